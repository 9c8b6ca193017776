"""Settlement on a stream: tracked positions and commit windows as keyed state.

State is kept as runs of offsets, so settles that come out of order cost memory by their gaps only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.functions import runs


class _Tracker(StatefulProcessor):
    """Of one partition: the offsets delivered since its last restart, and those settled under its generation."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "generation bigint, last bigint, position bigint, delivered binary, settled binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        generation, last, position, delivered, settled = self.state.get() if self.state.exists() else (None, -1, None, b"", b"")
        delivered, settled = runs.unpacked(delivered), runs.unpacked(settled)
        part = pd.concat(list(rows)).sort_values("seq", kind="stable")
        came, done = part[~part["settles"]], part[part["settles"]]
        if len(came):
            offset, era = came["offset"].to_numpy(np.int64), came["generation"].to_numpy(np.int64)
            before = np.concatenate([[last], offset[:-1]])
            era_before = np.concatenate([[era[0] if generation is None else generation], era[:-1]])
            restarts = np.flatnonzero((offset <= before) | (era != era_before))
            if len(restarts):
                delivered, offset_now = runs.EMPTY, offset[restarts[-1] :]
            else:
                offset_now = offset
            delivered = runs.union(delivered, runs.of(offset_now))
            if generation is not None and era[-1] != generation:
                settled = runs.EMPTY  # a settle of an older generation is void
            generation, last = int(era[-1]), int(offset[-1])
        if len(done) and generation is not None:
            settled = runs.union(settled, runs.of(done["offset"][done["generation"] == generation]))
        open_ = runs.minus(delivered, settled)
        some = runs.size(open_) < runs.size(delivered)
        at = int(open_[0, 0]) if len(open_) else int(delivered[-1, 1]) if len(delivered) else 0
        new = at if some and at > 0 else None
        self.state.update((generation, last, new, runs.packed(delivered), runs.packed(settled)))
        if new != position:
            yield pd.DataFrame({"topic": [key[0]], "partition": pd.array([key[1]], dtype="Int32"), "next_offset": pd.array([new], dtype="Int64")})

    def close(self) -> None:
        pass


def tracked_positions(stream: DataFrame) -> DataFrame:
    """Stream form of the tracked positions (settle.committed_after_replay): rows (topic, partition, seq,
    offset, generation, settles), a row for each delivery and for each settle, in the order of seq
    within a partition, give (topic, partition, next_offset) whenever a partition's position changes;
    null where nothing is stored any more.

    An offset not above the one before it, or another generation, starts over with only itself open.
    Settles may come in any order and in any later micro-batch; one counts for what is delivered under
    its generation, whichever reading of it, and one of an older generation is void. A null generation
    is generation 0. Needs the RocksDB state store. Output mode is append; the last row of a partition
    holds."""
    rows = stream.select("topic", "partition", "seq", "offset", F.coalesce("generation", F.lit(0)).cast("bigint").alias("generation"), "settles")
    return rows.groupBy("topic", "partition").transformWithStateInPandas(statefulProcessor=_Tracker(), outputStructType="topic string, partition int, next_offset bigint", outputMode="Append", timeMode="None")


#: What can be told of a commit window, in the order of their codes.
_EVENTS = ["enrolled", "settled", "failed", "closed"]
_ENROLLED, _SETTLED, _FAILED, _CLOSED = range(4)
#: Windows are kept by _LANE together, so that Python and the state store are called once for them all. Those
#: of a lane lie _LANE apart in a block of _LANE squared: windows next to each other are in different tasks.
_BITS = 6
_LANE = 1 << _BITS
#: The lane of a null window; no other one has this number.
_NO_WINDOW = 1 << 62
#: A set of runs is named by its window's place in the lane, its topic's code and its partition.
_AT_WINDOW, _AT_TOPIC = 56, 32


class _Lane(StatefulProcessor):
    """The commit windows of one lane: what each enrolled and what of that has settled, until it is given out once."""

    #: A window's facts: records it was closed with (-1: not closed), failed, deadline (0: none), given.
    BLANK = np.array([-1, 0, 0, 0])

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "topics array<string>, facts binary, enrolled binary, settled binary")

    def _read(self) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        had = self.state.get()
        facts = np.tile(self.BLANK, (_LANE, 1))
        if had is None:
            return [], facts, runs.NONE, runs.NONE
        known = np.frombuffer(bytes(had[1]), "<i8").reshape(-1, 5)
        facts[known[:, 0]] = known[:, 1:]
        return list(had[0]), facts, runs.unpacked_many(had[2]), runs.unpacked_many(had[3])

    def _write(self, topics: list, facts: np.ndarray, enrolled: np.ndarray, settled: np.ndarray) -> None:
        known = np.flatnonzero((facts != self.BLANK).any(axis=1))
        if not len(enrolled) and not len(settled):
            topics = []
        self.state.update((topics, np.column_stack([known, facts[known]]).astype("<i8").tobytes(), runs.packed_many(enrolled), runs.packed_many(settled)))

    def _give(self, key, topics: list, facts: np.ndarray, enrolled: np.ndarray, settled: np.ndarray, windows: np.ndarray, committed: np.ndarray) -> pd.DataFrame:
        """Windows of the lane to be given out, by their places in it; the rest is written back."""
        n = _records(enrolled)[windows]
        facts[windows] = self.BLANK
        facts[windows, 3] = 1
        enrolled, settled = (x[facts[x[:, 0] >> _AT_WINDOW, 3] == 0] for x in (enrolled, settled))
        self._write(topics, facts, enrolled, settled)
        lane = int(key[0])
        names = [None if lane == _NO_WINDOW else lane >> _BITS << 2 * _BITS | w << _BITS | lane & _LANE - 1 for w in windows.tolist()]
        return pd.DataFrame({"window": pd.array(names, dtype="Int64"), "n": n, "committed": committed})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        topics, facts, enrolled, settled = self._read()
        codes = {t: i for i, t in enumerate(topics)}
        for part in rows:
            at, offset = part["at"].to_numpy(np.int64), part["offset"].to_numpy(np.int64)
            topic, names = pd.factorize(part["topic"])
            topic = np.array([codes.setdefault(t, len(codes)) for t in names], np.int64)[topic]
            window, kind = at >> _AT_WINDOW, at >> _AT_TOPIC & 3
            new = facts[window, 3] == 0
            sets = window << _AT_WINDOW | topic << _AT_TOPIC | at & 0xFFFFFFFF
            facts[window[new & (kind == _FAILED)], 1] = 1
            closing = np.flatnonzero(new & (kind == _CLOSED) & (facts[window, 0] < 0))
            if len(closing):
                closed, first = np.unique(window[closing], return_index=True)
                facts[closed, 0] = np.maximum(offset[closing][first], 0)
                if self.timeout_ms:
                    facts[closed, 2] = timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms
                    self.handle.registerTimer(int(facts[closed[0], 2]))
            of = [runs.of_many(sets[new & (kind == k)], offset[new & (kind == k)]) for k in (_ENROLLED, _SETTLED)]
            enrolled, settled = runs.union_many(enrolled, of[0]), runs.union_many(settled, of[1])
        unsettled = np.zeros(_LANE, bool)
        unsettled[enrolled[~runs.inside_many(enrolled, settled), 0] >> _AT_WINDOW] = True
        failed = facts[:, 1] == 1
        given = np.flatnonzero((facts[:, 3] == 0) & (facts[:, 0] >= 0) & (_records(enrolled) >= facts[:, 0]) & (failed | ~unsettled))
        if len(given):
            yield self._give(key, list(codes), facts, enrolled, settled, given, ~unsettled[given] & ~failed[given])
        else:
            self._write(list(codes), facts, enrolled, settled)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        lane = self._read()
        late = np.flatnonzero((lane[1][:, 2] > 0) & (lane[1][:, 2] <= expiredTimerInfo.getExpiryTimeInMs()))
        if len(late):
            yield self._give(key, *lane, late, np.zeros(len(late), bool))

    def close(self) -> None:
        pass


def _records(enrolled: np.ndarray) -> np.ndarray:
    """How many records each window of a lane has enrolled."""
    n = np.zeros(_LANE, np.int64)
    np.add.at(n, enrolled[:, 0] >> _AT_WINDOW, enrolled[:, 2] - enrolled[:, 1])
    return n


def commit_windows(stream: DataFrame, timeout_ms: int = 0) -> DataFrame:
    """Stream form of eos_windows: events (window, topic, partition, offset, event) give (window, n,
    committed) once for each window. event: `enrolled` of a source record, then `settled` or `failed` of it,
    and `closed`, whose offset is how many records the window enrolled in all; they may come in any
    order and over many micro-batches, and repeated ones count once.

    A closed window commits when all that it enrolled has settled, and aborts when anything in it failed
    or, with a timeout, when it has waited so long. What comes after it was given out is ignored, and so
    are other events, an enrolled or settled record without full coordinates and a close without a number.
    Needs the RocksDB state store. 64 windows, each 64 apart, share one state and one call of Python; where
    windows are numbered with wide gaps each has its own, which costs more time a window."""
    event, window = F.col("event"), F.col("window").cast("bigint")
    kind = F.array_position(F.array(*[F.lit(e) for e in _EVENTS]), event) - 1
    placed = F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    told = (event == "failed") | (event.isin("enrolled", "settled") & placed) | ((event == "closed") & F.col("offset").isNotNull())
    lane = F.shiftleft(F.shiftright(window, 2 * _BITS), _BITS).bitwiseOR(window.bitwiseAND(F.lit(_LANE - 1).cast("bigint")))
    place = F.coalesce(F.shiftright(window, _BITS).bitwiseAND(F.lit(_LANE - 1).cast("bigint")), F.lit(0).cast("bigint"))
    partition = F.coalesce(F.col("partition").cast("int").cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")), F.lit(0).cast("bigint"))
    at = F.shiftleft(place, _AT_WINDOW).bitwiseOR(F.shiftleft(kind, _AT_TOPIC)).bitwiseOR(partition)
    rows = stream.where(told).select(F.coalesce(lane, F.lit(_NO_WINDOW).cast("bigint")).alias("lane"), F.coalesce("topic", F.lit("")).alias("topic"), at.alias("at"), F.coalesce("offset", F.lit(0)).cast("bigint").alias("offset"))
    return rows.groupBy("lane").transformWithStateInPandas(statefulProcessor=_Lane(timeout_ms), outputStructType="window bigint, n bigint, committed boolean", outputMode="Append", timeMode="ProcessingTime" if timeout_ms else "None")


def lineage_as_it_settles(outputs: DataFrame, log: DataFrame, within: str = "10 minutes") -> DataFrame:
    """Stream form of source_lineage: outputs (output_id, topic, partition, offset, at: when they were
    written) met with log records (topic, partition, offset, timestamp) in a stream-stream outer join.
    `found` comes at once; `lost` and `silent` come when the watermarks have passed the time in which
    an output follows its record (`within`). An output may be up to that much older than its record,
    as clocks differ."""
    left = outputs.select("output_id", F.col("topic").alias("o_topic"), F.col("partition").alias("o_partition"), F.col("offset").alias("o_offset"), "at").withWatermark("at", within)
    right = log.select("topic", "partition", "offset", "timestamp").withWatermark("timestamp", within)
    on = F.expr(f"o_topic = topic AND o_partition = partition AND o_offset = offset AND at BETWEEN timestamp - INTERVAL {within} AND timestamp + INTERVAL {within}")
    both = left.join(right, on, "full_outer")
    status = F.when(F.col("o_topic").isNull(), "silent").when(F.col("topic").isNull(), "lost").otherwise("found")
    place = [F.coalesce(c, f"o_{c}").alias(c) for c in ("topic", "partition", "offset")]
    return both.select("output_id", *place, status.alias("status"))
