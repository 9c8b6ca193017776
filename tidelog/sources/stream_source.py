"""The log as a streaming source of its own: offsets are positions of partitions.

`spark.readStream.format("tidelog")` starts at any position, pins the ends of a micro-batch when it is
planned, and admits at most `records` records to it. Only file footers are read to plan, or the narrow
columns of files whose row groups mix partitions; each file once. Files are read through Arrow's file
systems (local paths, hdfs, s3, gs), by tasks that take a range of one partition's offsets each.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidelog.functions import runs
from tidelog.sources.logs import SCHEMA

#: Offsets of a partition that a task reads at most.
SPAN = 1 << 16


def register(spark: SparkSession) -> None:
    """Makes the format known to a session."""
    spark.dataSource.register(LogSource)


class LogSource(DataSource):
    """Options: path; start: `earliest` (default), `latest`, `timestamp:<epoch milliseconds>`, or JSON
    {topic: {partition: offset}} whose other partitions start at `reset` (earliest or latest; an offset
    outside the log does too); topics: names by commas (default all); records: at most so many in a
    micro-batch (needs progress); progress: a folder for what was planned last, one for each query."""

    @classmethod
    def name(cls) -> str:
        return "tidelog"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return LogReader(schema, dict(self.options))


def _files(where: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder: a local path or a URI, `file:/x` as Hadoop writes it too."""
    if not re.match(r"[a-z][a-z0-9+.\-]*:/", where):
        return pafs.LocalFileSystem(), where
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", where))


class Span(InputPartition):
    def __init__(self, topic: str, partition: int, first: int, end: int):
        self.topic, self.partition, self.first, self.end = topic, partition, first, end


Ends = dict[str, dict[str, int]]


class LogReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options = schema, options
        self.records = int(options.get("records", 0))
        if self.records and not options.get("progress"):
            raise ValueError("a bounded stream needs the option progress, a folder of its own")
        self.files: set[str] = set()
        self.covered: dict[tuple[str, int], np.ndarray] = {}
        self.planned: Ends | None = None

    # ---- what there is ----

    def _dataset(self) -> ds.Dataset:
        fs, path = _files(self.options["path"])
        if not fs.get_file_info(path).type == pafs.FileType.Directory:
            return ds.dataset([], schema=pa.schema([("topic", pa.string())]))
        return ds.dataset(path, filesystem=fs, format="parquet", partitioning=ds.partitioning(pa.schema([("topic", pa.string())]), flavor="hive"))

    def _of_file(self, fragment: ds.ParquetFileFragment) -> dict[tuple[str, int], tuple[int, int]]:
        """(first offset, one past the last) of each partition in a file."""
        topic = ds.get_partition_keys(fragment.partition_expression).get("topic")
        found: dict = {}

        def put(topic: str, partition: int, low: int, high: int) -> None:
            had = found.get((topic, partition), (low, high + 1))
            found[topic, partition] = (min(had[0], low), max(had[1], high + 1))

        for group in fragment.row_groups:
            s = group.statistics or {}
            if topic is not None and (p := s.get("partition")) and p["min"] == p["max"] and s.get("offset"):
                put(topic, p["min"], s["offset"]["min"], s["offset"]["max"])
                continue
            part = fragment.subset(row_group_ids=[group.id]).to_table(columns=[c for c in ("topic", "partition", "offset") if c != "topic" or topic is None])
            part = part if topic is None else part.append_column("topic", pa.array([topic] * part.num_rows))
            for r in part.group_by(["topic", "partition"]).aggregate([("offset", "min"), ("offset", "max")]).to_pylist():
                put(r["topic"], r["partition"], r["offset_min"], r["offset_max"])
        return found

    def _places(self) -> dict[tuple[str, int], np.ndarray]:
        """Of each partition the runs of offsets that its files cover."""
        named = {t for t in self.options.get("topics", "").split(",") if t}
        for fragment in self._dataset().get_fragments():
            if fragment.path not in self.files:
                self.files.add(fragment.path)
                for place, span in self._of_file(fragment).items():
                    if not named or place[0] in named:
                        self.covered[place] = runs.union(self.covered.get(place, runs.EMPTY), np.array([span], np.int64))
        return self.covered

    # ---- positions ----

    def initialOffset(self) -> dict:  # noqa: N802
        start, reset = self.options.get("start", "earliest"), self.options.get("reset", "earliest")
        places, out = self._places(), {}
        given = json.loads(start) if start.lstrip().startswith("{") else {}
        moment = int(start.removeprefix("timestamp:")) if start.startswith("timestamp:") else None
        if not given and moment is None and start not in ("earliest", "latest"):
            raise ValueError(f"unknown position {start!r}")
        for (topic, partition), own in places.items():
            end = int(own[-1, 1])
            fall = end if (reset if given else start) == "latest" else 0
            at = given.get(topic, {}).get(str(partition))
            if moment is not None:
                at = self._at_time(topic, partition, moment, end)
            out.setdefault(topic, {})[str(partition)] = at if at is not None and 0 <= at <= end else fall
        return out

    def _at_time(self, topic: str, partition: int, moment: int, end: int) -> int:
        """The lowest offset at or after a moment, else the end."""
        data = self._dataset()
        when = pa.scalar(moment * 1000, pa.timestamp("us")).cast(data.schema.field("timestamp").type, safe=False)
        at = data.to_table(columns=["offset"], filter=(ds.field("topic") == topic) & (ds.field("partition") == partition) & (ds.field("timestamp") >= when))
        return end if not at.num_rows else pc.min(at["offset"]).as_py()

    def _last(self) -> Ends:
        """What was planned last, in this process or in one before it."""
        if self.planned is None:
            fs, folder = _files(self.options["progress"])
            at = f"{folder}/planned.json"
            self.planned = json.loads(fs.open_input_stream(at).read()) if fs.get_file_info(at).type == pafs.FileType.File else self.initialOffset()
        return self.planned

    def latestOffset(self) -> dict:  # noqa: N802
        places = self._places()
        if not self.records:
            out: Ends = {}
            for (topic, partition), own in places.items():
                out.setdefault(topic, {})[str(partition)] = int(own[-1, 1])
            return out
        last = self._last()
        out = {t: dict(p) for t, p in last.items()}
        # Where the next record of each partition may be, and how far its log goes.
        behind = {}
        for (topic, partition), own in places.items():
            at, end = last.get(topic, {}).get(str(partition), 0), int(own[-1, 1])
            if at < end:
                behind[topic, partition] = (max(at, int(own[own[:, 1] > at][0, 0])), end)
        left = self.records
        for n, (place, (at, end)) in enumerate(sorted(behind.items(), key=lambda x: x[1][1] - x[1][0])):
            take = min(end - at, left // (len(behind) - n))
            left -= take
            if take:
                out.setdefault(place[0], {})[str(place[1])] = at + take
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if self.records:
            fs, folder = _files(self.options["progress"])
            fs.create_dir(folder, recursive=True)
            made = f"{folder}/.{uuid.uuid4().hex}"
            with fs.open_output_stream(made) as f:
                f.write(json.dumps(end).encode())
            fs.move(made, f"{folder}/planned.json")
            self.planned = end
        out = []
        for topic, own in end.items():
            for partition, to in own.items():
                at = start.get(topic, {}).get(partition, 0)
                out += [Span(topic, int(partition), i, min(i + SPAN, to)) for i in range(at, to, SPAN)]
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        data, schema = self._dataset(), to_arrow_schema(self.schema)
        there = [n for n in schema.names if n in data.schema.names]
        own = (ds.field("topic") == partition.topic) & (ds.field("partition") == partition.partition) & (ds.field("offset") >= partition.first) & (ds.field("offset") < partition.end)
        rows = data.to_table(columns=there, filter=own).sort_by("offset")
        columns = [rows[n].cast(schema.field(n).type, safe=False) if n in there else pa.nulls(rows.num_rows, schema.field(n).type) for n in schema.names]
        yield from pa.table(columns, names=schema.names).to_batches(max_chunksize=10_000)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass
