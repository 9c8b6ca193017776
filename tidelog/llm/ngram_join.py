"""Exact Jaccard join of n-gram sets by vertical partitioning.

The global order of the n-grams (rare ones first, then by hash) is cut into vertical fragments. The
first fragment of a set is its prefix: two sets that link share an n-gram there, and the shared ones
are counted and summed per pair to drop pairs that cannot reach the needed overlap. What is left is
compared over all fragments of the hash range: partial overlaps are counted fragment by fragment and
summed per pair, and the sum decides exactly.

Documents with equal sets are one class. A first round links each class to the most central class
that it shares most lists with; later only pairs between different components are looked at, so a
group of near copies costs about as many pairs as it has members. Lists that are still long are
compared block against block, with a bound on the symmetric difference from parity bitmaps, and
only pairs that the bound lets pass leave the task.

Scale: n-grams travel packed (a few bytes each) to fragments, the number of which follows the bytes of
text, so a task holds those of PART_BYTES; what is broadcast has a fixed bound (FREQUENT
n-grams, FILTER_BITS); no group is collected.
n-grams and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import wordhash as W
from .common import checkpoint, components, table

#: The contract of the op3 query; other callers name their own shingle length and percentage.
NGRAM, PERCENT = 4, 85
#: n-grams whose frequency is known to every task (the most frequent ones); the rest come first.
FREQUENT, LEAST_FREQUENT = 1 << 18, 4
#: Lists of more classes than this are compared in blocks of BLOCK classes.
LONG_LIST, BLOCK = 64, 256
MAP_BITS = 1024
#: Bits of the filter for texts in pairs: sixteen for each text, within these bounds (32 MB at most).
FILTER_BITS = 1 << 20, 1 << 28
FRAGMENTS = 4  # vertical fragments of a set in the exact comparison
#: Bytes of text whose n-grams one task counts, up to so many tasks (beyond, a task holds more: at
#: 100 TB about 800 MB of text, a quarter of that in a fragment), and n-grams that are packed together.
PART_BYTES, MOST_PARTS, FLUSH = 1 << 26, 1 << 17, (1 << 20, 1 << 23)
_U = np.uint64


def ngram_sets(buf: np.ndarray, bounds: np.ndarray, n: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct n-gram hashes, sorted, one row after the other, and the rows' bounds. A row
    of fewer than n words has its whole sequence as one; a row without words has none."""
    starts, ends, first = W.spans(buf, bounds)
    words = W.span_hash(buf, starts, ends, W.LOWER)
    grams = W.ngrams(words, n)
    out = []
    with np.errstate(over="ignore"):
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= n:
                g = np.sort(grams[a : b - n + 1])
                keep = np.ones(len(g), bool)
                np.not_equal(g[1:], g[:-1], out=keep[1:])
                out.append(g[keep])
            elif b > a:
                h = _U(b - a)
                for w in words[a:b]:
                    h = W.mix64(np.array([h * _U(0x9FB21C651E98DF25) + w], np.uint64))[0]
                out.append(np.array([h], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)


def short_ids(grams: np.ndarray, bits: int) -> np.ndarray:
    """The fragment (top bits) and 32 more bits: enough to find candidates, not to decide."""
    return grams >> _U(32 - bits)


def _packed(ids: np.ndarray, bits: int, owners: np.ndarray | None = None, planes: int = 4) -> Iterator[pa.RecordBatch]:
    """A row for each fragment: sorted keys as byte planes, the high ones of which compress well."""
    order = np.argsort(ids, kind="stable") if owners is not None else None
    ids = np.sort(ids) if owners is None else ids[order]
    cut = np.searchsorted(ids >> _U(32), np.arange((1 << bits) + 1, dtype=np.uint64))
    some = np.flatnonzero(np.diff(cut))
    keys = (ids & _U(0xFFFFFFFF)).astype(np.uint32)
    cols = {"frag": pa.array(some, pa.int32()), "ids": pa.array([np.ascontiguousarray(keys[cut[f] : cut[f + 1]].view(np.uint8).reshape(-1, 4)[:, 4 - planes :].T).tobytes() for f in some], pa.binary())}
    if owners is not None:
        owners = owners[order]
        cols["owners"] = pa.array([owners[cut[f] : cut[f + 1]].tobytes() for f in some], pa.binary())
    yield pa.record_batch(cols)


def _unpacked(col: pa.ChunkedArray, planes: int = 4) -> np.ndarray:
    """The keys of these rows; of fewer planes only the high bytes, moved down."""
    parts = []
    for x in col.to_pylist():
        whole = np.zeros((len(x) // planes, 4), np.uint8)
        whole[:, :planes] = np.frombuffer(x, np.uint8).reshape(planes, -1).T
        parts.append(whole.view(np.uint32).ravel())
    return np.concatenate(parts)


def frequent(docs: DataFrame, bits: int, gram: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Coarse ids (short ids without their last byte) of the most frequent n-grams, sorted, and in how
    many rows they are, counted over all rows. At most FREQUENT of them reach the driver, whatever the
    size of the input. n-grams of one coarse id share a place in the order, which is as valid."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for _, _, buf, bounds in W.chunks(batch.column(0)):
                ids = short_ids(ngram_sets(buf, bounds, gram)[0], bits)
                held.append(ids)
                n += len(ids)
                if n >= flush_size(bits):
                    yield from _packed(np.concatenate(held), bits, planes=3)
                    held, n = [], 0
        if n:
            yield from _packed(np.concatenate(held), bits, planes=3)

    most = -(-FREQUENT >> bits) or 1

    def count(rows: pa.Table) -> pa.Table:
        key, n = np.unique(_unpacked(rows.column("ids"), planes=3), return_counts=True)
        top = np.argsort(-n, kind="stable")[:most]
        top = top[n[top] >= LEAST_FREQUENT]
        frag = rows.column("frag")[0].as_py()
        return pa.table({"id": pa.array((frag << 24) | key[top].astype(np.int64), pa.int64()), "n": pa.array(n[top], pa.int64())})

    got = spread(docs.mapInArrow(emit, "frag int, ids binary"), bits).groupBy("frag").applyInArrow(count, "id bigint, n bigint").toArrow()
    ids, n = (got.column(c).to_numpy() for c in ("id", "n"))
    order = np.argsort(ids)
    return ids[order].astype(np.uint64), n[order]


def _needed(a, b, percent: int):
    """Least overlap of linked sets of these sizes."""
    return F.ceil((a + b) * percent / (100 + percent))


def _least_shared(a, b, percent: int):
    """Least number of prefix n-grams that linked sets of these sizes share: the set whose prefix ends
    first in the global order misses at most size - needed overlap of its n-grams there."""
    rest = lambda n: 1 - F.ceil(n * percent / 100)
    return F.least(rest(a), rest(b)) + _needed(a, b, percent)


def flush_size(bits: int) -> int:
    """n-grams packed together: more where there are more fragments to fill."""
    return min(FLUSH[1], max(FLUSH[0], 256 << bits))


def spread(packed: DataFrame, bits: int) -> DataFrame:
    """Packed rows by fragment, four fragments to a task; where the session has partitions enough, the
    grouping's own shuffle does it."""
    parts = 1 << max(0, bits - 2)
    return packed.repartition(parts, "frag") if parts > int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")) else packed


def prefix_length(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


SETS = "doc_id bigint, mark bigint, cls bigint, n bigint, central double, map array<bigint>, often array<bigint>, rare array<bigint>"


def describe(docs: DataFrame, often: np.ndarray, counts: np.ndarray, bits: int, gram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """Per row its set's class (hash of the set; null without words), size, mean frequency, parity
    bitmap and prefix in the global order, frequent and other n-grams apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, bounds in W.chunks(batch.column(1)):
                grams, cut = ngram_sets(buf, bounds, gram)
                n, rows = np.diff(cut), np.repeat(np.arange(j - i), np.diff(cut))
                ids = short_ids(grams, bits)
                level = np.zeros(len(ids), np.int64)
                if len(often) and len(ids):
                    coarse = ids >> _U(8)
                    at = np.minimum(np.searchsorted(often, coarse), len(often) - 1)
                    level = np.where(often[at] == coarse, counts[at], 0)
                total = np.zeros(len(grams) + 1, np.uint64)
                with np.errstate(over="ignore"):
                    np.cumsum(W.mix64(grams), out=total[1:])
                    cls = W.mix64(total[cut[1:]] - total[cut[:-1]] + n.astype(np.uint64)).view(np.int64)
                central = np.bincount(rows, level, j - i) / np.maximum(n, 1)
                parity = np.bincount(rows * MAP_BITS + (grams & _U(MAP_BITS - 1)).astype(np.int64), minlength=(j - i) * MAP_BITS) & 1
                maps = np.packbits(parity.astype(np.uint8).reshape(j - i, MAP_BITS), axis=1).view(np.int64)
                want, common, rare = prefix_length(n, percent), [], []
                signed = ids.view(np.int64)
                for k in range(j - i):
                    own, lv = signed[cut[k] : cut[k + 1]], level[cut[k] : cut[k + 1]]
                    if lv.any():
                        first = own[lv == 0][: want[k]]
                        rest = np.flatnonzero(lv)
                        rest = own[rest[np.argsort(lv[rest], kind="stable")[: max(0, want[k] - len(first))]]]
                    else:
                        first, rest = own[: want[k]] if n[k] else own, own[:0]
                    rare.append(first)
                    common.append(rest)
                lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in col])]), pa.int32()), pa.array(np.concatenate(col), pa.int64())) for col in (common, rare)]
                part = batch.slice(i, j - i)
                yield pa.record_batch([part.column(0), part.column(2), pa.array(cls, pa.int64(), mask=n == 0), pa.array(n, pa.int64()), pa.array(central), pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1) * maps.shape[1], pa.int32()), pa.array(maps.ravel())), *lists], ["doc_id", "mark", "cls", "n", "central", "map", "often", "rare"])

    return docs.mapInArrow(run, SETS)


def shared_lists(sets: DataFrame, bits: int) -> DataFrame:
    """(token, cls): the prefix n-grams that at least two classes have. Frequent ones are aggregated
    row by row, so a long list is in no one task; the others, whose number of rows per n-gram is
    bounded by the least counted frequency, meet packed in their fragment."""
    common = sets.where("cls is not null").select(F.explode("often").alias("token"), "cls").distinct()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, owners, n = [], [], 0
        for batch in batches:
            lists = batch.column(1)
            ids.append(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            owners.append(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)))
            n += len(ids[-1])
            if n >= flush_size(bits):
                yield from _packed(np.concatenate(ids), bits, np.concatenate(owners))
                ids, owners, n = [], [], 0
        if n:
            yield from _packed(np.concatenate(ids), bits, np.concatenate(owners))

    def meet(rows: pa.Table) -> pa.Table:
        key = _unpacked(rows.column("ids"))
        own = np.concatenate([np.frombuffer(x, np.int64) for x in rows.column("owners").to_pylist()])
        order = np.lexsort((own, key))
        key, own = key[order], own[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        key, own = key[new], own[new]
        twin = np.zeros(len(key), bool)
        twin[1:] = key[1:] == key[:-1]
        twin[:-1] |= twin[1:]
        frag = rows.column("frag")[0].as_py()
        return pa.table({"token": pa.array((frag << 32) | key[twin].astype(np.int64), pa.int64()), "cls": pa.array(own[twin], pa.int64())})

    packed = sets.where("cls is not null and size(rare) > 0").select("cls", "rare").mapInArrow(emit, "frag int, ids binary, owners binary")
    return common.union(spread(packed, bits).groupBy("frag").applyInArrow(meet, "token bigint, cls bigint"))


def verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, gram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes that link: partial overlaps in each vertical fragment, summed.

    Pairs whose parity bitmaps differ in more bits than linked sets may differ in n-grams are out
    before that. Only texts of classes in some pair are cut into n-grams again; a bit filter, sized by the
    number of pairs, keeps the others out before that, and the joins leave out what it lets pass.
    """
    of = lambda c: classes.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("map").alias(f"m{c}"))
    both = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b")
    differ = F.aggregate(F.zip_with("ma", "mb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    pairs = checkpoint(both.where(differ <= F.col("na") + F.col("nb") - 2 * _needed(F.col("na"), F.col("nb"), percent)).select("a", "b", "na", "nb"))
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    size = min(FILTER_BITS[1], max(FILTER_BITS[0], 1 << (16 * pairs.count()).bit_length()))
    spot = F.pmod(F.col("mark"), F.lit(size))
    bits = (
        ends.join(classes.select("cls", "mark"), "cls")
        .select(spot.alias("spot"))
        .groupBy(F.bitmap_bucket_number("spot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
        .collect()
    )
    wide = 4096
    mask = np.zeros((size // (8 * wide) + 2, wide), np.uint8)
    for r in bits:
        mask[r.bucket] = np.frombuffer(r.bits, np.uint8)
    mask = mask.ravel()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            spots = batch.column(2).to_numpy(zero_copy_only=False)
            # bucket numbers start at 1 for spot 1; spot 0 is bucket 0
            number, place = (spots + 8 * wide - 1) // (8 * wide), (spots - 1) % (8 * wide)
            place = np.where(spots == 0, 0, place)
            chosen = np.flatnonzero(mask[number * wide + place // 8] >> (place % 8).astype(np.uint8) & 1)
            if not len(chosen):
                continue
            for i, j, buf, bounds in W.chunks(batch.column(1).take(pa.array(chosen))):
                grams, at = ngram_sets(buf, bounds, gram)
                n = np.diff(at)
                total = np.zeros(len(grams) + 1, np.uint64)
                with np.errstate(over="ignore"):
                    np.cumsum(W.mix64(grams), out=total[1:])
                    cls = W.mix64(total[at[1:]] - total[at[:-1]] + n.astype(np.uint64)).view(np.int64)
                rows = []
                for k in range(j - i):
                    c = int(cls[k])
                    if n[k] and c not in seen:
                        seen.add(c)
                        own = grams[at[k] : at[k + 1]]
                        edge = np.searchsorted(own >> _U(62), np.arange(FRAGMENTS + 1, dtype=np.uint64))
                        rows += [(c, f, own[edge[f] : edge[f + 1]].view(np.int64)) for f in range(FRAGMENTS) if edge[f] < edge[f + 1]]
                if rows:
                    flat = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for _, _, x in rows])]), pa.int32()), pa.array(np.concatenate([x for _, _, x in rows]), pa.int64()))
                    yield pa.record_batch([pa.array([c for c, _, _ in rows], pa.int64()), pa.array([f for _, f, _ in rows], pa.int32()), flat], ["cls", "frag", "grams"])

    parts = docs.select("doc_id", "text", F.pmod("mark", F.lit(size)).alias("spot")).mapInArrow(cut, "cls bigint, frag int, grams array<bigint>")
    parts = parts.groupBy("cls", "frag").agg(F.first("grams").alias("grams"))
    left = parts.select(F.col("cls").alias("a"), "frag", F.col("grams").alias("one"))
    right = parts.select(F.col("cls").alias("b"), "frag", F.col("grams").alias("two"))
    sums = (
        pairs.join(left, "a")
        .join(right, ["b", "frag"])
        .select("a", "b", "na", "nb", F.size(F.array_intersect("one", "two")).alias("partial"))
        .groupBy("a", "b", "na", "nb")
        .agg(F.sum("partial").alias("overlap"))
    )
    return sums.where(100 * F.col("overlap") >= percent * (F.col("na") + F.col("nb") - F.col("overlap"))).select("a", "b")


def _close(rows: pa.Table, percent: int) -> pa.Table:
    """Pairs of different components in one block or between two that the bitmaps do not rule out:
    where two sets differ in d n-grams, their parity bitmaps differ in at most d bits."""
    same = rows.column("i")[0].as_py() == rows.column("j")[0].as_py()
    cls, comp, n, block = (rows.column(c).to_numpy() for c in ("cls", "component", "n", "block"))
    maps = rows.column("map").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(cls), -1)
    one = np.arange(len(cls)) if same else np.flatnonzero(block == rows.column("i")[0].as_py())
    two = one if same else np.flatnonzero(block != rows.column("i")[0].as_py())
    left, right = [], []
    for k in range(0, len(one), 64):
        a = one[k : k + 64]
        na, nb = n[a][:, None], n[two][None, :]
        most = na + nb - 2 * -(-(na + nb) * percent // (100 + percent))
        ok = (comp[a][:, None] != comp[two][None, :]) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
        x, y = np.nonzero(ok)
        far = np.bitwise_count(maps[a[x]] ^ maps[two[y]]).sum(axis=1, dtype=np.int64)
        good = far <= most[x, y]
        left.append(cls[a[x[good]]])
        right.append(cls[two[y[good]]])
    a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (left, right))
    pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pa.table({"a": pa.array(pair[:, 0], pa.int64()), "b": pa.array(pair[:, 1], pa.int64())})


def leftover_pairs(lists: DataFrame, classes: DataFrame, found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of classes in different components that may link: from short lists those whose count of
    shared prefix n-grams allows the needed overlap, from long ones what the bitmaps let pass."""
    of = found.select(F.col("node").alias("cls"), "component")
    rows = lists.join(of, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    open_ = rows.groupBy("token").agg(F.count("*").alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token", "m")
    rows = checkpoint(rows.join(open_, "token").join(classes.select("cls", "n", "map"), "cls"))
    short = rows.where(F.col("m") <= LONG_LIST).drop("map")
    long = rows.where(F.col("m") > LONG_LIST)
    many = long.groupBy("cls").agg(F.count("*").alias("hot"))
    short = short.join(many, "cls", "left").withColumn("hot", F.coalesce("hot", F.lit(0)))
    x, y = short.alias("x"), short.alias("y")
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.cls") < F.col("y.cls")) & (F.col("x.component") != F.col("y.component")) & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")))
    met = met.groupBy(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).agg(
        F.count("*").alias("shared"), F.first("x.n").alias("na"), F.first("y.n").alias("nb"), F.first(F.least("x.hot", "y.hot")).alias("hot"))
    near = met.where(F.col("shared") + F.col("hot") >= _least_shared(F.col("na"), F.col("nb"), percent)).select("a", "b")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    long = long.withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    long = long.select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cls", "component", "n", "map")
    far = long.groupBy("token", "i", "j").applyInArrow(lambda rows: _close(rows, percent), "a bigint, b bigint")
    return near.union(far).distinct()


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """(doc_id, mark, n_shingles, component_id) of every row; mark is the text's xxhash64.

    A row's set is its distinct n-grams of `gram` words (A-Z lower-cased); rows link where
    100 * overlap >= percent * union; component_id is the smallest id reachable. Null and empty texts have an empty set and
    link with nothing (component_id is their own id). Repeated rows and ids each come back; null ids
    do not count as smallest, and a component of null ids alone has a null id. Ids are
    bigint or cast to it. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = docs.agg(F.sum(F.octet_length(text)).alias("bytes")).first().bytes or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTS, -(-held // PART_BYTES)))
    bits = max(8, int(np.ceil(np.log2(4 * parts))))
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    often, counts = frequent(base.select("text"), bits, gram)
    sets = checkpoint(describe(base.select("doc_id", "text", "mark"), often, counts, bits, gram, percent))
    classes = sets.where("cls is not null").groupBy("cls").agg(F.min("mark").alias("mark"), F.min("n").alias("n"), F.max("central").alias("central"), F.min("map").alias("map"), F.min("doc_id").alias("least_id"))
    classes = checkpoint(classes)
    lists = checkpoint(shared_lists(sets.select("cls", "often", "rare"), bits))
    # First round: each class with the most central class of the lists that it is in.
    ranked = lists.join(classes.select("cls", "central", "n"), "cls")
    heads = ranked.groupBy("token").agg(F.max(F.struct("central", "cls", "n")).alias("head"))
    tries = ranked.join(heads, "token").where((F.col("cls") != F.col("head.cls")) & (100 * F.least("n", "head.n") >= percent * F.greatest("n", "head.n")))
    tries = tries.groupBy("cls", "n", F.col("head.cls").alias("to"), F.col("head.n").alias("nto")).agg(F.count("*").alias("k"))
    # Pairs that share little can wait for the exact round: most of them are chance.
    tries = tries.where(2 * F.col("k") >= _least_shared(F.col("n"), F.col("nto"), percent)).groupBy("cls").agg(F.max(F.struct("k", "to")).alias("best"))
    first = checkpoint(verify(checkpoint(tries.select(F.least("cls", "best.to").alias("a"), F.greatest("cls", "best.to").alias("b")).distinct()), base, classes, gram, percent))
    rest = checkpoint(leftover_pairs(lists, classes, components(first), percent))
    second = verify(rest, base, classes, gram, percent)
    whole = components(first.union(second))
    least = classes.select("cls", "least_id").join(whole.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    ids = least.groupBy(F.col("component").alias("of")).agg(F.min("least_id").alias("component_id"))
    named = least.select(F.col("cls").alias("known"), "component").join(ids, F.col("component") == F.col("of")).select("known", "component_id")
    out = sets.select("doc_id", "mark", "cls", "n").join(named, F.col("cls") == F.col("known"), "left")
    return out.select("doc_id", "mark", F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, unchanged, of which each linked group keeps only the one of smallest id.

    Rows without words are in no group and stay. Repeated rows of words stay once. A row of null id
    goes if it links with one that has an id; rows of null id alone stay, once for each text.
    """
    names = docs.columns
    kept = link_components(docs, id_col, text_col, gram, percent).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "mark").agg(F.max("n_shingles").alias("n_shingles"))
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("mark").alias("kept_mark"), "n_shingles")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).cast("bigint").alias("own_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("own_mark"))
    met = whole.join(kept, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_mark") == F.col("kept_mark")))
    twice = F.when(F.col("n_shingles") > 0, F.lit(0)).otherwise(F.monotonically_increasing_id())
    return met.withColumn("apart", twice).dropDuplicates(["own_id", "own_mark", "apart"]).select("row.*")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents").select("doc_id", "text"), gram=NGRAM, percent=PERCENT).drop("mark")
