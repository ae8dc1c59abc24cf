"""Near-duplicate documents: bottom-k sketches from one hash function.

A document's set are its distinct 5-word shingles; its sketch are the 64 smallest of
their hashes.  Documents with equal sets are one class, stood for by its smallest doc_id.
Of the classes:

1. Inverted lists of the 16 smallest values give candidates.  Two sets with a Jaccard
   similarity of 0.75 share none of their union's 16 smallest values with
   probability 0.25 ** 16, under 3e-10.
2. A list longer than ``LONG`` isn't paired off.  Its classes get a second index of all
   64 values, rarest first: linked sets share 24 of their union's 64 smallest values
   but for a probability under 1e-9, so they meet in one of the 41 rarest of either
   (if the union is no larger than a sketch: in the rarest quarter and one more, with certainty).
   Common passages are the last in this order and drop out.
3. Classes in lists that are still long are large groups of near copies.  They are
   indexed once more by whole sets, rarest first, which is exact, and each list is
   compared in blocks of at most ``BLOCK`` by ``BLOCK`` classes a task with whole
   sets; a task returns a spanning forest of its links, not its pairs.
4. Candidates from 1 and 2 are filtered by the similarity of the union's sketch
   (again 24 of 64) and confirmed on whole sets: first each class with its most similar
   candidate, then only pairs that are still in different components.

No list, block or candidate is cut.  Shingles are told apart by 63-bit hashes throughout.

Defined results: null and empty texts have no shingles and are linked with nothing; a
document of fewer than five words is one shingle; rows with a null doc_id stand
alone (component null, kept); rows that share a doc_id are one document with the links
of all of them and one component, whatever their texts; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorekeep.llm.common import U64, Words, batches_of, blocks, distinct, drop_written, materialize, mix64, release, slices, utf8
from lorekeep.llm.components import components

SHINGLE = 5
#: Similarity as a fraction.
NUM, DEN = 75, 100
SKETCH, INDEXED, SHARED = 64, 16, 24
LONG = 64
#: Classes in a block, and shingles of all of them, at most about.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: Rows of a batch sent to Python: a row can hold two whole sets.
BATCH = 512
#: Ids that are broadcast at most: 8 bytes each.
BROADCAST_IDS = 1_000_000
_MULT = U64(0xC2B2AE3D27D4EB4F)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 63-bit hashes of its shingles."""
    for some in blocks(texts):
        w = Words([t.lower() for t in some])
        n = len(w.hash)
        with np.errstate(over="ignore"):
            roll = np.zeros(n, U64)
            for j in range(size):
                roll[: max(0, n - j)] = roll[: max(0, n - j)] * _MULT + w.hash[j:]
            roll = (mix64(roll) >> U64(1)).astype(np.int64)
            for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
                if b - a >= size:
                    yield distinct(roll[a : b - size + 1])
                elif b > a:
                    h = U64(b - a)
                    for x in w.hash[a:b]:
                        h = h * _MULT + x
                    yield (mix64(np.array([h])) >> U64(1)).astype(np.int64)
                else:
                    yield np.zeros(0, np.int64)


def unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(b, "<i8")


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (null for empty sets) and the sketch of every row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = list(shingle_sets(b["body"].to_pylist()))
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            heads = [s[:SKETCH] for s in sets]
            offsets = np.concatenate(([0], np.cumsum([len(h) for h in heads]))).astype(np.int32)
            values = np.concatenate([*heads, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                names=["doc_id", "n_shingles", "set_key", "sketch"],
            )

    return d.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sketch array<long>")


def alike(n: str, m: str):
    """Sizes that allow the similarity: the smaller set is at least 75% of the larger."""
    return F.least(n, m) * DEN >= F.greatest(n, m) * NUM


def listed(keys: DataFrame) -> DataFrame:
    """From (v, rep, n): the rows of lists with more than one row, their length, and the sum of n."""
    lengths = keys.groupBy("v").agg(F.count("*").alias("length"), F.sum("n").alias("volume")).where("length > 1")
    return keys.join(lengths, "v")


def paired(lists: DataFrame) -> DataFrame:
    """(a, b) of classes that share a short list and have alike sizes; each at most LONG - 1 times per list."""
    short = lists.where(F.col("length") <= LONG)
    x = short.select("v", F.col("rep").alias("a"), F.col("n").alias("na"))
    y = short.select("v", F.col("rep").alias("b"), F.col("n").alias("nb"))
    return x.join(y, "v").where((F.col("a") < F.col("b")) & alike("na", "nb")).select("a", "b")


def rarest_first(keys: DataFrame, wanted) -> DataFrame:
    """From (v, rep, n): the rows of each class's ``wanted`` rarest values that others have too, with list lengths."""
    counts = keys.groupBy("v").agg(F.count("*").alias("_df"))
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("_df", "v"))
    return listed(keys.join(counts, "v").withColumn("_rank", rank).where((F.col("_rank") <= wanted) & (F.col("_df") > 1)).select("v", "rep", "n"))


def quarter(n: str = "n"):
    """Values of n that hold one of any three quarters of them."""
    return F.col(n) - F.ceil(F.col(n) * NUM / DEN) + 1


def among(rows: DataFrame, ids: DataFrame, column: str, key: str = "rep") -> DataFrame:
    """Rows whose ``column`` is one of ``ids``: broadcast up to a checked number, else joined by shuffle."""
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, rows[column] == ids[key], "left_semi")


def whole_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, set) of the documents in ``ids``, sets packed."""
    d = among(docs.select(F.col("doc_id").cast("long").alias("_doc"), utf8().alias("body")), ids, "_doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b["_doc"], pa.array([s.astype("<i8").tobytes() for s in shingle_sets(b["body"].to_pylist())], pa.binary())], names=["rep", "set"])

    return d.mapInArrow(run, "rep long, set binary").where("length(set) > 0").distinct()


def estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b, est) of the pairs whose union's sketch allows the similarity."""
    side = lambda x: reps.select(F.col("rep").alias(x), F.col("n").alias("n" + x), F.col("sketch").alias("s" + x))
    p = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep, est = [], []
            rows = zip(*(lists(t[c]) for c in ("sa", "sb")), t["na"].to_pylist(), t["nb"].to_pylist(), strict=True)
            for i, (x, y, n, m) in enumerate(rows):
                both = np.sort(np.concatenate((x, y)))
                twice = both[1:] == both[:-1]
                distinct = np.concatenate(([True], ~twice))
                whole = n <= SKETCH and m <= SKETCH
                size = int(distinct.sum()) if whole else min(SKETCH, int(distinct.sum()))
                last = both[distinct][size - 1]
                shared = int((both[1:][twice] <= last).sum())
                if shared * DEN >= NUM * size if whole else shared >= SHARED:
                    keep.append(i)
                    est.append(shared / size)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([t["a"].take(at), t["b"].take(at), pa.array(est, pa.float64())], names=["a", "b", "est"])

    return p.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long, est double")


def lists(column: pa.ListArray) -> list[np.ndarray]:
    at, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]


def linked(n_common: int, n: int, m: int) -> bool:
    return DEN * n_common >= NUM * (n + m - n_common)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    a, b = (sets.select(F.col("rep").alias(x), F.col("set").alias("s" + x)) for x in "ab")
    p = pairs.select("a", "b").join(a, "a").join(b, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in slices(batches):
            keep = []
            for i, (x, y) in enumerate(zip(t["sa"], t["sb"], strict=True)):
                x, y = unpacked(x.as_py()), unpacked(y.as_py())
                both = np.sort(np.concatenate((x, y)))
                if linked(int((both[1:] == both[:-1]).sum()), len(x), len(y)):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([t["a"].take(at), t["b"].take(at)], names=["a", "b"])

    return p.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long").distinct()


def compared(lists_: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) within lists of any length, by blocks of classes with whole sets: a spanning forest a task."""
    wanted = F.greatest(F.ceil(F.col("length") / BLOCK), F.ceil(F.col("volume") / BLOCK_SHINGLES)).cast("int")
    d = lists_.withColumn("_blocks", wanted).withColumn("_own", F.pmod(F.xxhash64("rep"), F.col("_blocks")).cast("int"))
    d = d.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    d = d.select("v", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "_own", "rep").join(sets, "rep")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        reps, own = t["rep"].to_numpy(), t["_own"].to_numpy()
        sets_ = [unpacked(x.as_py()) for x in t["set"]]
        i, j = t["_i"][0].as_py(), t["_j"][0].as_py()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        out = [] if not len(left) or not len(right) else forest(sets_, left, right, i == j)
        release()
        return pa.table([pa.array([int(min(reps[x], reps[y])) for x, y in out], pa.int64()), pa.array([int(max(reps[x], reps[y])) for x, y in out], pa.int64())], schema=schema)

    return d.groupBy("v", "_i", "_j").applyInArrow(run, "a long, b long").where("a <> b").distinct()


def forest(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Links between two blocks of sets that join everything their links join."""
    sizes = np.array([len(s) for s in sets])
    owner, flat = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    common = count > 1
    column = np.cumsum(common) - 1
    use = common[code]
    owner, code = owner[use], column[code[use]]
    n_common = np.zeros((len(left), len(right)), np.float32)
    place = np.full(len(sets), -1)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    width = 1024  # shared shingles at a time
    for c in range(0, int(common.sum()), width):
        a, b = np.searchsorted(code, (c, c + width))
        parts = []
        for side in (left, right):
            place[:] = -1
            place[side] = np.arange(len(side))
            at = place[owner[a:b]]
            m = np.zeros((len(side), width), np.float32)
            m[at[at >= 0], code[a:b][at >= 0] - c] = 1
            parts.append(m)
        n_common += parts[0] @ parts[1].T
    total = sizes[left][:, None] + sizes[right][None, :] - n_common
    ok = DEN * n_common.astype(np.int64) >= NUM * total.astype(np.int64)
    if same:
        ok = np.triu(ok, 1)
    parent = np.arange(len(sets))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(*np.nonzero(ok), strict=True):
        p, q = root(left[x]), root(right[y])
        if p != q:
            parent[q] = p
            out.append((left[x], right[y]))
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    with batches_of(df.sparkSession, BATCH):
        return materialize(df, name)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    spark = docs.sparkSession
    sk = written(sketches(docs), "sketches")
    classes = sk.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    classes = written(classes, "classes")
    several = written(_several(sk), "several")
    known = sk.where("set_key is not null and doc_id is not null").select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sketch", "set_key")
    reps = written(known.join(classes, ["set_key", "rep"], "left_semi").select("rep", "n", "sketch").dropDuplicates(["rep", "n", "sketch"]), "reps")

    values = lambda k: reps.select(F.explode(F.slice("sketch", 1, k)).alias("v"), "rep", "n")
    first = written(listed(values(INDEXED)), "lists")
    crowded = first.where(F.col("length") > LONG).select("rep").distinct()
    wanted = F.greatest(F.when(F.col("n") <= SKETCH, quarter()), F.least(F.col("n"), F.lit(SKETCH)) - SHARED + 1)
    second = written(rarest_first(among(values(SKETCH), crowded, "rep"), wanted), "lists")
    third = written(second.where(F.col("length") > LONG).select("rep").distinct(), "ids")

    pairs = written(estimated(paired(first).unionAll(paired(second)).distinct(), reps), "pairs")
    ids = pairs.select(F.col("a").alias("rep")).unionAll(pairs.select("b")).unionAll(third).distinct()
    sets = written(whole_sets(docs, ids), "sets")

    shingles = among(sets, third, "rep").mapInArrow(_exploded, "v long, rep long, n long")
    links = compared(rarest_first(shingles, quarter()), sets)
    nearest = pairs.groupBy("b").agg(F.max(F.struct("est", (-F.col("a")).alias("a"))).alias("m")).select((-F.col("m.a")).alias("a"), "b")
    # The sets of one document are one node: each of their classes is linked with the smallest.
    own = sk.join(several, "doc_id", "left_semi").join(classes, "set_key").select("doc_id", "rep").distinct()
    least = own.groupBy("doc_id").agg(F.min("rep").alias("a"))
    same = own.join(least, "doc_id").where("a < rep").select("a", F.col("rep").alias("b"))
    links = written(links.unionAll(confirmed(nearest, sets)).unionAll(same), "links")
    joined = components(links)

    side = lambda x: joined.select(F.col("node").alias(x), F.col("component").alias("c" + x))
    apart = pairs.select("a", "b").join(nearest, ["a", "b"], "left_anti").join(side("a"), "a", "left").join(side("b"), "b", "left")
    apart = written(apart.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"), "pairs")
    if apart.take(1):
        ends = apart.select(F.col("a").alias("rep")).unionAll(apart.select("b")).distinct()
        more = written(confirmed(apart, among(sets, ends, "rep")), "links")
        if more.take(1):
            joined = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more))
    for t in (first, second, third, pairs, sets, reps, links, apart):
        drop_written(spark, t)

    merged = classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("_c"))
    out = sk.join(merged, "set_key", "left").withColumn("_c", F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id")))
    # Rows without shingles get the component of their document's other rows.
    shared = out.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("_c").alias("_least"))
    mine = F.coalesce("_least", "_c")
    out = out.join(shared, "doc_id", "left").withColumn("component_id", mine)
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _several(sk: DataFrame) -> DataFrame:
    """The doc_ids whose rows have different sets."""
    key = F.coalesce("set_key", F.lit(b""))
    return sk.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.hex(key)).alias("x"), F.max(F.hex(key)).alias("y")).where("x <> y").select("doc_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, one document of each group: the one with the smallest doc_id.

    Rows that share a doc_id are one document, of which the first row by text stays; rows without one all stay.
    """
    decided = near_duplicates(docs)
    ids = materialize(decided.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias("rep")).agg(F.count("*").alias("rows")), "kept")
    single = among(docs, ids.where("rows = 1").select("rep"), "doc_id")
    out = single.unionByName(docs.where("doc_id is null"))
    if ids.where("rows > 1").take(1):
        again = among(docs, ids.where("rows > 1").select("rep"), "doc_id")
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        # Of rows with one text, whose other columns may differ, the smallest as JSON.
        first = again.groupBy(F.col("doc_id").alias("_id")).agg(F.min_by(row, F.struct("text", F.to_json(row))).alias("_row"))
        out = out.unionByName(first.select("_row.*"))
    return out


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for rep, s in zip(b["rep"].to_pylist(), b["set"], strict=True):
            x = unpacked(s.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(np.full(len(x), rep)), pa.array(np.full(len(x), len(x)))], names=["v", "rep", "n"])
