"""Exact nearest vectors of many queries, block by block.

Vectors and queries are dealt into blocks by a hash, and each pair of blocks is scored by one task: what a task holds doesn't grow
with the tables.  Products of matrices tell which pairs can be among a query's best; those alone are scored as
``functions.vectors.cosine`` does, term by term, so that scores and their order are the same to the last bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Numbers in a block of vectors, queries in one of queries, and pairs that are scored at a time.
BLOCK_NUMBERS, BLOCK_QUERIES, TILE = 1 << 21, 4096, 1 << 21
#: Norms between which products neither overflow nor lose digits.
LEAST, MOST = 1e-100, 1e100


def matrices(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors for each length; lists that are empty or null, or hold a null, have no cosine and are left out."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    start = np.cumsum(length) - length
    if flat.null_count:
        holes = np.flatnonzero(flat.is_null().to_numpy(zero_copy_only=False))
        length[np.repeat(np.arange(len(length)), length)[holes]] = 0
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    out = {}
    for d in np.unique(length[length > 0]).tolist():
        rows = np.flatnonzero(length == d)
        out[d] = rows, x[start[rows][:, None] + np.arange(d)]
    return out


def norms(x: np.ndarray) -> np.ndarray:
    s = np.zeros(len(x))
    with np.errstate(all="ignore"):
        for j in range(x.shape[1]):
            s += x[:, j] * x[:, j]
    return np.sqrt(s)


def cosines(x: np.ndarray, nx: np.ndarray, i: np.ndarray, y: np.ndarray, ny: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cosine of each x[i], y[j], summed in order, and whether there is one."""
    s = np.zeros(len(i))
    with np.errstate(all="ignore"):
        for c in range(x.shape[1]):
            s += x[i, c] * y[j, c]
        length = nx[i] * ny[j]
        some = ~(length <= 0)
        return np.divide(s, length, out=np.zeros(len(s)), where=some), some


def first_copies(x: np.ndarray, of: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` rows of each vector in each list: copies tie, so that no more of them can be among the best."""
    if not len(x):
        return np.zeros(0, np.int64)
    keys = np.ascontiguousarray(np.column_stack([x + 0.0, of.astype(np.float64)]))
    _, same = np.unique(keys.view(np.dtype((np.void, keys.strides[0]))).ravel(), return_inverse=True)
    order = np.argsort(same, kind="stable")
    rank, run = np.arange(len(order)), same[order]
    rank = rank - np.maximum.accumulate(np.where(np.concatenate(([True], run[1:] != run[:-1])), rank, 0))
    return np.sort(order[rank < k])


def leading(q: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order by query and ``keys``, and each place's rank within its query."""
    order = np.lexsort([*keys[::-1], q])
    at, run = np.arange(len(order)), q[order]
    begins = np.concatenate(([True], run[1:] != run[:-1])) if len(run) else np.zeros(0, bool)
    return order, at - np.maximum.accumulate(np.where(begins, at, 0)) if len(at) else at


def nearest(x: np.ndarray, of: np.ndarray, y: np.ndarray, probed: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of y, row of x, cosine) of the ``k`` best rows of ``x`` for each of ``y``, NaN first, ties by the row of ``x``.

    ``of`` is each vector's list, ``probed`` which lists a query looks at (all, if it is None).
    """
    nx, ny = norms(x), norms(y)
    kept = first_copies(x, of, k)
    kept = kept[np.argsort(of[kept], kind="stable")]
    # A vector of zeros has a cosine, NaN, only with one whose norm isn't finite.
    zero_x, zero_y = nx == 0, ny == 0
    kept = kept if not np.isfinite(ny).all() else kept[~zero_x[kept]]
    asked = np.arange(len(y)) if not np.isfinite(nx).all() else np.flatnonzero(~zero_y)
    margin = 4 * (x.shape[1] + 16) * np.finfo(float).eps
    fine_x, fine_y = (nx > LEAST) & (nx < MOST), (ny > LEAST) & (ny < MOST)
    ux = np.where(fine_x[:, None], x, 0) / np.where(fine_x, nx, 1)[:, None]
    uy = np.where(fine_y[:, None], y, 0) / np.where(fine_y, ny, 1)[:, None]
    high = max(1, min(len(asked), 1024))
    wide = max(1, TILE // high)
    begins = np.flatnonzero(np.concatenate(([True], of[kept][1:] != of[kept][:-1]))) if len(kept) else np.zeros(0, np.int64)
    runs = [(a, min(a + wide, e)) for b, e in zip(begins, [*begins[1:], len(kept)], strict=True) for a in range(b, e, wide)]
    out = []
    for t in range(0, len(asked), high):
        tile = asked[t : t + high]
        bound, met, n = np.full(len(tile), -np.inf), [], 0
        for a, b in runs:
            cols = kept[a:b]
            sel = np.arange(len(tile)) if probed is None else np.flatnonzero(probed[tile, of[cols[0]]])
            if not len(sel):
                continue
            near = uy[tile[sel]] @ ux[cols].T
            if not (fine_y[tile[sel]].all() and fine_x[cols].all()):
                odd = ~(fine_y[tile[sel]][:, None] & fine_x[cols])
                near[odd] = -np.inf
                none = (zero_y[tile[sel]][:, None] & np.isfinite(nx[cols])) | (np.isfinite(ny[tile[sel]])[:, None] & zero_x[cols])
                i, j = np.nonzero(odd & ~none)
                s, some = cosines(y, ny, tile[sel[i]], x, nx, cols[j])
                near[i, j] = np.where(some, np.where(np.isnan(s), np.inf, s), -np.inf)
            if b - a > 2 * k:
                bound[sel] = np.maximum(bound[sel], np.partition(near, b - a - k, axis=1)[:, b - a - k]) if np.isneginf(bound[sel]).any() else bound[sel]
            i, j = np.nonzero(near >= np.maximum(bound[sel] - margin, np.finfo(float).min)[:, None])
            met.append((sel[i], cols[j], near[i, j]))
            n += len(i)
            if n > max(1 << 18, 4 * k * len(tile)):
                met = [_best(met, bound, k, margin)]
                n = len(met[0][0])
        if not met:
            continue
        i, j, _ = _best(met, bound, k, margin)
        s, some = cosines(y, ny, tile[i], x, nx, j)
        i, j, s = i[some], j[some], s[some]
        order, rank = leading(i, [~np.isnan(s), -np.nan_to_num(s), j])
        order = order[rank < k]
        out.append((tile[i[order]], j[order], s[order]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _best(met: list, bound: np.ndarray, k: int, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that can still be among a query's ``k`` best; ``bound`` is raised to its k-th best so far."""
    i, j, near = (np.concatenate(c) for c in zip(*met, strict=True))
    order, rank = leading(i, [-near, j])
    last = order[rank == k - 1]
    bound[i[last]] = np.maximum(bound[i[last]], near[last])
    # Pairs without a number (+inf here) tie, whatever their vectors.
    keep = order[(near[order] >= bound[i[order]] - margin) & ((rank < k) | ~np.isposinf(near[order]))]
    return i[keep], j[keep], near[keep]


def _scored(vectors: pa.Table, queries: pa.Table, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    x, y = matrices(vectors["embedding"]), matrices(queries["_q"])
    of = vectors["list"].to_numpy().astype(np.int64) if "list" in vectors.column_names else np.zeros(len(vectors), np.int64)
    probed = np.array([np.unpackbits(np.frombuffer(b, np.uint8)) for b in queries["_lists"].to_pylist()], bool) if "_lists" in queries.column_names else None
    for d in x.keys() & y.keys():
        (r, a), (w, b) = x[d], y[d]
        i, j, s = nearest(a, of[r], b, probed[w] if probed is not None else None, k)
        yield w[i], r[j], s


def nearest_each(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, chunk_id, score): for each of (query_id, _q) the ``k`` best of (chunk_id, embedding), ties by chunk_id.

    With a column ``list`` of vectors and ``_lists`` of queries, a bit for each list, a query looks at vectors of its lists only.
    """
    asked = queries.agg(F.count("*").alias("n"), F.max(F.size("_q")).alias("d")).first()
    longest = max(1, asked.d or 1)
    deep = max(1, -(-vectors.select("chunk_id").count() * longest // BLOCK_NUMBERS))
    across = max(1, -(-asked.n // BLOCK_QUERIES))
    v = vectors.where(F.size("embedding").between(1, longest))
    v = v.withColumn("_v", F.pmod(F.xxhash64("chunk_id", "embedding"), F.lit(deep)).cast("int")).withColumn("_w", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    q = queries.withColumn("_w", F.pmod(F.xxhash64("query_id", "_q"), F.lit(across)).cast("int")).withColumn("_v", F.explode(F.sequence(F.lit(0), F.lit(deep - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.take(pc.sort_indices(left["chunk_id"]))  # nulls come last
        parts = [pa.table({"query_id": right["query_id"].take(pa.array(i)), "chunk_id": left["chunk_id"].take(pa.array(j)), "score": pa.array(s, from_pandas=False)}) for i, j, s in _scored(left, right, k)]
        none = pa.table({"query_id": right["query_id"].slice(0, 0), "chunk_id": left["chunk_id"].slice(0, 0), "score": pa.array([], pa.float64())})
        return pa.concat_tables([none, *parts])

    kinds = queries.schema["query_id"].dataType.simpleString(), vectors.schema["chunk_id"].dataType.simpleString()
    scored = v.groupBy("_v", "_w").cogroup(q.groupBy("_v", "_w")).applyInArrow(run, f"query_id {kinds[0]}, chunk_id {kinds[1]}, score double")
    # The limit by rank also holds before the shuffle.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("chunk_id")))
    return scored.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


# ---- lists of an index -------------------------------------------------------------------------------


def with_probes(queries: DataFrame, centres: list[tuple[int, list[float]]], probes: int) -> DataFrame:
    """(query_id, _q, _lists): a bit for each list, set for the ``probes`` whose centres are nearest to a query, NaN first, ties by list."""
    number = np.array([i for i, _ in centres], np.int64)
    centre = pa.chunked_array([pa.array([c for _, c in centres], pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = matrices(centre)
        for whole in batches:
            for at in range(0, len(whole), 512):
                b = whole.slice(at, 512)
                bits = np.zeros((len(b), (int(number.max()) + 1 if len(number) else 1)), bool)
                for d, (w, y) in matrices(pa.chunked_array([b.column("_q")])).items():
                    if d in x:
                        i, j, _ = nearest(x[d][1], number[x[d][0]], y, None, probes)
                        bits[w[i], number[x[d][0][j]]] = True
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in np.packbits(bits, axis=1)], pa.binary())], [*b.schema.names, "_lists"])

    return queries.mapInArrow(run, queries.select("*", F.lit(b"").alias("_lists")).schema)


def probed_lists(lists: str) -> Column:
    """The numbers of the bits that are set."""
    byte = lambda i: F.conv(F.hex(F.substring(F.col(lists), i + 1, F.lit(1))), 16, 10).cast("int")
    each = F.transform(F.sequence(F.lit(0), F.octet_length(lists) - 1), lambda i: F.filter(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda j: F.when(F.getbit(byte(i), F.lit(7) - j) == 1, i * 8 + j)), lambda n: n.isNotNull()))
    return F.flatten(each)
