"""Removal of repeated text with suffix arrays built by two-stage sorting.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else is removed.
Suffix arrays find the repeats; what makes this distributed is how text is dealt to them:

1. The anchor of a window (a string of LENGTH bytes) is the smallest hash of its
   64-byte substrings.  Equal windows have equal anchors, and neighbouring windows
   mostly share one, so a document falls into runs of windows.  Only runs whose anchor
   occurs more than once can hold repeats.
2. A run's text is its segment.  Equal segments are pre-aggregated: two copies are
   enough to find that all of them repeat, so a large group of copies is no larger
   than a pair.  Segments are dealt to shards by anchor.  An anchor with more than
   ``CROWD`` different segments is dealt again by whole windows.
3. Each shard sorts its suffixes in two stages: those smaller than their successor are
   sorted directly, all others are induced from them by a scan over the buckets of
   first bytes; then neighbours' common prefixes are computed.  Windows with a common
   prefix of LENGTH with a neighbour repeat.
4. The marks of a segment go back to all its occurrences, and the documents are cut.

Anchors and segments are told apart by 64-bit hashes, windows by their bytes, rows by two 64-bit hashes of doc_id and text.

Defined results: null and empty texts have no bytes, and the digest of nothing; texts shorter
than LENGTH are kept whole; repeated rows are copies of each other, so they are
removed if long enough; null doc_ids are kept as they are; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeep.llm.common import U64, blocks, drop_written, materialize, mix64, powers, prefix_hash, release, slices, utf8

LENGTH = 200
KMER = 64
#: Different segments of one anchor that may go to one shard.
CROWD = 20_000
#: Bytes of text in a shard, about.
SHARD = 2 << 20
#: Ids that are broadcast at most: 16 bytes each.
BROADCAST_IDS = 1_000_000
ROW = ["rid", "rid2"]
_GAP = 0xFF  # in no UTF-8 text


# ---- runs of windows -------------------------------------------------------------------


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours."""
    n, w = len(x) - width + 1, 1
    if n <= 0:
        return x[:0]
    while 2 * w <= width:
        x = pick(x[:-w], x[w:])
        w *= 2
    return pick(x[:n], x[width - w : width - w + n])


def runs(texts: list[bytes], length: int = LENGTH, kmer: int = KMER):
    """(text, first window, windows, anchor, content hash, doubled) of every run, as arrays.

    doubled: the anchor's substring occurs at two places of these texts at least, so that windows of
    one run may be equal.
    """
    sizes = np.array([len(t) for t in texts])
    buf = np.frombuffer(b"".join(texts), np.uint8)
    if len(buf) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),) * 2 + (np.zeros(0, bool),)
    with np.errstate(over="ignore"):
        p, inv = prefix_hash(buf), powers(len(buf) + 1)[1]
        h = mix64((p[kmer:] - p[:-kmer]) * inv[: len(buf) - kmer + 1])
    least = sliding(h, length - kmer + 1, np.minimum)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
    inside = np.arange(len(least)) + length <= ends[doc]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (doc[1:] != doc[:-1]) | (least[1:] != least[:-1])
    start = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    stop = np.flatnonzero(last) + 1
    anchor = least[start]
    # Substrings that are the smallest of some window: as large as the largest of the minima around them.
    wide = length - kmer + 1
    around = sliding(np.concatenate((np.zeros(wide - 1, U64), least, np.zeros(wide - 1, U64))), wide, np.maximum)
    seen, count = np.unique(h[h == around], return_counts=True)
    doubled = np.isin(anchor, seen[count > 1])
    with np.errstate(over="ignore"):
        content = mix64((p[stop + length - 1] - p[start]) * inv[start] + (stop - start).astype(U64))
    return doc[start], start - (ends - sizes)[doc[start]], stop - start, anchor, content, doubled


def _runs(kmer: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids, others, bodies = b["rid"].to_numpy(), b["rid2"].to_numpy(), b["body"].to_pylist()
            done = 0
            for some in blocks(bodies):
                doc, first, n, anchor, content, doubled = runs(some, length, kmer)
                at = (first.astype(np.int64) << 32) | n.astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[done + doc]), pa.array(others[done + doc]), pa.array(at), pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(1 + doubled.astype(np.int64))], names=["rid", "rid2", "at", "anchor", "content", "places"])
                done += len(some)

    return run


# ---- the suffix array ------------------------------------------------------------------


def eight(t: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one big-endian number; ``t`` is padded at its end."""
    k = t.astype(U64)
    for w in (1, 2, 4):
        k = (k[:-w] << U64(8 * w)) | k[w:]
    return k


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Places of all suffixes of ``text`` in the order of their first ``depth`` bytes at least, by two-stage sorting.

    The byte 255 ends a string, and is the largest: suffixes that are equal up to one are next to each other in any
    order.  The end of the text is the end of a string.
    """
    if len(text) == 0:
        return np.zeros(0, np.int64)
    last = len(text)
    text = np.append(text, np.uint8(_GAP))
    n = len(text)
    # Types: a suffix is smaller than its successor if the first different byte after its run is larger.
    turn = np.flatnonzero(text[1:] != text[:-1])
    lengths = np.diff(np.concatenate(([-1], turn, [n - 1])))
    smaller = np.repeat(np.concatenate((text[turn] < text[turn + 1], [False])), lengths)
    direct = sort_directly(text, np.flatnonzero(smaller), depth)
    bounds = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        induced = list(waiting[c])
        level = np.concatenate(induced) if induced else np.zeros(0, np.int64)
        bucket = [level] if len(level) else []
        while len(level):  # runs of c: a longer run that ends in a smaller byte is larger
            level = level[level > 0] - 1
            level = level[text[level] == c]
            bucket.append(level)
        bucket.append(direct[bounds[c] : bounds[c + 1]])
        bucket = np.concatenate(bucket)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        byte = text[before]
        larger = byte > c
        before, byte = before[larger], byte[larger]
        if len(before):
            order = np.argsort(byte, kind="stable")
            before, byte = before[order], byte[order]
            cuts = np.flatnonzero(byte[1:] != byte[:-1]) + 1
            for part in np.split(before, cuts):
                waiting[text[part[0]]].append(part)
    order = np.concatenate(out)
    return order[order < last]


def sort_directly(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Sort the suffixes at ``places`` by their first ``depth`` bytes, eight at a time.

    Suffixes with one hash of those bytes, or of those before a byte of 255, are sorted as one.
    """
    if not len(places):
        return places
    gaps = np.append(np.flatnonzero(text == _GAP), len(text))
    own = np.minimum(gaps[np.searchsorted(gaps, places)] - places, depth)
    padded = np.concatenate((text, np.full(depth + 16, _GAP, np.uint8)))
    word = eight(padded)
    with np.errstate(over="ignore"):
        p, inv = prefix_hash(padded[: len(text) + depth]), powers(len(text) + depth + 1)[1]
        whole = (p[places + own] - p[places]) * inv[places] + own.astype(U64)
    by_hash = np.argsort(whole)
    first = np.concatenate(([True], np.diff(whole[by_hash]) != 0))
    same = np.empty(len(places), np.int64)
    same[by_hash] = np.cumsum(first) - 1
    some = places[by_hash[first]]
    order = np.argsort(word[some])
    key = word[some[order]]
    # Places of ``order`` that are still tied, and the group of each.
    left = np.arange(len(order))
    group = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
    pairs = [left[:0]]
    for at in range(8, depth, 8):
        size = np.bincount(group)
        # Two that are tied need no more than to be compared, see below.
        pairs.append(left[size[group] == 2][::2])
        tied = size[group] > 2
        left, group = left[tied], group[tied]
        if not len(left):
            break
        key = word[some[order[left]] + at]
        within = np.argsort(key)
        group = np.cumsum(np.concatenate(([0], group[1:] != group[:-1])))
        within = within[np.argsort(group[within].astype(np.min_scalar_type(group[-1])), kind="stable")]
        order[left] = order[left][within]
        key = key[within]
        group = np.cumsum(np.concatenate(([0], (group[1:] != group[:-1]) | (key[1:] != key[:-1]))))
    later, live = [pairs[0]], pairs[0]
    for i, at in enumerate(range(8, depth, 8), 1):
        live = np.concatenate((live, *pairs[i : i + 1]))
        a, b = word[some[order[live]] + at], word[some[order[live + 1]] + at]
        later.append(live[a > b])
        live = live[a == b]
    swap = np.concatenate(later)
    order[swap], order[swap + 1] = order[swap + 1], order[swap]
    rank = np.empty(len(some), np.int64)
    rank[order] = np.arange(len(some))
    return places[np.argsort(rank[same])]


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Bytes, ``most`` at the most, that each suffix shares with the one before it in ``order`` (the first: 0)."""
    padded = np.concatenate((text, np.arange(16, dtype=np.uint8), np.zeros(most, np.uint8)))
    word = eight(padded)
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for at in range(0, most, 8):
        a, b = word[order[live] + at], word[order[live - 1] + at]
        differ = a != b
        gone = live[differ]
        if len(gone):
            bits = a[differ] ^ b[differ]
            same = np.zeros(len(gone), np.int64)
            for k in range(1, 8):
                same += bits < (U64(1) << U64(64 - 8 * k))
            out[gone] = at + same
        live = live[~differ]
    out[live] = most
    return np.minimum(out, most)


def repeats(segments: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each segment a mask of its windows: those whose string starts at another place of the segments too."""
    gap = bytes([_GAP])
    text = np.frombuffer(gap.join([*segments, b""]), np.uint8)
    sizes = np.array([len(s) for s in segments])
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    order = suffix_array(text, length)
    window = np.zeros(len(text), bool)
    for a, n in zip(begins.tolist(), sizes.tolist(), strict=True):
        window[a : a + max(0, n - length + 1)] = True
    order = order[window[order]]
    full = common_prefixes(text, order, length) >= length
    full[:-1] |= full[1:]
    mark = np.zeros(len(text), bool)
    mark[order[full]] = True
    return [mark[a : a + max(0, n - length + 1)] for a, n in zip(begins.tolist(), sizes.tolist(), strict=True)]


# ---- the distributed operator ------------------------------------------------------------


def spans_of(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return list(zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True))


def _with_ids(docs: DataFrame) -> DataFrame:
    """doc_id, rid, rid2, body; the two stand for the row: rows that share them are equal."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("body"))
    return d.withColumn("rid", F.xxhash64("doc_id", "body")).withColumn("rid2", F.xxhash64(F.lit(1), "body", "doc_id"))


def _few(ids: DataFrame, n: int) -> DataFrame:
    return F.broadcast(ids) if n <= BROADCAST_IDS else ids


def found(d: DataFrame, length: int = LENGTH, kmer: int = KMER, crowd: int = CROWD, shard: int = SHARD) -> DataFrame:
    """(rid, rid2, spans): the repeated byte spans of each row that has any, one entry a run, not merged."""
    spark = d.sparkSession
    schema = "rid long, rid2 long, at long, anchor long, content long, places long"
    every = d.select(*ROW, "body").where(F.length("body") >= length).mapInArrow(_runs(kmer, length), schema)
    counts = every.groupBy("anchor").agg(F.sum("places").alias("_n")).where("_n > 1").select("anchor")
    occurring = materialize(every.join(counts, "anchor").select(*ROW, "at", "anchor", "content"), "runs")

    crowded = materialize(occurring.select("anchor", "content").distinct().groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("anchor"), "crowded")
    written = [occurring, crowded]
    if crowded.take(1):
        whole = occurring.join(crowded, "anchor", "left_semi").groupBy(*ROW).agg(F.collect_list("at").alias("ats"))
        single = d.select(*ROW, "body").dropDuplicates(ROW).join(whole, ROW).mapInArrow(_windows(length), schema)
        copies = d.groupBy(*ROW).agg(F.count("*").alias("_rows"))
        # Equal rows: two of them stand for all.
        single = single.join(copies.where("_rows > 1"), ROW, "left").withColumn("_k", F.explode(F.sequence(F.lit(1), F.least(F.coalesce("_rows", F.lit(1)), F.lit(2)))))
        counts = single.groupBy("anchor").agg(F.sum("places").alias("_n")).where("_n > 1").select("anchor")
        single = single.join(counts, "anchor").select(*ROW, "at", "anchor", "content")
        occurring = materialize(occurring.join(crowded, "anchor", "left_anti").unionByName(single), "runs")
        written.append(occurring)

    # Two occurrences stand for all equal segments; of rows that are equal themselves one text is read twice.
    place = F.struct(*ROW, "at")
    segments = occurring.groupBy("anchor", "content").agg(F.min(place).alias("x"), F.max(place).alias("y"), F.count("*").alias("n"))
    segments = segments.select("anchor", "content", F.when(F.col("n") == 1, F.array("x")).otherwise(F.array("x", "y")).alias("two"))
    segments = materialize(segments.select("anchor", "content", F.explode("two").alias("p")).select("anchor", "content", "p.rid", "p.rid2", "p.at"), "segments")
    written.append(segments)
    total = segments.agg(F.sum(F.col("at").bitwiseAND(0xFFFFFFFF) + length)).first()[0] or 0
    shards = total // shard + 1
    asked = segments.groupBy(*ROW).agg(F.collect_list(F.struct("at", "anchor", "content")).alias("asked"))
    ids = segments.select(*ROW).distinct()
    texts = d.select(*ROW, "body").join(_few(ids, ids.count()), ROW, "left_semi").dropDuplicates(ROW)
    cut = texts.join(asked, ROW).select("body", "asked").mapInArrow(_cut(length), "anchor long, content long, segment binary")
    marked = cut.withColumn("_shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("_shard").applyInArrow(_search(length), "anchor long, content long, spans array<struct<a:int,b:int>>")
    marked = materialize(marked, "marks")
    written.append(marked)
    base = F.shiftright("at", 32)
    spans = occurring.join(marked, ["anchor", "content"]).select(*ROW, F.transform("spans", lambda s: F.struct((s.a + base).alias("a"), (s.b + base + length - 1).alias("b"))).alias("spans"))
    # Equal rows have the same spans, so their number doesn't matter.
    out = materialize(spans.groupBy(*ROW).agg(F.flatten(F.collect_set("spans")).alias("spans")), "spans")
    for t in written:
        drop_written(spark, t)
    return out


def _windows(length: int):
    """Every window of the given runs as a run of its own, its hash as anchor and content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rid, rid2, body, ats in zip(b["rid"].to_pylist(), b["rid2"].to_pylist(), b["body"].to_pylist(), b["ats"].to_pylist(), strict=True):
                buf = np.frombuffer(body, np.uint8)
                with np.errstate(over="ignore"):
                    p, inv = prefix_hash(buf), powers(len(buf) + 1)[1]
                    first = np.unique(np.concatenate([np.arange(x >> 32, (x >> 32) + (x & 0xFFFFFFFF)) for x in ats]))
                    h = mix64((p[first + length] - p[first]) * inv[first] + U64(1)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), rid)), pa.array(np.full(len(h), rid2)), pa.array((first << 32) | 1), pa.array(h), pa.array(h), pa.array(np.ones(len(h), np.int64))], names=["rid", "rid2", "at", "anchor", "content", "places"])

    return run


def _cut(length: int):
    schema = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("segment", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for body, asked in zip(b["body"].to_pylist(), b["asked"].to_pylist(), strict=True):
                parts = [body[x["at"] >> 32 : (x["at"] >> 32) + (x["at"] & 0xFFFFFFFF) + length - 1] for x in asked]
                yield pa.RecordBatch.from_arrays([pa.array([x["anchor"] for x in asked], pa.int64()), pa.array([x["content"] for x in asked], pa.int64()), pa.array(parts, pa.binary())], schema=schema)

    return run


def _search(length: int):
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    schema = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("spans", kind)])

    def run(t: pa.Table) -> pa.Table:
        masks = repeats(t["segment"].to_pylist(), length)
        release()
        rows = {}
        for anchor, content, m in zip(t["anchor"].to_pylist(), t["content"].to_pylist(), masks, strict=True):
            if m.any():
                rows[anchor, content] = [{"a": a, "b": b} for a, b in spans_of(m)]
        return pa.table([pa.array([k[0] for k in rows], pa.int64()), pa.array([k[1] for k in rows], pa.int64()), pa.array(list(rows.values()), kind)], schema=schema)

    return run


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_repeats(docs: DataFrame, keep_bytes: bool = False, **settings) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and its remaining bytes if asked for."""
    d = _with_ids(docs)
    spans = found(d, **settings)
    ids = spans.select(*ROW)
    n = ids.count()
    hit = d.join(_few(ids, n), ROW, "left_semi").join(spans, ROW).select("doc_id", "body", "spans")
    rest = d.join(_few(ids, n), ROW, "left_anti").select("doc_id", "body", F.lit(None).cast("array<struct<a:bigint,b:bigint>>").alias("spans"))
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())] + [("kept", pa.binary())] * keep_bytes
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for body, s in zip(b["body"].to_pylist(), b["spans"].to_pylist(), strict=True):
                s = merged(s)
                cuts = [0, *(x for ab in s for x in ab), len(body)]
                kept = b"".join(body[p:q] for p, q in zip(cuts[0::2], cuts[1::2], strict=True))
                rows.append((len(body), len(body) - len(kept), len(s), hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([b["doc_id"], *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:], strict=False))], schema=schema)

    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    return hit.unionAll(rest.select("doc_id", "body", F.col("spans").cast(hit.schema["spans"].dataType))).mapInArrow(run, out)
