"""Benchmark decontamination with suffix arrays over the training text.

Each block of documents is a shard.  Its words are turned into ids of the benchmark's
vocabulary (0: not in it, and the end of a document), and all its suffixes are sorted into a suffix array,
by doubling the length they are sorted by.  Every test suffix is then binary-searched in it, word by
word: the interval that is left at a window's length gives all places where the window occurs; where the
interval gets empty the longest verbatim match ends, and the last interval that wasn't gives its places.

The work is narrow passes over the documents.  The benchmark is sent to the executors in blocks of at
most ``BLOCK_LIMIT`` bytes, one after the other: the driver holds one at a time, what a block hits is written, and
the hits of all are merged by document.

Defined results: null texts have no words; null item ids are named by the empty
string; repeated rows each get their own result; items of fewer words than a window
are one window; an item without words matches nothing; items of equal ids count once; other columns are ignored.
Equal words are recognised by 64-bit hashes, equal rows by doc_id and MD5 of the text where there are several blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeep.llm.common import Words, blocks, distinct, materialize, slices, utf8

WINDOW = 13
#: Bytes of benchmark text in a block; the broadcast holds no more.
BLOCK_LIMIT = 4 << 20
#: Bytes of documents in a shard, about.
SHARD = 1 << 19
#: Places of test suffixes that are worked on at once.
PLACES = 1 << 18
#: Item words and their separators after lower-casing A-Z: digits, a-z and everything above ASCII are words.
GAP = np.ones(256, bool)
GAP[0x30:0x3A] = GAP[0x61:0x7B] = GAP[0x80:] = False


class Vocabulary:
    """The ids, from 1, of 64-bit hashes: a bit table first, then binary search."""

    def __init__(self, hashes: np.ndarray):
        self.keys = distinct(hashes)
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.keys >> np.uint64(40)) & np.uint64(0xFFFFF)] = True

    def ids(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        at = np.flatnonzero(self.table[(x >> np.uint64(40)) & np.uint64(0xFFFFF)])
        if len(at) and len(self.keys):
            rank = np.minimum(np.searchsorted(self.keys, x[at]), len(self.keys) - 1)
            same = self.keys[rank] == x[at]
            out[at[same]] = rank[same] + 1
        return out


class TestSuffixes:
    """The benchmark side: vocabulary, and the words of all items with a zero after each."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window, self.names = window, [n for n, _ in items]
        w = Words([t.lower() for _, t in items], GAP)
        self.vocabulary = Vocabulary(w.hash)
        sizes = np.diff(w.first)
        item = np.repeat(np.arange(len(items)), sizes)
        self.longest = int(sizes.max()) if len(sizes) else 0
        self.ids = np.zeros(len(w.hash) + len(items) + self.longest + 1, np.int64)
        self.places = np.arange(len(w.hash)) + item
        self.ids[self.places] = self.vocabulary.ids(w.hash)
        #: For every test suffix: its item, its first word, words to the item's end, words of the window that it begins with (0: none).
        self.item, self.word = item, np.arange(len(w.hash)) - w.first[item]
        self.left = sizes[item] - self.word
        self.size = np.where(self.left >= np.minimum(window, sizes[item]), np.minimum(window, sizes[item]), 0)


def suffix_order(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes in the order of their first ``depth`` words; what follows a zero is in any order."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    stops = np.append(np.flatnonzero(ids == 0), n)
    open_for = stops[np.searchsorted(stops, np.arange(n))] - np.arange(n)
    group = np.cumsum(np.concatenate(([0], np.diff(ids[order]) != 0)))[:n]
    rank = np.empty(n + 1, np.int64)
    k = 1
    while k < depth:
        rank[order], rank[n] = group + 1, 0
        equal = group[1:] == group[:-1]
        tied = np.concatenate((equal, [False])) | np.concatenate(([False], equal))
        left = np.flatnonzero(tied & (open_for[order] >= k))
        if not len(left):
            break
        next_ = rank[np.minimum(order[left] + k, n)]
        within = np.lexsort((next_, group[left]))
        order[left] = order[left][within]
        key, g = next_[within], group[left]
        new = np.zeros(n, bool)
        new[left[1:]] = (g[1:] == g[:-1]) & (key[1:] != key[:-1])
        group = np.cumsum(np.concatenate(([False], group[1:] != group[:-1])) | new)
        k *= 2
    return order


class Shard:
    """The suffix array over some documents."""

    def __init__(self, texts: list[bytes], tests: TestSuffixes):
        self.tests = tests
        w = Words([t.lower() for t in texts], GAP)
        self.n_words = np.diff(w.first)
        doc = np.repeat(np.arange(len(texts)), self.n_words)
        self.base = w.first[:-1] + np.arange(len(texts))
        n = len(w.hash) + len(texts)
        self.ids = np.zeros(n + tests.longest + 1, np.int64)
        self.ids[np.arange(len(w.hash)) + doc] = tests.vocabulary.ids(w.hash)
        self.order = suffix_order(self.ids[:n], max(1, tests.longest))

    def bound(self, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray, after: bool) -> np.ndarray:
        """In the intervals [lo, hi) of the array, the first suffix whose word ``depth`` is not before (after: is after) ``word``."""
        lo, hi = lo.copy(), hi.copy()
        while (live := np.flatnonzero(lo < hi)).size:
            mid = (lo[live] + hi[live]) >> 1
            seen = self.ids[self.order[mid] + depth]
            up = seen <= word[live] if after else seen < word[live]
            lo[live[up]] = mid[up] + 1
            hi[live[~up]] = mid[~up]
        return lo

    def search(self, whole: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each depth (test suffixes, lo, hi): the suffixes of the shard that begin with so many of their words.

        Test suffixes leave when no suffix is left, and, unless ``whole``, when their window is found.
        """
        tests = self.tests
        live = np.arange(len(tests.places)) if whole else np.flatnonzero(tests.size)
        lo, hi = np.zeros(len(live), np.int64), np.full(len(live), len(self.order))
        depth = 0
        while len(live):
            word = tests.ids[tests.places[live] + depth]
            lo, hi = self.bound(lo, hi, depth, word, False), self.bound(lo, hi, depth, word, True)
            found = lo < hi
            live, lo, hi = live[found], lo[found], hi[found]
            depth += 1
            yield depth, live, lo, hi
            more = (tests.left if whole else tests.size)[live] > depth
            live, lo, hi = live[more], lo[more], hi[more]

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document and word of places in the text."""
        doc = np.searchsorted(self.base, at, "right") - 1
        return doc, at - self.base[doc]


class Hit:
    """What a document holds of the benchmark: spans of words, items, and (words, item, word) of its longest verbatim match."""

    def __init__(self, n_words: int):
        self.n_words, self.spans, self.names, self.match = n_words, [], set(), (0, None, None)

    def add(self, spans: list[tuple[int, int]], names, match: tuple) -> None:
        self.spans += spans
        self.names |= set(names)
        if match[0] > self.match[0] or match[0] == self.match[0] > 0 and match[1:] < self.match[1:]:
            self.match = match

    def verdict(self, share: int) -> tuple:
        n_hit, upto = 0, 0
        for a, b in sorted(self.spans):
            n_hit += max(0, b - max(a, upto))
            upto = max(upto, b)
        names = sorted(self.names)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        return self.n_words, n_hit, len(names), digest, n_hit > 0 and share * n_hit >= self.n_words, *self.match


def hits(texts: list[bytes], tests: TestSuffixes) -> Iterator[Hit]:
    """What each document holds, in order."""
    for some in blocks(texts, limit=SHARD):
        shard = Shard(some, tests)
        out = [Hit(n) for n in shard.n_words.tolist()]
        for depth, live, lo, hi in shard.search():
            full = tests.size[live] == depth
            if full.any():
                collect(shard, live[full], lo[full], hi[full], depth, out)
        yield from out


def collect(shard: Shard, suffixes: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: int, out: list[Hit]) -> None:
    """Add the places of found windows, ``PLACES`` at a time, to the documents that hold them."""
    tests, width = shard.tests, hi - lo
    upto = np.cumsum(width)
    for a in range(0, int(upto[-1]), PLACES):
        pick = np.arange(a, min(a + PLACES, int(upto[-1])))
        which = np.searchsorted(upto, pick, "right")
        at, suffix = shard.order[lo[which] + pick - (upto - width)[which]], suffixes[which]
        # Beyond the window, as far as both go on alike.
        words, live, depth = np.full(len(at), size), np.arange(len(at)), size
        while len(live):
            other = tests.ids[tests.places[suffix[live]] + depth]
            live = live[(other > 0) & (shard.ids[at[live] + depth] == other)]
            words[live] += 1
            depth += 1
        doc, word = shard.place(at)
        order = np.lexsort((word, tests.item[suffix], -words, doc))
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(doc[order]) != 0)))
        for part in np.split(order, cuts[1:]):
            best = part[0]
            longest = part[words[part] == words[best]]
            name, place = min((tests.names[tests.item[suffix[i]]], int(word[i])) for i in longest.tolist())
            spans = [(x, x + size) for x in np.unique(word[part]).tolist()]
            out[doc[best]].add(spans, (tests.names[i] for i in np.unique(tests.item[suffix[part]]).tolist()), (int(words[best]), name, place))


# ---- the distributed operators ---------------------------------------------------------------------


def benchmark_blocks(benchmark: DataFrame, limit: int | None = None) -> Iterator[list[tuple[str, bytes]]]:
    """The items in lists of about ``limit`` bytes; the driver holds one at a time."""
    limit = limit or BLOCK_LIMIT
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), utf8().alias("body"))
    total = items.agg(F.sum(F.length("body") + F.length("name") + 64)).first()[0] or 0
    n = 2 * (total // limit) + 1 if total > limit else 1
    for b in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("name", "body"), F.lit(n)) == b)
        yield [(r.name, bytes(r.body)) for r in part.collect()]


VERDICT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long, match_item string, match_word long"
_ARROW = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("longest_match", pa.int64()), ("match_item", pa.string()), ("match_word", pa.int64())]


def columns(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> list[pa.Array]:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return [pa.array(c, f) for c, (_, f) in zip(cols, fields, strict=True)]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, limit: int | None = None) -> DataFrame:
    """doc_id and, for each row: words, hit words, items that occur, their digest, whether it is contaminated, and
    words, item and first word of its longest verbatim match (0 and null without one of a window's length).

    A word is hit if it is part of an occurrence of a window; a document is contaminated if
    at least 1 / ``share`` of its words, and at least one, are hit.  Of matches of one length the smallest item and place are given.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("body"))
    return judged(d, benchmark, window, share, limit).drop("body")


def judged(d: DataFrame, benchmark: DataFrame, window: int, share: int, limit: int | None) -> DataFrame:
    """The rows of (doc_id, body) with their verdict."""
    spark, found, schema = d.sparkSession, [], pa.schema([("doc_id", pa.int64()), ("body", pa.binary()), *_ARROW])
    parts = benchmark_blocks(benchmark, limit)
    one, second = next(parts), next(parts, None)
    if second is None:
        items = spark.sparkContext.broadcast(one)

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = TestSuffixes(items.value, window)
            for b in slices(batches):
                rows = [h.verdict(share) for h in hits(b["body"].to_pylist(), tests)]
                yield pa.RecordBatch.from_arrays([b["doc_id"], b["body"], *columns(rows, _ARROW)], schema=schema)

        return d.mapInArrow(judge, f"doc_id long, body binary, {VERDICT}")
    keyed = d.withColumn("_key", F.md5("body"))
    while one is not None:
        items = spark.sparkContext.broadcast(one)
        found.append(materialize(keyed.mapInArrow(_found(items, window), _FOUND), "hits"))
        items.unpersist()
        one, second = second, next(parts, None)
    every = found[0]
    for f in found[1:]:
        every = every.unionAll(f)
    every = every.distinct().groupBy("_id", "_k").agg(F.collect_list(F.struct("spans", "names", "words", "item", "word")).alias("_found"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for body, parts in zip(b["body"].to_pylist(), b["_found"].to_pylist(), strict=True):
                h = Hit(len(Words([body.lower()], GAP).hash))
                for x in parts or []:
                    h.add([(s["a"], s["b"]) for s in x["spans"]], x["names"], (x["words"], x["item"], x["word"]))
                rows.append(h.verdict(share))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["body"], *columns(rows, _ARROW)], schema=schema)

    joined = keyed.join(every, keyed["doc_id"].eqNullSafe(every["_id"]) & (keyed["_key"] == every["_k"]), "left")
    return joined.select("doc_id", "body", "_found").mapInArrow(merge, f"doc_id long, body binary, {VERDICT}")


_FOUND = "_id long, _k string, spans array<struct<a:long,b:long>>, names array<string>, words long, item string, word long"


def _found(items, window: int):
    """What one block of the benchmark hits: a row for each document that holds any of it."""
    fields = [("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("names", pa.list_(pa.string())), ("words", pa.int64()), ("item", pa.string()), ("word", pa.int64())]
    schema = pa.schema([("_id", pa.int64()), ("_k", pa.string()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestSuffixes(items.value, window)
        for b in slices(batches):
            found = [(i, h) for i, h in enumerate(hits(b["body"].to_pylist(), tests)) if h.spans]
            at = pa.array([i for i, _ in found], pa.int64())
            rows = [([{"a": p, "b": q} for p, q in sorted(set(h.spans))], sorted(h.names), *h.match) for _, h in found]
            yield pa.RecordBatch.from_arrays([b["doc_id"].take(at), b["_key"].take(at), *columns(rows, fields)], schema=schema)

    return run


def uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, limit: int | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, that aren't contaminated: each row is judged by its own text."""
    parts = benchmark_blocks(benchmark, limit)
    one = next(parts)
    if next(parts, None) is None:
        items = docs.sparkSession.sparkContext.broadcast(one)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = TestSuffixes(items.value, window)
            for b in slices(batches):
                texts = [(t or "").encode() for t in b["text"].to_pylist()]
                yield b.filter(pa.array([not h.verdict(share)[4] for h in hits(texts, tests)], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("body"))
    bad = judged(d, benchmark, window, share, limit).where("contaminated").select(F.col("doc_id").alias("_bad"), F.md5("body").alias("_bad_key")).distinct()
    key = F.md5(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary"))
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_bad"]) & (key == bad["_bad_key"]), "left_anti")


def longest_matches(docs: DataFrame, benchmark: DataFrame, least: int = 5) -> DataFrame:
    """For every test suffix with a verbatim match of ``least`` words or more: the longest, and the first place of it.

    Columns item_id, item_word, n_words, doc_id, doc_word.  Matches are as long as they are.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("body"))
    schema = pa.schema([("item_id", pa.string()), ("item_word", pa.int64()), ("n_words", pa.int64()), ("doc_id", pa.int64()), ("doc_word", pa.int64())])
    out = None
    for part in benchmark_blocks(benchmark):
        items = spark.sparkContext.broadcast(part)

        def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            tests = TestSuffixes(items.value)
            for b in slices(batches):
                ids, done = np.array([-(2**63) if x is None else x for x in b["doc_id"].to_pylist()], np.int64), 0
                for some in blocks(b["body"].to_pylist(), limit=SHARD):
                    shard, best = Shard(some, tests), {}
                    for depth, live, lo, hi in shard.search(whole=True):
                        if depth >= least:
                            best.update(zip(live.tolist(), zip([depth] * len(live), lo.tolist(), hi.tolist())))
                    rows = []
                    for q, (n, a, e) in best.items():
                        doc, word = shard.place(shard.order[a:e])
                        i = np.lexsort((word, ids[done + doc]))[0]
                        own = b["doc_id"][done + int(doc[i])].as_py()
                        rows.append((tests.names[tests.item[q]], int(tests.word[q]), n, own, int(word[i])))
                    done += len(some)
                    yield pa.RecordBatch.from_arrays(columns(rows, [(f.name, f.type) for f in schema]), schema=schema)

        one = materialize(d.mapInArrow(search, "item_id string, item_word long, n_words long, doc_id long, doc_word long"), "matches")
        items.unpersist()
        out = one if out is None else out.unionAll(one)
    best = F.min(F.struct((-F.col("n_words")).alias("n"), "doc_id", "doc_word"))
    return out.groupBy("item_id", "item_word").agg(best.alias("b")).select("item_id", "item_word", (-F.col("b.n")).alias("n_words"), "b.doc_id", "b.doc_word")
