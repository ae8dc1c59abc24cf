"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its words, of word pairs and of
character n-grams, all hashed into one table; a softmax over the average gives the
label.  Table and output layer are trained together by stochastic gradient descent in numpy.

Training reads a bounded sample (``SAMPLE`` labelled rows, whole texts) in one task
and returns the model, whose size is fixed.  As the output is linear in the average,
scoring needs one number a bucket: the documents are scored in one narrow pass.

A word pair of a word with itself is one feature whatever the word, as is one of a
word that occurred two words before: repetition is a property of its own.

Defined results: null and empty texts have no features and are scored by the bias
alone; a null doc_id counts as held out; without labels every score is 0.5; repeated rows
each get the same score; a document that is labelled twice, or occurs twice, is that many labelled rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeep.llm.common import U64, Words, batches_of, blocks, forget, mix64, slices, utf8

SAMPLE = 6000
BITS = 18
WIDTH = 16
EPOCHS = 6
RATE = 0.5
NGRAMS = (2, 3, 4)
#: Bytes of text whose features are worked out at once.
BLOCK = 1 << 18
#: Rows of the sample that are sent to the worker at once.
ROWS = 512
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
_MULT = U64(0x9E3779B97F4A7C15)


def fold(doc_id, folds: int = FOLDS):
    """crc32 of doc_id as text, modulo ``folds``; -1 for null."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(-1))


def features(texts: list[bytes], bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, document) of every feature of the texts; each array pair is sorted by document."""
    w = Words(texts)
    buf, shift = w.buf, U64(64 - bits)
    out = []

    def add(h, doc):
        out.append(((mix64(h) >> shift).astype(np.int64), doc))

    with np.errstate(over="ignore"):
        doc = np.repeat(np.arange(len(texts)), np.diff(w.first))
        add(w.hash, doc)
        for gap in (1, 2):
            if len(w.hash) > gap:
                same_doc = doc[gap:] == doc[:-gap]
                a, b = w.hash[:-gap][same_doc], w.hash[gap:][same_doc]
                if gap == 1:
                    add(np.where(a == b, U64(11), a * _MULT + b), doc[gap:][same_doc])
                else:
                    again = a == b
                    add(np.full(int(again.sum()), U64(13)), doc[gap:][same_doc][again])
        gap_at = (buf == 0x20) | ((buf >= 0x09) & (buf <= 0x0D))
        b64 = np.where(gap_at, U64(0x20), buf.astype(U64))
        where = np.repeat(np.arange(len(texts)), np.diff(w.bounds))
        for n in NGRAMS:
            m = len(buf) - n + 1
            if m <= 0:
                continue
            h = np.full(m, U64(n))
            for j in range(n):
                h = h * _MULT + b64[j : j + m]
            inside = ~np.logical_or.reduce([gap_at[j : j + m] for j in range(1, n - 1)]) if n > 2 else np.ones(m, bool)
            inside &= ~(gap_at[:m] & gap_at[n - 1 : n - 1 + m]) & (where[:m] == where[n - 1 : n - 1 + m])
            add(h[inside], where[:m][inside])
    return out


class Model:
    """One number a bucket, and a bias: the score is the logistic of bias + mean over a document's features."""

    def __init__(self, values: np.ndarray, bias: float):
        self.values, self.bias = values.astype(np.float32), float(bias)
        self.bits = int(len(values)).bit_length() - 1

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = []
        for some in blocks(texts, limit=BLOCK):
            total, count = np.zeros(len(some)), np.zeros(len(some))
            for bucket, doc in features(some, self.bits):
                total += np.bincount(doc, self.values[bucket], len(some))
                count += np.bincount(doc, minlength=len(some))
            out.append(1 / (1 + np.exp(-np.clip(self.bias + total / np.maximum(count, 1), -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)

    def to_bytes(self) -> bytes:
        return np.float64(self.bias).tobytes() + self.values.tobytes()

    @classmethod
    def from_bytes(cls, b: bytes) -> Model:
        return cls(np.frombuffer(b, np.float32, offset=8), np.frombuffer(b, np.float64, 1)[0])


def train(texts: list[bytes], labels: list[int], bits: int = BITS, width: int = WIDTH, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Stochastic gradient descent, a document a step, over vectors of ``width`` and a softmax of two classes."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / width, 1 / width, (1 << bits, width)).astype(np.float32)
    layer, bias = np.zeros((width, 2), np.float32), np.zeros(2, np.float32)
    rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
    high = np.arange(0, 1 << bits, 1 << 16, dtype=np.int32)
    for some in blocks(texts, limit=BLOCK):
        parts = features(some, bits)
        bucket, doc = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(doc, kind="stable")
        cuts = np.searchsorted(doc[order], np.arange(len(some) + 1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            ids, n = np.unique(bucket[order[a:b]], return_counts=True)
            # The sample's features are what training holds: counts as small as they are, and of the sorted ids the low 16 bits.
            few = n.astype(np.min_scalar_type(n.max(initial=0)))
            rows.append((ids.astype(np.uint16), np.diff(np.searchsorted(ids, high), append=len(ids)), few, max(1, b - a)))
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            low, each, n, size = rows[i]
            ids = np.repeat(high, each) | low
            share = (n / size).astype(np.float32)
            pace = rate * (1 - done / steps)
            done += 1
            mean = share @ table[ids] if len(ids) else np.zeros(width, np.float32)
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1  # gradient of the loss by z
            back = layer @ p
            layer -= pace * np.outer(mean, p)
            bias -= pace * p * 0.1
            if len(ids):
                # A document's share of the step is spread over its features as in the average, times a constant that keeps short and long ones alike.
                table[ids] -= (pace * 20) * share[:, None] * back[None, :]
    return Model(table @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on at most ``sample`` labelled rows that aren't held out: the first in the order of a hash of doc_id and text.

    The bound holds for joined rows, so that no repeated doc_id, in either table, brings more of them to the task that trains.
    """
    rows = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_y"))
    # At most `sample` different labelled ids are needed, two numbers each: small enough to be sent to every executor.
    rows = rows.where(fold(F.col("_id")) != HELD_OUT).groupBy("_id", "_y").agg(F.least(F.count("*"), F.lit(sample)).alias("_n"))
    rows = rows.orderBy(F.xxhash64("_id"), "_id", "_y").limit(sample)
    d = docs.select(F.col("doc_id").cast("long").alias("_doc"), utf8().alias("body"))
    d = d.join(F.broadcast(rows), d["_doc"] == F.col("_id")).withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    d = d.orderBy(F.xxhash64("_id"), "_id", "_y", F.xxhash64("body"), "_n").limit(sample).select("_id", "_y", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        seen: list[tuple[int, int, bytes]] = []
        for b in slices(batches):
            seen += zip(b["_id"].to_pylist(), b["_y"].to_pylist(), b["body"].to_pylist(), strict=True)
        seen.sort()
        if seen:
            model = train([x[2] for x in seen], [x[1] for x in seen])
            yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], pa.binary())], names=["model"])

    with batches_of(docs.sparkSession, ROWS):
        found = d.repartition(1).mapInArrow(run, "model binary").collect()
    return Model.from_bytes(bytes(found[0].model)) if found else Model(np.zeros(1 << BITS, np.float32), 0.0)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model.to_bytes())
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")).isin(HELD_OUT, -1)).alias("held_out"), utf8(text).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.from_bytes(sent.value)
        for b in slices(batches):
            s = m.scores(b["body"].to_pylist())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return d.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``threshold`` or more."""
    sent = docs.sparkSession.sparkContext.broadcast(model.to_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.from_bytes(sent.value)
        for b in slices(batches):
            texts = [(t or "").encode() for t in b["text"].to_pylist()]
            yield b.filter(pa.array(m.scores(texts) >= threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: int) -> bool:
    """The fold of one document, for use outside Spark."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT
