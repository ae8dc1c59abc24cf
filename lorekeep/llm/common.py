"""Helpers shared by the training-data operators: tables, blocks of texts, word hashes."""

from __future__ import annotations

import ctypes
import itertools
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekeep.shared import drop_written, materialize, shared_dir

__all__ = ["drop_written", "materialize", "shared_dir"]

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_MUL = U64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = []

#: Texts are handled in blocks of about so many bytes, which bounds a worker's memory.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str = "text"):
    """The column's text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def blocks(items, size=len, limit: int = BLOCK_BYTES):
    """Consecutive lists of items whose sizes sum to about ``limit``."""
    out, n = [], 0
    for x in items:
        out.append(x)
        n += size(x) + 1
        if n >= limit:
            yield out
            out, n = [], 0
    if out:
        yield out


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of so many rows, which bounds what a worker holds as Python values."""
    for b in batches:
        for at in range(0, max(1, len(b)), rows):
            yield b.slice(at, rows)
    release()


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def batches_from_here(spark: SparkSession, rows: int) -> None:
    """``batches_of`` for the rest of the session, where what is returned is run later; a smaller setting stays."""
    before = int(spark.conf.get(BATCH_ROWS))
    if before <= 0 or before > rows:
        spark.conf.set(BATCH_ROWS, str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run inside sends Arrow batches of at most so many rows, which bounds what an executor and its workers hold of wide rows."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


#: What workers remember between tasks, to be emptied by a task that needs the room.
remembered: list = [_powers]


def forget() -> None:
    for x in remembered:
        x.clear()
    release()


def release() -> None:
    """Give freed memory back to the system: a worker lives on after its task, next to others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def batched(iterable, n: int):
    it = iter(iterable)
    while chunk := list(itertools.islice(it, n)):
        yield chunk


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values, sorted."""
    x = np.sort(x)
    keep = np.ones(len(x), bool)
    keep[1:] = x[1:] != x[:-1]
    return x[keep]


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(32))) * _MUL
    h = (h ^ (h >> U64(32))) * _MUL
    return h ^ (h >> U64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * BLOCK_BYTES)
        for base in (_BASE, _BASE_INV):
            p = np.full(size, base, U64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
        del _powers[:-2]
    return _powers[0], _powers[1]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """P with (P[e] - P[s]) * B**-s a hash of buf[s:e]."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(buf) + 1, U64)
        np.cumsum((buf.astype(U64) + U64(1)) * powers(len(buf) + 1)[0][: len(buf)], out=out[1:])
    return out


class Words:
    """Words of a block of texts: byte spans, 64-bit hashes, and the first word of each text.

    Equal words get equal hashes; different ones differ but for 64-bit collisions.
    """

    def __init__(self, texts: list[bytes], gap: np.ndarray = _SPACE):
        self.buf = buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        inside = ~gap[buf]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
        self.bounds = bounds
        self.first = np.searchsorted(self.start, bounds)
        with np.errstate(over="ignore"):
            p, inv = prefix_hash(buf), powers(len(buf) + 1)[1]
            self.hash = mix64((p[self.end] - p[self.start]) * inv[self.start] + (self.end - self.start).astype(U64))
