"""Token-id output as directly addressable codes.

Texts are encoded with a public tokenizer and written, in ascending doc_id order, as
shards of directly addressable codes: an id is split into chunks of 8 bits; level k
holds chunk k of all ids that are that long, with one continuation bit each; a rank
directory over the continuation bits gives the place of an id's next chunk.  Any
token is read by one chunk access per level and one rank: nothing is decoded around it.

Shard layout, integers little-endian:
    8 bytes   magic "DACTOK01"
    4 x u32   documents, levels, directory step in bits, 0
    u64       tokens
    documents x (i64 doc_id, u64 end of the document's tokens)
    a bitmap of null doc_ids
    per level: u64 chunks n; n bytes of chunks; (n + 7) // 8 bytes of continuation bits;
               u32 ranks at every directory step
Shards are rows of a Parquet table (part, shard, first and last document, payload) in
the shared folder, so any file system that Spark writes to holds them.

Defined results: null text is empty and has only its end id; documents with equal
doc_id are ordered by text; null doc_ids come first; empty tables give no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorekeep.llm.common import batches_of, release, remembered, shared_dir, slices

MAGIC = b"DACTOK01"
STEP = 512
END_ID = 2
#: A shard is closed at so many tokens (a single longer document makes a longer shard).
SHARD_TOKENS = 1 << 20
#: Rows that are sent to a worker at once, whole texts each.
ROWS = 512
#: Pieces that a worker remembers, some 150 bytes each; of a full memo the last third is forgotten, as common pieces come first.
MEMO = 300_000
BLANKS = 1_000
#: Letters below this are the same to str.isalpha and to the pattern.
LATIN = "\u0250"
#: Shards whose starts are broadcast: 24 bytes each.
BROADCAST_SHARDS = 1_000_000
DEFAULT = "byte_bpe_50k.json"
#: The pattern that texts may be cut for at spaces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer_path(name: str = DEFAULT) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts from the tokenizers library, remembering what it has met.

    A byte-level tokenizer splits a text by a fixed pattern and encodes each piece alone, so the ids
    of a piece can be remembered.  Only pieces that aren't remembered go to the library.
    No piece of the usual pattern goes on from a character that isn't white to one that is, and the pattern looks past pieces of
    white only: a text can be cut before its spaces and line ends, and a cut that is one remembered piece, or such a one and
    punctuation, needs no pattern.
    """

    def __init__(self, path: str, pattern: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        whole.model._resize_cache(0)  # it would be asked for nothing twice
        self.tokenize = whole.model.tokenize
        added = {t.content: (i, t) for i, t in whole.get_added_tokens_decoder().items()}
        if any(t.single_word or t.lstrip or t.rstrip for _, t in added.values()):
            raise ValueError("added tokens that look at the text around them aren't supported")
        self.added = {c: array("I", [i]).tobytes() for c, (i, _) in added.items()}
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split
        self.split = regex.compile(pattern or public_tokenizers.PATTERN).findall
        self.cuts = pattern is None and public_tokenizers.PATTERN == PATTERN
        self.letters = byte_letters()
        self.memo: dict[str, bytes] = {}
        #: Pieces of white only, which may go on behind a cut: no cut must be taken for one.
        self.blanks: dict[str, bytes] = {}

    def piece(self, p: str) -> bytes:
        """Ids of one piece that ``memo`` doesn't hold; it is remembered if it isn't long."""
        blank = p.isspace()
        if blank and p in self.blanks:
            return self.blanks[p]
        tokens = self.tokenize(p.encode().decode("latin-1").translate(self.letters))
        got = array("I", [t.id for t in tokens]).tobytes()
        if len(p) <= 48:
            memo, most = (self.blanks, BLANKS) if blank else (self.memo, MEMO)
            if len(memo) >= most:
                for _ in range(most // 3):
                    memo.popitem()
            memo[p] = got
        return got

    def ids(self, text: str) -> bytes:
        """The text's ids as u32 in the machine's byte order."""
        if not any(c in text for c in self.added):
            return self.between(text)
        return b"".join([self.added[p] if i % 2 else self.between(p) for i, p in enumerate(self.parts(text))])

    def between(self, text: str) -> bytes:
        """Ids of text that holds no added token."""
        if not self.cuts or "\0" in text:
            return self.pieces(text)
        units = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
        known, piece = self.memo.get, self.piece
        got, upto = list(map(known, units)), 0
        for i in [i for i, g in enumerate(got) if g is None]:
            if i < upto:
                continue
            u, upto = units[i], i + 1
            last, g = "", None
            if u[-1:].isalpha():
                word = u
            else:
                word = u.rstrip(punctuation)
                last, end = u[len(word) :], word[-1:]
                if last and end.isalnum() and end < LATIN:
                    g = known(word)
            if g is None:
                letters = word[1:] if word[:1] == " " or word[:1] == "\n" else word
                if letters.isalpha() and (letters.isascii() or max(letters) < LATIN):
                    # A line end, and letters, are pieces of their own.
                    g = known(word) or piece(word) if word[0] != "\n" else piece("\n") + (known(letters) or piece(letters))
            if g is not None:
                got[i] = g + (known(last) or piece(last)) if last else g
            else:
                # What ends in white goes on in the next unit.
                while upto < len(units) and (not units[upto - 1] or units[upto - 1][-1].isspace()):
                    upto += 1
                got[i:upto] = [self.pieces("".join(units[i:upto])), *[b""] * (upto - i - 1)]
        return b"".join(got)

    def pieces(self, text: str) -> bytes:
        """Ids of text by the pattern alone."""
        known, piece = self.memo.get, self.piece
        return b"".join([known(p) or piece(p) for p in self.split(text)])


def byte_letters() -> dict[int, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


def pack(doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    """One shard of the documents' ids."""
    ids = np.concatenate([*docs, np.zeros(0, np.uint32)]).astype(np.uint32)
    ends = np.cumsum([len(x) for x in docs], dtype=np.uint64) if docs else np.zeros(0, np.uint64)
    levels, rest = [], ids
    while len(rest) or not levels:
        longer = rest > 255
        bits = np.packbits(longer, bitorder="little")
        ranks = np.concatenate(([0], np.cumsum(longer, dtype=np.int64)))[0 : len(rest) + 1 : STEP].astype("<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        rest = rest[longer] >> 8
    table = np.empty((len(docs), 2), "<i8")
    table[:, 0] = [d or 0 for d in doc_ids]
    table[:, 1] = ends.astype(np.int64)
    nulls = np.packbits([d is None for d in doc_ids], bitorder="little").tobytes() if docs else b""
    return MAGIC + struct.pack("<4IQ", len(docs), len(levels), STEP, 0, len(ids)) + table.tobytes() + nulls + b"".join(levels)


class Shard:
    """Reads a shard: any token by rank, any range or all of it by whole arrays."""

    def __init__(self, payload: bytes):
        if payload[:8] != MAGIC:
            raise ValueError("not a token shard")
        n_docs, n_levels, self.step, _, self.n_tokens = struct.unpack_from("<4IQ", payload, 8)
        at = 32
        docs = np.frombuffer(payload, "<i8", 2 * n_docs, at).reshape(n_docs, 2)
        at += 16 * n_docs
        null = np.unpackbits(np.frombuffer(payload, np.uint8, (n_docs + 7) // 8, at), bitorder="little")[:n_docs]
        at += (n_docs + 7) // 8
        self.doc_ids = [None if x else int(d) for d, x in zip(docs[:, 0], null, strict=True)]
        self.ends = docs[:, 1]
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", payload, at)
            chunks = np.frombuffer(payload, np.uint8, n, at + 8)
            bits = np.frombuffer(payload, np.uint8, (n + 7) // 8, at + 8 + n)
            at += 8 + n + (n + 7) // 8
            ranks = np.frombuffer(payload, "<u4", n // self.step + 1, at)
            at += 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def token(self, i: int) -> int:
        """Token ``i`` of the shard."""
        out, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            out |= int(chunks[i]) << shift
            if not (bits[i >> 3] >> (i & 7)) & 1:
                break
            step = i // self.step
            block = np.unpackbits(bits[step * self.step // 8 : (i + 8) // 8], bitorder="little")
            i = int(ranks[step]) + int(block[: i - step * self.step].sum())
            shift += 8
        return out

    def all(self) -> np.ndarray:
        out = None
        for chunks, bits, _ in reversed(self.levels):
            longer = np.unpackbits(bits, bitorder="little")[: len(chunks)].astype(bool)
            here = chunks.astype(np.uint32)
            if out is not None:
                here[longer] |= out << np.uint32(8)
            out = here
        return out


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode the documents and write the shard table to ``path``.

    The rows are range-partitioned by doc_id before they are encoded: sampling for the ranges
    then reads plain columns only, and each text crosses the network once.
    """
    tokenizer = tokenizer or tokenizer_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, shard = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        body: list[np.ndarray] = []
        n, end = 0, np.array([end_id], np.uint32).tobytes()

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"part": part, "shard": shard, "n_docs": len(ids), "n_tokens": n, "payload": pack(ids, body)}], schema=_SHARDS)

        for b in slices(batches):
            for d, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                ids.append(d)
                body.append(np.frombuffer(enc.ids(text or "") + end, np.uint32))
                n += len(body[-1])
                if n >= shard_tokens:
                    yield close()
                    ids, body, n, shard = [], [], 0, shard + 1
        if ids:
            yield close()
        release()

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    d = d.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    with batches_of(docs.sparkSession, ROWS):
        d.mapInArrow(encode, "part int, shard int, n_docs long, n_tokens long, payload binary").write.parquet(path)


_SHARDS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())])
_encoders: dict[str, Encoder] = {}
remembered.append(_encoders)


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def read(spark, path: str) -> DataFrame:
    """The shard table with the global number of each shard's first token, ``start``."""
    shards = spark.read.parquet(path)
    sizes = shards.select("part", "shard", "n_tokens")
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    parts = parts.select("part", (F.sum("_sum").over(upto(Window.orderBy("part"))) - F.col("_sum")).alias("_before"))
    inside = sizes.withColumn("_in", F.sum("n_tokens").over(upto(Window.partitionBy("part").orderBy("shard"))) - F.col("n_tokens"))
    starts = inside.join(parts, "part").select("part", "shard", (F.col("_before") + F.col("_in")).alias("start"))
    if shards.count() <= BROADCAST_SHARDS:
        starts = F.broadcast(starts)
    return shards.join(starts, ["part", "shard"])


def summary(shards: DataFrame) -> DataFrame:
    """Per document, from the stored shards: doc_id, start, n_tokens, ids_crc32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for payload, start in zip(b["payload"], b["start"].to_pylist(), strict=True):
                s = Shard(payload.as_py())
                ids, ends = s.all().astype("<u4"), s.ends.tolist()
                begins = [0, *ends[:-1]]
                crcs = [zlib.crc32(ids[a:e]) for a, e in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.doc_ids, pa.int64()), pa.array([start + a for a in begins], pa.int64()), pa.array([e - a for a, e in zip(begins, ends, strict=True)], pa.int64()), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
        release()

    return shards.select("payload", "start").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, name: str = "tokens", **settings) -> DataFrame:
    """Write the shards into the shared folder, read them back, and sum them up per document."""
    path = shared_dir(docs.sparkSession, name)
    write(docs, path, **settings)
    return summary(read(docs.sparkSession, path))
