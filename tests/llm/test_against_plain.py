"""Operators and the pipeline against plain versions over whole tables, and properties of their parts."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pyarrow.dataset as ds
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lorekeep.llm import components, decontam, lm, media, mixing, near_dup, quality, queries, secrets, suffix_dedup, tokens, urls

WORD = re.compile("[^\x20\x09-\x0d]+")
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(sf):
    return ds.dataset(f"{sf}/documents.parquet").to_table().to_pandas()


# ---- 1 -----------------------------------------------------------------------------------


def repeats_by_counting(texts, length):
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mark[i : i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~mark])
        out.append((len(t), int(mark.sum()), len(suffix_dedup.spans_of(mark)), hashlib.sha256(kept).hexdigest()))
    return out


@given(st.binary(max_size=150).map(lambda b: bytes(x % 3 + 97 if x < 250 else 255 for x in b)))
@settings(max_examples=200, deadline=None)
def test_suffix_array_is_sorted(text):
    t = np.frombuffer(text, np.uint8)
    order = suffix_dedup.suffix_array(t, 40).tolist()
    assert sorted(order) == list(range(len(text)))
    # A string ends at the byte 255 or at the text's end, which is the largest byte.
    keys = [(text[i:] + b"\xff").split(b"\xff")[0] + b"\xff" for i in order]
    assert [k[:40] for k in keys] == sorted(k[:40] for k in keys)
    for k, n in enumerate(suffix_dedup.common_prefixes(t, np.array(order, np.int64), 40).tolist()):
        if k:
            a, b = text[order[k] :][:40], text[order[k - 1] :][:40]
            assert n == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_two_tied_suffixes_are_not_sorted_but_compared(monkeypatch):
    rng, sorted_ = np.random.default_rng(5), []
    half = bytes(rng.integers(97, 123, 3000).astype(np.uint8))
    text = half + b"\xff" + half[:1500] + b"0" + half[1500:] + b"\xff"
    for name in ("lexsort", "argsort"):
        f = getattr(np, name)
        monkeypatch.setattr(np, name, lambda x, *a, f=f, **b: (sorted_.append(np.shape(x)[-1]), f(x, *a, **b))[1])
    order = suffix_dedup.sort_directly(np.frombuffer(text, np.uint8), np.arange(len(text)), 200)
    keys = [(text[i:].split(b"\xff")[0] + b"\xff")[:200] for i in order.tolist()]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(len(text)))
    # Some sorts of all suffixes, and none for every eight bytes that two of them share.
    assert sum(n > 100 for n in sorted_) <= 4


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 2])
def test_suffix_dedup(spark, sf, docs, crowd):
    want = dict(zip(docs.doc_id, repeats_by_counting([(t or "").encode() for t in docs.text], 200)))
    got = suffix_dedup.without_repeats(spark.read.parquet(f"{sf}/documents.parquet"), crowd=crowd).collect()
    assert {r.doc_id: tuple(r[1:]) for r in got} == want


# ---- 2, 3 --------------------------------------------------------------------------------


def test_secrets_held_out():
    forest = secrets.fit()
    rows = secrets.labelled_findings(1500, seed=77)
    p = forest.scores(np.array([secrets.describe(t.encode(), a, b) for t, a, b, _ in rows]))
    assert ((p >= secrets.THRESHOLD) == np.array([y for *_, y in rows])).mean() > 0.95


def test_planted_secrets_are_found():
    """Of every make, in prose of other words than the training's: as candidates, and by the forest."""
    import random

    rng, forest = random.Random(9), secrets.fit()
    some = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    low, hexes = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
    mixed = low + low.upper() + "0123456789"
    makes = {
        "password": lambda: f"the password: {some(mixed, 10)}", "lower": lambda: f"api_key = {some(low, 24)}", "hex": lambda: f'secret="{some(hexes, 32)}"', "short hex": lambda: f"token: {some(hexes, 14)}",
        "cloud": lambda: f"AWS_SECRET_ACCESS_KEY={some(mixed + '+/', 40)}", "id": lambda: f"key AKIA{some(low.upper() + '234567', 16)}", "bearer": lambda: f"Authorization: Bearer {some(mixed, 36)}", "prefixed": lambda: f"use ghp_{some(mixed, 36)} here",
    }
    prose = "Yesterday we walked along the river and spoke about harvest weather until evening came"
    for name, make in makes.items():
        found = met = 0
        for _ in range(50):
            line = make()
            value = re.split(r"[ =:\"]+", line.strip('"'))[-1] if name != "prefixed" else line.split()[1]
            body = f"{prose}. {line} {prose}".encode()
            at = body.index(value.encode())
            hit = [(a, b) for a, b in secrets.candidates(body) if a <= at and b >= at + len(value)]
            met += bool(hit)
            found += any(forest.scores(np.array([secrets.describe(body, a, b)]))[0] >= secrets.THRESHOLD for a, b in hit)
        assert met == 50 and found >= 45, (name, met, found)
    clean = [x for x in secrets.candidates(" ".join([prose, "McGregor-Wellington", "1984", "Blumenstrasse"]).encode())]
    assert len(clean) <= 1


def test_secrets_query_is_a_plain_scan(spark, sf, docs):
    forest, want = secrets.fit(), []
    for d, t in zip(docs.doc_id, docs.text):
        body = (t or "").encode()
        for a, b in secrets.candidates(body):
            p = forest.scores(np.array([secrets.describe(body, a, b)]))[0]
            want.append((d, a, b - a, bool(p >= 0.5), hashlib.sha256(body[a:b]).hexdigest()))
    got = [(r.doc_id, r.start, r.length, r.secret, r.value_sha256) for r in queries.op2_secrets(spark, sf).collect()]
    assert sorted(got) == sorted(want)


@given(st.integers(1, 40), st.integers(0, 2**32))
@settings(max_examples=20, deadline=None)
def test_jpeg_payload_round_trip(blocks, seed):
    payload = np.random.default_rng(seed).integers(0, 256, 64 * blocks, dtype=np.uint8).tobytes()
    image = media.Image(media.encode_payload(payload))
    assert media.read_payload(image) == payload


def test_jpeg_of_any_bytes(spark):
    """Zeros, runs of them and coefficients of magnitude 1 have codes of their own; another decoder reads the files."""
    rng = np.random.default_rng(3)
    kinds = [np.arange(256), [104], [103, 104, 105], [104] * 19 + [105, 0], [103, 105]]
    payloads = [rng.choice(np.array(k, np.uint8), 64 * n).tobytes() for k in kinds for n in (1, 5, 6, 7, 40)]
    files = media.encode_payloads(payloads)
    images = [media.Image(x, read=False) for x in files]
    media.read_scans(images)
    assert [media.read_payload(i) for i in images] == payloads
    assert [media.read_payload(media.Image(x)) for x in files] == payloads
    for i, x in zip(images[4::5], files[4::5]):
        seen = spark._jvm.javax.imageio.ImageIO.read(spark._jvm.java.io.ByteArrayInputStream(x))
        assert (seen.getHeight(), seen.getWidth()) == i.rgb().shape[:2]


class BitWriter:
    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> (n - 1 - i) & 1 for i in range(n)]

    def code(self, symbol):  # every symbol has a code of nine bits
        self.put(symbol, 9)

    def signed(self, v, size):
        self.put(v if v > 0 else v + (1 << size) - 1, size)

    def done(self):
        bits = self.bits + [1] * (-len(self.bits) % 8)
        return np.packbits(np.array(bits, np.uint8)).tobytes().replace(b"\xff", b"\xff\x00")


def colour_file(coefficients, height, width):
    """A progressive file of three components, chroma at half the resolution, in eight scans, by the standard's procedure."""
    table = lambda kind: media.segment(0xC4, bytes([kind << 4, *[0] * 8, 256 % 256 or 255, *[0] * 7, *range(255)]))
    out = [b"\xff\xd8", media.segment(0xDB, bytes([0, *[2] * 64])), media.segment(0xC2, bytes([8, height >> 8, height & 255, width >> 8, width & 255, 3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])), table(0), table(1)]
    y, cb, cr = coefficients
    w, before = BitWriter(), [0, 0, 0]
    units = [(my, mx) for my in range(cb.shape[0]) for mx in range(cb.shape[1])]
    for my, mx in units:
        blocks = [(0, y[2 * my + v, 2 * mx + h]) for v in range(2) for h in range(2)] + [(1, cb[my, mx]), (2, cr[my, mx])]
        for c, b in blocks:
            v = int(b[0]) >> 1
            diff, before[c] = v - before[c], v
            size = abs(diff).bit_length()
            w.code(size)
            if size:
                w.signed(diff, size)
    out += [media.segment(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 0, 1])), w.done()]
    w = BitWriter()
    for my, mx in units:
        for b in [y[2 * my + v, 2 * mx + h] for v in range(2) for h in range(2)] + [cb[my, mx], cr[my, mx]]:
            w.put(int(b[0]) & 1, 1)
    for k, plane in enumerate((y, cb, cr), 1):
        first = BitWriter()
        for b in plane.reshape(-1, 64):
            zeros = 0
            for v in b[1:]:
                v = int(np.sign(v)) * (abs(int(v)) >> 1)
                if v == 0:
                    zeros += 1
                    continue
                while zeros > 15:
                    first.code(0xF0)
                    zeros -= 16
                size = abs(v).bit_length()
                first.code(zeros << 4 | size)
                first.signed(v, size)
                zeros = 0
            if zeros:
                first.code(0)
        out += [media.segment(0xDA, bytes([1, k, 0, 1, 63, 1])), first.done()]
        again = BitWriter()
        for b in plane.reshape(-1, 64):
            zeros, held = 0, []
            last = max([i for i in range(1, 64) if abs(int(b[i])) == 1], default=0)
            for i in range(1, 64):
                v = int(b[i])
                if abs(v) > 1:
                    held.append(abs(v) & 1)
                elif v == 0:
                    zeros += 1
                    if zeros == 16 and i < last:
                        again.code(0xF0)
                        for bit in held:
                            again.put(bit, 1)
                        zeros, held = 0, []
                else:
                    again.code(zeros << 4 | 1)
                    again.put(v > 0, 1)
                    for bit in held:
                        again.put(bit, 1)
                    zeros, held = 0, []
            if zeros or held:
                again.code(0)
                for bit in held:
                    again.put(bit, 1)
        out += [media.segment(0xDA, bytes([1, k, 0, 1, 63, 0x10])), again.done()]
    out += [media.segment(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 0, 0x10])), w.done(), b"\xff\xd9"]
    return b"".join(out)


def test_jpeg_with_chroma():
    rng = np.random.default_rng(4)
    planes = []
    for shape in ((4, 4), (2, 2), (2, 2)):
        x = rng.integers(-40, 41, (*shape, 64)) * (rng.random((*shape, 64)) < 0.2)
        x[..., 0] = rng.integers(-60, 60, shape)
        planes.append(x)
    image = media.Image(colour_file(planes, 30, 27))
    for c, x in zip(image.components, planes):
        assert (c.blocks.reshape(x.shape) == x).all()
    rgb = image.rgb()
    assert rgb.shape == (30, 27, 3) and rgb.dtype == np.uint8
    # By the definition: sums of cosines, chroma of a pixel from the block cell it falls in.
    k = np.arange(8)
    scale = np.where(k == 0, math.sqrt(0.5), 1) / 2
    natural = np.zeros((8, 8))
    natural.ravel()[media.ZIGZAG] = planes[0][1, 2] * 2
    want = sum(natural[u, v] * scale[u] * scale[v] * math.cos((2 * 3 + 1) * u * math.pi / 16) * math.cos((2 * 5 + 1) * v * math.pi / 16) for u in range(8) for v in range(8)) + 128
    assert abs(int(next(image.planes())[8 + 3, 16 + 5]) - min(255, max(0, want))) <= 0.51


def test_media_query(spark, sf, docs):
    rows = {r.doc_id: r for r in queries.op3_media(spark, sf).collect()}
    for d, t in zip(docs.doc_id, docs.text):
        body = (t or "").encode()
        p = body + bytes(-len(body) % 64 if body else 64)
        r = rows[d]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(body), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        data = media.encode_payload(p)
        assert (r.media_bytes, r.media_sha256) == (len(data), hashlib.sha256(data).hexdigest())
        assert r.feature == plain_feature(data)
    t = media.tensors(media.stored(spark.read.parquet(f"{sf}/documents.parquet")).limit(2)).collect()
    assert all(len(r.rgb) == r.height * r.width * 3 for r in t)


def plain_feature(data):
    """From the coefficients, by sums of cosines, chroma repeated pixel by pixel."""
    image = media.Image(data)
    k = np.arange(8)
    scale = np.where(k == 0, math.sqrt(0.5), 1) / 2
    wave = np.array([[scale[u] * math.cos((2 * x + 1) * u * math.pi / 16) for x in range(8)] for u in range(8)])
    planes = []
    for c in image.components:
        out = np.zeros((8 * c.rows, 8 * c.columns))
        for i, b in enumerate(c.blocks):
            natural = np.zeros(64)
            natural[media.ZIGZAG] = b
            y, x = divmod(i, c.columns)
            out[8 * y : 8 * y + 8, 8 * x : 8 * x + 8] = wave.T @ natural.reshape(8, 8) @ wave
        planes.append(np.clip(np.rint((out + 128).astype(np.float32)), 0, 255))
    h, w = image.height, image.width
    y, cb, cr = planes[0][:h, :w], *(np.kron(p, np.ones((2, 2)))[:h, :w] - 128 for p in planes[1:])
    rgb = [np.clip(np.rint(v.astype(np.float32)), 0, 255).astype(np.int64) for v in (y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb)]
    r = rgb[0]
    steps = [int(np.abs(np.diff(r, axis=a)).sum()) for a in (1, 0)]
    return ";".join(map(str, (h, w, *(int(v.sum()) for v in rgb), int((r * r).sum()), *steps, int((r == 255).sum()), int((r == 0).sum()))))


# ---- 4, 5, 6 -----------------------------------------------------------------------------


def test_lm(spark, sf, docs):
    train = [t for d, t in zip(docs.doc_id, docs.text) if zlib.crc32(str(d).encode()) % 7 != 2]
    c = collections.Counter(w for t in train for w in [*WORD.findall(low(t)), "\n"])
    n, v = sum(c.values()), len(c)
    got = lm.scored(spark.read.parquet(f"{sf}/documents.parquet"), bucket_bytes=100_000).collect()
    text = dict(zip(docs.doc_id, docs.text))
    for r in got:
        w = [*WORD.findall(low(text[r.doc_id])), "\n"]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    other = {r.doc_id: r.score for r in lm.scored(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    assert all(r.score == pytest.approx(other[r.doc_id], rel=1e-9) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(-r.score for r in held) / math.log10(2) < 4.5 * sum(len(text[r.doc_id].encode()) for r in held)


def test_lm_held_out_bits(spark, sf, docs):
    """Well under the order-0 entropy of the held-out bytes."""
    rows = lm.scored(spark.read.parquet(f"{sf}/documents.parquet")).where("held_out").collect()
    text = dict(zip(docs.doc_id, docs.text))
    held = b"".join(text[r.doc_id].encode() for r in rows)
    p = np.bincount(np.frombuffer(held, np.uint8)) / len(held)
    p = p[p > 0]
    assert sum(-r.score for r in rows) / math.log10(2) / len(held) < 0.75 * -(p * np.log2(p)).sum()


class PlainModel:
    """Bit by bit: counts by the contexts' bytes themselves, a text's weights and map as plain lists."""

    def __init__(self, train):
        counts = np.zeros((256, 257), np.int64)
        for t in train:
            for before, s in zip([lm.BEFORE, *t], [*t, lm.END]):
                counts[before, s] += 1
        self.code, self.n = lm.Code(counts), collections.Counter()
        for t in train:
            for i, s in enumerate([*t, lm.END]):
                path = self.path(t, i, s)
                self.n.update((m, c, node, bit) for m, c in enumerate(self.contexts(t, i)) for node, bit in path)

    def contexts(self, t, i):
        return [*((t[max(0, i - k) : i]) for k in lm.ORDERS), (re.search(rb"[^\t-\r ]*\Z", t[max(0, i - 5000) : i])[0], t[max(0, i - 1) : i])]

    def path(self, t, i, s):
        after = (t[i - 1] if i else lm.BEFORE) << 9 | s
        at = slice(self.code.base[after], self.code.base[after] + self.code.length[after])
        return list(zip(self.code.tree[at].tolist(), (self.code.sign[at] > 0).astype(int).tolist()))

    def logit(self, m, c, node):
        zero, one = self.n[m, c, node, 0], self.n[m, c, node, 1]
        x = round(max(-lm.MAP_SPAN, min(lm.MAP_SPAN, math.log((one + lm.PRIOR) / (zero + lm.PRIOR)))) * lm.UNIT)
        return (x or 1) / lm.UNIT if zero + one else 0.0

    def one(self, c, node, weights, curve):
        """Inputs, gate, mixed probability of a 1, the favoured bit, map cell, probability of a 1."""
        x = [self.logit(m, k, node) for m, k in enumerate(c)]
        gate = sum(v != 0 for v in x)
        z = max(-lm.MAP_SPAN + 0.01, min(lm.MAP_SPAN - 0.01, sum(v * w for v, w in zip(x, weights[gate]))))
        mixed, at = 1 / (1 + math.exp(-z)), abs(z) * (lm.MAP_STEPS - 1) / lm.MAP_SPAN
        low, part = int(at), at - int(at)
        favoured = min(1 - 1e-4, curve[low] + (curve[low + 1] - curve[low]) * part)
        return x, gate, mixed, z > 0, low + (part > 0.5), (mixed + (favoured if z > 0 else 1 - favoured)) / 2

    def score(self, t, sums=False):
        weights = [[w] * lm.PREDICTORS for w in lm.START[: lm.GATES]]
        curve = [1 / (1 + math.exp(-lm.MAP_SPAN * i / (lm.MAP_STEPS - 1))) for i in range(lm.MAP_STEPS)]
        out, s = 0.0, [*t, lm.END]
        cut = lm.steps(len(s)).tolist()
        for a, b in zip(cut, cut[1:]):
            moves, cells = collections.Counter(), collections.defaultdict(list)
            for i in range(a, min(b, len(s))):
                c = self.contexts(t, i)
                for node, bit in self.path(t, i, s[i]):
                    x, gate, mixed, favoured, cell, p = self.one(c, node, weights, curve)
                    out += math.log10(p if bit else 1 - p)
                    for m, v in enumerate(x):
                        moves[gate, m] += v * (bit - mixed) * lm.RATE * (lm.FIRST / (b - a)) ** lm.RATE_POWER
                    # A logit of exactly 0 favours neither side and misses.
                    cells[cell].append((favoured == bit and (favoured or any(x))) - curve[cell])
                if sums:  # the probabilities of all symbols that could stand here
                    paths = [self.path(t, i, x) for x in range(257)]
                    every = {n: self.one(c, n, weights, curve)[-1] for n in {n for path in paths for n, _ in path}}
                    assert sum(math.prod(every[n] if bit else 1 - every[n] for n, bit in path) for path in paths) == pytest.approx(1)
            for (gate, m), v in moves.items():
                weights[gate][m] += v
            for cell, missed in cells.items():
                curve[cell] += sum(missed) / len(missed) * (1 - (1 - lm.MAP_RATE) ** len(missed))
            curve[0] = 0.5
        return out


def test_lm_against_a_plain_mixer(spark, sf, docs):
    texts = [(d, (t or "").encode(), zlib.crc32(str(d).encode()) % 7 == 2) for d, t in zip(docs.doc_id, docs.text)]
    plain = PlainModel([t for _, t, out in texts if not out])
    got = {r.doc_id: r.score for r in lm.scored(spark.read.parquet(f"{sf}/documents.parquet"), bucket_bytes=150_000).collect()}
    some = sorted((len(t), d, t) for d, t, out in texts if out)
    for _, d, t in [*some[: len(some) // 2], some[-1]]:
        assert got[d] == pytest.approx(plain.score(t), rel=1e-4)
    plain.score(some[0][2][:40], sums=True)


def test_lm_prepares_a_block_once(monkeypatch):
    made, plain = [], lm.Symbols
    monkeypatch.setattr(lm, "Symbols", lambda texts: made.append(len(texts)) or plain(texts))
    pairs = lm.Pairs([b"abcab", b"", b"ab"], 27)
    assert made == [3]
    for m in range(lm.PREDICTORS):
        assert (pairs.keys[m][pairs.some[m][0]][pairs.which[m][0]] == plain([b"abcab", b"", b"ab"]).pairs(m, 27)).all()


def test_lm_hashes_words_once(docs, monkeypatch):
    texts = [(t or "").encode() for t in docs.text[:300]]
    keys, counts = lm.word_counts(texts, np.ones(len(texts), np.int64))
    known = dict(zip(keys.tolist(), counts.tolist(), strict=True))
    own, hashed = [lm.word_hashes([t]).hash.tolist() for t in texts], []
    f = lm.word_hashes
    monkeypatch.setattr(lm, "word_hashes", lambda some: (hashed.append(len(some)), f(some))[1])
    n_tokens, n_known, seen = lm.base_scores(texts, [lm.squeezed(counts)], 1, len(texts))
    assert sum(hashed) == len(texts)
    assert n_tokens.tolist() == n_known.tolist() == [len(w) + 1 for w in own]
    want = [sum(math.log10(known[x] + 1) for x in w) + math.log10(len(texts) + 1) for w in own]
    assert np.allclose(seen, want)


def test_lm_hashes_distinct_short_contexts(monkeypatch):
    texts, times = [b"abcd" * 500, b"", b"\xff\xff\xffa\xff", b"abcdabc"], np.array([1, 1, 2, 0])
    hashed, f = [], lm.pair_of
    monkeypatch.setattr(lm, "pair_of", lambda h, width, *rest: (hashed.append(len(h)) if width == 3 else None, f(h, width, *rest))[1])
    own, counted = lm.Pairs(texts, 27), lm.Pairs(texts, 27, times)
    assert max(hashed) < 30
    plain = [lm.Symbols([t]).pairs(0, 27) for t in texts]
    assert own.keys[0].take(own.some[0][0].take(own.which[0][0])).tolist() == np.concatenate(plain).tolist()
    n = collections.Counter()
    for k, most in zip(plain, times.tolist()):
        for x in k.tolist():
            n[x] += most
    assert dict(zip(counted.keys[0].tolist(), counted.counts[0].tolist())) == n


def test_lm_prepares_few_steps_at_a_time(docs, monkeypatch):
    texts = [(t or "").encode() for t in docs.text[:60]]
    model, made, f = lm.Model.trained(texts, texts), [], lm.Mixer.mixed
    whole = model.scores()
    monkeypatch.setattr(lm, "AHEAD", 100)
    monkeypatch.setattr(lm.Mixer, "mixed", lambda self, *given: (made.append(len(given[-1])), f(self, *given))[1])
    assert model.scores() == pytest.approx(whole, rel=1e-12)
    assert sum(made) == sum(len(lm.steps(max(map(len, some)) + 1)) - 1 for some in model.pairs.blocks)
    assert len(made) > sum(made) / 2


def test_lm_counts_grow_with_the_corpus(spark):
    """Contexts in great number aren't added together, and copies are counted as often as they occur."""
    rng = np.random.default_rng(5)
    noise = [bytes(rng.integers(33, 120, 20_000, np.uint8)) for _ in range(7)]
    words = [b" ".join(rng.choice([b"some", b"known", b"words", b"again."], 60)) for _ in range(20)]
    texts = [*noise, *words, *[words[0]] * 9]
    out = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    plain = PlainModel([t for t, o in zip(texts, out) if not o])
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in lm.scored(docs, bucket_bytes=30_000).collect()}
    for i in range(len(noise), len(texts)):
        assert got[i].score == pytest.approx(plain.score(texts[i]), rel=1e-4)
    assert any(out[len(noise) :]) and len({got[i].score for i in range(len(texts) - 9, len(texts))}) == 1
    assert sum(lm.Model.trained([b"abcab", b"abba"], [b"", b"ab"]).scores()) == pytest.approx(sum(map(PlainModel([b"abcab", b"abba"]).score, (b"", b"ab"))), rel=1e-4)


def plain_mix(sizes):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target = 1.5 * sum(sizes.values()), {}
    while len(target) < len(names):
        free = [s for s in names if s not in target]
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        for s in over or free:
            target[s] = 2 * sizes[s] if over else level * weight[s]
        if over:
            left -= sum(2 * sizes[s] for s in over)
    return target


@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=12))
@settings(max_examples=8, deadline=None)
def test_targets(spark, sizes):
    given_ = {f"s{i:02d}": n for i, n in enumerate(sizes)} | {None: 7}
    rows = mixing.targets(spark.createDataFrame(list(given_.items()), "source string, source_size long")).collect()
    want = plain_mix(given_)
    assert all(r.target == pytest.approx(want[r.source]) for r in rows) and len(rows) == len(want)


def test_mixing_positions(spark, sf):
    rows = mixing.in_training_order(mixing.plan(spark.read.parquet(f"{sf}/documents.parquet"))).collect()
    at = [r.position for r in rows if r.position is not None]
    assert at == sorted(at) and all(0 <= p <= 1 for p in at)
    for r in rows:
        if r.position is not None:  # the schedule's integral up to the position is the share of the supply before the document
            assert r.position + r.slope * (r.position**2 - r.position) == pytest.approx(r.offset / r.target, abs=1e-9)


def test_mix_of_repeated_rows(spark):
    """Equal rows each have their own place in the plan, so that the mix meets its targets."""
    rows = [(1, " ".join(["w"] * 100), "a", "en")] * 30 + [(1, " ".join(["v"] * 100), "a", "en")] * 10 + [(i, " ".join(["u"] * 50), "b", "en") for i in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = mixing.mixed(docs).collect()
    goal = plain_mix({"a": 4000, "b": 2500})
    for source in "ab":
        assert abs(sum(len(r.text.split()) for r in got if r.source == source) - goal[source]) <= 50
    again = mixing.mixed(docs.repartition(3)).collect()
    assert collections.Counter(got) == collections.Counter(again) and {r.text for r in got} == {r[1] for r in rows}


@given(st.lists(st.lists(st.integers(0, 2**31), max_size=700), max_size=5))
@settings(max_examples=40, deadline=None)
def test_token_shard_round_trip(docs):
    ids = [np.array(x, np.uint32) for x in docs]
    s = tokens.Shard(tokens.pack([None if i == 1 else i - 2 for i in range(len(ids))], ids))
    flat = [t for x in docs for t in x]
    assert s.all().tolist() == flat and s.n_tokens == len(flat)
    assert all(s.token(i) == flat[i] for i in range(0, len(flat), 37))
    assert s.doc_ids == [None if i == 1 else i - 2 for i in range(len(ids))]


# ---- 7, 8 -----------------------------------------------------------------------------------


@given(st.lists(st.sampled_from([*"  \n\n\tabZé1½.,'-_", "'s", "'ll", "***", "\x00", "\x1c", "\xa0", "\u3000", "\u0301", "\u0558", "中", "\U0001f600"]), max_size=24).map("".join))
@settings(max_examples=400, deadline=None)
def test_cuts_are_those_of_the_pattern(text):
    import regex

    encoder, pattern = tokens._encoder(tokens.tokenizer_path()), regex.compile(tokens.PATTERN)
    plain = tokens.Encoder.__new__(tokens.Encoder)
    plain.__dict__ = encoder.__dict__ | {"memo": {}, "blanks": {}, "tokenize": lambda p: [type("T", (), {"id": zlib.crc32(p.encode())})]}
    for _ in range(2):  # the second time from what is remembered
        want = [zlib.crc32(p.encode().decode("latin-1").translate(encoder.letters).encode()) for p in pattern.findall(text)]
        assert np.frombuffer(plain.ids(text), np.uint32).tolist() == want


def test_pattern_is_spared_and_common_pieces_stay(docs, monkeypatch):
    encoder, seen = tokens.Encoder(tokens.tokenizer_path()), []
    split = encoder.split
    encoder.split = lambda t: (seen.append(len(t)), split(t))[1]
    prose = " ".join(["The river, as it were, rose.\nNobody Übersah it"] * 200)
    encoder.ids(prose)
    assert sum(seen) < 0.1 * len(prose)
    monkeypatch.setattr(tokens, "MEMO", 30)
    for i in range(100):
        encoder.ids(f"rare{i} x")
    assert " river" in encoder.memo and len(encoder.memo) <= 30


def test_mined_rules_are_those_of_a_plain_count(spark):
    rows = [("http://bad.example.net/en/%d" % i, i % 10 != 0) for i in range(40)] + [("http://good.example.net/en/%d?x=1" % i, i % 10 == 0) for i in range(40)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    labelled = urls.parsed(pages.join(spark.createDataFrame([(u, b) for u, b in rows], "url string, bad boolean"), "url")).withColumn("tokens", urls.tokens())
    mined = urls.mine(labelled.select("tokens", "bad"), 0.05, 0.8).collect()
    baskets = [(set(r.tokens), r.bad) for r in labelled.collect()]
    for r in mined:
        hit = [bad for t, bad in baskets if set(r.tokens) <= t]
        assert r.confidence == pytest.approx(np.mean([b == (r.verdict == "block") for b in hit]))
        assert r.key in r.tokens
    assert {(tuple(r.tokens), r.verdict) for r in mined if r.tokens == ["host bad.example.net"]} == {(("host bad.example.net",), "block")}
    # None is missing: every combination of tokens, held against every page.
    every, want = sorted(set().union(*(t for t, _ in baskets))), {}
    for n in range(1, len(every) + 1):
        for items in itertools.combinations(every, n):
            hit = [bad for t, bad in baskets if set(items) <= t]
            for verdict in ("block", "allow"):
                count = sum(b == (verdict == "block") for b in hit)
                if count >= 0.05 * len(baskets) and count >= 0.8 * len(hit):
                    want[items, verdict] = count / len(hit)
    kept = {(t, v) for (t, v), c in want.items() if not any(set(o) < set(t) and v == w and d >= c for (o, w), d in want.items())}
    assert {(tuple(r.tokens), r.verdict) for r in mined} == kept
    labels = spark.createDataFrame([(i, int(not rows[i][1]), 0) for i in range(40)], "doc_id long, quality int, toxic int")
    bad = spark.createDataFrame([(1, "http://bad.example.net/en/7000"), (2, "http://good.example.com/de/1")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.verdicts(bad.unionByName(pages.limit(40).selectExpr("page_id + 100 as page_id", "url")), labels, min_confidence=0.8).collect()}
    assert got[1] == (None, "block") and got[2] == ("com/de/", "block")


def test_quality_on_held_out(spark):
    big = "/root/testdata/sf0.01"
    rows = queries.op8_quality(spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(r.held_out == quality.held_out(r.doc_id) for r in rows)


# ---- 9, 10, pipeline ----------------------------------------------------------------------------


def plain_hits(texts, items, window=13):
    places = {}
    for name, t in items:
        w = ITEM_WORD.findall(low(t))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            places.setdefault(tuple(w[i : i + n]), []).append((name, w[i:]))
    out = []
    for t in texts:
        w, hit, names, longest = ITEM_WORD.findall(low(t)), set(), set(), [(0, None, None)]
        for n in {len(k) for k in places}:
            for i in range(len(w) - n + 1):
                for name, rest in places.get(tuple(w[i : i + n]), ()):
                    hit.update(range(i, i + n))
                    names.add(name)
                    same = next((k for k, (x, y) in enumerate(zip(rest, w[i:])) if x != y), min(len(rest), len(w) - i))
                    longest.append((-same, name, i))
        n, name, at = min(longest, key=lambda x: (x[0], x[1] or "", x[2] or 0))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w), -n, name, at))
    return out


@pytest.mark.parametrize("limit", [None, 2000])
def test_decontamination(spark, sf, docs, limit):
    bench = ds.dataset(f"{sf}/benchmark.parquet").to_table().to_pandas()
    want = dict(zip(docs.doc_id, plain_hits(docs.text, [(str(i), t) for i, t in zip(bench.item_id, bench.text)])))
    got = decontam.contamination(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"), limit=limit).collect()
    assert {r.doc_id: tuple(None if isinstance(x, float) else x for x in r[1:]) for r in got} == want
    assert any(r.longest_match > 13 for r in got)


def test_longest_matches(spark):
    docs = spark.createDataFrame([(1, "x a b c d e f y"), (2, "a b c d z")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "q a b c d e f g")], "item_id long, text string")
    got = {r.item_word: (r.n_words, r.doc_id, r.doc_word) for r in decontam.longest_matches(docs, items, least=3).collect()}
    assert got[1] == (6, 1, 1) and got[3] == (4, 1, 3)
    passage = " ".join(f"w{i}" for i in range(300))
    found = decontam.longest_matches(spark.createDataFrame([(1, f"x {passage} y"), (2, passage[:500])], "doc_id long, text string"), spark.createDataFrame([(7, passage)], "item_id long, text string"))
    assert found.where("item_word = 0").first().n_words == 300


@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 70))
@settings(max_examples=200, deadline=None)
def test_word_suffixes_are_sorted(ids, depth):
    order = decontam.suffix_order(np.array(ids, np.int64), depth).tolist()
    assert sorted(order) == list(range(len(ids)))
    upto = lambda i: ids[i : i + depth][: ids[i:].index(0) if 0 in ids[i:] else None]
    keys = [upto(i) for i in order]
    assert all(x <= y for x, y in zip(keys, keys[1:]))


def plain_components(docs):
    sets = {}
    for d, t in docs:
        w = WORD.findall(low(t))
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])
    where = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        common = collections.Counter(o for x in s for o in where[x] if o > d)
        for o, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[o]) - n):
                a, b = sorted((root(d), root(o)))
                parent[b] = a
    return {d: (len(sets[d]), root(d)) for d in sets}


def test_near_duplicates(spark, sf, docs):
    got = near_dup.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(zip(docs.doc_id, docs.text))


def test_near_duplicates_in_long_lists(spark, monkeypatch):
    """Groups far over the length of a list that is paired off, in several blocks."""
    monkeypatch.setattr(near_dup, "LONG", 6)
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rng = np.random.default_rng(2)
    base, texts = [f"w{i}" for i in range(90)], []
    for i in range(60):
        w = list(base)
        for k in rng.choice(90, rng.integers(0, 6), replace=False):
            w[k] = f"new{i}x{k}"
        texts.append(" ".join(w))
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [f"{' '.join(f'own{i}y{k}' for k in range(60))} {passage}" for i in range(40)]
    docs = list(enumerate(texts))
    got = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(docs)


def test_rows_that_share_a_doc_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(1, a), (5, a), (5, b), (7, b), (8, b + " more"), (9, None), (9, "x y")], schema)
    assert {(r.doc_id, r.component_id) for r in near_dup.near_duplicates(docs).collect()} == {(1, 1), (5, 1), (7, 1), (8, 1), (9, 9)}
    assert sorted(tuple(r) for r in near_dup.one_of_each(docs).collect()) == [(1, a), (9, None)]
    rows = spark.createDataFrame([(3, ""), (4, a), (4, a), (2, b), (4, "")], schema)
    assert {(r.doc_id, r.component_id) for r in near_dup.near_duplicates(rows).collect()} == {(3, 3), (4, 4), (2, 2)}


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[k] == 100 for k in range(100, 130)) and got[201] == 200
    with pytest.raises(RuntimeError):
        components.components(spark.createDataFrame(links, "a long, b long"), rounds=2)


def test_stages_send_few_rows_and_training_needs_little(spark, sf):
    import corpus_pipeline
    from lorekeep.llm import common

    before = spark.conf.get(common.BATCH_ROWS)
    try:
        for stage in (corpus_pipeline.by_quality, corpus_pipeline.without_benchmarks):
            spark.conf.set(common.BATCH_ROWS, "10000")
            stage(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
            assert int(spark.conf.get(common.BATCH_ROWS)) <= 512
    finally:
        spark.conf.set(common.BATCH_ROWS, before)
    tokens._encoder(tokens.tokenizer_path())
    common.forget()
    assert not tokens._encoders


def test_pipeline(spark, sf, docs, tmp_path):
    import corpus_pipeline as C

    bench = ds.dataset(f"{sf}/benchmark.parquet").to_table().to_pandas()
    now, kept = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in C.STAGES:
        out = stage(spark, now, sf)
        out.write.parquet(str(tmp_path / name.replace(" ", "_")))
        now = spark.read.parquet(str(tmp_path / name.replace(" ", "_")))
        kept.append(now.toPandas())
        if name != C.STAGES[-1][0]:
            assert now.columns == list(docs.columns)
    good, single, clean, mix, ids = kept
    want = plain_components(zip(good.doc_id, good.text))
    assert sorted(single.doc_id) == sorted(d for d, (_, c) in want.items() if d == c)
    verdict = plain_hits(single.text, [(str(i), t) for i, t in zip(bench.item_id, bench.text)])
    assert sorted(clean.doc_id) == sorted(d for d, v in zip(single.doc_id, verdict) if not v[4])
    sizes = clean.assign(n=[len(WORD.findall(t or "")) for t in clean.text]).groupby("source").n.sum().to_dict()
    goal, took = plain_mix(sizes), mix.assign(n=[len(WORD.findall(t or "")) for t in mix.text]).groupby("source").n.sum().to_dict()
    longest = clean.assign(n=[len(WORD.findall(t or "")) for t in clean.text]).groupby("source").n.max().to_dict()
    assert all(abs(took.get(s, 0) - goal[s]) <= longest[s] for s in goal)
    assert sorted(ids.doc_id) == sorted(mix.doc_id) and len(C.run(spark, sf).collect()) == len(ids)
