"""Media columns: progressive JPEG.

``Image`` reads any progressive 8-bit Huffman JPEG of one or three components: the scans,
spectral selection and successive approximation, are accumulated into coefficient arrays,
which are dequantised and inverse-transformed by one matrix product, chroma is repeated
to full resolution, and the result is an RGB tensor.  The restart intervals of a scan, of many files at once, are read
in lockstep, a symbol of each at a time; a file without any is one interval.

``encode_payload`` stores bytes losslessly in such a file of three components, chroma at half the
resolution: a unit of 16 by 16 pixels takes six blocks of 64 bytes, four of Y and one each of Cb and Cr, and a byte b
is the coefficient b - 104.  Every unit of a scan is a restart interval.

    scan 1       DC of all components, all bits but the last
    scans 2-4    coefficients 1 to 5 of each component, all bits but the last
    scans 5-7    coefficients 6 to 63 of each component
    scans 8-10   coefficients 1 to 5, last bit
    scan 11      DC, last bit

Defined results: null and empty texts are one block of zeros; a text of n bytes takes
n / 64 blocks, rounded up, and rows of ``COLUMNS`` units, more of them where the rows would be too many for the format, the last
filled with blocks without coefficients; repeated rows are stored each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeep.llm.common import blocks as grouped
from lorekeep.llm.common import slices, utf8

COLUMNS, MOST_ROWS = 1024, 4095
#: Blocks that are transformed at a time.
CHUNK = 1 << 12
#: Bytes of files or texts that are worked on together.
TOGETHER = 1 << 20
OFFSET = 104
#: Component names with their sampling factors, both ways.
COMPONENTS = ((1, 2), (2, 1), (3, 1))
#: (components, first and last coefficient, bits left before and after the scan)
SCRIPT = (
    ((1, 2, 3), 0, 0, 0, 1),
    *(((c,), 1, 5, 0, 1) for c in (1, 2, 3)),
    *(((c,), 6, 63, 0, 0) for c in (1, 2, 3)),
    *(((c,), 1, 5, 1, 0) for c in (1, 2, 3)),
    ((1, 2, 3), 0, 0, 1, 0),
)


def zigzag() -> np.ndarray:
    """Natural place of each coefficient in zigzag order: diagonals, every other one upwards."""
    cells = [(r, c) for r in range(8) for c in range(8)]
    cells.sort(key=lambda rc: (sum(rc), rc[0] if sum(rc) % 2 else rc[1]))
    return np.array([8 * r + c for r, c in cells])


ZIGZAG = zigzag()


def transform() -> np.ndarray:
    """64 x 64: coefficients in zigzag order times this are the samples of a block."""
    k = np.arange(8)
    basis = np.cos((2 * k[None, :] + 1) * k[:, None] * np.pi / 16) / 2
    basis[0] /= np.sqrt(2)
    return np.kron(basis, basis)[ZIGZAG]


TRANSFORM = transform()


# ---- Huffman codes -----------------------------------------------------------------------------


class Huffman:
    """A canonical code as the format states it: how many codes of 1 to 16 bits there are, and their symbols in order."""

    def __init__(self, counts: bytes, symbols: bytes):
        self.counts, self.symbols = counts, symbols
        self.code, self.bits = np.zeros(256, np.uint64), np.zeros(256, np.int64)
        #: Symbol and length by the next 16 bits; length 0: no code.
        self.by_bits, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        code, k = 0, 0
        for n, count in enumerate(counts, 1):
            for s in symbols[k : k + count]:
                self.code[s], self.bits[s] = code, n
                span = slice(code << (16 - n), (code + 1) << (16 - n))
                self.by_bits[span], self.length[span] = s, n
                code += 1
            code, k = code << 1, k + count

    @classmethod
    def of(cls, weights: dict[int, float]) -> Huffman:
        """The code for symbols of these weights; no code is all ones, and none is longer than 16 bits."""
        while True:
            heap = [(w, i, (s,)) for i, (s, w) in enumerate([*weights.items(), (None, 0.0)])]
            heapq.heapify(heap)
            depth = dict.fromkeys([*weights, None], 0)
            while len(heap) > 1:
                (v, i, x), (w, _, y) = heapq.heappop(heap), heapq.heappop(heap)
                for s in x + y:
                    depth[s] += 1
                heapq.heappush(heap, (v + w, i, x + y))
            if max(depth.values()) <= 16:
                break
            weights = {s: w + max(weights.values()) / 1024 for s, w in weights.items()}
        # The symbol that doesn't exist has one of the longest codes: it is put last, which is all ones, and left out.
        order = sorted((n, s) for s, n in depth.items() if s is not None)
        return cls(bytes(sum(n == k for n, _ in order) for k in range(1, 17)), bytes(s for _, s in order))

    def segment(self, kind: int) -> bytes:
        return segment(0xC4, bytes([kind]) + self.counts + self.symbols)


def segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


#: Codes by a rule: a size of s bits weighs most at 5 to 6 bits, as letters do; each zero before it halves the weight.
_WEIGHT = [8.0, 1, 1, 2, 4, 16, 24, 16, 8, 1, 0.25]
DC_CODE = Huffman.of(dict(enumerate(_WEIGHT)))
AC_CODE = Huffman.of({0: 6.0, 0xF0: 0.05} | {run << 4 | size: _WEIGHT[size] / 2.0**run for run in range(16) for size in range(1, 11)})


# ---- writing a payload -------------------------------------------------------------------------


def sized(v: np.ndarray) -> np.ndarray:
    """Bits of each number's magnitude."""
    return np.frexp(np.abs(v).astype(np.float32))[1].astype(np.int64)


def low_bits(v: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bits that state a number of so many bits: itself, or one less if it's negative."""
    return np.where(v > 0, v, v + (1 << size) - 1).astype(np.uint64)


def layout(blocks: int) -> tuple[int, int]:
    """Rows and columns of units for so many blocks."""
    units = -(-blocks // 6)
    columns = min(units, max(COLUMNS, -(-units // MOST_ROWS)))
    return -(-units // columns), columns


def first_fields(v: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A band of each block in a first scan: (block, value, bits) of every field, in order."""
    q = np.sign(v) * (np.abs(v) >> low)
    row, col = np.nonzero(q)
    value = q[row, col].astype(np.int64)
    before = np.full(len(col), -1)
    before[1:] = np.where(row[1:] == row[:-1], col[:-1], -1)
    run, size = col - before - 1, sized(value)
    symbol = (run & 15) << 4 | size
    out, bits = AC_CODE.code[symbol] << size.astype(np.uint64) | low_bits(value, size), AC_CODE.bits[symbol] + size
    for k in range(3):  # sixteen zeros are a symbol of their own, at most three times in a band
        more = run >= 16 * (k + 1)
        out[more] |= AC_CODE.code[0xF0] << bits[more].astype(np.uint64)
        bits[more] += AC_CODE.bits[0xF0]
    last = np.full(len(v), -1)
    last[row] = col
    ends = np.flatnonzero(last < v.shape[1] - 1)
    row, out, bits = np.concatenate((row, ends)), np.concatenate((out, np.full(len(ends), AC_CODE.code[0]))), np.concatenate((bits, np.full(len(ends), AC_CODE.bits[0])))
    order = np.argsort(row, kind="stable")
    return row[order], out[order], bits[order]


def last_fields(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The last bit of a band of under 16 coefficients of each block: of those known, and those of magnitude 1, which are new."""
    size, (n, width) = np.abs(v), v.shape
    new, known = size == 1, size > 1
    # A symbol is followed by the bits of the known coefficients before its own; what is left follows an end of block.
    part = np.cumsum(new, axis=1) - new
    zeros = np.cumsum(size == 0, axis=1)
    row, col = np.nonzero(new)
    since = np.zeros(len(col), np.int64)
    since[1:] = np.where(row[1:] == row[:-1], zeros[row[:-1], col[:-1]], 0)
    symbol = (zeros[row, col] - since) << 4 | 1
    rows, parts, kinds = [row], [part[row, col]], [np.zeros(len(row), np.int64)]
    values, bits = [AC_CODE.code[symbol] << np.uint64(1) | (v[row, col] > 0).astype(np.uint64)], [AC_CODE.bits[symbol] + 1]
    last = np.full(n, -1)
    last[row] = col
    ends = np.flatnonzero(last < width - 1)
    rows.append(ends), parts.append(np.full(len(ends), width)), kinds.append(np.zeros(len(ends), np.int64))
    values.append(np.full(len(ends), AC_CODE.code[0])), bits.append(np.full(len(ends), AC_CODE.bits[0]))
    row, col = np.nonzero(known)
    rows.append(row), parts.append(np.where(col > last[row], width, part[row, col])), kinds.append(col + 1)
    values.append((size[row, col] & 1).astype(np.uint64)), bits.append(np.ones(len(row), np.int64))
    row = np.concatenate(rows)
    order = np.lexsort((np.concatenate(kinds), np.concatenate(parts), row))
    return row[order], np.concatenate(values)[order], np.concatenate(bits)[order]


def dc_fields(v: np.ndarray, high: int, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """DC coefficients, units x 6, of all components."""
    unit = np.repeat(np.arange(len(v)), 6)
    if high:
        return unit, (v.ravel() & 1).astype(np.uint64), np.ones(v.size, np.int64)
    diff = (v >> low).astype(np.int64)
    diff[:, 1:4] -= diff[:, 0:3].copy()
    diff = diff.ravel()
    size = sized(diff)
    return unit, DC_CODE.code[size] << size.astype(np.uint64) | low_bits(diff, size), DC_CODE.bits[size] + size


def put(out: np.ndarray, at: np.ndarray, value: np.ndarray, bits: np.ndarray) -> None:
    """Add numbers of 1 to 64 bits to words of 64, from bit ``at`` on; places ascend and don't overlap."""
    if not len(at):
        return
    word, over = at >> 6, (at & 63) + bits - 64
    part = np.where(over > 0, value >> np.maximum(over, 0).astype(np.uint64), value << np.maximum(-over, 0).astype(np.uint64))
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    out[word[first]] |= np.bitwise_or.reduceat(part, first)
    # What goes on into the next word; only one number of a word does.
    more = over > 0
    out[word[more] + 1] |= value[more] << (64 - over[more]).astype(np.uint64)


def intervals(lane: np.ndarray, value: np.ndarray, bits: np.ndarray, lanes: np.ndarray) -> list[bytes]:
    """The fields of consecutive lanes as scans of ``lanes`` restart intervals each: filled up with ones, stuffed, with markers between."""
    n = int(lanes.sum())
    taken = np.bincount(lane, bits, n).astype(np.int64)
    sizes = (taken + 7) >> 3
    begin = (np.cumsum(sizes) - sizes) << 3
    upto = np.cumsum(bits) - bits
    at = begin[lane] + upto - (np.cumsum(taken) - taken)[lane]
    out = np.zeros((int(sizes.sum()) >> 3) + 2, np.uint64)
    put(out, at, value, bits)
    fill = -taken & 7
    some = fill > 0
    put(out, (begin + taken)[some], ((1 << fill[some]) - 1).astype(np.uint64), fill[some])
    raw = out.astype(">u8").view(np.uint8)[: int(sizes.sum())]
    # A zero follows each byte of 255, a marker each interval but a scan's last.
    first = np.cumsum(lanes) - lanes
    number = np.arange(n) - np.repeat(first, lanes)
    final = np.zeros(n, bool)
    final[np.cumsum(lanes) - 1] = True
    owner = np.repeat(np.arange(n), sizes)
    place = np.arange(len(raw)) + np.cumsum(raw == 0xFF) - (raw == 0xFF) + 2 * (number + np.repeat(np.cumsum(lanes - 1) - (lanes - 1), lanes))[owner]
    out = np.zeros(len(raw) + int((raw == 0xFF).sum()) + 2 * int((lanes - 1).sum()), np.uint8)
    out[place] = raw
    ends = np.cumsum(sizes) - 1
    behind = place[ends] + 1 + (raw[ends] == 0xFF)
    out[behind[~final]] = 0xFF
    out[behind[~final] + 1] = 0xD0 + number[~final] % 8
    return [out[a:b].tobytes() for a, b in zip([0, *behind[final][:-1].tolist()], behind[final].tolist(), strict=True)]


def encode_payloads(payloads: Sequence[bytes]) -> list[bytes]:
    """For each payload, whose length is a positive multiple of 64, a progressive JPEG that holds it."""
    sizes = np.array([len(p) // 64 for p in payloads])
    shapes = [layout(n) for n in sizes.tolist()]
    units = np.array([r * c for r, c in shapes])
    v = np.zeros((int(units.sum()) * 6, 64), np.int16)
    begin = (np.cumsum(units) - units) * 6
    v[np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))] = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, 64).astype(np.int16) - OFFSET
    v = v.reshape(-1, 6, 64)
    # Blocks of a scan of one component go by rows of the component, not by units.
    luma = [raster(r, c) + 4 * o for (r, c), o in zip(shapes, (np.cumsum(units) - units).tolist(), strict=True)]
    by_component = {1: v[:, :4].reshape(-1, 64)[np.concatenate(luma)], 2: v[:, 4], 3: v[:, 5]}
    out = []
    for p, (rows, columns) in zip(payloads, shapes, strict=True):
        frame = struct.pack(">BHHB", 8, 16 * rows, 16 * columns, 3) + b"".join(bytes([c, h << 4 | h, 0]) for c, h in COMPONENTS)
        out.append([b"\xff\xd8", segment(0xFE, b"payload %d" % len(p)), segment(0xDB, bytes([0, *[1] * 64])), segment(0xC2, frame), DC_CODE.segment(0x00), AC_CODE.segment(0x10), segment(0xDD, struct.pack(">H", 1))])
    for names, start, end, high, low in SCRIPT:
        if start == 0:
            fields, lanes = dc_fields(v[:, :, 0], high, low), units
        else:
            band, lanes = by_component[names[0]][:, start : end + 1].astype(np.int64), units * (4 if names[0] == 1 else 1)
            fields = last_fields(band) if high else first_fields(band, low)
        header = segment(0xDA, bytes([len(names), *(x for c in names for x in (c, 0)), start, end, high << 4 | low]))
        for parts, data in zip(out, intervals(*fields, lanes), strict=True):
            parts += [header, data]
    return [b"".join([*parts, b"\xff\xd9"]) for parts in out]


def encode_payload(payload: bytes) -> bytes:
    return encode_payloads([payload])[0]


def raster(rows: int, columns: int) -> np.ndarray:
    """Where the luma blocks of an image, row by row, are among those of its units."""
    y, x = np.arange(2 * rows)[:, None], np.arange(2 * columns)[None, :]
    return (((y >> 1) * columns + (x >> 1)) * 4 + (y & 1) * 2 + (x & 1)).ravel()


# ---- reading ---------------------------------------------------------------------------------------


class Component:
    def __init__(self, name: int, sampling: int, table: int):
        self.name, self.h, self.v, self.table = name, sampling >> 4, sampling & 15, table
        self.rows = self.columns = self.real_rows = self.real_columns = 0
        self.blocks: np.ndarray


class Scan:
    """One scan of a file: what it states, and for each restart interval the blocks of its components in order."""

    def __init__(self, image: Image, header: bytes, data: bytes):
        n = header[0]
        picked = [(next(c for c in image.components if c.name == header[1 + 2 * i]), header[2 + 2 * i]) for i in range(n)]
        self.start, self.end, approx = header[1 + 2 * n : 4 + 2 * n]
        self.high, self.low, self.data = approx >> 4, approx & 15, data
        if n == 1:
            c = picked[0][0]
            order = (np.arange(c.real_rows)[:, None] * c.columns + np.arange(c.real_columns)).reshape(-1, 1)
            self.parts = [(c, order)]
        else:
            unit = np.arange(image.units[0] * image.units[1])
            y, x = np.divmod(unit, image.units[1])
            self.parts = [(c, ((y * c.v)[:, None, None] + np.arange(c.v)[:, None]) * c.columns + (x * c.h)[:, None, None] + np.arange(c.h)) for c, _ in picked]
            self.parts = [(c, b.reshape(len(unit), -1)) for c, b in self.parts]
        self.tables = [None if self.high and not self.start else image.tables.get((t & 15) | 0x10 if self.start else t >> 4) for _, t in picked]
        if not self.high or self.start:
            if any(t is None for t in self.tables):
                raise ValueError("a scan without its Huffman table")
        if any(len(b) == 0 for _, b in self.parts):
            raise ValueError("a scan without blocks")
        self.units = len(self.parts[0][1])
        self.step = image.restart or self.units

    def kind(self) -> tuple:
        """Scans of one kind are read together."""
        tables = tuple((t.counts, t.symbols) if t else None for t in self.tables)
        return self.start, self.end, self.high, self.low, min(self.step, self.units), tuple(b.shape[1] for _, b in self.parts), tables


class Image:
    """A parsed file: coefficient arrays (blocks x 64, zigzag order) of each component, comments, quantisers."""

    def __init__(self, data: bytes, read: bool = True):
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        self.comments: list[bytes] = []
        self.quantisers: dict[int, np.ndarray] = {}
        self.tables: dict[int, Huffman] = {}
        self.components: list[Component] = []
        self.scans: list[Scan] = []
        self.restart = 0
        at = 2
        while at + 4 <= len(data):
            marker = data[at + 1]
            if data[at] != 0xFF:
                raise ValueError("a marker is missing")
            if marker == 0xD9:
                break
            (size,) = struct.unpack_from(">H", data, at + 2)
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDA:
                end = self._end(data, at)
                self.scans.append(Scan(self, body, data[at:end]))
                at = end
            else:
                self._segment(marker, body)
        if read:
            read_scans([self])

    @staticmethod
    def _end(data: bytes, at: int) -> int:
        while True:
            at = data.find(b"\xff", at)
            if at < 0:
                return len(data)
            if at + 1 < len(data) and (data[at + 1] == 0 or 0xD0 <= data[at + 1] <= 0xD7):
                at += 2
            else:
                return at

    def _segment(self, marker: int, body: bytes) -> None:
        if marker == 0xFE:
            self.comments.append(body)
        elif marker == 0xDD:
            (self.restart,) = struct.unpack(">H", body)
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                self.quantisers[body[0] & 15] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, 1).astype(np.float32)
                body = body[129 if wide else 65 :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                self.tables[body[0]] = known_code(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xC2:
            bits, self.height, self.width, n = struct.unpack_from(">BHHB", body)
            if bits != 8 or n not in (1, 3):
                raise ValueError("only 8-bit images of one or three components are read")
            self.components = [Component(*body[6 + 3 * i : 9 + 3 * i]) for i in range(n)]
            if n == 1:
                self.components[0].h = self.components[0].v = 1
            self.h, self.v = max(c.h for c in self.components), max(c.v for c in self.components)
            self.units = (-(-self.height // (8 * self.v)), -(-self.width // (8 * self.h)))
            for c in self.components:
                c.rows, c.columns = self.units[0] * c.v, self.units[1] * c.h
                c.real_rows, c.real_columns = -(-self.height * c.v // (8 * self.v)), -(-self.width * c.h // (8 * self.h))
                c.blocks = np.zeros((c.rows * c.columns, 64), np.int16)
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("only progressive Huffman files are read")

    def planes(self) -> Iterator[np.ndarray]:
        """Samples of each component at full resolution, chroma repeated, before the colour transform."""
        for c in self.components:
            x = np.empty((len(c.blocks), 64), np.float32)
            q = self.quantisers[c.table]
            for i in range(0, len(x), CHUNK):
                # Rounded once to single precision, so that what lies halfway doesn't hang on the order of the sums.
                x[i : i + CHUNK] = (c.blocks[i : i + CHUNK] * q) @ TRANSFORM + 128
            x = np.clip(np.rint(x), 0, 255).astype(np.uint8)
            x = x.reshape(c.rows, c.columns, 8, 8).transpose(0, 2, 1, 3).reshape(8 * c.rows, 8 * c.columns)
            if (c.v, c.h) != (self.v, self.h):
                x = x.repeat(self.v // c.v, axis=0).repeat(self.h // c.h, axis=1)
            yield x[: self.height, : self.width]

    def rgb(self) -> np.ndarray:
        """height x width x 3, 8 bits."""
        planes = list(self.planes())
        if len(planes) == 1:
            return np.broadcast_to(planes[0][:, :, None], (*planes[0].shape, 3))
        y, cb, cr = (p.astype(np.float32) for p in planes)
        cb, cr = cb - 128, cr - 128
        # The colour transform of JFIF files.
        out = np.stack((y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb), axis=2)
        return np.clip(np.rint(out), 0, 255).astype(np.uint8)



_codes: dict[tuple[bytes, bytes], Huffman] = {(h.counts, h.symbols): h for h in (DC_CODE, AC_CODE)}


def known_code(counts: bytes, symbols: bytes) -> Huffman:
    """The code of a file; the two that payloads are written with are kept."""
    return _codes.get((counts, symbols)) or Huffman(counts, symbols)


def read_scans(images: Sequence[Image]) -> None:
    """Accumulate the scans of all images into their coefficients; those of one kind at the same place of their files together."""
    for i in range(max((len(x.scans) for x in images), default=0)):
        kinds: dict[tuple, list[Scan]] = {}
        for x in images:
            if i < len(x.scans):
                kinds.setdefault(x.scans[i].kind(), []).append(x.scans[i])
        for scans in kinds.values():
            Lanes(scans).read()
    for x in images:
        x.scans.clear()


class Lanes:
    """The restart intervals of scans of one kind, read in lockstep."""

    def __init__(self, scans: list[Scan]):
        self.scan = scans[0]
        raw = np.frombuffer(b"".join(s.data for s in scans), np.uint8)
        begins = np.cumsum([0, *(len(s.data) for s in scans[:-1])])
        after = np.zeros(len(raw), bool)
        after[1:] = raw[:-1] == 0xFF
        after[begins[begins < len(raw)]] = False
        marker = after & (raw >= 0xD0) & (raw <= 0xD7)
        drop = marker | (after & (raw == 0))
        drop[:-1] |= marker[1:]
        kept = np.concatenate(([0], np.cumsum(~drop)))
        flat = np.concatenate((raw[~drop], np.full(16, 0xFF, np.uint8))).astype(np.uint64)
        #: The 32 bits from each byte on.
        self.word = flat[:-3] << np.uint64(24) | flat[1:-2] << np.uint64(16) | flat[2:-1] << np.uint64(8) | flat[3:]
        # Each scan's intervals begin where it does and after each of its markers.
        owner = np.searchsorted(begins, np.flatnonzero(marker), "right") - 1
        want = [-(-s.units // s.step) for s in scans]
        found = np.bincount(owner, minlength=len(scans)) + 1
        if (found != want).any():
            raise ValueError("a scan without all of its restart intervals")
        starts = np.sort(np.concatenate((begins, np.flatnonzero(marker) + 1)), kind="stable")
        self.at = kept[starts] << 3
        self.stop = np.append(self.at[1:], kept[-1] << 3)
        # Coefficients of all scans one below the other, and each lane's blocks by unit.
        self.targets: list[tuple[np.ndarray, list[np.ndarray]]] = []
        self.step = min(self.scan.step, self.scan.units)
        self.units: list[np.ndarray] = []
        for part in range(len(self.scan.parts)):
            offset, places = 0, []
            for s in scans:
                c, b = s.parts[part]
                fill = -len(b) % self.step
                places.append(np.concatenate((b + offset, np.full((fill, b.shape[1]), -1))).reshape(-1, self.step, b.shape[1]))
                offset += len(c.blocks)
            self.units.append(np.concatenate(places))
            self.targets.append((np.concatenate([s.parts[part][0].blocks for s in scans]), [s.parts[part][0].blocks for s in scans]))

    def peek(self, lanes: np.ndarray) -> np.ndarray:
        """The next 16 bits."""
        at = np.minimum(self.at[lanes], (len(self.word) - 1) << 3)
        return (self.word[at >> 3] >> (16 - (at & 7)).astype(np.uint64)).astype(np.int64) & 0xFFFF

    def take(self, lanes: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The next ``n`` bits, at most 16, as a number."""
        out = self.peek(lanes) >> (16 - n)
        self.at[lanes] += n
        return out

    def bit(self, lanes: np.ndarray) -> np.ndarray:
        at = self.at[lanes]
        self.at[lanes] = at + 1
        at = np.minimum(at, (len(self.word) - 1) << 3)
        return (self.word[at >> 3] >> (31 - (at & 7)).astype(np.uint64)).astype(np.int64) & 1

    def symbol(self, lanes: np.ndarray, h: Huffman) -> np.ndarray:
        seen = self.peek(lanes)
        n = h.length[seen]
        if (n == 0).any():
            raise ValueError("a Huffman code that the table doesn't have")
        self.at[lanes] += n
        return h.by_bits[seen]

    def signed(self, lanes: np.ndarray, size: np.ndarray) -> np.ndarray:
        v = self.take(lanes, size)
        return np.where((size > 0) & (v >> np.maximum(size - 1, 0) == 0), v - (1 << size) + 1, v)

    def read(self) -> None:
        s = self.scan
        waiting = np.zeros(len(self.at), np.int64)
        previous = [np.zeros(len(self.at), np.int64) for _ in self.units]
        for u in range(self.step):
            for (blocks, _), units, h, last in zip(self.targets, self.units, s.tables, previous, strict=True):
                for k in range(units.shape[2]):
                    lanes = np.flatnonzero(units[:, u, k] >= 0)
                    if s.start == 0:
                        self._dc(lanes, blocks, units[lanes, u, k], h, last)
                    elif s.high:
                        self._refine(lanes, blocks, units[:, u, k], h, waiting)
                    else:
                        self._first(lanes, blocks, units[:, u, k], h, waiting)
        if (self.at > self.stop).any():
            raise ValueError("a scan ends early")
        for all_, own in self.targets:
            done = 0
            for blocks in own:
                blocks[:] = all_[done : done + len(blocks)]
                done += len(blocks)

    def _dc(self, lanes: np.ndarray, blocks: np.ndarray, place: np.ndarray, h: Huffman | None, last: np.ndarray) -> None:
        if self.scan.high:
            blocks[place, 0] |= (self.bit(lanes) << self.scan.low).astype(np.int16)
        else:
            last[lanes] += self.signed(lanes, np.minimum(self.symbol(lanes, h), 15))
            blocks[place, 0] = last[lanes] << self.scan.low

    def _blocks_to_wait(self, lanes: np.ndarray, zeros: np.ndarray, waiting: np.ndarray) -> None:
        waiting[lanes] = (1 << zeros) + self.take(lanes, zeros) - 1

    def _first(self, lanes: np.ndarray, blocks: np.ndarray, place: np.ndarray, h: Huffman, waiting: np.ndarray) -> None:
        """First pass over a band of a block; lanes that wait have nothing more for so many blocks."""
        idle = waiting[lanes] > 0
        waiting[lanes[idle]] -= 1
        lanes = lanes[~idle]
        k = np.full(len(lanes), self.scan.start)
        while len(lanes):
            zeros, size = np.divmod(self.symbol(lanes, h), 16)
            over = (size == 0) & (zeros < 15)
            if over.any():
                self._blocks_to_wait(lanes[over], zeros[over], waiting)
                lanes, k, zeros, size = lanes[~over], k[~over], zeros[~over], size[~over]
            k = k + zeros + (size == 0)
            some = np.flatnonzero(size)
            if (k[some] > self.scan.end).any():
                raise ValueError("a coefficient outside its band")
            blocks[place[lanes[some]], k[some]] = self.signed(lanes[some], size[some]) << self.scan.low
            k[some] += 1
            more = k <= self.scan.end
            lanes, k = lanes[more], k[more]

    def _correct(self, lanes: np.ndarray, blocks: np.ndarray, place: np.ndarray, k: np.ndarray) -> None:
        """A further bit of known coefficients."""
        old = blocks[place[lanes], k]
        bit = 1 << self.scan.low
        more = (self.bit(lanes) == 1) & (np.abs(old) & bit == 0)
        blocks[place[lanes], k] = old + np.where(more, np.where(old > 0, bit, -bit), 0)

    def _refine(self, lanes: np.ndarray, blocks: np.ndarray, place: np.ndarray, h: Huffman, waiting: np.ndarray) -> None:
        """A further bit of a band of a block: of its coefficients, and new ones."""
        end, bit = self.scan.end, 1 << self.scan.low
        k = np.full(len(self.at), self.scan.start)
        resting = lanes[waiting[lanes] > 0]
        lanes = lanes[waiting[lanes] == 0]
        while len(lanes):
            zeros, size = np.divmod(self.symbol(lanes, h), 16)
            over = (size == 0) & (zeros < 15)
            if over.any():
                # The block itself is one of those that have nothing new.
                self._blocks_to_wait(lanes[over], zeros[over], waiting)
                waiting[lanes[over]] += 1
                resting = np.concatenate((resting, lanes[over]))
                lanes, zeros, size = lanes[~over], zeros[~over], size[~over]
            value = np.zeros(len(lanes), np.int64)
            new = np.flatnonzero(size)
            value[new] = np.where(self.bit(lanes[new]) == 1, bit, -bit)
            walking, left = np.arange(len(lanes)), zeros.copy()
            while len(walking):
                here = lanes[walking]
                old = blocks[place[here], k[here]] != 0
                if old.any():
                    self._correct(here[old], blocks, place, k[here[old]])
                put = walking[~old & (left[walking] == 0)]
                blocks[place[lanes[put]], k[lanes[put]]] = value[put]
                left[walking[~old]] -= 1
                k[here] += 1
                walking = walking[(left[walking] >= 0) & (k[here] <= end)]
            lanes = lanes[k[lanes] <= end]
        waiting[resting] -= 1
        while len(resting := resting[k[resting] <= end]):
            old = resting[blocks[place[resting], k[resting]] != 0]
            if len(old):
                self._correct(old, blocks, place, k[old])
            k[resting] += 1


def decode(data: bytes) -> np.ndarray:
    """The full-resolution RGB tensor of a progressive JPEG."""
    return Image(data).rgb()


def read_payload(image: Image) -> bytes:
    """What ``encode_payload`` stored."""
    (size,) = (int(c.split()[1]) for c in image.comments if c.startswith(b"payload "))
    y, cb, cr = (c.blocks for c in image.components)
    rows, columns = image.units
    luma = np.empty_like(y)
    luma[raster(rows, columns)] = y
    out = np.concatenate((luma.reshape(-1, 4, 64), cb[:, None], cr[:, None]), axis=1)
    return (out + OFFSET).astype(np.uint8).tobytes()[:size]


# ---- columns ------------------------------------------------------------------------------------------


def features(rgb: np.ndarray) -> str:
    """Whole-number statistics of a tensor: size, sums by channel, squares, steps between neighbours, extremes."""
    level = np.arange(256)
    counts = [np.bincount(rgb[:, :, k].ravel(), minlength=256) for k in range(3 if rgb.strides[2] else 1)]
    counts = [counts[k % len(counts)] for k in range(3)]
    x = rgb[:, :, 0].astype(np.int16)
    across, down = (int(np.abs(np.diff(x, axis=k)).sum(dtype=np.int64)) for k in (1, 0))
    return ";".join(map(str, (*rgb.shape[:2], *(int(c @ level) for c in counts), int(counts[0] @ level**2), across, down, counts[0][255], counts[0][0])))


def stored(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each text, filled up with zeros, as the bytes of a file."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            bodies = part["body"].to_pylist()
            padded = [x + bytes(-len(x) % 64 if x else 64) for x in bodies]
            media = [m for some in grouped(padded, limit=TOGETHER) for m in encode_payloads(some)]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([len(x) for x in bodies], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return d.mapInArrow(run, "doc_id long, n_bytes long, media binary")


def described(media: DataFrame) -> DataFrame:
    """Read stored payloads back: their digests and the features of the decoded tensors."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for some in grouped(b["media"].to_pylist(), limit=TOGETHER):
                images = [Image(x, read=False) for x in some]
                read_scans(images)
                for x, image in zip(some, images, strict=True):
                    p = read_payload(image)
                    rows.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(x), hashlib.sha256(x).hexdigest(), features(image.rgb())))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["n_bytes"], *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[2:], strict=True))], schema=schema)

    return media.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def tensors(media: DataFrame, column: str = "media", id_column: str = "doc_id") -> DataFrame:
    """(id, height, width, rgb, error) of a column of progressive JPEGs; a file that can't be read has an error and no tensor."""
    schema = pa.schema([("id", pa.int64()), ("height", pa.int32()), ("width", pa.int32()), ("rgb", pa.binary()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, x in zip(b["id"].to_pylist(), b["media"], strict=True):
                try:
                    t = decode(x.as_py() or b"")
                    row = {"id": i, "height": t.shape[0], "width": t.shape[1], "rgb": t.tobytes(), "error": None}
                except (ValueError, KeyError, struct.error, StopIteration, AttributeError, IndexError) as e:
                    row = {"id": i, "height": None, "width": None, "rgb": None, "error": str(e) or type(e).__name__}
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    return media.select(F.col(id_column).cast("long").alias("id"), F.col(column).alias("media")).mapInArrow(run, "id long, height int, width int, rgb binary, error string")
