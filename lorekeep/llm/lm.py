"""Language-model scoring by online logistic context mixing.

A text is coded symbol by symbol (its bytes, then one end), a symbol as the binary
decisions of the prefix code of the byte before it; the codes are made from the corpus's counts of byte pairs.
Several predictors give a probability for every decision: hashed contexts of the last ``ORDERS`` bytes, and of the
word so far.  Their counts are gathered over all training documents.  A mixer combines the
predictors' logits with weights chosen, for every decision, by a gate (the number of contexts in which
the corpus has shown that decision); an adaptive map from the mixed logit to a probability refines the
result.  The sum of the logarithms is the score.

Weights and map belong to a text and adapt from its first byte to its last; nothing starts anew inside it.
They move along the gradient of the coding cost after the first ``FIRST`` symbols, and then whenever the text has
grown by ``GROWTH`` of itself: small steps while they have much to learn, long ones later.
Thousands of texts advance in lockstep, a step of all of them as one slice of the arrays.  A score
depends on nothing but the text and the corpus counts.

Logits are kept as seen from the decision that is taken: the mixed one then says how likely that decision was,
and the map, which treats a 0 and a 1 alike, is one of the favoured side's probability.

What is counted grows with the corpus: a number for every distinct pair of context and symbol.
Equal texts are counted and scored once, with the number of their rows.  Texts are dealt by digest into buckets of about
``BUCKET`` bytes.  A bucket sends its pairs and its words, cut into ranges of their hashes; what all buckets
sent of a range is summed, and each bucket gets back the logits of its own pairs, and the counts of its own
words for the base score.

Defined results: null and empty texts have no words and one end; rows with a null doc_id are
held out and not learnt from; repeated rows are learnt from as often as they occur and get one score; without
training documents all counts are 0; other columns are ignored.  Words are told apart
by 64-bit hashes, contexts by the bits that ``context_bits`` gives a corpus of its size, texts by their MD5.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeep.llm.common import U64, Words, blocks, distinct, materialize, powers, prefix_hash, release, utf8

FOLDS, HELD_OUT = 7, 2
END = 256
#: Stands before a text: in no UTF-8 text.
BEFORE = 0xFF
#: Lengths in bytes of the contexts; one more is the word so far.
ORDERS = (3, 6)
PREDICTORS = len(ORDERS) + 1
#: The predictors whose contexts have three bytes, so that few are distinct: sorted as they are, hashed when they are distinct.
SHORT = [m for m, n in enumerate(ORDERS) if n == 3]
#: Bytes of text, and pairs of context and symbol, that are worked on at once.
LANES, PIECE = 1 << 19, 1 << 18
#: Symbols whose decisions are prepared at once, unless a step has more.
AHEAD = 1 << 13
#: Bytes of text whose pairs are made at once, and sorted at once, to be counted.
FEW, RUN = 1 << 16, 1 << 21
#: Symbols before the weights move for the first time, and the part of itself that a text grows by between later moves.
FIRST, GROWTH = 8, 1 / 24
BUCKET = 12 << 20
RATE, RATE_POWER = 0.02, 0.75
MAP_STEPS, MAP_SPAN, MAP_RATE = 17, 8.0, 0.02
#: Logits are whole numbers of this part.
UNIT = 15
#: Counts that an unseen decision is given.
PRIOR = 0.4
GATES = PREDICTORS + 1
#: The weight of the contexts at the start of a text, by gate: the number of contexts that know the decision.
START = (0.3, 0.5, 0.45, 0.4)
#: The last bits of a pair: the byte before, and the symbol.
CODE_BITS = 18


def words_of(buf: np.ndarray) -> np.ndarray:
    """For every place of ``buf`` a hash of the word that ends before it."""
    at = np.arange(len(buf))
    gap = (buf == 0x20) | ((buf >= 0x09) & (buf <= 0x0D)) | (buf == BEFORE)
    start = np.zeros(len(buf), np.int64)
    start[1:] = np.where(gap[:-1], at[1:], 0)
    start = np.maximum.accumulate(start)
    p, inv = prefix_hash(buf), powers(len(buf) + 1)[1]
    with np.errstate(over="ignore"):
        return (p[:-1] - p.take(start, mode="clip")) * inv.take(start, mode="clip")


class Code:
    """For every byte before (or BEFORE) a prefix code of the 257 symbols: the tree nodes passed and the bits taken.

    A symbol after a byte is the number ``byte << 9 | symbol``.
    """

    def __init__(self, counts: np.ndarray):
        """counts: 256 x 257, of symbols after bytes."""
        every = counts.sum(axis=0)
        common = 64 * every // max(1, int(every.sum())) + 1
        self.length, self.base = np.zeros(1 << CODE_BITS, np.int64), np.zeros(1 << CODE_BITS, np.int64)
        nodes: list[int] = []
        bits: list[int] = []
        plain = None
        for before in range(256):
            if plain is None or counts[before].any():
                paths = self._paths((64 * counts[before] + common).tolist())
            else:
                paths = plain
            if not counts[before].any():
                plain = paths
            for s, path in enumerate(paths):
                self.length[before << 9 | s], self.base[before << 9 | s] = len(path), len(nodes)
                nodes += [n for n, _ in path]
                bits += [b for _, b in path]
        self.tree, self.sign = np.array(nodes, np.int16), np.where(np.array(bits) == 1, 1, -1).astype(np.int8)

    @staticmethod
    def _paths(counts: list[int]) -> list[list[tuple[int, int]]]:
        heap = [(n, i, i) for i, n in enumerate(counts)]
        heapq.heapify(heap)
        child: dict[int, tuple[int, int]] = {}
        nodes = END + 1
        while len(heap) > 1:
            (n, _, a), (m, _, b) = heapq.heappop(heap), heapq.heappop(heap)
            child[nodes] = (a, b)
            heapq.heappush(heap, (n + m, nodes, nodes))
            nodes += 1
        paths: list[list[tuple[int, int]]] = [[] for _ in range(END + 1)]
        stack = [(heap[0][2], [])]
        while stack:
            node, path = stack.pop()
            if node in child:
                stack += [(c, [*path, (node - END - 1, bit)]) for bit, c in enumerate(child[node])]
            else:
                paths[node] = path
        return paths


def byte_pairs(texts: list[bytes]) -> np.ndarray:
    """256 x 257 counts of symbols after bytes."""
    counts = np.zeros((256, END + 1), np.int64)
    for some in blocks(texts, limit=FEW):
        buf = np.frombuffer(bytes([BEFORE]).join([b"", *some, b""]), np.uint8)
        pairs = buf[:-1].astype(np.int64)
        pairs <<= 8
        pairs |= buf[1:]
        counts[:, :END] += np.bincount(pairs, minlength=1 << 16).reshape(256, 256)
        # Where a text ends stands the byte before the next one.
        last = np.bincount(buf[np.cumsum([len(t) + 1 for t in some]) - 1], minlength=256)
        counts[:, BEFORE] -= last
        counts[:, END] += last
    return counts


class Symbols:
    """The symbols of a block of texts, each text with its end: ``after``, the byte before and the symbol; ``ends``, where each text ends."""

    def __init__(self, texts: list[bytes]):
        pad = bytes([BEFORE]) * max(ORDERS)
        self.buf = np.frombuffer(pad + pad.join([*texts, b""]), np.uint8)
        sizes = np.array([len(t) + 1 for t in texts])
        self.ends = np.cumsum(sizes)
        # A text's end takes the place of the first byte of what stands before the next one.
        begin = np.cumsum(sizes + len(pad) - 1) - (sizes + len(pad) - 1) + len(pad)
        self.place = spread(begin, sizes)
        s = self.buf[self.place].astype(np.int64)
        s[self.ends - 1] = END
        self.after = self.buf[self.place - 1].astype(np.int64) << 9 | s

    def pairs(self, m: int, bits: int) -> np.ndarray:
        """One number for each symbol and predictor ``m``'s context: so many bits of the context's hash, the byte before, the symbol."""
        if m < len(ORDERS):
            return pair_of(self._last(ORDERS[m])[self.place], ORDERS[m], self.after, bits)
        return pair_of(words_of(self.buf)[self.place], 0, self.after, bits)

    def whole(self, n: int) -> np.ndarray:
        """One number for each symbol and its context of ``n`` bytes, 6 at most: these bytes as they are, and the symbol."""
        v = self._last(n)[self.place]
        v <<= U64(9)
        v |= self.after.view(U64) & U64(511)
        return v

    def _last(self, n: int) -> np.ndarray:
        """The ``n`` bytes before every place as one number; the places before the first text get any."""
        out, have = np.zeros(len(self.buf), U64), 1
        out[1:] = self.buf[:-1]
        while have < n:
            more = min(have, n - have)
            longer = out.copy()
            longer[more:] |= out[:-more] << U64(8 * more)
            out, have = longer, have + more
        return out


def pair_of(h: np.ndarray, width: int, after: np.ndarray, bits: int) -> np.ndarray:
    """The pairs, in the place of ``h``, of contexts of ``width`` bytes (the word so far: 0), as one number each, and of symbols with the byte before."""
    with np.errstate(over="ignore"):
        h += U64(width)
        h *= U64(0x9E3779B97F4A7C15)
        h ^= h >> U64(32)
        h *= U64(0xD6E8FEB86659FD93)
    h >>= U64(64 - bits)
    h <<= U64(CODE_BITS)
    h |= after.view(U64)
    return h


def pairs_of_whole(v: np.ndarray, width: int, bits: int) -> np.ndarray:
    """The pairs of numbers as ``Symbols.whole`` makes them."""
    return pair_of(v >> U64(9), width, (v >> U64(9) & U64(0xFF)) << U64(9) | v & U64(511), bits)


def context_bits(size: int) -> int:
    """Bits of a context's hash for a corpus of so many bytes; with the byte before, some thousand values for each of its places."""
    return min(46, max(27, int(size).bit_length() + 4))


class Pairs:
    """For each predictor the distinct pairs of some texts, sorted: ``keys``.

    Without ``times``, ``some`` holds for each block of texts which of them it has, nearly in order, and ``which`` the one of
    these that every symbol is; with it, ``counts`` holds how often each occurs if the texts count so many times.
    """

    def __init__(self, texts: list[bytes], bits: int, times: np.ndarray | None = None):
        self.bits = bits
        if times is None:
            self.blocks = list(blocks(texts, limit=LANES))
            self.keys, self.some = [], []
            found: list[list[np.ndarray]] = [[] for _ in range(PREDICTORS)]
            self.which = [[] for _ in range(PREDICTORS)]
            for block in self.blocks:
                symbols = Symbols(block)
                for m in range(PREDICTORS):
                    k, which = self._block(symbols, m)
                    found[m].append(k), self.which[m].append(which)
            while found:
                own = found.pop(0)
                keys = np.concatenate([*own, np.zeros(0, U64)])
                keys.sort()
                keys = keys[np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]))]
                self.keys.append(keys)
                self.some.append([np.searchsorted(keys, k).astype(np.int32) for k in own])
        else:
            own = [self._run(some, n) for some, n in runs(texts, times)]
            self.keys = [distinct(np.concatenate([*(r[m][0] for r in own), np.zeros(0, U64)])) for m in range(PREDICTORS)]
            self.counts = [np.zeros(len(k), np.int64) for k in self.keys]
            for r in own:
                for all_, total, (k, n) in zip(self.keys, self.counts, r, strict=True):
                    total[np.searchsorted(all_, k)] += n

    def _run(self, texts: list[bytes], times: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each predictor the distinct pairs, in order, of texts that count equally, and how often each occurs."""
        own: list[list[np.ndarray]] = [[] for _ in range(PREDICTORS)]
        ends: list[np.ndarray] = []
        for some in blocks(texts, limit=FEW):
            symbols = Symbols(some)
            for m in range(PREDICTORS):
                if m in SHORT:
                    v = symbols.whole(ORDERS[m])
                    ends.append(v[symbols.ends - 1])
                    # A byte and three bytes before it: half as much to be sorted.
                    v = (v >> U64(9) << U64(8) | v & U64(0xFF)).astype(np.uint32)
                    own[m].append(np.delete(v, symbols.ends - 1))
                else:
                    own[m].append(symbols.pairs(m, self.bits))
        out = []
        for m in range(PREDICTORS):
            k, own[m] = np.concatenate(own[m]), []
            k.sort()
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(k)), bool), k[1:] != k[:-1])))
            k, n = k[first], np.diff(first, append=len(k)) * times
            if m in SHORT:
                last = np.concatenate(ends)
                v = np.concatenate((k.astype(U64) >> U64(8) << U64(9) | k & U64(0xFF), last))
                k, n = added([pairs_of_whole(v, ORDERS[m], self.bits)], [np.concatenate((n, np.full(len(last), times)))])
            out.append((k, n))
        return out

    def _block(self, symbols: Symbols, m: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of a block, nearly in order and hardly any of them twice, and which one each symbol is."""
        if m in SHORT:
            return self._short(symbols, m)
        k = symbols.pairs(m, self.bits)
        # Pair and place as one number; what doesn't fit are the hash's last bits, so that hardly any equal pairs lie apart.
        room = len(k).bit_length()
        v = k >> U64(CODE_BITS + max(0, self.bits + CODE_BITS + room - 64))
        v <<= U64(CODE_BITS)
        v |= k & U64((1 << CODE_BITS) - 1)
        v <<= U64(room)
        v |= np.arange(len(k), dtype=U64)
        v.sort()
        v &= U64((1 << room) - 1)
        order = v.view(np.int64)
        k = k[order]
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        which = np.empty(len(k), np.int32)
        which[order] = np.cumsum(new, dtype=np.int32) - 1
        return k[new], which


    def _short(self, symbols: Symbols, m: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``_block``; only the distinct pairs are hashed, few where contexts are short."""
        v = symbols.whole(ORDERS[m])
        room = len(v).bit_length()
        v <<= U64(room)
        v |= np.arange(len(v), dtype=U64)
        v.sort()
        order = (v & U64((1 << room) - 1)).view(np.int64)
        v >>= U64(room)
        new = np.ones(len(v), bool)
        new[1:] = v[1:] != v[:-1]
        k = pairs_of_whole(v[new], ORDERS[m], self.bits)
        sort = np.argsort(k)
        place, which = np.empty(len(k), np.int32), np.empty(len(v), np.int32)
        place[sort] = np.arange(len(k), dtype=np.int32)
        which[order] = place.take(np.cumsum(new) - 1)
        return k[sort], which


def runs(texts: list[bytes], times: np.ndarray) -> Iterator[tuple[list[bytes], int]]:
    """Consecutive texts that count equally, about ``RUN`` bytes at a time, and how often they count."""
    for n, some in itertools.groupby(zip(times.tolist(), texts, strict=True), key=lambda x: x[0]):
        for part in blocks((t for _, t in some), limit=RUN):
            yield part, n


def added(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the sum of each one's ``n``."""
    k, n = np.concatenate([*keys, np.zeros(0, U64)]), np.concatenate([*n, np.zeros(0, np.int64)])
    order = np.argsort(k)
    k = k[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(k)), bool), k[1:] != k[:-1])))
    return k[first], np.add.reduceat(n[order], first) if len(first) else n


def logit_of(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The logit, in parts of UNIT, of a 1 that was met ``m`` times, and a 0 ``n`` times; 0 stands for a decision not met."""
    logit = np.log((m + PRIOR) / (n + PRIOR))
    out = np.rint(np.clip(logit, -MAP_SPAN, MAP_SPAN) * UNIT).astype(np.int8)
    # A decision that was met is never quite 0.
    out[(n + m > 0) & (out == 0)] = 1
    return out


def spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin, begin + 1 ... of each, ``n`` numbers long, one after the other."""
    return np.arange(int(n.sum())) + np.repeat(begin - (np.cumsum(n) - n), n)


def code_of(keys: np.ndarray) -> np.ndarray:
    return (keys & U64((1 << CODE_BITS) - 1)).astype(np.int64)


def pair_logits(keys: np.ndarray, n: np.ndarray, code: Code) -> np.ndarray:
    """The logits of each pair's decisions, as seen from those taken, one after the other; ``keys`` are all pairs of their contexts, sorted."""
    context = np.concatenate((np.zeros(min(1, len(keys)), np.int64), np.cumsum(keys[1:] >> U64(9) != keys[:-1] >> U64(9))))
    out, begin = [np.zeros(0, np.int8)], 0
    while begin < len(keys):
        end = min(begin + PIECE, len(keys))
        end = int(np.searchsorted(context, context[end - 1], "right"))
        s = code_of(keys[begin:end])
        size = code.length[s]
        flat = spread(code.base[s], size)
        at = np.repeat(context[begin:end] - context[begin], size) << 8 | code.tree[flat]
        sign, times = code.sign[flat], np.repeat(n[begin:end], size)
        order = np.argsort(at)
        first = np.flatnonzero(np.concatenate(([True], np.diff(at[order]) != 0)))
        logit = logit_of(*(np.add.reduceat(np.where(sign == b, times, 0)[order], first).astype(np.float64) for b in (-1, 1)))
        own = np.empty(len(at), np.int8)
        own[order] = np.repeat(logit, np.diff(np.concatenate((first, [len(at)]))))
        own *= sign
        out.append(own)
        begin = end
    return np.concatenate(out)


def taken(logits: np.ndarray, keys: np.ndarray, some: np.ndarray, code: Code) -> np.ndarray:
    """The part of the logits of all ``keys`` that belongs to ``some`` of them."""
    size = code.length[code_of(keys)]
    at = np.searchsorted(keys, some)
    return logits[spread((np.cumsum(size) - size)[at], size[at])]


def share_of(times: np.ndarray) -> np.ndarray:
    """The part of what it missed that a cell of the map moves by for each of so many decisions."""
    return (1 - (1 - MAP_RATE) ** times) / np.maximum(times, 1)


#: Of few decisions, looked up.
SHARES = share_of(np.arange(LANES >> 3))


def steps(longest: int) -> np.ndarray:
    """Where each step of a text of ``longest`` symbols begins, and where the last one ends."""
    out = [0]
    while out[-1] < longest:
        out.append(out[-1] + max(FIRST, int(out[-1] * GROWTH)))
    return np.array(out)


class Model:
    """Scores texts by the logits of their pairs' decisions, for each predictor those of one pair after the other."""

    def __init__(self, code: Code, pairs: Pairs, logits: list[np.ndarray]):
        self.code, self.pairs, self.logits, self.first, self.size = code, pairs, logits, [], []
        for k, x in zip(pairs.keys, logits, strict=True):
            n = code.length[code_of(k)]
            if n.sum() != len(x):
                raise ValueError("pairs and logits don't belong together")
            self.first.append((np.cumsum(n) - n).astype(np.int32 if len(x) < 2**31 else np.int64))
            self.size.append(n.astype(np.int16))  # of 257 symbols' codes, 256 at most

    @classmethod
    def trained(cls, train: list[bytes], texts: list[bytes]) -> Model:
        """A model of the training texts that scores ``texts``."""
        bits = context_bits(sum(map(len, train)))
        code, own, logits = Code(byte_pairs(train)), Pairs(texts, bits), []
        all_ = Pairs([*train, *texts], bits, np.repeat([1, 0], [len(train), len(texts)]))
        for k, every, n in zip(own.keys, all_.keys, all_.counts, strict=True):
            logits.append(taken(pair_logits(every, n, code), every, k, code))
        return cls(code, own, logits)

    def scores(self) -> np.ndarray:
        """log10 of the probability of each text."""
        parts = [self._mixed(i, some) for i, some in enumerate(self.pairs.blocks)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _mixed(self, block: int, texts: list[bytes]) -> np.ndarray:
        symbols = Symbols(texts)
        sizes = np.diff(symbols.ends, prepend=0)
        order = np.argsort(-sizes, kind="stable")
        size, begin = sizes[order], (symbols.ends - sizes)[order]
        # Symbols by place, then by text, the longest first: a step of all texts that reach it is one slice, in which the
        # sums of different texts take turns.
        longest = int(size[0])
        cut = steps(longest)
        alive = len(size) - np.cumsum(np.bincount(size, minlength=longest + 1))[:longest]
        upto = np.concatenate(([0], np.cumsum(alive)))[np.minimum(cut, longest)]
        text = spread(np.zeros(longest, np.int64), alive)
        where = begin.take(text) + np.repeat(np.arange(longest), alive)
        n = self.code.length.take(symbols.after.take(where))
        first = np.concatenate(([0], np.cumsum(n)))
        # What is made for each decision is made for a few symbols at a time, so that it stays in the processor's cache;
        # one predictor after the other, so that its logits do, too.
        logits = np.empty((PREDICTORS, first[-1]), np.int8)
        for m, out in enumerate(logits):
            known, begins, which = self._own(m, block)
            begins = begins.take(which.take(where, mode="clip"), mode="clip") - first[:-1]
            for a in range(0, len(n), AHEAD):
                low, high = first[a], first[min(a + AHEAD, len(n))]
                at = np.repeat(begins[a : a + AHEAD], n[a : a + AHEAD])
                at += np.arange(low, high)
                known.take(at, mode="clip", out=out[low:high])
        mixer, total, a = Mixer(len(size)), np.zeros(len(size)), 0
        while a < len(cut) - 1:
            b = max(a + 1, int(np.searchsorted(upto, upto[a] + AHEAD, "right")) - 1)
            low, high = upto[a], upto[b]
            lane, some = np.repeat(text[low:high], n[low:high]), logits[:, first[low] : first[high]]
            row, x = lane * GATES, some * np.float32(1 / UNIT)
            for own in some:
                row += own != 0
            p = mixer.mixed(x, row, lane, first[upto[a : b + 1]] - first[low], alive[cut[a:b]], np.diff(cut[a : b + 1]))
            total += np.bincount(lane, np.log(p), len(size))
            a = b
        out = np.empty(len(size))
        out[order] = total / np.log(10)
        return out

    def _own(self, m: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The logits of a block's own pairs, nearly in the order they lie in, where each pair's begin, and the pair of every symbol."""
        some = self.pairs.some[m][block]
        size = self.size[m].take(some, mode="clip").astype(np.int64)
        logits = self.logits[m].take(spread(self.first[m].take(some, mode="clip"), size), mode="clip")
        return logits, np.cumsum(size) - size, self.pairs.which[m][block]


class Mixer:
    """The weights and the map of each of so many texts."""

    def __init__(self, lanes: int):
        self.weights = [np.tile(np.array(START[:GATES], np.float32), lanes) for _ in range(PREDICTORS)]
        self.curve = np.tile((1 / (1 + np.exp(-np.linspace(0, MAP_SPAN, MAP_STEPS)))).astype(np.float32), lanes)

    def mixed(self, x: np.ndarray, row: np.ndarray, lane: np.ndarray, upto: np.ndarray, active: np.ndarray, widths: np.ndarray) -> np.ndarray:
        """The probability of each decision of the next steps; ``upto`` are the bounds of these."""
        weights, curve, share = self.weights, self.curve, SHARES
        out = np.empty(len(row), np.float32)
        scale, most, half = np.float32((MAP_STEPS - 1) / MAP_SPAN), np.float32(MAP_SPAN - 0.01), np.float32(0.5)
        for n, a, b, width in zip(active.tolist(), upto[:-1].tolist(), upto[1:].tolist(), widths.tolist(), strict=True):
            at, inputs = row[a:b], [v[a:b] for v in x]
            # All places are valid; "clip" only spares take() a check of its own.
            z = weights[0].take(at, mode="clip")
            z *= inputs[0]
            for v, w in zip(inputs[1:], weights[1:], strict=True):
                z += v * w.take(at, mode="clip")
            np.minimum(z, most, out=z)
            np.maximum(z, -most, out=z)
            mixed = np.exp(-z)
            mixed += np.float32(1)
            np.reciprocal(mixed, out=mixed)
            error = (np.float32(1) - mixed) * np.float32(RATE * (FIRST / width) ** RATE_POWER)
            for v, w in zip(inputs, weights, strict=True):
                w[: n * GATES] += np.bincount(at, v * error, n * GATES)
            # The favoured side's probability by the size of the logit; each cell moves towards the mean of what it met.
            favoured = z > 0
            np.abs(z, out=z)
            z *= scale
            low = np.floor(z)
            z -= low
            low = low.astype(np.int64)
            low += lane[a:b] * MAP_STEPS
            p = curve.take(low, mode="clip")
            low += 1
            q = curve.take(low, mode="clip")
            low -= z <= half
            met = curve.take(low, mode="clip")
            q -= p
            q *= z
            q += p
            np.minimum(q, np.float32(1 - 1e-4), out=q)
            # The other side's probability is 1 - q.
            q -= ~favoured
            np.abs(q, out=q)
            mixed += q
            np.multiply(mixed, half, out=out[a:b])
            times = np.bincount(low, minlength=n * MAP_STEPS)
            missed = np.bincount(low, favoured - met, n * MAP_STEPS)
            curve[: n * MAP_STEPS] += missed * (share.take(times) if b - a < len(share) else share_of(times))
            curve[: n * MAP_STEPS : MAP_STEPS] = half
        return out


# ---- the distributed operator ------------------------------------------------------------


def _dealt(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, body, and the body's digest ``key``."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("body"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    return d.withColumn("held_out", F.coalesce(fold == HELD_OUT, F.lit(True))).withColumn("key", F.unhex(F.md5("body")))


def in_buckets(d: DataFrame, buckets: int) -> DataFrame:
    """(bucket, key, body, times): compressed texts and how many training rows have them; equal ones meet in a bucket.

    Equal texts of a batch are one row already, so that a group of copies crosses the network once a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            first: dict[bytes, int] = {}
            which = [first.setdefault(k, len(first)) for k in b["key"].to_pylist()]
            at = np.unique(which, return_index=True)[1] if which else np.zeros(0, np.int64)
            times = np.bincount(which, ~b["held_out"].to_numpy(zero_copy_only=False), len(first)) if which else at
            bodies = [small(x.as_py()) for x in b["body"].take(pa.array(at))]
            yield pa.RecordBatch.from_arrays([pa.array(list(first), pa.binary()), pa.array(bodies, pa.binary()), pa.array(times.astype(np.int64))], names=["key", "body", "times"])

    out = d.select("key", "body", "held_out").mapInArrow(run, "key binary, body binary, times long")
    return out.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))


def merged(t: pa.Table) -> tuple[list[bytes], list[bytes], np.ndarray]:
    """Distinct digests, their texts, and the sum of each one's ``times``."""
    first: dict[bytes, int] = {}
    which = [first.setdefault(k, len(first)) for k in t["key"].to_pylist()]
    at = np.unique(which, return_index=True)[1]
    whole = zstandard.ZstdDecompressor().decompress
    return list(first), [whole(x) for x in t["body"].take(pa.array(at)).to_pylist()], np.bincount(which, t["times"].to_numpy()).astype(np.int64)


def corpus(d: DataFrame) -> tuple[np.ndarray, int, int]:
    """Byte pairs of the training documents; how many these are; bytes of all documents."""
    schema = pa.schema([("pair", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, size = np.zeros((256, END + 1), np.int64), 0
        for b in batches:
            bodies = b["body"].to_pylist()
            size += sum(map(len, bodies))
            counts += byte_pairs([body for body, out in zip(bodies, b["held_out"].to_pylist(), strict=True) if not out])
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1], pa.int32()), pa.array([*counts.ravel()[at].tolist(), size], pa.int64())], schema=schema)
        release()

    rows = d.select("body", "held_out").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    found = {r.pair: r.n for r in rows}  # 65,793 rows at most
    size = found.pop(-1, 0)
    counts = np.zeros(256 * (END + 1), np.int64)
    counts[list(found)] = list(found.values())
    counts = counts.reshape(256, END + 1)
    return counts, int(counts[:, END].sum()), size


def word_hashes(texts: list[bytes]) -> Words:
    return Words([t.lower() for t in texts])


def range_of(k: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Which of ``buckets`` ranges numbers of so many bits fall into; a context's pairs, whose last 9 bits differ, fall into one."""
    return ((k >> U64(bits - 32)) * U64(buckets) >> U64(32)).astype(np.int64)


def gathered(texts: DataFrame, buckets: int, bits: int) -> DataFrame:
    """From (bucket, key, body, times): rows (range, bucket, pairs, counts).

    Compressed, a bucket's pairs of one predictor, or after the predictors its words, that fall into the range, and how often
    each is learnt from, possibly never.  There are (predictors + 1) x buckets ranges.
    """
    schema = pa.schema([("range", pa.int64()), ("bucket", pa.int32()), ("pairs", pa.binary()), ("counts", pa.binary())])

    def run(t: pa.Table) -> pa.Table:
        bucket = t["bucket"][0].as_py()
        _, bodies, times = merged(t)
        # Texts that count alike are next to each other, so that few blocks have to add up different counts.
        order = np.argsort(times, kind="stable")
        bodies, times = [bodies[i] for i in order.tolist()], times[order]
        p = Pairs(bodies, bits, times)
        ranges, pairs, counts = [], [], []
        for m, (k, n) in enumerate([*zip(p.keys, p.counts, strict=True), word_counts(bodies, times)]):
            own = range_of(k, bits + CODE_BITS if m < PREDICTORS else 64, buckets)
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(k)), bool), own[1:] != own[:-1])))
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(k)], strict=True):
                ranges.append(m * buckets + int(own[a]))
                pairs.append(packed(np.diff(k[a:b], prepend=U64(0))))
                counts.append(squeezed(n[a:b]))
        release()
        return pa.table([pa.array(ranges, pa.int64()), pa.array(np.full(len(ranges), bucket, np.int32)), pa.array(pairs, pa.binary()), pa.array(counts, pa.binary())], schema=schema)

    return texts.groupBy("bucket").applyInArrow(run, "range long, bucket int, pairs binary, counts binary")


def word_counts(texts: list[bytes], times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words' hashes, sorted, and how often each occurs if the texts count so many times."""
    keys, counts, done = [], [], 0
    for some in blocks(texts):
        w = word_hashes(some)
        k, n = added([w.hash], [np.repeat(times[done : done + len(some)], np.diff(w.first))])
        keys.append(k), counts.append(n)
        done += len(some)
    return added(keys, counts)


def packed(x: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed."""
    return zstandard.compress(x.view(np.uint8).reshape(len(x), -1).T.tobytes(), 1 if x.itemsize > 1 else 3)


def unpacked(b: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(b), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def squeezed(x: np.ndarray) -> bytes:
    """Counts as one byte each where they are under 255, the others after them."""
    large = x >= 255
    return zstandard.compress(np.where(large, 255, x).astype(np.uint8).tobytes() + x[large].astype("<i8").tobytes(), 1)


def stretched(b: bytes, size: int) -> np.ndarray:
    b = zstandard.decompress(b)
    x = np.frombuffer(b, np.uint8, size).astype(np.int64)
    x[x == 255] = np.frombuffer(b, "<i8", offset=size)
    return x


def summed(t: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The pairs of each row of a range, all of them, and the sums of their counts."""
    pairs = [np.cumsum(unpacked(x.as_py(), U64), dtype=U64) for x in t["pairs"]]
    return pairs, *added(pairs, [stretched(x.as_py(), len(p)) for x, p in zip(t["counts"], pairs, strict=True)])


def answered(rows: DataFrame, code: Code, buckets: int) -> DataFrame:
    """(range, bucket, answer, words): for each row of ``gathered`` the logits of its pairs, or the counts of its words, by what all buckets sent.

    The first bucket that sent words of a range gets the number of different training words in it, the others 0.
    """
    schema = pa.schema([("range", pa.int64()), ("bucket", pa.int32()), ("answer", pa.binary()), ("words", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        pairs, keys, n = summed(t)
        bucket, words = t["bucket"].to_numpy(), np.zeros(len(t), np.int64)
        if t["range"][0].as_py() >= PREDICTORS * buckets:
            out = [squeezed(n[np.searchsorted(keys, p)]) for p in pairs]
            words[np.argmin(bucket)] = (n > 0).sum()
        else:
            logits = pair_logits(keys, n, code)
            out = [packed(taken(logits, keys, p, code)) for p in pairs]
        return pa.table([t["range"], t["bucket"], pa.array(out, pa.binary()), pa.array(words)], schema=schema)

    return rows.groupBy("range").applyInArrow(run, "range long, bucket int, answer binary, words long")


SCHEMA = "key binary, times long, words long, n_tokens long, n_known long, seen double, score double, bits_per_byte double"


def scored(docs: DataFrame, bucket_bytes: int = BUCKET) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row."""
    d = _dealt(docs)
    counts, n_train, size = corpus(d)
    buckets, bits, code = int(size // bucket_bytes) + 1, context_bits(size), Code(counts)
    texts = in_buckets(d, buckets)

    def run(t: pa.Table, given: pa.Table) -> pa.Table:
        keys, bodies, times = merged(t)
        answers: list[list[bytes]] = [[] for _ in range(PREDICTORS + 1)]
        for i in np.argsort(given["range"].to_numpy()).tolist():
            answers[given["range"][i].as_py() // buckets].append(given["answer"][i].as_py())
        n_tokens, n_known, seen = base_scores(bodies, answers.pop(), buckets, n_train)
        logits = [np.concatenate([np.zeros(0, np.int8), *(unpacked(x, np.int8) for x in own)]) for own in answers]
        score = Model(code, Pairs(bodies, bits), logits).scores()
        per_byte = -score / np.log10(2) / np.maximum(1, [len(b) for b in bodies])
        words = np.zeros(len(keys), np.int64)
        words[0] = given["words"].to_numpy().sum()
        out = pa.table({"key": pa.array(keys, pa.binary()), "times": times, "words": words, "n_tokens": n_tokens, "n_known": n_known, "seen": seen, "score": score, "bits_per_byte": per_byte})
        release()
        return out

    given = answered(gathered(texts, buckets, bits), code, buckets)
    by_text = materialize(texts.groupBy("bucket").cogroup(given.groupBy("bucket")).applyInArrow(run, SCHEMA), "scores")
    r = by_text.agg(F.coalesce(F.sum(F.col("times") * F.col("n_tokens")), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("v")).first()
    least = float(np.log10(r.n + r.v + (n_train > 0) + 1))
    out = d.select("doc_id", "held_out", "key").join(by_text, "key")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(r.n).cast("long").alias("train_tokens"), (F.col("seen") - F.col("n_tokens") * least).alias("base_score"), "score", "bits_per_byte")


def base_scores(texts: list[bytes], answers: list[bytes], buckets: int, n_train: int):
    """Tokens, known tokens, and the sum of log10(count + 1) of each text; ``answers`` are the counts of the texts' words by range."""
    found = [(w.hash, np.diff(w.first)) for w in map(word_hashes, blocks(texts))]
    word = distinct(np.concatenate([np.zeros(0, U64), *(h for h, _ in found)]))
    sizes = np.bincount(range_of(word, 64, buckets), minlength=buckets)
    c = np.concatenate([np.zeros(0, np.int64), *(stretched(x, n) for x, n in zip(answers, sizes[sizes > 0].tolist(), strict=True))])
    n_tokens, n_known, seen = [], [], []
    each, end = np.log10(c + 1), np.log10(n_train + 1)
    for h, words in found:
        # Looked up in their order: neighbours are found near each other.
        order, at = np.argsort(h), np.empty(len(h), np.int64)
        at[order] = np.searchsorted(word, h[order])
        doc = np.repeat(np.arange(len(words)), words)
        n_tokens.append(words + 1)
        n_known.append(np.bincount(doc[c[at] > 0], minlength=len(words)) + (n_train > 0))
        seen.append(np.bincount(doc, each[at], len(words)) + end)
    return tuple(np.concatenate(x) if x else np.zeros(0) for x in (n_tokens, n_known, seen))
