"""Secret scanning: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 8 or more characters of the kind that keys are written in, with letters and digits; or of 16 or more with
capital letters; or, of any of these characters, what is assigned to a name that speaks for a secret.  The forest judges
it by its length, its character transitions, how much of it dictionary words cover, whether it is part of a path, and the
words around it.  It is trained from labelled findings; by default those of ``labelled_findings``, made from a
seed with words of their own, and any table of the same form can take their place.  The trees are a few thousand numbers; the
scan is one narrow pass.

Defined results: null and empty texts have no candidates; rows with a null doc_id
keep it; repeated rows are scanned each; candidates of any length are judged whole; other
columns are ignored.  Offsets are in bytes of UTF-8.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeep.llm.common import utf8

CANDIDATE = re.compile(rb"[A-Za-z0-9_+/=\-]{8,}")
#: From so many characters on a run with capital letters is one too.
LONG = 16
#: What stands before a value that is a candidate whatever it is made of.
ASSIGNED = re.compile(rb"(?i)(?:api_?key|auth|credential|passwd|password|private_?key|pwd|secret|token)s?[\"']?\s*(?::|=|:=|=>)\s*[\"'`]?\Z")
#: Bytes of text on either side that give the neighbouring words.
AROUND = 48
THRESHOLD = 0.5
TREES, DEPTH, LEAST = 40, 9, 4
#: Words that speak for a secret, that speak against one, and that names are made of.
FOR = ("api", "auth", "authorization", "aws", "bearer", "credential", "credentials", "key", "passwd", "password", "private", "pwd", "secret", "signature", "token")
AGAINST = ("build", "checksum", "commit", "digest", "etag", "example", "hash", "id", "isbn", "md5", "placeholder", "revision", "sample", "serial", "sha", "sha1", "sha256", "uuid", "version")
WORDS = (
    "access", "account", "action", "admin", "address", "array", "base", "batch", "binary", "block", "body", "buffer", "build", "cache", "call", "class", "client",
    "code", "column", "config", "content", "context", "control", "count", "data", "date", "default", "delete", "detail", "document", "element", "entity", "error",
    "event", "example", "factory", "field", "file", "filter", "format", "frame", "function", "get", "group", "handler", "header", "image", "index", "info", "input",
    "interface", "item", "java", "label", "layer", "length", "library", "list", "load", "local", "main", "manager", "map", "message", "method", "model", "module",
    "name", "network", "node", "number", "object", "option", "order", "output", "page", "parameter", "parent", "parse", "path", "pattern", "point", "process",
    "project", "property", "query", "read", "record", "report", "request", "resource", "response", "result", "row", "sample", "schema", "script", "search", "server",
    "service", "session", "set", "size", "source", "start", "state", "status", "stream", "string", "style", "system", "table", "target", "task", "test", "text",
    "thread", "time", "type", "update", "user", "util", "value", "vector", "version", "view", "window", "word", "write",
)
FEATURES = ("length", "upper", "lower", "digit", "symbol", "transitions", "letter_digit", "entropy", "distinct", "longest_run", "vowels", "dictionary", "hex", "slashes", "path", "quoted", "assigned", "for", "against")
_KIND = np.zeros(256, np.int8)
_KIND[list(string.ascii_lowercase.encode())] = 1
_KIND[list(string.ascii_uppercase.encode())] = 2
_KIND[list(string.digits.encode())] = 3
_KIND[list(b"_+/=-")] = 4
_DICTIONARY = re.compile("|".join(sorted(map(re.escape, {*WORDS, *FOR, *AGAINST} - {"id"}), key=lambda w: -len(w))).encode())


_DIGIT, _LETTER = re.compile(rb"[0-9]").search, re.compile(rb"[A-Za-z]").search


def candidates(body: bytes) -> Iterator[tuple[int, int]]:
    """(start, end) of each run that could be a secret."""
    for m in CANDIDATE.finditer(body):
        run = m[0]
        kinds = bool(_LETTER(run)) and (bool(_DIGIT(run)) or len(run) >= LONG and not run.islower())
        if kinds or ASSIGNED.search(body, max(0, m.start() - AROUND), m.start()):
            yield m.span()


def describe(body: bytes, start: int, end: int) -> list[float]:
    """The features of a candidate, in the order of FEATURES."""
    s = body[start:end]
    x = np.frombuffer(s, np.uint8)
    kind, n = _KIND[x], len(x)
    share = np.bincount(kind, minlength=5) / n
    change = kind[1:] != kind[:-1]
    mixed = ((kind[1:] == 3) != (kind[:-1] == 3)).mean()
    counts = np.bincount(x)
    p = counts[counts > 0] / n
    runs = np.diff(np.concatenate(([-1], np.flatnonzero(x[1:] != x[:-1]), [n - 1])))
    low = s.lower()
    covered = sum(len(m) for m in _DICTIONARY.findall(low))
    before, after = body[max(0, start - AROUND) : start], body[end : end + AROUND]
    words = set(re.findall(rb"[a-z0-9]+", before.lower()[-32:] + b" " + after.lower()[:16])) | set(re.split(rb"[^a-z]+", low))
    hexes = sum(c in b"0123456789abcdef" for c in low) / n
    path = before[-1:] in (b"/", b".", b"~", b":") or after[:1] in (b"/", b".") or b"://" in before[-12:]
    quoted = before[-1:] in (b'"', b"'", b"`") and after[:1] == before[-1:]
    assigned = bool(re.search(rb"[=:]\s*[\"'`]?$", before)) or b"=" in s[:-2].rstrip(b"=")
    return [
        float(n), share[2], share[1], share[3], share[4], float(change.mean()), float(mixed), float(-(p * np.log2(p)).sum()), len(p) / n, float(runs.max()),
        sum(c in b"aeiou" for c in low) / n, covered / n, hexes, float(s.count(b"/")), float(path), float(quoted), float(assigned),
        float(sum(w.encode() in words for w in FOR)), float(sum(w.encode() in words for w in AGAINST)),
    ]


# ---- the forest ------------------------------------------------------------------------------


class Forest:
    """Trees as arrays: feature (-1: a leaf), threshold, left child (the right one follows), share of secrets."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]]):
        self.trees = trees

    @classmethod
    def train(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, least: int = LEAST, seed: int = 11) -> Forest:
        rng = np.random.default_rng(seed)
        tries = max(1, int(np.sqrt(x.shape[1]) + 0.5))
        out = []
        for _ in range(trees):
            rows = rng.integers(0, len(x), len(x))
            feature, threshold, left, share = [-1], [0.0], [0], [0.0]
            todo = [(0, rows, 0)]
            while todo:
                node, rows, level = todo.pop()
                share[node] = float(y[rows].mean())
                if level >= depth or len(rows) < 2 * least or share[node] in (0.0, 1.0):
                    continue
                best = (np.inf, -1, 0.0)
                for f in rng.choice(x.shape[1], tries, replace=False):
                    best = min(best, cls._split(x[rows, f], y[rows], least, int(f)))
                if best[1] < 0:
                    continue
                _, f, cut = best
                low = x[rows, f] <= cut
                feature[node], threshold[node], left[node] = f, cut, len(feature)
                for part in (rows[low], rows[~low]):
                    todo.append((len(feature), part, level + 1))
                    feature.append(-1), threshold.append(0.0), left.append(0), share.append(0.0)
            out.append((np.array(feature), np.array(threshold), np.array(left), np.array(share)))
        return cls(out)

    @staticmethod
    def _split(v: np.ndarray, y: np.ndarray, least: int, f: int) -> tuple[float, int, float]:
        """(impurity, feature, threshold) of the best cut of one feature."""
        order = np.argsort(v, kind="stable")
        v, ones, n = v[order], np.cumsum(y[order]), len(v)
        at = np.arange(1, n)
        ok = (v[1:] > v[:-1]) & (at >= least) & (n - at >= least)
        if not ok.any():
            return np.inf, -1, 0.0
        k, a = at[ok], ones[:-1][ok]
        b = ones[-1] - a
        gini = a * (k - a) / k + b * (n - k - b) / (n - k)
        i = int(np.argmin(gini))
        return float(gini[i]), f, float((v[k[i] - 1] + v[k[i]]) / 2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, threshold, left, share in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH + 1):
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[np.arange(len(x)), np.maximum(f, 0)] > threshold[node]
                node = np.where(inner, left[node] + right, node)
            total += share[node]
        return total / max(1, len(self.trees))


def labelled_findings(n: int = 4000, seed: int = 5) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label) of invented findings: keys of usual makes, and what is mistaken for them."""
    rng = random.Random(seed)
    some = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    hexes, mixed = "0123456789abcdef", string.ascii_letters + string.digits
    # Words of their own: the dictionary, which is a feature, knows a part of them only.
    onsets, nuclei, codas = ("b", "br", "c", "d", "f", "fl", "g", "h", "l", "m", "n", "p", "pr", "r", "s", "st", "t", "tr", "v", "w"), ("a", "e", "i", "o", "u", "ea", "ou"), ("", "", "n", "r", "s", "t", "l", "ck", "ng")
    invented = lambda: "".join(rng.choice(onsets) + rng.choice(nuclei) + rng.choice(codas) for _ in range(rng.randint(1, 3)))
    some_words = lambda k: [rng.choice(WORDS) if rng.random() < 0.4 else invented() for _ in range(k)]
    filler = lambda k: " ".join(some("aeinorst", rng.randint(2, 9)) for _ in range(k))

    def secret() -> tuple[str, str, str]:
        name = rng.choice(("token", "api_key", "secret", "password", "auth", "AWS_SECRET_ACCESS_KEY", "key", "private_key"))
        body = rng.choice((lambda: some(hexes, rng.choice((32, 40, 64))), lambda: "AKIA" + some(string.ascii_uppercase + "234567", 16), lambda: some(mixed, rng.randint(20, 48)), lambda: some(mixed + "+/", 40), lambda: rng.choice(("ghp_", "sk_live_", "xoxb-")) + some(mixed, rng.randint(24, 40)), lambda: some(mixed + "-_", rng.randint(24, 64)) + rng.choice(("", "=", "==")), lambda: some(mixed, rng.randint(8, 15)), lambda: some(hexes, rng.randint(10, 24)), lambda: some(string.ascii_lowercase, rng.randint(12, 32))))()
        quote = rng.choice(('"', "'", ""))
        lead = rng.choice((f"{name} = {quote}", f"{name}: {quote}", f"{name}={quote}" if quote else f"{name}: ", f"Bearer {quote}", f"{filler(2)} {quote}"))
        if len(body) < 16 or body.isalpha() and body.islower():  # short ones, and letters alone, are only known by their name
            lead = rng.choice((f"{name}: {quote}", f"{name} = {quote}"))
        return lead, body, quote

    def mistaken() -> tuple[str, str, str]:
        words = some_words(6)
        made = rng.choice(
            (
                lambda: ("commit ", some(hexes, 40), ""), lambda: (rng.choice(("sha256:", "md5 ", "checksum: ", "etag ")), some(hexes, rng.choice((32, 64))), ""),
                lambda: (rng.choice(("id ", "uuid: ", "")), "-".join(some(hexes, k) for k in (8, 4, 4, 4, 12)), ""),
                lambda: (rng.choice(("/", "./", "https://host/")), "/".join(words[: rng.randint(3, 5)]) + str(rng.randint(0, 99)), rng.choice((".py", ".html", ""))),
                lambda: ("", words[0] + "".join(w.title() for w in words[1 : rng.randint(3, 6)]) + rng.choice(("", "2")), rng.choice(("(", "", "."))),
                lambda: ("", "_".join(words[: rng.randint(3, 5)]).upper() + rng.choice(("", "_1")), ""),
                lambda: (rng.choice(("token = ", "password: ", "key=")), rng.choice(("xxxxxxxxxxxxxxxxxxxxxxx1", "YOUR_API_KEY_GOES_HERE", "changeme-changeme-1", "<example>-EXAMPLE_VALUE_0")).lstrip("<"), ""),
                lambda: ("", some("etaoinshrdlu", rng.randint(8, 14)).title() + "-" + some("etaoinshrdlu", rng.randint(7, 14)).title(), ","),
                lambda: ("", some(string.ascii_lowercase, rng.randint(3, 6)) + "=" + some(string.digits, rng.randint(12, 20)), ""),
                lambda: (rng.choice(("", "room ", "model ", "flight ")), words[0].title() + some(string.digits, rng.randint(2, 6)) + rng.choice(("", "b", "-" + words[1])), rng.choice(("", ".", ","))),
                lambda: (rng.choice(("", "since ", "at ")), rng.choice(("2024-05-17T10", "12th-century", "v2-release-" + words[0], "10-4-" + words[1], "3rd-" + words[2] + "-" + words[3])), ""),
                lambda: (rng.choice(("token: ", "password = ", "secret: ")), rng.choice(("required", "changeme", "undefined", "password", "your-password", "disabled", "<hidden>-value".lstrip("<")) ), ""),
                lambda: ("", words[0] + "-" + words[1] + "-" + some(string.digits, 2), ""),
                lambda: ("data:image/png;base64,", some(mixed + "+/", rng.randint(200, 400)), ""),
            )
        )
        return made()

    out = []
    for i in range(n):
        lead, body, end = (secret if i % 2 else mistaken)()
        text = f"{filler(3)} {lead}"
        out.append((text + body + end + f" {filler(2)}", len(text), len(text) + len(body), i % 2))
    return out


def fit(findings=None, **settings) -> Forest:
    """Train on (text, start, end, label) rows; offsets in bytes."""
    rows = [(t.encode() if isinstance(t, str) else t, a, b, y) for t, a, b, y in (labelled_findings() if findings is None else findings)]
    return Forest.train(np.array([describe(t, a, b) for t, a, b, _ in rows]), np.array([y for *_, y in rows], float), **settings)


def findings(docs: DataFrame, forest: Forest | None = None) -> DataFrame:
    """Every candidate: doc_id, start, length, score, secret, and the candidate's digest (never the text itself)."""
    sent = docs.sparkSession.sparkContext.broadcast((forest or fit()).trees)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("body"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64()), ("secret", pa.bool_()), ("value_sha256", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(sent.value)
        for b in batches:
            rows, x = [], []
            for doc, body in zip(b["doc_id"].to_pylist(), b["body"].to_pylist(), strict=True):
                for a, e in candidates(body):
                    rows.append((doc, a, e - a, hashlib.sha256(body[a:e]).hexdigest()))
                    x.append(describe(body, a, e))
            p = forest.scores(np.array(x)) if x else np.zeros(0)
            doc, start, length, digest = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(p), pa.array(p >= THRESHOLD), pa.array(digest, pa.string())], schema=schema)

    return d.mapInArrow(scan, "doc_id long, start long, length long, score double, secret boolean, value_sha256 string")
