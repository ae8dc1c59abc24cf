"""Cutting documents into sections, chunks and line windows: one row in, many rows out.

Where a text is cut depends on the sizes of what was cut before, which the built-in functions can't express
well, so each cutter is an Arrow-batched function from a text to an array of structs that the plan explodes.
All of them work alike: the pieces' lengths are summed up once, each cut is looked up in the sums, and only then are
texts put together.  A document is the unit of work: nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate, groupby, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Page markers, headings, ends of sentences.
_PAGE = re.compile(r"<!--\s*PAGE\s+(\d+)\s*-->", re.IGNORECASE)
_HEADING = re.compile(r"^(#{2,3})\s+(.+)", re.MULTILINE)
_ANY_HEADING = re.compile(r"^#{1,4}\s+.+", re.MULTILINE)
_SENTENCE = re.compile(r"(?<=\.\s)(?=[A-Z])")
GAP = "\n\n"

Section = tuple[str, str]


class Sums:
    """Lengths of texts that are joined by GAP, as running sums with a gap after each."""

    def __init__(self, texts: Sequence[str]):
        self.upto = [0, *accumulate(len(t) + len(GAP) for t in texts)]

    def reach(self, first: int, room: int) -> int:
        """The end of the longest run from ``first`` on whose joined length is at most ``room``."""
        return bisect_right(self.upto, self.upto[first] + room + len(GAP), first) - 1


def marked(pattern: re.Pattern[str], text: str) -> list[tuple[re.Match[str] | None, int, int]]:
    """Each match with the bounds of the text from its end to the next match; first, without a match, what comes before all."""
    found = list(pattern.finditer(text))
    begins = [0, *(m.end() for m in found)]
    ends = [*(m.start() for m in found), len(text)]
    return list(zip([None, *found], begins, ends, strict=True))


# ---- sections ------------------------------------------------------------------------------


def in_parts(text: str, name: str, target: int) -> list[Section]:
    """Runs of paragraphs of at most ``target`` characters; a longer paragraph is a part of its own."""
    paragraphs = re.split(r"\n\n+", text)
    sums, cuts = Sums(paragraphs), [0]
    while cuts[-1] < len(paragraphs):
        cuts.append(max(cuts[-1] + 1, sums.reach(cuts[-1], target)))
    return [(f"{name}_part{i}", GAP.join(paragraphs[a:b])) for i, (a, b) in enumerate(pairwise(cuts))]


def balanced(pieces: Sequence[Section], least: int, most: int, target: int, run_name: Callable[[Sequence[str]], str]) -> list[Section]:
    """Sections of moderate size from (name, text) pieces.

    A piece under ``least`` begins a run of as many pieces as fit ``most``; one over ``most`` is cut at paragraphs. A run
    that takes in the last piece is added to the section before it if that fits.
    """
    names, texts = [n for n, _ in pieces], [t for _, t in pieces]
    sums, out, at = Sums(texts), [], 0
    while at < len(texts):
        if len(texts[at]) > most and len(texts[at]) >= least:
            out += in_parts(texts[at], names[at], target)
            at += 1
            continue
        short = len(texts[at]) < least
        end = max(at + 1, sums.reach(at, most)) if short else at + 1
        name, text = run_name(names[at:end]), GAP.join(texts[at:end])
        if short and end == len(texts) and out and len(out[-1][1]) + len(GAP) + len(text) <= most:
            name, text = out[-1][0], out.pop()[1] + GAP + text
        out.append((name, text))
        at = end
    return out


def page_sections(text: str, least: int = 1000, most: int = 5000, target: int = 3500) -> list[Section]:
    """Sections by page markers; text before the first marker isn't part of any."""
    pages = [(str(int(m[1])), text[a:b].strip()) for m, a, b in marked(_PAGE, text)[1:]]
    pages = [p for p in pages if p[1]]
    if not pages:
        return [("page-1", text.strip())]
    return balanced([(f"page-{n}", t) for n, t in pages], least, most, target, lambda run: "-".join([run[0], *(n.removeprefix("page-") for n in run[1:][-1:])]))


def heading_sections(text: str, least: int = 1000, most: int = 5000, target: int = 3500) -> list[Section]:
    """Sections by headings of levels 1 to 4; a run keeps its first heading as its name."""
    before, *found = marked(_ANY_HEADING, text)
    if not found:
        return in_parts(text, "section", target)
    pieces = [("preamble", text[: before[2]].strip())] if text[: before[2]].strip() else []
    pieces += [(m[0].strip().lstrip("#").strip(), text[m.start() : b].strip()) for m, _, b in found]
    return balanced(pieces, least, most, target, lambda run: run[0])


def by_heading(text: str) -> list[Section]:
    """(heading, body) of headings of levels 2 and 3; what comes before the first has an empty heading."""
    parts = [(m[2].strip() if m else "", text[a:b].strip()) for m, a, b in marked(_HEADING, text)]
    return parts if parts[0][1] else parts[1:]


def rendered(heading: str, body: str) -> str:
    return f"## {heading}{GAP}{body}" if heading else body


def relation_sections(text: str, least: int = 3000) -> list[Section]:
    """Sections by headings for relation extraction: joined while under ``least`` without the gap between, never cut."""
    parts = by_heading(text)
    texts = [rendered(h, b) if b else f"## {h}" for h, b in parts]
    sums, cuts = Sums(texts), [0]
    while cuts[-1] < len(texts):
        cuts.append(max(cuts[-1] + 1, sums.reach(cuts[-1], least - 1 + len(GAP))))
    return [(f"sec-{i:03d}-{_slug(parts[a][0] or 'preamble')}", GAP.join(texts[a:b])) for i, (a, b) in enumerate(pairwise(cuts))]


def _slug(title: str, most: int = 40) -> str:
    return re.sub(r"[^a-z0-9]+", "-", title.lower().strip()).strip("-")[:most]


# ---- chunks -----------------------------------------------------------------------------------


def without_tiny(sections: list[Section], least: int = 100) -> list[Section]:
    """Sections shorter than ``least`` belong to the one before; if the first is still tiny with its own, to the second."""
    small = [len(rendered(*s).strip()) < least for s in sections]
    # A section that isn't small opens a family; the first one always does.
    family = list(accumulate(i == 0 or not x for i, x in enumerate(small)))
    out = []
    for _, members in groupby(zip(family, sections, strict=True), key=lambda x: x[0]):
        (heading, body), *others = [s for _, s in members]
        out.append((heading, GAP.join([body, *(rendered(*s).strip() for s in others)]).strip() if others else body))
    if len(out) > 1 and len(rendered(*out[0]).strip()) < least:
        out[:2] = [(out[1][0], GAP.join([rendered(*out[0]), out[1][1]]).strip())]
    return out


def in_sentences(text: str) -> list[str]:
    cuts = [0, *(m.start() for m in _SENTENCE.finditer(text)), len(text)]
    return [s for s in (text[a:b].strip() for a, b in pairwise(cuts)) if s]


def packed(pieces: list[str], most: int, overlap: int) -> list[str]:
    """Chunks of as many pieces as fit ``most``; each begins with the last ``overlap`` characters of the one before.

    The overlap counts, but the first piece after a chunk goes into the next one however long it is. Where there
    is no chunk to follow, a piece too long for one is packed by its sentences, and what comes next goes on in the last of
    these; with a single sentence it is a chunk that nothing follows.
    """
    sums, out, at = Sums(pieces), [], 0
    follows = False
    while at < len(pieces):
        lead, end = "", at
        if follows:
            lead, end = (out[-1][-overlap:].lstrip() if overlap else ""), at + 1
        elif len(pieces[at]) > most:
            sentences = in_sentences(pieces[at])
            at += 1
            if len(sentences) < 2:
                out.append(pieces[at - 1])
                continue
            out += packed(sentences, most, overlap)
            lead, end = out.pop(), at
        room = most - len(lead) - len(GAP) if lead else most
        end = max(end, sums.reach(at, room)) if at < len(pieces) else at
        out.append(GAP.join([*([lead] if lead else []), *pieces[at:end]]))
        at, follows = end, True
    return out


def chunks(text: str, most: int = 1500, overlap: int = 200, least: int = 100) -> list[Section]:
    """(heading, text) of a document's chunks in order."""
    out = []
    for heading, body in without_tiny(by_heading(text), least):
        whole = rendered(heading, body)
        if len(whole) <= most:
            out.append((heading, whole))
            continue
        paragraphs = [p for p in map(str.strip, re.split(r"\n{2,}", body)) if p]
        out += [(heading, c) for c in packed([rendered(heading, p) if i == 0 else p for i, p in enumerate(paragraphs)], most, overlap)]
    return out


# ---- as operators -----------------------------------------------------------------------------------


#: Texts that are cut before their pieces are handed on.
CUT_ROWS, CUT_CHARS = 64, 1 << 20


def _exploded(docs: DataFrame, cut, name: str, text: str, first: str, second: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A worker holds a batch as it came (64 MB at most, or one text) and the pieces of a few of its texts."""
        for b in batches:
            names, texts = b.column(0), b.column(1)
            rows: list[tuple] = []
            size = at = 0
            for i in range(len(b)):
                t = texts[i].as_py()
                found = cut(t) if t is not None else []
                rows += [(i, pos, x, y) for pos, (x, y) in enumerate(found)]
                size += len(t or "")
                if rows and (i + 1 - at >= CUT_ROWS or size >= CUT_CHARS or i + 1 == len(b)):
                    of, pos, x, y = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(of)), pa.array(pos, pa.int32()), pa.array(x, pa.string()), pa.array(y, pa.string())], ["doc_name", "pos", first, second])
                    rows, size, at = [], 0, i + 1

    return docs.select(F.col(name).alias("doc_name"), F.col(text).alias("_t")).mapInArrow(run, f"doc_name {docs.schema[name].dataType.simpleString()}, pos int, {first} string, {second} string")


def sections(docs: DataFrame, kind: str = "pages", name: str = "doc_name", text: str = "text", **sizes) -> DataFrame:
    """(doc_name, section_pos, section_id, text).  kind: pages, headings or relations."""
    cut = {"pages": page_sections, "headings": heading_sections, "relations": relation_sections}[kind]
    out = _exploded(docs, lambda t: cut(t, **sizes), name, text, "section_id", "text")
    return out.withColumnRenamed("pos", "section_pos")


def chunked(docs: DataFrame, name: str = "doc_name", text: str = "text", most: int = 1500, overlap: int = 200, least: int = 100) -> DataFrame:
    """(chunk_id, text, document_name, section_heading, chunk_index)."""
    out = _exploded(docs, lambda t: chunks(t, most, overlap, least), name, text, "section_heading", "text")
    return out.select(F.format_string("%s-%04d", "doc_name", "pos").alias("chunk_id"), "text", F.col("doc_name").alias("document_name"), "section_heading", F.col("pos").alias("chunk_index"))


def chunk_stats(chunks_: DataFrame) -> DataFrame:
    """Chunks and their mean length, rounded down, of each document."""
    total = F.sum(F.length("text"))
    return chunks_.groupBy("document_name").agg(F.count("*").alias("n_chunks"), F.floor(total / F.count("*")).alias("mean_chars"))


# ---- line windows ------------------------------------------------------------------------------------


def windows(docs: DataFrame, name: str = "doc_name", text: str = "text", size: int = 100, overlap: int = 5) -> DataFrame:
    """(doc_name, window, first, end, lines): overlapping windows of lines."""
    lines = F.split(F.col(text), "\n")
    d = docs.select(F.col(name).alias("doc_name"), lines.alias("_l"), F.size(lines).alias("_n"))
    d = d.select("doc_name", "_l", "_n", F.posexplode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(size - overlap))).alias("window", "first"))
    end = F.least(F.col("first") + size, F.col("_n"))
    return d.select("doc_name", "window", "first", end.alias("end"), F.slice("_l", F.col("first") + 1, end - F.col("first")).alias("lines"))


def reassembled(w: DataFrame, size: int = 100, overlap: int = 5, compat: bool = False) -> DataFrame:
    """(doc_name, text) from windows whose lines may have been repaired.

    Each line comes from the first window that holds it, so that windows which kept their lines give
    the document back.  compat=True takes the share of each window that the older rule takes, which loses
    the last lines before the second window.
    """
    last = F.max("window").over(Window.partitionBy("doc_name"))
    w = w.withColumn("_last", last)
    n = F.size("lines")
    if compat:
        skip = F.when((F.col("window") == 0) | ((F.col("window") == F.col("_last")) & (n <= overlap)), 0).otherwise(F.least(F.lit(overlap), n))
        take = F.when(F.col("window") == F.col("_last"), n).otherwise(size - overlap)
    else:
        skip = F.when(F.col("window") == 0, 0).otherwise(F.least(F.lit(overlap), n))
        take = n
    part = F.slice("lines", skip + 1, F.greatest(F.lit(0), F.least(take, n - skip)))
    parts = w.select("doc_name", F.struct("window", part.alias("part")).alias("_p")).groupBy("doc_name").agg(F.array_sort(F.collect_list("_p")).alias("_p"))
    return parts.select("doc_name", F.array_join(F.flatten(F.transform("_p", lambda p: p.part)), "\n").alias("text"))


def split_text(docs: DataFrame, pieces: Column, name: str) -> DataFrame:
    """(name, pos, piece) of an array expression over a text."""
    return docs.select(name, F.posexplode(pieces).alias("pos", "piece"))
