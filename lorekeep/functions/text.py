"""Text and name functions as Column expressions; all stay inside whole-stage codegen.

Patterns carry (?d) where ``$`` is used, so that only a newline ends a line, and (?U)
where white space has to be that of Unicode.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lorekeep import constants as K

IMAGE_BLOCK_LIMIT = 50

#: The clean-up rules, in order, as (name, pattern, replacement); "=" patterns are literal.
RULES = (
    ("control", r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", ""),
    ("images", None, None),
    ("header_roman", r"\n## [A-Z][A-Z .]+\. {1,3}[xivlXIVL]+\n", "\n"),
    ("header_number_first", r"\n\d{1,3} [A-Z][A-Z' ]+\.\n", "\n"),
    ("header_number_last", r"\n## [A-Z][A-Z' ]+\. \d{1,3}\n", "\n"),
    ("page_number", r"(?md)^\d{1,3}\.?\s*$", ""),
    ("roman_one_word", r"(?md)^[xivlXIVL]{1,6} [A-Z]+\.\s*$", ""),
    ("roman_two_words", r"(?md)^[xivlXIVL]{1,6} [A-Z]+ [A-Z]+\.\s*$", ""),
    ("v_slash", "=v/", "w"),
    ("capital_vv", "=Vv", "W"),
    ("small_vv", "=vv", "w"),
    ("apostrophe", "=\\'", "'"),
    ("hyphen_strict", r"([a-z])\\-([a-z])", "$1$2"),
    ("hyphen_loose", r"([A-Za-z])\s*\\\s*-\s*([A-Za-z])", "$1$2"),
    ("double_y", r"(?U)([a-zA-Z])yy\b", "$1y"),
    ("trailing_blanks", r"[ \t]+\n", "\n"),
    ("blank_lines", r"\n{4,}", "\n\n\n"),
    ("final_newline", None, None),
)


def cut_images(text: Column, limit: int = IMAGE_BLOCK_LIMIT) -> Column:
    """Drop what follows the first image line if more than ``limit`` images follow, unless it begins the text."""
    at = F.locate("\n![Image ", text)
    rest = F.substring(text, at, F.length(text))
    kept = F.regexp_replace(F.substring(text, F.lit(1), at - 1), r"(?U)\s+\z", "")
    return F.when((at > 1) & (F.regexp_count(rest, F.lit(r"!\[Image \d+")) > limit), F.concat(kept, F.lit("\n"))).otherwise(text)


def one_final_newline(text: Column) -> Column:
    return F.concat(F.regexp_replace(text, r"\n+\z", ""), F.lit("\n"))


def rule(name: str, text: Column) -> Column:
    """One clean-up rule by name."""
    if name == "images":
        return cut_images(text)
    if name == "final_newline":
        return one_final_newline(text)
    pattern, new = next((p, r) for n, p, r in RULES if n == name)
    return F.replace(text, F.lit(pattern[1:]), F.lit(new)) if pattern.startswith("=") else F.regexp_replace(text, pattern, new)


def clean(text: Column) -> Column:
    """All clean-up rules in order."""
    return reduce(lambda t, r: rule(r[0], t), RULES, text)


# ---- names ------------------------------------------------------------------------------


def strip(text: Column) -> Column:
    """Trim Unicode white space."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def normalized(name: Column) -> Column:
    """Lower-case, without one leading article, white space collapsed."""
    bare = F.regexp_replace(F.lower(strip(name)), r"(?U)^(?:the|a|an)\s+", "")
    return strip(F.regexp_replace(bare, r"(?U)\s+", " "))


def slug(text: Column, most: int | None = None) -> Column:
    out = F.regexp_replace(F.regexp_replace(F.lower(strip(text)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.substring(out, 1, most) if most else out


def entity_id(kind: Column, name: Column) -> Column:
    prefixes = reduce(lambda w, kv: w.when(kind == kv[0], F.lit(kv[1])), K.PREFIXES.items(), F.when(F.lit(False), F.lit("")))
    return F.concat(F.coalesce(prefixes, F.lower(kind)), F.lit("-"), slug(name))


def canonical_type(spelling: Column) -> Column:
    """The type code of a spelling, or null."""
    pairs = [F.lit(x) for kv in K.type_spellings().items() for x in kv]
    return F.element_at(F.create_map(*pairs), spelling)


def display(relation: Column, fallback: str = "words") -> Column:
    """A relation's label; otherwise its words in lower case, or (fallback="code") the code itself."""
    pairs = [F.lit(x) for kv in K.DISPLAY.items() for x in kv]
    other = F.replace(F.lower(relation), F.lit("_"), F.lit(" ")) if fallback == "words" else relation
    return F.coalesce(F.element_at(F.create_map(*pairs), relation), other)


def type_label(kind: Column) -> Column:
    pairs = [F.lit(x) for kv in K.LABELS.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), kind), kind)


def clamp(x: Column) -> Column:
    # least and greatest pass over nulls, so a missing value is kept missing here.
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def entity_description(kind: Column, name: Column, note: Column) -> Column:
    """What an entity is embedded as: "name (type). note"."""
    head = F.concat(name, F.lit(" ("), type_label(kind), F.lit(")"))
    return F.when(F.coalesce(note, F.lit("")) != "", F.concat(head, F.lit(". "), note)).otherwise(head)


def for_document(text: Column) -> Column:
    return F.concat(F.lit("search_document: "), text)


def for_query(text: Column) -> Column:
    return F.concat(F.lit("search_query: "), text)


# ---- segmentation without state ------------------------------------------------------------


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\n{2,}"), strip), lambda p: p != "")


def sentences(text: Column) -> Column:
    """Cut after ". " where an ASCII capital follows."""
    return F.filter(F.transform(F.split(text, r"(?U)(?<=\.\s)(?=[A-Z])"), strip), lambda s: s != "")
