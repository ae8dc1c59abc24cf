"""Readers and writers for the files that stages exchange."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekeep import constants as K
from lorekeep.functions.text import canonical_type, clamp

ENTITY_FIELDS = "name string, entity_type string, aliases array<string>, description string, source_section string, confidence double"
RELATION_FIELDS = "head_name:string,head_type:string,relation_type:string,tail_name:string,tail_type:string,source_section:string,confidence:double"
CANONICAL_FIELDS = "entity_id:string,name:string,entity_type:string,aliases:array<string>,description:string,sources:array<string>"


def _stem(suffix: str = r"\.[^./]*$"):
    return F.regexp_replace(F.col("_metadata.file_name"), suffix, "")


def markdown(spark: SparkSession, path: str) -> DataFrame:
    """(doc_name, text): a row a file, named by its stem."""
    d = spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True)
    return d.select(_stem().alias("doc_name"), F.col("value").alias("text"))


def listing(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """(doc_name, path, length) of the files of a folder in the order of their names; no file is read."""
    d = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return d.select(F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1).alias("doc_name"), "path", "length").orderBy("path")


def unreadable(spark: SparkSession, path: str, parse: Callable[[bytes], list[str]]) -> DataFrame:
    """(doc_name, error) of the PDF files that the parser fails on; ``pdf_pages`` with ``skip`` leaves them out."""

    def attempt(content: bytes) -> list[str]:
        try:
            parse(content)
        except Exception as e:  # noqa: BLE001 - whatever a parser raises is the file's error
            return [f"{type(e).__name__}: {e}"]
        return []

    return pdf_pages(spark, path, attempt).select("doc_name", F.col("text").alias("error"))


def pdf_pages(spark: SparkSession, path: str, parse: Callable[[bytes], list[str]], skip: bool = False) -> DataFrame:
    """(doc_name, page_num, text) by a parser from a file's bytes to its pages' texts; pages without text are empty.

    A file that the parser fails on ends the job or, with ``skip``, has no pages.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select(F.regexp_extract("path", r"([^/]*)\.[^./]*$", 1).alias("doc_name"), "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in b.itertuples(index=False):
                try:
                    pages = parse(content)
                except Exception:  # noqa: BLE001 - as above
                    if not skip:
                        raise
                    continue
                # Without a type, the texts of a file without pages would be numbers.
                yield pd.DataFrame({"doc_name": name, "page_num": range(1, len(pages) + 1), "text": pd.Series([p or "" for p in pages], dtype=object)})

    return files.mapInPandas(run, "doc_name string, page_num int, text string")


def column_crops(width: float, height: float, split: float = 0.5) -> tuple[tuple[float, float, float, float], ...]:
    """(left, top, right, bottom) of a page's two columns, cut at a share of its width."""
    return (0.0, 0.0, width * split, height), (width * split, 0.0, width, height)


def two_columns(left: str | None, right: str | None) -> str:
    """A page's text from those of its halves, left before right."""
    return f"{left or ''}\n{right or ''}"


def marked(pages: DataFrame) -> DataFrame:
    """(doc_name, text): a document's pages, each after its marker."""
    page = F.concat(F.lit("<!-- PAGE "), F.col("page_num").cast("string"), F.lit(" -->\n\n"), F.coalesce("text", F.lit("")))
    listed = F.array_sort(F.collect_list(F.struct("page_num", page.alias("t"))))
    return pages.groupBy("doc_name").agg(F.array_join(F.transform(listed, lambda s: s.t), "\n\n").alias("text"))


def entity_files(spark: SparkSession, path: str) -> DataFrame:
    """Entities of JSON arrays, a file a document; missing fields get their defaults.

    Types are read in any of their spellings; entities without a name, or of a type that isn't known or not proposed, are left out.
    """
    d = spark.read.schema(ENTITY_FIELDS).option("multiLine", True).json(path).withColumn("doc_name", _stem())
    empty = F.array().cast("array<string>")
    d = d.withColumn("entity_type", canonical_type(F.col("entity_type"))).where(F.col("entity_type").isNotNull() & ~F.col("entity_type").isin(*K.NOT_PROPOSED) & (F.trim(F.coalesce("name", F.lit(""))) != ""))
    return d.select("doc_name", "name", "entity_type", F.coalesce("aliases", empty).alias("aliases"), F.coalesce("description", F.lit("")).alias("description"), F.coalesce("source_section", F.lit("")).alias("source_section"), clamp(F.coalesce("confidence", F.lit(1.0))).alias("confidence"))


def relation_files(spark: SparkSession, path: str) -> DataFrame:
    d = spark.read.schema(f"extracted_at string, model string, count long, relations array<struct<{RELATION_FIELDS}>>").option("multiLine", True).json(path)
    # A relation without its names or its type is none.
    return d.select(_stem().alias("doc_name"), F.inline("relations")).where("head_name is not null and relation_type is not null and tail_name is not null")


def registry_files(spark: SparkSession, path: str) -> DataFrame:
    d = spark.read.schema(f"entity_count long, entities array<struct<{CANONICAL_FIELDS}>>").option("multiLine", True).json(path)
    return d.select(F.inline("entities"))


def write_parts(rows: DataFrame, path: str, key: str = "doc_name", mode: str = "overwrite") -> None:
    """A folder a document, as JSON lines."""
    rows.write.mode(mode).partitionBy(key).json(path)


def write_relations(rows: DataFrame, path: str, model: str) -> None:
    """One JSON object a document: when, by which model, how many, and the relations."""
    fields = [f.split(":")[0] for f in RELATION_FIELDS.split(",")]
    d = rows.groupBy("doc_name").agg(F.count("*").alias("count"), F.collect_list(F.struct(*fields)).alias("relations"))
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    d.select("doc_name", stamp.alias("extracted_at"), F.lit(model).alias("model"), "count", "relations").write.mode("overwrite").partitionBy("doc_name").json(path)


def write_registry(registry: DataFrame, path: str) -> None:
    """The registry (``resolution.registry``) as one JSON object; pairs that are ambiguous are only named if there are any."""
    registry.coalesce(1).write.mode("overwrite").option("ignoreNullFields", True).json(path)


def write_tables(tables: DataFrame, path: str) -> None:
    """(doc_name, page_num, title, headers, rows) as JSON, a folder a document."""
    write_parts(tables, path)


def write_texts(docs: DataFrame, path: str) -> None:
    """A text file a document with one final newline, in a folder of its name; inputs are never overwritten."""
    body = F.regexp_replace("text", r"\n\z", "").alias("text")
    docs.select("doc_name", body).write.mode("overwrite").partitionBy("doc_name").text(path)
