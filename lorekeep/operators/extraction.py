"""Model output: parsing proposed entities and relations, and validating them.

Raw JSON is read with explicit schemas whose scalars are strings, so that what a model
quotes doesn't void a row; numbers are cast afterwards.  Nothing is dropped silently: parsed and validated
rows carry a status.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekeep import constants as K
from lorekeep.functions import text as T

ENTITY = "array<struct<name:string,type:string,aliases:array<string>,description:string,confidence:string>>"
RELATION = "array<struct<head_name:string,head_type:string,relation_type:string,tail_name:string,tail_type:string,confidence:string>>"


def unfenced(raw: Column, where: str = "both") -> Column:
    """Without code fences: at both ends, or only at the end."""
    s = F.regexp_replace(T.strip(raw), r"\n?```\s*\z", "")
    return s if where == "end" else F.regexp_replace(s, r"\A```[^\n]*\n", "")


def prefilled(raw: Column) -> Column:
    """A response that continues an opened array."""
    return F.concat(F.lit("["), raw)


def without_trailing_commas(raw: Column) -> Column:
    return F.regexp_replace(raw, r",\s*([}\]])", "$1")


def _array(raw: Column, schema: str) -> Column:
    """The array in a response: all of it, or from the first to the last bracket; a lone object counts as one."""
    whole = F.when(F.startswith(F.ltrim(raw), F.lit("{")), F.concat(F.lit("["), raw, F.lit("]"))).otherwise(raw)
    inner = F.regexp_extract(raw, r"(?s)\[.*\]", 0)
    # Malformed input is null, and then the brackets are tried.
    return F.coalesce(F.from_json(whole, schema), F.from_json(inner, schema))


def parsed_entities(raw: DataFrame, column: str = "raw_json", section: str = "section_id") -> DataFrame:
    """Rows of proposed entities with a status: ok, unknown type, not proposed, no name, bad confidence, unparsable."""
    rows = raw.select(F.col(section).alias("source_section"), _array(without_trailing_commas(F.col(column)), ENTITY).alias("_a"))
    bad = rows.where("_a is null").select("source_section", F.lit("unparsable").alias("status"))
    e = rows.select("source_section", F.explode("_a").alias("_e")).select("source_section", "_e.*")
    kind = T.canonical_type(F.col("type"))
    confidence = F.when(F.col("confidence").isNull(), F.lit(1.0)).otherwise(F.expr("try_cast(confidence as double)"))
    e = e.select(
        "source_section",
        T.strip(F.coalesce("name", F.lit(""))).alias("name"),
        kind.alias("entity_type"),
        F.filter(F.transform(F.coalesce("aliases", F.array().cast("array<string>")), T.strip), lambda a: a != "").alias("aliases"),
        T.strip(F.coalesce("description", F.lit(""))).alias("description"),
        T.clamp(confidence).alias("confidence"),
    )
    status = (
        F.when(F.col("entity_type").isNull(), "unknown type")
        .when(F.col("entity_type").isin(*K.NOT_PROPOSED), "not proposed")
        .when(F.col("name") == "", "no name")
        .when(F.col("confidence").isNull(), "bad confidence")
        .otherwise("ok")
    )
    return e.withColumn("status", status).unionByName(bad, allowMissingColumns=True)


def entities(parsed: DataFrame) -> DataFrame:
    return parsed.where("status = 'ok'").drop("status")


def parsed_relations(raw: DataFrame, column: str = "raw_json", section: str = "section_id") -> DataFrame:
    """Rows of proposed relations, fields stripped, confidence as a number (null if unparsable, 0 if missing)."""
    rows = raw.select(F.col(section).alias("source_section"), F.explode(F.from_json(F.col(column), RELATION)).alias("_r")).select("source_section", "_r.*")
    names = ["head_name", "head_type", "relation_type", "tail_name", "tail_type"]
    confidence = F.when(F.col("confidence").isNull(), F.lit(0.0)).otherwise(F.expr("try_cast(confidence as double)"))
    return rows.select("source_section", *[T.strip(F.coalesce(n, F.lit(""))).alias(n) for n in names], confidence.alias("confidence"))


def validated(relations: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """Relations with ``reject_reason`` (null: valid) and names in the spelling of the registry.

    The checks apply in order: confidence, names, relation, floor, head type, tail type, head known, tail known.
    A name is looked up exactly, then without regard to case (the smallest spelling wins).
    """
    known = names.select(F.col(name).alias("_n")).where("_n is not null").distinct()
    folded = known.groupBy(F.lower("_n").alias("_l")).agg(F.min("_n").alias("_spelling"), F.collect_set("_n").alias("_all"))

    def looked_up(df: DataFrame, side: str) -> DataFrame:
        f = folded.select(F.col("_l").alias(f"_l_{side}"), F.col("_spelling").alias(f"_s_{side}"), F.col("_all").alias(f"_a_{side}"))
        df = df.join(f, F.lower(f"{side}_name") == F.col(f"_l_{side}"), "left")
        exact = F.array_contains(f"_a_{side}", F.col(f"{side}_name"))
        return df.withColumn(f"_{side}", F.when(exact, F.col(f"{side}_name")).otherwise(F.col(f"_s_{side}"))).drop(f"_l_{side}", f"_s_{side}", f"_a_{side}")

    rules = K.relations_table(relations.sparkSession).select(F.col("rel_type").alias("_rt"), "sources", "targets", "is_property", "extractable")
    d = looked_up(looked_up(relations, "head"), "tail").join(F.broadcast(rules), F.col("relation_type") == F.col("_rt"), "left")
    free = F.col("is_property")
    reason = (
        F.when(F.col("confidence").isNull(), "unparsable")
        .when((F.col("head_name") == "") | (F.col("tail_name") == ""), "missing name")
        .when(~F.coalesce("extractable", F.lit(False)), "relation type")
        .when(F.col("confidence") < K.CONFIDENCE_FLOOR, "low confidence")
        .when(~F.array_contains("sources", F.col("head_type")), "head type")
        .when(~free & (F.size("targets") > 0) & ~F.array_contains("targets", F.col("tail_type")), "tail type")
        .when(F.col("_head").isNull(), "head unknown")
        .when(~free & F.col("_tail").isNull(), "tail unknown")
    )
    d = d.withColumn("reject_reason", reason)
    fixed = {"head_name": F.coalesce("_head", "head_name"), "tail_name": F.when(free, F.col("tail_name")).otherwise(F.coalesce("_tail", "tail_name")), "confidence": T.clamp(F.col("confidence"))}
    ok = F.col("reject_reason").isNull()
    d = d.withColumns({k: F.when(ok, v).otherwise(F.col(k)) for k, v in fixed.items()})
    return d.drop("_head", "_tail", "_rt", "sources", "targets", "is_property", "extractable")


def constraint_text() -> str:
    """The relations and their endpoint types, as prompts list them."""
    out = []
    for name, shown, sources, targets in K.RELATIONS:
        if name in K.EXTRACTABLE:
            out += [f"  {name}  ({shown})", f"    Source types: {', '.join(sources)}", f"    Target types: {', '.join(targets) or '(free text value)'}"]
    return "\n".join(out)


def names_text(names: Column) -> Column:
    """Sorted bullet points of an array of names."""
    lines = F.array_join(F.transform(F.array_sort(names), lambda n: F.concat(F.lit("  - "), n)), "\n")
    return F.when(F.size(names) > 0, lines).otherwise(F.lit("  (no entities provided)"))


def names_by_document(entities_: DataFrame, doc: str = "doc_name", seq: str = "seq") -> DataFrame:
    """(doc, names): names and aliases of each document in the order they are first met."""
    n = entities_.select(doc, seq, F.posexplode(F.concat(F.array("name"), "aliases")).alias("_k", "_n"))
    first = n.groupBy(doc, "_n").agg(F.min(F.struct(seq, "_k")).alias("_at"))
    return first.groupBy(doc).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_n"))), lambda s: s._n).alias("names"))


# ---- model slots -------------------------------------------------------------------------------------


def with_model(
    rows: DataFrame, call: Callable[..., str], inputs: list[str], output: str = "raw_json", attempts: int = 3, parallel: int | None = None,
    waits: Callable[[int, Exception], float] | None = None, per_minute: float | None = None, fallback: str | None = None,
) -> DataFrame:
    """Call a model for every row; ``error`` holds why a row has no output of its own.

    ``call`` gets the row's input values and returns text.  ``parallel`` bounds how many calls run at once, ``per_minute`` how many
    begin in a minute, in equal shares of the tasks; ``waits`` says how many seconds to wait after an attempt (from 1) that raised.
    A row whose attempts all failed gets the column ``fallback`` instead, if one is named.
    Retries happen inside the call's task: a lost task must not repeat paid calls that were written already, so
    write the result before using it.
    """
    gap = 60.0 * (parallel or 1) / per_minute if per_minute else 0.0
    if per_minute and not parallel:
        parallel = 1

    @F.pandas_udf(f"struct<{output}:string,error:string>")
    def run(*columns: pd.Series) -> pd.DataFrame:
        out, last = [], 0.0
        for *values, other in zip(*columns, strict=True):
            error = None
            for attempt in range(1, attempts + 1):
                if gap:
                    time.sleep(max(0.0, last + gap - time.monotonic()) if last else 0.0)
                    last = time.monotonic()
                try:
                    out.append((call(*values), None))
                    break
                except Exception as e:  # noqa: BLE001 - whatever a model's client raises is the row's error
                    error = f"{type(e).__name__}: {e}"
                    if waits and attempt < attempts:
                        time.sleep(waits(attempt, e))
            else:
                out.append((other, error))
        return pd.DataFrame(out, columns=[output, "error"])

    rows = rows.repartition(parallel) if parallel else rows
    other = F.col(fallback) if fallback else F.lit(None).cast("string")
    return rows.withColumn("_m", run(*map(F.col, inputs), other)).select(*rows.columns, f"_m.{output}", "_m.error")


def embedded(rows: DataFrame, embed: Callable[[list[str]], list[list[float]]], text: Column, output: str = "embedding", batch: int = 128) -> DataFrame:
    """Vectors from an embedding model in batches."""

    @F.pandas_udf("array<float>")
    def run(texts: pd.Series) -> pd.Series:
        values = texts.tolist()
        return pd.Series([v for i in range(0, len(values), batch) for v in embed(values[i : i + batch])])

    return rows.withColumn(output, run(text))


def to_extract(sections: DataFrame, entities_: DataFrame | None = None, doc: str = "doc_name", text: str = "text") -> DataFrame:
    """Sections that a model is asked about: not blank and, for relations, of documents that have entities."""
    out = sections.where(T.strip(F.col(text)) != "")
    return out if entities_ is None else out.join(entities_.select(doc).distinct(), doc, "left_semi")


def table_preview(tables: DataFrame, rows: int = 3) -> DataFrame:
    """Add the first rows of each table, ``preview``, and their number, ``n_rows``."""
    return tables.withColumn("preview", F.slice("rows", 1, rows)).withColumn("n_rows", F.size("rows"))


def page_base64(content: Column) -> Column:
    """A rasterised page as models take it."""
    return F.base64(content)


def table_json(raw: Column) -> Column:
    """Tables that a vision model returned: an array of title, headers, rows."""
    return F.from_json(unfenced(raw), "array<struct<title:string,headers:array<string>,rows:array<array<string>>>>")


def to_json_text(value: object) -> str:
    return json.dumps(value, ensure_ascii=False)
