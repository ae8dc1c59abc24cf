"""Entity resolution: clustering names within a type, canonical entities, alias maps.

The two clustering tiers depend on the order of the input (a later entity can take over a name, a
merged cluster stops matching), so names are folded in order; but only names that are connected, by a shared name or by a chain
of similar ones, ever meet.  Each connected component is folded by itself.  Similar names are
found by a join on rare characters, which no similar pair escapes, and compared on all executors.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorekeep import constants as K
from lorekeep.functions import text as T
from lorekeep.functions.similarity import may_reach, ratios
from lorekeep.operators.components import few_components

#: Characters from common to rare; what isn't listed is rarer still.
COMMON = " eaiontrslcudphmgbfywvkxzjq0123456789"


def canonical_name(names: Column) -> Column:
    """The longest of an array of names; of these the first in code-point order."""
    return F.array_min(F.transform(names, lambda n: F.struct((-F.length(n)).alias("k"), n.alias("n")))).n


def longest(name: str = "name") -> Column:
    """The same as an aggregate."""
    return F.min_by(name, F.struct(-F.length(name), F.col(name)))


def exact_clusters(entities: DataFrame, kind: str = "entity_type", seq: str = "seq") -> DataFrame:
    """Add ``cluster``: the seq of the first entity of its tier-1 cluster.

    An entity joins the cluster of its first name that is known, and all its names then stand for that cluster.
    """
    keys = F.transform(F.concat(F.array("name"), "aliases"), T.normalized)
    d = entities.select(kind, seq, keys.alias("_keys"))
    named = d.select(kind, F.col(seq).alias("a"), F.explode("_keys").alias("_key"))
    first = named.groupBy(kind, "_key").agg(F.min("a").alias("b"), F.count("*").alias("_n")).where("_n > 1")
    # Entities that share a name, directly or through others, are one component.
    met = few_components(named.join(first, [kind, "_key"]).select("a", "b"))
    d = d.join(met, d[seq] == met["node"])

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        owner: dict[str, int] = {}
        home = []
        for s, names in group.sort_values(seq)[[seq, "_keys"]].itertuples(index=False):
            cluster = next((owner[n] for n in names if n in owner), s)
            owner.update(dict.fromkeys(names, cluster))
            home.append((s, cluster))
        return pd.DataFrame(home, columns=["_seq", "cluster"])

    found = d.groupBy("component").applyInPandas(fold, "_seq long, cluster long")
    out = entities.join(found, F.col(seq) == F.col("_seq"), "left")
    return out.withColumn("cluster", F.coalesce("cluster", F.col(seq).cast("long"))).drop("_seq")


def rare_characters(key: Column, least: float) -> Column:
    """The rarest characters of a string, numbered by occurrence, of which any string as similar as ``least`` has one too.

    Similar strings share at least ``least / (2 - least)`` of either one's characters, so that of all characters in one
    order, rare first, those that remain can't all be missing.
    """
    own = F.filter(F.split(key, ""), lambda c: c != "")
    numbered = F.transform(own, lambda c, i: F.concat(F.lpad(F.position(c, F.lit(COMMON[::-1])).cast("string"), 2, "0"), c, F.size(F.filter(F.slice(own, 1, i + 1), lambda x: x == c)).cast("string")))
    keep = F.size(own) - F.ceil(F.size(own) * F.lit(least / (2 - least)) - 1e-9).cast("int") + 1
    return F.when(F.size(own) == 0, F.array(F.lit(""))).otherwise(F.slice(F.array_sort(numbered), F.lit(1), keep))


def similar_names(names: DataFrame, kind: str = "entity_type", seq: str = "seq", least: float = K.FLAG_AT) -> DataFrame:
    """(type, seq_a, seq_b, name_a, name_b, similarity) of names of a type, a before b, with similarity >= ``least``."""
    n = names.select(F.col(kind).alias("entity_type"), F.col(seq).alias("s"), F.col("name"), T.normalized(F.col("name")).alias("key"))
    n = n.withColumn("rare", F.explode(rare_characters(F.col("key"), least)))
    a, b = (n.select("entity_type", "rare", *[F.col(c).alias(f"{c}_{x}") for c in ("s", "name", "key")]) for x in "ab")
    pairs = a.join(b, ["entity_type", "rare"]).where((F.col("s_a") < F.col("s_b")) & may_reach(F.col("key_a"), F.col("key_b"), least))
    pairs = pairs.drop("rare").distinct().withColumn("similarity", ratios("key_a", "key_b")).where(F.col("similarity") >= least)
    return pairs.select("entity_type", F.col("s_a").alias("seq_a"), F.col("s_b").alias("seq_b"), "name_a", "name_b", "similarity")


def merged_clusters(pairs: DataFrame) -> DataFrame:
    """Tier 2 on the pairs of similar cluster names: (entity_type, seq, into, flagged_with, similarity).

    Clusters are taken in order; one that isn't merged yet takes in every later one, not merged yet, that is similar
    enough to its own name.  Rows with ``into`` are merges, rows with ``flagged_with`` are close calls.
    """

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        gone: set[int] = set()
        out = []
        for a, b, s in group.sort_values(["seq_a", "seq_b"])[["seq_a", "seq_b", "similarity"]].itertuples(index=False):
            if a in gone or b in gone:
                continue
            if s >= K.MERGE_AT:
                gone.add(b)
                out.append((b, a, None, s))
            else:
                out.append((a, None, b, round(s, 3)))
        d = pd.DataFrame(out, columns=["seq", "into", "flagged_with", "similarity"]).astype({"into": "Int64", "flagged_with": "Int64"})
        return d.assign(entity_type=group["entity_type"].iloc[0])[["entity_type", "seq", "into", "flagged_with", "similarity"]]

    # Names of one type only are paired, so a component has one type.
    pairs = pairs.join(few_components(pairs, "seq_a", "seq_b"), F.col("seq_a") == F.col("node"))
    return pairs.groupBy("component").applyInPandas(fold, "entity_type string, seq long, into long, flagged_with long, similarity double")


def first_seen(rows: DataFrame, group: list[str], value: str, key: Column, order: list[str]) -> DataFrame:
    """(group, values): distinct by ``key``, the first of each in ``order``, in that order."""
    at = F.struct(*order)
    first = rows.withColumn("_key", key).groupBy(*group, "_key").agg(F.min(F.struct(at.alias("at"), F.col(value).alias("v"))).alias("_f"))
    return first.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list("_f")), lambda s: s.v).alias("values"))


def sentences(rows: DataFrame, group: list[str], order: list[str], text: str = "description") -> DataFrame:
    """(group, order, _i, _s): the sentences of every text, numbered by ``_i``."""
    parts = F.split(T.strip(F.coalesce(text, F.lit(""))), r"(?U)(?<=[.!?])\s+")
    return rows.select(*group, *order, F.posexplode(parts).alias("_i", "_s")).withColumn("_s", T.strip(F.col("_s"))).where("_s <> ''")


def merged_descriptions(rows: DataFrame, group: list[str], order: list[str], text: str = "description") -> DataFrame:
    """(group, description): the distinct sentences, without regard to case, of all texts in order."""
    d = first_seen(sentences(rows, group, order, text), group, "_s", F.lower("_s"), [*order, "_i"])
    return d.select(*group, F.array_join("values", " ").alias("description"))


def description_sentences(rows: DataFrame, group: list[str], order: list[str], text: str = "description") -> DataFrame:
    """(group, order, place, sentence): what ``merged_descriptions`` joins, a row for each sentence.

    ``order`` and ``place`` say where a sentence stands first and give the order within a group. No
    row grows with the group, so whole documents can be merged.
    """
    s = sentences(rows, group, order, text)
    first = s.groupBy(*group, F.lower("_s").alias("_key")).agg(F.min(F.struct(*order, "_i", "_s")).alias("_f"))
    return first.select(*group, *[F.col(f"_f.{c}").alias(c) for c in order], F.col("_f._i").alias("place"), F.col("_f._s").alias("sentence"))


def resolve(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Canonical entities and ambiguous pairs of (seq, doc_name, name, entity_type, aliases, description).

    seq is unique and ascends in the order of documents, sections and positions.
    """
    e = exact_clusters(entities)
    variants = e.select("entity_type", "cluster", "seq", F.posexplode(F.concat(F.array("name"), "aliases")).alias("_i", "name"))
    own = variants.groupBy("entity_type", "cluster").agg(longest().alias("name"))
    pairs = merged_clusters(similar_names(own.withColumnRenamed("cluster", "seq")))
    moves = pairs.where("into is not null").select("entity_type", F.col("seq").alias("cluster"), "into")
    # Members of a merged cluster follow those of the cluster that takes it in, in the order of the merges.
    e = e.join(moves, ["entity_type", "cluster"], "left").withColumn("_rank", F.when(F.col("into").isNull(), F.lit(-1)).otherwise(F.col("cluster")))
    e = e.withColumn("home", F.coalesce("into", "cluster"))
    group = ["entity_type", "home"]
    variants = e.select(*group, "_rank", "seq", F.posexplode(F.concat(F.array("name"), "aliases")).alias("_i", "variant"))
    named = variants.groupBy(*group).agg(longest("variant").alias("name"))
    aliases = first_seen(variants, group, "variant", F.lower("variant"), ["_rank", "seq", "_i"]).withColumnRenamed("values", "aliases")
    described = merged_descriptions(e, group, ["_rank", "seq"])
    sources = e.groupBy(*group).agg(F.array_sort(F.collect_set("doc_name")).alias("sources"))
    out = named.join(aliases, group).join(described, group, "left").join(sources, group)
    out = out.select(
        T.entity_id(F.col("entity_type"), F.col("name")).alias("entity_id"),
        "name",
        "entity_type",
        F.filter("aliases", lambda a: F.lower(a) != F.lower(F.col("name"))).alias("aliases"),
        F.coalesce("description", F.lit("")).alias("description"),
        "sources",
        F.col("home").alias("seq"),
    )
    label = own.select("entity_type", F.col("cluster").alias("_c"), F.col("name").alias("_n"))
    flags = pairs.where("flagged_with is not null").select("entity_type", "seq", "flagged_with", "similarity")
    a, b = (label.select("entity_type", F.col("_c").alias(k), F.col("_n").alias(f"entity_{x}")) for k, x in (("seq", "a"), ("flagged_with", "b")))
    return out, flags.join(a, ["entity_type", "seq"]).join(b, ["entity_type", "flagged_with"]).select("entity_a", "entity_b", "entity_type", "similarity")


def alias_map(entities: DataFrame, seq: str = "seq") -> DataFrame:
    """(alias, entity_id): a name owned as canonical goes to the last owner, another to the first claimant."""
    names = entities.select("entity_id", F.col(seq).alias("_seq"), F.posexplode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("_i", "_n"))
    canonical = F.col("_i") == 0
    order = F.struct(~canonical, F.when(canonical, -F.col("_seq")).otherwise(F.col("_seq")))
    return names.groupBy(F.lower("_n").alias("alias")).agg(F.min_by("entity_id", order).alias("entity_id"))


def registry(entities: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """One row: entity_count, the entities by type and name, and the ambiguous pairs, null if there are none.

    It is the registry as one document and grows with it; ``entities`` itself is the table to work with.
    """
    fields = ["entity_id", "name", "entity_type", "aliases", "description", "sources"]
    listed = F.array_sort(F.collect_list(F.struct("entity_type", "name", F.struct(*fields).alias("e"))))
    pairs = F.array_sort(F.collect_list(F.struct("entity_a", "entity_b", "entity_type", "similarity")))
    e = entities.agg(F.count("*").alias("entity_count"), F.transform(listed, lambda s: s.e).alias("entities"))
    return e.crossJoin(ambiguous.agg(F.when(F.count("*") > 0, pairs).alias("ambiguous_candidates")))


def last_rows(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the last in ``order``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[o.desc() for o in order]))
    return rows.withColumn("_r", rank).where("_r = 1").drop("_r")
