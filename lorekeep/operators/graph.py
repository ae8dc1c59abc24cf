"""Building the property graph: nodes, edges, chunks and mentions as tables.

Upserts are last-row-wins aggregations; infrastructure links are tables of their own, so that
traversals never have to filter them out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorekeep import constants as K
from lorekeep.shared import at_most, drop_written, materialize

#: Broadcast at most so many alias rows; more are joined by shuffle.
BROADCAST_ALIASES = 500_000
#: And so many ends of edges that some shape does not allow.
BROADCAST_SUSPECTS = 50_000
#: Nodes and edges that one task joins.
PART_ROWS = 250_000


def nodes(entities: DataFrame, seq: str = "seq") -> DataFrame:
    """(entity_id, label, name, P3_has_note, aliases): the last entity of each id."""
    last = F.max_by(F.struct(F.col("entity_type").alias("label"), "name", F.col("description").alias("P3_has_note"), "aliases"), F.col(seq))
    return entities.groupBy("entity_id").agg(last.alias("_n")).select("entity_id", "_n.*")


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that aren't unique; a valid table has none."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def resolved(relations: DataFrame, entities: DataFrame, seq: str = "seq") -> DataFrame:
    """Add head_id and tail_id by name without regard to case; of entities that share one the last counts."""
    ids = entities.groupBy(F.lower("name").alias("_l")).agg(F.max_by("entity_id", seq).alias("_id"))
    out = relations
    for side in ("head", "tail"):
        i = ids.select(F.col("_l").alias(f"_l_{side}"), F.col("_id").alias(f"{side}_id"))
        out = out.join(i, F.lower(f"{side}_name") == F.col(f"_l_{side}"), "left").drop(f"_l_{side}")
    return out


def edges(relations: DataFrame, order: list[Column]) -> DataFrame:
    """(src, rel_type, dst, confidence, source_section): the last relation of each (head, type, tail) with both ends."""
    kept = relations.where(~F.col("relation_type").isin(*K.PROPERTIES) & F.col("head_id").isNotNull() & F.col("tail_id").isNotNull())
    last = F.max_by(F.struct("confidence", "source_section"), F.struct(*order))
    out = kept.groupBy(F.col("head_id").alias("src"), F.col("relation_type").alias("rel_type"), F.col("tail_id").alias("dst")).agg(last.alias("_v"))
    return out.select("src", "rel_type", "dst", "_v.*")


def property_values(relations: DataFrame, order: list[Column]) -> DataFrame:
    """(entity_id, P45_CONSISTS_OF, P101_HAD_AS_GENERAL_USE): values in order, joined by comma; loading again changes nothing."""
    kept = relations.where(F.col("relation_type").isin(*K.PROPERTIES) & F.col("head_id").isNotNull())
    listed = [F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("relation_type") == p, F.struct(F.struct(*order).alias("at"), F.col("tail_name").alias("v"))))), lambda s: s.v), ", ").alias(p) for p in K.PROPERTIES]
    out = kept.groupBy(F.col("head_id").alias("entity_id")).agg(*listed)
    return out.select("entity_id", *[F.nullif(p, F.lit("")).alias(p) for p in K.PROPERTIES])


def load_counts(relations: DataFrame) -> DataFrame:
    """(edges, properties, skipped) of resolved relations."""
    prop, head, tail = F.col("relation_type").isin(*K.PROPERTIES), F.col("head_id").isNotNull(), F.col("tail_id").isNotNull()
    return relations.agg(F.count_if(~prop & head & tail).alias("edges"), F.count_if(prop & head).alias("properties"), F.count_if(~head | (~prop & ~tail)).alias("skipped"))


def graph_counts(nodes_: DataFrame, edges_: DataFrame) -> DataFrame:
    one = lambda name, d: d.agg(F.count("*").alias("n")).select(F.lit(name).alias("kind"), "n")
    return one("nodes", nodes_).unionAll(one("edges", edges_))


def upserted(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """The rows of ``new``, of each key the last in ``order``, and those of ``old`` whose key isn't among them.

    Columns that only one side has are null on the other.
    """
    if order:
        row = F.struct(*[F.col(c) for c in new.columns if c not in keys])
        new = new.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row")).select(*keys, "_row.*")
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def chunk_nodes(chunks: DataFrame, order: list[Column]) -> DataFrame:
    """(chunk_id, text, document_name, section_heading, chunk_index): the last row of each chunk_id."""
    fields = ["text", "document_name", "section_heading", "chunk_index"]
    return chunks.groupBy("chunk_id").agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("_c")).select("chunk_id", "_c.*")


def with_vectors(rows: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """Rows with their embedding: the new one of ``vectors`` (key, embedding) where there is one, else their own."""
    new = vectors.where("embedding is not null").select(key, F.col("embedding").alias("_new"))
    own = rows if "embedding" in rows.columns else rows.withColumn("embedding", F.lit(None).cast("array<float>"))
    return own.join(new, key, "left").withColumn("embedding", F.coalesce("_new", "embedding")).drop("_new")


def vector_report(rows: DataFrame) -> DataFrame:
    """(rows, embedded, dimension): how many rows there are, how many have a vector, and the longest one's length (0 without)."""
    return rows.agg(F.count("*").alias("rows"), F.count("embedding").alias("embedded"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("dimension"))


def document_totals(entities: DataFrame, relations: DataFrame, doc: str = "doc_name") -> DataFrame:
    """(doc, n_entities, n_relations) of every document of either table."""
    e = entities.groupBy(doc).agg(F.count("*").alias("n_entities"))
    r = relations.groupBy(doc).agg(F.count("*").alias("n_relations"))
    out = e.join(r, doc, "full")
    return out.select(doc, F.coalesce("n_entities", F.lit(0)).alias("n_entities"), F.coalesce("n_relations", F.lit(0)).alias("n_relations"))


def connected(edges_: DataFrame, nodes_: DataFrame) -> DataFrame:
    """The edges whose two ends are nodes."""
    n = nodes_.select("entity_id").distinct()
    return edges_.join(n.withColumnRenamed("entity_id", "src"), "src", "left_semi").join(n.withColumnRenamed("entity_id", "dst"), "dst", "left_semi")


def document_nodes(chunks: DataFrame) -> DataFrame:
    """(entity_id, name): one node a document of the chunks."""
    return chunks.select("document_name").where("document_name is not null").distinct().select(F.concat(F.lit("doc-"), "document_name").alias("entity_id"), F.col("document_name").alias("name"))


def chunk_documents(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """(chunk_id, entity_id): chunks to the node of their document, by name."""
    return chunks.select("chunk_id", F.col("document_name").alias("name")).join(documents.select("entity_id", "name"), "name").select("chunk_id", "entity_id").distinct()


# ---- mentions -----------------------------------------------------------------------------------------


def _words(text: Column) -> Column:
    """Maximal runs of word characters, those between which patterns see a word boundary."""
    return F.filter(F.split(text, r"(?U)\W+"), lambda w: w != "")


def mentions(chunks: DataFrame, aliases: DataFrame) -> DataFrame:
    """(chunk_id, entity_id): chunks in which an alias of more than two characters occurs as whole words, whatever the case.

    Every word of an alias is a whole word of the text, so chunks and aliases meet by an equi-join on words, an alias by its
    longest one; no text takes part in it.  An alias that is one word is found by that.  The others are looked up in
    the text, which joins the candidates of its chunk once.  Aliases without any word are compared with all chunks.
    """
    a = aliases.where(F.length("alias") > 2).select(F.lower("alias").alias("alias"), "entity_id").distinct()
    a = a.withColumn("_word", F.array_max(F.transform(_words(F.col("alias")), lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))).w)
    kinds = {r.kind: r.n for r in a.select(F.when(F.col("_word").isNull(), "none").when(F.col("_word") == F.col("alias"), "whole").otherwise("part").alias("kind")).groupBy("kind").agg(F.count("*").alias("n")).collect()}
    small = F.broadcast if sum(kinds.values()) <= BROADCAST_ALIASES else (lambda d: d)
    words = chunks.select("chunk_id", F.explode(F.array_distinct(_words(F.lower("text")))).alias("_word"))
    out = words.join(small(a.where("_word = alias").select("_word", "entity_id")), "_word").select("chunk_id", "entity_id")

    def occurs(alias: Column) -> Column:
        pattern = F.concat(F.lit(r"(?iu)(?U)\b\Q"), F.replace(alias, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E\b"))
        return F.contains(F.lower("text"), alias) & F.rlike("text", pattern)

    if kinds.get("part"):
        met = words.join(small(a.where("_word <> alias")), "_word").groupBy("chunk_id").agg(F.collect_set(F.struct("alias", "entity_id")).alias("_met"))
        found = chunks.select("chunk_id", "text").join(met, "chunk_id").select("chunk_id", F.explode(F.filter("_met", lambda m: occurs(m["alias"]))).alias("_m"))
        out = out.unionAll(found.select("chunk_id", "_m.entity_id"))
    if kinds.get("none"):
        out = out.unionAll(chunks.join(small(a.where("_word is null")), occurs(F.col("alias"))).select("chunk_id", "entity_id"))
    return out.distinct()


def linked_mentions(pairs: DataFrame, chunks: DataFrame, nodes_: DataFrame) -> DataFrame:
    """Mentions whose two ends exist."""
    return pairs.join(chunks.select("chunk_id"), "chunk_id", "left_semi").join(nodes_.select("entity_id"), "entity_id", "left_semi").select("chunk_id", "entity_id").distinct()


# ---- validation against shapes --------------------------------------------------------------------------


def violations(nodes_: DataFrame, edges_: DataFrame, literals: DataFrame, only: str | None = None) -> DataFrame:
    """(focus_id, shape, path, constraint, severity, observed) of nodes against the shapes, those of one constraint if ``only`` names it.

    ``literals`` is (entity_id, path, value).  Object paths are checked for number and type of their targets,
    literal paths for number and allowed values; labels and edges no shape knows are warnings.
    """
    spark = nodes_.sparkSession
    # 49 shapes: a constant.
    shapes = F.broadcast(K.shapes_table(spark))
    n = nodes_.select(F.col("entity_id").alias("focus_id"), F.col("label").alias("shape"))
    e = edges_.select(F.col("src").alias("focus_id"), F.col("rel_type").alias("path"), F.col("dst").alias("value"), F.lit(True).alias("_edge"))
    values = e.unionAll(literals.select(F.col("entity_id").alias("focus_id"), "path", "value", F.lit(False)))
    # One row for each node without regard to its values, so that each node and value is joined once; what shapes say is joined after that.
    # Dealt into parts of so many rows, however many there are: left to itself, a task gets what is small while it is compressed.
    parts = 1 if only == "undeclared" else max(1, -(-(nodes_.count() + edges_.count()) // PART_ROWS))
    every = n.repartition(parts, "focus_id").join(values.repartition(parts, "focus_id"), "focus_id", "left")
    report = lambda d, what, seen, severity="Violation": d.select("focus_id", "shape", "path", F.lit(what).alias("constraint"), F.lit(severity).alias("severity"), seen.cast("string").alias("observed"))
    out = []
    if only in (None, "closed"):
        declared = shapes.select("shape", "path", F.lit(True).alias("_declared"))
        out.append(report(every.where("_edge").join(declared, ["shape", "path"], "left").where("_declared is null"), "closed", F.col("value")))
    if only in (None, "class"):
        suspects = materialize(_suspects(nodes_, edges_, parts), "suspects")
        bounded = F.broadcast(suspects) if at_most(suspects, BROADCAST_SUSPECTS) else suspects
        ends = every.where("_edge").join(shapes.where("kind = 'object'").select("shape", "path", "allowed"), ["shape", "path"]).join(bounded.select(F.col("path").alias("_p"), F.col("value").alias("_v"), "_target"), (F.col("path") == F.col("_p")) & F.col("value").eqNullSafe(F.col("_v")))
        out.append(report(ends.where(~F.coalesce(F.array_contains("allowed", F.col("_target")), F.lit(False))), "class", F.coalesce("_target", F.lit("(missing)"))))
    if only in (None, "in"):
        listed = every.where(~F.col("_edge")).join(shapes.where("kind = 'literal' and size(allowed) > 0").select("shape", "path", "allowed"), ["shape", "path"])
        out.append(report(listed.where(~F.array_contains("allowed", F.col("value"))), "in", F.col("value")))
    if only in (None, "minCount", "maxCount"):
        # A row for each node with a number for each path that shapes count, so that no node is joined with what it should have.
        counted = [x for x in K.SHAPES if x[3] > 0 or x[4] is not None]
        paths = sorted({x[1] for x in counted})
        numbers = every.groupBy("focus_id", "shape").agg(*[F.count_if(F.col("path") == p).alias(f"_{i}") for i, p in enumerate(paths)])
        rows = [(s, [(p, paths.index(p), a, b) for t, p, _, a, b, _ in counted if t == s]) for s in sorted({x[0] for x in counted})]
        wanted = F.broadcast(spark.createDataFrame(rows, "shape string, _wanted array<struct<path: string, i: int, least: int, most: int>>"))
        seen = lambda w: F.get(F.col("_n"), w["i"])
        odd = F.filter("_wanted", lambda w: (seen(w) < w["least"]) | (seen(w) > w["most"]))
        found = numbers.withColumn("_n", F.array(*[F.col(f"_{i}") for i in range(len(paths))])).select("focus_id", "shape", "_n").join(wanted, "shape").select("focus_id", "shape", "_n", F.explode(odd).alias("_w"))
        what = F.when(seen(F.col("_w")) < F.col("_w")["least"], "minCount").otherwise("maxCount")
        out.append(found.select("focus_id", "shape", F.col("_w")["path"].alias("path"), what.alias("constraint"), F.lit("Violation").alias("severity"), seen(F.col("_w")).cast("string").alias("observed")))
    if only in (None, "undeclared"):
        unknown = n.join(shapes.select("shape").distinct(), "shape", "left_anti").withColumn("path", F.lit("label"))
        out.append(report(unknown, "undeclared", F.col("shape"), "Warning"))
    return reduce(DataFrame.unionAll, out).where(F.col("constraint") == only if only else F.lit(True))


def _suspects(nodes_: DataFrame, edges_: DataFrame, parts: int) -> DataFrame:
    """(path, value, _target): ends of edges whose label not every shape with that path allows.

    Ends are made distinct before they meet the nodes: many edges share a few, and those would all be one task's.
    """
    objects = [x for x in K.SHAPES if x[2] == "object"]
    common = [(p, sorted(set.intersection(*[set(x[5]) for x in objects if x[1] == p]))) for p in sorted({x[1] for x in objects})]
    rules = F.broadcast(nodes_.sparkSession.createDataFrame(common, "path string, _all array<string>"))
    ends = edges_.select(F.col("rel_type").alias("path"), F.col("dst").alias("value")).distinct()
    labels = nodes_.select(F.col("entity_id").alias("value"), F.col("label").alias("_target")).repartition(parts, "value")
    met = ends.repartition(parts, "value").join(labels, "value", "left").join(rules, "path")
    return met.where(~F.coalesce(F.array_contains("_all", F.col("_target")), F.lit(False))).select("path", "value", "_target")


# ---- traversal --------------------------------------------------------------------------------------------


def details(nodes_: DataFrame, seeds: DataFrame) -> DataFrame:
    """(entity_id, name, type, label) of the seeds that exist."""
    from lorekeep.functions.text import type_label

    return nodes_.join(seeds.select("entity_id").distinct(), "entity_id", "left_semi").select("entity_id", "name", type_label(F.col("label")).alias("type"), "label")


def triples(nodes_: DataFrame, edges_: DataFrame, seeds: DataFrame, hops: int = 2) -> DataFrame:
    """Distinct (subject, relationship, object) names of edges from the seeds and, for two hops, of edges from their targets.

    An edge isn't followed by itself.
    """
    s = seeds.select(F.col("entity_id").alias("src")).distinct()
    first = edges_.join(s, "src", "left_semi").select("src", "rel_type", "dst")
    found = first
    if hops >= 2:
        one = first.select(F.col("src").alias("_s"), F.col("rel_type").alias("_r"), F.col("dst").alias("_d"))
        second = one.join(edges_.select("src", "rel_type", "dst"), F.col("_d") == F.col("src"))
        second = second.where(~((F.col("_s") == F.col("src")) & (F.col("_r") == F.col("rel_type")) & (F.col("_d") == F.col("dst")))).select("src", "rel_type", "dst")
        found = first.unionAll(second).distinct()
    names = nodes_.select("entity_id", "name")
    a, b = (names.select(F.col("entity_id").alias(k), F.col("name").alias(v)) for k, v in (("src", "subject"), ("dst", "object")))
    return found.join(a, "src").join(b, "dst").select("subject", F.col("rel_type").alias("relationship"), "object").distinct()


def shortest_paths(nodes_: DataFrame, edges_: DataFrame, seeds: DataFrame, most: int = 3) -> DataFrame:
    """(from_id, to_id, hops, rel_types) of every pair of seeds, from_id < to_id; hops -1 if none has ``most`` or fewer.

    Edges count in both directions.  Paths are put together in the middle: from every seed, and to every seed, nodes are reached
    in as many hops as half of ``most``; a path of one hop more has an edge between the two.  So the edges are never joined with
    a frontier that has gone through a hub.  Of the shortest paths the first in the order of relation types counts.
    """
    spark, radius = nodes_.sparkSession, most // 2
    ends = materialize(nodes_.join(seeds.select("entity_id").distinct(), "entity_id", "left_semi").select("entity_id"), "ends")
    both = edges_.select("src", "rel_type", "dst").unionAll(edges_.select(F.col("dst").alias("src"), "rel_type", F.col("src").alias("dst"))).where("src <> dst")
    none = F.array().cast("array<string>")
    start = ends.select(F.col("entity_id").alias("seed"), F.col("entity_id").alias("at"), none.alias("rels"))
    out_of, into, written = [start], [start], [ends]
    reached = start.select("seed", "at")
    for _ in range(radius):
        near = out_of[-1].join(into[-1].select("seed", "at", F.col("rels").alias("back")), ["seed", "at"]).withColumnRenamed("at", "src")
        new = near.join(both, "src").groupBy("seed", F.col("dst").alias("at")).agg(F.min(F.array_append("rels", F.col("rel_type"))).alias("rels"), F.min(F.array_prepend("back", F.col("rel_type"))).alias("back"))
        new = materialize(new.join(reached, ["seed", "at"], "left_anti"), "reached")
        written.append(new)
        reached = reached.unionAll(new.select("seed", "at"))
        out_of.append(new.select("seed", "at", "rels"))
        into.append(new.select("seed", "at", F.col("back").alias("rels")))
    pairs = ends.select(F.col("entity_id").alias("from_id")).join(ends.select(F.col("entity_id").alias("to_id")), F.col("from_id") < F.col("to_id"))
    left = [d.select(F.col("seed").alias("from_id"), "at", F.col("rels").alias("_a")) for d in out_of]
    right = [d.select(F.col("seed").alias("to_id"), "at", F.col("rels").alias("_b")) for d in into]
    found = None
    for hops in range(1, most + 1):
        if hops <= 2 * radius:
            one = left[hops - hops // 2].join(right[hops // 2], "at").select("from_id", "to_id", F.concat("_a", "_b").alias("rels"))
        else:
            # Both ends of the edge in the middle are nodes that were reached, so only such edges are joined.
            edge = both.join(left[-1].select(F.col("at").alias("src")).distinct(), "src", "left_semi").join(right[-1].select(F.col("at").alias("dst")).distinct(), "dst", "left_semi").distinct()
            one = left[-1].withColumnRenamed("at", "src").join(edge, "src").join(right[-1].withColumnRenamed("at", "dst"), "dst")
            one = one.select("from_id", "to_id", F.concat(F.array_append("_a", F.col("rel_type")), F.col("_b")).alias("rels"))
        one = one.where("from_id < to_id")
        found = one if found is None else found.unionAll(one)
    best = found.groupBy("from_id", "to_id").agg(F.min(F.struct(F.size("rels").alias("hops"), "rels")).alias("_p"))
    out = pairs.join(best, ["from_id", "to_id"], "left").select("from_id", "to_id", F.coalesce("_p.hops", F.lit(-1)).alias("hops"), F.coalesce("_p.rels", none).alias("rel_types"))
    # A row for each pair of seeds: written, so that what it was made from can go.
    out = materialize(out, "paths")
    for t in written:
        drop_written(spark, t)
    return out


def mention_counts(nodes_: DataFrame, mentions_: DataFrame) -> DataFrame:
    """(entity_id, label, name, mention_count), zeroes included."""
    counts = mentions_.groupBy("entity_id").agg(F.count("chunk_id").alias("_n"))
    return nodes_.select("entity_id", "label", "name").join(counts, "entity_id", "left").select("entity_id", "label", "name", F.coalesce("_n", F.lit(0)).alias("mention_count"))


def with_category(counts: DataFrame) -> DataFrame:
    """Add category and type."""
    from lorekeep.functions.text import type_label

    category = F.coalesce(*[F.when(F.col("label") == c, g) for c, g in K.CATEGORY.items()], F.lit(K.OTHER))
    return counts.withColumn("category", category).withColumn("type", type_label(F.col("label")))


def category_totals(counts: DataFrame) -> DataFrame:
    """(category, n_entities, n_mentions, first_entity) of every category; no row grows with it."""
    order = F.struct(-F.col("mention_count"), F.col("entity_id"))
    e = with_category(counts).groupBy("category").agg(F.count("*").alias("n_entities"), F.sum("mention_count").alias("n_mentions"), F.min_by("entity_id", order).alias("first_entity"))
    names = counts.sparkSession.createDataFrame([(c,) for c in K.CATEGORIES], "category string")
    out = names.join(e, "category", "full")
    return out.select("category", F.coalesce("n_entities", F.lit(0)).alias("n_entities"), F.coalesce("n_mentions", F.lit(0)).alias("n_mentions"), "first_entity")


def by_category(counts: DataFrame, most: int | None = None) -> DataFrame:
    """(category, entities): every category, entities by falling mention count, the first ``most`` of them if that is given."""
    spark = counts.sparkSession
    e = with_category(counts)
    if most is not None:
        rank = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("mention_count"), "entity_id"))
        e = e.withColumn("_rank", rank).where(F.col("_rank") <= most)
    listed = F.array_sort(F.collect_list(F.struct((-F.col("mention_count")).alias("k"), "entity_id", "name", "type", "mention_count")))
    e = e.groupBy("category").agg(listed.alias("_e"))
    names = spark.createDataFrame([(c,) for c in K.CATEGORIES], "category string").unionByName(e.select("category")).distinct()
    out = names.join(e, "category", "left")
    return out.select("category", F.transform(F.coalesce("_e", F.expr("array()").cast(e.schema["_e"].dataType)), lambda s: F.struct(*[s[f].alias(f) for f in ("entity_id", "name", "type", "mention_count")])).alias("entities"))


def without_vector(rows: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """Rows that have no vector yet."""
    return rows.join(vectors.where("embedding is not null").select(key), key, "left_anti")


def ranked(order: list[Column]) -> Column:
    return F.row_number().over(Window.orderBy(*order))
