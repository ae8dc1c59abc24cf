"""Answering: graph chunks, vector top-k, their merge, and the prompt, each a plan that returns few rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from lorekeep.functions.text import display
from lorekeep.functions.vectors import cosine, norm
from lorekeep.operators import graph as G
from lorekeep.operators.nearest import nearest_each, probed_lists, with_probes
from lorekeep.shared import drop_written, materialize, shared_dir

BOOST = 0.3
#: What is said where nothing can be looked up.
NO_QUERY = "Please select entities from the sidebar or enter a text query."
ONE_ENTITY = "Single entity selected — no path check needed."
NO_PAIRS = "Path check completed — no pairs to evaluate."
SYSTEM = (
    "Answer from the knowledge graph context and source text below and from nothing else. Name the graph paths that support a connection; where there is none, "
    "say so and don't make one up. If the context doesn't hold the answer, say that. Refer to source chunks by their numbers, as in [1]."
)


def graph_chunks(chunks: DataFrame, mentions: DataFrame, nodes: DataFrame, seeds: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` chunks that mention most of the seeds: (chunk_id, text, source, entity_count, mentioned_entities)."""
    s = seeds.select("entity_id").distinct()
    hit = mentions.join(s, "entity_id", "left_semi").join(nodes.select("entity_id", "name"), "entity_id")
    best = hit.groupBy("chunk_id").agg(F.countDistinct("entity_id").alias("entity_count"), F.array_sort(F.collect_set("name")).alias("mentioned_entities"))
    best = best.join(chunks.select("chunk_id"), "chunk_id", "left_semi").orderBy(F.desc("entity_count"), "chunk_id").limit(k)
    # The texts are fetched for the k winners only.
    return chunks.select("chunk_id", "text", F.col("document_name").alias("source")).join(F.broadcast(best), "chunk_id")


def vector_chunks(chunks: DataFrame, vectors: DataFrame, query: list[float] | DataFrame, k: int = 10, scale: str = "raw", exclude: str | None = None) -> DataFrame:
    """The ``k`` chunks nearest to a vector, by exact cosine: (chunk_id, text, source, score).

    ``query`` is a vector or a frame of one row with a column ``embedding``.
    """
    if isinstance(query, DataFrame):
        scored = vectors.crossJoin(F.broadcast(query.select(F.col("embedding").alias("_q")).limit(1)))
    else:
        scored = vectors.withColumn("_q", F.array(*[F.lit(float(x)) for x in query]))
    scored = scored.select("chunk_id", cosine(F.col("embedding"), F.col("_q"), scale).alias("score")).where("score is not null")
    scored = scored.where(F.col("chunk_id") != exclude) if exclude else scored
    scored = scored.join(chunks.select("chunk_id"), "chunk_id", "left_semi")
    best = scored.orderBy(F.desc("score"), "chunk_id").limit(k)
    return chunks.select("chunk_id", "text", F.col("document_name").alias("source")).join(F.broadcast(best), "chunk_id")


def vector_chunks_each(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """For each of (query_id, embedding) the ``k`` nearest chunks, by exact cosine: (query_id, chunk_id, score)."""
    return nearest_each(vectors.select("chunk_id", "embedding"), queries.select("query_id", F.col("embedding").alias("_q")), k)


def vector_index(vectors: DataFrame, lists: int | None = None, sample: int = 20_000, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """An inverted-file index for approximate search: (chunk_id, embedding, list) of every vector, and (list, centre).

    The centres are fitted by cosine on at most ``sample`` vectors, the first in the order of a hash of chunk_id; every vector
    is filed under its nearest one.  Both tables are written to the shared folder, the first in a folder a list, so that a
    search reads the lists it probes and no others.  ``lists`` is the root of the number of vectors, 1,024 at most.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark = vectors.sparkSession
    rows = vectors.select("chunk_id", "embedding").where("embedding is not null")
    rows = rows.where(norm(F.col("embedding")) > 0).withColumn("features", array_to_vector("embedding"))
    some = materialize(rows.orderBy(F.xxhash64("chunk_id"), "chunk_id").limit(sample), "sample")
    k = lists or max(1, min(1024, round(rows.count() ** 0.5)))
    model = KMeans(k=max(2, k), seed=seed, distanceMeasure="cosine", maxIter=15).fit(some)
    path = shared_dir(spark, "index")
    # Dealt by list first, or each task would write a file for every list.
    model.transform(rows).select("chunk_id", "embedding", F.col("prediction").alias("list")).hint("rebalance", "list").write.partitionBy("list").parquet(path)
    centres = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "list int, centre array<double>")
    drop_written(spark, some)
    return spark.read.parquet(path), centres


def search_index(index: DataFrame, centres: DataFrame, queries: DataFrame, k: int = 10, probes: int = 8) -> DataFrame:
    """As ``vector_chunks_each``, but only among the vectors in the ``probes`` lists whose centres are nearest to a query."""
    q = queries.select("query_id", F.col("embedding").alias("_q"))
    # Centres are at most 1,024 rows, and so are the lists that are probed.
    probed = with_probes(q, sorted((r.list, r.centre) for r in centres.collect()), probes)
    lists = F.broadcast(probed.select(F.explode(probed_lists("_lists")).alias("list")).distinct())
    return nearest_each(index.join(lists, "list", "left_semi").select("chunk_id", "embedding", "list"), probed, k)


def chunks_with(chunks: DataFrame, term: str, most: int = 1) -> DataFrame:
    """(chunk_id) of the first chunks that hold a term, whatever its case: seeds for a search by what is like them."""
    return chunks.where(F.contains(F.lower("text"), F.lit(term.lower()))).select("chunk_id").orderBy("chunk_id").limit(most)


def entities_of(found: DataFrame, mentions: DataFrame, nodes: DataFrame) -> DataFrame:
    """(entity_id, name, n_chunks): what the chunks that were found mention."""
    hit = mentions.join(found.select("chunk_id").distinct(), "chunk_id", "left_semi").groupBy("entity_id").agg(F.countDistinct("chunk_id").alias("n_chunks"))
    return hit.join(nodes.select("entity_id", "name"), "entity_id").select("entity_id", "name", "n_chunks")


def merged_chunks(graph: DataFrame, vector: DataFrame, k: int = 10, boost: float = BOOST) -> DataFrame:
    """Full outer merge: share of the largest coverage, plus similarity and a boost where both found a chunk.

    Ties: chunks of the graph first, in the order of either side's own rank.
    """
    g = graph.select("chunk_id", F.col("text").alias("_tg"), F.col("source").alias("_sg"), "entity_count", "mentioned_entities", F.row_number().over(Window.orderBy(F.desc("entity_count"), "chunk_id")).alias("_rg"))
    g = g.withColumn("_share", F.col("entity_count") / F.max("entity_count").over(Window.partitionBy()))
    v = vector.select("chunk_id", F.col("text").alias("_tv"), F.col("source").alias("_sv"), F.col("score").alias("_score"), F.row_number().over(Window.orderBy(F.desc("score"), "chunk_id")).alias("_rv"))
    m = g.join(v, "chunk_id", "full")
    both = F.col("_share").isNotNull() & F.col("_score").isNotNull()
    score = F.when(both, F.col("_share") + F.col("_score") + boost).otherwise(F.coalesce("_share", "_score"))
    origin = F.when(both, "both").when(F.col("_share").isNotNull(), "graph").otherwise("vector")
    m = m.withColumns({"score": score, "origin": origin}).orderBy(F.desc("score"), F.col("_rg").isNull(), F.coalesce("_rg", "_rv")).limit(k)
    return m.select("chunk_id", F.coalesce("_tg", "_tv").alias("text"), F.coalesce("_sg", "_sv").alias("source"), "entity_count", "mentioned_entities", "score", "origin")


def connection_lines(paths: DataFrame, nodes: DataFrame, most: int = 3) -> DataFrame:
    """(from_id, to_id, line) for each pair of seeds."""
    names = nodes.select("entity_id", "name")
    a, b = (names.select(F.col("entity_id").alias(i), F.col("name").alias(n)) for i, n in (("from_id", "_from"), ("to_id", "_to")))
    shown = F.array_join(F.transform("rel_types", lambda r: display(r, "code")), " -> ")
    found = F.concat(F.col("_from"), F.lit(" -> "), F.col("_to"), F.lit(": connected in "), F.col("hops").cast("string"), F.lit(" hop(s) via ["), shown, F.lit("]"))
    none = F.concat(F.lit("No connection found between "), F.col("_from"), F.lit(" and "), F.col("_to"), F.lit(f" (within {most} hops)"))
    return paths.join(a, "from_id").join(b, "to_id").select("from_id", "to_id", F.when(F.col("hops") < 0, none).otherwise(found).alias("line"))


def connection_status(lines: DataFrame, n_seeds: int) -> DataFrame:
    """One row: all lines, or what is said without any."""
    if n_seeds < 2:
        return lines.sparkSession.range(1).select(F.lit(ONE_ENTITY).alias("status"))
    ordered = F.array_sort(F.collect_list(F.struct("from_id", "to_id", "line")))
    text = F.array_join(F.transform(ordered, lambda s: s.line), "\n")
    return lines.agg(F.when(F.count("*") == 0, F.lit(NO_PAIRS)).otherwise(text).alias("status"))


def triple_line(subject: Column, relation: Column, other: Column) -> Column:
    return F.concat(F.lit("  - "), subject, F.lit(" — "), display(relation), F.lit(" — "), other)


def entity_sections(details: DataFrame, triples: DataFrame) -> DataFrame:
    """(entity_id, section): an entity with the triples whose subject bears its name."""
    t = triples.groupBy(F.col("subject").alias("_s")).agg(F.array_sort(F.collect_list(F.struct("relationship", "object", triple_line(F.col("subject"), F.col("relationship"), F.col("object")).alias("l")))).alias("_t"))
    d = details.join(t, details["name"] == t["_s"], "left")
    head = F.concat(F.lit("### Entity: "), F.col("name"), F.lit(" ("), F.col("type"), F.lit(")\nGraph connections:"))
    body = F.when(F.col("_t").isNull(), F.lit(" (none retrieved)")).otherwise(F.concat(F.lit("\n"), F.array_join(F.transform("_t", lambda s: s.l), "\n")))
    return d.select("entity_id", F.concat(head, body).alias("section"))


def source_lines(chunks: DataFrame, order: list[Column], scored: bool) -> DataFrame:
    """(rank, line): chunks as numbered sources."""
    score = F.format_string(" (relevance: %.3f)", "score") if scored else F.lit("")
    rank = F.row_number().over(Window.orderBy(*order))
    from lorekeep.functions.text import strip

    return chunks.withColumn("rank", rank).select("rank", F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] Source: "), F.coalesce("source", F.lit("unknown")), score, F.lit("\n"), strip(F.coalesce("text", F.lit("")))).alias("line"))


def prompt(question: str | None, sections: DataFrame | None, sources: DataFrame, status: DataFrame | None, triples: DataFrame | None = None) -> DataFrame:
    """One row, ``content``: the parts of a prompt in their fixed order, those without content left out."""
    asked = f"## User Query\n{question}" if question else "## User Query\n(No text query — browsing selected entities)"
    out = sources.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "line"))), lambda s: s.line), "\n\n").alias("_s"))
    out = out.select(F.lit(asked).alias("_q"), F.concat(F.lit("## Retrieved Context\n"), F.when(F.col("_s") == "", F.lit("(no source chunks retrieved)")).otherwise(F.col("_s"))).alias("_s"))
    if sections is not None:
        e = sections.agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("entity_id", "section"))), lambda s: s.section), "\n\n").alias("t"))
        out = out.crossJoin(e.select(F.when(F.col("n") > 0, F.concat(F.lit("## Selected Entities ("), F.col("n").cast("string"), F.lit(")\n\n"), F.col("t"))).alias("_e")))
    elif triples is not None:
        lines = F.array_sort(F.collect_list(triple_line(F.col("subject"), F.col("relationship"), F.col("object"))))
        out = out.crossJoin(triples.agg(F.when(F.count("*") > 0, F.concat(F.lit("## Graph Connections\n"), F.array_join(lines, "\n"))).alias("_e")))
    else:
        out = out.withColumn("_e", F.lit(None).cast("string"))
    if status is not None:
        out = out.crossJoin(status.select(F.concat(F.lit("## Connection Status\n"), F.col("status")).alias("_c")))
    else:
        out = out.withColumn("_c", F.lit(None).cast("string"))
    return out.select(F.concat_ws("\n\n", "_q", "_e", "_s", "_c").alias("content"))


class Graph:
    """The tables of a loaded graph, and the queries a client asks of them."""

    def __init__(self, nodes: DataFrame, edges: DataFrame, chunks: DataFrame, mentions: DataFrame, vectors: DataFrame | None = None, embed: Callable[[str], list[float]] | None = None, answer: Callable[[str], str] | None = None):
        self.nodes, self.edges, self.chunks, self.mentions, self.vectors = nodes, edges, chunks, mentions, vectors
        self.embed, self.answer = embed, answer or (lambda content: content)

    def seeds(self, ids: list[str]) -> DataFrame:
        return self.nodes.sparkSession.createDataFrame([(i,) for i in dict.fromkeys(ids)], "entity_id string")

    def query(self, filters: list[str] | None = None, question: str | None = None, k: int = 10, mode: str = "graph") -> dict:
        """Route a request: entities, text, both, or neither."""
        asked = bool(question and question.strip())
        if mode == "naive":
            if not asked:
                raise ValueError("a naive query needs a question")
            return self._by_vector(question, k)
        if filters:
            return self._by_graph(filters, question if asked else None, k)
        if asked:
            return self._by_vector(question, k)
        return {"answer": NO_QUERY, "sources": [], "stats": {"retrieval_method": "none", "path": "none"}}

    def _by_vector(self, question: str, k: int) -> dict:
        rows = vector_chunks(self.chunks, self.vectors, self.embed(question), k).orderBy(F.desc("score"), "chunk_id").collect()
        sources = self.nodes.sparkSession.createDataFrame(rows, "chunk_id string, text string, source string, score double")
        content = prompt(question, None, source_lines(sources, [F.desc("score"), F.col("chunk_id")], True), None).first().content
        return {"answer": self.answer(content), "sources": [_source(r) for r in rows], "stats": {"retrieval_method": "vector_search", "path": "B", "chunks_retrieved": len(rows)}}

    def _by_graph(self, ids: list[str], question: str | None, k: int) -> dict:
        seeds = self.seeds(ids)
        details, triples = G.details(self.nodes, seeds).cache(), G.triples(self.nodes, self.edges, seeds).cache()
        lines = connection_lines(G.shortest_paths(self.nodes, self.edges, seeds), self.nodes)
        status = connection_status(lines, len(ids)).cache()
        chunks = found = graph_chunks(self.chunks, self.mentions, self.nodes, seeds, k).cache()
        order = [F.desc("entity_count"), F.col("chunk_id")]
        vector = None
        if question:
            vector = vector_chunks(self.chunks, self.vectors, self.embed(question), k).cache()
            chunks = merged_chunks(found, vector, k).cache()
            order = [F.desc("score"), F.col("entity_count").isNull(), F.desc("entity_count"), F.col("chunk_id")]
        content = prompt(question, entity_sections(details, triples), source_lines(chunks, order, question is not None), status).first().content
        rows, evidence = chunks.orderBy(*order).collect(), triples.orderBy("subject", "relationship", "object").collect()
        stats = {"retrieval_method": "hybrid_graph_vector" if question else "graph_traversal", "path": "C" if question else "A", "entities_selected": len(ids), "triples_retrieved": len(evidence)}
        stats |= {"graph_chunks": found.count(), "vector_chunks": vector.count(), "merged_chunks": len(rows)} if question else {"chunks_retrieved": len(rows)}
        out = {"answer": self.answer(content), "sources": [_source(r) for r in rows], "evidence_triples": [r.asDict() for r in evidence], "connection_status": status.first().status, "stats": stats}
        for d in (details, triples, status, found, *([vector, chunks] if question else [])):
            d.unpersist()
        return out

    def entities(self) -> DataFrame:
        return G.by_category(G.mention_counts(self.nodes, self.mentions))

    def health(self) -> dict:
        return {"status": "ok" if self.nodes.sparkSession.sql("SELECT 1 AS one").first().one == 1 else "error"}


def _source(r: Row) -> dict:
    """The fields of a source that a row has."""
    return {f: r[f] for f in ("chunk_id", "source", "score", "origin", "mentioned_entities") if f in r.__fields__ and r[f] is not None}
