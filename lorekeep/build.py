"""From a folder of documents to a loaded graph: the steps as a table each, and a command line.

    python -m lorekeep.build all --source FOLDER --store FOLDER --models package.module:models

Steps, in order: extract, chunk, ner, relations, resolve, load, embed.  ``all`` runs them but for chunk, which
load does itself.  A table is written as a new version and the version before is kept, so a step can read what
it replaces, and a run that fails leaves the last one whole.  What a step has done for a document isn't done again
unless ``force`` is set.
"""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekeep.functions import text as T
from lorekeep.operators import extraction as E
from lorekeep.operators import graph as G
from lorekeep.operators import resolution as R
from lorekeep.operators import segments as S
from lorekeep.shared import materialize
from lorekeep.sources import tables as D
from lorekeep.streaming import incremental as I


@dataclass
class Models:
    """What is called for what Spark can't do; a step whose model is missing raises."""

    parse_pdf: Callable[[bytes], list[str]] | None = None
    #: (section text) -> JSON of entities; (section text, constraints, names) -> JSON of relations.
    entities: Callable[[str], str] | None = None
    relations: Callable[[str, str, str], str] | None = None
    embed: Callable[[list[str]], list[list[float]]] | None = None


class Store:
    """A folder of tables, each a folder of versions."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _versions(self, name: str) -> list[int]:
        """The versions that were written to their end."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        found = [s.getPath() for s in fs.listStatus(folder)]
        done = [p for p in found if p.getName().isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName()) for p in done)

    def has(self, name: str) -> bool:
        return bool(self._versions(name))

    def get(self, name: str) -> DataFrame:
        versions = self._versions(name)
        if not versions:
            raise ValueError(f"the table {name} hasn't been made yet")
        return self.spark.read.parquet(f"{self.path}/{name}/{versions[-1]}")

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        version = max([0, *self._versions(name)]) + 1
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/{version}")
        return self.get(name)


class Build:
    def __init__(self, spark: SparkSession, store: str, models: Models | None = None, force: bool = False):
        self.spark, self.store, self.models, self.force = spark, Store(spark, store), models or Models(), force

    def _kept(self, name: str, new: Callable[[DataFrame], DataFrame], docs: DataFrame) -> DataFrame:
        """A table by document: what is new for the documents that it doesn't have yet, with what it has."""
        if not self.store.has(name):
            return self.store.put(name, new(docs))
        old = self.store.get(name)
        return self.store.put(name, I.with_cached(new(I.pending(docs, old, force=self.force)), old))

    def extract(self, source: str, clean: bool = True) -> DataFrame:
        """texts (doc_name, text): markdown files, and PDF files if there is a parser; files that it fails on are in ``unreadable``."""
        docs = D.markdown(self.spark, source)
        if self.models.parse_pdf:
            docs = docs.unionByName(D.marked(D.pdf_pages(self.spark, source, self.models.parse_pdf, skip=True)))
            self.store.put("unreadable", D.unreadable(self.spark, source, self.models.parse_pdf))
        return self._kept("texts", lambda d: d.withColumn("text", T.clean(F.col("text"))) if clean else d, docs)

    def chunk(self) -> DataFrame:
        return self.store.put("chunks", S.chunked(self.store.get("texts")))

    def ner(self, **calls) -> DataFrame:
        """entities (doc_name, section_pos, seq ...): every entity that passed, in the order of documents, sections and answers."""
        if not self.models.entities:
            raise ValueError("no model proposes entities")

        def ask(docs: DataFrame) -> DataFrame:
            sections = E.to_extract(S.sections(docs.join(self.store.get("texts"), "doc_name")))
            return E.with_model(sections, self.models.entities, ["text"], **calls)

        raw = self._kept("entity_answers", ask, self.store.get("texts").select("doc_name"))
        key = F.struct("doc_name", "section_pos")
        found = E.entities(E.parsed_entities(raw.withColumn("section_id", F.to_json(key))))
        place = F.from_json("source_section", "doc_name string, section_pos int")
        found = found.select(place.alias("_p"), "*").select("_p.*", "*").drop("_p")
        return self.store.put("entities", found.withColumn("seq", F.xxhash64("doc_name", "section_pos", "name", "entity_type")))

    def relations(self, **calls) -> DataFrame:
        """relations: every proposed relation with its reason if it was rejected; documents without entities aren't asked about."""
        if not self.models.relations:
            raise ValueError("no model proposes relations")
        entities = self.store.get("entities")
        names = E.names_by_document(entities)

        def ask(docs: DataFrame) -> DataFrame:
            sections = S.sections(docs.join(self.store.get("texts"), "doc_name"), "relations")
            rows = E.to_extract(sections, entities).join(names, "doc_name").withColumns({"constraints": F.lit(E.constraint_text()), "names": E.names_text(F.col("names"))})
            return E.with_model(rows, self.models.relations, ["text", "constraints", "names"], **calls)

        raw = self._kept("relation_answers", ask, self.store.get("texts").select("doc_name"))
        every = entities.select("name").unionAll(entities.select(F.explode("aliases")))
        return self.store.put("relations", E.validated(E.parsed_relations(raw), every))

    def resolve(self) -> DataFrame:
        """registry, ambiguous and aliases."""
        e = self.store.get("entities")
        order = e.select("seq", F.struct("doc_name", "section_pos", "name", "entity_type").alias("_at")).distinct()
        # Numbers in the order of documents: ranges are sorted on all executors, only their sizes meet.
        numbered = ordered_numbers(order, "_at").select("seq", F.col("_number").alias("_n"))
        e = e.join(numbered, "seq").drop("seq").withColumnRenamed("_n", "seq").dropDuplicates(["seq"])
        canonical, ambiguous = R.resolve(e)
        canonical = self.store.put("registry", canonical)
        self.store.put("ambiguous", ambiguous)
        self.store.put("aliases", R.alias_map(canonical))
        return canonical

    def load(self) -> dict[str, int]:
        """nodes, edges, properties, chunks, documents, mentions; how many there are of each."""
        registry, aliases = self.store.get("registry"), self.store.get("aliases")
        chunks = self.chunk()
        documents = self.store.put("documents", G.document_nodes(chunks))
        nodes = self.store.put("nodes", G.nodes(registry))
        valid = self.store.get("relations").where("reject_reason is null")
        linked = G.resolved(valid, registry)
        order = [F.col(c) for c in ("source_section", "head_name", "tail_name", "confidence")]
        self.store.put("edges", G.connected(G.edges(linked, order), nodes))
        self.store.put("properties", G.property_values(linked, order))
        self.store.put("mentions", G.linked_mentions(G.mentions(chunks, aliases), chunks, nodes))
        self.store.put("chunk_documents", G.chunk_documents(chunks, documents))
        return {name: self.store.get(name).count() for name in ("nodes", "edges", "properties", "chunks", "documents", "mentions", "chunk_documents")}

    def embed(self) -> dict[str, DataFrame]:
        """chunk_vectors and entity_vectors: only what has no vector yet is embedded."""
        if not self.models.embed:
            raise ValueError("no model embeds")
        out = {}
        nodes = self.store.get("nodes")
        told = nodes.select("entity_id", T.entity_description(F.col("label"), F.col("name"), F.col("P3_has_note")).alias("text"))
        for name, key, rows in (("chunk_vectors", "chunk_id", self.store.get("chunks").select("chunk_id", "text")), ("entity_vectors", "entity_id", told)):
            old = self.store.get(name) if self.store.has(name) and not self.force else None
            new = rows if old is None else G.without_vector(rows, old, key)
            new = E.embedded(new, self.models.embed, T.for_document(F.col("text"))).select(key, "embedding")
            out[name] = self.store.put(name, new if old is None else G.upserted(old, new, [key]))
        return out

    def report(self) -> DataFrame:
        """(doc_name, n_entities, n_relations)"""
        relations = self.store.get("relation_answers").select("doc_name", "section_id").join(self.store.get("relations").where("reject_reason is null").select(F.col("source_section").alias("section_id")), "section_id")
        return G.document_totals(self.store.get("entities"), relations)

    def all(self, source: str, clean: bool = True, **calls) -> dict[str, int]:
        self.extract(source, clean)
        self.ner(**calls)
        self.relations(**calls)
        self.resolve()
        counts = self.load()
        self.embed()
        return counts


def ordered_numbers(rows: DataFrame, order: str, name: str = "_number") -> DataFrame:
    """Add numbers from 0 in the order of a column: within ranges of it, after the sizes of the ranges before."""
    d = rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("_m", F.monotonically_increasing_id())
    # Written: another run of the plan could cut the ranges elsewhere.
    d = materialize(d.withColumns({"_part": F.shiftright("_m", 33), "_in": F.col("_m").bitwiseAND((1 << 33) - 1)}), "numbered")
    # Sizes of ranges: as many rows as there are partitions.
    sizes = d.groupBy("_part").agg(F.count("*").alias("n")).collect()
    before, done = {}, 0
    for r in sorted(sizes, key=lambda r: r["_part"]):
        before[r["_part"]], done = done, done + r["n"]
    starts = rows.sparkSession.createDataFrame(list(before.items()) or [(0, 0)], "_part long, _before long")
    return d.join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + F.col("_in")).drop("_m", "_part", "_in", "_before")


def main(arguments: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="lorekeep.build", description="Build a knowledge graph from documents.")
    p.add_argument("step", choices=("extract", "chunk", "ner", "relations", "resolve", "load", "embed", "all"))
    p.add_argument("--source", help="folder of documents, for extract and all")
    p.add_argument("--store", required=True, help="folder of tables")
    p.add_argument("--models", help="package.module:name of a Models object")
    p.add_argument("--force", action="store_true", help="do again what was done")
    p.add_argument("--no-clean", action="store_true", help="leave texts as they are")
    a = p.parse_args(arguments)
    models = None
    if a.models:
        module, name = a.models.split(":")
        models = getattr(importlib.import_module(module), name)
    if a.step in ("extract", "all") and not a.source:
        p.error("--source is needed")
    b = Build(SparkSession.builder.appName("lorekeep").getOrCreate(), a.store, models, a.force)
    if a.step in ("extract", "all"):
        out = getattr(b, a.step)(a.source, not a.no_clean)
    else:
        out = getattr(b, a.step)()
    print(out if isinstance(out, dict) else f"{a.step}: done")


if __name__ == "__main__":
    main()
