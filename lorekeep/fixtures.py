"""Adapters from the driver's tables to the tables of the graph; ``catalog.py`` states the same in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekeep import constants as K
from lorekeep.functions.text import slug


class Tables:
    """The driver's tables by name, read when they are used."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    @property
    def texts(self) -> DataFrame:
        """The documents on all cores: a table that comes in fewer pieces than there are cores is dealt out."""
        d, cores = self.__getattr__("documents"), self.spark.sparkContext.defaultParallelism
        return d.repartition(cores) if d.rdd.getNumPartitions() < cores else d


def _id(prefix: str, key) -> F.Column:
    return F.concat(F.lit(f"{prefix}-"), key if isinstance(key, F.Column) else F.col(key).cast("string"))


def nodes(t: Tables) -> DataFrame:
    """(entity_id, label, name)"""
    month = F.date_format("o_orderdate", "yyyy-MM")
    parts = [
        t.region.select(_id("place", slug(F.col("r_name"))), F.lit(K.PLACE), "r_name"),
        t.nation.select(_id("place", slug(F.col("n_name"))), F.lit(K.PLACE), "n_name"),
        t.supplier.select(_id("site", "s_suppkey"), F.lit(K.SITE), "s_name"),
        t.customer.select("c_mktsegment").distinct().select(_id("group", slug(F.col("c_mktsegment"))), F.lit(K.GROUP), "c_mktsegment"),
        t.customer.select(_id("person", "c_custkey"), F.lit(K.PERSON), "c_name"),
        t.part.select(_id("artifact", "p_partkey"), F.lit(K.ARTIFACT), "p_name"),
        t.orders.select(_id("event", "o_orderkey"), F.lit(K.EVENT), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"))),
        t.orders.select(month.alias("m")).distinct().select(_id("period", "m"), F.lit(K.PERIOD), "m"),
        t.documents.select("source").where("source is not null").distinct().select(_id("doc", "source"), F.lit(K.DOCUMENT), "source"),
    ]
    return reduce(DataFrame.unionAll, parts).toDF("entity_id", "label", "name")


def edges(t: Tables) -> DataFrame:
    """(src, rel_type, dst)"""
    nation = t.nation.select(F.col("n_nationkey").alias("k"), _id("place", slug(F.col("n_name"))).alias("place"), "n_regionkey")
    region = t.region.select("r_regionkey", _id("place", slug(F.col("r_name"))).alias("region"))
    customer = t.customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("k")).select("c_custkey", "place")
    orders = t.orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    event = _id("event", "o_orderkey")
    parts = [
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("place", F.lit("P89_FALLS_WITHIN"), "region"),
        t.supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("k")).select(_id("site", "s_suppkey"), F.lit("P53_HAS_FORMER_OR_CURRENT_LOCATION"), "place"),
        t.customer.select(_id("person", "c_custkey"), F.lit("P107I_IS_CURRENT_OR_FORMER_MEMBER_OF"), _id("group", slug(F.col("c_mktsegment")))),
        t.orders.select(event, F.lit("P11_HAD_PARTICIPANT"), _id("person", "o_custkey")),
        orders.select(event, F.lit("P8_TOOK_PLACE_ON_OR_WITHIN"), "place"),
        t.orders.select(event, F.lit("P4_HAS_TIME-SPAN"), _id("period", F.date_format("o_orderdate", "yyyy-MM"))),
    ]
    return reduce(DataFrame.unionAll, parts).toDF("src", "rel_type", "dst")


def chunks(t: Tables) -> DataFrame:
    """(chunk_id, text, document_name): a chunk a document."""
    return t.texts.select(F.concat(F.col("source"), F.lit("-"), F.lpad(F.col("doc_id").cast("string"), 6, "0")).alias("chunk_id"), "text", F.col("source").alias("document_name"), "doc_id")


def aliases(t: Tables) -> DataFrame:
    """(alias, entity_id): the ASCII words of 7 to 12 letters in the benchmark."""
    words = t.benchmark.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+")).alias("alias")).where(F.rlike("alias", F.lit("^[a-z]{7,12}$")))
    return words.distinct().select("alias", F.concat(F.lit("term-"), "alias").alias("entity_id"))


def terms(t: Tables) -> DataFrame:
    """The aliases as nodes."""
    return aliases(t).select("entity_id", F.lit(K.ARTIFACT).alias("label"), F.col("alias").alias("name"))


def vectors(t: Tables) -> DataFrame:
    c = chunks(t).select("chunk_id", "doc_id")
    return t.embeddings.join(c, F.col("vec_id") == F.col("doc_id")).select("chunk_id", "embedding", "vec_id")
