"""Tables in the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which driver and executors share.

    Where a local session names none, as in tests, one below the warehouse is set; a cluster's session must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, df: DataFrame) -> None:
    """Remove a table that ``materialize`` wrote, once nothing reads it any more."""
    for f in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether a table has no more rows than that; reads no more than it needs."""
    return df.limit(rows + 1).count() <= rows
