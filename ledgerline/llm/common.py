"""What the operators share: column access, row keys, tables that cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``_row`` holds every input column, so no name can clash; a document is known by (``_id``, ``_h``).

    ``_h`` hashes the text: rows that repeat an id with another text stay apart, rows
    that repeat id and text are one document given more than once.
    """
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(f"`{doc_id}`").cast("long").alias("_id"),
        F.xxhash64(text_of(text)).alias("_h"),
        text_of(text).alias("_text"),
    )


class Scratch:
    """Written tables in the folder that all executors share; they cut lineage and survive lost executors.

    The cluster names the folder in ``spark.checkpoint.dir``; else that given to
    ``SparkContext.setCheckpointDir`` counts. Only a session on this one machine
    (tests) gets a folder of its own.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        root = folder or spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            root = spark.sparkContext.getCheckpointDir()
        if not root and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-"))
            root = spark.sparkContext.getCheckpointDir()
        if not root:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        self.root = f"{root.rstrip('/')}/ledgerline-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Removes a table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
