"""Written intermediate tables: they cut lineage and survive lost executors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources.files import fresh_folder, shuffles_removed

ARROW_ROWS = 2000
ARROW_BYTES = "8m"


def bounded_batches(spark: SparkSession) -> None:
    """Hand Python workers a few MB at a time; the session keeps the setting."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def row_key() -> Column:
    """Tells rows of doc_id and text apart, a null or repeated id included; rows alike in both share it."""
    return F.struct(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), F.col("text")).alias("b")
    )


def unused(df: DataFrame, name: str) -> str:
    """``name``, with marks appended until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def staged(df: DataFrame, options: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder, with these writer's options, and read again.

    Later uses read the files, so nothing is computed twice and a lost executor
    loses nothing. The files go when the session's process ends, what the write
    shuffled goes with the write.
    """
    spark = df.sparkSession
    path = f"{fresh_folder(spark, 'llm')}/rows"
    with shuffles_removed(spark):
        df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
