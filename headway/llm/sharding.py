"""Shards that all hold the mixture: proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked; the rank's middle,
as a fraction of the source, says how far through the whole the row stands. All
rows sorted by that fraction and cut at equal counts give shards whose sources
are mixed as in the whole. Both ranks are global sorts by range, so a source that
holds a third of all rows is spread like any other.

The law is ``rows``: shard sizes differ by one row at most. Null texts count as
empty, a null source is a source of its own, rows that repeat are ranked each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.staging import staged

SHARDS = 16
SEED = 20240501


def numbered(df: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """``df`` with ``position`` from 0 in the given order, and the number of rows.

    Rows are dealt by range and sorted in their partitions; only the partitions'
    sizes reach the driver.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(
        dealt.withColumn("part", F.spark_partition_id()).withColumn(
            "in_part", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        )
    )
    sizes = sorted((r["part"], r["count"]) for r in placed.groupBy("part").count().collect())
    before, total = [], 0
    for part, count in sizes:
        before.append((part, total))
        total += count
    offsets = df.sparkSession.createDataFrame(before, "part int, rows_before long")
    found = placed.join(F.broadcast(offsets), "part").withColumn("position", F.col("rows_before") + F.col("in_part"))
    return found.drop("part", "in_part", "rows_before"), total


def shards(docs: DataFrame, count: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.col("source").alias("stratum"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "text_crc32"))
    ranked, _ = numbered(rows, "stratum", "draw", "doc_id", "text_crc32", "size")
    ranked = ranked.withColumnRenamed("position", "rank")
    strata = ranked.groupBy(F.col("stratum").alias("of")).agg(F.min("rank").alias("first"), F.count("*").alias("rows"))
    through = ranked.join(strata, F.col("stratum").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "text_crc32", "draw",
        ((2 * (F.col("rank") - F.col("first")) + 1) / (2 * F.col("rows"))).alias("fraction"),
    )
    placed, total = numbered(through, "fraction", "draw", "doc_id", "text_crc32", "size")
    shard = F.expr(f"(position * {count}) div {max(total, 1)}")
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        # the first position of shard k is k * total / count, rounded up
        (F.col("position") - F.expr(f"(shard * {total} + {count - 1}) div {count}")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
