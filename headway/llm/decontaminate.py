"""Benchmark items inside documents: size-partitioned MinHash, then exact containment.

An item counts as leaked into a document that contains at least 80 % of the
item's distinct five-word shingles. Items are partitioned by the size of their
shingle set (powers of two). A partition's sketches hold the k least shingle
hashes of each item, k being one more than the most that its largest set may
lack: a document that contains enough of an item must then hold one of its
sketch's hashes, so the search misses nothing, however long the document is.
Every document's shingles are looked up in the sketches, and the pairs that meet
are verified on the shingles themselves.

Only DataFrame functions are used. Words are runs of letters and digits in lower
case. Null or empty texts contain nothing; items of fewer than five words have no
shingle and are never found. Repeated items are reported once, repeated documents
once per row; a null ``doc_id`` is reported as null, a null ``item_id`` likewise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.staging import row_key, unused

WIDTH = 5
PERCENT = 80
BROADCAST_ROWS = 1_000_000


def _words(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def _windows(words: str, of) -> Column:
    """``of`` applied to every WIDTH consecutive words of an array column."""
    last = F.size(words) - WIDTH
    every = F.transform(F.sequence(F.lit(0), last), lambda i: of(*(F.get(words, i + k) for k in range(WIDTH))))
    return F.when(last >= 0, every)


def _hash(*words: Column) -> Column:
    return F.xxhash64(*words)


def _phrase(*words: Column) -> Column:
    return F.concat_ws(" ", *words)


def _lacking(size: Column) -> Column:
    """The most members that a contained set of this size may lack."""
    return size - F.ceil(size * F.lit(PERCENT) / 100)


def item_sets(benchmark: DataFrame) -> DataFrame:
    """item_id and its distinct shingles, as phrases."""
    words = benchmark.select(F.col("item_id").alias("item_id"), _words(F.col("text")).alias("item_words"))
    return (
        words.select("item_id", F.array_distinct(_windows("item_words", _phrase)).alias("phrases"))
        .where(F.size("phrases") > 0)
        .distinct()
    )


def sketches(items: DataFrame) -> DataFrame:
    """One row for each sketch hash and item."""
    size = F.size("phrases")
    partition = F.floor(F.log2(size))
    sized = items.select("item_id", "phrases", (F.pow(2, partition + 1) - 1).cast("int").alias("largest"))
    hashes = F.array_sort(F.transform("phrases", lambda p: _hash(*(F.split(p, " ")[k] for k in range(WIDTH)))))
    cut = F.slice(hashes, F.lit(1), (_lacking(F.col("largest")) + 1).cast("int"))
    return sized.select("item_id", F.explode(cut).alias("sketch_hash"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast when measured to be small; otherwise the join shuffles."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, shingle counts and containment of every leaked item."""
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    items = item_sets(benchmark)
    found = sketches(items)
    words = texts.select("doc_id", _words(F.col("text")).alias("doc_words"))
    hashes = words.select("doc_id", F.explode(_windows("doc_words", _hash)).alias("doc_hash"))
    met = (
        hashes.join(_small(found, found.count()), F.col("doc_hash") == F.col("sketch_hash"))
        .select("doc_id", "item_id")
        .groupBy(F.col("doc_id").alias("met_id"))
        .agg(F.collect_set(F.struct("item_id")).alias("items"))
    )
    suspects = words.join(met, F.col("doc_id").eqNullSafe(F.col("met_id"))).select(
        "doc_id", "items", F.array_distinct(_windows("doc_words", _phrase)).alias("doc_phrases")
    )
    pairs = suspects.select("doc_id", "doc_phrases", F.explode("items").alias("candidate"))
    own = items.select(F.col("item_id").alias("own_id"), "phrases")
    verified = pairs.join(
        _small(own, own.count()), F.col("candidate.item_id").eqNullSafe(F.col("own_id"))
    ).select(
        "doc_id",
        F.col("own_id").alias("item_id"),
        F.size("phrases").cast("long").alias("n_shingles"),
        F.size(F.array_intersect("phrases", "doc_phrases")).cast("long").alias("n_shared"),
    )
    return verified.where(F.col("n_shared") * 100 >= F.col("n_shingles") * PERCENT).withColumn(
        "containment", F.col("n_shared") / F.col("n_shingles")
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; rows and columns else unchanged.

    The verdict is a row's own, whatever other rows have its id, or a null one.
    """
    keyed = docs.select(row_key().alias("doc_id"), F.col("text").alias("text"))
    leaked = unused(docs, "leaked")
    bad = contaminated(keyed, benchmark).select(F.col("doc_id").alias(leaked)).distinct()
    return docs.join(bad, row_key() == F.col(leaked), "left_anti")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents
), i AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) AS s
  FROM d WHERE len(w) >= 5
), s AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) AS s
  FROM i WHERE len(w) >= 5
), n AS (SELECT item_id, count(*) AS n_shingles FROM s GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared, count(*) / n_shingles AS containment
FROM ds JOIN s USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles
HAVING count(*) * 100 >= n_shingles * 80
"""
