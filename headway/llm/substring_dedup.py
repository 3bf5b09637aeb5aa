"""Repeated passages: Rabin-Karp hashes of every 50-word window, counted in Spark.

The hash of a window rolls over the words of its text. Each window also has an
anchor: the least hash among the 20-word windows inside it, which equal windows
share and neighbouring windows mostly have in common. Anchors are counted first,
a sixteenth of the rows; a window whose anchor stands in one document alone is
itself in no other. The hashes of all other windows are then counted: they go to
buckets, which find the least document of each hash. Windows whose hash has a
smaller document are removed, overlapping ones as one interval.

Of a window that many documents of a batch hold, only the batch's least document
goes to the hash's bucket; the others are settled and go straight to a bucket of
their own document. Words are runs of non-space bytes. Null and empty texts have
no words. A null ``doc_id`` is compared with nothing. Rows that repeat a
``doc_id`` are one document's: they do not remove each other's words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.kernels import (
    Words,
    interval_union,
    mixed,
    rabin_karp,
    rows_of,
    signed,
    slices,
    sliding_minimum,
    utf8,
)
from headway.llm.staging import bounded_batches, staged

WINDOW, ANCHOR = 50, 20
BUCKET_WINDOWS = 1_000_000
BROADCAST_IDS = 1_000_000
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def windows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice: row, first word in the row, hash and anchor of every window."""
    data, bounds = utf8(column)
    words = Words()
    for first, last in slices(bounds):
        own = bounds[first : last + 1] - bounds[first]
        part = data[bounds[first] : bounds[last]]
        starts, ends = words.bounds(part, own)
        if len(starts) < WINDOW:
            continue
        ids = words.hashes(part, starts, ends)
        rows = rows_of(own, starts)
        at = np.flatnonzero(rows[: len(rows) - WINDOW + 1] == rows[WINDOW - 1 :])
        hashes = rabin_karp(ids, WINDOW)[at]
        anchors = sliding_minimum(rabin_karp(ids, ANCHOR), WINDOW - ANCHOR + 1)[at]
        yield first + rows[at], at - np.searchsorted(rows, rows[at]), hashes, anchors


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and anchor, once for each run of windows."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for rows, _, _, anchors in windows(batch.column(1)):
            new = np.ones(len(rows), bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows[new]]), pa.array(signed(anchors[new]))], names=["doc_id", "anchor"]
            )


def _claims(buckets: int):
    def claim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hashes of windows with shared anchors, by bucket; those a smaller document of the batch has are settled.

        Settled ones are dealt by document, the others by hash.
        """
        for batch in batches:
            ids = batch.column(0).to_numpy()
            shared = [np.sort(np.array(a, np.int64).view(np.uint64)) for a in batch.column(2).to_pylist()]
            docs, found = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            for rows, _, hashes, anchors in windows(batch.column(1)):
                edges = np.searchsorted(rows, np.arange(rows[0], rows[-1] + 2)) if len(rows) else []
                for a, b in zip(edges[:-1], edges[1:]):
                    if b > a:
                        known = shared[rows[a]]
                        place = np.minimum(np.searchsorted(known, anchors[a:b]), len(known) - 1)
                        own = np.unique(hashes[a:b][known[place] == anchors[a:b]])
                        docs.append(np.full(len(own), ids[rows[a]]))
                        found.append(own)
            doc, value = np.concatenate(docs), np.concatenate(found)
            order = np.lexsort((doc, value))
            doc, value = doc[order], value[order]
            new = np.ones(len(value), bool)
            new[1:] = value[1:] != value[:-1]
            least = doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(doc) else doc
            by_hash = (value % np.uint64(buckets)).astype(np.int64)
            for settled, own, bucket in ((False, new, by_hash), (True, doc > least, _by_id(doc, buckets))):
                yield _packed(bucket[own], doc[own], value[own], settled)

    return claim


def _by_id(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _packed(bucket: np.ndarray, doc: np.ndarray, value: np.ndarray, settled: bool) -> pa.RecordBatch:
    """One row for each bucket, with its documents and hashes end to end."""
    order = np.argsort(bucket, kind="stable")
    bucket, docs, values = bucket[order], doc[order].tobytes(), value[order].tobytes()
    begins = np.flatnonzero(np.concatenate(([True], np.diff(bucket) != 0))) if len(bucket) else np.empty(0, np.int64)
    cuts = [8 * int(x) for x in (*begins, len(bucket))]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[begins]),
            *(pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()) for raw in (docs, values)),
            pa.array(np.full(len(begins), settled)),
        ],
        names=["bucket", "docs", "hashes", "settled"],
    )


def _joined(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The documents and hashes of all rows."""
    docs, values = (b"".join(table.column(c).to_pylist()) for c in ("docs", "hashes"))
    return np.frombuffer(docs, np.int64), np.frombuffer(values, np.uint64)


def _count(buckets: int):
    def count(table: pa.Table) -> pa.Table:
        """The hashes in a bucket that a smaller document has too, dealt anew by document."""
        doc, value = _joined(table)
        order = np.lexsort((doc, value))
        doc, value = doc[order], value[order]
        new = np.ones(len(value), bool)
        new[1:] = value[1:] != value[:-1]
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(doc) else doc
        gone = doc > least
        doc, value = doc[gone], value[gone]
        return pa.Table.from_batches([_packed(_by_id(doc, buckets), doc, value, True)]).drop_columns(["settled"])

    return count


def _by_document(table: pa.Table) -> pa.Table:
    """One row for each document, with all its removed hashes."""
    doc, value = _joined(table)
    found = _packed(doc, doc, value, True)
    return pa.table({"id": found.column("bucket"), "hashes": found.column("hashes")})


def _untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [(t.as_py() or "").encode().split() for t in batch.column(1)]
        yield _result(batch.column(0), words, [0] * len(words))


def _trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [(t.as_py() or "").encode().split() for t in batch.column(1)]
        gone = [0] * len(kept)
        removed = batch.column(2).to_pylist()
        for rows, places, hashes, _ in windows(batch.column(1)):
            edges = np.searchsorted(rows, np.arange(rows[0], rows[-1] + 2)) if len(rows) else []
            for a, b in zip(edges[:-1], edges[1:]):
                if b > a:
                    row = rows[a]
                    known = np.frombuffer(removed[row], np.uint64)
                    left, right = interval_union(places[a:b][np.isin(hashes[a:b], known)], WINDOW)
                    gone[row] = int((right - left).sum())
                    for x, y in zip(left[::-1].tolist(), right[::-1].tolist()):
                        del kept[row][x:y]
        yield _result(batch.column(0), kept, gone)


def _result(ids: pa.Array, kept: list[list[bytes]], gone: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array([len(k) + g for k, g in zip(kept, gone)], pa.int64()),
            pa.array(gone, pa.int64()),
            pa.array([hashlib.sha256(b" ".join(k)).hexdigest() for k in kept], pa.string()),
        ],
        names=["doc_id", "n_words", "n_removed", "kept_sha256"],
    )


def narrowed(docs: DataFrame, ids: DataFrame, rows: int, kind: str) -> DataFrame:
    """``docs`` whose id is (not) among ``ids``, whose column is ``id``; broadcast only where measured to be small."""
    return docs.join(F.broadcast(ids) if rows <= BROADCAST_IDS else ids, docs["doc_id"] == ids["id"], kind)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: its words, how many of them are removed, and a digest of those kept."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    named = docs.where(F.col("doc_id").isNotNull())
    anchors = named.mapInArrow(_anchors, "doc_id long, anchor long")
    shared = (
        anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high").select(F.col("anchor").alias("shared"))
    )
    suspects = staged(
        anchors.join(shared, F.col("anchor") == F.col("shared"))
        .groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("anchor").alias("anchors"))
    )
    rows, runs = suspects.agg(F.count("*"), F.sum(F.size("anchors"))).first()
    buckets = max(1, -(-(runs or 0) * (WINDOW - ANCHOR + 1) // BUCKET_WINDOWS))
    claims = staged(
        narrowed(named, suspects.select("id"), rows, "left_semi")
        .join(suspects, F.col("doc_id") == F.col("id"))
        .select("doc_id", "text", "anchors")
        .mapInArrow(_claims(buckets), "bucket long, docs binary, hashes binary, settled boolean")
    )
    packed = ["bucket", "docs", "hashes"]
    removed = staged(
        claims.where("not settled").select(packed).groupBy("bucket")
        .applyInArrow(_count(buckets), "bucket long, docs binary, hashes binary")
        .union(claims.where("settled").select(packed)).groupBy("bucket").applyInArrow(_by_document, "id long, hashes binary")
    )
    ids = removed.select("id")
    rows = removed.count()
    trimmed = (
        narrowed(named, ids, rows, "left_semi").join(removed, F.col("doc_id") == F.col("id"))
        .select("doc_id", "text", "hashes").mapInArrow(_trimmed, SCHEMA)
    )
    return narrowed(docs, ids, rows, "left_anti").mapInArrow(_untouched, SCHEMA).union(trimmed)


#: DuckDB: every window's words joined by spaces, its least holder, and the words that later holders' windows cover.
ORACLE_SQL = r"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM documents
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM cut
), windows AS (
  SELECT doc_id, word, place,
    CASE WHEN count(*) OVER next50 = 50 THEN md5(string_agg(word, ' ') OVER next50) END AS w
  FROM placed
  WINDOW next50 AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
), lowest AS (
  SELECT w, min(doc_id) AS low FROM windows WHERE w IS NOT NULL GROUP BY w
), judged AS (
  SELECT doc_id, word, place, coalesce(max(CAST(low < doc_id AS INT)) OVER
    (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM windows LEFT JOIN lowest USING (w)
), kept AS (
  SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed,
    sha256(coalesce(string_agg(word, ' ' ORDER BY place) FILTER (WHERE gone = 0), '')) AS kept_sha256
  FROM judged GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""
