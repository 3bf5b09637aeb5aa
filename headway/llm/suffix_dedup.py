"""Repeated byte strings across and within documents, by suffix arrays over shards.

A string of 400 bytes that starts at two places is removed at both. Every window
of 400 bytes has an anchor, the least hash of the 64-byte strings inside it, which
equal windows share. Anchors that stand at one place only are counted away in
Spark; what is left are runs of windows with a shared anchor. Runs with equal bytes
(a digest of 128 bits tells) are joined where they lie: all windows of a run that
stands at two places are repeated. Only where the runs of one anchor differ, or one
run holds its anchor twice, are windows left to compare. Of such runs one copy each
goes to the shard that its anchor names, so equal windows meet in one shard. There a
suffix array with common prefixes is built by external induced sorting
(``suffix_sort``), and a window is repeated if it shares 400 bytes with a neighbour
in the array.

The shards' sizes are set by the number of different runs. Null texts count as
empty. Rows are told apart by id and text, so null and repeated ids are rows like any
other; rows alike in both are several places, so all of their windows go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.kernels import (
    byte_items,
    rabin_karp,
    rows_of,
    signed,
    slices,
    sliding_minimum,
    utf8,
)
from headway.llm.staging import bounded_batches, staged
from headway.llm.substring_dedup import BROADCAST_IDS
from headway.llm.suffix_sort import suffix_array

WINDOW, ANCHOR = 400, 64
SPREAD = WINDOW - ANCHOR + 1
SHARD_RUNS = 2_000
#: Text bytes whose windows are hashed at a time; a longer row stands alone.
HASHED_BYTES = 1 << 19
KEY = "key struct<a:long,b:long>"
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _windows(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice: first row, bytes, bounds, start of every window, its anchor, and the anchor hashes by place."""
    data, bounds = utf8(column)
    for first, last in slices(bounds, HASHED_BYTES):
        own = bounds[first : last + 1] - bounds[first]
        part = data[bounds[first] : bounds[last]]
        if len(part) >= WINDOW:
            hashes = rabin_karp(byte_items(part), ANCHOR)
            least = sliding_minimum(hashes, SPREAD)
            inside = np.zeros(len(part) + 1, np.int32)  # windows that cross no row
            begins, ends = own[:-1], own[1:] - WINDOW + 1
            fits = ends > begins
            np.add.at(inside, begins[fits], 1)
            np.add.at(inside, ends[fits], -1)
            at = np.flatnonzero(np.cumsum(inside[: len(least)]) > 0)
            if len(at):
                yield first, part, own, at, least[at], hashes


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row key, anchor and at how many places of the slice's row it stands."""
    for batch in batches:
        for first, _, own, at, anchor, hashes in _windows(batch.column(1)):
            # a place holds an anchor if it is the least of some window around it
            most = np.zeros(len(hashes) + SPREAD - 1, np.uint64)
            most[at + SPREAD - 1] = anchor
            around = ~sliding_minimum(~most, SPREAD)
            places = np.flatnonzero(around[: len(hashes)] == hashes)
            row = rows_of(own, places)
            order = np.lexsort((hashes[places], row))
            row, value = row[order], hashes[places][order]
            if len(row):
                new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (value[1:] != value[:-1]))))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(first + row[new])),
                        pa.array(signed(value[new])),
                        pa.array(np.diff(np.append(new, len(row))).astype(np.int32)),
                    ],
                    names=["key", "anchor", "places"],
                )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every run of windows with a shared anchor: its place, a digest of its bytes, whether it holds the anchor again."""
    for batch in batches:
        shared = [np.sort(np.array(a, np.int64).view(np.uint64)) for a in batch.column(2).to_pylist()]
        for first, part, own, at, anchor, hashes in _windows(batch.column(1)):
            row = rows_of(own, at)
            new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])))
            begins = np.flatnonzero(new)
            sizes = np.diff(np.append(begins, len(at)))
            left = at[begins]
            raw = memoryview(part.tobytes())
            held, digests, again = [], [], []
            for run, (r, a, n) in enumerate(zip(row[begins].tolist(), left.tolist(), sizes.tolist())):
                known, value = shared[first + r], anchor[begins[run]]
                k = np.searchsorted(known, value)
                if k < len(known) and known[k] == value:
                    held.append(run)
                    digests.append(hashlib.blake2b(raw[a : a + n - 1 + WINDOW], digest_size=16).digest())
                    again.append(np.count_nonzero(hashes[a : a + n - 1 + SPREAD] == value) > 1)
            held = np.array(held, np.int64)
            owner = row[begins[held]]
            digest = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(first + owner)),
                    pa.array((left[held] - own[owner]).astype(np.int64)),
                    pa.array(sizes[held].astype(np.int64)),
                    pa.array(signed(anchor[begins[held]])),
                    pa.array(np.ascontiguousarray(digest[:, 0])),
                    pa.array(np.ascontiguousarray(digest[:, 1])),
                    pa.array(again, pa.bool_()),
                ],
                names=["key", "start", "windows", "anchor", "c1", "c2", "again"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of a row's runs that are to be compared, and the shards they go to."""
    for batch in batches:
        keys, numbers, segments = [], [], []
        for k, (text, runs) in enumerate(zip(batch.column(1), batch.column(2).to_pylist())):
            raw = (text.as_py() or "").encode()
            for run in runs:
                keys.append(k)
                numbers.append((run["shard"], run["start"], run["n"]))
                segments.append(raw[run["start"] : run["start"] + run["windows"] - 1 + WINDOW])
        columns = list(zip(*numbers)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(keys, pa.int64())), *(pa.array(c, pa.int64()) for c in columns), pa.array(segments, pa.binary())],
            names=["key", "shard", "start", "n", "segment"],
        )


def repeated_windows(segments: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each distinct segment, the starts of windows that stand anywhere else among them."""
    sizes = np.array([len(s) for s in segments])
    raw = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    text = raw.astype(np.int32) + 2
    ends = np.cumsum(sizes + 1)
    text[ends - 1] = 1  # between segments
    text[-1] = 0
    order, lcp = suffix_array(text, window)
    same = lcp >= window
    hit = np.zeros(len(text), bool)
    hit[order[same]] = True
    hit[order[np.flatnonzero(same) - 1]] = True
    return [np.flatnonzero(hit[e - n - 1 : e - window]) if n >= window else np.empty(0, np.int64) for e, n in zip(ends, sizes)]


def _sort_shard(table: pa.Table) -> pa.Table:
    """Row key, first and end of every stretch of the shard's repeated windows, in runs that stand at one place."""
    n, start = (table.column(c).to_numpy() for c in ("n", "start"))
    found = repeated_windows(table.column("segment").to_pylist())
    rows, begins, ends = [], [], []
    for k, starts in enumerate(found):
        if n[k] == 1 and len(starts):
            new = np.concatenate(([True], np.diff(starts) > 1))
            begin = starts[new]
            rows.append(np.full(len(begin), k))
            begins.append(start[k] + begin)
            ends.append(start[k] + starts[np.append(new[1:], True)] + 1)
    rows, begins, ends = (np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in (rows, begins, ends))
    key = table.column("key").combine_chunks().take(pa.array(rows))
    return pa.table({"key": key, "begin": pa.array(begins), "end": pa.array(ends)})


def _trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        removed = batch.column(2).to_pylist() if batch.num_columns > 2 else [[]] * batch.num_rows
        for text, stretches in zip(batch.column(1), removed):
            raw = (text.as_py() or "").encode()
            kept, at, gone, spans = hashlib.sha256(), 0, 0, 0
            reach = -1  # end of the removed run so far
            for stretch in sorted((s["begin"], s["end"]) for s in stretches):
                a, b = stretch[0], stretch[1] - 1 + WINDOW
                spans += a > reach
                a = max(a, reach)
                if b > a:
                    kept.update(raw[at:a])
                    gone += b - a
                    at = reach = b
            kept.update(raw[at:])
            rows.append((len(raw), gone, spans, kept.hexdigest()))
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _among(docs: DataFrame, keys: DataFrame, rows: int, kind: str) -> DataFrame:
    """``docs`` whose key is (not) among ``keys``; broadcast only where measured to be small."""
    named = keys.select(F.col("key").alias("other"))
    return docs.join(F.broadcast(named) if rows <= BROADCAST_IDS else named, F.col("key") == F.col("other"), kind)


def _with_texts(docs: DataFrame, lists: DataFrame, rows: int, column: str) -> DataFrame:
    """key, text and ``column`` of the rows that ``lists`` names; only their texts are shuffled."""
    other = lists.select(F.col("key").alias("other"), column)
    return _among(docs, lists, rows, "left_semi").join(other, F.col("key") == F.col("other")).select("doc_id", "key", "text", column)


def _compared(docs: DataFrame, contents: DataFrame) -> DataFrame:
    """Stretches of repeated windows in runs at one place whose anchor other runs share, or that hold it again."""
    open_ = contents.groupBy("anchor").agg(F.count("*").alias("m"), F.max("again").alias("again")).where("m > 1 or again")
    shards = max(1, -(-(open_.agg(F.sum("m")).first()[0] or 0) // SHARD_RUNS))
    run = F.struct(
        F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"),
        F.col("holder.start").alias("start"), F.col("holder.windows").alias("windows"), "n",
    )
    held = staged(
        contents.join(open_.select("anchor"), "anchor")
        .groupBy(F.col("holder.key").alias("key")).agg(F.collect_list(run).alias("runs"))
    )
    rows = held.count()
    single = _among(docs, held, rows, "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    return (
        single.join(held, "key").select("key", "text", "runs")
        .mapInArrow(_cut, f"{KEY}, shard long, start long, n long, segment binary")
        .groupBy("shard").applyInArrow(_sort_shard, f"{KEY}, begin long, end long")
    )


def remove_repeated_bytes(docs: DataFrame) -> DataFrame:
    """Per row: its bytes, how many are removed in how many runs, and a digest of those kept."""
    bounded_batches(docs.sparkSession)
    key = F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), F.col("doc_id"), F.col("text")).alias("b"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).withColumn("key", key)
    anchors = docs.select("key", "text").mapInArrow(_anchors, f"{KEY}, anchor long, places int")
    shared = (
        anchors.groupBy("anchor").agg(F.sum("places").alias("n")).where("n > 1").select(F.col("anchor").alias("shared"))
    )
    suspects = staged(
        anchors.join(shared, F.col("anchor") == F.col("shared")).groupBy("key").agg(F.collect_set("anchor").alias("anchors"))
    )
    # rows alike in id and text share their key, so each of them is met by one list
    runs = staged(
        _with_texts(docs, suspects, suspects.count(), "anchors").select("key", "text", "anchors")
        .mapInArrow(_runs, f"{KEY}, start long, windows long, anchor long, c1 long, c2 long, again boolean")
    )
    contents = staged(
        runs.groupBy("anchor", "c1", "c2")
        .agg(F.count("*").alias("n"), F.max("again").alias("again"), F.min(F.struct("key", "start", "windows")).alias("holder"))
    )
    copied = contents.where("n > 1").select("c1", "c2")
    whole = runs.join(copied, ["c1", "c2"], "left_semi").select("key", F.col("start").alias("begin"), (F.col("start") + F.col("windows")).alias("end"))
    removed = staged(
        whole.union(_compared(docs, contents)).groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("stretches"))
    )
    rows = removed.count()
    trimmed = _with_texts(docs, removed, rows, "stretches").select("doc_id", "text", "stretches").mapInArrow(_trimmed, SCHEMA)
    return _among(docs, removed, rows, "left_anti").select("doc_id", "text").mapInArrow(_trimmed, SCHEMA).union(trimmed)
