"""Language by bit-sliced Bloom filters over letter n-grams.

All languages share one filter. Each of its positions holds a slice of bits, one
per language, and an n-gram's languages are the conjunction of the slices at its
positions: one look-up answers for every language at once. A text's n-grams are
looked up, the answers counted per language, and each count is corrected for the
false positives that the language's share of set bits predicts. The language
with the largest corrected count wins.

An n-gram is 2 to 4 lower-case letters in a row, word ends included as a mark.
All training texts are counted. A language holds an n-gram if its rate there is
at least ``LEAST_SHARE`` of its highest rate in any language, so what a large
language quotes from others does not enter its filter, whatever the corpus size.

The filter grows with the n-grams: it is built in segments by hash, about
``SEGMENT_KEYS`` each, by Spark. Texts are looked up in as many passes as it has
groups of ``GROUP_BYTES`` (usually one): no more than a group is broadcast at once.

Null texts and texts without a letter are ``und`` with score 0; so are all texts
if there is nothing to learn from. Ties go to the language first in UTF-8 order.
Rows with a null lang or doc_id, and the held-out fold, are never learned from.
The result depends on the text alone; columns beside doc_id, text and lang are
not looked at. The list of languages goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.kernels import mixed, slices, utf8
from headway.llm.staging import bounded_batches, staged

SIZES = (2, 3, 4)
LEAST_SHARE = 0.25
HELD_PAIRS = 1 << 20
SEGMENT_KEYS = 1 << 16
POSITIONS_PER_KEY = 10
PROBES = 3
GROUP_BYTES = 32 << 20
UNKNOWN = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_HIGH = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: every fifth, by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Letters:
    """Turns texts into code points with everything but letters as 0; one per task."""

    def __init__(self):
        self.is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)

    def grams(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row and hash of each n-gram of the texts, and whether each text has a letter."""
        lowered = [(t or "").lower() for t in texts]
        joined = "\0" + "\0".join(lowered) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(self.is_letter[codes], codes, 0).astype(np.uint64)
        sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
        row = np.repeat(np.arange(len(lowered)), sizes + 1)
        letters = np.concatenate(([0], np.cumsum(codes > 0)))
        rows, hashes = [], []
        for n in SIZES:
            starts = len(codes) - n + 1
            if starts <= 0:
                continue
            inner = letters[n - 1 : n - 1 + starts] - letters[1 : 1 + starts]
            some = letters[n : n + starts] - letters[:starts]
            at = np.flatnonzero((inner == n - 2) & (some > 0))
            h = np.full(len(at), n, np.uint64)
            for k in range(n):
                h = h * _BASE + codes[at + k]
            # The first place of an n-gram may be the mark before its row; the second is in the row or its end mark.
            rows.append(row[at])
            hashes.append(mixed(h))
        has_letter = np.bincount(row[np.flatnonzero(codes[1:])], minlength=len(lowered)) > 0
        return np.concatenate(rows), np.concatenate(hashes), has_letter


def _parts(batch: pa.RecordBatch, text: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a few MB of text."""
    return slices(utf8(batch.column(text))[1])


class _Sums:
    """Sums per (n-gram, language), held until there are many."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(place, np.concatenate(self.counts), len(keys)).astype(np.int64)
        self.keys, self.counts, self.held = [keys], [counts], len(keys)
        return keys, counts


def _counter(language_of: dict[str, int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """n-gram counts per language, summed over much of a task's rows before they travel."""
        letters = Letters()
        sums: dict[int, _Sums] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, held in sums.items():
                keys, counts = held.merged()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), lang, np.int32)), pa.array(counts)],
                    names=["gram", "lang", "n"],
                )
            sums.clear()

        for batch in batches:
            langs = np.array([language_of[v] for v in batch.column(1).to_pylist()], np.int64)
            for first, last in _parts(batch, 0):
                rows, hashes, _ = letters.grams(batch.column(0).slice(first, last - first).to_pylist())
                own = langs[first + rows]
                for lang in np.unique(own):
                    held = sums.setdefault(int(lang), _Sums())
                    held.add(*np.unique(hashes[own == lang], return_counts=True))
                    if held.held > 2 * HELD_PAIRS:
                        held.merged()
                if sum(s.held for s in sums.values()) > 4 * HELD_PAIRS:
                    yield from out()
        yield from out()

    return count


def _positions(grams: np.ndarray, segments: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Segment of each n-gram, and its positions in the segment."""
    segment = ((grams >> _HIGH) * np.uint64(segments)) >> _HIGH
    a, b = mixed(grams) & _LOW, mixed(grams ^ _BASE) | np.uint64(1)
    size = np.uint64(SEGMENT_KEYS * POSITIONS_PER_KEY)
    probes = [(((a + np.uint64(k) * b) & _LOW) * size) >> _HIGH for k in range(PROBES)]
    return segment.astype(np.int64), [p.astype(np.int64) for p in probes]


def _segment_builder(segments: int, width: int, languages: int):
    def build(table: pa.Table) -> pa.Table:
        """One segment: ``width`` bytes of language bits at each position, and each language's share of set bits."""
        grams = table.column("gram").to_numpy().view(np.uint64)
        masks = np.frombuffer(b"".join(table.column("mask").to_pylist()), np.uint8).reshape(-1, width)
        _, probes = _positions(grams, segments)
        bits = np.zeros((SEGMENT_KEYS * POSITIONS_PER_KEY, width), np.uint8)
        for p in probes:
            np.bitwise_or.at(bits, p, masks)
        fill = np.array([(bits[:, k // 8] >> (k % 8) & 1).mean() for k in range(languages)])
        return pa.table(
            {
                "segment": table.column("segment").slice(0, 1),
                "bits": pa.array([bits.tobytes()], pa.binary()),
                "fill": pa.array([fill.tolist()], pa.list_(pa.float64())),
            }
        )

    return build


def _segmenter(segments: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segment, _ = _positions(batch.column(0).to_numpy().view(np.uint64), segments)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment.astype(np.int32))], names=["gram", "mask", "segment"])

    return place


def _mask(width: int) -> Column:
    """Bytes with the bit of each language in ``langs`` set."""

    def byte(k: int) -> Column:
        own = F.filter("langs", lambda lang: F.floor(lang / 8) == k)
        return F.aggregate(own, F.lit(0), lambda a, lang: a.bitwiseOR(F.call_function("shiftleft", F.lit(1), lang % 8)))

    return F.unhex(F.concat(*[F.lpad(F.hex(byte(k)), 2, "0") for k in range(width)]))


class Filter:
    """The languages, and the written segments with the languages' bits."""

    def __init__(self, training: DataFrame, group_bytes: int = GROUP_BYTES):
        """``training``: t (text) and lang of the rows to learn from."""
        self.group_bytes = group_bytes
        self.names = [r[0] for r in training.select("lang").distinct().orderBy("lang").collect()]
        self.width = -(-len(self.names) // 8)
        self.segments = 0
        if not self.names:
            return
        counter = _counter({name: k for k, name in enumerate(self.names)})
        pairs = staged(
            training.select("t", "lang")
            .mapInArrow(counter, "gram long, lang int, n long")
            .repartition("gram")
            .groupBy("gram", "lang")
            .agg(F.sum("n").alias("n"))
        )
        totals = {r["lang"]: r["n"] for r in pairs.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        total = F.element_at(F.array(*[F.lit(float(totals.get(k, 1))) for k in range(len(self.names))]), F.col("lang") + 1)
        rated = pairs.groupBy("gram").agg(F.collect_list(F.struct("lang", (F.col("n") / total).alias("rate"))).alias("rates"))
        highest = F.array_max(F.transform("rates", lambda r: r["rate"]))
        held = F.transform(F.filter("rates", lambda r: r["rate"] >= LEAST_SHARE * highest), lambda r: r["lang"])
        masks = staged(rated.select("gram", held.alias("langs")).select("gram", _mask(self.width).alias("mask")))
        grams = masks.count()
        if not grams:
            return
        self.segments = -(-grams // SEGMENT_KEYS)
        builder = _segment_builder(self.segments, self.width, len(self.names))
        self.table = staged(
            masks.mapInArrow(_segmenter(self.segments), "gram long, mask binary, segment int")
            .groupBy("segment")
            .applyInArrow(builder, "segment int, bits binary, fill array<double>")
        )

    def groups(self) -> Iterator[tuple[int, int]]:
        """Ranges of segments of at most ``group_bytes``, one at least."""
        step = max(1, self.group_bytes // (SEGMENT_KEYS * POSITIONS_PER_KEY * self.width))
        for first in range(0, self.segments, step):
            yield first, min(first + step, self.segments)

    def load(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Bits and false-positive rates of the segments ``first`` to ``last`` (exclusive); an empty one is all zero."""
        size = SEGMENT_KEYS * POSITIONS_PER_KEY
        bits = np.zeros((last - first, size, self.width), np.uint8)
        wrong = np.zeros((last - first, len(self.names)))
        for r in self.table.where(F.col("segment").between(first, last - 1)).toLocalIterator():
            bits[r["segment"] - first] = np.frombuffer(r["bits"], np.uint8).reshape(size, self.width)
            wrong[r["segment"] - first] = np.array(r["fill"]) ** PROBES
        return bits, wrong


def _looker(shared, first: int, last: int, segments: int, languages: int, finish):
    """Counts of one group of segments per text; ``finish`` makes the output batch."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        bits, wrong = shared.value
        size, width = bits.shape[1], bits.shape[2]
        flat = bits.reshape(-1, width)
        bit_of = (np.arange(256)[:, None] >> np.arange(8)) & 1
        for batch in batches:
            for start, stop in _parts(batch, 1):
                part = batch.slice(start, stop - start)
                texts = part.column(1).to_pylist()
                rows, grams, has_letter = letters.grams(texts)
                n = len(texts)
                total = np.bincount(rows, minlength=n)
                segment, probes = _positions(grams, segments)
                if segments > last - first:
                    own = (segment >= first) & (segment < last)
                    rows, segment, probes = rows[own], segment[own], [p[own] for p in probes]
                base = (segment - first) * size
                expected = np.zeros((n, languages))
                per_segment = np.bincount(rows * (last - first) + segment - first, minlength=n * (last - first))
                expected += per_segment.reshape(n, last - first) @ wrong
                found = np.zeros((n, languages))
                for k in range(width):
                    mask = flat[base + probes[0], k]
                    for p in probes[1:]:
                        mask = mask & flat[base + p, k]
                    seen = np.bincount(rows * 256 + mask, minlength=n * 256).reshape(n, 256) @ bit_of
                    here = min(8, languages - 8 * k)
                    found[:, 8 * k : 8 * k + here] = seen[:, :here]
                yield finish(part, total, found, expected, has_letter)

    return look


def _decided(names: list[str], total: np.ndarray, found: np.ndarray, expected: np.ndarray, has_letter: np.ndarray):
    """Language and score: the share of n-grams that the winner truly holds."""
    n = np.maximum(total, 1)[:, None]
    true = np.clip((found - expected) / np.maximum(1 - expected / n, 1e-9), 0, n)
    best = true.argmax(1)
    score = np.where(has_letter, true[np.arange(len(best)), best] / n[:, 0], 0.0)
    return [names[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)], score


def predict(docs: DataFrame, model: Filter) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    if not model.segments:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    names, segments = model.names, model.segments
    groups = list(model.groups())

    if len(groups) == 1:

        def finish(part, *counts):
            langs, score = _decided(names, *counts)
            return pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(langs, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"]
            )

        look = _looker(spark.sparkContext.broadcast(model.load(*groups[0])), *groups[0], segments, len(names), finish)
        return rows.mapInArrow(look, "doc_id long, lang_pred string, score double")

    # Several passes: their counts meet by text, since a prediction depends on nothing else.
    identity = [F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), F.col("text")).alias("b")]
    texts = rows.select(*identity, "text")

    def keep(part, total, found, expected, has_letter):
        arrays = [
            part.column(0),
            part.column(2),
            pa.array(total),
            pa.array(list(found), pa.list_(pa.float64())),
            pa.array(list(expected), pa.list_(pa.float64())),
            pa.array(has_letter),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "total", "found", "expected", "has_letter"])

    passes = None
    for group in groups:
        shared = spark.sparkContext.broadcast(model.load(*group))
        look = _looker(shared, *group, segments, len(names), keep)
        counted = staged(
            texts.select("a", "text", "b")
            .mapInArrow(look, "a long, b long, total long, found array<double>, expected array<double>, has_letter boolean")
            .dropDuplicates(["a", "b"])
        )
        shared.destroy()
        passes = counted if passes is None else passes.unionByName(counted)

    def added(column: str) -> Column:
        return F.array(*[F.sum(F.col(column)[k]) for k in range(len(names))]).alias(column)

    summed = passes.groupBy("a", "b").agg(
        F.max("total").alias("total"), F.max("has_letter").alias("has_letter"), added("found"), added("expected")
    )

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.array(batch.column(i).to_pylist(), float).reshape(batch.num_rows, -1) for i in (4, 5)]
            total, has_letter = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            langs, score = _decided(names, total, *counts, has_letter)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(score)],
                names=["a", "b", "lang_pred", "score"],
            )

    verdicts = staged(summed.mapInArrow(decide, "a long, b long, lang_pred string, score double"))
    return rows.select("doc_id", *identity).join(verdicts, ["a", "b"]).select("doc_id", "lang_pred", "score")


def learn(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> Filter:
    """The filter of the rows outside the held-out fold that name a language."""
    bounded_batches(docs.sparkSession)
    learned = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    return Filter(docs.where(learned).select(F.col("text").alias("t"), F.col("lang").alias("lang")), group_bytes)


def languages(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``."""
    found = predict(docs, learn(docs, group_bytes))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
