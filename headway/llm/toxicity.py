"""Toxicity by two Kneser-Ney word models, one per class, with shared backoff counts.

All labelled training texts are counted: Spark sums word pairs per class, and
from the distinct pairs the continuation counts that Kneser-Ney backs off to. A
word's probability in a class is its discounted continuation count there
(discounts for counts of one, two and more follow from the counts of counts); the
mass taken goes to the continuation counts of both classes together. Every word
ever counted is scored, however rare; one never counted says nothing. Pairs seen
``MIN_COUNT`` times among toxic texts are scored as pairs, by the same
discounting one order up. Neither rule knows the size of the corpus.

A text's evidence is the difference of its two log-likelihoods per word, and how
much of it comes from words far likelier in toxic texts. Both are sums over the
text's expressions, held as whole numbers (``UNIT`` to one), so their order is
irrelevant. The counted expressions are a written table. Those that make up one in
``FREQUENT`` of the counted words or more are broadcast, so their number has a bound
and the share of occurrences left does not follow from the corpus' size; occurrences
of all others are joined to the table, of those only that a bitmap of ``BITMAP_BITS``
lets through (it passes every counted expression). The division changes where sums
are made, not the sums.

A logistic curve turns the evidence into a score; it is fitted on at most
``CALIBRATION_ROWS`` labelled rows, drawn by a hash of the id before anything is
measured, whose own counts are taken out of the models.

Null or empty texts get the score of no evidence. Without labels of both classes
every score is the share of toxic labels (0 without labels). Of several labels of
one document the largest counts; null labels don't count. A score of exactly
``THRESHOLD`` counts as toxic; equal texts get equal scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.kernels import SLICE_BYTES, Words, find, mixed, rows_of, slices, utf8
from headway.llm.staging import bounded_batches, staged, unused

DISCOUNT = 0.75
MIN_COUNT = 3
#: An expression broadcast is one in so many words at least, so twice as many at most (words and pairs); bits of the
#: bitmap of all. They bound memory and change no result.
FREQUENT = 1 << 21
BITMAP_BITS = 1 << 26
PROBES = 3
_BLOCK_BITS = 8 * 4096
CALIBRATION_ROWS = 8_000
#: A table of at most so many rows is broadcast to a join; a larger one is shuffled.
BROADCAST_ROWS = 1_000_000
STRONG = 1.5
UNIT = 1 << 20
#: Text bytes scored at a time.
SCORED_BYTES = 1 << 19
THRESHOLD = 0.3
#: A word is a run of letters and digits, any byte beyond ASCII included, in lower case.
SEPARATORS = tuple(b for b in range(128) if not chr(b).isalnum())
#: A word is known by 64 bits of its hash, the word before it, within its pairs, by 32.
LOW = np.uint64(0xFFFFFFFF)
WORD, CONTEXT, PAIR = 0, 1, 2


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: every fourth, by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _words(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice: first row, bounds of rows, and row, hash and context of each word (a first word's context is 0)."""
    words = Words(SEPARATORS, lower=True)
    data, bounds = utf8(batch.column(text))
    for first, last in slices(bounds, limit):
        own = bounds[first : last + 1] - bounds[first]
        part = data[bounds[first] : bounds[last]]
        starts, ends = words.bounds(part, own)
        ids = words.hashes(part, starts, ends)
        rows = rows_of(own, starts)
        context = np.zeros_like(ids)
        if len(ids):
            context[1:] = np.where(rows[1:] == rows[:-1], ids[:-1] & LOW, np.uint64(0))
        yield first, last, rows, ids, context


def _pair_keys(ids: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mixed(ids ^ mixed(context + np.uint64(1)))


def _slices_of_words(batch: pa.RecordBatch, toxic: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Label, hash and context of the words of some ``SLICE_BYTES`` of text, hashed ``SCORED_BYTES`` at a time."""
    bounds = utf8(batch.column(0))[1]
    for first, last in slices(bounds):
        parts = [
            (toxic[first + at + rows], ids, context)
            for at, _, rows, ids, context in _words(batch.slice(first, last - first), 0, SCORED_BYTES)
        ]
        if parts:
            yield tuple(map(np.concatenate, zip(*parts)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pair counts per class, summed within each slice."""
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for bad, ids, context in _slices_of_words(batch, toxic):
            unique, at, place = np.unique(_pair_keys(ids, context), return_index=True, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at].view(np.int64)), pa.array(context[at].astype(np.uint32).view(np.int32))]
                + [pa.array(np.bincount(place[of], minlength=len(unique)).astype(np.int32)) for of in (bad, ~bad)],
                names=["word", "context", "toxic", "ordinary"],
            )


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches joined to tables of at least ``rows`` rows, so that sums within each are worth making."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


COUNTS = ["toxic", "ordinary", "toxic_types", "ordinary_types", "types"]


def _continuations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From summed pairs: per word and per context the tokens and distinct pairs; pairs that repeat among toxic texts."""
    for table in _gathered(batches, 300_000):
        word = table.column(0).to_numpy()
        context = table.column(1).to_numpy()
        toxic, ordinary = (table.column(i).to_numpy().astype(np.float64) for i in (2, 3))
        for kind, ids in ((WORD, word), (CONTEXT, context)):
            unique, place = np.unique(ids, return_inverse=True)
            sums = [
                np.bincount(place, w, len(unique)).astype(np.int64)
                for w in (toxic, ordinary, toxic > 0, ordinary > 0, np.ones(len(ids)))
            ]
            yield _rows(kind, unique.astype(np.int64), np.zeros(len(unique), np.int32), sums)
        repeated = toxic >= MIN_COUNT
        zeros = np.zeros(int(repeated.sum()), np.int64)
        yield _rows(
            PAIR,
            word[repeated],
            context[repeated],
            [toxic[repeated].astype(np.int64), ordinary[repeated].astype(np.int64), zeros, zeros, zeros],
        )


def _rows(kind: int, word: np.ndarray, context: np.ndarray, sums: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(word), kind, np.int32)), pa.array(word), pa.array(context), *map(pa.array, sums)],
        names=["kind", "word", "context", *COUNTS],
    )


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kind, word and context with the key that texts look up: the word's hash, or the pair's."""
    for batch in batches:
        pair = batch.column(0).to_numpy() == PAIR
        word = batch.column(1).to_numpy().view(np.uint64)
        context = batch.column(2).to_numpy().view(np.uint32).astype(np.uint64)
        key = np.where(pair, _pair_keys(word, context), word).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key), *batch.columns], names=["key", *batch.schema.names])


@dataclass
class Totals:
    """Of each class (toxic, ordinary): continuation counts, discounts for counts 1, 2 and more, and backoff's share; of both: types, words."""

    counts: tuple[float, float]
    discounts: tuple[list[float], list[float]]
    backoff: tuple[float, float]
    types: float
    tokens: int

    def word(self, own: tuple[Column, Column], types: Column) -> list[Column]:
        """A word's probability in each class."""
        out = []
        for seen, total, (one, two, more), share in zip(own, self.counts, self.discounts, self.backoff):
            less = F.when(seen >= 3, more).when(seen == 2, two).when(seen == 1, one).otherwise(0.0)
            out.append((seen - less) / total + share * types / self.types)
        return out


def _discounts(n: list[float]) -> list[float]:
    """Discounts of counts 1, 2 and more, from the numbers of words with counts 1 to 4; where one is missing, ``DISCOUNT``."""
    if not all(n):
        return [DISCOUNT] * 3
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), 0.95 * k) for k in (1, 2, 3)]


def training_labels(labels: DataFrame) -> DataFrame:
    """id and label (0 or 1) of documents outside the held-out fold."""
    return (
        labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def training_rows(docs: DataFrame, known: DataFrame) -> DataFrame:
    """text and label of the documents in ``known``."""
    texts = docs.select(F.col("text").alias("t"), F.col("doc_id").alias("d"))
    return texts.join(_small(known), F.col("d") == F.col("id")).select("t", "label")


def count_model(training: DataFrame) -> tuple[DataFrame, Totals] | None:
    """All counted expressions as a written table, and the classes' totals; None unless both classes have words."""
    pairs = (
        training.mapInArrow(_count, "word long, context int, toxic int, ordinary int")
        .groupBy("word", "context")
        .agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    )
    fields = "kind int, word long, context int, " + ", ".join(f"{c} long" for c in COUNTS)
    counted = staged(
        pairs.mapInArrow(_continuations, fields).groupBy("kind", "word", "context").agg(*(F.sum(c).alias(c) for c in COUNTS))
    )
    words = counted.where(F.col("kind") == WORD)
    classes = ("toxic_types", "ordinary_types")
    sums = [F.sum(c) for c in (*COUNTS[2:], "toxic", "ordinary")]
    sums += [F.sum((F.col(c) == k).cast("long")) for c in classes for k in (1, 2, 3, 4)]
    sums += [F.sum((F.col(c) >= 3).cast("long")) for c in classes]
    found = [float(v or 0) for v in words.agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).first()]
    if not found[3] or not found[4]:
        return None
    tallies = found[5:9], found[9:13]
    discounts = tuple(_discounts(n) for n in tallies)
    backoff = tuple(
        (d[0] * n[0] + d[1] * n[1] + d[2] * more) / total
        for d, n, more, total in zip(discounts, tallies, found[13:15], found[:2])
    )
    totals = Totals((found[0], found[1]), discounts, backoff, found[2], int(found[3] + found[4]))

    word = words.select("word", *(F.col(c).alias(f"w_{c}") for c in COUNTS[2:]))
    context = counted.where(F.col("kind") == CONTEXT).select(
        F.col("word").cast("int").alias("context"), *(F.col(c).alias(f"c_{c}") for c in COUNTS[:4])
    )
    of_pair = counted.where(F.col("kind") == PAIR).select("kind", "word", "context", "toxic", "ordinary")
    none = [F.lit(None).cast("long").alias(f"c_{c}") for c in COUNTS[:4]]
    columns = ["kind", "word", "context", "toxic", "ordinary"]
    columns += [f"w_{c}" for c in COUNTS[2:]] + [f"c_{c}" for c in COUNTS[:4]]
    rows = (
        of_pair.join(word, "word")
        .join(context, "context")
        .select(*columns)
        .unionByName(words.select(*columns[:5], *(F.col(c).alias(f"w_{c}") for c in COUNTS[2:]), *none))
    )
    schema = "key long, kind int, word long, context int, " + ", ".join(f"{c} long" for c in columns[3:])
    return staged(rows.mapInArrow(_keyed, schema).drop("word", "context")), totals


def _evidence(totals: Totals, words: Column, pairs: Column, label: Column) -> tuple[Column, Column]:
    """What one occurrence of a row of the model adds to a text's evidence and to its strong evidence.

    ``words`` and ``pairs`` are the occurrences of the word and of the pair in the
    text itself, taken out of class ``label``. A pair stands in place of its word,
    so it adds the difference.
    """

    def without(count: Column, own: Column, name: str | None) -> Column:
        theirs = F.lit(True) if name is None else label == (1 if name == "toxic" else 0)
        return F.greatest(count - F.when(theirs, own).otherwise(0), F.lit(0))

    classes = ("toxic", "ordinary")
    types = without(F.col("w_types"), words, None)
    p = totals.word(tuple(without(F.col(f"w_{c}_types"), words, c) for c in classes), F.greatest(types, F.lit(1)))
    single = F.when(types > 0, F.log(p[0] / p[1])).otherwise(0.0)
    q = []
    for name, below in zip(classes, p):
        seen = without(F.col(name), pairs, name)
        total = F.greatest(without(F.col(f"c_{name}"), pairs, name), F.lit(1))
        spare = F.least(DISCOUNT * F.col(f"c_{name}_types") / total, F.lit(1.0))
        q.append(F.when(seen > 0, F.greatest(seen - DISCOUNT, F.lit(0.0)) / total + spare * below).otherwise(below))
    whole = F.when(F.col("kind") == PAIR, F.log(q[0] / q[1])).otherwise(single)
    is_pair = F.col("kind") == PAIR

    def beyond(x: Column) -> Column:
        return F.greatest(x - STRONG, F.lit(0.0))

    parts = whole - F.when(is_pair, single).otherwise(0.0), beyond(whole) - F.when(is_pair, beyond(single)).otherwise(0.0)
    return tuple(F.round(x * UNIT).cast("long") for x in parts)


def _bit(key: np.ndarray, probe: int) -> np.ndarray:
    return ((key >> np.uint64(19 * probe)) % np.uint64(BITMAP_BITS)).astype(np.int64)


def _may_hold(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether every bit of a key is set: always for a counted expression."""
    alive = np.arange(len(key))
    for probe in range(PROBES):
        at = _bit(key[alive], probe)
        alive = alive[bitmap[at >> 3] >> (at & 7) & 1 == 1]
    out = np.zeros(len(key), bool)
    out[alive] = True
    return out


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = batch.column(0).to_numpy().view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([_bit(key, k) for k in range(PROBES)]) + 1)], names=["place"])


def _bitmap(model: DataFrame) -> bytes:
    """``PROBES`` bits for each key of the model; always ``BITMAP_BITS`` long."""
    blocks = (
        model.select("key")
        .mapInArrow(_places, "place long")
        .groupBy(F.bitmap_bucket_number("place").alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    out = bytearray(BITMAP_BITS // 8)
    for r in blocks.toLocalIterator():
        start = (r["block"] - 1) * _BLOCK_BITS // 8
        out[start : start + len(r["bits"])] = r["bits"]
    return bytes(out)


def _look_up(batch: pa.RecordBatch, text: int, keys: np.ndarray, adds: np.ndarray, bitmap: np.ndarray) -> list[pa.Array]:
    """Per text: words, the sums over frequent expressions, and key, occurrences and its word's occurrences of the others."""
    n, sums = np.zeros(batch.num_rows, np.int64), np.zeros((2, batch.num_rows), np.int64)
    rest = [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
    for first, last, rows, ids, context in _words(batch, text, SCORED_BYTES):
        if not len(ids):
            continue
        n[first:last] = np.bincount(rows, minlength=last - first)
        own = _occurrences(rows, ids)
        row, key, word = np.concatenate((rows, rows)), np.concatenate((ids, _pair_keys(ids, context))), np.concatenate((own, own))
        place, known = find(keys, key.view(np.int64))
        for k in (0, 1):
            np.add.at(sums[k], first + row[known], adds[k][place[known]])
        left = np.flatnonzero(~known)
        left = left[_may_hold(bitmap, key[left])]
        row, key, word = row[left], key[left], word[left]
        times = _occurrences(row, key)
        order = np.lexsort((key, row))
        new = np.concatenate(([True], (np.diff(row[order]) != 0) | (np.diff(key[order].view(np.int64)) != 0)))[: len(order)]
        kept = order[new]
        rest.append((first + row[kept], key[kept], times[kept], word[kept]))
    row, key, times, word = (np.concatenate(x) for x in zip(*rest))
    bounds = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(bounds, pa.array(x.view(np.int64))) for x in (key, times, word)]
    return [pa.array(n), pa.array(sums[0]), pa.array(sums[1]), *lists]


def _occurrences(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """How often each key stands in its own row."""
    order = np.lexsort((keys, rows))
    r, k = rows[order], keys[order]
    new = np.concatenate(([True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])))[: len(keys)]
    group = np.cumsum(new) - 1
    out = np.empty(len(keys), np.int64)
    out[order] = np.bincount(group)[group] if len(keys) else 0
    return out


def _sums(df: DataFrame, frequent, bitmap, entries: DataFrame, parts: tuple[Column, Column]) -> DataFrame:
    """``df`` without its first column, the text, and with words, evidence and strong evidence of each row (n, s0, s1).

    ``frequent`` and ``bitmap`` are broadcasts; ``entries`` are the model's other rows and ``parts`` what each adds.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[1:])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, *adds = frequent.value
        bits = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            found = _look_up(batch, 0, keys, adds, bits)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *found], names=[*batch.schema.names[1:], "n", "a0", "a1", "keys", "times", "own"]
            )

    lists = ", ".join(f"{c} array<long>" for c in ("keys", "times", "own"))
    rows = staged(
        df.mapInArrow(look_up, f"{schema}, n long, a0 long, a1 long, {lists}").withColumn("row", F.monotonically_increasing_id())
    )
    label = ["label"] if "label" in df.columns else []
    others = rows.where(F.size("keys") > 0).select("row", *label, F.inline(F.arrays_zip("keys", "times", "own")))
    added = (
        others.join(entries, F.col("keys") == F.col("key"))
        .select("row", *((F.col("times") * part).alias(f"b{k}") for k, part in enumerate(parts)))
        .groupBy("row")
        .agg(F.sum("b0").alias("b0"), F.sum("b1").alias("b1"))
    )
    total = [(F.col(f"a{k}") + F.coalesce(f"b{k}", F.lit(0))).alias(f"s{k}") for k in (0, 1)]
    return rows.join(added, "row", "left").select(*df.columns[1:], "n", *total)


def _features() -> list[Column]:
    """Mean evidence, log of the strong evidence, that by length, and the length."""
    n, strong = F.greatest(F.col("n"), F.lit(1)), F.greatest(F.col("s1"), F.lit(0)) / UNIT
    features = F.col("s0") / UNIT / n, F.log1p(strong), F.log1p(100 * strong / n), F.log1p(n.cast("double")) / 10
    return [F.when(F.col("n") > 0, f).otherwise(0.0).alias(f"f{k}") for k, f in enumerate(features)]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a slightly damped logistic regression, by Newton steps; the last is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    damping = np.eye(x.shape[1]) * 0.1
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + damping, x.T @ (p - y) + damping @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def divided(model: DataFrame, totals: Totals) -> tuple[list[np.ndarray], DataFrame]:
    """key, evidence and strong evidence of the model's frequent expressions, sorted by key, and of all others as a table."""
    zero = F.lit(0)
    parts = [p.alias(f"d{k}") for k, p in enumerate(_evidence(totals, zero, zero, zero))]
    is_frequent = (F.col("toxic") + F.col("ordinary")) * FREQUENT >= totals.tokens
    top = model.where(is_frequent).select("key", *parts).toArrow()
    columns = [top.column(c).to_numpy() for c in ("key", "d0", "d1")]
    order = np.argsort(columns[0])
    return [c[order] for c in columns], model.where(~is_frequent).select("key", *parts)


def scorer(docs: DataFrame, labels: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Learns from ``docs`` and ``labels``; the result turns a table whose first column is a text into its other columns and ``score``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    known = training_labels(labels)
    training = training_rows(docs, known)
    counted = count_model(training)
    if counted is None:
        share = training.agg(F.avg("label")).first()[0] or 0.0
        return lambda df: df.drop(df.columns[0]).withColumn("score", F.lit(float(share)))
    model, totals = counted
    top, entries = divided(model, totals)
    frequent = spark.sparkContext.broadcast(top)
    nothing = spark.sparkContext.broadcast([np.empty(0, np.int64)] * 3)
    bitmap = spark.sparkContext.broadcast(_bitmap(model))

    drawn = known.orderBy(F.xxhash64("id"), "id").limit(CALIBRATION_ROWS)
    without_own = _evidence(totals, F.col("own"), F.col("times"), F.col("label"))
    sample = _sums(training_rows(docs, drawn), nothing, bitmap, model, without_own).select("label", *_features()).toPandas()
    weights = _logistic(sample[[f"f{k}" for k in range(4)]].to_numpy(), sample["label"].to_numpy())

    def score(df: DataFrame) -> DataFrame:
        sums = _sums(df, frequent, bitmap, entries, (F.col("d0"), F.col("d1")))
        z = F.lit(float(weights[-1]))
        for f, w in zip(_features(), weights):
            z = z + f * float(w)
        z = F.least(F.greatest(z, F.lit(-500.0)), F.lit(500.0))
        return sums.select(*df.columns[1:], (1 / (1 + F.exp(-z))).alias("score"))

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    scored = scorer(docs, labels)(docs.select(F.col("text").alias("text"), F.col("doc_id").alias("doc_id")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; all other rows and columns unchanged, whatever their names.

    The scores travel by two hashes of the text, which decides them.
    """
    marks = [F.xxhash64("text"), F.xxhash64(F.lit(1), F.col("text"))]
    own = [unused(docs, f"text_{k}") for k in "ab"]
    scored = scorer(docs, labels)(docs.select(F.col("text").alias("text"), *(m.alias(o) for m, o in zip(marks, own))))
    toxic = staged(scored.where(F.col("score") >= THRESHOLD).select(*own).distinct())
    marked = docs.select("*", *(m.alias(o) for m, o in zip(marks, own)))
    return marked.join(_small(toxic), own, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
