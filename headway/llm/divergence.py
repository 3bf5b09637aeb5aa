"""How far the sources of a language differ in their words, over the words the language really uses.

The kept terms of a language are those in at least ``MIN_DOCS`` of its documents.
They are found by iceberg prefix refinement: a prefix cannot stand in fewer
documents than a term that begins with it, so the prefixes of ``FIRST`` bytes are
counted first, those in too few documents are discarded, the others are extended
to twice the length, and so on until only complete terms remain (a term shorter
than the level's length is complete).

Documents are read once. Each stretch of a task's documents becomes an inverted
index of its terms, written to the shared folder; a level counts the distinct
documents of its live prefixes within each stretch, and Spark sums these. The
survivors go to the next level as a bitmap of fixed size: it may let a dead prefix
through, whose own count discards it again, but never loses one.

From the kept terms' counts every (lang, source) group, and each language as a
whole, gets smoothed shares in exact integers. Two sources differ by the sum of
(p - q)^2 / (p + q) over all kept terms; it is put together from sums over the
terms that a source holds, so absent terms cost nothing. A group's own terms are
ranked by the same measure against its language.

A null text, lang or source counts as empty. Every row is one document, whether
or not its id repeats. Equal values rank by item in UTF-8 order. A language
without kept terms has pairs of value 0 and no terms. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.kernels import Words, mixed, rows_of, slices, utf8
from headway.llm.staging import bounded_batches, staged

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
FIRST = 3
#: Text bytes of one stretch (its last batch may exceed them), and terms of one row of its index.
STRETCH_BYTES = 16 << 20
INDEX_TERMS = 4096
#: The index's files: sizes of row groups and pages hold from the first row on, not from the hundredth.
INDEX_FILES = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1"}
BITMAP_BITS = 1 << 26
_BLOCK_BITS = 8 * 4096
#: A term is a run of ASCII letters and bytes beyond ASCII, its capitals A to Z in lower case.
_WORDS = Words(tuple(b for b in range(128) if not chr(b).isalpha()))
_LOWER = np.array([b + 32 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else b for b in range(256)], np.uint8)
INDEX = "lang string, sources array<string>, source_of array<int>, terms array<binary>, lengths array<int>, docs array<int>, counts array<int>"


class _Stretch:
    """The inverted index of some documents of one language.

    Texts are split ``SLICE_BYTES`` at a time; only each slice's distinct terms and their
    documents are held until the stretch is written.
    """

    def __init__(self):
        self.parts: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]] = []
        self.sources: dict[str, int] = {}
        self.source_of = array("i")

    def add(self, texts: pa.Array, sources: list[str]) -> None:
        data, bounds = utf8(texts)
        for first, last in slices(bounds):
            own = bounds[first : last + 1]
            self._split(data[own[0] : own[-1]], own - own[0], len(self.source_of) + first)
        self.source_of.extend([self.sources.setdefault(s, len(self.sources)) for s in sources])

    def _split(self, data: np.ndarray, bounds: np.ndarray, doc: int) -> None:
        """Hold the slice's distinct terms and, for each term and document from ``doc`` on, the occurrences there."""
        starts, ends = _WORDS.bounds(data, bounds)
        offsets = np.concatenate(([0], np.cumsum(ends - starts)))
        inside = _LOWER[data[~_WORDS.is_separator[data]]]
        raw = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(inside)]
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), raw).dictionary_encode()
        n = len(bounds) - 1
        both, counts = np.unique(found.indices.to_numpy().astype(np.int64) * n + rows_of(bounds, starts), return_counts=True)
        self.parts.append((found.dictionary, *(x.astype(np.int32) for x in (both // n, both % n + doc, counts))))

    def _terms(self) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct terms and how many documents hold each; then, term by term, these documents and the occurrences there."""
        n = len(self.source_of)
        found = pa.concat_arrays([pa.array([], pa.large_binary()), *(terms for terms, *_ in self.parts)]).dictionary_encode()
        order = pc.array_sort_indices(found.dictionary)
        place = np.empty(len(order), np.int64)
        place[order.to_numpy()] = np.arange(len(order))
        place = place[found.indices.to_numpy()]
        both, counts, first = [np.empty(0, np.int64)], [np.empty(0, np.int32)], 0
        while self.parts:
            terms, own, docs, count = self.parts.pop(0)
            both.append(place[first : first + len(terms)][own] * n + docs)
            counts.append(count)
            first += len(terms)
        both, counts = np.concatenate(both), np.concatenate(counts)
        at = np.argsort(both)
        both, counts = both[at], counts[at]
        lengths = np.bincount(both // n, minlength=len(order)) if n else np.zeros(0, np.int64)
        return found.dictionary.take(order).cast(pa.binary()), lengths, (both % n).astype(np.int32) if n else both, counts

    def rows(self, lang: str) -> Iterator[list]:
        """Index rows of about ``INDEX_TERMS`` sorted terms; terms with one first prefix share a row."""
        terms, lengths, doc, count = self._terms()
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        begins = np.append(np.flatnonzero(_begins(terms, FIRST)), len(terms))
        sources, first = list(self.sources), 0
        while first < len(terms):
            last = begins[np.searchsorted(begins, min(first + INDEX_TERMS, len(terms)))]
            own = slice(bounds[first], bounds[last])
            yield [lang, sources, self.source_of, terms[first:last], lengths[first:last], doc[own], count[own]]
            first = last


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, _Stretch] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for lang, stretch in held.items():
            for _, *single, terms, lengths, docs, counts in stretch.rows(lang):
                names = [f.strip().split(" ")[0] for f in INDEX.split(",")]
                values = [pa.array([lang], pa.string())]
                values += [pa.array([v], pa.list_(kind)) for v, kind in zip(single, (pa.string(), pa.int32()))]
                ends = pa.array([0, len(terms)], pa.int32())
                values += [pa.ListArray.from_arrays(ends, v) for v in (terms, pa.array(lengths, pa.int32()))]
                ends = pa.array([0, len(docs)], pa.int32())
                values += [pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in (docs, counts)]
                yield pa.RecordBatch.from_arrays(values, names=names)
        held.clear()

    for batch in batches:
        langs, sources = (np.array(batch.column(k).to_pylist(), object) for k in (1, 2))
        for lang in dict.fromkeys(langs):
            own = langs == lang
            held.setdefault(lang, _Stretch()).add(batch.column(0).filter(pa.array(own)), sources[own].tolist())
        size += batch.column(0).nbytes
        if size > STRETCH_BYTES:
            yield from out()
            size = 0
            pa.default_memory_pool().release_unused()
    yield from out()
    pa.default_memory_pool().release_unused()


def _numbers(batch: pa.RecordBatch, column: str, row: int) -> np.ndarray:
    return batch.column(column)[row].values.to_numpy(zero_copy_only=False)


def _hashes(mark: bytes, terms: pa.BinaryArray, length: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bitmap places of the terms' prefixes of ``length`` bytes (None: whole terms), and whether a prefix is complete."""
    data, bounds = _bytes_of(terms)
    starts, ends = bounds[:-1], bounds[1:]
    complete = np.ones(len(terms), bool) if length is None else ends - starts < length
    if length is not None:
        ends = np.minimum(ends, starts + length)
    own = Words().hashes(data, starts, ends) if len(data) else np.zeros(len(terms), np.uint64)
    return mixed(own ^ np.uint64(zlib.crc32(mark)) ^ (complete.astype(np.uint64) << np.uint64(63))), complete


def _bytes_of(terms: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = terms.cast(pa.large_binary()).buffers()
    bounds = np.frombuffer(offsets, np.int64)[: len(terms) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def _begins(terms: pa.BinaryArray, length: int) -> np.ndarray:
    """Whether each of the sorted terms has another prefix of ``length`` bytes than the one before it."""
    data, bounds = _bytes_of(terms)
    starts, sizes = bounds[:-1], np.diff(bounds)
    new = np.zeros(len(sizes), bool)
    new[:1] = True
    at = np.arange(1, len(sizes))
    for k in range(length):
        inside = (sizes[at] > k) & (sizes[at - 1] > k)
        new[at[~inside]] = True
        at = at[inside]
        alike = data[starts[at] + k] == data[starts[at - 1] + k]
        new[at[~alike]] = True
        at = at[alike]
        if not len(at):
            break
    return new


def _is_set(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes % np.uint64(BITMAP_BITS)).astype(np.int64)
    return bitmap[at >> 3] >> (at & 7) & 1 == 1


def _level_counter(length: int, shared):
    """Distinct documents, within each index row, of the prefixes of ``length`` that extend survivors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if shared is None else np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for row in range(batch.num_rows):
                lang, terms = batch.column("lang")[row].as_py(), batch.column("terms")[row].values
                alive = np.ones(len(terms), bool)
                if bitmap is not None:
                    hashes, ended = _hashes(lang.encode(), terms, length // 2)
                    alive = ~ended & _is_set(bitmap, hashes)
                if not alive.any():
                    continue
                live = terms.filter(pa.array(alive))
                begins = _begins(live, length)
                group = np.full(len(terms), -1)
                group[alive] = np.cumsum(begins) - 1
                prefixes = pc.binary_slice(live.filter(pa.array(begins)), 0, length)
                own = np.repeat(group, _numbers(batch, "lengths", row))
                docs = _numbers(batch, "docs", row).astype(np.int64)
                top = docs.max() + 1
                distinct = np.unique((own * top + docs)[own >= 0])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang]).take(pa.array(np.zeros(len(prefixes), np.int32))),
                        prefixes,
                        pc.less(pc.binary_length(prefixes), length),
                        pa.array(np.bincount(distinct // top, minlength=len(prefixes))),
                    ],
                    names=["lang", "prefix", "complete", "docs"],
                )

    return count


def _term_counter(shared):
    """For each term of an index row that the bitmap holds, its sources and their occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for row in range(batch.num_rows):
                lang, sources = batch.column("lang")[row].as_py(), batch.column("sources")[row].values
                terms = batch.column("terms")[row].values
                kept = _is_set(bitmap, _hashes(lang.encode(), terms)[0])
                number = np.where(kept, np.cumsum(kept) - 1, -1)
                term = np.repeat(number, _numbers(batch, "lengths", row))
                source = _numbers(batch, "source_of", row)[_numbers(batch, "docs", row)]
                own = term >= 0
                places, at = np.unique((term * len(sources) + source)[own], return_inverse=True)
                found = np.bincount(at, _numbers(batch, "counts", row)[own], len(places)).astype(np.int64)
                bounds = pa.array(np.searchsorted(places // len(sources), np.arange(kept.sum() + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang]).take(pa.array(np.zeros(int(kept.sum()), np.int32))),
                        terms.filter(pa.array(kept)),
                        pa.ListArray.from_arrays(bounds, sources.take(pa.array(places % len(sources)))),
                        pa.ListArray.from_arrays(bounds, pa.array(found)),
                    ],
                    names=["lang", "term", "sources", "counts"],
                )

    return count


def _placer(length: int | None):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bitmap places, from 1, of rows of lang and prefix."""
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in set(langs):
                hashes, _ = _hashes(lang.encode(), batch.column(1).filter(pa.array(langs == lang)), length)
                yield pa.RecordBatch.from_arrays([pa.array((hashes % np.uint64(BITMAP_BITS)).astype(np.int64) + 1)], names=["place"])

    return place


def _bitmap(prefixes: DataFrame, length: int | None = None) -> bytes:
    """A bit for each row of lang and prefix, by hash; always ``BITMAP_BITS`` long, so its broadcast has a bound."""
    blocks = (
        prefixes.mapInArrow(_placer(length), "place long")
        .groupBy(F.bitmap_bucket_number("place").alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    out = bytearray(BITMAP_BITS // 8)
    for r in blocks.toLocalIterator():
        start = (r["block"] - 1) * _BLOCK_BITS // 8
        out[start : start + len(r["bits"])] = r["bits"]
    return bytes(out)


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])


def index_terms(docs: DataFrame) -> DataFrame:
    """The written inverted index of all documents, in stretches."""
    bounded_batches(docs.sparkSession)
    # A row is wide, and Spark decodes up to 4096 of a row group at once: a group of the default size takes most of a heap.
    return staged(_inputs(docs).mapInArrow(_index, INDEX), INDEX_FILES)


def kept_terms(index: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term (bytes) and distinct documents of the terms in at least ``min_docs`` documents of their language."""
    spark = index.sparkSession
    length, shared, kept = FIRST, None, None
    while True:
        level = staged(
            index.select("lang", "terms", "lengths", "docs")
            .mapInArrow(_level_counter(length, shared), "lang string, prefix binary, complete boolean, docs long")
            .groupBy("lang", "prefix", "complete")
            .agg(F.sum("docs").alias("docs"))
            .where(F.col("docs") >= min_docs)
        )
        if shared is not None:
            shared.destroy()
        ended = level.where("complete").select("lang", F.col("prefix").alias("term"), "docs")
        kept = ended if kept is None else kept.unionByName(ended)
        going = level.where("not complete").select("lang", "prefix")
        if not going.count():
            return kept
        shared = spark.sparkContext.broadcast(_bitmap(going, length))
        length *= 2


def term_counts(index: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, term and its occurrences n there, for kept terms."""
    kept = kept.select("lang", "term")
    shared = index.sparkSession.sparkContext.broadcast(_bitmap(kept))
    return staged(
        index.mapInArrow(_term_counter(shared), "lang string, term binary, sources array<string>, counts array<long>")
        .join(kept, ["lang", "term"], "left_semi")
        .repartition("lang", "term")
        .select("lang", "term", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n"))))
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"))
    )


def _div(a: Column, b: Column) -> Column:
    """Whole-number division."""
    return F.call_function("div", a, b)


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact beyond 64 bits."""
    return _div(F.lit(SCALE).cast("decimal(10,0)") * (n + 2), total + 2 * terms) + 1


def _apart(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _apart_np(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each two sources, over the terms both hold: what their distance there differs by from one-sided sums."""
    sums: dict[tuple[str, str, str], int] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for lang in set(langs):
            held = batch.filter(pa.array(langs == lang)).column(1)
            owner = np.repeat(np.arange(len(held)), pc.list_value_length(held).to_numpy())
            flat = held.flatten()
            names, source = np.unique(np.array(flat.field("source").to_pylist(), object), return_inverse=True)
            p, none = flat.field("p").to_numpy(), flat.field("none").to_numpy()
            absent = np.zeros(len(names), np.int64)
            absent[source] = none
            step = max(1, (1 << 22) // len(names))
            for first in range(0, len(held), step):
                own = (owner >= first) & (owner < first + step)
                shares = np.zeros((min(step, len(held) - first), len(names)), np.int64)
                shares[owner[own] - first, source[own]] = p[own]
                for k, name in enumerate(names):
                    q = shares[shares[:, k] > 0]
                    mine = q[:, k : k + 1]
                    both = _apart_np(mine, q) - _apart_np(mine, absent) - _apart_np(absent[k], q) + _apart_np(absent[k], absent)
                    for other, value in zip(names, np.where(q > 0, both, 0).sum(0).tolist()):
                        if other != name:
                            sums[lang, name, other] = sums.get((lang, name, other), 0) + value
    if sums:
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([k[i] for k in sums], pa.string()) for i in range(3)), pa.array(sums.values(), pa.int64())],
            names=["lang", "source", "item", "value"],
        )


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank; see the module's text."""
    index = index_terms(docs)
    kept = kept_terms(index, min_docs)
    counts = term_counts(index, kept)
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    lang_totals = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    none = F.when(F.col("terms") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("terms")))
    groups = staged(
        _inputs(docs)
        .select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(vocabulary, "lang", "left")
        .join(lang_totals, "lang", "left")
        .select(
            "lang",
            "source",
            *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("total", "terms", "lang_total")],
        )
        .withColumn("none", none)
    )
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))
    by_term = staged(
        shares.groupBy("lang", "term").agg(
            F.collect_list(F.struct("source", "n", "p", "none")).alias("held"),
            F.sum("n").alias("n"),
            F.first("lang_total").alias("lang_total"),
            F.first("terms").alias("terms"),
        )
    )

    # Pairs: all terms as if both sources lacked them, then what holding them changes on each side, then on both.
    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("item_none"))
    lacking = _apart(F.col("none"), F.col("item_none"))
    every = (
        groups.join(other, "lang")
        .where(F.col("source") != F.col("item"))
        .select("lang", "source", "item", F.coalesce(F.col("terms") * lacking, F.lit(0).cast("long")).alias("value"))
    )
    alike = by_term.select("lang", F.explode("held").alias("h")).groupBy("lang", "h.source", "h.p", "h.none").agg(F.count(F.lit(1)).alias("k"))
    one_side = (
        alike.join(other, "lang")
        .where(F.col("source") != F.col("item"))
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.col("k") * (_apart(F.col("p"), F.col("item_none")) - lacking)).alias("value"))
    )
    turned = one_side.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    both = by_term.select("lang", F.transform("held", lambda h: F.struct(h["source"].alias("source"), h["p"].alias("p"), h["none"].alias("none"))).alias("held"))
    both = both.mapInArrow(_shared_terms, "lang string, source string, item string, value long")
    pairs = every.unionByName(one_side).unionByName(turned).unionByName(both)
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))

    q = _share(F.col("n"), F.col("lang_total"), F.col("terms"))
    own = by_term.select("lang", "term", q.alias("q"), F.explode("held").alias("h")).where(F.col("h.p") > F.col("q"))
    terms = own.select(
        "lang",
        "h.source",
        F.col("term").cast("string").alias("item"),
        _apart(F.col("h.p"), F.col("q")).alias("value"),
        F.lit("term").alias("part"),
    )
    in_order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    ranked = terms.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= top)
    return (
        pairs.withColumn("rank", F.row_number().over(in_order))
        .unionByName(ranked)
        .select("lang", "source", "part", "item", "value", "rank")
    )


ORACLE_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
),
words AS (
    SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
sizes AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
held AS (
    SELECT lang, source, term, count(*)::HUGEINT AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM held GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
           1 + 1000000000 * (coalesce(h.n, 0) + 2) // (coalesce(t.total, 0) + 2 * s.v) AS p
    FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang)
    LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
    LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
),
whole AS (
    SELECT h.lang, h.term,
           1 + 1000000000 * (sum(h.n) + 2)::HUGEINT // (any_value(l.total) + 2 * any_value(s.v)) AS q
    FROM held h JOIN sizes s USING (lang)
    JOIN (SELECT lang, sum(n)::HUGEINT AS total FROM held GROUP BY lang) l USING (lang)
    GROUP BY h.lang, h.term
),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
),
parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT s.lang, s.source, 'term', s.term, ((s.p - w.q) * (s.p - w.q) // (s.p + w.q))::BIGINT
    FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term
    WHERE s.n > 0 AND s.p > w.q
),
ranked AS (
    SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank
    FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
