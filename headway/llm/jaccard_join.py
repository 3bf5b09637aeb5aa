"""Set-similarity join on word shingles by token-combination prefixes.

A document's set holds the hashes of its distinct five-word shingles. Sets are
ordered by one global order, rare shingles before frequent ones, and only a
prefix of each is indexed: rare shingles alone, frequent ones in pairs from the
same class. A frequent class needs one shingle more before it counts against the
allowed differences, so prefixes are extended until every linked pair must share
a signature (a single rare shingle or a pair of frequent ones). Which shingles are
frequent is counted over all documents' prefixes.

Equal sets are one class from the start and are never compared. Signatures
meet in a shuffle; in every bucket all members are compared, exactly, with one set
drawn for it. What is then left is compared only across the components found so
far: in small buckets pair by pair, in large ones by what tells the members apart.

For the latter, members of large buckets with the same main component form a
region. Its centre holds the shingles of more than half of some sets drawn from it
(which, only changes how many candidates there are), and each set of the region is
turned into its difference from the centre. Linked sets differ by at most a
ninth of their sizes' sum, so unless both are so near the centre that they must
be linked, their differences share members: a prefix of each difference, rare
shingles first, is indexed. Edits peculiar to one set are rare, so a large group
whose sets are nearly but not quite alike yields few candidates, and none is lost.

Null or empty texts and texts without words have the empty set and no link.
Rows that repeat a ``doc_id`` are one document each. A null ``doc_id`` takes part
in no component: its ``component_id`` is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.components import components
from headway.llm.kernels import Words, find, mixed, rabin_karp, rows_of, signed, slices, utf8
from headway.llm.staging import bounded_batches, row_key, staged, unused

WIDTH = 5
PERCENT = 80
#: A shingle is frequent from so many prefixes on; at most ``FREQUENT_ENTRIES`` shingles are.
FREQUENT_FROM = 64
FREQUENT_ENTRIES = 1 << 19
CLASSES = np.uint64(8)
#: Sets up to the first size index frequent shingles alone, from the second on in pairs.
#: Linked sets differ in size by a quarter at most, so they share one of the two ways.
SINGLES_TO, PAIRS_FROM = 20, 16
BROADCAST_IDS = 1_000_000
#: Buckets of more members are compared by their differences from a centre.
PAIRWISE_MEMBERS = 64
#: A region's centre is taken from about so many drawn sets; any centre gives the same links.
CENTRE_SETS = 64
#: Text bytes hashed at a time: every byte takes eight bytes in each of several arrays. It bounds memory, not results.
HASHED_BYTES = 1 << 19


def shingle_sets(column: pa.Array, words: Words, width: int = WIDTH) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted set of shingle hashes for every text with words."""
    data, bounds = utf8(column)
    for first, last in slices(bounds, HASHED_BYTES):
        own = bounds[first : last + 1] - bounds[first]
        part = data[bounds[first] : bounds[last]]
        starts, ends = words.bounds(part, own)
        ids = words.hashes(part, starts, ends)
        rolled = rabin_karp(ids, width)
        edges = np.searchsorted(rows_of(own, starts), np.arange(last - first + 1))
        for row, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if b - a >= width:
                yield first + row, np.unique(rolled[a : b - width + 1])
            elif b > a:
                yield first + row, rabin_karp(mixed(ids[a:b] + np.uint64(b - a)), int(b - a))


def allowed(size: int) -> int:
    """How many of a set's members a linked set may lack."""
    return size - -(-PERCENT * size // 100)


def set_key(members: np.ndarray) -> int:
    """One number for a set, whatever the order of its members."""
    total = np.add.reduce(mixed(members ^ np.uint64(0xA5A5A5A5A5A5A5A5))) + np.uint64(len(members))
    return int(signed(mixed(np.array([total], np.uint64)))[0])


def signatures(members: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The signatures of a sorted set, given the sorted frequent shingles."""
    size = len(members)
    need = allowed(size) + 1
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, members), len(frequent) - 1)
        common = frequent[place] == members
        rare, often = members[~common], members[common]
    else:
        rare, often = members, members[:0]
    if len(rare) >= need:
        return rare[:need]
    short = need - len(rare)
    found = [rare]
    if size <= SINGLES_TO:
        found.append(often[:short])
    if size >= PAIRS_FROM:
        kind = (often % CLASSES).astype(np.int64)
        order = np.argsort(kind, kind="stable")
        counts = np.bincount(kind, minlength=int(CLASSES))
        rank = np.empty(len(often), np.int64)
        rank[order] = np.arange(len(often)) - np.repeat(np.cumsum(counts) - counts, counts)
        reached = np.flatnonzero(np.cumsum(rank >= 1) >= short)
        prefix = often[: int(reached[0]) + 1 if len(reached) else len(often)]
        for k in range(int(CLASSES)):
            own = prefix[prefix % CLASSES == np.uint64(k)]
            i, j = np.triu_indices(len(own), 1)
            found.append(mixed(own[i] * np.uint64(0x9E3779B97F4A7C15) + mixed(own[j])))
    return np.concatenate(found)


def bitmap(members: np.ndarray) -> bytes:
    """Which of some 2 to 4 places for each member are taken."""
    places = max(64, 1 << (2 * len(members) - 1).bit_length())
    taken = np.zeros(places, np.uint8)
    taken[(members & np.uint64(places - 1)).astype(np.int64)] = 1
    return np.packbits(taken, bitorder="little").tobytes()


def most_shared(a: bytes, a_size: int, b: bytes, b_size: int) -> int:
    """No two sets with these bitmaps share more members: places taken in one alone differ."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) > len(y):
        x = np.bitwise_or.reduce(x.reshape(-1, len(y)), axis=0)
    elif len(y) > len(x):
        y = np.bitwise_or.reduce(y.reshape(-1, len(x)), axis=0)
    return (a_size + b_size - int(np.bitwise_count(x ^ y).sum())) // 2


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words(lower=True)
    for batch in batches:
        size, key = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        bits = [b""] * batch.num_rows
        for row, members in shingle_sets(batch.column(1), words):
            size[row], key[row], bits[row] = len(members), set_key(members), bitmap(members)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size), pa.array(key), pa.array(bits, pa.binary()), *batch.columns[2:]],
            names=["doc_id", "n_shingles", "set_key", "bits", *batch.schema.names[2:]],
        )


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of keys whose bitmaps do not rule the threshold out."""
    for batch in batches:
        a, b, a_size, b_size, a_bits, b_bits = (batch.column(i).to_pylist() for i in range(6))
        kept = []
        for row in range(batch.num_rows):
            both = most_shared(a_bits[row], a_size[row], b_bits[row], b_size[row])
            if 100 * both >= PERCENT * (a_size[row] + b_size[row] - both):
                kept.append(row)
        yield pa.RecordBatch.from_arrays(
            [batch.column(i).take(pa.array(kept, pa.int64())) for i in (0, 1)], names=["a", "b"]
        )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words(lower=True)
    for batch in batches:
        parts = [s[: allowed(len(s)) + 1] for _, s in shingle_sets(batch.column(1), words)]
        unique, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *parts]), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(unique)), pa.array(counts.astype(np.int32))], names=["shingle", "n"]
        )


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of shared signatures with their bucket's first set, from rows sorted by signature and size.

    Only the current bucket's first set is held between batches.
    """
    last = (None, 0, 0)  # signature, size and key of the row before
    center, told = (0, 0), False  # size and key of the current bucket's first set; whether it was emitted
    for batch in batches:
        sig, size, key = (batch.column(i).to_numpy() for i in range(3))
        if not len(sig):
            continue
        same = np.concatenate(([sig[0] == last[0]], sig[1:] == sig[:-1]))
        twice = same & np.concatenate(([key[0] == last[2]], key[1:] == key[:-1]))
        begins = np.flatnonzero(~same)
        at = np.cumsum(~same) - 1  # -1: the bucket goes on from the batch before
        sizes = np.concatenate((size[begins], [center[0]]))[at]
        keys = np.concatenate((key[begins], [center[1]]))[at]
        member = same & ~twice
        firsts = np.zeros(len(sig), bool)
        firsts[begins[np.unique(at[member & (at >= 0)])]] = True
        out = [[sig, key, size, keys, sizes], np.flatnonzero(member | firsts)]
        rows = [x[out[1]] for x in out[0]]
        if bool((member & (at < 0)).any()) and not told:
            rows = [np.concatenate(([v], x)) for v, x in zip((last[0], center[1], center[0], center[1], center[0]), rows)]
        if len(rows[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(x, np.int64)) for x in rows], names=["sig", "key", "size", "first", "first_size"]
            )
        told = bool(firsts[begins[-1]]) if len(begins) else told or bool(member.any())
        center = (int(sizes[-1]), int(keys[-1]))
        last = (sig[-1], size[-1], key[-1])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of keys whose texts' sets pass the threshold."""
    words = Words(lower=True)
    for batch in batches:
        kept = np.zeros(batch.num_rows, bool)
        held: dict[int, np.ndarray] = {}
        keys = [batch.column(i).to_numpy() for i in (0, 1)]
        for side in (0, 1):  # each distinct set of the batch once
            _, rows = np.unique(keys[side], return_index=True)
            rows = rows[[keys[side][r] not in held for r in rows]] if len(rows) else rows
            for row, members in shingle_sets(batch.column(2 + side).take(pa.array(rows)), words):
                held[keys[side][rows[row]]] = members
        for row, (a, b) in enumerate(zip(*keys)):
            x, y = held[a], held[b]
            both = len(np.intersect1d(x, y, assume_unique=True))
            kept[row] = 100 * both >= PERCENT * (len(x) + len(y) - both)
        yield pa.RecordBatch.from_arrays([pa.array(k[kept]) for k in keys], names=["a", "b"])


def _texts(keys: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``set_key`` and the text of one document that has the set."""
    wanted = staged(keys.join(classes.select("set_key", "least"), "set_key"))
    ids = wanted.select("set_key", F.col("least").alias("wanted_id"))
    if wanted.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return staged(
        docs.join(ids, docs["doc_id"] == F.col("wanted_id")).groupBy("set_key").agg(F.first("text").alias("text"))
    )


def linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``: set keys) that are similar enough, by their representatives' texts.

    Bitmaps rule most pairs out before any text is fetched.
    """
    sides = [
        classes.select(F.col("set_key").alias(x), F.col("n_shingles").alias(f"{x}_size"), F.col("bits").alias(f"{x}_bits"))
        for x in ("a", "b")
    ]
    sized = pairs.distinct().join(sides[0], "a").join(sides[1], "b")
    sized = sized.select("a", "b", "a_size", "b_size", "a_bits", "b_bits")
    pairs = staged(sized.mapInArrow(_may_link, "a long, b long"))
    texts = _texts(pairs.select(F.col("a").alias("set_key")).union(pairs.select("b")).distinct(), classes, docs)
    left = texts.select(F.col("set_key").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("set_key").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")
    return staged(both.mapInArrow(_compare, "a long, b long"))


def _fits(a: str, b: str):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _ordered(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def _placed(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """The members of buckets that still hold several components, with the bucket's largest as ``main`` and its ``members``."""
    placed = buckets.join(found, buckets["key"] == found["node"], "left").select(
        "sig", "key", "size", F.coalesce("component", "key").alias("component")
    )
    per = placed.groupBy("sig", "component").agg(F.count("*").alias("n"))
    several = per.groupBy("sig").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.count("*").alias("k"),
        F.sum("n").alias("members"),
    )
    return staged(placed.join(several.where("k > 1").drop("k"), "sig"))


def _apart(placed: DataFrame) -> DataFrame:
    """All pairs of different components in a bucket."""
    outside = placed.where("component != main").select(
        F.col("sig").alias("of"), F.col("key").alias("x"), F.col("size").alias("x_size"), F.col("component").alias("x_component")
    )
    met = outside.join(placed, F.col("of") == F.col("sig")).where(
        (F.col("component") != F.col("x_component"))
        & ((F.col("component") == F.col("main")) | (F.col("x") < F.col("key")))
        & _fits("size", "x_size")
    )
    return _ordered(met, "x", "key")


def _region_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of a batch's sets hold each shingle, by region."""
    words = Words(lower=True)
    for batch in batches:
        region = batch.column(0).to_numpy()
        found = [(region[row], members) for row, members in shingle_sets(batch.column(3), words)]
        if not found:
            continue
        members = np.concatenate([m for _, m in found])
        regions = np.repeat(np.array([r for r, _ in found], np.int64), [len(m) for _, m in found])
        order = np.lexsort((members, regions))
        members, regions = members[order], regions[order]
        new = np.flatnonzero(
            np.concatenate(([True], (members[1:] != members[:-1]) | (regions[1:] != regions[:-1])))
        )
        counts = np.diff(np.concatenate((new, [len(members)])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(regions[new]), pa.array(signed(members[new])), pa.array(counts)], names=["region", "shingle", "n"]
        )


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per set its size and distance from the centre (``place`` -1), then the prefix of its difference.

    A linked set is at most a quarter of this one's size away, so both differences
    share all but so many of this one's members: the prefix is that long and one more.
    """
    words = Words(lower=True)
    names = ["region", "shingle", "key", "component", "size", "distance", "place"]
    for batch in batches:
        region, key, component = (batch.column(i).to_numpy() for i in range(3))
        rows: list[list[np.ndarray]] = []
        for row, members in shingle_sets(batch.column(3), words):
            held, counts = (np.array(batch.column(i)[row].as_py() or [], np.int64) for i in (4, 5))
            sets = batch.column(6)[row].as_py()
            central = 2 * counts > sets
            apart = signed(np.setxor1d(members, held[central].view(np.uint64), assume_unique=True))
            order = np.argsort(held)
            held, often = held[order], np.where(central, sets - counts, counts)[order]
            place, known = find(held, apart)
            seen = np.where(known, often[place], 0) if len(held) else np.zeros(len(apart), np.int64)
            apart = apart[np.lexsort((apart, seen))]
            size, distance = len(members), len(apart)
            apart = apart[: distance - max(1, distance - size // 4) + 1]
            n = len(apart) + 1
            rows.append(
                [np.full(n, region[row]), np.append(0, apart), np.full(n, key[row]), np.full(n, component[row])]
                + [np.full(n, size), np.full(n, distance), np.arange(-1, n - 1)]
            )
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(column).astype(np.int64)) for column in zip(*rows)], names=names
            )


def _regions(placed: DataFrame, classes: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links that follow from nearness to the centre, and candidate pairs of different components, for large buckets."""
    members = staged(placed.select(F.col("main").alias("region"), "key", "component").distinct())
    texts = _texts(members.select(F.col("key").alias("set_key")).distinct(), classes, docs)
    sets = staged(members.join(texts, F.col("key") == F.col("set_key")).select("region", "key", "component", "text"))
    per = members.groupBy("region").agg(F.count("*").alias("sets"))
    drawn = sets.join(per, "region").where(
        F.pmod(F.xxhash64("region", "key"), F.ceil(F.col("sets") / CENTRE_SETS)) == 0
    )
    drawn = staged(drawn.select("region", "key", "component", "text"))
    counts = drawn.mapInArrow(_region_counts, "region long, shingle long, n long").groupBy("region", "shingle").agg(F.sum("n").alias("n"))
    per = drawn.groupBy("region").agg(F.count("*").alias("sets"))
    # shingles of a quarter of the drawn sets: at most four times as many as a set has on average
    common = staged(
        counts.join(per, "region").where("4 * n >= sets").groupBy("region", "sets")
        .agg(F.collect_list(F.struct("shingle", "n")).alias("held"))
        .select(F.col("region").alias("of"), "sets", F.col("held.shingle").alias("shingles"), F.col("held.n").alias("counts"))
    )
    centred = sets.join(common, F.col("region") == F.col("of"), "left").select(
        "region", "key", "component", "text", "shingles", "counts", F.coalesce("sets", F.lit(0)).alias("sets")
    )
    rows = staged(
        centred.mapInArrow(
            _differences, "region long, shingle long, key long, component long, size long, distance long, place long"
        ).withColumn("reach", F.expr("9 * distance - size"))
    )
    # two sets whose reaches sum to 0 or less are linked, and then both are with the set of least reach
    heads = rows.where("place = -1")
    nearest = heads.groupBy(F.col("region").alias("of")).agg(F.min(F.struct("reach", "key")).alias("best"))
    sure = heads.join(nearest, (F.col("region") == F.col("of")) & (F.col("reach") + F.col("best.reach") <= 0)).where(
        "key != best.key"
    )
    # others share at least (sum of reaches) / 18 members of their differences
    x, y = (
        rows.where("place >= 0").select([F.col(c).alias(f"{side}_{c}") for c in rows.columns]) for side in ("x", "y")
    )
    shared = F.ceil((F.col("x_reach") + F.col("y_reach")) / 18)
    met = x.join(
        y,
        (F.col("x_region") == F.col("y_region"))
        & (F.col("x_shingle") == F.col("y_shingle"))
        & (F.col("x_key") < F.col("y_key"))
        & (F.col("x_component") != F.col("y_component"))
        & _fits("x_size", "y_size")
        & (F.col("x_reach") + F.col("y_reach") > 0)
        & (F.col("x_place") <= F.col("x_distance") - shared)
        & (F.col("y_place") <= F.col("y_distance") - shared),
    )
    return staged(_ordered(sure.select("key", F.col("best.key").alias("other")), "key", "other")), _ordered(met, "x_key", "y_key")


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return _row_components(docs).select("doc_id", "n_shingles", "component_id")


def _row_components(docs: DataFrame) -> DataFrame:
    """For every row of doc_id and text n_shingles, component, component_id and its further columns."""
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    more = "".join(f", {f.name} {f.dataType.simpleString()}" for f in docs.schema.fields[2:])
    sets = staged(docs.mapInArrow(_sets, f"doc_id long, n_shingles long, set_key long, bits binary{more}"))
    known = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    classes = staged(
        sets.where(known).groupBy("set_key", "n_shingles", "bits").agg(F.min("doc_id").alias("least"))
    )
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")

    counted = (
        texts.mapInArrow(_prefixes, "shingle long, n int").groupBy("shingle").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= FREQUENT_FROM)
    )
    counted = staged(counted)
    total = counted.agg(F.sum("n")).first()[0] or 0
    least = max(FREQUENT_FROM, -(-total // FREQUENT_ENTRIES))
    often = counted.where(F.col("n") >= least).select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    frequent = spark.sparkContext.broadcast(np.sort(often.view(np.uint64)))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        for batch in batches:
            found: dict[int, tuple[int, np.ndarray]] = {}
            for _, members in shingle_sets(batch.column(1), words):
                key = set_key(members)
                if key not in found:  # copies within the batch count once
                    found[key] = len(members), signatures(members, frequent.value)
            lengths = [len(s) for _, s in found.values()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate([np.empty(0, np.uint64), *(s for _, s in found.values())]))),
                    pa.array(np.repeat(np.array([n for n, _ in found.values()], np.int32), lengths)),
                    pa.array(np.repeat(np.array(list(found), np.int64), lengths)),
                ],
                names=["sig", "size", "key"],
            )

    signed_rows = texts.mapInArrow(sign, "sig long, size int, key long")
    by_draw = signed_rows.withColumn("draw", F.xxhash64("sig", "key"))
    buckets = staged(
        by_draw.repartition(F.col("sig")).sortWithinPartitions("sig", "draw", "key").select("sig", "size", "key")
        .mapInArrow(_buckets, "sig long, key long, size long, first long, first_size long")
    )
    stars = buckets.where((F.col("key") != F.col("first")) & _fits("size", "first_size"))
    tested = staged(_ordered(stars, "first", "key").distinct())
    links = linked(tested, classes, texts)
    found = components(links)
    placed = _placed(buckets, found)
    sure, across = _regions(placed.where(F.col("members") > PAIRWISE_MEMBERS), classes, texts)
    rest = _apart(placed.where(F.col("members") <= PAIRWISE_MEMBERS)).union(across)
    more = linked(rest.distinct().join(tested, ["a", "b"], "left_anti"), classes, texts)
    found = components(links.union(sure).union(more))

    joined = classes.join(found, classes["set_key"] == found["node"], "left").select(
        "set_key", "least", F.coalesce("component", "set_key").alias("component")
    )
    named = joined.join(
        joined.groupBy("component").agg(F.min("least").alias("component_id")), "component"
    ).select(F.col("set_key").alias("of"), "component", "component_id")
    own = sets.join(named, known & (F.col("set_key") == F.col("of")), "left")
    return own.select(
        "doc_id", "n_shingles", "component", F.coalesce("component_id", "doc_id").alias("component_id"), *docs.columns[2:]
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component: one with its least ``doc_id``; rows without words or id all stay."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), row_key().alias("row_key"))
    found = staged(_row_components(texts))
    firm = found.where("n_shingles = 0 or doc_id is null").select("row_key").distinct()
    alike = found.where("n_shingles > 0 and doc_id = component_id").groupBy("component", "row_key").agg(F.count("*").alias("n"))
    first = alike.groupBy("component").agg(F.min(F.struct("row_key", "n")).alias("first")).select("first.row_key", "first.n")
    other = unused(docs, "stays")
    staying = firm.union(first.select("row_key")).select(F.col("row_key").alias(other))
    kept = docs.join(staying, row_key() == F.col(other), "left_semi")
    again = first.where("n > 1").select(F.col("row_key").alias(other))
    if again.isEmpty():
        return kept
    single = kept.join(again, row_key() == F.col(other), "left_anti")
    return single.union(kept.join(again, row_key() == F.col(other), "left_semi").dropDuplicates(["doc_id", "text"]))


#: DuckDB: shared shingles of all pairs (for small tables), links, and what links reach.
ORACLE_SQL = r"""WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents
), placed AS (
  SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(range(len(words))) AS place FROM cut
), joined AS (
  SELECT doc_id, place = 0 OR place <= n - 5 AS whole, string_agg(word, ' ') OVER
    (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS shingle
  FROM placed
), sets AS (
  SELECT DISTINCT doc_id, md5(shingle) AS shingle FROM joined WHERE whole
), sizes AS (
  SELECT doc_id, count(*) AS size FROM sets GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * n >= 80 * (a.size + b.size - n)
), ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, w.y FROM reached r JOIN ways w ON r.other = w.x
)
SELECT doc_id, CAST(coalesce(any_value(size), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""
