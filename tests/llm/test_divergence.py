"""The divergence audit against a plain version, its refinement level by level, odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from headway.llm import divergence as M

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(a): ord(a.lower()) for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, min_docs, top):
    docs = [tuple(v or "" for v in r) for r in rows]
    found = [(lang, source, Counter(TERM.findall(text.translate(LOWER)))) for text, lang, source in docs]
    in_docs = Counter((lang, t) for lang, _, c in found for t in c)
    kept = defaultdict(set)
    for (lang, t), n in in_docs.items():
        if n >= min_docs:
            kept[lang].add(t)
    groups, langs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, c in found:
        own = Counter({t: n for t, n in c.items() if t in kept[lang]})
        groups[lang, source] += own
        langs[lang] += own

    def share(counts, lang):
        total, v = sum(counts.values()), len(kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * v) for t in kept[lang]}

    def apart(p, q):
        return (p - q) ** 2 // (p + q)

    out = []
    for lang, source in groups:
        p, q = share(groups[lang, source], lang), share(langs[lang], lang)
        pairs = []
        for other_lang, other in groups:
            if other_lang == lang and other != source:
                o = share(groups[lang, other], lang)
                pairs.append((other, sum(apart(p[t], o[t]) for t in kept[lang])))
        terms = [(t, apart(p[t], q[t])) for t in kept[lang] if groups[lang, source][t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def rows(seed=1, n=260):
    draw = random.Random(seed)
    words = [a + b + c for a in ("a", "über", "Ka", "日本", "lo") for b in ("", "n", "ste", "é") for c in ("", "s", "ingenlonglonglongtail")]
    out = []
    for k in range(n):
        source = draw.choice(["s0", "s0", "s0", "s1", "S2", "é", None])
        text = " ".join(draw.choice(words[: 20 + 20 * (k % 3)]) + draw.choice([" ", "9", "-", "\n"]) for _ in range(draw.randint(0, 30)))
        out.append((text, draw.choice(["en", "en", "de", None]), source))
    out += [(None, "en", "s1"), ("", "zz", "lonely"), ("", "zz", "other"), (None, None, None), ("123 []", "en", "only digits")]
    return out + [("repeat a a a", "en", "s1")] * 12 + [(" ".join(words) * 300, "en", "long")]


def frame(spark, data):
    clash = [(*r, "x", 7, 3.0) for r in data]
    return spark.createDataFrame(clash, "text string, lang string, source string, item string, rank int, n double")


@pytest.mark.parametrize("min_docs,top", [(10, 10), (1, 3), (40, 10)])
def test_equals_the_plain_version(spark, min_docs, top):
    out = M.audit(frame(spark, rows()).repartition(3), min_docs, top)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, out.collect())) == plain(rows(), min_docs, top)


def test_stretches_and_rows_of_the_index_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(M, "STRETCH_BYTES", 500)
    monkeypatch.setattr(M, "INDEX_TERMS", 2)
    monkeypatch.setattr(M, "BITMAP_BITS", 32768)
    assert sorted(map(tuple, M.audit(frame(spark, rows(2))).collect())) == plain(rows(2), 10, 10)


def test_a_stretch_is_indexed_from_whole_arrays():
    """Terms of texts without marks between them, capitals, bytes beyond ASCII, nulls and empty texts."""
    texts = ["b a B", None, "Éa a1a", "", "zz", "zz,aé"]
    stretch = M._Stretch()
    stretch.add(pa.array(texts[:2], pa.string()), ["x", "y"])
    stretch.add(pa.array(texts, pa.string())[2:], ["x", "x", "y", "z"])
    found = Counter()
    for lang, sources, source_of, terms, lengths, docs, counts in stretch.rows("en"):
        assert lang == "en" and terms.to_pylist() == sorted(terms.to_pylist())
        owner = [t for t, n in zip(terms.to_pylist(), lengths) for _ in range(n)]
        for term, doc, count in zip(owner, docs, counts, strict=True):
            found[term.decode(), int(doc)] += int(count)
    assert found == Counter((t, k) for k, text in enumerate(texts) for t in TERM.findall((text or "").translate(LOWER)))
    assert [sources[k] for k in source_of] == ["x", "y", "x", "x", "y", "z"]


def test_the_index_has_row_groups_of_bounded_size(spark):
    """A reader decodes a row group at once, however few rows it has."""
    draw = random.Random(5)
    texts = [" ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(2000)) for _ in range(400)]
    docs = spark.createDataFrame([(t, "en", "a") for t in texts], "text string, lang string, source string")
    files = [f.removeprefix("file:") for f in M.index_terms(docs.coalesce(1)).inputFiles()]
    found = [pq.ParquetFile(f).metadata for f in files]
    sizes = [m.row_group(k).total_byte_size for m in found for k in range(m.num_row_groups)]
    assert sum(sizes) > 8 << 20 and max(sizes) < 6 << 20


def test_a_stretch_holds_terms_instead_of_texts():
    stretch = M._Stretch()
    for _ in range(3):
        stretch.add(pa.array(["of a few words " * 70_000, "more"]), ["x", "y"])
    assert sum(p.nbytes for part in stretch.parts for p in part) < 1000
    [row] = stretch.rows("en")
    assert row[3].to_pylist() == [b"a", b"few", b"more", b"of", b"words"]
    assert [list(x) for x in row[4:]] == [[3] * 5, [0, 2, 4, 0, 2, 4, 1, 3, 5, 0, 2, 4, 0, 2, 4], [70_000] * 6 + [1] * 3 + [70_000] * 6]


def test_a_bitmap_that_lets_everything_through_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(M, "_bitmap", lambda prefixes, length=None: b"\xff" * (M.BITMAP_BITS // 8))
    assert sorted(map(tuple, M.audit(frame(spark, rows(3))).collect())) == plain(rows(3), 10, 10)


def test_levels_discard_prefixes_below_the_threshold(spark, monkeypatch):
    seen = []
    whole = M._bitmap

    def watched(prefixes, length=None):
        seen.append({bytes(r["prefix"]) for r in prefixes.select("prefix").collect()})
        return whole(prefixes, length)

    monkeypatch.setattr(M, "_bitmap", watched)
    data = [("common commonest commoner", "en", "a")] * 10 + [("comet rare commodity", "en", "a")] * 9
    kept = M.kept_terms(M.index_terms(frame(spark, data)))
    assert {(r["lang"], bytes(r["term"]), r["docs"]) for r in kept.collect()} == {
        ("en", t, 10) for t in (b"common", b"commonest", b"commoner")
    }
    assert seen == [{b"com"}, {b"common"}]


def test_sums_beyond_64_bits_stay_exact(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(M._share(F.lit(10**12), F.lit(3 * 10**13), F.lit(10**9)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (10**12 + 2) // (3 * 10**13 + 2 * 10**9)


def test_empty_table(spark):
    assert M.audit(frame(spark, [])).collect() == []
