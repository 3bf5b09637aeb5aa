"""Substring, suffix-array and near-duplicate removal against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from headway.llm import jaccard_join, substring_dedup, suffix_dedup, suffix_sort
from tests.llm.samples import SCHEMA, corpus, prose

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


def test_repeated_windows_go_from_later_documents(spark, docs):
    first, expected = {}, {}
    for doc_id, text, *_ in corpus():
        words = WORD.findall(text or "")
        gone, own = [False] * len(words), []
        for k in range(len(words) - 49):
            window = tuple(words[k : k + 50])
            if window in first:
                gone[k : k + 50] = [True] * 50
            own.append(window)
        for window in own:
            first.setdefault(window, doc_id)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        expected[doc_id] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    found = {r[0]: tuple(r[1:]) for r in substring_dedup.remove_repeats(docs).collect()}
    assert found == expected
    assert sum(x[1] for x in expected.values()) > 300


def test_repeated_bytes_go_everywhere(spark, docs):
    count: dict[bytes, int] = {}
    raw = {d: (t or "").encode() for d, t, *_ in corpus()}
    for text in raw.values():
        for k in range(len(text) - 399):
            count[text[k : k + 400]] = count.get(text[k : k + 400], 0) + 1
    expected = {}
    for doc_id, text in raw.items():
        gone = np.zeros(len(text), bool)
        for k in range(len(text) - 399):
            if count[text[k : k + 400]] > 1:
                gone[k : k + 400] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        expected[doc_id] = (len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    found = {r[0]: tuple(r[1:]) for r in suffix_dedup.remove_repeated_bytes(docs).collect()}
    assert found == expected


@pytest.mark.parametrize("queue_bytes", [64, 1 << 20])
@pytest.mark.parametrize("short", [4, 1 << 22])
def test_suffix_array_and_common_prefixes(monkeypatch, queue_bytes, short):
    monkeypatch.setattr(suffix_sort, "SHORT", short)
    draw = np.random.default_rng(3)
    for _ in range(60):
        text = np.append(draw.integers(1, draw.integers(2, 6), draw.integers(1, 90)), 0)
        items = text.tolist()
        order = sorted(range(len(items)), key=lambda i: items[i:])
        found, lcp = suffix_sort.suffix_array(text, queue_bytes=queue_bytes)
        assert found.tolist() == order
        for a, b, n in zip(order, order[1:], lcp[1:]):
            assert items[a : a + n] == items[b : b + n] and items[a + n : a + n + 1] != items[b + n : b + n + 1]


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return {" ".join(words)} if words else set()
    return {" ".join(words[k : k + 5]) for k in range(len(words) - 4)}


def brute_components(rows):
    sets = {d: shingles(t) for d, t, *_ in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: (len(s), root(d)) for d, s in sets.items()}


@pytest.mark.parametrize("frequent_from", [2, 64])
def test_components_of_similar_documents(spark, docs, monkeypatch, frequent_from):
    monkeypatch.setattr(jaccard_join, "FREQUENT_FROM", frequent_from)
    expected = brute_components(corpus())
    found = {r[0]: tuple(r[1:]) for r in jaccard_join.similar_components(docs).collect()}
    assert found == expected
    kept = sorted(r.doc_id for r in jaccard_join.keep_one(docs).collect())
    assert kept == sorted(d for d, (n, c) in expected.items() if n == 0 or c == d)


def edited_groups():
    """Documents with ever more edits of three bases, many of them just too far apart to link."""
    draw, rows = random.Random(11), []
    for base in (prose(200, 150), prose(201, 60), prose(202, 90) + " " + prose(203, 40)):
        for k in range(70):
            words = base.split()
            for place in draw.sample(range(len(words)), k % 8 * len(words) // 150 + k % 3):
                words[place] = draw.choice(("same", f"own{draw.randrange(10**6)}"))
            if k % 9 == 0:
                words += prose(203, 40).split()[: k % 20]
            rows.append((len(rows), " ".join(words), "en", "src", 0))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("pairwise", [2, 12, 10_000])
def test_groups_of_sets_nearly_alike(spark, monkeypatch, pairwise):
    monkeypatch.setattr(jaccard_join, "PAIRWISE_MEMBERS", pairwise)
    monkeypatch.setattr(jaccard_join, "FREQUENT_FROM", 8)
    rows = edited_groups()
    expected = brute_components(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert {r[0]: tuple(r[1:]) for r in jaccard_join.similar_components(docs).collect()} == expected
    assert 10 < len({c for _, c in expected.values()}) < len(rows) - 60


def test_every_link_of_a_region_is_sure_or_a_candidate(spark):
    rows = edited_groups()
    docs = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text")
    sets = docs.mapInArrow(jaccard_join._sets, "doc_id long, n_shingles long, set_key long, bits binary").toPandas()
    own = {d: shingles(t) for d, t, *_ in rows}
    key = dict(zip(sets["doc_id"], sets["set_key"].tolist()))
    doc = {k: d for d, k in key.items()}
    classes = spark.createDataFrame(list(doc.items()), "set_key long, least long")
    placed = classes.selectExpr("1L as main", "set_key as key", "set_key as component")
    sure, across = jaccard_join._regions(placed, classes, docs)
    sure, across = ({tuple(r) for r in df.collect()} for df in (sure, across))
    links = {
        (a, b) for a in doc for b in doc if a < b
        and 100 * len(own[doc[a]] & own[doc[b]]) >= 80 * len(own[doc[a]] | own[doc[b]])
    }
    assert sure <= links
    near = {x for pair in sure for x in pair}
    assert all(pair in across or set(pair) <= near for pair in links)
    assert len(across) < len(doc) ** 2 / 8


def test_signatures_are_shared_by_linked_sets():
    draw = np.random.default_rng(5)
    for size in (5, 12, 16, 18, 20, 23, 40, 150):
        for _ in range(60):
            x = np.unique(draw.integers(0, 2**63, size).astype(np.uint64))
            y = x.copy()
            change = draw.choice(len(x), max(0, len(x) // 10), replace=False)
            y[change] = draw.integers(0, 2**63, len(change)).astype(np.uint64)
            y = np.unique(y)
            both = len(np.intersect1d(x, y))
            frequent = np.sort(draw.choice(np.union1d(x, y), len(x) // 2 + 1, replace=False))
            if 100 * both >= 80 * (len(x) + len(y) - both):
                for known in (np.empty(0, np.uint64), frequent, np.union1d(x, y)):
                    assert len(np.intersect1d(jaccard_join.signatures(x, known), jaccard_join.signatures(y, known)))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.remove_repeats(none).count() == 0
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0
    assert jaccard_join.similar_components(none).count() == 0
