"""HTML extraction: the induced wrapper decides, matching against brute force, hostile and odd input."""

from __future__ import annotations

import random
import time
from functools import lru_cache

import pytest

from headway.llm import html_extract as M
from headway.llm import html_tree as T
from tests.llm.samples import prose

SCHEMA = "page_id long, url string, html string, text string, n_chars int, host string, nodes int"


def _page(k, menu="Home", article=3):
    paragraphs = [prose(1000 * k + j, 12) for j in range(article)]
    body = "".join(f"<p class='t2'>{p}</p>" for p in paragraphs)
    return (
        f"<html><body><div class='q1'><span>{menu}</span> <a href='/a'>News</a></div><div class='q2'>{prose(7 * k, 4)}</div>"
        f"<div class='q3'><h2>{prose(k, 5)}</h2>{body}<div class='q4'>Printed by us</div></div>"
        f"<div class='q5'><p><a href='/x{k}'>{prose(k + 50, 9)}</a></p></div><div class='q6'>All rights, {k}</div></body></html>",
        "\n".join([prose(k, 5), *paragraphs]),
    )


def _frame(spark, rows):
    return spark.createDataFrame([(k, url, page, "x", 1, "h", 2) for k, (url, page) in enumerate(rows)], SCHEMA)


def test_the_wrapper_removes_what_no_name_tells(spark):
    pages = [_page(k, article=1 + k % 5) for k in range(9)]
    rows = [("https://one.example/%d" % k, page) for k, (page, _) in enumerate(pages)]
    got = {r["page_id"]: r for r in M.extract(_frame(spark, rows).repartition(3)).collect()}
    for k, (page, expected) in enumerate(pages):
        assert got[k]["text"] == expected and got[k]["n_chars"] == len(expected)
        # Without a wrapper the layout's other parts stay: names decide nothing here.
        assert M.main_text(page, None) != expected


def test_a_line_that_two_articles_share_stays(spark):
    shared = "A line that stands in several articles of the host."
    pages = [_page(k)[0].replace("<p class='t2'>", f"<p class='t2'>{shared}</p><p class='t2'>", 1) for k in range(5)]
    got = M.extract(_frame(spark, [("http://h/%d" % k, p) for k, p in enumerate(pages)])).collect()
    assert all(shared in r["text"] and "Printed" not in r["text"] for r in got)


def test_copies_are_no_evidence_of_template(spark):
    page, expected = _page(1)
    other, other_text = _page(2)
    rows = [("http://h/%d" % k, page) for k in range(6)] + [("http://h/z", other)]
    got = M.extract(_frame(spark, rows)).collect()
    assert sorted(r["text"] for r in got) == sorted([expected] * 6 + [other_text])


def test_a_host_with_one_page_goes_by_names(spark):
    page = "<body><nav>Menu</nav><div class='ad'>Buy</div><article><h1>T</h1>some <b>text</b> &amp; more</article><div class='comments'>c</div></body>"
    bare = "<body><div class='cookie-consent'>ok?</div><p>just text</p></body>"
    got = M.extract(_frame(spark, [("http://a/1", page), ("http://b/1", bare), ("http://c/1", page), ("http://c/2", page)])).collect()
    assert sorted((r["page_id"], r["text"]) for r in got) == [(0, "T\nsome text & more"), (1, "just text"), (2, "T\nsome text & more"), (3, "T\nsome text & more")]


def test_odd_rows(spark):
    page, expected = _page(3)
    rows = [(None, None), ("http://h/1", None), ("http://h/2", ""), ("nonsense", "<<<>>> <p"), (None, page), (None, page), ("http://h/3", page)]
    got = {r["page_id"]: r for r in M.extract(_frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert [got[k]["text"] for k in (0, 1, 2)] == [""] * 3 and got[0]["n_chars"] == 0
    assert got[4]["text"] == got[5]["text"] and expected.splitlines()[0] in got[6]["text"]
    empty = M.extract(_frame(spark, []))
    assert empty.columns == ["page_id", "url", "text", "n_chars"] and empty.collect() == []


def _random_layout(draw, kinds):
    def inner(depth):
        if depth == 4:
            return ""
        chosen = draw.sample(kinds, draw.randint(0, 3))
        return "".join(f"<div class='{k}'>{inner(depth + 1)}</div>" for k in chosen)

    return T.Layout(f"<div class='r'>{inner(0)}</div>", lambda _node: False)


@pytest.mark.parametrize("seed", range(40))
def test_matching_equals_brute_force(seed):
    draw = random.Random(seed)
    a, b = (_random_layout(draw, ["a", "b", "c", "d"]) for _ in range(2))
    first, second = a.paths(), b.paths()

    @lru_cache(None)
    def best(x, y):
        left, right = a.children[x], b.children[y]

        @lru_cache(None)
        def run(i, j):
            if i == len(left) or j == len(right):
                return 0
            here = best(left[i], right[j]) + run(i + 1, j + 1) if a.kinds[left[i]] == b.kinds[right[j]] else 0
            return max(here, run(i + 1, j), run(i, j + 1))

        return 1 + run(0, 0)

    place = {k: n for parent in b.children for n, k in enumerate(parent)}
    wrapper = {second[k]: (second[b.parents[k]], place[k]) for k in range(1, len(second))}
    found = T.matched(a, first, wrapper)
    assert len(found) == best(0, 0)
    assert all(a.parents[k] in found for k in found if k)
    for k in found:
        inner = [place[second.index(first[c])] for c in a.children[k] if c in found]
        assert inner == sorted(inner)


@pytest.mark.parametrize(
    "source",
    [
        "<div>" * 100_000 + "x",
        '<a "' * 250_000,
        "<a x='" * 170_000 + ">",
        "<" * 1_000_000,
        "<p><li><td>" * 30_000 + "</p>" * 30_000,
        "<script>" * 100_000,
        "<!-- " * 200_000,
        "".join(f"<div class='c{k}'>t</div>" for k in range(20_000)),
    ],
)
def test_hostile_pages_take_seconds(source):
    start = time.perf_counter()
    layout = T.Layout(source, M._defined_as_other)
    T.matched(layout, layout.paths(), {})
    assert time.perf_counter() - start < 20


def test_blocks_references_and_tags():
    source = "<body><p class=a>x &amp; <b>y</b>\n <a href=q>z</a><br>k<script>if(a<b){'</p>'}</script><ul><li>1<li>2</ul><p>3 < 4 <!-- no --> end"
    layout = T.Layout(source, M._defined_as_other)
    assert [b.text for b in layout.blocks if not b.hidden] == ["x & y z", "k", "1", "2", "3 < 4 end"]
    assert [layout.kinds[b.group] for b in layout.blocks][2:4] == ["li.", "li."]
