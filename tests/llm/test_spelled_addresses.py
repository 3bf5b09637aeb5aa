"""Spelled e-mail addresses in text without digits or at signs."""

from __future__ import annotations

import pytest

from headway.llm import pii
from tests.llm.samples import prose

FORMS = ["jo.smith at mail dot example dot com", "jo.smith[at]mail.example.com", "jo.smith (at) mail.example.com", "jo.smith [at] mail [dot] example [dot] com"]


@pytest.fixture(scope="module")
def field():
    examples = []
    for k in range(120):
        own = (f"jo{k}.{'xyz'[k % 3]}@mail.host{k % 9}.com", f"+1 (523) 555-{1000 + k}", f"10.{k}.7.{k + 3}", f"id {k * 7919}")[k % 4]
        text = f"{prose(k, 12)} {own} {prose(k + 500, 9)}"
        base = pii.base_spans(text)
        examples += [(text[a:b], [(x - a, y - a, kind) for x, y, kind in base if a <= x and y <= b]) for a, b in pii.zones(text)]
    return pii.train(examples)


@pytest.mark.parametrize("form", FORMS)
def test_spelled_addresses_are_found_whole(field, form):
    for before, after in (("please write to ", " before noon today"), ("", ""), ("a long way off there stood a line of text, ask ", ".")):
        text = before + form + after
        assert field.spans(text, pii.base_spans(text)) == [(len(before), len(before) + len(form), "email")], text


def test_long_hosts_lie_in_one_zone():
    text = "see anna at " + " dot ".join(["subdomain"] * 6) + " dot com for more of the same things"
    assert any(a <= 4 and b >= text.index(" for more") for a, b in pii.zones(text))


def test_ordinary_uses_of_at_stay(field):
    for text in ("we met at the station at noon", "look at the dot on the map", "he stood at attention [sic] (see below)", "at [at] (at)"):
        assert field.spans(text, []) == []
