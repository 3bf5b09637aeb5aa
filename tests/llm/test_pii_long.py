"""Long texts: time in proportion to length, and the same candidates as by comparing everything with everything."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from headway.llm import pii


def _plain_candidates(zone, cuts, taken):
    out = []
    for i in range(len(cuts)):
        for j in range(i + 1, min(i + pii.MAX_ATOMS, len(cuts)) + 1):
            start, end = cuts[i][0], cuts[j - 1][1]
            if pii._plausible(zone[start:end]) and not any(start < b and a < end for a, b in taken):
                out.append((i, j))
    return out


@pytest.mark.parametrize("seed", range(20))
def test_candidates_equal_the_plain_ones(seed):
    draw = random.Random(seed)
    parts = ["+49 30 1234567", "4111 1111 1111 1111", "a.b@c.example", "10.0.0.1", "word", "12-34", "(555) 123 4567", "x at y dot com"]
    text = " ".join(draw.choice(parts) for _ in range(30))
    taken = [(a, b) for a, b, _ in pii.base_spans(text)]
    cuts = pii.atoms(text)
    assert pii.candidates(text, cuts, pii.joined(taken)) == _plain_candidates(text, cuts, taken)


def test_time_grows_with_the_length_of_a_list_of_addresses():
    field = pii.Field({}, np.zeros((0, len(pii.KINDS))))

    def seconds(n):
        text = " ".join(f"user{k}@host{k % 9}.example" for k in range(n))
        start = time.perf_counter()
        field.spans(text, pii.base_spans(text))
        return time.perf_counter() - start

    seconds(200)
    short, long = seconds(1000), seconds(8000)
    assert long < 20 * max(short, 0.02)
