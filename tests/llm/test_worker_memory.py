"""What a Python worker holds while it hashes a large batch, and that smaller slices change no row."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from headway.llm import jaccard_join, kernels, toxicity
from tests.llm.samples import prose

TEXTS = [prose(k, 400) for k in range(60)] * 30


def _batch() -> pa.RecordBatch:
    toxic = pa.array(np.arange(len(TEXTS)) % 7 == 0)
    return pa.RecordBatch.from_arrays([pa.array(TEXTS), toxic], names=["text", "toxic"])


def _peak_mb(run, monkeypatch) -> float:
    monkeypatch.setattr(kernels, "_powers", {})
    batch = _batch()
    assert batch.nbytes > 4 << 20
    tracemalloc.start()
    for _ in run(batch):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 2**20


@pytest.mark.parametrize(
    "run",
    [
        lambda b: jaccard_join.shingle_sets(b.column(0), kernels.Words(lower=True)),
        lambda b: toxicity._count(iter([b])),
    ],
    ids=["near_duplicates", "toxicity"],
)
def test_a_worker_hashes_a_large_batch_in_little_memory(run, monkeypatch):
    assert _peak_mb(run, monkeypatch) < 56


def test_sets_do_not_depend_on_the_slice(monkeypatch):
    column = pa.array([*TEXTS[:70], None, "", "two words"])

    def found():
        return [(row, members.tolist()) for row, members in jaccard_join.shingle_sets(column, kernels.Words(lower=True))]

    whole = found()
    monkeypatch.setattr(jaccard_join, "HASHED_BYTES", 3_000)
    assert found() == whole


def test_counts_are_summed_over_the_same_slices(monkeypatch):
    def rows():
        return [b.to_pydict() for b in toxicity._count(iter([_batch()]))]

    monkeypatch.setattr(toxicity, "SCORED_BYTES", kernels.SLICE_BYTES)
    whole = rows()
    monkeypatch.setattr(toxicity, "SCORED_BYTES", 3_000)
    assert rows() == whole
