"""A passage that many documents share: what reaches its hashes' buckets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from headway.llm import substring_dedup
from tests.llm.samples import prose


def test_only_the_least_holder_of_a_batch_goes_to_the_hash():
    passage, buckets, n = prose(9, 60), 7, 200
    texts = pa.array([f"before own{k} {passage}" for k in range(n)])
    anchors = {a for _, _, _, found in substring_dedup.windows(texts) for a in found.view(np.int64).tolist()}
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), texts, pa.array([sorted(anchors)] * n)], names=["doc_id", "text", "anchors"])
    out = pa.Table.from_batches(list(substring_dedup._claims(buckets)([batch])))
    open_, settled = (out.filter(pa.array(out.column("settled").to_numpy() == s)) for s in (False, True))
    _, values = substring_dedup._joined(open_)
    assert len(values) == len(np.unique(values))
    docs, _ = substring_dedup._joined(settled)
    assert len(np.unique(docs)) == n - 1 and len(docs) == 11 * (n - 1)
    for bucket, raw in zip(settled.column("bucket").to_pylist(), settled.column("docs").to_pylist()):
        assert set(substring_dedup._by_id(np.frombuffer(raw, np.int64), buckets).tolist()) == {bucket}
