"""The corpus pipeline's stages against their rules, on a small table with odd rows and clashing columns."""

from __future__ import annotations

import pytest

import corpus_pipeline
from headway.llm import decontaminate, jaccard_join, packing, pii, toxicity
from headway.llm.queries import vocabulary_path
from tests.llm.samples import corpus, prose

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, score double, leaked string, stays long, again int, chosen int"


def _docs(spark, rows):
    return spark.createDataFrame([(*r, 1.0, "x", 2, 3, 4) for r in rows], CLASHING).repartition(3)


def _labels(spark, rows):
    return spark.createDataFrame([(r[0], 1, 1 if r[0] % 5 == 0 else 0) for r in rows if r[0] is not None], "doc_id long, quality int, toxic int")


def _shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_clashing_columns_pass_every_filtering_stage(spark):
    rows = corpus() + [(None, None, "en", "s", 0), (None, "a null id", "en", "s", 9)]
    docs = _docs(spark, rows)
    benchmark = spark.createDataFrame([(1, " ".join(rows[5][1].split()[10:40]))], "item_id long, text string")
    expected = sorted(map(repr, map(tuple, docs.collect())))
    kept = toxicity.keep_ordinary(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert kept.columns == docs.columns and sorted(map(repr, map(tuple, kept.collect()))) == expected
    clean = decontaminate.keep_uncontaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert 5 not in {r["doc_id"] for r in clean.collect()} and clean.count() >= docs.count() - 3
    single = jaccard_join.keep_one(docs)
    assert single.columns == docs.columns
    masked = pii.mask(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    stays = sorted(r["doc_id"] for r in jaccard_join.keep_one(_docs(spark, rows)).collect())
    sets = {r[0]: _shingles(r[1]) for r in rows}
    group = {k: k for k in sets}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    assert stays == sorted(k for k in sets if not sets[k] or root(k) == k)


def test_run_equals_its_stages_one_by_one(spark, tmp_path):
    rows = [(k, prose(k, 30 + k), "en", f"s{k % 3}", 0) for k in range(24)] + corpus()[14:26]
    rows = [(n, *r[1:]) for n, r in enumerate(rows)]
    rows += [(100 + n, prose(n, 20) + " mail me at a.b@c.example or +49 (30) 123456-78", "en", "s", 0) for n in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = _labels(spark, rows)
    benchmark = spark.createDataFrame([(7, " ".join(prose(9, 39).split()[5:25]))], "item_id long, text string")
    for name, frame in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]

    left = docs
    for stage in (
        lambda d: toxicity.keep_ordinary(d, labels),
        jaccard_join.keep_one,
        lambda d: decontaminate.keep_uncontaminated(d, benchmark),
        pii.mask,
    ):
        left = spark.createDataFrame(stage(left).collect(), docs.schema)
    texts = {r["doc_id"]: r["text"] for r in left.collect()}
    assert 9 not in texts and all("@" not in (t or "") for t in texts.values())
    packed = packing.pack_documents(left, vocabulary_path())
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, packed.select(*names).collect()))
    assert {r["doc_id"] for r in got.collect()} == set(texts)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_empty_tables(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(rows)
