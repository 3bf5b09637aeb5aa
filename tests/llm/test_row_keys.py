"""Filtering stages on rows whose ids are null or repeated."""

from __future__ import annotations

from headway.llm import decontaminate, jaccard_join
from tests.llm.samples import prose

SCHEMA = "doc_id long, text string, place int"


def _places(df):
    return sorted(r.place for r in df.collect())


def test_one_of_each_component_stays_with_null_and_repeated_ids(spark):
    rows = [
        (None, prose(1, 40), 0), (None, prose(1, 40), 1), (None, prose(2, 40), 2), (None, "", 3), (None, None, 4),
        (5, prose(3, 40), 5), (5, prose(4, 40), 6), (5, "", 7), (5, prose(3, 40), 8),
        (7, prose(3, 40), 9), (7, prose(6, 40), 10), (2, prose(6, 40), 11), (9, prose(1, 40), 12), (7, "", 13),
    ]
    found = _places(jaccard_join.keep_one(spark.createDataFrame(rows, SCHEMA)))
    assert [p for p in found if p not in (5, 8)] == [0, 1, 2, 3, 4, 6, 7, 11, 12, 13]
    assert len([p for p in found if p in (5, 8)]) == 1


def test_no_null_ids_with_words_and_none_empty(spark):
    rows = [(None, prose(1, 40), 0), (None, prose(2, 40), 1), (3, prose(3, 40), 2)]
    assert _places(jaccard_join.keep_one(spark.createDataFrame(rows, SCHEMA))) == [0, 1, 2]


def test_a_leak_removes_its_own_row_only(spark):
    benchmark = spark.createDataFrame([(1, prose(90, 30))], "item_id long, text string")
    leak = f"{prose(91, 20)} {prose(90, 30)}"
    rows = [(None, leak, 0), (None, prose(1, 40), 1), (None, None, 2), (4, leak, 3), (4, prose(2, 40), 4), (4, leak, 5), (6, prose(3, 9), 6)]
    found = decontaminate.keep_uncontaminated(spark.createDataFrame(rows, SCHEMA), benchmark)
    assert found.columns == ["doc_id", "text", "place"] and _places(found) == [1, 2, 4, 6]
