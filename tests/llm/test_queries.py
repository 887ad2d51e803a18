import pytest

pytest.importorskip("regex")
from ledgerloom.llm.queries import QUERIES  # noqa: E402

COLUMNS = {
    "p1_found": [("value_id", "bigint")], "p3_found": [("source_table", "string"), ("row_key", "bigint")], "p7_ids": [("doc_id", "bigint"), ("ids", "array<int>")],
    "p8_found": [("doc_id", "bigint"), ("item_id", "bigint")], "p9_found": [("doc_id", "bigint"), ("text_kind", "string")],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs(spark, smallest, name):
    df = QUERIES[name](spark, smallest)
    if name in COLUMNS:
        assert df.dtypes == COLUMNS[name]
    df.write.format("noop").mode("overwrite").save()
