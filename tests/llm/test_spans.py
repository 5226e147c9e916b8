import pytest

from fundscape.llm import decontaminate

from .test_operators import corpus, frame, rows


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_spans_are_removed_both_ways(spark, bound):
    docs = [*corpus(), (1000, "Before — SHORT, Item! after é"), (1001, "short item"), (1002, "éé short item short item")]
    bench = spark.createDataFrame([(1, docs[3][1]), (2, "Short item"), (6, docs[8][1][:200])], "item_id long, text string")
    found = decontaminate.decontaminate(frame(spark, docs), bench, broadcast_bytes=bound)
    want = decontaminate.decontaminate(frame(spark, docs), bench)
    assert rows(found, *found.columns) == rows(want, *want.columns)
    clean = decontaminate.remove_spans(frame(spark, docs), found)
    assert decontaminate.decontaminate(clean, bench).where("n_hit > 0").count() == 0
    assert {r["doc_id"]: r["text"] for r in clean.where("doc_id between 1000 and 1002").collect()} == {1000: "Before — ! after é", 1001: "", 1002: "éé "}
