"""Columns with the names that operators use inside, repeated ids and empty tables, for all operators that give documents back."""

import pytest

import corpus_pipeline
from fundscape.llm import decontaminate, linededup, neardup

SF = "/root/testdata/sf0.001"
NAMES = ["_removed_id", "_removed_hash", "_removed_at", "_gone", "_bad", "_spans", "text_hash", "removed", "spans", "component", "kept", "n_hit", "part", "no", "k"]
WORDS = " ".join(f"word{i}" for i in range(40))
ROWS = [(1, f"{WORDS}\nsome other line of text here"), (1, "another text of the same id"), (2, f"{WORDS}\nsome other line of text here"), (2, WORDS), (None, WORDS), (3, None), (4, ""), (5, "plain words only"), (5, "plain words only")]
ITEMS = [(1, WORDS)]


def documents(spark, rows=ROWS):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    return docs.selectExpr("*", *[f"'x' AS {n}" for n in NAMES])


def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("rows", [ROWS, []])
def test_operators(spark, rows):
    docs = documents(spark, rows)
    lines = linededup.dedup_lines(docs)
    assert lines.columns == [*docs.columns, "n_lines", "n_removed"] and lines.count() == len(rows)
    near = neardup.drop_near_duplicates(docs)
    assert near.columns == docs.columns and {r["doc_id"] for r in near.collect()} == ({1, None, 3, 4, 5} if rows else set())
    clean = decontaminate.drop_contaminated(docs, benchmark(spark))
    assert clean.columns == docs.columns
    assert sorted(str(r["text"]) for r in clean.collect()) == sorted(str(t) for _, t in rows if WORDS not in str(t))


@pytest.mark.parametrize("bound", [8 << 20, 0])
def test_spans_of_rows_that_share_an_id(spark, bound):
    docs = documents(spark)
    found = decontaminate.decontaminate(docs, benchmark(spark), broadcast_bytes=bound)
    clean = decontaminate.remove_spans(docs, found)
    assert clean.columns == docs.columns
    want = [(d, None if t is None else t.replace(WORDS, "")) for d, t in ROWS]
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("rows", [ROWS, []])
def test_stages(spark, rows):
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "packing":
            assert sum(r["length"] for r in out.collect()) == sum(r["doc_tokens"] for r in out.where("start = 0").collect())
        else:
            assert out.columns[: len(docs.columns)] == docs.columns or set(docs.columns) <= set(out.columns)
            assert out.count() <= len(rows)
