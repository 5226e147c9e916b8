"""Results that must not depend on how rows are dealt, and columns whose names clash."""

import numpy as np
from pyspark.sql import functions as F

from fundscape.llm import linededup, suffix, toxicity

SF = "/root/testdata/sf0.001"


def test_language_model_is_the_same_for_any_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, many = toxicity.language_model(docs.repartition(1)), toxicity.language_model(docs.repartition(40))
    assert np.array_equal(one, many)


def test_line_dedup_with_clashing_columns(spark):
    line = "the quick brown fox jumps over the lazy dog and runs away"
    docs = spark.createDataFrame([(1, line, 7, "x", 3), (2, line + "s", 8, "y", 4), (3, None, 9, "z", 5)], "doc_id long, text string, removed int, id string, n_lines int")
    got = {r["doc_id"]: r for r in linededup.dedup_lines(docs).collect()}
    assert [got[k]["removed"] for k in (1, 2, 3)] == [7, 8, 9] and [got[k]["id"] for k in (1, 2, 3)] == ["x", "y", "z"]
    assert [got[k]["n_removed"] for k in (1, 2, 3)] == [0, 1, 0] and got[2]["text"] == "" and got[3]["text"] is None


def test_lines_without_blanks_are_found(spark):
    rng = np.random.default_rng(5)
    letters = {"latin": "abcdefghijklmnopqrstuvwxyz", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "hex": "0123456789abcdef", "cjk": "".join(map(chr, range(0x4E00, 0x5200)))}
    docs = []
    for alphabet in letters.values():
        for _ in range(25):
            a = "".join(rng.choice(list(alphabet), 80))
            at = int(rng.integers(6, 74))
            docs += [a, a[:at] + "x7" [at % 2] + a[at + 1 :]]
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    assert linededup.dedup_lines(rows).where("n_removed > 0").count() >= 99


def test_repeats_of_hot_anchors_at_every_level(spark, monkeypatch):
    """Copies with single changed bytes: all anchors are hot, so segments are routed again to the last level."""
    monkeypatch.setattr(suffix, "HOT", 2)
    rng = np.random.default_rng(9)
    base = rng.integers(97, 123, 700).astype(np.uint8)
    texts = []
    for _ in range(12):
        own = base.copy()
        own[rng.integers(0, 700, 2)] = 65
        texts.append(own.tobytes().decode())
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix.remove_repeats(rows).select("doc_id", F.col("n_removed")).collect()}
    seen: dict[str, int] = {}
    for t in texts:
        for i in range(len(t) - 199):
            seen[t[i : i + 200]] = seen.get(t[i : i + 200], 0) + 1
    for k, t in enumerate(texts):
        gone = set()
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone.update(range(i, i + 200))
        assert got[k] == len(gone)
