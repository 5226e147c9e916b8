from fundscape.operators import text as X


def test_all_signals_of_a_large_dictionary_count(spark):
    docs = spark.createDataFrame([(1, "a word10049x b"), (2, "word3 and word10020"), (3, None), (4, ""), (5, "ab\nz"), (None, "word7")], "id long, t string")
    signals = [(k, f"word{k}", f"l{k}") for k in range(10_050)] + [(20_000, "b\nz", "short"), (20_001, None, "none")]
    dictionary = spark.createDataFrame(signals, "ord long, signal string, label string")
    want = {1: "l1", 2: "l1", 3: None, 4: None, 5: "short", None: "l7"}
    for most in (10_000, 1 << 20):
        assert {r["id"]: r["label"] for r in X.match_dictionary(docs, "t", "id", dictionary, most=most).collect()} == want
    late = dictionary.where("ord >= 10049 or ord between 2000 and 9999 or ord = 20000")
    more = late.union(spark.createDataFrame([(30_000 + k, f"other{k}", "o") for k in range(5_000)], dictionary.schema))
    assert {r["id"]: r["label"] for r in X.match_dictionary(docs, "t", "id", more).collect()}[1] == "l10049"


def test_grid_keeps_all_cells(spark):
    line = "|||" + "|||".join(["label", *["x"] * 100_005]) + "|||"
    cells = X.grid(spark.createDataFrame([(1, line)], "id long, t string"), "id", "t").first()["cells"]
    assert len(cells) == 100_005
