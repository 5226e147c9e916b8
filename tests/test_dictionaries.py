"""Automaton, trie and as-of against plain Python."""

import random

import pytest

from fundscape.operators import dictionary as D, relational as L


def test_automaton_agrees_with_a_search_for_every_signal(spark):
    rng = random.Random(1)
    word = lambda k: "".join(rng.choice("abé ") for _ in range(k))
    texts = [(i % 40, word(rng.randint(0, 60))) for i in range(150)] + [(1, None), (2, ""), (None, "ab" * 30_000), (3, "Ab\n😀é")]
    signals = [(rng.randint(0, 50), word(rng.randint(1, 7)), f"l{i}") for i in range(900)] + [(3, None, "none"), (0, "😀é", "late"), (None, "é a", "first")]
    rows = spark.createDataFrame(texts, "id long, t string").selectExpr("*", "1 AS ord", "2 AS at", "3 AS signal")
    table = spark.createDataFrame(signals, "ord int, signal string, label string")

    def best(t):
        hits = [((o is not None, o), s, lab) for o, s, lab in signals if s is not None and t is not None and s in t]
        if not hits:
            return None
        (_, o), s, lab = min(hits)
        return (o, s, lab, t.index(s) + 1)

    want = sorted(((i, best(t)) for i, t in texts), key=str)
    for size in (1 << 20, 4000):
        got = D.match_signals(rows, "t", table, part_bytes=size)
        assert got.columns == ["id", "t", "ord", "at", "signal", "match"]
        assert sorted(((r["id"], r["match"] and tuple(r["match"])) for r in got.collect()), key=str) == want


def test_empty_signals_and_tables(spark):
    rows = spark.createDataFrame([(1, "x"), (2, ""), (3, None)], "id long, t string")
    table = spark.createDataFrame([(5, "", "any"), (7, "x", "x")], "ord int, signal string, label string")
    assert {r["id"]: r["match"] and r["match"]["label"] for r in D.match_signals(rows, "t", table).collect()} == {1: "any", 2: "any", 3: None}
    assert {r["id"]: r["match"] for r in D.match_signals(rows, "t", table.limit(0)).collect()} == {1: None, 2: None, 3: None}
    assert D.match_signals(rows.limit(0), "t", table).collect() == []


def test_prefixes_by_table_order_and_ties(spark):
    rng = random.Random(2)
    texts = [(i, "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))) for i in range(300)] + [(300, None), (5, "abc")]
    tables = [[(rng.randint(0, 9), "".join(rng.choice("abc") for _ in range(rng.randint(3, 6))), f"{k}{i}") for i in range(300)] + [(1, None, "x")] for k in (0, 1)]
    frames = [spark.createDataFrame(t, "ord int, prefix string, label string") for t in tables]
    rows = spark.createDataFrame(texts, "id long, t string").selectExpr("*", "1 AS prefix", "2 AS label", "3 AS ord")

    def best(t):
        hits = [(k, o, len(p), lab) for k, table in enumerate(tables) for o, p, lab in table if t is not None and p is not None and t.startswith(p)]
        return min(hits)[3] if hits else None

    found = D.first_prefix(rows, "t", *frames)
    assert sorted(((r["id"], r["match"] and r["match"]["label"]) for r in found.collect()), key=str) == sorted(((i, best(t)) for i, t in texts), key=str)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_second_table_without_variants(spark):
    first = spark.createDataFrame([(0, "msci world", "MSCI_W")], "ord int, prefix string, label string")
    second = spark.createDataFrame([(0, "ms euro growth nr eur", "MS_EG"), (1, "ms asia", "MS_A")], "ord int, prefix string, label string")
    names = [(1, " MSCI   World NR EUR"), (2, "MS Euro Growth GR USD"), (3, "MS Euro Growth"), (4, "ms asia small"), (5, None), (6, "other")]
    got = D.normal_names(spark.createDataFrame(names, "id int, t string"), "t", first, second).collect()
    assert {r["id"]: r["match"] and r["match"]["label"] for r in got} == {1: "MSCI_W", 2: "MS_EG", 3: None, 4: "MS_A", 5: None, 6: None}


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_last_fact_is_carried_over_partitions_without_one(spark, keys):
    rng = random.Random(3)
    times = [(rng.choice(["a", "b", None]), rng.randint(0, 3000)) for _ in range(1500)] + [("a", None), ("c", 5), ("a", 7), ("a", 7)]
    facts = [("a", 2, 1.0), ("a", 2800, 2.0), ("b", 1, None), ("b", 1500, 7.0), (None, 3, 9.0)]  # most of four partitions hold no fact
    t, f = spark.createDataFrame(times, "k string, at int"), spark.createDataFrame(facts, "k string, at int, v double")
    out = L.asof_backward(t, f, "at", "v", *keys)
    order = lambda x: (x is not None, x or 0)

    def last(k, at):
        seen = [(order(a), order(kk if not keys else None), v) for kk, a, v in facts if v is not None and (not keys or kk == k) and order(a) <= order(at)]
        return max(seen)[2] if seen else None

    want = sorted((((k,) if keys else ()) + (at, last(k, at)) for k, at in times), key=str)
    assert sorted(map(tuple, out.collect()), key=str) == want
    assert out.select(*keys, "at").count() == len(times)
