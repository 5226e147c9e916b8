"""Portfolios per regime against the rule in plain Python."""

import random

import pytest

from fundscape.operators import scoring as S
from fundscape.plans import scoring_queries as Q
from fundscape.plans.registry import QUERIES
from fundscape.sources import tables as T

REGIMES = {"calm": (0.2, 0.5, 0.3), "bad": (0.7, 0.3, 0.0)}


def plain(scores):
    used, out = set(), []
    for part in S.PARTS:
        funds = sorted((-t, i) for i, p, t in scores if p == part and t is not None and t > 0 and i not in used)[:10]
        used |= {i for _, i in funds}
        out += [(part, i, -t) for t, i in funds]
    return out


def test_a_later_part_takes_the_next_unused_funds(spark):
    rng = random.Random(8)
    scores = [(i, p, float(rng.randint(0, 12))) for i in range(60) for p in S.PARTS] + [(99, "Dinamica", None)]
    chosen = S.refilled(spark.createDataFrame(scores, "isin long, part string, total double")).collect()
    assert [tuple(r) for r in chosen] == plain(scores) and [sum(r["part"] == p for r in chosen) for p in S.PARTS] == [10, 10, 10]


def test_too_few_funds_and_empty_tables(spark):
    scores = [(1, "Defensiva", 2.0), (1, "Equilibrada", 3.0), (2, "Equilibrada", 1.0), (2, "Dinamica", 5.0)]
    frame = spark.createDataFrame(scores, "isin long, part string, total double")
    assert [tuple(r) for r in S.refilled(frame).collect()] == [("Defensiva", 1, 2.0), ("Equilibrada", 2, 1.0)]
    assert S.refilled(frame.limit(0)).collect() == []
    weights = {(r["regime"], r["isin"]): r["weight"] for r in S.regime_portfolios(S.refilled(frame), REGIMES).collect()}
    assert weights == {("calm", 1): 0.2, ("calm", 2): 0.5, ("bad", 1): 0.7, ("bad", 2): 0.3}


def test_months_are_judged_by_their_own_regime(spark):
    weights = spark.createDataFrame([("calm", "a", 1, 0.25), ("calm", "b", 2, 0.75), ("bad", "a", 1, 1.0)], "regime string, part string, isin long, weight double")
    forward = spark.createDataFrame([(1, 1, 1, 0.1), (2, 1, 1, 0.2), (1, 2, 1, -0.1), (2, 2, 1, 0.9), (2, 3, 1, 0.4), (3, 1, 1, 9.0)], "isin long, date int, h int, ret double")
    regimes = spark.createDataFrame([(1, "calm"), (2, "bad"), (3, "calm"), (4, "bad")], "date int, regime string")
    got = S.portfolio_returns(weights, forward, regimes)
    assert {(r["date"], r["regime"]): r["ret"] for r in got.collect()} == {(1, "calm"): pytest.approx(0.175), (2, "bad"): -0.1, (3, "calm"): pytest.approx(0.4)}
    bench = spark.createDataFrame([(1, 1, 0.1), (2, 1, 0.0), (3, 1, 0.1)], "date int, h int, bench double")
    out = {r["regime"]: r for r in S.evaluate(got, bench).collect()}
    assert out["calm"]["months"] == 2 and out["calm"]["hit"] == 1.0 and out["bad"]["excess"] == pytest.approx(-0.1)
    mean = (0.175 - 0.1 + 0.4) / 3
    assert out["GLOBAL"]["ret"] == pytest.approx((1 + mean) ** 12 - 1) and out["GLOBAL"]["excess"] == pytest.approx((mean - 0.2 / 3) * 12)


@pytest.mark.parametrize("name", ["evaluate_by_regime", "report_holdings"])
def test_a_query_groups_lines_and_orders_once(spark, monkeypatch, name):
    """Every measure worked the panel out from all lines again."""
    seen, read = [], T.read
    monkeypatch.setattr(T, "read", lambda s, d, table: (seen.append(table), read(s, d, table))[1])
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert seen.count("lineitem") == seen.count("orders") == 1


def test_only_chosen_funds_are_put_beside_later_months(spark, monkeypatch):
    panel = spark.sql("SELECT isin, last_day(date'2024-01-01') AS date, isin + 1.0D AS nav FROM range(9) t(isin)")
    seen, forward = [], S.forward_returns
    monkeypatch.setattr(Q, "portfolios", lambda s, d: spark.createDataFrame([("calm", "a", 4, 1.0)], "regime string, part string, isin long, weight double"))
    monkeypatch.setattr(Q, "regimes", lambda s, d: spark.sql("SELECT date'2024-01-31' AS date, 'calm' AS regime"))
    monkeypatch.setattr(T, "nav", lambda s, d: panel)
    monkeypatch.setattr(S, "forward_returns", lambda p, *m: (seen.append(p), forward(p, *m))[1])
    Q.monthly(spark, T.Made("unread")).collect()
    assert [r["isin"] for r in seen[0].collect()] == [4]
