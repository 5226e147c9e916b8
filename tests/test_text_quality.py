import pytest
from pyspark.sql import functions as F

from fundscape.operators import quality as D, relational as L, text as X


def value(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0]["v"]


@pytest.mark.parametrize(("text", "number"), [("1.360", 1360.0), ("1.360,00", 1360.0), ("1,360.00", 1360.0), ("1,5", 1.5), ("hasta 3,25%", 3.25), ("none", None), ("", None)])
def test_numbers(spark, text, number):
    assert value(spark, X.number(F.lit(text))) == number


@pytest.mark.parametrize(("text", "years"), [("1 año", 1.0), ("3 meses", 0.25), ("6 meses", 0.5), ("periodo recomendado", -1.0), ("10Y+", 10.0), ("x", None)])
def test_years(spark, text, years):
    assert value(spark, X.years(F.lit(text))) == years


def test_grid_gives_schedule_and_composition(spark):
    text = "|||Horizon|||1 año|||\n|||Total costs|||12|||\n|||Impact|||0,12%|||\n|||Management fees|||0,10%|||\n|||Transaction costs|||0,02%|||"
    cells = X.grid(spark.createDataFrame([(1, text), (2, None), (3, "")], "id long, t string"), "id", "t")
    assert [tuple(r) for r in X.schedule(cells, "id").collect()] == [(1, 1.0, 12.0, 0.12)]
    costs = X.composition(cells, "id").select("id", "management_fee_pct", "transaction_cost_pct", "entry_fee_pct").collect()
    assert [tuple(r) for r in costs] == [(1, 0.10, 0.02, None)]


@pytest.mark.parametrize(("pct", "amount", "status"), [(1.0, 100.0, "OK"), (1.0, 103.0, "OK"), (1.0, 130.0, "MILD"), (1.0, 200.0, "VOID"), (None, 100.0, "SINGLE")])
def test_cross_validation(spark, pct, amount, status):
    assert value(spark, D.cross_validate(F.lit(pct).cast("double"), F.lit(amount)))["status"] == status


def test_family_names_lose_all_class_suffixes(spark):
    assert value(spark, D.family_name(F.lit("Óptima Renta A2 EUR Hedged Acc"))) == "optima renta"


def test_merges(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c"), (3, None)], "k long, v string")
    rows = lambda df: sorted((r["k"], r["v"]) for r in df.collect())
    assert rows(L.upsert_replace(old, new, "k")) == [(1, "a"), (2, "c"), (3, None)]
    assert rows(L.insert_ignore(old, new, "k")) == [(1, "a"), (2, "b"), (3, None)]
    assert rows(L.policy_merge(old, new, ["k"], {"v": "fill"})) == [(1, "a"), (2, "c"), (3, None)]


def test_asof_takes_the_last_fact(spark):
    t = spark.createDataFrame([(1,), (5,), (9,)], "at long")
    f = spark.createDataFrame([(2, 1.0), (5, 2.0)], "at long, v double")
    assert sorted((r["at"], r["v"]) for r in L.asof_backward(t, f, "at", "v").collect()) == [(1, None), (5, 2.0), (9, 2.0)]
