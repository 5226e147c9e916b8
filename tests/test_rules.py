"""Families, cost lines, factors and streams on small known cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundscape.operators import macro as M, quality as D, scoring as S, text as X
from fundscape.streaming import incremental as I

FUND = "family_id string, fund_name string, nature string, data_quality string, risk_quality string"


def resolved(spark, *members):
    rows = [("f", name, *rest) for name, *rest in members]
    got = D.family_natures(spark.createDataFrame(rows, FUND)).collect()
    return got[0]["resolved"] if got else "one nature"


def test_families_are_resolved_in_order(spark):
    good, poor = ("OK", "HIGH"), ("MISSING", "NONE")
    assert resolved(spark, ("A", "Mixtos", *good), ("B", "Mixtos", *good)) == "one nature"
    assert resolved(spark, ("A", "Mixtos", *good), ("B", "Mixtos", *good), ("C", "Monetario", *poor)) == "Mixtos"
    assert resolved(spark, ("A Long Short", "Mixtos", *good), ("B", "Mixtos", *good), ("C", "Monetario", *poor)) is None
    assert resolved(spark, ("A", "Mixtos", *good), ("B", "Mixtos", *good), ("C", "Monetario", *good)) is None  # a sound dissenter
    assert resolved(spark, ("A", "Restantes", *good), ("B", "Estructurado", *poor)) == "Estructurado"
    assert resolved(spark, ("A", "Estructurado", "OK", "NONE"), ("B", "Mixtos", "WARN", "NONE")) == "Estructurado"
    assert resolved(spark, ("A", "Estructurado", "OK", "MEDIUM_VISUAL"), ("B", "Mixtos", "OK", "NONE")) == "Estructurado"
    assert resolved(spark, ("A", "Mixtos", "OK", "HIGH"), ("B", "Renta Variable", "OK", "LOW_CONFLICT")) == "Mixtos"  # adjacent, three ranks ahead
    assert resolved(spark, ("A", "Estructurado", "OK", "HIGH"), ("B", "Mixtos", "OK", "HIGH")) is None


def test_families_are_numbered_in_order(spark):
    names = [("m2", "Zeta Fund A"), ("m1", "Alfa Fund B EUR"), ("m1", "Álfa Fund"), ("m1", None)]
    got = {(r["m"], r["n"]): r["family"] for r in D.families(spark.createDataFrame(names, "m string, n string"), F.col("m"), "n").collect()}
    assert got == {("m1", "Alfa Fund B EUR"): "FAM_000001", ("m1", "Álfa Fund"): "FAM_000001", ("m2", "Zeta Fund A"): "FAM_000002", ("m1", None): None}


def test_cost_lines_keep_their_limits(spark):
    grid = "|||Costes de entrada|||hasta el 3,5 % de lo que paga|||350 EUR|||\n|||Transaction costs|||0,007%|||1.250,50 €|||\n|||Performance fee|||40%|||"
    row = X.composition(X.grid(spark.createDataFrame([(1, grid)], "id long, t string"), "id", "t"), "id").first()
    assert (row["entry_fee_pct"], row["entry_fee_max_pct"], row["entry_fee_eur"]) == (3.5, 3.5, 350.0)
    assert (row["transaction_cost_pct"], row["transaction_cost_eur"], row["performance_fee_pct"]) == (0.007, 1250.5, None)


def test_accents_go_however_they_are_written(spark):
    rows = spark.createDataFrame([("ýøšé é",)], "t string").select(X.fold_accents(F.col("t")).alias("t"))
    assert rows.first()["t"] == "yøse e"


def test_run_together_text_has_a_language(spark):
    markers, fused = {"en": ["the", "and"]}, {"es": ["elfondo", "rentabilidad"]}
    rows = spark.createDataFrame([("documentoElFondo\nbuscarentabilidád",), ("el fondo",)], "t string").select(X.language(F.col("t"), markers, fused).alias("l"))
    assert [r["l"] for r in rows.collect()] == ["es", None]


def test_least_squares_agree_with_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 3))
    r = 0.01 + x @ [0.02, -0.01, 0.0] + rng.normal(scale=0.01, size=80)
    nav = 100 * np.exp(np.cumsum(np.concatenate([[0.0], r])))
    panel = spark.createDataFrame([(1, k, float(v)) for k, v in enumerate(nav)], "isin long, date int, nav double")
    frame = spark.createDataFrame([(k + 1, *map(float, row)) for k, row in enumerate(x)], "date int, a double, b double, c double")
    got = {q["factor"]: q["beta"] for q in M.ols(panel, frame, ["a", "b", "c"]).collect()}
    want = np.linalg.lstsq(np.column_stack([np.ones(80), x]), r, rcond=None)[0]
    assert [got[f] for f in "abc"] == pytest.approx(list(want[1:]), abs=1e-8)
    assert M.ols(panel.where("date < 50"), frame, ["a", "b", "c"]).count() == 0  # fewer than 60 months


def test_multiplier_follows_the_regime(spark):
    columns = "isin long, beta_spread double, beta_vix double, beta_oil double, beta_rate double, fx_pct double, alpha_persistence double, macro_r2 double, n_obs long, return_regime double"
    wide = spark.createDataFrame([(1, 0.03, 0.03, 0.02, -0.2, 0.7, 0.7, 0.6, 20, 9.0), (2, -0.02, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 20, -9.0), (3, *[None] * 9)], columns)
    got = lambda regime: [r["multiplier"] for r in S.multiplier(wide, regime, p25=-1.0, p75=1.0).orderBy("isin").collect()]
    common = 0.8 * 1.15 * 0.85 * 1.2
    assert got("Crisis_Financiera") == [round(0.36 * common, 4), round(1.3 * 0.8, 4), 1.0]
    assert got("Estanflacion") == [round(1.2 * 0.7 * common, 4), 0.8, 1.0]
    assert got("Expansion") == [round(common, 4), 0.8, 1.0]


def test_streams_go_on_after_a_restart(spark, tmp_path):
    source, where = str(tmp_path / "in"), {"target": str(tmp_path / "table"), "offsets": str(tmp_path / "offsets")}
    schema = "isin long, at timestamp, nav double"
    rows = lambda *r: spark.createDataFrame(list(r), "isin long, at string, nav double").selectExpr("isin", "CAST(at AS timestamp) AS at", "nav")
    rows((1, "2024-01-05", 1.0), (2, "2024-01-06", 5.0)).write.mode("append").parquet(source)
    assert I.upsert_stream(spark, source, schema, **where).count() == 2
    rows((1, "2024-01-20", 2.0), (1, "2024-02-01", 3.0)).write.mode("append").parquet(source)
    got = {(r["isin"], str(r["date"])): r["nav"] for r in I.upsert_stream(spark, source, schema, **where).collect()}
    assert got == {(1, "2024-01-31"): 2.0, (2, "2024-01-31"): 5.0, (1, "2024-02-29"): 3.0}
