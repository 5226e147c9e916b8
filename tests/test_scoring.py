import pytest

from fundscape.operators import scoring as S


def candidates(spark, n=60):
    rows = [("s", S.PARTS[k % 3], k, 1.0 / (k + 1), f"n{k % 4}", f"m{k % 9}", f"f{k % 40}") for k in range(n)]
    return spark.createDataFrame(rows, "scenario string, part string, isin long, total double, nature string, manager string, family_id string")


def test_selection_keeps_every_cap(spark):
    df = candidates(spark)
    chosen = S.select_capped(df, "scenario").join(df.drop("total"), ["scenario", "part", "isin"]).toPandas()
    assert chosen.groupby("part").size().max() <= 10 and chosen.groupby(["part", "nature"]).size().max() <= 5
    assert chosen.groupby("manager").size().max() <= 2 and chosen["family_id"].is_unique


def test_selection_equals_a_plain_loop(spark):
    df = candidates(spark).toPandas()
    want, managers, families = set(), {}, set()
    for part in S.PARTS:
        natures, n = {}, 0
        for r in df[df.part == part].sort_values(["total", "isin"], ascending=[False, True]).itertuples():
            if n < 10 and natures.get(r.nature, 0) < 5 and managers.get(r.manager, 0) < 2 and r.family_id not in families:
                want.add((part, r.isin))
                n += 1
                natures[r.nature] = natures.get(r.nature, 0) + 1
                managers[r.manager] = managers.get(r.manager, 0) + 1
                families.add(r.family_id)
    assert {(r["part"], r["isin"]) for r in S.select_capped(candidates(spark), "scenario").collect()} == want


def test_weights_sum_to_one_under_the_cap(spark):
    df = spark.createDataFrame([("p", k, v) for k, v in enumerate([9.0, 1.0, 1.0, 1.0, 0.5, 0.01, 1.0, 2.0])], "part string, isin long, total double")
    got = S.capped_weights(df, "part").toPandas()
    assert got["weight"].sum() == pytest.approx(1.0, abs=1e-9) and got["weight"].min() > 0.02 and got["weight"].max() < 0.25


def test_rotation_needs_a_gain_over_its_cost(spark):
    old = spark.createDataFrame([("p", 1, 0.5, "X")], "part string, isin long, total double, nature string")
    new = spark.createDataFrame([("p", 2, 0.52, "X"), ("p", 3, 0.9, "X")], "part string, isin long, total double, nature string")
    costs = spark.createDataFrame([("Y", 0.0, 0.0)], "nature string, exit_cost double, entry_cost double")
    rows = S.rotation_plan(old, new, costs).collect()
    assert [(r["out_isin"], r["in_isin"]) for r in rows] == [(1, 3)] and rows[0]["cost"] == pytest.approx(0.011)
