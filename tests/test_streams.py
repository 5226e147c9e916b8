"""Keyed upserts: restarts, late and repeated batches, open months, compaction."""

import glob
import os
import random

import pytest

from fundscape.streaming import incremental as I

SCHEMA = "isin long, at timestamp, nav double"


@pytest.fixture
def world(spark, tmp_path):
    source, where = str(tmp_path / "in"), {"target": str(tmp_path / "table"), "offsets": str(tmp_path / "offsets")}
    os.makedirs(source)

    def add(*rows):
        spark.createDataFrame(list(rows), "isin long, at string, nav double").selectExpr("isin", "CAST(at AS timestamp) AS at", "nav").coalesce(1).write.mode("append").parquet(source)

    def run(**more):
        return {(r["isin"], str(r["date"])): r["nav"] for r in I.upsert_stream(spark, source, SCHEMA, **where, **more).collect()}

    return add, run, where["target"]


def parts(spark, target):
    return {f.split("=")[-1]: spark.read.schema(I.CHANGES).parquet(f).count() for f in glob.glob(f"{target}/batch=*") if not f.endswith("=-1")}


def test_only_changed_values_are_written_and_late_ones_count(spark, world):
    add, run, target = world
    add((1, "2024-01-05", 1.0), (1, "2024-05-02", 9.0), (2, "2024-01-06", 5.0), (3, None, 1.0))
    assert run() == {(1, "2024-01-31"): 1.0, (1, "2024-05-31"): 9.0, (2, "2024-01-31"): 5.0}
    add((1, "2024-05-02", 9.0), (2, "2024-01-05", 4.0))  # known already, and older than what is known
    assert run()[2, "2024-01-31"] == 5.0 and parts(spark, target) == {"0": 3, "1": 0}
    add((1, "2024-01-04", 7.0), (1, "2024-01-09", 8.0), (1, "2024-04-30", 3.0))  # January is closed, April open
    assert run() == {(1, "2024-01-31"): 8.0, (1, "2024-04-30"): 3.0, (1, "2024-05-31"): 9.0, (2, "2024-01-31"): 5.0}
    add((1, "2024-01-03", 0.5))  # older than the table's value of a closed month: written, but does not win
    assert run()[1, "2024-01-31"] == 8.0


def test_a_repeated_batch_replaces_its_part(spark, world):
    add, run, target = world
    add((1, "2024-01-05", 1.0))
    first = run()
    again = spark.read.schema(I.CHANGES).parquet(f"{target}/batch=0")
    I._parts(target)(spark.createDataFrame(again.collect(), again.schema), 0)
    assert {(r["isin"], str(r["date"])): r["nav"] for r in I.read_upserted(spark, target).collect()} == first


def test_compaction_bounds_what_is_read(spark, world):
    add, run, target = world
    rng, best = random.Random(4), {}
    for k in range(7):
        rows = [(rng.randint(1, 3), f"2024-{rng.randint(1, 6):02d}-{rng.randint(1, 28):02d}", float(rng.randint(1, 99))) for _ in range(12)]
        add(*rows)
        for i, at, nav in rows:
            best[i, at[:7]] = max(best.get((i, at[:7]), ("", 0)), (at, nav))
        got = run(most_parts=3)
        assert {(i, d[:7]): v for (i, d), v in got.items()} == {key: v for key, (_, v) in best.items()}
        assert len(I._current(spark, target)[0]) <= 4 and len(I._folders(spark, target)) <= 6
    before = got
    os.makedirs(f"{target}/upto=99")  # a compaction that broke off
    assert {(r["isin"], str(r["date"])): r["nav"] for r in I.read_upserted(spark, target).collect()} == before


def test_a_batch_is_compared_with_the_state_without_python(spark):
    """Work on each fund in Python took most of the time of a load with many funds."""
    rows = lambda schema, *r: spark.createDataFrame(list(r), schema)
    t = lambda day: f"timestamp'2024-{day} 00:00:00'"
    kept = rows("isin long", (1,)).selectExpr("isin", "date'2024-05-31' AS date", "9.0D AS nav", f"{t('05-02')} AS at", "current_timestamp() AS seen")
    kept = kept.unionByName(rows("isin long", (2,)).selectExpr("isin", "date'2024-05-31' AS date", "1.0D AS nav", f"{t('05-02')} AS at", f"{t('01-01')} AS seen"))
    new = rows("isin long, at string, nav double", (1, "2024-05-02", 9.0), (1, "2024-02-10", 3.0), (1, "2024-03-10", 4.0), (3, None, 1.0)).selectExpr("isin", "CAST(at AS timestamp) AS at", "nav")
    out = I.open_months(kept, new, 2, 90)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    got = {(r["isin"], str(r["date"])): (r["nav"], r["fresh"], r["opened"]) for r in out.collect()}
    assert got == {(1, "2024-05-31"): (9.0, False, True), (1, "2024-03-31"): (4.0, True, True), (1, "2024-02-29"): (3.0, True, False), (2, "2024-05-31"): (1.0, False, False)}


def test_a_batch_that_runs_twice_reads_the_same_state(spark, tmp_path):
    target, state = str(tmp_path / "table"), str(tmp_path / "state")
    for path, schema in ((f"{target}/batch=-1", I.CHANGES), (f"{state}/after=-1", I.STATE)):
        spark.createDataFrame([], schema).write.parquet(path)
    write = I._upserts(target, state, 2, 90)
    batch = lambda nav: spark.sql(f"SELECT 1L AS isin, timestamp'2024-05-02 00:00:00' AS at, {nav}D AS nav")
    for nav, number in ((1.0, 0), (2.0, 1), (2.0, 1), (2.0, 2)):
        write(batch(nav), number)
    assert parts(spark, target) == {"0": 1, "1": 1, "2": 0} and {f.split("=")[-1] for f in glob.glob(f"{state}/after=*")} == {"1", "2"}
