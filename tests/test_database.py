import pytest
from pyspark.sql import functions as F

from fundscape.sources import files


@pytest.fixture
def url(spark):
    return files.database(spark)


def table(spark, url):
    return {r["k"]: (r["t"], r["x"]) for r in files.jdbc_source(spark, url, "kept", "k", tasks=4).collect()}


def test_rows_replace_by_key_and_copies_of_a_repeated_task_go(spark, url):
    old = spark.createDataFrame([(i, f"a{i}", i / 2) for i in range(50)], "k long, t string, x double")
    files.jdbc_sink(old, url, "kept", "k", tasks=3)
    new = spark.createDataFrame([(5, "new", None), (60, None, 1.0)], "k long, t string, x double")
    twice = new.unionByName(new)  # what a task leaves that is run a second time after its commit
    for _ in range(2):
        files.jdbc_sink(twice, url, "kept", "k", tasks=3)
        rows = table(spark, url)
        assert len(rows) == 51 and rows[5] == ("new", None) and rows[60] == (None, 1.0) and rows[7] == ("a7", 3.5)
        assert files.jdbc_source(spark, url, "kept", "k").count() == 51
    assert files.jdbc_source(spark, url, "kept", "k", tasks=4).rdd.getNumPartitions() == 4
    left = spark.read.jdbc(url, "(SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T') s").collect()
    assert [r[0] for r in left] == ["KEPT"]


def test_a_failed_run_changes_nothing(spark, url):
    good = spark.createDataFrame([(1, "a", 1.0)], "k long, t string, x double")
    files.jdbc_sink(good, url, "kept", "k")
    bad = spark.createDataFrame([(1, "b", 1.0), (None, "c", 2.0)], "k long, t string, x double")
    with pytest.raises(Exception, match="k is null"):
        files.jdbc_sink(bad, url, "kept", "k")
    assert table(spark, url) == {1: ("a", 1.0)}


def test_empty_table(spark, url):
    none = spark.createDataFrame([], "k long, t string, x double")
    files.jdbc_sink(none, url, "kept", "k")
    assert table(spark, url) == {}
