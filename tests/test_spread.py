"""Work that costs far more than reading its rows: in all tasks, and once."""

import re

from fundscape.operators import costs
from fundscape.plans import text_queries as Q

SF = "/root/testdata/sf0.001"


def test_texts_of_short_rows_are_made_in_all_tasks(spark):
    wide = spark.sparkContext.defaultParallelism
    for texts in (Q.names(spark, SF), Q.costs(spark, SF)):
        assert texts.rdd.getNumPartitions() >= wide


def test_no_filter_works_the_sections_out_again(spark):
    docs = spark.createDataFrame([(1, "|||Composition of costs|||\n|||Entry costs|||2%|||"), (2, None), (3, "")], "id long, t string")
    plan = costs.composition(docs, "id", "t")
    nodes = re.split(r"\n\s*\+- ", plan._jdf.queryExecution().optimizedPlan().toString())
    assert not [x for x in nodes if x.startswith("Filter") and "|||" in x]
    assert [(r["id"], r["entry_fee_pct"]) for r in plan.collect()] == [(1, 2.0)]
