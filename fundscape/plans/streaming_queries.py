"""Streams over the given tables, run to their present end."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import tables as T
from ..sources.files import shared_path
from ..streaming import incremental as I
from .registry import query as Q


@Q("inc_nav_upsert", "SELECT l_suppkey AS isin, last_day(l_shipdate) AS date, max_by(l_extendedprice, (l_shipdate, l_extendedprice)) AS nav FROM lineitem GROUP BY ALL")
def inc_nav_upsert(s, d):
    source = shared_path(s, "nav-files")
    rows = T.read(s, d, "lineitem").select(F.col("l_suppkey").alias("isin"), F.col("l_shipdate").alias("at"), F.col("l_extendedprice").alias("nav"))
    rows.repartition(6, *rows.columns).write.parquet(source)
    return I.upsert_stream(s, source, "isin long, at timestamp, nav double")


@Q("inc_log_counts", "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, event_type AS status, count(*) AS n FROM events GROUP BY ALL")
def inc_log_counts(s, d):
    source = shared_path(s, "log-files")
    T.read(s, d, "events").select("ts", F.col("event_type").alias("status")).write.parquet(source)
    return I.log_counts(s, source, "ts timestamp, status string")
