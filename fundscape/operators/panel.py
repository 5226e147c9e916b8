"""Measures of panels of series (keys, date, nav): one grouped pass over all series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.files import stored

#: Yearly rate without risk, and the monthly return from which a loss is severe.
RISK_FREE, SEVERE = 0.02, -0.02
MEASURES = ["ret", "vol", "sharpe", "sortino", "ret_vol", "max_drawdown", "dd_duration", "recovery", "pct_positive", "pct_negative", "pct_severe", "worst_month"]


def by_date(*keys: str):
    return Window.partitionBy(*keys).orderBy("date")


def returns(panel: DataFrame, *keys: str, lag: int = 1, log: bool = False, value: str = "nav") -> DataFrame:
    """Add ``r``: the simple or log return over ``lag`` rows."""
    before = F.lag(value, lag).over(by_date(*keys))
    return panel.withColumn("r", F.log(F.col(value) / before) if log else F.col(value) / before - 1)


def drawdowns(panel: DataFrame, *keys: str) -> DataFrame:
    """Add ``peak`` so far and ``dd``, the value against it."""
    peak = F.max("nav").over(by_date(*keys))
    return panel.withColumn("peak", peak).withColumn("dd", F.col("nav") / F.col("peak") - 1)


def longest_run(panel: DataFrame, condition: Column, *keys: str) -> DataFrame:
    """(keys, longest): the most consecutive rows for which ``condition`` holds."""
    island = F.sum(F.when(condition, 0).otherwise(1)).over(by_date(*keys))
    runs = panel.select(*keys, "date", condition.alias("c"), island.alias("island"))
    return runs.groupBy(*keys, "island").agg(F.count_if("c").alias("k")).groupBy(*keys).agg(F.max("k").alias("longest"))


def recovery(panel: DataFrame, *keys: str) -> DataFrame:
    """(keys, recovery): rows from the deepest drawdown to the first value at or above the peak before it."""
    i = drawdowns(panel, *keys).withColumn("i", F.row_number().over(by_date(*keys)))
    trough = F.min(F.struct("dd", "i", "peak")).over(Window.partitionBy(*keys))
    after = i.withColumn("t", trough).where((F.col("i") >= F.col("t.i")) & (F.col("nav") >= F.col("t.peak")))
    return after.groupBy(*keys).agg((F.min("i") - F.min("t.i")).cast("long").alias("recovery"))


def risk_measures(panel: DataFrame, *keys: str) -> DataFrame:
    """All measures of each series. Years count points; volatility needs two returns, downside two losses."""
    keys = keys or ("isin",)
    full = drawdowns(returns(panel, *keys), *keys)
    share = lambda c: F.avg(F.when(c, 1.0).when(F.col("r").isNotNull(), 0.0))
    down = F.when(F.count_if(F.col("r") < 0) >= 2, F.stddev_samp(F.when(F.col("r") < 0, F.col("r"))) * F.sqrt(F.lit(12)))
    growth = F.when(F.count("*") >= 2, F.pow(F.max_by("nav", "date") / F.min_by("nav", "date"), 12.0 / F.count("*")) - 1)
    out = full.groupBy(*keys).agg(
        F.count("*").alias("n"), growth.alias("ret"), F.when(F.count("r") >= 2, F.stddev_samp("r") * F.sqrt(F.lit(12))).alias("vol"), down.alias("down"), F.min("dd").alias("max_drawdown"),
        share(F.col("r") > 0).alias("pct_positive"), share(F.col("r") < 0).alias("pct_negative"), share(F.col("r") <= SEVERE).alias("pct_severe"), F.min("r").alias("worst_month"),
    )
    below = longest_run(full, F.col("nav") < F.col("peak"), *keys).withColumnRenamed("longest", "dd_duration")
    out = out.join(below, list(keys)).join(recovery(panel, *keys), list(keys), "left")
    ratio = lambda a, b: F.when(F.col(b) > 0, a / F.col(b))
    out = out.withColumns({"sharpe": ratio(F.col("ret") - RISK_FREE, "vol"), "sortino": ratio(F.col("ret") - RISK_FREE, "down"), "ret_vol": ratio(F.col("ret"), "vol")})
    return out.select(*keys, "n", *MEASURES)


def to_long(wide: DataFrame, *keys: str, digits: int = 6) -> DataFrame:
    """(keys, metric, value) of a wide table of measures; missing and NaN values give no row."""
    cells = wide.select(*keys, *[F.round(F.col(m).cast("double"), digits).alias(m) for m in MEASURES])
    long = cells.unpivot(list(keys), MEASURES, "metric", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def risk_bucket(vol: Column, n: Column) -> Column:
    """Volatility to 1 to 7; 0 with fewer than 14 values or without volatility."""
    # Lower bounds of buckets 2 to 7.
    bounds = [0.005, 0.02, 0.05, 0.10, 0.15, 0.25]
    bucket = F.lit(1)
    for k, b in enumerate(bounds):
        bucket = F.when(vol >= b, k + 2).otherwise(bucket)
    return F.when((n < 14) | vol.isNull(), 0).otherwise(bucket)


def deflate(panel: DataFrame, prices: DataFrame) -> DataFrame:
    """``panel`` in constant prices: nav over the index of the same date (date, index)."""
    return panel.join(F.broadcast(prices), "date").withColumn("nav", F.col("nav") / F.col("index")).drop("index")  # one row per month


def nominal_and_real(panel: DataFrame, prices: DataFrame) -> DataFrame:
    """Both series stacked, told apart by real_flag."""
    return panel.withColumn("real_flag", F.lit(0)).unionByName(deflate(panel, prices).withColumn("real_flag", F.lit(1)))


def in_windows(panel: DataFrame, windows: DataFrame, *, least: int = 12) -> DataFrame:
    """Rows of ``panel`` under every window (horizon, start, stop) they lie in, if the series has ``least`` rows there."""
    rows = panel.join(F.broadcast(windows), F.col("date").between(F.col("start"), F.col("stop"))).drop("start", "stop")  # a table of a few windows
    return rows.withColumn("_n", F.count("*").over(Window.partitionBy("isin", "horizon"))).where(F.col("_n") >= least).drop("_n")


def tails(panel: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """The last rows of every series, under each horizon whose size it has in full."""
    back = panel.withColumn("_k", F.row_number().over(Window.partitionBy("isin").orderBy(F.desc("date")))).withColumn("_n", F.count("*").over(Window.partitionBy("isin")))
    each = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.lit(n).alias("size")) for h, n in sizes.items()]))
    rows = back.select("*", each.alias("_h")).where((F.col("_k") <= F.col("_h.size")) & (F.col("_n") >= F.col("_h.size")))
    return rows.withColumn("horizon", F.col("_h.horizon")).drop("_k", "_n", "_h")


def horizons(panel: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows under since_inception, each window and each rolling tail."""
    whole = panel.withColumn("horizon", F.lit("since_inception"))
    return whole.unionByName(in_windows(panel, windows)).unionByName(tails(panel, {"rolling_1y": 12, "rolling_3y": 36, "rolling_5y": 60}))


def percent_rank_ties(value: str, *groups: str) -> Column:
    """Rank of a value in its group over the group's size, ties at their mean rank; null values have none."""
    own = F.col(value)
    ranked = Window.partitionBy(*groups, own.isNull()).orderBy(value)
    ties = F.count("*").over(Window.partitionBy(*groups, value))
    size = F.count(value).over(Window.partitionBy(*groups))
    return F.when(own.isNotNull(), (F.rank().over(ranked) + (ties - 1) / 2) / size)


def percentiles_of_values(rows: DataFrame, value: str, *, descending: bool = False) -> DataFrame:
    """(value, pct): the mean rank of each distinct value over the number of rows that have one.

    Distinct values are counted, range-partitioned and cumulated partition by partition; no task holds all of them.
    """
    order = F.desc(value) if descending else F.asc(value)
    counts = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n")).repartitionByRange(order)
    counts = stored(counts.withColumn("_p", F.spark_partition_id()), "value-counts")
    sizes = counts.groupBy("_p").agg(F.sum("_n").alias("_s"))  # one row a partition
    every, so_far = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_p", F.coalesce(F.sum("_s").over(so_far), F.lit(0)).alias("_b"), F.sum("_s").over(every).alias("_t"))
    inside = F.sum("_n").over(Window.partitionBy("_p").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.join(sizes, "_p").withColumn("_r", F.col("_b") + inside - F.col("_n") + 1)
    return ranked.select(value, ((F.col("_r") + (F.col("_n") - 1) / 2) / F.col("_t")).alias("pct"))


def share_below(value: str, *groups: str) -> Column:
    """Share of the group's values strictly below."""
    ranked = Window.partitionBy(*groups, F.col(value).isNull()).orderBy(value)
    return F.when(F.col(value).isNotNull(), (F.rank().over(ranked) - 1) / F.count(value).over(Window.partitionBy(*groups)))
