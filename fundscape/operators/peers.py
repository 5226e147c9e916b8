"""Measures against peers: funds of the same nature, without the fund itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .panel import returns, risk_measures, share_below, tails


def leave_one_out(value: str, *groups: str) -> Column:
    """Mean of the others' values in the group; null for a group of one."""
    w = Window.partitionBy(*groups)
    n = F.count(value).over(w)
    return F.when((n > 1) & F.col(value).isNotNull(), (F.sum(value).over(w) - F.col(value)) / (n - 1))


def peer_returns(panel: DataFrame, master: DataFrame) -> DataFrame:
    """(isin, nature, date, r, bench): monthly return and the peers' mean return."""
    r = returns(panel, "isin").where("r is not null").join(master.select("isin", "nature"), "isin")
    return r.select("isin", "nature", "date", "r", leave_one_out("r", "nature", "date").alias("bench"))


def capture_ratios(peers: DataFrame, *, least: int = 12, bound: float = 5.0) -> DataFrame:
    """(isin, upside, downside, ratio): own mean return over the peers' in months when these rise or fall."""
    up, down = F.col("bench") > 0, F.col("bench") < 0
    side = lambda c, on: F.avg(F.when(on, F.col(c)))
    g = peers.where("bench is not null").groupBy("isin").agg(
        F.count_if(up).alias("n_up"), F.count_if(down).alias("n_down"), (side("r", up) / side("bench", up)).alias("u"), (side("r", down) / side("bench", down)).alias("d")
    )
    clamp = lambda c: F.greatest(F.lit(-bound), F.least(F.lit(bound), c))
    g = g.where((F.col("n_up") >= least) & (F.col("n_down") >= least) & (F.abs("d") >= 1e-6))
    return g.select("isin", clamp(F.col("u")).alias("upside"), clamp(F.col("d")).alias("downside"), clamp(F.col("u") / F.col("d")).alias("ratio"))


def persistence(panel: DataFrame, master: DataFrame, *, months: int = 36, step: int = 6, windows: int = 4) -> DataFrame:
    """(isin, alpha_persistence, alpha_persistence_n): share of rolling windows in which a fund beats its peers' mean.

    Windows begin every ``step`` months from the fund's first month and hold months + 1 month-ends; a window counts if
    it ends by the fund's last month and has at least months - 3 rows. Peers are measured over the same calendar window,
    so rows are dealt to the windows by month index and grouped once.
    """
    m = panel.join(master.select("isin", "nature"), "isin").withColumn("m", F.year("date") * 12 + F.month("date"))
    span = Window.partitionBy("isin")
    m = m.withColumns({"m0": F.min("m").over(span), "m1": F.max("m").over(span)})
    # Every calendar window that some month can lie in, by its first month.
    begin = F.sequence(F.col("m") - months, F.col("m"))
    each = m.select("isin", "nature", "m", "nav", "m0", "m1", F.explode(begin).alias("w"))
    rets = each.groupBy("isin", "nature", "w", "m0", "m1").agg(F.count("*").alias("n"), F.max_by("nav", "m").alias("last"), F.min_by("nav", "m").alias("first"))
    rets = rets.where(F.col("n") >= months - 3).withColumn("ret", F.pow(F.col("last") / F.col("first"), 12.0 / F.col("n")) - 1)
    rets = rets.withColumn("peers", leave_one_out("ret", "nature", "w"))
    own = rets.where((F.col("w") >= F.col("m0")) & ((F.col("w") - F.col("m0")) % step == 0) & (F.col("w") + months <= F.col("m1")) & F.col("peers").isNotNull())
    g = own.groupBy("isin").agg(F.count("*").alias("alpha_persistence_n"), F.avg(F.when(F.col("ret") > F.col("peers"), 1.0).otherwise(0.0)).alias("alpha_persistence"))
    return g.where(F.col("alpha_persistence_n") >= windows)


def momentum_excess(panel: DataFrame, master: DataFrame, *, peers: int = 5) -> DataFrame:
    """(isin, metric, value): the last 12 and 36 months' total return less the mean yearly return of the category over
    the same tail."""
    back = panel.withColumn("_k", F.row_number().over(Window.partitionBy("isin").orderBy(F.desc("date"))))
    total = back.groupBy("isin").agg(
        *[F.when(F.max("_k") > n, F.max(F.when(F.col("_k") == 1, F.col("nav"))) / F.max(F.when(F.col("_k") == n + 1, F.col("nav"))) - 1).alias(f"t{n}") for n in (12, 36)]
    )
    years = risk_measures(tails(panel, {"12": 12, "36": 36}), "isin", "horizon").join(master.select("isin", "nature"), "isin")
    means = years.where("ret is not null").groupBy("nature", "horizon").agg(F.avg("ret").alias("mean"), F.count("*").alias("n")).where(F.col("n") >= peers)
    own = total.select("isin", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(str(n)).alias("horizon"), F.col(f"t{n}").alias("t")) for m, n in (("momentum_1y", 12), ("momentum_3y", 36))])).alias("x"))
    own = own.select("isin", "x.*").where("t is not null").join(master.select("isin", "nature"), "isin")
    return own.join(means, ["nature", "horizon"]).select("isin", "metric", (F.col("t") - F.col("mean")).alias("value"))


def momentum_rank(measures: DataFrame, master: DataFrame, *, peers: int = 5) -> DataFrame:
    """(isin, momentum_rank): share of the category with a lower return since inception."""
    r = measures.select("isin", "ret").where("ret is not null").join(master.select("isin", "nature"), "isin")
    r = r.withColumn("n", F.count("*").over(Window.partitionBy("nature"))).where(F.col("n") >= peers)
    return r.select("isin", share_below("ret", "nature").alias("momentum_rank"))
