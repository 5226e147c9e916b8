"""Macro series: wide monthly frames, liquidity, regimes and signals; and what funds do with them.

Windows over the macro calendar are not partitioned: it has one row per month, whatever the number of funds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..sources.files import stored


def calendar() -> WindowSpec:
    return Window.partitionBy(F.lit(0)).orderBy("date")


# Regimes with the weights of the defensive, balanced and dynamic parts.
REGIMES = {
    "Crisis_Financiera": (0.70, 0.25, 0.05), "Shock_Energetico": (0.55, 0.35, 0.10), "Estanflacion": (0.50, 0.35, 0.15), "Contraccion": (0.60, 0.35, 0.05),
    "Recalentamiento_Tardio": (0.40, 0.40, 0.20), "Recalentamiento": (0.30, 0.40, 0.30), "Expansion": (0.20, 0.45, 0.35),
}
SERIES = ["ipc_ES", "ipc_EU", "oil", "cli", "rate", "spread", "vix"]
#: Further series of the indicator frame.
MORE = {
    "copper_GLOBAL": "copper", "ipc_index_US": "ipc_US", "ipc_index_JP": "ipc_JP", "ipc_index_CN": "ipc_CN", "cli_US": "cli_us", "cli_JP": "cli_jp", "cli_CN": "cli_cn", "cli_ES": "cli_es", "rate_policy_US": "rate_us", "rate_policy_JP": "rate_jp",
    "rate_policy_CN": "rate_cn", "m3_yoy_EU": "m3_yoy", "m2_yoy_US": "m2_yoy_us", "unemployment_US": "unemployment_us", "dxy_GLOBAL": "dxy", "gold_GLOBAL": "gold", "m2_global_yoy_GLOBAL": "m2_global_yoy", "spread_ig_GLOBAL": "spread_ig", "term_spread_US": "term_spread",
    "fx_usd_eur_GLOBAL": "usd_eur", "fx_jpy_usd_GLOBAL": "jpy_usd", "fx_usd_gbp_GLOBAL": "usd_gbp", "fx_cny_usd_GLOBAL": "cny_usd",
}
_NAMES = {"ipc_index_ES": "ipc_ES", "ipc_index_EU": "ipc_EU", "oil_wti_GLOBAL": "oil", "cli_EU": "cli", "rate_deposit_EU": "rate", "spread_hy_GLOBAL": "spread", "vix_GLOBAL": "vix"}


def wide(macro: DataFrame, names: dict[str, str] = _NAMES) -> DataFrame:
    """One row per month between the first and the last of all series, a column per named one; missing months are null."""
    keyed = macro.withColumn("_key", F.concat_ws("_", "indicator", "geography")).where(F.col("_key").isin(*names))
    rows = keyed.groupBy("date").pivot("_key", list(names)).agg(F.max("value"))
    rows = rows.select("date", *[F.col(k).alias(v) for k, v in names.items()])
    spine = macro.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    months = spine.select(F.explode(F.sequence(F.trunc("a", "MM"), F.trunc("b", "MM"), F.expr("interval 1 month"))).alias("m")).select(F.last_day("m").alias("date"))
    return months.join(rows, "date", "left")


def filled(c: str | Column) -> Column:
    """The last value so far."""
    return F.last(c, ignorenulls=True).over(calendar().rowsBetween(Window.unboundedPreceding, Window.currentRow))


def change(c: Column, n: int) -> Column:
    return c / F.lag(c, n).over(calendar()) - 1


def indicators(macro: DataFrame) -> DataFrame:
    """Monthly series with year-on-year rates and differences, null where a month is missing."""
    w = wide(macro, {**_NAMES, **MORE})
    percent = lambda c: 100 * change(F.col(c), 12)
    return w.select(
        "date", *SERIES, change(F.col("oil"), 12).alias("oil_yoy"), change(F.col("ipc_ES"), 12).alias("ipc_yoy_ES"), change(F.col("ipc_EU"), 12).alias("ipc_yoy_EU"),
        (100 * change(F.col("vix"), 12)).alias("vix_yoy"), (F.col("rate") - F.lag("rate", 3).over(calendar())).alias("d_rate_3m"), (F.col("rate") - F.lag("rate", 1).over(calendar())).alias("d_rate_1m"),
        *[c for c in MORE.values() if c not in ("copper", "ipc_US", "ipc_JP", "ipc_CN", "dxy", "gold", "spread_ig", "term_spread", "usd_eur", "jpy_usd", "usd_gbp", "cny_usd")],
        *[percent(c).alias(n) for c, n in (("copper", "copper_yoy"), ("ipc_US", "ipc_yoy_us"), ("ipc_JP", "ipc_yoy_jp"), ("ipc_CN", "ipc_yoy_cn"), ("dxy", "dxy_yoy"), ("gold", "gold_yoy"))],
    ).withColumn("ipc_yoy_avg", (F.coalesce("ipc_yoy_ES", "ipc_yoy_EU") + F.coalesce("ipc_yoy_EU", "ipc_yoy_ES")) / 2)


def classify(frame: DataFrame, *, oil: float = 0.25, high: float = 0.04, moderate: float = 0.03, cli: float = 100.0, low_rate: float = 1.0, spread: float = 6.0, vix: float = 30.0) -> DataFrame:
    """(date, regime) of each month after forward fill; months before the first inflation and cycle values are left out."""
    f = frame.select("date", *[filled(c).alias(c) for c in ("oil_yoy", "ipc_yoy_avg", "cli", "rate", "d_rate_3m", "spread", "vix_yoy")])
    c = F.col
    regime = (
        F.when((c("spread") > spread) & (c("vix_yoy") > vix), "Crisis_Financiera")
        .when(c("oil_yoy") > oil, "Shock_Energetico")
        .when((c("cli") < cli) & (c("ipc_yoy_avg") > moderate), "Estanflacion")
        .when(c("cli") < cli, "Contraccion")
        .when((c("ipc_yoy_avg") > high) & (c("d_rate_3m") > 0), "Recalentamiento_Tardio")
        .when(c("ipc_yoy_avg") > high, "Recalentamiento")
        .when(c("rate") < low_rate, "Contraccion")
        .otherwise("Expansion")
    )
    return f.where("ipc_yoy_avg is not null and cli is not null").select("date", regime.alias("regime"))


def regime_weights(regimes: DataFrame) -> DataFrame:
    """Add the weights of the three parts."""
    for k, name in enumerate(("w_def", "w_bal", "w_dyn")):
        regimes = regimes.withColumn(name, F.create_map(*[F.lit(x) for r, w in REGIMES.items() for x in (r, w[k])])[F.col("regime")])
    return regimes


def semaphore(frame: DataFrame, regimes: DataFrame) -> DataFrame:
    """(date, colour, signals) of every classified month: red if any red signal, amber if any other, else green."""
    f = frame.join(regimes, "date").select("date", "regime", *[filled(c).alias(c) for c in ("oil", "cli", "ipc_yoy_avg", "rate", "spread", "vix")])
    d = lambda c: F.col(c) - F.lag(c).over(calendar())
    rel = lambda c: F.when(F.lag(c).over(calendar()) > 0, change(F.col(c), 1))
    # Thresholds of the signals, red before amber.
    rules = [
        ("regime", "amber", F.lag("regime").over(calendar()) != F.col("regime")),
        ("oil_spike", "red", rel("oil") > 0.20), ("oil_up", "amber", (rel("oil") > 0.08) & (rel("oil") <= 0.20)),
        ("cli_drop", "red", d("cli") < -2.0), ("cli_near", "amber", (F.abs(F.col("cli") - 100) < 1.0) & ~(d("cli") < -2.0)),
        ("ipc_up", "amber", d("ipc_yoy_avg") > 0.003), ("rate_jump", "red", F.abs(d("rate")) >= 0.50),
        ("spread_red", "red", F.col("spread") > 6.0), ("spread_up", "amber", (F.col("spread") > 4.0) & (F.col("spread") <= 6.0)),
        ("vix_spike", "red", rel("vix") > 0.30), ("vix_up", "amber", (rel("vix") > 0.15) & (rel("vix") <= 0.30)),
    ]
    fired = F.array_compact(F.array(*[F.when(on, F.lit(n)) for n, _, on in rules]))
    any_of = lambda kind: F.greatest(*[F.coalesce(on, F.lit(False)) for _, k, on in rules if k == kind])
    return f.select("date", F.when(any_of("red"), "red").when(any_of("amber"), "amber").otherwise("green").alias("colour"), F.array_join(fired, ",").alias("signals"))


def fx_rates(macro: DataFrame) -> DataFrame:
    """(date, currency, rate): units of each currency per euro, from the legs against the dollar."""
    names = {"fx_usd_eur_GLOBAL": "usd_eur", "fx_jpy_usd_GLOBAL": "jpy_usd", "fx_usd_gbp_GLOBAL": "usd_gbp", "fx_cny_usd_GLOBAL": "cny_usd"}
    w = wide(macro, names)
    c = F.col
    rates = {"USD": c("usd_eur"), "JPY": c("usd_eur") * c("jpy_usd"), "GBP": c("usd_eur") / c("usd_gbp"), "CNY": c("usd_eur") * c("cny_usd")}
    rows = F.array(*[F.struct(F.lit(k).alias("currency"), v.alias("rate")) for k, v in rates.items()])
    return w.select("date", F.explode(rows).alias("x")).select("date", "x.*").where("rate is not null")


def fx_decomposition(panel: DataFrame, master: DataFrame, rates: DataFrame, *, least: int = 24) -> DataFrame:
    """(isin, fx_ann, fx_pct, fx_vol) of unhedged funds in foreign currency."""
    by = Window.partitionBy("isin").orderBy("date")
    r = panel.select("isin", "date", F.log(F.col("nav") / F.lag("nav").over(by)).alias("r"))
    fx = rates.select("currency", "date", F.log(F.col("rate") / F.lag("rate").over(Window.partitionBy("currency").orderBy("date"))).alias("fx"))
    funds = master.where("currency <> 'EUR' and hedging is null").select("isin", "currency")
    g = r.join(funds, "isin").join(F.broadcast(fx), ["currency", "date"]).where("r is not null and fx is not null")  # months times currencies
    year = lambda c: F.pow(1 + F.avg(c), 12) - 1
    g = g.groupBy("isin").agg(F.count("*").alias("n"), year("fx").alias("fx_ann"), year("r").alias("total"), (F.stddev_samp("fx") * F.sqrt(F.lit(12))).alias("fx_vol")).where(F.col("n") >= least)
    pct = F.when(F.abs("total") > 1e-6, F.greatest(F.lit(-5.0), F.least(F.lit(5.0), F.col("fx_ann") / F.col("total")))).otherwise(0.0)
    return g.select("isin", "fx_ann", pct.alias("fx_pct"), "fx_vol")


def regime_stats(panel: DataFrame, regimes: DataFrame, *, least: int = 12, history: int = 36, yearly: float = 0.02) -> DataFrame:
    """(isin, regime, n_obs, return_ann, vol_ann, sharpe) of log returns by regime; return and volatility in percent.
    Funds with fewer than ``history`` values are left out.
    """
    by = Window.partitionBy("isin").orderBy("date")
    values = F.count("nav").over(Window.partitionBy("isin")).alias("values")
    r = panel.select("isin", "date", values, F.log(F.col("nav") / F.lag("nav").over(by)).alias("r"))
    r = r.where("r is not null").where(F.col("values") >= history)
    monthly = (1 + yearly) ** (1 / 12) - 1
    g = r.join(F.broadcast(regimes), "date").groupBy("isin", "regime").agg(F.count("*").alias("n_obs"), F.avg("r").alias("m"), F.stddev_samp("r").alias("s")).where(F.col("n_obs") >= least)  # one row per month
    sharpe = F.when(F.col("s") < 1e-10, 0.0).otherwise((F.col("m") - monthly) / F.col("s") * F.sqrt(F.lit(12)))
    return g.select("isin", "regime", "n_obs", ((F.exp(F.col("m") * 12) - 1) * 100).alias("return_ann"), (F.col("s") * F.sqrt(F.lit(12)) * 100).alias("vol_ann"), sharpe.alias("sharpe"))


def liquidity(macro: DataFrame) -> DataFrame:
    """(date, total, yoy, estimated): the money levels of four areas, each filled forward; core areas are required."""
    names = {f"m2_level_{g}": g for g in ("US", "EU", "CN", "JP")}
    w = wide(macro, names)
    f = w.select("date", *[filled(g).alias(g) for g in names.values()], F.greatest(*[F.col(g).isNull() for g in names.values()]).alias("estimated"))
    f = f.where("US is not null and EU is not null").withColumn("total", sum((F.coalesce(g, F.lit(0.0)) for g in names.values()), F.lit(0.0)))
    return f.select("date", "total", change(F.col("total"), 12).alias("yoy"), "estimated")


def extend_level(macro: DataFrame, growth: dict[str, float], indicator: str = "m2_level") -> DataFrame:
    """(geography, date, value, label) of a level carried on to the calendar's end by a yearly growth after its last
    month; gaps inside keep the last value."""
    level = macro.where(F.col("indicator") == indicator).select("geography", "date", "value")
    months = wide(macro).select("date")
    rate = F.create_map(*[F.lit(x) for pair in growth.items() for x in pair])
    spine = level.select("geography").distinct().crossJoin(F.broadcast(months)).join(level, ["geography", "date"], "left")  # areas times months
    by = Window.partitionBy("geography").orderBy("date")
    m = F.year("date") * 12 + F.month("date")
    last = F.max(F.when(F.col("value").isNotNull(), m)).over(Window.partitionBy("geography"))
    carried = F.last("value", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.greatest(m - last, F.lit(0))
    value = carried * F.pow(1 + F.coalesce(rate[F.col("geography")], F.lit(0.0)) / 12, ahead)
    return spine.select("geography", "date", value.alias("value"), F.when(F.col("value").isNotNull(), "CALC").otherwise("CALC_EST").alias("label")).where("value is not null")


#: The factors of funds' returns, in order.
FACTORS = [
    "d_rate_eu", "m3_yoy", "ipc_yoy_es", "ipc_yoy_eu", "ipc_yoy_us", "ipc_yoy_jp", "ipc_yoy_cn", "d_rate_us", "d_rate_jp", "d_rate_cn", "oil_yoy", "copper_yoy", "cli_yoy_eu", "cli_yoy_us",
    "dxy_yoy", "gold_yoy", "m2_global_yoy", "spread_hy", "spread_ig", "vix_yoy", "term_spread", "eur_jpy_yoy", "eur_gbp_yoy", "eur_cny_yoy",
]


def factor_matrix(macro: DataFrame, *, coverage: float = 0.5) -> DataFrame:
    """(date, factors): yearly rates in percent, monthly differences of rates, and levels. Factors known in fewer than
    ``coverage`` of the months are left out, then months that lack any other."""
    w = wide(macro, {**_NAMES, **MORE})
    c, yoy = F.col, lambda x: 100 * change(x, 12)
    diff = lambda x: F.col(x) - F.lag(x).over(calendar())
    made = {
        "d_rate_eu": diff("rate"), "m3_yoy": c("m3_yoy"), "ipc_yoy_es": yoy(c("ipc_ES")), "ipc_yoy_eu": yoy(c("ipc_EU")), "ipc_yoy_us": yoy(c("ipc_US")), "ipc_yoy_jp": yoy(c("ipc_JP")), "ipc_yoy_cn": yoy(c("ipc_CN")),
        "d_rate_us": diff("rate_us"), "d_rate_jp": diff("rate_jp"), "d_rate_cn": diff("rate_cn"), "oil_yoy": yoy(c("oil")), "copper_yoy": yoy(c("copper")), "cli_yoy_eu": yoy(c("cli")), "cli_yoy_us": yoy(c("cli_us")),
        "dxy_yoy": yoy(c("dxy")), "gold_yoy": yoy(c("gold")), "m2_global_yoy": c("m2_global_yoy"), "spread_hy": c("spread"), "spread_ig": c("spread_ig"), "vix_yoy": yoy(c("vix")), "term_spread": c("term_spread"),
        "eur_jpy_yoy": yoy(c("jpy_usd") * c("usd_eur")), "eur_gbp_yoy": yoy(c("usd_gbp") / c("usd_eur")), "eur_cny_yoy": yoy(c("cny_usd") / c("usd_eur")),
    }
    every = stored(w.select("date", *[made[f].alias(f) for f in FACTORS]), "every-factor")  # one row a month
    known = every.agg(F.count(F.lit(1)).alias("_n"), *[F.count(f).alias(f) for f in FACTORS]).first()  # one row
    dense = [f for f in FACTORS if known[f] >= coverage * max(1, known["_n"])]
    return every.select("date", *dense).dropna()


def betas(panel: DataFrame, factor: DataFrame, *, least: int = 36) -> DataFrame:
    """(isin, n, beta, alpha, r2) of each fund's log return on one factor (date, x)."""
    by = Window.partitionBy("isin").orderBy("date")
    r = panel.select("isin", "date", F.log(F.col("nav") / F.lag("nav").over(by)).alias("r")).where("r is not null")
    g = r.join(F.broadcast(factor.where("x is not null")), "date").groupBy("isin")  # one row per month
    g = g.agg(F.count("*").alias("n"), F.regr_slope("r", "x").alias("beta"), F.regr_intercept("r", "x").alias("alpha"), F.regr_r2("r", "x").alias("r2"))
    return g.where(F.col("n") >= least)


def factor_betas(panel: DataFrame, frame: DataFrame, factors: dict[str, str], *, least: int = 60) -> DataFrame:
    """(isin, a beta per factor under its name, macro_r2): each fund's log return on each factor alone, and the largest
    share of variance that one of them explains; one pass over the panel."""
    by = Window.partitionBy("isin").orderBy("date")
    r = panel.select("isin", "date", F.log(F.col("nav") / F.lag("nav").over(by)).alias("r")).where("r is not null")
    g = r.join(frame.select("date", *factors.values()), "date").groupBy("isin")
    slopes = [F.regr_slope("r", f).alias(name) for name, f in factors.items()]
    g = g.agg(F.count("*").alias("n"), *slopes, F.greatest(*[F.regr_r2("r", f) for f in factors.values()]).alias("macro_r2"))
    return g.where(F.col("n") >= least).drop("n")


def _solved(factors: list[str], least: int, vif: float, keep: tuple[str, ...], table: list[list[float]]):
    """For sets of months (numbers of rows of ``table``): the factors that stay and the inverse of their normal matrix."""
    import numpy as np
    import pandas as pd

    x_all = np.column_stack([np.ones(len(table)), np.array(table, float).reshape(len(table), len(factors))])

    def solve(batches):
        for batch in batches:
            out = []
            for key, months in zip(batch["months_id"], batch["months"], strict=True):
                x, n = x_all[list(months)], len(months)
                if n < least:
                    continue
                g = x.T @ x
                cov = g / n - np.outer(g[0], g[0]) / n**2
                left = list(range(1, len(factors) + 1))
                while len(left) > 1:
                    sd = np.sqrt(np.maximum(np.diag(cov)[left], 1e-300))
                    inflation = np.diag(np.linalg.pinv(cov[np.ix_(left, left)] / np.outer(sd, sd)))
                    free = [i for i, f in enumerate(left) if factors[f - 1] not in keep]
                    worst = max(free, key=lambda i: inflation[i], default=None)
                    if worst is None or inflation[worst] <= vif:
                        break
                    left.pop(worst)
                used = [0, *left]
                out.append((key, used, np.linalg.pinv(g[np.ix_(used, used)]).tolist()))
            yield pd.DataFrame(out, columns=["months_id", "used", "inverse"])

    return solve


def products(panel: DataFrame, frame: DataFrame, factors: list[str]) -> DataFrame:
    """(isin, n, months, months_id, xr, rr): the months (row numbers of ``frame``, ordered by date) in which a fund has a log
    return, and the sums of its returns' products with (1, factors) and with themselves."""
    by = Window.partitionBy("isin").orderBy("date")
    r = panel.select("isin", "date", F.log(F.col("nav") / F.lag("nav").over(by)).alias("r")).where("r is not null")
    g = r.join(frame.select("date", "_month", *factors), "date").groupBy("isin")
    xr = F.array(F.sum("r"), *[F.sum(F.col("r") * F.col(f)) for f in factors])
    g = g.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("_month")).alias("months"), xr.alias("xr"), F.sum(F.col("r") * F.col("r")).alias("rr"))
    return g.select("isin", "n", "months", F.xxhash64("months").alias("months_id"), "xr", "rr")


def numbered(frame: DataFrame, factors: list[str]) -> DataFrame:
    """The months that have all factors, numbered by date: one row a month of the calendar."""
    return frame.select("date", *factors).dropna().withColumn("_month", (F.row_number().over(calendar()) - 1).cast("int"))


def ols(panel: DataFrame, frame: DataFrame, factors: list[str], *, least: int = 60, vif: float = 10.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """(isin, factor, beta, r2, n): multi-factor least squares per fund; factors whose variance inflation exceeds ``vif``
    go first, worst first, but for those in ``keep``.

    Products of factors depend on nothing but the months that a fund has. They, the factors that stay and the inverse are
    computed once for each distinct set of months; a fund only sums one product per factor, and its betas are that vector
    times the inverse of its set.
    """
    frame = stored(numbered(frame, factors), "factors")  # one row a month
    table = [list(r)[1:-1] for r in sorted(frame.select("date", *factors, "_month").collect(), key=lambda r: r["_month"])]
    funds = stored(products(panel, frame, factors).where(F.col("n") >= least), "products")
    sets = funds.groupBy("months_id").agg(F.first("months").alias("months"))
    sets = stored(sets.mapInPandas(_solved(factors, least, vif, keep, table), "months_id long, used array<int>, inverse array<array<double>>"), "inverses")
    fit = funds.select("isin", "n", "months_id", "xr", "rr").join(sets, "months_id").withColumn("v", F.transform("used", lambda i: F.get("xr", i)))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    fit = fit.withColumn("beta", F.transform("inverse", lambda row: dot(row, F.col("v"))))
    total = F.col("rr") - F.get("xr", F.lit(0)) * F.get("xr", F.lit(0)) / F.col("n")
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - (F.col("rr") - dot(F.col("beta"), F.col("v"))) / total))
    names = F.array(F.lit("alpha_ann"), *map(F.lit, factors))
    each = fit.select("isin", "n", F.when(total > 0, share).otherwise(0.0).alias("r2"), F.explode(F.arrays_zip("used", "beta")).alias("x"))
    beta = F.when(F.col("x.used") == 0, F.pow(1 + F.col("x.beta"), 12) - 1).otherwise(F.col("x.beta"))
    return each.select("isin", F.get(names, F.col("x.used")).alias("factor"), beta.alias("beta"), "r2", "n")
