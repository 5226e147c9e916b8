"""Scores, selection under caps, weights, rotation and forward returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.files import stored
from .panel import percent_rank_ties, percentiles_of_values

# Weights of the measures, factors of natures, limits; each by part.
PARTS = ("Defensiva", "Equilibrada", "Dinamica")
WEIGHTS = {
    "Defensiva": {"return_real": 0.20, "sharpe": 0.25, "max_drawdown": 0.30, "alpha_persistence": 0.15, "capture_ratio": 0.05, "momentum_rank": 0.05},
    "Equilibrada": {"return_real": 0.25, "sharpe": 0.20, "max_drawdown": 0.20, "alpha_persistence": 0.15, "capture_ratio": 0.10, "momentum_rank": 0.10},
    "Dinamica": {"return_real": 0.30, "sharpe": 0.15, "max_drawdown": 0.15, "alpha_persistence": 0.15, "capture_ratio": 0.15, "momentum_rank": 0.10},
}
BONUS = {
    "Defensiva": {"Monetario": 1.25, "Renta Fija Corto Plazo": 1.10, "Renta Fija Flexible": 1.00},
    "Equilibrada": {"Mixtos": 1.10, "Renta Variable": 1.00, "Renta Fija Flexible": 0.95},
    "Dinamica": {"Renta Variable": 1.10, "Alternativo": 1.05, "Mixtos": 0.95},
}
DRAWDOWN_LIMIT = {"Defensiva": -0.20, "Equilibrada": -0.30, "Dinamica": -0.40}
RETURN_LIMIT = {"Defensiva": -0.05, "Equilibrada": -0.02, "Dinamica": 0.00}
RISK_LIMIT = 5
MEASURES = ["return_real", "sharpe", "max_drawdown", "alpha_persistence", "capture_ratio", "momentum_rank"]


def by_part(table: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def base_scores(wide: DataFrame, *, drawdown: str = "corrected") -> DataFrame:
    """(isin, part, nature, base): weighted ranks of the measures within each nature, times the nature's factor.

    A drawdown is at most 0; ``corrected`` gives the shallowest the best rank, ``reference`` the deepest.
    """
    ranks = {m: F.coalesce(1 - percent_rank_ties(m, "nature") if m == "max_drawdown" and drawdown == "reference" else percent_rank_ties(m, "nature"), F.lit(0.0)) for m in MEASURES}
    ranked = wide.where("nature is not null").select("isin", "nature", *[r.alias(m) for m, r in ranks.items()])
    each = ranked.withColumn("part", F.explode(F.array(*map(F.lit, PARTS))))
    total = sum((F.col(m) * by_part({p: w[m] for p, w in WEIGHTS.items()}, F.col("part")) for m in MEASURES), F.lit(0.0))
    factor = F.coalesce(by_part({f"{p}/{n}": f for p, t in BONUS.items() for n, f in t.items()}, F.concat_ws("/", "part", "nature")), F.lit(1.0))
    return each.select("isin", "part", "nature", (total * factor).alias("base"))


def exclusion(wide: DataFrame) -> DataFrame:
    """(isin, part, reason): the first limit that a fund misses, or null."""
    each = wide.withColumn("part", F.explode(F.array(*map(F.lit, PARTS))))
    part = F.col("part")
    reason = (
        F.when(F.col("max_drawdown") < by_part(DRAWDOWN_LIMIT, part), "max_drawdown")
        .when(F.col("return_real") < by_part(RETURN_LIMIT, part), "return_real")
        .when((part == "Defensiva") & (F.col("srri_nav") > RISK_LIMIT), "srri")
        .when((part == "Defensiva") & (F.col("credit_quality") == "High Yield"), "credit_quality")
    )
    return each.select("isin", "part", reason.alias("reason"))


def multiplier(wide: DataFrame, regime: str | Column, *, p25: float | Column | None = None, p75: float | Column | None = None, keys: tuple[str, ...] = ("isin",)) -> DataFrame:
    """(keys, multiplier): product of the factors that apply to a fund in the regime, to four digits.

    ``regime``, ``p25`` and ``p75`` (quartiles of the funds' returns in that regime) may be columns of ``wide``.
    """
    c = F.col
    regime = F.lit(regime) if isinstance(regime, str) else regime
    crisis = regime == "Crisis_Financiera"
    # Conditions and factors.
    rules: list[tuple[Column, float]] = [
        (crisis & (c("beta_spread") > 0.02), 0.60),
        (crisis & (c("beta_spread") < -0.01), 1.30),
        (crisis & (c("beta_vix") > 0.02), 0.60),
        (regime.isin("Shock_Energetico", "Estanflacion", "Recalentamiento") & (c("beta_oil") > 0.01), 1.20),
        (regime.isin("Recalentamiento_Tardio", "Shock_Energetico", "Estanflacion") & (c("beta_rate") < -0.10), 0.70),
        (F.abs(c("fx_pct")) > 0.60, 0.80),
        (c("alpha_persistence") > 0.60, 1.15),
        (c("macro_r2") > 0.50, 0.85),
    ]
    if p25 is not None and p75 is not None:
        known, back = c("n_obs") >= 12, c("return_regime")
        rules += [(known & (back >= p75), 1.20), (known & (back <= p25) & (back < p75), 0.80)]
    product = F.lit(1.0)
    for on, factor in rules:
        product = product * F.when(F.coalesce(on, F.lit(False)), factor).otherwise(1.0)
    return wide.select(*keys, F.round(product, 4).alias("multiplier"))


def score(wide: DataFrame, regime: str, *, p25: float | Column | None = None, p75: float | Column | None = None, **options) -> DataFrame:
    """(isin, part, nature, base, multiplier, reason, total): total is 0 for excluded funds."""
    factors = multiplier(wide, regime, p25=p25, p75=p75)
    full = base_scores(wide, **options).join(factors, "isin").join(exclusion(wide), ["isin", "part"])
    return full.withColumn("total", F.when(F.col("reason").isNull(), F.col("base") * F.col("multiplier")).otherwise(0.0))


def preservation(measures: DataFrame) -> DataFrame:
    """(isin, damage, consistent, resilience) of (isin, max_drawdown, worst_month, pct_positive, pct_severe, recovery,
    crisis): weighted percentiles over all funds, the better the higher; an unknown measure counts 0."""
    # Parts and weights, and which measures are better low.
    parts = {"damage": {"max_drawdown": 0.7, "worst_month": 0.3}, "consistent": {"pct_positive": 0.6, "pct_severe": 0.4}, "resilience": {"recovery": 0.6, "crisis": 0.4}}
    low = ("pct_severe", "recovery")
    out = measures
    for measure in (m for weights in parts.values() for m in weights):
        ranks = percentiles_of_values(measures, measure, descending=measure in low)
        out = out.join(ranks.withColumnRenamed("pct", f"_{measure}"), measure, "left")
    return out.select("isin", *[sum((w * F.coalesce(f"_{m}", F.lit(0.0)) for m, w in weights.items()), F.lit(0.0)).alias(p) for p, weights in parts.items()])


def best_per_family(scores: DataFrame, family: str = "family_id") -> DataFrame:
    """The best fund of each (family, part); funds without a family all stay."""
    w = Window.partitionBy(family, "part").orderBy(F.desc("total"), "isin")
    return scores.withColumn("_k", F.row_number().over(w)).where(F.col(family).isNull() | (F.col("_k") == 1)).drop("_k")


def select_capped(scores: DataFrame, *scenario: str, most: int = 10, per_nature: int = 5, per_manager: int = 2) -> DataFrame:
    """(scenario, part, isin, total, rank): by score, at most ``most`` a part and ``per_nature`` of them of a nature; at
    most ``per_manager`` of a manager and one of a family over all parts, which are filled in order.

    The choice is sequential within a scenario only: one ordered fold per scenario over its candidates. Those are cut to
    what can be chosen at all before they are gathered: of a part, funds behind ``most`` others of the same nature,
    manager and family can't matter, so the fold's input is bounded by the numbers of natures, managers and families.
    """
    same = Window.partitionBy(*scenario, "part", "nature", "manager", "family_id").orderBy(F.desc("total"), "isin")
    rows = scores.where("total > 0").withColumn("_k", F.row_number().over(same)).where(F.col("_k") <= most).drop("_k")
    order = by_part({p: k for k, p in enumerate(PARTS)}, F.col("part"))
    item = F.struct(order.alias("o"), (-F.col("total")).alias("s"), "isin", "part", "nature", "manager", "family_id")
    lists = rows.groupBy(*scenario).agg(F.array_sort(F.collect_list(item)).alias("items"))
    none = F.array().cast("array<struct<o:int,s:double,isin:bigint,part:string,nature:string,manager:string,family_id:string>>")

    def step(chosen, x):
        count = lambda test: F.size(F.filter(chosen, test))
        fits = (
            (count(lambda y: y["part"] == x["part"]) < most)
            & (count(lambda y: (y["part"] == x["part"]) & (y["nature"] == x["nature"])) < per_nature)
            & (count(lambda y: y["manager"] == x["manager"]) < per_manager)
            & (count(lambda y: y["family_id"] == x["family_id"]) == 0)
        )
        return F.when(fits, F.array_append(chosen, x)).otherwise(chosen)

    picked = lists.select(*scenario, F.posexplode(F.aggregate("items", none, step)).alias("rank", "x"))
    return picked.select(*scenario, "x.part", "x.isin", (-F.col("x.s")).alias("total"), "rank")


def capped_weights(chosen: DataFrame, *groups: str, cap: float = 0.20, floor: float = 0.03) -> DataFrame:
    """Add ``weight``: the share of total, at most ``cap`` with the rest shared out once, at least ``floor``, made to sum
    to one, to four digits; what rounding leaves goes to the largest."""
    g = Window.partitionBy(*groups)
    w = chosen.withColumn("_w", F.col("total") / F.sum("total").over(g))
    w = w.withColumn("_c", F.col("_w") > cap).withColumn("_any", F.max("_c").over(g))
    free, rest = F.sum(F.when(~F.col("_c"), F.col("total"))).over(g), 1 - cap * F.count_if("_c").over(g)
    w = w.withColumn("_w", F.when(F.col("_c"), cap).when(F.col("_any"), F.col("total") / free * rest).otherwise(F.col("_w")))
    w = w.withColumn("_w", F.greatest("_w", F.lit(floor)))
    w = w.withColumn("_w", F.round(F.col("_w") / F.sum("_w").over(g), 4))
    first = F.row_number().over(g.orderBy(F.desc("_w"), "isin")) == 1
    out = w.withColumn("_d", 1 - F.sum("_w").over(g)).withColumn("weight", F.round(F.when(first, F.col("_w") + F.col("_d")).otherwise(F.col("_w")), 4))
    return out.drop("_w", "_c", "_any", "_d")


def rotation_cost(pairs: DataFrame, costs: DataFrame, *, default: float = 0.005, extra: float = 0.001) -> DataFrame:
    """Add ``cost`` to (nature_out, nature_in) rows: exit and entry cost of the natures (or the default) and the extra."""
    side = lambda c, v: F.broadcast(costs.select(F.col("nature").alias(c), F.col(v).alias("_" + v)))  # noqa: E731  a row per nature
    full = pairs.join(side("nature_out", "exit_cost"), "nature_out", "left").join(side("nature_in", "entry_cost"), "nature_in", "left")
    return full.withColumn("cost", F.coalesce("_exit_cost", F.lit(default)) + F.coalesce("_entry_cost", F.lit(default)) + extra).drop("_exit_cost", "_entry_cost")


def worth_rotating(gain: Column, cost: Column, current: Column, *, margin: float = 0.05) -> Column:
    return gain > cost / F.greatest(current, F.lit(0.01)) + margin


def rotation_plan(held: DataFrame, target: DataFrame, costs: DataFrame) -> DataFrame:
    """(part, out_isin, in_isin, gain, cost): for each fund to leave the best fund to enter that is worth its cost.
    Both sides hold the few chosen funds of a part."""
    gone = held.join(target.select("part", "isin"), ["part", "isin"], "left_anti").select("part", F.col("isin").alias("out_isin"), F.col("total").alias("out_total"), F.col("nature").alias("nature_out"))
    new = target.join(held.select("part", "isin"), ["part", "isin"], "left_anti").select("part", F.col("isin").alias("in_isin"), F.col("total").alias("in_total"), F.col("nature").alias("nature_in"))
    pairs = rotation_cost(gone.join(new, "part"), costs).withColumn("gain", F.col("in_total") - F.col("out_total"))
    good = pairs.where(worth_rotating(F.col("gain"), F.col("cost"), F.col("out_total")))
    best = F.min(F.struct((-F.col("gain")).alias("g"), "in_isin", "gain", "cost")).alias("b")
    return good.groupBy("part", "out_isin").agg(best).select("part", "out_isin", "b.in_isin", "b.gain", "b.cost")


def forward_returns(panel: DataFrame, months: tuple[int, ...] = (1, 3, 12)) -> DataFrame:
    """(isin, date, h, ret): growth from a month to h months later, where both have values."""
    m = panel.withColumn("m", F.year("date") * 12 + F.month("date"))
    each = m.select("isin", "date", "nav", "m", F.explode(F.array(*map(F.lit, months))).alias("h")).withColumn("to", F.col("m") + F.col("h"))
    later = m.select("isin", F.col("m").alias("to"), F.col("nav").alias("later"))
    return each.join(later, ["isin", "to"]).select("isin", "date", "h", (F.col("later") / F.col("nav") - 1).alias("ret"))


def refilled(scores: DataFrame, *, most: int = 10) -> DataFrame:
    """(part, isin, total): of each part, in order, the ``most`` best funds that no earlier part has taken.

    An earlier part can take at most ``most`` of a part's funds, so the fold sees no more than the best ``most`` times the
    number of parts of each, whatever the number of funds.
    """
    w = Window.partitionBy("part").orderBy(F.desc("total"), "isin")
    best = scores.where("total > 0").withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= most * len(PARTS))
    item = F.struct(by_part({p: k for k, p in enumerate(PARTS)}, F.col("part")).alias("o"), F.col("_k").alias("k"), "part", "isin", "total")
    rows = best.groupBy().agg(F.array_sort(F.collect_list(item)).alias("items"))
    none = F.filter("items", lambda x: F.lit(False))

    def take(taken, x):
        free = ~F.exists(taken, lambda y: y["isin"] == x["isin"]) & (F.size(F.filter(taken, lambda y: y["part"] == x["part"])) < most)
        return F.when(free, F.concat(taken, F.array(x))).otherwise(taken)

    return rows.select(F.explode(F.aggregate("items", none, take)).alias("x")).select("x.part", "x.isin", "x.total")


def regime_portfolios(chosen: DataFrame, regimes: dict[str, tuple[float, float, float]]) -> DataFrame:
    """(regime, part, isin, weight): in each regime a part has the regime's share, dealt to its funds (part, isin, total) by score."""
    inside = chosen.withColumn("share", F.col("total") / F.sum("total").over(Window.partitionBy("part")))
    shares = {f"{r}/{p}": w for r, ws in regimes.items() for p, w in zip(PARTS, ws, strict=True) if w}
    every = inside.withColumn("regime", F.explode(F.array(*map(F.lit, regimes))))
    return every.select("regime", "part", "isin", (F.col("share") * by_part(shares, F.concat_ws("/", "regime", "part"))).alias("weight")).where("weight is not null")


def portfolio_returns(weights: DataFrame, forward: DataFrame, regimes: DataFrame) -> DataFrame:
    """(date, regime, h, ret): each month's return of the portfolio of its own regime, (regime, isin, weight), as the weighted
    mean of its available funds. ``regimes`` (date, regime) has a row a month; Spark broadcasts what it finds small."""
    held = weights.groupBy("regime", "isin").agg(F.sum("weight").alias("weight"))
    rows = forward.join(weights.select("isin").distinct(), "isin", "left_semi").join(regimes.select("date", "regime"), "date").join(held, ["regime", "isin"])
    return rows.groupBy("date", "regime", "h").agg((F.sum(F.col("weight") * F.col("ret")) / F.sum("weight")).alias("ret"))


def equal_weight(forward: DataFrame, *, funds: int = 100) -> DataFrame:
    """(date, h, bench): mean of the first ``funds`` available funds by id."""
    w = Window.partitionBy("date", "h").orderBy("isin")
    return forward.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= funds).groupBy("date", "h").agg(F.avg("ret").alias("bench"))


def evaluate(portfolio: DataFrame, bench: DataFrame) -> DataFrame:
    """(regime, h, months, ret, bench, excess, hit) of (date, regime, h, ret) over the months of each regime, and over all of them
    as regime GLOBAL, there a year's: the mean return compounded, the mean excess times the windows in a year."""
    full = stored(portfolio.join(bench, ["date", "h"]), "months")  # a row per month and h, used twice
    hit = F.avg(F.when(F.col("ret") > F.col("bench"), 1.0).otherwise(0.0)).alias("hit")
    means = [F.count("*").alias("months"), F.avg("ret").alias("ret"), F.avg("bench").alias("bench"), F.avg(F.col("ret") - F.col("bench")).alias("excess"), hit]
    year = lambda c: (F.pow(1 + F.col(c), 12 / F.col("h")) - 1).alias(c)
    whole = full.groupBy("h").agg(*means).select(F.lit("GLOBAL").alias("regime"), "h", "months", year("ret"), year("bench"), (F.col("excess") * 12 / F.col("h")).alias("excess"), "hit")
    return full.groupBy("regime", "h").agg(*means).unionByName(whole)
