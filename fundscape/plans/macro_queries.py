"""Queries over macro series, regimes, currencies and factors."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators import macro as M, panel as P
from ..sources import tables as T
from ..sources.files import stored
from .registry import query
from .sqlbase import sql

WIDE = """months AS (SELECT CAST(last_day(unnest(generate_series(date_trunc('month', (SELECT min(date) FROM macro)), date_trunc('month', (SELECT max(date) FROM macro)), INTERVAL 1 MONTH))) AS DATE) AS date),
wd AS (SELECT date, max(value) FILTER (indicator = 'ipc_index' AND geography = 'ES') AS ipc_ES, max(value) FILTER (indicator = 'ipc_index' AND geography = 'EU') AS ipc_EU,
 max(value) FILTER (indicator = 'oil_wti') AS oil, max(value) FILTER (indicator = 'cli' AND geography = 'EU') AS cli, max(value) FILTER (indicator = 'rate_deposit') AS rate, max(value) FILTER (indicator = 'spread_hy') AS spread, max(value) FILTER (indicator = 'vix') AS vix,
 max(value) FILTER (indicator = 'fx_usd_eur') AS usd_eur, max(value) FILTER (indicator = 'fx_jpy_usd') AS jpy_usd, max(value) FILTER (indicator = 'fx_usd_gbp') AS usd_gbp, max(value) FILTER (indicator = 'fx_cny_usd') AS cny_usd,
 max(value) FILTER (indicator = 'm2_level' AND geography = 'US') AS us, max(value) FILTER (indicator = 'm2_level' AND geography = 'EU') AS eu, max(value) FILTER (indicator = 'm2_level' AND geography = 'CN') AS cn, max(value) FILTER (indicator = 'm2_level' AND geography = 'JP') AS jp
 FROM months LEFT JOIN macro USING (date) GROUP BY date),
ind AS (SELECT *, (coalesce(y_es, y_eu) + coalesce(y_eu, y_es)) / 2 AS ipc_yoy_avg FROM (SELECT *, oil / lag(oil, 12) OVER w - 1 AS oil_yoy, ipc_ES / lag(ipc_ES, 12) OVER w - 1 AS y_es, ipc_EU / lag(ipc_EU, 12) OVER w - 1 AS y_eu,
 100 * (vix / lag(vix, 12) OVER w - 1) AS vix_yoy, rate - lag(rate, 3) OVER w AS d_rate_3m, rate - lag(rate) OVER w AS d_rate_1m FROM wd WINDOW w AS (ORDER BY date))),
ff AS (SELECT date, """ + ", ".join(f"last_value({c} IGNORE NULLS) OVER (ORDER BY date) AS {c}" for c in ("oil", "oil_yoy", "ipc_yoy_avg", "cli", "rate", "d_rate_3m", "spread", "vix", "vix_yoy")) + """ FROM ind),
rg AS (SELECT date, CASE WHEN spread > 6 AND vix_yoy > 30 THEN 'Crisis_Financiera' WHEN oil_yoy > 0.25 THEN 'Shock_Energetico' WHEN cli < 100 AND ipc_yoy_avg > 0.03 THEN 'Estanflacion' WHEN cli < 100 THEN 'Contraccion'
 WHEN ipc_yoy_avg > 0.04 AND d_rate_3m > 0 THEN 'Recalentamiento_Tardio' WHEN ipc_yoy_avg > 0.04 THEN 'Recalentamiento' WHEN rate < 1 THEN 'Contraccion' ELSE 'Expansion' END AS regime FROM ff WHERE ipc_yoy_avg IS NOT NULL AND cli IS NOT NULL)"""
WEIGHTS = "CASE regime " + " ".join(f"WHEN '{r}' THEN {{}}" for r in M.REGIMES) + " END"
rnd = lambda df, *c: df.select(*[F.round(x, 6).alias(x) if t == "double" else F.col(x) for x, t in df.select(*c).dtypes])
R6 = lambda *c: ", ".join(f"round({x}, 6) AS {x}" for x in c)


def regimes(s, d):
    return M.classify(M.indicators(T.macro(s, d)))


_ONE = lambda i, g, n: f"max(value) FILTER (indicator = '{i}' AND geography = '{g}') AS {n}"
WIDE_MORE = "wm AS (SELECT date, " + ", ".join(_ONE(*x) for x in (
    ("copper", "GLOBAL", "copper"), ("ipc_index", "US", "ipc_us"), ("ipc_index", "JP", "ipc_jp"), ("ipc_index", "CN", "ipc_cn"), ("cli", "US", "cli_us"), ("cli", "JP", "cli_jp"), ("cli", "CN", "cli_cn"), ("cli", "ES", "cli_es"),
    ("rate_policy", "US", "rate_us"), ("rate_policy", "JP", "rate_jp"), ("rate_policy", "CN", "rate_cn"), ("m3_yoy", "EU", "m3_yoy"), ("m2_yoy", "US", "m2_yoy_us"), ("unemployment", "US", "unemployment_us"), ("dxy", "GLOBAL", "dxy"),
    ("gold", "GLOBAL", "gold"), ("m2_global_yoy", "GLOBAL", "m2_global_yoy"), ("spread_ig", "GLOBAL", "spread_ig"), ("term_spread", "US", "term_spread"),
)) + " FROM months LEFT JOIN macro USING (date) GROUP BY date)"
FRAME_COLUMNS = [
    "oil_yoy", "copper_yoy", "ipc_yoy_avg", "ipc_yoy_es", "ipc_yoy_eu", "ipc_yoy_us", "ipc_yoy_jp", "ipc_yoy_cn", "cli", "cli_us", "cli_jp", "cli_cn", "cli_es", "rate", "d_rate_3m", "rate_us", "rate_jp", "rate_cn",
    "m3_yoy", "m2_yoy_us", "unemployment_us", "dxy_yoy", "gold_yoy", "m2_global_yoy", "spread", "vix_yoy",
]
_Y = lambda c: f"100 * ({c} / lag({c}, 12) OVER w - 1)"


@query("macro_indicator_frame", sql(f""", {WIDE}, {WIDE_MORE}, wy AS (SELECT date, {_Y('copper')} AS copper_yoy, {_Y('ipc_us')} AS ipc_yoy_us, {_Y('ipc_jp')} AS ipc_yoy_jp, {_Y('ipc_cn')} AS ipc_yoy_cn, {_Y('dxy')} AS dxy_yoy, {_Y('gold')} AS gold_yoy FROM wm WINDOW w AS (ORDER BY date))
SELECT date, {R6(*FRAME_COLUMNS)} FROM (SELECT ind.*, y_es AS ipc_yoy_es, y_eu AS ipc_yoy_eu, wm.* EXCLUDE (date), wy.* EXCLUDE (date) FROM ind JOIN wm USING (date) JOIN wy USING (date))""", "macro"))
def macro_indicator_frame(s, d):
    frame = M.indicators(T.macro(s, d)).withColumnsRenamed({"ipc_yoy_ES": "ipc_yoy_es", "ipc_yoy_EU": "ipc_yoy_eu"})
    return rnd(frame, "date", *FRAME_COLUMNS)


query("regime_classify", sql(f", {WIDE} SELECT date, regime FROM rg", "macro"))(regimes)
query("regime_current", sql(f", {WIDE} SELECT max(date) AS date, max_by(regime, date) AS regime FROM rg", "macro"))(lambda s, d: regimes(s, d).agg(F.max("date").alias("date"), F.max_by("regime", "date").alias("regime")))
query("regime_weights", sql(f", {WIDE} SELECT date, regime, " + ", ".join(f"{WEIGHTS.format(*[w[k] for w in M.REGIMES.values()])}::DOUBLE AS {n}" for k, n in enumerate(("w_def", "w_bal", "w_dyn"))) + " FROM rg", "macro"))(lambda s, d: M.regime_weights(regimes(s, d)))
query("win_state_change", sql(f", {WIDE} SELECT date, regime, regime <> lag(regime) OVER (ORDER BY date) AS changed FROM rg", "macro"))(lambda s, d: regimes(s, d).select("date", "regime", (F.col("regime") != F.lag("regime").over(M.calendar())).alias("changed")))
query("agg_regime_distribution", sql(f", {WIDE} SELECT regime, count(*) AS months, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM rg GROUP BY regime", "macro"))(
    lambda s, d: regimes(s, d).groupBy("regime").agg(F.count("*").alias("months")).withColumn("pct", F.round(100 * F.col("months") / F.sum("months").over(Window.partitionBy(F.lit(0))), 6))
)


@query("regime_semaphore", sql(f""", {WIDE}, j AS (SELECT ff.*, regime FROM ff JOIN rg USING (date)), s AS (SELECT *, lag(regime) OVER w AS pr, CASE WHEN lag(oil) OVER w > 0 THEN oil / lag(oil) OVER w - 1 END AS mo, cli - lag(cli) OVER w AS dc, ipc_yoy_avg - lag(ipc_yoy_avg) OVER w AS di, rate - lag(rate) OVER w AS dr,
 CASE WHEN lag(vix) OVER w > 0 THEN vix / lag(vix) OVER w - 1 END AS mv FROM j WINDOW w AS (ORDER BY date)),
t AS (SELECT date, [CASE WHEN pr <> regime THEN 'regime' END, CASE WHEN mo > 0.2 THEN 'oil_spike' END, CASE WHEN mo > 0.08 AND mo <= 0.2 THEN 'oil_up' END, CASE WHEN dc < -2 THEN 'cli_drop' END, CASE WHEN abs(cli - 100) < 1 AND NOT (dc < -2) THEN 'cli_near' END,
 CASE WHEN di > 0.003 THEN 'ipc_up' END, CASE WHEN abs(dr) >= 0.5 THEN 'rate_jump' END, CASE WHEN spread > 6 THEN 'spread_red' END, CASE WHEN spread > 4 AND spread <= 6 THEN 'spread_up' END, CASE WHEN mv > 0.3 THEN 'vix_spike' END, CASE WHEN mv > 0.15 AND mv <= 0.3 THEN 'vix_up' END] AS a FROM s)
SELECT date, CASE WHEN list_has_any(a, ['oil_spike', 'cli_drop', 'rate_jump', 'spread_red', 'vix_spike']) THEN 'red' WHEN len(list_filter(a, lambda x: x IS NOT NULL)) > 0 THEN 'amber' ELSE 'green' END AS colour, coalesce(array_to_string(list_filter(a, lambda x: x IS NOT NULL), ','), '') AS signals FROM t""", "macro"))
def regime_semaphore(s, d):
    frame = M.indicators(T.macro(s, d))
    return M.semaphore(frame, M.classify(frame))


FX = "fx AS (SELECT date, unnest(['USD', 'JPY', 'GBP', 'CNY']) AS currency, unnest([usd_eur, usd_eur * jpy_usd, usd_eur / usd_gbp, usd_eur * cny_usd]) AS rate FROM wd)"


@query("fx_cross_rates", sql(f", {WIDE}, {FX} SELECT date, currency, round(rate, 6) AS rate FROM fx WHERE rate IS NOT NULL", "macro"))
def fx_cross_rates(s, d):
    return rnd(M.fx_rates(T.macro(s, d)), "date", "currency", "rate")


@query("fx_decomposition", sql(f""", {WIDE}, {FX}, f AS (SELECT currency, date, ln(rate / lag(rate) OVER (PARTITION BY currency ORDER BY date)) AS fx FROM fx WHERE rate IS NOT NULL), r AS (SELECT isin, date, ln(nav / lag(nav) OVER (PARTITION BY isin ORDER BY date)) AS r FROM nav),
g AS (SELECT isin, count(*) AS n, pow(1 + avg(fx), 12) - 1 AS fx_ann, pow(1 + avg(r), 12) - 1 AS t, stddev_samp(fx) * sqrt(12) AS fx_vol FROM r JOIN master USING (isin) JOIN f USING (currency, date) WHERE hedging IS NULL AND currency <> 'EUR' AND r IS NOT NULL AND fx IS NOT NULL GROUP BY isin HAVING count(*) >= 24)
SELECT isin, round(fx_ann, 6) AS fx_ann, round(CASE WHEN abs(t) > 1e-6 THEN greatest(-5, least(5, fx_ann / t)) ELSE 0 END, 5) AS fx_pct, round(fx_vol, 6) AS fx_vol FROM g""", "nav", "macro", "master"))
def fx_decomposition(s, d):
    out = M.fx_decomposition(T.nav(s, d), T.master(s, d), M.fx_rates(T.macro(s, d)))
    return out.select("isin", F.round("fx_ann", 6).alias("fx_ann"), F.round("fx_pct", 5).alias("fx_pct"), F.round("fx_vol", 6).alias("fx_vol"))


@query("regime_conditional_stats", sql(f""", {WIDE}, g AS (SELECT isin, regime, count(*) AS n_obs, avg(r) AS m, stddev_samp(r) AS s FROM (SELECT isin, date, count(*) OVER (PARTITION BY isin) AS k, ln(nav / lag(nav) OVER (PARTITION BY isin ORDER BY date)) AS r FROM nav) JOIN rg USING (date) WHERE r IS NOT NULL AND k >= 36 GROUP BY isin, regime HAVING count(*) >= 12)
SELECT isin, regime, n_obs, round((exp(m * 12) - 1) * 100, 5) AS return_ann, round(s * sqrt(12) * 100, 5) AS vol_ann, round(CASE WHEN s < 1e-10 THEN 0 ELSE (m - (pow(1.02, 1 / 12.0) - 1)) / s * sqrt(12) END, 5) AS sharpe FROM g""", "nav", "macro"))
def regime_conditional_stats(s, d):
    out = M.regime_stats(T.nav(s, d), regimes(s, d))
    return out.select("isin", "regime", "n_obs", *[F.round(c, 5).alias(c) for c in ("return_ann", "vol_ann", "sharpe")])


LIQ = ", lf AS (SELECT date, " + ", ".join(f"last_value({c} IGNORE NULLS) OVER (ORDER BY date) AS {c}" for c in ("us", "eu", "cn", "jp")) + ", (us IS NULL OR eu IS NULL OR cn IS NULL OR jp IS NULL) AS estimated FROM wd), lt AS (SELECT date, us + eu + coalesce(cn, 0) + coalesce(jp, 0) AS total, estimated FROM lf WHERE us IS NOT NULL AND eu IS NOT NULL)"


@query("global_liquidity", sql(f", {WIDE}{LIQ} SELECT date, round(total, 5) AS total, round(total / lag(total, 12) OVER (ORDER BY date) - 1, 6) AS yoy, estimated FROM lt", "macro"))
def global_liquidity(s, d):
    out = M.liquidity(T.macro(s, d))
    return out.select("date", F.round("total", 5).alias("total"), F.round("yoy", 6).alias("yoy"), "estimated")


GROWTH = {"US": 0.05, "EU": 0.04, "CN": 0.08, "JP": 0.02}


@query("level_extend_growth", sql(f""", {WIDE}, sp AS (SELECT geography, m.date, value, year(m.date) * 12 + month(m.date) AS mi FROM (SELECT DISTINCT geography FROM macro WHERE indicator = 'm2_level') CROSS JOIN months m LEFT JOIN (SELECT geography, date, value FROM macro WHERE indicator = 'm2_level') v USING (geography, date)),
e AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY geography ORDER BY date) AS c, greatest(mi - max(CASE WHEN value IS NOT NULL THEN mi END) OVER (PARTITION BY geography), 0) AS ahead FROM sp)
SELECT geography, date, round(1e-9 + c * pow(1 + CASE geography WHEN 'US' THEN 0.05::DOUBLE WHEN 'EU' THEN 0.04 WHEN 'CN' THEN 0.08 WHEN 'JP' THEN 0.02 END / 12, ahead), 4) AS value, CASE WHEN value IS NOT NULL THEN 'CALC' ELSE 'CALC_EST' END AS label FROM e WHERE c IS NOT NULL""", "macro"))
def level_extend_growth(s, d):
    return M.extend_level(T.macro(s, d), GROWTH).select("geography", "date", F.round(F.col("value") + 1e-9, 4).alias("value"), "label")


@query("yoy_per_geo", sql(", s AS (SELECT geography, date, value, year(date) * 12 + month(date) AS m FROM macro WHERE indicator = 'm2_level') SELECT a.geography, a.date, round(a.value / b.value - 1, 6) AS yoy FROM s a JOIN s b ON a.geography = b.geography AND a.m = b.m + 12", "macro"))
def yoy_per_geo(s, d):
    level = T.macro(s, d).where("indicator = 'm2_level'").select("geography", "date", "value", T.month_index("date").alias("m"))
    before = level.select("geography", (F.col("m") + 12).alias("m"), F.col("value").alias("before"))
    return level.join(before, ["geography", "m"]).select("geography", "date", F.round(F.col("value") / F.col("before") - 1, 6).alias("yoy"))


@query("level_from_yoy", sql(", s AS (SELECT geography, date, value / lag(value) OVER (PARTITION BY geography ORDER BY date) AS g, value FROM macro WHERE indicator = 'm2_level'), l AS (SELECT geography, date, 100 * exp(sum(ln(coalesce(g, 1))) OVER (PARTITION BY geography ORDER BY date)) AS level FROM s) SELECT geography, date, round(level / first_value(level) OVER (PARTITION BY geography ORDER BY abs(year(date) * 12 + month(date) - 23976), date) * 100, 5) AS level FROM l", "macro"))
def level_from_yoy(s, d):
    by = Window.partitionBy("geography").orderBy("date")
    level = T.macro(s, d).where("indicator = 'm2_level'").withColumn("g", F.log(F.coalesce(F.col("value") / F.lag("value").over(by), F.lit(1.0))))
    grown = level.select("geography", "date", (100 * F.exp(F.sum("g").over(by))).alias("level"))
    base = F.first("level").over(Window.partitionBy("geography").orderBy(F.abs(T.month_index("date") - 23976), "date"))  # the month nearest the base, January 1998
    return grown.select("geography", "date", F.round(F.col("level") / base * 100, 5).alias("level"))


@query("target_hurdle", sql(f", {WIDE}{LIQ}, y AS (SELECT date, total / lag(total, 12) OVER (ORDER BY date) - 1 AS m FROM lt) SELECT date, round(ipc_yoy_avg + m, 6) AS hurdle, round(pow(1 + ipc_yoy_avg + m, 1 / 12.0) - 1, 6) AS monthly FROM ind JOIN y USING (date) WHERE ipc_yoy_avg + m IS NOT NULL", "macro"))
def target_hurdle(s, d):
    macro = T.macro(s, d)
    both = M.indicators(macro).select("date", "ipc_yoy_avg").join(M.liquidity(macro).select("date", "yoy"), "date").withColumn("h", F.col("ipc_yoy_avg") + F.col("yoy")).where("h is not null")
    return both.select("date", F.round("h", 6).alias("hurdle"), F.round(F.pow(1 + F.col("h"), 1 / 12) - 1, 6).alias("monthly"))


@query("indicator_trend_panel", sql(", k AS (SELECT indicator, geography, date, value, CASE WHEN count(*) OVER a = 3 THEN avg(value) OVER a END AS ma3, CASE WHEN count(*) OVER b = 6 THEN avg(value) OVER b END AS ma6, row_number() OVER (PARTITION BY indicator, geography ORDER BY date DESC) AS n FROM macro WINDOW a AS (PARTITION BY indicator, geography ORDER BY date ROWS 2 PRECEDING), b AS (PARTITION BY indicator, geography ORDER BY date ROWS 5 PRECEDING)) SELECT indicator, geography, date, round(ma3 + 1e-9, 4) AS ma3, round(ma6 + 1e-9, 4) AS ma6, CASE WHEN ma6 IS NOT NULL THEN CASE WHEN ma3 > ma6 THEN 'up' ELSE 'down' END END AS trend FROM k WHERE n <= 36", "macro"))
def indicator_trend_panel(s, d):
    by = Window.partitionBy("indicator", "geography").orderBy("date")
    mean = lambda n: F.when(F.count("*").over(by.rowsBetween(1 - n, 0)) == n, F.avg("value").over(by.rowsBetween(1 - n, 0)))
    back = F.row_number().over(Window.partitionBy("indicator", "geography").orderBy(F.desc("date")))
    k = T.macro(s, d).withColumns({"ma3": mean(3), "ma6": mean(6), "n": back}).where("n <= 36")
    trend = F.when(F.col("ma6").isNotNull(), F.when(F.col("ma3") > F.col("ma6"), "up").otherwise("down"))
    return k.select("indicator", "geography", "date", F.round(F.col("ma3") + 1e-9, 4).alias("ma3"), F.round(F.col("ma6") + 1e-9, 4).alias("ma6"), trend.alias("trend"))


FACTOR = "fac AS (SELECT date, ln(oil / lag(oil) OVER (ORDER BY date)) AS x FROM wd)"


def factor(s, d):
    w = M.wide(T.macro(s, d))
    return w.select("date", F.log(F.col("oil") / F.lag("oil").over(M.calendar())).alias("x"))


@query("ols_beta_single", sql(f""", {WIDE}, {FACTOR}, g AS (SELECT isin, count(*) AS n, regr_slope(r, x) AS beta, regr_intercept(r, x) AS alpha, regr_r2(r, x) AS r2 FROM (SELECT isin, date, ln(nav / lag(nav) OVER (PARTITION BY isin ORDER BY date)) AS r FROM nav) JOIN fac USING (date) WHERE r IS NOT NULL AND x IS NOT NULL GROUP BY isin)
SELECT isin, n, {R6('beta', 'alpha', 'r2')} FROM g WHERE n >= 36""", "nav", "macro"))
def ols_beta_single(s, d):
    return rnd(M.betas(T.nav(s, d), factor(s, d)), "isin", "n", "beta", "alpha", "r2")


FACTORS = ["f_oil", "f_vix", "f_cli", "f_rate", "f_spread", "f_ipc"]


def factor_frame(s, d, coverage=0.5):
    """Monthly factors: growth of levels, differences of rates; those with less than ``coverage`` of the months go."""
    w = M.wide(T.macro(s, d))
    diff = lambda c: F.col(c) - F.lag(c).over(M.calendar())
    log = lambda c: F.log(F.col(c) / F.lag(c).over(M.calendar()))
    return w.select("date", log("oil").alias("f_oil"), log("vix").alias("f_vix"), diff("cli").alias("f_cli"), diff("rate").alias("f_rate"), diff("spread").alias("f_spread"), log("ipc_ES").alias("f_ipc"))


FRAME = "fr AS (SELECT date, ln(oil / lag(oil) OVER w) AS f_oil, ln(vix / lag(vix) OVER w) AS f_vix, cli - lag(cli) OVER w AS f_cli, rate - lag(rate) OVER w AS f_rate, spread - lag(spread) OVER w AS f_spread, ln(ipc_ES / lag(ipc_ES) OVER w) AS f_ipc FROM wd WINDOW w AS (ORDER BY date))"


MATRIX = f"""{WIDE_MORE}, fm AS (SELECT date, rate - lag(rate) OVER w AS d_rate_eu, m3_yoy, {_Y('ipc_ES')} AS ipc_yoy_es, {_Y('ipc_EU')} AS ipc_yoy_eu, {_Y('ipc_us')} AS ipc_yoy_us, {_Y('ipc_jp')} AS ipc_yoy_jp, {_Y('ipc_cn')} AS ipc_yoy_cn,
 rate_us - lag(rate_us) OVER w AS d_rate_us, rate_jp - lag(rate_jp) OVER w AS d_rate_jp, rate_cn - lag(rate_cn) OVER w AS d_rate_cn, {_Y('oil')} AS oil_yoy, {_Y('copper')} AS copper_yoy, {_Y('cli')} AS cli_yoy_eu, {_Y('cli_us')} AS cli_yoy_us, {_Y('dxy')} AS dxy_yoy, {_Y('gold')} AS gold_yoy,
 m2_global_yoy, spread AS spread_hy, spread_ig, {_Y('vix')} AS vix_yoy, term_spread, {_Y('ej')} AS eur_jpy_yoy, {_Y('eg')} AS eur_gbp_yoy, {_Y('ec')} AS eur_cny_yoy
 FROM (SELECT wd.*, wm.* EXCLUDE (date), jpy_usd * usd_eur AS ej, usd_gbp / usd_eur AS eg, cny_usd / usd_eur AS ec FROM wd JOIN wm USING (date)) WINDOW w AS (ORDER BY date))"""


@query("macro_factor_matrix", sql(f", {WIDE}, {MATRIX} SELECT date, {R6(*M.FACTORS)} FROM fm WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in M.FACTORS), "macro"))
def macro_factor_matrix(s, d):
    return rnd(M.factor_matrix(T.macro(s, d)), "date", *M.FACTORS)


def matrix(s, d):
    frame = stored(M.factor_matrix(T.macro(s, d)), "factors")  # one row a month
    return frame, frame.columns[1:]


_XR = ", ".join(f"CASE WHEN round(sum(r * {f}), 4) = 0 THEN 0 ELSE round(sum(r * {f}), 4) END AS xr_{f}" for f in M.FACTORS)  # no negative zeros
_XX = ", ".join(f"round(sum({f} * {f}), 4) AS xx_{f}" for f in M.FACTORS)


@query("ols_gram_sums", sql(f"""{", " + WIDE}, {MATRIX}, r AS (SELECT isin, date, ln(nav / lag(nav) OVER (PARTITION BY isin ORDER BY date)) AS r FROM nav)
 SELECT isin, count(*) AS n, round(sum(r), 4) AS sum_r, round(sum(r * r), 4) AS rr, {_XR}, {_XX} FROM r JOIN (SELECT * FROM fm WHERE {" AND ".join(f"{c} IS NOT NULL" for c in M.FACTORS)}) USING (date) WHERE r IS NOT NULL GROUP BY isin""", "nav", "macro"))
def ols_gram_sums(s, d):
    """Each fund's sums of products with its return, and the squares of the factors, summed once per set of months."""
    frame, factors = matrix(s, d)
    frame = stored(M.numbered(frame, factors), "months")
    funds = stored(M.products(T.nav(s, d), frame, factors), "products")
    sets = funds.groupBy("months_id").agg(F.first("months").alias("months")).select("months_id", F.explode("months").alias("_month"))
    squares = [F.round(F.sum(F.col(f) * F.col(f)), 4).alias(f"xx_{f}") for f in factors]
    squares = sets.join(frame, "_month").groupBy("months_id").agg(*squares)
    sums = [F.round(F.get("xr", F.lit(k + 1)), 4).alias(f"xr_{f}") for k, f in enumerate(factors)]
    return funds.join(squares, "months_id").select("isin", "n", F.round(F.get("xr", F.lit(0)), 4).alias("sum_r"), F.round("rr", 4).alias("rr"), *sums, *[f"xx_{f}" for f in factors])


@query("ols_betas_multi")
def ols_betas_multi(s, d):
    return M.ols(T.nav(s, d), *matrix(s, d)).select("isin", "factor", F.round("beta", 6).alias("beta"), F.round("r2", 6).alias("r2"), "n")


@query("vif_prune")
def vif_prune(s, d):
    """Factors that are left of all and a near copy of one of them."""
    frame, factors = matrix(s, d)
    frame = stored(frame.withColumn("oil_twin", 2 * F.col("oil_yoy") + 0.001 * F.col("vix_yoy")), "factors")
    return M.ols(T.nav(s, d), frame, [*factors, "oil_twin"], keep=("oil_yoy",)).groupBy("isin").agg(F.sort_array(F.collect_set("factor")).alias("factors"))


@query("benchmark_relative_stats", sql(", pr AS (SELECT isin, nature, date, r FROM (SELECT isin, date, nav / lag(nav) OVER (PARTITION BY isin ORDER BY date) - 1 AS r FROM nav) JOIN master USING (isin) WHERE r IS NOT NULL), p AS (SELECT *, CASE WHEN count(*) OVER w > 1 THEN (sum(r) OVER w - r) / (count(*) OVER w - 1) END AS b FROM pr WINDOW w AS (PARTITION BY nature, date)) SELECT isin, round(covar_samp(r, b) / var_samp(b), 5) AS beta, round(stddev_samp(r - b) * sqrt(12), 6) AS tracking_error, round(avg(r - b) * 12 / (stddev_samp(r - b) * sqrt(12)), 5) AS information_ratio FROM p WHERE b IS NOT NULL GROUP BY isin", "nav", "master"))
def benchmark_relative_stats(s, d):
    from ..operators.peers import peer_returns

    p = peer_returns(T.nav(s, d), T.master(s, d)).where("bench is not null")
    te = F.stddev_samp(F.col("r") - F.col("bench")) * F.sqrt(F.lit(12))
    return p.groupBy("isin").agg(F.round(F.covar_samp("r", "bench") / F.var_samp("bench"), 5).alias("beta"), F.round(te, 6).alias("tracking_error"), F.round(F.avg(F.col("r") - F.col("bench")) * 12 / te, 5).alias("information_ratio"))
