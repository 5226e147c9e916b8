"""Queries over scores, selections, weights, rotation and forward returns."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators import macro as M, panel as P, peers as R, scoring as S
from ..sources import tables as T
from ..sources.files import stored
from .macro_queries import FRAME, FX, LIQ, WIDE, factor_frame, regimes, target_hurdle
from .panel_queries import PEERS, PERSIST, PRICES, prices
from .registry import query
from .sqlbase import risk, sql


def metrics_wide(s, d):
    """One row per fund with the measures that scores use."""
    d = T.made(s, d)
    panel, master = T.nav(s, d), T.master(s, d)
    nominal = P.risk_measures(panel)
    real = P.risk_measures(P.deflate(panel, prices(s, d))).select("isin", F.round("ret", 6).alias("return_real"))
    bucket = P.risk_bucket(F.col("vol"), F.col("n")).alias("srri_nav")
    wide = nominal.select("isin", F.round("sharpe", 6).alias("sharpe"), F.round("max_drawdown", 6).alias("max_drawdown"), bucket)
    for more in (
        real, R.persistence(panel, master).select("isin", F.round("alpha_persistence", 6).alias("alpha_persistence")),
        R.capture_ratios(R.peer_returns(panel, master)).select("isin", F.round("ratio", 4).alias("capture_ratio")), R.momentum_rank(nominal, master).select("isin", F.round("momentum_rank", 6).alias("momentum_rank")),
    ):
        wide = wide.join(more, "isin", "left")
    return master.join(wide, "isin").withColumn("credit_quality", F.when(F.col("isin") % 11 == 0, "High Yield").otherwise("Investment Grade"))


MW = f""", {PRICES}, {PEERS}{PERSIST.replace(', m AS', ', pm AS').replace('FROM m)', 'FROM pm)').replace('FROM m ', 'FROM pm ')},
dn AS (SELECT isin, date, nav / index AS nav FROM nav JOIN prices USING (date)), {risk('dn', 'rr')},
cg AS (SELECT isin, count(*) FILTER (bench > 0) AS nu, count(*) FILTER (bench < 0) AS nd, avg(r) FILTER (bench > 0) / avg(bench) FILTER (bench > 0) AS u, avg(r) FILTER (bench < 0) / avg(bench) FILTER (bench < 0) AS dd FROM peers WHERE bench IS NOT NULL GROUP BY isin),
cr AS (SELECT isin, round(greatest(-5, least(5, u / dd)), 4) AS capture_ratio FROM cg WHERE nu >= 12 AND nd >= 12 AND abs(dd) >= 1e-6),
ap AS (SELECT isin, round(avg(CASE WHEN ret > peers THEN 1.0 ELSE 0.0 END), 6) AS alpha_persistence FROM o WHERE w >= m0 AND (w - m0) % 6 = 0 AND w + 36 <= m1 AND peers IS NOT NULL GROUP BY isin HAVING count(*) >= 4),
mr AS (SELECT isin, round((rank() OVER w - 1) / count(*) OVER (PARTITION BY nature), 6) AS momentum_rank FROM rk JOIN master USING (isin) WHERE ret IS NOT NULL WINDOW w AS (PARTITION BY nature ORDER BY ret) QUALIFY count(*) OVER (PARTITION BY nature) >= 5),
mw AS (SELECT master.*, round(rk.sharpe, 6) AS sharpe, round(rk.max_drawdown, 6) AS max_drawdown, CASE WHEN rk.n < 14 OR rk.vol IS NULL THEN 0 WHEN rk.vol >= 0.25 THEN 7 WHEN rk.vol >= 0.15 THEN 6 WHEN rk.vol >= 0.10 THEN 5 WHEN rk.vol >= 0.05 THEN 4 WHEN rk.vol >= 0.02 THEN 3 WHEN rk.vol >= 0.005 THEN 2 ELSE 1 END AS srri_nav,
 round(rr.ret, 6) AS return_real, alpha_persistence, capture_ratio, momentum_rank, CASE WHEN master.isin % 11 = 0 THEN 'High Yield' ELSE 'Investment Grade' END AS credit_quality
 FROM master JOIN rk USING (isin) LEFT JOIN rr USING (isin) LEFT JOIN ap USING (isin) LEFT JOIN cr USING (isin) LEFT JOIN mr USING (isin))"""
_rank = lambda m: f"coalesce(CASE WHEN {m} IS NOT NULL THEN (rank() OVER (PARTITION BY nature, {m} IS NULL ORDER BY {m}) + (count(*) OVER (PARTITION BY nature, {m}) - 1) / 2.0) / count({m}) OVER (PARTITION BY nature) END, 0)"
PARTS_SQL = "(VALUES ('Defensiva'), ('Equilibrada'), ('Dinamica')) v(part)"
BETAS = {"beta_oil": "f_oil", "beta_rate": "f_rate", "beta_spread": "f_spread", "beta_vix": "f_vix"}
# Fixed values, written out: this SQL must not follow the code.
SCORES = MW + f""", {WIDE}, {FRAME}, {FX}, lr AS (SELECT isin, date, count(*) OVER (PARTITION BY isin) AS k, ln(nav / lag(nav) OVER (PARTITION BY isin ORDER BY date)) AS r FROM nav),
fb AS (SELECT isin, round(regr_slope(r, f_oil), 6) AS beta_oil, round(regr_slope(r, f_rate), 6) AS beta_rate, round(regr_slope(r, f_spread), 6) AS beta_spread, round(regr_slope(r, f_vix), 6) AS beta_vix,
 round(greatest(regr_r2(r, f_oil), regr_r2(r, f_rate), regr_r2(r, f_spread), regr_r2(r, f_vix)), 6) AS macro_r2 FROM lr JOIN fr USING (date) WHERE r IS NOT NULL GROUP BY isin HAVING count(*) >= 60),
xr AS (SELECT currency, date, ln(rate / lag(rate) OVER (PARTITION BY currency ORDER BY date)) AS fx FROM fx WHERE rate IS NOT NULL),
xg AS (SELECT isin, pow(1 + avg(fx), 12) - 1 AS fx_ann, pow(1 + avg(r), 12) - 1 AS t FROM lr JOIN master USING (isin) JOIN xr USING (currency, date) WHERE hedging IS NULL AND currency <> 'EUR' AND r IS NOT NULL AND fx IS NOT NULL GROUP BY isin HAVING count(*) >= 24),
xf AS (SELECT isin, round(CASE WHEN abs(t) > 1e-6 THEN greatest(-5, least(5, fx_ann / t)) ELSE 0 END, 5) AS fx_pct FROM xg),
rt AS (SELECT isin, regime, count(*) AS n_obs, round((exp(avg(r) * 12) - 1) * 100, 5) AS return_regime FROM lr JOIN rg USING (date) WHERE r IS NOT NULL AND k >= 36 GROUP BY isin, regime HAVING count(*) >= 12),
rq AS (SELECT regime, quantile_cont(return_regime, 0.25) AS p25, quantile_cont(return_regime, 0.75) AS p75 FROM rt GROUP BY regime),
ft AS (SELECT mw.isin, regime, alpha_persistence, beta_oil, beta_rate, beta_spread, beta_vix, macro_r2, fx_pct, n_obs, return_regime, p25, p75 FROM mw
 CROSS JOIN (VALUES ('Crisis_Financiera'), ('Shock_Energetico'), ('Estanflacion'), ('Contraccion'), ('Recalentamiento_Tardio'), ('Recalentamiento'), ('Expansion')) e(regime)
 LEFT JOIN fb USING (isin) LEFT JOIN xf USING (isin) LEFT JOIN rt USING (isin, regime) LEFT JOIN rq USING (regime)),
ml AS (SELECT isin, regime, round(
 CASE WHEN regime = 'Crisis_Financiera' AND beta_spread > 0.02 THEN 0.6::DOUBLE WHEN regime = 'Crisis_Financiera' AND beta_spread < -0.01 THEN 1.3 ELSE 1 END
 * CASE WHEN regime = 'Crisis_Financiera' AND beta_vix > 0.02 THEN 0.6::DOUBLE ELSE 1 END
 * CASE WHEN regime IN ('Shock_Energetico', 'Estanflacion', 'Recalentamiento') AND beta_oil > 0.01 THEN 1.2::DOUBLE ELSE 1 END
 * CASE WHEN regime IN ('Recalentamiento_Tardio', 'Shock_Energetico', 'Estanflacion') AND beta_rate < -0.1 THEN 0.7::DOUBLE ELSE 1 END
 * CASE WHEN abs(fx_pct) > 0.6 THEN 0.8::DOUBLE ELSE 1 END * CASE WHEN alpha_persistence > 0.6 THEN 1.15::DOUBLE ELSE 1 END * CASE WHEN macro_r2 > 0.5 THEN 0.85::DOUBLE ELSE 1 END
 * CASE WHEN n_obs >= 12 AND return_regime >= p75 THEN 1.2::DOUBLE WHEN n_obs >= 12 AND return_regime <= p25 THEN 0.8 ELSE 1 END, 4) AS multiplier FROM ft),
sr AS (SELECT isin, nature, manager, family_id, {", ".join(f"{_rank(m)} AS {m}" for m in S.MEASURES)} FROM mw),
bs AS (SELECT isin, part, nature, manager, family_id,
 CASE part WHEN 'Defensiva' THEN 0.20::DOUBLE * return_real + 0.25 * sharpe + 0.30 * max_drawdown + 0.15 * alpha_persistence + 0.05 * capture_ratio + 0.05 * momentum_rank
  WHEN 'Equilibrada' THEN 0.25::DOUBLE * return_real + 0.20 * sharpe + 0.20 * max_drawdown + 0.15 * alpha_persistence + 0.10 * capture_ratio + 0.10 * momentum_rank
  ELSE 0.30::DOUBLE * return_real + 0.15 * sharpe + 0.15 * max_drawdown + 0.15 * alpha_persistence + 0.15 * capture_ratio + 0.10 * momentum_rank END
 * CASE part || '/' || nature WHEN 'Defensiva/Monetario' THEN 1.25::DOUBLE WHEN 'Defensiva/Renta Fija Corto Plazo' THEN 1.1 WHEN 'Equilibrada/Mixtos' THEN 1.1 WHEN 'Equilibrada/Renta Fija Flexible' THEN 0.95
  WHEN 'Dinamica/Renta Variable' THEN 1.1 WHEN 'Dinamica/Alternativo' THEN 1.05 WHEN 'Dinamica/Mixtos' THEN 0.95 ELSE 1 END AS base FROM sr CROSS JOIN {PARTS_SQL}),
ex AS (SELECT isin, part, CASE WHEN max_drawdown < CASE part WHEN 'Defensiva' THEN -0.2::DOUBLE WHEN 'Equilibrada' THEN -0.3 ELSE -0.4 END THEN 'max_drawdown'
 WHEN return_real < CASE part WHEN 'Defensiva' THEN -0.05::DOUBLE WHEN 'Equilibrada' THEN -0.02 ELSE 0 END THEN 'return_real'
 WHEN part = 'Defensiva' AND srri_nav > 5 THEN 'srri' WHEN part = 'Defensiva' AND credit_quality = 'High Yield' THEN 'credit_quality' END AS reason FROM mw CROSS JOIN {PARTS_SQL}),
sc AS (SELECT isin, part, nature, manager, family_id, round(base, 6) AS base, multiplier, reason, CASE WHEN reason IS NULL THEN round(base * multiplier, 6) ELSE 0 END AS total
 FROM bs JOIN (SELECT isin, multiplier FROM ml WHERE regime = 'Expansion') USING (isin) JOIN ex USING (isin, part))"""
NEED = ("nav", "macro", "master", "rk")


def features(s, d, wide):
    """``wide`` with the funds' betas, explained share and currency share."""
    panel, master = T.nav(s, d), T.master(s, d)
    betas = M.factor_betas(panel, factor_frame(s, d), BETAS).select("isin", *[F.round(c, 6).alias(c) for c in (*BETAS, "macro_r2")])
    fx = M.fx_decomposition(panel, master, M.fx_rates(T.macro(s, d))).select("isin", F.round("fx_pct", 5).alias("fx_pct"))
    return wide.join(betas, "isin", "left").join(fx, "isin", "left")


def regime_returns(s, d):
    """(isin, regime, n_obs, return_regime, p25, p75)."""
    own = M.regime_stats(T.nav(s, d), regimes(s, d)).select("isin", "regime", "n_obs", F.round("return_ann", 5).alias("return_regime"))
    own = stored(own, "regime-returns")
    quartiles = own.groupBy("regime").agg(F.percentile("return_regime", 0.25).alias("p25"), F.percentile("return_regime", 0.75).alias("p75"))
    return own.join(quartiles, "regime")


def scores(s, d, wide=None):
    d = T.made(s, d)
    wide = stored(metrics_wide(s, d), "measures") if wide is None else wide
    flat = features(s, d, wide).join(regime_returns(s, d).where("regime = 'Expansion'").drop("regime"), "isin", "left")
    out = S.score(flat, "Expansion", p25=F.col("p25"), p75=F.col("p75")).join(wide.select("isin", "manager", "family_id"), "isin")
    out = out.select("isin", "part", "nature", "manager", "family_id", F.round("base", 6).alias("base"), "multiplier", "reason", F.round("total", 6).alias("total"))
    return stored(out, "scores")


def multipliers(s, d):
    """Of every fund in every regime."""
    d = T.made(s, d)
    returns = regime_returns(s, d)
    wide = features(s, d, metrics_wide(s, d).select("isin", "alpha_persistence"))
    each = wide.withColumn("regime", F.explode(F.array(*map(F.lit, M.REGIMES)))).join(returns.drop("p25", "p75"), ["isin", "regime"], "left")
    each = each.join(returns.select("regime", "p25", "p75").distinct(), "regime", "left")
    return S.multiplier(each, F.col("regime"), p25=F.col("p25"), p75=F.col("p75"), keys=("isin", "regime"))


query("metrics_wide", sql(f"{MW} SELECT isin, nature, sharpe, max_drawdown, srri_nav, return_real, alpha_persistence, capture_ratio, momentum_rank FROM mw", *NEED))(
    lambda s, d: metrics_wide(s, d).select("isin", "nature", "sharpe", "max_drawdown", "srri_nav", "return_real", "alpha_persistence", "capture_ratio", "momentum_rank")
)
query("score_base", sql(f"{SCORES} SELECT isin, part, nature, round(base, 6) AS base FROM bs", *NEED))(lambda s, d: S.base_scores(metrics_wide(s, d)).withColumn("base", F.round("base", 6)))
query("score_hard_filters", sql(f"{SCORES} SELECT isin, part, reason FROM ex", *NEED))(lambda s, d: S.exclusion(metrics_wide(s, d)))
query("score_funds", sql(f"{SCORES} SELECT isin, part, nature, base, multiplier, reason, total FROM sc", *NEED))(lambda s, d: scores(s, d).drop("manager", "family_id"))
query("score_regime_multiplier", sql(f"{SCORES} SELECT isin, regime, multiplier FROM ml", *NEED))(multipliers)
@query("fn_json", sql(f"{SCORES} SELECT isin, part, base, multiplier, reason, reason AS why FROM sc", *NEED))
def fn_json(s, d):
    """Details written as JSON and read back, whole and by path."""
    detail = scores(s, d).select("isin", "part", F.to_json(F.struct("base", "multiplier", "reason")).alias("detail"))
    return detail.select("isin", "part", F.from_json("detail", "base double, multiplier double, reason string").alias("d"), F.get_json_object("detail", "$.reason").alias("why")).select("isin", "part", "d.*", "why")


query("best_per_family", sql(f"{SCORES} SELECT isin, part, family_id, total FROM sc QUALIFY row_number() OVER (PARTITION BY family_id, part ORDER BY total DESC, isin) = 1", *NEED))(lambda s, d: S.best_per_family(scores(s, d)).select("isin", "part", "family_id", "total"))
query("topk_per_group", sql(f"{SCORES} SELECT isin, part, total FROM sc QUALIFY row_number() OVER (PARTITION BY part ORDER BY total DESC, isin) <= 10", *NEED))(
    lambda s, d: scores(s, d).withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy(F.desc("total"), "isin"))).where("k <= 10").select("isin", "part", "total")
)


def chosen(s, d):
    return S.select_capped(scores(s, d).withColumn("scenario", F.lit("Expansion")), "scenario")


CHOSEN = f"""{SCORES}, cand AS (SELECT row_number() OVER (ORDER BY CASE part WHEN 'Defensiva' THEN 0 WHEN 'Equilibrada' THEN 1 ELSE 2 END, total DESC, isin) AS k, part, isin, nature, manager, family_id, total FROM sc WHERE total > 0),
gr(k, c) AS (SELECT 0::BIGINT, []::STRUCT(part VARCHAR, isin BIGINT, nature VARCHAR, manager VARCHAR, family_id VARCHAR, total DOUBLE)[] UNION ALL
 SELECT cand.k, CASE WHEN len(list_filter(c, lambda y: y.part = cand.part)) < 10 AND len(list_filter(c, lambda y: y.part = cand.part AND y.nature = cand.nature)) < 5 AND len(list_filter(c, lambda y: y.manager = cand.manager)) < 2 AND len(list_filter(c, lambda y: y.family_id = cand.family_id)) = 0
  THEN list_append(c, {{'part': cand.part, 'isin': cand.isin, 'nature': cand.nature, 'manager': cand.manager, 'family_id': cand.family_id, 'total': cand.total}}) ELSE c END FROM gr JOIN cand ON cand.k = gr.k + 1),
ch AS (SELECT x.part AS part, x.isin AS isin, x.total AS total, CAST(r AS INTEGER) AS rank FROM (SELECT unnest(c) AS x, unnest(range(len(c))) AS r FROM (SELECT c FROM gr ORDER BY k DESC LIMIT 1))),
w1 AS (SELECT *, total / sum(total) OVER w AS share, total / sum(total) OVER w > 0.2 AS big FROM ch WINDOW w AS (PARTITION BY part)),
w2 AS (SELECT *, greatest(CASE WHEN big THEN 0.2::DOUBLE WHEN bool_or(big) OVER w THEN total / sum(total) FILTER (NOT big) OVER w * (1 - 0.2::DOUBLE * count(*) FILTER (big) OVER w) ELSE share END, 0.03) AS capped FROM w1 WINDOW w AS (PARTITION BY part)),
w3 AS (SELECT *, round(capped / sum(capped) OVER (PARTITION BY part), 4) AS even FROM w2),
wt AS (SELECT part, isin, round(CASE WHEN row_number() OVER (PARTITION BY part ORDER BY even DESC, isin) = 1 THEN even + (1 - sum(even) OVER (PARTITION BY part)) ELSE even END, 4) AS weight FROM w3)"""
_recursive = lambda body: sql(body, *NEED).replace("WITH ", "WITH RECURSIVE ", 1)
query("select_constrained", _recursive(f"{CHOSEN} SELECT 'Expansion' AS scenario, part, isin, total, rank FROM ch"))(chosen)
query("weights_cap_redistribute", _recursive(f"{CHOSEN} SELECT 'Expansion' AS scenario, part, isin, weight FROM wt"))(lambda s, d: S.capped_weights(chosen(s, d), "scenario", "part").select("scenario", "part", "isin", "weight"))


@query("weights_master", _recursive(f"""{CHOSEN} SELECT regime, part, isin, round(weight * CASE part WHEN 'Defensiva' THEN d WHEN 'Equilibrada' THEN e ELSE y END, 6) AS weight FROM wt CROSS JOIN (VALUES ('Crisis_Financiera', 0.70::DOUBLE, 0.25::DOUBLE, 0.05::DOUBLE),
 ('Shock_Energetico', 0.55, 0.35, 0.10), ('Estanflacion', 0.50, 0.35, 0.15), ('Contraccion', 0.60, 0.35, 0.05), ('Recalentamiento_Tardio', 0.40, 0.40, 0.20), ('Recalentamiento', 0.30, 0.40, 0.30), ('Expansion', 0.20, 0.45, 0.35)) v(regime, d, e, y)"""))
def weights_master(s, d):
    """Weights in the whole, in every regime: the part's weights times the regime's."""
    inside = S.capped_weights(chosen(s, d), "scenario", "part").withColumn("regime", F.explode(F.array(*map(F.lit, M.REGIMES))))
    factor = S.by_part({f"{r}/{p}": w for r, ws in M.REGIMES.items() for p, w in zip(S.PARTS, ws, strict=True)}, F.concat_ws("/", "regime", "part"))
    return inside.select("regime", "part", "isin", F.round(F.col("weight") * factor, 6).alias("weight"))


TOP = f"{SCORES}, tp AS (SELECT isin, part, nature, total FROM sc WHERE total > 0 QUALIFY row_number() OVER (PARTITION BY part ORDER BY total DESC, isin) <= 10)"


def top(s, d, scored=None):
    w = Window.partitionBy("part").orderBy(F.desc("total"), "isin")
    return (scores(s, d) if scored is None else scored).where("total > 0").withColumn("k", F.row_number().over(w)).where("k <= 10").select("isin", "part", "nature", "total")


_BEST = lambda part, used: f"SELECT isin, part, total FROM sc WHERE part = '{part}' AND total > 0{used} ORDER BY total DESC, isin LIMIT 10"
#: The portfolio of each regime: ten funds a part that no earlier part has, weighted by score and the regime's share of the part.
PORTFOLIO = f"""{SCORES}, t1 AS ({_BEST("Defensiva", "")}), t2 AS ({_BEST("Equilibrada", " AND isin NOT IN (SELECT isin FROM t1)")}),
 t3 AS ({_BEST("Dinamica", " AND isin NOT IN (SELECT isin FROM t1 UNION SELECT isin FROM t2)")}), rf AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3),
 pw AS (SELECT regime, part, isin, total / sum(total) OVER (PARTITION BY regime, part) * CASE part WHEN 'Defensiva' THEN d WHEN 'Equilibrada' THEN e ELSE y END AS weight
 FROM rf CROSS JOIN (VALUES ('Crisis_Financiera', 0.70::DOUBLE, 0.25::DOUBLE, 0.05::DOUBLE), ('Shock_Energetico', 0.55, 0.35, 0.10), ('Estanflacion', 0.50, 0.35, 0.15), ('Contraccion', 0.60, 0.35, 0.05),
 ('Recalentamiento_Tardio', 0.40, 0.40, 0.20), ('Recalentamiento', 0.30, 0.40, 0.30), ('Expansion', 0.20, 0.45, 0.35)) v(regime, d, e, y)),
 ix AS (SELECT isin, date, nav, year(date) * 12 + month(date) AS m FROM nav), fw AS (SELECT a.isin, a.date, h, b.nav / a.nav - 1 AS ret FROM ix a CROSS JOIN (VALUES (1), (3), (12)) v(h) JOIN ix b ON a.isin = b.isin AND b.m = a.m + h),
 pf AS (SELECT date, regime, h, sum(weight * ret) / sum(weight) AS ret FROM fw JOIN rg USING (date) JOIN pw USING (regime, isin) GROUP BY date, regime, h)"""


def portfolios(s, d):
    """(regime, part, isin, weight), written once: a row for each regime and chosen fund."""
    return stored(S.regime_portfolios(S.refilled(scores(s, d)), M.REGIMES), "portfolios")


def monthly(s, d, months=(1, 3, 12)):
    """(date, regime, h, ret) of the portfolios; only the few chosen funds' values are put beside later ones."""
    d = T.made(s, d)
    weights = portfolios(s, d)
    held = T.nav(s, d).join(F.broadcast(weights.select("isin").distinct()), "isin", "left_semi")  # at most ten funds a part
    return S.portfolio_returns(weights, S.forward_returns(held, months), regimes(s, d))


query("forward_returns", sql(", ix AS (SELECT isin, date, nav, year(date) * 12 + month(date) AS m FROM nav) SELECT a.isin, a.date, h, round(b.nav / a.nav - 1, 6) AS ret FROM ix a CROSS JOIN (VALUES (1), (3), (12)) v(h) JOIN ix b ON a.isin = b.isin AND b.m = a.m + h", "nav"))(lambda s, d: S.forward_returns(T.nav(s, d)).select("isin", "date", "h", F.round("ret", 6).alias("ret")))
query("portfolio_forward_return", sql(f"{PORTFOLIO} SELECT date, h, round(ret, 6) AS ret FROM pf", *NEED))(lambda s, d: monthly(s, d).select("date", "h", F.round("ret", 6).alias("ret")))
BENCH = "bn AS (SELECT date, h, avg(ret) AS bench FROM (SELECT * FROM fw QUALIFY row_number() OVER (PARTITION BY date, h ORDER BY isin) <= 100) GROUP BY date, h)"
query("equal_weight_benchmark", sql(f"{PORTFOLIO}, {BENCH} SELECT date, h, round(bench, 6) AS bench FROM bn", *NEED))(lambda s, d: S.equal_weight(S.forward_returns(T.nav(s, d))).select("date", "h", F.round("bench", 6).alias("bench")))


@query("evaluate_by_regime", sql(f"""{PORTFOLIO}, {BENCH}, j AS (SELECT *, CASE WHEN ret > bench THEN 1.0 ELSE 0.0 END AS won FROM pf JOIN bn USING (date, h)),
 ev AS (SELECT regime, h, count(*) AS months, avg(ret) AS ret, avg(bench) AS bench, avg(ret - bench) AS excess, avg(won) AS hit FROM j GROUP BY regime, h
 UNION ALL SELECT 'GLOBAL', h, count(*), pow(1 + avg(ret), 12.0 / h) - 1, pow(1 + avg(bench), 12.0 / h) - 1, avg(ret - bench) * 12 / h, avg(won) FROM j GROUP BY h)
 SELECT regime, h, months, round(ret, 6) AS ret, round(bench, 6) AS bench, round(excess, 6) AS excess, round(hit, 6) AS hit FROM ev""", *NEED))
def evaluate_by_regime(s, d):
    d = T.made(s, d)
    out = S.evaluate(monthly(s, d), S.equal_weight(S.forward_returns(T.nav(s, d))))
    return out.select("regime", "h", "months", *[F.round(c, 6).alias(c) for c in ("ret", "bench", "excess", "hit")])


@query("regime_portfolio_weights", sql(f"{PORTFOLIO} SELECT regime, part, isin, round(weight, 6) AS weight FROM pw", *NEED))
def regime_portfolio_weights(s, d):
    return portfolios(s, d).select("regime", "part", "isin", F.round("weight", 6).alias("weight"))


COSTS = [("Monetario", 0.0, 0.0), ("Renta Variable", 0.01, 0.005), ("Mixtos", 0.005, 0.005)]
COST_SQL = "co(nature, exit_cost, entry_cost) AS (VALUES ('Monetario', 0.0::DOUBLE, 0.0::DOUBLE), ('Renta Variable', 0.01, 0.005), ('Mixtos', 0.005, 0.005))"


def costs(s):
    return s.createDataFrame(COSTS, "nature string, exit_cost double, entry_cost double")


PAIRS = f", {COST_SQL}, pa AS (SELECT a.nature AS nature_out, b.nature AS nature_in FROM (SELECT DISTINCT nature FROM master) a JOIN (SELECT DISTINCT nature FROM master) b ON a.nature <> b.nature)"


@query("rotation_cost", sql(f"{PAIRS} SELECT nature_out, nature_in, round(coalesce(x.exit_cost, 0.005) + coalesce(y.entry_cost, 0.005) + 0.001, 6) AS cost FROM pa LEFT JOIN co x ON x.nature = nature_out LEFT JOIN co y ON y.nature = nature_in", "master"))
def rotation_cost(s, d):
    n = T.master(s, d).select("nature").distinct()
    pairs = n.select(F.col("nature").alias("nature_out")).join(n.select(F.col("nature").alias("nature_in")), F.col("nature_out") != F.col("nature_in"))
    return S.rotation_cost(pairs, costs(s)).select("nature_out", "nature_in", F.round("cost", 6).alias("cost"))


query("lookup_default", sql(f", {COST_SQL} SELECT isin, nature, coalesce(exit_cost, 0.005) AS exit_cost FROM master LEFT JOIN co USING (nature)", "master"))(
    lambda s, d: T.master(s, d).join(F.broadcast(costs(s)), "nature", "left").select("isin", "nature", F.coalesce("exit_cost", F.lit(0.005)).alias("exit_cost"))
)
PLAN = f"{TOP}, {COST_SQL}, hd AS (SELECT isin, part, nature, total FROM sc WHERE total > 0 QUALIFY row_number() OVER (PARTITION BY part ORDER BY isin) <= 10), lv AS (SELECT * FROM hd ANTI JOIN tp USING (part, isin)), nw AS (SELECT * FROM tp ANTI JOIN hd USING (part, isin)), pp AS (SELECT lv.part, lv.isin AS out_isin, nw.isin AS in_isin, nw.total - lv.total AS gain, lv.total AS ot, coalesce(x.exit_cost, 0.005) + coalesce(y.entry_cost, 0.005) + 0.001 AS cost FROM lv JOIN nw USING (part) LEFT JOIN co x ON x.nature = lv.nature LEFT JOIN co y ON y.nature = nw.nature)"


def held(scored):
    return scored.where("total > 0").withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy("isin"))).where("k <= 10").select("isin", "part", "nature", "total")


@query("rotation_plan", sql(f"{PLAN} SELECT part, out_isin, min_by(in_isin, (-gain, in_isin)) AS in_isin, round(max(gain), 6) AS gain FROM pp WHERE gain > cost / greatest(ot, 0.01) + 0.05 GROUP BY part, out_isin", *NEED))
def rotation_plan(s, d):
    scored = scores(s, d)
    return S.rotation_plan(held(scored), top(s, d, scored), costs(s)).select("part", "out_isin", "in_isin", F.round("gain", 6).alias("gain"))


def leaving(scored, best):
    return held(scored).join(best, ["part", "isin"], "left_anti").select("part", F.col("isin").alias("out_isin"), F.col("total").alias("ot"), F.col("nature").alias("nature_out"))


def entering(scored, best):
    return best.join(held(scored), ["part", "isin"], "left_anti").select("part", F.col("isin").alias("in_isin"), F.col("total").alias("it"), F.col("nature").alias("nature_in"))


@query("cross_pairs_best", sql(f"{PLAN} SELECT part, out_isin, count(*) AS pairs, round(max(gain), 6) AS best FROM pp GROUP BY part, out_isin", *NEED))
def cross_pairs_best(s, d):
    scored = scores(s, d)
    best = top(s, d, scored)
    pairs = leaving(scored, best).join(entering(scored, best), "part")  # at most ten of each a part
    return pairs.groupBy("part", "out_isin").agg(F.count("*").alias("pairs"), F.round(F.max(F.col("it") - F.col("ot")), 6).alias("best"))


@query("rotation_decision", sql(f"{PLAN} SELECT part, out_isin, in_isin, gain > cost / greatest(ot, 0.01) + 0.05 AS rotate FROM pp", *NEED))
def rotation_decision(s, d):
    scored = scores(s, d)
    best = top(s, d, scored)
    p = S.rotation_cost(leaving(scored, best).join(entering(scored, best), "part"), costs(s))
    return p.select("part", "out_isin", "in_isin", S.worth_rotating(F.col("it") - F.col("ot"), F.col("cost"), F.col("ot")).alias("rotate"))


query("nav_matrix_rebased", sql("SELECT isin, date, round(100 * nav / first_value(nav) OVER (PARTITION BY isin ORDER BY date), 5) AS nav FROM nav", "nav"))(
    lambda s, d: T.nav(s, d).select("isin", "date", F.round(100 * F.col("nav") / F.first("nav").over(Window.partitionBy("isin").orderBy("date")), 5).alias("nav"))
)


@query("curve_drawdown", sql(f"{PORTFOLIO}, c AS (SELECT date, exp(sum(ln(1 + ret)) OVER (ORDER BY date)) AS v FROM pf WHERE h = 1) SELECT date, round(v / max(v) OVER (ORDER BY date) - 1, 6) AS dd FROM c", *NEED))
def curve_drawdown(s, d):
    p = monthly(s, d, (1,))
    c = p.select("date", F.exp(F.sum(F.log1p("ret")).over(M.calendar())).alias("v"))
    return c.select("date", F.round(F.col("v") / F.max("v").over(M.calendar()) - 1, 6).alias("dd"))


def holdings(s, d, wide):
    chosen = top(s, d, scores(s, d, wide))
    return chosen.join(wide.drop("nature"), "isin").select("part", "isin", "fund_name", "manager", "sharpe", "max_drawdown", "return_real", "total")


#: What a fund has to earn, by the newest month that has it.
HURDLE = "SELECT max_by(round(ipc_yoy_avg + m, 6), date) FROM (SELECT date, total / lag(total, 12) OVER (ORDER BY date) - 1 AS m FROM lt) JOIN ind USING (date) WHERE ipc_yoy_avg + m IS NOT NULL"


@query(
    "report_holdings",
    sql(
        f"""{TOP}{LIQ} SELECT part, isin, fund_name, manager, sharpe, max_drawdown, return_real, total, ({HURDLE}) AS hurdle, round(return_real - ({HURDLE}), 6) AS excess
 FROM tp JOIN mw USING (isin, nature)""",
        *NEED,
    ),
)
def report_holdings(s, d):
    d = T.made(s, d)
    hurdle = target_hurdle(s, d).agg(F.max_by("hurdle", "date")).scalar()
    rows = holdings(s, d, stored(metrics_wide(s, d), "measures"))
    return rows.withColumn("hurdle", hurdle).withColumn("excess", F.round(F.col("return_real") - F.col("hurdle"), 6))


_PCT = lambda c, v: f"(CASE WHEN {c} IS NOT NULL THEN (rank() OVER (PARTITION BY {c} IS NULL ORDER BY {v}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0) / count({c}) OVER () END)"


@query("score_preservation", sql(f""", {WIDE}, lr AS (SELECT isin, date, count(*) OVER (PARTITION BY isin) AS k, ln(nav / lag(nav) OVER (PARTITION BY isin ORDER BY date)) AS r FROM nav),
cr AS (SELECT isin, round((exp(avg(r) * 12) - 1) * 100, 5) AS crisis FROM lr JOIN rg USING (date) WHERE r IS NOT NULL AND k >= 36 AND regime IN ('Crisis_Financiera', 'Shock_Energetico', 'Contraccion') GROUP BY isin HAVING count(*) >= 12),
v AS (SELECT isin, round(max_drawdown, 6) AS dd, round(worst_month, 6) AS wm, round(pct_positive, 6) AS pp, round(pct_severe, 6) AS ps, recovery AS rc, crisis FROM rk LEFT JOIN cr USING (isin)),
k AS (SELECT isin, coalesce({_PCT('dd', 'dd')}, 0) AS a, coalesce({_PCT('wm', 'wm')}, 0) AS b, coalesce({_PCT('pp', 'pp')}, 0) AS c, coalesce({_PCT('ps', 'ps DESC')}, 0) AS e, coalesce({_PCT('rc', 'rc DESC')}, 0) AS f, coalesce({_PCT('crisis', 'crisis')}, 0) AS g FROM v)
SELECT isin, round(0.7 * a + 0.3 * b + 1e-9, 5) AS damage, round(0.6 * c + 0.4 * e + 1e-9, 5) AS consistent, round(0.6 * f + 0.4 * g + 1e-9, 5) AS resilience FROM k""", "nav", "macro", "rk"))
def score_preservation(s, d):
    d = T.made(s, d)
    measures = P.risk_measures(T.nav(s, d)).select("isin", *[F.round(c, 6).alias(c) for c in ("max_drawdown", "worst_month", "pct_positive", "pct_severe")], "recovery")
    bad = regimes(s, d).where(F.col("regime").isin("Crisis_Financiera", "Shock_Energetico", "Contraccion")).withColumn("regime", F.lit("crisis"))
    crisis = M.regime_stats(T.nav(s, d), bad).select("isin", F.round("return_ann", 5).alias("crisis"))
    out = S.preservation(stored(measures.join(crisis, "isin", "left"), "measures"))
    return out.select("isin", *[F.round(F.col(c) + 1e-9, 5).alias(c) for c in ("damage", "consistent", "resilience")])
