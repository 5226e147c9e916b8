"""Queries over the value panel, peers and macro series."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators import macro as M, panel as P, peers as R
from ..sources import tables as T
from .registry import query
from .sqlbase import MEASURES, risk, sql

by = P.by_date
cols = lambda df, keys, *values, digits=6: df.select(*keys, *[F.round(v, digits).alias(v) for v in values])
ID = ["isin", "date"]


def lag_query(name, fn, expr, where="TRUE", log=False):
    query(name, sql(f"SELECT isin, date, round({expr}, 6) AS v FROM (SELECT *, lag(nav) OVER w AS p, lag(nav, 12) OVER w AS p12, lag(nav, 3) OVER w AS p3 FROM nav WINDOW w AS (PARTITION BY isin ORDER BY date)) WHERE {where}", "nav"))(fn)


lag_query("win_pct_change", lambda s, d: P.returns(T.nav(s, d), "isin").select(*ID, F.round("r", 6).alias("v")), "nav / p - 1")
lag_query("win_log_return", lambda s, d: P.returns(T.nav(s, d), "isin", log=True).select(*ID, F.round("r", 6).alias("v")), "ln(nav / p)")
lag_query("win_yoy", lambda s, d: P.returns(T.nav(s, d), "isin", lag=12).select(*ID, F.round("r", 6).alias("v")), "nav / p12 - 1")
lag_query("win_diff_n", lambda s, d: T.nav(s, d).select(*ID, F.round(F.col("nav") - F.lag("nav", 3).over(by("isin")), 6).alias("v")), "nav - p3")


def over_nav(name, expr, window="PARTITION BY isin ORDER BY date"):
    return query(name, sql(f"SELECT isin, date, {expr.replace('OVER', f'OVER ({window})')} AS v FROM nav", "nav"))


over_nav("win_cummax_drawdown", "round(nav / max(nav) OVER - 1, 6)")(lambda s, d: P.drawdowns(T.nav(s, d), "isin").select(*ID, F.round("dd", 6).alias("v")))
over_nav("win_rebase_100", "round(100 * nav / first_value(nav) OVER, 6)")(lambda s, d: T.nav(s, d).select(*ID, F.round(100 * F.col("nav") / F.first("nav", ignorenulls=True).over(by("isin")), 6).alias("v")))


@query("win_cumprod", sql(", a AS (SELECT *, nav / lag(nav) OVER (PARTITION BY isin ORDER BY date) - 1 AS r FROM nav) SELECT isin, date, round(exp(sum(ln(1 + r)) OVER (PARTITION BY isin ORDER BY date)), 6) AS v FROM a WHERE r IS NOT NULL", "nav"))
def win_cumprod(s, d):
    r = P.returns(T.nav(s, d), "isin").where("r is not null")
    return r.select(*ID, F.round(F.exp(F.sum(F.log1p("r")).over(by("isin"))), 6).alias("v"))


@query("win_rolling_mean", sql("SELECT isin, date, round(CASE WHEN count(*) OVER a = 3 THEN avg(nav) OVER a END + 1e-9, 4) AS ma3, round(CASE WHEN count(*) OVER b = 6 THEN avg(nav) OVER b END + 1e-9, 4) AS ma6, CASE WHEN count(*) OVER b = 6 THEN avg(nav) OVER a > avg(nav) OVER b END AS up FROM nav WINDOW a AS (PARTITION BY isin ORDER BY date ROWS 2 PRECEDING), b AS (PARTITION BY isin ORDER BY date ROWS 5 PRECEDING)", "nav"))
def win_rolling_mean(s, d):
    frame = lambda n: by("isin").rowsBetween(1 - n, 0)
    mean = lambda n: F.when(F.count("*").over(frame(n)) == n, F.avg("nav").over(frame(n)))
    return T.nav(s, d).select(*ID, F.round(mean(3) + 1e-9, 4).alias("ma3"), F.round(mean(6) + 1e-9, 4).alias("ma6"), (F.when(mean(6).isNotNull(), mean(3) > mean(6))).alias("up"))


MONTHS = "months AS (SELECT last_day(unnest(generate_series(date_trunc('month', (SELECT min(date) FROM macro)), date_trunc('month', (SELECT max(date) FROM macro)), INTERVAL 1 MONTH))) AS date)"


@query("win_ffill", sql(f", {MONTHS} SELECT date, last_value(value IGNORE NULLS) OVER (ORDER BY date) AS cli FROM months LEFT JOIN (SELECT date, value FROM macro WHERE indicator = 'cli' AND geography = 'EU') USING (date)", "macro"))
def win_ffill(s, d):
    macro = T.macro(s, d)
    months = M.wide(macro, {f"{i}_{g}": f"{i}_{g}" for i, g in ALL_SERIES})
    return months.select("date", M.filled("cli_EU").alias("cli"))


ALL_SERIES = [("ipc_index", "ES"), ("ipc_index", "EU"), ("oil_wti", "GLOBAL"), ("cli", "EU"), ("rate_deposit", "EU"), ("spread_hy", "GLOBAL"), ("vix", "GLOBAL"), ("m2_level", "US"), ("m2_level", "EU"), ("m2_level", "CN"), ("m2_level", "JP")]


@query("win_tail_n", sql("SELECT isin, date, nav FROM nav QUALIFY row_number() OVER (PARTITION BY isin ORDER BY date DESC) <= 12", "nav"))
def win_tail_n(s, d):
    return T.nav(s, d).withColumn("k", F.row_number().over(Window.partitionBy("isin").orderBy(F.desc("date")))).where("k <= 12").drop("k")


@query("win_dedup_keep_last", "SELECT l_suppkey AS isin, last_day(l_shipdate) AS date, l_extendedprice AS price FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, last_day(l_shipdate) ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1")
def win_dedup_keep_last(s, d):
    w = Window.partitionBy("l_suppkey", "date").orderBy(*[F.desc(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")])
    rows = T.read(s, d, "lineitem").withColumn("date", F.last_day("l_shipdate")).withColumn("k", F.row_number().over(w)).where("k = 1")
    return rows.select(F.col("l_suppkey").alias("isin"), "date", F.col("l_extendedprice").alias("price"))


RANK = "(rank() OVER (PARTITION BY nature ORDER BY {v}) + (count(*) OVER (PARTITION BY nature, {v}) - 1) / 2.0) / count(*) OVER (PARTITION BY nature)"


@query("win_rank_pct", sql(f"SELECT isin, nature, round({RANK.format(v='srri')}, 6) AS v FROM master", "master"))
def win_rank_pct(s, d):
    return T.master(s, d).select("isin", "nature", F.round(P.percent_rank_ties("srri", "nature"), 6).alias("v"))


@query("win_frac_below", sql("SELECT isin, nature, round((rank() OVER (PARTITION BY nature ORDER BY srri) - 1) / count(*) OVER (PARTITION BY nature), 6) AS v FROM master", "master"))
def win_frac_below(s, d):
    return T.master(s, d).select("isin", "nature", F.round(P.share_below("srri", "nature"), 6).alias("v"))


@query("win_lead_gap", "SELECT event_id, user_id, CAST(floor(epoch(lead(ts) OVER w)) - floor(epoch(ts)) AS BIGINT) AS gap_s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def win_lead_gap(s, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return T.read(s, d, "events").select("event_id", "user_id", (F.unix_timestamp(F.lead("ts").over(w)) - F.unix_timestamp("ts")).alias("gap_s"))


@query("win_last_valid_flag", sql(f", {MONTHS} SELECT geography, m.date, m.date > max(k.date) OVER (PARTITION BY geography) AS estimated FROM (SELECT DISTINCT geography FROM macro WHERE indicator = 'm2_level') CROSS JOIN months m LEFT JOIN (SELECT geography, date FROM macro WHERE indicator = 'm2_level') k USING (geography, date)", "macro").replace("m.date >", "m.date >"))
def win_last_valid_flag(s, d):
    macro = T.macro(s, d)
    months = M.wide(macro, {f"{i}_{g}": f"{i}_{g}" for i, g in ALL_SERIES}).select("date")
    level = macro.where("indicator = 'm2_level'").select("geography", "date", F.col("date").alias("seen"))
    spine = level.select("geography").distinct().crossJoin(F.broadcast(months)).join(level, ["geography", "date"], "left")  # areas times months
    return spine.select("geography", "date", (F.col("date") > F.max("seen").over(Window.partitionBy("geography"))).alias("estimated"))


@query("win_islands_longest", sql("SELECT isin, dd_duration AS longest FROM rk", "rk"))
def win_islands_longest(s, d):
    full = P.drawdowns(T.nav(s, d), "isin")
    return P.longest_run(full, F.col("nav") < F.col("peak"), "isin")


def wide_query(name, *measures, digits=6):
    body = ", ".join(f"round({m}, {digits}) AS {m}" if m not in ("dd_duration", "recovery", "n") else m for m in measures)

    @query(name, sql(f"SELECT isin, {body} FROM rk", "rk"))
    def run(s, d):
        full = P.risk_measures(T.nav(s, d))
        return full.select("isin", *[F.round(m, digits).alias(m) if m not in ("dd_duration", "recovery", "n") else F.col(m) for m in measures])


for _name, _measures in {
    "ret_annualized": ["ret"], "vol_annualized": ["vol"], "sharpe": ["sharpe"], "sortino": ["sortino"], "ret_vol_simple": ["ret_vol"], "max_drawdown": ["max_drawdown"], "drawdown_duration": ["dd_duration"],
    "time_to_recovery": ["recovery"], "consistency": ["pct_positive", "pct_negative", "pct_severe", "worst_month"],
}.items():
    wide_query(_name, *_measures)

PRICES = "prices AS (SELECT date, value AS index FROM macro WHERE indicator = 'ipc_index' AND geography = 'ES')"


def prices(s, d):
    return T.macro(s, d).where("indicator = 'ipc_index' and geography = 'ES'").select("date", F.col("value").alias("index"))


@query("deflate_real", sql(f", {PRICES} SELECT isin, date, round(nav / index, 6) AS nav FROM nav JOIN prices USING (date)", "nav", "macro"))
def deflate_real(s, d):
    return P.deflate(T.nav(s, d), prices(s, d)).select("isin", "date", F.round("nav", 6).alias("nav"))


BODY = ", ".join(f"round({m}, 6) AS {m}" if m not in ("dd_duration", "recovery") else m for m in MEASURES)
rounded = lambda df, *keys: df.select(*keys, *[F.round(m, 6).alias(m) if m not in ("dd_duration", "recovery") else F.col(m) for m in P.MEASURES])


@query("risk_pack_nominal_real", sql(f", {PRICES}, nominal_real AS (SELECT isin, date, nav, 0 AS real_flag FROM nav UNION ALL SELECT isin, date, nav / index, 1 FROM nav JOIN prices USING (date)), {risk('nominal_real', 'k', 'isin, real_flag')} SELECT isin, real_flag, {BODY} FROM k", "nav", "macro"))
def risk_pack_nominal_real(s, d):
    return rounded(P.risk_measures(P.nominal_and_real(T.nav(s, d), prices(s, d)), "isin", "real_flag"), "isin", "real_flag")


BUCKET = "CASE WHEN n < 14 OR vol IS NULL THEN 0 WHEN vol >= 0.25 THEN 7 WHEN vol >= 0.15 THEN 6 WHEN vol >= 0.10 THEN 5 WHEN vol >= 0.05 THEN 4 WHEN vol >= 0.02 THEN 3 WHEN vol >= 0.005 THEN 2 ELSE 1 END"


@query("srri_bucket", sql(f"SELECT isin, {BUCKET} AS bucket FROM rk", "rk"))
def srri_bucket(s, d):
    return P.risk_measures(T.nav(s, d)).select("isin", P.risk_bucket(F.col("vol"), F.col("n")).alias("bucket"))


@query("return_metrics", sql(f"SELECT isin, fund_name, manager, nature, round(ret, 6) AS ret, round(vol, 6) AS vol, round(max_drawdown, 6) AS max_drawdown, {BUCKET} AS bucket FROM rk JOIN master USING (isin) ORDER BY ret DESC, isin LIMIT 30", "rk", "master"))
def return_metrics(s, d):
    full = P.risk_measures(T.nav(s, d)).join(T.master(s, d), "isin")
    out = full.select("isin", "fund_name", "manager", "nature", F.round("ret", 6).alias("ret"), F.round("vol", 6).alias("vol"), F.round("max_drawdown", 6).alias("max_drawdown"), P.risk_bucket(F.col("vol"), F.col("n")).alias("bucket"))
    return out.orderBy(F.desc("ret"), "isin").limit(30)


HORIZONS = """tail AS (SELECT *, row_number() OVER (PARTITION BY isin ORDER BY date DESC) AS k, count(*) OVER (PARTITION BY isin) AS c FROM nav),
hz AS (SELECT isin, date, nav, 'since_inception' AS horizon FROM nav
 UNION ALL SELECT isin, date, nav, horizon FROM (SELECT isin, date, nav, horizon, count(*) OVER (PARTITION BY isin, horizon) AS c FROM nav JOIN windows ON date BETWEEN start AND stop) WHERE c >= 12
 UNION ALL SELECT isin, date, nav, h FROM tail, (VALUES ('rolling_1y', 12), ('rolling_3y', 36), ('rolling_5y', 60)) v(h, size) WHERE k <= size AND c >= size)"""


@query("multi_horizon_metrics", sql(f", {HORIZONS}, {risk('hz', 'k', 'isin, horizon')} SELECT isin, horizon, {BODY} FROM k", "nav", "windows"))
def multi_horizon_metrics(s, d):
    return rounded(P.risk_measures(P.horizons(T.nav(s, d), T.windows(s)), "isin", "horizon"), "isin", "horizon")


@query("range_join_windows", sql("SELECT isin, horizon, date, nav FROM (SELECT *, count(*) OVER (PARTITION BY isin, horizon) AS c FROM nav JOIN windows ON date BETWEEN start AND stop) WHERE c >= 12", "nav", "windows"))
def range_join_windows(s, d):
    return P.in_windows(T.nav(s, d), T.windows(s)).select("isin", "horizon", "date", "nav")


PEERS = "pr AS (SELECT isin, nature, date, r FROM (SELECT isin, date, nav / lag(nav) OVER (PARTITION BY isin ORDER BY date) - 1 AS r FROM nav) JOIN master USING (isin) WHERE r IS NOT NULL), peers AS (SELECT *, CASE WHEN count(*) OVER w > 1 THEN (sum(r) OVER w - r) / (count(*) OVER w - 1) END AS bench FROM pr WINDOW w AS (PARTITION BY nature, date))"


@query("peer_benchmark", sql(f", {PEERS} SELECT isin, date, round(bench, 6) AS bench FROM peers", "nav", "master"))
def peer_benchmark(s, d):
    return R.peer_returns(T.nav(s, d), T.master(s, d)).select("isin", "date", F.round("bench", 6).alias("bench"))


query("loo_peer_join", sql(f", {PEERS} SELECT isin, nature, date, round(r - bench, 6) AS excess FROM peers WHERE bench IS NOT NULL", "nav", "master"))(lambda s, d: R.peer_returns(T.nav(s, d), T.master(s, d)).where("bench is not null").select("isin", "nature", "date", F.round(F.col("r") - F.col("bench"), 6).alias("excess")))


@query("capture_ratios", sql(f""", {PEERS}, g AS (SELECT isin, count(*) FILTER (bench > 0) AS nu, count(*) FILTER (bench < 0) AS nd, avg(r) FILTER (bench > 0) / avg(bench) FILTER (bench > 0) AS u, avg(r) FILTER (bench < 0) / avg(bench) FILTER (bench < 0) AS dn FROM peers WHERE bench IS NOT NULL GROUP BY isin)
SELECT isin, round(greatest(-5, least(5, u)), 4) AS upside, round(greatest(-5, least(5, dn)), 4) AS downside, round(greatest(-5, least(5, u / dn)), 4) AS ratio FROM g WHERE nu >= 12 AND nd >= 12 AND abs(dn) >= 1e-6""", "nav", "master"))
def capture_ratios(s, d):
    return cols(R.capture_ratios(R.peer_returns(T.nav(s, d), T.master(s, d))), ["isin"], "upside", "downside", "ratio", digits=4)


PERSIST = """, m AS (SELECT isin, nature, year(date) * 12 + month(date) AS m, nav, min(year(date) * 12 + month(date)) OVER (PARTITION BY isin) AS m0, max(year(date) * 12 + month(date)) OVER (PARTITION BY isin) AS m1 FROM nav JOIN master USING (isin)),
e AS (SELECT *, unnest(range(m - 36, m + 1)) AS w FROM m),
q AS (SELECT isin, nature, w, m0, m1, count(*) AS n, pow(max_by(nav, m) / min_by(nav, m), 12.0 / count(*)) - 1 AS ret FROM e GROUP BY isin, nature, w, m0, m1 HAVING count(*) >= 33),
o AS (SELECT *, CASE WHEN count(*) OVER z > 1 THEN (sum(ret) OVER z - ret) / (count(*) OVER z - 1) END AS peers FROM q WINDOW z AS (PARTITION BY nature, w))"""


@query("alpha_persistence", sql(PERSIST + " SELECT isin, count(*) AS alpha_persistence_n, round(avg(CASE WHEN ret > peers THEN 1.0 ELSE 0.0 END), 6) AS alpha_persistence FROM o WHERE w >= m0 AND (w - m0) % 6 = 0 AND w + 36 <= m1 AND peers IS NOT NULL GROUP BY isin HAVING count(*) >= 4", "nav", "master"))
def alpha_persistence(s, d):
    return R.persistence(T.nav(s, d), T.master(s, d)).select("isin", "alpha_persistence_n", F.round("alpha_persistence", 6).alias("alpha_persistence"))


query("range_join_rolling", sql(PERSIST + " SELECT isin, CAST(w - m0 AS INTEGER) AS offset_months, n, round(ret, 6) AS ret FROM q WHERE w >= m0 AND (w - m0) % 6 = 0 AND w + 36 <= m1", "nav", "master"))(lambda s, d: rolling(s, d))


def rolling(s, d):
    m = T.nav(s, d).withColumn("m", T.month_index("date"))
    span = Window.partitionBy("isin")
    m = m.withColumns({"m0": F.min("m").over(span), "m1": F.max("m").over(span)})
    first = F.greatest(F.lit(0), F.ceil((F.col("m") - 36 - F.col("m0")) / 6).cast("int"))
    last = F.floor((F.col("m") - F.col("m0")) / 6).cast("int")
    each = m.where(first <= last).select("*", F.explode(F.sequence(first, last)).alias("k")).where(F.col("m0") + 6 * F.col("k") + 36 <= F.col("m1"))
    g = each.groupBy("isin", "k").agg(F.count("*").alias("n"), (F.pow(F.max_by("nav", "m") / F.min_by("nav", "m"), 12.0 / F.count("*")) - 1).alias("ret")).where("n >= 33")
    return g.select("isin", (6 * F.col("k")).alias("offset_months"), "n", F.round("ret", 6).alias("ret"))


@query("momentum_rank", sql("SELECT isin, round((rank() OVER w - 1) / count(*) OVER (PARTITION BY nature), 6) AS momentum_rank FROM rk JOIN master USING (isin) WHERE ret IS NOT NULL WINDOW w AS (PARTITION BY nature ORDER BY ret) QUALIFY count(*) OVER (PARTITION BY nature) >= 5", "rk", "master"))
def momentum_rank(s, d):
    return R.momentum_rank(P.risk_measures(T.nav(s, d)), T.master(s, d)).select("isin", F.round("momentum_rank", 6).alias("momentum_rank"))


@query("momentum_excess", sql(f""", tail AS (SELECT *, row_number() OVER (PARTITION BY isin ORDER BY date DESC) AS k, count(*) OVER (PARTITION BY isin) AS c FROM nav),
hz AS (SELECT isin, date, nav, months FROM tail, (VALUES (12), (36)) v(months) WHERE k <= months AND c >= months), {risk('hz', 'q', 'isin, months')},
mean AS (SELECT nature, months, avg(ret) AS mean FROM q JOIN master USING (isin) WHERE ret IS NOT NULL GROUP BY nature, months HAVING count(*) >= 5),
t AS (SELECT isin, months, max(nav) FILTER (k = 1) / max(nav) FILTER (k = months + 1) - 1 AS t FROM tail, (VALUES (12), (36)) v(months) GROUP BY isin, months)
SELECT isin, CASE months WHEN 12 THEN 'momentum_1y' ELSE 'momentum_3y' END AS metric, round(t - mean, 6) AS value FROM t JOIN master USING (isin) JOIN mean USING (nature, months) WHERE t IS NOT NULL""", "nav", "master"))
def momentum_excess(s, d):
    return R.momentum_excess(T.nav(s, d), T.master(s, d)).select("isin", "metric", F.round("value", 6).alias("value"))
