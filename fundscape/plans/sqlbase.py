"""The fund model in DuckDB SQL, for the oracles."""

from ..sources.tables import ATTRIBUTES as TABLE_ATTRIBUTES

NAV = """p0 AS (SELECT l_suppkey AS isin, last_day(l_shipdate) AS date, max_by(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS px
  FROM lineitem GROUP BY ALL),
r0 AS (SELECT isin, date, (0.002 + 0.018 * (isin % 7)) * (px / avg(px) OVER (PARTITION BY isin) - 1) + 0.004 AS r FROM p0),
nav AS (SELECT isin, date, round(100 * exp(sum(ln(1 + r)) OVER (PARTITION BY isin ORDER BY date)), 6) AS nav FROM r0)"""

MASTER = """master AS (SELECT s_suppkey AS isin, s_name AS fund_name, n_name AS manager,
  CASE r_name WHEN 'AFRICA' THEN 'Monetario' WHEN 'AMERICA' THEN 'Renta Variable' WHEN 'ASIA' THEN 'Renta Fija Flexible' WHEN 'EUROPE' THEN 'Mixtos' ELSE 'Alternativo' END AS nature,
  CAST(1 + s_suppkey % 7 AS INTEGER) AS srri, (['EUR', 'USD', 'JPY', 'GBP', 'CNY'])[s_suppkey % 5 + 1] AS currency,
  CASE WHEN s_suppkey % 4 = 0 THEN 'Full' END AS hedging, n_name || '_' || (s_suppkey % 3) AS family_id, s_acctbal AS size
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_SERIES = [
    (0, "ipc_index", "ES", "100 * {0.0030 + 0.012 * z}"), (1, "ipc_index", "EU", "100 * {0.0030 + 0.012 * z}"), (2, "oil_wti", "GLOBAL", "50 * {0.005 + 0.40 * z}"),
    (3, "cli", "EU", "100.5 + 6 * z"), (4, "rate_deposit", "EU", "2 + 3 * z"), (5, "spread_hy", "GLOBAL", "5 + 6 * z"), (5, "vix", "GLOBAL", "20 * exp(0.9 * z)"),
    (0, "fx_usd_eur", "GLOBAL", "1.1 * exp(0.1 * z)"), (2, "fx_jpy_usd", "GLOBAL", "120 * exp(0.1 * z)"), (3, "fx_usd_gbp", "GLOBAL", "1.3 * exp(0.1 * z)"), (4, "fx_cny_usd", "GLOBAL", "7 * exp(0.1 * z)"),
    (0, "m2_level", "US", "1000 * {0.004 + 0.01 * z}"), (1, "m2_level", "EU", "1300 * {0.004 + 0.01 * z}"), (2, "m2_level", "CN", "1900 * {0.004 + 0.01 * z}"), (3, "m2_level", "JP", "700 * {0.004 + 0.01 * z}"),
    (1, "rate_policy", "US", "3 + 4 * z + 6 * z * z"), (2, "rate_policy", "JP", "0.5 + z - 2 * z * z"), (5, "rate_policy", "CN", "4 + 2 * z + 5 * z * z"), (3, "m3_yoy", "EU", "5 + 9 * z + 7 * z * z"), (4, "m2_yoy", "US", "6 + 8 * z - 3 * z * z"),
    (2, "ipc_index", "US", "100 * {0.0025 + 0.010 * z}"), (3, "ipc_index", "JP", "100 * {0.0010 + 0.008 * z}"), (5, "ipc_index", "CN", "100 * {0.0020 + 0.015 * z}"), (1, "copper", "GLOBAL", "9000 * {0.003 + 0.30 * z}"),
    (0, "cli", "US", "100 + 5 * z + 9 * z * z"), (2, "cli", "JP", "100 + 4 * z"), (4, "cli", "CN", "100 - 3 * z"), (5, "cli", "ES", "100 + 2 * z"), (4, "dxy", "GLOBAL", "100 * exp(0.2 * z)"), (1, "gold", "GLOBAL", "1800 * exp(0.3 * z)"), (0, "unemployment", "US", "5 - 4 * z"),
    (5, "m2_global_yoy", "GLOBAL", "6 + 5 * z * z - 3 * z"), (2, "spread_ig", "GLOBAL", "1.5 + 2 * z + 4 * z * z"), (4, "term_spread", "US", "1 - 2 * z + 8 * z * z"),
]


def _sql(v: str) -> str:
    return v.replace("{", "exp(sum(ln(1 + ").replace("}", ")) OVER (PARTITION BY j ORDER BY date))")


MACRO = (
    """m0 AS (SELECT CAST(o_custkey % 6 AS INTEGER) AS j, last_day(o_orderdate) AS date, avg(o_totalprice) AS v FROM orders GROUP BY ALL),
z0 AS (SELECT j, date, round(v / avg(v) OVER (PARTITION BY j) - 1, 9) AS z FROM m0),
macro AS (SELECT * FROM ("""
    + " UNION ALL ".join(f"SELECT date, '{i}' AS indicator, '{g}' AS geography, round({_sql(v)}, 6) AS value FROM z0 WHERE j = {j}" for j, i, g, v in _SERIES)
    + """) WHERE NOT (indicator = 'm2_level' AND (geography = 'CN' AND date > DATE '2000-06-30' OR geography = 'JP' AND date > DATE '2000-12-31')))"""
)

WINDOWS = """windows(horizon, start, stop) AS (VALUES ('w1', DATE '1996-01-31', DATE '1997-06-30'), ('w2', DATE '1998-01-31', DATE '1999-03-31'),
 ('w3', DATE '2000-01-31', DATE '2001-06-30'), ('short', DATE '1999-05-31', DATE '1999-07-31'))"""


def risk(source: str, name: str, keys: str = "isin", extra: str = "") -> str:
    """CTEs that give ``name``: the risk measures of ``source`` (keys, date, nav) per key."""
    n = name
    return f"""{n}_a AS (SELECT {keys}, date, nav, nav / lag(nav) OVER w - 1 AS r, max(nav) OVER w AS peak, row_number() OVER w AS i
  FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY date)),
{n}_b AS (SELECT *, nav / peak - 1 AS dd, sum(CASE WHEN nav >= peak THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY date) AS island FROM {n}_a),
{n}_d AS (SELECT {keys}, max(k) AS dd_duration FROM (SELECT {keys}, island, sum(CASE WHEN nav < peak THEN 1 ELSE 0 END) AS k FROM {n}_b GROUP BY {keys}, island) GROUP BY {keys}),
{n}_t AS (SELECT {keys}, min_by(i, (dd, i)) AS ti, min_by(peak, (dd, i)) AS tp FROM {n}_b GROUP BY {keys}),
{n}_r AS (SELECT {keys}, min(i) - min(ti) AS recovery FROM {n}_b JOIN {n}_t USING ({keys}) WHERE i >= ti AND nav >= tp GROUP BY {keys}),
{n}_g AS (SELECT {keys}, count(*) AS n, CASE WHEN count(*) >= 2 THEN pow(max_by(nav, date) / min_by(nav, date), 12.0 / count(*)) - 1 END AS ret,
  CASE WHEN count(r) >= 2 THEN stddev_samp(r) * sqrt(12) END AS vol, CASE WHEN count(*) FILTER (r < 0) >= 2 THEN stddev_samp(r) FILTER (r < 0) * sqrt(12) END AS down,
  min(dd) AS max_drawdown, avg(CASE WHEN r > 0 THEN 1.0 WHEN r IS NOT NULL THEN 0.0 END) AS pct_positive, avg(CASE WHEN r < 0 THEN 1.0 WHEN r IS NOT NULL THEN 0.0 END) AS pct_negative,
  avg(CASE WHEN r <= -0.02 THEN 1.0 WHEN r IS NOT NULL THEN 0.0 END) AS pct_severe, min(r) AS worst_month FROM {n}_b GROUP BY {keys}),
{n} AS (SELECT {keys}, n, ret, vol, CASE WHEN vol > 0 THEN (ret - 0.02) / vol END AS sharpe, CASE WHEN down > 0 THEN (ret - 0.02) / down END AS sortino, CASE WHEN vol > 0 THEN ret / vol END AS ret_vol,
  max_drawdown, CAST(dd_duration AS BIGINT) AS dd_duration, CAST(recovery AS BIGINT) AS recovery, pct_positive, pct_negative, pct_severe, worst_month
  FROM {n}_g JOIN {n}_d USING ({keys}) LEFT JOIN {n}_r USING ({keys}))"""


#: Long metric rows (isin, metric, value) since inception.
MEASURES = ["ret", "vol", "sharpe", "sortino", "ret_vol", "max_drawdown", "dd_duration", "recovery", "pct_positive", "pct_negative", "pct_severe", "worst_month"]
LONG = "metrics AS (" + " UNION ALL ".join(f"SELECT isin, '{m}' AS metric, round(CAST({m} AS DOUBLE), 6) AS value FROM rk WHERE {m} IS NOT NULL" for m in MEASURES) + ")"

_nth = lambda values, step: "([" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + f"])[(p_partkey // {step}) % {len(values)} + 1]"
ATTRIBUTES = "attributes AS (SELECT p_partkey AS id, p_name AS name, " + ", ".join(f"{_nth(*spec)} AS {c}" for c, spec in TABLE_ATTRIBUTES.items()) + """, CAST(CASE WHEN p_partkey % 13 <> 0 THEN 1 + p_partkey % 7 END AS INTEGER) AS srri, CAST((p_partkey // 2) % 2 AS INTEGER) AS is_esg,
 ([6, 8, 9, NULL])[(p_partkey // 3) % 4 + 1] AS sfdr, CASE WHEN p_partkey % 3 <> 0 THEN p_size / 10 END AS charge, CASE WHEN p_partkey % 5 <> 0 THEN p_type || ' ' || p_name END AS benchmark FROM part)"""

ALL = {"attributes": ATTRIBUTES, "nav": NAV, "master": MASTER, "macro": MACRO, "windows": WINDOWS, "rk": risk("nav", "rk"), "metrics": LONG}
NEEDS = {"metrics": ["rk"], "rk": ["nav"]}


def sql(body: str, *names: str) -> str:
    """``body`` with the named parts of the model before it; ``body`` may begin with further CTEs after a comma."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    head = ",\n".join(ALL[n] for n in order)
    return f"WITH {head}{body}" if body.lstrip().startswith(",") else (f"WITH {head}\n{body}" if head else body)
