"""Queries over merges, filters, joins, aggregations, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators import macro as M, panel as P, relational as L
from ..sources import files, tables as T
from .macro_queries import factor  # noqa: F401
from .registry import query
from .sqlbase import sql

Q = query
c = F.col


def metrics(s, d):
    return P.to_long(P.risk_measures(T.nav(s, d)), "isin")


def wide(s, d, *names):
    return metrics(s, d).groupBy("isin").pivot("metric", list(names)).agg(F.max("value"))


PIVOT = lambda *n: ", pv AS (SELECT isin, " + ", ".join(f"max(value) FILTER (metric = '{m}') AS {m}" for m in n) + " FROM metrics GROUP BY isin)"

# Scans, sources, sinks
Q("scan_nav", sql("SELECT isin, date, nav FROM nav", "nav"))(T.nav)
Q("scan_distinct_ids", "SELECT DISTINCT l_suppkey AS isin FROM lineitem")(lambda s, d: T.read(s, d, "lineitem").select(c("l_suppkey").alias("isin")).distinct())
Q("scan_cpi", sql("SELECT date, value FROM macro WHERE indicator = 'ipc_index' AND geography = 'EU'", "macro"))(lambda s, d: T.macro(s, d).where("indicator = 'ipc_index' and geography = 'EU'").select("date", "value"))
Q("series_available", sql("SELECT indicator, geography, count(*) AS n FROM macro GROUP BY ALL", "macro"))(lambda s, d: T.macro(s, d).groupBy("indicator", "geography").agg(F.count("*").alias("n")))
Q("scan_macro_catalog", sql(", cat(indicator, geography) AS (VALUES ('cli', 'EU'), ('vix', 'GLOBAL')) SELECT macro.* FROM macro JOIN cat USING (indicator, geography)", "macro"))(
    lambda s, d: T.macro(s, d).join(F.broadcast(s.createDataFrame([("cli", "EU"), ("vix", "GLOBAL")], "indicator string, geography string")), ["indicator", "geography"]).select("date", "indicator", "geography", "value")
)


@Q("union_master_sheets", "SELECT s_suppkey AS isin, s_name AS name, 'supplier' AS source FROM supplier UNION ALL SELECT c_custkey, c_name, 'customer' FROM customer")
def union_master_sheets(s, d):
    sheets = {t: T.read(s, d, t) for t in ("supplier", "customer", "nation")}
    return L.union_sources(sheets, {"isin": ["s_suppkey", "c_custkey"], "name": ["s_name", "c_name", "n_name"]}, "isin")


def written(s, d, fmt, df):
    from ..sources.files import shared_path

    path = shared_path(s, fmt)
    df.write.format(fmt).save(path)
    return path


@Q("read_timevalue_csv", sql("SELECT date, value FROM macro WHERE indicator = 'cli' AND month(date) <> 6", "macro"))
def read_timevalue_csv(s, d):
    rows = T.macro(s, d).where("indicator = 'cli'").select("date", F.when(F.month("date") == 6, ".").otherwise(c("value").cast("string")).alias("value"))
    return files.time_value_csv(s, written(s, d, "csv", rows))


@Q("read_jsonstat", sql("SELECT date, value FROM macro WHERE indicator = 'vix'", "macro"))
def read_jsonstat(s, d):
    v = T.macro(s, d).where("indicator = 'vix'").withColumn("i", (F.row_number().over(Window.partitionBy("geography").orderBy("date")) - 1).cast("string"))
    payload = v.groupBy("geography").agg(F.map_from_entries(F.collect_list(F.struct("i", "value"))).alias("value"), F.map_from_entries(F.collect_list(F.struct(F.date_format("date", "yyyy-MM").alias("k"), c("i").cast("int").alias("v")))).alias("time"))
    return files.json_stat(payload.select(F.to_json(F.struct("value", "time")).alias("json")))


Q("source_priority_merge", "SELECT doc_id, q, CASE WHEN quality IS NOT NULL THEN 'labels' ELSE 'documents' END AS source FROM (SELECT d.doc_id, coalesce(l.quality, 9)::INTEGER AS q, quality FROM documents d LEFT JOIN labels l USING (doc_id))")(
    lambda s, d: L.first_source(T.read(s, d, "labels").select("doc_id", c("quality").cast("int").alias("q"), F.lit("labels").alias("source")).join(T.read(s, d, "documents").select("doc_id"), "doc_id", "left_semi").unionByName(T.read(s, d, "documents").select("doc_id", F.lit(9).alias("q"), F.lit("documents").alias("source"))), {"labels": 0, "documents": 1}, "doc_id")
)
@Q(
    "sink_long_metrics",
    sql(
        """SELECT isin, metric, 'since_inception' AS horizon, value FROM metrics
 UNION ALL SELECT isin, metric, '3Y', CASE WHEN isin IN (SELECT isin FROM master WHERE srri > 3) THEN value * 3 ELSE value / 2 END FROM metrics""",
        "metrics", "master",
    ),
)
def sink_long_metrics(s, d):
    """Two horizons are written; then one of them comes again for some of the funds."""
    path, long = files.shared_path(s, "metrics"), files.stored(metrics(s, d), "long-metrics")
    horizon = lambda df, name, value: df.select("isin", "metric", F.lit(name).alias("horizon"), value.alias("value"))
    files.replace_keyed(horizon(long, "since_inception", c("value")).union(horizon(long, "3Y", c("value") / 2)), path, "horizon", "isin", "metric")
    again = horizon(long.join(T.master(s, d).where("srri > 3"), "isin", "left_semi"), "3Y", c("value") * 3)
    files.replace_keyed(again, path, "horizon", "isin", "metric")
    return files.read_partitioned(s, path, again.schema)


# An earlier state of the panel, and a later delivery that corrects its last months and adds newer ones.
OLD, NEW = "SELECT isin, date, nav FROM nav WHERE date < DATE '2000-07-01'", "SELECT isin, date, nav * 2 AS nav FROM nav WHERE date >= DATE '2000-01-01'"
old = lambda s, d: T.nav(s, d).where("date < '2000-07-01'")
new = lambda s, d: T.nav(s, d).where("date >= '2000-01-01'").withColumn("nav", c("nav") * 2)
Q("upsert_replace", sql(f", a AS ({OLD}), b AS ({NEW}) SELECT * FROM a ANTI JOIN b USING (isin, date) UNION ALL SELECT * FROM b", "nav"))(lambda s, d: L.upsert_replace(old(s, d), new(s, d), "isin", "date"))
Q("insert_ignore", sql(f", a AS ({OLD}), b AS ({NEW}) SELECT * FROM a UNION ALL SELECT * FROM b ANTI JOIN a USING (isin, date)", "nav"))(lambda s, d: L.insert_ignore(old(s, d), new(s, d), "isin", "date"))
Q("replace_children", sql(f", a AS ({OLD}), b AS (SELECT * FROM ({NEW}) WHERE date > DATE '2000-01-01') SELECT * FROM a WHERE isin NOT IN (SELECT isin FROM b) UNION ALL SELECT * FROM b", "nav"))(lambda s, d: L.replace_children(old(s, d), new(s, d).where("date > '2000-01-01'"), "isin"))
Q("upsert_policy_merge", sql("""SELECT coalesce(a.isin, b.isin) AS isin, CASE WHEN a.isin IS NOT NULL THEN a.fund_name ELSE b.fund_name END AS fund_name, CASE WHEN b.isin IS NOT NULL THEN b.srri ELSE a.srri END AS srri,
 coalesce(b.hedging, a.hedging) AS hedging, CASE WHEN b.isin IS NOT NULL AND (a.isin IS NULL OR b.size > a.size) THEN b.size ELSE a.size END AS size
 FROM (SELECT * FROM master WHERE size < 7000) a FULL JOIN (SELECT isin, upper(fund_name) AS fund_name, 7 - srri AS srri, CASE WHEN isin % 5 = 0 THEN 'Partial' END AS hedging, size + CASE WHEN isin % 2 = 0 THEN 1 ELSE -1 END AS size FROM master WHERE size > -500) b ON a.isin = b.isin""", "master"))(
    lambda s, d: L.policy_merge(
        T.master(s, d).where("size < 7000"),
        T.master(s, d).where("size > -500").select("isin", F.upper("fund_name").alias("fund_name"), (7 - c("srri")).alias("srri"), F.when(c("isin") % 5 == 0, "Partial").alias("hedging"), (c("size") + F.when(c("isin") % 2 == 0, 1).otherwise(-1)).alias("size")),
        ["isin"], {"fund_name": "keep", "srri": "overwrite", "hedging": "fill", "size": c("n.size") > c("o.size")},
    )
)
Q("table_export", sql("SELECT isin, fund_name, size FROM master WHERE srri > 3 ORDER BY size DESC, isin LIMIT 20", "master"))(lambda s, d: L.export(T.master(s, d), include=["isin", "fund_name", "size", "not_there", "nature"], exclude=("nature",), where="srri > 3", order=[F.desc("size"), "isin"], limit=20))
Q("block_filtered_export", sql("SELECT nav.* FROM nav SEMI JOIN (SELECT isin FROM master WHERE nature = 'Mixtos') USING (isin)", "nav", "master"))(lambda s, d: T.nav(s, d).join(T.master(s, d).where("nature = 'Mixtos'"), "isin", "left_semi"))
@Q("jdbc_copy_clean", "SELECT doc_id, replace(text, chr(0), '') AS text, lang, source, n_chars FROM documents")
def jdbc_copy_clean(s, d):
    """Through a database where the session names one or runs in one process; else through files."""
    rows, url = L.strip_nul(T.read(s, d, "documents")), files.database(s)
    if not url:
        return files.stored(rows, "copy")
    files.jdbc_sink(rows, url, "documents_copy", "doc_id")
    return files.jdbc_source(s, url, "documents_copy", "doc_id")


@Q("event_log_append", "SELECT event_id, ts, event_type AS status, CASE WHEN value < 20 THEN 'load' ELSE 'repair' END AS step FROM events")
def event_log_append(s, d):
    """Two runs append to one log, which is read back."""
    log, events = files.shared_path(s, "event-log"), T.read(s, d, "events")
    for step, rows in (("load", events.where("value < 20")), ("repair", events.where("not value < 20 or value is null"))):
        files.append_log(rows.select("event_id", "ts", c("event_type").alias("status")), log, step)
    return files.read_log(s, log)


# Filters
Q("filter_like_any_none", "SELECT p_partkey, p_name, (contains(p_name, 'red') OR contains(p_name, 'small')) AS wanted, (contains(p_name, 'ring') OR contains(p_name, 'bolt')) AS barred FROM part WHERE (contains(p_name, 'red') OR contains(p_name, 'small')) AND NOT (contains(p_name, 'ring') OR contains(p_name, 'bolt'))")(
    lambda s, d: T.read(s, d, "part").select("p_partkey", "p_name", c("p_name").rlike("red|small").alias("wanted"), c("p_name").rlike("ring|bolt").alias("barred")).where("wanted and not barred")
)
G4 = ("max_drawdown", "pct_positive", "pct_severe", "recovery")
Q("filter_hard_gates", sql(f"{PIVOT(*G4)} SELECT isin FROM pv WHERE max_drawdown >= -0.15 AND pct_positive >= 0.5 AND pct_severe <= 0.2 AND recovery IS NOT NULL AND recovery <= 60", "metrics"))(lambda s, d: wide(s, d, *G4).where("max_drawdown >= -0.15 and pct_positive >= 0.5 and pct_severe <= 0.2 and recovery is not null and recovery <= 60").select("isin"))
Q("filter_gate_union", sql("SELECT DISTINCT isin FROM metrics WHERE (metric = 'sharpe' AND value > 0.5) OR (metric = 'max_drawdown' AND value > -0.05)", "metrics"))(lambda s, d: metrics(s, d).where("(metric = 'sharpe' and value > 0.5) or (metric = 'max_drawdown' and value > -0.05)").select("isin").distinct())
PROFILES = [("conservative", -0.10, 0.55, 0.05), ("balanced", -0.20, 0.5, 0.15), ("bold", -0.40, 0.45, 0.30)]
GATES = "gt(profile, dd, pos, sev) AS (VALUES ('conservative', -0.10::DOUBLE, 0.55::DOUBLE, 0.05::DOUBLE), ('balanced', -0.20, 0.5, 0.15), ('bold', -0.40, 0.45, 0.30))"
PASSES = "CAST(max_drawdown >= dd AS INTEGER) + CAST(pct_positive >= pos AS INTEGER) + CAST(pct_severe <= sev AS INTEGER)"
Q("profile_gate_matrix", sql(f"{PIVOT(*G4)}, {GATES} SELECT isin, profile, {PASSES} AS passed FROM pv CROSS JOIN gt WHERE {PASSES} >= 2", "metrics"))(
    lambda s, d: wide(s, d, *G4).join(F.broadcast(s.createDataFrame(PROFILES, "profile string, dd double, pos double, sev double")), F.lit(True)).select("isin", "profile", ((c("max_drawdown") >= c("dd")).cast("int") + (c("pct_positive") >= c("pos")).cast("int") + (c("pct_severe") <= c("sev")).cast("int")).alias("passed")).where("passed >= 2")  # three profiles
)
Q("filter_candidates", sql(f"{PIVOT('ret', 'vol', 'sharpe', 'max_drawdown', 'pct_positive', 'worst_month')} SELECT pv.* FROM pv JOIN (SELECT isin, n FROM rk) USING (isin) WHERE ret > 0.02 AND vol < 0.3 AND sharpe > 0 AND max_drawdown > -0.3 AND pct_positive > 0.45 AND worst_month > -0.2 AND n >= 60", "metrics"))(
    lambda s, d: wide(s, d, "ret", "vol", "sharpe", "max_drawdown", "pct_positive", "worst_month").where("ret > 0.02 and vol < 0.3 and sharpe > 0 and max_drawdown > -0.3 and pct_positive > 0.45 and worst_month > -0.2").join(T.nav(s, d).groupBy("isin").agg(F.count("*").alias("n")).where("n >= 60"), "isin", "left_semi")
)
Q("slice_window", sql("SELECT * FROM nav WHERE date BETWEEN DATE '1998-01-31' AND DATE '1999-03-31'", "nav"))(lambda s, d: T.nav(s, d).where(c("date").between("1998-01-31", "1999-03-31")))
BUCKETS = "CASE WHEN value < 0 THEN 'a: loss' WHEN value < 0.05 THEN 'b: low' WHEN value < 0.10 THEN 'c: fair' ELSE 'd: high' END"
Q("bucket_case", sql(f"SELECT {BUCKETS} AS bucket, count(*) AS n FROM metrics WHERE metric = 'ret' GROUP BY 1", "metrics"))(lambda s, d: metrics(s, d).where("metric = 'ret'").groupBy(F.when(c("value") < 0, "a: loss").when(c("value") < 0.05, "b: low").when(c("value") < 0.10, "c: fair").otherwise("d: high").alias("bucket")).agg(F.count("*").alias("n")))
V1, V2 = "CASE WHEN isin % 7 = 0 THEN NULL WHEN isin % 3 = 0 THEN 'AGREE' WHEN isin % 3 = 1 THEN 'MILD' ELSE 'CONFLICT' END", "CASE WHEN isin % 2 = 0 THEN 'AGREE' ELSE 'MILD' END"
Q("worst_of_verdict", sql(f"SELECT isin, CASE WHEN a IS NULL OR b IS NULL THEN NULL WHEN 'CONFLICT' IN (a, b) THEN 'CONFLICT' WHEN 'MILD' IN (a, b) THEN 'MILD' ELSE 'AGREE' END AS verdict FROM (SELECT isin, {V1} AS a, {V2} AS b FROM master)", "master"))(
    lambda s, d: T.master(s, d).select("isin", F.expr(V1).alias("a"), F.expr(V2).alias("b")).select("isin", F.when(c("a").isNotNull() & c("b").isNotNull(), F.get(F.array(*map(F.lit, ("AGREE", "MILD", "CONFLICT"))), F.greatest(*[F.array_position(F.array(*map(F.lit, ("AGREE", "MILD", "CONFLICT"))), c(x)) - 1 for x in "ab"]).cast("int"))).alias("verdict"))
)
REASON = "CASE WHEN nulls > 0 THEN 'nulls' WHEN n <> months THEN 'repeated dates' WHEN low <= 0 THEN 'not positive' END"
Q("validate_series", sql(f", g AS (SELECT isin, count(*) FILTER (nav IS NULL) AS nulls, count(*) AS n, count(DISTINCT date) AS months, min(nav) AS low FROM nav GROUP BY isin) SELECT isin, {REASON} AS reason FROM g", "nav"))(
    lambda s, d: T.nav(s, d).groupBy("isin").agg(F.count_if(c("nav").isNull()).alias("nulls"), F.count("*").alias("n"), F.count_distinct("date").alias("months"), F.min("nav").alias("low")).select("isin", F.expr(REASON).alias("reason"))
)

# Joins
Q("join_inner_equi", sql("SELECT isin, nature, metric, value FROM metrics JOIN master USING (isin)", "metrics", "master"))(lambda s, d: metrics(s, d).join(T.master(s, d), "isin").select("isin", "nature", "metric", "value"))
SP = ("ret", "vol", "sharpe", "max_drawdown")
Q("join_left_selfpivot", sql(f"{PIVOT(*SP)} SELECT isin, fund_name, {', '.join(SP)} FROM master LEFT JOIN pv USING (isin)", "metrics", "master"))(lambda s, d: T.master(s, d).select("isin", "fund_name").join(wide(s, d, *SP), "isin", "left"))
Q("join_left_or_notnull", sql(f"{PIVOT('recovery', 'sortino')} SELECT isin, recovery, sortino FROM master JOIN pv USING (isin) WHERE coalesce(recovery, sortino) IS NOT NULL", "metrics", "master"))(lambda s, d: T.master(s, d).select("isin").join(wide(s, d, "recovery", "sortino"), "isin").where(F.coalesce("recovery", "sortino").isNotNull()))
Q("anti_join_missing", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")(lambda s, d: T.read(s, d, "customer").join(T.read(s, d, "orders").where("o_orderstatus = 'F'"), c("o_custkey") == c("c_custkey"), "left_anti").select("c_custkey"))
Q("semi_join_exists", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")(lambda s, d: T.read(s, d, "customer").join(T.read(s, d, "orders").where("o_totalprice > 400000"), c("o_custkey") == c("c_custkey"), "left_semi").select("c_custkey", "c_name"))
Q("align_inner_series", sql("SELECT isin, date, nav, value FROM nav JOIN (SELECT date, value FROM macro WHERE indicator = 'oil_wti') USING (date)", "nav", "macro"))(lambda s, d: T.nav(s, d).join(F.broadcast(T.macro(s, d).where("indicator = 'oil_wti'").select("date", "value")), "date").dropna().select("isin", "date", "nav", "value"))  # one row per month
ASOF = ", f AS (SELECT date AS at, value FROM macro WHERE indicator = 'rate_deposit'), t AS (SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS at FROM nav)"
Q("asof_backward", sql(f"{ASOF} SELECT t.at, f.value FROM t ASOF LEFT JOIN f ON t.at >= f.at", "nav", "macro"))(
    lambda s, d: L.asof_backward(T.nav(s, d).select(F.trunc("date", "MM").alias("at")).distinct(), T.macro(s, d).where("indicator = 'rate_deposit'").select(c("date").alias("at"), "value"), "at", "value")
)
TOK = "SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p, w FROM (SELECT doc_id, string_split_regex(trim(lower(text)), '[ \\n]+') AS w FROM documents)"
CTX = f"SELECT doc_id, p::INTEGER AS p, array_to_string(w[greatest(1, p - 3):p + 2], ' ') AS context FROM ({TOK}) WHERE word IN ('the', 'la', 'der')"
Q("position_range_selfjoin", CTX)(lambda s, d: contexts(s, d))


def contexts(s, d):
    w = T.read(s, d, "documents").select("doc_id", F.split(F.trim(F.lower("text")), "[ \\n]+").alias("w"))
    each = w.select("doc_id", "w", F.posexplode("w").alias("i", "word")).where(c("word").isin("the", "la", "der"))
    first = F.greatest(c("i") - 3, F.lit(0))
    return each.select("doc_id", (c("i") + 1).alias("p"), F.array_join(F.slice("w", first + 1, c("i") + 3 - first), " ").alias("context"))


Q("txt_context_windows", f"SELECT doc_id, count(*) AS n, string_agg(context, ' | ' ORDER BY p) AS contexts FROM ({CTX}) GROUP BY doc_id")(
    lambda s, d: contexts(s, d).groupBy("doc_id").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "context"))), lambda x: x["context"]), " | ").alias("contexts"))
)
Q("nearest_key_tolerance", "SELECT l_suppkey, min_by(l_quantity, (abs(l_discount - 0.05), l_quantity)) FILTER (abs(l_discount - 0.05) <= 0.011) AS l_quantity FROM lineitem GROUP BY l_suppkey")(lambda s, d: L.nearest_key(T.read(s, d, "lineitem"), "l_discount", F.lit(0.05), "l_quantity", "l_suppkey", tolerance=0.011))
# Aliases are the beginnings, of four lengths, of large parts' names; which length counts first is not the order of the lengths.
ALIASES = "SELECT DISTINCT 7 * n % 11 AS ord, substr(p_name, 1, n) AS prefix, upper(substr(p_name, 1, n)) || n AS label FROM part, (VALUES (3), (5), (8), (11)) l(n) WHERE p_size > 35"


@Q("prefix_join_first", f"SELECT p_partkey, p_name, (SELECT min_by(label, (ord, length(prefix), label)) FROM ({ALIASES}) WHERE starts_with(p_name, prefix)) AS label FROM part")
def prefix_join_first(s, d):
    part, n = T.read(s, d, "part"), F.explode(F.array(*map(F.lit, (3, 5, 8, 11)))).alias("n")
    prefix = F.expr("substring(p_name, 1, n)")
    aliases = part.where("p_size > 35").select("p_name", n).select((7 * c("n") % 11).alias("ord"), prefix.alias("prefix"), F.concat(F.upper(prefix), "n").alias("label")).distinct()
    return L.prefix_first(part.select("p_partkey", "p_name"), aliases, "p_name")


# Aggregations
Q("agg_global_summary", sql("SELECT count(DISTINCT isin) AS funds, count(*) AS n, min(value) AS low, max(value) AS high FROM metrics", "metrics"))(lambda s, d: metrics(s, d).agg(F.count_distinct("isin").alias("funds"), F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")))
Q("agg_by_horizon", sql("SELECT horizon, count(DISTINCT isin) AS funds, count(*) AS n FROM (SELECT * FROM nav JOIN windows ON date BETWEEN start AND stop QUALIFY count(*) OVER (PARTITION BY isin, horizon) >= 12) GROUP BY horizon", "nav", "windows"))(lambda s, d: P.in_windows(T.nav(s, d), T.windows(s)).groupBy("horizon").agg(F.count_distinct("isin").alias("funds"), F.count("*").alias("n")))
Q("agg_metric_coverage", sql("SELECT metric, count(*) AS n, round(avg(value), 5) AS mean, min(value) AS low, max(value) AS high FROM metrics GROUP BY metric", "metrics"))(lambda s, d: metrics(s, d).groupBy("metric").agg(F.count("*").alias("n"), F.round(F.avg("value"), 5).alias("mean"), F.min("value").alias("low"), F.max("value").alias("high")))
Q("agg_conditional_counts", sql("SELECT nature, count(*) FILTER (srri <= 2) AS low, count(*) FILTER (srri > 5) AS high, count(*) FILTER (hedging IS NULL) AS unhedged FROM master GROUP BY nature", "master"))(lambda s, d: T.master(s, d).groupBy("nature").agg(F.count_if(c("srri") <= 2).alias("low"), F.count_if(c("srri") > 5).alias("high"), F.count_if(c("hedging").isNull()).alias("unhedged")))
Q("agg_having", sql("SELECT manager, count(*) AS n FROM master GROUP BY manager HAVING count(*) >= 4", "master"))(lambda s, d: T.master(s, d).groupBy("manager").agg(F.count("*").alias("n")).where("n >= 4"))
Q("agg_concat_distinct", sql("SELECT manager, string_agg(DISTINCT nature, ',' ORDER BY nature) AS natures, string_agg(DISTINCT currency, ',' ORDER BY currency) AS currencies FROM master GROUP BY manager", "master"))(lambda s, d: T.master(s, d).groupBy("manager").agg(*[F.array_join(F.array_sort(F.collect_set(x)), ",").alias(n) for x, n in (("nature", "natures"), ("currency", "currencies"))]))
Q("agg_two_level", sql("SELECT n, count(*) AS families FROM (SELECT family_id, count(*) AS n FROM master GROUP BY family_id) GROUP BY n", "master"))(lambda s, d: T.master(s, d).groupBy("family_id").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("families")))
PCT = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
Q("agg_percentiles_exact", "SELECT p::DOUBLE AS p, n_chars AS value FROM (SELECT n_chars, row_number() OVER (ORDER BY n_chars, doc_id) AS k, count(*) OVER () AS n FROM documents) JOIN (SELECT unnest([" + ", ".join(map(str, PCT)) + "]) AS p) ON k = floor(n * p::DOUBLE) + 1")(
    lambda s, d: percentiles(T.read(s, d, "documents"))
)


def percentiles(docs):
    """Nearest-rank values: counts per value, cumulated, so that no task sorts all rows."""
    hist = docs.groupBy("n_chars").agg(F.count("*").alias("k"))
    all_rows = Window.partitionBy(F.lit(0)).orderBy("n_chars")  # one row per distinct length
    cum = hist.select("n_chars", F.sum("k").over(all_rows.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("k").over(Window.partitionBy(F.lit(0))).alias("n"))
    each = cum.select("*", F.explode(F.array(*map(F.lit, PCT))).alias("p")).where(c("upto") >= F.floor(c("n") * c("p")) + 1)
    return each.groupBy("p").agg(F.min("n_chars").alias("value"))


Q("agg_quantile_interp", sql("SELECT nature, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.75), 6) AS p75 FROM metrics JOIN master USING (isin) WHERE metric = 'ret' GROUP BY nature", "metrics", "master"))(lambda s, d: metrics(s, d).where("metric = 'ret'").join(T.master(s, d), "isin").groupBy("nature").agg(F.round(F.percentile("value", F.lit(0.25)), 6).alias("p25"), F.round(F.percentile("value", F.lit(0.75)), 6).alias("p75")))


def all_rows():
    """One partition: only for grouped results."""
    return Window.partitionBy(F.lit(0))


Q("agg_share_of_total", sql("SELECT nature, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 5) AS pct FROM master GROUP BY nature", "master"))(lambda s, d: T.master(s, d).groupBy("nature").agg(F.count("*").alias("n")).withColumn("pct", F.round(100 * c("n") / F.sum("n").over(all_rows()), 5)))
Q("agg_crosstab_shares", sql("SELECT nature, currency, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 5) AS pct, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY nature), 5) AS of_nature, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY currency), 5) AS of_currency FROM master GROUP BY nature, currency", "master"))(
    lambda s, d: T.master(s, d).groupBy("nature", "currency").agg(F.count("*").alias("n")).select("nature", "currency", "n", *[F.round(100 * c("n") / F.sum("n").over(w), 5).alias(a) for w, a in ((all_rows(), "pct"), (Window.partitionBy("nature"), "of_nature"), (Window.partitionBy("currency"), "of_currency"))])
)
Q("agg_null_ratio_profile", sql(" SELECT field, filled, round(1 - filled / n, 6) AS null_ratio FROM (SELECT count(*) AS n, count(hedging) AS hedging, count(nature) AS nature FROM master) UNPIVOT (filled FOR field IN (hedging, nature))", "master"))(lambda s, d: L.null_profile(T.master(s, d), ["hedging", "nature"]).withColumn("null_ratio", F.round("null_ratio", 6)))
Q("agg_value_distribution", sql("SELECT field, value, count(*) AS n FROM (SELECT nature, currency FROM master) UNPIVOT (value FOR field IN (nature, currency)) GROUP BY ALL", "master"))(lambda s, d: T.master(s, d).unpivot("isin", ["nature", "currency"], "field", "value").groupBy("field", "value").agg(F.count("*").alias("n")))
Q("agg_median_classify", sql("SELECT indicator, geography, round(median(value) + 1e-9, 4) AS median, median(value) > 1000 AS is_level FROM macro GROUP BY ALL", "macro"))(lambda s, d: T.macro(s, d).groupBy("indicator", "geography").agg(F.round(F.median("value") + 1e-9, 4).alias("median"), (F.median("value") > 1000).alias("is_level")))
Q("agg_pivot_last", sql("SELECT date, max_by(value, geography) FILTER (indicator = 'ipc_index') AS ipc_index, max_by(value, geography) FILTER (indicator = 'm2_level') AS m2_level FROM macro WHERE indicator IN ('ipc_index', 'm2_level') GROUP BY date", "macro"))(lambda s, d: T.macro(s, d).groupBy("date").pivot("indicator", ["ipc_index", "m2_level"]).agg(F.max_by("value", "geography")).where("ipc_index is not null or m2_level is not null"))
Q("agg_resample_last", "SELECT o_custkey, last_day(o_orderdate) AS date, max_by(o_totalprice, (o_orderdate, o_orderkey)) AS price FROM orders GROUP BY ALL")(lambda s, d: T.read(s, d, "orders").groupBy("o_custkey", F.last_day("o_orderdate").alias("date")).agg(F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("price")))
Q("agg_resample_mean", "SELECT o_orderpriority, last_day(o_orderdate) AS date, round(avg(o_totalprice), 4) AS price FROM orders GROUP BY ALL")(lambda s, d: T.read(s, d, "orders").groupBy("o_orderpriority", F.last_day("o_orderdate").alias("date")).agg(F.round(F.avg("o_totalprice"), 4).alias("price")))
Q("agg_latest_value", sql("SELECT indicator, geography, max(value) FILTER (k = 1) AS latest, max(value) FILTER (k = 13) AS back FROM (SELECT *, row_number() OVER (PARTITION BY indicator, geography ORDER BY date DESC) AS k FROM macro) WHERE k IN (1, 13) GROUP BY ALL", "macro"))(
    lambda s, d: T.macro(s, d).withColumn("k", F.row_number().over(Window.partitionBy("indicator", "geography").orderBy(F.desc("date")))).where("k in (1, 13)").groupBy("indicator", "geography").agg(F.max(F.when(c("k") == 1, c("value"))).alias("latest"), F.max(F.when(c("k") == 13, c("value"))).alias("back"))
)

# Top-k, sampling, sets
Q("topk_global", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")(lambda s, d: T.read(s, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25))
Q("sort_multi_nulls", sql("SELECT isin, hedging, size FROM master ORDER BY hedging NULLS FIRST, size DESC, isin LIMIT 30", "master"))(lambda s, d: T.master(s, d).select("isin", "hedging", "size").orderBy(F.asc_nulls_first("hedging"), F.desc("size"), "isin").limit(30))
Q("sample_n")(lambda s, d: T.master(s, d).orderBy(F.xxhash64("isin", F.lit(7)), "isin").limit(20))
Q("set_union_all", sql("SELECT 'no_hedging' AS label, count(*) FILTER (hedging IS NULL) AS n FROM master UNION ALL SELECT 'high_risk', count(*) FILTER (srri = 7) FROM master", "master"))(lambda s, d: L.rule_counts(T.master(s, d), {"no_hedging": c("hedging").isNull(), "high_risk": c("srri") == 7}).withColumnRenamed("rule", "label"))
Q("set_difference", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")(lambda s, d: T.read(s, d, "documents").select("doc_id").exceptAll(T.read(s, d, "labels").select("doc_id")).distinct())
Q("set_universe", "((SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) EXCEPT (SELECT doc_id FROM labels WHERE toxic = 1)) UNION ((SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels WHERE quality = 0) EXCEPT (SELECT doc_id FROM labels WHERE toxic = 1))")(lambda s, d: universe(s, d))


def universe(s, d):
    every, labels = T.read(s, d, "documents").select("doc_id"), T.read(s, d, "labels")
    bad = labels.where("toxic = 1").select("doc_id")
    fresh = every.subtract(labels.select("doc_id")).subtract(bad)
    return fresh.union(every.intersect(labels.where("quality = 0").select("doc_id")).subtract(bad)).distinct()


# Scalar functions
Q("fn_string", "SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, p_name LIKE '%ring%' AS ring, substr(p_name, 2, 4) AS part, replace(p_name, 'e', 'E') AS swapped, length(p_name) AS n, instr(p_name, ' ') AS at, trim(' ' || p_name || ' ') AS trimmed, upper(array_to_string(string_split(p_name || ' ' || p_brand || ' ' || p_type, ' ')[1:3], ' ')) AS three FROM part")(
    lambda s, d: T.read(s, d, "part").select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"), c("p_name").like("%ring%").alias("ring"), F.substring("p_name", 2, 4).alias("part"), F.replace("p_name", F.lit("e"), F.lit("E")).alias("swapped"),
        F.length("p_name").cast("long").alias("n"), F.instr("p_name", " ").cast("long").alias("at"), F.trim(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("trimmed"), F.upper(F.array_join(F.slice(F.split(F.concat_ws(" ", "p_name", "p_brand", "p_type"), " "), 1, 3), " ")).alias("three"),
    )
)
Q("fn_regex", "SELECT doc_id, regexp_matches(text, '[0-9]{4}') AS has_number, regexp_extract(text, '([a-z]+)@', 1) AS who, len(regexp_extract_all(text, '[A-Z][a-z]+')) AS capitals, regexp_replace(text, '[^a-zA-Z]+', '_', 'g') AS cleaned FROM documents")(
    lambda s, d: T.read(s, d, "documents").select("doc_id", c("text").rlike("[0-9]{4}").alias("has_number"), F.regexp_extract("text", "([a-z]+)@", 1).alias("who"), F.size(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0))).cast("long").alias("capitals"), F.regexp_replace("text", "[^a-zA-Z]+", "_").alias("cleaned"))
)
Q("fn_date", "SELECT o_orderkey, last_day(o_orderdate) AS month_end, CAST(last_day(o_orderdate) + INTERVAL 3 MONTH AS DATE) AS later, CAST(strptime(strftime(o_orderdate, '%Y-%m') || '-01', '%Y-%m-%d') AS DATE) AS parsed, CAST(make_date(year(o_orderdate), quarter(o_orderdate) * 3 - 2, 1) AS DATE) AS quarter_start, date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS age FROM orders")(
    lambda s, d: T.read(s, d, "orders").select(
        "o_orderkey", F.last_day("o_orderdate").alias("month_end"), F.add_months(F.last_day("o_orderdate"), 3).alias("later"), F.to_date(F.date_format("o_orderdate", "yyyy-MM"), "yyyy-MM").alias("parsed"), F.make_date(F.year("o_orderdate"), F.quarter("o_orderdate") * 3 - 2, F.lit(1)).alias("quarter_start"), F.datediff(F.lit("2002-01-01"), c("o_orderdate").cast("date")).cast("long").alias("age"),
    )
)
Q("fn_math", "SELECT c_custkey, round(sqrt(abs(c_acctbal)), 6) AS root, round(pow(c_acctbal / 1000, 2), 6) AS sq, round(ln(abs(c_acctbal) + 1), 6) AS l, greatest(-5, least(5, c_acctbal / 1000)) AS clamped, abs(c_acctbal - 5000) <= greatest(0.1 * greatest(abs(c_acctbal), 5000), 100) AS close FROM customer")(
    lambda s, d: T.read(s, d, "customer").select("c_custkey", F.round(F.sqrt(F.abs("c_acctbal")), 6).alias("root"), F.round(F.pow(c("c_acctbal") / 1000, 2), 6).alias("sq"), F.round(F.log(F.abs("c_acctbal") + 1), 6).alias("l"), F.greatest(F.lit(-5.0), F.least(F.lit(5.0), c("c_acctbal") / 1000)).alias("clamped"), (F.abs(c("c_acctbal") - 5000) <= F.greatest(0.1 * F.greatest(F.abs("c_acctbal"), F.lit(5000)), F.lit(100))).alias("close"))
)
Q("fn_null", sql("SELECT isin, coalesce(hedging, 'None') AS hedging, nullif(currency, 'EUR') AS foreign_currency, CASE WHEN srri = 7 THEN NULL ELSE srri END AS srri FROM master", "master"))(
    lambda s, d: T.master(s, d).select("isin", F.coalesce("hedging", F.lit("None")).alias("hedging"), F.nullif("currency", F.lit("EUR")).alias("foreign_currency"), F.when(c("srri") != 7, c("srri")).alias("srri"))
)
