"""Queries over families, reconciliation and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import panel as P, quality as D, relational as L
from ..sources import tables as T
from ..sources.files import stored
from .registry import query as Q
from .sqlbase import sql
from .text_queries import NAMES, names

c = F.col
docs = lambda s, d: T.read(s, d, "documents")
labels = lambda s, d: T.read(s, d, "labels")
FAM = "lower(name)"
for _ in range(10):
    FAM = f"regexp_replace({FAM}, '\\s+(acc|dist|inc|income|hedged|h|a|b|c|i|r|a2|eur|usd|gbp)$', '')"
FAM = f"trim({FAM})"
Q("family_normalize_name", f"SELECT id, {FAM} AS family_name FROM ({NAMES})")(lambda s, d: names(s, d).select("id", D.family_name(c("name")).alias("family_name")))
Q("family_assign", f"SELECT id, 'FAM_' || lpad(CAST(dense_rank() OVER (ORDER BY m, f) AS VARCHAR), 6, '0') AS family FROM (SELECT id, 'm' || (id % 3) AS m, {FAM} AS f FROM ({NAMES}))")(lambda s, d: D.families(names(s, d).withColumn("manager", F.concat(F.lit("M"), c("id") % 3)), c("manager"), "name").select("id", "family"))
NATURE_SQL = """, m AS (SELECT CASE WHEN isin < 40 THEN isin // 2 ELSE 1000 + isin // 5 END AS fam, CASE WHEN isin % 4 = 1 THEN 'Restantes' ELSE nature END AS nature, isin % 17 = 0 AS sign, ['OK', 'WARN', 'MISSING'][isin % 3 + 1] AS dq, (['HIGH', 'MEDIUM_TEXT', 'NONE', NULL, 'LOW_CONFLICT'])[isin % 5 + 1] AS rq FROM master),
e AS (SELECT fam, nature, count(*) AS k, count(*) FILTER (dq = 'OK' AND rq IS NOT NULL AND rq <> 'NONE') AS sound, sum(CASE rq WHEN 'HIGH' THEN 4 WHEN 'MEDIUM_TEXT' THEN 3 WHEN 'MEDIUM_VISUAL' THEN 2 WHEN 'LOW_CONFLICT' THEN 1 ELSE 0 END) AS risk,
 sum(CASE dq WHEN 'OK' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END) AS data, count(*) FILTER (dq = 'OK') AS ok, count(*) FILTER (dq <> 'OK') AS weak, bool_or(sign) AS sign FROM m GROUP BY ALL),
f AS (SELECT fam, string_agg(nature, ',' ORDER BY nature) AS natures, sum(k) AS members, sum(sound) AS all_sound, bool_or(sign) AS sign, count(*) AS kinds, bool_or(nature = 'Restantes') AS none FROM e GROUP BY fam HAVING count(*) > 1),
t AS (SELECT fam, nature AS tn, k AS tk, sound AS ts FROM e QUALIFY row_number() OVER (PARTITION BY fam ORDER BY k DESC, nature) = 1),
p AS (SELECT a.fam, CASE WHEN b.nature = 'Restantes' THEN a.nature WHEN a.nature = 'Restantes' THEN b.nature WHEN a.ok = 1 AND b.weak = 1 THEN a.nature WHEN b.ok = 1 AND a.weak = 1 THEN b.nature WHEN a.risk >= 2 AND b.risk = 0 THEN a.nature WHEN b.risk >= 2 AND a.risk = 0 THEN b.nature END AS pn
 FROM e a JOIN e b ON a.fam = b.fam AND a.nature < b.nature JOIN f ON f.fam = a.fam WHERE members = 2 AND kinds = 2),
l AS (SELECT fam, nature AS ln, risk AS lr FROM e WHERE nature <> 'Restantes' QUALIFY row_number() OVER (PARTITION BY fam ORDER BY risk DESC, nature) = 1),
lo AS (SELECT fam, max(risk) AS other FROM e JOIN l USING (fam) WHERE nature <> ln GROUP BY fam),
g AS (SELECT fam, nature AS gn, data AS gd FROM e QUALIFY row_number() OVER (PARTITION BY fam ORDER BY data DESC, nature) = 1),
go AS (SELECT fam, max(data) AS gother FROM e JOIN g USING (fam) WHERE nature <> gn GROUP BY fam)
SELECT fam AS family_id, natures, CASE WHEN sign THEN NULL WHEN 3 * tk >= 2 * members AND all_sound = ts THEN tn WHEN pn IS NOT NULL THEN pn
 WHEN none OR natures IN ('Mixtos,Renta Variable', 'Mixtos,Renta Fija Flexible', 'Mixtos,Renta Fija Corto Plazo', 'Renta Fija Corto Plazo,Renta Fija Flexible', 'Monetario,Renta Fija Corto Plazo', 'Alternativo,Renta Variable', 'Monetario,Renta Variable')
 THEN CASE WHEN lr - other > 2 OR (lr - other >= 0 AND gn = ln AND gd - gother >= 1) OR (none AND kinds = 2) THEN ln END END AS resolved
FROM f JOIN t USING (fam) LEFT JOIN p USING (fam) LEFT JOIN l USING (fam) LEFT JOIN lo USING (fam) LEFT JOIN g USING (fam) LEFT JOIN go USING (fam)"""


@Q("family_nature_resolve", sql(NATURE_SQL, "master"))
def family_nature_resolve(s, d):
    k = c("isin")
    nth = lambda values: F.get(F.array(*[F.lit(v).cast("string") for v in values]), (k % len(values)).cast("int"))
    funds = T.master(s, d).select(
        F.when(k < 40, F.floor(k / 2)).otherwise(1000 + F.floor(k / 5)).alias("family_id"), F.when(k % 17 == 0, F.concat(F.lit("Hedged "), "fund_name")).otherwise(c("fund_name")).alias("fund_name"),
        F.when(k % 4 == 1, "Restantes").otherwise(c("nature")).alias("nature"), nth(["OK", "WARN", "MISSING"]).alias("data_quality"), nth(["HIGH", "MEDIUM_TEXT", "NONE", None, "LOW_CONFLICT"]).alias("risk_quality"),
    )
    return D.family_natures(funds)


Q("family_inconsistent", sql("SELECT currency AS family_id, string_agg(DISTINCT nature, ',' ORDER BY nature) AS natures FROM master GROUP BY currency HAVING count(DISTINCT nature) > 1", "master"))(lambda s, d: D.inconsistent(T.master(s, d).withColumn("family_id", c("currency")), "family_id", "nature").select("family_id", "natures"))
Q("source_reconcile_pair", "SELECT doc_id, CASE WHEN a IS NULL AND b IS NULL THEN 'NONE' WHEN b IS NULL THEN 'ONLY_A' WHEN a IS NULL THEN 'ONLY_B' WHEN a = b THEN 'MATCH' ELSE 'CONFLICT' END AS status FROM (SELECT d.doc_id, CASE WHEN d.doc_id % 3 <> 0 THEN CAST(NOT contains(text, '!!') AS INTEGER) END AS a, quality AS b FROM documents d LEFT JOIN labels l USING (doc_id))")(
    lambda s, d: docs(s, d).join(labels(s, d), "doc_id", "left").select("doc_id", D.reconcile(F.when(c("doc_id") % 3 != 0, (~c("text").contains("!!")).cast("int")), c("quality")).alias("status"))
)
V = "SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 5 <> 0 THEN l_discount END AS a, CASE WHEN l_orderkey % 7 <> 0 THEN l_tax END AS b FROM lineitem"
Q("cost_verdict", f"SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN a IS NULL AND b IS NULL THEN 'BOTH_FAIL' WHEN b IS NULL THEN 'ONLY_A' WHEN a IS NULL THEN 'ONLY_B' WHEN abs(a - b) <= greatest(0.015, 0.05 * greatest(abs(a), abs(b))) THEN 'AGREE' ELSE 'CONFLICT' END AS verdict FROM ({V})) GROUP BY verdict")(
    lambda s, d: T.read(s, d, "lineitem").select(F.when(c("l_orderkey") % 5 != 0, c("l_discount")).alias("a"), F.when(c("l_orderkey") % 7 != 0, c("l_tax")).alias("b")).groupBy(D.cost_verdict(c("a"), c("b"), absolute=0.015).alias("verdict")).agg(F.count("*").alias("n"))
)
CV = "SELECT p_partkey, p_size / 10.0 AS pct, CASE WHEN p_partkey % 5 <> 0 THEN p_size * 10.0 + p_partkey % 60 END AS amount FROM part"
Q("cross_validate_pct_amount", f"SELECT p_partkey, CASE WHEN amount IS NULL THEN 'SINGLE' WHEN bp <= 5 THEN 'OK' WHEN bp <= 50 THEN 'MILD' ELSE 'VOID' END AS status, CASE WHEN bp IS NULL OR bp <= 50 THEN pct END AS value, bp FROM (SELECT *, round(abs(pct - amount / 10000 * 100) * 100, 4) AS bp FROM ({CV}))")(
    lambda s, d: T.read(s, d, "part").select("p_partkey", D.cross_validate(c("p_size") / 10, F.when(c("p_partkey") % 5 != 0, c("p_size") * 10.0 + c("p_partkey") % 60)).alias("v")).select("p_partkey", "v.*")
)
BK = "CASE WHEN n < 14 OR vol IS NULL THEN 0 WHEN vol >= 0.25 THEN 7 WHEN vol >= 0.15 THEN 6 WHEN vol >= 0.10 THEN 5 WHEN vol >= 0.05 THEN 4 WHEN vol >= 0.02 THEN 3 WHEN vol >= 0.005 THEN 2 ELSE 1 END"
Q("srri_declared_vs_calc", sql(f"SELECT srri, calculated, count(*) AS n, count(*) FILTER (abs(srri - calculated) >= 3) AS far FROM (SELECT srri, {BK} AS calculated FROM rk JOIN master USING (isin)) GROUP BY ALL", "rk", "master"))(
    lambda s, d: P.risk_measures(T.nav(s, d)).join(T.master(s, d), "isin").groupBy("srri", P.risk_bucket(c("vol"), c("n")).alias("calculated")).agg(F.count("*").alias("n"), F.count_if(F.abs(c("srri") - P.risk_bucket(c("vol"), c("n"))) >= 3).alias("far"))
)
# Written out: this SQL must not follow the code.
RULES = {
    "nature_singular": "nature = 'Mixto'", "broad_with_sector": "focus = 'Broad' AND sector IS NOT NULL", "hedging_contradicts": "hedged = 'Hedged' AND hedging = 'UNHEDGED' OR hedged = 'Unhedged' AND hedging = 'HEDGED'",
    "frequency_without_policy": "frequency IS NOT NULL AND accumulation IS NULL", "cash_without_universe": "nature IN ('Monetario', 'Renta Fija Corto Plazo') AND universe IS NULL", "credit_no_aplica": "credit = 'No aplica'",
    "credit_unknown": "credit NOT IN ('Investment Grade', 'High Yield', 'Mixed', 'Not Applicable')", "hedged_yes_no": "hedged IN ('Yes', 'No')", "charge_missing": "charge IS NULL", "charge_out_of_range": "charge < 0 OR charge > 10",
    "benchmark_long": "length(benchmark) > 100 AND benchmark <> 'NO_BENCHMARK'", "benchmark_spanish": "regexp_matches(benchmark, '(además|través|riesgo|corro|hemos|clasificado)') AND benchmark <> 'NO_BENCHMARK'",
    "srri_missing": "srri IS NULL", "srri_out_of_range": "srri < 1 OR srri > 7", "distribution_without_frequency": "accumulation = 'DISTRIBUTION' AND frequency IS NULL", "accumulation_with_frequency": "accumulation = 'ACCUMULATION' AND frequency IS NOT NULL",
    "passive_without_technique": "strategy IN ('Indexado', 'Pasivo') AND coalesce(replication NOT IN ('Physical', 'Synthetic', 'Sampling'), true)", "active_with_technique": "strategy = 'Activo' AND replication IN ('Physical', 'Synthetic', 'Sampling')",
    "sector_universe_without_sector": "universe = 'Sector' AND sector IS NULL", "regional_without_geography": "universe IN ('Regional', 'Country') AND geography IS NULL", "esg_article_6": "is_esg = 1 AND sfdr = 6", "equity_low_risk": "nature = 'Renta Variable' AND srri <= 2",
    "cash_high_risk": "nature = 'Monetario' AND srri >= 4", "conservative_leveraged": "profile = 'Conservador' AND leverage = 'YES'", "profile_missing": "profile IS NULL",
}
Q("dq_rules_report", sql(" UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER ({r}) AS n FROM attributes" for n, r in RULES.items()), "attributes"))(lambda s, d: L.rule_counts(T.attributes(s, d), D.quality_rules()))
FIRED = """[CASE WHEN strategy IN ('Indexado', 'Pasivo') AND coalesce(replication NOT IN ('Physical', 'Synthetic', 'Sampling'), true) THEN 'INTER-1 passive' END, CASE WHEN strategy = 'Activo' AND replication IS DISTINCT FROM 'Not Applicable' THEN 'INTER-1 active' END,
 CASE WHEN accumulation = 'ACCUMULATION' AND frequency IS NOT NULL THEN 'INTER-2 frequency' END, CASE WHEN accumulation = 'DISTRIBUTION' AND frequency IS NULL THEN 'INTER-2 missing' END, CASE WHEN accumulation IS NULL AND frequency IS NOT NULL THEN 'INTER-2 inferred' END,
 CASE WHEN profile = 'Conservador' AND srri >= 6 OR profile = 'Moderado' AND srri IN (1, 7) OR profile = 'Dinámico' AND srri <= 2 OR profile = 'Agresivo' AND srri <= 4 THEN 'INTER-3' END,
 CASE WHEN universe = 'Sector' AND sector IS NULL THEN 'INTER-6 sector' END, CASE WHEN universe IN ('Regional', 'Country') AND geography IS NULL THEN 'INTER-6 geography' END, CASE WHEN profile = 'Conservador' AND leverage = 'YES' THEN 'INTER-7' END, CASE WHEN is_esg = 1 AND sfdr = 6 THEN 'INTER-8' END,
 CASE WHEN universe = 'Country' AND geography = 'Europe' THEN 'INTER-10 region' END, CASE WHEN geography = 'Japan' AND universe = 'Global' THEN 'INTER-10 country' END, CASE WHEN geography = 'Global' AND universe IN ('Country', 'Regional') THEN 'INTER-10 global' END,
 CASE WHEN external_role <> 'hurdle_rate' AND external = 'Mixed' AND nature NOT IN ('Mixtos', 'Alternativo') THEN 'INTER-18 mixed' END,
 CASE WHEN external_role <> 'hurdle_rate' AND (nature = 'Renta Variable' AND external = 'Fixed Income' OR nature IN ('Renta Fija Flexible', 'Renta Fija Corto Plazo') AND external = 'Equity') THEN 'INTER-18 class' END,
 CASE WHEN theme = 'Water' AND sector <> 'Health' THEN 'INTER-9 Water' END, CASE WHEN theme = 'Robotics' AND sector <> 'Technology' THEN 'INTER-9 Robotics' END]"""


@Q("dq_semantic_rules", sql(f"""SELECT id, CASE WHEN strategy IN ('Indexado', 'Pasivo') AND coalesce(replication NOT IN ('Physical', 'Synthetic', 'Sampling'), true) THEN 'Physical' WHEN strategy = 'Activo' THEN 'Not Applicable' ELSE replication END AS replication,
 CASE WHEN accumulation = 'ACCUMULATION' THEN NULL ELSE frequency END AS frequency, CASE WHEN accumulation IS NULL AND frequency IS NOT NULL THEN 'DISTRIBUTION' ELSE accumulation END AS accumulation,
 CASE WHEN universe = 'Country' AND geography = 'Europe' THEN 'Regional' ELSE universe END AS universe, coalesce(array_to_string(list_filter({FIRED}, lambda x: x IS NOT NULL), ','), '') AS fired FROM attributes""", "attributes"))
def dq_semantic_rules(s, d):
    rules = D.consistency_rules(theme_sector={"Water": "Health", "Robotics": "Technology"})
    return D.semantic_rules(T.attributes(s, d), rules).select("id", "replication", "frequency", "accumulation", "universe", "fired")


VOCAB = [("nature", "Monetario"), ("nature", "Mixtos"), ("nature", "Renta Variable"), ("currency", "EUR"), ("currency", "USD")]
Q("dq_allowed_values", sql("SELECT isin, field, value FROM (SELECT isin, nature, currency FROM master) UNPIVOT (value FOR field IN (nature, currency)) WHERE (field, value) NOT IN (" + ", ".join(map(str, VOCAB)) + ")", "master"))(lambda s, d: D.outside_vocabulary(T.master(s, d), "isin", ["nature", "currency"], s.createDataFrame(VOCAB, "field string, value string")))
Q("dq_canonical_casing", "SELECT p_partkey, CASE upper(p_type) WHEN 'ECONOMY' THEN 'Economy' WHEN 'STANDARD' THEN 'Standard' WHEN 'PROMO' THEN 'Promotion' ELSE p_type END AS kind FROM part")(lambda s, d: T.read(s, d, "part").select("p_partkey", D.canonical(c("p_type"), ["Economy", "Standard"], {"PROMO": "Promotion"}).alias("kind")))
Q("dq_translate_values", "SELECT count(*) FILTER (p_type IN ('PROMO', 'ECONOMY')) AS changed, count(*) AS n FROM part")(lambda s, d: T.read(s, d, "part").select("p_type", D.canonical(c("p_type"), [], {"PROMO": "Promotion", "ECONOMY": "Eco"}).alias("k")).agg(F.count_if(c("p_type") != c("k")).alias("changed"), F.count("*").alias("n")))
Q("dq_range_checks", "SELECT c_custkey, rule FROM (SELECT c_custkey, unnest([CASE WHEN c_acctbal < 0 THEN 'negative' END, CASE WHEN c_acctbal > 9000 THEN 'large' END, CASE WHEN c_nationkey > 20 THEN 'nation' END]) AS rule FROM customer) WHERE rule IS NOT NULL")(lambda s, d: D.violations(T.read(s, d, "customer"), "c_custkey", {"negative": c("c_acctbal") < 0, "large": c("c_acctbal") > 9000, "nation": c("c_nationkey") > 20}))
Q("dq_schema_diff", "WITH e(field, t) AS (VALUES ('doc_id', 'BIGINT'), ('text', 'VARCHAR'), ('lang', 'INTEGER'), ('title', 'VARCHAR')), a AS (SELECT DISTINCT column_name AS field, data_type AS t FROM information_schema.columns WHERE table_name = 'documents') SELECT coalesce(e.field, a.field) AS field, CASE WHEN a.field IS NULL THEN 'missing' WHEN e.field IS NULL THEN 'extra' WHEN e.t = a.t THEN 'ok' ELSE 'type' END AS status FROM e FULL JOIN a ON e.field = a.field")(lambda s, d: D.schema_diff(docs(s, d), {"doc_id": "bigint", "text": "string", "lang": "int", "title": "string"}))
SC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
Q("dq_scale_audit", " UNION ALL ".join(f"SELECT '{x}' AS field, count({x}) AS n, min({x}) AS low, max({x}) AS high, round(avg({x}), 5) AS mean FROM lineitem" for x in SC))(lambda s, d: L.scale_profile(T.read(s, d, "lineitem"), SC).withColumn("mean", F.round("mean", 5)))
Q("dq_quality_mix", "SELECT lang, quality, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY lang), 5) AS pct FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang, quality")(lambda s, d: mix(s, d))


def mix(s, d):
    from pyspark.sql import Window

    g = docs(s, d).join(labels(s, d), "doc_id", "left").groupBy("lang", "quality").agg(F.count("*").alias("n"))
    return g.withColumn("pct", F.round(100 * c("n") / F.sum("n").over(Window.partitionBy("lang")), 5))


Q("dq_quality_flag", "SELECT doc_id, CASE quality WHEN 1 THEN 'OK' WHEN 0 THEN 'WARN' ELSE 'MISSING' END AS flag FROM documents LEFT JOIN labels USING (doc_id)")(lambda s, d: docs(s, d).join(labels(s, d), "doc_id", "left").select("doc_id", F.when(c("quality") == 1, "OK").when(c("quality") == 0, "WARN").otherwise("MISSING").alias("flag")))
Q("dq_refresh_candidates", sql("SELECT isin, max(date) AS last FROM nav GROUP BY isin HAVING max(date) < DATE '2001-12-01' ORDER BY last, isin LIMIT 25", "nav"))(lambda s, d: T.nav(s, d).groupBy("isin").agg(F.max("date").alias("last")).where("last < '2001-12-01'").orderBy(F.asc_nulls_first("last"), "isin").limit(25))
Q("dq_load_state", sql("SELECT isin, first, last, n, CASE WHEN n IS NULL THEN 'PENDING' ELSE 'LOADED' END AS status FROM master LEFT JOIN (SELECT isin, min(date) AS first, max(date) AS last, count(*) AS n FROM nav WHERE date < DATE '1995-03-15' GROUP BY isin) USING (isin)", "nav", "master"))(
    lambda s, d: T.master(s, d).select("isin").join(D.load_state(T.nav(s, d).where("date < '1995-03-15'"), "isin", "date"), "isin", "left").withColumn("status", F.when(c("n").isNull(), "PENDING").otherwise("LOADED"))
)
Q("dq_benchmark_gap", "SELECT CASE WHEN d.doc_id IS NULL THEN 'only_b' WHEN l.doc_id IS NULL THEN 'only_a' ELSE 'both' END AS status, count(*) AS n FROM documents d FULL JOIN (SELECT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY 1")(lambda s, d: D.gaps_between(docs(s, d), labels(s, d), "doc_id"))
RG = "SELECT doc_id, quality AS truth, CASE WHEN doc_id % 4 = 0 THEN 1 - quality ELSE quality END AS stored, CASE WHEN doc_id % 8 = 0 THEN quality WHEN doc_id % 12 = 4 THEN 1 - quality ELSE 0 END AS again FROM labels"
Q("dq_regrid_verdict", f"SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN stored = truth THEN 'OK' WHEN again = truth THEN 'FIXES' WHEN stored <> again THEN 'STALE' ELSE 'RESIDUAL' END AS verdict FROM ({RG})) GROUP BY verdict")(
    lambda s, d: labels(s, d).select(c("quality").alias("truth"), F.when(c("doc_id") % 4 == 0, 1 - c("quality")).otherwise(c("quality")).alias("stored"), F.when(c("doc_id") % 8 == 0, c("quality")).when(c("doc_id") % 12 == 4, 1 - c("quality")).otherwise(0).alias("again")).groupBy(D.verdict_after(c("truth"), c("stored"), c("again")).alias("verdict")).agg(F.count("*").alias("n"))
)
Q("dq_roi_segments", "SELECT n_name, count(*) AS suppliers, count(*) FILTER (s_acctbal > 5000) AS rich FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")(lambda s, d: T.read(s, d, "supplier").join(F.broadcast(T.read(s, d, "nation")), c("s_nationkey") == c("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("suppliers"), F.count_if(c("s_acctbal") > 5000).alias("rich")))  # 25 nations
Q("dq_latency_profile", "SELECT event_type, CASE WHEN value < 5 THEN 'fast' WHEN value < 20 THEN 'fair' ELSE 'slow' END AS bucket, count(*) AS n, max(value) AS slowest FROM events GROUP BY ALL")(lambda s, d: T.read(s, d, "events").groupBy("event_type", F.when(c("value") < 5, "fast").when(c("value") < 20, "fair").otherwise("slow").alias("bucket")).agg(F.count("*").alias("n"), F.max("value").alias("slowest")))
@Q("dq_copy_validate", "SELECT 'orders' AS tbl, (SELECT count(*) FROM orders) AS source, (SELECT count(*) FROM orders) AS target, (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS orphans")
def dq_copy_validate(s, d):
    orders = T.read(s, d, "orders")
    return D.validate_copy("orders", orders, stored(orders, "copy"), "o_orderkey", T.read(s, d, "lineitem"), "l_orderkey")
