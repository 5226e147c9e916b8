"""Queries over document text, templated names, cost grids and benchmark phrases."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify as L, costs as K, dictionary as D, evidence as E, text as X
from ..sources import tables as T
from .registry import query as Q

c = F.col
NAMES = "SELECT p_partkey AS id, p_brand || ' ' || p_name || ' ' || (['Acc EUR', 'Dist USD H', 'A2 EUR Hedged', 'Income B'])[p_partkey % 4 + 1] AS name, p_size, p_retailprice FROM part"


def part_rows(s, d):
    """Texts are made of short rows, so that all tasks have to get some."""
    return T.spread(T.read(s, d, "part"))


def names(s, d):
    share = F.get(F.array(*map(F.lit, ("Acc EUR", "Dist USD H", "A2 EUR Hedged", "Income B"))), (c("p_partkey") % 4).cast("int"))
    return part_rows(s, d).select(c("p_partkey").alias("id"), F.concat_ws(" ", "p_brand", "p_name", share).alias("name"), "p_size", "p_retailprice")


def docs(s, d):
    return T.read(s, d, "documents")


# Signals taken from the documents themselves: words of 8 to 12 plain letters that occur in 5 or more of them, the most frequent first.
SIGNALS = """SELECT -count(DISTINCT doc_id) AS ord, signal, min(lang) AS label FROM (SELECT doc_id, lang, unnest(regexp_extract_all(text, '[a-z]{8,}')) AS signal FROM documents)
 WHERE length(signal) <= 12 GROUP BY signal HAVING count(DISTINCT doc_id) >= 5"""


def signals(s, d):
    words = docs(s, d).select("doc_id", "lang", F.explode(F.regexp_extract_all("text", F.lit("[a-z]{8,}"), F.lit(0))).alias("signal")).where(F.length("signal") <= 12)
    return words.groupBy("signal").agg((-F.count_distinct("doc_id")).alias("ord"), F.min("lang").alias("label")).where("ord <= -5").select("ord", "signal", "label")


@Q(
    "txt_signal_first_match",
    f"""WITH s AS ({SIGNALS}), m AS (SELECT doc_id, min((ord, signal, label, instr(text, signal))) AS m FROM documents JOIN s ON contains(text, signal) GROUP BY doc_id)
 SELECT doc_id, m[1] AS ord, m[2] AS signal, m[3] AS label, m[4]::INTEGER AS at FROM documents LEFT JOIN m USING (doc_id)""",
)
def signal_first_match(s, d):
    return D.match_signals(docs(s, d).select("doc_id", "text"), "text", signals(s, d)).select("doc_id", "match.ord", "match.signal", "match.label", "match.at")


Q("txt_window_by_format", "SELECT doc_id, CASE WHEN contains(substr(text, 1, 600), ' | ') THEN substr(text, 1, 100) WHEN contains(substr(text, 1, 600), '!!') THEN substr(text, 50, 200) ELSE substr(text, 1, 1000) END AS part FROM documents")(lambda s, d: docs(s, d).select("doc_id", X.window_by_format(c("text"), [("table", " | ", 1, 100), ("loud", "!!", 50, 200)]).alias("part")))
HIT = lambda *p: " + ".join(f"CAST(regexp_matches(text, '{x}') AS INTEGER)" for x in p)
R1, R2 = ["the ", " of ", "ing"], [" de ", " la ", "tion"]
Q("txt_format_router", f"SELECT doc_id, CASE WHEN {HIT(*R1)} >= 2 AND {HIT(*R1)} >= {HIT(*R2)} THEN 'FIRST' WHEN {HIT(*R2)} >= 2 THEN 'SECOND' ELSE 'UNKNOWN' END AS route FROM documents")(lambda s, d: docs(s, d).select("doc_id", X.route(c("text"), R1, R2).alias("route")))
CUR = "SELECT id, 'Inversion 10.000 ' || (['EUR', 'USD', 'GBP'])[id % 3 + 1] || ' en ' || p_size || ' meses' AS t FROM (" + NAMES + ")"
cur = lambda s, d: names(s, d).select("id", F.concat(F.lit("Inversion 10.000 "), F.get(F.array(*map(F.lit, ("EUR", "USD", "GBP"))), (c("id") % 3).cast("int")), F.lit(" en "), "p_size", F.lit(" meses")).alias("t"))
Q("txt_currency_detect", f"SELECT id, regexp_extract(t, '10\\.000\\s*(EUR|USD|GBP)', 1) AS currency FROM ({CUR})")(lambda s, d: cur(s, d).select("id", F.regexp_extract("t", r"10\.000\s*(EUR|USD|GBP)", 1).alias("currency")))
MARKERS = {"en": ["the", "and", "of"], "fr": ["les", "des", "un"], "de": ["und", "der", "die"], "es": ["los", "las", "que"]}
_hits = lambda words: " + ".join(f"CAST(regexp_matches(lower(text), '(^|[^\\p{{L}}]){w}([^\\p{{L}}]|$)') AS INTEGER)" for w in words)
# Markers of texts whose words run together.
FUSED = {
    "es": ["documentodedatos", "informacionfundamental", "perfilderiesgo", "elfondo", "rentabilidad", "productodeinversion"],
    "en": ["keyinformation", "fundamentalinformation", "riskprofile", "thefund"],
}
_marks = lambda t: " ".join("WHEN " + " + ".join(f"CAST(regexp_matches({t}, '(^|[^\\p{{L}}]){w}([^\\p{{L}}]|$)') AS INTEGER)" for w in words) + f" >= 2 THEN '{k}'" for k, words in MARKERS.items())
_BARE = "regexp_replace(strip_accents(lower(text)), '[ \\n\\r]', '', 'g')"
_joined = " ".join("WHEN " + " + ".join(f"CAST(contains({_BARE}, '{w}') AS INTEGER)" for w in words) + f" >= 2 THEN '{k}'" for k, words in FUSED.items())
Q("txt_language_detect", f"SELECT doc_id, CASE {_marks('lower(text)')} {_marks('strip_accents(lower(text))')} {_joined} END AS found FROM documents")(
    lambda s, d: docs(s, d).select("doc_id", X.language(c("text"), MARKERS, FUSED).alias("found"))
)
# Each text of an order has another date before, the published one (in one of three languages, by number or by month name),
# one in the next sentence, and a second word for publication without a date.
DATES = """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE o_orderdate END AS published FROM orders"""


@Q("txt_published_date", DATES)
def published(s, d):
    k, date = c("o_orderkey") % 4, c("o_orderdate")
    month = lambda code: F.get(F.array(*map(F.lit, E.MONTHS[code])), F.month(date) - 1)
    parts = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in p])
    day = F.dayofmonth(date)
    text = (
        F.when(k == 0, parts("Fund of 01/01/1990. This text was PUBLISHED on ", day, " ", month("EN"), " ", F.year(date), ". Prices of 02/02/1991. It is updated yearly."))
        .when(k == 1, parts("Datos a 01/01/1990. Este documento se publicó el ", day, " de ", month("ES"), " de ", F.year(date), " en\nMadrid. Inicio: 02/02/1991."))
        .when(k == 2, parts("Créé le 01/01/1990. Date de publication ", F.date_format(date, "dd/MM/yyyy"), ", cours du 02/02/1991."))
        .otherwise("Founded on 31/02/1990 and published on 30/02/1991. Then 01/01/1992.")
    )
    language = F.get(F.array(*map(F.lit, ("EN", "ES", "FR", "EN"))), k.cast("int"))
    return T.read(s, d, "orders").select("o_orderkey", E.published_date(text, language).alias("published"))


# Texts of seven kinds by id: run together, declared, declared twice, stated, stated twice, near a word, and none; the class
# drawn is told for four of five parts.
RISK = """SELECT p_partkey AS id, p_partkey % 7 AS kind, p_size % 7 + 1 AS x, p_partkey % 3 + 1 AS y, CASE WHEN p_partkey % 5 > 0 THEN p_partkey % 4 + 1 END AS drawn FROM part"""
TOLD = f"""SELECT *, CASE WHEN kind IN (0, 1, 3, 5) OR kind IN (2, 4) AND x = y THEN x END AS risk,
 CASE kind WHEN 0 THEN 'L0_FUSED' WHEN 1 THEN 'L0' WHEN 2 THEN CASE WHEN x = y THEN 'L0' ELSE 'L0_CONFLICT' END WHEN 3 THEN 'L1' WHEN 4 THEN CASE WHEN x = y THEN 'L1' ELSE 'L1_CONFLICT' END WHEN 5 THEN 'L2' END AS level FROM ({RISK})"""


@Q(
    "txt_risk_class",
    f"""SELECT id, risk, level, CASE WHEN drawn IS NULL AND risk IS NULL THEN 'NONE' WHEN drawn IS NULL THEN 'MEDIUM_TEXT' WHEN risk IS NULL THEN 'MEDIUM_VISUAL' WHEN drawn = risk THEN 'HIGH'
 WHEN drawn = 1 AND level IN ('L0', 'L0_FUSED') THEN 'MEDIUM_TEXT' ELSE 'LOW_CONFLICT' END AS quality FROM ({TOLD})""",
)
def risk_classes(s, d):
    x, y, kind = (c("p_size") % 7 + 1).cast("string"), (c("p_partkey") % 3 + 1).cast("string"), c("p_partkey") % 7
    forms = [
        F.concat(F.lit("laclasederiesgo"), x, F.lit("enunaescala de 1 a 7, clasederiesgo"), x, F.lit("enunaescala")),
        F.concat(F.lit("We have classified this fund as "), x, F.lit(" out of 7. Risk class 9")),
        F.concat(F.lit("Nivel de riesgo: "), x, F.lit(" y\nrisk class "), y, F.lit(" on a scale")),
        F.concat(F.lit("Key investor information document 1/3. Summary risk indicator is "), x, F.lit(", 3% a year for 4 years")),
        F.concat(F.lit("risk class "), x, F.lit("; risk category "), y),
        F.concat(F.lit("3 pages: the SRRI of 2021 is at "), x, F.lit(" and not 8")),
        F.lit("no class of 4"),
    ]
    text = F.get(F.array(*forms), kind.cast("int"))
    rows = part_rows(s, d).select(c("p_partkey").alias("id"), F.when(c("p_partkey") % 5 > 0, c("p_partkey") % 4 + 1).alias("drawn"), E.risk_class(text).alias("told"))
    return rows.select("id", c("told.value").alias("risk"), c("told.level").alias("level"), E.risk_grade(c("drawn"), c("told.value"), c("told.level"))["quality"].alias("quality"))


Q("txt_policy_attributes", f"SELECT id, contains(name, 'Hedged') OR regexp_matches(name, ' H$') AS hedged, CASE WHEN contains(name, 'Acc') THEN 'Accumulation' WHEN contains(name, 'Dist') OR contains(name, 'Income') THEN 'Distribution' END AS income, nullif(regexp_extract(name, '(EUR|USD)', 1), '') AS currency FROM ({NAMES})")(
    lambda s, d: names(s, d).select("id", (c("name").contains("Hedged") | c("name").rlike(" H$")).alias("hedged"), X.first_label(c("name"), [("Accumulation", ["Acc"]), ("Distribution", ["Dist", "Income"])]).alias("income"), X.ordered_extract(c("name"), ["(EUR|USD)"]).alias("currency"))
)
FEES = "SELECT id, CASE id % 4 WHEN 0 THEN 'no entry fee' WHEN 1 THEN 'entry fee up to ' || (p_size / 10.0) || '%' WHEN 2 THEN 'entry fee ' || (p_size / 10.0) || ' %' ELSE 'nothing' END AS t FROM (" + NAMES + ")"
fees = lambda s, d: names(s, d).select("id", F.when(c("id") % 4 == 0, "no entry fee").when(c("id") % 4 == 1, F.concat(F.lit("entry fee up to "), c("p_size") / 10, F.lit("%"))).when(c("id") % 4 == 2, F.concat(F.lit("entry fee "), c("p_size") / 10, F.lit(" %"))).otherwise("nothing").alias("t"))
# Entry fees in three languages beside other percentages of the same sentence.
ENTRY = """SELECT p_partkey AS id, p_partkey % 6 AS kind, p_size / 4 AS x FROM part"""


@Q(
    "txt_fee_extract",
    f"""SELECT id, CASE WHEN kind = 0 THEN 0.0 WHEN kind < 5 AND x <= 10 THEN x END AS fee,
 CASE WHEN kind = 0 THEN 'ZERO' WHEN kind = 5 THEN 'NOT_FOUND' WHEN x > 10 THEN 'OUT_OF_RANGE' WHEN kind IN (1, 3) THEN 'CEILING' ELSE 'TEXT' END AS origin FROM ({ENTRY})""",
)
def entry_fees(s, d):
    x, comma = F.format_number(c("p_size") / 4, 2), F.translate(F.format_number(c("p_size") / 4, 2), ".", ",")
    forms = [
        F.lit("There is no entry charge; 4% of it goes to us"),
        F.concat(F.lit("Costes de salida 1,5%, costes de entrada: hasta el "), comma, F.lit(" % del importe que usted paga")),
        F.concat(F.lit("We keep 1% yearly, a front-end load of "), x, F.lit("% once")),
        F.concat(F.lit("frais d'entrée jusqu'à "), comma, F.lit("%, frais de gestion 2%")),
        F.concat(F.lit("After "), x, F.lit(" % as initial charge, which is all. 2% a year")),
        F.lit("Entry costs are not told. Performance 3%"),
    ]
    fee = E.entry_fee(F.get(F.array(*forms), (c("p_partkey") % 6).cast("int")))
    return part_rows(s, d).select(c("p_partkey").alias("id"), fee.alias("f")).select("id", "f.fee", "f.origin")


Q("txt_fee_near_anchor", f"SELECT id, TRY_CAST(regexp_extract(t, 'entry fee (?:up to )?([0-9]+(?:[.][0-9]+)?) ?%', 1) AS DOUBLE) AS pct FROM ({FEES})")(lambda s, d: fees(s, d).select("id", X.near_anchor(c("t"), "entry fee").alias("pct")))
BM = "SELECT id, (['MSCI World Index NR EUR', 'Euro Stoxx 50 Index, which tracks shares', 'No benchmark is used', 'the fund seeks growth', 'Bloomberg Global Aggregate Bond TR', 'ESTR'])[id % 6 + 1] AS t FROM (" + NAMES + ")"
PHRASES = ("MSCI World Index NR EUR", "Euro Stoxx 50 Index, which tracks shares", "No benchmark is used", "the fund seeks growth", "Bloomberg Global Aggregate Bond TR", "ESTR")
bm = lambda s, d: names(s, d).select("id", F.get(F.array(*map(F.lit, PHRASES)), (c("id") % 6).cast("int")).alias("t"))
CLEAN = "SELECT id, CASE WHEN regexp_matches(t, '(?i)\\b(no benchmark|not applicable)\\b') THEN 'NO_BENCHMARK' WHEN NOT regexp_matches(t, '(?i)\\b(the fund|we|investors)\\b') AND length(u) >= 4 THEN u END AS benchmark FROM (SELECT *, trim(regexp_replace(t, '(?i)\\s*(,?\\s*(which|that)\\b|;|\\. [A-Z]).*$', '')) AS u FROM (" + BM + "))"
Q("txt_benchmark_clean", CLEAN)(lambda s, d: bm(s, d).select("id", X.clean_benchmark(c("t")).alias("benchmark")))
# Index names: a part's brand, its name's words and a return variant. The first table knows makers with the name's first
# word (the longer the earlier), the second one full names of some sizes, of which the variant may differ.
INDEXES = "SELECT p_partkey AS id, p_brand || '  ' || p_name || CASE p_size % 3 WHEN 0 THEN ' NR EUR' WHEN 1 THEN ' gr usd ' ELSE '' END AS t, p_brand, p_name, p_size FROM part"
FIRST_TABLE = f"SELECT DISTINCT -length(prefix) AS ord, prefix, upper(prefix) AS label FROM (SELECT lower(p_brand || ' ' || string_split(p_name, ' ')[1]) AS prefix FROM ({INDEXES}) WHERE p_size > 40)"
SECOND_TABLE = f"SELECT DISTINCT p_size AS ord, lower(p_brand || ' ' || p_name || ' nr eur') AS prefix, p_name AS label FROM ({INDEXES}) WHERE p_size BETWEEN 10 AND 40"
BEST = "SELECT t, min((ord, length(prefix), label, prefix)) AS m FROM (SELECT DISTINCT t FROM x) JOIN {table} ON starts_with(t, prefix) GROUP BY t"


def indexes(s, d):
    variant = F.when(c("p_size") % 3 == 0, " NR EUR").when(c("p_size") % 3 == 1, " gr usd ").otherwise("")
    return part_rows(s, d).select(c("p_partkey").alias("id"), F.concat("p_brand", F.lit("  "), "p_name", variant).alias("t"), "p_brand", "p_name", "p_size")


@Q(
    "txt_benchmark_normalize",
    f"""WITH i AS (SELECT id, trim(regexp_replace(lower(t), '[ ]+', ' ', 'g')) AS w FROM ({INDEXES})),
 j AS (SELECT *, trim(regexp_replace(w, '{D.VARIANT}', '')) AS v FROM i), x AS (SELECT w AS t FROM j UNION SELECT v FROM j),
 a AS ({FIRST_TABLE}), b AS ({SECOND_TABLE}), e AS (SELECT ord, label, trim(regexp_replace(prefix, '{D.VARIANT}', '')) AS prefix FROM b),
 ma AS ({BEST.format(table='a')}), mb AS ({BEST.format(table='b')}), me AS ({BEST.format(table='e')})
 SELECT id, CASE WHEN ma.m IS NOT NULL THEN 0 WHEN mb.m IS NOT NULL THEN 1 WHEN v <> w AND me.m IS NOT NULL THEN 2 END AS found_in, coalesce(ma.m[3], mb.m[3], CASE WHEN v <> w THEN me.m[3] END) AS benchmark
 FROM j LEFT JOIN ma ON ma.t = w LEFT JOIN mb ON mb.t = w LEFT JOIN me ON me.t = v""",
)
def benchmark_normalize(s, d):
    rows, name = indexes(s, d), F.lower(F.concat_ws(" ", "p_brand", F.get(F.split("p_name", " "), F.lit(0))))
    first = rows.where("p_size > 40").select(name.alias("prefix")).distinct().select((-F.length("prefix")).alias("ord"), "prefix", F.upper("prefix").alias("label"))
    second = rows.where("p_size between 10 and 40").select(c("p_size").alias("ord"), F.lower(F.concat_ws(" ", "p_brand", "p_name", F.lit("nr eur"))).alias("prefix"), c("p_name").alias("label")).distinct()
    return D.normal_names(rows.select("id", "t"), "t", first, second).select("id", c("match.table").alias("found_in"), c("match.label").alias("benchmark"))


Q("txt_benchmark_class_role", f"SELECT id, CASE WHEN regexp_matches(t, '(?i)equity|stoxx|msci|s&p') THEN 'Equity' WHEN regexp_matches(t, '(?i)bond|aggregate|treasury') THEN 'Fixed Income' WHEN regexp_matches(t, '(?i)estr|euribor|eonia') THEN 'Rate' END AS asset_class, CASE WHEN regexp_matches(t, '(?i)estr|euribor|eonia') THEN 'hurdle' ELSE 'proxy' END AS role FROM ({BM})")(lambda s, d: bm(s, d).select("id", X.asset_class(c("t")).alias("asset_class"), F.when(X.asset_class(c("t")) == "Rate", "hurdle").otherwise("proxy").alias("role")))
GRID = "SELECT id, p_size, '|||Horizon|||1 year|||5 years|||' || chr(10) || '|||Total costs|||' || p_size || '|||' || (p_size * 4) || '|||' || chr(10) || 'note' || chr(10) || '|||Impact|||' || (p_size / 10.0) || '%|||' || (p_size / 20.0) || '%|||' || chr(10) || '|||Entry costs|||' || (p_size / 10.0) || '%|||' || chr(10) || '|||Management fees|||1.5%|||' AS t FROM (" + NAMES + ")"


def grids(s, d):
    z = c("p_size")
    parts = ["|||Horizon|||1 year|||5 years|||\n|||Total costs|||", z, "|||", z * 4, "|||\nnote\n|||Impact|||", z / 10, "%|||", z / 20, "%|||\n|||Entry costs|||", z / 10, "%|||\n|||Management fees|||1.5%|||"]
    return names(s, d).select("id", "p_size", F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("t"))


Q("txt_grid_parse", f"SELECT id, CAST(k - 1 AS INTEGER) AS row, trim(string_split(line, '|||')[2]) AS label, CAST(len(string_split(line, '|||')) - 3 AS INTEGER) AS cells FROM (SELECT id, unnest(string_split(t, chr(10))) AS line, unnest(range(1, 100)[1:len(string_split(t, chr(10)))]) AS k FROM ({GRID})) WHERE contains(line, '|||')")(lambda s, d: X.grid(grids(s, d), "id", "t").select("id", "row", "label", F.size("cells").alias("cells")))


@Q(
    "txt_cost_schedule",
    """SELECT p_partkey AS id, 1.0::DOUBLE AS years, p_size * 10.0::DOUBLE AS amount, p_size / 10 AS pct, p_partkey % 7 = 0 AS recommended FROM part WHERE p_partkey % 4 < 3
 UNION ALL SELECT p_partkey, 5.0, p_size * 40.0, p_size / 20, TRUE FROM part WHERE p_partkey % 4 < 3 AND p_partkey % 7 > 0""",
)
def cost_plans(s, d):
    plan = K.schedule(costs(s, d), "id", "t")
    return plan.withColumns({x: F.round(x, 4) for x in ("years", "amount", "pct")})


def costs(s, d):
    """Cost documents of parts, in two languages and two number formats: three of four have a schedule and five cost lines
    in their sections, with rows of the same labels before and after; the others are of the second format."""
    even = c("id") % 2 == 0
    word = lambda es, en: F.when(even, es).otherwise(en)
    plain = lambda x, n: F.format_number(x, n)
    comma = lambda x, n: F.when(even, F.translate(plain(x, n), ",.", ".,")).otherwise(plain(x, n))
    size, price, bar = c("p_size"), c("p_retailprice"), F.lit("|||")
    period = F.when(c("id") % 7 == 0, "1").otherwise("5")
    lines = [
        F.concat(word("Documento de datos fundamentales. Período de mantenimiento recomendado: ", "Key information document. Recommended holding period: "), period, word(" años", " years")),
        F.concat(word("Costes de entrada de 9%", "Entry costs of 9%")),
        F.concat(bar, word("Costes de entrada", "Entry costs"), F.lit("|||9%|||99 EUR|||")),
        F.concat(bar, word("Costes a lo largo del tiempo", "Costs over time"), bar),
        F.concat(bar, word("Inversión: 10.000 EUR", "Investment: 10,000 EUR"), bar, word("Salida después de 1 año", "Exit after 1 year"), bar, word("Salida en el PMR", "Exit at the"), bar),
        F.concat(F.lit("||||||||| "), word("", "recommended holding period"), bar),
        F.concat(bar, word("Costes totales", "Total costs"), bar, comma(size * 10, 2), F.lit(" EUR|||"), comma(size * 40, 2), F.lit(" EUR|||")),
        F.concat(bar, word("Incidencia anual de|||los costes (*)", "Annual cost impact"), bar, comma(size / 10, 1), F.lit("%|||"), comma(size / 20, 2), F.lit("|||%|||")),
        F.concat(bar, word("Composición de los costes", "Composition of costs"), bar),
        F.concat(bar, word("Costes de entrada", "Entry costs"), bar, word("hasta ", "up to "), comma(size / 10, 1), F.lit("% of what you pay"), bar, comma(size * 10, 2), F.lit(" EUR"), bar),
        F.concat(bar, word("Costes de salida", "Exit cost"), bar, comma(c("id") % 7 / 10, 1), F.lit(" %"), bar),
        F.concat(bar, word("Comisiones de gestión", "Management fees and others"), bar, comma(F.floor(price / 10) / 100, 2), F.lit("%"), bar, comma(price, 2), F.lit(" €"), bar),
        F.concat(bar, word("Costes de operación", "Transaction costs"), bar, comma(size / 20, 2), F.lit("%"), bar),
        F.concat(bar, word("Comisiones de éxito", "Performance fee"), bar, comma(size.cast("double"), 1), F.lit("%"), bar),
        F.concat(bar, word("Escenarios de rentabilidad", "Performance scenarios"), bar),
        F.concat(bar, word("Comisiones de gestión", "Management fees"), F.lit("|||4.9%|||7 EUR|||")),
    ]
    old = F.concat(word("Datos fundamentales para el inversor. Gastos corrientes: ", "Key investor information. Entry charge 1%, exit charge 2%, ongoing charges: "), comma(size / 10, 1), F.lit(" %"))
    return names(s, d).select("id", F.when(c("id") % 4 < 3, F.concat_ws("\n", *lines)).otherwise(old).alias("t"))


COST_COLUMNS = ["entry_fee_pct", "entry_fee_max_pct", "entry_fee_eur", "exit_fee_pct", "exit_fee_eur", "management_fee_pct", "management_fee_eur", "transaction_cost_pct", "performance_fee_pct", "performance_fee_max_pct"]
COSTS = """SELECT p_partkey AS id, p_size, p_size / 10 AS entry_fee_pct, p_size / 10 AS entry_fee_max_pct, p_size * 10.0::DOUBLE AS entry_fee_eur, (p_partkey % 7) / 10 AS exit_fee_pct, NULL::DOUBLE AS exit_fee_eur,
 CASE WHEN floor(p_retailprice / 10) / 100 <= 5 THEN floor(p_retailprice / 10) / 100 END AS management_fee_pct, round(p_retailprice, 2) AS management_fee_eur, CASE WHEN p_size / 20 <= 2 THEN p_size / 20 END AS transaction_cost_pct,
 CASE WHEN p_size <= 30 THEN p_size::DOUBLE END AS performance_fee_pct, NULL::DOUBLE AS performance_fee_max_pct FROM part"""
R4 = ", ".join(f"round({x}, 4) AS {x}" for x in COST_COLUMNS)


@Q("txt_cost_composition", f"SELECT id, {R4} FROM ({COSTS}) WHERE id % 4 < 3")
def cost_lines(s, d):
    return K.composition(costs(s, d), "id", "t").select("id", *[F.round(x, 4).alias(x) for x in COST_COLUMNS])


@Q(
    "txt_cost_extract",
    f"""SELECT id, CASE WHEN id % 4 = 3 THEN 'UCITS_KIID' ELSE 'PRIIPS_KID' END AS format, CASE WHEN id % 4 < 3 THEN 'EUR' END AS currency, CASE WHEN id % 4 < 3 THEN round(entry_fee_pct, 4) END AS entry_fee_pct,
 CASE WHEN id % 4 < 3 THEN round(management_fee_pct, 4) END AS management_fee_pct, CASE WHEN id % 4 = 3 OR id % 7 = 0 THEN 1 ELSE 2 END AS horizons,
 round(CASE WHEN id % 4 = 3 OR id % 7 = 0 THEN p_size / 10 ELSE p_size / 20 END, 4) AS impact,
 CASE WHEN id % 4 = 3 OR management_fee_pct IS NOT NULL AND transaction_cost_pct IS NOT NULL AND performance_fee_pct IS NOT NULL THEN 'HIGH' WHEN management_fee_pct IS NOT NULL THEN 'MEDIUM' ELSE 'NONE' END AS quality,
 CASE WHEN id % 4 < 3 THEN round(CASE WHEN id % 7 = 0 THEN p_size / 10 ELSE p_size / 20 END, 4) > round(management_fee_pct, 4) END AS mismatch FROM ({COSTS})""",
)
def cost_records(s, d):
    r = K.records(costs(s, d), "id", "t").withColumns({x: F.round(x, 4) for x in ("entry_fee_pct", "management_fee_pct", "impact")})
    return r.select("id", "format", "currency", "entry_fee_pct", "management_fee_pct", "horizons", "impact", "quality", (c("impact") > c("management_fee_pct")).alias("mismatch"))


FP = r"entry fee (?:up to )?([0-9]*[1-9][0-9.]*|0\.[0-9]*[1-9][0-9]*) ?%"
Q("txt_fee_false_positive", f"SELECT id, id % 3 = 0 AS found, len(regexp_extract_all(t, '{FP}')) >= CASE WHEN id % 3 = 0 THEN 1 ELSE 2 END AS suspect FROM ({FEES})")(lambda s, d: fees(s, d).select("id", (c("id") % 3 == 0).alias("found"), (F.size(F.regexp_extract_all("t", F.lit(FP), F.lit(1))) >= F.when(c("id") % 3 == 0, 1).otherwise(2)).alias("suspect")))
Q("txt_oc_aci_gap", f"SELECT id, abs(p_size / 10.0 - 1.5) <= 0.05 OR abs(p_size / 20.0 - 1.5) <= 0.05 AS suspect FROM ({NAMES})")(
    lambda s, d: X.schedule(X.grid(grids(s, d), "id", "t"), "id").groupBy("id").agg(F.collect_list("pct").alias("p")).select("id", F.exists("p", lambda x: F.abs(x - 1.5) <= 0.05).alias("suspect"))
)
Q("txt_length_profile", "SELECT lang, count(*) AS n, min(n_chars) AS low, max(n_chars) AS high, round(avg(n_chars), 4) AS mean, CAST(quantile_cont(n_chars, 0.5) AS DOUBLE) AS median FROM documents GROUP BY lang")(lambda s, d: docs(s, d).groupBy("lang").agg(F.count("*").alias("n"), F.min("n_chars").alias("low"), F.max("n_chars").alias("high"), F.round(F.avg("n_chars"), 4).alias("mean"), F.median("n_chars").alias("median")))
Q("txt_defect_signatures", "SELECT lang, count(*) FILTER (regexp_matches(text, '!!|###|[$]{3}')) AS broken FROM documents GROUP BY lang")(lambda s, d: docs(s, d).groupBy("lang").agg(F.count_if(c("text").rlike("!!|###|[$]{3}")).alias("broken")))
Q("txt_label_variants", "SELECT array_to_string(string_split_regex(lower(trim(line)), ' +')[1:2], ' ') AS head, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '^The ') AND NOT regexp_matches(line, 'The (and|than)') GROUP BY 1")(lambda s, d: X.label_heads(docs(s, d), "text", "^The ", "The (and|than)"))
Q("txt_duplicate_tables", "SELECT doc_id, count(*) AS rows FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE contains(line, ' | ') GROUP BY doc_id HAVING count(*) >= 2")(lambda s, d: docs(s, d).select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(c("line").contains(" | ")).groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows >= 2"))
Q("attr_derive", f"SELECT id, CASE WHEN p_size < 10 THEN 'short' WHEN p_size < 30 THEN 'medium' ELSE 'long' END AS duration, greatest(1, least(5, CAST(floor(p_size / 8.0) AS INTEGER))) AS profile, CASE WHEN p_retailprice > 1200 THEN 'premium' ELSE 'plain' END AS vehicle FROM ({NAMES})")(
    lambda s, d: names(s, d).select("id", F.when(c("p_size") < 10, "short").when(c("p_size") < 30, "medium").otherwise("long").alias("duration"), F.greatest(F.lit(1), F.least(F.lit(5), F.floor(c("p_size") / 8).cast("int"))).alias("profile"), F.when(c("p_retailprice") > 1200, "premium").otherwise("plain").alias("vehicle"))
)
BLOCKS = [("money", "ring", "red"), ("bonds", "gear|bolt", "blue"), ("shares", "red|blue|green", "small"), ("mixed", "a2", "zzz")]
_fits = lambda inc, exc: f"regexp_matches(lower(name), '{inc}') AND NOT regexp_matches(lower(name), '{exc}')"
Q("block_universe", "SELECT id, CASE " + " ".join(f"WHEN {_fits(i, e)} THEN '{b}'" for b, i, e in reversed(BLOCKS)) + f" END AS block FROM ({NAMES})")(lambda s, d: X.last_block(names(s, d), BLOCKS, "id", "name"))
Q("block_classify", "SELECT id, block, CASE block WHEN 'money' THEN 'cash' WHEN 'bonds' THEN CASE WHEN p_size < 20 THEN 'short' ELSE 'long' END WHEN 'shares' THEN CASE WHEN contains(name, 'EUR') THEN 'Europe' ELSE 'Global' END WHEN 'mixed' THEN 'balanced' END AS kind FROM (SELECT *, CASE " + " ".join(f"WHEN {_fits(i, e)} THEN '{b}'" for b, i, e in reversed(BLOCKS)) + f" END AS block FROM ({NAMES}))")(
    lambda s, d: X.last_block(names(s, d), BLOCKS, "id", "name").join(names(s, d), "id").select("id", "block", F.when(c("block") == "money", "cash").when(c("block") == "bonds", F.when(c("p_size") < 20, "short").otherwise("long")).when(c("block") == "shares", F.when(c("name").contains("EUR"), "Europe").otherwise("Global")).when(c("block") == "mixed", "balanced").alias("kind"))
)
Q("fn_accent_fold", "SELECT doc_id, strip_accents(lower(text)) AS folded FROM documents")(lambda s, d: docs(s, d).select("doc_id", X.fold_accents(F.lower("text")).alias("folded")))
Q("fn_number_parse", "SELECT p_partkey AS id, round(p_retailprice, 2) AS grouped, p_size / 10 AS single, p_partkey::DOUBLE AS whole, p_size / 4 AS capped, NULL::DOUBLE AS none FROM part")(lambda s, d: numbers(s, d))


def numbers(s, d):
    """Amounts in the two formats, by turns, and what they mean."""
    even = c("p_partkey") % 2 == 0
    both = lambda x, n: F.when(even, F.translate(F.format_number(x, n), ",.", ".,")).otherwise(F.format_number(x, n))
    p = part_rows(s, d)
    return p.select(
        c("p_partkey").alias("id"), X.number(F.concat(F.lit("EUR "), both(c("p_retailprice"), 2))).alias("grouped"), X.number(both(c("p_size") / 10, 1)).alias("single"), X.number(both(c("p_partkey"), 0)).alias("whole"),
        X.number(F.concat(F.lit("Hasta "), both(c("p_size") / 4, 2), F.lit("%"))).alias("capped"), X.number(F.lit("none")).alias("none"),
    )


Q("fn_code_to_years", "SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN p_size::DOUBLE WHEN 1 THEN round(p_size / 12, 6) WHEN 2 THEN p_size::DOUBLE WHEN 3 THEN -1 END AS years FROM part")(
    lambda s, d: part_rows(s, d).select(c("p_partkey").alias("id"), F.round(X.years(F.concat(F.when(c("p_partkey") % 5 == 3, "Recommended holding period ").otherwise(""), F.when(c("p_partkey") % 5 != 4, c("p_size").cast("string")).otherwise("some"), F.get(F.array(*map(F.lit, ("Y+", " meses", " años", " years", " time"))), (c("p_partkey") % 5).cast("int")))), 6).alias("years"))
)


def pick(index, *forms):
    return F.get(F.array(*[F.lit(x) if x is None or isinstance(x, str) else x for x in forms]), index.cast("int"))


# Funds of ten kinds by id, each with wording that one layer or one guard is for, and a risk class by size.
NATURES = """SELECT p_partkey AS id, p_partkey % 10 AS k, p_size % 7 + 1 AS r FROM part"""


@Q(
    "txt_nature_cascade",
    f"""SELECT id, CASE WHEN k IN (0, 3, 5) AND r >= 5 OR k = 6 AND r >= 5 OR k = 1 THEN 'Renta Variable' WHEN k IN (0, 5) OR k = 6 AND r = 1 THEN 'Monetario' WHEN k IN (2, 9) OR k = 6 AND r = 2 THEN 'Renta Fija Flexible'
 WHEN k = 3 THEN 'Renta Fija Corto Plazo' WHEN k IN (4, 8) THEN 'Mixtos' WHEN k = 7 THEN 'Alternativo' ELSE 'Restantes' END AS nature,
 CASE WHEN k IN (0, 2, 3, 7, 8, 9) THEN 'text' WHEN k IN (1, 4) THEN 'name' WHEN k = 5 THEN 'benchmark' WHEN r NOT IN (3, 4) THEN 'risk' END AS layer,
 CASE WHEN k IN (0, 5) AND r >= 5 THEN 'high_risk' WHEN k = 1 THEN 'other_than_money' WHEN k = 2 OR k = 6 AND r = 2 THEN 'flexible_bonds' WHEN k = 3 AND r >= 5 THEN 'short_bonds,high_risk' WHEN k = 3 THEN 'short_bonds'
 WHEN k = 6 AND r IN (3, 4) THEN 'nothing_known' WHEN k = 9 THEN 'linked_bonds' ELSE '' END AS guards FROM ({NATURES})""",
)
def natures(s, d):
    k, own = c("p_partkey") % 10, F.concat_ws(" ", "p_brand", "p_name")
    text = pick(
        k, F.concat(F.lit("The aim of "), own, F.lit(" is that of a money market fund.")), "A money market fund under the rules for ucits", "It invests mainly in bonds of states", "Compra deuda soberana",
        "Mainly in bonds, at times common shares", None, "Nothing is told", "Absolute return above the sofr by equity securities", "Invierte en acciones y en renta fija", "Primarily in bonds linked to inflation, some of them short term",
    )
    name = F.concat_ws(" ", own, pick(k, None, "Global Equity", None, "Short Duration", "Allocation", None, None, None, "Cash", "Equity"))
    rows = part_rows(s, d).select(c("p_partkey").alias("id"), name.alias("name"), text.alias("text"), F.when(k.isin(5, 8), "Rate").alias("class"), (c("p_size") % 7 + 1).alias("risk"))
    rows = rows.select("id", L.fund_nature(c("name"), c("text"), c("class"), c("risk")).alias("x"))
    return rows.select("id", c("x.value").alias("nature"), "x.layer", F.array_join("x.guards", ",").alias("guards"))


# Benchmarks inside running text, beside names of other indices, statements of none, and makers that are no index.
@Q(
    "txt_benchmark_extract",
    """SELECT p_partkey AS id, CASE p_partkey % 7 WHEN 0 THEN 'msci ' || n || ' index (net return)' WHEN 2 THEN 'ftse ' || n || ' total return' WHEN 3 THEN 'bloomberg ' || n || ' (nr)' WHEN 4 THEN '€STR' WHEN 6 THEN 's&p ' || n || ' net return' END AS benchmark,
 (['LABEL', 'NONE', 'ACTION', 'NAME', 'RATE', NULL, 'LABEL'])[p_partkey % 7 + 1] AS level, p_partkey % 7 = 1 AS declared_none FROM (SELECT *, lower(p_name) AS n FROM part)""",
)
def benchmarks(s, d):
    parts = lambda a, b: F.concat(F.lit(a), "p_name", F.lit(b))
    text = pick(
        c("p_partkey") % 7, parts("El fondo crece. Índice de referencia: MSCI ", " Index (Net Return), un índice que no mide el FTSE 100 Index."), parts("No sigue ningún índice, aunque conoce el MSCI ", " Index"),
        parts("We know the Nikkei. The fund aims to outperform the FTSE ", " Total Return over five years."), parts("En 2020 el Bloomberg ", " (NR) cayó"), parts("Índice de referencia: €STR (en EUR), no el MSCI ", " Index"),
        parts("Benchmark: JPMorgan Asset Management (Europe), ", ""), parts("Objetivo\nÍndice de referencia\nS&P ", " Net Return\nRiesgos del MSCI World Index"),
    )
    return part_rows(s, d).select(c("p_partkey").alias("id"), L.benchmark_of(text).alias("b")).select("id", "b.*")


# Five layers by turns of different length, so that each meets each other one.
REGION = """SELECT p_partkey AS id, p_partkey % 5 AS u, (['EUR', 'USD', 'GBP'])[p_partkey % 3 + 1] AS currency, p_partkey % 11 = 0 AS liquid, (['EEUU', 'Europa', 'China', 'Asia', NULL, NULL])[p_size % 6 + 1] AS by_name,
 (['EEUU', 'China', 'Global', 'Europa', 'Emergentes', NULL, NULL, NULL])[p_partkey % 8 + 1] AS by_index, p_partkey % 4 AS t FROM part"""


@Q(
    "attr_impute_cascade",
    f"""SELECT id, CASE WHEN u = 0 THEN 'Global' WHEN u = 1 AND currency = 'EUR' THEN 'Europa' WHEN u = 1 AND currency = 'USD' THEN 'EEUU' WHEN NOT liquid THEN coalesce(by_name, by_index, CASE t WHEN 1 THEN 'EEUU' WHEN 2 THEN 'Asia' END) END AS geography,
 CASE WHEN u = 0 THEN 'universe' WHEN u = 1 AND currency <> 'GBP' THEN 'currency' WHEN liquid THEN NULL WHEN by_name IS NOT NULL THEN 'name' WHEN by_index IS NOT NULL THEN 'benchmark' WHEN t IN (1, 2) THEN 'text' END AS layer FROM ({REGION})""",
)
def regions(s, d):
    key = c("p_partkey")
    universe, currency = F.when(key % 5 == 0, "Global").when(key % 5 == 1, "Liquidity"), pick(key % 3, "EUR", "USD", "GBP")
    name = F.concat_ws(" ", "p_brand", "p_name", pick(c("p_size") % 6, "US Growth", "Euro Stars", "China", "Asia ex", "Euro STR", "Australasia"))
    index = pick(key % 8, "Russell 1000", "Hang Seng", "MSCI AC World", "EURO STOXX 50", "MSCI EM", None, "NO_BENCHMARK", "Worldwide")
    text = pick(key % 4, "Invierte en Asia y en Estados Unidos", "Invierte\nprincipalmente en Norteamérica", "principalmente en valores asiáticos", "Estados Unidos es grande")
    nature = F.when(key % 11 == 0, "Monetario").otherwise("Renta Variable")
    return part_rows(s, d).select(key.alias("id"), L.region(universe, currency, name, index, text, nature).alias("x")).select("id", c("x.value").alias("geography"), "x.layer")


@Q(
    "name_characterize",
    """SELECT id, (['Unhedged', 'Hedged', 'Hedged', 'Hedged', 'Unhedged', NULL])[k + 1] AS currency_hedged, CASE WHEN g THEN 'given' ELSE (['Accumulation', 'Distribution', 'Distribution', NULL])[j + 1] END AS accumulation,
 CASE WHEN g THEN 'given' ELSE (['name', 'name', 'text', NULL])[j + 1] END AS accumulation_layer, CASE WHEN id % 3 > 0 THEN (['Small', NULL, 'Large', NULL, 'Small'])[id % 5 + 1] END AS cap, CASE WHEN id % 7 = 0 THEN '1' ELSE '0' END AS esg,
 CASE WHEN id % 3 = 0 THEN 'Liquidity' WHEN id % 5 = 1 THEN 'Country' WHEN id % 5 = 3 THEN 'Regional' END AS universe FROM (SELECT p_partkey AS id, p_partkey % 6 AS k, p_size % 4 AS j, p_partkey % 9 = 0 AS g FROM part)""",
)
def characterized(s, d):
    key, size = c("p_partkey"), c("p_size")
    name = F.concat_ws(
        " ", "p_name", pick(key % 6, "Unhedged", "EURH", "(H)", None, None, "High"), pick(size % 4, "Acc", "Dist", None, None), pick(key % 5, "Smaller Companies", "China", None, "Asia", None), F.when(key % 7 == 0, "Sustainable")
    )
    text = F.concat_ws(". ", pick(key % 6, "is hedged", None, None, "The class is hedged", "It is not hedged", None), F.when(size % 4 == 2, "Distributes income").when(size % 4 == 0, "pays dividends"), pick(key % 5, None, None, "blue chip shares", None, "small cap"))
    nature = F.when(key % 3 == 0, "Monetario").otherwise("Renta Variable")
    rows = part_rows(s, d).select(key.alias("id"), name.alias("name"), text.alias("text"), nature.alias("nature"), F.when(key % 9 == 0, "given").alias("given"))
    rows = rows.select("id", L.characterize(c("name"), c("text"), c("nature"), {"accumulation_policy": c("given")}).alias("x"))
    return rows.select(
        "id", c("x.currency_hedged.value").alias("currency_hedged"), c("x.accumulation_policy.value").alias("accumulation"), c("x.accumulation_policy.layer").alias("accumulation_layer"),
        c("x.market_cap_focus.value").alias("cap"), c("x.is_esg.value").alias("esg"), c("x.universe.value").alias("universe"),
    )


# Labels of whole documents in three layers: what their beginning holds, what they hold anywhere, and their language.
DOCS = [("junk", ["!!", "###"]), ("en", ["the ", "with "]), ("fr", [" les ", " des "]), ("de", [" und ", " der "])]
_has = lambda t, entries: "CASE " + " ".join("WHEN " + " OR ".join(f"contains({t}, '{x}')" for x in signals) + f" THEN '{label}'" for label, signals in entries) + " END"


@Q("txt_layered_labels", f"SELECT doc_id, coalesce(a, b, lang) AS nature, CASE WHEN a IS NOT NULL THEN 'begin' WHEN b IS NOT NULL THEN 'text' WHEN lang IS NOT NULL THEN 'lang' END AS layer FROM (SELECT doc_id, lang, {_has('substr(text, 1, 200)', DOCS)} AS a, {_has('text', DOCS[:2])} AS b FROM documents)")
def layered_labels(s, d):
    layers = [L.Layer("begin", X.first_label(F.substring("text", 1, 200), DOCS)), L.Layer("text", X.first_label(c("text"), DOCS[:2])), L.Layer("lang", c("lang"))]
    return docs(s, d).select("doc_id", L.cascade(layers).alias("x")).select("doc_id", c("x.value").alias("nature"), "x.layer")
