"""Cost tables of documents: sections told by their heads, horizons and rows of each, for two document formats.

Everything of a document stays in its row as arrays of lines and cells; rows are exploded only for results. Null and empty
texts, and texts without a table, give no rows. Of several tables with the same head the first counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import text as X
from .evidence import let

# Heads of the sections, signals of the two formats, labels of rows and horizons.
OVER_TIME = r"(?i)costes?\s*a\s*lo\s*largo\s*del\s*tiempo|costs?\s*over\s*time"
COMPOSITION = r"(?i)composici[oó]n\s*de\s*los\s*costes?|composition\s*of\s*costs?"
SCENARIOS = r"(?i)escenarios?\s*de\s*rentabilidad|performance\s*scenarios"
PRIIPS = [
    r"documento\s*de\s*datos\s*fundamentales", "key information document", r"composici[óo]n\s*de\s*los\s*costes?", "composition of costs",
    r"costes?\s*a\s*lo\s*largo\s*del\s*tiempo", "costs over time", r"incidencia\s*anual\s*de\s*los\s*costes?", "annual cost impact",
    r"escenarios?\s*de\s*rentabilidad", "performance scenarios", r"per[ií]odo\s*de\s*mantenimiento\s*recomendado", "recommended holding period",
]
UCITS = [
    "datos fundamentales para el inversor", "key investor information", "gastos corrientes", "entry charge.{0,80}exit charge.{0,80}ongoing charge",
    r"comisi[óo]n\s+de\s+entrada.{0,200}comisi[óo]n\s+de\s+salida.{0,200}comisi[óo]n\s+de\s+gesti[óo]n",
]
SCENARIO_SIGNALS = [
    "escenarios? de rentabilidad", "performance scenarios", r"escenario\s+(?:favorable|desfavorable|moderado|de\s+tensi[oó]n)",
    r"(?:favourable|unfavourable|moderate|stress)\s+scenario",
]
CURRENCY = r"(?i)10[.,]000\s*(EUR|USD|GBP|CHF|SEK|NOK|DKK|PLN|CZK)"
TOTAL = r"(?i)^\s*(costes?\s*totales?|costes?|total\s*costs?)\s*[*().:\d\s]*$"
IMPACT = r"(?i)incidencia\s*(anual\s*)?de\s*los\s*costes?|impacto\s*(anual\s*)?en\s*los\s*costes?|annual\s*cost\s*impact"
PERIOD = r"(?i)per[ií]odo\s*de\s*mantenimiento\s*recomendado|recommended\s*holding\s*period|mantenimiento\s*recomendado|\bRHP\b|\bPMR\b"
PERIOD_VALUE = r"(?i)(?:per[ií]odo\s+de\s+mantenimiento\s+recomendado|recommended\s+holding\s+period)\s*[:\-]?\s*(\d+\s*(?:a[ñn]os?|years?|mes(?:es)?|months?))\b"
YEARS, MONTHS = r"(?i)(\d+)\s*(?:a[ñn]os?|years?)", r"(?i)(\d+)\s*(?:mes(?:es)?|months?)"
INVESTED = r"(?i)(inversi[oó]n|invest(ment)?|ejemplo|example)\b.*?(\d{4,}|\d{1,3}([\s.,]\d{3})+)"
ONGOING = r"(?i)(?:gastos\s+corrientes|ongoing\s+charges?)\s*[:\-]?\s*(\d+[,.]\d+)\s*%"


def document_format(text: Column) -> Column:
    """UCITS_KIID, PRIIPS_KID or UNKNOWN, by how many signals of each occur; two of the first outweigh all others."""
    hits = lambda signals: X.count_hits(text, [f"(?is){s}" for s in signals])
    old, new = hits(UCITS), hits(PRIIPS)
    return F.when(old >= 2, "UCITS_KIID").when((new >= 3) | ((new >= 1) & (old == 0) & (hits(SCENARIO_SIGNALS) >= 1)), "PRIIPS_KID").otherwise("UNKNOWN")


def currency(text: Column) -> Column:
    """The currency of the example investment, else null."""
    return F.upper(X.ordered_extract(text, [CURRENCY]))


def horizon(label: Column) -> Column:
    """Years of a label; months as parts of a year; null if it names no time."""
    return F.coalesce(X.ordered_extract(label, [YEARS]).try_cast("double"), F.round(X.ordered_extract(label, [MONTHS]).try_cast("double") / 12, 4))


def _cells(line: Column) -> Column:
    """Cells of a line, without the blank ones that the outer separators make."""
    inner = F.regexp_replace(F.regexp_replace(F.trim(line), r"^\|\|\|", ""), r"\|\|\|$", "")
    return F.transform(F.split(inner, r"\|\|\|"), lambda x: F.trim(x))


def _section(lines: Column, heads: Column, head: str, most: int) -> Column:
    """Rows of cells from the first line that fits ``head`` to the one before the next other head, at most ``most``.

    ``heads`` has the fits of every line by name; they and the places found in them are computed once.
    """
    others = lambda x: (x["over_time"].cast("int") + x["composition"].cast("int") + x["scenarios"].cast("int")) > x[head].cast("int")

    def of(begin: Column) -> Column:
        rest = F.slice(heads, begin + 1, F.size(lines))
        return let(F.array_position(F.transform(rest, others), F.lit(True)), lambda end: F.slice(lines, begin, F.when(end > 0, F.least(end, F.lit(most))).otherwise(F.lit(most)).cast("int")))

    return let(F.array_position(F.transform(heads, lambda x: x[head]), F.lit(True)), lambda begin: F.when(begin > 0, F.transform(of(begin), _cells)))


def tables(docs: DataFrame, key: str, text: str, *, most: int = 15) -> DataFrame:
    """(key, period, over_time, composition): the recommended period in years and the rows of both sections, as cells."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.contains("|||"))
    d = docs.select(F.col(key), horizon(X.ordered_extract(F.col(text), [PERIOD_VALUE])).alias("period"), lines.alias("lines"))
    fits = F.transform("lines", lambda x: F.struct(x.rlike(OVER_TIME).alias("over_time"), x.rlike(COMPOSITION).alias("composition"), x.rlike(SCENARIOS).alias("scenarios")))
    d = d.select(key, "period", "lines", fits.alias("heads"))
    return d.select(key, "period", *[_section(F.col("lines"), F.col("heads"), name, most).alias(name) for name in ("over_time", "composition")])


def _labelled(row: Column, **patterns: str) -> Column:
    """By name of a pattern, the row with its label in one cell, if the first one to four cells, joined with or without a
    blank, fit; else null. The joins are made once for all patterns."""
    tries = [(n, F.array_join(F.slice(row, 1, n), gap)) for n in (1, 2, 3, 4) for gap in ((" ",) if n == 1 else (" ", ""))]
    labels = F.array(*[F.when(F.size(row) >= n, F.struct(F.lit(n).alias("n"), s.alias("s"))) for n, s in tries])

    def fit(short: Column, pattern: str) -> Column:
        first = F.get(F.filter(short, lambda x: x["s"].rlike(pattern)), F.lit(0))
        return let(first, lambda x: F.when(x.isNotNull(), F.concat(F.array(x["s"]), F.slice(row, x["n"] + 1, F.size(row)))))

    short = F.filter(labels, lambda x: F.length(x["s"]) < 150)
    return let(short, lambda short: F.struct(*[fit(short, p).alias(name) for name, p in patterns.items()]))


def _first_row(rows: Column, name: str) -> Column:
    return F.get(F.filter(F.transform(rows, lambda r: r[name]), lambda r: r.isNotNull()), F.lit(0))


def _amount(cell: Column) -> Column:
    """The amount with a currency, else the cell's number if it is one of at least 1 and no percentage."""
    priced = X.ordered_extract(cell, ["(?i)" + X.AMOUNT])
    lone = F.when(~cell.contains("%") & cell.rlike(r"^[^\d]*\d[\d.,]*[^\d]*$"), cell)
    return let(F.struct(priced.isNotNull().alias("priced"), F.coalesce(priced, lone).alias("t")), lambda x: let(X.number(x["t"]), lambda v: F.when(x["priced"] | (v >= 1), v)))


def _values(row: Column, read) -> Column:
    """The values of the cells after the label that have one; a sign apart from its number is put back first."""
    cells = F.split(F.regexp_replace(F.array_join(F.slice(row, 2, F.size(row)), "|||"), r"(\d)\s*\|\|\|\s*%", "$1%"), r"\|\|\|")
    return F.coalesce(F.filter(F.transform(cells, lambda x: read(x)), lambda v: v.isNotNull()), F.array().cast("array<double>"))


def schedule(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, years, amount, pct, recommended): costs and yearly impact by horizon, of documents of the first format.

    The header is the first row that names a time; a row without label below it carries on its cells. Values go with
    horizons in order where there are as many, else by column; one value more than horizons is the recommended period's.
    The recommended period is resolved to the years that the document gives for it (else those in its label) and left out
    without them. Equal horizons become one row: the first value of each kind, recommended if any of them is.
    """
    names_time = lambda x: x.rlike(YEARS) | x.rlike(MONTHS) | x.rlike(PERIOD)
    o = tables(docs, key, text).withColumnsRenamed({"over_time": "o"})
    timed = F.array_position(F.transform("o", lambda r: F.exists(F.slice(r, 2, F.size(r)), names_time)), F.lit(True))
    o = o.select(key, "period", "o", timed.alias("timed"), F.transform("o", lambda r: _labelled(r, total=TOTAL, impact=IMPACT)).alias("marked"))
    data = F.array_position(F.transform("marked", lambda r: F.coalesce(r["total"], r["impact"]).isNotNull()), F.lit(True))
    o = o.select(key, "period", "o", "timed", "marked", data.alias("data"))
    head, below = F.get("o", F.col("timed").cast("int") - 1), F.get("o", F.col("timed").cast("int"))
    carried = F.when((F.get(below, F.lit(0)) == "") & F.exists(below, names_time), below).otherwise(F.array().cast("array<string>"))
    o = o.select(key, "period", "o", "timed", "marked", "data", head.alias("head"), carried.alias("carried"))
    extra = lambda i: F.get("carried", i)
    merged = F.transform("head", lambda x, i: F.when((i > 0) & F.coalesce(names_time(extra(i)), F.lit(False)), F.trim(F.concat_ws(" ", x, extra(i)))).otherwise(x))
    keep = lambda x: (x != "") & ~x.rlike(INVESTED) & (names_time(x) | x.rlike(r"\d") | (F.length(x) >= 7))
    labels = F.when(F.col("timed") > 0, F.filter(F.slice(merged, 2, F.size(merged)), keep)).when(F.col("data") > 0, F.array(F.lit("1 year")))
    rows = F.slice("marked", F.when(F.col("timed") > 0, F.col("timed") + 1).otherwise(F.greatest("data", F.lit(1))).cast("int"), F.size("o"))
    o = o.select(key, "period", labels.alias("labels"), _first_row(rows, "total").alias("total"), _first_row(rows, "impact").alias("impact"))
    inside = F.array_compact(F.array(X.percent(F.get("impact", F.lit(0)))))
    impacts = _values(F.col("impact"), X.percent)
    o = o.select(key, "period", "labels", "total", "impact", _values(F.col("total"), _amount).alias("totals"), F.when(F.size(impacts) > 0, impacts).otherwise(F.coalesce(inside, F.array().cast("array<double>"))).alias("impacts"))
    more = F.greatest(F.size("totals"), F.size("impacts")) > F.size("labels")
    o = o.withColumn("labels", F.when(more, F.concat("labels", F.array(F.lit("RHP")))).otherwise(F.col("labels")))
    each = o.select(key, "period", "total", "impact", "totals", "impacts", F.size("labels").alias("n"), F.posexplode_outer("labels").alias("i", "label"))
    value = lambda values, row, read: F.when(F.size(values) == F.col("n"), F.get(values, F.col("i"))).otherwise(read(F.get(row, F.col("i") + 1)))
    label, given = F.col("label"), horizon(F.col("label"))
    dated = label.rlike(r"\d{1,2}/\d{1,2}/\d{4}") & (F.col("i") == F.col("n") - 1)
    recommended = label.rlike(PERIOD) | (given.isNull() & ((F.col("n") == 1) | dated))
    years = F.round(F.when(recommended | given.isNull(), F.coalesce("period", given)).otherwise(given), 4)
    near = F.coalesce(F.abs(years - F.col("period")) <= 0.01, F.lit(False))
    out = each.select(key, "i", "label", years.alias("years"), value("totals", "total", _amount).alias("amount"), value("impacts", "impact", X.percent).alias("pct"), (recommended | near).alias("recommended")).where("label is not null and years is not null")
    first = lambda x: F.min_by(x, F.when(F.col(x).isNotNull(), F.col("i"))).alias(x)
    return out.groupBy(key, "years").agg(first("amount"), first("pct"), F.max("recommended").alias("recommended"))


def composition(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, per cost line pct, max_pct and eur) from the rows of the composition section alone."""
    # The outer form, as Spark infers a filter from the other one that works every text out a second time.
    rows = tables(docs, key, text).select(key, F.posexplode_outer("composition").alias("row", "c")).where("row > 0")
    return X.composition(rows.select(key, "row", F.get("c", F.lit(0)).alias("label"), F.slice("c", 2, F.size("c")).alias("cells")), key)


def records(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, format, currency, percentages, horizons, impact, ongoing, quality): one row per document, of either format.

    Documents of the second format have no schedule; their ongoing charges stand for one year, and their quality is HIGH
    if they are found, else LOW. ``impact`` is that of the recommended period, else of the longest horizon.
    """
    t = F.col(text)
    heads = docs.select(key, document_format(t).alias("format"), currency(t).alias("currency"), X.percent(F.concat(X.ordered_extract(t, [ONGOING]), F.lit("%"))).alias("ongoing"))
    plan = schedule(docs, key, text).groupBy(key).agg(F.count("*").cast("int").alias("horizons"), F.max_by("pct", F.struct("recommended", "years")).alias("impact"))
    d = heads.join(composition(docs, key, text), key, "left").join(plan, key, "left")
    second, known = F.col("format") == "UCITS_KIID", lambda *names: F.coalesce(*[F.when(F.col(n).isNull(), False) for n in names], F.lit(True))
    ongoing = F.when(second, F.col("ongoing"))
    quality = (
        F.when(second & ongoing.isNotNull(), "HIGH").when(second, "LOW").when(F.col("format") == "UNKNOWN", "NONE")
        .when(known("entry_fee_pct", "management_fee_pct", "transaction_cost_pct", "performance_fee_pct", "horizons"), "HIGH")
        .when(F.col("management_fee_pct").isNotNull(), "MEDIUM").otherwise("NONE")
    )
    horizons = F.when(second, F.when(ongoing.isNotNull(), 1).otherwise(0)).otherwise(F.coalesce("horizons", F.lit(0)))
    return d.select(key, "format", "currency", "entry_fee_pct", "management_fee_pct", "transaction_cost_pct", "performance_fee_pct", horizons.alias("horizons"), F.when(second, ongoing).otherwise(F.col("impact")).alias("impact"), ongoing.alias("ongoing"), quality.alias("quality"))
