"""Attributes from document text: dictionaries, ordered patterns, grids and benchmarks, as native expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .dictionary import match_signals


def escape(signal: str) -> str:
    """A signal as a Java pattern that matches it literally."""
    return re.sub(r"([\\^$.|?*+()\[\]{}])", r"\\\1", signal)


def first_label(text: Column, dictionary: list[tuple[str, list[str]]]) -> Column:
    """The first label, in order, any of whose signals occurs in the text."""
    return F.coalesce(*[F.when(text.rlike("|".join(map(escape, signals))), F.lit(label)) for label, signals in dictionary])


def match_dictionary(docs: DataFrame, text: str, key: str, dictionary: DataFrame, *, most: int = 1_000_000) -> DataFrame:
    """(key, label): the same for a large dictionary (ord, signal, label), lowest ord first, of all rows of a key. All signals
    are found in one pass by an automaton; about ``most`` of them are held at once."""
    hit = match_signals(docs.select(key, text), text, dictionary, part_bytes=32 * most)
    return hit.groupBy(key).agg(F.min(F.when(F.col("match").isNotNull(), F.struct("match.ord", "match.label"))).alias("m")).select(key, F.col("m.label").alias("label"))


def count_hits(text: Column, patterns: list[str]) -> Column:
    return sum((text.rlike(p).cast("int") for p in patterns), F.lit(0))


def route(text: Column, first: list[str], second: list[str], *, least: int = 2) -> Column:
    """FIRST, SECOND or UNKNOWN by the numbers of signal patterns that match; ties go to the first."""
    a, b = count_hits(text, first), count_hits(text, second)
    return F.when((a >= least) & (a >= b), "FIRST").when(b >= least, "SECOND").otherwise("UNKNOWN")


def window_by_format(text: Column, formats: list[tuple[str, str, int, int]], *, head: int = 600) -> Column:
    """The part of the text that its format calls for: (name, signal in the head, start, length), in order."""
    begin = F.substring(text, 1, head)
    return F.coalesce(*[F.when(begin.contains(signal), F.substring(text, start, length)) for _, signal, start, length in formats], F.substring(text, 1, 1000))


def language(text: Column, markers: dict[str, list[str]], fused: dict[str, list[str]] | None = None, *, least: int = 2) -> Column:
    """The first language, in order, of which at least ``least`` marker words occur; then on text without accents; then,
    for texts whose words run together, of which ``fused`` markers occur in text without accents, blanks and line ends."""
    def by(t: Column) -> list[Column]:
        return [F.when(count_hits(t, [rf"(^|[^\p{{L}}]){w}([^\p{{L}}]|$)" for w in words]) >= least, F.lit(code)) for code, words in markers.items()]

    low = F.lower(text)
    bare = F.regexp_replace(fold_accents(low), r"[ \n\r]", "")
    joined = [F.when(sum((bare.contains(w).cast("int") for w in words), F.lit(0)) >= least, F.lit(code)) for code, words in (fused or {}).items()]
    return F.coalesce(*by(low), *by(fold_accents(low)), *joined)


def _marked_letters() -> tuple[str, str]:
    """Letters that decompose to a plain one and combining marks, and the plain ones, by Unicode's own decomposition."""
    marked = [c for c in map(chr, [*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)]) if len(unicodedata.normalize("NFD", c)) > 1]
    plain = ["".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x)) for c in marked]
    pairs = [(c, p) for c, p in zip(marked, plain, strict=True) if len(p) == 1]
    return "".join(c for c, _ in pairs), "".join(p for _, p in pairs)


MARKED, PLAIN = _marked_letters()


def fold_accents(text: Column) -> Column:
    """The text decomposed and without combining marks (of Latin, Greek and Cyrillic letters)."""
    return F.regexp_replace(F.translate(text, MARKED, PLAIN), r"\p{Mn}", "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def number(text: Column) -> Column:
    """A number with European or English separators; a lone separator before three digits groups thousands."""
    return let(F.regexp_replace(F.regexp_replace(F.lower(text), r"^\s*hasta\s+", ""), r"[^0-9.,\-]", ""), _number)


def _number(t: Column) -> Column:
    comma, dot = F.length(t) - F.locate(",", F.reverse(t)), F.length(t) - F.locate(".", F.reverse(t))
    has_comma, has_dot = t.contains(","), t.contains(".")
    last = F.when(comma > dot, F.regexp_replace(F.replace(t, F.lit("."), F.lit("")), ",", ".")).otherwise(F.replace(t, F.lit(","), F.lit("")))
    single = F.when(t.rlike(r"^-?\d{1,3}([.,]\d{3})+$"), F.regexp_replace(t, "[.,]", "")).otherwise(F.regexp_replace(t, ",", "."))
    return F.when(has_comma & has_dot, last).otherwise(single).try_cast("double")


def years(text: Column) -> Column:
    """``1 year``, ``3 months``, ``5Y``, ``10Y+`` to years; a recommended period to -1; else null."""
    low = fold_accents(F.lower(text))
    n = F.regexp_extract(low, r"(\d+)", 1).try_cast("double")
    unit = lambda p: low.rlike(rf"\d+\s*({p})")
    return F.when(low.rlike("recomend|recommend"), F.lit(-1.0)).when(unit("ano|year|y"), n).when(unit("mes|month|m"), n / 12)


def last_match(text: Column, pattern: str) -> Column:
    return F.element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), -1)


def near_anchor(text: Column, anchor: str, *, reach: int = 80) -> Column:
    """The percentage nearest before an anchor phrase within ``reach`` characters, else the first after it."""
    at = F.locate(anchor, text)
    before = F.substring(text, F.greatest(at - reach, F.lit(1)), F.least(F.lit(reach), F.greatest(at - 1, F.lit(0))))
    after = F.substring(text, at + len(anchor), F.lit(reach))
    pattern = r"(\d+(?:[.,]\d+)?)\s*%"
    found = F.coalesce(F.try_element_at(F.regexp_extract_all(before, F.lit(pattern), F.lit(1)), F.lit(-1)), F.try_element_at(F.regexp_extract_all(after, F.lit(pattern), F.lit(1)), F.lit(1)))
    return F.when(at > 0, number(found))


def ordered_extract(text: Column, patterns: list[str]) -> Column:
    """The first group of the first pattern that matches."""
    return F.coalesce(*[_filled(F.regexp_extract(text, p, 1)) for p in patterns])


def _filled(text: Column) -> Column:
    """Null for an empty text; the text is computed once, also inside higher-order functions."""
    return let(text, lambda t: F.when(t != "", t))


def grid(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, row, label, cells) of the lines with ``|||`` between cells."""
    lines = docs.select(key, F.posexplode(F.split(text, "\n")).alias("row", "line")).where(F.col("line").contains("|||"))
    cells = F.filter(F.transform(F.split("line", r"\|\|\|"), lambda x: F.trim(x)), lambda x: x != "")
    return lines.select(key, "row", cells.alias("c")).where(F.size("c") > 0).select(key, "row", F.get("c", F.lit(0)).alias("label"), F.slice("c", 2, F.size("c")).alias("cells"))


def schedule(cells: DataFrame, key: str) -> DataFrame:
    """(key, years, amount, pct): the horizon, cost and impact rows of a grid, cell by cell; equal horizons merge."""
    row = lambda pattern: F.max(F.when(F.lower("label").rlike(pattern), F.col("cells")))
    one = cells.groupBy(key).agg(row("horizon").alias("h"), row("total").alias("t"), row("impact").alias("i")).where("h is not null")
    each = one.select(key, F.explode(F.arrays_zip("h", "t", "i")).alias("x"))
    out = each.select(key, years(F.col("x.h")).alias("years"), number(F.col("x.t")).alias("amount"), number(F.col("x.i")).alias("pct")).where("years is not null")
    return out.groupBy(key, "years").agg(F.max("amount").alias("amount"), F.max("pct").alias("pct"))


# Labels of the five cost lines, the largest percentage that is believed, and the word in a column's name.
COST_LINES = {
    "entry": (r"costes?\s*de\s*entrada|entry\s*(charge|cost)s?", 25.0, "fee"),
    "exit": (r"costes?\s*de\s*salida|exit\s*(charge|cost)s?", 25.0, "fee"),
    "management": (r"comisiones?\s*de\s*gesti[oó]n|management\s*(fee|cost)s?", 5.0, "fee"),
    "transaction": (r"costes?\s*de\s*operaci[oó]n|transaction\s*costs?", 2.0, "cost"),
    "performance": (r"comisiones?\s*(en\s*funci[oó]n\s*de\s*la\s*rentabilidad|de\s*([eé]xito|rendimiento))|performance\s*fees?", 30.0, "fee"),
}
PERCENT = r"(\d+[,.]?\d*)\s*%"
AT_MOST = r"(?i)(?:hasta|up\s+to|m[aá]ximo|maximum|at\s+most)\s+(?:el\s+)?" + PERCENT
AMOUNT = r"(\d{1,3}(?:[.,]\d{3})*(?:[.,]\d{1,2})?)\s*(?:EUR|USD|GBP|CHF|€|\$)"


def percent(text: Column, pattern: str = PERCENT) -> Column:
    """The first percentage of a text; its separator is always the decimal one."""
    return F.replace(_filled(F.regexp_extract(text, pattern, 1)), F.lit(","), F.lit(".")).try_cast("double")


def composition(cells: DataFrame, key: str) -> DataFrame:
    """(key, then per cost line pct, max_pct and eur): of a grid's rows (label, cells), the last of each line that has
    the value. A line is told by the first label pattern that fits; percentages above the line's limit are no costs."""
    line = F.coalesce(*[F.when(F.col("label").rlike("(?i)" + p), F.lit(n)) for n, (p, _, _) in COST_LINES.items()])
    whole = F.concat_ws(" ", "label", F.array_join("cells", " "))
    amounts = F.filter(F.transform("cells", lambda x: number(_filled(F.regexp_extract(x, AMOUNT, 1)))), lambda v: v.isNotNull())
    rows = cells.select(key, "row", line.alias("line"), percent(whole).alias("pct"), percent(whole, AT_MOST).alias("max_pct"), F.get(amounts, F.lit(0)).alias("eur")).where("line is not null")
    out = []
    for name, (_, most, word) in COST_LINES.items():
        for part in ("pct", "max_pct", "eur"):
            fits = (F.col("line") == name) & (F.col(part) <= most if part != "eur" else F.col(part).isNotNull())
            out.append(F.max_by(F.when(fits, F.col(part)), F.when(fits, F.col("row"))).alias(f"{name}_{word}_{part}"))
    return rows.groupBy(key).agg(*out)


def clean_benchmark(text: Column, *, least: int = 4) -> Column:
    """A benchmark phrase without what follows it; null if it is narrative or too short."""
    t = F.trim(F.regexp_replace(F.regexp_replace(text, r"(?i)\s*(,?\s*(which|that)\b|;|\. [A-Z]).*$", ""), r"^[\s\"'(]+|[\s\"'.,;)]+$", ""))
    return F.when(text.rlike(r"(?i)\b(no benchmark|not applicable)\b"), "NO_BENCHMARK").when(~text.rlike(r"(?i)\b(the fund|we|investors)\b") & (F.length(t) >= least), t)


def strip_suffixes(text: Column, pattern: str, times: int) -> Column:
    for _ in range(times):
        text = F.regexp_replace(text, pattern, "")
    return text


def normal_benchmark(text: Column, aliases: list[tuple[str, str]], suffix: str = r"(?i)\s+(index|tr|nr|net|eur|usd|hedged)$", *, strips: int = 4) -> Column:
    """The name of the first alias that begins the text, or the text after up to four suffix strips."""
    steps = [F.upper(strip_suffixes(text, suffix, k)) for k in range(strips + 1)]
    found = [F.when(s.startswith(prefix.upper()), F.lit(name)) for s in steps for prefix, name in aliases]
    return F.coalesce(*found, steps[-1])


def asset_class(text: Column) -> Column:
    equity, bond, rate = text.rlike(r"(?i)equity|stoxx|msci|s&p"), text.rlike(r"(?i)bond|aggregate|treasury"), text.rlike(r"(?i)estr|euribor|eonia")
    return F.when(equity & bond, "Mixed").when(equity, "Equity").when(bond, "Fixed Income").when(rate, "Rate")


def label_heads(docs: DataFrame, text: str, wanted: str, known: str, *, words: int = 2) -> DataFrame:
    """(head, n): first words of the lines that look relevant but miss the pattern."""
    lines = docs.select(F.explode(F.split(text, "\n")).alias("line")).where(F.col("line").rlike(wanted) & ~F.col("line").rlike(known))
    return lines.groupBy(F.array_join(F.slice(F.split(F.lower(F.trim("line")), " +"), 1, words), " ").alias("head")).agg(F.count("*").alias("n"))


def last_block(funds: DataFrame, blocks: list[tuple[str, str, str]], key: str, name: str) -> DataFrame:
    """(key, block): of the blocks (name, include, exclude patterns) that a fund fits, the last."""
    low = F.lower(name)
    fits = F.array_compact(F.array(*[F.when(low.rlike(inc) & ~low.rlike(exc), F.lit(b)) for b, inc, exc in blocks]))
    return funds.select(key, F.try_element_at(fits, F.lit(-1)).alias("block"))


def latest(rows: DataFrame, order: str, *keys: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
