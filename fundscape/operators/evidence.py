"""Values of running text by evidence: nearest to a keyword in one fold, and by votes of ranked patterns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from . import text as X
from .text import let


def nearest(text: Column, keyword: str, value: str, read: Callable[[Column], Column], *, kind: str, reach: int = 80, stop: str = r"[.;!?]\s") -> Column:
    """(distance, before, start, value): of the values that ``read`` accepts, the one nearest to any keyword; null if none.

    Keywords and values are found in one pass in order of place, and one fold over them carries the last of each, because
    the nearest pair is always one of neighbours. A value after its keyword wins over one before it at the same distance,
    then the earlier. Pairs end at ``stop`` and at ``reach`` characters. ``kind`` is the SQL type of a value.
    """
    either = f"(?i)(?:{stop})|(?:{value})|(?:{keyword})"
    whole = lambda p: f"(?is)^(?:{p})$"
    best = "struct<distance:int,before:int,start:int,value:" + kind + ">"
    init = F.struct(F.lit(0).alias("at"), F.lit(None).cast("int").alias("key"), F.lit(None).cast("int").alias("begin"), F.lit(None).cast("int").alias("end"), F.lit(None).cast(kind).alias("value"), F.lit(None).cast(best).alias("best"))

    def step(s: Column, x: Column) -> Column:
        token = x["token"]
        start = s["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(token), F.lit(0))
        stops, is_value = token.rlike(whole(stop)), token.rlike(whole(value))
        return let(F.when(is_value, read(token)), lambda found: after_token(s, start, end, stops, is_value, found))

    def after_token(s: Column, start: Column, end: Column, stops: Column, is_value: Column, found: Column) -> Column:
        is_key = ~stops & ~is_value
        after = F.when(found.isNotNull() & (start - s["key"] <= reach), F.struct((start - s["key"]).alias("distance"), F.lit(0).alias("before"), start.alias("start"), found.alias("value")).cast(best))
        prior = F.when(is_key & s["value"].isNotNull() & (start - s["end"] <= reach), F.struct((start - s["end"]).alias("distance"), F.lit(1).alias("before"), s["begin"].alias("start"), s["value"].alias("value")).cast(best))
        hold = lambda new, when, old: F.when(stops, None).when(when, new).otherwise(old)
        return F.struct(
            end.alias("at"), hold(end, is_key, s["key"]).cast("int").alias("key"), hold(start, found.isNotNull(), s["begin"]).cast("int").alias("begin"), hold(end, found.isNotNull(), s["end"]).cast("int").alias("end"),
            hold(found, found.isNotNull(), s["value"]).cast(kind).alias("value"), F.least(s["best"], F.coalesce(after, prior)).alias("best"),
        )

    gaps, tokens = F.split(text, either, -1), F.regexp_extract_all(text, F.lit(either), F.lit(0))
    pairs = F.transform(gaps, lambda g, i: F.struct(g.alias("gap"), F.get(tokens, i).alias("token")))
    return F.aggregate(pairs, init, step, lambda s: s["best"])


# Words near a date of publication, how dates are written, and months.
MONTHS = {
    "ES": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split(),
    "EN": "january february march april may june july august september october november december".split(),
    "FR": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split(),
}
DATE_WORDS = {
    "ES": "documento|publicad[oa]|publicaci[oó]n|public[oó]|v[aá]lid[oa]|actualiza(?:do|da|ci[oó]n)",
    "EN": "date of publication|published on|published|updated|valid as (?:at|of)",
    "FR": "date de publication|publi[eé]e?|mise? [aà] jour|valable",
}
DATE_FORMS = {"ES": r"\d{1,2} de \p{L}+ de \d{4}", "EN": r"\d{1,2} \p{L}+ \d{4}", "FR": r"\d{1,2}(?:er)? \p{L}+ \d{4}"}


def date_of(token: Column, language: str) -> Column:
    """The date of ``dd/mm/yyyy`` or of day, month name and year; null if there is no such day."""
    day, year = F.regexp_extract(token, r"^(\d{1,2})", 1), F.regexp_extract(token, r"(\d{4})$", 1)
    name = F.regexp_replace(F.lower(F.regexp_extract(token, r"(\p{L}{3,})", 1)), "^setiembre$", "septiembre")
    named = F.array_position(F.array(*map(F.lit, MONTHS[language])), name).cast("string")
    month = F.when(token.contains("/"), F.regexp_extract(token, r"/(\d{1,2})/", 1)).otherwise(named)
    number = F.struct(year.try_cast("int").alias("y"), month.try_cast("int").alias("m"), day.try_cast("int").alias("d"))
    known = lambda x: x["m"].between(1, 12) & (x["y"] >= 1) & (x["d"] >= 1)
    first = lambda x: F.when(known(x), F.make_date(x["y"], x["m"], F.lit(1)))
    return let(number, lambda x: F.when(x["d"] <= F.dayofmonth(F.last_day(first(x))), F.date_add(first(x), x["d"] - 1)))


def published_date(text: Column, language: Column, *, reach: int = 80) -> Column:
    """The date nearest to a word for publication, in the text's language (ES, EN or FR); null for others."""
    flat = F.regexp_replace(F.lower(text), r"[\n\r ]", " ")
    form = lambda code: r"\b\d{1,2}/\d{1,2}/\d{4}\b|\b" + DATE_FORMS[code] + r"\b"
    found = lambda t: F.coalesce(*[F.when(language == code, nearest(t, words, form(code), lambda x, code=code: date_of(x, code), kind="date", reach=reach)["value"]) for code, words in DATE_WORDS.items()])
    return let(flat, found)


# Statements that there is no entry fee, words for it, and the largest that is believed (percent).
NO_ENTRY_FEE = (
    r"(?i)no\s+hay\s+gastos?\s+de\s+entrada|sin\s+cargo\s+(?:de\s+entrada|inicial)|no\s+(?:se\s+)?cobr(?:an|a|amos)\s+(?:gastos|comisi[oó]n)\s+de\s+entrada"
    r"|no\s+front[\s\-]?end\s+(?:load|charge|fee)|no\s+sales\s+charge|no\s+initial\s+charge|(?:entry|initial)\s+(?:charge|fee)\s*[:\-]\s*(?:nil|none|n/a)"
    r"|no\s+(?:entry|subscription)\s+(?:charge|fee)|pas\s+de\s+frais\s+d.entr[eé]e"
)
ENTRY_FEE = (
    r"costes?\s+de\s+entrada|comisi[oó]n\s+de\s+(?:suscripci[oó]n|entrada)|gastos?\s+de\s+entrada|cargo\s+inicial"
    r"|entry\s+(?:charges?|fees?|costs?)|front[\s\-]?end\s+load|sales\s+charge|initial\s+charge|frais\s+d.entr[eé]e"
)
CEILING = r"hasta(?:\s+(?:el|un\s+m[aá]ximo\s+del))?|up\s+to|m[aá]ximo(?:\s+del?)?|maximum(?:\s+of)?|jusqu.[aà]"
MOST_FEE = 10.0


def entry_fee(text: Column, *, most: float = MOST_FEE, reach: int = 200) -> Column:
    """(fee, origin): a statement of none is ZERO and 0; else the percentage nearest to a word for the fee: TEXT, CEILING if
    it is given as the most that may be asked, OUT_OF_RANGE (without a fee) above ``most``; NOT_FOUND (null) otherwise."""
    value = r"(?:\b(?:" + CEILING + r")\s+)?\d+(?:[.,]\d+)?\s*%"
    read = lambda t: F.struct(X.percent(t).alias("pct"), t.rlike("(?i)^(?:" + CEILING + ")").alias("ceiling"))
    none = F.coalesce(text.rlike(NO_ENTRY_FEE), F.lit(False))
    return let(nearest(text, ENTRY_FEE, value, read, kind="struct<pct:double,ceiling:boolean>", reach=reach)["value"], lambda hit: _fee(none, hit, most))


def _fee(none: Column, hit: Column, most: float) -> Column:
    fee = F.when(none, 0.0).when(hit["pct"] <= most, hit["pct"])
    origin = F.when(none, "ZERO").when(hit["pct"] > most, "OUT_OF_RANGE").when(hit["ceiling"], "CEILING").when(hit["pct"].isNotNull(), "TEXT").otherwise("NOT_FOUND")
    return F.struct(fee.alias("fee"), origin.alias("origin"))


def votes(levels: list[tuple[str, Column, list[str], bool]]) -> Column:
    """(value, level, n): every match of a level's patterns votes with its first group; levels count in order.

    A level (name, text, patterns, final) whose votes agree gives their value; one whose votes differ gives a null value and
    the level ``name_CONFLICT`` if it is final, else the next level is asked. Null if no level has votes.
    """
    each = []
    for name, text, patterns, final in levels:
        found = F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in patterns]))
        each.append(F.struct(F.lit(name).alias("name"), F.lit(final).alias("final"), F.coalesce(found, F.array().cast("array<string>")).alias("found")))
    counted = F.transform(F.array(*each), lambda x: F.struct(x["name"], x["final"], F.array_distinct(x["found"]).alias("kinds"), F.size(x["found"]).alias("n")))
    heard = F.filter(counted, lambda x: (F.size(x["kinds"]) == 1) | (x["final"] & (F.size(x["kinds"]) > 1)))
    agreed = lambda x: F.size(x["kinds"]) == 1
    told = lambda x: F.struct(F.when(agreed(x), F.get(x["kinds"], F.lit(0))).alias("value"), F.when(agreed(x), x["name"]).otherwise(F.concat(x["name"], F.lit("_CONFLICT"))).alias("level"), x["n"].alias("n"))
    return F.get(F.transform(heard, told), F.lit(0))


# What is removed before risk classes are read, and the statements of a class, most reliable first.
RISK_NOISE = [
    r"(?:documento\s+de\s+datos\s+fundamentales|key\s+(?:investor\s+)?(?:information\s+)?document)\s*\d+\s*[/\\]\s*\d+",
    r"(?:page|pagina|página|seite)\s*\d+\s*(?:of|de|von|/)\s*\d+", r"\b(?:19|20)\d{2}\b",
    r"\b\d+\s*(?:año|años|year|years|an|ans|jahr|jahre)\b", r"-?\d+(?:[,.]\d+)?\s*%",
]
RISK_FUSED = ["clasederiesgo([1-7])enunaescala", "clasederiesgo([1-7])enescalade", r"laclasederiesgo([1-7])[,.\s]"]
RISK_DECLARED = [
    r"hemos\s+clasificado\s+este\s+(?:producto|fondo|subfondo)\s+en\s+la\s+(?:clase\s+de\s+riesgo|categor[ií]a)\s+([1-7])",
    r"hemos\s+asignado\s+(?:a\s+este\s+(?:producto|fondo|subfondo)\s+)?la\s+clase\s+de\s+riesgo\s+([1-7])",
    r"nivel\s+de\s+riesgo\s+([1-7])\s+(?:de\s+7|en\s+una\s+escala)", r"nivel\s+de\s+riesgo\s*[:=]\s*([1-7])\b",
    r"we\s+have\s+classified\s+this\s+(?:product|fund)\s+(?:as\s+)?(?:class\s+)?([1-7])\s+(?:out\s+of\s+7|of\s+7)",
    r"risk\s+class\s+([1-7])\s+(?:on\s+a\s+scale|out\s+of)", r"en\s+classe\s+de\s+risque\s+([1-7])\s+sur\s+7",
]
RISK_STATED = [
    r"indicador\s+sint[eé]tico\s+de\s+riesgo\s+(?:es|:)\s*([1-7])", r"categor[ií]a\s+([1-7])\s+de\s+7", r"summary\s+risk\s+indicator\s+(?:is|:)\s*([1-7])",
    r"\brisk\s+(?:class|category)\s+([1-7])\b", r"cat[eé]gorie\s+([1-7])\s+sur\s+7", r"risikoklasse\s+([1-7])\b",
]
RISK_WORDS = r"srri|synthetic risk|summary risk|indicador sint|indicateur synth|risikoindikator|risiko"


def risk_class(text: Column, *, window: int = 116) -> Column:
    """(value, level): a class of 1 to 7 by votes: run-together text (L0_FUSED), declarations (L0), statements (L1), else
    the digit nearest to a word for the indicator, within ``window`` (L2). Votes that differ give no value but a conflict."""
    clean = F.regexp_replace(F.lower(text), r"\s+", " ")
    for p in RISK_NOISE:
        clean = F.regexp_replace(clean, p, " ")

    def judged(clean: Column) -> Column:
        voted = votes([("L0_FUSED", F.replace(clean, F.lit(" "), F.lit("")), RISK_FUSED, False), ("L0", clean, RISK_DECLARED, True), ("L1", clean, RISK_STATED, True)])
        close = nearest(clean, RISK_WORDS, r"\b[1-7]\b", lambda t: t, kind="string", reach=window)["value"]
        near = let(close, lambda v: F.struct(v.cast("int").alias("value"), F.when(v.isNotNull(), "L2").alias("level")))
        return let(voted, lambda v: F.when(v.isNull(), near).otherwise(F.struct(v["value"].cast("int").alias("value"), v["level"].alias("level"))))

    return let(clean, judged)


def risk_grade(drawn: Column, told: Column, level: Column) -> Column:
    """(status, quality) of a class read from a drawing and one from text. A drawn 1 against a declared class is most
    likely a page number: the text is used then."""
    pairs = [
        (drawn.isNull() & told.isNull(), "NOT_AVAILABLE", "NONE"), (drawn.isNull(), "TEXT_ONLY", "MEDIUM_TEXT"), (told.isNull(), "VISUAL_ONLY", "MEDIUM_VISUAL"),
        (drawn == told, "MATCH", "HIGH"), ((drawn == 1) & level.isin("L0", "L0_FUSED"), "VISUAL_SUSPICIOUS", "MEDIUM_TEXT"), (F.lit(True), "CONFLICT", "LOW_CONFLICT"),
    ]
    return F.coalesce(*[F.when(cond, F.struct(F.lit(status).alias("status"), F.lit(quality).alias("quality"))) for cond, status, quality in pairs])
