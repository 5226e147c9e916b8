"""Layered evidence with vetoes and overrides, natures of funds by it, and benchmark names from running text."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, functions as F

from . import text as X
from .evidence import let


class Layer(NamedTuple):
    """One kind of evidence: its name, what it says (null: nothing), and where from."""

    name: str
    value: Column
    source: Column | None = None


class Guard(NamedTuple):
    """A rule over layers. Where ``when`` holds, it vetoes the layers ``layers`` (None: all) that say one of ``values``
    (None: anything), or, with ``to``, gives the resolved value ``to`` if that is one of ``values`` (None among them: no
    value) and comes from one of ``layers``."""

    name: str
    when: Column
    values: Sequence[str | None] | None = None
    layers: Sequence[str] | None = None
    to: Column | None = None


def cascade(layers: Sequence[Layer], guards: Sequence[Guard] = ()) -> Column:
    """(value, layer, source, guards): the value of the first layer that says something and is not vetoed, after overrides.

    Vetoes look at each layer alone, so the next layer decides where one is vetoed; overrides apply in order to what is
    resolved then, and see each other's results. ``layer`` and ``source`` stay those of the evidence, or null without any.
    ``guards`` names what fired: the vetoes that took evidence away, in order of layers, then the overrides. Null
    conditions don't hold.
    """
    empty = F.array().cast("array<string>")
    unnamed = F.lit(None).cast("string")
    entries = []
    for layer in layers:
        vetoes = [g for g in guards if g.to is None and (g.layers is None or layer.name in g.layers)]

        def entry(said: Column, layer=layer, vetoes=vetoes) -> Column:
            hit = [F.when(said.isNotNull() & _among(said, g.values) & F.coalesce(g.when, F.lit(False)), F.lit(g.name)) for g in vetoes]
            fired = F.array_compact(F.array(*hit)) if hit else empty
            return F.struct(said.alias("value"), F.lit(layer.name).alias("layer"), (unnamed if layer.source is None else layer.source.cast("string")).alias("source"), fired.alias("guards"))

        said = layer.value.cast("string")
        entries.append(let(said, entry) if vetoes else entry(said))

    def resolve(rows: Column) -> Column:
        standing = F.filter(rows, lambda x: x["value"].isNotNull() & (F.size(x["guards"]) == 0))
        vetoed = F.flatten(F.transform(rows, lambda x: x["guards"]))
        first = F.get(standing, F.lit(0))
        out = F.struct(first["value"].alias("value"), first["layer"].alias("layer"), first["source"].alias("source"), vetoed.alias("guards"))
        for g in (g for g in guards if g.to is not None):
            out = let(out, lambda s, g=g: _override(s, g))
        return out

    return let(F.array(*entries), lambda rows: resolve(rows))


def _among(value: Column, values: Sequence[str | None] | None) -> Column:
    if values is None:
        return F.lit(True)
    named = [v for v in values if v is not None]
    return F.coalesce(value.isin(*named) if named else F.when(value.isNotNull(), F.lit(False)), F.lit(None in values))


def _override(s: Column, g: Guard) -> Column:
    there = F.lit(True) if g.layers is None else F.coalesce(s["layer"].isin(*g.layers), F.lit(False))
    holds = F.coalesce(g.when, F.lit(False)) & _among(s["value"], g.values) & there
    value = F.when(holds, g.to.cast("string")).otherwise(s["value"])
    fired = F.when(holds, F.concat(s["guards"], F.array(F.lit(g.name)))).otherwise(s["guards"])
    return F.struct(value.alias("value"), s["layer"].alias("layer"), s["source"].alias("source"), fired.alias("guards"))


# Natures, the one of bonds whose term is open, and phrases (of lower-case text or names) that tell them.
MONEY, SHORT_BONDS, BONDS, SHARES, MIXED, OTHER, STRUCTURED, REST = "Monetario", "Renta Fija Corto Plazo", "Renta Fija Flexible", "Renta Variable", "Mixtos", "Alternativo", "Estructurado", "Restantes"
OPEN_BONDS = "bonds"
STRUCTURED_TEXT = ["autocall", "capital protected", "capital protection", "capital guarantee", "capital garantizado", "structured note", "nota estructurada", "barrier", "knock-in", "knock in"]
MONEY_TEXT = [
    "money market fund", "fondo del mercado monetario", "fondo monetario", "monetary fund", "ucits mmf", "standard money market", "short term money market", "short-term money market", "fondsmonétaire",
    "geldmarktfonds", "instrumentos del mercado monetario", "vencimiento medio ponderado", "activos en instrumentos del mercado", "mercados monetarios", "money market instruments", "weighted average maturity",
]
NOT_MONEY_TEXT = ["renta variable", "renta fija", "acciones", "equity", "fixed income", "instrumentos financieros derivados", "instrumentos de crédito", "ucits", "ocivm", "colectiva en valores mobiliarios"]
ABSOLUTE_TEXT = ["absolute return", "retorno absoluto", "rendimiento positivo independientemente", "positive return regardless", "en cualquier entorno de mercado", "market neutral", "long/short", "long short"]
CASH_TEXT = ["€str", "estr", "eonia", "sonia", "sofr", "overnight", "tasa libre de riesgo"]
MAIN_SHARES_TEXT = [
    "primarily in equities", "mainly in equities", "principally in equities", "invierte principalmente en acciones", "invest in shares", "invierte en acciones", "equity securities", "invests mainly in shares",
    "fondo de renta variable", "acciones y otros valores", "acciones de empresas", "acciones emitidas por", "en acciones de", "valores de renta variable", "principalmente en acciones", "invirtiendo en acciones",
]
MAIN_BONDS_TEXT = [
    "primarily in bonds", "mainly in bonds", "principally in bonds", "invierte principalmente en bonos", "invierte en bonos", "fixed income securities", "fixed income fund", "renta fija", "fixed income", "bond fund",
    "fondo de bonos", "debt securities", "debt fund", "títulos de deuda", "deuda soberana", "deuda corporativa", "bonos corporativos", "grado de inversión", "investment grade bonds", "bonos de alto rendimiento",
]
SHARES_TEXT = ["acciones ordinarias", "acciones emitidas", "cartera de acciones", "shares of companies", "company shares", "common shares", "invertir en renta variable", "renta variable de", "renta variable global", "acciones de compañías", "acciones de sociedades"]
BONDS_TEXT = ["bonos soberanos", "bonos y otros", "valores de deuda", "obligaciones", "en bonos y", "bond securities", "floating rate notes", "high yield bonds", "investment grade", "calificación crediticia"]
MIXED_TEXT = [
    "tanto acciones como bonos", "both equities and bonds", "equities and bonds", "stocks and bonds", "acciones y bonos", "renta variable y renta fija", "multiactivo", "multi-asset", "asset allocation",
    "asignación de activos", "múltiples clases de activos", "varias clases de activos", "multiple asset class", "diversas clases de activos", "diferentes clases de activos",
]
SHORT_TEXT = ["short term", "short-term", "short duration", "corto plazo", "ultra short", "low duration", "baja duración"]
LINKED_TEXT = ["inflation-linked", "inflation linked", "bonos indexados a la inflación", "ligado a la inflación", "linked to inflation"]
NAME_SIGNALS = [
    (STRUCTURED, ["autocall", "garantizado", "guaranteed", "protected", "structured"]),
    (OTHER, ["absolute return", "retorno absoluto", "long/short", "long short", "market neutral", "hedge", "commodit", "managed futures"]),
    (MONEY, ["money market", "monetario", "liquidity", "cash", "tesorer"]),
    (SHORT_BONDS, ["short term bond", "short duration", "short-term bond", "renta fija corto", "ultra short"]),
    (MIXED, ["mixto", "mixed", "balanced", "multi-asset", "multi asset", "allocation"]),
    (BONDS, ["bond", "renta fija", "fixed income", "credit", "high yield", "income fund"]),
    (SHARES, ["equity", "equities", "renta variable", "acciones", "shares", "smaller companies", "small cap"]),
]
BENCHMARK_NATURES = {"Equity": SHARES, "Fixed Income": BONDS, "Rate": MONEY, "Commodity": OTHER, "Mixed": MIXED}


def any_of(text: Column, phrases: Sequence[str]) -> Column:
    """Whether one of the phrases occurs; false for null texts."""
    return F.coalesce(text.rlike("|".join(map(X.escape, phrases))), F.lit(False))


def text_nature(text: Column, *, head: int = 4000) -> Column:
    """(value, source): what a document's wording says, by the first rule that fits; both null if none does.

    Of a text that is mainly on bonds and mentions shares nothing is said: the name is to decide. Wording of money markets
    counts in the first ``head`` characters only.
    """
    flags = {"structured": STRUCTURED_TEXT, "absolute": ABSOLUTE_TEXT, "cash": CASH_TEXT, "main_shares": MAIN_SHARES_TEXT, "main_bonds": MAIN_BONDS_TEXT, "shares": SHARES_TEXT, "bonds": BONDS_TEXT, "mixed": MIXED_TEXT}

    def decide(f: Column) -> Column:
        shares, bonds = f["main_shares"] | f["shares"], f["main_bonds"] | f["bonds"]
        rules = [
            ("structured", f["structured"], STRUCTURED),
            ("money", f["money"], MONEY),
            ("absolute", f["absolute"] & f["cash"], OTHER),
            ("main_shares", f["main_shares"] & ~f["main_bonds"], SHARES),
            ("main_bonds", f["main_bonds"] & ~shares, OPEN_BONDS),
            ("bonds_with_shares", f["main_bonds"] & ~f["main_shares"], None),
            ("mixed", f["mixed"], MIXED),
            ("absolute_mix", shares & bonds & f["absolute"], OTHER),
            ("both", shares & bonds, MIXED),
            ("bonds", bonds, OPEN_BONDS),
            ("shares", shares, SHARES),
        ]
        found = F.coalesce(*[F.when(holds, F.struct(F.lit(value).cast("string").alias("value"), F.lit(name).alias("source"))) for name, holds, value in rules])
        return F.struct(found["value"].alias("value"), F.when(found["value"].isNotNull(), found["source"]).alias("source"))

    low = F.lower(text)
    return let(low, lambda t: let(F.struct(any_of(F.substring(t, 1, head), MONEY_TEXT).alias("money"), *[any_of(t, p).alias(n) for n, p in flags.items()]), decide))


def fund_nature(name: Column, text: Column, benchmark_class: Column, risk: Column, *, signals: Sequence[tuple[str, Sequence[str]]] = NAME_SIGNALS, named: Column | None = None, head: int = 4000) -> Column:
    """The nature of a fund as a ``cascade``: wording of its document, its name, the class of its benchmark, its risk class.

    ``text`` is the part of the document that tells its aim; ``named`` is what a larger dictionary says of the name (see
    ``match_signals``) in place of ``signals``. Vetoes: wording of money markets beside words for other funds. Overrides:
    bonds of open term are short if name or text says so and nothing is linked to inflation; a risk class of 5 or more makes
    money market, short bond and unknown funds shares; what nothing tells is ``Restantes``. Null texts and names say nothing.
    """
    low, title = F.lower(text), F.lower(name)
    by_risk = F.when(risk == 1, MONEY).when(risk >= 5, SHARES).when(risk == 2, OPEN_BONDS)
    by_class = F.coalesce(*[F.when(benchmark_class == k, F.lit(v)) for k, v in BENCHMARK_NATURES.items()])
    short = any_of(title, SHORT_TEXT) | any_of(low, SHORT_TEXT)
    linked = any_of(low, LINKED_TEXT)
    guards = [
        Guard("other_than_money", any_of(F.substring(low, 1, head), NOT_MONEY_TEXT), [MONEY], ["text"]),
        Guard("linked_bonds", linked, [OPEN_BONDS], to=F.lit(BONDS)),
        Guard("short_bonds", short, [OPEN_BONDS], to=F.lit(SHORT_BONDS)),
        Guard("flexible_bonds", F.lit(True), [OPEN_BONDS], to=F.lit(BONDS)),
        Guard("high_risk", risk >= 5, [MONEY, SHORT_BONDS, None], to=F.lit(SHARES)),
        Guard("nothing_known", F.lit(True), [None], to=F.lit(REST)),
    ]
    by_name = X.first_label(title, [(label, list(words)) for label, words in signals]) if named is None else named
    told = lambda t: cascade([Layer("text", t["value"], t["source"]), Layer("name", by_name), Layer("benchmark", by_class, benchmark_class), Layer("risk", by_risk, risk)], guards)
    return let(text_nature(text, head=head), told)


# Regions by words of a name, by index names and by the aim that a text states; natures of liquid funds.
LIQUID = [MONEY, SHORT_BONDS]
REGIONS_IN_NAMES = [("EEUU", r"\b(?:US|USA|AMERICAN|AMERIC)\b"), ("Europa", r"\b(?:EUROP|EURO(?!\s*STR))\b"), ("China", r"\bCHINA\b|\bCHN\b"), ("Asia", r"\bASIA\b")]
REGIONS_OF_INDICES = [
    ("EEUU", r"\brussell\s+\d{4}\b|\bmsci\s+usa\b"), ("China", r"\bmsci\s+china\b|\bcsi\s*300\b|\bhang\s+seng\b"),
    ("Global", r"\bmsci\s+(?:ac\s+)?world\b|\bmsci\s+acwi\b|\bmsci\s+all\s+country\b|\bbloomberg\s+global\b|\bftse\s+all.?world\b"),
    ("Europa", r"\bmsci\s+europe\b|\beuro\s+stoxx\b|\bstoxx\s+europe\b|\bbloomberg\s+euro.?aggregate\b"), ("Emergentes", r"\bmsci\s+emerging\b|\bmsci\s+frontier\b|\bmsci\s+em\b"),
]
AIM = r"(?i)(?:invierte|principalmente|invertir|mayormente)[\s\S]{0,60}?"
AIM_US, AIM_ASIA = AIM + r"(?:estados\s+unidos|norteam[eé]rica|ee\.?uu\.?\b)", AIM + r"(?:\basia\b|asi[aá]ticos?)"


def _first_pattern(text: Column, labelled: Sequence[tuple[str, str]]) -> Column:
    return F.coalesce(*[F.when(text.rlike("(?U)" + p), F.lit(label)) for label, p in labelled])


def region(universe: Column, currency: Column, name: Column, benchmark: Column, text: Column, nature: Column) -> Column:
    """The region of a fund as a ``cascade`` of five layers: its universe if global, a liquid universe's currency, its name, its
    benchmark, and the aim that its text states. Vetoes: names, benchmarks and texts say nothing of liquid funds; a text that
    names two regions says none."""
    us, asia = text.rlike(AIM_US), text.rlike(AIM_ASIA)
    by_currency = F.when((universe == "Liquidity") & (currency == "EUR"), "Europa").when((universe == "Liquidity") & (currency == "USD"), "EEUU")
    layers = [
        Layer("universe", F.when(universe == "Global", "Global"), universe),
        Layer("currency", by_currency, currency),
        Layer("name", _first_pattern(F.upper(name), REGIONS_IN_NAMES), name),
        Layer("benchmark", _first_pattern(F.lower(benchmark), REGIONS_OF_INDICES), benchmark),
        Layer("text", F.when(us, "EEUU").when(asia, "Asia")),
    ]
    guards = [Guard("liquid", nature.isin(*LIQUID), layers=["name", "benchmark", "text"]), Guard("two_regions", us & asia, layers=["text"])]
    return cascade(layers, guards)


# Words of names and of texts for the attributes of a share class, and regions that are one country.
UNHEDGED_NAME = ["unhedged", "sin cobertura", "no cubierto", "no hedged", "not hedged"]
HEDGED_NAME = ["hedged", "(h)", "- h)", " h eur", "hdg", "cubierto", "cubierta divisa", "hgd"]
HEDGED_CODE = r"\b(?:eur|usd|gbp|chf)h(?:\s|$)"
UNHEDGED_TEXT = ["no está cubierta", "no cubre el riesgo de cambio", "is not hedged", "currency risk is not hedged"]
HEDGED_TEXT = ["clase cubierta", "cobertura del riesgo de cambio", "is hedged", "currency hedging"]
ACC_NAME = ["acc", "accumulation", "acumulación", "acumulacion", "capitalización", "capitalizacion", "cap ", "(c)", "thesaurisant", "thesaurisierung", "re-invest"]
DIST_NAME = ["dist", "distribution", "distribución", "distribucion", "income", "dividend", "rte", "reparto", "ausschüttend", "distributing"]
ACC_TEXT = ["acumula los rendimientos", "reinvierte los rendimientos", "accumulates income", "reinvests income"]
DIST_TEXT = ["distribuye los rendimientos", "reparte los rendimientos", "distributes income", "pays dividends"]
SMALL, LARGE = ["small cap", "smaller companies", "small & mid", "pequeñas compañías"], ["large cap", "blue chip", "grandes compañías", "mega cap"]
ESG_NAME = ["esg", "sustainable", "sostenible", "sri ", "climate", "responsible", "impact"]
COUNTRIES = ["China", "Japón", "India", "Reino Unido", "España"]


def characterize(name: Column, text: Column, nature: Column, given: dict[str, Column] | None = None) -> Column:
    """Attributes of a fund as a struct, each a ``cascade`` of what is given, its name, its text and a default: currency_hedged,
    accumulation_policy, market_cap_focus (only of funds of shares), is_esg and, from the region given or named, universe.

    Names and texts are compared in lower case; denials come before what they deny. Null names and texts say nothing.
    """
    given = given or {}
    none = F.lit(None).cast("string")
    place = F.coalesce(given.get("region", none), _first_pattern(F.upper(name), REGIONS_IN_NAMES))
    two = lambda t, a, b: X.first_label(t, [("Accumulation", a), ("Distribution", b)])

    def decide(v: Column) -> Column:
        title, low, kind = v["title"], v["low"], v["nature"]
        pre = lambda k: Layer("given", given.get(k, none))
        hedged = F.coalesce(X.first_label(title, [("Unhedged", UNHEDGED_NAME), ("Hedged", HEDGED_NAME)]), F.when(title.rlike(HEDGED_CODE), "Hedged"))
        caps = [Layer(n, X.first_label(t, [("Small", SMALL), ("Large", LARGE)])) for n, t in (("name", title), ("text", low))]
        wide = F.when(v["place"] == "Global", "Global").when(v["place"].isin(*COUNTRIES), "Country").when(v["place"].isNotNull(), "Regional")
        out = {
            "currency_hedged": cascade([pre("currency_hedged"), Layer("name", hedged), Layer("text", X.first_label(low, [("Unhedged", UNHEDGED_TEXT), ("Hedged", HEDGED_TEXT)]))]),
            "accumulation_policy": cascade([pre("accumulation_policy"), Layer("name", two(title, ACC_NAME, DIST_NAME)), Layer("text", two(low, ACC_TEXT, DIST_TEXT))]),
            "market_cap_focus": cascade([pre("market_cap_focus"), *caps], [Guard("not_shares", F.coalesce(kind != SHARES, F.lit(True)))]),
            "is_esg": cascade([pre("is_esg"), Layer("name", F.when(any_of(title, ESG_NAME), "1")), Layer("default", F.lit("0"))]),
            "universe": cascade([pre("universe"), Layer("nature", F.when(kind.isin(*LIQUID), "Liquidity")), Layer("region", wide, v["place"])]),
        }
        return F.struct(*[x.alias(k) for k, x in out.items()])

    return let(F.struct(F.lower(name).alias("title"), F.lower(text).alias("low"), nature.alias("nature"), place.alias("place")), decide)


# Makers of indices and rates, what index names end with, what ends a name in running text, words that no name
# has, statements that there is no benchmark, and phrases before one.
PROVIDERS = (
    r"msci|bloomberg|barclays|ftse|russell|s&p|stoxx|euro\s*stoxx|eurostoxx|nasdaq|dow\s+jones|nikkei|topix|hang\s+seng|dax|cac|ibex|omx|tsx|asx"
    r"|iboxx|\bice\b|bofa(?:ml)?|merrill\s+lynch|jp\s+morgan|jpmorgan|solactive|morningstar|markit|itraxx|cdx|korea|kospi|sensex|nifty|bse"
    r"|€str|\bestr\b|euribor|libor|\bsofr\b|sonia|tona|tonar"
)
NAME_ENDS = r"index|índice|net\s+(?:tr|return)|total\s+return|nr\b|gross\s+return|net\s+div(?:idend)?\s+reinvested|capitaliz[ae]d|compounded|\(net\)|\(nr\)|\(total\s+return\)"
ENDERS = (
    r"\s+(?:el|la|se|del|de\s+la|en|que|y\s+(?:el|la)|cobertura|consúltese|para|usos?|derivados|apartado|exclusiones|con\s+fines|método\s+de|gestionar|limitaciones|indicativo|solamente"
    r"|ingresos|inversor|acumula|distribuc|partici|folleto|anual|trimestral|semestral|por\s+lo|informaci|precio|clase|riesgos?|rentabilidad|productos?|inversi[oó]n|p[aá]gina|documento|adem[aá]s"
    r"|which|that|and\s+the|over|as\s+its|in\s+order|for|is|management|limited|bank|centre|business)\b|[.;\n¿?]|,\s+(?:un|an?|which)\b|\s+\((?:el|la|un|the)\s|\),?\s+\p{L}{3,}"
)
NO_NAME = r"asset\s+management|\basset$|gestoras?\b|depositario|administrad|domiciliado|registrad|subgestor|\b(?:riesgo|podría|obtener|cambio|hemos|clasificado|producto|página|documento|inversor)\b"
NO_BENCHMARK = (
    r"no\s+tiene\s+ningún\s+valor\s+de\s+referencia|se\s+gestiona\s+sin\s+(?:utilizar\s+(?:un\s+)?)?índice\s+de\s+referencia|sin\s+índice\s+de\s+referencia"
    r"|no\s+está\s+gestionado\s+con\s+referencia\s+a\s+ningún\s+índice|no\s+toma\s+como\s+referencia\s+ning[uú]n\s+valor|rentabilidad\s+del\s+fondo\s+no\s+se\s+compara"
    r"|(?:no|ni)\s+está\s+(?:limitado|referenciado)\s+por\s+ning|no\s+sigue\s+ning[uú]n\s+[íi]ndice|sin\s+referencia\s+a\s+ning[uú]n\s+[íi]ndice|gestionado\s+activamente\s+(?:y\s+)?(?:sin|no)"
    r"|no\s+pretende\s+(?:replicar|seguir)\s+ning[uú]n\s+(?:[íi]ndice|valor)|not\s+managed\s+(?:with\s+reference|in\s+relation)\s+to\s+(?:any|an?)\s+(?:index|benchmark)"
    r"|does\s+not\s+track\s+(?:any|an?)\s+(?:index|benchmark)|no\s+benchmark"
)
RATE = r"€str|estr|ester|eonia|sofr|sonia|saron|euribor[^\s,.]{0,15}|tonar?"
RATES = [
    r"[íi]ndice\s+de\s+referencia\s*:\s*(" + RATE + r")\b", r"utilizar\s+el\s+(" + RATE + r")\s+para\s+comparar", r"comparar\s+la\s+rentabilidad[^.]{0,40}?\b(" + RATE + r")\b",
    r"en\s+consonancia\s+con\s+(?:el\s+tipo\s+)?(" + RATE + r")\b", r"rentabilidad\s+acorde\s+con[^.]{0,60}?\b(" + RATE + r")\b", r"in\s+line\s+with\s+(?:the\s+)?(" + RATE + r")\b",
]
LABELS = [
    r"índice\s+de\s+referencia\s*(?:de\s+la\s+clase\s+de\s+(?:acciones|participaciones)\s*)?[:\-]\s*([^\n]{8,130})", r"valor\s+de\s+referencia\s*:\s*([^\n]{8,130})", r"benchmark(?:\s+index)?\s*:\s*([^\n]{8,130})",
    r"índice\(?s?\)?\s+de\s+referencia\s+(?!de\s+la\s+clase)([^\n]{8,130})", r"índice\s+de\s+referencia\s*\n\s*([^\n]{8,130})",
]
ACTIONS = [
    r"(?:superar|batir|supere|outperform|beat)\s+([^\n.;]{8,130})", r"compar[aá]r?\w*\s+la\s+rentabilidad([^\n.;]{8,130})", r"(?:replicar?|replicate|tracks?)\s+([^\n.;]{8,130})",
    r"rentabilidad\s+similar\s+a\s+([^\n.;]{8,130})", r"(?:mide|medirá|medira)\s+su\s+rentabilidad\s+([^\n.;]{8,130})", r"performance\s+(?:is\s+)?(?:compared|measured)\s+(?:with|to|against)\s+([^\n.;]{8,130})",
]
NAMES = [r"(?:^|[\s:,(])((?:" + PROVIDERS + r")\s+[a-z][a-z0-9&\s.\-()/]{3,80}?(?:" + NAME_ENDS + r"))"]


def benchmark_name(span: Column, *, least: int = 6, most: int = 120) -> Column:
    """The index name within a span of lower-case text: from its first maker to what ends a name, tidied; null if there is no
    maker, if what is left is too short, is one word that no index ends with, holds words that no name has, or is a sentence."""
    whole = lambda pattern: "(?U)" + pattern
    begun = F.regexp_extract(F.trim(F.regexp_replace(span, r"\s+", " ")), whole(r"(?:" + PROVIDERS + r").*$"), 0)
    cut = F.regexp_extract(begun, whole(r"^(.{3,}?)(?:" + ENDERS + r"|$)"), 1)
    tidy = F.regexp_replace(F.regexp_replace(cut, r"\s*[®™©]\s*", " "), r"[\s(\[,;:«\"]+$", "")

    def accept(t: Column) -> Column:
        rate = F.regexp_extract(t, whole(r"^(?:€?str|sofr|sonia|saron|tona|ester|estr)\b"), 0)
        single = ~t.contains(" ") & ~t.rlike(whole(NAME_ENDS))
        sentence = (F.length(t) > 80) & (F.size(F.split(t, " ")) > 7)
        name = F.when((F.length(t) >= least) & ~single & ~sentence & ~t.rlike(whole(NO_NAME)), F.substring(t, 1, most))
        return F.when(rate != "", rate).otherwise(name)

    return let(tidy, accept)


def benchmark_of(text: Column) -> Column:
    """(benchmark, level, declared_none) of running text, lower case (rates in capitals).

    Levels in order: NONE (a statement that there is no benchmark; the name is null), RATE (a market rate after a phrase),
    LABEL (after a label), ACTION (after what the manager does with it), NAME (a name that ends as indices do, anywhere).
    Within a level patterns count in order, and of one pattern's spans the first that ``benchmark_name`` accepts. All null
    and false without any; null texts give the same.
    """
    low = F.lower(F.coalesce(text, F.lit("")))

    def first_name(t: Column, patterns: list[str]) -> Column:
        spans = F.flatten(F.array(*[F.regexp_extract_all(t, F.lit("(?U)" + p), F.lit(1)) for p in patterns]))
        return F.get(F.filter(F.transform(spans, lambda s: benchmark_name(s)), lambda x: x.isNotNull()), F.lit(0))

    def decide(x: Column) -> Column:
        none = x["flat"].rlike("(?U)" + NO_BENCHMARK)
        rate = F.upper(X.ordered_extract(x["flat"], ["(?U)" + p for p in RATES]))
        found = F.coalesce(
            F.when(none, F.struct(F.lit(None).cast("string").alias("benchmark"), F.lit("NONE").alias("level"))),
            *[F.when(name.isNotNull(), F.struct(name.alias("benchmark"), F.lit(level).alias("level"))) for level, name in [("RATE", rate)]],
            let(first_name(x["low"], LABELS), lambda n: F.when(n.isNotNull(), F.struct(n.alias("benchmark"), F.lit("LABEL").alias("level")))),
            let(first_name(x["flat"], ACTIONS), lambda n: F.when(n.isNotNull(), F.struct(n.alias("benchmark"), F.lit("ACTION").alias("level")))),
            let(first_name(x["flat"], NAMES), lambda n: F.when(n.isNotNull(), F.struct(n.alias("benchmark"), F.lit("NAME").alias("level")))),
        )
        return F.struct(found["benchmark"].alias("benchmark"), found["level"].alias("level"), none.alias("declared_none"))

    return let(F.struct(low.alias("low"), F.regexp_replace(low, r"\s+", " ").alias("flat")), decide)
