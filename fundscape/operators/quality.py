"""Entity names and families, reconciliation of sources, and data-quality rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.files import stored
from .text import fold_accents, strip_suffixes

#: Share classes and currencies at the end of a fund's name.
CLASS_SUFFIX = r"\s+(acc|dist|inc|income|hedged|h|a|b|c|i|r|a2|eur|usd|gbp)$"


def family_name(name: Column, *, times: int = 10) -> Column:
    """A fund's name without accents, case and class suffixes, taken off to a fixed point."""
    return F.trim(strip_suffixes(F.lower(fold_accents(name)), CLASS_SUFFIX, times))


def families(funds: DataFrame, manager: str, name: str) -> DataFrame:
    """Add ``family``: ``FAM_000001`` and on, numbered in the order of (manager, family name).

    Keys are range-partitioned and sorted; a key's number is its place in its partition after the sizes of those before,
    so no task holds all of them. Funds without a name have no family.
    """
    keyed = funds.withColumns({"_m": F.lower(F.trim(F.coalesce(manager, F.lit("")))), "_f": family_name(F.col(name))})
    keys = keyed.where("_f is not null").select("_m", "_f").distinct().repartitionByRange("_m", "_f").withColumn("_p", F.spark_partition_id())
    keys = stored(keys, "family-keys")
    sizes = keys.groupBy("_p").agg(F.count(F.lit(1)).alias("_s"))  # one row a partition
    before = F.coalesce(F.sum("_s").over(Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = keys.join(sizes.select("_p", before.alias("_b")), "_p")
    place = F.col("_b") + F.row_number().over(Window.partitionBy("_p").orderBy("_m", "_f"))
    ids = numbered.select("_m", "_f", F.concat(F.lit("FAM_"), F.lpad(place.cast("string"), 6, "0")).alias("family"))
    return keyed.join(ids, ["_m", "_f"], "left").drop("_m", "_f")


# Signs of families that mix natures on purpose, natures that are easily mistaken for each other, the nature
# that stands for none, and the ranks of the quality flags.
STRUCTURAL = ["hedge", "hedged", "long short", "long/short", "absolute return", "abs ret", "market neutral", "short ", " short"]
ADJACENT = [
    ("Mixtos", "Renta Variable"),
    ("Mixtos", "Renta Fija Flexible"),
    ("Mixtos", "Renta Fija Corto Plazo"),
    ("Renta Fija Flexible", "Renta Fija Corto Plazo"),
    ("Monetario", "Renta Fija Corto Plazo"),
    ("Alternativo", "Renta Variable"),
    ("Monetario", "Renta Variable"),
]
NO_NATURE = "Restantes"
RISK_RANK = {"HIGH": 4, "MEDIUM_TEXT": 3, "MEDIUM_VISUAL": 2, "LOW_CONFLICT": 1, "NONE": 0}
DATA_RANK = {"OK": 2, "WARN": 1, "MISSING": 0}


def family_natures(funds: DataFrame, family: str = "family_id", name: str = "fund_name", nature: str = "nature", data: str = "data_quality", risk: str = "risk_quality") -> DataFrame:
    """(family, natures, resolved) of families whose members differ in nature; ``resolved`` is null where it is unsafe.

    In order: families with a structural sign in a name stay; two thirds of one nature win if all others are of low
    quality; of two members the one with a nature, with good data or with a read risk class wins; adjacent natures are
    decided by the sum of risk ranks, then of data ranks; a lone nature wins over none. Ties go by name. Only one row
    per nature of a family is gathered.
    """
    rank = lambda table, c: F.coalesce(F.create_map(*[F.lit(x) for p in table.items() for x in p])[F.col(c)], F.lit(0))
    weak = F.col(data).isin("MISSING", "WARN")
    low = F.coalesce(weak, F.lit(False)) | F.col(risk).isNull() | (F.col(risk) == "NONE")
    sign = F.coalesce(F.greatest(*[F.lower(name).contains(x) for x in STRUCTURAL]), F.lit(False))
    each = funds.where(F.col(nature).isNotNull()).groupBy(F.col(family), F.col(nature).alias("_n")).agg(
        F.count(F.lit(1)).alias("k"), F.count_if(~low).alias("sound"), F.sum(rank(RISK_RANK, risk)).alias("risk"), F.sum(rank(DATA_RANK, data)).alias("data"), F.count_if(F.col(data) == "OK").alias("ok"), F.count_if(weak).alias("weak"), F.max(sign).alias("sign"),
    )
    item = F.struct(F.col("_n").alias("nature"), "k", "sound", "risk", "data", "ok", "weak")
    own = each.groupBy(family).agg(F.array_sort(F.collect_list(item)).alias("x"), F.sum("k").alias("members"), F.sum("sound").alias("all_sound"), F.max("sign").alias("sign")).where(F.size("x") > 1)
    best = lambda xs, key: F.array_max(F.transform(xs, lambda v, i: F.struct(key(v).alias("v"), (-i).alias("i"), v["nature"].alias("nature"), v["sound"].alias("sound"))))
    x, named = F.col("x"), F.filter("x", lambda v: v["nature"] != NO_NATURE)
    top = best(x, lambda v: v["k"])
    majority = (3 * top["v"] >= 2 * F.col("members")) & (F.col("all_sound") == top["sound"])
    a, b = F.get("x", F.lit(0)), F.get("x", F.lit(1))
    pair = (F.col("members") == 2) & (F.size("x") == 2)
    wins = lambda p, q: (q["nature"] == NO_NATURE) | ((p["nature"] != NO_NATURE) & (p["ok"] == 1) & (q["weak"] == 1))
    by_risk = lambda p, q: (p["risk"] >= 2) & (q["risk"] == 0)
    of_two = F.when(wins(a, b), a["nature"]).when(wins(b, a), b["nature"]).when(by_risk(a, b), a["nature"]).when(by_risk(b, a), b["nature"])
    none = F.exists("x", lambda v: v["nature"] == NO_NATURE)
    set_of = F.transform("x", lambda v: v["nature"])
    adjacent = none | F.greatest(*[(F.size("x") == 2) & F.array_contains(set_of, p) & F.array_contains(set_of, q) for p, q in ADJACENT])
    lead = best(named, lambda v: v["risk"])
    others = lambda key, but: F.array_max(F.transform(F.filter("x", lambda v: v["nature"] != but), lambda v: v[key]))
    ahead = lead["v"] - others("risk", lead["nature"])
    data_lead = best(x, lambda v: v["data"])
    by_data = (ahead >= 0) & (data_lead["nature"] == lead["nature"]) & (data_lead["v"] - others("data", data_lead["nature"]) >= 1)
    close = F.when((ahead > 2) | by_data | (none & (F.size(named) == 1)), lead["nature"])
    resolved = F.when(F.col("sign"), F.lit(None)).when(majority, top["nature"]).otherwise(F.coalesce(F.when(pair, of_two), F.when(adjacent, close)))
    return own.select(family, F.array_join(set_of, ",").alias("natures"), resolved.alias("resolved"))


def resolve_nature(funds: DataFrame, family: str, nature: str, *, share: float = 2 / 3) -> DataFrame:
    """(family, nature, resolved) of families with several natures: that of at least ``share`` of the members, or null."""
    counts = funds.where(F.col(nature).isNotNull()).groupBy(family, nature).agg(F.count("*").alias("n"))
    total = counts.groupBy(family).agg(F.sum("n").alias("members"), F.count("*").alias("natures"), F.max(F.struct("n", nature)).alias("top")).where("natures > 1")
    return total.select(family, "members", "natures", F.when(F.col("top.n") >= share * F.col("members"), F.col(f"top.{nature}")).alias("resolved"))


def inconsistent(funds: DataFrame, family: str, nature: str) -> DataFrame:
    sets = funds.groupBy(family).agg(F.array_sort(F.collect_set(nature)).alias("found"))
    return sets.where(F.size("found") > 1).select(family, F.array_join("found", ",").alias("natures"))


def reconcile(a: Column, b: Column, *, tolerance: float = 0.0) -> Column:
    """MATCH, CONFLICT, ONLY_A, ONLY_B or NONE."""
    return F.when(a.isNull() & b.isNull(), "NONE").when(b.isNull(), "ONLY_A").when(a.isNull(), "ONLY_B").when(F.abs(a - b) <= tolerance, "MATCH").otherwise("CONFLICT")


def cost_verdict(a: Column, b: Column, *, absolute: float = 0.05, relative: float = 0.05) -> Column:
    limit = F.greatest(F.lit(absolute), relative * F.greatest(F.abs(a), F.abs(b)))
    return F.when(a.isNull() & b.isNull(), "BOTH_FAIL").when(b.isNull(), "ONLY_A").when(a.isNull(), "ONLY_B").when(F.abs(a - b) <= limit, "AGREE").otherwise("CONFLICT")


def cross_validate(pct: Column, amount: Column, *, base: float = 10_000.0) -> Column:
    """A struct (status, value, bp): a percentage against an amount over the base; more than 50 basis points void it."""
    bp = F.round(F.abs(pct - amount / base * 100) * 100, 4)
    status = F.when(pct.isNull() | amount.isNull(), "SINGLE").when(bp <= 5, "OK").when(bp <= 50, "MILD").otherwise("VOID")
    return F.struct(status.alias("status"), F.when(~(bp > 50) | bp.isNull(), F.coalesce(pct, amount / base * 100)).alias("value"), bp.alias("bp"))


def semantic_rules(df: DataFrame, rules: list[tuple[str, str, Column, Column | None]]) -> DataFrame:
    """Apply rules (name, column, condition, value or None for a warning only) in order and list those that fired."""
    fired = F.array().cast("array<string>")
    df = df.withColumn("fired", fired)
    for name, column, condition, value in rules:
        on = F.coalesce(condition, F.lit(False))
        df = df.withColumn("_on", on).withColumn("fired", F.when(F.col("_on"), F.array_append("fired", F.lit(name))).otherwise(F.col("fired")))
        if value is not None:
            df = df.withColumn(column, F.when(F.col("_on"), value).otherwise(F.col(column)))
    return df.drop("_on").withColumn("fired", F.array_join("fired", ","))


def consistency_rules(theme_sector: dict[str, str] | None = None, nature_family: dict[str, list[str]] | None = None) -> list[tuple[str, str, Column, Column | None]]:
    """Rules for ``semantic_rules`` between a fund's attributes; those with a value correct, the others warn."""
    c = F.col
    passive, technique = c("strategy").isin("Indexado", "Pasivo"), c("replication").isin("Physical", "Synthetic", "Sampling")
    none = lambda x: F.coalesce(x, F.lit(False))
    regions = ("Europe", "North America", "Asia-Pacific", "Latin America", "Eastern Europe", "Middle East & Africa")
    mono = ~c("nature").isin("Mixtos", "Alternativo", "Estructurado", "Restantes")
    external = ~none(c("external_role") == "hurdle_rate")
    expected = F.create_map(*[F.lit(x) for p in (("Renta Variable", "Equity"), ("Renta Fija Flexible", "Fixed Income"), ("Renta Fija Corto Plazo", "Fixed Income")) for x in p])[c("nature")]
    odd_profile = (
        ((c("profile") == "Conservador") & (c("srri") >= 6)) | ((c("profile") == "Moderado") & c("srri").isin(1, 7))
        | ((c("profile") == "Dinámico") & (c("srri") <= 2)) | ((c("profile") == "Agresivo") & (c("srri") <= 4))
    )
    rules: list[tuple[str, str, Column, Column | None]] = [
        ("INTER-1 passive", "replication", passive & ~none(technique), F.lit("Physical")),
        ("INTER-1 active", "replication", (c("strategy") == "Activo") & ~c("replication").eqNullSafe("Not Applicable"), F.lit("Not Applicable")),
        ("INTER-2 frequency", "frequency", (c("accumulation") == "ACCUMULATION") & c("frequency").isNotNull(), F.lit(None)),
        ("INTER-2 missing", "frequency", (c("accumulation") == "DISTRIBUTION") & c("frequency").isNull(), None),
        ("INTER-2 inferred", "accumulation", c("accumulation").isNull() & c("frequency").isNotNull(), F.lit("DISTRIBUTION")),
        ("INTER-3", "profile", odd_profile, None),
        ("INTER-6 sector", "sector", (c("universe") == "Sector") & c("sector").isNull(), None),
        ("INTER-6 geography", "geography", c("universe").isin("Regional", "Country") & c("geography").isNull(), None),
        ("INTER-7", "leverage", (c("profile") == "Conservador") & (c("leverage") == "YES"), None),
        ("INTER-8", "sfdr", (c("is_esg") == 1) & ~c("sfdr").isin(8, 9), None),
        ("INTER-10 region", "universe", (c("universe") == "Country") & c("geography").isin(*regions), F.lit("Regional")),
        ("INTER-10 country", "universe", c("geography").isin("Japan", "China", "India") & (c("universe") == "Global"), None),
        ("INTER-10 global", "universe", (c("geography") == "Global") & c("universe").isin("Country", "Regional"), None),
        ("INTER-18 mixed", "nature", external & (c("external") == "Mixed") & mono, None),
        ("INTER-18 class", "nature", external & c("external").isin("Equity", "Fixed Income") & (c("external") != expected), None),
    ]
    for theme, sector in (theme_sector or {}).items():
        rules.append((f"INTER-9 {theme}", "theme", (c("theme") == theme) & (c("sector") != sector), None))
    for nature, allowed in (nature_family or {}).items():
        rules.append((f"INTER-5 {nature}", "family", (c("nature") == nature) & ~c("family").isin(*allowed), None))
    return rules


def quality_rules() -> dict[str, Column]:
    """Conditions that no row of a table of fund attributes should meet."""
    c = F.col
    return {
        "nature_singular": c("nature") == "Mixto",
        "broad_with_sector": (c("focus") == "Broad") & c("sector").isNotNull(),
        "hedging_contradicts": ((c("hedged") == "Hedged") & (c("hedging") == "UNHEDGED")) | ((c("hedged") == "Unhedged") & (c("hedging") == "HEDGED")),
        "frequency_without_policy": c("frequency").isNotNull() & c("accumulation").isNull(),
        "cash_without_universe": c("nature").isin("Monetario", "Renta Fija Corto Plazo") & c("universe").isNull(),
        "credit_no_aplica": c("credit") == "No aplica",
        "credit_unknown": ~c("credit").isin("Investment Grade", "High Yield", "Mixed", "Not Applicable"),
        "hedged_yes_no": c("hedged").isin("Yes", "No"),
        "charge_missing": c("charge").isNull(),
        "charge_out_of_range": ~c("charge").between(0, 10),
        "benchmark_long": (F.length("benchmark") > 100) & (c("benchmark") != "NO_BENCHMARK"),
        "benchmark_spanish": c("benchmark").rlike("(además|través|riesgo|corro|hemos|clasificado)") & (c("benchmark") != "NO_BENCHMARK"),
        "srri_missing": c("srri").isNull(),
        "srri_out_of_range": ~c("srri").between(1, 7),
        "distribution_without_frequency": (c("accumulation") == "DISTRIBUTION") & c("frequency").isNull(),
        "accumulation_with_frequency": (c("accumulation") == "ACCUMULATION") & c("frequency").isNotNull(),
        "passive_without_technique": c("strategy").isin("Indexado", "Pasivo") & F.coalesce(~c("replication").isin("Physical", "Synthetic", "Sampling"), F.lit(True)),
        "active_with_technique": (c("strategy") == "Activo") & c("replication").isin("Physical", "Synthetic", "Sampling"),
        "sector_universe_without_sector": (c("universe") == "Sector") & c("sector").isNull(),
        "regional_without_geography": c("universe").isin("Regional", "Country") & c("geography").isNull(),
        "esg_article_6": (c("is_esg") == 1) & (c("sfdr") == 6),
        "equity_low_risk": (c("nature") == "Renta Variable") & (c("srri") <= 2),
        "cash_high_risk": (c("nature") == "Monetario") & (c("srri") >= 4),
        "conservative_leveraged": (c("profile") == "Conservador") & (c("leverage") == "YES"),
        "profile_missing": c("profile").isNull(),
    }


def outside_vocabulary(df: DataFrame, key: str, columns: list[str], vocabulary: DataFrame) -> DataFrame:
    """(key, field, value) of the values that a closed vocabulary (field, value) does not hold."""
    long = df.unpivot(key, columns, "field", "value").where("value is not null")
    return long.join(vocabulary, ["field", "value"], "left_anti").select(key, "field", "value")


def canonical(value: Column, forms: list[str], remap: dict[str, str]) -> Column:
    """A value in its canonical case, old names replaced first."""
    key = F.lower(F.trim(value))
    table = {**{f.lower(): f for f in forms}, **{k.lower(): v for k, v in remap.items()}}
    return F.coalesce(F.create_map(*[F.lit(x) for p in table.items() for x in p])[key], value)


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule) of each row and rule that matches."""
    hit = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return df.select(key, F.explode(hit).alias("rule"))


def schema_diff(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """(field, status) of expected and actual columns: missing, extra, type or ok."""
    actual = dict(df.dtypes)
    rows = [(n, "missing" if n not in actual else "ok" if actual[n] == t else "type") for n, t in expected.items()] + [(n, "extra") for n in actual if n not in expected]
    return df.sparkSession.createDataFrame(rows, "field string, status string")


def validate_copy(name: str, source: DataFrame, copy: DataFrame, key: str, children: DataFrame, parent: str) -> DataFrame:
    """(tbl, source, target, orphans): rows of a table and of its copy, and children whose parent the copy lacks."""
    lost = children.join(copy.select(F.col(key).alias(parent)), parent, "left_anti")
    one = lambda df, k: df.select(F.lit(k).alias("k"))
    counts = one(source, "source").union(one(copy, "target")).union(one(lost, "orphans"))
    return counts.agg(F.lit(name).alias("tbl"), *[F.count_if(F.col("k") == k).alias(k) for k in ("source", "target", "orphans")])


def load_state(rows: DataFrame, key: str, date: str) -> DataFrame:
    """(key, first, last, n) of what is loaded."""
    return rows.groupBy(key).agg(F.min(date).alias("first"), F.max(date).alias("last"), F.count("*").alias("n"))


def gaps_between(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(status, n): ids in both, only in a, only in b."""
    x, y = a.select(key).distinct().withColumn("_a", F.lit(1)), b.select(key).distinct().withColumn("_b", F.lit(1))
    status = F.when(F.col("_a").isNull(), "only_b").when(F.col("_b").isNull(), "only_a").otherwise("both")
    return x.join(y, key, "full").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def verdict_after(truth: Column, stored: Column, again: Column) -> Column:
    """OK if stored is true; FIXES if only the new value is; STALE if stored and new differ otherwise; else RESIDUAL."""
    return F.when(stored.eqNullSafe(truth), "OK").when(again.eqNullSafe(truth), "FIXES").when(~stored.eqNullSafe(again), "STALE").otherwise("RESIDUAL")


def newest(rows: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
