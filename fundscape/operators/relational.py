"""Keyed merges, exports, joins by range or nearest key, and grouped profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.files import stored
from .dictionary import first_prefix


def upsert_replace(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Rows of both; of those with equal keys the new one."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def insert_ignore(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Rows of both; of those with equal keys the old one."""
    return old.unionByName(new.join(old.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def policy_merge(old: DataFrame, new: DataFrame, keys: list[str], policies: dict[str, str | Column]) -> DataFrame:
    """Merge column by column: ``keep`` the old value if the row exists, ``overwrite``, ``fill`` only with new values
    that are not null, or a condition (over columns o.x, n.x) under which the new value is taken."""
    full = old.alias("o").join(new.alias("n"), [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full")
    exists, comes = F.col(f"o.{keys[0]}").isNotNull(), F.col(f"n.{keys[0]}").isNotNull()

    def merged(c: str, policy: str | Column) -> Column:
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}")
        if isinstance(policy, str) and policy == "keep":
            return F.when(exists, o).otherwise(n)
        if isinstance(policy, str) and policy == "overwrite":
            return F.when(comes, n).otherwise(o)
        if isinstance(policy, str) and policy == "fill":
            return F.coalesce(n, o)
        return F.when(comes & (~exists | policy), n).otherwise(o)

    return full.select(*[F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in keys], *[merged(c, p).alias(c) for c, p in policies.items()])


def replace_children(old: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """All rows of a parent that comes anew are replaced by the new ones."""
    return old.join(new.select(parent).distinct(), parent, "left_anti").unionByName(new)


def union_sources(sources: dict[str, DataFrame], aliases: dict[str, list[str]], key: str) -> DataFrame:
    """One table of sources with differing headers; sources without the key are left out, names become a column."""
    def fit(name: str, df: DataFrame) -> DataFrame:
        lower = {c.lower(): c for c in df.columns}
        pick = {c: [lower[a.lower()] for a in [c, *names] if a.lower() in lower] for c, names in aliases.items()}
        return df.select(*[(F.coalesce(*[F.col(x) for x in found]) if found else F.lit(None)).alias(c) for c, found in pick.items()], F.lit(name).alias("source"))

    good = [fit(n, df) for n, df in sources.items() if any(a.lower() in {c.lower() for c in df.columns} for a in [key, *aliases[key]])]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), good)


def first_source(rows: DataFrame, priority: dict[str, int], *keys: str, source: str = "source") -> DataFrame:
    """Of each key's rows that of the source with the lowest number."""
    order = F.coalesce(F.create_map(*[F.lit(x) for p in priority.items() for x in p])[F.col(source)], F.lit(1 << 30))
    w = Window.partitionBy(*keys).orderBy(order, source)
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def export(df: DataFrame, *, include: list[str] | None = None, exclude: tuple[str, ...] = (), where: str | None = None, order: list | None = None, limit: int | None = None) -> DataFrame:
    """A selection of a table; names it lacks are passed over."""
    keep = [c for c in (include or df.columns) if c in df.columns and c not in exclude]
    out = df.where(where) if where else df
    out = out.orderBy(*order) if order else out
    return (out.limit(limit) if limit else out).select(*keep)


def asof_backward(times: DataFrame, facts: DataFrame, at: str, value: str, *keys: str) -> DataFrame:
    """``times`` (keys, at) with the last fact at or before each that is not null, without a join of the two.

    Both are sorted together by range, so a long history of one key, or one without keys, is spread over many partitions. In
    each partition the last fact is carried forward; what a partition begins with comes from a table of one row per
    partition and key in it, carried over partitions that hold no fact. Equal rows of ``times`` are kept one by one; nulls in
    ``at`` come first, null keys are a key.
    """
    parts = int(times.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = times.select(*keys, at, F.lit(None).cast(dict(facts.dtypes)[value]).alias(value), F.lit(1).alias("_t")).unionByName(facts.select(*keys, at, value, F.lit(0).alias("_t")))
    both = stored(both.repartitionByRange(parts, *keys, at).withColumn("_part", F.spark_partition_id()), "asof")
    here = Window.partitionBy("_part", *keys).orderBy(at, "_t").rowsBetween(Window.unboundedPreceding, 0)
    local = both.withColumn("_last", F.last(value, ignorenulls=True).over(here))
    ends = both.groupBy("_part", *keys).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(at, "_t", value))).alias("_end"))
    # As many rows as partitions and keys that meet, whatever the number of facts.
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_part").alias("_p"), F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("_part") == F.col("_p"))
    return local.where("_t = 1").join(carried, same, "left").select(*keys, at, F.coalesce("_last", "_carried").alias(value))


def prefix_first(texts: DataFrame, aliases: DataFrame, text: str) -> DataFrame:
    """``texts`` with the label of the first alias (ord, prefix, label) that begins the text."""
    return first_prefix(texts, text, aliases).withColumn("label", F.col("match.label")).drop("match")


def nearest_key(rows: DataFrame, key: str, target: Column, value: str, *groups: str, tolerance: float = 0.01) -> DataFrame:
    """(groups, value): that of the row whose key is nearest the target and within the tolerance, else null."""
    gap = F.abs(F.col(key) - target)
    return rows.groupBy(*groups).agg(F.min(F.when(gap <= tolerance, F.struct(gap.alias("g"), value))).alias("m")).select(*groups, F.col(f"m.{value}").alias(value))


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, filled, ratio) of each column, from one pass."""
    one = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in columns])
    long = one.unpivot("_n", columns, "field", "filled")
    return long.select("field", "filled", F.when(F.col("_n") > 0, 1 - F.col("filled") / F.col("_n")).alias("null_ratio"))


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n): rows that each rule matches, from one pass."""
    one = df.agg(F.lit(0).alias("_"), *[F.count_if(c).alias(n) for n, c in rules.items()])
    return one.unpivot("_", list(rules), "rule", "n").drop("_")


def scale_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, n, low, high, mean) of each numeric column, from one pass."""
    struct = lambda c: F.struct(F.count(c).alias("n"), F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high"), F.avg(c).alias("mean"))
    one = df.agg(F.array(*[F.struct(F.lit(c).alias("field"), struct(c).alias("s")) for c in columns]).alias("a"))
    return one.select(F.explode("a").alias("a")).select("a.field", "a.s.*")


def strip_nul(df: DataFrame) -> DataFrame:
    """NUL characters taken out of all string columns."""
    return df.select(*[F.translate(c, "\0", "").alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])
