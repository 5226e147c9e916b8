"""The fund model read from the given tables: monthly values, fund attributes, macro series and long metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .files import stored


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt to all cores, four tasks each: for work on a row that costs far more than reading it, because a file of
    many short rows is read by few tasks."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def month(c: str | Column) -> Column:
    """The month's last day."""
    return F.last_day(c)


def month_index(c: str | Column) -> Column:
    return F.year(c) * 12 + F.month(c)


class Made(str):
    """A folder of tables whose panel and macro series are made already; whatever takes the folder's name takes this."""

    panel: DataFrame
    series: DataFrame


def made(spark: SparkSession, sf_dir: str) -> Made:
    """The folder with its panel and macro series written once, for queries that use them many times: each use would read and
    group all lines and orders again."""
    if isinstance(sf_dir, Made):
        return sf_dir
    out = Made(sf_dir)
    out.panel, out.series = stored(nav(spark, sf_dir), "panel"), stored(macro(spark, sf_dir).coalesce(1), "series")  # some rows a month
    return out


def nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(isin, date, nav): the last price of each supplier and month, compounded to an index."""
    if isinstance(sf_dir, Made):
        return sf_dir.panel
    items = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    last = F.max_by("l_extendedprice", F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"))
    p = items.groupBy(F.col("l_suppkey").alias("isin"), month("l_shipdate").alias("date")).agg(last.alias("px"))
    mean = F.avg("px").over(Window.partitionBy("isin"))
    r = p.select("isin", "date", ((0.002 + 0.018 * (F.col("isin") % 7)) * (F.col("px") / mean - 1) + 0.004).alias("r"))
    grown = F.sum(F.log(1 + F.col("r"))).over(Window.partitionBy("isin").orderBy("date"))
    return r.select("isin", "date", F.round(100 * F.exp(grown), 6).alias("nav"))


#: Region of a supplier to the nature of a fund.
NATURES = {"AFRICA": "Monetario", "AMERICA": "Renta Variable", "ASIA": "Renta Fija Flexible", "EUROPE": "Mixtos", "MIDDLE EAST": "Alternativo"}


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per fund: isin, fund_name, manager, nature, srri, currency, hedging, family_id."""
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    full = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)  # 25 and 5 rows
    nature = F.create_map(*[F.lit(x) for pair in NATURES.items() for x in pair])[F.col("r_name")]
    k = F.col("s_suppkey")
    currency = F.get(F.array(*map(F.lit, ("EUR", "USD", "JPY", "GBP", "CNY"))), (k % 5).cast("int"))
    return full.select(
        k.alias("isin"), F.col("s_name").alias("fund_name"), F.col("n_name").alias("manager"), nature.alias("nature"), (1 + k % 7).cast("int").alias("srri"),
        currency.alias("currency"), F.when(k % 4 == 0, "Full").alias("hedging"), F.concat_ws("_", "n_name", (k % 3).cast("string")).alias("family_id"), F.col("s_acctbal").alias("size"),
    )


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, indicator, geography, value) derived from monthly order totals; some months are missing."""
    if isinstance(sf_dir, Made):
        return sf_dir.series
    o = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 6).cast("int").alias("j"), month("o_orderdate").alias("date"), "o_totalprice")
    m = o.groupBy("j", "date").agg(F.avg("o_totalprice").alias("v"))
    z = m.select("j", "date", F.round(F.col("v") / F.avg("v").over(Window.partitionBy("j")) - 1, 9).alias("z"))
    run = lambda x: F.exp(F.sum(F.log(1 + x)).over(Window.partitionBy("j").orderBy("date")))
    c = F.col("z")
    series = [
        (0, "ipc_index", "ES", 100 * run(0.0030 + 0.012 * c)), (1, "ipc_index", "EU", 100 * run(0.0030 + 0.012 * c)), (2, "oil_wti", "GLOBAL", 50 * run(0.005 + 0.40 * c)),
        (3, "cli", "EU", 100.5 + 6 * c), (4, "rate_deposit", "EU", 2 + 3 * c), (5, "spread_hy", "GLOBAL", 5 + 6 * c), (5, "vix", "GLOBAL", 20 * F.exp(0.9 * c)),
        (0, "fx_usd_eur", "GLOBAL", 1.1 * F.exp(0.1 * c)), (2, "fx_jpy_usd", "GLOBAL", 120 * F.exp(0.1 * c)), (3, "fx_usd_gbp", "GLOBAL", 1.3 * F.exp(0.1 * c)), (4, "fx_cny_usd", "GLOBAL", 7 * F.exp(0.1 * c)),
        (0, "m2_level", "US", 1000 * run(0.004 + 0.01 * c)), (1, "m2_level", "EU", 1300 * run(0.004 + 0.01 * c)), (2, "m2_level", "CN", 1900 * run(0.004 + 0.01 * c)), (3, "m2_level", "JP", 700 * run(0.004 + 0.01 * c)),
        (1, "rate_policy", "US", 3 + 4 * c + 6 * c * c), (2, "rate_policy", "JP", 0.5 + c - 2 * c * c), (5, "rate_policy", "CN", 4 + 2 * c + 5 * c * c), (3, "m3_yoy", "EU", 5 + 9 * c + 7 * c * c), (4, "m2_yoy", "US", 6 + 8 * c - 3 * c * c),
        (2, "ipc_index", "US", 100 * run(0.0025 + 0.010 * c)), (3, "ipc_index", "JP", 100 * run(0.0010 + 0.008 * c)), (5, "ipc_index", "CN", 100 * run(0.0020 + 0.015 * c)), (1, "copper", "GLOBAL", 9000 * run(0.003 + 0.30 * c)),
        (0, "cli", "US", 100 + 5 * c + 9 * c * c), (2, "cli", "JP", 100 + 4 * c), (4, "cli", "CN", 100 - 3 * c), (5, "cli", "ES", 100 + 2 * c), (4, "dxy", "GLOBAL", 100 * F.exp(0.2 * c)), (1, "gold", "GLOBAL", 1800 * F.exp(0.3 * c)), (0, "unemployment", "US", 5 - 4 * c),
        (5, "m2_global_yoy", "GLOBAL", 6 + 5 * c * c - 3 * c), (2, "spread_ig", "GLOBAL", 1.5 + 2 * c + 4 * c * c), (4, "term_spread", "US", 1 - 2 * c + 8 * c * c),
    ]
    rows = F.array(*[F.when(F.col("j") == j, F.struct(F.lit(i).alias("indicator"), F.lit(g).alias("geography"), F.round(v, 6).alias("value"))) for j, i, g, v in series])
    out = z.select("date", rows.alias("rows")).select("date", F.explode(F.array_compact("rows")).alias("s")).select("date", "s.*")
    cut = (F.col("indicator") == "m2_level") & ((F.col("geography") == "CN") & (F.col("date") > F.lit("2000-06-30").cast("date")) | (F.col("geography") == "JP") & (F.col("date") > F.lit("2000-12-31").cast("date")))
    return out.where(~cut)


#: Attributes of a fund derived from its id: the values, and after how many ids the next one comes.
ATTRIBUTES: dict[str, tuple[list[str | None], int]] = {
    "strategy": (["Activo", "Indexado", "Pasivo", None], 1),
    "replication": (["Physical", "Not Applicable", "Synthetic", None, "Sampling"], 1),
    "accumulation": (["ACCUMULATION", "DISTRIBUTION", None], 1),
    "frequency": (["Annual", None], 3),
    "profile": (["Conservador", "Moderado", "Dinámico", "Agresivo", None], 2),
    "nature": (["Monetario", "Renta Variable", "Mixto", "Renta Fija Flexible", "Mixtos", "Alternativo", "Renta Fija Corto Plazo"], 3),
    "universe": (["Sector", "Regional", "Country", "Global", None], 1),
    "sector": (["Technology", "Health", None], 5),
    "geography": (["Europe", "Japan", "Global", None], 2),
    "leverage": (["YES", "NO", None], 4),
    "theme": (["Water", "Robotics", None], 6),
    "external": (["Equity", "Fixed Income", "Rate", "Mixed", None], 3),
    "external_role": (["benchmark", "hurdle_rate"], 11),
    "hedged": (["Hedged", "Unhedged", "Yes", None], 1),
    "hedging": (["HEDGED", "UNHEDGED", None], 1),
    "credit": (["Investment Grade", "High Yield", "No aplica", "Not Applicable", "Mixed", "BBB", None], 1),
    "focus": (["Broad", "Narrow", None], 1),
}


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name, attributes, srri, is_esg, sfdr, charge, benchmark): a row per part."""
    k = F.col("p_partkey")
    nth = lambda values, step: F.get(F.array(*[F.lit(v).cast("string") for v in values]), (F.floor(k / step) % len(values)).cast("int"))
    return read(spark, sf_dir, "part").select(
        k.alias("id"), F.col("p_name").alias("name"), *[nth(*spec).alias(c) for c, spec in ATTRIBUTES.items()], F.when(k % 13 != 0, 1 + k % 7).cast("int").alias("srri"), (F.floor(k / 2) % 2).cast("int").alias("is_esg"),
        F.get(F.array(*[F.lit(v).cast("int") for v in (6, 8, 9, None)]), (F.floor(k / 3) % 4).cast("int")).alias("sfdr"), F.when(k % 3 != 0, F.col("p_size") / 10).alias("charge"), F.when(k % 5 != 0, F.concat_ws(" ", "p_type", "p_name")).alias("benchmark"),
    )


#: Named windows of dates.
WINDOWS = [("w1", "1996-01-31", "1997-06-30"), ("w2", "1998-01-31", "1999-03-31"), ("w3", "2000-01-31", "2001-06-30"), ("short", "1999-05-31", "1999-07-31")]


def windows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WINDOWS, "horizon string, start string, stop string").select("horizon", F.to_date("start").alias("start"), F.to_date("stop").alias("stop"))
