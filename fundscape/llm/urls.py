"""URL filter: longest matching rule, else gradient-boosted trees on lexical features.

The trees learn from labelled urls: at most ``sample_rows`` of them, the first by a hash of the url (bounded, whatever
the input). Features: lengths of url, host and path, depth, number of host labels, share of digits, hyphens, entropy of
the characters, number of parameters and their length, and what share of all labelled urls with the same host suffix
(hashed to ``SUFFIXES`` values, so that table is bounded) is to be blocked.

Null urls and urls without ``://`` have empty host and path and fit no rule. Where labelled urls have one verdict only,
the others get that; without labels they are allowed. Repeated rows give repeated results.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

UPPER_AZ, LOWER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SUFFIXES = 512
FEATURES = ["url_len", "host_len", "path_len", "depth", "labels", "digits", "hyphens", "entropy", "params", "query_len", "suffix_rate", "suffix_share"]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER_AZ, LOWER_AZ), F.regexp_extract(text, pattern, 2)


def match_rules(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null if none fits. ``rules``: (verdict, host and path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def lexical(df: DataFrame) -> DataFrame:
    """Add the lexical features of ``url``, ``host`` and ``path``, and the hashed ``suffix``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    count = lambda pattern: F.length(F.regexp_replace(url, pattern, ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(F.array_distinct(F.split(url, "")), F.lit(0.0), lambda a, c: a - F.when(c == "", 0.0).otherwise(share(c) * F.log2(F.greatest(share(c), F.lit(1e-9)))))
    labels = F.split("host", r"\.")
    return df.withColumns({
        "url_len": F.length(url).cast("double"), "host_len": F.length("host").cast("double"), "path_len": F.length("path").cast("double"),
        "depth": (F.size(F.split("path", "/")) - 1).cast("double"), "labels": F.size(labels).cast("double"),
        "digits": count("[^0-9]") / n, "hyphens": count("[^-]").cast("double"), "entropy": entropy,
        "params": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")), "query_len": F.length(query).cast("double"),
        "suffix": F.pmod(F.xxhash64(F.element_at(labels, -1)), F.lit(SUFFIXES)),
    })


def judge(pages: DataFrame, rules: list[tuple[str, str]], *, labelled: DataFrame | None = None, sample_rows: int = 10_000, trees: int = 12, depth: int = 4, threshold: float = 0.5) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule, verdict (allow or block) and the trees' block_score.

    ``labelled``: (url, verdict) to learn from; without it, the urls that a rule judges are the labelled ones.
    """
    host, path = split_url(F.col("url"))
    base = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "ruled": verdict})
    learn = base.where("ruled is not null").select("url", "host", "path", F.col("ruled").alias("verdict"))
    if labelled is not None:
        learn = labelled.select("url", "verdict").withColumns({"host": host, "path": path})
    learn = learn.withColumn("label", (F.col("verdict") == "block").cast("double"))
    suffix = F.pmod(F.xxhash64(F.element_at(F.split("host", r"\."), -1)), F.lit(SUFFIXES)).alias("suffix")
    seen = learn.groupBy(suffix).agg(F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("n"))
    all_n = learn.agg(F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked"), F.count(F.lit(1)).alias("n")).first()
    if all_n["blocked"] in (0, all_n["n"]):
        only = "block" if all_n["blocked"] else "allow"
        return base.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(only)).alias("verdict"), F.lit(float(only == "block")).alias("block_score"))
    mean = all_n["blocked"] / all_n["n"]
    seen = seen.select("suffix", ((F.col("blocked") + 10 * mean) / (F.col("n") + 10)).alias("suffix_rate"), (F.col("n") / all_n["n"]).alias("suffix_share"))

    def features(df: DataFrame) -> DataFrame:
        joined = lexical(df).join(F.broadcast(seen), "suffix", "left")  # at most SUFFIXES rows
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(joined.fillna({"suffix_rate": float(mean), "suffix_share": 0.0}))

    sample = learn.orderBy(F.xxhash64("url"), "url").limit(sample_rows)
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, maxBins=32).fit(features(sample).select("features", "label"))
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(features(base)).withColumn("block_score", vector_to_array("probability")[1])
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("block_score") >= threshold, "block").otherwise("allow")).alias("verdict"), "block_score")
