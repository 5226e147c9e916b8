"""The registered queries of this subpackage: thin uses of the operators with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ann, bpe, decontaminate as dec, linededup, merkle, neardup, packing, quality, spelling, suffix, toxicity, urls, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Fewer rows per Arrow batch than by default, as texts are long; shuffle files go when the step that made them ends."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = dec.verdicts(dec.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    ids = F.concat_ws(",", "items")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("restored")
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path=public_tokenizers.path("word_bpe_49k.json"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return suffix.remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False).drop("kept")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    manifest = warc.write_archive(warc.with_revisits(table(spark, sf_dir, "pages")))
    records = warc.read_archive(manifest, payloads=False)
    digest = F.when(F.col("verified"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a payload does not have its record's digest")))
    return records.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


#: (verdict, host and path).
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("block_score")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    how = {"ranks_path": public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}
    found = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), **how), **how)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    forged = merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), lowered)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, forged)
    manifest = merkle.build_manifest(table(spark, sf_dir, "documents"), carried={"tampered": tampered})
    proofs = merkle.prove(manifest).withColumn("root", manifest.root.scalar())
    folded = merkle.fold(F.coalesce("tampered", "leaf"), "path")
    out = proofs.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest("path").alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spelling.variants(spelling.vocabulary(spelling.noisy_words(table(spark, sf_dir, "documents"))))


QUERIES = {"op1_decontaminate": op1_decontaminate, "op2_quality": op2_quality, "op3_packing": op3_packing, "op4_toxicity": op4_toxicity, "op5_near_duplicates": op5_near_duplicates, "op6_repeated_strings": op6_repeated_strings, "op7_warc": op7_warc, "op8_nearest": op8_nearest, "op9_url_filter": op9_url_filter, "op10_line_dedup": op10_line_dedup, "op11_bpe": op11_bpe, "op12_merkle": op12_merkle, "op13_spelling": op13_spelling}

_AZ = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DEC = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
k AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, n, array_to_string(w[i:i + n - 1], ' ') AS key FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
o AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS key FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN (SELECT DISTINCT n FROM k) ON len(w) >= n)),
h AS (SELECT r, item, unnest(range(i, i + n)) AS word FROM o JOIN k USING (n, key)),
g AS (SELECT r, count(DISTINCT word) AS n_hit, list_sort(list(DISTINCT item)) AS items FROM h GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN g USING (r)"""
_NEAR = rf"""WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all({_AZ}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
t AS (SELECT a, b FROM e UNION SELECT t.a, e.b FROM t JOIN e ON t.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS c FROM t GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(c, doc_id)) AS component_id, doc_id <= coalesce(c, doc_id) AS kept FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)"""
_WARC = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS best FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND best > page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN payload_bytes >= 1000 AND best > page_id THEN best END AS refers_to FROM q"""

#: The others are trained, packed, approximate or too slow in SQL; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {"op1_decontaminate": _DEC, "op5_near_duplicates": _NEAR, "op7_warc": _WARC}
