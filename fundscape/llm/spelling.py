"""Spelling variants: which words of a vocabulary are one edit apart, and which common word each rare one is a form of.

1. Letters are hashed to a few symbols, so a word becomes a reduced word over a small alphabet. Two words that differ by one
   inserted, deleted or replaced letter have reduced words that are equal or one edit apart.
2. Every distinct reduced word generates its full one-edit neighbourhood over the small alphabet: about ``2 * SYMBOLS`` keys
   for each letter, where the full alphabet would give eighteen times as many. Keys are 64-bit polynomial hashes, so each of
   them is made in constant time from sums before and after the edit, and none is ever spelt out: a word of a hundred
   thousand letters costs no more for each key than a short one.
3. Keys are joined with the reduced vocabulary, and its words are verified on the original strings (edit distance 1). Hash
   collisions can only add candidates that the verification rejects.
4. A word's form is its near word with the largest count (ties: the smallest), if that count is ``ratio`` times its own or
   more. Counts grow at least so much with every step, so roots are found by doubling steps a few times.

Occurrences are counted by Spark's map-side aggregation, so a word in a third of all texts is no hot key. Words that share
one reduced form are spread over a join between written tables, whose large partitions Spark splits.

Null and empty texts have no words; very long texts and words are taken whole; repeated rows count each. Empty tables give
empty ones. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, mix

#: Symbols of the small alphabet.
SYMBOLS = 5
LEAST_LETTERS, LEAST_COUNT = 6, 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of letters: ASCII and the upper half of Latin-1.
LETTERS = r"[A-Za-zÀ-ÿ]"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def words(text: Column, least: int = LEAST_LETTERS) -> Column:
    """The maximal runs of letters of at least ``least`` letters, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))


def noisy_words(docs: DataFrame, *, one_in: int = 199, least: int = LEAST_LETTERS) -> DataFrame:
    """(word) of every occurrence in ``docs`` (doc_id, text) of at least ``least`` letters, of which about one in ``one_in``
    loses a letter: where that number divides the hash of document and word, the letter at this hash modulo the word's
    length. A row without doc_id loses none."""
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(words(F.col("text"), least)).alias("word"))
    h = F.crc32(F.concat("doc_id", F.lit(":"), "word").cast("binary"))
    at = (h % F.length("word")).cast("int")
    shorter = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    return found.select(F.when(h % one_in == 0, shorter).otherwise(F.col("word")).alias("word")).where(F.length("word") >= least)


def vocabulary(occurrences: DataFrame, *, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words (word) that occur at least ``least`` times."""
    return occurrences.where("word is not null").groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _symbols(codes: np.ndarray, symbols: int) -> np.ndarray:
    """From 1 on, as a zero would vanish from the hash."""
    return mix(codes.astype(np.uint64)) % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    up = np.full(n + 1, _BASE)
    up[0] = 1
    return np.cumprod(up, dtype=np.uint64)


def _letters(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le"), np.uint32)


def reduced_hash(word: str, symbols: int = SYMBOLS) -> np.uint64:
    """The hash of a word's reduced form."""
    s = _symbols(_letters(word), symbols)
    return mix(np.array([(s * _powers(len(s))[1:]).sum(dtype=np.uint64) + np.uint64(len(s))]))[0]


def neighbourhood(word: str, symbols: int = SYMBOLS) -> np.ndarray:
    """The hashes of the reduced form of a word and of all strings over the small alphabet that are one edit away from it."""
    s = _symbols(_letters(word), symbols)
    n, up = len(s), _powers(len(s) + 2)
    terms = s * up[1 : n + 1]
    before = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])  # before[i]: of the first i letters
    after = before[-1] - before  # after[i]: of the letters from i on, where they stand
    later = after * _BASE  # the same, moved by one place to the right
    kinds = np.arange(1, symbols + 1, dtype=np.uint64)
    same = before[-1:] + np.uint64(n)
    deleted = before[:n] + after[1:] * _INVERSE + np.uint64(n - 1)
    replaced = (before[:n] + after[1:])[:, None] + kinds[None, :] * up[1 : n + 1, None] + np.uint64(n)
    inserted = (before + later)[:, None] + kinds[None, :] * up[1 : n + 2, None] + np.uint64(n + 1)
    return np.unique(mix(np.concatenate([same, deleted, replaced.ravel(), inserted.ravel()])))


def _reduced(symbols: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.array([reduced_hash(w, symbols) for w in batch.column(0).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64))], names=[*batch.schema.names, "reduced"])


def _neighbours(symbols: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 200):
            part = batch.slice(i, 200)
            keys = [neighbourhood(w, symbols) for w in part.column(1).to_pylist()]
            sizes = [len(k) for k in keys]
            rows = pa.array(np.repeat(np.arange(len(keys)), sizes))
            yield pa.RecordBatch.from_arrays([part.column(0).take(rows), pa.array(np.concatenate(keys).view(np.int64))], names=["reduced", "key"])


def near_words(vocab: DataFrame, *, symbols: int = SYMBOLS) -> DataFrame:
    """(a, b) of all ordered pairs of different words of ``vocab`` (word) that are exactly one edit apart."""
    own = cut(vocab.select("word").mapInArrow(lambda batches: _reduced(symbols, batches), "word string, reduced long"), "reduced")
    forms = own.groupBy("reduced").agg(F.min("word").alias("word"))
    # Reduced words that have others of the vocabulary in their neighbourhood; each is in its own.
    keys = forms.mapInArrow(lambda batches: _neighbours(symbols, batches), "reduced long, key long")
    links = cut(keys.join(forms.select(F.col("reduced").alias("key")), "key"), "links")
    left = links.join(own.select("reduced", F.col("word").alias("a")), "reduced")
    pairs = left.join(own.select(F.col("reduced").alias("key"), F.col("word").alias("b")), "key")
    near = F.abs(F.length("a") - F.length("b")) <= 1
    return pairs.where((F.col("a") != F.col("b")) & near & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")


def variants(vocab: DataFrame, *, ratio: int = 5, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``vocab`` (word, n)."""
    vocab = cut(vocab.select("word", "n"), "vocabulary")
    near = near_words(vocab, symbols=symbols).join(vocab.select(F.col("word").alias("b"), "n"), "b")
    best = near.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "b")).alias("best"))
    found = vocab.join(best.withColumnRenamed("a", "word"), "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    form, form_n = F.when(is_form, F.col("best.b")), F.when(is_form, -F.col("best.less"))
    found = cut(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"), form_n.alias("form_n")), "forms")
    steps = cut(found.where("form is not null").select("word", F.col("form").alias("root")), "steps")
    while True:  # a word's root so far, then that word's
        after = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = cut(steps.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "steps")
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return found.join(steps.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
