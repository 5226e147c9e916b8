"""A bounded sample of labelled documents to fit classifiers on, and the split that holds rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learned from: crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, most_bytes: int = 64 << 20) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, y) of at most ``per_class`` labelled documents of each class, the first by a hash of their ids,
    whose texts have ``most_bytes`` bytes at most
    together (per class), and how many labelled rows each class has. Held-out rows are left out of both. A document with several labels has
    the largest; null labels count as none.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows at most
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    few = F.broadcast(chosen[0].union(chosen[1]))  # at most 2 * per_class rows of two numbers
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(few, "doc_id")
    # Whole texts in that order until a class's share of bytes is used up; sizes of few rows, texts stay where they are.
    so_far = Window.partitionBy("y").orderBy(*order, "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = found.select("doc_id", "y", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"))
    fits = sizes.select("doc_id", (F.sum("n").over(so_far) <= most_bytes).alias("fits")).groupBy("doc_id").agg(F.min("fits").alias("fits")).where("fits")
    return found.join(F.broadcast(fits.select("doc_id")), "doc_id"), counts  # at most 2 * per_class ids
