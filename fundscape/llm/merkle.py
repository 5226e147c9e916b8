"""A Merkle manifest of a dataset: one tree per source, a tree over the sources' roots, and proofs for single rows.

Every 16 consecutive nodes (the last run of a level may be shorter, even one) become their hash, until one is left. Trees
are stored in blocks, which are aligned subtrees of ``HEIGHT`` levels: the roots of all blocks of a tree are the leaves of the
next tier of blocks, and so on up to one block per tree. Within a block the levels lie in van Emde Boas order: a
subtree is split at half its height, its upper part comes first, then the lower parts one after another, each split again
the same way, down to runs of 16 siblings, which are contiguous. ``run_address`` gives a run's place by arithmetic alone; it
serves both construction, which writes a level's hashes to their runs, and proofs, which read a slice for each level.

A block is built in one task from at most ``16 ** HEIGHT`` digests, however many rows a source has; texts are hashed where they
are read and never move. Places of leaves within their source come from a range partition and a count per partition and
source, not from a window over a source. Paths go down the tiers the other way: each block gets the path above its root and
gives one to each of its leaves, so a tier costs one join by block.

Nulls hash as ``-`` and null sources form a source of their own, which comes first. Empty and very long texts are hashed whole.
Rows that share a doc_id are leaves of their own, in the order of their hashes. An empty table has no roots and no proofs.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut

FAN, HEIGHT, DIGEST = 16, 3, 32


def span(height: int) -> int:
    """Nodes of a full subtree below its root."""
    return sum(FAN**k for k in range(1, height + 1))


def run_address(height: int, depth: int, index: np.ndarray | int) -> np.ndarray | int:
    """Where the children of the nodes ``index`` of level ``depth`` begin in a block of ``height`` levels."""
    if height == 1:
        return index * 0
    upper = height // 2
    if depth < upper:
        return run_address(upper, depth, index)
    below = FAN ** (depth - upper)
    return span(upper) + index // below * span(height - upper) + run_address(height - upper, depth - upper, index % below)


def build(leaves: bytes, height: int) -> tuple[bytes, bytes]:
    """(the block's nodes in van Emde Boas order, its root) of digests end to end."""
    if not height:
        return b"", leaves
    n, level = len(leaves) // DIGEST, np.frombuffer(leaves, np.uint8).reshape(-1, DIGEST)
    nodes = np.zeros((span(height), DIGEST), np.uint8)
    end = 0
    for depth in range(height - 1, -1, -1):
        parents = np.arange(-(-n // FAN))
        at = run_address(height, depth, parents)
        child = np.arange(n)
        place = at[child // FAN] + child % FAN
        nodes[place] = level
        end = max(end, int(place.max()) + 1)
        sizes = np.minimum(FAN, n - parents * FAN)
        runs = [nodes[a : a + k].tobytes().hex().encode() for a, k in zip(at, sizes, strict=True)]
        level = np.frombuffer(b"".join(hashlib.sha256(r).digest() for r in runs), np.uint8).reshape(-1, DIGEST)
        n = len(parents)
    return nodes[:end].tobytes(), level.tobytes()


def siblings(nodes: bytes, height: int, n: int, index: int) -> list[tuple[str, str]]:
    """For each level from the leaf up: the hashes left and right of it in its run, end to end."""
    out = []
    for depth in range(height - 1, -1, -1):
        parent, at = divmod(index, FAN)
        run = int(run_address(height, depth, parent)) * DIGEST
        size = min(FAN, n - parent * FAN) * DIGEST
        mid = run + at * DIGEST
        out.append((nodes[run:mid].hex(), nodes[mid + DIGEST : run + size].hex()))
        index, n = parent, -(-n // FAN)
    return out


def field(value: Column, kind: str = "string") -> Column:
    """A value as it is hashed: its UTF-8 size, a colon and itself; ``-`` for null."""
    text = value.cast(kind)
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


class Manifest(NamedTuple):
    """Leaves with their places; blocks, lowest tier first, of the sources' trees and of the tree of sources; roots."""

    leaves: DataFrame  # doc_id, source, leaf, tree, place
    tiers: list[DataFrame]  # tree, block, n, height, nodes, root
    upper: list[DataFrame]
    roots: DataFrame  # source, tree, subroot
    root: DataFrame  # root, at most one row


def _placed(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``place``, their number from 0 within ``tree`` (a column, null is a value), ordered by ``order`` (nulls first)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order)
    dealt = cut(dealt.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), name)
    # One row for each partition and tree that meet.
    counts = dealt.groupBy(tree, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    counts = counts.select(F.col(tree).alias("_tree"), F.col("_part").alias("_p"), (before - F.col("_first")).alias("_shift"))
    found = dealt.join(counts, F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("_part") == F.col("_p")))
    return found.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("place"))


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tree, block, height, leaves = batch.columns
        made = [build(b"".join(x), h) for x, h in zip(leaves.to_pylist(), height.to_pylist(), strict=True)]
        n = pa.array([len(x) for x in leaves.to_pylist()], pa.int64())
        columns = [tree, block, n, height, *(pa.array([m[i] for m in made], pa.binary()) for i in (0, 1))]
        yield pa.RecordBatch.from_arrays(columns, names=["tree", "block", "n", "height", "nodes", "root"])


def forest(leaves: DataFrame, *, height: int = HEIGHT) -> list[DataFrame]:
    """The tiers of blocks of all trees of ``leaves`` (tree, place, digest: binary); the last has one block per tree."""
    size, tiers, level = FAN**height, [], leaves
    # The levels that its leaves need; a block that isn't full is the last one, and lower only if it is the only one.
    own = F.aggregate(F.sequence(F.lit(1), F.lit(height)), F.lit(0), lambda most, k: F.when(F.size("leaves") > F.pow(F.lit(float(FAN)), k - 1), k).otherwise(most))
    while True:
        blocks = level.groupBy("tree", F.expr(f"place div {size}").alias("block")).agg(F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("x"))
        blocks = blocks.select("tree", "block", F.col("x.digest").alias("leaves"))
        blocks = blocks.select("tree", "block", F.when(F.col("block") > 0, height).otherwise(own).alias("height"), "leaves")
        tier = cut(blocks.mapInArrow(_built, "tree long, block long, n long, height int, nodes binary, root binary"), "blocks")
        tiers.append(tier)
        if tier.where("block > 0").isEmpty():
            return tiers
        level = tier.select("tree", F.col("block").alias("place"), F.col("root").alias("digest"))


PATH = "array<struct<left: string, right: string>>"


def _path_of(height: int, wanted: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block's columns, above, items) give the paths of their items; ``above`` is what lies over the block's root."""
    for batch in wanted:
        item = batch.schema.field("items").type.value_type.field("item").type
        tree, _, size, high, nodes, above, items = (c.to_pylist() for c in batch.columns)
        for t, n, h, held, over, some in zip(tree, size, high, nodes, above, items, strict=True):
            for i in range(0, len(some), 500):
                part = some[i : i + 500]
                found = [[{"left": a, "right": b} for a, b in siblings(held, h, n, x["place"] % FAN**height)] + over for x in part]
                columns = [([t] * len(part), pa.int64()), ([x["place"] for x in part], pa.int64()), ([x["item"] for x in part], item), (found, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))]
                yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in columns], names=["tree", "place", "item", "path"])


def paths(tiers: list[DataFrame], wanted: DataFrame, above: DataFrame | None = None, *, height: int = HEIGHT) -> DataFrame:
    """(tree, place, item, path) of ``wanted`` (tree, place, item of any type): siblings level by level, from the leaf up.
    ``above`` (tree, path) is what lies over each tree's root."""
    size = FAN**height
    if above is None:
        above = tiers[-1].select("tree", F.array().cast(PATH).alias("path"))
    over = tiers[-1].select("tree", "block").join(above, "tree")
    for k in range(len(tiers) - 1, -1, -1):
        items = wanted if k == 0 else tiers[k - 1].select("tree", F.col("block").alias("place"), F.lit("").alias("item"))
        some = items.groupBy("tree", F.expr(f"place div {size}").alias("block")).agg(F.collect_list(F.struct("place", "item")).alias("items"))
        rows = tiers[k].join(over, ["tree", "block"]).join(some, ["tree", "block"])
        rows = rows.select("tree", "block", "n", "height", "nodes", F.col("path").alias("above"), "items")
        item = items.schema["item"].dataType.simpleString()
        found = rows.mapInArrow(lambda batches: _path_of(height, batches), f"tree long, place long, item {item}, path {PATH}")
        if k:
            over = cut(found.select("tree", F.col("place").alias("block"), "path"), "paths")
    return found


def build_manifest(docs: DataFrame, *, height: int = HEIGHT, carried: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text). ``carried`` are more columns over these that the leaves keep."""
    inputs = docs.select("doc_id", "source", "lang", "n_chars", "text")
    made = leaf(*[F.col(c) for c in inputs.columns])
    more = [c.alias(name) for name, c in (carried or {}).items()]
    rows = cut(inputs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), made.alias("leaf"), *more), "leaves")
    ranks = cut(_placed(rows.select("source").distinct().withColumn("all", F.lit(0).cast("long")), "all", ["source"], "sources"), "sources")
    rows = rows.join(ranks.select(F.col("source").alias("_s"), F.col("place").alias("tree")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = cut(_placed(rows, "tree", ["doc_id", "leaf"], "placed"), "places")
    tiers = forest(rows.select("tree", "place", F.unhex("leaf").alias("digest")), height=height)
    upper = forest(tiers[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("root").alias("digest")), height=height)
    text = lambda c: F.lower(F.hex(c))
    roots = tiers[-1].join(ranks.select("source", F.col("place").alias("tree")), "tree").select("source", "tree", text("root").alias("subroot"))
    return Manifest(rows, tiers, upper, roots, upper[-1].select(text("root").alias("root")))


def prove(manifest: Manifest, wanted: DataFrame | None = None, *, height: int = HEIGHT) -> DataFrame:
    """(the columns of ``wanted``, subroot, path) of the leaves ``wanted`` (tree, place, and any more columns), by default all
    of them. A path has what stands left and right of its nodes in their runs, from the leaf over the source's root to the root."""
    of_sources = manifest.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("subroot").alias("item"))
    tops = cut(paths(manifest.upper, of_sources, height=height).select(F.col("place").alias("tree"), "path"), "tops")
    # Written, so that Spark splits a large source in this join and then deals leaves by block, not by source.
    wanted = cut((manifest.leaves if wanted is None else wanted).join(manifest.roots.select("tree", "subroot"), "tree"), "wanted")
    more = [c for c in wanted.columns if c not in ("tree", "place")]
    found = paths(manifest.tiers, wanted.select("tree", "place", F.struct(*more).alias("item")), tops, height=height)
    return found.select("tree", "place", "item.*", "path")


def fold(start: Column | str, path: Column | str) -> Column:
    """The root that a leaf and the siblings on its path give."""
    start, path = (F.col(c) if isinstance(c, str) else c for c in (start, path))
    return F.aggregate(path, start, lambda node, level: F.sha2(F.concat(level["left"], node, level["right"]), 256))


def proof_digest(path: Column | str) -> Column:
    """One hash of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), ""), 256)
