"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation, union-find.

A document is its set of distinct n-word shingles (the whole sequence, if it has fewer words). Steps:

1. One pass over the texts computes each set's size, a 128-bit fingerprint, a MinHash signature and band keys.
   Documents of equal sets are one class from here on, under the smallest doc_id.
2. In each band bucket all members are paired with the bucket's smallest: a star, not all pairs.
3. A pair's signatures are compared batch by batch; with a uniform prior the posterior that the similarity reaches the
   threshold after m of n agreements is a binomial tail, and the pair is dropped once it falls below ``miss``.
4. Survivors are confirmed on the full sets, and confirmed links are joined to components.
5. Buckets that still hold several components go, with all their members, to the component that has most members
   there. Such a group is compared block by block inside tasks, by 3 and 4, and only links that join components come
   out. Links inside a component are not looked at again, as they change nothing; no pairs are written out.

Joins on bucket, class and document are between scans, so Spark splits the partitions of a hot key.

Null, empty and wordless texts have no shingles and are linked with nothing. Rows that share a doc_id count as one
document with the links of each. Rows with null doc_id take part by their text. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import LOWER, byte_prefix, byte_table, cut, mix, prefix, row_slices, runs, span_hash, utf8
from .components import components

BANDS, ROWS = 20, 4
BATCH = 16
#: Documents of a block in which, or between two of which, one task compares.
GROUP_ROWS, GROUP_BYTES = 1500, 32 << 20
_SPACE = b" \t\n\x0b\x0c\r"
WORD = ~byte_table(_SPACE)
_A = np.random.default_rng(5).integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = np.random.default_rng(6).integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
SIGNED = "doc_id long, n_shingles long, f1 long, f2 long, signature binary, bands array<long>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row as sorted 64-bit hashes end to end, and where each row's begin."""
    low = LOWER[data]
    starts, ends = runs(WORD[low], offsets)
    words = span_hash(byte_prefix(low), starts, ends)
    first = np.searchsorted(starts, offsets)  # first word of each row
    count = np.diff(first)
    size = np.where(count > 0, np.maximum(count - n + 1, 1), 0)
    at = np.concatenate([[0], np.cumsum(size)])
    begin = np.repeat(first[:-1] - at[:-1], size) + np.arange(at[-1])
    length = np.repeat(np.minimum(count, n), size)
    hashes = span_hash(prefix(words), begin, begin + length)
    for a, b in zip(at[:-1], at[1:], strict=True):
        hashes[a:b].sort()
    keep = np.ones(len(hashes), bool)
    keep[1:] = hashes[1:] != hashes[:-1]
    inner = at[(at > 0) & (at < len(hashes))]
    keep[inner] = True
    return hashes[keep], np.concatenate([[0], np.cumsum(keep)])[at]


def _sign(n: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in row_slices(offsets):
            hashes, at = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
            size = np.diff(at)
            full = np.flatnonzero(size)
            begin = at[:-1][full]
            signature = np.zeros((len(full), len(_A)), np.uint32)
            if len(full):
                x = (hashes >> np.uint64(32)).astype(np.uint32)
                for k in range(len(_A)):
                    signature[:, k] = np.minimum.reduceat(x * _A[k] + _B[k], begin)
                f1 = np.add.reduceat(mix(hashes + np.uint64(1)), begin).view(np.int64)
                f2 = np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), begin).view(np.int64)
            else:
                f1 = f2 = np.zeros(0, np.int64)
            wide = signature.reshape(len(full), BANDS, ROWS).astype(np.uint64)
            keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None], len(full), 0)
            for r in range(ROWS):
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, r])
            spread = np.full(j - i, -1)
            spread[full] = np.arange(len(full))
            take = pa.array(np.where(spread < 0, 0, spread), mask=spread < 0)
            parts = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(full) + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[i:j],
                    pa.array(size, pa.int64()),
                    pa.array(f1).take(take),
                    pa.array(f2).take(take),
                    pa.array([s.tobytes() for s in signature], pa.binary()).take(take),
                    parts.take(take),
                ],
                names=["doc_id", "n_shingles", "f1", "f2", "signature", "bands"],
            )


def least_matches(threshold: float, miss: float, hashes: int = BANDS * ROWS) -> list[tuple[int, int]]:
    """(n, m): after n hashes a pair goes on only with m agreements, else P(similarity >= threshold) < miss."""
    out = []
    for n in range(BATCH, hashes + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:  # P(Bin(n + 1, threshold) <= m), the posterior under a uniform prior
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _plausible(needed: list[tuple[int, int]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in (2, 3))
        alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for n, least in needed:
            matches[alive] += (x[alive, n - BATCH : n] == y[alive, n - BATCH : n]).sum(1)
            alive = alive[matches[alive] >= least]
        yield batch.select(["a", "b"]).take(pa.array(alive))


def _sets(n: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in row_slices(offsets):
            hashes, at = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
            raw = hashes.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array([raw[a * 8 : b * 8] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["doc_id", "members"])


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirm(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = ([np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(c)] for c in (2, 3))
        good = [_similar(a, b, percent) for a, b in zip(x, y, strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _compare(needed: list[tuple[int, int]], percent: int, key, rows: pa.Table) -> pa.Table:
    """Links that join components of a group: between the rows of its two blocks, or in its one block.

    Every row outside the group's main component is compared with all rows of the other block by signature batches;
    what stays plausible is confirmed on the full sets, likeliest first, unless the two are joined by then.
    """
    main, one, two = (k.as_py() for k in key)
    rows = rows.sort_by([("doc_id", "ascending")])
    ids, block, size = (rows[c].to_numpy() for c in ("doc_id", "block", "n_shingles"))
    label = rows["component"].to_numpy()
    signature = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint32).reshape(len(ids), -1)
    sets = [np.frombuffer(v.as_buffer(), np.uint64) for c in rows["members"].chunks for v in c]
    names, own = np.unique(label, return_inverse=True)
    links: list[tuple[int, int]] = []
    for i in np.flatnonzero(label != main):
        other = np.flatnonzero((block == (two if block[i] == one else one)) & (own != own[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])))
        matches = np.zeros(len(other), np.int64)
        for n, least in needed:
            matches += (signature[other, n - BATCH : n] == signature[i, n - BATCH : n]).sum(1)
            other, matches = other[matches >= least], matches[matches >= least]
        for j in other[np.argsort(-matches, kind="stable")]:
            if own[i] != own[j] and _similar(sets[i], sets[j], percent):
                links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                own[own == own[i]] = own[j]
    return pa.table({c: pa.array([link[k] for link in links], pa.int64()) for k, c in enumerate(("a", "b"))})


def near_duplicates(docs: DataFrame, *, shingle_words: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_shingles, component_id, kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    needed = least_matches(percent / 100, miss)
    every = cut(docs.mapInArrow(lambda batches: _sign(shingle_words, batches), SIGNED), "signed")
    full = every.where("n_shingles > 0")
    classes = cut(full.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes")
    heads = cut(classes.where("rep is not null").select(F.col("rep").alias("doc_id")).distinct(), "heads")
    keys = full.select("doc_id", F.explode("bands").alias("key")).join(heads, "doc_id", "left_semi")
    shared = keys.groupBy("key").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("tail")).where("head < tail").select("key", "head")
    members = cut(keys.join(cut(shared, "buckets"), "key").distinct(), "members")
    # Signatures and full sets of the documents that share a bucket with any other.
    wanted = cut(members.select("doc_id").distinct(), "wanted")
    sets = docs.join(wanted, "doc_id", "left_semi").mapInArrow(lambda batches: _sets(shingle_words, batches), "doc_id long, members binary")
    signed = full.select("doc_id", "n_shingles", "signature").join(wanted, "doc_id", "left_semi")
    profiles = cut(signed.join(sets, "doc_id").where(F.octet_length("members") == 8 * F.col("n_shingles")).dropDuplicates(["doc_id", "signature"]), "profiles")
    stars = members.where("doc_id <> head").select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct()
    side = lambda c, x, *more: profiles.select(F.col("doc_id").alias(c), *(F.col(m).alias(n) for m, n in zip(more, x, strict=True)))
    near = stars.join(side("a", ("x", "nx"), "signature", "n_shingles"), "a").join(side("b", ("y", "ny"), "signature", "n_shingles"), "b")
    near = near.where(100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")).select("a", "b", "x", "y")
    near = cut(near.mapInArrow(lambda batches: _plausible(needed, batches), "a long, b long").distinct(), "near")
    sure = near.join(side("b", ("y",), "members"), "b").join(side("a", ("x",), "members"), "a").select("a", "b", "x", "y")
    links = cut(sure.mapInArrow(lambda batches: _confirm(percent, batches), "a long, b long").distinct(), "links")
    found = cut(components(links), "found")
    # Buckets that still hold several components are dealt to the component with most members there: that component's
    # members and all others of these buckets form a group, compared in pairs of blocks of bounded size.
    joined = members.select("key", "doc_id").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    joined = cut(joined, "joined")
    counts = joined.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = counts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("most"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    mixed = cut(mixed.select("key", F.col("most.component").alias("main")), "mixed")
    group = cut(joined.join(mixed, "key").select("main", "doc_id", "component").distinct(), "groups")
    parts = F.greatest(F.count(F.lit(1)) / GROUP_ROWS, F.sum("n_shingles") * 8 / GROUP_BYTES)
    blocks = group.join(profiles.select("doc_id", "n_shingles"), "doc_id").groupBy("main").agg(F.ceil(parts).cast("int").alias("blocks"))
    blocks = cut(blocks, "blocks")
    dealt = group.join(blocks, "main").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    dealt = dealt.join(profiles, "doc_id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("main", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "doc_id", "component", "block", "n_shingles", "signature", "members")
    more = cut(dealt.groupBy("main", "one", "two").applyInArrow(lambda key, rows: _compare(needed, percent, key, rows), "a long, b long").distinct(), "more")
    if not more.isEmpty():
        found = cut(components(links.union(more)), "found")
    # The classes and their components, then the documents.
    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("f1", "f2", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    named = cut(named, "named")
    out = every.select("doc_id", "n_shingles", "f1", "f2").join(named, ["f1", "f2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, as they are, whose document is the first of its component."""
    gone = near_duplicates(docs, shingle_words=shingle_words, percent=percent).where("not kept and doc_id is not null").select("doc_id").distinct()
    gone = cut(gone, "gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["doc_id"], "left_anti")
