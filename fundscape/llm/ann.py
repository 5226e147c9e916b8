"""Approximate nearest neighbours by cosine, with score-aware (anisotropic) quantisation.

1. Equal vectors are one class, which keeps its ``k + 1`` smallest ids: all that any result can hold.
2. On a bounded sample (``sample_rows`` vectors, the first by a hash) spherical k-means finds the lists, and a product
   quantiser of two-dimensional parts with 16 codewords each is fitted to the residuals under the loss
   |e|^2 + (eta - 1) (e.x)^2: the error along x, which shifts inner products with near queries, weighs eta times.
   Codes are set by coordinate descent, codewords by the joint least-squares solution.
3. Every class gets its list and its codes, two to a byte.
4. Classes are dealt at random into blocks of about ``BLOCK_ROWS`` and queries likewise; every pair of blocks is
   one task's work. In a block a query scans the classes of its ``probes`` nearest lists, with one 256-entry table per
   byte, and scores its best there (its share of ``keep``, four standard deviations and eight more) exactly, in double
   precision on the original vectors. That gives a score to beat.
5. The other lists are scanned as well unless their angle to the query, less their radius, rules it out, and every scanned
   class whose table score may be wrong by enough to reach the score to beat is scored exactly: by its own coding error
   times ``slack``, the largest such ratio among near pairs of the sample (at most 1, where it is a certain bound).
   So dense groups, whose members share their codes, are told apart by exact scores, however many they are.

Vectors that are null, zero, hold null or non-finite components or have another length than most take no part, and rows
with null ids none either. Repeated ids count once per vector. Fewer candidates than k give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut

CODES = 16
PART = 2
BLOCK_ROWS, BLOCK_QUERY_BYTES = 1 << 14, 1 << 25
FOUND = "query_id long, gid long, score double"


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Unit centroids of unit vectors."""
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = np.argmax(x @ centre.T, 1)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        empty = np.bincount(own, minlength=k) == 0
        total[empty] = x[rng.choice(len(x), int(empty.sum()))]
        centre = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-12)
    return centre


def encode(x: np.ndarray, rest: np.ndarray, words: np.ndarray, eta: float, sweeps: int = 2) -> np.ndarray:
    """Codes (rows, parts) of the residuals ``rest`` of unit vectors ``x``; ``words``: (parts, CODES, PART)."""
    parts = words.shape[0]
    xs, rs = x.reshape(len(x), parts, PART), rest.reshape(len(x), parts, PART)
    far = ((rs[:, :, None] - words[None]) ** 2).sum(-1)
    along = np.einsum("npd,pcd->npc", xs, words)
    codes = far.argmin(-1)
    at = np.arange(len(x))
    own = (rs * xs).sum(-1)
    error = (own - along[at[:, None], np.arange(parts), codes]).sum(1)  # e.x
    for _ in range(sweeps):
        for p in range(parts):
            base = error + along[at, p, codes[:, p]]
            codes[:, p] = (far[:, p] + (eta - 1) * (base[:, None] - along[:, p]) ** 2).argmin(1)
            error = base - along[at, p, codes[:, p]]
    return codes


def fit_words(x: np.ndarray, rest: np.ndarray, eta: float, rounds: int = 4, seed: int = 12) -> np.ndarray:
    """Codewords for the residuals, by turns of coding and joint least squares."""
    n, d = x.shape
    parts = d // PART
    rng = np.random.default_rng(seed)
    words = rest[rng.choice(n, CODES, replace=n < CODES)].reshape(CODES, parts, PART).transpose(1, 0, 2).copy()
    size = parts * CODES * PART
    for _ in range(rounds):
        codes = np.concatenate([encode(x[i : i + 1000], rest[i : i + 1000], words, eta) for i in range(0, n, 1000)])
        slot = ((np.arange(parts) * CODES + codes)[:, :, None] * PART + np.arange(PART)).reshape(n, d)
        if size > 4096:  # the matrix would be large: by conjugate gradients instead
            words = _solve(x, rest, slot, eta, words.reshape(-1)).reshape(parts, CODES, PART)
            continue
        left, right = np.zeros((size, size)), np.zeros(size)
        np.add.at(left, (slot, slot), 1.0)
        np.add.at(right, slot, rest)
        scale = (rest * x).sum(1)
        for i in range(0, n, 2048):
            wide = np.zeros((len(x[i : i + 2048]), size), np.float32)
            np.put_along_axis(wide, slot[i : i + 2048], x[i : i + 2048].astype(np.float32), 1)
            left += (eta - 1) * (wide.T @ wide)
            right += (eta - 1) * (scale[i : i + 2048] @ wide)
        left += 1e-3 * np.eye(size)
        words = np.linalg.solve(left, right + 1e-3 * words.reshape(-1)).reshape(parts, CODES, PART)
    return words


def _solve(x: np.ndarray, rest: np.ndarray, slot: np.ndarray, eta: float, words: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Codewords of the same least squares as a vector, without its matrix."""
    spread = lambda v: np.bincount(slot.reshape(-1), (v + (eta - 1) * x * (x * v).sum(1, keepdims=True)).reshape(-1), len(words))
    times = lambda z: spread(z[slot]) + 1e-3 * z
    z, r = words.copy(), spread(rest) + 1e-3 * words - times(words)
    p, rr = r.copy(), r @ r
    for _ in range(rounds):
        if rr <= 1e-18:
            break
        ap = times(p)
        step = rr / (p @ ap)
        z, r = z + step * p, r - step * ap
        p, rr = r + (r @ r) / rr * p, r @ r
    return z


def _coded(centre: np.ndarray, words: np.ndarray, eta: float, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists, codes and the vectors that they stand for."""
    near = np.argmax(x @ centre.T, 1)
    codes = encode(x, x - centre[near], words, eta)
    return near, codes, centre[near] + words[np.arange(len(words)), codes].reshape(x.shape)


def calibrate(centre: np.ndarray, words: np.ndarray, eta: float, sample: np.ndarray, queries: int = 500, near: int = 100) -> float:
    """How far scores of the nearest are above their table scores at most, as a part of the norm of the coding error."""
    stood = np.concatenate([_coded(centre, words, eta, sample[i : i + 1000])[2] for i in range(0, len(sample), 1000)])
    norm = np.maximum(np.linalg.norm(sample - stood, axis=1), 1e-12)
    most = 0.0
    for i in range(0, min(queries, len(sample)), 100):
        q = sample[i : min(i + 100, queries)]
        score = q @ sample.T
        ratio = (score - q @ stood.T) / norm
        best = np.argsort(-score, 1)[:, :near]
        most = max(most, float(np.take_along_axis(ratio, best, 1).max()))
    return min(1.0, 1.1 * most + 0.01)


def _unit(column: pa.Array, width: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _index(centre: np.ndarray, words: np.ndarray, eta: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _unit(batch.column(1), centre.shape[1])
        near, codes, stood = _coded(centre, words, eta, x)
        error, radius = np.linalg.norm(x - stood, axis=1), np.arccos(np.clip((x * centre[near]).sum(1), -1, 1))
        codes = codes.astype(np.uint8)
        codes = np.pad(codes, ((0, 0), (0, codes.shape[1] % 2)))
        packed = codes[:, ::2] | (codes[:, 1::2] << 4)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(near, pa.int32()), pa.array([r.tobytes() for r in packed], pa.binary()), pa.array(error), pa.array(radius), batch.column(1)], names=["gid", "list", "codes", "error", "radius", "x"])


def _probe(centre: np.ndarray, probes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _unit(batch.column(1), centre.shape[1])
        near = np.argsort(-(x @ centre.T), 1, kind="stable")[:, :probes]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(near.astype(np.int32)), pa.list_(pa.int32())), batch.column(1)], names=["query_id", "lists", "q"])


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _cosines(a: np.ndarray, q: np.ndarray) -> np.ndarray:
    a = a.astype(np.float64)
    return (a * q).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((q * q).sum()))


def _scan(centre: np.ndarray, words: np.ndarray, slack: float, keep: int, k: int, left: pa.Table, right: pa.Table) -> pa.Table:
    """The ``k`` classes of a block with the largest cosines for each query."""
    empty = pa.table({"query_id": pa.array([], pa.int64()), "gid": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not left.num_rows or not right.num_rows:
        return empty
    parts, lists = words.shape[0], len(centre)
    order = np.argsort(left["list"].to_numpy(), kind="stable")
    codes = np.frombuffer(b"".join(left["codes"].to_pylist()), np.uint8).reshape(left.num_rows, -1)[order]
    gids, own = left["gid"].to_numpy()[order], left["list"].to_numpy()[order]
    error, vectors = left["error"].to_numpy()[order], _rows(left["x"])[order]
    radius = np.full(lists, -1.0)
    np.maximum.at(radius, own, left["radius"].to_numpy()[order])
    ids, asked, probes, out = right["query_id"].to_numpy(), _rows(right["q"]).astype(np.float64), _rows(right["lists"]), [[], [], []]
    for i in range(len(ids)):
        q = asked[i]
        unit = np.pad(q / np.linalg.norm(q), (0, parts * PART - len(q)))
        table = np.zeros((parts + parts % 2, CODES), np.float32)
        table[:parts] = np.einsum("pcd,pd->pc", words, unit.reshape(parts, PART))
        pair = (table[1::2, :, None] + table[::2, None, :]).reshape(-1, CODES * CODES)  # by byte: high half, low half
        central = centre @ unit

        def scanned(at: np.ndarray) -> np.ndarray:
            score, some = central.astype(np.float32)[own[at]], codes[at]  # noqa: B023
            for b in range(codes.shape[1]):
                score += pair[b][some[:, b]]  # noqa: B023
            return score

        probed = np.zeros(lists, bool)
        probed[probes[i]] = True
        at = np.flatnonzero(probed[own])
        if len(at) < keep:
            probed[:], at = True, np.arange(len(own))
        approx = scanned(at)
        best = np.argpartition(-approx, keep)[:keep] if len(at) > keep else np.arange(len(at))
        exact = np.full(len(at), np.nan)
        exact[best] = _cosines(vectors[at[best]], q)
        if len(best) > k:
            least = np.partition(exact[best], len(best) - k)[len(best) - k] - 1e-6
            hopeful = ~probed & (radius >= 0) & (np.cos(np.maximum(0, np.arccos(np.clip(central, -1, 1)) - radius)) >= least)
            more = np.flatnonzero(hopeful[own])
            at, approx, exact = np.concatenate([at, more]), np.concatenate([approx, scanned(more)]), np.concatenate([exact, np.full(len(more), np.nan)])
            rest = np.flatnonzero(np.isnan(exact) & (approx + slack * error[at] >= least))
            exact[rest] = _cosines(vectors[at[rest]], q)
        done = np.flatnonzero(~np.isnan(exact))
        done = done[np.lexsort((gids[at[done]], -exact[done]))[:k]]
        out[0].append(np.full(len(done), ids[i]))
        out[1].append(gids[at[done]])
        out[2].append(exact[done])
    return pa.table({n: np.concatenate(c) for n, c in zip(empty.column_names, out, strict=True)})


def nearest(vectors: DataFrame, is_query: Column, *, k: int = 5, sample_rows: int = 8000, lists: int | None = None, probe_share: float = 0.25, keep: int = 250, threshold: float = 0.2) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found of every row of ``vectors`` (vec_id, embedding) for which
    ``is_query`` holds; the row's own id is no candidate. ``threshold``: the cosine from which errors along the vector
    count; it sets eta.
    """
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("x"), is_query.alias("is_query"))
    x = x.where("vec_id is not null and x is not null and size(x) > 0")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists("x", lambda v: v != 0)
    x = x.where(finite)
    widths = x.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "width").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if widths is None:
        return vectors.sparkSession.createDataFrame([], empty)
    width = widths["width"]
    x = cut(x.where(F.size("x") == width).withColumns({"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit(1), "x")}), "vectors")
    few = Window.partitionBy("h1", "h2").orderBy("vec_id")
    firsts = x.select("h1", "h2", "vec_id", "x").dropDuplicates(["h1", "h2", "vec_id"]).withColumn("r", F.row_number().over(few)).where(F.col("r") <= k + 1)
    classes = cut(firsts.groupBy("h1", "h2").agg(F.min("vec_id").alias("gid"), F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("x").alias("x")), "classes")
    n = classes.count()
    some = classes.select("gid", "x").orderBy(F.xxhash64("gid"), "gid").limit(sample_rows).toArrow()
    padded = width + width % PART
    sample = _unit(some["x"].combine_chunks(), padded)
    k_lists = min(len(sample), lists or int(np.clip(np.sqrt(n) / 2, 1, 1024)))
    centre = kmeans(sample, k_lists)
    eta = max(1.0, (width - 1) * threshold**2 / (1 - threshold**2))
    near = np.argmax(sample @ centre.T, 1)
    words = fit_words(sample, sample - centre[near], eta)
    slack = calibrate(centre, words, eta, sample)
    probes = max(1, int(np.ceil(k_lists * probe_share)))

    index = cut(classes.select("gid", "x").mapInArrow(lambda batches: _index(centre, words, eta, batches), f"gid long, list int, codes binary, error double, radius double, x {kind}"), "index")
    asked = x.where("is_query").select("vec_id", "x", "h1", "h2").dropDuplicates(["vec_id", "h1", "h2"])
    probed = cut(asked.select("vec_id", "x").mapInArrow(lambda batches: _probe(centre, probes, batches), f"query_id long, lists array<int>, q {kind}"), "probed")
    blocks, qblocks = -(-n // BLOCK_ROWS), max(1, -(-probed.count() * 8 * width // BLOCK_QUERY_BYTES))
    deal = lambda c, n: F.pmod(F.xxhash64(F.lit(8), c), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.select(deal("gid", blocks).alias("block"), each(qblocks).alias("qblock"), "gid", "list", "codes", "error", "radius", "x")
    right = probed.select(each(blocks).alias("block"), deal("query_id", qblocks).alias("qblock"), "query_id", "lists", "q")
    share = keep / blocks
    own = int(np.ceil(share + 4 * np.sqrt(share) + 8))
    grouped = left.groupBy("block", "qblock").cogroup(right.groupBy("block", "qblock"))
    found = grouped.applyInArrow(lambda a, b: _scan(centre, words, slack, own, k + 1, a, b), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "gid")
    found = cut(found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).select("query_id", "gid", "score"), "found")
    rows = found.join(classes.select("gid", "ids"), "gid").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
