"""Quality classifier: supervised subword embeddings.

A document is the mean of the vectors of its words plus the mean of the vectors of its byte 3- and 4-grams, all hashed
to ``BUCKETS`` learned rows; a word that repeats the one before also counts as the one token ``<same>``. A softmax
layer on top gives the class. Vectors and layer are trained together by stochastic gradient descent in numpy, on a
bounded sample (``per_class`` labelled documents of each class), a part of which only fits the final scale and offset.
Labels' shares of all labelled rows are the prior. Scoring needs one number per bucket, as averaging and the layer are
linear; it runs over whole texts where they lie, without a shuffle.

Null and empty texts have no features and get the prior's score. Without labels of both classes every score is the
prior's. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import byte_prefix, byte_table, row_slices, runs, span_hash, utf8
from .labelled import held_out, sample

BUCKETS = 1 << 16
SAME = BUCKETS - 1
GRAMS = (3, 4)
TOKEN = ~byte_table(b" \t\n\x0b\x0c\r")


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(40)).astype(np.int64) % (BUCKETS - 1)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of every word and marker, and of every n-gram, in rows of bytes."""
    starts, ends = runs(TOKEN[data], offsets)
    sums = byte_prefix(data)
    words = span_hash(sums, starts, ends)
    row = np.searchsorted(offsets, starts, "right") - 1
    same = np.flatnonzero((words[1:] == words[:-1]) & (row[1:] == row[:-1])) + 1
    word_ids = np.concatenate([_bucket(words), np.full(len(same), SAME)])
    word_rows = np.concatenate([row, row[same]])
    ids, rows = [], []
    for n in GRAMS:
        first = np.arange(max(0, len(data) - n + 1))
        own = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        inside = own[first] == own[first + n - 1]
        first = first[inside]
        ids.append(_bucket(span_hash(sums, first, first + n)))
        rows.append(own[first])
    return (word_ids, word_rows), (np.concatenate(ids), np.concatenate(rows))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i in range(batch.num_rows):
            ids, values = [], []
            for bucket, _ in features(data[offsets[i] : offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]])):
                found, n = np.unique(bucket, return_counts=True)
                ids.append(found)
                values.append(n / max(1, len(bucket)))
            found, at = np.unique(np.concatenate(ids), return_inverse=True)
            total = np.bincount(at, np.concatenate(values), len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[i : i + 1], batch.column(2)[i : i + 1], pa.array([found.astype(np.int32).tobytes()], pa.binary()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["doc_id", "y", "ids", "vals"]
            )


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_scale(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Logistic regression of y on the columns of x by damped Newton steps: coefficients and offset."""
    z = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(z.shape[1])
    ridge = np.full(z.shape[1], 1e-2)
    for _ in range(rounds):
        p = _sigmoid(z @ beta)
        gradient = z.T @ (weight * (p - y)) + ridge * beta
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(hessian + 1e-6 * np.eye(len(beta)), gradient)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return beta[:-1], float(beta[-1])


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], counts: dict[int, int], *, size: int = 8, epochs: int = 8, rate: float = 0.5, seed: int = 3) -> tuple[np.ndarray, float]:
    """A number per bucket and an offset whose sum over a document's shares is the log-odds of label 1."""
    prior = np.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1))
    if len({y for y, _, _ in rows}) < 2:
        return np.zeros(BUCKETS, np.float32), float(prior)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 1 / size, (BUCKETS, size))
    layer, bias = rng.normal(0, 1 / size, (size, 2)), np.zeros(2)
    seen, seen_layer = np.full(BUCKETS, 1e-8), np.full((size, 2), 1e-2)
    order = rng.permutation(len(rows))
    checks, learn = order[: len(order) // 5], order[len(order) // 5 :]
    share = {y: max(1, sum(rows[k][0] == y for k in learn)) for y in (0, 1)}
    for _ in range(epochs):
        for k in rng.permutation(learn):
            y, ids, vals = rows[k]
            doc = vals @ vectors[ids]
            out = doc @ layer + bias
            p = np.exp(out - out.max())
            p /= p.sum()
            p[y] -= 1
            p *= len(learn) / (2 * share[y])
            towards = layer @ p
            seen[ids] += (vals**2) * (towards @ towards)
            vectors[ids] -= rate * (vals / np.sqrt(seen[ids]))[:, None] * towards * 0.1
            step = np.outer(doc, p)
            seen_layer += step**2
            layer -= 0.1 * rate * step / np.sqrt(seen_layer)
            bias -= 0.01 * rate * p
    weights = vectors @ (layer[:, 1] - layer[:, 0])
    raw = np.array([vals @ weights[ids] for _, ids, vals in rows])
    y = np.array([r[0] for r in rows])
    use = checks if len({int(v) for v in y[checks]}) == 2 and len(checks) >= 40 else order
    real = np.where(y[use] == 1, counts[1] / max(1, (y[use] == 1).sum()), counts[0] / max(1, (y[use] == 0).sum()))
    (a,), b = fit_scale(raw[use, None] / (spread := max(1e-9, np.abs(raw).mean())), y[use], real * len(use) / real.sum())
    return (weights * a / spread).astype(np.float32), b


def _score(model: tuple[np.ndarray, float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights, offset = model
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in row_slices(offsets):
            total = np.full(j - i, offset)
            for ids, rows in features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]):
                total += np.bincount(rows, weights[ids], j - i) / np.maximum(1, np.bincount(rows, minlength=j - i))
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(_sigmoid(total))], names=["doc_id", "score"])


def score_quality(docs: DataFrame, labels: DataFrame, *, label: str = "quality", per_class: int = 1000) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): held_out and score, the probability of label 1."""
    few, counts = sample(docs, labels, label, per_class)
    found = few.select("doc_id", "text", "y").mapInArrow(_count, "doc_id long, y int, ids binary, vals binary").collect()  # 2 * per_class rows
    rows = [(r["y"], np.frombuffer(r["ids"], np.int32), np.frombuffer(r["vals"], np.float32)) for r in sorted(found, key=lambda r: (r["doc_id"], bytes(r["ids"])))]
    model = docs.sparkSession.sparkContext.broadcast(train(rows, counts))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda batches: _score(model.value, batches), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")
