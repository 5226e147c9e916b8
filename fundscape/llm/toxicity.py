"""Toxicity by a noisy channel: restore disguised words, then score the restored text.

1. A character language model: trigram counts over all documents (letters, a class for other letters, for digits, for
   signs and for gaps), summed by Spark.
2. Suspicious spans: tokens with a letter and, anywhere, a sign or digit that can stand for one; letters repeated twice
   or more; three or more single letters with any blanks and punctuation of the same line between them.
3. A span is a lattice: each sign as it is or as the letters it can stand for, each run of a letter at full length,
   doubled or single, each separator run (among single letters, signs too) kept or dropped, at a channel cost. Viterbi decoding under the language model
   gives the restored span. All else has one path through the lattice and stays.
4. Words (lower-cased) of the restored text and of the text as it is are evidence: how much likelier the word, or its
   first four or five bytes, is in toxic documents of the labelled sample. A logistic curve over a document's two
   strongest words, fitted on leave-one-out evidence, gives the score.

The sample is bounded (``per_class`` labelled documents of each class); labels' shares of all labelled rows are the
prior. Texts are scored whole and where they lie. Null and empty texts have no evidence. Without labels of both classes
every score is the prior's. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import LOWER, byte_prefix, byte_table, row_slices, runs, span_hash, utf8
from .labelled import held_out, sample
from .quality import _sigmoid, fit_scale

# What a sign can stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
SIGNS = byte_table(b"0123456789@$!|+(")
LETTERS = byte_table(b"abcdefghijklmnopqrstuvwxyz")
WORD = byte_table(b"abcdefghijklmnopqrstuvwxyz0123456789" + bytes(range(0x80, 0x100)))
TOKEN = WORD | SIGNS
#: Symbols: gap, a to z, other letters, digits, signs.
SYMBOLS = 30
GAP, OTHER, DIGIT, SIGN = 0, 27, 28, 29
FOLD = np.full(256, SIGN, np.int64)
FOLD[list(b" \t\n\x0b\x0c\r")] = GAP
FOLD[list(b"abcdefghijklmnopqrstuvwxyz")] = np.arange(1, 27)
FOLD[0x80:] = OTHER
FOLD[list(b"0123456789")] = DIGIT
#: Log-probabilities that the channel disguises so.
SUBSTITUTED, SHORTENED, DROPPED = np.log(0.2), np.log(0.2), np.log(0.5)
EVIDENCE = "doc_id long, y int, words binary, heads4 binary, heads5 binary"


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**3, np.int64)
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for i, j in row_slices(offsets):
            s = FOLD[LOWER[data[offsets[i] : offsets[j]]]]
            own = np.repeat(np.arange(i, j), np.diff(offsets[i : j + 1]))
            inside = own[:-2] == own[2:]  # trigrams of one text, so counts are the same however rows are dealt
            total += np.bincount(((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:])[inside], minlength=SYMBOLS**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """Log-probability of each symbol after each two, interpolated; counted over all texts of ``docs``."""
    rows = docs.select("text").mapInArrow(_trigrams, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # SYMBOLS ** 3 rows at most
    three = np.zeros(SYMBOLS**3)
    for r in rows:
        three[r["cell"]] = r["n"]
    three = three.reshape((SYMBOLS,) * 3)
    two, one = three.sum(0), three.sum((0, 1)) + 1
    p1 = one / one.sum()
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    return np.log((three + 5 * p2[None]) / (three.sum(2, keepdims=True) + 5))


def _options(span: str) -> list[list[tuple[str, float]]]:
    """The lattice: for each step, strings that it can emit and their channel costs."""
    steps, i = [], 0
    spaced = len(span) > 4 and not any(a.isalnum() and b.isalnum() for a, b in zip(span, span[1:], strict=False))
    gap = lambda c: not c.isalnum() and c not in STANDS_FOR
    while i < len(span):
        c, n = span[i], 1
        while i + n < len(span) and span[i + n] == c:
            n += 1
        if c.isalpha() and n >= 2:
            steps.append([(c * n, 0.0), *[(c * 2, SHORTENED)] * (n > 2), (c, SHORTENED)])
        elif c in STANDS_FOR:
            one = [(c, 0.0), *((x, SUBSTITUTED) for x in STANDS_FOR[c]), *[("", DROPPED)] * (spaced and not c.isalnum())]
            steps += [one] * n if n < 3 else [[(c * n, 0.0), *((x, SUBSTITUTED + SHORTENED) for x in STANDS_FOR[c])]]
        elif spaced and gap(c):
            n = next((k for k in range(i, len(span)) if not gap(span[k])), len(span)) - i
            steps.append([(span[i : i + n], 0.0), ("", DROPPED)])
        else:
            steps.append([(c * n, 0.0)])
        i += n
    return steps


def decode(span: str, model: np.ndarray) -> str:
    """The likeliest intended text of a disguised span."""
    fold = lambda c: int(FOLD[ord(c)]) if ord(c) < 128 else OTHER
    paths: dict[tuple[int, int], tuple[float, str]] = {(GAP, GAP): (0.0, "")}
    for options in [*_options(span), [(" ", 0.0)]]:
        new: dict[tuple[int, int], tuple[float, str]] = {}
        for (p, q), (logp, text) in paths.items():
            for out, cost in options:
                a, b, total = p, q, logp + cost
                for c in out:
                    s = fold(c)
                    total += model[a, b, s]
                    a, b = b, s
                if (a, b) not in new or total > new[a, b][0]:
                    new[a, b] = (total, text + out)
        paths = new
    return max(paths.values())[1].rstrip(" ")


def suspicious(low: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges of lower-cased text that may be disguised."""
    if not len(low):
        return []
    next1, next2 = np.append(low[1:], np.uint8(0)), np.append(low[2:], np.zeros(min(2, len(low)), np.uint8))
    euro = (low == 0xE2) & (next1 == 0x82) & (next2 == 0xAC)
    # punctuation beyond ASCII: U+0080 to U+00BF and U+2000 to U+203F
    two, three = low == 0xC2, (low == 0xE2) & (next1 == 0x80)
    token = TOKEN[low] & ~two & ~three
    token[1:] &= ~two[:-1] & ~three[:-1]
    token[2:] &= ~three[:-2]
    starts, ends = runs(token, offsets)
    if not len(starts):
        return []
    letter = LETTERS[low]
    same = np.zeros(len(low), bool)  # as the byte before, in the same row
    same[1:] = low[1:] == low[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(low))]
    same[inner] = False
    odd = SIGNS[low] | euro | (letter & same)
    flagged = np.add.reduceat(odd.astype(np.int32), starts) > 0
    # A token's sum reaches to the next start; what is between is no token, so it holds neither flag.
    has_letter = np.add.reduceat(letter.astype(np.int32), starts) > 0
    out = [(int(a), int(b)) for a, b in zip(starts[flagged & has_letter], ends[flagged & has_letter], strict=True)]
    single = (ends - starts == 1) & (letter[starts] | SIGNS[low[starts]]) | (ends - starts == 3) & euro[starts]
    line = np.cumsum(low == 10)[starts]
    row = np.searchsorted(offsets, starts, "right") - 1
    chain = np.zeros(len(starts), bool)
    chain[1:] = single[1:] & single[:-1] & (line[1:] == line[:-1]) & (row[1:] == row[:-1])
    for a, b in zip(*runs(chain, np.array([0, len(chain)])), strict=True):
        if b - a >= 2 and has_letter[a - 1 : b].any():
            out.append((int(starts[a - 1]), int(ends[b - 1])))
    return out


class Restorer:
    """Restored words of suspicious spans, remembered by span."""

    def __init__(self, model: np.ndarray, most: int = 200_000):
        self.model, self.most, self.known = model, most, {}

    def __call__(self, raw: bytes) -> str:
        found = self.known.get(raw)
        if found is None:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[raw] = found = decode(raw.decode(errors="replace"), self.model)
        return found


def evidence(data: np.ndarray, offsets: np.ndarray, restore: Restorer) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """Hashes of all words, of their first four and five bytes, the words' rows; and (row, start, stop, restored)."""
    low = LOWER[data]
    spans = []
    for a, b in suspicious(low, offsets):
        row = int(np.searchsorted(offsets, a, "right") - 1)
        raw = low[a:b].tobytes()
        text = restore(raw)
        if text.encode() != raw:
            spans.append((row, a - int(offsets[row]), b - int(offsets[row]), text))
    more = pa.array([s[3] for s in spans], pa.string())
    parts = [(low, offsets, None), (*utf8(more), np.array([s[0] for s in spans], np.int64))]
    words, four, five, rows = [], [], [], []
    for raw, at, of in parts:
        starts, ends = runs(WORD[raw], at)
        sums = byte_prefix(raw)
        words.append(span_hash(sums, starts, ends))
        for n, out in ((4, four), (5, five)):
            stop = np.minimum(starts + n, ends)
            h = span_hash(sums, starts, stop)
            h[ends - starts <= n] = 0  # no head of its own
            out.append(h)
        own = np.searchsorted(at, starts, "right") - 1
        rows.append(own if of is None else of[own])
    return *(np.concatenate(x) for x in (words, four, five, rows)), spans


def _gather(model: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    restore = Restorer(model)
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i in range(batch.num_rows):
            words, four, five, _, _ = evidence(data[offsets[i] : offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]), restore)
            words, first = np.unique(words, return_index=True)
            yield pa.RecordBatch.from_arrays([batch.column(0)[i : i + 1], batch.column(2)[i : i + 1], *(pa.array([x.tobytes()], pa.binary()) for x in (words, four[first], five[first]))], names=["doc_id", "y", "words", "heads4", "heads5"])


class WordModel:
    """Evidence of words and heads, and the curve from a document's two strongest to a probability."""

    def __init__(self, rows: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], counts: dict[int, int]):
        self.tables, self.beta = [], np.zeros(2)
        self.offset = float(np.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 1)))
        y = np.array([r[0] for r in rows], np.int64)
        n = np.bincount(y, minlength=2) if len(y) else np.zeros(2)
        if not n.all():
            return
        strongest = [np.full(len(r[1]), -9.0) for r in rows]
        for kind in (1, 2, 3):
            each = [np.unique(r[kind]) for r in rows]
            each = [x[x != 0] for x in each]
            keys, at = np.unique(np.concatenate(each), return_inverse=True)
            of = np.repeat(y, [len(x) for x in each])
            c1, c0 = np.bincount(at[of == 1], minlength=len(keys)), np.bincount(at[of == 0], minlength=len(keys))
            value = self._value(c1, c0, n)
            strong = (c1 >= 2) & (value > 0.5)
            self.tables.append((keys[strong], value[strong].astype(np.float32)))
            for r, best in zip(rows, strongest, strict=True):  # as if the document itself had not been counted
                k = np.minimum(np.searchsorted(keys, r[kind]), len(keys) - 1)
                a, b = c1[k] - (r[0] == 1), c0[k] - (r[0] == 0)
                own = self._value(a, b, n - np.eye(2, dtype=int)[r[0]])
                np.maximum(best, np.where((r[kind] != 0) & (a >= 2) & (own > 0.5), own, 0.0), out=best)
        x = np.array([np.sort(np.append(best, [0.0, 0.0]))[-2:][::-1] for best in strongest])
        weight = np.where(y == 1, counts[1] / n[1], counts[0] / n[0])
        beta, self.offset = fit_scale(x, y, weight * len(y) / weight.sum())
        self.beta = np.maximum(beta, 0)

    @staticmethod
    def _value(c1, c0, n):
        c1, c0 = np.maximum(c1, 0), np.maximum(c0, 0)
        return np.log((c1 + 0.5) / (n[1] + 1)) - np.log((c0 + 0.5) / (n[0] + 1))

    def score(self, hashes: tuple[np.ndarray, ...], rows: np.ndarray, n: int) -> np.ndarray:
        best = np.zeros(len(rows), np.float32)
        for (keys, value), own in zip(self.tables, hashes, strict=False):
            if len(keys):
                k = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                np.maximum(best, np.where(keys[k] == own, value[k], 0), out=best)
        at = np.flatnonzero(best)
        # two strongest distinct words of each row
        at = at[np.unique(np.stack([rows[at].astype(np.uint64), hashes[0][at]], 1), axis=0, return_index=True)[1]] if len(at) else at
        at = at[np.lexsort((-best[at], rows[at]))]
        r = rows[at]
        first = np.ones(len(at), bool)
        first[1:] = r[1:] != r[:-1]
        x = np.zeros((n, 2))
        x[r[first], 0] = best[at[first]]
        second = np.flatnonzero(first) + 1
        second = second[second < len(at)]
        second = second[~first[second]]
        x[r[second], 1] = best[at[second]]
        return _sigmoid(x @ self.beta + self.offset)


def _score(state: dict, model: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scorer = WordModel([], {})
    scorer.__dict__.update(state)
    restore = Restorer(model)
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("text", pa.string())])
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in row_slices(offsets):
            *hashes, rows, spans = evidence(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], restore)
            restored: list[list] = [[] for _ in range(j - i)]
            for row, a, b, text in spans:
                restored[row].append({"start": a, "stop": b, "text": text})
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(scorer.score(tuple(hashes), rows, j - i)), pa.array(restored, pa.list_(span))], names=["doc_id", "score", "restored"])


def fit(docs: DataFrame, labels: DataFrame, label: str, per_class: int):
    """The language model of all texts and the word model of the labelled sample, both broadcast; both have a fixed or
    bounded size."""
    context = docs.sparkSession.sparkContext
    model = context.broadcast(language_model(docs))
    few, counts = sample(docs, labels, label, per_class)
    found = few.select("doc_id", "text", "y").mapInArrow(lambda batches: _gather(model.value, batches), EVIDENCE).collect()  # 2 * per_class rows
    found.sort(key=lambda r: (r["doc_id"], bytes(r["words"])))
    rows = [(r["y"], *(np.frombuffer(r[c], np.uint64) for c in ("words", "heads4", "heads5"))) for r in found]
    return model, context.broadcast(WordModel(rows, counts).__dict__)


def score_toxicity(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", per_class: int = 2000) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): held_out, score (the probability of label 1), restored spans."""
    model, scorer = fit(docs, labels, label, per_class)
    schema = "doc_id long, score double, restored array<struct<start:long,stop:long,text:string>>"
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda batches: _score(scorer.value, model.value, batches), schema)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "restored")


def _keep(state: dict, model: np.ndarray, text: int, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [x.column(1) for x in _score(state, model, iter([pa.RecordBatch.from_arrays([batch.column(text)] * 2, names=["doc_id", "text"])]))]
        yield batch.filter(pa.array(np.concatenate(scores) < threshold)) if scores else batch


def drop_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, label: str = "toxic", per_class: int = 2000) -> DataFrame:
    """The rows of ``docs``, as they are, that score below ``threshold``."""
    model, scorer = fit(docs, labels, label, per_class)
    at = docs.columns.index("text")
    return docs.mapInArrow(lambda batches: _keep(scorer.value, model.value, at, threshold, batches), docs.schema)
