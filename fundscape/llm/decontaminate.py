"""Benchmark decontamination: find windows of benchmark words in training texts.

Words are runs of digits, ASCII letters (lower-cased) and all non-ASCII characters. Every run of ``window`` words of
a benchmark item is a window; an item with fewer words is one window itself. A word of a document is hit where it
lies inside an occurrence of a window.

The windows' hashes go to the executors as one broadcast set, if the benchmark's text is at most ``broadcast_bytes``
(checked first); hits on a hash are verified on the words themselves. A larger benchmark is joined by a shuffle on
the windows' text. Rows are not moved in the first case, so skew in the documents does not matter.

Null or wordless texts have no words and no hits; repeated rows give repeated results; other columns are ignored.
Null or wordless items have no windows. An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import LOWER, cut, byte_prefix, byte_table, prefix, row_slices, runs, span_hash, utf8

WORD = byte_table(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER_AZ, LOWER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OUT = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,stop:long>>, text_hash long"


class WindowSet:
    """The windows of all items: by length in words, sorted hashes and where their words are."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.items = [i for i, _ in items]
        self.words: list[list[bytes]] = []
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k, (_, text) in enumerate(items):
            data, offsets = utf8(pa.array([text], pa.string()))
            low = LOWER[data]
            starts, ends = runs(WORD[low], offsets)
            raw = low.tobytes()
            self.words.append([raw[a:b] for a, b in zip(starts, ends, strict=True)])
            if not len(starts):
                continue
            n = min(window, len(starts))
            sums = prefix(span_hash(byte_prefix(low), starts, ends))
            first = np.arange(len(starts) - n + 1)
            hashes = span_hash(sums, first, first + n)
            found.setdefault(n, []).extend(zip(hashes.tolist(), [k] * len(first), first.tolist(), strict=True))
        self.by_length = {}
        for n, entries in found.items():
            entries.sort()
            hashes = np.array([e[0] for e in entries], np.uint64)
            seen = np.zeros(1 << 16, bool)
            seen[(hashes >> np.uint64(48)).astype(np.int64)] = True
            self.by_length[n] = (hashes, [e[1:] for e in entries], seen)

    def hits(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, doc_of: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first word, length in words, item) of each verified occurrence."""
        sums = prefix(hashes)
        for n, (known, where, seen) in self.by_length.items():
            if len(starts) < n:
                continue
            first = np.arange(len(starts) - n + 1)
            first = first[doc_of[first] == doc_of[first + n - 1]]
            own = span_hash(sums, first, first + n)
            maybe = np.flatnonzero(seen[(own >> np.uint64(48)).astype(np.int64)])
            at = np.searchsorted(known, own[maybe])
            good = at < len(known)
            good[good] = known[at[good]] == own[maybe[good]]
            for i, j in zip(maybe[good].tolist(), at[good].tolist(), strict=True):
                w = int(first[i])
                words = [low[a:b].tobytes() for a, b in zip(starts[w : w + n], ends[w : w + n], strict=True)]
                while j < len(known) and known[j] == own[i]:
                    item, p = where[j]
                    if self.words[item][p : p + n] == words:
                        yield w, n, item
                    j += 1


def _scan(state: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    windows = WindowSet([], 1)
    windows.__dict__.update(state)
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in row_slices(offsets):
            low = LOWER[data[offsets[i] : offsets[j]]]
            own = offsets[i : j + 1] - offsets[i]
            starts, ends = runs(WORD[low], own)
            doc_of = np.searchsorted(own, starts, "right") - 1
            n_words = np.bincount(doc_of, minlength=j - i)
            hashes = span_hash(byte_prefix(low), starts, ends)
            cover = np.zeros(len(starts) + 1, np.int64)
            items: dict[int, set[str]] = {}
            for w, n, item in windows.hits(low, starts, ends, hashes, doc_of):
                cover[w] += 1
                cover[w + n] -= 1
                items.setdefault(int(doc_of[w]), set()).add(windows.items[item])
            hit = np.cumsum(cover[:-1]) > 0
            n_hit = np.bincount(doc_of[hit], minlength=j - i)
            spans: dict[int, list] = {}
            if len(hit) and hit.any():
                # word runs that are hit, as byte ranges of the document
                word_docs = np.searchsorted(doc_of, np.arange(j - i + 1))
                for a, b in zip(*runs(hit, word_docs), strict=True):
                    d = int(doc_of[a])
                    spans.setdefault(d, []).append({"start": int(starts[a] - own[d]), "stop": int(ends[b - 1] - own[d])})
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[i:j],
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array([sorted(x for x in items.get(d, ()) if x is not None) for d in range(j - i)], pa.list_(pa.string())),
                    pa.array([spans.get(d, []) for d in range(j - i)], pa.list_(span)),
                    batch.column(2)[i:j],
                ],
                names=["doc_id", "n_words", "n_hit", "items", "spans", "text_hash"],
            )


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hit word positions to byte ranges of their texts."""
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    for batch in batches:
        data, offsets = utf8(batch.column(4))
        found = []
        for i, words in enumerate(batch.column(5)):
            whole = np.array([0, offsets[i + 1] - offsets[i]])
            starts, ends = runs(WORD[LOWER[data[offsets[i] : offsets[i + 1]]]], whole)
            hit = np.zeros(len(starts), bool)
            hit[np.array(words.as_py(), np.int64)] = True
            found.append([{"start": int(starts[a]), "stop": int(ends[b - 1])} for a, b in zip(*runs(hit, np.array([0, len(hit)])), strict=True)])
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.list_(span)), batch.column(6)], names=["doc_id", "n_words", "n_hit", "items", "spans", "text_hash"])


def _joined(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """The way for a benchmark beyond the broadcast bound: windows as text, joined by a shuffle."""
    def words(c):
        return F.regexp_extract_all(F.translate(F.coalesce(c, F.lit("")), UPPER_AZ, LOWER_AZ), F.lit(f"({WORD_PATTERN})"), F.lit(1))

    def windows(n):
        return F.transform(F.sequence(F.lit(0), F.size("w") - n), lambda i: F.struct(i.alias("at"), F.array_join(F.slice("w", i + 1, n), " ").alias("key")))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    keys = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    keys = keys.withColumn("n", F.least(F.lit(window), F.size("w")))
    keys = keys.select("item", "n", F.explode(windows(F.col("n"))).alias("x")).select("item", "n", F.col("x.key").alias("key")).distinct()
    lengths = F.transform(F.sequence(F.lit(1), F.lit(window)), lambda n: n)
    own = rows.select("row", "w", F.explode(lengths).alias("n")).where(F.col("n") <= F.size("w"))
    own = own.join(F.broadcast(keys.select("n").distinct()), "n", "left_semi")  # at most ``window`` rows
    own = own.select("row", "n", F.explode(windows(F.col("n"))).alias("x")).select("row", "n", F.col("x.at").alias("at"), F.col("x.key").alias("key"))
    hits = own.join(keys, ["n", "key"]).select("row", "item", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("word"))
    hits = hits.groupBy("row").agg(F.collect_set("word").alias("words"), F.sort_array(F.collect_set("item")).alias("items"))
    full = rows.join(hits, "row", "left").select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.coalesce(F.size("words"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.when(F.col("words").isNotNull(), F.col("text")).alias("text"), F.coalesce("words", F.array().cast("array<int>")).alias("words"), "text_hash",
    )
    return full.mapInArrow(_spans, OUT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, broadcast_bytes: int = 8 << 20) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_hit, the sorted ids of the items with occurring windows
    and the hit byte ranges, and the hash of the text. ``benchmark``: (item_id, text); an item without id hits words, but is not named.
    """
    size = benchmark.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    if size > broadcast_bytes:
        return _joined(docs, benchmark, window)
    items = [(None if r["item_id"] is None else str(r["item_id"]), r["text"]) for r in benchmark.where("text is not null").select("item_id", "text").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(WindowSet(items, window).__dict__)  # plain data
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(lambda batches: _scan(shared.value, batches), OUT)


def verdicts(found: DataFrame, *, one_in: int = 20) -> DataFrame:
    """Add ``contaminated``: hit at all, and in at least one word of ``one_in``."""
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))


def remove_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the hit byte ranges of ``found`` cut out of their texts. Rows are told apart by (doc_id, text), null ids
    included: ``found`` is what ``decontaminate`` gives for ``docs``; rows that share both have the same ranges."""
    def kept(text, spans):
        edges = F.concat(F.array(F.lit(0)), F.flatten(F.transform(spans, lambda s: F.array(s["start"].cast("int"), s["stop"].cast("int")))), F.array(F.octet_length(text)))
        raw, last = text.cast("binary"), (F.size(edges) / 2 - 1).cast("int")
        part = lambda i: F.substring(raw, F.get(edges, i * 2) + 1, F.get(edges, i * 2 + 1) - F.get(edges, i * 2))
        return F.aggregate(F.transform(F.sequence(F.lit(0), last), part), F.lit(b""), lambda a, b: F.concat(a, b)).cast("string")

    hit = found.where("n_hit > 0").groupBy("doc_id", "text_hash").agg(F.first("spans").alias("spans"))
    joined = docs.join(hit, docs["doc_id"].cast("long").eqNullSafe(hit["doc_id"]) & (F.xxhash64(docs["text"]) == hit["text_hash"]), "left")
    text, spans = docs["text"], hit["spans"]
    return joined.select(*[F.when(spans.isNotNull(), kept(text, spans)).otherwise(text).alias("text") if c == "text" else docs[c] for c in docs.columns])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, one_in: int = 20) -> DataFrame:
    """The rows of ``docs``, as they are, that are not contaminated; rows are told apart by (doc_id, text)."""
    mark = F.xxhash64(docs["text"])
    numbered = docs.select(mark.alias("doc_id"), "text")
    bad = cut(verdicts(decontaminate(numbered, benchmark, window=window), one_in=one_in).where("contaminated").select("doc_id").distinct(), "bad")
    return docs.join(bad, mark == bad["doc_id"], "left_anti")
