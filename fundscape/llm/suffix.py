"""Exact removal of long repeated strings: content-routed run-length indexes.

A byte goes if some string of ``length`` bytes that covers it also starts anywhere else, in the same text or another.
One index of all texts would not fit a cluster's tasks, so strings are first routed to where their repeats must be:

1. One pass over the texts. Every window of ``length`` bytes has an anchor, its 40-byte gram of the smallest hash (the
   last, if several): equal windows have equal anchors. Neighbouring windows with one anchor are a segment, a stretch of
   fewer than twice ``length`` bytes; the pass writes the hashes of its anchor and of its bytes.
2. Segments whose anchor occurs once hold no repeat. Segments equal to another are repeated whole. What is left are
   different segments of one anchor, at the borders of repeated passages; each distinct one's bytes are fetched.
3. Anchors are dealt out; a task takes its segments in batches (all of an anchor in one), builds the suffix array and
   the run-length Burrows-Wheeler transform of a batch, samples the match length with the neighbour suffix at each
   run's ends, and streams these along the text: between sampled positions the length falls by one per byte. That is
   each position's longest match with any other; where it is ``length`` or more, the window is repeated.
4. An anchor with more than ``HOT`` different segments would be too much for one task. These segments are taken as texts
   and routed again, by anchors of 120 bytes and then, if these are hot too, of one byte less than ``length``. Segments of
   such an anchor have two windows at most and differ in one byte at either end, so they are few whatever the input.
5. A document's repeated windows are merged to spans and cut out.

Texts and segments are told apart by 64-bit hashes. Null texts are empty. Rows that share doc_id and text are repeats of
each other, as any rows with equal text are. Other columns are ignored. Kept bytes need not be valid UTF-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import byte_prefix, cut, row_slices, span_hash, utf8

#: Bytes of an anchor, by level; the last level's have a byte less than the windows.
GRAMS = (40, 120)
CHUNK = 1 << 22
#: Bytes of segments in one index, and segments of one anchor from which they are routed again.
INDEX_BYTES, HOT = 1 << 19, 1000
LOW = (1 << 24) - 1
SEGMENT = "doc_id long, text_hash long, anchor long, content long, start long, windows int"


def _anchors(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` grams, the position of its last smallest hash (by 40 bits)."""
    at = np.arange(len(h), dtype=np.uint64)
    low = (h & np.uint64(~LOW & (1 << 64) - 1)) | (np.uint64(LOW) - at)
    step = 1
    while step * 2 <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if width > step:
        low = np.minimum(low[: len(low) - (width - step)], low[width - step :])
    return LOW - (low & np.uint64(LOW)).astype(np.int64)


def _segments(length: int, gram: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = length - gram + 1
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        doc_ids, hashes = batch.column(0), batch.column(1)
        for i, j in row_slices(offsets):
            own = data[offsets[i] : offsets[j]]
            if len(own) < length:
                continue
            bounds = offsets[i : j + 1] - offsets[i]
            sums = byte_prefix(own)
            first = np.arange(len(own) - gram + 1)
            grams = span_hash(sums, first, first + gram)
            anchor = np.concatenate([_anchors(grams[c : c + CHUNK + width - 1], width) + c for c in range(0, len(own) - length + 1, CHUNK)])
            row = np.repeat(np.arange(j - i), np.diff(bounds))
            starts = np.flatnonzero(row[: len(anchor)] == row[length - 1 : length - 1 + len(anchor)])
            if not len(starts):
                continue
            new = np.ones(len(starts), bool)
            new[1:] = (anchor[starts[1:]] != anchor[starts[:-1]]) | (row[starts[1:]] != row[starts[:-1]])
            begin = np.flatnonzero(new)
            windows = np.diff(np.append(begin, len(starts)))
            start = starts[begin]
            of = pa.array(row[start] + i)
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids.take(of),
                    hashes.take(of),
                    pa.array(grams[anchor[start]].view(np.int64)),
                    pa.array(span_hash(sums, start, start + windows + length - 1).view(np.int64)),
                    pa.array(start - bounds[row[start]]),
                    pa.array(windows.astype(np.int32)),
                ],
                names=["doc_id", "text_hash", "anchor", "content", "start", "windows"],
            )


def _fetch(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted segments; column 1 holds structs (anchor, content, start, windows)."""
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        raw, out = memoryview(data), [[], [], [], []]
        for d, wanted in enumerate(batch.column(1).to_pylist()):
            for w in wanted:
                a = int(offsets[d]) + w["start"]
                for c, v in zip(out, (w["anchor"], w["content"], w["windows"], bytes(raw[a : a + w["windows"] + length - 1])), strict=True):
                    c.append(v)
            if len(out[0]) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["anchor", "content", "windows", "bytes"])
                out = [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["anchor", "content", "windows", "bytes"])


class RunIndex:
    """Run-length Burrows-Wheeler transform of texts, each ended by a symbol of its own, with samples at run ends."""

    def __init__(self, texts: list[bytes]):
        self.first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        symbols = np.zeros(self.first[-1], np.int64)
        ends = self.first[1:] - 1
        inside = np.ones(len(symbols), bool)
        inside[ends] = False
        symbols[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + len(texts) + 1
        symbols[ends] = np.arange(1, len(texts) + 1)
        self.ranks = [symbols]  # by the first 1, 2, 4, ... symbols
        rank, step = symbols, 1
        while True:
            high = np.zeros(len(rank), np.int64)
            high[:-step] = rank[step:]
            key = rank * (len(rank) + len(texts) + 300) + high
            order = np.argsort(key, kind="stable")
            new = np.ones(len(key), np.int64)
            new[1:] = key[order[1:]] != key[order[:-1]]
            rank = np.empty(len(key), np.int64)
            rank[order] = np.cumsum(new)
            step *= 2
            self.ranks.append(rank)
            if new.all() or step >= len(key):
                break
        self.suffix = order
        before = symbols[order - 1]  # the transform; position -1 is the last end symbol
        change = np.flatnonzero(before[1:] != before[:-1]) + 1
        self.heads = np.concatenate([[0], change])  # ranks at which runs begin

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of suffixes, by descent through the ranks."""
        a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        n = len(self.suffix)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank, step = self.ranks[level], 1 << level
            same = (a < n) & (b < n)
            same[same] = rank[a[same]] == rank[b[same]]
            total[same] += step
            a, b = np.where(same, a + step, a), np.where(same, b + step, b)
        return total

    def statistics(self) -> np.ndarray:
        """Each position's longest match with another position, streamed from the samples at run ends."""
        n = len(self.suffix)
        best = np.zeros(n, np.int64)
        if n < 2:
            return best
        tails = np.append(self.heads[1:], n) - 1
        for at, other in ((self.heads[self.heads > 0], -1), (tails[tails < n - 1], 1)):
            sample = np.full(n, -1, np.int64)
            here = self.suffix[at]
            sample[here] = self.common(here, self.suffix[at + other])
            # The first (last) suffix of all has no neighbour on that side.
            sample[self.suffix[0 if other < 0 else n - 1]] = 0
            known = np.maximum.accumulate(np.where(sample >= 0, np.arange(n), 0))
            np.maximum(best, np.maximum(sample[known], 0) - (np.arange(n) - known), out=best)
        return best


def _ranges(hit: np.ndarray) -> list[dict]:
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return [{"start": int(a), "stop": int(b)} for a, b in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0), strict=True)]


RANGE = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
REPEATED = "anchor long, content long, ranges array<struct<start:long,stop:long>>"


def _match(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of segments that come sorted by anchor."""
    def work(rows: dict) -> pa.RecordBatch:
        index = RunIndex([t for _, t in rows.values()])
        best, out = index.statistics(), []
        for k, (windows, _) in enumerate(rows.values()):
            out.append(_ranges(best[index.first[k] : index.first[k] + windows] >= length))
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in rows], pa.int64()), pa.array([k[1] for k in rows], pa.int64()), pa.array(out, RANGE)], names=["anchor", "content", "ranges"])

    held, size, last = {}, 0, None
    for batch in batches:
        for anchor, content, windows, text in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            if size >= INDEX_BYTES and anchor != last:
                yield work(held)
                held, size = {}, 0
            if (anchor, content) not in held:
                held[anchor, content] = (windows, text)
                size += len(text)
            last = anchor
    if held:
        yield work(held)


def _cut_out(length: int, keep_bytes: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        raw, out = memoryview(data), [[], [], [], [], []]
        for d, ranges in enumerate(batch.column(2).to_pylist()):
            text = raw[offsets[d] : offsets[d + 1]]
            spans: list[list[int]] = []
            for r in sorted((r["start"], r["stop"]) for r in ranges or ()):
                if spans and r[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], r[1])
                else:
                    spans.append(list(r))
            kept, at = [], 0
            for a, b in spans:
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            whole = b"".join(kept)
            for c, v in zip(out, (len(text), len(text) - len(whole), len(spans), hashlib.sha256(whole).hexdigest(), whole if keep_bytes else None), strict=True):
                c.append(v)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, types, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_spans(docs: DataFrame, *, length: int = 200) -> DataFrame:
    """(doc_id, text_hash, ranges): the byte ranges of each document that lie in repeated strings, written."""
    return _spans(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), length, 0)


def _spans(source: DataFrame, length: int, level: int) -> DataFrame:
    """The repeats among the texts of ``source`` (doc_id, text_hash, text), found by the anchors of a level."""
    last = level >= len(GRAMS) or GRAMS[level] >= length - 1
    gram = length - 1 if last else GRAMS[level]
    source = source.where(F.octet_length("text") >= length)
    segments = cut(source.mapInArrow(lambda batches: _segments(length, gram, batches), SEGMENT), "segments")
    anchors = segments.groupBy("anchor").agg(F.min("content").alias("lo"), F.max("content").alias("hi"), F.count(F.lit(1)).alias("n")).where("n > 1")
    anchors = cut(anchors.select("anchor", (F.col("lo") < F.col("hi")).alias("mixed")), "anchors")
    repeated = cut(segments.join(anchors, "anchor"), "repeated")
    # Distinct segments of the anchors that have several, with one place each to fetch their bytes from.
    kinds = repeated.where("mixed").groupBy("anchor", "content").agg(F.min(F.struct("doc_id", "text_hash", "start", "windows")).alias("at"), F.count(F.lit(1)).alias("n"))
    kinds = cut(kinds.select("anchor", "content", "n", "at.*"), "kinds")
    hot = cut(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).select("anchor", ((F.col("m") > HOT) & F.lit(not last)).alias("hot")), "hot")
    wanted = kinds.groupBy(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).agg(F.collect_list(F.struct("anchor", "content", "start", "windows")).alias("wanted"))
    own = source.join(cut(wanted, "wanted"), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")))
    texts = cut(own.select("text", "wanted").mapInArrow(lambda batches: _fetch(length, batches), "anchor long, content long, windows int, bytes binary"), "texts")
    texts = cut(texts.join(hot, "anchor"), "dealt")
    plain = texts.where("not hot").select("anchor", "content", "windows", "bytes").repartition("anchor").sortWithinPartitions("anchor", "content")
    found = cut(plain.mapInArrow(lambda batches: _match(length, batches), REPEATED), "found")
    many = texts.where("hot")
    if not many.isEmpty():
        many = many.select(F.col("anchor").alias("doc_id"), F.col("content").alias("text_hash"), F.col("bytes").alias("text")).dropDuplicates(["doc_id", "text_hash"])
        windows = F.transform("ranges", lambda r: F.struct(r["start"].alias("start"), (r["stop"] - length + 1).alias("stop")))
        deeper = _spans(cut(many, "again"), length, level + 1)
        found = found.union(deeper.select(F.col("doc_id").alias("anchor"), F.col("text_hash").alias("content"), windows.alias("ranges")))
    parts = cut(found.where(F.size("ranges") > 0), "parts")
    shift = F.transform("ranges", lambda r: F.struct((F.col("start") + r["start"]).alias("start"), (F.col("start") + r["stop"] - 1 + length).alias("stop")))
    whole = F.array(F.struct(F.col("start").alias("start"), (F.col("start") + F.col("windows") - 1 + length).alias("stop")))
    twins = cut(kinds.where("n > 1").select("anchor", "content"), "twins")
    full = repeated.where("not mixed").select("doc_id", "text_hash", whole.alias("ranges"))
    full = full.union(repeated.where("mixed").join(twins, ["anchor", "content"]).select("doc_id", "text_hash", whole.alias("ranges")))
    some = repeated.where("mixed").join(parts, ["anchor", "content"]).select("doc_id", "text_hash", shift.alias("ranges"))
    return cut(full.union(some).groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "ranges")


def remove_repeats(docs: DataFrame, *, length: int = 200, keep_bytes: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranges = repeated_spans(docs, length=length).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "ranges")
    own = docs.withColumn("text_hash", F.xxhash64("text"))
    joined = own.join(ranges, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return joined.select("doc_id", "text", "ranges").mapInArrow(lambda batches: _cut_out(length, keep_bytes, batches), schema)
