"""Harmonic packing of tokenised documents into sequences of fixed capacity.

A document's ids are cut into pieces of sizes ``capacity // k``; a class k holds pieces that fit k to a bin, so a
bin is full after exactly k pieces whatever they are, and workers number their pieces without seeing each other's.
Cutting goes greedily through the reciprocal sizes until at most ``capacity // 16`` ids are left; the rest goes to
the tightest class. Only the last bin of each class can be incomplete: those few pieces (fewer than the sum of all k,
whatever the input) are packed first-fit in one small group.

Null text is empty (one end-of-document id). Repeated rows are packed as documents of their own. Other columns are
ignored.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import cut, row_slices, utf8

CAPACITY = 4096
CUT_CLASSES = tuple(range(1, 17))
REST_CLASSES = tuple([*range(16, 33), *range(36, 65, 4), *range(72, 129, 8), 144, 160, 192, 224, 256])
#: Distinct words whose ids a worker keeps; then it starts anew.
CACHE_WORDS = 400_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, k int, part int, idx long"


#: Characters whose lower case, composition and class are plain: ASCII, and the letters of Latin-1.
UNUSUAL = re.compile("[^\\x00-\\x7fÀ-ÖØ-öø-ÿ]")
#: The tokenizer's own split, over lower-cased texts of these characters.
WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \\t\\n\\x0b\\x0c\\ra-z0-9ß-öø-ÿ]+")
BLANKS = re.compile("[^ \\t\\n\\x0b\\x0c\\r]+")


class WordIds(dict):
    """Code of each word seen, and the ids of each code. Words are what the tokenizer itself splits texts into, so each
    has its own ids; in texts with unusual characters or the strings of special tokens they are what stands between blanks, marked by a newline.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.fresh = Tokenizer.from_file(path), []
        self.first, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    @staticmethod
    def split(text: str) -> list[str]:
        return ["\n" + w for w in BLANKS.findall(text)] if "<|" in text or UNUSUAL.search(text) else WORDS.findall(text.lower())

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        self.fresh.append(word)
        return code

    def learn(self) -> None:
        """Encode the words not seen before, many in one text with blanks between."""
        sizes, ids = [], []
        for i in range(0, len(self.fresh), 2000):
            some = self.fresh[i : i + 2000]
            if any(w[0] == "\n" for w in some):
                found = [self.tokenizer.encode(w.removeprefix("\n"), add_special_tokens=False).ids for w in some]
                sizes.append(np.array([len(x) for x in found], np.int64))
                ids += [np.array(x, np.uint32) for x in found]
            else:
                found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
                sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)))
                ids.append(np.array(found.ids, np.uint32))
        if sizes:
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate(sizes))])
            self.ids = np.concatenate([self.ids, *ids])
            self.fresh = []


def _known(path: str) -> WordIds:
    """What this worker process has learned of the tokenizer, in this task or before."""
    kept = sys.modules.setdefault("_word_ids_kept", types.ModuleType("_word_ids_kept")).__dict__
    if path not in kept or len(kept[path]) > CACHE_WORDS:
        kept[path] = WordIds(path)
    return kept[path]


def _plan(n: int, capacity: int) -> list[tuple[int, int, int]]:
    """(start, length, class) of the pieces of ``n`` ids."""
    out, start, k = [], 0, 1
    while n - start > capacity // CUT_CLASSES[-1]:
        while capacity // k > n - start:
            k += 1
        out.append((start, capacity // k, k))
        start += capacity // k
    if start < n:
        left = n - start
        out.append((start, left, max(k for k in REST_CLASSES if capacity // k >= left)))
    return out


def _pieces(path: str, end_id: int, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, count = TaskContext.get().partitionId(), {}
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        ids_col = batch.column(0)
        for i, j in row_slices(offsets):
            vocab = _known(path)
            raw = data[offsets[i] : offsets[j]].tobytes()
            words, n_words = [], np.zeros(j - i, np.int64)
            for d in range(i, j):
                own = vocab.split(raw[offsets[d] - offsets[i] : offsets[d + 1] - offsets[i]].decode())
                n_words[d - i] = len(own)
                words += own
            codes = np.fromiter(map(vocab.__getitem__, words), np.int64, len(words))
            vocab.learn()
            sizes = vocab.first[codes + 1] - vocab.first[codes]
            total = np.concatenate([[0], np.cumsum(sizes)])
            flat = vocab.ids[np.repeat(vocab.first[codes] - total[:-1], sizes) + np.arange(total[-1])]
            bounds = total[np.concatenate([[0], np.cumsum(n_words)])]
            rows = {c: [] for c in ("row", "start", "length", "crc", "tokens", "k", "idx")}
            for d in range(j - i):
                ids = np.append(flat[bounds[d] : bounds[d + 1]], np.uint32(end_id)).astype("<u4")
                for start, length, k in _plan(len(ids), capacity):
                    at = count[k] = count.get(k, -1) + 1
                    for c, v in zip(rows, (d + i, start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids), k, at), strict=True):
                        rows[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [ids_col.take(pa.array(rows["row"])), *(pa.array(rows[c], pa.int64()) for c in ("start", "length", "crc", "tokens")), pa.array(rows["k"], pa.int32()), pa.array([part] * len(rows["k"]), pa.int32()), pa.array(rows["idx"], pa.int64())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "k", "part", "idx"],
            )


def _first_fit(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Bins for the pieces of incomplete bins: longest first, each into the first bin with room."""
    rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32", "part", "idx"], ascending=[False, True, True, True, True, True], kind="stable")
    room, bins, slots, held = [], [], [], []
    for n in rows["length"]:
        b = next((b for b, free in enumerate(room) if free >= n), None)
        if b is None:
            b = len(room)
            room.append(capacity)
            held.append(0)
        room[b] -= n
        bins.append(b)
        slots.append(held[b])
        held[b] += 1
    return rows.assign(sequence_id=rows["base"] + pd.Series(bins, index=rows.index, dtype="int64"), slot=pd.Series(slots, index=rows.index, dtype="int64"))


def pack(docs: DataFrame, *, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = cut(source.mapInArrow(lambda batches: _pieces(tokenizer_path, end_id, capacity, batches), PIECES), "pieces")
    # Rows of this table: partitions times classes. Each class's pieces are numbered through all partitions.
    counts = pieces.groupBy("k", "part").agg((F.max("idx") + 1).alias("n"))
    before = F.sum("n").over(Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    counts = counts.select("k", "part", before.alias("before"))
    totals = pieces.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("bins", F.expr("n div k"))
    totals = totals.withColumn("g", F.lit(0))
    by_k = Window.partitionBy("g").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy("g")
    totals = totals.select("k", "bins", (F.sum("bins").over(by_k) - F.col("bins")).alias("first"), F.sum("bins").over(every).alias("base"))
    placed = pieces.join(counts, ["k", "part"]).join(F.broadcast(totals), "k")  # totals: one row per class
    placed = placed.withColumn("rank", F.col("before") + F.col("idx")).withColumn("bin", F.expr("rank div k"))
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"]
    full = placed.where("bin < bins").select("*", (F.col("first") + F.col("bin")).alias("sequence_id"), F.expr("rank % k").alias("slot")).select(*keep)
    rest = placed.where("bin >= bins").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "idx", "base", F.lit(0).alias("g"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, idx long, base long, g int, sequence_id long, slot long"
    rest = rest.groupBy("g").applyInPandas(lambda rows: _first_fit(rows, capacity), schema).select(*keep)
    order = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = full.unionByName(rest).withColumn("offset", F.sum("length").over(order) - F.col("length"))
    return out.drop("slot")
