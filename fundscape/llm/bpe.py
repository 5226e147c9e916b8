"""Byte-level BPE encoding and decoding of whole texts, however long, with a rank file's own split pattern.

A text of more than ``chunk`` bytes is cut into chunks of ``chunk`` characters, each with the first ``overlap`` characters
of the next, and the chunks are dealt to all workers:

1. each chunk is split by the pattern on its own and reports where matches begin in its first and last ``overlap``
   characters. A chunk that starts inside a match soon falls into step: splitting goes from left to right and looks a few
   characters ahead at most, so from the first boundary that two neighbours have in common all further ones are the same.
   Matches that end within ``LOOK`` characters of a chunk's end are not believed, as more text could change them.
2. A window over a text's chunks takes that first common boundary as the border of the two (two small arrays a chunk; no
   text moves).
3. Each worker encodes its chunk from border to border. A text's ids are put together in order.

Where two chunks have no boundary in common (a match longer than the overlap) the text is put together again and encoded
in one piece: exact, and as rare as such matches. Shorter texts are one chunk, so nothing is to be stitched.

Ids are little-endian unsigned 32-bit integers end to end in a binary column. Decoding looks every id's bytes up in one
array and concatenates them. It does not depend on how texts were cut: encoded texts always come back.

Null and empty texts have no ids. Very long texts are taken whole. Repeated rows and rows with the same or a null doc_id are
encoded each by itself. An empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import cut, utf8

#: Bytes of a text that is one chunk; characters of a chunk of a longer one, and those it shares with the next.
CHUNK, OVERLAP = 1 << 15, 256
#: Characters beyond its end that a match can depend on.
LOOK = 3


class Codec:
    """A rank file: its encoding, and the bytes of each id."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(pattern)
        self.sizes = np.full(max(ranks.values(), default=-1) + 1, -1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        held = np.maximum(self.sizes, 0)
        self.first = np.cumsum(held) - held
        self.bytes = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)

    def encode(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)

    def encode_matches(self, text: str) -> np.ndarray:
        """The same, match by match: for texts with matches of any length, for which the pattern runs out of stack otherwise."""
        ids = [i for m in self.split.finditer(text) for i in self.encoding._encode_single_piece(m.group())]
        return np.array(ids, "<u4")

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids end to end, and where each id's begin (one more at the end)."""
        if len(ids) and (int(ids.max()) >= len(self.sizes) or (self.sizes[ids] < 0).any()):
            raise ValueError("an id that the rank file does not have")
        sizes = self.sizes[ids]
        at = np.concatenate([[0], np.cumsum(sizes)])
        return self.bytes[np.repeat(self.first[ids] - at[:-1], sizes) + np.arange(at[-1])], at


def codec(path: str, pattern: str) -> Codec:
    """One for each worker process and file."""
    kept = sys.modules.setdefault("_codecs_kept", types.ModuleType("_codecs_kept")).__dict__
    if (path, pattern) not in kept:
        kept[path, pattern] = Codec(path, pattern)
    return kept[path, pattern]


def _encoded(path: str, pattern: str, by_match: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last two columns (text, from: characters to skip at its start, to: where to end, or null) become n_tokens and ids."""
    one = codec(path, pattern)
    encode = one.encode_matches if by_match else one.encode
    for batch in batches:
        *keys, text, start, stop = batch.columns
        ids = [encode((t.as_py() or "")[a:b]) for t, a, b in zip(text, start.to_pylist(), stop.to_pylist(), strict=True)]
        n = np.array([len(x) for x in ids], np.int64)
        out = [*keys, pa.array(n), pa.array([x.tobytes() for x in ids], pa.binary())]
        yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names[:-3], "n_tokens", "ids"])


def _chunks(chunk: int, overlap: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of long texts; ``part`` and ``at`` tell the row."""
    part, at = TaskContext.get().partitionId(), 0
    names = ["doc_id", "part", "at", "no", "text"]
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            text, no = text.as_py(), 0
            while no * chunk < len(text) or no == 0:
                some = [text[k * chunk : (k + 1) * chunk + overlap] for k in range(no, no + 256) if k * chunk < len(text)]
                same = lambda v, kind: pa.array([v] * len(some), kind)  # noqa: B023, E731
                columns = [same(doc_id.as_py(), pa.int64()), same(part, pa.int32()), same(at, pa.int64()), pa.array(range(no, no + len(some)), pa.int32()), pa.array(some, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                no += len(some)
            at += 1


def _borders(path: str, pattern: str, chunk: int, overlap: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, at, no, head, tail): where matches begin in the first and the last ``overlap`` characters, from the text's start."""
    split = codec(path, pattern).split
    for batch in batches:
        part, at, no, text = batch.columns
        head, tail = [], []
        for k, t in zip(no.to_pylist(), text, strict=True):
            t = t.as_py()
            starts = np.fromiter((m.end() for m in split.finditer(t)), np.int64)
            starts = starts[starts <= len(t) - LOOK]
            head.append((starts[starts <= overlap] + k * chunk).tolist())
            tail.append((starts[starts >= chunk] + k * chunk).tolist())
        arrays = [pa.array(x, pa.list_(pa.int64())) for x in (head, tail)]
        yield pa.RecordBatch.from_arrays([part, at, no, *arrays], names=["part", "at", "no", "head", "tail"])


def encode(docs: DataFrame, *, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row of ``docs`` (doc_id, text)."""
    if not LOOK < overlap <= chunk:
        raise ValueError("overlap must be more than a match looks ahead, and not more than a chunk")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "n_tokens long, ids binary"
    whole = [F.lit(0).alias("start"), F.lit(None).cast("int").alias("stop")]
    plain = lambda batches: _encoded(ranks_path, pattern, False, batches)
    short = source.where(F.octet_length("text") <= chunk).select("*", *whole).mapInArrow(plain, f"doc_id long, {schema}")

    row = ["part", "at", "no"]
    long = source.where(F.octet_length("text") > chunk).mapInArrow(lambda batches: _chunks(chunk, overlap, batches), "doc_id long, part int, at long, no int, text string")
    long = cut(long.repartition(*row), "chunks")
    borders = long.select(*row, "text").mapInArrow(lambda batches: _borders(ranks_path, pattern, chunk, overlap, batches), "part int, at long, no int, head array<long>, tail array<long>")
    text = Window.partitionBy("part", "at")
    common = F.array_min(F.array_intersect("head", F.lag("tail").over(text.orderBy("no"))))
    borders = borders.select(*row, F.when(F.col("no") == 0, F.lit(0)).otherwise(common).alias("start"))
    borders = borders.select(*row, "start", F.lead("start").over(text.orderBy("no")).alias("stop"), F.max(F.col("start").isNull()).over(text).alias("apart"))
    borders = cut(borders, "borders")
    begin = F.col("no").cast("long") * chunk
    found = long.join(borders, row)
    pieces = found.where("not apart").select("doc_id", *row, "text", (F.col("start") - begin).alias("start"), (F.col("stop") - begin).alias("stop"))
    pieces = pieces.mapInArrow(plain, f"doc_id long, part int, at long, no int, {schema}")
    own = F.struct("no", F.substring("text", 1, chunk).alias("text"))
    again = found.where("apart").groupBy("doc_id", "part", "at").agg(F.sort_array(F.collect_list(own)).alias("own"))
    again = again.select("doc_id", "part", "at", F.lit(0).alias("no"), F.array_join("own.text", "").alias("text"), *whole)
    again = again.mapInArrow(lambda batches: _encoded(ranks_path, pattern, True, batches), f"doc_id long, part int, at long, no int, {schema}")
    ids = F.expr("listagg(ids) WITHIN GROUP (ORDER BY no)")
    joined = pieces.union(again).groupBy("doc_id", "part", "at").agg(F.sum("n_tokens").alias("n_tokens"), ids.alias("ids"))
    return short.union(joined.select("doc_id", "n_tokens", "ids"))


def _decoded(path: str, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    one = codec(path, pattern)
    for batch in batches:
        data, offsets = utf8(batch.column(batch.num_columns - 1))
        raw, at = one.decode(np.frombuffer(data.tobytes(), "<u4"))
        out = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(at[offsets // 4].tobytes()), pa.py_buffer(raw)])
        yield pa.RecordBatch.from_arrays([*batch.columns, out.cast(pa.binary())], names=[*batch.schema.names, "decoded"])


def decode(encoded: DataFrame, *, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) and the bytes that the ids stand for. Null ids are none; ids that the file lacks raise."""
    rows = encoded.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(lambda batches: _decoded(ranks_path, pattern, batches), "doc_id long, n_tokens long, ids binary, decoded binary")
