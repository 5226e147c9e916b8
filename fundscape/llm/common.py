"""What several operators share: cutting lineage in the shared folder, and reading text columns as byte arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step handles at once; longer single texts are handled whole.
SLICE_BYTES = 1 << 21


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; a temporary one only where Spark runs in this process alone."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_parts(spark: SparkSession, make: Callable[[int], DataFrame], parts: int, name: str) -> DataFrame:
    """``make(0)``, ``make(1)`` ... as one table, each written before the next is made: what one shuffles is gone by then."""
    path = shared_dir(spark, name)
    for i in range(parts):
        part = make(i)
        part.write.mode("append").parquet(path)
    return spark.read.schema(part.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete the folders of tables that ``cut`` wrote. Only once all that reads them has itself been written."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column end to end, and where each row's begin (one more at the end). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def row_slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes each, at least one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that do not cross a row's border."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    inner = offsets[(offsets > 0) & (offsets < len(mask))]
    first[inner] = mask[inner]
    last[inner - 1] = mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def byte_table(allowed: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(allowed)] = True
    return table


#: A-Z to a-z, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_MULT), -1, 1 << 64))
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(0)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length() if n > 1 else 1)
        up, down = np.full(size, _MULT), np.full(size, _INV)
        up[0] = down[0] = np.uint64(1)
        _POWERS[0] = have = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of 64-bit values times powers of a constant, for ``span_hash``; one more entry than values."""
    up, _ = _powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans of values behind ``prefix``; equal spans have equal hashes wherever they stand."""
    _, down = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def byte_prefix(data: np.ndarray) -> np.ndarray:
    return prefix(_BYTE[data])
