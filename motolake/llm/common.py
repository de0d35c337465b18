"""Shared helpers of the training-data operators: scratch tables, folds, byte hashing."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ODD = np.uint64(0x9E3779B97F4A7C15)
MASK = (1 << 64) - 1
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir of the session; a temporary one where it is unset and everything runs in this process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: executors need a folder that they share")
        found = f"file://{tempfile.mkdtemp(prefix='motolake-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of df with a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/motolake/{name}-{uuid.uuid4().hex}"
    # the shuffle files go as soon as the table is written, not when the driver happens to collect its garbage
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, True)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def release(df: DataFrame) -> None:
    """Delete a table of materialize that nothing will read again."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def repeats(docs: DataFrame, id_col: str = "doc_id") -> bool:
    """Whether an id is null or stands in more than one row."""
    return docs.groupBy(id_col).count().filter(F.col(id_col).isNull() | (F.col("count") > 1)).limit(1).count() > 0


def with_row_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """(docs, name of a column of unique ids that are not null): the id, or a number in the order of id (null last) and text, written with docs, where ids are null or repeat."""
    if not repeats(docs, id_col):
        return docs, id_col
    return materialize(docs.orderBy(F.col(id_col).asc_nulls_last(), text_col).withColumn("row_id", F.monotonically_increasing_id()), "row-ids"), "row_id"


def held_out(id_col, folds: int = 5):
    """True for ids whose crc32 as text is divisible by folds; ids that are null count as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(True))


def wanted_parts(rows: int, per_part: int) -> int:
    return max(1, -(-int(rows) // per_part))


def dealt(rows: DataFrame, parts: int, part: str = "part") -> DataFrame:
    """rows with every number 0 .. parts - 1 of a column in a partition of its own: groups by it need no other exchange, and a task's share doesn't grow with the input, whatever the session's number of shuffle partitions."""
    return rows.repartitionById(parts, F.col(part))


# ---------------------------------------------------------------- memory of Python workers
_caches: dict[str, Callable[[], None]] = {}


def cache(owner: str, clear: Callable[[], None]) -> None:
    """Name what frees a module's cache in a worker process."""
    _caches[owner] = clear


def begin(owner: str) -> None:
    """At the start of a task: a worker serves many operators, so free the other ones' caches and give unused memory back."""
    import ctypes

    import pyarrow as pa

    for name, clear in _caches.items():
        if name != owner:
            clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Whole texts make Arrow batches of 10000 rows, the default, too large for small executors; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


# ---------------------------------------------------------------- hashing
def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class PrefixHash:
    """Polynomial hash modulo 2**64 of any slice of a byte buffer, from prefix sums of random byte codes."""

    _codes = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    _base = 0x5851F42D4C957F2D
    _inverse = pow(_base, -1, 1 << 64)
    _powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._powers[0]) <= n:
            size = 1 << int(n).bit_length()
            out = []
            for base in (cls._base, cls._inverse):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                out.append(np.multiply.accumulate(p))
            cls._powers = (out[0], out[1])
        return cls._powers

    def __init__(self, data: np.ndarray):
        n = len(data)
        up, _ = self.powers(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self._codes[data] * up[:n], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end]; the length takes part."""
        _, down = self.powers(len(self.sums) - 1)
        h = (self.sums[end] - self.sums[start]) * down[start]
        return mix64(h + (end - start).astype(np.uint64) * ODD)


def utf8(values) -> list[bytes]:
    """UTF-8 of a string column of an Arrow batch; null gives no bytes."""
    import pyarrow as pa

    column = values.cast(pa.large_binary()) if not pa.types.is_large_binary(values.type) else values
    return [x or b"" for x in column.to_pylist()]


def joined(values) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column one after another, and the n + 1 offsets of its rows; null gives no bytes."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(values, "") if values.null_count else values
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def segmented_arange(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after another."""
    total = int(counts.sum())
    starts = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(starts, counts)


