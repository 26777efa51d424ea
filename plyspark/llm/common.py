"""Shared helpers of the training-data operators: reading tables, writing
intermediate tables to the shared folder, and vectorised word hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plyspark.session import scratch_path

#: Word separators of every contract: space and \x09-\x0D (all ASCII).
SEPARATORS = b" \t\n\x0b\x0c\r"
WORD_RE = r"[^ \t-\r]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROWS, _BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1024, megabytes: int = 4) -> None:
    """Bound the Arrow batches sent to Python, whose working memory is a
    small multiple of one batch (one row at least, however long)."""
    spark.conf.set(_ROWS, str(rows))
    spark.conf.set(_BYTES, str(megabytes << 20))


_scratch: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Delete the tables staged inside, but for those that are kept."""
    _scratch.append([])
    try:
        yield
    finally:
        for df in _scratch.pop():
            discard(df)


def staged(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    (lost executors recompute nothing before it) and lets Spark delete the
    finished job's shuffle files."""
    spark = df.sparkSession
    path = scratch_path(spark, f"plyspark_llm/{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    written = spark.read.schema(df.schema).parquet(path)
    if _scratch and not keep:
        _scratch[-1].append(written)
    return written


def discard(df: DataFrame) -> None:
    """Delete the files of a ``staged`` table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` also maps other letters, so it is used
    where no other upper-case letter occurs and ``translate`` elsewhere."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    other = text.rlike(r"[\P{ASCII}&&[\p{IsUppercase}\p{Lt}]]")
    return F.when(other, F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def running(df: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` up to and with each row, by ``keys``
    in order of ``(bucket, order)``. One row a bucket is summed by ``keys``;
    rows themselves only meet those of their own bucket."""
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_bucket_sum"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(
        sums.select(*keys, bucket, F.coalesce(F.sum("_bucket_sum").over(earlier), F.lit(0)).alias("_start")), "starts"
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        df.join(starts, [*keys, bucket])
        .withColumn(name, F.col("_start") + F.sum(value).over(inside))
        .drop("_start")
    )


# ---------------------------------------------------------------- flat text
IS_SEPARATOR = np.zeros(256, bool)
IS_SEPARATOR[list(SEPARATORS)] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTE = np.random.default_rng(20240117).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2^64, kept for reuse."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, 1 << 16)
        got = np.full(size, base, np.uint64)
        got[0] = 1
        np.multiply.accumulate(got, out=got)
        _powers[base] = got
    return got[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def flat_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a column as one byte array and each text's offsets
    (``n + 1`` of them); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and the first word of each text
    (``n + 1`` offsets into the words). A text's end also ends its word.
    ``separator`` tells for each byte value whether it separates words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~(IS_SEPARATOR if separator is None else separator)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each word (A-Z lower-cased with ``fold``): a
    polynomial over bytes, read off one running sum of the whole buffer."""
    if not len(start):
        return np.zeros(0, np.uint64)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_FOLD[data] if fold else data] * powers(_BASE, len(data)), out=run[1:])
    return mix((run[end] - run[start]) * powers(_INV, len(data))[start] + (end - start).astype(np.uint64))


def blocks(batches: Iterator[pa.RecordBatch], most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text."""
    for batch in batches:
        step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
