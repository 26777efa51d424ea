"""Packing along a space-filling curve.

A document's token ids are hashed to random vectors whose sum is its position
in a few dimensions; positions become cells of a Hilbert curve, documents are
range-sorted by curve key, and neighbours along the curve fill sequences one
after another. Cuts fall where a sequence is full, so only the last sequence
has padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyspark.llm.common import blocks, flat_bytes, running, shuffle_partitions, small_batches, staged, table
from plyspark.llm.tokens import tokenizer

SEQUENCE = 4096
END_ID = 2
DIMENSIONS, BITS = 4, 10
#: Low bits of the key that spread equal documents over ranges.
TIE_BITS = 20


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of integer cells ``(n, dimensions)``:
    undo the curve's rotations from the highest bit down, then read the Gray
    code's bits across the dimensions."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(dims):
            inside = (x[i] & bit) != 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(inside, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        bit >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where(x[-1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def token_table(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = END_ID, dimensions: int = DIMENSIONS) -> DataFrame:
    """``_uid, _id, n, ids, p0..``: ids with ``end_id`` appended as packed
    little-endian integers (two bytes each where they fit), and the document's
    position. ``_uid`` numbers the rows; null text is empty."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [f"p{k}" for k in range(dimensions)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(tokenizer_path)
        vectors = np.random.default_rng(7).standard_normal((1 << 16, dimensions)).astype(np.float32)
        for batch in blocks(batches):
            ids, at = coder.encode(*flat_bytes(batch.column(2)))
            sizes = np.diff(at)
            where = np.maximum(at[:-1], 0)
            if len(ids):
                picked = np.concatenate([vectors[ids & 0xFFFF], np.zeros((1, dimensions), np.float32)])
                sums = np.add.reduceat(picked, np.minimum(where, len(ids)), axis=0)
                sums[sizes == 0] = 0
            else:
                sums = np.zeros((len(sizes), dimensions), np.float32)
            place = sums / np.sqrt(np.maximum(sizes, 1))[:, None]
            tail = np.array([end_id], coder.dtype).tobytes()
            packed = [ids[a:b].tobytes() + tail for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes + 1, pa.int64()), pa.array(packed, pa.binary())]
                + [pa.array(place[:, k].astype(np.float64)) for k in range(dimensions)],
                ["_uid", "_id", "n", "ids", *names],
            )

    small_batches(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("_uid"), F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")
    )
    return rows.mapInArrow(run, f"_uid long, _id {id_type}, n long, ids binary, {', '.join(f'{p} double' for p in names)}")


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, ids`` (``ids``: packed little-endian uint32).

    Every input row is packed, also repeated ones and those with a null
    identifier; null or empty text is the end id alone. All sequences are
    full but the last one. Other columns are ignored. No rows give no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    coded = staged(token_table(docs, tokenizer_path, id_col, text_col, end_id), "pack-ids")
    places = [f"p{k}" for k in range(DIMENSIONS)]
    stats = coded.agg(*[F.avg(p) for p in places], *[F.stddev_pop(p) for p in places]).first()
    centre = np.array([x or 0.0 for x in stats[:DIMENSIONS]])
    spread = np.array([x or 1.0 for x in stats[DIMENSIONS:]])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = (np.stack([batch.column(2 + k).to_numpy() for k in range(DIMENSIONS)], 1) - centre) / spread
            cells = np.minimum(((1 << BITS) / (1 + np.exp(np.clip(-1.702 * z, -60, 60)))).astype(np.int64), (1 << BITS) - 1)
            key = pa.array(hilbert_key(cells))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), key], ["_uid", "n", "_cell"])

    spark = docs.sparkSession
    tie = F.pmod(F.xxhash64("_uid"), F.lit(1 << TIE_BITS))
    order = staged(
        coded.select("_uid", "n", *places)
        .mapInArrow(keys, "_uid long, n long, _cell long")
        .withColumn("_key", F.col("_cell") * (1 << TIE_BITS) + tie)
        .repartitionByRange(shuffle_partitions(spark), "_key", "_uid")
        .select("_uid", "n", "_key", F.spark_partition_id().alias("_range")),
        "pack-order",
    )
    spans = staged(
        running(order, [], "_range", ["_key", "_uid"], "n", "_upto").select("_uid", (F.col("_upto") - F.col("n")).alias("_at")),
        "pack-spans",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            out: list[list] = [[] for _ in range(8)]
            for row, (n, ids, at) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                wide = np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4")
                start = 0
                while start < n:
                    offset = (at + start) % sequence
                    length = min(n - start, sequence - offset)
                    piece = wide[start : start + length].tobytes()
                    for column, value in zip(out, (row, start, length, zlib.crc32(piece), n, (at + start) // sequence, offset, piece)):
                        column.append(value)
                    start += length
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(out[0], pa.int64()))] + [pa.array(c, pa.int64()) for c in out[1:7]] + [pa.array(out[7], pa.binary())],
                [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    joined = coded.select("_uid", "_id", "n", "ids").join(spans, "_uid").select("_id", "n", "ids", "_at")
    return joined.mapInArrow(
        cut, f"`{id_col}` {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_pack_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer()).drop("ids")
