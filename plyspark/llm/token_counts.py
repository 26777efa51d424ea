"""Token counts from flat, unindexed token files.

A token file is a plain sequence of ids in which an end-of-document id closes
each document; nothing says where documents begin. Files are read in blocks
of fixed size that cut documents anywhere. Each block is searched for
separators in one vectorised pass, and a prefix scan over the blocks of a
file adds the ids that a document has in earlier blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plyspark.llm.common import blocks, flat_bytes, small_batches, staged, table
from plyspark.llm.packing import default_tokenizer
from plyspark.llm.tokens import tokenizer

END_OF_DOCUMENT = 49407
#: No token's id: stands in the files for the end id inside a text.
INNER_END = 0xFFFF
BLOCK_IDS = 1 << 18


def write_token_files(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_OF_DOCUMENT, block_ids: int = BLOCK_IDS) -> DataFrame:
    """The documents as token files: rows ``file, block, payload`` (packed
    two-byte little-endian ids) and, apart from them, ``file, ordinal, id``
    naming the documents of each file in order. A file is what one task
    writes. ``end_id`` inside a text is written as ``INNER_END``, so that the
    end id only ends documents; null text is an empty document. A vocabulary
    whose ids don't fit two bytes beside ``INNER_END`` is refused."""
    if Tokenizer.from_file(tokenizer_path).get_vocab_size() > INNER_END or not 0 <= end_id < INNER_END:
        raise ValueError("token files hold ids of two bytes, below 65,535")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, file = tokenizer(tokenizer_path), TaskContext.get().partitionId()
        rest, block, ordinal = np.zeros(0, "<u2"), 0, 0

        def row(payloads: list[bytes], ids: pa.Array) -> pa.RecordBatch:
            nonlocal block, ordinal
            n, m = len(payloads), len(ids)
            numbers = [*range(block, block + n), *range(ordinal, ordinal + m)]
            block, ordinal = block + n, ordinal + m
            return pa.RecordBatch.from_arrays(
                [pa.array([file] * (n + m), pa.int32()), pa.array(numbers, pa.int64()),
                 pa.array(payloads + [None] * m, pa.binary()), pa.concat_arrays([pa.nulls(n, ids.type), ids])],
                ["file", "number", "payload", "id"],
            )

        for batch in blocks(batches):
            ids, at = coder.encode(*flat_bytes(batch.column(1)))
            ids = np.where(ids == end_id, INNER_END, ids)
            rest = np.concatenate([rest, np.insert(ids.astype("<u2"), at[1:], end_id)])
            full = len(rest) // block_ids
            pieces = [rest[k * block_ids : (k + 1) * block_ids].tobytes() for k in range(full)]
            rest = rest[full * block_ids :]
            yield row(pieces, batch.column(0))
        if len(rest):
            yield row([rest.tobytes()], pa.nulls(0, pa.int64()).cast(batch.column(0).type))

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"file int, number long, payload binary, id {id_type}")


def scan_separators(files: DataFrame, end_id: int = END_OF_DOCUMENT) -> DataFrame:
    """Tokens of each document of ``files(file, block, payload)``: ``file,
    ordinal, n_tokens`` (without the separator). What follows a file's last
    separator is a document if it has ids. Blocks may be empty, hold no
    separator or begin with one; no blocks give no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for file, block, payload in zip(*(batch.column(k).to_pylist() for k in range(3))):
                ids = np.frombuffer(payload or b"", "<u2")
                ends = np.flatnonzero(ids == end_id)
                inner = np.diff(ends) - 1
                head = int(ends[0]) if len(ends) else len(ids)
                tail = len(ids) - int(ends[-1]) - 1 if len(ends) else len(ids)
                for column, value in zip(out, (file, block, [head, *inner.tolist()] if len(ends) else [], tail, len(ends))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64())),
                 pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())],
                ["file", "block", "closed", "tail", "ends"],
            )

    scanned = files.select("file", "block", "payload").mapInArrow(
        run, "file int, block long, closed array<bigint>, tail long, ends long"
    )
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    # Blocks since the last one with a separator add up to the open document.
    stitched = (
        scanned.withColumn("first", F.coalesce(F.sum("ends").over(earlier), F.lit(0)))
        .withColumn("all", F.sum("tail").over(earlier))
        .withColumn("base", F.when(F.col("ends") > 0, F.coalesce("all", F.lit(0))))
        .withColumn("since", F.last("base", True).over(earlier))
        .withColumn("open", F.coalesce(F.col("all") - F.coalesce("since", F.lit(0)), F.lit(0)))
        .withColumn("last", F.lead("block").over(order).isNull())
    )
    closed = stitched.select(
        "file", "first", "open", F.posexplode("closed").alias("k", "n")
    ).select("file", (F.col("first") + F.col("k")).alias("ordinal"),
             (F.col("n") + F.when(F.col("k") == 0, F.col("open")).otherwise(0)).alias("n_tokens"))
    left = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("open") + F.col("tail"))
    unclosed = stitched.where(F.col("last") & (left > 0)).select("file", (F.col("first") + F.col("ends")).alias("ordinal"), left.alias("n_tokens"))
    return closed.unionByName(unclosed)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens`` of all documents, counted in their token files."""
    written = staged(write_token_files(table(spark, sf_dir, "documents"), default_tokenizer()), "token-files")
    files = written.where("payload IS NOT NULL").select("file", F.col("number").alias("block"), "payload")
    names = written.where("payload IS NULL").select("file", F.col("number").alias("ordinal"), F.col("id").alias("doc_id"))
    return names.join(scan_separators(files), ["file", "ordinal"]).select("doc_id", "n_tokens")
