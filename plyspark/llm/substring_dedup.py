"""Removal of byte strings that an earlier document has, by bucket-pointer
refinement of suffixes.

Suffixes are put in buckets by their first bytes, and buckets are refined by
the bucket identifiers of later offsets: the identifier of 20 bytes is made of
those of two 10-byte buckets, those of 35 and 50 bytes of identifiers found
before. Each round keeps only what the next one must tell apart:

1. 20-byte buckets, of sampled suffixes only: in every 50-byte window the one
   with the smallest identifier (the first such) stands for the window, so
   equal windows are always in one bucket. Neighbouring windows with one
   sample form a segment. Buckets with a single document are done, and those
   are most. Segments are told apart by the identifiers of their first and
   last 50 bytes; all documents but the first of equal segments lose them,
   and where all segments of a bucket are equal, the first one is done too.
2. The other segments' buckets are refined to 35 bytes, to the right for
   windows that hold 15 bytes after the sample and to the left for the rest,
   and settled in the same way.
3. What is left, at the edges of repeated passages, is refined window by
   window to 50 bytes.

Every step is an aggregate or a join by bucket; no bucket is ever gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plyspark.llm.common import _BASE, _BYTE, _INV, discard, flat_bytes, mix, powers, scratch, small_batches, staged, table

#: Bytes of a repeated string, of the first buckets, and of the samples.
LENGTH, GRAM = 50, 10
SAMPLE = 2 * GRAM
SPAN = LENGTH - SAMPLE + 1
#: Bytes beside the sample that the second round's buckets hold.
BESIDE = (LENGTH - SAMPLE) // 2
#: ``at`` holds a start and a number of windows.
SHIFT = 8
#: Bytes worked on at once.
PIECE = 1 << 19
#: Room for places in a piece, among the bits of an identifier.
PLACES = (1 << 20) - 1
_LEFT, _RIGHT = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of a bucket refined by that of a later offset."""
    return mix(a * _LEFT + (b ^ (b >> np.uint64(29))) * _RIGHT)


def gram_buckets(data: np.ndarray) -> np.ndarray:
    """Identifiers of the first buckets: of every ``GRAM`` bytes."""
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=run[1:])
    return mix((run[GRAM:] - run[:-GRAM]) * powers(_INV, len(data))[: len(data) - GRAM + 1])


def window_buckets(grams: np.ndarray, samples: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Identifiers of the 50 bytes at ``at``, from those of later offsets."""
    return pair(pair(samples[at], samples[at + SAMPLE]), grams[at + 2 * SAMPLE])


def smallest(values: np.ndarray, span: int) -> np.ndarray:
    """First place of the minimum of each ``span`` neighbours. Values and
    places are compared as one number, by the values' upper bits first."""
    low = (values & ~np.uint64(PLACES)) | np.arange(len(values), dtype=np.uint64)
    width = 1
    while width < span:
        step = min(width, span - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    return (low & np.uint64(PLACES)).astype(np.int64)


def segment_identifier(grams: np.ndarray, samples: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Identifier of the bytes of ``count`` windows from ``begin`` on: the
    first and last window cover them, as a segment has at most ``SPAN``."""
    return pair(window_buckets(grams, samples, begin), window_buckets(grams, samples, begin + count - 1) + count.astype(np.uint64))


def pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(batch, rows, bases, data, offsets)``: texts of about ``PIECE`` bytes
    together, long ones cut so that each window is in exactly one piece."""
    for batch in batches:
        data, offsets = flat_bytes(batch.column(column))
        parts = []
        for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            for base in range(0, max(b - a - LENGTH + 1, 0), PIECE):
                parts.append((row, base, a + base, min(b, a + base + PIECE + LENGTH - 1)))
        at = 0
        while at < len(parts):
            size, end = 0, at
            while end < len(parts) and (end == at or size + parts[end][3] - parts[end][2] <= PIECE):
                size += parts[end][3] - parts[end][2]
                end += 1
            rows, bases, starts, ends = (np.array(x, np.int64) for x in zip(*parts[at:end]))
            yield batch, rows, bases, np.concatenate([data[a:b] for a, b in zip(starts, ends)]), np.concatenate([[0], np.cumsum(ends - starts)])
            at = end


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def segments(docs: DataFrame) -> DataFrame:
    """``bucket, segment, doc, part, at`` of ``docs(doc, part, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, bases, data, offsets in pieces(batches, 2):
            grams = gram_buckets(data)
            samples = pair(grams[: len(grams) - GRAM], grams[GRAM:])
            chosen = smallest(samples, SPAN)
            place = np.arange(len(chosen))
            owner = np.repeat(np.arange(len(rows)), np.diff(offsets))[: len(place)]
            valid = place + LENGTH <= offsets[owner + 1]
            place, owner, chosen = place[valid], owner[valid], chosen[valid]
            new = np.ones(len(place), bool)
            new[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(place)))
            begin = place[first]
            segment = segment_identifier(grams, samples, begin, count)
            who = owner[first]
            start = begin - offsets[who] + bases[who]
            row = pa.array(rows[who])
            yield pa.RecordBatch.from_arrays(
                [signed(samples[chosen[first]]), signed(segment), batch.column(0).take(row), batch.column(1).take(row), pa.array(start << SHIFT | count)],
                ["bucket", "segment", "doc", "part", "at"],
            )

    return docs.mapInArrow(run, "bucket long, segment long, doc long, part int, at long")


def asked_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The bytes of asked segments, one after another: ``(batch, owner, at,
    bucket, start, count, first byte of each, grams, samples)``; the third
    column is the text and the fourth the ``(at, bucket)`` pairs."""
    for batch in batches:
        data, offsets = flat_bytes(batch.column(2))
        asked = batch.column(3)
        pairs = asked.flatten()
        at, bucket = (pairs.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        owner = np.repeat(np.arange(len(asked)), np.diff(asked.offsets.to_numpy()))
        step = max(1, PIECE // (SPAN + LENGTH))
        for low in range(0, len(at), step):
            part = slice(low, low + step)
            start, count = at[part] >> SHIFT, at[part] & ((1 << SHIFT) - 1)
            size = count + LENGTH - 1
            begin = np.cumsum(size) - size
            take = np.arange(size.sum()) + np.repeat(offsets[owner[part]] + start - begin, size)
            grams = gram_buckets(data[take])
            yield batch, owner[part], bucket[part], start, count, begin, grams, pair(grams[: len(grams) - GRAM], grams[GRAM:])


def longer_buckets(docs: DataFrame) -> DataFrame:
    """``bucket, segment, doc, part, at``: the asked segments of ``docs(doc,
    part, text, asked)``, cut at the window that has as many bytes before as
    after its sample, in buckets of 35 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, owner, _, start, count, begin, grams, samples in asked_texts(batches):
            sample = smallest(samples, SPAN)[begin]
            cut = np.clip(sample - BESIDE - begin, 0, count)
            out = []
            for rows, skip, size, near, far in (
                (np.flatnonzero(cut < count), cut, count - cut, SAMPLE, SAMPLE + BESIDE - GRAM),
                (np.flatnonzero(cut > 0), 0 * cut, cut, -GRAM, -BESIDE),
            ):
                at = sample[rows]
                longer = pair(pair(samples[at], grams[at + near]), grams[at + far] + np.uint64(near < 0))
                segment = segment_identifier(grams, samples, (begin + skip)[rows], size[rows])
                who = pa.array(owner[rows])
                out.append(pa.RecordBatch.from_arrays(
                    [signed(longer), signed(segment), batch.column(0).take(who), batch.column(1).take(who),
                     pa.array((start + skip)[rows] << SHIFT | size[rows])],
                    ["bucket", "segment", "doc", "part", "at"],
                ))
            yield from out

    return docs.mapInArrow(run, "bucket long, segment long, doc long, part int, at long")


def windows(docs: DataFrame) -> DataFrame:
    """``bucket, window, doc, part, at``: the single windows of the asked
    segments of ``docs(doc, part, text, asked)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, owner, bucket, start, count, begin, grams, samples in asked_texts(batches):
            each = np.repeat(np.arange(len(count)), count)
            inner = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
            found = window_buckets(grams, samples, begin[each] + inner)
            who = pa.array(owner[each])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[each]), signed(found), batch.column(0).take(who), batch.column(1).take(who),
                 pa.array((start[each] + inner) << SHIFT | 1)],
                ["bucket", "window", "doc", "part", "at"],
            )

    return docs.mapInArrow(run, "bucket long, window long, doc long, part int, at long")


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, part, text, given, null_text``: identifiers as numbers, a null
    one before all others. Rows that repeat an identifier are parts of one
    document, in order of their texts; mostly there are none."""
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.lit(0).alias("part"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(id_col).alias("given"),
    )
    repeated = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    if repeated:
        part = F.row_number().over(Window.partitionBy("doc").orderBy("text")) - 1
        rows = staged(rows.withColumn("part", part.cast("int")), "numbered")
    return rows


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``doc, part, at``: windows that begin in an earlier document too, of
    ``rows(doc, part, text)``; each ``at`` is a start and how many windows
    follow each other there."""
    texts = rows.select("doc", "part", "text").where(F.octet_length("text") >= LENGTH)
    first = settle(segments(texts), "sub-first")
    asked = asked_of(texts, first)
    cut = staged(longer_buckets(asked), "sub-longer")
    second = settle(cut, "sub-second")
    discard(cut)
    single = staged(windows(asked_of(texts, second)), "sub-windows")
    firsts = staged(
        single.groupBy("bucket", "window").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").drop("last"), "sub-firsts"
    )
    found = single.join(firsts, ["bucket", "window"]).where("doc > first").select("doc", "part", "at")
    gone = [x.where("gone").select("doc", "part", "at") for x in (first, second)]
    return gone[0].unionByName(gone[1]).unionByName(found)


def asked_of(texts: DataFrame, settled: DataFrame) -> DataFrame:
    """Texts with the segments that a round leaves open."""
    asked = settled.where("NOT gone").groupBy("doc", "part").agg(F.collect_list(F.struct("at", "bucket")).alias("asked"))
    return texts.join(asked, ["doc", "part"]).select("doc", "part", "text", "asked")


def settle(cut: DataFrame, name: str) -> DataFrame:
    """``doc, part, at, bucket, gone``: the segments of buckets that several
    documents share. ``gone`` ones are in an earlier document as a whole; of
    the others only those are kept that a bucket with several kinds has."""
    shared = staged(
        cut.groupBy("bucket").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("bucket"), f"{name}-shared"
    )
    left = staged(cut.join(shared.hint("shuffle_hash"), "bucket"), f"{name}-left")
    discard(shared)
    kinds = staged(left.groupBy("bucket", "segment").agg(F.min("doc").alias("first")), f"{name}-kinds")
    several = kinds.groupBy("bucket").agg(F.min("segment").alias("a"), F.max("segment").alias("b")).where("a < b")
    told = staged(kinds.join(several.select("bucket", F.lit(True).alias("several")), "bucket", "left"), f"{name}-told")
    discard(kinds)
    settled = staged(
        left.join(told, ["bucket", "segment"])
        .where((F.col("doc") > F.col("first")) | F.col("several"))
        .select("doc", "part", "at", "bucket", (F.col("doc") > F.col("first")).alias("gone")),
        f"{name}-settled",
    )
    discard(left)
    discard(told)
    return settled


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, n_bytes, n_removed, n_spans,
    kept_sha256, kept_text`` (``kept_text``: the remaining bytes).

    A byte goes if a 50-byte string over it also begins in a document with a
    smaller identifier, judged on the input. Null text is empty; texts under
    50 bytes lose nothing; rows with one identifier are one document and never
    remove from each other. Other columns are ignored. No rows give no rows.
    """
    small_batches(docs.sparkSession)
    rows = numbered(docs, id_col, text_col)
    with scratch():
        spans = staged(repeated_spans(rows).groupBy("doc", "part").agg(F.collect_list("at").alias("spans")), "sub-spans", keep=True)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(batch.column(1))
            spans, n = batch.column(2), batch.num_rows
            out: list[list] = [[] for _ in range(5)]
            for row in range(n):
                text = data[offsets[row] : offsets[row + 1]]
                kept, removed, count = text.tobytes(), 0, 0
                if spans[row].is_valid:
                    at = np.sort(spans[row].values.to_numpy())
                    begin, end = at >> SHIFT, (at >> SHIFT) + (at & ((1 << SHIFT) - 1)) + LENGTH - 1
                    end = np.maximum.accumulate(end)
                    first = np.append(True, begin[1:] > end[:-1])
                    begin, end = begin[first], end[np.append(first[1:], True)]
                    removed, count = int((end - begin).sum()), len(begin)
                    gone = np.zeros(len(text) + 1, np.int8)
                    gone[begin], gone[end] = 1, -1
                    kept = text[np.cumsum(gone[:-1]) == 0].tobytes()
                for column, value in zip(out, (len(text), removed, count, hashlib.sha256(kept).hexdigest(), kept)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, pa.int64()) for c in out[:3]] + [pa.array(out[3], pa.string()), pa.array(out[4], pa.binary())],
                [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )

    joined = rows.join(spans, ["doc", "part"], "left").select("given", "text", "spans")
    return joined.mapInArrow(
        run, f"`{id_col}` {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary"
    )


def op4_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")
