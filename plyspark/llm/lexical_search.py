"""Ranked lexical search by dense blocked matrix multiplication.

Items are taken in blocks of bounded size; a block's vocabulary is compacted to
small integers. One pass over the documents keeps, for each, its length and the
counts of vocabulary terms; a second builds dense tiles of impacts (documents
by the terms of a tile of items) and multiplies them with the items' weights in
float64. Terms are cut so that no partial sum reaches 2^53, so every sum is
exact, and partial sums are added as 64-bit integers. Each task keeps the best
``k`` of every item, ties by identifier, and a window over those picks the
result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plyspark.llm.common import flat_bytes, small_batches, scratch, staged, table, word_hashes, word_spans
from plyspark.llm.top_k import Best

TOP = 10
#: Text bytes of the items that one pass over the documents serves.
BLOCK_BYTES = 2 << 20
#: Items and documents of a tile.
TILE_ITEMS, TILE_DOCS = 64, 512
#: Text bytes that are split into terms at once.
PIECE_BYTES = 1 << 19
#: No impact reaches this: tf * 10^9 div (1000 * tf + 8 * m) with m of 25 or more.
IMPACT_BOUND = 10**6
_EXACT = 1 << 53

#: ASCII other than digits and letters separates terms.
SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def text_pieces(data: np.ndarray, longest: int, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Cut one text behind separators into pieces of at most ``most`` bytes
    (and more than ``longest``, the longest term that counts). Of a term that
    fills a whole piece only that piece comes: one term, too long to count."""
    most = max(most, longest + 1)
    at = 0
    while at < len(data):
        end = min(at + most, len(data))
        found = np.flatnonzero(SEPARATOR[data[at:end]]) if end < len(data) else []
        if len(found):
            end = at + int(found[-1]) + 1
        yield at, end
        while not len(found) and end < len(data):
            found = np.flatnonzero(SEPARATOR[data[end : end + most]])
            end = end + int(found[0]) if len(found) else min(end + most, len(data))
        at = end


class Vocabulary:
    """The terms of a block of items as consecutive integers."""

    def __init__(self, texts: list[str | None]):
        data, offsets = flat_bytes(pa.array(texts, pa.large_string()))
        start, end, first = word_spans(data, offsets, SEPARATOR)
        raw = data.tobytes()
        words = [raw[a:b].lower() for a, b in zip(start.tolist(), end.tolist())]  # bytes: A-Z only
        self.words = sorted(set(words))
        number = {w: i for i, w in enumerate(self.words)}
        self.items = [Counter(number[w] for w in words[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        flat = np.frombuffer(b"".join(self.words), np.uint8)
        ends = np.cumsum([0, *map(len, self.words)])
        hashes = word_hashes(flat, ends[:-1], ends[1:], fold=False)
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], order.astype(np.int64)
        self.sizes = np.diff(ends)
        self.longest = int(self.sizes.max(initial=0))

    def __len__(self) -> int:
        return len(self.words)

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Each word's number, -1 for those not in the vocabulary. Words are
        told apart by a 64-bit hash and their length."""
        if not len(self) or not len(start):
            return np.full(len(start), -1, np.int64)
        hashes = word_hashes(data, start, end)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        number = self.number[place]
        number[(self.hashes[place] != hashes) | (self.sizes[number] != end - start)] = -1
        return number


def term_counts(texts: pa.Array, vocabulary: Vocabulary) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of runs of rows: the rows, their number of terms, and the row, number
    and count of each vocabulary term, in order of rows and numbers."""
    data, offsets = flat_bytes(texts)
    rows = len(offsets) - 1
    at = 0
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, side="right")) - 1)
        end = min(end, rows)
        part = data[offsets[at] : offsets[end]]
        if len(part) <= 2 * PIECE_BYTES:
            start, stop, first = word_spans(part, offsets[at : end + 1] - offsets[at], SEPARATOR)
            found = vocabulary.find(part, start, stop)
            keep = found >= 0
            row = np.repeat(np.arange(end - at), np.diff(first))[keep]
            keys, counts = np.unique(row * max(len(vocabulary), 1) + found[keep], return_counts=True)
            sizes = np.diff(first)
        else:  # one long text, piece by piece
            total, sums = 0, np.zeros(len(vocabulary), np.int64)
            for a, b in text_pieces(part, vocabulary.longest):
                start, stop, first = word_spans(part[a:b], np.array([0, b - a]), SEPARATOR)
                short = stop - start <= vocabulary.longest
                found = vocabulary.find(part[a:b], start[short], stop[short]) if short.any() else np.zeros(0, np.int64)
                total += len(start)
                sums += np.bincount(found[found >= 0], minlength=len(vocabulary))
            keys = np.flatnonzero(sums)
            counts, sizes = sums[keys], np.array([total])
        size = max(len(vocabulary), 1)
        yield slice(at, end), sizes, keys // size, keys % size, counts
        at = end


class ItemTile:
    """Some items' weights over the terms they hold, cut into groups of terms
    whose partial sums stay below 2^53."""

    def __init__(self, items: list[Counter], weight: np.ndarray):
        self.terms = np.array(sorted({t for item in items for t in item}), np.int64)
        column = {t: c for c, t in enumerate(self.terms.tolist())}
        self.weights = np.zeros((len(self.terms), len(items)), np.int64)
        for i, item in enumerate(items):
            for t, times in item.items():
                self.weights[column[t], i] = times * int(weight[t])
        self.column = np.full(len(weight), -1, np.int64)
        self.column[self.terms] = np.arange(len(self.terms))
        self.cuts, sums = [0], np.zeros(len(items), object)
        for c, row in enumerate(self.weights.astype(object)):
            sums = sums + row * IMPACT_BOUND
            if c > self.cuts[-1] and len(items) and max(sums) >= _EXACT:
                self.cuts.append(c)
                sums = row * IMPACT_BOUND
        self.cuts.append(len(self.terms))

    def scores(self, docs: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Integer scores, documents by items."""
        where = self.column[term]
        keep = where >= 0
        tile = np.zeros((docs, len(self.terms)))
        tile[row[keep], where[keep]] = impact[keep]
        out = np.zeros((docs, self.weights.shape[1]), np.int64)
        for a, b in zip(self.cuts[:-1], self.cuts[1:]):
            weights = self.weights[a:b]
            if b - a == 1 and weights.max(initial=0) * IMPACT_BOUND >= _EXACT:
                out += tile[:, a:b].astype(np.int64) * weights
            else:
                out += (tile[:, a:b] @ weights.astype(np.float64)).astype(np.int64)
        return out


def document_weight(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """``m`` of each document, from its number of terms."""
    return np.array([25 + 75 * x * documents // terms for x in n.tolist()], np.int64)


def impacts(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (10**9 * counts) // (1000 * counts + 8 * m)


def _search_block(docs: DataFrame, block: list, k: int) -> DataFrame:
    """``_item, item_id, doc_id, score``: of each task the best ``k`` of each
    item of ``block``."""
    spark = docs.sparkSession
    vocabulary = Vocabulary([r["_text"] for r in block])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, n, row, term, times in term_counts(batch.column(1), vocabulary):
                ends = np.searchsorted(row, np.arange(len(n) + 1)) * 4
                binary = [
                    pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.astype("<i4")), pa.py_buffer(v.astype("<u4"))])
                    for v in (term, times)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[rows], pa.array(n, pa.int64()), *binary], ["_id", "n", "terms", "times"]
                )

    hits = staged(docs.mapInArrow(count, "_id long, n long, terms binary, times binary"), "lexical-hits")
    total = hits.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = int(total["docs"]), int(total["terms"] or 0)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            held += np.bincount(flat_bytes(batch.column(0))[0].view("<u4"), minlength=len(held))
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["term", "held"])

    df = np.zeros(len(vocabulary), np.int64)  # a row a term of the block
    for r in hits.select("terms").mapInArrow(frequencies, "term long, held long").groupBy("term").agg(F.sum("held").alias("df")).collect():
        df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    items = vocabulary.items
    keys = np.array([r["_item"] for r in block], np.int64)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = [(i, ItemTile(items[i : i + TILE_ITEMS], weight)) for i in range(0, len(items), TILE_ITEMS)]
        best = Best(np.ones(len(items)), k)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                null = np.asarray(part.column(0).is_null())
                ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                term, ends = flat_bytes(part.column(2))
                times = flat_bytes(part.column(3))[0].view("<u4").astype(np.int64)
                row = np.repeat(np.arange(part.num_rows), np.diff(ends) // 4)
                if not len(row):
                    continue
                m = document_weight(part.column(1).to_numpy(), n_docs, n_terms)
                impact = impacts(times, m[row])
                for first, tile in tiles:
                    scores = tile.scores(part.num_rows, row, term.view("<u4"), impact)
                    best.add(np.arange(first, first + scores.shape[1]), scores, ids, null)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[best.query]), pa.array(best.id, mask=best.null), pa.array(best.score)], ["_item", "doc_id", "score"]
        )

    small_batches(spark)
    return hits.mapInArrow(score, "_item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: of each row of ``items`` the ``k``
    documents of highest score above 0.

    Document identifiers are integers; a null one ranks behind its ties. Null
    or empty texts hold no term: such a document is found by no item, and such
    an item finds none. Repeated documents are ranked one by one, repeated
    items each on their own. Texts of any length are read piece by piece; other
    columns are ignored. No documents or no items give no rows. ``items`` is
    meant to be small beside ``docs``, which are read once a block of items.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    with scratch():
        asked = staged(
            items.select(F.monotonically_increasing_id().alias("_item"), F.col(item_col).alias("item_id"),
                         F.col(text_col).cast("string").alias("_text")),
            "lexical-items",
        )
        size = asked.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
        blocks = max(1, -(-size // block_bytes))
        found = []
        for b in range(blocks):
            block = asked.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == b).orderBy("_item").collect()
            if block:
                found.append(staged(_search_block(rows, block, k), "lexical-found"))
        if not found:
            found = [spark.createDataFrame([], "_item long, doc_id long, score long")]
        best = Window.partitionBy("_item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return staged(
            ranked.join(asked.select("_item", "item_id"), "_item").select("item_id", "rank", "doc_id", "score"),
            "lexical-ranked", keep=True,
        )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE_SQL = f"""
with doc_terms as (
  select row_number() over () as r, doc_id, {_TERMS} as terms from documents where text is not null
), totals as (
  select count(*) filter (where len(terms) > 0) as n_docs, sum(len(terms)) as n_terms from doc_terms
), counts as (
  select r, term, count(*) as tf from (select r, unnest(terms) as term from doc_terms) group by r, term
), weights as (
  select term, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / cast(2 * df + 1 as double))) as bigint) as w
  from (select term, count(*) as df from counts group by term), totals
), wanted as (
  select i, item_id, term, count(*) as times
  from (select i, item_id, unnest(terms) as term
        from (select row_number() over () as i, item_id, {_TERMS} as terms from benchmark where text is not null))
  group by i, item_id, term
), scored as (
  select i, item_id, d.doc_id,
    cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.terms) * n_docs) // n_terms)))) as bigint) as score
  from wanted join counts using (term) join weights using (term) join doc_terms d using (r), totals
  group by i, item_id, r, d.doc_id
), ranked as (
  select item_id, doc_id, score,
    row_number() over (partition by i order by score desc, doc_id nulls last) as rank
  from scored where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= {TOP}
"""
