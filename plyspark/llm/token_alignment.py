"""Alignment of two tokenizers by white-space anchors.

A text is tokenised whole by both. Places where a token of either ends and
the next token of both is space-marked are anchors; they split the document
into windows of token ids. A window's alignment depends on nothing but its
ids, so it is worked out once for each pair of id tuples and kept. Links of
all documents are counted by id pair, and each document's links are then rated
by those counts.

Words and windows are met again and again, so a worker keeps the ids of the
words (cut where neither tokenizer joins across) and the alignments of the
windows that it has met lately; both are looked up in bulk by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plyspark.llm.common import flat_bytes, mix, powers, scratch, small_batches, staged, table, word_hashes

#: Text bytes that are tokenised at once; a longer text comes in pieces, cut
#: between words.
PIECE_BYTES = 1 << 19
#: Words and windows that a worker keeps; beyond it a store starts anew.
KEPT = 400_000
#: Most id pairs whose counts are broadcast (24 bytes each); more are joined
#: by a shuffle.
BROADCAST_PAIRS = 1_000_000
_SPACE = 0x20
#: First bytes of characters none of which is white space or a space mark.
_VISIBLE = np.array([b > 0x20 and b not in (0x7F, 0xC2, 0xE1, 0xE2, 0xE3) for b in range(256)])
_BASES = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: Texts on which cutting between words is tried against whole texts.
_PROBES = (
    "Don't stop, it's  42!", "a\n b\t c \n\n  d", "x,y . zété 你好 世界", " lead and trail ",
    "a <s> b </s> <|endoftext|> c", "café naïve 3.14 __x__ ''' \"q\" tab\tend", "  x 　 y",
)


class Side:
    """One tokenizer: ids of texts, and of each id the bytes and whether it
    begins with a space."""

    def __init__(self, token_bytes: list[bytes], encode):
        self.encode = encode
        self.size = np.array([len(b) for b in token_bytes], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.marked = np.array([b[:1] == b" " for b in token_bytes])
        if len(token_bytes) > 1 << 17:
            raise ValueError("a vocabulary has more than 131,072 ids")  # a pair and its text share 64 bits

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.pool[spread(self.begin[ids], self.size[ids])]


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``begin .. begin + size - 1`` of every run, one after another."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def byte_level(path: str) -> Side:
    """Side A, of a byte-level vocabulary; texts come with their space."""
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    # The public byte alphabet: printable Latin-1 stands for itself, the rest for 256 and up.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    value = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    words = [library.id_to_token(i) for i in range(library.get_vocab_size())]
    decoded = [bytes(value[c] for c in w) if all(c in value for c in w) else w.encode() for w in words]
    return Side(decoded, lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)])


def pieces(path: str) -> Side:
    """Side B, of pieces with byte fallback; the model adds the space."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    decoded = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        decoded.append(bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return Side(decoded, lambda texts: model.encode([t[1:] for t in texts], num_threads=1))


class Store:
    """Rows of columns that only grow, found by a 64-bit hash."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.columns: dict[str, np.ndarray] = {}

    def full(self, hashes: np.ndarray) -> bool:
        return len(self.keys) + len(hashes) > self.most

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the sorted distinct ``hashes`` aren't held."""
        at = np.searchsorted(self.keys, hashes)
        held = at < len(self.keys)
        held[held] = self.keys[at[held]] == hashes[held]
        return np.flatnonzero(~held)

    def learn(self, hashes: np.ndarray, columns: dict[str, np.ndarray]) -> None:
        at = np.searchsorted(self.keys, hashes)
        n = len(self.keys)
        self.keys = np.insert(self.keys, at, hashes)
        self.place = np.insert(self.place, at, np.arange(n, n + len(hashes)))
        for name, values in columns.items():
            self.columns[name] = np.concatenate([self.columns[name], values]) if name in self.columns else values

    def find(self, hashes: np.ndarray) -> np.ndarray:
        return self.place[np.searchsorted(self.keys, hashes)]


class Runs:
    """Many short arrays in one that only grows."""

    def __init__(self, dtype: type):
        self.data, self.used = np.zeros(1 << 16, dtype), 0

    def add(self, values: np.ndarray) -> int:
        """Where ``values`` begin."""
        begin = self.used
        if begin + len(values) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(len(self.data), len(values)), self.data.dtype)])
        self.data[begin : begin + len(values)] = values
        self.used += len(values)
        return begin


def id_hashes(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of each run of ids."""
    run = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(mix(ids.astype(np.uint64) + np.uint64(base)) * powers(base, len(ids)), out=run[1:])
    back = powers(pow(base, -1, 1 << 64), len(ids) + 1)
    return mix((run[end] - run[begin]) * back[begin] + (end - begin).astype(np.uint64))


def align_windows(a: np.ndarray, a_count: np.ndarray, b: np.ndarray, b_count: np.ndarray, sides: tuple[Side, Side]) -> dict:
    """Align windows given one after another. Returns of each window its
    groups and links, its groups as text, and the runs of its distinct linked
    pairs (A id shifted left by 32 bits, or-ed with B id) with their times."""
    (end_a, end_b) = (np.cumsum(s.size[ids]) for s, ids in zip(sides, (a, b)))
    cut = np.intersect1d(end_a, end_b, assume_unique=True)  # windows end at shared ends
    group_a, group_b = np.searchsorted(cut, end_a), np.searchsorted(cut, end_b)
    n_a, n_b = np.bincount(group_a, minlength=len(cut)), np.bincount(group_b, minlength=len(cut))
    windows = len(a_count)
    group_window = np.repeat(np.arange(windows), a_count)[np.cumsum(n_a) - 1]
    groups = np.bincount(group_window, minlength=windows)
    links = np.bincount(group_window, weights=n_a * n_b, minlength=windows).astype(np.int64)

    # Distinct ids of a group with their times, so that long groups don't make all their pairs.
    def distinct(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        key, times = np.unique(group << 32 | ids, return_counts=True)
        of = key >> 32
        return key & 0xFFFFFFFF, times, np.searchsorted(of, np.arange(len(cut))), np.bincount(of, minlength=len(cut))

    id_a, times_a, from_a, held_a = distinct(group_a, a)
    id_b, times_b, from_b, held_b = distinct(group_b, b)
    each = held_a * held_b
    group = np.repeat(np.arange(len(cut)), each)
    inside = np.arange(len(group)) - np.repeat(np.cumsum(each) - each, each)
    left, right = from_a[group] + inside // held_b[group], from_b[group] + inside % held_b[group]
    pair, times = id_a[left] << 32 | id_b[right], times_a[left] * times_b[right]
    window = group_window[group]
    order = np.lexsort((pair, window))
    window, pair, times = window[order], pair[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], (window[1:] != window[:-1]) | (pair[1:] != pair[:-1])])) if len(pair) else order
    times = np.add.reduceat(times, first) if len(first) else times
    pair, window = pair[first], window[first]

    text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
    shown, at_a, at_b = [], 0, 0
    for x, y in zip(n_a.tolist(), n_b.tolist()):
        shown.append(
            f"{text_a[at_a]}|{text_b[at_b]}" if x == 1 and y == 1
            else ",".join(text_a[at_a : at_a + x]) + "|" + ",".join(text_b[at_b : at_b + y])
        )
        at_a, at_b = at_a + x, at_b + y
    texts, at = [], 0
    for n in groups.tolist():
        texts.append(shown[at] if n == 1 else ";".join(shown[at : at + n]))
        at += n
    return {"groups": groups, "links": links, "texts": texts, "pair": pair, "times": times,
            "held": np.bincount(window, minlength=windows)}


class Aligner:
    """What one worker knows: both tokenizers, and what it met lately."""

    def __init__(self, path_a: str, path_b: str, kept: int = KEPT):
        self.sides = byte_level(path_a), pieces(path_b)
        self.words, self.windows = Store(kept), Store(kept)
        self._clear_words()
        self._clear_windows()
        self.by_word = True
        for text in _PROBES:
            data = np.frombuffer(b" " + text.encode(), np.uint8)
            whole = [np.array(s.encode([" " + text])[0], np.int64) for s in self.sides]
            ids, count, _ = self.encode(data, np.array([0, len(data)]))
            if any(x.tolist() != y.tolist() for x, y in zip(whole, ids)):
                self.by_word = False
                self._clear_words()

    def _clear_words(self) -> None:
        self.words.clear()
        self.ids = Runs(np.uint32), Runs(np.uint32)

    def _clear_windows(self) -> None:
        self.windows.clear()
        self.texts: list[str] = []
        self.pair, self.times = Runs(np.int64), Runs(np.int64)

    def places(self, data: np.ndarray) -> np.ndarray:
        """Places where a word may begin: a space after something else than a
        space and before a character that is surely no white space. Neither
        tokenizer joins across such a place."""
        if not self.by_word or len(data) < 3:
            return np.zeros(0, np.int64)
        return np.flatnonzero((data[1:-1] == _SPACE) & (data[:-2] != _SPACE) & _VISIBLE[data[2:]]) + 1

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Both sides' ids of texts (each with its space before it) one after
        another, how many each text has, and whether it has tokens whose
        bytes are its own."""
        begin = np.unique(np.concatenate([offsets[:-1], self.places(data)]))
        end = np.append(begin[1:], len(data))
        hashes = word_hashes(data, begin, end, fold=False)
        distinct, sample, where = np.unique(hashes, return_index=True, return_inverse=True)
        if self.words.full(distinct):
            self._clear_words()
        new = self.words.missing(distinct)
        if len(new):
            raw = data.tobytes()
            spans = zip(begin[sample[new]].tolist(), end[sample[new]].tolist())
            words = [raw[x:y] for x, y in spans]
            texts = [w.decode() for w in words]
            columns, same = {}, np.ones(len(words), bool)
            given = np.frombuffer(b"".join(words), np.uint8)
            sizes = np.array([len(w) for w in words], np.int64)
            for name, side, pool in zip("ab", self.sides, self.ids):
                lists = side.encode(texts)
                count = np.array([len(x) for x in lists], np.int64)
                flat = np.array([i for x in lists for i in x], np.int64)
                columns[f"{name}_count"] = count
                columns[f"{name}_begin"] = pool.add(flat) + np.cumsum(count) - count
                word = np.repeat(np.arange(len(words)), count)
                made = np.bincount(word, weights=side.size[flat], minlength=len(words)).astype(np.int64)
                fits = made == sizes
                got = side.bytes_of(flat[fits[word]])
                wrong = got != given[np.repeat(fits, sizes)]
                held = np.flatnonzero(fits)
                bad = np.unique(np.repeat(held, sizes[held])[wrong])
                fits[bad] = False
                same &= fits
            columns["same"] = same
            self.words.learn(distinct[new], columns)
        place = self.words.find(distinct)[where]
        of_text = np.searchsorted(offsets, begin, side="right") - 1
        ids, counts = [], []
        for name, pool in zip("ab", self.ids):
            size = self.words.columns[f"{name}_count"][place]
            ids.append(pool.data[spread(self.words.columns[f"{name}_begin"][place], size)].astype(np.int64))
            counts.append(np.bincount(of_text, weights=size, minlength=len(offsets) - 1).astype(np.int64))
        wrong = np.bincount(of_text, weights=~self.words.columns["same"][place], minlength=len(offsets) - 1)
        return ids, counts, (wrong == 0) & (np.diff(offsets) > 1)

    def align(self, ids: list[np.ndarray], text_begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows of texts whose ids come one after another (``text_begin``:
        the byte at which each begins): each window's first byte and its place
        among the kept alignments."""
        ends = [np.cumsum(s.size[x]) for s, x in zip(self.sides, ids)]
        shared, at_a, at_b = np.intersect1d(ends[0], ends[1], assume_unique=True, return_indices=True)
        last = ends[0][-1]
        inner = shared < last
        # An anchor: a shared end before space-marked tokens of both, or before the next text.
        anchor = ~inner
        anchor[inner] = self.sides[0].marked[ids[0][at_a[inner] + 1]] & self.sides[1].marked[ids[1][at_b[inner] + 1]]
        anchor |= np.isin(shared, text_begin)
        stop_a, stop_b, stop = at_a[anchor] + 1, at_b[anchor] + 1, shared[anchor]
        begin_a, begin_b = np.append(0, stop_a[:-1]), np.append(0, stop_b[:-1])
        hashes = id_hashes(ids[0], begin_a, stop_a, _BASES[0]) * np.uint64(3) + id_hashes(ids[1], begin_b, stop_b, _BASES[1])
        distinct, sample, where = np.unique(hashes, return_index=True, return_inverse=True)
        if self.windows.full(distinct):
            self._clear_windows()
        new = self.windows.missing(distinct)
        if len(new):
            pick = sample[new]
            a_count, b_count = stop_a[pick] - begin_a[pick], stop_b[pick] - begin_b[pick]
            found = align_windows(ids[0][spread(begin_a[pick], a_count)], a_count, ids[1][spread(begin_b[pick], b_count)], b_count, self.sides)
            begin = self.pair.add(found["pair"]) + np.cumsum(found["held"]) - found["held"]
            self.times.add(found["times"])
            self.texts.extend(found["texts"])
            self.windows.learn(distinct[new], {"groups": found["groups"], "links": found["links"], "held": found["held"], "begin": begin})
        return np.append(0, stop[:-1]), self.windows.find(distinct)[where]


_open: dict[tuple, Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's aligner."""
    if (path_a, path_b) not in _open:
        _open.clear()
        _open[path_a, path_b] = Aligner(path_a, path_b)
    return _open[path_a, path_b]


class Totals:
    """What has been gathered of each text of a run."""

    def __init__(self, texts: int):
        self.a, self.b, self.groups, self.links = (np.zeros(texts, np.int64) for _ in range(4))
        self.same = np.ones(texts, bool)
        self.digest = [hashlib.sha256() for _ in range(texts)]
        self.begun = [False] * texts
        self.keys, self.times = [], []

    def add(self, known: Aligner, data: np.ndarray, offsets: np.ndarray, first: int) -> None:
        """Texts ``first`` and on, or a piece of text ``first``."""
        ids, counts, same = known.encode(data, offsets)
        rows = slice(first, first + len(same))
        self.a[rows] += counts[0]
        self.b[rows] += counts[1]
        self.same[rows] &= same
        if not same.all():  # the others are aligned by themselves
            keep = [np.repeat(same, c) for c in counts]
            ids = [x[k] for x, k in zip(ids, keep)]
        if not len(ids[0]):
            return
        size = np.diff(offsets) * same
        start = np.cumsum(size) - size
        begin, place = known.align(ids, start[same])
        text = np.flatnonzero(same)[np.searchsorted(start[same], begin, side="right") - 1] + first
        columns = known.windows.columns
        self.groups += np.bincount(text, weights=columns["groups"][place], minlength=len(self.groups)).astype(np.int64)
        self.links += np.bincount(text, weights=columns["links"][place], minlength=len(self.links)).astype(np.int64)
        cuts = np.searchsorted(text, np.arange(first, first + len(same) + 1)).tolist()
        shown, listed = known.texts, place.tolist()
        for t, (x, y) in enumerate(zip(cuts[:-1], cuts[1:]), first):
            if x < y:
                joined = ";".join([shown[p] for p in listed[x:y]])
                self.digest[t].update((";" + joined if self.begun[t] else joined).encode())
                self.begun[t] = True
        met, often = np.unique(text << 32 | place, return_counts=True)
        t, p = met >> 32, met & 0xFFFFFFFF
        held = columns["held"][p]
        at = spread(columns["begin"][p], held)
        self._gather(np.repeat(t, held), known.pair.data[at], known.times.data[at] * np.repeat(often, held))

    def _gather(self, text: np.ndarray, pair: np.ndarray, times: np.ndarray) -> None:
        """Distinct pairs of each text so far."""
        key, at = np.unique(text << 34 | pair >> 32 << 17 | pair & 0xFFFFFFFF, return_inverse=True)
        times = np.bincount(at, weights=times).astype(np.int64)
        self.keys.append(key)
        self.times.append(times)
        if len(self.keys) > 8:
            self.keys, self.times = ([x] for x in self._joined())

    def _joined(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        return key, np.bincount(at, weights=np.concatenate(self.times)).astype(np.int64)

    def rows(self) -> tuple[list, list[str]]:
        """Columns, in order of ``_ALIGNED`` without the identifiers."""
        n = len(self.a)
        key, times = self._joined()
        good = self.same[key >> 34]
        key, times = key[good], times[good]
        ends = np.searchsorted(key >> 34, np.arange(n + 1)).astype(np.int32)
        pair = (key >> 17 & 0x1FFFF) << 32 | key & 0x1FFFF
        counts = [np.where(self.same, x, 0) for x in (self.a, self.b, self.groups, self.links)]
        shown = [d.hexdigest() if s else "" for s, d in zip(self.same.tolist(), self.digest)]
        return [*(pa.array(c) for c in counts), pa.array(shown),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(pair)), pa.ListArray.from_arrays(pa.array(ends), pa.array(times))]


_NAMES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "_pairs", "_times"]
_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, _pairs array<long>, _times array<long>"


def aligned_rows(known: Aligner, texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[slice, list]]:
    """Runs of rows and their aligned columns. A text over ``most`` bytes is
    taken in pieces that begin at the first word after so many bytes."""
    data, offsets = flat_bytes(texts)
    rows, at = len(offsets) - 1, 0
    while at < rows:
        end = min(max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1), rows)
        totals = Totals(end - at)
        part, cuts = data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        if len(part) <= 2 * most:
            totals.add(known, np.insert(part, cuts[:-1], _SPACE), cuts + np.arange(len(cuts)), 0)
        else:
            text = np.insert(part, 0, _SPACE)
            begin = 0
            while begin < len(text):
                stop, look = len(text), begin + most
                while look < len(text):
                    found = known.places(text[look - 1 : look + most + 1])
                    if len(found):
                        stop = look - 1 + int(found[0])
                        break
                    look += most
                totals.add(known, text[begin:stop], np.array([0, stop - begin]), 0)
                begin = stop
        yield slice(at, end), totals.rows()
        at = end


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """One row a document: ``_uid, _id``, its counts and its linked pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(path_a, path_b)
        for batch in batches:
            for rows, columns in aligned_rows(known, batch.column(2)):
                yield pa.RecordBatch.from_arrays([batch.column(0)[rows], batch.column(1)[rows], *columns], ["_uid", "_id", *_NAMES])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.monotonically_increasing_id().alias("_uid"), F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")
    )
    return rows.mapInArrow(run, f"_uid long, _id {id_type}, {_ALIGNED}")


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                    broadcast_pairs: int = BROADCAST_PAIRS) -> tuple[DataFrame, DataFrame]:
    """Aligns two tokenizers over ``docs``. Returns one row a document
    (``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``) and the linked id pairs (``a, b, documents, best``:
    ``best`` if no other pair of ``a`` is linked in more documents).

    Texts that are null or empty, or whose tokens' bytes are not the text's,
    have no tokens: zeros, and an empty digest. Every row counts as a document
    of its own, also repeated ones and those with a null identifier. Texts of
    any length are read piece by piece; other columns are ignored. No rows
    give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with scratch():
        rows = staged(aligned(docs, path_a, path_b, id_col, text_col), "align-rows")
        counts = rows.select(F.explode("_pairs").alias("_pair")).groupBy("_pair").agg(F.count(F.lit(1)).alias("documents"))
        of_a = Window.partitionBy(F.shiftrightunsigned("_pair", 32))  # an A id has as many pairs as B has ids, at most
        rated = staged(
            counts.select("_pair", "documents", (F.col("documents") == F.max("documents").over(of_a)).alias("best")), "align-pairs"
        )
        few = rated.count() <= broadcast_pairs
        linked = rows.select("_uid", F.explode(F.arrays_zip("_pairs", "_times")).alias("_link")).select(
            "_uid", F.col("_link._pairs").alias("_pair"), F.col("_link._times").alias("_often")
        )
        sums = linked.join(F.broadcast(rated) if few else rated, "_pair").groupBy("_uid").agg(
            F.sum(F.when(F.col("best"), F.col("_often")).otherwise(F.lit(0))).alias("_best"),
            F.sum(F.col("_often") * F.col("documents")).alias("_sum"),
        )
        documents = rows.join(sums, "_uid", "left").select(
            F.col("_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
            F.coalesce("_best", F.lit(0)).cast("long").alias("n_best"),
            F.coalesce("_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256",
        )
        pairs = rated.select(
            F.shiftrightunsigned("_pair", 32).alias("a"), F.col("_pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "documents", "best"
        )
        return staged(documents, "align-documents", keep=True), staged(pairs, "align-linked", keep=True)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_documents(table(spark, sf_dir, "documents"), *paths)[0]
