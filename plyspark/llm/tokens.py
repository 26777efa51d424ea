"""Tokenising flat text with the ``tokenizers`` library, word by word.

Where a vocabulary drops white space, a text's ids are its words' ids one
after another. Words are hashed in bulk, and only those a worker has not met
lately go through the library.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
from tokenizers import Tokenizer

from plyspark.llm.common import IS_SEPARATOR, word_hashes, word_spans

#: Words whose ids a worker keeps (about 30 bytes each); beyond it the store
#: starts anew.
KEPT_WORDS = 1_500_000
#: Longest word (bytes) merged in bulk; longer ones go through the library.
BULK_BYTES = 32
#: Text bytes hashed and looked up at once: the arrays for it take about 40
#: times as much, whatever the length of a text.
PIECE_BYTES = 1 << 19
_PROBES = ("a b", "Don't stop, it's 42!", "x  y\nz\tw .", "Été über á e")
_open: dict[str, "FlatTokenizer"] = {}


class PairTable:
    """Merge rank and result of a pair of ids, looked up for whole arrays: a
    hash table without chains, and a smaller one for what collides there."""

    SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray):
        self.levels = []
        for salt, bits in zip(self.SALTS, (20, 16, 12)):
            keys, values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
            slot = self._slot(pairs, salt, bits)
            _, first = np.unique(slot, return_index=True)
            keys[slot[first]], values[slot[first]] = pairs[first], ranks[first]
            self.levels.append((salt, bits, keys, values))
            pairs, ranks = np.delete(pairs, first), np.delete(ranks, first)
        self.complete = len(pairs) == 0

    @staticmethod
    def _slot(pairs: np.ndarray, salt: int, bits: int) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(salt)) >> np.uint64(64 - bits)).astype(np.int64)

    def ranks(self, pairs: np.ndarray) -> np.ndarray:
        """The rank of each pair; a large number for those that don't merge."""
        out = np.full(pairs.shape, 1 << 30, np.int32)
        for salt, bits, keys, values in self.levels:
            slot = self._slot(pairs, salt, bits)
            hit = keys[slot] == pairs
            out[hit] = values[slot[hit]]
        return out


class BulkMerger:
    """Byte-pair merges of many words at once, for vocabularies of bytes with
    a word-end mark: in each step every word merges its best pair."""

    def __init__(self, library: Tokenizer):
        model = json.loads(library.to_str())["model"]
        vocab, mark = model["vocab"], model.get("end_of_word_suffix")
        self.usable = model["type"] == "BPE" and bool(mark) and library.get_vocab_size() <= 1 << 16
        if not self.usable:
            return
        # The public byte alphabet: printable Latin-1 stands for itself, the rest for 256 and up.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        letter = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
        self.inner = np.array([vocab[letter[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letter[b] + mark] for b in range(256)], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        self.result = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.table = PairTable(left << 16 | right, np.arange(len(merges), dtype=np.int32))
        self.usable = self.table.complete

    def merge(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``words``: bytes ``(n, width)``, zero-padded. Returns their ids,
        row by row in the same shape, and how many each row has."""
        ids = self.inner[words]
        rows = np.arange(len(words))
        ids[rows, sizes - 1] = self.last[words[rows, sizes - 1]]
        count = sizes.copy()
        column = np.arange(words.shape[1] - 1)
        rank = self.table.ranks(ids[:, :-1] << 16 | ids[:, 1:])
        rank[column >= count[:, None] - 1] = 1 << 30
        live = rows
        while len(live):
            best = rank.argmin(1)
            low = rank[np.arange(len(live)), best]
            go = low < 1 << 30
            live, best, low, rank = live[go], best[go], low[go], rank[go]
            if not len(live):
                break
            now = ids[live]
            shift = np.minimum(np.arange(now.shape[1]) + (np.arange(now.shape[1]) > best[:, None]), now.shape[1] - 1)
            now = np.take_along_axis(now, shift, 1)
            at = np.arange(len(live))
            now[at, best] = self.result[low]
            ids[live] = now
            count[live] -= 1
            rank = np.take_along_axis(rank, np.minimum(shift[:, :-1], rank.shape[1] - 1), 1)
            ends = count[live] - 1
            for k in (best - 1, best):
                ok = (k >= 0) & (k < ends)
                rank[at[ok], k[ok]] = self.table.ranks(now[at[ok], k[ok]] << 16 | now[at[ok], k[ok] + 1])
            rank[column >= ends[:, None]] = 1 << 30
        return ids, count


class FlatTokenizer:
    """Token ids (no special tokens added) of many texts at once."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.by_word = all(self._ids(p) == [i for w in p.split() for i in self._ids(w)] for p in _PROBES)
        self.fold = self._ids("Abc DEF") == self._ids("abc def")
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self._forget()
        self.merger = BulkMerger(self.library) if self.by_word and self.fold else None
        if self.merger is not None:
            known = sorted({w.removesuffix("</w>").lower() for w in self.library.get_vocab()})
            parts = [w for w in known if w.isascii() and w.isalpha()][::23]
            sample = [a + b for a, b in zip(parts, parts[7:]) if len(a + b) <= BULK_BYTES]
            if not self.merger.usable or self._words(sample)[0].tolist() != [i for w in sample for i in self._ids(w)]:
                self.merger = None

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.begin, self.count = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pool = np.zeros(1 << 20, self.dtype)
        self.used = 0

    def _bulk(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain lower-case words, ``(words, widest)`` and zero-padded,
        and how many each has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = np.zeros((len(words), int(sizes.max(initial=1)) + 1), self.dtype)
        count = np.zeros(len(words), np.int64)
        order = np.argsort(sizes, kind="stable")
        for at in range(0, len(words), 10_000):  # words of like length together
            part = order[at : at + 10_000]
            width = int(sizes[part[-1]]) + 1
            grid = np.frombuffer(b"".join([words[i].ljust(width, b"\0") for i in part.tolist()]), np.uint8)
            ids[part, :width], count[part] = self.merger.merge(grid.reshape(-1, width), sizes[part])
        return ids, count

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each has. Plain
        words (Latin letters, then at most one stop or comma) are merged in
        bulk, the others by the library."""
        plain, at, tail, odd = [], [], [], list(range(len(words)))
        if self.merger is not None:
            odd = []
            for i, word in enumerate(words):
                end = word[-1]
                body = word[:-1] if end == "." or end == "," else word
                if body.isalpha() and (body.isascii() or max(body) < "\u0100") and len(raw := body.lower().encode()) <= BULK_BYTES:
                    plain.append(raw)
                    at.append(i)
                    tail.append(end if body is not word else "")
                else:
                    odd.append(i)
        rest = [e.ids for e in self.library.encode_batch_fast([words[i] for i in odd], add_special_tokens=False)]
        sizes = np.zeros(len(words), np.int64)
        sizes[odd] = [len(ids) for ids in rest]
        if plain:
            ids, count = self._bulk(plain)
            for c in ".,":
                rows = np.array([k for k, t in enumerate(tail) if t == c], np.int64)
                for i in self._ids(c):
                    ids[rows, count[rows]] = i
                    count[rows] += 1
            sizes[at] = count
        begin = np.cumsum(sizes) - sizes
        flat = np.zeros(int(sizes.sum()), self.dtype)
        for i, found in zip(odd, rest):
            flat[begin[i] : begin[i] + len(found)] = found
        if plain:
            inside = np.arange(ids.shape[1]) < count[:, None]
            flat[(begin[at][:, None] + np.arange(ids.shape[1]))[inside]] = ids[inside]
        return flat, sizes

    def _learn(self, keys: np.ndarray, place: np.ndarray, words: list[str]) -> None:
        flat, sizes = self._words(words)
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(flat)), self.dtype)])
        self.pool[self.used : self.used + len(flat)] = flat
        begin = self.used + np.cumsum(sizes) - sizes
        self.known = np.insert(self.known, place, keys)
        self.begin = np.insert(self.begin, place, begin.astype(np.int32))
        self.count = np.insert(self.count, place, sizes.astype(np.int32))
        self.used += len(flat)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and each text's offsets in
        them (``n + 1``). ``data`` is UTF-8. Texts of any length are taken in
        pieces cut between words."""
        if not self.by_word or len(data) <= 2 * PIECE_BYTES:
            return self._encode(data, offsets)
        ids, sizes = [], np.zeros(len(offsets) - 1, np.int64)
        for a, b in word_pieces(data):
            found, at = self._encode(data[a:b], np.clip(offsets, a, b) - a)
            ids.append(found)
            sizes += np.diff(at)
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(sizes)])

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        if not self.by_word:
            lists = [self._ids(raw[a:b].decode()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            sizes = np.array([0, *map(len, lists)], np.int64)
            return np.array([i for ids in lists for i in ids], self.dtype), np.cumsum(sizes)
        special = b"<|" in raw  # such tokens are found before lower-casing
        start, end, first = word_spans(data, offsets)
        hashes = word_hashes(data, start, end, self.fold and not special)
        if special:
            hashes = ~hashes
        if not len(hashes):
            return np.zeros(0, self.dtype), np.zeros(len(offsets), np.int64)
        if len(self.known) > KEPT_WORDS:
            self._forget()
        unique, sample, where = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, unique)
        met = np.zeros(len(unique), bool)
        inside = place < len(self.known)
        met[inside] = self.known[place[inside]] == unique[inside]
        new = np.flatnonzero(~met)
        if len(new):
            spans = zip(start[sample[new]].tolist(), end[sample[new]].tolist())
            self._learn(unique[new], place[new], [raw[a:b].decode() for a, b in spans])
            place = np.searchsorted(self.known, unique)
        slot = place[where]
        sizes = self.count[slot].astype(np.int64)
        ends = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.begin[slot] - (ends - sizes), sizes) + np.arange(ends[-1])]
        return ids, np.concatenate([[0], ends])[first]


def word_pieces(data: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Cut a buffer before white space into pieces of about ``most`` bytes (a
    longer word stays whole)."""
    most = most or PIECE_BYTES
    at = 0
    while at < len(data):
        end = at + most
        while end < len(data):
            found = np.flatnonzero(IS_SEPARATOR[data[end : end + most]])
            end += int(found[0]) if len(found) else most
            if len(found):
                break
        end = min(end, len(data))
        yield at, end
        at = end


def tokenizer(path: str) -> FlatTokenizer:
    """This worker's tokenizer of ``path``."""
    if path not in _open:
        _open.clear()
        _open[path] = FlatTokenizer(path)
    return _open[path]
