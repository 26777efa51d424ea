"""Personal data: fixed patterns, and a semi-Markov conditional random field.

Four patterns give the base spans. The field finds further ones: runs of
words around digits, @ and + are cut into segments by a dynamic programme over
whole spans, which are scored by features of the span as a whole (its shape,
its digit count, its cue words) and of neighbouring types. It is trained on
the base spans of a bounded sample of documents, so what it adds are spans
that look like these as a whole but miss a pattern's letter.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyspark.llm.common import blocks, small_batches, table

#: Kinds in the order of the results; the last one is the field's own.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
#: Words of an entity at most (a phone number has up to five).
MAX_WORDS = 5
#: Bounds of the training: documents, runs of words, runs of one document, words
#: and characters of a run (longer runs are not learnt from, but are decoded).
TRAINING_DOCUMENTS = 1_500
TRAINING_RUNS = 1_500
RUNS_OF_A_DOCUMENT = 2
WORDS_OF_A_RUN = 12
CHARACTERS_OF_A_RUN = 2_000
#: The shortest entity has seven characters; shorter runs hold none.
LEAST_CHARACTERS = 7
#: Margin in log odds by which a segment must beat being no entity.
MARGIN = 2.0

# The base patterns. Possessive runs and the walk back from "@" only save time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SECRET = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9_-]{32,}(?![A-Za-z0-9])")

_SIGN = re.compile(r"[0-9@+][^ \t-\r]*+")
_BETWEEN = re.compile(r"[ \t-\r]++(?:([^ \t-\r]++)[ \t-\r]++)?")
_TRIM_LEFT, _TRIM_RIGHT = "\"'<[{,;:=#$%&*|", "\"'>]},;:.!?=#$%&*|"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the four patterns, leftmost and not
    overlapping within a kind; matches that fail their test are dropped."""
    spans = []
    at = text.find("@")
    floor = 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            spans.append((0, start, found.end()))
            floor = found.end()
        at = text.find("@", max(at + 1, floor))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            spans.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, m.start(), m.end()))
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 8 <= len(_digits(m.group())) <= 15:
            spans.append((3, m.start(), m.end()))
        at = text.find("+", m.end() if m else at + 1)
    return spans


def run_words(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the words that hold a digit, @ or +. Every character is looked
    at a fixed number of times, also in one word of many megabytes."""
    floor = 0
    for m in _SIGN.finditer(text):
        before = max(text.rfind(c, floor, m.start()) for c in " \t\n\x0b\x0c\r")
        yield max(before + 1, floor), m.end()
        floor = m.end()


def runs(text: str) -> list[list[tuple[int, int]]]:
    """Spans of the words of each candidate run: words with a digit, @ or +,
    joined where at most one other word lies between, which is then a word of
    the run, whatever blanks are around it."""
    out: list[list[tuple[int, int]]] = []
    for span in run_words(text):
        between = _BETWEEN.fullmatch(text, out[-1][-1][1], span[0]) if out else None
        if between:
            out[-1] += [between.span(1), span] if between[1] else [span]
        else:
            out.append([span])
    return out


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in _TRIM_LEFT:
        start += 1
    while end > start and text[end - 1] in _TRIM_RIGHT:
        end -= 1
    return start, end


def span_features(text: str, start: int, end: int, words: int) -> list[str]:
    """Features of a whole span."""
    span = text[start:end]
    digits = sum("0" <= c <= "9" for c in span)
    letters = sum(c.isalpha() for c in span)
    rest = len(span) - digits - letters
    parts = span.split(".")
    shape = re.sub(r"(.)\1+", r"\1", re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", "9", span)))[:14]
    found = [
        "bias", f"words={words}", f"digits={min(digits, 24)}", f"shape={shape}", f"rest={min(rest, 5)}",
        f"length={min(len(span).bit_length(), 7)}", f"only={'d' * (digits > 0)}{'l' * (letters > 0)}{'r' * (rest > 0)}",
    ]
    if "@" in span:
        domain = span.rpartition("@")[2]
        found.append(f"at={span.count('@')},{'.' in domain and domain[-1:].isalnum()}")
    if span[:1] == "+":
        found.append("plus")
    if len(parts) == 4 and all(p.isdigit() and p.isascii() for p in parts):
        found.append(f"quad={all(len(p) <= 3 and int(p) <= 255 for p in parts)}")
    if 13 <= digits <= 19 and not letters:
        found.append(f"luhn={luhn(_digits(span))}")
    if len(span) >= 20 and rest == 0 and letters:
        found.append("long-mixed")
    before = text[max(0, start - 12) : start].lower()
    for cue in ("token", "key", "secret", "mail", "phone", "tel", "card", "ip"):
        if cue in before:
            found.append(f"cue={cue}")
    return found


class SemiMarkov:
    """Segment scores ``weights[feature][type]`` and ``moves[type][type]``;
    type 0 is no entity (one word), type ``k`` is ``KINDS[k - 1]``."""

    def __init__(self):
        self.weights: dict[str, np.ndarray] = {}
        self.moves = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def segments(self, text: str, words: list[tuple[int, int]]) -> list[list[tuple[int, list[str], np.ndarray]]]:
        """For each end the segments ``(first word, features, scores)``."""
        out = []
        for end in range(1, len(words) + 1):
            row = []
            for size in range(1, min(MAX_WORDS, end) + 1):
                a, b = trimmed(text, words[end - size][0], words[end - 1][1])
                if a >= b and size > 1:
                    continue
                features = span_features(text, a, b, size)
                score = np.zeros(len(KINDS) + 1)
                for f in features:
                    w = self.weights.get(f)
                    if w is not None:
                        score = score + w
                if size > 1:
                    score[0] = -np.inf
                row.append((end - size, features, score))
            out.append(row)
        return out

    def decode(self, text: str, words: list[tuple[int, int]], margin: float = MARGIN) -> list[tuple[int, int, int]]:
        """``(type, first word, last word + 1)`` of the best segmentation."""
        best = np.full((len(words) + 1, len(KINDS) + 1), -np.inf)
        best[0, 0] = 0
        back: list[list] = [[None] * (len(KINDS) + 1) for _ in range(len(words) + 1)]
        for end, row in enumerate(self.segments(text, words), 1):
            for first, _, score in row:
                reach = best[first][:, None] + self.moves
                come = reach.argmax(0)
                value = reach.max(0) + score
                value[1:] -= margin
                for kind in np.flatnonzero(value > best[end]):
                    best[end, kind], back[end][kind] = value[kind], (first, int(come[kind]))
        out, end, kind = [], len(words), int(best[-1].argmax())
        while end:
            first, come = back[end][kind]
            if kind:
                out.append((kind, first, end))
            end, kind = first, come
        return out[::-1]

    def learn(self, examples: list[tuple[str, list[tuple[int, int]], dict]], steps: int = 12, rate: float = 0.3) -> None:
        """Gradient steps on the likelihood of gold segments ``{(first, last
        + 1): type}``; other words are type 0. Forward and backward sums over
        all segmentations give the expected feature counts."""
        kinds = len(KINDS) + 1
        for step in range(steps):
            pace = rate / (1 + step / 4)
            for text, words, gold in examples:
                table_ = self.segments(text, words)
                n = len(words)
                ahead = np.full((n + 1, kinds), -np.inf)
                ahead[0, 0] = 0
                for end, row in enumerate(table_, 1):
                    for first, _, score in row:
                        into = np.logaddexp.reduce(ahead[first][:, None] + self.moves, axis=0) + score
                        ahead[end] = np.logaddexp(ahead[end], into)
                after = np.full((n + 1, kinds), -np.inf)
                after[n] = 0
                for end in range(n, 0, -1):
                    for first, _, score in table_[end - 1]:
                        out = np.logaddexp.reduce(self.moves + (score + after[end])[None, :], axis=1)
                        after[first] = np.logaddexp(after[first], out)
                total = np.logaddexp.reduce(ahead[n])
                taken = {**gold}
                covered = {k for a, b in gold for k in range(a, b)}
                taken.update({(k, k + 1): 0 for k in range(n) if k not in covered})
                slope = np.zeros((kinds, kinds))
                for end, row in enumerate(table_, 1):
                    for first, features, score in row:
                        pair = np.exp(ahead[first][:, None] + self.moves + (score + after[end])[None, :] - total)
                        expected = pair.sum(0)
                        expected[~np.isfinite(expected)] = 0
                        slope -= np.nan_to_num(pair)
                        change = -expected
                        if (first, end) in taken:
                            change[taken[first, end]] += 1
                        if np.abs(change).max() > 1e-3:
                            for f in features:
                                old = self.weights.get(f)
                                self.weights[f] = pace * change if old is None else old + pace * change - pace * 1e-4 * old
                kind = 0
                for (_, _), to in sorted(taken.items()):
                    slope[kind, to] += 1
                    kind = to
                self.moves += pace * np.clip(slope, -1, 1)


def silver(text: str) -> list[tuple[list[tuple[int, int]], dict]]:
    """Training runs of a text: base spans and long keys that fill whole
    words (but for punctuation) are the gold segments."""
    spans = base_spans(text) + [(4, m.start(), m.end()) for m in _SECRET.finditer(text) if any(c.isdigit() for c in m.group())]
    by_span = {}
    for kind, a, b in spans:
        by_span[a, b] = kind + 1
    out = []
    for words in runs(text):
        gold, used = {}, set()
        for first in range(len(words)):
            for last in range(first + 1, min(first + MAX_WORDS, len(words)) + 1):
                kind = by_span.get(trimmed(text, words[first][0], words[last - 1][1]))
                if kind and not used & set(range(first, last)):
                    gold[first, last] = kind
                    used |= set(range(first, last))
        out.append((words, gold))
    return out


def train(docs: DataFrame, text_col: str = "text") -> SemiMarkov:
    """Fit on the first ``RUNS_OF_A_DOCUMENT`` runs (of ``WORDS_OF_A_RUN`` words
    at most) of about ``TRAINING_DOCUMENTS`` distinct texts at most; what
    reaches the driver is ``TRAINING_RUNS`` distinct parts of texts around
    runs, the first by hash, so that reruns train on the same ones."""
    model = SemiMarkov()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for text in batch.column(0).to_pylist():
                found = runs(text)
                for words in found[:RUNS_OF_A_DOCUMENT]:
                    if len(words) <= WORDS_OF_A_RUN and words[-1][1] - words[0][0] <= CHARACTERS_OF_A_RUN:
                        parts.append(text[max(0, words[0][0] - 20) : words[-1][1] + 20])
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string())], ["part"])

    small_batches(docs.sparkSession)
    sample = docs.select(F.col(text_col).cast("string").alias("_text")).where(F.col("_text").rlike(r"[0-9@]"))
    sample = sample.withColumn("_at", F.xxhash64("_text")).where("_text IS NOT NULL")
    n = sample.agg(F.approx_count_distinct("_at")).first()[0]
    share = min(1.0, TRAINING_DOCUMENTS / max(n, 1))
    chosen = sample.where(F.pmod("_at", F.lit(1_000_000)) < int(share * 1_000_000)).select("_text").distinct()
    parts = chosen.mapInArrow(run, "part string").distinct().orderBy(F.md5(F.col("part").cast("binary")), "part").limit(TRAINING_RUNS)
    examples = [(r["part"], words, gold) for r in parts.collect() for words, gold in silver(r["part"]) if len(words) <= WORDS_OF_A_RUN + 4]
    model.learn(examples)
    return model


def find_spans(text: str, model: SemiMarkov) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and those that the field adds: they overlap no base span."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in taken], np.int64)
    ends = np.maximum.accumulate(np.array([b for _, b in taken], np.int64)) if taken else np.zeros(0, np.int64)
    added = []
    for words in runs(text):
        if sum(b - a for a, b in words) < LEAST_CHARACTERS:
            continue
        for kind, first, last in model.decode(text, words):
            a, b = trimmed(text, words[first][0], words[last - 1][1])
            k = int(np.searchsorted(starts, b))
            if a < b and not (k and ends[k - 1] > a):
                added.append((kind - 1, a, b))
    return base, added


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: SemiMarkov | None = None) -> DataFrame:
    """``id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans,
    found`` of every row; ``found`` is the spans as an array of ``(kind,
    start, end)``, in code points, end exclusive.

    Rows stand for themselves, repeated ones alike; null or empty text has no
    spans. Other columns are ignored. Runs of any length are decoded in time
    in proportion to it; those under ``LEAST_CHARACTERS`` hold no entity of
    the field. No rows give no rows.
    """
    model = model or train(docs, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            out: list[list] = [[] for _ in range(7)]
            for text in batch.column(1).to_pylist():
                base, added = find_spans(text or "", model)
                for column, kind in zip(out, range(4)):
                    column.append(sum(k == kind for k, _, _ in base))
                out[4].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out[5].append(joined(base + added))
                out[6].append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(base + added)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, pa.int64()) for c in out[:4]] + [pa.array(c, pa.string()) for c in out[4:6]]
                + [pa.array(out[6], pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))],
                [id_col, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "found"],
            )

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(
        run,
        f"`{id_col}` {id_type}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
        "found array<struct<kind:string,start:bigint,end:bigint>>",
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents")).drop("found")
