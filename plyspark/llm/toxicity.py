"""Counterfactual-regularised toxicity classifier.

A logistic regression over the distinct words of a text. In labelled texts
that name a group, the name is swapped for each other name of its kind and
the change of the score is penalised, so that the label cannot hang on which
group a text mentions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plyspark.llm.common import blocks, flat_bytes, mix, small_batches, table, word_hashes, word_spans

#: Labelled rows that the fit uses at most (an even sample by identifier hash).
MAX_TRAINING_ROWS = 8_000
FEATURE_BITS = 18
THRESHOLD = 0.7
#: Words that occur in fewer training texts get no weight.
MIN_TEXTS = 5
#: Word beginnings (bytes) that are features besides whole words, so that
#: inflected and compound words share weight.
PREFIX_BYTES = (4, 5, 6, 7)
#: Features whose share of label 1 differs from the overall share by fewer
#: standard deviations get no weight.
MIN_DEVIATION = 3.0

# Names of groups, by kind; a name is swapped within its kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("woman", "man", "girl", "boy", "mother", "father"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("mexicans", "americans", "chinese", "indians", "russians", "germans"),
    ("mexican", "american", "chinese", "indian", "russian", "german"),
    ("blind", "deaf", "disabled", "autistic"),
)

_LETTERS = np.ones(256, bool)  # True: separates words
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def hashes_of(words: list[str]) -> np.ndarray:
    data, at = flat_bytes(pa.array(words, pa.string()))
    return word_hashes(data, at[:-1], at[1:])


def feature_ids(words: list[str], bits: int = FEATURE_BITS) -> np.ndarray:
    return (hashes_of(words) >> np.uint64(64 - bits)).astype(np.int64)


_NAMES = np.sort(hashes_of([name for kind in IDENTITY_TERMS for name in kind]))
_MAYBE_NAME = np.zeros(1 << 16, bool)
_MAYBE_NAME[(_NAMES >> np.uint64(48)).astype(np.int64)] = True


def are_names(hashes: np.ndarray) -> np.ndarray:
    """Which word hashes are those of names in ``IDENTITY_TERMS``."""
    found = _MAYBE_NAME[(hashes >> np.uint64(48)).astype(np.int64)]
    found[found] = np.isin(hashes[found], _NAMES)
    return found


def word_features(column: pa.Array, bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word and prefix features of each text, one after another, and each
    text's offsets in them. A group's name is one feature, without prefixes, so
    that all a text's score owes to the name is that one weight."""
    data, offsets = flat_bytes(column)
    start, end, first = word_spans(data, offsets, _LETTERS)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    shift = np.uint64(64 - bits)
    words = word_hashes(data, start, end)
    found = [text << bits | (words >> shift).astype(np.int64)]
    named = are_names(words)
    for size in PREFIX_BYTES:
        longer = (end - start > size) & ~named
        begin = start[longer]
        prefix = mix(word_hashes(data, begin, begin + size) + np.uint64(size)) >> shift
        found.append(text[longer] << bits | prefix.astype(np.int64))
    pairs = np.unique(np.concatenate([np.unique(f) for f in found]))
    return pairs & ((1 << bits) - 1), np.searchsorted(pairs >> bits, np.arange(len(offsets)))


def segment_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


def fit(features: np.ndarray, at: np.ndarray, labels: np.ndarray, swap_penalty: float = 1.0, l1: float = 5e-5, l2: float = 1e-6,
        steps: int = 250, bits: int = FEATURE_BITS, min_texts: int = MIN_TEXTS) -> tuple[np.ndarray, float]:
    """``(weights, bias)`` of the regularised regression, by Adam steps with
    soft thresholds. The score is linear in the features and a name is one of
    them (see ``word_features``), so swapping name ``a`` for ``b`` changes it by
    ``w[b] - w[a]``; the change counts by the share of texts that hold ``a``."""
    size, n = 1 << bits, max(len(labels), 1)
    texts = np.bincount(features, minlength=size)
    ones = np.bincount(features, weights=np.repeat(labels, np.diff(at)), minlength=size)
    rate = labels.mean() if len(labels) else 0.5
    deviation = np.abs(ones - texts * rate) / np.sqrt(np.maximum(texts * rate * (1 - rate), 1e-9))
    usable = (texts >= min_texts) & (deviation >= MIN_DEVIATION)
    swaps = []
    for kind in IDENTITY_TERMS:
        ids = feature_ids(list(kind), bits)
        usable[ids] |= texts[ids] > 0
        swaps += [(a, b, texts[a] / n) for a in ids for b in ids if a != b and texts[a]]
    keep = usable[features]
    owner = np.repeat(np.arange(len(labels)), np.diff(at))[keep]
    features = features[keep]
    at = np.searchsorted(owner, np.arange(len(labels) + 1))
    from_, to, share = (np.array(x) for x in zip(*swaps)) if swaps else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    weights, bias = np.zeros(size), 0.0
    first, second, b1, b2 = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(segment_sums(weights[features], at) + bias, -30, 30)))
        error = (p - labels) / n
        slope = np.bincount(features, weights=error[owner], minlength=size) + l2 * weights
        change = 2 * swap_penalty * share * (weights[to] - weights[from_])
        slope += np.bincount(to, weights=change, minlength=size) - np.bincount(from_, weights=change, minlength=size)
        first += 0.1 * (slope - first)
        second += 0.01 * (slope * slope - second)
        b1 += 0.1 * (error.sum() - b1)
        b2 += 0.01 * (error.sum() ** 2 - b2)
        pace = 0.15 * min(1.0, 2 * (1 - step / (steps + 1)))
        scale = pace / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        moved = weights - scale * first / (1 - 0.9**step)
        weights = np.sign(moved) * np.maximum(np.abs(moved) - l1 * scale, 0)
        bias -= pace * (b1 / (1 - 0.9**step)) / (np.sqrt(b2 / (1 - 0.99**step)) + 1e-6)
    return weights, float(bias)


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """``_text, _label`` of at most about ``most`` labelled documents: rows
    that are not held out, an even share of them by a hash of the identifier.
    The chosen identifiers, so many at most, are broadcast."""
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max(label).cast("double").alias("_label"))
    share = min(1.0, most / max(usable.count(), 1))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) < int(share * 1_000_000)).limit(2 * most)
    return docs.select("doc_id", F.col("text").alias("_text")).join(F.broadcast(chosen), "doc_id").select("_text", "_label")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MAX_TRAINING_ROWS) -> tuple[np.ndarray, float]:
    """Fit on a bounded sample of labelled rows (see ``training_sample``);
    only word features reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            features, at = word_features(batch.column(0))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(features, pa.int32()))
            yield pa.RecordBatch.from_arrays([lists, batch.column(1)], ["features", "label"])

    small_batches(docs.sparkSession)
    rows = training_sample(docs, labels, label, most).mapInArrow(run, "features array<int>, label double").toArrow()
    if not rows.num_rows:
        return np.zeros(1 << FEATURE_BITS), 0.0
    lists = rows.column(0).combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return fit(lists.flatten().to_numpy().astype(np.int64), offsets - offsets[0], rows.column(1).to_numpy())


def score_texts(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs``, without its text unless ``keep_text``, with ``score`` (probability of label 1). A
    null or empty text has no words and gets the model's base rate; every row
    is scored by itself, repeated ones alike."""
    weights, bias = model[0].astype(np.float32), model[1]
    rest = [c for c in docs.columns if (keep_text or c != text_col) and c != "score"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest") if rest else F.lit(0).alias("_rest"), F.col(text_col).cast("string").alias("_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            features, at = word_features(batch.column(1))
            score = 1 / (1 + np.exp(-np.clip(segment_sums(weights[features].astype(np.float64), at) + bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["_rest", "score"])

    small_batches(docs.sparkSession)
    scored = rows.mapInArrow(run, f"_rest {rows.schema['_rest'].dataType.simpleString()}, score double")
    return scored.select("_rest.*", "score") if rest else scored.select("score")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``, by a
    model fitted on ``labels`` of other rows (``held_out`` false). Without
    labels every score is 0.5; a null identifier is never learnt from and
    never held out. No rows give no rows."""
    scored = score_texts(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
