"""N-gram Jaccard join by prefixes under several global token orders.

Two sets that are similar enough share a token in the first quarter of their
tokens, whatever global order the tokens are in. Candidates must share such
a token under each of three orders (frequent tokens last in all of them,
hashes otherwise). The first order's shared tokens are joined; before their
sets are fetched, pairs must pass bounds by size, by how many tokens of their
prefixes any other set shares, and by bitmaps. Pairs that share a prefix token
in the other two orders as well are verified on the whole sets.

Equal sets are one class from the start. Links are only needed between
classes that are not connected yet, so each bucket of a prefix token is first
compared with a pivot in a few star rounds, which joins groups of near
copies, and only then pairs of classes in different components are formed:
those outside a bucket's largest component, with all others. In a bucket with
many such pairs, classes that would link must also share a token in which they
differ from the bucket's pivot (``deviations``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plyspark.llm.common import blocks, discard, flat_bytes, mix, scratch, small_batches, staged, table, word_hashes, word_spans

WORDS = 5
#: Link when 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
#: Tokens are 53-bit hashes; a block has at most 2 ** ROW_BITS rows.
TOKEN_BITS, ROW_BITS = 53, 10
#: The most frequent tokens come last in every order; so many at most are
#: sent to the tasks. Which tokens these are only affects speed.
FREQUENT_TOKENS = 100_000
#: Documents of one block that must share a token for it to count as frequent.
FREQUENT_IN_BLOCK = 3
SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)
#: Bins of a set's sketch: a bit each, or a count (up to 255) each in sets of
#: more than ``BIT_TOKENS`` tokens, where bits would mostly be set.
BINS, BIT_TOKENS = 2048, 1000
STAR_ROUNDS = 3
#: With more pairs of classes a bucket's classes are compared by their
#: deviations from its pivot; up to it, these are 32 pairs a class at most.
BUCKET_PAIRS = 1024
#: Only classes that are about so similar to the pivot by their sketches, as
#: others deviate in most of their tokens, and of pivots with so many of these
#: at least. Other pairs are formed one by one.
RELATED, RELATED_CLASSES = 50, 128
#: What a row of ``deviations`` is for.
NEAR, PROBE, INDEX = 0, 1, 2
#: A pivot's set is sent once for so many classes.
PIVOT_CLASSES = 256
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def shingle_sets(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (hashes, ascending) of each text, one after another,
    and each text's offsets in them. A text of fewer words is one shingle."""
    data, offsets = flat_bytes(column)
    start, end, first = word_spans(data, offsets)
    hashes = word_hashes(data, start, end)
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    last = first[1:][owner] if len(owner) else owner
    place = np.arange(len(hashes))
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    total, whole = np.zeros(len(hashes), np.uint64), place + words <= last
    short = (np.diff(first) < words)[owner] if len(owner) else np.zeros(0, bool)
    for k in range(words):
        total = total * _MIX + np.where(place + k < last, padded[k : k + len(hashes)], 0)
    use = whole | (short & (place == first[:-1][owner])) if len(owner) else whole
    tokens = mix(total[use] + short[use].astype(np.uint64)) >> np.uint64(64 - TOKEN_BITS)
    pairs = np.unique(owner[use].astype(np.uint64) << np.uint64(TOKEN_BITS) | tokens)
    return pairs & np.uint64((1 << TOKEN_BITS) - 1), np.searchsorted(pairs >> np.uint64(TOKEN_BITS), np.arange(n + 1, dtype=np.uint64))


def set_classes(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for each set, equal for equal sets."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens + np.uint64(SEEDS[0])))])
    return mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64)


def prefix_size(n: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    return n - -(-n * threshold // 100) + (n > 0)


def prefixes(tokens: np.ndarray, at: np.ndarray, seed: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of each set in the order of ``seed``, named by their
    place in it, and each set's offsets in them."""
    key = mix(tokens ^ np.uint64(seed)) >> np.uint64(64 - TOKEN_BITS + 1)
    if len(frequent):
        maybe = np.zeros(1 << 20, bool)
        shift = np.uint64(TOKEN_BITS - 20)
        maybe[(frequent >> shift).astype(np.int64)] = True
        rows = np.flatnonzero(maybe[(tokens >> shift).astype(np.int64)])
        found = frequent[np.minimum(np.searchsorted(frequent, tokens[rows]), len(frequent) - 1)] == tokens[rows]
        key[rows[found]] |= np.uint64(1 << (TOKEN_BITS - 1))
    n = np.diff(at)
    owner = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    ordered = np.sort(owner << np.uint64(TOKEN_BITS) | key)
    first = np.arange(len(ordered)) - np.repeat(at[:-1], n) < np.repeat(prefix_size(n), n)
    return (ordered[first] & np.uint64((1 << TOKEN_BITS) - 1)), np.concatenate([[0], np.cumsum(prefix_size(n))])


def packed(values: np.ndarray, at: np.ndarray) -> pa.Array:
    raw = values.tobytes()
    return pa.array([raw[8 * a : 8 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())


def sketches(tokens: np.ndarray, at: np.ndarray) -> list[bytes]:
    """Bins of each set, see ``BINS``."""
    n = np.diff(at)
    owner = np.repeat(np.arange(len(n)), n)
    bins = (mix(tokens) % np.uint64(BINS)).astype(np.int64)
    small = n <= BIT_TOKENS
    bits = np.zeros((len(n), BINS), bool)
    bits[owner, bins] = True
    out = [m.tobytes() for m in np.packbits(bits, axis=1)]
    for row in np.flatnonzero(~small).tolist():
        out[row] = np.minimum(np.bincount(bins[at[row] : at[row + 1]], minlength=BINS), 255).astype(np.uint8).tobytes()
    return out


def least_difference(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Tokens by which the sets of two sketches differ at least: those that
    bins differ by, counts taken as bits where one side has bits."""
    out = np.zeros(len(a), np.int64)
    counts = np.array([(len(x) == BINS) + 2 * (len(y) == BINS) for x, y in zip(a, b)], np.int64)
    for kind in range(4):
        rows = np.flatnonzero(counts == kind)
        for low in range(0, len(rows), 1024):
            part = rows[low : low + 1024].tolist()
            if not part:
                continue
            x, y = (np.frombuffer(b"".join(side[i] for i in part), np.uint8).reshape(len(part), -1) for side in (a, b))
            if kind == 3:
                out[part] = np.abs(x.astype(np.int16) - y).sum(1, dtype=np.int64)
            else:
                x, y = (np.packbits(z > 0, axis=1) if z.shape[1] == BINS else z for z in (x, y))
                out[part] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return out


def likeness(a: list[bytes], b: list[bytes], n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity of the sets of two sketches in percent, estimated: from
    products of counts, of which sets without a common token have ``n_a * n_b /
    BINS`` by chance, or else from how many bins the union leaves empty."""
    common = np.zeros(len(a))
    counts = np.array([len(x) == BINS and len(y) == BINS for x, y in zip(a, b)], bool)
    for kind in (False, True):
        rows = np.flatnonzero(counts == kind)
        for low in range(0, len(rows), 1024):
            part = rows[low : low + 1024]
            sides = [[np.frombuffer(side[i], np.uint8) for i in part.tolist()] for side in (a, b)]
            n, product = (n_a + n_b)[part], n_a[part] * n_b[part]
            if kind:
                x, y = (np.stack(side).astype(np.float32) for side in sides)
                common[part] = ((x * y).sum(1, dtype=np.float64) - product / BINS) / (1 - 1 / BINS)
            else:
                x, y = (np.stack([np.packbits(z > 0) if len(z) == BINS else z for z in side]) for side in sides)
                empty = np.maximum(BINS - np.bitwise_count(x | y).sum(1, dtype=np.int64), 0.5)
                common[part] = n + BINS * np.log(empty / BINS)
    common = np.clip(common, 0, np.minimum(n_a, n_b))
    return 100 * common / np.maximum(n_a + n_b - common, 1)


def describe(docs: DataFrame) -> DataFrame:
    """``doc, n, value`` (the class) and ``bitmap`` of ``docs(doc, text)``,
    and besides, with ``is_token``, tokens as ``value`` that ``n`` classes of
    a block share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            tokens, at = shingle_sets(batch.column(1))
            classes, n = set_classes(tokens, at), np.diff(at)
            _, firsts = np.unique(classes, return_index=True)
            one = np.zeros(len(n), bool)
            one[firsts] = True
            counted = np.sort(tokens[np.repeat(one, n)])
            new = np.flatnonzero(np.append(True, counted[1:] != counted[:-1])) if len(counted) else np.zeros(0, np.int64)
            many = np.diff(np.append(new, len(counted)))
            often = many >= FREQUENT_IN_BLOCK
            a, b = batch.num_rows, int(often.sum())
            maps = sketches(tokens, at)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([batch.column(0), pa.nulls(b, pa.int64())]),
                 pa.array(np.concatenate([n, many[often]]), pa.int64()),
                 pa.array(np.concatenate([classes, counted[new[often]].view(np.int64)])),
                 pa.array(np.arange(a + b) >= a), pa.array(maps + [None] * b, pa.binary())],
                ["doc", "n", "value", "is_token", "bitmap"],
            )

    return docs.select("doc", "text").mapInArrow(run, "doc long, n long, value long, is_token boolean, bitmap binary")


def prefix_rows(docs: DataFrame, frequent: np.ndarray, seed: int = SEEDS[0]) -> DataFrame:
    """``token, class, n``: the prefix of each set of ``docs(doc, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            tokens, at = shingle_sets(batch.column(1))
            classes, n = set_classes(tokens, at), np.diff(at)
            keys, ends = prefixes(tokens, at, seed, frequent)
            size = np.diff(ends)
            _, firsts = np.unique(classes, return_index=True)
            one = np.zeros(len(n), bool)
            one[firsts] = True
            use = np.repeat(one, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[use].view(np.int64)), pa.array(np.repeat(classes, size)[use]), pa.array(np.repeat(n, size)[use])],
                ["token", "class", "n"],
            )

    return docs.select("doc", "text").mapInArrow(run, "token long, class long, n long")


def full_sets(docs: DataFrame) -> DataFrame:
    """``class, tokens`` of ``docs(doc, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            tokens, at = shingle_sets(batch.column(1))
            yield pa.RecordBatch.from_arrays([pa.array(set_classes(tokens, at)), packed(tokens, at)], ["class", "tokens"])

    return docs.select("doc", "text").mapInArrow(run, "class long, tokens binary")


def by_bitmap(pairs: DataFrame, maps: DataFrame, alike: int | None = None) -> DataFrame:
    """``pairs(a, b)`` that can link going by their sketches; with ``alike``
    those that are about so similar, which may miss some and take others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            sides = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            if alike is None:
                # 100 i >= t u with u = i + d and n = 2 i + d: d <= n (100 - t) / (100 + t)
                ok = least_difference(*sides) * (100 + THRESHOLD) <= (n_a + n_b) * (100 - THRESHOLD)
            else:
                ok = likeness(*sides, n_a, n_b) >= alike
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    side = maps.select("class", "n", "bitmap")
    both = pairs.join(side.toDF("a", "n_a", "map_a"), "a").join(side.toDF("b", "n_b", "map_b"), "b")
    return both.select("a", "b", "n_a", "n_b", "map_a", "map_b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``pairs(a, b)`` that share a prefix token in the other orders too, and
    then link by their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(iter([whole])):
                sides = []
                for k in (2, 3):
                    data, ends = flat_bytes(batch.column(k))
                    tokens, at = data.copy().view(np.uint64), ends // 8
                    sides.append([(tokens, at)] + [prefixes(tokens, at, seed, frequent) for seed in SEEDS[1:]])
                ok = []
                for row in range(batch.num_rows):
                    parts = [[t[at[row] : at[row + 1]] for t, at in side] for side in sides]
                    share = all(len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(parts[0][1:], parts[1][1:]))
                    x, y = parts[0][0], parts[1][0]
                    both = len(np.intersect1d(x, y, assume_unique=True)) if share else 0
                    ok.append(share and 100 * both >= THRESHOLD * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def deviation_prefixes(base: np.ndarray, tokens: np.ndarray, frequent: np.ndarray) -> tuple[int, np.ndarray, int | None, int, list[int]]:
    """How a set differs from the pivot ``base`` (both ascending): its excess,
    the tokens that only one of the two has in a common order, the level and
    length of the prefix by which it looks for others (level ``None`` where it
    links with the pivot, length 0 where nothing can link), and the lengths of
    those by which it is found, by level.

    Sets x and y differ by ``|dx| + |dy| - 2 |dx & dy|`` tokens, dx and dy being
    their deviations, and link if that is at most ``(|x| + |y|) (100 - t) /
    (100 + t)``. With ``F(x) = (100 + t) |dx| - (100 - t) |x|`` they thus share
    ``(F(x) + F(y)) / (2 (100 + t))`` deviations at least. x links with the
    pivot if ``F(x) <= H = (100 - t) |pivot|``; no F is below ``-H``. So if x does
    not, that is above 0 for every y, and at least ``(F(x) - H) / 200`` as y has
    no fewer deviations than are shared. Of two sets the one with the larger F
    looks for the other, at the level of ``F - H``, whose lower bound the other
    one's prefix is made for.
    """
    add, drop = np.setdiff1d(tokens, base, assume_unique=True), np.setdiff1d(base, tokens, assume_unique=True)
    kind = np.zeros(len(add), bool)
    if len(frequent) and len(add):
        kind = frequent[np.minimum(np.searchsorted(frequent, add), len(frequent) - 1)] == add
    key = mix(np.concatenate([add, drop]) ^ np.uint64(SEEDS[0]))
    order = np.lexsort((key, np.concatenate([kind.astype(np.int8), np.full(len(drop), 2, np.int8)])))
    one, d = 100 + THRESHOLD, len(key)
    excess, least = one * d - (100 - THRESHOLD) * len(tokens), (100 - THRESHOLD) * len(base)
    over = excess - least
    level = max(over // one, 1).bit_length() - 1 if over > 0 else None
    found, at = [], level or 0
    while True:
        shared = max(1, -(-(least + excess + (one << at if at else 1)) // (2 * one)))
        if shared > d:
            break
        found.append(d - shared + 1)
        at += 1
    return excess, key[order], level, max(0, d - max(1, -(-over // 200)) + 1), [0] * (level or 0) + found


def deviations(members: DataFrame, sets: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``role, key, class, n, s, component, excess, pivot`` of
    ``members(pivot, of_pivot, class, n, s, component)``: a row (``NEAR``) of
    a class that links with its pivot of another component, and a row a prefix
    token (``PROBE``, ``INDEX``): linked classes of one pivot, not both of
    which link with it, meet in a ``key`` of a probe and an index row."""

    def prefix_keys(base: np.ndarray, tokens: np.ndarray, pivot: np.ndarray, other: bool) -> Iterator[tuple[int, int, np.ndarray]]:
        excess, ordered, level, look, found = deviation_prefixes(base, tokens, frequent)
        if level is None and other:
            yield NEAR, excess, np.zeros(1, np.uint64)
        if level is not None and look:
            yield PROBE, excess, mix(ordered[:look] + mix(mix(pivot + np.uint64(level))))
        for at, many in enumerate(found):
            if many:
                yield INDEX, excess, mix(ordered[:many] + mix(mix(pivot + np.uint64(at))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(iter([whole])):
                (x, x_at), (y, y_at) = ((data.copy().view(np.uint64), ends // 8) for data, ends in map(flat_bytes, (batch.column(6), batch.column(7))))
                pivot, other = batch.column(0).to_numpy(), batch.column(1).to_numpy() != batch.column(5).to_numpy()
                about = batch.select(["class", "n", "s", "component", "pivot"])
                held, size = [], 0
                for row in range(batch.num_rows):
                    sides = x[x_at[row] : x_at[row + 1]], y[y_at[row] : y_at[row + 1]]
                    for role, excess, keys in prefix_keys(*sides, pivot[row : row + 1].view(np.uint64), bool(other[row])):
                        held.append((row, role, excess, keys))
                        size += len(keys)
                        if size >= 1 << 16:
                            yield laid_out(about, held)
                            held, size = [], 0
                if held:
                    yield laid_out(about, held)

    def laid_out(about: pa.RecordBatch, held: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
        sizes = [len(keys) for *_, keys in held]
        row, role, excess = (np.repeat(np.array(side, np.int64), sizes) for side in list(zip(*held))[:3])
        kept = about.take(pa.array(row))
        return pa.RecordBatch.from_arrays(
            [pa.array(role.astype(np.int32)), pa.array(np.concatenate([keys for *_, keys in held]).view(np.int64)),
             *(kept.column(c) for c in ("class", "n", "s", "component")), pa.array(excess), kept.column("pivot")],
            ["role", "key", "class", "n", "s", "component", "excess", "pivot"],
        )

    # A pivot may have most of the classes: they are dealt to several tasks.
    copies = members.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / PIVOT_CLASSES).cast("int").alias("copies"))
    bases = copies.join(sets.toDF("pivot", "base"), "pivot").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    dealt = members.join(copies, "pivot").withColumn("salt", F.pmod(F.xxhash64("class"), F.col("copies")).cast("int"))
    both = dealt.join(sets, "class").join(bases, ["pivot", "salt"])
    return both.select("pivot", "of_pivot", "class", "n", "s", "component", "base", "tokens").mapInArrow(
        run, "role int, key long, class long, n long, s long, component long, excess long, pivot long"
    )


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``class, component`` of all classes in ``links(a, b)``: the smallest
    class that links reach. Each step points classes at the smallest label
    among their neighbours and then at that label's label, until none moves."""
    edges = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = staged(edges.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("class"), F.least("a", "near").alias("component")), f"{name}-0")
    while True:
        near = edges.join(labels.select(F.col("class").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "class"), "class").select(
            "class", F.col("component").alias("old"), F.least("component", "near").alias("label"))
        jump = labels.select(F.col("class").alias("label"), F.col("component").alias("of_label"))
        step = step.join(jump, "label").select("class", "old", F.least("label", "of_label").alias("component"))
        step = staged(step, f"{name}-step")
        discard(labels)
        labels = step.select("class", "component")
        if not step.where("old <> component").limit(1).count():
            return labels


def size_bounds() -> Column:
    """Whether sizes allow ``(a, n_a, s_a, b, n_b, s_b)`` to link. Of the
    common tokens, those outside the prefix of the set whose prefix ends first
    in the order are as many as that set has there at most; the others are
    shared tokens of both prefixes (``s`` of them)."""
    n_a, n_b = F.col("n_a"), F.col("n_b")
    outside = [F.floor(n * THRESHOLD / 100 + F.lit(0.999999)) - 1 for n in (n_a, n_b)]
    near = 100 * F.least(n_a, n_b) >= THRESHOLD * F.greatest(n_a, n_b)
    enough = (100 + THRESHOLD) * (F.least("s_a", "s_b") + F.greatest(*outside)) >= THRESHOLD * (n_a + n_b)
    return near & enough & (F.col("a") != F.col("b"))


def once(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, n_shingles, component_id``.

    Words are split at space and \\x09-\\x0D, A-Z lower-cased; a text of
    fewer than five words is one shingle; null or empty text has none and
    links with nothing. Rows that repeat an identifier are rows of their own;
    a null identifier is the smallest and gives a null component. Other
    columns are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark, rows=1 << ROW_BITS, megabytes=2)
    none = -(1 << 63)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(none)).alias("doc"), F.col(text_col).cast("string").alias("text"))
    with scratch():
        described = staged(describe(rows), "jac-sets")
        slim = described.where("NOT is_token").select("doc", "n", F.col("value").alias("class"))
        top = described.where("is_token").groupBy("value").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "value").limit(FREQUENT_TOKENS)
        frequent = np.sort(np.array(top.select("value").toArrow().column(0).to_numpy(), np.int64).view(np.uint64))

        owned = staged(prefix_rows(rows, frequent), "jac-prefixes")
        shared = staged(
            owned.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("token"), "jac-shared"
        )
        buckets = staged(owned.join(shared.hint("shuffle_hash"), "token").distinct(), "jac-buckets")
        discard(owned)
        discard(shared)
        counts = staged(buckets.groupBy("class").agg(F.count(F.lit(1)).alias("s")), "jac-counts")
        buckets = staged(buckets.join(counts, "class"), "jac-counted")
        maps = staged(described.where("NOT is_token").select(F.col("value").alias("class"), "n", "bitmap", "doc")
                      .join(counts.select("class"), "class").groupBy("class")
                      .agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap")), "jac-maps")

        def fetched(sets: DataFrame | None, classes: DataFrame, name: str) -> DataFrame:
            """``sets`` and those of ``classes`` that are not in it."""
            needed = classes.distinct()
            if sets is not None:
                needed = needed.join(sets.select("class"), "class", "left_anti")
            needed = staged(needed.join(maps.select("class", "doc"), "class").select("doc").distinct(), f"jac-needed-{name}")
            if needed.limit(1).count():
                more = staged(full_sets(rows.join(needed, "doc")), f"jac-full-{name}")
                new = (more if sets is None else sets.unionByName(more)).dropDuplicates(["class"])
                return new if sets is None else staged(new, f"jac-all-{name}")
            return spark.createDataFrame([], "class long, tokens binary") if sets is None else sets

        links, labels, sets = None, None, None
        for turn in range(STAR_ROUNDS + 1):
            held = buckets if labels is None else buckets.join(labels, "class", "left")
            held = held.withColumn("component", F.col("class") if labels is None else F.coalesce("component", "class"))
            other = [F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("s").alias("s_b")]
            if turn < STAR_ROUNDS:
                # The text that near copies stem from has the largest share of tokens that others have.
                first = -F.col("s") / F.col("n") if turn == 0 else F.xxhash64("class", F.lit(turn)).cast("double")
                turn_order = F.struct(first.alias("first"), "class", "n", "s", "component")
                pivots = held.groupBy("token").agg(
                    F.min(turn_order).alias("pivot"), F.min("component").alias("low"), F.max("component").alias("high")
                ).where("low < high").selectExpr("token", "pivot.class AS a", "pivot.n AS n_a", "pivot.s AS s_a", "pivot.component AS of_a")
                pairs = held.join(pivots, "token").where("component <> of_a").select("a", "n_a", "s_a", *other).where(size_bounds())
                # Of its buckets' pivots each class meets the one that it shares most tokens with.
                met = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("many"))
                pairs = met.groupBy("b").agg(F.max(F.struct("many", "a"))["a"].alias("a"))
            else:
                sizes = held.groupBy("token", "component").agg(F.count(F.lit(1)).alias("many"))
                largest = sizes.groupBy("token").agg(
                    F.max(F.struct("many", "component"))["component"].alias("largest"), F.min("component").alias("low"), F.max("component").alias("high")
                ).where("low < high").select("token", "largest")
                mixed = staged(held.join(largest, "token"), "jac-mixed")
                pivot = F.min(F.struct((-F.col("s") / F.col("n")).alias("first"), "class", "component"))
                many = F.count(F.lit(1)) * F.count_if(F.col("component") != F.col("largest"))
                hot = mixed.groupBy("token").agg(many.alias("pairs"), pivot.alias("pivot")).where(F.col("pairs") > BUCKET_PAIRS)
                hot = staged(hot.selectExpr("token", "pivot.class AS pivot", "pivot.component AS of_pivot"), "jac-hot")
                inside = mixed.join(hot, "token")
                related = staged(by_bitmap(inside.selectExpr("pivot AS a", "class AS b").distinct(), maps, RELATED), "jac-related")
                enough = related.groupBy("a").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") >= RELATED_CLASSES)
                related = related.join(enough, "a").selectExpr("a AS pivot", "b AS class", "true AS related")
                inside = staged(inside.join(related, ["pivot", "class"], "left").withColumn("related", F.coalesce("related", F.lit(False))), "jac-inside")
                plain = mixed.join(hot.select("token"), "token", "left_anti").withColumn("related", F.lit(False))
                plain = plain.unionByName(inside.select(*plain.columns))
                few = plain.where("component <> largest").selectExpr("token", "class AS a", "n AS n_a", "s AS s_a", "component AS of_a", "related AS related_a")
                pairs = few.join(plain, "token").where("component <> of_a AND NOT (related AND related_a)")
                pairs = pairs.select("a", "n_a", "s_a", *other).where(size_bounds()).select("a", "b")
                members = staged(inside.where("related").select("pivot", "of_pivot", "class", "n", "s", "component").distinct(), "jac-members")
                sets = fetched(sets, members.select("class"), "hot")  # pivots are members themselves
                met = staged(deviations(members, sets, frequent), "jac-deviations")
                found = met.where(F.col("role") == INDEX).select("key", *other, F.col("component").alias("of_b"), F.col("excess").alias("over_b"))
                look = met.where(F.col("role") == PROBE).selectExpr("key", "class AS a", "n AS n_a", "s AS s_a", "component AS of_a", "excess AS over_a")
                near = met.where(F.col("role") == NEAR).selectExpr("pivot AS a", "class AS b")
                shared = look.join(found, "key").where("of_a <> of_b AND over_a >= over_b").where(size_bounds()).select("a", "b")
                pairs = pairs.unionByName(shared).unionByName(near)
            left = staged(by_bitmap(staged(once(pairs), f"jac-pairs-{turn}"), maps), f"jac-left-{turn}")
            sets = fetched(sets, left.selectExpr("a AS class").unionByName(left.selectExpr("b AS class")), str(turn))
            found = staged(verified(left, sets, frequent).distinct(), f"jac-found-{turn}")
            links = found if links is None else staged(links.unionByName(found).distinct(), f"jac-links-{turn}")
            labels = components(links, f"jac-labels-{turn}")

        joined = staged(slim.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class")), "jac-joined", keep=True)
        firsts = staged(joined.where("n > 0").groupBy("component").agg(F.min("doc").alias("component_id")), "jac-firsts", keep=True)
    id_type = docs.schema[id_col].dataType
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc"))
    given = lambda c: F.when(c != none, c).cast(id_type)
    return joined.join(firsts, "component", "left").select(
        given(F.col("doc")).alias(id_col), F.col("n").alias("n_shingles"), given(own).alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the smallest of their component, with
    all their columns; a row without identifier only where no other of its
    component has one. Documents without words all stay.

    Rows are told apart by a 64-bit hash of identifier and text, so rows that
    repeat an identifier, or have none, are judged by their texts. Of rows
    equal in both, one stays.
    """
    keyed = docs.select(
        F.struct(*docs.columns).alias("_row"), F.xxhash64(id_col, text_col).alias("_key"),
        F.col(id_col).alias("_name"), F.col(text_col).alias("_text"),
    )
    found = jaccard_components(keyed.select("_key", "_text"), "_key", "_text")
    named = keyed.select(F.col("_key").alias("_of"), "_name").distinct()
    order = F.struct(F.col("_name").isNull(), "_name", "_key")
    firsts = found.where("n_shingles > 0").join(named, F.col("_key") == F.col("_of")).groupBy("component_id").agg(F.min(order)["_key"].alias("_keep"))
    wordless = found.where("n_shingles = 0").select(F.col("_key").alias("_keep"), F.lit(True).alias("_all")).distinct()
    stay = staged(firsts.select("_keep", F.lit(False).alias("_all")).unionByName(wordless), "jac-stay")
    kept = keyed.join(stay, F.col("_key") == F.col("_keep")).select("_row", "_key", "_all")
    single = kept.where("NOT _all").dropDuplicates(["_key"])
    return kept.where("_all").unionByName(single).select("_row.*")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
