"""Ordered windows that stay balanced when one key is very large.

A ``Window.partitionBy(keys)`` puts every row of a key into one task; AQE
splits skewed *join* partitions but not window partitions. When a key may
hold a large share of all rows (one player, one anonymous pool), a plain
window sorts that whole group in a single task.

``ranged_window`` keeps exact window semantics for functions whose frame
reaches at most ``lookback`` rows back and ``lookahead`` rows forward (lag,
lead, bounded ``rowsBetween`` aggregates) plus ``row_number``:

1. One aggregate finds the *hot* keys (more than ``rows_per_range`` rows).
   Without any, the plan is exactly the plain window.
2. A random sample of the hot keys' rows, ordered by the full window order,
   gives splitters at equal depth: a range holds about ``rows_per_range``
   rows, however times cluster. An outlier, a burst or one timestamp shared
   by all rows is cut like anything else; only rows equal in the whole order
   stay together.
3. Rows of hot keys get their range by binary search over the splitters (a
   bounded broadcast) and one window runs on ``(keys, range)``: one shuffle.
   Its result is stored, so it runs once; rows of other keys take the plain
   window and nothing else.
4. Prefix sums of the ranges' row counts complete ``row_number``. The first
   and last rows of each range are the halo that neighbouring ranges pass to
   each other: windowed once more per key (a few rows a range), they give the
   values whose frames cross a cut. Rows inside a range are final as stored.

The result does not depend on where the cuts fall, only the balance does.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from plyspark.session import stored

DEFAULT_ROWS_PER_RANGE = 4_000_000
#: Most ranges over all hot keys; beyond it ranges grow. It bounds the
#: splitters and prefix sums that are broadcast and the halo of one key.
MAX_RANGES = 10_000
#: Sampled rows for each range: its size then stays within a few tenths.
SAMPLES_PER_RANGE = 128
#: Splitters of one block of the two-level search.
_BLOCK = 64

_HELPERS = ["_range", "_rank", "_rows"]


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def _keyed(df: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *columns)


def hot_keys(df: DataFrame, keys: list[str], rows_per_range: int) -> DataFrame:
    """The largest keys of more than ``rows_per_range`` rows, with ``_n``;
    ``MAX_RANGES`` of them at most (a key beyond those holds less than that
    part of all rows and takes the plain window)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_range)
    return counts.orderBy(F.desc("_n")).limit(MAX_RANGES)


def splitters(df: DataFrame, hot: DataFrame, keys: list[str], order: list[str], rows_per_range: int) -> DataFrame:
    """``_k_<key>.., _cuts``: each hot key's splitters, in blocks of ascending
    order tuples. The sample of a key is bounded by ``SAMPLES_PER_RANGE`` for
    each of at most ``MAX_RANGES`` ranges."""
    side = _keyed(hot, keys)
    share = min(1.0, SAMPLES_PER_RANGE / rows_per_range)
    rows = df.join(F.broadcast(side), _same(df, side, keys), "left_semi").select(*keys, F.struct(*order).alias("_at"))
    # Cuts need not be repeatable: they are stored once and any cut is right.
    sample = rows if share == 1.0 else rows.where(F.rand(17) < share)
    every = max(1, round(share * rows_per_range))
    in_order = Window.partitionBy(*keys).orderBy("_at")
    picked = sample.withColumn("_i", F.row_number().over(in_order)).where((F.col("_i") - 1) % every == 0).where("_i > 1")
    block = F.floor((F.row_number().over(in_order) - 1) / _BLOCK)
    blocks = picked.withColumn("_block", block).groupBy(*keys, "_block").agg(F.sort_array(F.collect_list("_at")).alias("_cut"))
    in_blocks = F.array_sort(F.collect_list(F.struct("_block", "_cut")))
    return _keyed(blocks.groupBy(*keys).agg(F.transform(in_blocks, lambda b: b["_cut"]).alias("_cuts")), keys, "_cuts")


def range_of(cuts: Column, at: Column) -> Column:
    """How many splitters lie at or before ``at``: whole blocks first, then
    inside the last one that begins at or before it."""
    before = F.size(F.filter(cuts, lambda block: F.element_at(block, 1) <= at))
    inside = F.size(F.filter(F.element_at(cuts, before), lambda cut: cut <= at))
    return F.when(before == 0, F.lit(0)).otherwise((before - 1) * _BLOCK + inside)


def with_ranges(df: DataFrame, cuts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The hot keys' rows with their ``_range``."""
    joined = df.join(F.broadcast(cuts), _same(df, cuts, keys), "inner")
    at = range_of(F.col("_cuts"), F.struct(*order))
    return joined.select(*df.columns, at.alias("_range"))


def _plan_ranges(df: DataFrame, keys: list[str], order: list[str], rows_per_range: int) -> tuple[DataFrame, DataFrame] | None:
    """Stored hot keys and splitters; None without hot keys."""
    hot = hot_keys(df, keys, rows_per_range)
    total = hot.agg(F.sum("_n")).first()[0]
    if total is None:
        return None
    hot = stored(hot, "hot-keys")
    rows = max(rows_per_range, -(-total // MAX_RANGES))
    return hot, stored(splitters(df, hot, keys, order, rows), "splitters")


def range_sizes(df: DataFrame, keys: list[str], order: list[str], rows_per_range: int) -> DataFrame:
    """Diagnostic: rows of each (key, range) that one window task gets."""
    plan = _plan_ranges(df, keys, order, rows_per_range)
    if plan is None:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).withColumn("_range", F.lit(0))
    ranged = with_ranges(df, plan[1], keys, order)
    return ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("rows"))


def ranged_window(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    lookback_cols: list[str],
    lookahead_cols: list[str],
    rank_cols: list[str],
    lookback: int,
    lookahead: int,
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> DataFrame:
    """Apply ``compute(df, window)`` exactly, splitting hot keys.

    The window orders by the columns ``order``, all ascending, NULLs first.
    ``compute`` must add ``lookback_cols`` (frames ending at the current row,
    at most ``lookback`` rows back), ``lookahead_cols`` (at most ``lookahead``
    rows forward) and ``rank_cols`` (``row_number``) using only the window it
    is given.
    """
    plan = _plan_ranges(df, keys, order, rows_per_range)
    if plan is None:
        return compute(df, Window.partitionBy(*keys).orderBy(*order))
    hot, cuts = plan

    in_range = Window.partitionBy(*keys, "_range").orderBy(*order)
    whole = in_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = compute(with_ranges(df, cuts, keys, order), in_range).withColumns(
        {"_rank": F.row_number().over(in_range), "_rows": F.count(F.lit(1)).over(whole)}
    )
    local = stored(local, "ranges")

    # Rows in the key's earlier ranges: one row a range, MAX_RANGES at most.
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = local.where("_rank = 1").withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    side = _keyed(starts, keys, F.col("_range").alias("_k__range"), "_start")
    placed = local.join(F.broadcast(side), _same(local, side, keys) & (local["_range"] == side["_k__range"]), "left").select(
        *local.columns, "_start"
    ).withColumns({c: (F.col(c) + F.col("_start")).cast("long") for c in rank_cols})

    edge = max(lookback, lookahead)
    begins, ends = F.col("_rank") <= lookback, F.col("_rank") > F.col("_rows") - lookahead
    result = [c for c in local.columns if c not in _HELPERS]
    inner = placed.where(~begins & ~ends).select(*result)

    halo = placed.where((F.col("_rank") <= edge) | (F.col("_rank") > F.col("_rows") - edge))
    kept = {c: F.col(c) for c in lookback_cols + lookahead_cols}
    again = compute(
        halo.select(*df.columns, *_HELPERS, *[F.col(c).alias(f"_own_{c}") for c in [*kept, *rank_cols]]),
        Window.partitionBy(*keys).orderBy(*order),
    )
    crossing = again.where(begins | ends).withColumns({
        **{c: F.when(begins, F.col(c)).otherwise(F.col(f"_own_{c}")) for c in lookback_cols},
        **{c: F.when(ends, F.col(c)).otherwise(F.col(f"_own_{c}")) for c in lookahead_cols},
        **{c: F.col(f"_own_{c}") for c in rank_cols},
    }).select(*result)

    few = _keyed(hot, keys)
    cold = df.join(F.broadcast(few), _same(df, few, keys), "left_anti")
    plain = compute(cold, Window.partitionBy(*keys).orderBy(*order)).select(*result)
    return plain.unionByName(inner).unionByName(crossing)
