"""M7-M9: the match fact table and the player and opening dimensions.

Aggregation always happens before a join (ply metrics per game, then one
row per game on each side of the fact joins), so no join fans out and every
aggregate gets a map-side partial step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plyspark.functions.scalar import (
    BLACK,
    DRAW,
    JUDGMENT_LABELS,
    LOSS,
    WHITE,
    WIN,
    seconds_between,
)
from plyspark.schemas import (
    MATCH_FACT_COLUMNS,
    MOVE_AGGREGATE_COLUMNS,
    OPENING_DIM_COLUMNS,
    OPENING_STATS_COLUMNS,
    PLAYER_DIM_COLUMNS,
)


def _count_if(cond: Column) -> Column:
    """Count of rows where ``cond`` is true (0 when none; NULL counts as false)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


# --- M7 ---------------------------------------------------------------------


def move_aggregates(features: DataFrame) -> DataFrame:
    """Per-game ply counts, error counts by side, SAN marks, eval and clock."""
    color, judgment = F.col("color"), F.col("judgment")
    aggs = [F.count(F.lit(1)).alias("total_plies"),
            _count_if(color == WHITE).alias("white_plies"),
            _count_if(color == BLACK).alias("black_plies")]
    for label, name in JUDGMENT_LABELS.items():
        for side in (WHITE, BLACK):
            aggs.append(_count_if((color == side) & (judgment == name)).alias(f"{side}_{label}"))
    aggs += [
        _count_if(F.col("is_capture")).alias("total_captures"),
        _count_if(F.col("is_check")).alias("total_checks"),
        _count_if(F.col("is_castling")).alias("total_castles"),
        F.avg(F.abs("eval_score")).alias("avg_eval_magnitude"),
        F.max(F.abs("eval_score")).alias("max_eval_swing"),
        F.avg("time_left_ratio").alias("avg_time_left_ratio"),
        F.min("time_left_ratio").alias("min_time_left_ratio"),
    ]
    return features.groupBy("game_id").agg(*aggs).select(*MOVE_AGGREGATE_COLUMNS)


def match_timing(stg_games: DataFrame) -> DataFrame:
    """Game duration in whole seconds and the UTC calendar date."""
    return stg_games.select(
        "game_id",
        "game_created_at",
        "game_ended_at",
        seconds_between(F.col("game_created_at"), F.col("game_ended_at")).alias("game_duration_sec"),
        F.to_date("game_created_at").alias("game_date"),
    )


def fact_columns() -> dict[str, Column]:
    """What a fact row adds to its staged game."""
    return {
        "rating_gap": F.abs(F.col("white_rating") - F.col("black_rating")),
        "game_duration_sec": seconds_between(F.col("game_created_at"), F.col("game_ended_at")),
        "game_date": F.to_date("game_created_at"),
    }


def match_facts(stg_games: DataFrame, features: DataFrame, openings: DataFrame) -> DataFrame:
    """One row per timed game: game attributes, opening sequence, ply metrics."""
    g = stg_games.withColumns(fact_columns())
    ma = move_aggregates(features)
    op = openings.select("game_id", "opening_moves_string")
    return g.join(ma, "game_id", "left").join(op, "game_id", "left").select(*MATCH_FACT_COLUMNS)


# --- M8 ---------------------------------------------------------------------


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)


#: Bytes of an identifier that fit beside a time in one decimal.
KEY_ID_BYTES = 8
_TIME_SHIFT, _HIGH_SHIFT, _LOW_SHIFT = 1 << 66, 1 << 34, 1 << 2
_TIME_OFFSET = 1 << 59  # times of the years 1 to 9999 then lie in 1 .. 2^60


def has_short_ids(games: DataFrame) -> bool:
    """Whether every ``game_id`` fits a packed order key: present, of 1 to
    ``KEY_ID_BYTES`` bytes, none of them zero (one narrow aggregate)."""
    return bool(games.agg(short_ids()).first()[0])


def short_ids() -> Column:
    """Aggregate of ``has_short_ids``; true of no rows."""
    size = F.octet_length("game_id")
    fits = (size >= 1) & (size <= KEY_ID_BYTES) & ~F.col("game_id").contains("\0")
    return (F.count_if(~F.coalesce(fits, F.lit(False))) == 0).alias("short_ids")


def _order_key(short: bool) -> Column:
    """Order of a player's games by (time, id, colour), NULLs lowest.

    Short identifiers are packed with the time and the colour into one decimal
    of fixed width, which a hash aggregate can keep in its buffer. Others need a
    struct, for which Spark sorts every row.
    """
    if not short:
        return F.struct("game_created_at", "game_id", "color")

    def number(value: Column, factor: int) -> Column:
        return value.cast("decimal(19,0)") * F.lit(str(factor)).cast("decimal(20,0)")

    digits = F.rpad(F.hex(F.encode("game_id", "utf-8")), 2 * KEY_ID_BYTES, "0")
    high, low = (F.conv(F.substring(digits, at, KEY_ID_BYTES), 16, 10) for at in (1, KEY_ID_BYTES + 1))
    time = F.coalesce(F.unix_micros("game_created_at") + F.lit(_TIME_OFFSET), F.lit(0))
    white = F.when(F.col("color") == WHITE, F.lit(1)).otherwise(F.lit(0))
    return number(time, _TIME_SHIFT) + number(high, _HIGH_SHIFT) + number(low, _LOW_SHIFT) + white


def player_current_rating(games: DataFrame, short: bool | None = None) -> DataFrame:
    """Rating at each player's latest game (NULL when that game has none), of
    ``player_games`` rows. ``short``: see ``player_dim``."""
    short = has_short_ids(games) if short is None else short
    return (
        games.where(F.col("username").isNotNull())
        .groupBy("username")
        .agg(_latest_rating(short).alias("current_rating"))
    )


def _latest_rating(short: bool) -> Column:
    # max_by keeps a NULL value; ties on time broken by game id, then colour.
    return F.max_by("rating", _order_key(short))


def player_dim(games: DataFrame, short: bool | None = None) -> DataFrame:
    """Lifetime stats per named player, pooled over all perf types, of
    ``player_games`` rows (no window column is needed). ``short`` says what
    ``has_short_ids`` would find, and saves its job."""
    short = has_short_ids(games) if short is None else short
    t = games.where(F.col("username").isNotNull())
    res, color = F.col("game_result"), F.col("color")
    stats = t.groupBy("username").agg(
        F.count(F.lit(1)).alias("total_games"),
        _count_if(res == WIN).alias("wins"),
        _count_if(res == DRAW).alias("draws"),
        _count_if(res == LOSS).alias("losses"),
        _ratio(_count_if(res == WIN), F.count(F.lit(1))).alias("win_rate"),
        _count_if(color == WHITE).alias("white_games"),
        _count_if(color == BLACK).alias("black_games"),
        _ratio(_count_if((color == WHITE) & (res == WIN)),
               F.nullif(_count_if(color == WHITE), F.lit(0))).alias("white_win_rate"),
        _ratio(_count_if((color == BLACK) & (res == WIN)),
               F.nullif(_count_if(color == BLACK), F.lit(0))).alias("black_win_rate"),
        F.round(F.avg("rating"), 0).alias("avg_rating"),
        F.max("rating").alias("peak_rating"),
        F.min("rating").alias("lowest_rating"),
        _latest_rating(short).alias("current_rating"),
        F.round(F.avg("accuracy"), 1).alias("avg_accuracy"),
        F.round(F.max("accuracy"), 1).alias("best_accuracy"),
        F.min("game_created_at").alias("first_game_at"),
        F.max("game_created_at").alias("last_game_at"),
    )
    return stats.withColumns(
        {
            "preferred_color": F.when(F.col("white_games") >= F.col("black_games"), F.lit(WHITE))
            .otherwise(F.lit(BLACK)),
            "active_days": F.datediff(F.to_date("last_game_at"), F.to_date("first_game_at")).cast("long"),
        }
    ).select(*PLAYER_DIM_COLUMNS)


# --- M9 ---------------------------------------------------------------------


def canonical_openings(facts: DataFrame) -> DataFrame:
    """Most frequent move sequence per (eco, name); ties -> smallest sequence,
    NULL last. ``row_number`` + ``rn = 1`` is planned as a WindowGroupLimit,
    which keeps one row per group on the map side before the exchange."""
    seq = (
        facts.where(F.col("opening_eco").isNotNull())
        .groupBy("opening_eco", "opening_name", "opening_moves_string")
        .agg(F.count(F.lit(1)).alias("games_with_this_sequence"))
    )
    w = Window.partitionBy("opening_eco", "opening_name").orderBy(
        F.col("games_with_this_sequence").desc(), F.col("opening_moves_string").asc_nulls_last()
    )
    return (
        seq.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") == 1)
        .select("opening_eco", "opening_name", "opening_moves_string", "games_with_this_sequence")
    )


def opening_stats(facts: DataFrame) -> DataFrame:
    f = facts.where(F.col("opening_eco").isNotNull())
    res = F.col("result")
    n = F.count(F.lit(1))
    return f.groupBy("opening_eco", "opening_name").agg(
        n.alias("times_played"),
        _count_if(res == WHITE).alias("white_wins"),
        _count_if(res == BLACK).alias("black_wins"),
        _count_if(res == DRAW).alias("draws"),
        _ratio(_count_if(res == WHITE), n).alias("white_win_rate"),
        _ratio(_count_if(res == BLACK), n).alias("black_win_rate"),
        _ratio(_count_if(res == DRAW), n).alias("draw_rate"),
        F.round(F.avg("total_plies") / 2, 1).alias("avg_full_moves"),
        F.round(F.avg("game_duration_sec") / 60, 1).alias("avg_duration_min"),
        F.round(F.avg("max_eval_swing"), 2).alias("avg_sharpness"),
        F.round(F.avg(F.col("white_blunders") + F.col("black_blunders")), 2).alias("avg_blunders_per_game"),
    ).select(*OPENING_STATS_COLUMNS)


def _most_played_first() -> list[Column]:
    return [F.col("times_played").desc(), F.col("opening_eco").asc(), F.col("opening_name").asc_nulls_last()]


def join_canonical(stats: DataFrame, canonical: DataFrame) -> DataFrame:
    """Each opening's stats with its canonical sequence, joined on (eco, name)
    by plain equality: a NULL opening name gets no sequence."""
    sequences = canonical.select("opening_eco", "opening_name", F.col("opening_moves_string").alias("canonical_moves"))
    joined = stats.join(sequences, ["opening_eco", "opening_name"], "left")
    return joined.orderBy(*_most_played_first()).select(*OPENING_DIM_COLUMNS)


def opening_dim(facts: DataFrame) -> DataFrame:
    """Opening stats with the canonical sequence, most played first; the rows
    of ``join_canonical`` with one scan of the facts.

    One aggregate per (eco, name, sequence) and one per (eco, name) over its
    rows, both with a partial step before their shuffle, so neither a hot
    opening nor one with many sequences meets in a single task unreduced.
    """
    f = facts.where(F.col("opening_eco").isNotNull())
    res, sequence = F.col("result"), F.col("opening_moves_string")
    blunders = F.col("white_blunders") + F.col("black_blunders")
    averaged = {"plies": F.col("total_plies"), "dur": F.col("game_duration_sec"), "swing": F.col("max_eval_swing"), "bl": blunders}
    per_seq = f.groupBy("opening_eco", "opening_name", "opening_moves_string").agg(
        F.count(F.lit(1)).alias("n"),
        _count_if(res == WHITE).alias("w"),
        _count_if(res == BLACK).alias("b"),
        _count_if(res == DRAW).alias("d"),
        *[F.sum(c).alias(f"{k}_sum") for k, c in averaged.items()],
        *[F.count(c).alias(f"{k}_n") for k, c in averaged.items()],
    )
    # Most games first, then the smallest sequence, a NULL one last.
    rank = F.struct(-F.col("n"), sequence.isNull(), sequence)
    totals = per_seq.groupBy("opening_eco", "opening_name").agg(
        *[F.sum(c).alias(c) for c in ("n", "w", "b", "d")],
        *[F.sum(f"{k}_{part}").alias(f"{k}_{part}") for k in averaged for part in ("sum", "n")],
        F.min_by(sequence, rank).alias("canonical"),
    )

    def mean(k: str) -> Column:
        return F.try_divide(F.col(f"{k}_sum").cast("double"), F.col(f"{k}_n"))

    n = F.col("n")
    return totals.select(
        "opening_eco",
        "opening_name",
        n.alias("times_played"),
        F.col("w").alias("white_wins"),
        F.col("b").alias("black_wins"),
        F.col("d").alias("draws"),
        _ratio(F.col("w"), n).alias("white_win_rate"),
        _ratio(F.col("b"), n).alias("black_win_rate"),
        _ratio(F.col("d"), n).alias("draw_rate"),
        F.round(mean("plies") / 2, 1).alias("avg_full_moves"),
        F.round(mean("dur") / 60, 1).alias("avg_duration_min"),
        F.round(mean("swing"), 2).alias("avg_sharpness"),
        F.round(mean("bl"), 2).alias("avg_blunders_per_game"),
        F.when(F.col("opening_name").isNotNull(), F.col("canonical")).alias("canonical_moves"),
    ).orderBy(*_most_played_first()).select(*OPENING_DIM_COLUMNS)
