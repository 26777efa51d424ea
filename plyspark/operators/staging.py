"""M2/M3: cleaned games and plies joined with their evaluations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyspark.functions.scalar import DEFAULT_VARIANT, DRAW, epoch_ms_to_ts, time_control_label
from plyspark.schemas import STG_GAMES_COLUMNS, STG_MOVES_COLUMNS


def is_timed() -> Column:
    """Games that the staging layer keeps, of raw rows."""
    return F.col("time_control_initial") > 0


def staged_columns() -> dict[str, Column]:
    """The columns of a staged game that differ from its raw row."""
    return {
        "white_username": F.lower("white_username"),
        "black_username": F.lower("black_username"),
        "result": F.coalesce(F.col("winner"), F.lit(DRAW)),
        "variant": F.coalesce(F.col("variant"), F.lit(DEFAULT_VARIANT)),
        "time_control_label": time_control_label(F.col("time_control_initial"), F.col("time_control_increment")),
        "game_created_at": epoch_ms_to_ts(F.col("created_at")),
        "game_ended_at": epoch_ms_to_ts(F.col("last_move_at")),
    }


def stage_games(games: DataFrame, *more: str) -> DataFrame:
    """Lower-cased names, result, label and timestamps; timed games only
    (``more``: further columns to keep).

    The filter is written first so Catalyst pushes it into the scan.
    """
    made = staged_columns()
    return games.where(is_timed()).select(
        *[made[c].alias(c) if c in made else F.col(c) for c in STG_GAMES_COLUMNS], *more
    )


def stage_moves(moves: DataFrame, evals: DataFrame, co_partition: bool = True) -> DataFrame:
    """Every ply with its evaluation (left join on the ply key).

    Duplicate eval rows for one ply fan out, as an equi-join does.

    The plies are hash-partitioned by ``game_id`` only, unless
    ``co_partition=False`` says that both tables are bucketed by it. With
    ``spark.sql.requireAllClusterKeysForCoPartition=false`` (set by
    ``plyspark.session.ensure_conf``) the planner then shuffles the evals
    to that same partitioning, and the per-game window and aggregates
    downstream reuse it instead of shuffling the joined plies again. A game's
    ply count is bounded, so partitioning by the game alone cannot create a hot
    task.
    """
    m = moves.select(
        "game_id", "move_offset", "move_number", "color",
        F.lower("username").alias("username"), "move_san",
    )
    e = evals.select(
        "game_id", "move_offset", "eval_score", "mate_in", "best_move", "variation",
        "judgment", "time_left_cs", "time_left_ratio",
    )
    if co_partition:
        m = m.repartition("game_id")
    # Evals are a per-ply table with no size bound, so they are never
    # broadcast: a sort-merge join on the shared game partitioning costs no
    # extra shuffle and leaves the rows sorted for the per-game window.
    return m.join(e.hint("merge"), ["game_id", "move_offset"], "left").select(*STG_MOVES_COLUMNS)
