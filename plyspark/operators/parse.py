"""M1: expand nested feed games into the three flat raw tables.

The move string is tokenized and exploded once with its 0-based position;
the per-ply analysis and clock arrays are read positionally with ``get``,
which yields NULL past the end of a shorter array (never an error).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyspark.functions.scalar import BLACK, WHITE, clock_ratio
from plyspark.schemas import EVALS_SCHEMA, GAMES_SCHEMA, MOVES_SCHEMA
from plyspark.sources.tables import conform


def _load_time(ingested_at: datetime | Column | None) -> Column:
    """One load timestamp for the whole run (a literal, so reruns agree)."""
    if isinstance(ingested_at, Column):
        return ingested_at.cast("timestamp")
    ts = ingested_at or datetime.now(timezone.utc)
    return F.lit(ts).cast("timestamp")


def game_columns(ingested_at: datetime | Column | None = None) -> list[Column]:
    """The raw game columns of a feed row; missing nested values are NULL, a
    missing clock is 0."""
    white, black = "players.white", "players.black"
    return [
        F.col("id").alias("game_id"),
        F.col(f"{white}.user.name").alias("white_username"),
        F.col(f"{black}.user.name").alias("black_username"),
        F.col(f"{white}.rating").alias("white_rating"),
        F.col(f"{black}.rating").alias("black_rating"),
        F.col(f"{white}.ratingDiff").alias("white_rating_diff"),
        F.col(f"{black}.ratingDiff").alias("black_rating_diff"),
        F.col(f"{white}.analysis.accuracy").alias("white_accuracy"),
        F.col(f"{black}.analysis.accuracy").alias("black_accuracy"),
        F.col("winner"),
        F.col("status"),
        F.col("perf").alias("perf_type"),
        F.col("variant"),
        F.col("opening.eco").alias("opening_eco"),
        F.col("opening.name").alias("opening_name"),
        F.col("opening.ply").alias("opening_ply"),
        F.coalesce(F.col("clock.initial"), F.lit(0)).alias("time_control_initial"),
        F.coalesce(F.col("clock.increment"), F.lit(0)).alias("time_control_increment"),
        F.col("createdAt").alias("created_at"),
        F.col("lastMoveAt").alias("last_move_at"),
        _load_time(ingested_at).alias("ingested_at"),
    ]


def parse_games_table(feed: DataFrame, ingested_at: datetime | Column | None = None) -> DataFrame:
    return conform(feed.select(*game_columns(ingested_at)), GAMES_SCHEMA)


def move_tokens(moves: Column) -> Column:
    """Whitespace tokenization; NULL or blank text gives no tokens."""
    return F.filter(F.split(moves, r"\s+"), lambda t: t != "")


def explode_plies(feed: DataFrame, ingested_at: datetime | Column | None = None) -> DataFrame:
    """One row per ply with everything both ply tables need (explode once)."""
    plies = feed.select(
        F.col("id").alias("game_id"),
        F.col("players.white.user.name").alias("_white"),
        F.col("players.black.user.name").alias("_black"),
        F.coalesce(F.col("clock.initial"), F.lit(0)).alias("_initial"),
        F.col("analysis").alias("_analysis"),
        F.col("clocks").alias("_clocks"),
        F.posexplode(move_tokens(F.col("moves"))).alias("_pos", "move_san"),
    )
    pos = F.col("_pos").cast("long")
    white_to_move = (pos % 2) == 0
    ply_eval = F.get(F.col("_analysis"), F.col("_pos"))
    return plies.select(
        "game_id",
        pos.alias("move_offset"),
        (F.floor(pos / 2) + 1).cast("long").alias("move_number"),
        F.when(white_to_move, WHITE).otherwise(BLACK).alias("color"),
        F.when(white_to_move, F.col("_white")).otherwise(F.col("_black")).alias("username"),
        "move_san",
        ply_eval["eval"].alias("eval_score"),
        ply_eval["mate"].alias("mate_in"),
        ply_eval["best"].alias("best_move"),
        ply_eval["variation"].alias("variation"),
        ply_eval["judgment"]["name"].alias("judgment"),
        F.get(F.col("_clocks"), F.col("_pos")).alias("time_left_cs"),
        F.col("_initial"),
        _load_time(ingested_at).alias("ingested_at"),
    ).withColumn(
        "time_left_ratio", clock_ratio(F.col("time_left_cs"), F.col("_initial"))
    )


def parse_moves_table(feed: DataFrame, ingested_at: datetime | Column | None = None) -> DataFrame:
    return conform(explode_plies(feed, ingested_at), MOVES_SCHEMA)


def parse_evals_table(feed: DataFrame, ingested_at: datetime | Column | None = None) -> DataFrame:
    return conform(explode_plies(feed, ingested_at), EVALS_SCHEMA)


def parse_games(
    feed: DataFrame, ingested_at: datetime | Column | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(games, moves, move_evals)`` from feed rows, sharing one load time."""
    ts = _load_time(ingested_at)
    plies = explode_plies(feed, ts)
    return (
        parse_games_table(feed, ts),
        conform(plies, MOVES_SCHEMA),
        conform(plies, EVALS_SCHEMA),
    )
