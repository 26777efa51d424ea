"""M6: one row per player per game, with rating history and rolling form.

The two sides are unpivoted in a single scan with ``inline(array(...))``
instead of a UNION ALL of two scans. All five window columns share the
``(username, perf_type ORDER BY game_created_at, game_id, color)`` window;
the key is a player, which can be very hot (one account, or the pool of
anonymous sides), so the window runs through ``plans.skew`` which splits
hot players into ranges of their history while keeping exact results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from plyspark.functions.scalar import BLACK, ROLLING_GAMES, WHITE, WIN, outcome_for
from plyspark.plans.skew import DEFAULT_ROWS_PER_RANGE, ranged_window
from plyspark.schemas import PLAYER_GAME_COLUMNS, TRAJECTORY_COLUMNS
from plyspark.session import conf_int

PLAYER_KEYS = ["username", "perf_type"]
PLAYER_ORDER = ["game_created_at", "game_id", "color"]


def _side(side: str):
    return F.struct(
        F.col("game_id").alias("game_id"),
        F.col("game_created_at").alias("game_created_at"),
        F.col(f"{side}_username").alias("username"),
        F.lit(side).alias("color"),
        F.col(f"{side}_rating").alias("rating"),
        F.col(f"{side}_rating_diff").alias("rating_diff"),
        F.col(f"{side}_accuracy").alias("accuracy"),
        outcome_for(side, F.col("result")).alias("game_result"),
        F.col("perf_type").alias("perf_type"),
    )


def player_games(stg_games: DataFrame) -> DataFrame:
    """Unpivot white and black into one schema (two rows per game)."""
    return stg_games.select(F.inline(F.array(_side(WHITE), _side(BLACK)))).select(
        *PLAYER_GAME_COLUMNS
    )


def _trajectory_window_cols(df: DataFrame, w: WindowSpec) -> DataFrame:
    rolling = w.rowsBetween(-(ROLLING_GAMES - 1), Window.currentRow)
    win = F.when(F.col("game_result") == WIN, F.lit(1.0)).otherwise(F.lit(0.0))
    return df.withColumns(
        {
            "game_sequence": F.row_number().over(w).cast("long"),
            "prev_rating": F.lag("rating").over(w),
            "next_rating": F.lead("rating").over(w),
            "rolling_10_win_rate": F.avg(win).over(rolling),
            "rolling_10_avg_accuracy": F.avg("accuracy").over(rolling),
        }
    )


def rating_trajectories(stg_games: DataFrame, rows_per_range: int | None = None) -> DataFrame:
    """Per player-game rating history and rolling form.

    ``rows_per_range`` defaults to the session setting
    ``spark.plyspark.window.rowsPerRange`` (else 4M rows).
    """
    if rows_per_range is None:
        rows_per_range = conf_int(stg_games.sparkSession, "spark.plyspark.window.rowsPerRange", DEFAULT_ROWS_PER_RANGE)
    out = ranged_window(
        player_games(stg_games),
        keys=PLAYER_KEYS,
        order=PLAYER_ORDER,
        compute=_trajectory_window_cols,
        lookback_cols=["prev_rating", "rolling_10_win_rate", "rolling_10_avg_accuracy"],
        lookahead_cols=["next_rating"],
        rank_cols=["game_sequence"],
        lookback=ROLLING_GAMES - 1,
        lookahead=1,
        rows_per_range=rows_per_range,
    )
    return out.select(*TRAJECTORY_COLUMNS)
