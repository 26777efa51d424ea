"""M4: per-ply features -- piece type, SAN flags, eval delta, volatility.

All window columns share one ``(game_id ORDER BY move_offset)`` window, so
Spark plans one exchange on ``game_id`` and one sort for all of them, and
the per-game aggregate downstream reuses that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from plyspark.functions.scalar import VOLATILITY_PLIES, move_flags, piece_type
from plyspark.plans.skew import ranged_window
from plyspark.schemas import MOVE_FEATURE_COLUMNS


def eval_delta(w: WindowSpec) -> Column:
    """``eval - (-1 * previous eval)`` as defined upstream (the sum of the two);
    NULL on the first ply and next to a ply without a score."""
    return F.col("eval_score") - (F.lit(-1) * F.lag("eval_score").over(w))


def eval_volatility(w: WindowSpec) -> Column:
    """Sample standard deviation of the last plies' scores; NULLs are skipped
    and a single value gives NULL."""
    return F.stddev_samp("eval_score").over(w.rowsBetween(-(VOLATILITY_PLIES - 1), Window.currentRow))


def _window_features(df: DataFrame, w: WindowSpec) -> DataFrame:
    return df.withColumns(
        {"eval_delta": eval_delta(w), "eval_volatility_3": eval_volatility(w)}
    )


def move_features(stg_moves: DataFrame, rows_per_game_range: int | None = None) -> DataFrame:
    """Adds piece_type, is_* flags, eval_delta and eval_volatility_3.

    A game's ply count is bounded by the rules of chess, so the plain
    per-game window is the default. Pass ``rows_per_game_range`` to guard
    against malformed feeds with runaway game ids (hot keys get split, see
    ``plans.skew``).
    """
    san = F.col("move_san")
    df = stg_moves.withColumns({"piece_type": piece_type(san), **move_flags(san)})
    if rows_per_game_range is None:
        out = _window_features(df, Window.partitionBy("game_id").orderBy("move_offset"))
    else:
        out = ranged_window(
            df,
            keys=["game_id"],
            order=["move_offset"],
            compute=_window_features,
            lookback_cols=["eval_delta", "eval_volatility_3"],
            lookahead_cols=[],
            rank_cols=[],
            lookback=VOLATILITY_PLIES - 1,
            lookahead=0,
            rows_per_range=rows_per_game_range,
        )
    return out.select(*MOVE_FEATURE_COLUMNS)
