"""Scalar column expressions used by the operators.

Every helper returns a Spark ``Column`` built from built-in functions, so
it stays inside whole-stage codegen; there is no Python UDF anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source semantics; listed in natural order).
#
# SAN first letter -> piece: N knight, B bishop, R rook, Q queen, K king;
# any other first character is a pawn move; castling is 'O-O' or 'O-O-O'.
# Move marks inside SAN: 'x' capture, '+' check, '#' checkmate, '=' promotion.
# Perf-type request groups: 'blitz' -> [blitz]; anything else -> [rapid, classical].
# Default request: perf 'rapid+classical', at most 5000 games.
# Game result: white, black, draw (a missing winner is a draw).
# Outcome for one side: win, loss, draw.
# Engine judgments counted per side: Blunder, Mistake, Inaccuracy.
# Missing variant: standard.
# Rolling form: the last 10 games (this one included); volatility: the last 3 plies.
# ---------------------------------------------------------------------------
SAN_PIECES = {"N": "knight", "B": "bishop", "R": "rook", "Q": "queen", "K": "king"}
CASTLING_PREFIX = "O-O"
CAPTURE_MARK, CHECK_MARK, MATE_MARK, PROMOTION_MARK = "x", "+", "#", "="
PERF_GROUPS = {"blitz": ["blitz"], "default": ["rapid", "classical"]}
DEFAULT_PERF, DEFAULT_MAX_GAMES = "rapid+classical", 5000
WHITE, BLACK, DRAW = "white", "black", "draw"
WIN, LOSS = "win", "loss"
JUDGMENT_LABELS = {"blunders": "Blunder", "mistakes": "Mistake", "inaccuracies": "Inaccuracy"}
DEFAULT_VARIANT = "standard"
ROLLING_GAMES = 10
VOLATILITY_PLIES = 3


def whole_number_text(x: Column) -> Column:
    """Render a double the way the source warehouse prints it: whole values
    without a fractional part (``10``), other values as the double (``1.5``)."""
    return (
        F.when(x == F.floor(x), F.floor(x).cast("string"))
        .otherwise(x.cast("string"))
    )


def time_control_label(initial: Column, increment: Column) -> Column:
    """``<initial minutes>+<increment seconds>``, e.g. ``10+5``, ``1.5+0``."""
    minutes = initial.cast("double") / F.lit(60.0)
    return F.concat(whole_number_text(minutes), F.lit("+"), increment.cast("string"))


def epoch_ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff("SECOND", start, end)


def piece_type(san: Column) -> Column:
    """Moving piece from SAN; castling counts as a king move, NULL SAN as pawn."""
    first = F.left(san, F.lit(1))
    expr = F.when(san.startswith(CASTLING_PREFIX), F.lit("king"))
    for letter, piece in SAN_PIECES.items():
        expr = expr.when(first == letter, F.lit(piece))
    return expr.otherwise(F.lit("pawn"))


def move_flags(san: Column) -> dict[str, Column]:
    """Boolean SAN marks; a NULL SAN gives NULL flags."""
    return {
        "is_capture": san.contains(CAPTURE_MARK),
        "is_check": san.contains(CHECK_MARK),
        "is_checkmate": san.contains(MATE_MARK),
        "is_promotion": san.contains(PROMOTION_MARK),
        "is_castling": san.startswith(CASTLING_PREFIX),
    }


def outcome_for(side: str, result: Column) -> Column:
    """Game outcome from ``side``'s point of view given result white/black/draw."""
    other = BLACK if side == WHITE else WHITE
    return (
        F.when(result == side, F.lit(WIN))
        .when(result == other, F.lit(LOSS))
        .otherwise(F.lit(DRAW))
    )


def clock_ratio(time_left_cs: Column, initial_sec: Column) -> Column:
    """Fraction of the initial clock left, 4 decimals; NULL without a clock."""
    return F.when(
        time_left_cs.isNotNull() & (initial_sec > 0),
        F.round(time_left_cs / F.lit(100.0) / initial_sec, 4),
    )
