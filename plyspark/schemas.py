"""Explicit schemas: the nested game feed, the three raw tables and the
column order of every model output.

Nothing is inferred at read time: the feed is decoded with ``FEED_SCHEMA``
and each raw table is cast to its declared schema before it is written.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- nested feed (one JSON object per game) --------------------------------

_PLAYER = T.StructType(
    [
        T.StructField("user", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("rating", T.LongType()),
        T.StructField("ratingDiff", T.LongType()),
        T.StructField("analysis", T.StructType([T.StructField("accuracy", T.DoubleType())])),
    ]
)

_PLY_ANALYSIS = T.StructType(
    [
        T.StructField("eval", T.DoubleType()),
        T.StructField("mate", T.LongType()),
        T.StructField("best", T.StringType()),
        T.StructField("variation", T.StringType()),
        T.StructField("judgment", T.StructType([T.StructField("name", T.StringType())])),
    ]
)

FEED_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("winner", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("perf", T.StringType()),
        T.StructField("variant", T.StringType()),
        T.StructField("createdAt", T.LongType()),
        T.StructField("lastMoveAt", T.LongType()),
        T.StructField("moves", T.StringType()),
        T.StructField(
            "players",
            T.StructType([T.StructField("white", _PLAYER), T.StructField("black", _PLAYER)]),
        ),
        T.StructField(
            "clock",
            T.StructType(
                [T.StructField("initial", T.LongType()), T.StructField("increment", T.LongType())]
            ),
        ),
        T.StructField(
            "opening",
            T.StructType(
                [
                    T.StructField("eco", T.StringType()),
                    T.StructField("name", T.StringType()),
                    T.StructField("ply", T.LongType()),
                ]
            ),
        ),
        T.StructField("analysis", T.ArrayType(_PLY_ANALYSIS)),
        T.StructField("clocks", T.ArrayType(T.LongType())),
    ]
)

# --- raw tables --------------------------------------------------------------

GAMES_SCHEMA = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("white_username", T.StringType()),
        T.StructField("black_username", T.StringType()),
        T.StructField("white_rating", T.LongType()),
        T.StructField("black_rating", T.LongType()),
        T.StructField("white_rating_diff", T.LongType()),
        T.StructField("black_rating_diff", T.LongType()),
        T.StructField("white_accuracy", T.DoubleType()),
        T.StructField("black_accuracy", T.DoubleType()),
        T.StructField("winner", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("perf_type", T.StringType()),
        T.StructField("variant", T.StringType()),
        T.StructField("opening_eco", T.StringType()),
        T.StructField("opening_name", T.StringType()),
        T.StructField("opening_ply", T.LongType()),
        T.StructField("time_control_initial", T.LongType()),  # seconds
        T.StructField("time_control_increment", T.LongType()),  # seconds
        T.StructField("created_at", T.LongType()),  # epoch ms
        T.StructField("last_move_at", T.LongType()),  # epoch ms
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

MOVES_SCHEMA = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("move_offset", T.LongType()),  # 0-based ply
        T.StructField("move_number", T.LongType()),  # 1-based full move
        T.StructField("color", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("move_san", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

EVALS_SCHEMA = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("move_offset", T.LongType()),
        T.StructField("eval_score", T.DoubleType()),  # feed value as given (not divided)
        T.StructField("mate_in", T.LongType()),
        T.StructField("best_move", T.StringType()),
        T.StructField("variation", T.StringType()),
        T.StructField("judgment", T.StringType()),
        T.StructField("time_left_cs", T.LongType()),  # centiseconds
        T.StructField("time_left_ratio", T.DoubleType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

#: A game's plies in one array (the parsed feed, before it is exploded).
PLIES_TYPE = T.ArrayType(
    T.StructType([T.StructField("move_san", T.StringType())] + [f for f in EVALS_SCHEMA.fields[2:-1]])
)

RAW_SCHEMAS = {"games": GAMES_SCHEMA, "moves": MOVES_SCHEMA, "move_evals": EVALS_SCHEMA}

# --- model output column orders -----------------------------------------------

STG_GAMES_COLUMNS = [
    "game_id", "white_username", "black_username", "white_rating", "black_rating",
    "white_rating_diff", "black_rating_diff", "white_accuracy", "black_accuracy",
    "winner", "result", "status", "perf_type", "variant", "opening_eco", "opening_name",
    "opening_ply", "time_control_initial", "time_control_increment", "time_control_label",
    "game_created_at", "game_ended_at", "ingested_at",
]

STG_MOVES_COLUMNS = [
    "game_id", "move_offset", "move_number", "color", "username", "move_san",
    "eval_score", "mate_in", "best_move", "variation", "judgment",
    "time_left_cs", "time_left_ratio",
]

MOVE_FEATURE_COLUMNS = STG_MOVES_COLUMNS + [
    "piece_type", "is_capture", "is_check", "is_checkmate", "is_promotion", "is_castling",
    "eval_delta", "eval_volatility_3",
]

OPENING_PATTERN_COLUMNS = [
    "game_id", "opening_eco", "opening_name", "opening_moves_string", "opening_move_count",
]

PLAYER_GAME_COLUMNS = [
    "game_id", "game_created_at", "username", "color", "rating", "rating_diff",
    "accuracy", "game_result", "perf_type",
]

TRAJECTORY_COLUMNS = PLAYER_GAME_COLUMNS + [
    "game_sequence", "prev_rating", "next_rating", "rolling_10_win_rate",
    "rolling_10_avg_accuracy",
]

MOVE_AGGREGATE_COLUMNS = [
    "game_id", "total_plies", "white_plies", "black_plies",
    "white_blunders", "black_blunders", "white_mistakes", "black_mistakes",
    "white_inaccuracies", "black_inaccuracies",
    "total_captures", "total_checks", "total_castles",
    "avg_eval_magnitude", "max_eval_swing", "avg_time_left_ratio", "min_time_left_ratio",
]

MATCH_FACT_COLUMNS = [
    "game_id", "white_username", "black_username",
    "white_rating", "black_rating", "white_rating_diff", "black_rating_diff", "rating_gap",
    "white_accuracy", "black_accuracy",
    "result", "status",
    "opening_eco", "opening_name", "opening_moves_string",
    "perf_type", "time_control_label", "time_control_initial", "time_control_increment",
    "game_created_at", "game_ended_at", "game_duration_sec", "game_date",
] + MOVE_AGGREGATE_COLUMNS[1:]

PLAYER_DIM_COLUMNS = [
    "username", "total_games", "wins", "draws", "losses", "win_rate",
    "white_games", "black_games", "white_win_rate", "black_win_rate",
    "avg_rating", "peak_rating", "lowest_rating", "current_rating",
    "avg_accuracy", "best_accuracy", "first_game_at", "last_game_at",
    "preferred_color", "active_days",
]

OPENING_STATS_COLUMNS = [
    "opening_eco", "opening_name", "times_played", "white_wins", "black_wins", "draws",
    "white_win_rate", "black_win_rate", "draw_rate",
    "avg_full_moves", "avg_duration_min", "avg_sharpness", "avg_blunders_per_game",
]

OPENING_DIM_COLUMNS = OPENING_STATS_COLUMNS + ["canonical_moves"]

CHECK_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("failures", T.LongType()),
    ]
)
