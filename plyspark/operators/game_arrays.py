"""M1, M4, M5, M7 over games that keep their plies together.

The feed gives a game's moves, analysis and clocks as positional arrays. Here
they stay one array of plies a game, from parsing to the fact row: the
previous score, the three-ply deviation, the opening string and the per-game
counts come from higher-order functions over that array, so nothing is
joined, windowed or grouped by game, and no ply is shuffled. Plies are exploded
only where a ply table is wanted.

The rows equal those of the joined path (``staging``, ``features``,
``openings``, ``marts``) as long as no game occurs twice; a repeated game fans
out there and stays two games here.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyspark.functions.scalar import (
    BLACK,
    JUDGMENT_LABELS,
    VOLATILITY_PLIES,
    WHITE,
    clock_ratio,
    move_flags,
    piece_type,
)
from plyspark.operators.marts import fact_columns
from plyspark.operators.parse import game_columns, move_tokens
from plyspark.operators.staging import stage_games
from plyspark.schemas import (
    EVALS_SCHEMA,
    GAMES_SCHEMA,
    MATCH_FACT_COLUMNS,
    MOVE_FEATURE_COLUMNS,
    MOVES_SCHEMA,
    OPENING_PATTERN_COLUMNS,
    PLIES_TYPE,
)
from plyspark.sources.tables import conform


def plies_of_feed() -> Column:
    """The game's plies, in order: each token of the move text with the
    analysis and clock at its place (NULL past the end of a shorter array)."""
    initial = F.coalesce(F.col("clock.initial"), F.lit(0))

    def ply(san: Column, at: Column) -> Column:
        found, clock = F.get("analysis", at), F.get("clocks", at)
        return F.struct(
            san.alias("move_san"),
            found["eval"].alias("eval_score"),
            found["mate"].alias("mate_in"),
            found["best"].alias("best_move"),
            found["variation"].alias("variation"),
            found["judgment"]["name"].alias("judgment"),
            clock.alias("time_left_cs"),
            clock_ratio(clock, initial).alias("time_left_ratio"),
        )

    return F.coalesce(F.transform(move_tokens(F.col("moves")), ply), F.array()).cast(PLIES_TYPE)


def parse_game_arrays(feed: DataFrame, ingested_at: datetime | Column | None = None, *more: Column | str) -> DataFrame:
    """One row a game: the raw game columns and ``plies`` (and ``more``)."""
    games = feed.select(*game_columns(ingested_at), plies_of_feed().alias("plies"), *more)
    return games.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in GAMES_SCHEMA.fields})


def games_table(arrays: DataFrame) -> DataFrame:
    return conform(arrays, GAMES_SCHEMA)


def _exploded(arrays: DataFrame) -> DataFrame:
    return arrays.select(
        "game_id", "white_username", "black_username", "ingested_at", F.posexplode("plies").alias("_at", "_ply")
    ).select("game_id", "ingested_at", *_place(F.col("_at")), "_ply.*")


def _place(at: Column, name=lambda c: c) -> list[Column]:
    """Ply number, full-move number, colour and mover of the ply at ``at``."""
    white = at % 2 == 0
    return [
        at.cast("long").alias("move_offset"),
        (F.floor(at / 2) + 1).cast("long").alias("move_number"),
        F.when(white, WHITE).otherwise(BLACK).alias("color"),
        name(F.when(white, F.col("white_username")).otherwise(F.col("black_username"))).alias("username"),
    ]


def moves_table(arrays: DataFrame) -> DataFrame:
    return conform(_exploded(arrays), MOVES_SCHEMA)


def evals_table(arrays: DataFrame) -> DataFrame:
    return conform(_exploded(arrays), EVALS_SCHEMA)


# --- features ----------------------------------------------------------------


def _score(at: Column) -> Column:
    return F.get(F.col("plies"), at)["eval_score"]  # of one ply: no array of all scores


def _with(value: Column, then) -> Column:
    """``then(value)``, of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _recent_deviation(at: Column) -> Column:
    """Sample standard deviation of the scores at ``at`` and the two plies
    before it; NULLs are skipped, one value gives NULL."""
    frame = F.array(*[_score(at - back) for back in range(VOLATILITY_PLIES - 1, -1, -1)])

    def sum_of(values, term) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda total, x: total + term(x))

    def around(values, mean) -> Column:
        return F.sqrt(sum_of(values, lambda x: (x - mean) * (x - mean)) / (F.size(values) - 1))

    def deviation(values) -> Column:
        mean = sum_of(values, lambda x: x) / F.size(values)
        return F.when(F.size(values) > 1, _with(mean, lambda m: around(values, m)))

    return _with(F.filter(frame, lambda x: x.isNotNull()), deviation)


def features_from_arrays(arrays: DataFrame) -> DataFrame:
    """The rows of ``move_features``, of every game."""

    def feature(ply: Column, at: Column) -> Column:
        san = ply["move_san"]
        given = [ply[f.name].alias(f.name) for f in PLIES_TYPE.elementType.fields]
        flags = [flag.alias(name) for name, flag in move_flags(san).items()]
        delta = ply["eval_score"] - (F.lit(-1) * _score(at - 1))
        return F.struct(
            *_place(at, F.lower), *given, piece_type(san).alias("piece_type"), *flags,
            delta.alias("eval_delta"), _recent_deviation(at).alias("eval_volatility_3"),
        )

    plies = arrays.select("game_id", F.inline(F.transform("plies", feature)))
    return plies.select(*MOVE_FEATURE_COLUMNS)


def _opening(arrays: DataFrame) -> DataFrame:
    """Adds the opening's length and its moves as text (NULL without any)."""
    count = F.least(F.col("opening_ply"), F.size("plies"))
    sans = F.filter(F.slice(F.col("plies")["move_san"], F.lit(1), F.col("_n")), lambda san: san.isNotNull())
    return arrays.withColumn("_n", F.coalesce(F.greatest(count, F.lit(0)), F.lit(0)).cast("int")).withColumn(
        "opening_moves_string", F.when(F.size(sans) > 0, F.array_join(sans, " "))
    )


def openings_from_arrays(arrays: DataFrame) -> DataFrame:
    """The rows of ``opening_patterns``: timed games with an opening ply."""
    timed = arrays.where(F.col("time_control_initial") > 0)
    found = _opening(timed).where(F.col("_n") > 0).withColumn("opening_move_count", F.col("_n").cast("long"))
    return found.select(*OPENING_PATTERN_COLUMNS)


# --- facts ---------------------------------------------------------------------


def _ply_metrics() -> dict[str, Column]:
    """The per-game counts and averages of ``move_aggregates``."""
    plies = F.col("plies")

    def count(test) -> Column:
        return F.size(F.filter(plies, lambda ply, at: F.coalesce(test(ply, at), F.lit(False)))).cast("long")

    def side(color: str, at: Column) -> Column:
        return at % 2 == (0 if color == WHITE else 1)

    def flag(name: str) -> Column:
        return count(lambda ply, at: move_flags(ply["move_san"])[name])

    def mean(values: Column) -> Column:
        total = F.aggregate(values, F.lit(0.0), lambda sum_, x: sum_ + x)
        return F.when(F.size(values) > 0, total / F.size(values))

    def present(name: str, change=lambda x: x) -> Column:
        return F.transform(F.filter(plies[name], lambda x: x.isNotNull()), change)

    magnitude, ratio = present("eval_score", F.abs), present("time_left_ratio")
    metrics = {"total_plies": F.size(plies).cast("long")}
    for color in (WHITE, BLACK):
        metrics[f"{color}_plies"] = count(lambda ply, at, color=color: side(color, at))
        for label, judgment in JUDGMENT_LABELS.items():
            metrics[f"{color}_{label}"] = count(
                lambda ply, at, color=color, judgment=judgment: side(color, at) & (ply["judgment"] == judgment)
            )
    return metrics | {
        "total_captures": flag("is_capture"),
        "total_checks": flag("is_check"),
        "total_castles": flag("is_castling"),
        "avg_eval_magnitude": mean(magnitude),
        "max_eval_swing": F.array_max(magnitude),
        "avg_time_left_ratio": mean(ratio),
        "min_time_left_ratio": F.array_min(ratio),
    }


def facts_from_arrays(arrays: DataFrame) -> DataFrame:
    """The rows of ``match_facts``: one narrow pass over the games. A game
    without plies has no ply metrics."""
    timed = _opening(arrays).withColumns(
        {name: F.when(F.size("plies") > 0, metric) for name, metric in _ply_metrics().items()}
    )
    metrics = [*_ply_metrics(), "opening_moves_string"]
    staged = stage_games(timed, *metrics)
    return staged.withColumns(fact_columns()).select(*MATCH_FACT_COLUMNS)
