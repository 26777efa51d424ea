"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query starts from the driver tables under ``sf_dir`` through the
fixture adapter (``sources.adapter``), whose output -- raw Parquet tables
and an NDJSON feed file -- is written once per source into the shared
checkpoint folder, and runs the library operators over the whole tables. Raw floating averages, standard deviations and ratios
are rounded to 6 decimals in these wrappers only (the operators themselves
return unrounded values) so engines that add in a different order agree.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plyspark.functions.scalar import DEFAULT_MAX_GAMES, DEFAULT_PERF, move_flags, piece_type
from plyspark.operators.checks import PIPELINE_RULES, accepted_range
from plyspark.operators.features import move_features
from plyspark.operators.game_arrays import facts_from_arrays, features_from_arrays, openings_from_arrays, parse_game_arrays
from plyspark.operators.marts import (
    canonical_openings,
    join_canonical,
    match_facts,
    match_timing,
    move_aggregates,
    opening_dim,
    opening_stats,
    player_current_rating,
    player_dim,
)
from plyspark.operators.openings import opening_patterns
from plyspark.operators.parse import explode_plies, parse_evals_table, parse_games_table, parse_moves_table
from plyspark.operators.staging import stage_games, stage_moves
from plyspark.operators.trajectories import player_games, rating_trajectories
from plyspark.plans.pipeline import PipelineResult, check_models, refresh_from_tables, run_pipeline
from plyspark.schemas import RAW_SCHEMAS
from plyspark.session import ensure_conf, scratch_path, stored
from plyspark.sources import adapter
from plyspark.sources.feed import analysed_only, latest_games, read_feed, read_feed_lines, select_perf, select_user
from plyspark.sources.store import Store
from plyspark.sources.tables import read_raw_csv, write_csv

MAX_GAMES = DEFAULT_MAX_GAMES

Query = Callable[[SparkSession, str], DataFrame]


def _r6(df: DataFrame, cols: list[str], n: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), n) for c in cols})


def _raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Raw games / moves / move_evals derived from ``sf`` (stored once)."""
    ensure_conf(spark)
    return adapter.stored_raw_tables(spark, sf)


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    """The NDJSON feed derived from ``sf``, scanned with the feed schema."""
    ensure_conf(spark)
    return read_feed(spark, adapter.stored_feed_path(spark, sf))


def _plies(spark: SparkSession, sf: str, raw: dict[str, DataFrame]) -> DataFrame:
    return stage_moves(raw["moves"], raw["move_evals"], co_partition=not adapter.are_bucketed(spark, sf))


def _stg(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    raw = _raw(spark, sf)
    return stage_games(raw["games"]), _plies(spark, sf, raw)


def _scratch(spark: SparkSession, sf: str, name: str) -> str:
    """A folder of this source's fixture for what a query writes."""
    return scratch_path(spark, f"plyspark_{name}/" + os.path.basename(adapter.materialize(spark, sf)))


def _ingested() -> Column:
    return F.lit(adapter.INGESTED_AT_TEXT).cast("timestamp")


# --- feed scans and selection ------------------------------------------------


def q_scan_json(spark, sf):
    f = _feed(spark, sf)
    return f.select(
        F.col("id").alias("game_id"),
        "winner", "status",
        F.col("perf").alias("perf_type"),
        "variant",
        F.col("createdAt").alias("created_at"),
        F.col("lastMoveAt").alias("last_move_at"),
        F.col("moves").alias("moves_text"),
        F.col("players.white.user.name").alias("white_name"),
        F.col("players.black.user.name").alias("black_name"),
        F.col("players.white.rating").alias("white_rating"),
        F.col("players.black.rating").alias("black_rating"),
        F.col("clock.initial").alias("clock_initial"),
        F.col("clock.increment").alias("clock_increment"),
        F.col("opening.eco").alias("opening_eco"),
        F.col("opening.name").alias("opening_name"),
        F.col("opening.ply").alias("opening_ply"),
        F.coalesce(F.size("analysis"), F.lit(0)).cast("long").alias("n_analysis"),
        F.coalesce(F.size("clocks"), F.lit(0)).cast("long").alias("n_clocks"),
    )


def q_feed_analysed(spark, sf):
    f = analysed_only(_feed(spark, sf))
    return f.select(
        F.col("id").alias("game_id"),
        F.size("analysis").cast("long").alias("n_analysis"),
    )


def q_feed_perf_filter(spark, sf):
    f = select_perf(_feed(spark, sf), DEFAULT_PERF)
    return f.select(F.col("id").alias("game_id"), F.col("perf").alias("perf_type"))


def q_feed_latest_n(spark, sf):
    f = latest_games(select_perf(_feed(spark, sf), DEFAULT_PERF), MAX_GAMES)
    return f.select(
        F.col("id").alias("game_id"),
        F.col("createdAt").alias("created_at"),
        F.col("perf").alias("perf_type"),
    )


def _newest(feed: DataFrame, *columns: str):
    """Those columns of the newest game."""
    return feed.orderBy(F.col("createdAt").desc_nulls_last(), F.col("id").asc()).select(*columns).first()


def q_feed_user(spark, sf):
    """The games of one user, found by name in any case: who played white in
    the newest game."""
    feed, white = _feed(spark, sf), "players.white.user.name"
    name = _newest(feed.where(F.col(white).isNotNull()), white)[0]
    mine = select_user(feed, name.upper())
    return mine.select(
        F.col("id").alias("game_id"), F.col(white).alias("white_name"), F.col("players.black.user.name").alias("black_name")
    )


def q_feed_quarantine(spark, sf):
    """A feed of which every 25th line is bad, text or a wrong type: the games
    that can be read, and the lines that can't."""
    lines = spark.read.text(adapter.stored_feed_path(spark, sf))
    game = F.get_json_object("value", "$.id")
    k = game.cast("long")
    planted = lines.select(
        F.when(k % 50 == 0, F.concat(F.lit("no game: "), game))
        .when(k % 50 == 1, F.concat(F.lit('{"id": "'), game, F.lit('", "createdAt": "soon"}')))
        .otherwise(F.col("value")).alias("value")
    )
    path = _scratch(spark, sf, "quarantine")
    planted.write.mode("overwrite").option("compression", "gzip").text(path)
    good = F.col("bad_line").isNull()
    return stored(read_feed_lines(spark, path), "lines").select(F.when(good, F.col("id")).alias("game_id"), "bad_line")


def q_single_game(spark, sf):
    """All plies of one game read by its id: the newest analysed game."""
    game_id = _newest(analysed_only(_feed(spark, sf)), "id")[0]
    one = analysed_only(read_feed(spark, adapter.stored_feed_path(spark, sf), game_id=game_id))
    plies = explode_plies(one, _ingested())
    return plies.select(
        "game_id", "move_offset", "move_number", "color", "username", "move_san",
        "eval_score", "mate_in", "judgment", "time_left_cs", "time_left_ratio",
    )


# --- parse -------------------------------------------------------------------


def q_parse_games(spark, sf):
    return parse_games_table(_feed(spark, sf), _ingested())


def q_parse_moves(spark, sf):
    return parse_moves_table(_feed(spark, sf), _ingested())


def q_parse_evals(spark, sf):
    return parse_evals_table(_feed(spark, sf), _ingested())


# --- staging -----------------------------------------------------------------


def q_stage_games(spark, sf):
    return stage_games(_raw(spark, sf)["games"])


def q_time_control_label(spark, sf):
    g = stage_games(_raw(spark, sf)["games"])
    return g.select("game_id", "time_control_initial", "time_control_increment", "time_control_label")


def q_stage_moves(spark, sf):
    return _stg(spark, sf)[1]


def q_odd_plies(spark, sf):
    """Staged plies with what a feed rarely has: moves without text, and two
    evaluations of one ply, which fan out."""
    raw = _raw(spark, sf)
    k = F.col("game_id").cast("long")
    moves = raw["moves"].withColumn("move_san", F.when((k + F.col("move_offset")) % 11 != 0, F.col("move_san")))
    twice = raw["move_evals"].where(k % 10 == 3).withColumns({"eval_score": -F.col("eval_score"), "best_move": F.lit("x")})
    plies = stage_moves(moves, raw["move_evals"].unionByName(twice))
    flags = move_flags(F.col("move_san"))
    return plies.select(
        "game_id", "move_offset", "move_san", "eval_score", "best_move", piece_type(F.col("move_san")).alias("piece_type"),
        flags["is_capture"].alias("is_capture"), flags["is_castling"].alias("is_castling"),
    )


# --- per-ply features ----------------------------------------------------------


def q_piece_type(spark, sf):
    m = _raw(spark, sf)["moves"]  # no evaluation is needed
    return m.select("game_id", "move_offset", "move_san", piece_type(F.col("move_san")).alias("piece_type"))


def q_move_flags(spark, sf):
    m = _raw(spark, sf)["moves"]
    flags = move_flags(F.col("move_san"))
    return m.select("game_id", "move_offset", *[c.alias(n) for n, c in flags.items()])


def q_eval_delta(spark, sf):
    _, m = _stg(spark, sf)
    return move_features(m).select("game_id", "move_offset", "eval_score", "eval_delta")


def q_eval_volatility(spark, sf):
    _, m = _stg(spark, sf)
    out = move_features(m).select("game_id", "move_offset", "eval_score", "eval_volatility_3")
    return _r6(out, ["eval_volatility_3"])


def q_move_features(spark, sf):
    _, m = _stg(spark, sf)
    return _r6(move_features(m), ["eval_volatility_3"])


def q_opening_patterns(spark, sf):
    raw = _raw(spark, sf)  # the moves alone: each ply has one evaluation at most
    return opening_patterns(raw["moves"], stage_games(raw["games"]))


# --- games as arrays of plies -------------------------------------------------


def _arrays(spark, sf) -> DataFrame:
    return parse_game_arrays(analysed_only(_feed(spark, sf)), _ingested())


def q_array_features(spark, sf):
    return _r6(features_from_arrays(_arrays(spark, sf)), ["eval_volatility_3"])


def q_array_openings(spark, sf):
    return openings_from_arrays(_arrays(spark, sf))


def q_array_facts(spark, sf):
    return _r6(facts_from_arrays(_arrays(spark, sf)), _AGG_FLOATS, 8)  # means of parsed ratios lie halfway at 6


# --- trajectories --------------------------------------------------------------

_TRAJ_FLOATS = ["rolling_10_win_rate", "rolling_10_avg_accuracy"]


def q_player_games(spark, sf):
    g, _ = _stg(spark, sf)
    return player_games(g)


def q_rating_trajectories(spark, sf):
    g, _ = _stg(spark, sf)
    return _r6(rating_trajectories(g), _TRAJ_FLOATS)


def q_rolling_form(spark, sf):
    g, _ = _stg(spark, sf)
    t = rating_trajectories(g)
    out = t.select(
        "username", "perf_type", "game_id", "color", "game_sequence",
        "prev_rating", "next_rating", *_TRAJ_FLOATS,
    )
    return _r6(out, _TRAJ_FLOATS)


# --- marts ---------------------------------------------------------------------

_AGG_FLOATS = ["avg_eval_magnitude", "avg_time_left_ratio"]


def q_move_aggregates(spark, sf):
    _, m = _stg(spark, sf)
    return _r6(move_aggregates(move_features(m)), _AGG_FLOATS)


def q_match_timing(spark, sf):
    g, _ = _stg(spark, sf)
    return match_timing(g)


def _facts(spark, sf) -> DataFrame:
    g, m = _stg(spark, sf)
    return match_facts(g, move_features(m), opening_patterns(_raw(spark, sf)["moves"], g))


def q_match_facts(spark, sf):
    return _r6(_facts(spark, sf), _AGG_FLOATS)


def q_player_current_rating(spark, sf):
    return player_current_rating(q_player_games(spark, sf))


def q_player_dim(spark, sf):
    return _r6(player_dim(q_player_games(spark, sf)), ["win_rate", "white_win_rate", "black_win_rate"])


def q_canonical_openings(spark, sf):
    return canonical_openings(_facts(spark, sf))


_RATE_FLOATS = ["white_win_rate", "black_win_rate", "draw_rate"]


def q_opening_stats(spark, sf):
    return _r6(opening_stats(_facts(spark, sf)), _RATE_FLOATS)


def q_opening_dim(spark, sf):
    return _r6(opening_dim(_facts(spark, sf)), _RATE_FLOATS)


def q_opening_join(spark, sf):
    """The opening dimension by its left join of stats and sequences."""
    facts = stored(_facts(spark, sf), "facts")  # read by both sides
    return _r6(join_canonical(opening_stats(facts), canonical_openings(facts)), _RATE_FLOATS)


# --- data checks -----------------------------------------------------------------


def _checks(kind: str | None) -> Query:
    def run(spark, sf):
        rules = [r for r in PIPELINE_RULES if kind is None or r.kind == kind]
        return check_models(spark, _raw(spark, sf), rules, co_partition=not adapter.are_bucketed(spark, sf))

    return run


def q_check_failures(spark, sf):
    """The report of a refresh over raw tables with planted faults, as it was
    observed while the tables were written."""
    raw = _raw(spark, sf)
    k, offset = F.col("game_id").cast("long"), F.col("move_offset")
    games = raw["games"].withColumn("_k", k).withColumns({
        "game_id": F.when(k % 43 != 0, F.col("game_id")),
        "winner": F.when(k % 47 == 0, F.lit("nobody")).otherwise(F.col("winner")),
        "perf_type": F.when(k % 59 == 0, F.lit("hyper")).otherwise(F.col("perf_type")),
    })
    moves = raw["moves"].withColumn("game_id", F.when((k % 37 != 0) | (offset != 1), F.col("game_id")))
    evals = raw["move_evals"].withColumns({
        "game_id": F.when((k % 31 != 0) | (offset != 0), F.col("game_id")),
        "move_offset": F.when(k % 61 != 0, offset),
        "judgment": F.when((k % 29 == 0) & F.col("judgment").isNotNull(), F.lit("Oops")).otherwise(F.col("judgment")),
    })
    planted = {"games": games.unionByName(games.where("_k % 41 = 0")).drop("_k"), "moves": moves, "move_evals": evals}
    narrow = [accepted_range("match_facts", "total_plies", max_value=4), accepted_range("player_dim", "win_rate", 0.2, 0.8)]
    out = _scratch(spark, sf, "planted")
    return refresh_from_tables(
        spark, planted, out, rules=[*PIPELINE_RULES, *narrow], run_id="planted", table_prefix="plyspark_planted"
    ).report


# --- what a refresh stores -------------------------------------------------------


def _refreshed(spark, sf, name="refresh", **options) -> PipelineResult:
    """The stored refresh over the fixture's feed; run once for a source."""
    ensure_conf(spark)
    out = _scratch(spark, sf, name)
    load_time = datetime.fromisoformat(adapter.INGESTED_AT_TEXT).replace(tzinfo=timezone.utc)
    prefix = f"plyspark_{name}_{os.path.basename(out)}"
    return run_pipeline(spark, adapter.stored_feed_path(spark, sf), out, run_id="fixture", ingested_at=load_time, table_prefix=prefix, **options)


def q_stored_match_facts(spark, sf):
    return _r6(_refreshed(spark, sf).read("match_facts"), _AGG_FLOATS, 8)


def q_stored_game(spark, sf):
    """The stored plies of a refresh of one game."""
    game_id = _newest(analysed_only(_feed(spark, sf)), "id")[0]
    return _r6(_refreshed(spark, sf, "one_game", game_id=game_id).read("move_features"), ["eval_volatility_3"])


def q_view_stg_games(spark, sf):
    """The staged games as another session sees them in the catalog."""
    _refreshed(spark, sf)
    prefix = f"plyspark_refresh_{os.path.basename(adapter.materialize(spark, sf))}"
    return ensure_conf(spark.newSession()).table(f"{prefix}_stg_games")


def q_empty_refresh(spark, sf):
    """A refresh for a user without games fails; the stored tables stay."""
    stored = _refreshed(spark, sf)
    try:
        run_pipeline(spark, adapter.stored_feed_path(spark, sf), stored.out_dir, username="nobody at all")
        error = None
    except ValueError as e:
        error = str(e)
    counts = [
        stored.read(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), F.lit(error).alias("error"), "n_rows")
        for name in ("games", "moves", "match_facts", "player_dim")
    ]
    return reduce(DataFrame.unionByName, counts)


def q_csv_round_trip(spark, sf):
    """Raw games written as one CSV file and read back."""
    path = write_csv(_raw(spark, sf)["games"], _scratch(spark, sf, "csv"), "fixture", "games", "20260101_000000")
    return read_raw_csv(spark, path, "games")


def q_table_round_trip(spark, sf):
    """Raw moves given as text, loaded into a typed table and read back."""
    moves = _raw(spark, sf)["moves"]
    load = Store(spark, _scratch(spark, sf, "table")).load(uuid.uuid4().hex)
    load.write("moves", lambda: moves.select([F.col(c).cast("string") for c in moves.columns]), RAW_SCHEMAS["moves"])
    load.commit("raw")
    return load.store.read("moves")


QUERIES: dict[str, Query] = {
    "scan_json": q_scan_json,
    "single_game": q_single_game,
    "feed_user": q_feed_user,
    "feed_quarantine": q_feed_quarantine,
    "feed_analysed": q_feed_analysed,
    "feed_perf_filter": q_feed_perf_filter,
    "feed_latest_n": q_feed_latest_n,
    "parse_games": q_parse_games,
    "parse_moves": q_parse_moves,
    "parse_evals": q_parse_evals,
    "stage_games": q_stage_games,
    "time_control_label": q_time_control_label,
    "stage_moves": q_stage_moves,
    "odd_plies": q_odd_plies,
    "piece_type": q_piece_type,
    "move_flags": q_move_flags,
    "eval_delta": q_eval_delta,
    "eval_volatility": q_eval_volatility,
    "move_features": q_move_features,
    "opening_patterns": q_opening_patterns,
    "player_games": q_player_games,
    "rating_trajectories": q_rating_trajectories,
    "rolling_form": q_rolling_form,
    "move_aggregates": q_move_aggregates,
    "match_timing": q_match_timing,
    "match_facts": q_match_facts,
    "player_current_rating": q_player_current_rating,
    "player_dim": q_player_dim,
    "canonical_openings": q_canonical_openings,
    "opening_stats": q_opening_stats,
    "opening_dim": q_opening_dim,
    "opening_join": q_opening_join,
    "check_unique": _checks("unique"),
    "check_not_null": _checks("not_null"),
    "check_accepted_values": _checks("accepted_values"),
    "check_range": _checks("accepted_range"),
    "data_checks": _checks(None),
    "check_failures": q_check_failures,
    "array_features": q_array_features,
    "array_openings": q_array_openings,
    "array_facts": q_array_facts,
    "stored_match_facts": q_stored_match_facts,
    "stored_game": q_stored_game,
    "view_stg_games": q_view_stg_games,
    "empty_refresh": q_empty_refresh,
    "csv_round_trip": q_csv_round_trip,
    "table_round_trip": q_table_round_trip,
}
