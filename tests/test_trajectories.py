from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from plyspark.operators.staging import stage_games
from plyspark.operators.trajectories import (
    PLAYER_KEYS,
    PLAYER_ORDER,
    _trajectory_window_cols,
    player_games,
    rating_trajectories,
)
from plyspark.schemas import TRAJECTORY_COLUMNS
from plyspark.sources import adapter
from tests.conftest import SF_SMALL

_GAME = ("game_id string, white_username string, black_username string, white_rating long, "
         "black_rating long, white_rating_diff long, black_rating_diff long, white_accuracy double, "
         "black_accuracy double, winner string, result string, status string, perf_type string, "
         "variant string, opening_eco string, opening_name string, opening_ply long, "
         "time_control_initial long, time_control_increment long, time_control_label string, "
         "game_created_at timestamp, game_ended_at timestamp, ingested_at timestamp")


def _games(spark, n, hot="hero", anon_every=4):
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        t = t0 + timedelta(minutes=7 * i + (i % 5))  # uneven spacing
        other = None if i % anon_every == 0 else f"opp{i % 3}"
        white, black = (hot, other) if i % 2 == 0 else (other, hot)
        result = ["white", "black", "draw"][i % 3]
        acc = None if i % 7 == 0 else float(60 + i % 30)
        rows.append((f"g{i:04d}", white, black, 1500 + i, 1400 + (i * 13) % 300, 1, -1, acc,
                     70.0, None if result == "draw" else result, result, "mate",
                     "rapid" if i % 5 else "blitz", "standard", "C20", "x", 4, 600, 5, "10+5",
                     t, t + timedelta(minutes=5), t0))
    return spark.createDataFrame(rows, _GAME)


def plain_rating_trajectories(stg_games):
    """One plain window a player, however many games there are."""
    w = Window.partitionBy(*PLAYER_KEYS).orderBy(*PLAYER_ORDER)
    return _trajectory_window_cols(player_games(stg_games), w).select(*TRAJECTORY_COLUMNS)


def _rows(df):
    return sorted((tuple(repr(v) for v in r) for r in df.collect()))


def test_segmented_equals_plain_on_hot_players(spark):
    g = _games(spark, 160)
    plain = _rows(plain_rating_trajectories(g))
    for seg in (3, 7, 10, 11, 25):
        assert _rows(rating_trajectories(g, rows_per_range=seg)) == plain, seg


def test_segmented_equals_plain_on_driver_data(spark):
    stg = stage_games(adapter.stored_raw_tables(spark, SF_SMALL)["games"])
    plain = _rows(plain_rating_trajectories(stg))
    assert _rows(rating_trajectories(stg, rows_per_range=5)) == plain


def test_sequence_is_one_to_n_and_two_rows_per_game(spark):
    g = _games(spark, 60)
    t = rating_trajectories(g, rows_per_range=4)
    assert t.count() == 2 * g.count()
    seqs = (t.groupBy("username", "perf_type")
            .agg(F.count(F.lit(1)).alias("n"), F.min("game_sequence").alias("lo"),
                 F.max("game_sequence").alias("hi"), F.countDistinct("game_sequence").alias("d"))
            .collect())
    for r in seqs:
        assert r.lo == 1 and r.hi == r.n == r.d


def test_rolling_frames(spark):
    g = _games(spark, 30, anon_every=1000)
    rows = {r.game_id: r for r in plain_rating_trajectories(g)
            .where((F.col("username") == "hero") & (F.col("perf_type") == "rapid")).collect()}
    ordered = sorted(rows.values(), key=lambda r: r.game_created_at)
    first = ordered[0]
    assert first.game_sequence == 1 and first.prev_rating is None
    assert first.next_rating == ordered[1].rating
    wins = [1.0 if r.game_result == "win" else 0.0 for r in ordered]
    assert abs(ordered[11].rolling_10_win_rate - sum(wins[2:12]) / 10) < 1e-12
    assert ordered[-1].next_rating is None


def test_player_games_unpivot_single_scan(spark):
    g = _games(spark, 10)
    pg = player_games(g)
    assert pg.count() == 20
    plan = pg._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 or plan.count("LocalTableScan") == 1
    outcomes = {(r.game_id, r.color): r.game_result for r in pg.collect()}
    assert outcomes[("g0000", "white")] == "win" and outcomes[("g0000", "black")] == "loss"
    assert outcomes[("g0002", "white")] == "draw"
