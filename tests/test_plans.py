"""Plan-shape regression tests, with broadcast joins disabled so the plans
are the ones a large cluster gets (every join side above the threshold)."""

from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest

from plyspark import registry
from plyspark.plans import skew
from plyspark.operators.trajectories import PLAYER_KEYS, PLAYER_ORDER, rating_trajectories
from plyspark.plans.skew import range_sizes
from tests.conftest import SF_SMALL
from tests.test_trajectories import _games


@contextmanager
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> int:
    return sum(1 for ln in plan.splitlines() if "Exchange hashpartitioning" in ln
               or "Exchange rangepartitioning" in ln or "Exchange SinglePartition" in ln)


# The registered queries read games, plies and evals from tables bucketed by game.
@pytest.mark.parametrize("key,limit", [
    ("stage_games", 0),
    ("stage_moves", 0),          # bucketed join
    ("move_features", 0),        # window reuses the bucketing
    ("move_aggregates", 0),      # so does the per-game aggregate
    ("opening_patterns", 0),     # games are co-bucketed with the plies
    ("match_facts", 0),          # fact joins too
    ("rating_trajectories", 1),  # one exchange for all five windows
    ("player_dim", 1),
    ("opening_dim", 3),          # per-sequence aggregate, per-opening window, final order
])
def test_exchange_budget(spark, key, limit):
    with no_broadcast(spark):
        plan = _plan(registry.QUERIES[key](spark, SF_SMALL))
    assert _shuffles(plan) <= limit, plan


def test_plain_parquet_plies_shuffle_once_per_side(spark, scratch):
    """Unbucketed plies: one exchange per side, reused by window and aggregate."""
    import os

    from plyspark.operators.features import move_features
    from plyspark.operators.marts import move_aggregates
    from plyspark.operators.staging import stage_moves
    from plyspark.sources import adapter

    raw = adapter.stored_raw_tables(spark, SF_SMALL)
    for name in ("moves", "move_evals"):
        raw[name].write.mode("overwrite").parquet(os.path.join(scratch, name))
    m = spark.read.parquet(os.path.join(scratch, "moves"))
    e = spark.read.parquet(os.path.join(scratch, "move_evals"))
    with no_broadcast(spark):
        plan = _plan(move_aggregates(move_features(stage_moves(m, e))))
    assert _shuffles(plan) == 2, plan
    assert "hashpartitioning(game_id" in plan and "move_offset#" not in plan.split("Exchange")[1][:60]


def test_scans_are_pruned_and_filtered(spark):
    plan = _plan(registry.QUERIES["stage_games"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(time_control_initial), GreaterThan(time_control_initial,0)]" in plan
    plan = _plan(registry.QUERIES["player_dim"](spark, SF_SMALL))
    scan = [ln for ln in plan.splitlines() if "FileScan" in ln][0]
    assert "variant" not in scan and "opening_name" not in scan


def test_unused_windows_are_pruned(spark):
    plan = _plan(registry.QUERIES["move_aggregates"](spark, SF_SMALL))
    assert "Window [" not in plan


def test_top1_per_group_is_limited_before_shuffle(spark):
    with no_broadcast(spark):
        plan = _plan(registry.QUERIES["canonical_openings"](spark, SF_SMALL))
    assert plan.count("WindowGroupLimit") == 2  # partial (map side) + final


def _one_key(spark, times):
    rows = [(f"g{i:04d}", t, "hero", "white", "rapid") for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "game_id string, game_created_at timestamp, username string, color string, perf_type string")


@pytest.mark.parametrize("shape", ["spread", "outlier", "one timestamp", "no timestamp", "burst"])
def test_ranges_of_a_hot_key_are_balanced(spark, shape):
    t0 = datetime(2024, 1, 1)
    times = {
        "spread": [t0 + timedelta(minutes=i) for i in range(400)],
        "outlier": [datetime(1970, 1, 1)] + [t0 + timedelta(minutes=i) for i in range(400)],
        "one timestamp": [t0] * 400,
        "no timestamp": [None] * 400,
        "burst": [t0 + timedelta(days=i) for i in range(20)] + [t0 + timedelta(days=7, seconds=i // 50) for i in range(380)],
    }[shape]
    sizes = range_sizes(_one_key(spark, times), PLAYER_KEYS, PLAYER_ORDER, 20)
    rows = sorted(r["rows"] for r in sizes.collect())
    assert sum(rows) == len(times) and len(rows) >= 20 and rows[-1] <= 2 * 20


def test_ranges_from_a_sample_are_balanced(spark, monkeypatch):
    monkeypatch.setattr(skew, "SAMPLES_PER_RANGE", 64)
    df = spark.range(40_000).selectExpr("cast(id % 2 as string) as k", "pow(id, 3) as t", "id")
    rows = [r["rows"] for r in range_sizes(df.where("k = '0' or id < 900"), ["k"], ["t", "id"], 1000).collect()]
    assert len(rows) > 15 and max(rows) <= 2 * 1000


def test_no_more_ranges_than_allowed(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_RANGES", 4)
    t0 = datetime(2024, 1, 1)
    sizes = range_sizes(_one_key(spark, [t0] * 400), PLAYER_KEYS, PLAYER_ORDER, 20)
    assert sorted(r["rows"] for r in sizes.collect()) == [100] * 4


def test_hot_window_runs_once(spark):
    """The source is read for the other keys' rows alone; the hot keys' windows
    are stored, and what is windowed again is the halo."""
    plan = _plan(rating_trajectories(_games(spark, 400), rows_per_range=20))
    assert plan.count("Scan ExistingRDD") == 1, plan
    windows = [ln for ln in plan.splitlines() if "Window [" in ln]
    assert sum("rolling_10_win_rate" in ln or "avg(" in ln for ln in windows) <= 2, plan  # other keys, halo
