import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plyspark.operators.features import move_features
from plyspark.operators.marts import (
    canonical_openings,
    join_canonical,
    match_facts,
    opening_dim,
    opening_stats,
    has_short_ids,
    player_current_rating,
    player_dim,
)
from plyspark.operators.openings import opening_patterns
from plyspark.operators.staging import stage_games, stage_moves
from plyspark.operators.trajectories import player_games, rating_trajectories
from plyspark.sources import adapter
from tests.conftest import SF_SMALL


def _models(spark):
    raw = adapter.stored_raw_tables(spark, SF_SMALL)
    g = stage_games(raw["games"])
    m = stage_moves(raw["moves"], raw["move_evals"])
    f = move_features(m)
    facts = match_facts(g, f, opening_patterns(m, g))
    return g, m, f, facts


def test_fact_properties(spark):
    g, _, _, facts = _models(spark)
    assert facts.count() == g.count()
    bad = facts.where(
        (F.col("white_plies") + F.col("black_plies") != F.col("total_plies"))
        | (F.col("rating_gap") != F.abs(F.col("white_rating") - F.col("black_rating")))
    )
    assert bad.isEmpty()
    # untimed games are dropped from the fact table
    assert facts.where(F.col("time_control_initial") <= 0).isEmpty()


def test_opening_counts_bounded_by_depth(spark):
    g, m, _, _ = _models(spark)
    op = opening_patterns(m, g).join(g.select("game_id", "opening_ply"), "game_id")
    assert op.where(F.col("opening_move_count") > F.col("opening_ply")).isEmpty()
    assert op.where(F.col("opening_move_count") < 1).isEmpty()


def test_opening_dim_equals_stats_join_canonical(spark):
    *_, facts = _models(spark)
    joined = join_canonical(opening_stats(facts), canonical_openings(facts))
    assert sorted(map(str, joined.collect())) == sorted(map(str, opening_dim(facts).collect()))
    # same ordering: most played first
    fused = [(r.times_played, r.opening_eco, r.opening_name) for r in opening_dim(facts).collect()]
    assert fused == sorted(fused, key=lambda x: (-x[0], x[1], x[2] is None, x[2] or ""))


def test_player_dim_properties(spark):
    g, *_ = _models(spark)
    pd_ = player_dim(rating_trajectories(g))
    assert pd_.where(F.col("wins") + F.col("draws") + F.col("losses") != F.col("total_games")).isEmpty()
    assert pd_.where(F.col("white_games") + F.col("black_games") != F.col("total_games")).isEmpty()
    assert pd_.where(F.col("username").isNull()).isEmpty()
    assert pd_.select("username").distinct().count() == pd_.count()


_T = ("game_id string, game_created_at timestamp, username string, color string, rating long, "
      "rating_diff long, accuracy double, game_result string, perf_type string")


def test_current_rating_keeps_null_and_ties(spark):
    rows = [
        ("a", datetime(2024, 1, 1), "p", "white", 1500, 0, 80.0, "win", "rapid"),
        ("b", datetime(2024, 1, 2), "p", "black", None, 0, 70.0, "loss", "blitz"),
        ("c", datetime(2024, 1, 1), "q", "white", 1600, 0, 90.0, "draw", "rapid"),
        ("d", datetime(2024, 1, 1), "q", "black", 1700, 0, 91.0, "win", "rapid"),
    ]
    t = spark.createDataFrame(rows, _T)
    cur = {r.username: r.current_rating for r in player_current_rating(t).collect()}
    assert cur == {"p": None, "q": 1700}  # NULL at the latest game; tie -> larger game id
    dim = {r.username: r for r in player_dim(t).collect()}
    assert dim["q"].preferred_color == "white"  # 1 white vs 1 black -> white
    assert dim["p"].active_days == 1 and dim["p"].peak_rating == 1500


@pytest.mark.parametrize("ids", ["short", "long"])
def test_latest_rating_by_packed_key_and_by_struct(spark, ids):
    rng = random.Random(4)
    t0 = datetime(2024, 1, 1)
    times = [None, t0, t0 + timedelta(microseconds=1), t0 + timedelta(days=1), datetime(1960, 5, 5), datetime(1, 1, 2), datetime(9999, 12, 30)]
    rows, seen = [], set()
    for _ in range(1500):
        game = "".join(rng.choices("abz19Zé~", k=rng.randrange(1, 5))) + ("-of-more-bytes" if ids == "long" else "")
        row = (game, rng.choice(times), rng.choice("abcdefghijk"), rng.choice(["white", "black"]))
        if row not in seen:
            seen.add(row)
            rows.append((*row, rng.choice([None, rng.randrange(3000)]), 0, 1.0, "win", "rapid"))
    t = spark.createDataFrame(rows, _T)
    assert has_short_ids(t) == (ids == "short")
    got = {r.username: r.current_rating for r in player_current_rating(t).collect()}
    latest = {}
    for game, time, user, color, rating, *_ in rows:
        key = (time is not None, time or t0, game.encode(), color)
        if user not in latest or key > latest[user][0]:
            latest[user] = (key, rating)
    assert got == {u: r for u, (_, r) in latest.items()}


def test_identifiers_that_do_not_fit_a_key(spark):
    for odd in (None, "", "123456789", "a\0"):
        assert not has_short_ids(spark.createDataFrame([("ok",), (odd,)], "game_id string"))
    assert has_short_ids(spark.createDataFrame([("ok",), ("12345678",)], "game_id string"))


def test_player_dim_aggregates_by_hash(spark):
    g, *_ = _models(spark)
    plan = player_dim(player_games(g))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_duration_truncates_toward_zero(spark):
    from plyspark.operators.marts import match_timing

    rows = [("x", datetime(2024, 1, 1, 0, 0, 1), datetime(2024, 1, 1, 0, 0, 2, 999000)),
            ("y", datetime(2024, 1, 1, 0, 0, 2, 999000), datetime(2024, 1, 1, 0, 0, 1))]
    g = spark.createDataFrame(rows, "game_id string, game_created_at timestamp, game_ended_at timestamp")
    got = {r.game_id: r.game_duration_sec for r in match_timing(g).collect()}
    assert got == {"x": 1, "y": -1}


def test_null_name_group_gets_no_canonical(spark):
    *_, facts = _models(spark)
    f = facts.withColumn("opening_name", F.when(F.col("opening_name") == "Opening 1", None)
                         .otherwise(F.col("opening_name")))
    for dim in (opening_dim(f), join_canonical(opening_stats(f), canonical_openings(f))):
        nulls = dim.where(F.col("opening_name").isNull()).collect()
        assert nulls and all(r.canonical_moves is None for r in nulls)
