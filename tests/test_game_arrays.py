"""Games as arrays of plies give the rows of the joined path."""

import json
import os
from datetime import datetime, timezone

from pyspark.sql import functions as F

from plyspark.operators.features import move_features
from plyspark.operators.game_arrays import (
    _score,
    evals_table,
    facts_from_arrays,
    features_from_arrays,
    games_table,
    moves_table,
    openings_from_arrays,
    parse_game_arrays,
)
from plyspark.operators.marts import match_facts
from plyspark.operators.openings import opening_patterns
from plyspark.operators.parse import parse_games
from plyspark.operators.staging import stage_games, stage_moves
from plyspark.sources import adapter
from plyspark.sources.feed import read_feed
from tests.conftest import SF_SMALL

NOW = datetime(2026, 1, 1, tzinfo=timezone.utc)

ODD = [
    {"id": "g1", "perf": "rapid", "moves": "e4 e5 Nf3", "clock": {"initial": 600}, "opening": {"eco": "C20", "name": "x", "ply": 9},
     "analysis": [{"eval": 20}, {"mate": 3, "judgment": {"name": "Blunder"}}], "clocks": [59000], "createdAt": 5, "lastMoveAt": 4000},
    {"id": "g2", "perf": "rapid", "moves": "", "clock": {"initial": 60, "increment": 1}, "opening": {"ply": 2}, "createdAt": 7},
    {"id": "g3", "perf": "rapid", "clock": {"initial": 60}, "createdAt": 8, "analysis": [{"eval": 1}]},
    {"id": "g4", "perf": "rapid", "moves": " O-O  exd8=Q# ", "createdAt": 9, "analysis": [{}, {"eval": -3}, {"eval": 4}]},
    {"id": "g5", "perf": "blitz", "moves": "a b c d e f", "clock": {"initial": 60}, "winner": "white", "opening": {"ply": 0},
     "analysis": [{"eval": 1}, {"eval": 5}, {}, {}, {}, {"eval": 2, "judgment": {"name": "Mistake"}}], "createdAt": None},
    {"id": "g6", "perf": "blitz", "moves": "Bxc4+ Kf8", "clock": {"initial": 15}, "opening": {"ply": 1, "eco": "A00"},
     "players": {"white": {"user": {"name": "ANN"}, "rating": 1500}}, "analysis": [{"judgment": {"name": "Inaccuracy"}}], "clocks": [None, 5]},
]


def _rows(df):
    floats = [c for c, t in df.dtypes if t == "double"]
    return sorted(tuple(repr(v) for v in r) for r in df.withColumns({c: F.round(c, 9) for c in floats}).collect())


def _same(feed):
    arrays = parse_game_arrays(feed, NOW)
    games, moves, evals = parse_games(feed, NOW)
    stg_games, stg_moves = stage_games(games), stage_moves(moves, evals)
    features, openings = move_features(stg_moves), opening_patterns(stg_moves, stg_games)
    for got, expected in [
        (games_table(arrays), games), (moves_table(arrays), moves), (evals_table(arrays), evals),
        (features_from_arrays(arrays), features), (openings_from_arrays(arrays), openings),
        (facts_from_arrays(arrays), match_facts(stg_games, features, openings)),
    ]:
        assert got.dtypes == expected.dtypes
        assert _rows(got) == _rows(expected)
    return arrays


def test_arrays_equal_joined_path_on_odd_games(spark, scratch):
    path = os.path.join(scratch, "odd.ndjson")
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(g) for g in ODD))
    arrays = _same(read_feed(spark, path))
    assert openings_from_arrays(arrays).count() == 2 and facts_from_arrays(arrays).count() == 5


def test_arrays_equal_joined_path_on_the_fixture(spark):
    _same(read_feed(spark, adapter.stored_feed_path(spark, SF_SMALL)))


def test_arrays_need_no_exchange(spark):
    arrays = parse_game_arrays(read_feed(spark, adapter.stored_feed_path(spark, SF_SMALL)), NOW)
    for df in (features_from_arrays(arrays), openings_from_arrays(arrays), facts_from_arrays(arrays)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


def test_a_plys_score_builds_no_array_of_all():
    """Else the features of a game cost the square of its length."""
    assert "get(plies," in str(_score(F.col("x")))
