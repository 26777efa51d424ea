"""Values worked out by hand for the games in data/hand_made_games.csv."""

import os
from datetime import date, datetime

import pytest

from plyspark.operators.marts import match_facts, opening_stats, player_dim
from plyspark.operators.openings import opening_patterns
from plyspark.operators.features import move_features
from plyspark.operators.staging import stage_games, stage_moves
from plyspark.operators.trajectories import player_games, rating_trajectories
from plyspark.schemas import EVALS_SCHEMA, MOVES_SCHEMA
from plyspark.sources.tables import read_raw_csv

CSV = os.path.join(os.path.dirname(__file__), "data", "hand_made_games.csv")


@pytest.fixture(scope="module")
def games(spark):
    return read_raw_csv(spark, "file://" + CSV, "games")


def test_types_and_staging(games):
    raw = {r.game_id: r for r in games.collect()}
    assert raw["g1"].white_rating == 1500 and raw["g2"].white_rating_diff is None
    assert raw["g1"].ingested_at == datetime(2024, 2, 1, 0, 0, 0, 123456)
    assert raw["g1"].opening_name == "King's Pawn Game: Wayward, Open" and raw["g7"].black_username is None
    staged = {r.game_id: r for r in stage_games(games).collect()}
    assert set(staged) == {"g1", "g2", "g3", "g4", "g5", "g7"}  # g6 has no clock
    assert {k: r.time_control_label for k, r in staged.items()} == {
        "g1": "10+5", "g2": "1.5+0", "g3": "10+0", "g4": "0.25+0", "g5": "3+2", "g7": "30+30"}
    assert staged["g3"].result == "draw" and staged["g2"].variant == "standard" and staged["g2"].white_username == "bo"
    assert staged["g1"].game_created_at == datetime(2024, 1, 1, 10)


def test_facts(spark, games):
    stg = stage_games(games)
    moves = spark.createDataFrame([], MOVES_SCHEMA)
    plies = stage_moves(moves, spark.createDataFrame([], EVALS_SCHEMA))
    facts = {r.game_id: r for r in match_facts(stg, move_features(plies), opening_patterns(plies, stg)).collect()}
    assert {k: r.game_duration_sec for k, r in facts.items()} == {"g1": 600, "g2": 60, "g3": 0, "g4": 300, "g5": 300, "g7": 1800}
    assert facts["g4"].game_date == date(2024, 1, 5) and facts["g1"].rating_gap == 100 and facts["g5"].rating_gap is None
    assert facts["g1"].total_plies is None and facts["g1"].opening_moves_string is None


def test_trajectory(games):
    t = [r for r in rating_trajectories(stage_games(games)).collect() if r.username == "ada" and r.perf_type == "rapid"]
    rows = [(r.game_id, r.color, r.game_result, r.rating, r.prev_rating, r.next_rating, r.rolling_10_win_rate, r.rolling_10_avg_accuracy)
            for r in sorted(t, key=lambda r: r.game_sequence)]
    assert rows == [
        ("g1", "white", "win", 1500, None, 1510, 1.0, 80.0),
        ("g2", "black", "loss", 1510, 1500, 1500, 0.5, 75.0),
        ("g3", "white", "draw", 1500, 1510, 1505, 1 / 3, 75.0),
        ("g4", "black", "win", 1505, 1500, None, 0.5, 80.0),
    ]


def test_players(games):
    d = {r.username: r for r in player_dim(player_games(stage_games(games))).collect()}
    assert set(d) == {"ada", "bo", "cy"}
    ada = d["ada"]
    assert (ada.total_games, ada.wins, ada.draws, ada.losses, ada.white_games, ada.black_games) == (6, 4, 1, 1, 4, 2)
    assert (ada.win_rate, ada.white_win_rate, ada.black_win_rate) == (4 / 6, 3 / 4, 1 / 2)
    # ratings 1500 1510 1500 1505 1505; the latest game, g5, has none
    assert (ada.avg_rating, ada.peak_rating, ada.lowest_rating, ada.current_rating) == (1504.0, 1510, 1500, None)
    assert (ada.avg_accuracy, ada.best_accuracy) == (80.4, 90.0)  # 402 / 5
    assert ada.preferred_color == "white" and ada.active_days == 5 and d["bo"].preferred_color == "white"
    assert d["cy"].current_rating == 1590 and d["cy"].win_rate == 0.0


def test_openings(spark, games):
    stg = stage_games(games)
    plies = stage_moves(spark.createDataFrame([], MOVES_SCHEMA), spark.createDataFrame([], EVALS_SCHEMA))
    facts = match_facts(stg, move_features(plies), opening_patterns(plies, stg))
    rows = {r.opening_eco: r for r in opening_stats(facts).collect()}
    assert set(rows) == {"B01", "C20"}
    assert (rows["B01"].times_played, rows["B01"].white_wins, rows["B01"].black_wins, rows["B01"].draws) == (3, 1, 1, 1)
    assert rows["B01"].avg_duration_min == 3.3 and rows["C20"].avg_duration_min == 5.5  # 200 s, 330 s
