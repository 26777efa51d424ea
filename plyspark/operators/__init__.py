"""The pipeline operators; each is a pure ``DataFrame -> DataFrame`` function."""

from plyspark.operators.checks import PIPELINE_RULES, Rule, run_checks
from plyspark.operators.features import move_features
from plyspark.operators.marts import (
    canonical_openings,
    match_facts,
    match_timing,
    move_aggregates,
    opening_dim,
    opening_stats,
    player_current_rating,
    player_dim,
)
from plyspark.operators.openings import opening_patterns
from plyspark.operators.parse import parse_games
from plyspark.operators.staging import stage_games, stage_moves
from plyspark.operators.trajectories import player_games, rating_trajectories

__all__ = [
    "PIPELINE_RULES",
    "Rule",
    "canonical_openings",
    "match_facts",
    "match_timing",
    "move_aggregates",
    "move_features",
    "opening_dim",
    "opening_patterns",
    "opening_stats",
    "parse_games",
    "player_current_rating",
    "player_dim",
    "player_games",
    "rating_trajectories",
    "run_checks",
    "stage_games",
    "stage_moves",
]
