"""M5: the opening move sequence of each game (plies before ``opening_ply``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyspark.schemas import OPENING_PATTERN_COLUMNS


def opening_patterns(stg_moves: DataFrame, stg_games: DataFrame) -> DataFrame:
    """One row per game that has at least one ply inside its opening depth.

    Plies join their game (inner), keep ``move_offset < opening_ply`` and
    are concatenated in ply order (``listagg`` skips NULL moves).
    """
    m = stg_moves.select("game_id", "move_offset", "move_san")
    g = stg_games.select("game_id", "opening_ply", "opening_eco", "opening_name")
    opening_plies = m.join(g, "game_id").where(F.col("move_offset") < F.col("opening_ply"))
    return (
        opening_plies.groupBy("game_id", "opening_eco", "opening_name")
        .agg(
            F.expr("listagg(move_san, ' ') WITHIN GROUP (ORDER BY move_offset)")
            .alias("opening_moves_string"),
            F.count(F.lit(1)).alias("opening_move_count"),
        )
        .select(*OPENING_PATTERN_COLUMNS)
    )
