"""The staging models as views in the catalog.

A refresh points catalog tables at the current versions of the stored tables;
these views, plain SQL over them, stay when the session ends, so any other
session or SQL client reads the models without Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

STG_GAMES_SQL = """
SELECT
    game_id,
    lower(white_username) AS white_username, lower(black_username) AS black_username,
    white_rating, black_rating, white_rating_diff, black_rating_diff, white_accuracy, black_accuracy,
    winner, nvl(winner, 'draw') AS result, status, perf_type, nvl(variant, 'standard') AS variant,
    opening_eco, opening_name, opening_ply, time_control_initial, time_control_increment,
    if(time_control_initial % 60 = 0,
       string(time_control_initial DIV 60),
       string(double(time_control_initial) / 60D)) || '+' || string(time_control_increment) AS time_control_label,
    timestamp_millis(created_at) AS game_created_at, timestamp_millis(last_move_at) AS game_ended_at,
    ingested_at
FROM {prefix}_games
WHERE time_control_initial > 0
"""

STG_MOVES_SQL = """
SELECT
    game_id, move_offset, m.move_number, m.color, lower(m.username) AS username, m.move_san,
    e.eval_score, e.mate_in, e.best_move, e.variation, e.judgment, e.time_left_cs, e.time_left_ratio
FROM {prefix}_moves m LEFT JOIN {prefix}_move_evals e USING (game_id, move_offset)
"""

VIEWS = {"stg_games": STG_GAMES_SQL, "stg_moves": STG_MOVES_SQL}


def point_table(spark: SparkSession, table: str, path: str, schema: T.StructType) -> None:
    """A catalog table over the files at ``path``; one that is there is moved
    to them by a single change of its location."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if spark.catalog.tableExists(table):
        known = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
        if known == [(f.name, f.dataType) for f in schema.fields]:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")


def create_views(spark: SparkSession, prefix: str) -> None:
    for name, text in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}_{name} AS {text.format(prefix=prefix)}")
