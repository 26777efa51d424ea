"""Feed scans and feed-level selection (before parsing).

The feed is newline-delimited JSON, one game object per line. It is read
with the explicit ``FEED_SCHEMA`` (no inference pass over the data); blank
lines produce no rows. Selection helpers are lazy DataFrame filters so
Catalyst can push them into the scan when the feed is stored as Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyspark.functions.scalar import PERF_GROUPS
from plyspark.schemas import FEED_SCHEMA


_NO_TIME = -(1 << 63)  # sorts a game without a time behind all others


def read_feed(
    spark: SparkSession,
    path: str,
    game_id: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """NDJSON feed scan (``multiline=True`` for one pretty-printed document).

    A line that is no such object fails the read rather than vanishing.
    With ``game_id`` the scan is narrowed to that one game.
    """
    reader = spark.read.schema(FEED_SCHEMA).option("mode", "FAILFAST")
    if multiline:
        reader = reader.option("multiLine", True)
    feed = reader.json(path)
    if game_id is not None:
        feed = feed.where(F.col("id") == F.lit(game_id))
    return feed


def read_feed_lines(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The feed with its bad lines: the columns of ``read_feed``, and of a line
    that is no game object its text (``bad_line``, NULL otherwise) and file."""
    schema = T.StructType([*FEED_SCHEMA.fields, T.StructField("bad_line", T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "bad_line")
    return reader.option("multiLine", multiline).json(path).select("*", F.col("_metadata.file_path").alias("bad_file"))


def perf_types_for(perf: str) -> list[str]:
    """Request mapping: ``"blitz"`` -> blitz; anything else -> rapid+classical."""
    return PERF_GROUPS["blitz"] if perf == "blitz" else PERF_GROUPS["default"]


def select_perf(feed: DataFrame, perf: str) -> DataFrame:
    return feed.where(F.col("perf").isin(perf_types_for(perf)))


def played_by(username: str) -> Column:
    """Games that a user played on either side; names ignore case."""
    name = F.lower(F.lit(username))
    sides = (F.lower(f"players.{side}.user.name") == name for side in ("white", "black"))
    return F.coalesce(next(sides), F.lit(False)) | F.coalesce(next(sides), F.lit(False))


def select_user(feed: DataFrame, username: str) -> DataFrame:
    return feed.where(played_by(username))


def latest_games(feed: DataFrame, n: int, time_col: str = "createdAt", id_col: str = "id") -> DataFrame:
    """At most ``n`` newest games (by time, NULL last; ties by identifier).
    Runs two small jobs.

    The n-th key is found on its two columns alone; the games themselves are
    only filtered by it, so they stay in the partitions that read them. Only
    lines that repeat the n-th key, of which some don't fit, are cut by a limit.
    """
    if n <= 0:
        return feed.limit(0)
    time, name = F.coalesce(F.col(time_col), F.lit(_NO_TIME)), F.col(id_col)
    last = feed.select(time.alias("t"), name.alias("id")).orderBy(F.desc("t"), F.asc("id")).offset(n - 1).limit(1).collect()
    if not last:
        return feed
    t, game_id = last[0]
    before = F.lit(False) if game_id is None else name.isNull() | (name < game_id)
    above, level = (time > t) | ((time == t) & before), (time == t) & name.eqNullSafe(F.lit(game_id))
    taken = feed.agg(F.count_if(above).alias("above"), F.count_if(level).alias("level")).first()
    if taken["above"] + taken["level"] <= n:
        return feed.where(above | level)
    return feed.where(above).unionByName(feed.where(level).limit(n - taken["above"]))


def is_analysed() -> Column:
    """A game counts as analysed when its ``analysis`` array is non-empty."""
    return F.coalesce(F.size(F.col("analysis")) > 0, F.lit(False))


def analysed_only(feed: DataFrame) -> DataFrame:
    return feed.where(is_analysed())


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail fast when nothing is left (a one-row probe, not a full count)."""
    if df.isEmpty():
        raise ValueError(message)
    return df
