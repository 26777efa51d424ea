"""Raw-table reads and table/CSV sinks.

Sinks always cast to the declared schema and overwrite the target, which
is the full-replace load of each refresh.
"""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyspark.schemas import RAW_SCHEMAS
from plyspark.session import settings

RAW_TABLES = ("games", "moves", "move_evals")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the declared columns, in declared order."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_raw(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Scan one raw table stored as Parquet under ``base/table``."""
    return spark.read.schema(RAW_SCHEMAS[table]).parquet(os.path.join(base, table))


def read_raw_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {t: read_raw(spark, base, t) for t in RAW_TABLES}


def read_raw_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a raw table from its CSV export (header row).

    Exports written through pandas carry nullable integers as floats
    (``2144.0``), so integer columns are read as double and cast, and
    timestamps are read as text and parsed; the result has the declared
    raw schema. A file whose records are a line each is read in splits;
    only one with line breaks inside records needs a task for the whole file.
    """
    schema = RAW_SCHEMAS[table]
    read_as = T.StructType([
        T.StructField(f.name, T.DoubleType()) if isinstance(f.dataType, T.LongType)
        else T.StructField(f.name, T.StringType()) if isinstance(f.dataType, T.TimestampType)
        else f
        for f in schema.fields
    ])
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", spans_lines(spark, path))
    df = reader.schema(read_as).csv(path)
    stamps = {f.name: F.to_timestamp(f.name) for f in schema.fields if isinstance(f.dataType, T.TimestampType)}
    return conform(df.withColumns(stamps), schema)


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether some record of a CSV export may span lines (one narrow pass).

    Quotes inside values are doubled, so a line break lies inside a value where
    the quotes before it are odd in number; the first such line has an odd
    number itself. Lone carriage returns and lines of white space, which a
    reader by lines takes for ends and for nothing, count as well.
    """
    line = F.col("value")
    odd = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
    found = odd | line.rlike(r"\r[\s\S]") | line.rlike(r"\A[\x00-\x20]+\z")
    return bool(spark.read.option("lineSep", "\n").text(path).agg(F.bool_or(found)).first()[0])


#: So many partitions of a table are written side by side by a task; with more
#: it sorts its rows by them.
PARTITIONS_AT_ONCE = 8


def write_table(
    df: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Typed full-replace table load (Parquet)."""
    out = conform(df, schema) if schema is not None else df
    writer = out.write.mode(mode)
    if not partition_by:
        writer.parquet(path)
        return
    with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(PARTITIONS_AT_ONCE)}):
        writer.partitionBy(*partition_by).parquet(path)


#: Raw tables keyed by game are bucketed (and sorted) by ``game_id`` with one
#: bucket count, so the ply join, the per-game window and aggregates, the
#: opening join and the fact joins all read co-located data: no shuffle.
GAME_BUCKET_BY = ["game_id"]
GAME_SORT_BY = {"games": ["game_id"], "moves": ["game_id", "move_offset"],
                "move_evals": ["game_id", "move_offset"]}


def write_bucketed_table(
    df: DataFrame,
    table: str,
    path: str,
    buckets: int,
    by: list[str],
    sort_by: list[str] | None = None,
    schema: T.StructType | None = None,
    dealt: bool = False,
) -> None:
    """Full-replace load as an external Parquet table bucketed by ``by``
    (``dealt``: its rows are already partitioned so).

    The rows are first hash-partitioned into ``buckets`` partitions on the
    bucket columns (the same hash the bucketing uses), so each write task
    holds one bucket and writes one file: one shuffle at load time instead
    of one in every reader, and no small-file explosion. The bucket spec
    lives in the catalog; a later session re-attaches the written files with
    ``register_bucketed_table``.
    """
    out = conform(df, schema) if schema is not None else df
    if not dealt:
        out = out.repartition(buckets, *[F.col(c) for c in by])
    writer = out.write.mode("overwrite").bucketBy(buckets, *by)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.option("path", path).saveAsTable(table)


def register_bucketed_table(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    buckets: int,
    by: list[str],
    sort_by: list[str] | None = None,
) -> DataFrame:
    """Attach already-written bucketed files to the catalog.

    The entry is re-created each time (the table is external: dropping it
    keeps the files), so a stale entry of the same name in a persistent
    catalog can never point at another location or bucket spec.
    """
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    sort = f" SORTED BY ({', '.join(sort_by)})" if sort_by else ""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({cols}) USING parquet "
        f"CLUSTERED BY ({', '.join(by)}){sort} INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"
_CSV = {"escape": '"', "timestampFormat": CSV_TIMESTAMP_FORMAT}


def csv_name(label: str, table: str, stamp: str | None = None) -> str:
    """``{label}_{table}_{UTC yyyymmdd_HHMMSS}.csv``."""
    stamp = stamp or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    return f"{label}_{table}_{stamp}.csv"


def write_csv(df: DataFrame, out_dir: str, label: str, table: str, stamp: str | None = None) -> str:
    """CSV export: one file with a header row; returns its path.

    The rows are written in parallel as parts without a header, which the file
    system then joins behind a header of its own (``join_files``).
    """
    path = os.path.join(out_dir, csv_name(label, table, stamp))
    parts = path + ".parts"
    # Full microseconds with the UTC offset, e.g. 2026-06-11 00:42:39.763237+00:00
    # (Spark's default keeps milliseconds only).
    df.write.mode("overwrite").options(**_CSV).csv(parts)
    quoted = ['"' + c.replace('"', '""') + '"' if set(c) & set(',"\n') else c for c in df.columns]
    join_files(df.sparkSession, ",".join(quoted) + "\n", parts, path)
    return path


def join_files(spark: SparkSession, head: str, folder: str, path: str) -> None:
    """One file at ``path``: the text ``head``, then the part files of
    ``folder`` in their order; ``folder`` goes.

    The bytes stay inside the file system: a distributed one links the parts'
    blocks (``concat``), a local one copies them in the kernel. Others have no
    such operation: there the call fails and the parts stay.
    """
    jvm = spark._jvm
    source = jvm.org.apache.hadoop.fs.Path(folder)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted((s for s in fs.listStatus(source) if s.getPath().getName().startswith("part-")), key=lambda s: s.getPath().getName())
    parts = [s.getPath() for s in found if s.getLen()]
    target, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{folder}/.joined")
    if fs.getUri().getScheme() == "file":
        with open(beside.toUri().getPath(), "wb") as out:
            out.write(head.encode())
            out.flush()
            for part in parts:
                with open(part.toUri().getPath(), "rb") as one:
                    size, at = os.fstat(one.fileno()).st_size, 0
                    while at < size:
                        at += os.copy_file_range(one.fileno(), out.fileno(), size - at)
    else:
        stream = fs.create(beside, True)
        stream.write(bytearray(head.encode()))
        stream.close()
        if parts:
            array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
            for i, part in enumerate(parts):
                array[i] = part
            fs.concat(beside, array)
    fs.delete(target, False)
    if not fs.rename(beside, target):
        raise OSError(f"could not rename {beside} to {path}")
    fs.delete(source, True)
