"""Versioned tables and the pointer to the current ones.

Every load writes each of its tables into a new folder; nothing that readers
use is touched. When all are written, one small manifest file is put in place,
and with it all of them become current at once. A load that fails leaves the
old tables as they were, and a second attempt of the same run finds the tables
that the first one finished.

Layout under the base folder::

    tables/<table>/<run>/            one version of a table (Parquet)
    tables/<table>/<run>.done.json   written once that version is complete
    _manifest/<number>.json          the highest number is current
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyspark.sources.tables import conform, register_bucketed_table, write_bucketed_table, write_table


class Files:
    """The few file operations needed, through the file system of a path."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        p, fs = self.at(path)
        return bool(fs.exists(p))

    def size(self, path: str) -> int:
        """Bytes of a file, a folder or what a pattern matches."""
        p, fs = self.at(path)
        return sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(p) or [])

    def names(self, path: str) -> list[str]:
        p, fs = self.at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def read(self, path: str) -> str:
        p, fs = self.at(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A whole file or none: written beside its place, then renamed. An
        existing file stays, and the call fails."""
        p, fs = self.at(path)
        beside, _ = self.at(f"{os.path.dirname(path)}/.{os.path.basename(path)}.tmp")
        stream = fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if fs.exists(p) or not fs.rename(beside, p):
            fs.delete(beside, False)
            raise FileExistsError(f"{path} was written by another load")

    def delete(self, path: str) -> None:
        p, fs = self.at(path)
        fs.delete(p, True)


class Store:
    """Tables under ``base``, read as the current manifest says."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self.files = spark, base, Files(spark)

    def _manifests(self) -> list[str]:
        return [n for n in self.files.names(f"{self.base}/_manifest") if n.endswith(".json") and n[0] != "."]

    def manifest(self) -> dict:
        """``tables`` (by name: path, run, rows, metrics, ...) and ``layers``
        (the run that last finished each)."""
        found = self._manifests()
        return json.loads(self.files.read(f"{self.base}/_manifest/{found[-1]}")) if found else {"tables": {}, "layers": {}}

    def entry(self, name: str) -> dict:
        try:
            return self.manifest()["tables"][name]
        except KeyError:
            raise KeyError(f"no table {name!r} under {self.base}") from None

    def names(self) -> list[str]:
        return sorted(self.manifest()["tables"])

    def read(self, name: str) -> DataFrame:
        return self.open(self.entry(name))

    def open(self, entry: dict) -> DataFrame:
        """One version of a table; through the catalog where it is bucketed."""
        schema = T.StructType.fromJson(entry["schema"])
        if entry.get("buckets"):
            return register_bucketed_table(self.spark, entry["catalog"], entry["path"], schema, entry["buckets"], entry["by"], entry["sort"])
        return self.spark.read.schema(schema).parquet(entry["path"])

    def load(self, run: str) -> "Load":
        return Load(self, run)

    def expire(self, keep: int = 2) -> list[str]:
        """Delete the versions that none of the latest ``keep`` manifests
        names, and the older manifests; returns the deleted folders."""
        found = self._manifests()
        latest = [json.loads(self.files.read(f"{self.base}/_manifest/{n}")) for n in found[-keep:]]
        used = {t["folder"] for m in latest for t in m["tables"].values()}
        gone = []
        for name in self.files.names(f"{self.base}/tables"):
            for version in reversed(self.files.names(f"{self.base}/tables/{name}")):  # the mark of a version before it
                folder = f"{self.base}/tables/{name}/{version.removesuffix('.done.json')}"
                if folder not in used:
                    self.files.delete(f"{self.base}/tables/{name}/{version}")
                    gone += [folder] if not version.endswith(".json") else []
        for n in found[:-keep]:
            self.files.delete(f"{self.base}/_manifest/{n}")
        return gone


class Load:
    """The tables that one run writes. They can be read here at once; others
    see them after ``commit``."""

    def __init__(self, store: Store, run: str):
        self.store, self.run = store, run
        self.entries: dict[str, dict] = {}

    def read(self, name: str) -> DataFrame:
        return self.store.open(self.entries[name]) if name in self.entries else self.store.read(name)

    def entry(self, name: str) -> dict:
        return self.entries[name] if name in self.entries else self.store.entry(name)

    def write(
        self,
        name: str,
        make: Callable[[], DataFrame],
        schema: T.StructType | None = None,
        metrics: dict[str, Column] | None = None,
        partition_by: list[str] | None = None,
        buckets: int | None = None,
        by: list[str] | None = None,
        sort: list[str] | None = None,
        catalog: str | None = None,
    ) -> DataFrame:
        """Write ``make()`` as this run's version of ``name``, unless an
        earlier attempt of the run finished it, and read it back.

        ``metrics`` are aggregates of the written rows, observed while they are
        written; the entry keeps their values beside ``rows``. They stand
        behind the last shuffle, in the tasks that write, of which Spark counts
        each partition once.
        """
        files, folder = self.store.files, f"{self.store.base}/tables/{name}/{self.run}"
        done = f"{folder}.done.json"
        if files.exists(done):
            self.entries[name] = json.loads(files.read(done))
            return self.read(name)
        df = make()
        out = conform(df, schema) if schema is not None else df
        kept = out.schema
        if buckets:
            out = out.repartition(buckets, *[F.col(c) for c in by])
        seen = Observation()
        observed = out.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (metrics or {}).items()])
        if buckets:
            passing = f"{catalog}_{self.run}".replace("-", "_")
            write_bucketed_table(observed, passing, folder, buckets, by, sort, dealt=True)
            self.store.spark.sql(f"DROP TABLE {passing}")  # external: its files stay
        else:
            write_table(observed, folder, partition_by=partition_by)
        entry = {"path": folder, "folder": folder, "run": self.run, "schema": kept.jsonValue()}
        if buckets:
            entry |= {"buckets": buckets, "by": by, "sort": sort, "catalog": catalog}
        # No rows may leave a plan without the observed node.
        empty = self.store.spark.read.schema(kept).parquet(folder).isEmpty()
        values = {} if empty else dict(seen.get)
        entry |= {"rows": values.pop("rows", 0), "metrics": values}
        files.write(done, json.dumps(entry))
        self.entries[name] = entry
        return self.read(name)

    def keep(self, name: str, **changes) -> None:
        """Add a table that is part of another one's version, or more facts
        about one."""
        self.entries[name] = {**self.entries.get(name, {}), **changes}

    def commit(self, layer: str) -> dict:
        """Make this load's tables current, all at once, and say that the run
        finished ``layer``."""
        found = self.store._manifests()
        number = int(found[-1].split(".")[0]) if found else 0
        manifest = self.store.manifest()
        manifest["tables"].update(self.entries)
        manifest["layers"][layer] = self.run
        self.store.files.write(f"{self.store.base}/_manifest/{number + 1:08d}.json", json.dumps(manifest))
        return manifest
