"""A result table of complete versions, one current version per cutoff."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .writers import with_load_columns


class ResultTable:
    """Rows by cutoff below one folder; readers see whole versions only.

    ``publish`` writes a version of its own folder and then names it in the cutoff's entry under
    ``current/`` by one rename, which a file system with atomic rename does at once. A run that fails
    before leaves the entry as it was, so neither half of its rows nor a mixture is ever read. An
    empty result is a version too and replaces the rows of an earlier one. Old versions stay until
    `vacuum`, so readers that have begun can finish. Publishers of different cutoffs do not meet; of
    two for one cutoff the later rename counts.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def publish(self, df: DataFrame, cutoff: dt.date) -> str:
        """Write one cutoff's rows and make them current; returns the version."""
        version = uuid.uuid4().hex
        with_load_columns(df, cutoff).drop("fecha_corte").write.parquet(self._folder(cutoff, version))
        self._switch(cutoff, version)
        return version

    def remove(self, cutoff: dt.date) -> None:
        """Take one cutoff out of the table."""
        entry = self._path(f"{self.path}/current/{cutoff.isoformat()}")
        entry.getFileSystem(self._conf).delete(entry, False)

    def current(self) -> dict[dt.date, str]:
        """Current version of each cutoff; one small entry per cutoff is read."""
        folder = self._path(f"{self.path}/current")
        fs = folder.getFileSystem(self._conf)
        if not fs.exists(folder):
            return {}
        names = [s.getPath() for s in fs.listStatus(folder)]
        entries = [p for p in names if not p.getName().startswith((".", "_"))]
        return {dt.date.fromisoformat(p.getName()): self._content(fs, p) for p in entries}

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """Rows of all current versions, with their cutoff; a table without any needs ``schema``."""
        folders = {c: self._folder(c, v) for c, v in sorted(self.current().items())}
        if not folders:
            if schema is None:
                raise FileNotFoundError(f"no current version below {self.path}")
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.option("basePath", self.path).parquet(*folders.values())
        return rows.drop("version").withColumn("fecha_corte", F.col("fecha_corte").cast("date"))

    def vacuum(self) -> int:
        """Delete versions that are not current, unfinished ones included; for times without writers or readers."""
        current, gone = self.current(), 0
        root = self._path(self.path)
        fs = root.getFileSystem(self._conf)
        for of_cutoff in fs.listStatus(root) if fs.exists(root) else []:
            name = of_cutoff.getPath().getName()
            if not name.startswith("fecha_corte="):
                continue
            keep = current.get(dt.date.fromisoformat(name.removeprefix("fecha_corte=")))
            for version in fs.listStatus(of_cutoff.getPath()):
                if version.getPath().getName() != f"version={keep}":
                    gone += fs.delete(version.getPath(), True)
        return gone

    def _folder(self, cutoff: dt.date, version: str) -> str:
        return f"{self.path}/fecha_corte={cutoff.isoformat()}/version={version}"

    def _path(self, name: str):
        return self._hadoop.Path(name)

    def _switch(self, cutoff: dt.date, version: str) -> None:
        """Write the entry aside, then rename it over the old one."""
        aside = self._path(f"{self.path}/current/.{version}")
        out = aside.getFileSystem(self._conf).create(aside, True)
        out.write(bytearray(version, "ascii"))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 1)
        options[0] = self._hadoop.Options.Rename.OVERWRITE
        context = self._hadoop.FileContext.getFileContext(aside.toUri(), self._conf)
        context.rename(aside, self._path(f"{self.path}/current/{cutoff.isoformat()}"), options)

    @staticmethod
    def _content(fs, path) -> str:
        source = fs.open(path)
        try:
            return bytes(source.readNBytes(64)).decode("ascii")
        finally:
            source.close()
