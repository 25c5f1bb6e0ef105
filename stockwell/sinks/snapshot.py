"""A keyed parquet table kept as whole versions.

A merge reads the current version and writes the next one beside it, so a
failed job leaves the current version untouched: only a folder with Spark's
``_SUCCESS`` marker counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stockwell.operators.upsert import ACTION, upsert
from stockwell.schemas import conform, required_not_null
from stockwell.sources.files import child_names, claim_file, delete_path, path_exists

_PREFIX = "version="


class ConcurrentWrite(RuntimeError):
    """Another writer added a version while this one was being written."""


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keep: int | None = None):
        """``keep`` deletes all but that many newest versions after a write; at
        least two, so that readers of the previous one can finish."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.keep = None if keep is None else max(keep, 2)

    def _folder(self, version: int) -> str:
        return f"{self.path}/{_PREFIX}{version:09d}"

    def versions(self) -> list[int]:
        found = []
        for name in child_names(self.spark, self.path):
            if name.startswith(_PREFIX):
                version = int(name[len(_PREFIX) :])
                if path_exists(self.spark, f"{self._folder(version)}/_SUCCESS"):
                    found.append(version)
        return found

    def read(self) -> DataFrame:
        """The newest version; empty if there is none."""
        found = self.versions()
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return conform(self.spark.read.parquet(self._folder(found[-1])), self.schema)

    def write(self, df: DataFrame) -> int:
        """Write ``df`` as the next version and return its number.

        A NULL in a NOT NULL column fails the write. Version numbers are claimed, so two
        writers never share a folder, and of two that started from one version one fails.
        """
        found = self.versions()
        base = found[-1] if found else -1
        claimed = [int(n) for n in child_names(self.spark, f"{self.path}/_claims")]
        version = max([base, *claimed]) + 1
        if not claim_file(self.spark, f"{self.path}/_claims/{version:09d}", ""):
            raise ConcurrentWrite(f"another writer took version {version} of {self.path}")
        rows = required_not_null(conform(df, self.schema), self.schema)
        rows.write.mode("overwrite").parquet(self._folder(version))
        others = [v for v in self.versions() if base < v < version]
        if others:
            delete_path(self.spark, self._folder(version))
            raise ConcurrentWrite(f"version {others[-1]} of {self.path} was written meanwhile")
        if self.keep:
            self.vacuum(self.keep)
        return version

    def merge(self, source: DataFrame, owner: str = "", **options) -> None:
        """Upsert ``source`` by the first column and write the outcome as the next version."""
        merged = upsert(self.read(), source, [self.schema.fields[0].name], null_keys=True, **options)
        self.write(merged.drop(ACTION))

    def ensure(self) -> "SnapshotTable":
        """Create an empty first version unless the table exists."""
        if not self.versions():
            self.write(self.spark.createDataFrame([], self.schema))
        return self

    def vacuum(self, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions."""
        for version in self.versions()[:-keep]:
            delete_path(self.spark, self._folder(version))
