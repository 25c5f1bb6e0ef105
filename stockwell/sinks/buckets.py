"""A keyed Parquet table in hash buckets, merged bucket by bucket.

Each bucket is a partition folder. A merge reads only the buckets that its keys fall into,
stages what they become, and has Spark overwrite just those in which a row was inserted or
updated (dynamic partition overwrite). The staged rows are kept until that is done, so a
merge that dies halfway is finished by the next one. One writer at a time holds the table.
Every merge that changes rows also leaves their images in a folder of its own number, from
which a change stream is read without comparing states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwell.operators.upsert import ACTION, action_counts, upsert
from stockwell.schemas import conform, required_not_null
from stockwell.sources.changes import CHANGE, IS_UPDATE
from stockwell.sources.files import child_names, claim_file, delete_path, make_folder, path_exists

BUCKET, VERSION, _OLD = "_bucket", "version", "_old"


class TableClaimed(RuntimeError):
    """Another writer is merging into the table."""


class BucketedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        buckets: int = 64,
        files_per_bucket: int = 1,
    ):
        """``buckets`` is fixed for the life of the table; a few hundred MB each are a good size."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.buckets = buckets
        self.files_per_bucket = files_per_bucket

    @property
    def _staging(self) -> str:
        return f"{self.path}/_staged"

    @property
    def changes_path(self) -> str:
        return f"{self.path}/_changes"

    @property
    def _claim(self) -> str:
        return f"{self.path}/_claim"

    def ensure(self) -> "BucketedTable":
        make_folder(self.spark, self.path)
        return self

    def bucket_of(self, df: DataFrame) -> Column:
        """The bucket of a row by its key; a NULL key has one too."""
        types = {f.name: f.dataType for f in self.schema.fields}
        return F.pmod(F.xxhash64(*[F.col(k).cast(types[k]) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _stored(self, path: str, *extra: T.StructField) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *extra, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(path)

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows, of some buckets only if named; other folders are not opened."""
        rows = self._stored(self.path)
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(list(buckets)) if buckets else F.lit(False))
        return conform(rows, self.schema)

    def version(self) -> int:
        """Number of merges that changed a row."""
        return max((int(n.split("=")[1]) for n in child_names(self.spark, self.changes_path) if "=" in n), default=0)

    def changes(self, after: int, until: int) -> DataFrame:
        """Images of the rows that merges ``after + 1`` to ``until`` changed, in the shape of :func:`table_changes`.

        An updated row is the DELETE of its old image and the INSERT of its new one. Only
        the named versions' folders are read.
        """
        if after >= until:
            return self.spark.createDataFrame([], self._change_schema())
        rows = self.spark.read.schema(self._change_schema().add(VERSION, T.IntegerType())).parquet(self.changes_path)
        return rows.where((F.col(VERSION) > after) & (F.col(VERSION) <= until)).drop(VERSION)

    def _change_schema(self) -> T.StructType:
        own = [T.StructField(f.name, f.dataType) for f in self.schema.fields]
        return T.StructType([*own, T.StructField(CHANGE, T.StringType()), T.StructField(IS_UPDATE, T.BooleanType())])

    def merge(self, source: DataFrame, owner: str = "", **options) -> dict:
        """Upsert ``source`` (see :func:`upsert`; a NULL key is a key) and say what was done.

        ``owner`` names the run: if it died while it held the table, the same owner may go
        on, and any other one gets :class:`TableClaimed` until ``release`` is called.
        """
        self.ensure()
        if not claim_file(self.spark, self._claim, owner):
            raise TableClaimed(f"{self.path} is held by another writer")
        try:
            self._finish()
            touched = sorted(r[0] for r in source.select(self.bucket_of(source)).distinct().collect())
            merged = upsert(self.read(touched), source, self.keys, null_keys=True, old_image=_OLD, **options)
            rows = required_not_null(merged, self.schema, keep=[F.col(_OLD), F.col(ACTION)])
            spread = F.pmod(F.hash(*self.keys), F.lit(self.files_per_bucket))
            dealt = rows.withColumn(BUCKET, self.bucket_of(rows)).repartition(
                max(1, len(touched) * self.files_per_bucket), BUCKET, spread
            )
            dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self._staging}/{self.version() + 1}")
            return {"buckets_read": len(touched), **self._finish()}
        finally:
            self.release()

    def release(self) -> None:
        delete_path(self.spark, self._claim)

    def _finish(self) -> dict:
        """Put completely staged rows in place; rows staged by a run that died before are dropped."""
        done = {"buckets_written": 0, "rows_inserted": 0, "rows_updated": 0, "rows_merged": 0, "rows_deleted": 0}
        for name in child_names(self.spark, self._staging):
            folder = f"{self._staging}/{name}"
            if path_exists(self.spark, f"{folder}/_SUCCESS"):
                done = self._put(folder, int(name))
        delete_path(self.spark, self._staging)
        return done

    def _put(self, folder: str, version: int) -> dict:
        old = T.StructType([T.StructField(f.name, f.dataType) for f in self.schema.fields if f.name not in self.keys])
        staged = self._stored(folder, T.StructField(_OLD, old), T.StructField(ACTION, T.StringType()))
        deleted = F.count_if(F.col(ACTION) == "deleted")
        # One row for each bucket at most.
        counts = staged.groupBy(BUCKET).agg(*action_counts(), deleted.alias("rows_deleted"), F.count(F.lit(1)).alias("n"))
        counts = counts.where("rows_merged + rows_deleted > 0").collect()
        changed = [r[BUCKET] for r in counts]
        if changed:
            self._log(staged.where(F.col(ACTION) != "kept"), version)
            (
                staged.where(F.col(BUCKET).isin(changed) & (F.col(ACTION) != "deleted"))
                .drop(ACTION, _OLD)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(BUCKET)
                .parquet(self.path)
            )
            for row in counts:
                if row["n"] == row["rows_deleted"]:
                    delete_path(self.spark, f"{self.path}/{BUCKET}={row[BUCKET]}")
        totals = {n: sum(r[n] for r in counts) for n in ("rows_inserted", "rows_updated", "rows_merged", "rows_deleted")}
        return {"buckets_written": len(changed), **totals}

    def _log(self, changed: DataFrame, version: int) -> None:
        values = [f.name for f in self.schema.fields if f.name not in self.keys]
        new = F.struct(*[F.col(c).alias(c) for c in values])
        images = F.array_compact(
            F.array(
                F.when(F.col(ACTION) != "inserted", F.struct(F.lit("DELETE").alias("a"), F.col(_OLD).alias("r"))),
                F.when(F.col(ACTION) != "deleted", F.struct(F.lit("INSERT").alias("a"), new.alias("r"))),
            )
        )
        exploded = changed.select(*self.keys, (F.col(ACTION) == "updated").alias(IS_UPDATE), F.explode(images).alias("i"))
        rows = exploded.select(
            *[F.col(f.name) if f.name in self.keys else F.col(f"i.r.{f.name}").alias(f.name) for f in self.schema.fields],
            F.col("i.a").alias(CHANGE),
            IS_UPDATE,
        )
        rows.write.mode("overwrite").parquet(f"{self.changes_path}/{VERSION}={version}")
