"""Stored tables and views, replaced as a whole without readers seeing half of one."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "name string, path string, published_at timestamp, seq bigint"


class TableStore:
    """Every publication writes a new folder and then adds a line to the manifest. The line is the
    commit: until it is there, readers keep the version before."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @property
    def manifest(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")

    def _next(self, name: str) -> int:
        try:
            return (self.manifest.where(F.col("name") == name).agg(F.max("seq")).first()[0] or 0) + 1
        except Exception as e:  # first publication: there is no manifest yet
            if "PATH_NOT_FOUND" in str(e):
                return 1
            raise

    def publish(
        self, name: str, df: DataFrame, at: dt.datetime, cluster_by: list[str] | None = None
    ) -> DataFrame:
        """Store a new version of a table or view and point the session's view at it.

        ``cluster_by`` stands in for an index: rows are stored in that order, so that a filter on the
        first column skips files and row groups by their minimum and maximum. It should end in a
        unique column, which lets a frequent value spread over several files.
        """
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        seq = self._next(name)
        path = f"{self.root}/{name}/{seq:06d}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.spark.createDataFrame([(name, path, at, seq)], MANIFEST).coalesce(1).write.mode("append").parquet(
            f"{self.root}/manifest"
        )
        return self.current(name)

    def current(self, name: str) -> DataFrame:
        newest = self.manifest.where(F.col("name") == name).orderBy(F.desc("seq"), F.desc("published_at"), "path").first()
        if newest is None:
            raise LookupError(f"nothing published as {name}")
        df = self.spark.read.parquet(newest.path)
        df.createOrReplaceTempView(name)
        return df
