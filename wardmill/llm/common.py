"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from wardmill.llm.words import Task
from wardmill.session import durable

#: Stands for a missing id: larger than every other.
LAST = 2**63 - 1

#: Bytes of one Arrow batch. Spark's own 64 MB is held by the executor's JVM and, several times over, by its Python workers.
ARROW_BATCH = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

stored = durable


def in_batches(df: DataFrame, task: Task, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` over batches of at most ``ARROW_BATCH`` bytes or a single row; a smaller setting of the session stays."""
    now = df.sparkSession.conf.get(_BATCH_SETTING).rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= ARROW_BATCH:
        df.sparkSession.conf.set(_BATCH_SETTING, str(ARROW_BATCH))
    return df.mapInArrow(task, schema)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def id_of(column: str = "doc_id") -> Column:
    """The id as a long; a missing id counts as the largest."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST))


def digest(column: Column) -> Column:
    """Lowercase hex SHA-256."""
    return F.sha2(column, 256)
