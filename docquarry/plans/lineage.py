"""Cutting the lineage of iterative plans, and the tables that this takes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths of the tables cut in the innermost open passing(); none outside of any.
_HELD: ContextVar[list[str] | None] = ContextVar("held", default=None)


def tables_folder(spark: SparkSession) -> str:
    """This session's folder under the one that spark.checkpoint.dir names, else under the warehouse: both are
    shared by all executors. It goes when the session ends."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/docquarry-tables")
    folder = context._jvm.org.apache.hadoop.fs.Path(context.getCheckpointDir())
    folder.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return context.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table by its path."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def _written(df: DataFrame, held: list[str] | None) -> DataFrame:
    spark = df.sparkSession
    path = f"{tables_folder(spark)}/table-{uuid.uuid4().hex}"
    if held is not None:
        held.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again, so that a lost executor costs no more
    than the tasks it ran, and the plans of iterative operators don't grow."""
    return _written(df, _HELD.get())


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables cut inside the block are deleted at its end. The function that it gives cuts one that outlives
    the block (up to the end of the block around it, if there is one)."""
    outer, inner = _HELD.get(), []
    token = _HELD.set(inner)
    try:
        yield lambda df: _written(df, outer)
    finally:
        _HELD.reset(token)
        for path in inner:
            remove(spark, path)
