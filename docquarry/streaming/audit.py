"""Streaming form of the duplicate audit: questions are let through once a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.functions import text as T


def first_questions(stream: DataFrame, variant: str = "writer", delay: str = "1 day") -> DataFrame:
    """Rows (question, at, ...) whose key wasn't seen within the watermark; works on streams and tables. State
    is one key for each question younger than `delay`."""
    keyed = stream.withColumn("key", T.question_key(F.col("question"), variant))
    if not keyed.isStreaming:
        return keyed.dropDuplicates(["key"])
    return keyed.withWatermark("at", delay).dropDuplicatesWithinWatermark(["key"])
