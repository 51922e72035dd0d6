"""Helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.plans.lineage import cut, passing, remove, tables_folder

__all__ = ["LOWER", "UPPER", "WORD", "ascii_lower", "cut", "fresh", "held", "join_keys", "let", "only", "passing", "remove", "small", "table", "tables_folder", "words"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word: a run of ASCII letters, ASCII digits and any non-ASCII characters (input already lower-cased).
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; null becomes the empty string. Texts of ASCII alone take the short way."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, whatever else the caller's table holds."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def fresh(df: DataFrame, name: str) -> str:
    """A name that no column of df has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside lambdas (there, Spark would
    compute a plain expression again for every element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: At most so many keys can each have more than a HOT-th of the rows.
HOT = 10_000


def join_keys(rows: DataFrame, keys: DataFrame, key: str, total: int) -> DataFrame:
    """rows joined with `keys`, which has one row a key and in n how many of the `total` rows have it. The rows
    of hot keys (of which there are fewer than HOT) meet a broadcast table where they are; the others shuffle."""
    hot = F.col("n") * HOT > total
    common = keys.where(hot)
    rare = rows.join(F.broadcast(common.select(key)), key, "left_anti").join(keys.where(~hot).drop("n"), key)
    return rows.join(F.broadcast(common.drop("n")), key).unionByName(rare)


def small(df: DataFrame, rows: int = 1_000_000) -> bool:
    """Whether a table has at most so many rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def held(written: DataFrame, rows: int) -> DataFrame:
    """A written table as a side of a join: broadcast up to so many rows, else shuffled."""
    return F.broadcast(written) if written.count() <= rows else written.hint("shuffle_merge")
