"""Every query of the engine by name, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docquarry.operators import assets, checks, context, coverage, dedup, generate, library, parse, report, search

MODULES = (parse, search, dedup, coverage, checks, report, generate, assets, library, context)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
