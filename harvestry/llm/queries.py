"""All queries of this subpackage, by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import formatting, names, packing, private, residue, survivors, tokens

MODULES = [residue, survivors, formatting, names, tokens, packing, private]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.SQL.items()}
