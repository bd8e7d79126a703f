"""Lookups with fallbacks, overlays and resumption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .skew import look_up


def lookup_with_fallback(left: DataFrame, right: DataFrame, keys: list[Column], right_key: str, value: str) -> DataFrame:
    """`left` with `value` of the row of `right` (one per `right_key`) found by the first of `keys` that has one, and
    `found_by`, the number of that key from 1; both null where none has. A key may stand in any share of the rows."""
    out, found, by = checkpoint(left.withColumns({f"__k{n}": key for n, key in enumerate(keys, 1)})), F.lit(None), F.lit(None).cast("int")
    for n in range(1, len(keys) + 1):
        side = right.select(F.col(right_key).alias(f"__k{n}"), F.col(value).alias(f"__v{n}"), F.lit(True).alias(f"__m{n}"))
        out = look_up(out, side, [f"__k{n}"])
    for n in range(len(keys), 0, -1):
        found = F.when(F.col(f"__m{n}"), F.col(f"__v{n}")).otherwise(found)
        by = F.when(F.col(f"__m{n}"), F.lit(n)).otherwise(by)
    return out.withColumns({value: found, "found_by": by}).drop(*[c for c in out.columns if c.startswith("__")])


def overlay(value: Column, over: Column) -> Column:
    """`over` where it is filled, else `value`."""
    return F.coalesce(F.nullif(over, F.lit("")), value)


def pending(targets: DataFrame, log: DataFrame, key: str, done: Column) -> DataFrame:
    """The targets that the log doesn't show as done."""
    return targets.join(log.filter(done).select(key).distinct(), key, "left_anti")
