"""Several series brought onto one calendar."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_points(df: DataFrame, columns: Sequence[str], points: Sequence[str]) -> DataFrame:
    """Contributions of each row to several series, in one scan of ``df``.

    A point is an SQL list: the condition under which the row has it, then its columns.
    """
    stacked = f"stack({len(points)}, {', '.join(points)}) as (_on, {', '.join(columns)})"
    return df.selectExpr(stacked).filter("_on").drop("_on")


def align(series: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per key that occurs in any series, with every measure summed and 0 where absent.

    All series go through one aggregate (one shuffle, combined before it) instead of a
    spine joined to each of them. As in such joins a null key never matches: a key with a
    null part is kept as a row of zeros.
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), series)
    complete = " and ".join(f"{k} is not null" for k in keys)
    totals = rows.groupBy(*keys).agg(*(F.sum(m).alias(m) for m in measures))
    return totals.selectExpr(
        *keys, *(f"coalesce(case when {complete} then {m} end, 0) as {m}" for m in measures)
    )
