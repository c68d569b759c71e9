"""Approximate quantiles and distinct counts of any period, from sketches stored per month.

A sketch has a bounded size whatever the rows behind it, and sketches of parts merge into the one of
the whole. So the months of a table are sketched once, and a median or a distinct count over any
range of months is merged from them without reading the table again.

* Quantiles (KLL): exact while a group has at most ``size`` values in the period; beyond, the share of
  values below the result is off by no more than ``rank_error(size)`` with 99 % confidence. Of an even
  number of values the lower middle one is the median.
* Distinct counts (theta): exact below ``2 ** lg_size`` values; beyond, the standard error is
  ``2 ** (-lg_size / 2)`` of the count, 0.8 % by default.

Both aggregates combine before their shuffle, so a hot group passes one sketch per task. Null values
are not counted; a group without any has a null quantile and the count 0. Rows without a month are in
no period that has a bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILE_SIZE = 1024
DISTINCT_LG_SIZE = 14


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """Error of the rank of a quantile, as a share of all values, at 99 % confidence."""
    return 2.296 / size**0.9723


def monthly(
    rows: DataFrame,
    keys: list[str],
    month: str,
    quantiles: Iterable[str] = (),
    distinct: Iterable[str] = (),
    size: int = QUANTILE_SIZE,
    lg_size: int = DISTINCT_LG_SIZE,
) -> DataFrame:
    """One row per key and month: row_count, ``<column>_kll`` and ``<column>_theta``."""
    sketches = [F.count("*").alias("row_count")]
    for column in quantiles:
        sketch = F.kll_sketch_agg_double(F.col(column).cast("double"), size)
        sketches.append(sketch.alias(f"{column}_kll"))
    for column in distinct:
        sketches.append(F.theta_sketch_agg(column, lg_size).alias(f"{column}_theta"))
    return rows.groupBy(*keys, month).agg(*sketches)


def write_months(sketched: DataFrame, path: str, month: str) -> None:
    """Writes the sketches, one partition per month; months already there are replaced."""
    writer = sketched.hint("rebalance", month).write.mode("overwrite").partitionBy(month)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def refresh_months(
    rows: DataFrame, path: str, changed: Iterable[date | None], keys: list[str], month: str, **sketched
) -> None:
    """Sketches the ``changed`` months anew. Only they are read from ``rows`` and replaced.

    A month that has lost all its rows gets one row that counts none. Can be run again.
    """
    changed = list(changed)
    if not changed:
        return
    wanted = F.col(month).isin([m for m in changed if m is not None])
    if None in changed:
        wanted = wanted | F.col(month).isNull()
    fresh = monthly(rows.filter(wanted), keys, month, **sketched)
    months = rows.sparkSession.createDataFrame([(m,) for m in changed], f"`{month}` date")
    empty = months.withColumn("row_count", F.lit(0).cast("long"))
    write_months(fresh.unionByName(empty, allowMissingColumns=True), path, month)


def over_period(
    stored: DataFrame,
    keys: list[str],
    month: str,
    since: date | None = None,
    until: date | None = None,
    quantiles: Mapping[str, tuple[str, float]] | None = None,
    distinct: Mapping[str, str] | None = None,
    size: int = QUANTILE_SIZE,
    lg_size: int = DISTINCT_LG_SIZE,
) -> DataFrame:
    """Merges the months from ``since`` to before ``until``: keys, row_count and the results asked for.

    ``quantiles`` maps a result to its column and share, ``distinct`` a result to its column. ``keys``
    may be fewer than those stored: their sketches merge as months do.
    """
    stored = stored.filter("row_count > 0")
    if since is not None:
        stored = stored.filter(F.col(month) >= F.lit(since))
    if until is not None:
        stored = stored.filter(F.col(month) < F.lit(until))
    quantiles, distinct = dict(quantiles or {}), dict(distinct or {})
    merged = [F.sum("row_count").alias("row_count")]
    for column in sorted({column for column, _ in quantiles.values()}):
        merged.append(F.kll_merge_agg_double(f"{column}_kll", size).alias(f"{column}_kll"))
    for column in sorted(set(distinct.values())):
        merged.append(F.theta_union_agg(f"{column}_theta", lg_size).alias(f"{column}_theta"))
    whole = stored.groupBy(*keys).agg(*merged)
    results = [_quantile(f"{c}_kll", share).alias(name) for name, (c, share) in quantiles.items()]
    for name, column in distinct.items():
        results.append(F.theta_sketch_estimate(f"{column}_theta").alias(name))
    return whole.select(*keys, "row_count", *results)


def _quantile(sketch: str, share: float) -> Column:
    has_values = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(has_values, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))
