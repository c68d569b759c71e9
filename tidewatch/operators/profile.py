"""Profiling of a table, and the check of close numbers against close dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import round_half_up


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls, null rate and distinct values of each column.

    Columns are unpivoted and counted per value first, combined before the shuffle; a
    frequent value (or null) is one row from then on.
    """
    cells = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in columns
        )
    )
    per_value = (
        df.select(F.inline(cells))
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
    )
    total = per_value.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct_values"),
    )
    rate = F.col("nulls").cast("double") * F.lit(100.0) / F.col("row_count")
    return total.withColumn("null_rate_pct", round_half_up(rate, 2))


def close_order_anomalies(closes: DataFrame) -> DataFrame:
    """Close numbers of a fund that have a close dated before one with a lower number.

    Closes are reduced to their first and last date per (fund, number) before the window,
    so the window of a fund holds a row per number, not per close.
    """
    dates = closes.groupBy("fund_id", "close_number").agg(
        F.min("scheduled_close_date").alias("first_date"),
        F.max("scheduled_close_date").alias("last_date"),
    )
    lower = Window.partitionBy("fund_id").orderBy("close_number")
    lower = lower.rowsBetween(Window.unboundedPreceding, -1)
    compared = dates.withColumn("latest_lower_date", F.max("last_date").over(lower))
    return compared.filter(F.col("first_date") < F.col("latest_lower_date")).drop("last_date")
