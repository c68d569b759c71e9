"""Column expressions. All of them stay inside whole-stage codegen; there is no Python UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_key(c: Column | str) -> Column:
    """Join-key form of a text: no outer spaces, lower case. Tabs stay."""
    return F.lower(F.trim(_col(c)))


def week_start(c: Column | str) -> Column:
    """Monday of the week, as DATE."""
    return F.trunc(F.to_date(_col(c)), "week")


def month_start(c: Column | str) -> Column:
    return F.trunc(F.to_date(_col(c)), "month")


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Fractional hours, exact to the microsecond; meant for timestamps without zone."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(3.6e9)


def round_half_up(c: Column, scale: int = 0) -> Column:
    """Rounds the scaled double, so 1.005 gives 1.0: the binary value lies below the tie."""
    if scale == 0:
        return F.round(c.cast("double"), 0)
    factor = F.lit(float(10**scale))
    return F.round(c.cast("double") * factor, 0) / factor


def pct(part: Column | str, total: Column | str, scale: int = 2) -> Column:
    """Share in percent; null where the total is zero (ANSI mode would raise)."""
    return round_half_up(
        _col(part).cast("double") * F.lit(100.0) / F.nullif(_col(total), F.lit(0)), scale
    )


def split_rows(df: DataFrame, source: str, delimiter: str, out: str) -> DataFrame:
    """One row per normalised, non-empty element of a delimited text.

    Null and blank texts give no row; repeated elements stay repeated.
    """
    pieces = df.withColumn("_piece", F.explode(F.split(F.col(source), re.escape(delimiter))))
    return pieces.withColumn(out, norm_key("_piece")).drop("_piece").filter(F.col(out) != "")
