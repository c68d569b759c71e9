"""Counts of events within a number of days around centre dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def counts_around(
    centres: DataFrame,
    events: DataFrame,
    key: str,
    centre_date: str,
    event_date: str,
    days: int,
    flags: dict[str, str],
) -> DataFrame:
    """One row per distinct (key, centre date): events of the same key within +-``days``.

    Gives ``centres`` (rows of ``centres`` on that date), ``in_window``, ``before`` (strictly
    before the centre date), ``on_or_after``, and the in-window count of each flag (a name
    and its SQL condition).

    A centre without a date has no events near it and counts as a centre all the same.

    An interval join would pair every event with every centre near it, and a hot key would
    carry most of the pairs. Here both sides are first counted per (key, day), combined
    before the shuffle, and the interval becomes a range frame over the days of a key: a
    task sees two rows per calendar day at most, whatever the number of events or centres.
    """
    daily = (
        events.filter(F.col(key).isNotNull() & F.col(event_date).isNotNull())
        .groupBy(key, F.col(event_date).alias(centre_date))
        .agg(
            F.count("*").alias("_events"),
            *(F.expr(f"count_if({c}) as _{name}") for name, c in flags.items()),
        )
    )
    marks = (
        centres.filter(F.col(key).isNotNull())
        .groupBy(key, centre_date)
        .agg(F.count("*").alias("centres"))
    )
    around = Window.partitionBy(key).orderBy("_day").rangeBetween(-days, days)
    before = Window.partitionBy(key).orderBy("_day").rangeBetween(-days, -1)
    totals = {"in_window": F.sum("_events").over(around), "before": F.sum("_events").over(before)}
    totals |= {name: F.sum(f"_{name}").over(around) for name in flags}
    counted = (
        daily.unionByName(marks, allowMissingColumns=True)
        .withColumn("_day", F.unix_date(F.col(centre_date)))
        .withColumns(totals)
        .filter("centres is not null")
    )
    return counted.selectExpr(
        *(key, centre_date, "centres"),
        *(f"coalesce({name}, 0) as {name}" for name in totals),
        "coalesce(in_window, 0) - coalesce(before, 0) as on_or_after",
    )
