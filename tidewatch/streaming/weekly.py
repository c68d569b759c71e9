"""Weekly counts from a stream: a week is counted once, when no more of its rows are expected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: windows count from 1970-01-01, a Thursday; the Monday after it is four days later
WEEK, MONDAY = "7 days", "4 days"


def closed_weeks(
    rows: DataFrame,
    time: str,
    by: Sequence[str] = (),
    flags: dict[str, str] | None = None,
    delay: str = "7 days",
    key: str | None = None,
) -> DataFrame:
    """Counts per Monday week and ``by`` of a stream: week_start, ``by``, rows, and one per flag.

    ``flags`` gives counted conditions by name. The watermark lags ``delay`` behind the newest time seen;
    a week is counted and handed on when the watermark has passed its end, and its state is dropped
    then. Rows up to ``delay`` late are counted, later ones may not be; rows without a time are not.
    With ``key``, further rows of a key that come within ``delay`` of its first are the same row. The
    state is one row per open week and group (and per key seen within the delay).
    """
    stamped = rows.withColumn("_at", F.col(time).cast("timestamp")).filter("_at is not null")
    stamped = stamped.withWatermark("_at", delay)
    if key is not None:
        stamped = stamped.dropDuplicatesWithinWatermark([key])
    counts = [F.count_if(F.expr(c)).alias(n) for n, c in (flags or {}).items()]
    weeks = stamped.groupBy(F.window("_at", WEEK, WEEK, MONDAY).alias("_week"), *by)
    counted = weeks.agg(F.count("*").alias("rows"), *counts)
    return counted.select(
        F.to_date("_week.start").alias("week_start"), *by, "rows", *(flags or {})
    )


def count_weeks(weeks: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Appends closed weeks to Parquet files at ``path``, each once, also after a restart."""
    return (
        weeks.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
