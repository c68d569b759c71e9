"""Sums per group kept up to date from what a merge changes, without reading the rest again.

A merge replaces rows by key. Its change log has the image before (sign -1) and after (sign 1) of each
of these rows. A sum per group changes by the signed sum over the log, and so does the number of rows
behind a group; a group without rows is no longer there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.incremental import in_partitions, replace_partitions, sync_schema
from tidewatch.sources.tables import Copies, write_table

SIGN, ROWS, THROUGH = "_sign", "_rows", "_through"


def change_log(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Images of the rows that merging ``batch`` takes away and brings, in the batch's columns.

    A key that is not in the target has no image before. The target may have several rows per key
    (a bridge); the batch replaces all of them.
    """
    before = target.join(batch.select(key).distinct(), key, "left_semi")
    return (
        sync_schema(before, batch.schema)
        .withColumn(SIGN, F.lit(-1))
        .unionByName(batch.withColumn(SIGN, F.lit(1)))
    )


def grouped_sums(points: DataFrame, keys: Sequence[str], counters: Sequence[str]) -> DataFrame:
    """One row per group: the sums of its counters and the number of points.

    With a column of signs (a change log) these are the changes of the sums.
    """
    sign = F.col(SIGN) if SIGN in points.columns else F.lit(1)
    return points.groupBy(*keys).agg(
        *(F.sum(F.col(c) * sign).alias(c) for c in counters), F.sum(sign).alias(ROWS)
    )


def added(state: DataFrame, change: DataFrame, keys: Sequence[str], counters: Sequence[str]) -> DataFrame:
    """The state with the changes added; a group without rows stays, with zeros."""
    sums = [*counters, ROWS]
    both = state.select(*keys, *sums).unionByName(change.select(*keys, *sums))
    return both.groupBy(*keys).agg(*(F.sum(c).cast("long").alias(c) for c in sums))


def present(state: DataFrame) -> DataFrame:
    """Groups that have rows, without the state's own columns."""
    return state.filter(F.col(ROWS) > 0).drop(ROWS, THROUGH)


def create_state(
    points: DataFrame, table: str, keys: Sequence[str], counters: Sequence[str], partition: str, through: int
) -> None:
    """Writes the sums over all points as a table. ``through`` numbers the last merge that is in it."""
    sums = grouped_sums(points, [*keys, partition], counters)
    typed = [F.col(c).cast("long").alias(c) for c in (*counters, ROWS)]
    state = sums.select(*keys, *typed, F.lit(through).cast("long").alias(THROUGH), partition)
    write_table(state, table, partition)


def apply_change(
    change: DataFrame, table: str, keys: Sequence[str], counters: Sequence[str], partition: str, number: int
) -> None:
    """Adds the changes of merge ``number`` to a stored state.

    Only the partitions with a change are read and replaced, each as a whole, and every row says up to
    which merge it counts: partitions that have this merge already are left alone, so a job that died
    half way is simply run again.
    """
    spark = change.sparkSession
    with Copies(spark) as keep:
        change = keep(grouped_sums(change, [*keys, partition], counters))
        values = [r[0] for r in change.select(partition).distinct().collect()]  # partition values
        if not values:
            return
        state = spark.table(table).filter(in_partitions(partition, values))
        done = state.filter(F.col(THROUGH) >= number).select(partition).distinct().collect()
        values = [v for v in values if v not in {r[0] for r in done}]
        if not values:
            return
        state, change = (x.filter(in_partitions(partition, values)) for x in (state, change))
        new = added(state, change, [*keys, partition], counters)
        new = new.withColumn(THROUGH, F.lit(number).cast("long")).select(*spark.table(table).columns)
        replace_partitions(keep(new), table, partition, values)
