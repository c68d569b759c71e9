"""Exact median per group, for groups of any size."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.lookup import hot_keys


def _slot(value: str, bounds: Column, slots: int) -> Column:
    """How many of the sorted ``bounds`` lie below the value, in two steps of sqrt(slots)."""
    step = isqrt(slots) + 1
    v = F.col(value)
    marks = F.transform(F.sequence(F.lit(1), F.lit(slots // step)), lambda j: F.get(bounds, j * step - 1))
    whole = F.size(F.filter(marks, lambda b: b < v))
    part = F.slice(bounds, whole * step + 1, F.lit(step))
    return whole * step + F.size(F.filter(part, lambda b: b < v))


def exact_median(counted: DataFrame, group: str, value: str, weight: str, out: str) -> DataFrame:
    """Median of the non-null values of each group; the mean of the middle two if even.

    ``counted`` has one row per group and distinct value with the number of its occurrences. It is
    read several times; if it comes from an aggregate, Spark reuses that one's shuffle.

    ``F.median`` keeps all distinct values of a group in the memory of one task. Here a group that has
    no more values than a task's fair share is ordered whole, in one window that can spill; the few
    others (``hot_keys``) are cut into slots.
    """
    values = counted.filter(F.col(value).isNotNull() & F.col(group).isNotNull()).select(
        group, F.col(value).alias("_v"), F.col(weight).alias("_n")
    )
    hot = hot_keys(values, group=[F.col(group)])
    hot = F.broadcast(hot.select(F.col("hash").alias("_hash"), F.col("salts").alias("_salts")))
    is_hot = F.xxhash64(F.lit("group"), F.col(group)) == F.col("_hash")
    columns = values.columns
    small = values.join(hot, is_hot, "left").filter("_salts is null").select(*columns)
    # ever true, but known only after the join: so both joins read the same columns, in one broadcast
    large = values.join(hot, is_hot).filter("_n * _salts > 0").select(*columns)
    ranked = [_ranked_whole(small, group), _ranked_in_slots(large, group)]

    def at(rank: str) -> Column:
        return F.max(F.expr(f"case when _through > {rank} and _through - _n <= {rank} then _v end"))

    median = ((at("_low_rank") + at("_high_rank")) / 2).alias(out)
    small, large = (rows.groupBy(group).agg(median) for rows in ranked)
    return small.unionByName(large)


def _ranked_whole(values: DataFrame, group: str) -> DataFrame:
    """Values with the rows through them and the two middle ranks, each group ordered in one task."""
    whole = Window.partitionBy(group)
    return values.withColumns(
        {"_through": F.sum("_n").over(whole.orderBy("_v")), "_total": F.sum("_n").over(whole)}
    ).selectExpr(
        *(group, "_v", "_n", "_through"),
        *("(_total - 1) div 2 as _low_rank", "_total div 2 as _high_rank"),
    )


def _ranked_in_slots(values: DataFrame, group: str) -> DataFrame:
    """The same for the values that may hold the middle ranks, of groups of any size.

    The range of values is cut into as many slots as there are shuffle tasks, at approximate quantiles
    of the rows of all groups, so that a slot holds about a task's share of rows whatever group they
    are from. The slot with the middle rank follows from slot totals, and only the values of that
    slot are put in order.
    """
    slots = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / slots for i in range(1, slots)] or [0.5]
    bounds = values.agg(F.percentile_approx("_v", shares, 10 * slots)).scalar()
    values = values.withColumn("_bounds", bounds)
    values = values.withColumn("_slot", _slot("_v", F.col("_bounds"), len(shares))).drop("_bounds")
    whole = Window.partitionBy(group)
    chosen = (
        values.groupBy(group, "_slot")
        .agg(F.sum("_n").alias("_in_slot"))
        .withColumns(
            {
                "_through": F.sum("_in_slot").over(whole.orderBy("_slot")),
                "_total": F.sum("_in_slot").over(whole),
            }
        )
        .selectExpr(
            group,
            "_slot",
            "_through - _in_slot as _below",
            "_through",
            "(_total - 1) div 2 as _low_rank",
            "_total div 2 as _high_rank",
        )
        .filter("_below <= _high_rank and _through > _low_rank")
        .drop("_through")
    )
    in_slot = Window.partitionBy(group, "_slot").orderBy("_v")
    return values.join(chosen, [group, "_slot"]).withColumn(
        "_through", F.col("_below") + F.sum("_n").over(in_slot)
    )
