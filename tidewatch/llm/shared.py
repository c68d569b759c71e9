"""Helpers the operators share: stored copies, free column names, lookups that stand hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.tables import shared_folder, write_once

__all__ = [
    *("all_of", "attach", "content_hash", "fresh", "read", "shared_folder", "shuffle_tasks"),
    *("text_of", "write_once"),
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str | Column = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def all_of(names: list[str]) -> list[Column]:
    """The columns of these names, which may hold dots and back quotes."""
    return [F.col(f"`{name.replace('`', '``')}`") for name in names]


def content_hash(df: DataFrame) -> Column:
    """A hash of all columns; those that hold maps or variants, which have none, count as JSON."""
    plain, other = [], []
    for field, column in zip(df.schema, all_of(df.columns), strict=True):
        kind = field.dataType.simpleString()
        (other if "map<" in kind or "variant" in kind else plain).append(column)
    return F.xxhash64(*plain, *(F.to_json(F.struct(column)) for column in other))


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to the one row of ``groups`` with the same ``key``.

    ``size`` is the number of ``rows`` with that key, ``total`` the number of all. A key with
    more rows than a task's fair share is hot; there are fewer hot keys than shuffle tasks, so
    their groups are broadcast and their rows stay where they are. All others shuffle, and no
    task gets more than a fair share of one key.
    """
    tasks = shuffle_tasks(rows.sparkSession)
    is_hot = F.col(size) * F.lit(tasks) > F.lit(total)
    hot, cold = groups.filter(is_hot), groups.filter(~is_hot)
    resting = rows.join(F.broadcast(hot), key)
    moving = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return resting.unionByName(moving)
