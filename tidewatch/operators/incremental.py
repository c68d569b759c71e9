"""Keeping the ticket fact up to date: lookback filter, merge by key, schema sync."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources.clusters import Clustering, clustering_of
from tidewatch.sources.tables import Copies, write_table


def lookback_filter(
    source: DataFrame,
    target: DataFrame,
    time: str,
    days: int,
    key: str | None = None,
    changed_columns: tuple[str, ...] = (),
) -> DataFrame:
    """Source rows dated from ``days`` before the target's newest day on.

    An empty target takes every row. Changes of older rows are not seen, unless
    ``changed_columns`` names columns whose difference from the target (matched by
    ``key``) selects a row too.
    """
    newest = target.agg(F.date_sub(F.to_date(F.max(time)), days).cast("timestamp_ntz")).scalar()
    recent = F.when(newest.isNull(), F.lit(True)).otherwise(F.col(time) >= newest)
    if not changed_columns:
        return source.filter(recent)
    known = target.select(key, F.struct(*changed_columns).alias("_known"))
    changed = F.col("_known").isNotNull() & ~F.struct(*changed_columns).eqNullSafe(F.col("_known"))
    missed = F.col("_known").isNull()
    return (
        source.join(known, key, "left")
        .filter(F.coalesce(recent, F.lit(False)) | changed | missed)
        .drop("_known")
    )


def sync_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``: missing ones null, others dropped."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def merge_by_key(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of the batch, and the target's rows with other keys, in the batch's columns."""
    kept = target.join(batch.select(key), key, "left_anti")
    return sync_schema(kept, batch.schema).unionByName(batch)


def _partition_values(spark: SparkSession, table: str) -> list[str | None]:
    """Values of a table's only partition column, from the catalog (no data is read)."""
    found = [r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return [None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in found]


def newest_floor(spark: SparkSession, table: str, time: str, partition: str, days: int):
    """The day from which on a refresh reads again; None if the table holds no dated row.

    Only the newest partition is scanned: ``partition`` is the month of ``time``.
    """
    months = [m for m in _partition_values(spark, table) if m is not None]
    if not months:
        return None
    newest = spark.table(table).filter(F.col(partition) == F.lit(max(months)).cast("date"))
    return newest.agg(F.date_sub(F.to_date(F.max(time)), days)).first()[0]


@contextmanager
def _session_setting(spark: SparkSession, key: str, value: str):
    """An insert into a catalog table follows the session, not the writer's options."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def merge_into_table(
    batch: DataFrame, table: str, key: str, partition: str, keys_stay: bool = False
) -> None:
    """Upserts ``batch`` into a Parquet table partitioned by ``partition``.

    Only the partitions that hold a key of the batch, before or after, are rewritten. The
    batch and the new content of those partitions are written to the shared folder first
    and put in place from there: the job never reads what it overwrites, a lost executor
    costs a task, and merging the same batch again gives the same table. The copies are removed
    when the merge ends. Should the driver die in the moment the partitions are swapped, the
    copy (its path is logged) holds their new content and is inserted again.

    To find the partitions a key was in before, the table's keys are compared with the
    batch. ``keys_stay`` says that no key ever changes its partition, which saves that. A table
    clustered by ``key`` (``write_clustered``) is searched by its index of places instead, and neither the
    index nor the table moves a row for the search or for taking the batch's keys out.

    A table format with row-level operations would take ``MERGE INTO`` here; built-in
    Parquet tables refuse it. A column that is new, gone or of another type in the batch is
    synchronised: the table is rewritten with the columns of the batch.
    """
    with Copies(batch.sparkSession) as keep:
        _merge(batch, table, key, partition, keys_stay, keep)


def _columns(df: DataFrame) -> set[tuple[str, str]]:
    return {(f.name, f.dataType.simpleString()) for f in df.schema.fields}


def _merge(
    batch: DataFrame, table: str, key: str, partition: str, keys_stay: bool, keep: Copies
) -> None:
    spark = batch.sparkSession
    batch = keep(batch)
    target = spark.table(table)
    clustered = clustering_of(spark, table, partition)
    if clustered is not None and clustered.key != key:
        raise ValueError(f"{table} is clustered by {clustered.key}, not by {key}")
    if _columns(target) != _columns(batch):
        merged = keep(merge_by_key(target, batch, key))
        if clustered is None:
            write_table(merged, table, partition)
        else:
            clustered.write(merged.select(*batch.columns))
        return
    touched = batch.select(partition)
    if clustered is not None:
        known = keep(clustered.find(batch))
        places = [F.col(f"b.{c}").eqNullSafe(F.col(f"k.{c}")) for c in (key, partition)]
        clustered.add_places(batch.alias("b").join(known.alias("k"), places, "left_anti"))
        touched = touched.union(known.select(partition))
    elif not keys_stay:
        before = target.join(batch.select(key), key, "left_semi").select(partition)
        touched = touched.union(before)
    # bounded by the number of partitions of the table
    values = [r[0] for r in touched.distinct().collect()]
    if not values:
        return
    merged = merged_partitions(batch, table, key, partition, values, clustered).select(*target.columns)
    merged = keep(merged if clustered else merged.hint("rebalance", partition))

    replace_partitions(merged, table, partition, values, clustered)


def merged_partitions(
    batch: DataFrame, table: str, key: str, partition: str, values: list, clustered: Clustering | None = None
) -> DataFrame:
    """The partitions ``values`` of a table with the batch merged in."""
    target = batch.sparkSession.table(table).filter(in_partitions(partition, values))
    if clustered is None:
        return merge_by_key(target, batch, key)
    kept = target.join(clustered.deal(batch.select(key)), key, "left_anti")
    return sync_schema(kept, batch.schema).unionByName(batch)


def replace_partitions(
    content: DataFrame, table: str, partition: str, values: list, clustered: Clustering | None = None
) -> None:
    """Puts ``content``, a stored copy, in place of the partitions ``values`` of a table."""
    spark = content.sparkSession
    filled = {r[0] for r in content.select(partition).distinct().collect()}
    with _session_setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        dealt = clustered.deal(content) if clustered else content.hint("rebalance", partition)
        dealt.write.insertInto(table, overwrite=True)
    for value in set(values) - filled:
        literal = "null" if value is None else f"date '{value}'"
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition} = {literal})")
    spark.catalog.refreshTable(table)


def in_partitions(partition: str, values: list) -> Column:
    """Rows of the partitions ``values``, among which may be that of null."""
    hit = F.col(partition).isin([v for v in values if v is not None])
    if None in values:
        hit = F.coalesce(hit, F.lit(False)) | F.col(partition).isNull()
    return hit
