"""The incremental refresh of the ticket fact, driven by a stream of raw tickets."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.incremental import merge_into_table
from tidewatch.plans.warehouse import Warehouse
from tidewatch.settings import Settings
from tidewatch.sources import Copies


def refresh_from_stream(
    tickets: DataFrame,
    raw: Mapping[str, DataFrame],
    settings: Settings,
    table: str,
    checkpoint: str,
    sequence: str,
    **trigger,
) -> StreamingQuery:
    """Resolves each micro-batch of raw tickets and merges it into the stored fact.

    ``tickets`` is a streaming DataFrame of raw tickets with a column ``sequence`` that grows with
    every state of a ticket (a change time or version of the source system). The state with the
    greatest sequence counts, within a batch and against what is stored: the fact keeps the
    column, and states that arrive late are dropped. Equal sequences are the same state. So a
    batch that is run again after a failure, or out of turn, changes nothing.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark, columns = batch.sparkSession, batch.columns
        newest = F.struct(F.col(sequence), F.xxhash64(*columns))
        latest = batch.groupBy("ticket_id").agg(F.max_by(F.struct(*columns), newest).alias("_row"))
        latest = latest.select("_row.*")
        spark.catalog.refreshTable(table)
        stored = spark.table(table)
        if sequence in stored.columns:
            known = stored.select("ticket_id", F.col(sequence).alias("_known"))
            late = F.col("_known").isNotNull() & ~(F.col(sequence) > F.col("_known"))
            latest = latest.join(known, "ticket_id", "left").filter(~late).select(*columns)
        with Copies(spark) as keep:
            latest = keep(latest)
            model = Warehouse(ChainMap({"tickets": latest.drop(sequence)}, raw), settings)
            fact = model.ticket_fact.join(latest.select("ticket_id", sequence), "ticket_id")
            merge_into_table(fact, table, "ticket_id", "created_month")

    return (
        tickets.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
