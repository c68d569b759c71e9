import os
import uuid

import pytest
from helpers import AS_OF, at, day, model, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import Settings, Warehouse
from tidewatch.operators.incremental import (
    lookback_filter,
    merge_by_key,
    merge_into_table,
    newest_floor,
    sync_schema,
)
from tidewatch.sources import RAW, write_table
from tidewatch.streaming import refresh_from_stream


def ticket(id, created, status="open", resolved=None):
    return {
        "ticket_id": id,
        "requester_email": f"u{id}@x.com",
        "status": status,
        "created_at": created and at(created),
        "resolved_at": resolved and at(resolved),
    }


FIRST = [
    ticket(1, "2024-01-05T10:00:00"),
    ticket(2, "2024-02-01T10:00:00"),
    ticket(3, "2024-02-10T10:00:00"),
    ticket(9, None),
]


@pytest.fixture
def table(spark):
    name = f"fact_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def state(spark, table):
    spark.catalog.refreshTable(table)  # another session may have written it
    return {r.ticket_id: (r.status, r.is_resolved) for r in spark.table(table).collect()}


def loaded(spark, table, tickets=FIRST):
    m = model(spark, tickets=tickets)
    write_table(m.ticket_fact, table, "created_month")


def test_refresh_replaces_recent_and_adds_new(spark, table):
    loaded(spark, table)
    later = [
        ticket(1, "2024-01-05T10:00:00", "closed", "2024-02-11T00:00:00"),  # too old to be seen
        ticket(2, "2024-02-01T10:00:00"),
        ticket(3, "2024-02-10T10:00:00", "closed", "2024-02-11T00:00:00"),
        ticket(4, "2024-03-01T10:00:00"),
    ]
    m = model(spark, tickets=later)
    for _ in range(2):  # a second run of the same refresh changes nothing
        m.refresh_fact(spark, table)
        assert state(spark, table) == {
            1: ("open", False),
            2: ("open", False),
            3: ("closed", True),
            4: ("open", False),
            9: ("open", False),
        }
    m.refresh_fact(spark, table, full=True)
    assert state(spark, table)[1] == ("closed", True)
    assert 9 not in state(spark, table)


def test_refresh_equals_full_build_when_changes_are_recent(spark, table):
    loaded(spark, table)
    later = [*FIRST[:2], ticket(3, "2024-02-10T10:00:00", "closed", "2024-02-12T00:00:00"), FIRST[3]]
    m = model(spark, tickets=later)
    m.refresh_fact(spark, table)
    key = "ticket_id"
    columns = m.ticket_fact.columns
    got = spark.table(table).select(columns).orderBy(key).collect()
    assert got == m.ticket_fact.orderBy(key).collect()


def test_empty_table_is_loaded_in_full(spark, table):
    loaded(spark, table, [])
    assert newest_floor(spark, table, "created_at", "created_month", 3) is None
    model(spark, tickets=FIRST).refresh_fact(spark, table)
    assert set(state(spark, table)) == {1, 2, 3, 9}


def test_key_that_changes_partition_is_moved(spark, table):
    loaded(spark, table)
    moved = model(spark, tickets=[ticket(1, "2024-03-05T10:00:00"), ticket(9, "2024-03-06T10:00:00")])
    merge_into_table(moved.ticket_fact, table, "ticket_id", "created_month")
    got = {r.ticket_id: str(r.created_month) for r in spark.table(table).collect()}
    assert got == {1: "2024-03-01", 2: "2024-02-01", 3: "2024-02-01", 9: "2024-03-01"}


def test_untouched_partitions_are_not_rewritten(spark, table):
    loaded(spark, table)
    files = "select distinct input_file_name() as f from {t} where created_month = date '2024-01-01'"
    before = spark.sql(files.format(t=table)).collect()
    batch = model(spark, tickets=[ticket(3, "2024-02-10T10:00:00", "closed")]).ticket_fact
    merge_into_table(batch, table, "ticket_id", "created_month")
    assert spark.sql(files.format(t=table)).collect() == before


def test_keys_that_stay_need_no_search(spark, table):
    loaded(spark, table)
    batch = model(spark, tickets=[ticket(3, "2024-02-10T10:00:00", "closed"), ticket(9, None, "closed")])
    merge_into_table(batch.ticket_fact, table, "ticket_id", "created_month", keys_stay=True)
    assert {i: s for i, (s, _) in state(spark, table).items()} == {
        **{1: "open", 2: "open", 3: "closed"},
        9: "closed",
    }


def test_new_columns_are_synchronised(spark, table):
    loaded(spark, table)
    batch = model(spark, tickets=[ticket(3, "2024-02-10T10:00:00", "closed")]).ticket_fact
    batch = batch.drop("subject").withColumn("channel", F.lit("mail"))
    merge_into_table(batch, table, "ticket_id", "created_month")
    got = {r.ticket_id: r for r in spark.table(table).collect()}
    assert "subject" not in spark.table(table).columns
    assert (got[3].channel, got[1].channel, got[3].status) == ("mail", None, "closed")


def test_lookback_filter(spark):
    source = rows(spark, RAW["tickets"], [*FIRST, ticket(5, "2024-02-07T00:00:00")])
    target = rows(spark, RAW["tickets"], FIRST)
    ids = lambda df: sorted(r.ticket_id for r in df.collect())
    assert ids(lookback_filter(source, target, "created_at", 3)) == [3, 5]
    assert ids(lookback_filter(source, target.limit(0), "created_at", 3)) == [1, 2, 3, 5, 9]


def test_lookback_filter_can_follow_changes(spark):
    target = rows(spark, RAW["tickets"], FIRST)
    changed = [ticket(1, "2024-01-05T10:00:00", "closed", "2024-02-11T00:00:00"), *FIRST[1:]]
    source = rows(spark, RAW["tickets"], changed)
    got = lookback_filter(
        source, target, "created_at", 3, key="ticket_id", changed_columns=("status", "resolved_at")
    )
    assert sorted(r.ticket_id for r in got.collect()) == [1, 3]


def test_merge_by_key(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, v string, gone int")
    new = spark.createDataFrame([(2, "c", True), (3, "d", False)], "k int, v string, x boolean")
    got = sorted(map(tuple, merge_by_key(old, new, "k").collect()))
    assert got == [(1, "a", None), (2, "c", True), (3, "d", False)]


def test_sync_schema(spark):
    df = spark.createDataFrame([(1, "a")], "k int, gone string")
    wanted = spark.createDataFrame([], "k bigint, fresh string").schema
    got = sync_schema(df, wanted)
    assert got.dtypes == [("k", "bigint"), ("fresh", "string")]
    assert got.first() == (1, None)


def test_a_changed_type_is_synchronised(spark, table):
    old = spark.createDataFrame([(1, 7, day("2024-01-01"))], "k int, v int, m date")
    write_table(old, table, "m")
    new = spark.createDataFrame([(2, 5_000_000_000, day("2024-01-01"))], "k int, v bigint, m date")
    merge_into_table(new, table, "k", "m")
    assert dict(spark.table(table).dtypes)["v"] == "bigint"
    assert sorted((r.k, r.v) for r in spark.table(table).collect()) == [(1, 7), (2, 5_000_000_000)]


def test_merges_leave_no_copies(spark, table):
    folder = spark.conf.get("spark.checkpoint.dir")
    copies = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    loaded(spark, table)
    before = copies()
    m = model(spark, tickets=[ticket(4, "2024-03-01T10:00:00")])
    m.refresh_fact(spark, table)
    m.refresh_fact(spark, table, full=True)
    m.check()
    assert copies() == before


def test_stream_of_tickets_refreshes_the_fact(spark, table, tmp_path):
    """States count by their sequence: a ticket is closed and opened again, and one comes late."""
    loaded(spark, table)
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    settings = Settings(as_of=AS_OF)
    raw = model(spark).raw
    schema = T.StructType([*RAW["tickets"].fields, T.StructField("version", T.LongType())])

    def arrive(*states):
        data = [{**t, "version": v} for v, t in states]
        rows(spark, schema, data).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        refresh_from_stream(
            stream, raw, settings, table, checkpoint, sequence="version"
        ).awaitTermination()

    closed = ("closed", "2024-03-02T10:00:00")
    arrive((1, ticket(3, "2024-02-10T10:00:00")), (1, ticket(4, "2024-03-01T10:00:00")))
    arrive(
        (3, ticket(4, "2024-03-01T10:00:00")),
        (2, ticket(4, "2024-03-01T10:00:00", *closed)),
        (2, ticket(1, "2024-01-05T10:00:00", "closed", "2024-02-11T00:00:00")),
    )
    want = {1: ("closed", True), 2: ("open", False), 3: ("open", False), 9: ("open", False)}
    assert state(spark, table) == {**want, 4: ("open", False)}  # opened again
    arrive((2, ticket(4, "2024-03-01T10:00:00", *closed)), (1, ticket(1, "2024-01-05T10:00:00")))
    assert state(spark, table) == {**want, 4: ("open", False)}  # both come late
    arrive((4, ticket(4, "2024-03-01T10:00:00", *closed)))
    assert state(spark, table) == {**want, 4: ("closed", True)}


def test_stored_fact_feeds_the_marts(spark, table):
    loaded(spark, table)
    m = model(spark, tickets=[])
    kept = Warehouse(m.raw, m.settings, {"fct_tickets": spark.table(table)})
    created = kept.team_pressure_weekly.agg(F.sum("tickets_created")).first()[0]
    assert created == 3
