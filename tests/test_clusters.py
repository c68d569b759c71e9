"""Merges into a fact that is clustered by key: same rows, and nothing of the fact is moved to find them."""

import re
import uuid
from datetime import date, timedelta

import pytest
from helpers import at, day, model
from pyspark.sql import functions as F

from tidewatch.operators.incremental import merge_by_key, merge_into_table, merged_partitions
from tidewatch.sources import clustering_of, write_clustered, write_table

ROWS = "k bigint, v string, m date"


@pytest.fixture
def table(spark):
    name = f"clustered_{uuid.uuid4().hex}"
    yield name
    for each in (name, f"{name}_places"):
        spark.sql(f"DROP TABLE IF EXISTS {each}")


def rows_of(df):
    return sorted(((r.k, r.v, r.m) for r in df.collect()), key=str)


def months(spark, keys, value, shift=0):
    start = date(2024, 1, 1)
    data = [(k, f"{value}{k}", (start + timedelta(days=31 * ((k + shift) % 6))).replace(day=1)) for k in keys]
    return spark.createDataFrame(data, ROWS)


def exchanges(df):
    """The plan as it is laid out, without the tables it names."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("buckets", [3, 8, 20])  # fewer than, as many as and more than shuffle partitions
def test_neither_index_nor_table_is_exchanged(spark, table, no_broadcast, buckets):
    write_clustered(months(spark, range(500), "a"), table, "k", "m", buckets)
    clustered = clustering_of(spark, table, "m")
    assert (clustered.key, clustered.buckets, clustered.path) == ("k", buckets, None)
    batch = write_table(months(spark, range(400, 520), "b", 1), f"{table}_batch").select("k", "v", "m")
    found = clustered.find(batch)
    kept = merged_partitions(batch, table, "k", "m", [day("2024-01-01"), None], clustered)
    for df, name in ((found, clustered.places), (kept, table)):
        plan = exchanges(df)
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        scan = next(line for line in plan.splitlines() if f".{name}[" in line)
        depth = lambda line: len(re.match(r"[\s:|+\-]*", line)[0])
        above, at_depth = [], depth(scan)
        for line in reversed(plan.splitlines()[: plan.splitlines().index(scan)]):
            if depth(line) < at_depth:
                above.append(line)
                at_depth = depth(line)
        assert "Bucketed: true" in scan
        assert above and not any("Exchange" in line for line in above)
    assert {r.k for r in found.collect()} == set(range(400, 500))
    spark.sql(f"DROP TABLE {table}_batch")


@pytest.mark.parametrize(("external", "merges"), [(False, 10), (True, 2)])
def test_merges_give_what_the_definition_gives(spark, table, tmp_path, external, merges):
    path = str(tmp_path / "fact") if external else None
    want = months(spark, range(60), "a").collect()
    write_clustered(spark.createDataFrame(want, ROWS), table, "k", "m", 4, path)
    for n in range(merges):
        batch = months(spark, range(n * 7, n * 7 + 9), f"b{n}", shift=n)  # many keys change their month
        merge_into_table(batch, table, "k", "m")
        want = merge_by_key(spark.createDataFrame(want, ROWS), batch, "k").select("k", "v", "m").collect()
    assert rows_of(spark.table(table)) == rows_of(spark.createDataFrame(want, ROWS))
    clustered = clustering_of(spark, table, "m")
    assert (clustered.path is not None) == external
    places = {(r.k, r.m) for r in spark.table(clustered.places).collect()}
    assert places >= {(r.k, r.m) for r in want}
    clustered.write_places(spark)
    assert {(r.k, r.m) for r in spark.table(clustered.places).collect()} == {(r.k, r.m) for r in want}


def test_same_batch_again_changes_nothing(spark, table):
    write_clustered(months(spark, range(20), "a"), table, "k", "m", 4)
    batch = months(spark, range(15, 25), "b", 2)
    merge_into_table(batch, table, "k", "m")
    once, places = rows_of(spark.table(table)), spark.table(f"{table}_places").count()
    merge_into_table(batch, table, "k", "m")
    assert rows_of(spark.table(table)) == once
    assert spark.table(f"{table}_places").count() == places


def test_merge_that_died_before_the_table_changed(spark, table):
    """The places are added first: a second run finds a superset, and the table comes out right."""
    write_clustered(months(spark, range(20), "a"), table, "k", "m", 4)
    batch = months(spark, range(15, 25), "b", 2)
    clustering_of(spark, table, "m").add_places(batch)
    merge_into_table(batch, table, "k", "m")
    want = merge_by_key(months(spark, range(20), "a"), batch, "k")
    assert rows_of(spark.table(table)) == rows_of(want)


def test_null_months_empty_batches_and_emptied_months(spark, table):
    first = [(1, "a", None), (2, "b", day("2024-01-01")), (3, "c", day("2024-02-01"))]
    write_clustered(spark.createDataFrame(first, ROWS), table, "k", "m", 2)
    merge_into_table(spark.createDataFrame([], ROWS), table, "k", "m")
    assert rows_of(spark.table(table)) == sorted(first, key=str)
    merge_into_table(
        spark.createDataFrame([(1, "x", day("2024-02-01")), (2, "y", None)], ROWS), table, "k", "m"
    )
    want = [(1, "x", day("2024-02-01")), (2, "y", None), (3, "c", day("2024-02-01"))]
    assert rows_of(spark.table(table)) == sorted(want, key=str)


def test_new_columns_keep_the_clustering(spark, table):
    write_clustered(months(spark, range(8), "a"), table, "k", "m", 4)
    batch = months(spark, [3, 9], "b").withColumn("w", F.lit(7))
    merge_into_table(batch, table, "k", "m")
    assert clustering_of(spark, table, "m").buckets == 4
    got = {r.k: (r.v, r.w) for r in spark.table(table).collect()}
    assert got[3] == ("b3", 7) and got[9] == ("b9", 7) and got[1] == ("a1", None) and len(got) == 9


def test_other_keys_are_refused_and_plain_tables_have_no_clustering(spark, table):
    write_table(months(spark, range(4), "a"), table, "m")
    assert clustering_of(spark, table, "m") is None
    write_clustered(months(spark, range(4), "a"), table, "k", "m", 2)
    with pytest.raises(ValueError, match="clustered by k"):
        merge_into_table(months(spark, range(4), "b"), table, "v", "m")


def test_build_and_refresh_of_a_clustered_fact(spark):
    schema = f"built_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    fact = f"{schema}.fct_tickets"
    tickets = [
        {"ticket_id": n, "status": "open", "created_at": at(f"2024-0{1 + n % 3}-05T10:00:00")} for n in range(9)
    ]
    model(spark, tickets=tickets).build(schema, buckets=4)
    assert clustering_of(spark, fact, "created_month").buckets == 4
    later = [{**t, "status": "closed"} for t in tickets]
    m = model(spark, tickets=later)
    m.refresh_fact(spark, fact)
    closed = {r.ticket_id for r in spark.table(fact).filter("status = 'closed'").collect()}
    assert closed == {2, 5, 8} and spark.table(fact).count() == 9
    m.refresh_fact(spark, fact, full=True)
    assert clustering_of(spark, fact, "created_month").buckets == 4
    assert spark.table(fact).filter("status = 'closed'").count() == 9
    spark.sql(f"DROP DATABASE {schema} CASCADE")
