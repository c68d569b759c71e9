import random

import pytest
from helpers import at
from pyspark.sql import functions as F

from tidewatch.operators.lookup import (
    first_per_key,
    hot_keys,
    identity_lookup,
    investor_by_email,
    label_lookup,
    manager_by_email,
    spread_lookup,
)

INVESTORS = "investor_id string, email string, partner_id string, created_at timestamp_ntz"
MANAGERS = "rm_id string, rm_email string, partner_id string"


def test_dated_row_precedes_undated_one(spark):
    df = spark.createDataFrame(
        [("a", "x", "P1", None), ("b", "x", "P2", at("2024-01-02")), ("c", "x", "P3", None)],
        INVESTORS,
    )
    got = investor_by_email(df).collect()
    assert [(r.email, r.investor_id, r.investor_partner_id, r.investor_match_count) for r in got] == [
        ("x", "b", "P2", 3)
    ]


def test_id_breaks_ties_and_null_keys_are_left_out(spark):
    same = at("2024-01-02")
    df = spark.createDataFrame(
        [("b", "x", "P2", same), ("a", "x", None, same), ("c", None, "P3", same)], INVESTORS
    )
    got = investor_by_email(df).collect()
    assert [(r.email, r.investor_id, r.investor_partner_id) for r in got] == [("x", "a", None)]


def test_first_per_key_equals_row_number(spark):
    rng = random.Random(7)
    data = [
        (rng.choice("kkkkklm") if i % 9 else None, rng.choice([None, 1, 2, 3]), i)
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "k string, o int, id int")
    got = first_per_key(df, "k", ["o", "id"], ["id", "o"], "n")
    df.createOrReplaceTempView("numbered")
    expected = spark.sql(
        """select k, id, o, n from (
             select *, row_number() over (partition by k order by o nulls last, id) as rn,
                    count(*) over (partition by k) as n
             from numbered where k is not null) where rn = 1"""
    )
    assert sorted(got.collect()) == sorted(expected.collect())


def test_identity_lookup_equals_the_two_single_lookups(spark):
    investors = spark.createDataFrame(
        [("a", "x", "P1", None), ("b", "x", "P2", at("2024-01-02")), ("c", "y", None, None)],
        INVESTORS,
    )
    managers = spark.createDataFrame(
        [("m2", "x", "P3"), ("m1", "x", "P4"), ("m3", "z", None), ("m4", None, "P1")], MANAGERS
    )
    both = identity_lookup(investors, managers)
    single = investor_by_email(investors).join(
        manager_by_email(managers).withColumnRenamed("rm_email", "email"), "email", "full"
    )
    assert sorted(both.collect()) == sorted(single.select(both.columns).collect())


def test_label_spellings_collapse(spark):
    df = spark.createDataFrame(
        [("ACME", "P1"), ("acme ", "P1"), ("Acme", "P1"), ("Beta", "P2")],
        "label_raw string, partner_id string",
    )
    got = {r.label_norm: r.label_partner_id for r in label_lookup(df).collect()}
    assert got == {"acme": "P1", "beta": "P2"}


def hot_third(spark, n=3000):
    """A third of the rows under one key, 44 % without a key, keys without a lookup row."""
    data = [
        (i, "hot" if i % 9 < 3 else None if i % 9 < 7 else f"k{i % 50}") for i in range(n)
    ]
    facts = spark.createDataFrame(data, "id int, k string")
    lookup = spark.createDataFrame(
        [("hot", 1), *((f"k{i}", i) for i in range(25)), ("other", 9)], "k string, v int"
    )
    return facts, lookup


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("tasks", [1, 8, 64])
def test_spread_lookup_equals_left_join(spark, tasks, broadcast):
    facts, lookup = hot_third(spark)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "10485760" if broadcast else "-1",
        "spark.sql.shuffle.partitions": str(tasks),
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = spread_lookup(facts, lookup, ["k"], "id")
        expected = facts.join(lookup, ["k"], "left")
        assert got.columns == expected.columns
        assert got.orderBy("id").collect() == expected.orderBy("id").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_spread_lookup_on_two_columns(spark):
    facts = spark.createDataFrame(
        [(i, "a" if i % 4 else None, i % 2 if i % 5 else None) for i in range(200)],
        "id int, k string, d int",
    )
    lookup = spark.createDataFrame([("a", 0, "even"), ("a", 1, "odd")], "k string, d int, v string")
    got = spread_lookup(facts, lookup, ["k", "d"], "id")
    expected = facts.join(lookup, ["k", "d"], "left")
    assert got.orderBy("id").collect() == expected.orderBy("id").collect()


def test_hot_keys_get_as_many_salts_as_their_share_needs(spark):
    facts, _ = hot_third(spark)
    found = hot_keys(facts, key=[F.col("k")], other=[F.col("id")]).collect()
    hot = facts.select(F.xxhash64(F.lit("key"), F.lit("hot"))).first()[0]
    assert [r["hash"] for r in found] == [hot]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = facts.filter("k is not null").count()
    assert found[0]["salts"] == -(-facts.filter("k = 'hot'").count() * tasks // keyed)


def test_no_task_gets_much_more_than_the_mean(spark):
    """The hot key and the rows without a key are spread over the tasks of the join."""
    facts, lookup = hot_third(spark, 40_000)
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        joined = spread_lookup(facts, lookup, ["k"], "id")
        parts = joined.groupBy(F.spark_partition_id().alias("p")).count()
        largest = max(r["count"] for r in parts.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert largest < 2.5 * 40_000 / 16
