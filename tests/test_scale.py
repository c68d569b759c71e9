"""Results and plans under the settings of a cluster: many shuffle partitions, so that hot keys
are salted, and registries too large to broadcast."""

import contextlib
import io
import re

import pytest
from test_oracle import ORACLE, SF_DIR, _rows, duck  # noqa: F401

from __spark_entry__ import queries
from fixture.queries import QUERIES
from tidewatch.sources import RAW

CLUSTER = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def cluster(spark):
    before = {k: spark.conf.get(k, None) for k in CLUSTER}
    for k, v in CLUSTER.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


SALTED = [
    *("attribution", "ticket_tags", "investor_summary", "team_pressure_weekly"),
    *("partner_pressure_weekly", "close_pressure_14", "staffing_forecast", "theme_summary"),
    *("attribution_health", "incremental_merge", "check_report", "aq_05", "aq_14"),
]


@pytest.mark.parametrize("name", SALTED)
def test_same_result(cluster, duck, name):  # noqa: F811
    result = duck.execute(ORACLE[name])
    expected = _rows([d[0] for d in result.description], result.fetchall())
    df = queries()[name](cluster, SF_DIR)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == expected


def inputs_of(text, operator):
    return re.findall(rf"\(\d+\) {operator}\nInput \[\d+\]: \[(.*)\]", text)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"check_report"}))
def test_no_plan_pairs_all_rows_or_leaves_the_jvm(cluster, name):
    text = plan(queries()[name](cluster, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in text
    # what is broadcast are hot keys, fewer than tasks, and their number of rows, one per kind
    for columns in inputs_of(text, "BroadcastExchange"):
        assert re.fullmatch(r"_hash#\w+, _salts#\w+|name#\w+, of_all#\w+", columns)


def test_the_check_report_pairs_no_rows(cluster):
    """Its plan is made of the stored copies that the checks run on."""
    from fixture.extracts import warehouse
    from tidewatch.operators.checks import report
    from tidewatch.plans.quality import RULES

    text = plan(report(warehouse(cluster, SF_DIR).tables(), RULES))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "Pandas"):
        assert operator not in text


def test_the_fact_reads_the_tickets_twice(cluster):
    """Once to count hot keys of both kinds, once for the rows."""
    from fixture.extracts import warehouse
    from tidewatch import Warehouse

    source = warehouse(cluster, SF_DIR)
    folder = cluster.conf.get("spark.checkpoint.dir") + "/scanned-tickets"
    source.raw["tickets"].write.mode("overwrite").parquet(folder)
    raw = {**{n: source.raw[n] for n in RAW}, "tickets": cluster.read.parquet(folder)}
    fact = Warehouse(raw, source.settings).ticket_fact
    assert fact.collect()
    text = fact._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert "== Final Plan ==" in text and "ReusedExchange" in final
    assert final.count("scanned-tickets") == 2


def test_scans_read_only_the_columns_they_need(cluster):
    text = plan(queries()["team_pressure_weekly"](cluster, SF_DIR))
    read = re.findall(r"ReadSchema: struct<(.*)>", text)
    columns = {c.split(":")[0] for schema in read for c in schema.split(",")}
    assert {c for c in columns if c.startswith("o_")} == {
        *("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    }
    assert not columns & {"l_quantity", "l_returnflag", "p_name", "c_name", "n_name"}


def test_recent_tickets_are_filtered_in_the_scan(cluster, tmp_path):
    """The lookback of a refresh reaches the Parquet scan of the raw tickets."""
    from fixture.extracts import warehouse
    from tidewatch import Warehouse
    from tidewatch.sources import write_table

    model = warehouse(cluster, SF_DIR)
    model.raw["tickets"].write.parquet(str(tmp_path / "tickets"))
    model.raw["tickets"] = cluster.read.parquet(str(tmp_path / "tickets"))
    write_table(model.ticket_fact, "pushed", "created_month")
    try:
        batch = Warehouse(model.raw, model.settings).refresh_batch(cluster, "pushed")
        assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(created_at", plan(batch))
        month = cluster.table("pushed").filter("created_month = date '1999-01-01'")
        assert re.search(r"PartitionFilters: \[.*created_month", plan(month))
    finally:
        cluster.sql("DROP TABLE pushed")


def test_skewed_dimension_joins_are_split(spark):
    """Joins to a registry as it is read are left to AQE, which splits a hot or null key."""
    confs = {
        **CLUSTER,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
    }
    from pyspark.sql import functions as F

    from tidewatch.plans.dimensions import investors_with_partner_id

    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, "E1").when(F.col("id") % 3 == 1, None)
        investors = spark.range(0, 60000, 1, 8).select(
            F.md5(F.col("id").cast("string")).alias("investor_id"),
            hot.otherwise(F.concat(F.lit("E"), F.col("id"))).alias("entity_id"),
        )
        entities = spark.range(60000).select(
            F.concat(F.lit("E"), F.col("id")).alias("entity_id"),
            (F.col("id") % 7).cast("string").alias("partner_id"),
        )
        joined = investors_with_partner_id(investors, entities)
        rows = joined.collect()
        assert len(rows) == 60000 and sum(r.partner_id == "1" for r in rows) > 20000
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
