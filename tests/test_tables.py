"""Stored tables, views and report orders against the rows of the SQL."""

import pytest
from test_oracle import ORACLE, SF_DIR, _rows, duck  # noqa: F401

from fixture.extracts import warehouse
from fixture.oracle import statement
from fixture.queries import LOADED_UNTIL, MERGED, QUERIES
from tidewatch import Warehouse
from tidewatch.operators.incremental import lookback_filter, merge_into_table
from tidewatch.sources import RAW, write_table

#: tables of a build and the query whose SQL gives their rows
TABLES = {
    "dim_partner": "dim_partner",
    "dim_relationship_manager": "dim_manager",
    "dim_entity": "dim_entity",
    "dim_investor": "dim_investor",
    "dim_fund_close": "dim_close",
    "fct_tickets": "ticket_fact",
    "fct_ticket_tags": "ticket_tags",
    "mart_investor_ticket_summary": "investor_summary",
    "mart_is_pressure_weekly": "team_pressure_weekly",
    "mart_partner_pressure_weekly": "partner_pressure_weekly",
    "mart_close_ticket_pressure": "close_pressure_14",
    "mart_staffing_forecast": "staffing_forecast",
    "mart_theme_ticket_summary": "theme_summary",
    "mart_attribution_health": "attribution_health",
}
#: the sort keys of each report: column, and whether it descends
ORDERS = {
    "aq_01": [("open_count", True), ("ticket_count", True), ("investor_id", False)],
    "aq_03": [("investors_never_raised_ticket", True), ("partner_name", False)],
    "aq_06": [("scheduled_close_date", False)],
    "aq_07": [("total_expected_tickets", True), ("partner_name", False)],
    "aq_08": [("week_start", False)],
    "aq_09": [("tickets_high_urgent", True), ("week_start", False)],
    "aq_10": [("tickets", True), ("partner_name", False)],
    "aq_11": [("tickets_in_window", True), ("close_id", False)],
    "aq_12": [("week_start", True)],
    "aq_13": [("created_at", False), ("ticket_id", False)],
    "aq_14": [("tickets", True), ("partner_name", False)],
}


def wanted(duck, query):  # noqa: F811
    result = duck.execute(query)
    return _rows([d[0] for d in result.description], result.fetchall())


def held(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture(scope="module")
def built(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS stored")
    model = warehouse(spark, SF_DIR)
    yield model.build("stored")
    spark.sql("DROP DATABASE stored CASCADE")


@pytest.mark.parametrize("table", sorted(TABLES))
def test_stored_tables(spark, duck, built, table):  # noqa: F811
    assert held(spark.table(f"stored.{table}")) == wanted(duck, ORACLE[TABLES[table]])


def test_views(spark, duck):  # noqa: F811
    warehouse(spark, SF_DIR).register_views()
    for table in ("mart_is_pressure_weekly", "stg_fund_closes", "int_tickets"):
        name = {"stg_fund_closes": "stage_closes", "int_tickets": "attribution"}.get(
            table, TABLES.get(table)
        )
        assert held(spark.table(table)) == wanted(duck, ORACLE[name])


def test_sources_have_the_declared_columns_and_the_sql_rows(spark, duck, tmp_path):  # noqa: F811
    from pyspark.sql import functions as F

    from tidewatch.sources import read_extract

    model = warehouse(spark, SF_DIR)
    for name, schema in RAW.items():
        df = model.raw[name].select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))
        df.write.options(header=True, escape='"').csv(str(tmp_path / f"{name}.csv"))
        back = read_extract(spark, name, str(tmp_path / f"{name}.csv"))
        assert back.dtypes == [(f.name, f.dataType.simpleString()) for f in schema.fields]
        assert back.count() == sum(wanted(duck, statement(f"select * from raw_{name}")).values())


def test_merge_and_full_refresh(spark, duck):  # noqa: F811
    model = warehouse(spark, SF_DIR)
    rows = QUERIES["incremental_merge"](spark, SF_DIR)
    early = rows.filter(f"created_at <= timestamp_ntz '{LOADED_UNTIL} 00:00:00'")
    assert early.count() > 0
    write_table(early.filter("ticket_id % 3 <> 0").select(*MERGED), "merged", "created_month")
    try:
        recent = lookback_filter(
            model.tickets, spark.table("merged").filter("1 = 0"), "created_at", 3
        )
        batch = Warehouse(model.raw, model.settings)
        batch.tickets = recent
        merge_into_table(batch.ticket_fact.select(*MERGED), "merged", "ticket_id", "created_month")
        assert held(spark.table("merged")) == held(model.ticket_fact.select(*MERGED))
        merge_into_table(rows, "merged", "ticket_id", "created_month")
        assert held(spark.table("merged").select(*MERGED)) == wanted(
            duck, ORACLE["incremental_merge"]
        )
        model.refresh_fact(spark, "merged", full=True)
        assert held(spark.table("merged")) == wanted(duck, ORACLE["ticket_fact"])
    finally:
        spark.sql("DROP TABLE merged")


def test_reports_come_in_order(spark):
    for name, keys in ORDERS.items():
        rows = [r.asDict() for r in QUERIES[name](spark, SF_DIR).collect()]
        for later, earlier in zip(rows[1:], rows, strict=False):
            for column, descending in keys:
                a, b = earlier[column], later[column]
                if a == b:
                    continue
                if a is not None and b is not None:
                    assert (a > b) == descending, (name, column)
                break


def test_reports_that_sort_by_what_they_do_not_show(spark):
    medians = dict(
        QUERIES["investor_summary"](spark, SF_DIR)
        .select("investor_id", "median_resolution_hours")
        .collect()
    )
    names = [r["full_name"] for r in QUERIES["aq_02"](spark, SF_DIR).collect()]
    people = QUERIES["investor_summary"](spark, SF_DIR).collect()
    of_name = {p["full_name"]: medians[p["investor_id"]] for p in people}
    shown = [of_name[n] for n in names]
    assert shown == sorted(shown, reverse=True) and len(shown) > 1
    order = {r["theme_label"]: r["theme_sort_order"] for r in QUERIES["theme_summary"](spark, SF_DIR).collect()}
    for name in ("aq_04", "aq_05"):
        labels = [r["theme_label"] for r in QUERIES[name](spark, SF_DIR).collect()]
        assert labels == sorted(labels, key=order.get) and labels
