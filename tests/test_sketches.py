import uuid
from collections import defaultdict
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.sketches import (
    monthly,
    over_period,
    rank_error,
    refresh_months,
    write_months,
)

MONTHS = [date(2024, m, 1) for m in range(1, 7)]
SKETCHED = {"quantiles": ["hours"], "distinct": ["who"]}
ASKED = {"quantiles": {"median": ("hours", 0.5), "high": ("hours", 0.9)}, "distinct": {"people": "who"}}


@pytest.fixture
def path(spark):
    folder = str(spark.conf.get("spark.sql.warehouse.dir")).removeprefix("file:")
    return f"{folder}/sketches-{uuid.uuid4().hex}"


def table(spark, rows):
    return spark.createDataFrame(rows, "grp string, month date, hours double, who string")


def small(spark):
    rows = []
    for n in range(400):
        month = None if n % 97 == 0 else MONTHS[n % 6]
        group = [None, "a", "b"][n % 3] if n % 5 else "a"
        hours = None if n % 7 == 0 else (n * 37 % 101) / 4
        rows.append((group, month, hours, None if n % 11 == 0 else f"p{n % 40}"))
    return rows + [("none", MONTHS[0], None, None)]


def expected(rows, since, until):
    groups = defaultdict(list)
    for group, month, hours, who in rows:
        if month is not None and since <= month < until:
            groups[group].append((hours, who))
    found = {}
    for group, members in groups.items():
        hours = sorted(h for h, _ in members if h is not None)
        median = hours[(len(hours) + 1) // 2 - 1] if hours else None
        found[group] = (len(members), median, len({w for _, w in members if w is not None}))
    return found


def answers(stored, since, until):
    rows = over_period(stored, ["grp"], "month", since, until, **ASKED).collect()
    return {r["grp"]: (r["row_count"], r["median"], r["people"]) for r in rows}


def test_small_groups_are_exact_over_any_period(spark, path):
    rows = small(spark)
    write_months(monthly(table(spark, rows), ["grp"], "month", **SKETCHED), path, "month")
    stored = spark.read.parquet(path)
    for since, until in [(MONTHS[0], date(2025, 1, 1)), (MONTHS[1], MONTHS[3]), (MONTHS[2], MONTHS[2])]:
        assert answers(stored, since, until) == expected(rows, since, until)
    everything = over_period(stored, [], "month", **ASKED).first()
    assert everything["row_count"] == len(rows)


def test_months_outside_the_period_are_not_read(spark, path):
    write_months(monthly(table(spark, small(spark)), ["grp"], "month", **SKETCHED), path, "month")
    asked = over_period(spark.read.parquet(path), ["grp"], "month", MONTHS[1], MONTHS[3], **ASKED)
    plan = asked._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "month" in filters and ">=" in filters and "<" in filters


def test_large_groups_stay_within_the_stated_errors(spark):
    """A third of all rows in one group; parts merged against the exact answers."""
    count = 300_000
    rows = spark.range(0, count, 1, 12).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 4)).alias("grp"),
        F.expr("add_months(date'2024-01-01', cast(id % 6 as int))").alias("month"),
        (F.xxhash64("id") % 1_000_000 / 1000.0).alias("hours"),
        (F.xxhash64("id") % 50_000).cast("string").alias("who"),
    )
    sketched = monthly(rows, ["grp"], "month", **SKETCHED)
    got = {r["grp"]: r for r in over_period(sketched, ["grp"], "month", **ASKED).collect()}
    values = rows.groupBy("grp").agg(F.collect_list("hours").alias("h"), F.countDistinct("who").alias("n"))
    for row in values.collect():
        for name, share in (("median", 0.5), ("high", 0.9)):
            below = sum(h <= got[row["grp"]][name] for h in row["h"]) / len(row["h"])
            assert abs(below - share) <= 2 * rank_error()
        assert got[row["grp"]]["people"] == pytest.approx(row["n"], rel=4 / 2**7)


def test_a_refresh_replaces_the_changed_months_alone(spark, path):
    rows = small(spark)
    write_months(monthly(table(spark, rows), ["grp"], "month", **SKETCHED), path, "month")
    before = {p: p.stat().st_mtime_ns for p in Path(path).glob("month=*/*.parquet")}
    later = [r for r in rows if r[1] != MONTHS[4]]  # a month loses all its rows, another gains some
    later += [("new", MONTHS[1], 1.0 * n, f"q{n}") for n in range(30)]
    for _ in range(2):  # run again, as after the loss of the driver
        refresh_months(
            table(spark, later), path, [MONTHS[1], MONTHS[4]], ["grp"], "month", **SKETCHED
        )
    stored = spark.read.parquet(path)
    assert answers(stored, MONTHS[0], date(2025, 1, 1)) == expected(later, MONTHS[0], date(2025, 1, 1))
    assert answers(stored, MONTHS[4], MONTHS[5]) == {}
    kept = {p for p in before if p.exists() and p.stat().st_mtime_ns == before[p]}
    touched = {f"month={MONTHS[1]}", f"month={MONTHS[4]}"}
    assert {p.parent.name for p in set(before) - kept} == touched


def test_empty_table(spark):
    sketched = monthly(table(spark, []), ["grp"], "month", **SKETCHED)
    assert over_period(sketched, ["grp"], "month", **ASKED).collect() == []
