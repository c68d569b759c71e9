"""Weekly counts of a stream against the mart built from the same tickets."""

import random
from datetime import date, datetime, timedelta

import pytest
from helpers import model, records
from pyspark.sql import functions as F

from tidewatch.streaming.weekly import closed_weeks, count_weeks

SCHEMA = "ticket_id long, created_at timestamp_ntz, priority string, part int"


def tickets(count=200, seed=3):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for n in range(count):
        at = start + timedelta(hours=8 * n)
        rows.append((n, at, rng.choice(["high", "low", "urgent"]), n * 4 // count))
    return rows


class Feed:
    """Files that arrive one after the other, and a stream that reads what is there."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.sent = spark, folder, 0

    def send(self, rows):
        self.sent += 1
        at = f"{self.folder}/in/part-{self.sent}"
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(at)

    def run(self, **options):
        rows = self.spark.readStream.schema(SCHEMA).parquet(f"{self.folder}/in/part-*")
        flags = {"urgent": "priority in ('high', 'urgent')"}
        weeks = closed_weeks(rows, "created_at", flags=flags, **options)
        query = count_weeks(weeks, f"{self.folder}/out", f"{self.folder}/checkpoint")
        query.awaitTermination()

    def counted(self):
        found = records(self.spark.read.parquet(f"{self.folder}/out"))
        weeks = [r["week_start"] for r in found]
        assert len(weeks) == len(set(weeks))  # each week once
        return {r["week_start"]: (r["rows"], r["urgent"]) for r in found}


def expected(rows, through):
    found = {}
    for _, at, priority, _ in rows:
        week = (at - timedelta(days=at.weekday())).date()
        if week + timedelta(days=7) <= through.date():
            n, urgent = found.get(week, (0, 0))
            found[week] = (n + 1, urgent + (priority != "low"))
    return found


@pytest.fixture(autouse=True)
def few_tasks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def test_closed_weeks_equal_the_mart(spark, feed):
    """One part after the other, the stream stopped and started in between."""
    rows = tickets()
    for part in range(4):
        feed.send([r for r in rows if r[3] == part])
        feed.run(delay="7 days")
    got = feed.counted()
    last = max(r[1] for r in rows)
    assert got == expected(rows, last - timedelta(days=7)) and len(got) > 6
    built = model(
        spark,
        tickets=[{"ticket_id": n, "created_at": at, "priority": p} for n, at, p, _ in rows],
    )
    mart = {r["week_start"]: r for r in records(built.team_pressure_weekly)}
    for week, (count, urgent) in got.items():
        assert (mart[week]["tickets_created"], mart[week]["tickets_high_urgent"]) == (count, urgent)


def test_late_rows_within_and_beyond_the_delay(feed):
    rows = tickets(60)  # 20 days from a Monday on
    feed.send(rows)
    feed.run(delay="7 days")
    within = (500, datetime(2024, 1, 14, 12), "high", 0)  # its week is open until 2024-01-22
    beyond = (501, datetime(2024, 1, 2), "high", 0)  # its week was counted
    feed.send([within, beyond])
    feed.run(delay="7 days")
    feed.send([(502, datetime(2024, 3, 1), "low", 0)])
    feed.run(delay="7 days")
    got = feed.counted()
    assert got == expected([*rows, within], datetime(2024, 2, 23))


def test_repeated_rows_and_rows_without_a_time(feed):
    rows = tickets(30)
    feed.send([*rows, *rows[:10], (900, None, "high", 0)])
    feed.send([(901, datetime(2024, 2, 20), "low", 0)])
    feed.run(delay="7 days", key="ticket_id")
    assert feed.counted() == expected(rows, datetime(2024, 2, 13))


def test_groups_and_state(spark, feed):
    feed.send(tickets(100))
    rows = spark.readStream.schema(SCHEMA).parquet(f"{feed.folder}/in/part-*")
    weeks = closed_weeks(rows, "created_at", by=["priority"], delay="1 day")
    query = count_weeks(weeks, f"{feed.folder}/out", f"{feed.folder}/checkpoint")
    query.awaitTermination()
    state = query.lastProgress["stateOperators"][-1]
    assert state["numRowsTotal"] <= 2 * 3  # open weeks only
    found = spark.read.parquet(f"{feed.folder}/out")
    assert found.filter(F.col("week_start") == F.lit(date(2024, 1, 1))).agg(F.sum("rows")).first()[0] == 21
