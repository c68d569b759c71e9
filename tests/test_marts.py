import random
import statistics
from datetime import timedelta

import pytest
from helpers import AS_OF, at, day, model, records
from pyspark.sql import functions as F

from tidewatch import Settings
from tidewatch.operators import median
from tidewatch.operators.median import exact_median
from tidewatch.operators.nearby import counts_around
from tidewatch.operators.spine import align

PARTNERS = [{"partner_id": "P1", "partner_name": "One"}, {"partner_id": "P2", "partner_name": "Two"}]
LABELS = [{"label_raw": p, "partner_id": p, "partner_name": p} for p in ("P1", "P2")]


def ticket(id, created, partner="P1", **more):
    return {
        "ticket_id": id,
        "requester_email": "who@mail.com",
        "created_at": at(created),
        "partner_label": partner,
        **more,
    }


def close(id, date, status="completed", partner="P1", **more):
    return {
        "close_id": id,
        "partner_id": partner,
        "scheduled_close_date": date and day(date),
        "close_status": status,
        "total_committed_aum": 5,
        **more,
    }


def built(spark, settings=None, **extracts):
    extracts = {"partners": PARTNERS, "label_synonyms": LABELS, **extracts}
    return model(spark, settings, **extracts)


def test_window_bounds_are_inclusive_and_overlaps_count_twice(spark):
    m = built(
        spark,
        closes=[close("a", "2024-03-15"), close("b", "2024-03-20"), close("c", "2024-09-01")],
        tickets=[
            ticket(1, "2024-02-29T23:59:59"),  # 15 days before a
            ticket(2, "2024-03-01T00:00:00", priority="HIGH"),  # 14 days before a
            ticket(3, "2024-03-15T08:00:00"),  # the day of a, 5 days before b
            ticket(4, "2024-03-29T23:59:59", priority="urgent"),  # 14 days after a
            ticket(5, "2024-03-30T00:00:00"),  # 15 days after a, 10 after b
            ticket(6, "2024-03-15T08:00:00", partner="P2"),
            ticket(7, "2024-03-15T08:00:00", partner=None),
        ],
    )
    got = {
        r["close_id"]: tuple(r[f"tickets_{n}"] for n in ("in_window", "before_close", "on_or_after_close", "high_urgent"))
        for r in records(m.close_pressure)
    }
    assert got == {"a": (3, 1, 2, 2), "b": (3, 1, 2, 1), "c": (0, 0, 0, 0)}


@pytest.mark.parametrize("days", [0, 3, 14])
def test_counts_around_equal_the_interval_join(spark, days):
    rng = random.Random(days)
    start = day("2024-01-01")

    def dated(n, hot):
        return [
            (
                i,
                "hot" if rng.random() < hot else rng.choice(["a", "b", None]),
                start + timedelta(rng.randrange(60)) if rng.random() < 0.95 else None,
                rng.random() < 0.3,
            )
            for i in range(n)
        ]

    events = spark.createDataFrame(dated(500, 0.4), "id int, k string, d date, urgent boolean")
    centres = spark.createDataFrame(dated(120, 0.4), "id int, k string, c date, x boolean")
    got = counts_around(centres, events, "k", "c", "d", days, {"urgent": "urgent"})
    events.createOrReplaceTempView("near_events")
    centres.createOrReplaceTempView("near_centres")
    expected = spark.sql(
        f"""select c.k, c.c, count(distinct c.id) as centres,
                   count(e.id) div count(distinct c.id) as in_window,
                   count_if(e.d < c.c) div count(distinct c.id) as before,
                   count_if(e.urgent) div count(distinct c.id) as urgent,
                   count_if(e.d >= c.c) div count(distinct c.id) as on_or_after
            from near_centres c left join near_events e
              on c.k = e.k and abs(datediff(e.d, c.c)) <= {days}
            where c.k is not null group by c.k, c.c"""
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_forecast(spark):
    tickets = [ticket(i, "2024-01-10T00:00:00", priority="low") for i in range(5)]
    tickets += [ticket(10 + i, "2024-02-20T00:00:00", priority="urgent") for i in range(44)]
    history = [close(f"h{i}", "2024-01-10") for i in range(10)]
    history += [close(f"g{i}", "2023-01-10") for i in range(9)]
    m = built(
        spark,
        tickets=tickets,
        closes=[
            *history,
            close("x", "2024-02-20"),  # 94 tickets over 20 closes: mean 4.7
            close("today", str(AS_OF), " UPCOMING"),
            close("late", str(AS_OF - timedelta(1)), "upcoming"),
            close("new", "2024-07-01", "upcoming", partner="P2"),
            close("none", "2024-07-02", "upcoming", partner=None),
            close("off", "2024-02-20", "cancelled", partner="P2"),
        ],
    )
    got = {r["close_id"]: r for r in records(m.staffing_forecast)}
    assert set(got) == {"today", "new", "none"}  # due today is not overdue
    known = got["today"]
    assert known["historical_close_count"] == 20
    assert (known["avg_tickets_per_close"], known["expected_tickets"]) == (4.7, 5.0)
    assert (known["min_tickets_observed"], known["max_tickets_observed"]) == (0, 44)
    assert (known["avg_high_urgent_per_close"], known["expected_high_urgent_tickets"]) == (2.2, 2.0)
    assert known["pressure_window_start"] == AS_OF - timedelta(14)
    assert known["pressure_window_end"] == AS_OF + timedelta(14)
    assert (known["no_historical_data"], known["low_sample_warning"]) == (False, False)
    for unknown in (got["new"], got["none"]):
        assert unknown["no_historical_data"] and unknown["low_sample_warning"] is None
        assert unknown["expected_tickets"] is None and unknown["historical_close_count"] is None


def test_expected_tickets_come_from_the_unrounded_mean(spark):
    # 49 tickets over 20 closes: 2.45 shows as 2.5 but is expected as 2
    m = built(
        spark,
        tickets=[ticket(i, "2024-01-10T00:00:00") for i in range(49)],
        closes=[
            close("x", "2024-01-10"),
            *(close(f"h{i}", "2023-01-10") for i in range(19)),
            close("next", "2024-07-01", "upcoming"),
        ],
    )
    (row,) = records(m.staffing_forecast)
    assert (row["avg_tickets_per_close"], row["expected_tickets"]) == (2.5, 2.0)
    (load,) = records(m.load_estimate)
    assert (load["upcoming_closes"], load["expected_load"]) == (1, 2.5)


def test_investor_summary_keeps_silent_investors(spark):
    m = model(
        spark,
        investors=[{"investor_id": "I1", "email": "a@x"}, {"investor_id": "I2", "email": "b@x"}],
        rms=[{"rm_id": "R1", "email": "r@x"}],
        tickets=[
            {"ticket_id": i, "requester_email": e, "created_at": at(c), "resolved_at": r and at(r)}
            for i, e, c, r in [
                (1, "a@x", "2024-01-01T00:00:00", "2024-01-01T02:00:00"),
                (2, "a@x", "2024-01-02T00:00:00", "2024-01-02T05:00:00"),
                (3, "a@x", "2024-01-03T00:00:00", None),
                (4, "r@x", "2024-01-03T00:00:00", None),
            ]
        ],
    )
    got = {r["investor_id"]: r for r in records(m.investor_summary)}
    assert set(got) == {"I1", "I2"}
    busy, silent = got["I1"], got["I2"]
    assert (busy["ticket_count"], busy["resolved_count"]) == (3, 2)
    assert busy["avg_resolution_hours"] == busy["median_resolution_hours"] == 3.5
    assert busy["first_ticket_at"] == at("2024-01-01T00:00:00")
    assert (silent["ticket_count"], silent["open_count"]) == (0, 0)
    for column in ("avg_resolution_hours", "median_resolution_hours", "first_ticket_at"):
        assert silent[column] is None


def test_exact_median(spark):
    rng = random.Random(3)
    data = [("hot", rng.uniform(-50, 900)) for _ in range(999)]
    data += [(f"g{i % 40}", float(rng.randrange(30))) for i in range(500)]
    data += [("single", 1.25), ("pair", 2.0), ("pair", 700.5), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    counted = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    values = {}
    for g, v in data:
        if v is not None:
            values.setdefault(g, []).append(v)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for tasks in ("1", "8", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", tasks)
            got = {r.g: r.m for r in exact_median(counted, "g", "v", "n", "m").collect()}
            assert got == {g: statistics.median(v) for g, v in values.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_only_large_groups_are_cut_into_slots(spark, monkeypatch):
    cut, in_slots = [], median._ranked_in_slots
    monkeypatch.setattr(median, "_ranked_in_slots", lambda v, g: cut.append(v) or in_slots(v, g))
    small = spark.range(4000).selectExpr("id % 400 as g", "double(id) as v", "1 as n")
    large = spark.range(2001).selectExpr("-1L as g", "double(id * id) as v", "1 as n")
    got = {r.g: r.m for r in exact_median(small.union(large), "g", "v", "n", "m").collect()}
    assert got == {**{g: g + 1800.0 for g in range(400)}, -1: 1000.0**2}
    assert {r.g for r in cut[0].collect()} == {-1}
    assert exact_median(small, "g", "v", "n", "m").count() == 400 and cut[1].count() == 0


def test_median_of_durations_within_an_hour(spark):
    """A bot whose tickets all close within the hour, to the microsecond."""
    rng = random.Random(4)
    micros = [rng.randrange(3_600_000_000) for _ in range(801)]
    start = at("2024-05-01T00:00:00")
    m = built(
        spark,
        tickets=[
            ticket(i, "2024-05-01T00:00:00", resolved_at=start + timedelta(microseconds=u))
            | {"requester_email": "bot@x.com"}
            for i, u in enumerate(micros)
        ],
        investors=[{"investor_id": "bot", "email": "bot@x.com"}],
    )
    row = next(r for r in records(m.investor_summary) if r["investor_id"] == "bot")
    assert row["median_resolution_hours"] == statistics.median(micros) / 3.6e9
    assert row["avg_resolution_hours"] == pytest.approx(statistics.mean(micros) / 3.6e9)


def test_completed_closes_without_a_date_count_in_the_history(spark):
    m = built(
        spark,
        tickets=[ticket(n, "2024-01-10T00:00:00") for n in range(6)],
        closes=[
            close("dated", "2024-01-12", "completed"),
            close("undated", None, "completed"),
            close("undated too", None, "completed"),
            close("ahead", "2024-07-01", "upcoming"),
        ],
    )
    row = next(r for r in records(m.staffing_forecast) if r["close_id"] == "ahead")
    assert (row["historical_close_count"], row["low_sample_warning"]) == (3, False)
    assert (row["min_tickets_observed"], row["max_tickets_observed"]) == (0, 6)
    assert (row["avg_tickets_per_close"], row["expected_tickets"]) == (2.0, 2.0)
    load = next(r for r in records(m.load_estimate))
    assert (load["completed_close_count"], load["expected_load"]) == (3, 2.0)


def test_weekly_series_have_weeks_of_any_source(spark):
    m = built(
        spark,
        tickets=[
            ticket(1, "2024-01-01T00:00:00", priority="high", resolved_at=at("2024-01-16T00:00:00")),
            {"ticket_id": 2, "requester_email": "x"},
        ],
        closes=[close("a", "2024-02-01"), close("b", None), close("c", "2024-02-02", "cancelled")],
    )
    got = {str(r["week_start"]): tuple(r.values())[1:] for r in records(m.team_pressure_weekly)}
    assert got == {
        "2024-01-01": (1, 1, 0, 0, 0, 0, 0),
        "2024-01-15": (0, 0, 1, 0, 0, 0, 0),
        "2024-01-29": (0, 0, 0, 2, 1, 0, 10),  # a cancelled close is scheduled too
        "None": (0, 0, 0, 0, 0, 0, 0),  # a null week matches no series
    }


def test_partner_weeks_keep_a_null_partner_as_zeros(spark):
    m = built(
        spark,
        tickets=[ticket(1, "2024-01-02T00:00:00"), ticket(2, "2024-01-02T00:00:00", partner=None)],
        closes=[close("a", "2024-01-03", partner=None), close("b", "2024-01-03", partner="P7")],
    )
    got = sorted(
        (str(r["partner_id"]), r["partner_name"], r["tickets_created"], r["closes_scheduled"])
        for r in records(m.partner_pressure_weekly)
    )
    assert got == [("None", None, 0, 0), ("P1", "One", 1, 0), ("P7", None, 0, 1)]


def test_align_gives_each_key_once(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), (None, 5)], "k string, a int")
    b = spark.createDataFrame([("y", 7), ("x", 1)], "k string, b int")
    got = sorted(map(tuple, align([a, b], ["k"], ["a", "b"]).collect()), key=str)
    assert got == [("x", 3, 1), ("y", 0, 7), (None, 0, 0)]


THEMES = [
    {"tag": t, "theme": th, "theme_label": th.title(), "theme_sort_order": n}
    for t, th, n in [("kyc", "identity", 1), ("docs", "papers", 2), ("sign", "papers", 2)]
]


def test_theme_counts(spark):
    m = built(
        spark,
        tag_themes=THEMES,
        tickets=[
            ticket(1, "2024-01-30T00:00:00", tags="kyc, DOCS,sign, kyc"),
            ticket(2, "2024-02-01T00:00:00", tags="docs,other"),
            ticket(3, "2024-02-01T00:00:00", tags=None),
        ],
    )
    got = sorted(
        (r["theme"], str(r["week_start"]), str(r["month_start"]), r["ticket_count"])
        for r in records(m.theme_summary)
    )
    assert got == [
        ("identity", "2024-01-29", "2024-01-01", 1),
        ("papers", "2024-01-29", "2024-01-01", 1),  # one week, two months: two rows
        ("papers", "2024-01-29", "2024-02-01", 1),
    ]
    tags = sorted((r["ticket_id"], r["tag"]) for r in records(m.ticket_tags))
    assert tags == [(1, "docs"), (1, "kyc"), (1, "kyc"), (1, "sign"), (2, "docs"), (2, "other")]


def test_attribution_health(spark):
    m = built(
        spark,
        tickets=[
            ticket(1, "2024-01-01T00:00:00"),
            ticket(2, "2024-01-02T00:00:00", partner=None),
            ticket(3, "2024-01-02T00:00:00", partner="?"),
        ],
        closes=[close("a", "2024-01-01", "upcoming"), close("b", "2025-01-01", "upcoming")],
    )
    (row,) = records(m.attribution_health)
    assert (row["total_tickets"], row["attr_label_fallback"], row["attr_unresolved"]) == (3, 1, 2)
    assert (row["fallback_rate_pct"], row["unresolved_rate_pct"]) == (33.33, 66.67)
    assert (row["unknown_requester_rate_pct"], row["internal_requester_rate_pct"]) == (100.0, 0.0)
    assert row["stale_upcoming_close_count"] == 1


def test_salting_changes_no_mart(spark):
    rng = random.Random(5)
    extracts = {
        "tickets": [
            ticket(i, f"2024-0{rng.randrange(1, 7)}-1{rng.randrange(10)}T00:00:00", rng.choice(["P1", "P1", "P2", None]))
            for i in range(300)
        ],
        "closes": [
            close(str(i), f"2024-0{rng.randrange(1, 10)}-15", rng.choice(["completed", "upcoming"]), rng.choice(["P1", "P1", "P2", None]))
            for i in range(80)
        ],
    }
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for name in ("close_pressure", "staffing_forecast", "partner_pressure_weekly"):
            found = []
            for tasks in ("1", "64"):
                spark.conf.set("spark.sql.shuffle.partitions", tasks)
                found.append(sorted(map(str, getattr(built(spark, **extracts), name).collect())))
            assert found[0] == found[1] and found[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
