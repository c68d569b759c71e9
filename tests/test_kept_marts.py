"""Marts that follow merges equal marts that are built whole."""

import random
from datetime import date, datetime, timedelta

import pytest
from helpers import at, model, records

from tidewatch.operators import deltas
from tidewatch.plans import kept_marts
from tidewatch.plans.kept_marts import KEPT, MONTH, KeptMarts

PEOPLE = {
    "investors": [
        {"investor_id": f"I{n}", "email": f"i{n}@x.com", "entity_id": f"E{n % 2}", "created_at": at("2024-01-01")}
        for n in range(3)
    ],
    "entities": [{"entity_id": f"E{n}", "entity_name": "e", "partner_id": f"P{n}"} for n in range(2)],
    "partners": [{"partner_id": f"P{n}", "partner_name": f"Partner {n}"} for n in range(3)],
    "label_synonyms": [{"label_raw": "two", "partner_id": "P2"}],
    "tag_themes": [
        {"tag": t, "theme": t[0], "theme_label": t[0].upper(), "theme_sort_order": 1} for t in ("aa", "ab", "b")
    ],
    "closes": [
        {"close_id": "K1", "fund_id": "F", "partner_id": "P1", "close_number": 1, "close_status": "completed",
         "scheduled_close_date": date(2024, 4, 10), "total_committed_aum": 5},
    ],
}


def ticket(rng, id):
    created = datetime(2024, 3, 1) + timedelta(hours=rng.randrange(24 * 120))
    return {
        "ticket_id": id,
        "requester_email": rng.choice(["i0@x.com", "i1@x.com", "i2@x.com", "q@x.com", "b@corp.com", None]),
        "partner_label": rng.choice(["two", None, "odd"]),
        "status": rng.choice(["open", "resolved"]),
        "priority": rng.choice(["high", "low", "urgent"]),
        "created_at": rng.choice([created] * 9 + [None]),
        "resolved_at": rng.choice([None, created + timedelta(days=rng.randrange(40))]),
        "tags": rng.choice([None, "aa", "aa,ab", "b, aa,aa", "zz"]),
    }


def of(spark, tickets):
    return model(spark, **PEOPLE, tickets=list(tickets.values()))


def rows(df):
    return sorted((tuple(sorted(r.items(), key=lambda x: x[0])) for r in records(df)), key=str)


def whole(built):
    return {
        "mart_is_pressure_weekly": built.team_pressure_weekly,
        "mart_partner_pressure_weekly": built.partner_pressure_weekly,
        "mart_theme_ticket_summary": built.theme_summary,
        "mart_attribution_health": built.attribution_health,
    }


@pytest.fixture(autouse=True)
def few_tasks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture
def schema(spark):
    spark.sql("create database if not exists kept")
    yield "kept"
    spark.sql("drop database kept cascade")


def test_ten_merges_equal_a_full_build(spark, schema, tmp_path):
    rng = random.Random(8)
    tickets = {n: ticket(rng, n) for n in range(60)}
    kept = KeptMarts(spark, schema, f"file://{tmp_path}/log")
    kept.create(of(spark, tickets))
    for step in range(10):
        changed = {n: ticket(rng, n) for n in rng.sample(sorted(tickets), 4)}
        changed |= {100 + step: ticket(rng, 100 + step)}
        tickets |= changed
        assert kept.merge(of(spark, changed)) == step + 1
    final = of(spark, tickets)
    got, want = kept.marts(final), whole(final)
    for name, df in want.items():
        assert rows(got[name]) == rows(df), name
        assert dict(got[name].dtypes) == dict(df.dtypes), name
    assert rows(spark.table(f"{schema}.fct_tickets").select(*final.ticket_fact.columns)) == rows(final.ticket_fact)
    assert rows(spark.table(f"{schema}.fct_ticket_tags").drop("created_month")) == rows(final.ticket_tags)


def test_a_group_without_tickets_vanishes(spark, schema, tmp_path):
    one = {"ticket_id": 1, "requester_email": "i0@x.com", "tags": "aa", "created_at": at("2024-03-05")}
    kept = KeptMarts(spark, schema, f"file://{tmp_path}/log")
    kept.create(of(spark, {1: one}))
    moved = of(spark, {1: {**one, "created_at": at("2024-05-05"), "tags": None}})
    kept.merge(moved)
    got = kept.marts(moved)
    assert got["mart_theme_ticket_summary"].count() == 0
    assert [r["week_start"] for r in records(got["mart_attribution_health"])] == [date(2024, 4, 29)]


@pytest.mark.parametrize("dies_at", [2, 5])
def test_a_driver_that_dies_half_way(spark, schema, tmp_path, monkeypatch, dies_at):
    """The next merge finishes what was logged; nothing is counted twice."""
    rng = random.Random(9)
    tickets = {n: ticket(rng, n) for n in range(20)}
    kept = KeptMarts(spark, schema, f"file://{tmp_path}/log")
    kept.create(of(spark, tickets))
    steps = 0

    class Died(Exception):
        pass

    def counted(step):
        def run(*args, **options):
            nonlocal steps
            steps += 1
            if steps == dies_at:
                raise Died
            return step(*args, **options)

        return run

    first = {n: ticket(rng, n) for n in (1, 2, 50)}
    with monkeypatch.context() as patched:
        patched.setattr(deltas, "apply_change", counted(deltas.apply_change))
        patched.setattr(kept_marts, "merge_into_table", counted(kept_marts.merge_into_table))
        with pytest.raises(Died):
            kept.merge(of(spark, first))
    second = {n: ticket(rng, n) for n in (2, 3, 51)}
    kept.merge(of(spark, second))
    final = of(spark, {**tickets, **first, **second})
    got, want = kept.marts(final), whole(final)
    for name, df in want.items():
        assert rows(got[name]) == rows(df), name


def test_only_touched_months_are_read(spark, schema, tmp_path, monkeypatch):
    rng = random.Random(10)
    kept = KeptMarts(spark, schema, f"file://{tmp_path}/log")
    kept.create(of(spark, {n: ticket(rng, n) for n in range(60)}))
    read = []
    union = deltas.added

    def seen(state, change, keys, counters):
        files = [f for f in state.inputFiles() if "_weeks" in f]
        read.append({f.split(f"{MONTH}=")[1].split("/")[0] for f in files})
        return union(state, change, keys, counters)

    monkeypatch.setattr(deltas, "added", seen)
    one = {**ticket(rng, 500), "created_at": at("2024-05-08"), "resolved_at": None, "tags": "aa"}
    one["requester_email"] = "i0@x.com"
    kept.merge(of(spark, {500: one}))
    assert len(read) == len(KEPT) and all(months == {"2024-05-01"} for months in read)
