import re

import pytest
from helpers import AS_OF, at, day, model, records

from tidewatch import Settings
from tidewatch.operators import checks
from tidewatch.operators.checks import Overlap, Reference, TableRules
from tidewatch.operators.profile import close_order_anomalies, profile
from tidewatch.operators.synonyms import build_synonyms, distinctive_keywords
from tidewatch.plans.quality import RULES


@pytest.fixture
def child(spark):
    data = [(1, "a"), (2, "b"), (2, "x"), (3, "x"), (None, "x"), (None, None)]
    return spark.createDataFrame(data, "k int, v string")


def test_nulls_never_fail_but_for_not_null(spark, child):
    parent = spark.createDataFrame([("a",), (None,)], "p string")
    assert [tuple(r) for r in checks.unique(child, "k").collect()] == [(2, 2)]
    assert checks.not_null(child, "k").count() == 2
    odd = checks.accepted_values(child, "v", ["a", "b"])
    assert [tuple(r) for r in odd.collect()] == [("x", 3)]
    orphans = sorted(map(tuple, checks.relationships(child, "v", parent, "p").collect()))
    assert orphans == [("b", 1), ("x", 3)]
    overlap = checks.key_overlap(child, "v", parent, "p")
    assert [tuple(r) for r in overlap.collect()] == [("a", 1)]


def test_report_agrees_with_the_single_checks(spark, child):
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "p string")
    tables = {"child": child, "parent": parent, "empty": child.limit(0)}
    rules = {
        "child": TableRules(
            "k",
            not_null=("v",),
            accepted={"v": ("a", "b")},
            references=(Reference("v", "parent", "p"),),
        ),
        "parent": TableRules("p"),
        "empty": TableRules("k", accepted={"v": ("a",)}, strict=("v",)),
    }
    overlap = Overlap("disjoint", "child", "v", "parent", "p")
    got = {
        (r["check_name"], r["table_name"], r["column_name"]): (r["severity"], r["failures"], r["passed"])
        for r in records(checks.report(tables, rules, [overlap]))
    }
    assert got == {
        ("unique", "child", "k"): ("error", 1, False),
        ("not_null", "child", "k"): ("error", 2, False),
        ("not_null", "child", "v"): ("error", 1, False),
        ("accepted_values", "child", "v"): ("warn", 1, False),
        ("relationships", "child", "v"): ("warn", 4, False),
        ("unique", "parent", "p"): ("error", 1, False),
        ("not_null", "parent", "p"): ("error", 1, False),
        ("unique", "empty", "k"): ("error", 0, True),
        ("not_null", "empty", "k"): ("error", 0, True),
        ("accepted_values", "empty", "v"): ("error", 0, True),
        ("disjoint", "child", "v"): ("error", 1, False),
    }


def test_every_table_of_the_model_is_checked(spark):
    """58 checks of columns and one of two tables; a clean model passes them all."""
    m = model(
        spark,
        Settings(as_of=AS_OF),
        partners=[{"partner_id": "P1", "partner_name": "One", "partner_type": "Family_Office "}],
        rms=[{"rm_id": "R1", "partner_id": "P1", "name": "Rae", "email": "r@x"}],
        entities=[{"entity_id": "E1", "partner_id": "P1", "entity_type": "trust", "kyc_status": "Expired"}],
        investors=[{"investor_id": "I1", "email": "a@x", "entity_id": "E1"}],
        closes=[
            {
                "close_id": "K1",
                "partner_id": "P1",
                "scheduled_close_date": day("2024-07-01"),
                "close_status": "upcoming",
            }
        ],
        tickets=[
            {
                "ticket_id": 1,
                "requester_email": "A@x",
                "created_at": at("2024-06-01T00:00:00"),
                "status": "Open",
                "priority": "low",
            }
        ],
    )
    report = records(m.check())
    assert len(report) == 59
    assert [r for r in report if not r["passed"]] == []
    layers = {"stg": 24, "int": 8}
    for prefix, n in layers.items():
        assert sum(r["table_name"].startswith(f"{prefix}_") for r in report) == n
    assert set(RULES) <= set(m.tables())


def test_the_census_leaves_out_what_no_check_asks_for(spark):
    """Accepted values and nulls of columns that are no key are not counted; the key's nulls are."""
    df = spark.createDataFrame(
        [(1, "low", None), (1, "odd", None), (None, None, 5), (None, "low", 1)], "k int, p string, r int"
    )
    rules = TableRules("k", accepted={"p": ("low",)}, references=(Reference("r", "t", "k"),))
    found = checks.report({"t": df}, {"t": rules})
    assert {(r.check_name, r.column_name): r.failures for r in found.collect()} == {
        ("unique", "k"): 1, ("not_null", "k"): 2, ("accepted_values", "p"): 1, ("relationships", "r"): 1
    }
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Filter .*isnotnull\(value#\d+\) OR \(probe#\d+ = 0\).*\n\s*\+- Generate stack", text)


def test_profile(spark, child):
    got = {r["column_name"]: r for r in records(profile(child, ["k", "v"]))}
    assert (got["k"]["row_count"], got["k"]["nulls"], got["k"]["distinct_values"]) == (6, 2, 3)
    assert got["k"]["null_rate_pct"] == 33.33 and got["v"]["distinct_values"] == 3


def test_close_order_anomalies(spark):
    data = [
        ("up", 1, "2024-01-01"),
        ("up", 2, "2024-02-01"),
        ("down", 1, "2026-11-02"),
        ("down", 2, "2026-03-23"),
        ("down", 3, "2027-06-18"),
        ("same", 1, "2024-01-01"),
        ("same", 1, "2024-03-01"),
        ("same", 2, "2024-02-01"),
    ]
    df = spark.createDataFrame(
        [(f, n, day(d)) for f, n, d in data],
        "fund_id string, close_number int, scheduled_close_date date",
    )
    got = {(r["fund_id"], r["close_number"]) for r in records(close_order_anomalies(df))}
    assert got == {("down", 2), ("same", 2)}


def test_synonyms_from_distinctive_keywords(spark):
    partners = spark.createDataFrame(
        [("P1", "Clear Direct"), ("P2", " Oak Direct"), ("P3", "Direct")],
        "partner_id string, partner_name string",
    )
    words = {r.partner_id: r.keyword for r in distinctive_keywords(partners).collect()}
    assert words == {"P1": "clear", "P2": "oak"}  # P3 shares its only word
    labels = ["CLEAR d", "clear", "clear", "the oaks", "oak/clear", "none", "", None]
    df = spark.createDataFrame([(x,) for x in labels], "label_raw string")
    got = {
        r.label_raw: (r.partner_id, r.partners, r.outcome)
        for r in build_synonyms(df, distinctive_keywords(partners)).collect()
    }
    assert got == {
        "CLEAR d": ("P1", 1, "mapped"),
        "clear": ("P1", 1, "mapped"),
        "the oaks": ("P2", 1, "mapped"),
        "oak/clear": (None, 2, "ambiguous"),
        "none": (None, 0, "unmapped"),
        "": (None, 0, "unmapped"),
    }
