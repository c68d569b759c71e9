"""Releases: all tables or none, whatever fails on the way."""

import threading
from dataclasses import replace

import pytest
from helpers import at, model, records
from pyspark.sql import functions as F

from tidewatch.plans import warehouse as plans
from tidewatch.plans.warehouse import AuditFailed
from tidewatch.sources import Releases

EXTRACTS = {
    "investors": [{"investor_id": "I1", "email": "a@x.com", "entity_id": "E1", "created_at": at("2024-01-01")}],
    "entities": [{"entity_id": "E1", "entity_name": "One", "entity_type": "family_office", "partner_id": "P1"}],
    "partners": [{"partner_id": "P1", "partner_name": "Partner", "partner_type": "wealth"}],
    "tickets": [
        {"ticket_id": 1, "requester_email": "a@x.com", "status": "open", "priority": "high",
         "created_at": at("2024-05-01T10:00"), "tags": "a,b"},
    ],
}
RULES = {n: replace(plans.RULES[n], references=()) for n in ("stg_tickets", "fct_tickets", "dim_investor")}


@pytest.fixture(autouse=True)
def few_tasks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture(autouse=True)
def few_tables(monkeypatch):
    """Four tables are enough to see all or none, and take a quarter of the time."""
    kept = ("dim_investor", "dim_fund_close", "fct_tickets", "fct_ticket_tags")
    monkeypatch.setattr(plans, "MARTS", {n: plans.MARTS[n] for n in kept})
    monkeypatch.setattr(plans, "STAGED", {"stg_tickets": "tickets"})
    monkeypatch.setattr(plans, "RULES", RULES)
    overlaps = plans.checks.report
    monkeypatch.setattr(
        plans.checks, "report", lambda t, r, o: overlaps({**t, "dim_relationship_manager": few(t)}, r, o)
    )


def few(tables):
    return tables["dim_investor"].limit(0).select(F.col("email").alias("rm_email"))


def with_ticket(**changes):
    return {**EXTRACTS, "tickets": [*EXTRACTS["tickets"], {**EXTRACTS["tickets"][0], **changes}]}


def content(releases):
    return {
        name: sorted(map(str, records(df)))
        for name, df in releases.tables().items()
        if name != plans.REPORT
    }


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}/marts"


def test_a_release_has_all_tables_and_its_report(spark, root):
    releases = Releases(spark, root)
    assert releases.present() is None
    with pytest.raises(LookupError):
        releases.tables()
    built = model(spark, **EXTRACTS).release(root)
    tables = releases.tables()
    assert set(tables) == {*plans.MARTS, plans.REPORT}
    assert tables["fct_tickets"].count() == built.ticket_fact.count() == 1
    assert tables[plans.REPORT].filter("severity = 'error' and not passed").count() == 0
    releases.register_views()
    assert spark.sql("select ticket_id from fct_tickets").first()[0] == 1


def test_a_failed_check_publishes_nothing(spark, root):
    releases = Releases(spark, root)
    model(spark, **EXTRACTS).release(root)
    present, before = releases.present(), content(releases)
    with pytest.raises(AuditFailed, match="unique fct_tickets.ticket_id") as failed:
        model(spark, **with_ticket(subject="same id")).release(root)
    assert releases.present() == present and content(releases) == before
    assert failed.value.release in releases.all()  # stays for inspection
    model(spark, **with_ticket(ticket_id=2)).release(root)
    assert releases.present() > failed.value.release
    assert releases.tables()["fct_tickets"].count() == 2


def test_a_warning_publishes(spark, root):
    releases = Releases(spark, root)
    odd = with_ticket(ticket_id=2, status="brand new")
    model(spark, **odd).release(root)
    warned = releases.tables()[plans.REPORT].filter("severity = 'warn' and not passed")
    assert warned.count() >= 1 and releases.tables()["fct_tickets"].count() == 2
    with pytest.raises(AuditFailed):
        model(spark, **odd).release(root, blocking=("error", "warn"))


@pytest.mark.parametrize("step", ["fct_tickets", plans.REPORT, "draft", "rename"])
def test_a_driver_that_dies_changes_nothing(spark, root, step, monkeypatch):
    releases = Releases(spark, root)
    model(spark, **EXTRACTS).release(root)
    present, before = releases.present(), content(releases)

    class Died(Exception):
        pass

    def dies(*_, **__):
        raise Died

    with monkeypatch.context() as patched:
        if step == "draft":
            patched.setattr(plans.Releases, "publish", dies)
        elif step == "rename":
            def half(self, release):
                self.folder.write(".present-draft", release)
                raise Died

            patched.setattr(plans.Releases, "publish", half)
        else:
            write_table = plans.Releases.write

            def some(self, release, name, *rest, **options):
                if name == step:
                    raise Died
                return write_table(self, release, name, *rest, **options)

            patched.setattr(plans.Releases, "write", some)
        with pytest.raises(Died):
            model(spark, **with_ticket(ticket_id=2)).release(root)
    assert releases.present() == present and content(releases) == before
    model(spark, **with_ticket(ticket_id=2)).release(root)
    assert releases.tables()["fct_tickets"].count() == 2


def test_readers_keep_the_release_they_opened(spark, root):
    releases = Releases(spark, root)
    model(spark, **EXTRACTS).release(root)
    opened = releases.tables()["fct_tickets"]
    model(spark, **with_ticket(ticket_id=2)).release(root)
    assert opened.count() == 1 and releases.tables()["fct_tickets"].count() == 2
    assert releases.sweep(keep=2) == []
    assert len(releases.sweep(keep=1)) == 1 and len(releases.all()) == 1
    assert releases.tables()["fct_tickets"].count() == 2


def test_a_release_derives_staged_extracts_once(spark, root, tmp_path, monkeypatch):
    """Tables start from copies of the staged investors and closes, not from the extracts again."""
    m = model(spark, **EXTRACTS, closes=[{"close_id": "K1", "partner_id": "P1"}])
    for name in ("investors", "closes"):
        m.raw[name].write.parquet(f"{tmp_path}/raw-{name}")
        m.raw[name] = spark.read.parquet(f"{tmp_path}/raw-{name}")
    plans_of, write_table = {}, plans.Releases.write

    def seen(self, release, name, df, *rest, **options):
        plans_of[name] = df._jdf.queryExecution().optimizedPlan().toString() + str(df.inputFiles())
        return write_table(self, release, name, df, *rest, **options)

    monkeypatch.setattr(plans.Releases, "write", seen)
    m.release(root)
    assert set(plans_of) == {*plans.MARTS, plans.REPORT}
    assert [n for n, text in plans_of.items() if "raw-" in text] == []
    assert "once-" in plans_of["dim_investor"] and "once-" in plans_of["dim_fund_close"]


def test_the_fact_and_the_bridge_are_written_at_once(spark, root, monkeypatch):
    both, write_table = threading.Barrier(2, timeout=60), plans.Releases.write

    def meets(self, release, name, *rest, **options):
        if name.startswith("fct_"):
            both.wait()
        return write_table(self, release, name, *rest, **options)

    monkeypatch.setattr(plans.Releases, "write", meets)
    model(spark, **EXTRACTS).release(root)
    assert Releases(spark, root).tables()["fct_ticket_tags"].count() == 2
