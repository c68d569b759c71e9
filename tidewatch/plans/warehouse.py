"""All tables of the model, wired up from the raw extracts."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tidewatch.operators import checks, incremental
from tidewatch.operators import lookup as lookups
from tidewatch.operators import staging as stage
from tidewatch.operators.resolve import attribute_partners, hot_ticket_keys, resolve_requesters
from tidewatch.plans import dimensions as dims
from tidewatch.plans import facts, marts, sql_functions
from tidewatch.plans.quality import RULES
from tidewatch.settings import Settings
from tidewatch.sources import Copies, Releases, clustering_of, write_clustered, write_table

MARTS = {
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
    "mart_close_ticket_pressure": "close_pressure",
    "mart_staffing_forecast": "staffing_forecast",
    "mart_theme_ticket_summary": "theme_summary",
    "mart_attribution_health": "attribution_health",
}
STAGED = {
    "stg_partners": "partners",
    "stg_relationship_managers": "managers",
    "stg_entities": "entities",
    "stg_investors": "investors",
    "stg_fund_closes": "closes",
    "stg_tickets": "tickets",
    "int_investors": "investors_enriched",
    "int_relationship_managers": "managers_enriched",
    "int_tickets": "resolved",
}
FACT = "fct_tickets"
RESOLVED = "int_tickets"
STAGED_EXTRACTS = ("partners", "managers", "entities", "investors", "closes", "tickets")
#: staged extracts that tables of each step and the checks start from, besides the tickets
KEPT = ("investors", "closes")
#: tables that are written at a time
AT_ONCE = 3


#: in a release, the report of its checks
REPORT = "data_checks"


class AuditFailed(Exception):
    """A release failed its checks and was not published. ``report`` has a row per check."""

    def __init__(self, release: str, report: DataFrame):
        failed = [r for r in report.collect() if r["severity"] == "error" and not r["passed"]]
        listed = ", ".join(f"{r['check_name']} {r['table_name']}.{r['column_name']}" for r in failed)
        super().__init__(f"{release} is not published: {listed}")
        self.release, self.report = release, report


def together(spark: SparkSession, run: Callable, items: Iterable) -> list:
    """The results of ``run`` for each item; a few jobs at a time share the executors."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(inheritable_thread_target(spark)(run), items))


class Warehouse:
    """Lazy tables over the raw extracts.

    Every table is a DataFrame; nothing runs until one is read or written. ``stored`` gives
    tables that exist already (say, the ticket fact as last refreshed) and are scanned
    instead of being derived again.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        settings: Settings | None = None,
        stored: Mapping[str, DataFrame] | None = None,
    ):
        self.raw = raw
        self.settings = settings or Settings()
        self.stored = dict(stored or {})

    # staged extracts

    @cached_property
    def tickets(self) -> DataFrame:
        return stage.stage_tickets(self.raw["tickets"])

    @cached_property
    def investors(self) -> DataFrame:
        return stage.stage_investors(self.raw["investors"])

    @cached_property
    def managers(self) -> DataFrame:
        return stage.stage_managers(self.raw["rms"])

    @cached_property
    def entities(self) -> DataFrame:
        return stage.stage_entities(self.raw["entities"])

    @cached_property
    def partners(self) -> DataFrame:
        return stage.stage_partners(self.raw["partners"])

    @cached_property
    def closes(self) -> DataFrame:
        return stage.stage_closes(self.raw["closes"])

    # dimensions

    @cached_property
    def investors_enriched(self) -> DataFrame:
        return dims.investors_enriched(self.investors, self.entities, self.partners, self.managers)

    @cached_property
    def managers_enriched(self) -> DataFrame:
        return dims.managers_enriched(self.managers, self.partners)

    @cached_property
    def dim_partner(self) -> DataFrame:
        return self._stored("dim_partner", lambda: self.partners)

    @cached_property
    def dim_manager(self) -> DataFrame:
        return self._stored("dim_relationship_manager", lambda: self.managers_enriched)

    @cached_property
    def dim_entity(self) -> DataFrame:
        return self._stored("dim_entity", lambda: dims.dim_entity(self.entities, self.partners))

    @cached_property
    def dim_investor(self) -> DataFrame:
        return self._stored("dim_investor", lambda: self.investors_enriched)

    @cached_property
    def dim_close(self) -> DataFrame:
        return self._stored(
            "dim_fund_close", lambda: dims.dim_close(self.closes, self.partners, self.settings)
        )

    @cached_property
    def _calendar(self) -> DataFrame:
        """Closes for marts that use no partner name, planned without the partner join."""
        return self._stored(
            "dim_fund_close", lambda: dims.close_calendar(self.closes, self.settings)
        )

    # resolution

    @cached_property
    def investor_by_email(self) -> DataFrame:
        people = dims.investors_with_partner_id(self.investors, self.entities)
        return lookups.investor_by_email(people)

    @cached_property
    def manager_by_email(self) -> DataFrame:
        return lookups.manager_by_email(self.managers)

    @cached_property
    def identities(self) -> DataFrame:
        people = dims.investors_with_partner_id(self.investors, self.entities)
        return lookups.identity_lookup(people, self.managers)

    @cached_property
    def labels(self) -> DataFrame:
        return lookups.label_lookup(self.raw["label_synonyms"])

    @cached_property
    def _hot_keys(self) -> DataFrame:
        return hot_ticket_keys(self.tickets, self.settings)

    @cached_property
    def requesters(self) -> DataFrame:
        return resolve_requesters(self.tickets, self.identities, self.settings, self._hot_keys)

    @cached_property
    def resolved(self) -> DataFrame:
        return attribute_partners(self.requesters, self.labels, self._hot_keys)

    # facts

    @cached_property
    def ticket_fact(self) -> DataFrame:
        return self._stored(FACT, lambda: facts.ticket_fact(self.resolved, self.settings))

    @cached_property
    def ticket_tags(self) -> DataFrame:
        return self._stored("fct_ticket_tags", lambda: facts.ticket_tags(self.resolved))

    def _tickets(self, derived: DataFrame) -> DataFrame:
        """The stored fact, or else no more of its derivation than a mart needs."""
        return self._stored(FACT, lambda: facts.ticket_measures(derived, self.settings))

    # marts

    @cached_property
    def investor_summary(self) -> DataFrame:
        return marts.investor_summary(self.dim_investor, self._tickets(self.requesters))

    @cached_property
    def team_pressure_weekly(self) -> DataFrame:
        return marts.team_pressure_weekly(
            self._tickets(self.tickets), self._calendar, self.settings
        )

    @cached_property
    def partner_pressure_weekly(self) -> DataFrame:
        return marts.partner_pressure_weekly(
            self._tickets(self.resolved), self._calendar, self.dim_partner, self.settings
        )

    @cached_property
    def close_pressure(self) -> DataFrame:
        return marts.close_pressure(
            self.dim_close, self._tickets(self.resolved), self.settings, self._calendar
        )

    @cached_property
    def staffing_forecast(self) -> DataFrame:
        return marts.staffing_forecast(
            self.dim_close, self._tickets(self.resolved), self.settings, self._calendar
        )

    @cached_property
    def load_estimate(self) -> DataFrame:
        return marts.load_estimate(self._calendar, self._tickets(self.resolved), self.settings)

    @cached_property
    def theme_summary(self) -> DataFrame:
        return marts.theme_summary(self.ticket_tags, self.raw["tag_themes"])

    @cached_property
    def attribution_health(self) -> DataFrame:
        return marts.attribution_health(self.ticket_fact, self._calendar)

    # use

    def _stored(self, name: str, derive) -> DataFrame:
        return self.stored[name] if name in self.stored else derive()

    def tables(self) -> dict[str, DataFrame]:
        """Every table by its name."""
        return {name: getattr(self, attr) for name, attr in {**STAGED, **MARTS}.items()}

    def register_views(self) -> None:
        """Makes every table available to ``spark.sql`` under its name."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)

    def register_functions(self) -> None:
        """Makes the model's expressions available to ``spark.sql`` (see ``plans.sql_functions``)."""
        sql_functions.register(self.raw["tickets"].sparkSession)

    def build(self, schema: str, buckets: int | None = None) -> Warehouse:
        """Writes all marts as tables of ``schema``; later tables scan the earlier ones.

        The fact is partitioned by creation month, which the refresh relies on. With ``buckets`` it is
        clustered by ticket as well, so that merges find tickets without moving the fact. Tickets are
        resolved once, for the fact and the bridge.
        """

        def write(name: str, df: DataFrame, by: str | None) -> DataFrame:
            if name == FACT and buckets:
                return write_clustered(df, f"{schema}.{name}", "ticket_id", by, buckets)
            return write_table(df, f"{schema}.{name}", by)

        with Copies(self.raw["tickets"].sparkSession) as keep:
            return Warehouse(self.raw, self.settings, self._staged(keep)._written(keep, write))

    def _staged(self, keep: Copies, stored: Mapping[str, DataFrame] | None = None) -> Warehouse:
        """The model with copies of the staged extracts that several of its tables start from."""
        model = Warehouse(self.raw, self.settings, stored)
        for name in STAGED_EXTRACTS:
            setattr(model, name, getattr(self, name))
        copies = together(keep.spark, keep, [getattr(self, n) for n in KEPT])
        for name, copy in zip(KEPT, copies, strict=True):
            setattr(model, name, copy)
        return model

    def _on(self, stored: Mapping[str, DataFrame]) -> Warehouse:
        """The same staged extracts and resolved tickets, with the tables stored so far."""
        model = Warehouse(self.raw, self.settings, stored)
        for name in (*STAGED_EXTRACTS, "resolved", "requesters"):
            if name in self.__dict__:
                setattr(model, name, getattr(self, name))
        return model

    def _written(self, keep: Copies, write) -> dict[str, DataFrame]:
        """Writes the marts: first the dimensions, beside the copy of the resolved tickets, then the fact
        and the bridge, then what scans them. Tables of a step do not need each other."""
        done: dict[str, DataFrame] = {}

        def written(name: str) -> DataFrame:
            if name == RESOLVED:
                return keep(self.resolved.select(*facts.RESOLVED_COLUMNS))
            partition = "created_month" if name == FACT else None
            return write(name, getattr(self._on(done), MARTS[name]), partition)

        steps = [
            [RESOLVED, *(n for n in MARTS if n.startswith("dim_"))],
            [n for n in MARTS if n.startswith("fct_")],
            [n for n in MARTS if not n.startswith(("dim_", "fct_"))],
        ]
        for names in steps:
            tables = dict(zip(names, together(keep.spark, written, names), strict=True))
            if RESOLVED in tables:
                self.resolved = self.requesters = tables.pop(RESOLVED)
            done |= tables
        return {name: done[name] for name in MARTS}

    def release(self, root: str, blocking: tuple[str, ...] = ("error",)) -> Warehouse:
        """Writes all marts beside the published ones, checks them, and publishes all or none.

        The checks run on the files that would be published. A failed check of a ``blocking`` severity
        raises ``AuditFailed``: what is published stays as it is, and the draft stays for inspection
        until it is swept. Others are reported only. The report is part of the release. A driver that
        dies leaves the published release as it was, up to the switch, which is one rename.
        """
        spark = self.raw["tickets"].sparkSession
        releases = Releases(spark, root)
        draft = releases.begin()
        with Copies(spark) as keep:
            base = self._staged(keep)
            done = base._written(
                keep, lambda name, df, by: releases.write(draft, name, df, partition_by=by)
            )
            report = releases.write(draft, REPORT, base._on(done)._report())
        stops = F.col("severity").isin(*blocking) & ~F.col("passed")
        if report.filter(stops).limit(1).count():
            raise AuditFailed(draft, report)
        releases.publish(draft)
        return Warehouse(self.raw, self.settings, done)

    def refresh_batch(self, spark: SparkSession, table: str) -> DataFrame:
        """Fact rows to be merged into ``table``: the lookback filter is applied to the raw
        tickets, ahead of the resolution, where it reaches the scan."""
        floor = incremental.newest_floor(
            spark, table, "created_at", "created_month", self.settings.lookback_days
        )
        if floor is None:
            return self.ticket_fact
        recent = self.raw["tickets"].filter(f"created_at >= timestamp_ntz '{floor} 00:00:00'")
        return Warehouse(ChainMap({"tickets": recent}, self.raw), self.settings).ticket_fact

    def refresh_fact(self, spark: SparkSession, table: str, full: bool = False) -> None:
        """Brings the stored fact up to date; ``full`` derives all of it again."""
        if full:
            clustered = clustering_of(spark, table, "created_month")
            with Copies(spark) as keep:
                fact = keep(self.ticket_fact)
                if clustered is None:
                    write_table(fact, table, "created_month")
                else:
                    clustered.write(fact)
            return
        batch = self.refresh_batch(spark, table)
        incremental.merge_into_table(batch, table, "ticket_id", "created_month")

    def check(self, resolved: DataFrame | None = None) -> DataFrame:
        """One row per data check. ``resolved`` are the resolved tickets, if they are stored already.

        The checks run at once. What most checked tables start from is written for the time
        they take; the rows that come back are as many as there are checks.
        """
        spark = self.raw["tickets"].sparkSession
        with Copies(spark) as keep:
            base = self._staged(keep, self.stored)
            derived = [n for n in ("dim_investor", "dim_fund_close") if n not in base.stored]
            copied = [getattr(base, MARTS[n]) for n in derived]
            copied += [base.resolved] if resolved is None else []
            copies = together(spark, keep, copied)
            base.resolved = base.requesters = copies.pop() if resolved is None else resolved
            return base._on({**base.stored, **dict(zip(derived, copies, strict=True))})._report()

    def _report(self) -> DataFrame:
        """The report of the checks, run on what the model is made of by now."""
        shared_email = checks.Overlap(
            "no_shared_email", "dim_investor", "email", "dim_relationship_manager", "rm_email"
        )
        report = checks.report(self.tables(), RULES, [shared_email])
        return report.sparkSession.createDataFrame(report.collect(), report.schema)
