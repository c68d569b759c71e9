"""Marts that follow each merge of the fact instead of being built again.

What a ticket adds to a mart is a point: its group and its counters. Weekly load, load per partner, themes
and attribution are sums of points, kept as states (``operators.deltas``); the marts are read from these.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import month_start, week_start
from tidewatch.operators import deltas
from tidewatch.operators.incremental import in_partitions, merge_into_table, replace_partitions
from tidewatch.plans import marts
from tidewatch.plans.facts import FACT_COLUMNS
from tidewatch.plans.warehouse import FACT, Warehouse
from tidewatch.settings import Settings
from tidewatch.sources.releases import Folder
from tidewatch.sources.tables import Copies, write_table

BRIDGE = "fct_ticket_tags"
MONTH = "state_month"


@dataclass(frozen=True)
class Kept:
    """A kept mart: its groups and counters, and the points of fact or bridge rows."""

    keys: tuple[str, ...]
    counters: tuple[str, ...]
    source: str
    points: Callable[[DataFrame, Settings, DataFrame], DataFrame]

    def rows(self, images: DataFrame, settings: Settings, themes: DataFrame) -> DataFrame:
        """The points of images, signed if these are, with the month their partition is named by."""
        signed = images if deltas.SIGN in images.columns else images.withColumn(deltas.SIGN, F.lit(1))
        points = self.points(signed, settings, themes)
        return points.withColumn(MONTH, month_start("week_start"))


def _team(images: DataFrame, settings: Settings, _: DataFrame) -> DataFrame:
    created = f"true, created_week, 1, int({settings.urgent_sql}), 0, {deltas.SIGN}"
    resolved = f"resolved_at is not null, trunc(date(resolved_at), 'week'), 0, 0, 1, {deltas.SIGN}"
    names = f"_on, week_start, tickets_created, tickets_high_urgent, tickets_resolved, {deltas.SIGN}"
    return images.selectExpr(f"stack(2, {created}, {resolved}) as ({names})").filter("_on").drop("_on")


def _partner(images: DataFrame, settings: Settings, _: DataFrame) -> DataFrame:
    return images.filter("partner_id is not null").selectExpr(
        *("partner_id", "created_week as week_start", "1 as tickets_created"),
        f"int({settings.urgent_sql}) as tickets_high_urgent",
        "int(requester_type = 'investor') as investor_tickets",
        "int(requester_type = 'relationship_manager') as rm_tickets",
        deltas.SIGN,
    )


def _health(images: DataFrame, settings: Settings, _: DataFrame) -> DataFrame:
    rows = [f"int({condition}) as {name}" for name, condition in marts.HEALTH_ROWS.items()]
    return images.selectExpr("created_week as week_start", "1 as total_tickets", *rows, deltas.SIGN)


THEME_KEYS = ("theme", "theme_label", "theme_sort_order", "partner_id", "week_start", "month_start")


def _theme(images: DataFrame, settings: Settings, themes: DataFrame) -> DataFrame:
    """A ticket counts once per theme, before and after."""
    return (
        images.join(themes, "tag")
        .withColumns({"week_start": week_start("created_at"), "month_start": month_start("created_at")})
        .select(*THEME_KEYS, "requester_type", "ticket_id", deltas.SIGN)
        .distinct()
        .withColumn("ticket_count", F.lit(1))
        .drop("ticket_id")
    )


TEAM = ("tickets_created", "tickets_high_urgent", "tickets_resolved")
PARTNER = ("tickets_created", "tickets_high_urgent", "investor_tickets", "rm_tickets")
KEPT = {
    "team_weeks": Kept(("week_start",), TEAM, FACT, _team),
    "partner_weeks": Kept(("partner_id", "week_start"), PARTNER, FACT, _partner),
    "health_weeks": Kept(("week_start",), ("total_tickets", *marts.HEALTH_ROWS), FACT, _health),
    "theme_weeks": Kept((*THEME_KEYS, "requester_type"), ("ticket_count",), BRIDGE, _theme),
}


def marts_of(states: dict[str, DataFrame], model: Warehouse) -> dict[str, DataFrame]:
    """The marts as the model has them, from the states and the calendar of closes."""
    held = {name: deltas.present(state).drop(MONTH) for name, state in states.items()}
    return {
        "mart_is_pressure_weekly": marts.with_closes(held["team_weeks"], model._calendar, TEAM),
        "mart_partner_pressure_weekly": marts.partners_with_closes(
            held["partner_weeks"], model._calendar, model.dim_partner, PARTNER
        ),
        "mart_theme_ticket_summary": held["theme_weeks"],
        "mart_attribution_health": marts.health_rates(held["health_weeks"], model._calendar),
    }


def states_after(
    model: Warehouse, loaded: dict[str, DataFrame], batch: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """The states of ``loaded`` (fact and bridge by name) and the changes of one merge, added up."""
    found = {}
    themes = model.raw["tag_themes"]
    for name, kept in KEPT.items():
        old, new = loaded[kept.source], batch[kept.source]
        keys = [*kept.keys, MONTH]
        state = deltas.grouped_sums(kept.rows(old, model.settings, themes), keys, kept.counters)
        log = _log(old, new, batch[FACT])
        change = deltas.grouped_sums(kept.rows(log, model.settings, themes), keys, kept.counters)
        found[name] = deltas.added(state, change, keys, kept.counters)
    return found


def _log(target: DataFrame, batch: DataFrame, fact: DataFrame) -> DataFrame:
    """A ticket without tags in the batch takes its old tags away all the same."""
    if batch.columns == fact.columns:
        return deltas.change_log(target, batch, "ticket_id")
    before = target.join(fact.select("ticket_id"), "ticket_id", "left_semi").withColumn(deltas.SIGN, F.lit(-1))
    return before.unionByName(batch.withColumn(deltas.SIGN, F.lit(1)))


class KeptMarts:
    """Stored fact, bridge and states in ``schema``, and the log of merges in ``folder``.

    A merge is written to the log before anything is changed: the images of fact and bridge rows, under
    the next number. Then fact, bridge and states take it over, each in a way that may be repeated.
    A driver that dies leaves the log; ``recover`` (run first by every merge) does the rest.
    """

    def __init__(self, spark: SparkSession, schema: str, folder: str):
        self.spark, self.schema = spark, schema
        self.log = Folder(spark, folder)

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}"

    def create(self, model: Warehouse) -> None:
        """Builds everything from the model; merges that are logged are in it."""
        number = max(self._numbers(), default=0)
        with Copies(self.spark) as keep:
            whole = Warehouse(model.raw, model.settings)
            whole.resolved = whole.requesters = keep(model.resolved)
            write_table(whole.ticket_fact, self.table(FACT), "created_month")
            tags = whole.ticket_tags.withColumn("created_month", month_start("created_at"))
            write_table(tags, self.table(BRIDGE), "created_month")
        for name, kept in KEPT.items():
            rows = self.spark.table(self.table(kept.source))
            points = kept.rows(rows, model.settings, model.raw["tag_themes"])
            deltas.create_state(
                points, self.table(name), kept.keys, kept.counters, MONTH, through=number
            )
        self._done(number)

    def merge(self, model: Warehouse) -> int:
        """Merges the tickets of ``model`` (a batch) and returns the number of the merge."""
        self.recover(model)
        number = max(self._numbers(), default=0) + 1
        with Copies(self.spark) as keep:
            batch = Warehouse(model.raw, model.settings)
            batch.resolved = batch.requesters = keep(model.resolved)
            fact = keep(batch.ticket_fact.select(*FACT_COLUMNS))
            stored = self.spark.table(self.table(FACT)).select(*FACT_COLUMNS)
            tags = batch.ticket_tags.withColumn("created_month", month_start("created_at"))
            columns = tags.columns
            for name, images in (
                (FACT, deltas.change_log(stored, fact, "ticket_id")),
                (BRIDGE, _log(self.spark.table(self.table(BRIDGE)).select(*columns), tags, fact)),
            ):
                images.write.mode("overwrite").parquet(self.log.path(f"{number}/{name}"))
        self.log.write(f"{number}/logged", "")
        self._take_over(number, model)
        return number

    def recover(self, model: Warehouse) -> None:
        """Finishes the last merge, if it was logged and the driver died before its end."""
        last = max(self._numbers(), default=0)
        if last and not self.log.exists(f"{last}/done"):
            self._take_over(last, model)

    def marts(self, model: Warehouse) -> dict[str, DataFrame]:
        return marts_of({name: self.spark.table(self.table(name)) for name in KEPT}, model)

    def _numbers(self) -> list[int]:
        return [int(n) for n in self.log.names() if n.isdigit() and self.log.exists(f"{n}/logged")]

    def _done(self, number: int) -> None:
        self.log.write(f"{number}/logged", "")
        self.log.write(f"{number}/done", "")

    def _take_over(self, number: int, model: Warehouse) -> None:
        images = {n: self.spark.read.parquet(self.log.path(f"{number}/{n}")) for n in (FACT, BRIDGE)}
        for name, kept in KEPT.items():
            points = kept.rows(images[kept.source], model.settings, model.raw["tag_themes"])
            deltas.apply_change(points, self.table(name), kept.keys, kept.counters, MONTH, number)
        after = images[FACT].filter(f"{deltas.SIGN} = 1").drop(deltas.SIGN)
        merge_into_table(after, self.table(FACT), "ticket_id", "created_month")
        self._replace_tags(images[BRIDGE], after)
        self.log.write(f"{number}/done", "")

    def _replace_tags(self, images: DataFrame, fact: DataFrame) -> None:
        """The bridge with the old tags of the batch's tickets taken out and the new ones put in."""
        table = self.table(BRIDGE)
        months = [r[0] for r in images.select("created_month").distinct().collect()]  # partition values
        if not months:
            return
        with Copies(self.spark) as keep:
            columns = self.spark.table(table).columns
            hit = self.spark.table(table).filter(in_partitions("created_month", months))
            kept = hit.join(fact.select("ticket_id"), "ticket_id", "left_anti").select(*columns)
            new = images.filter(f"{deltas.SIGN} = 1").select(*columns)
            replace_partitions(keep(kept.unionByName(new)), table, "created_month", months)
