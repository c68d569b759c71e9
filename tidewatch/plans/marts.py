"""Analysis marts. Stored order is no contract; reports sort when they read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import month_start, pct, round_half_up, week_start
from tidewatch.operators.lookup import hot_keys, spread_lookup
from tidewatch.operators.median import exact_median
from tidewatch.operators.nearby import counts_around
from tidewatch.operators.spine import align, row_points
from tidewatch.plans.dimensions import with_partner
from tidewatch.settings import Settings


def _zero(name: str) -> str:
    return f"coalesce({name}, 0) as {name}"


def investor_summary(investors: DataFrame, tickets: DataFrame) -> DataFrame:
    """Ticket behaviour of every investor, also of those without a ticket.

    Only tickets whose requester is the investor count. Totals are one aggregate that is combined
    before its shuffle; the exact median takes the durations of resolved tickets alone.
    """
    own = tickets.filter("requester_type = 'investor' and investor_id is not null")
    totals = own.groupBy("investor_id").agg(
        F.expr("count(*) as ticket_count"),
        F.expr("count_if(is_resolved) as resolved_count"),
        F.expr("count_if(is_open) as open_count"),
        F.expr("count_if(priority = 'urgent') as urgent_count"),
        F.expr("count_if(priority = 'high') as high_count"),
        F.expr("avg(resolution_hours) as avg_resolution_hours"),
        F.expr("min(created_at) as first_ticket_at"),
        F.expr("max(created_at) as last_ticket_at"),
    )
    durations = own.filter("resolution_hours is not null").groupBy("investor_id", "resolution_hours")
    medians = exact_median(
        durations.agg(F.count("*").alias("tickets")),
        "investor_id",
        "resolution_hours",
        "tickets",
        "median_resolution_hours",
    )
    counts = ("ticket_count", "resolved_count", "open_count", "urgent_count", "high_count")
    return (
        investors.join(totals, "investor_id", "left")
        .join(medians, "investor_id", "left")
        .selectExpr(
            *("investor_id", "full_name", "email", "country"),
            *("entity_id", "entity_name", "entity_type", "kyc_status"),
            *("partner_id", "partner_name", "partner_type", "is_rm_managed"),
            *(_zero(c) for c in counts),
            *("avg_resolution_hours", "median_resolution_hours"),
            *("first_ticket_at", "last_ticket_at"),
        )
    )


def _close_points(closes: DataFrame, amount: str, *keys: str) -> DataFrame:
    return closes.selectExpr(
        *keys,
        "close_week as week_start",
        "1 as closes_scheduled",
        "int(close_status = 'completed') as closes_completed",
        "int(close_status = 'upcoming') as closes_upcoming",
        f"total_committed_aum_gbp as {amount}",
    )


def team_pressure_weekly(tickets: DataFrame, closes: DataFrame, settings: Settings) -> DataFrame:
    """Tickets created and resolved, and closes, per week. A ticket is read once and gives
    a point in its creation week and, if resolved, one in its resolution week."""
    created = f"true, created_week, 1, int({settings.urgent_sql}), 0"
    resolved = "resolved_at is not null, trunc(date(resolved_at), 'week'), 0, 0, 1"
    load = row_points(
        tickets,
        ["week_start", "tickets_created", "tickets_high_urgent", "tickets_resolved"],
        [created, resolved],
    )
    return with_closes(load, closes, ("tickets_created", "tickets_high_urgent", "tickets_resolved"))


def with_closes(load: DataFrame, closes: DataFrame, counted: Sequence[str]) -> DataFrame:
    """Weekly ticket counts, of tickets or of any sums of them, with the closes of each week."""
    return align(
        [load, _close_points(closes, "committed_aum_closing_gbp")],
        ["week_start"],
        [
            *counted,
            *("closes_scheduled", "closes_completed", "closes_upcoming"),
            "committed_aum_closing_gbp",
        ],
    )


def partner_pressure_weekly(
    tickets: DataFrame, closes: DataFrame, partners: DataFrame, settings: Settings
) -> DataFrame:
    """The weekly series per partner; tickets without a partner are left out."""
    load = tickets.filter("partner_id is not null").selectExpr(
        "partner_id",
        "created_week as week_start",
        "1 as tickets_created",
        f"int({settings.urgent_sql}) as tickets_high_urgent",
        "int(requester_type = 'investor') as investor_tickets",
        "int(requester_type = 'relationship_manager') as rm_tickets",
    )
    counted = ("tickets_created", "tickets_high_urgent", "investor_tickets", "rm_tickets")
    return partners_with_closes(load, closes, partners, counted)


def partners_with_closes(
    load: DataFrame, closes: DataFrame, partners: DataFrame, counted: Sequence[str]
) -> DataFrame:
    """Weekly ticket counts per partner with its closes and its name."""
    measures = [
        *counted,
        *("closes_scheduled", "closes_completed", "closes_upcoming", "committed_aum_gbp"),
    ]
    calendar = _close_points(closes, "committed_aum_gbp", "partner_id")
    weekly = align([load, calendar], ["partner_id", "week_start"], measures)
    return with_partner(weekly, partners).select(
        "partner_id", "partner_name", "partner_type", "week_start", *measures
    )


def _counts_near_closes(closes: DataFrame, tickets: DataFrame, settings: Settings) -> DataFrame:
    return counts_around(
        closes,
        tickets,
        key="partner_id",
        centre_date="scheduled_close_date",
        event_date="created_date",
        days=settings.window_days,
        flags={"high_urgent": settings.urgent_sql},
    )


def close_pressure(
    closes: DataFrame, tickets: DataFrame, settings: Settings, calendar: DataFrame | None = None
) -> DataFrame:
    """Tickets of the close's partner within the window around each close.

    Windows overlap: a ticket counts for every close it is near. The counts depend on
    partner and date only and are looked up by them. ``calendar`` are the same closes
    without partner names, if that saves their join.
    """
    calendar = closes if calendar is None else calendar
    counts = _counts_near_closes(calendar, tickets, settings).selectExpr(
        *("partner_id", "scheduled_close_date"),
        "in_window as tickets_in_window",
        "before as tickets_before_close",
        "on_or_after as tickets_on_or_after_close",
        "high_urgent as tickets_high_urgent",
    )
    described = closes.selectExpr(
        *("close_id", "fund_id", "fund_name", "close_number", "partner_id", "partner_name"),
        *("scheduled_close_date", "close_status", "total_committed_aum_gbp"),
    )
    on = ["partner_id", "scheduled_close_date"]
    hot = hot_keys(calendar, key=[F.col(c) for c in on])
    return spread_lookup(described, counts, on, spread_by="close_id", hot=hot).selectExpr(
        *described.columns,
        _zero("tickets_in_window"),
        _zero("tickets_before_close"),
        _zero("tickets_on_or_after_close"),
        _zero("tickets_high_urgent"),
    )


def close_history(closes: DataFrame, tickets: DataFrame, settings: Settings) -> DataFrame:
    """Load of a partner's completed closes: number, mean, least and most tickets.

    All closes of a partner on one date have the same count, so the mean is weighted by
    their number and no row per close is needed.
    """
    completed = closes.filter(F.col("close_status") == "completed")
    near = _counts_near_closes(completed, tickets, settings)
    return near.groupBy("partner_id").agg(
        F.expr("sum(centres) as completed_close_count"),
        F.expr("sum(centres * in_window) / sum(centres) as avg_tickets"),
        F.expr("min(in_window) as min_tickets_observed"),
        F.expr("max(in_window) as max_tickets_observed"),
        F.expr("sum(centres * high_urgent) / sum(centres) as avg_high_urgent"),
    )


def _live_upcoming(closes: DataFrame) -> DataFrame:
    """Upcoming closes that are not overdue."""
    return closes.filter("is_upcoming and not is_stale_upcoming")


def staffing_forecast(
    closes: DataFrame, tickets: DataFrame, settings: Settings, calendar: DataFrame | None = None
) -> DataFrame:
    """Expected load of each live upcoming close, from its partner's completed closes.

    Without history the estimates and the low-sample warning are null.
    """
    calendar = closes if calendar is None else calendar
    history = close_history(calendar, tickets, settings)
    day = F.col("scheduled_close_date")
    tickets_mean, urgent_mean = F.col("avg_tickets"), F.col("avg_high_urgent")
    # one row per partner, and both sides come straight from a shuffle: AQE splits a hot partner
    return _live_upcoming(closes).join(history, "partner_id", "left").select(
        *("close_id", "fund_id", "fund_name", "close_number"),
        *("partner_id", "partner_name", "partner_type"),
        *("scheduled_close_date", "total_committed_aum_gbp"),
        F.date_sub(day, settings.window_days).alias("pressure_window_start"),
        F.date_add(day, settings.window_days).alias("pressure_window_end"),
        F.col("completed_close_count").alias("historical_close_count"),
        round_half_up(tickets_mean, 1).alias("avg_tickets_per_close"),
        *("min_tickets_observed", "max_tickets_observed"),
        round_half_up(urgent_mean, 1).alias("avg_high_urgent_per_close"),
        round_half_up(tickets_mean).alias("expected_tickets"),
        round_half_up(urgent_mean).alias("expected_high_urgent_tickets"),
        F.col("completed_close_count").isNull().alias("no_historical_data"),
        (F.col("completed_close_count") < settings.min_sample).alias("low_sample_warning"),
    )


def load_estimate(closes: DataFrame, tickets: DataFrame, settings: Settings) -> DataFrame:
    """Per partner: mean tickets per completed close times the number of live upcoming closes."""
    upcoming = (
        _live_upcoming(closes).groupBy("partner_id").agg(F.count("*").alias("upcoming_closes"))
    )
    history = close_history(closes, tickets, settings)
    return upcoming.join(history, "partner_id", "left").select(
        "partner_id",
        "upcoming_closes",
        "completed_close_count",
        round_half_up(F.col("avg_tickets"), 1).alias("avg_tickets_per_close"),
        round_half_up(F.col("avg_tickets") * F.col("upcoming_closes"), 1).alias("expected_load"),
    )


def theme_summary(tags: DataFrame, themes: DataFrame) -> DataFrame:
    """Distinct tickets per theme, partner, week, month and requester type.

    A ticket counts once per theme it touches. The rows are made distinct on the group and
    the ticket, so the second step is a plain count that is combined before its shuffle.
    """
    group = [
        *("theme", "theme_label", "theme_sort_order"),
        *("partner_id", "week_start", "month_start", "requester_type"),
    ]
    touched = (
        tags.join(themes, "tag")
        .withColumns({"week_start": week_start("created_at"), "month_start": month_start("created_at")})
        .select(*group, "ticket_id")
        .distinct()
    )
    return touched.groupBy(*group).agg(F.count("ticket_id").alias("ticket_count"))


HEALTH_ROWS = {
    "investor_tickets": "requester_type = 'investor'",
    "rm_tickets": "requester_type = 'relationship_manager'",
    "internal_tickets": "requester_type = 'internal'",
    "unknown_tickets": "requester_type = 'unknown'",
    "attr_investor_email": "partner_attribution_method = 'investor_email_match'",
    "attr_rm_email": "partner_attribution_method = 'rm_email_match'",
    "attr_label_fallback": "partner_attribution_method = 'partner_label_fallback'",
    "attr_unresolved": "partner_attribution_method = 'unresolved'",
    "ambiguous_investor_email_count": "investor_email_is_ambiguous",
    "ambiguous_rm_email_count": "rm_email_is_ambiguous",
}


def attribution_health(tickets: DataFrame, closes: DataFrame) -> DataFrame:
    """Weekly counts and rates of how tickets were attributed, with the present number of
    overdue upcoming closes on every row."""
    weekly = tickets.groupBy(F.col("created_week").alias("week_start")).agg(
        F.expr("count(*) as total_tickets"),
        *(F.expr(f"count_if({condition}) as {name}") for name, condition in HEALTH_ROWS.items()),
    )
    return health_rates(weekly, closes)


def health_rates(weekly: DataFrame, closes: DataFrame) -> DataFrame:
    """Adds the rates and the number of overdue closes to the weekly counts."""
    stale = closes.filter("is_stale_upcoming").agg(F.count("*")).scalar()
    return weekly.withColumns(
        {
            "unresolved_rate_pct": pct("attr_unresolved", "total_tickets"),
            "fallback_rate_pct": pct("attr_label_fallback", "total_tickets"),
            "unknown_requester_rate_pct": pct("unknown_tickets", "total_tickets"),
            "internal_requester_rate_pct": pct("internal_tickets", "total_tickets"),
            "stale_upcoming_close_count": stale,
        }
    )
