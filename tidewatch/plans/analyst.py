"""The reports analysts run on the marts. Top-k reports break ties by the mart's key, so
that the same rows come back every time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import round_half_up, week_start
from tidewatch.settings import Settings

HOURS_PER_WEEK = 168


def open_backlog(summary: DataFrame, k: int = 10) -> DataFrame:
    """Investors with the most open tickets."""
    return (
        summary.filter("ticket_count > 0")
        .orderBy(F.desc("open_count"), F.desc("ticket_count"), "investor_id")
        .limit(k)
        .select(
            *("investor_id", "full_name", "partner_name"),
            *("ticket_count", "open_count", "urgent_count"),
        )
    )


def slow_investors(summary: DataFrame) -> DataFrame:
    """Investors whose median resolution takes over a week, in days."""
    median = F.col("median_resolution_hours")
    return (
        summary.filter(median > HOURS_PER_WEEK)
        .orderBy(F.desc(median), "investor_id")
        .select(
            *("investor_id", "full_name", "partner_name", "ticket_count"),
            round_half_up(median / 24, 1).alias("median_days"),
        )
    )


def silent_investors(summary: DataFrame) -> DataFrame:
    """Investors without a ticket, per partner."""
    counted = summary.filter("ticket_count = 0").groupBy("partner_name")
    counted = counted.agg(F.count("*").alias("investors_never_raised_ticket"))
    return counted.orderBy(F.desc("investors_never_raised_ticket"), "partner_name")


def theme_totals(themes: DataFrame, since: date) -> DataFrame:
    return (
        themes.filter(F.col("week_start") >= F.lit(since))
        .groupBy("theme_label", "theme_sort_order")
        .agg(F.sum("ticket_count").alias("tickets"))
        .orderBy("theme_sort_order", "theme_label")
        .select("theme_label", "tickets")
    )


def theme_growth(themes: DataFrame, settings: Settings, days: int = 90) -> DataFrame:
    """Tickets per theme in the last ``days`` and in as many days before."""
    week = F.col("week_start")
    cut, start = (F.date_sub(settings.today(), n) for n in (days, 2 * days))
    return (
        themes.groupBy("theme_label", "theme_sort_order")
        .agg(
            F.sum(F.when(week >= cut, F.col("ticket_count"))).alias("recent"),
            F.sum(F.when((week < cut) & (week >= start), F.col("ticket_count"))).alias("prior"),
        )
        .orderBy("theme_sort_order", "theme_label")
        .select("theme_label", "recent", "prior")
    )


def forecast_ahead(forecast: DataFrame, settings: Settings) -> DataFrame:
    """Forecasts whose window has not ended."""
    return (
        forecast.filter(F.col("pressure_window_end") >= settings.today())
        .orderBy("scheduled_close_date", "close_id")
        .select(
            *("close_id", "scheduled_close_date", "fund_name", "partner_name"),
            *("expected_tickets", "min_tickets_observed", "max_tickets_observed"),
            *("no_historical_data", "low_sample_warning"),
        )
    )


def expected_by_partner(forecast: DataFrame, settings: Settings, days: int = 90) -> DataFrame:
    day, today = F.col("scheduled_close_date"), settings.today()
    return (
        forecast.filter(day.between(today, F.date_add(today, days)))
        .groupBy("partner_name")
        .agg(
            F.count("*").alias("closes_upcoming"),
            F.sum("expected_tickets").alias("total_expected_tickets"),
        )
        .orderBy(F.desc("total_expected_tickets"), "partner_name")
    )


def recent_weeks(weekly: DataFrame, settings: Settings, days: int = 180) -> DataFrame:
    return (
        weekly.filter(F.col("week_start") >= F.date_sub(settings.today(), days))
        .orderBy("week_start")
        .select(
            *("week_start", "tickets_created", "tickets_high_urgent"),
            *("closes_scheduled", "committed_aum_closing_gbp"),
        )
    )


def peak_weeks(weekly: DataFrame, k: int = 10) -> DataFrame:
    return (
        weekly.orderBy(F.desc("tickets_high_urgent"), "week_start")
        .limit(k)
        .select("week_start", "tickets_created", "tickets_high_urgent", "closes_scheduled")
    )


def busiest_partners(partner_weekly: DataFrame, settings: Settings, days: int = 28) -> DataFrame:
    return (
        partner_weekly.filter(F.col("week_start") >= F.date_sub(settings.today(), days))
        .groupBy("partner_name")
        .agg(F.sum("tickets_created").alias("tickets"))
        .orderBy(F.desc("tickets"), "partner_name")
    )


def heaviest_closes(pressure: DataFrame, k: int = 20) -> DataFrame:
    """Completed closes with the most tickets around them."""
    return (
        pressure.filter("close_status = 'completed'")
        .orderBy(F.desc("tickets_in_window"), "close_id")
        .limit(k)
        .select(
            *("close_id", "fund_name", "partner_name", "scheduled_close_date"),
            *("tickets_in_window", "tickets_high_urgent"),
        )
    )


def latest_rates(health: DataFrame, k: int = 12) -> DataFrame:
    return (
        health.orderBy(F.desc("week_start"))
        .limit(k)
        .select(
            *("week_start", "unresolved_rate_pct", "fallback_rate_pct"),
            *("unknown_requester_rate_pct", "internal_requester_rate_pct"),
        )
    )


def urgent_open_this_week(tickets: DataFrame, settings: Settings) -> DataFrame:
    this_week = week_start(settings.today())
    return (
        tickets.filter(F.col("is_open") & F.col("priority").isin(*settings.high_priorities))
        .filter(F.col("created_week") == this_week)
        .orderBy("created_at", "ticket_id")
        .select(
            *("ticket_id", "requester_email", "requester_type"),
            *("partner_id", "priority", "created_at"),
        )
    )


def partner_volume(
    tickets: DataFrame, partners: DataFrame, settings: Settings, days: int = 90
) -> DataFrame:
    """Recent tickets per partner name. Tickets are counted per partner before the join, so
    a partner with a third of them is one row in it."""
    since = F.date_sub(settings.today(), days).cast("timestamp_ntz")
    counted = tickets.filter(F.col("created_at") >= since).groupBy("partner_id")
    return (
        counted.agg(F.count("*").alias("n"))
        .join(partners, "partner_id")
        .groupBy("partner_name")
        .agg(F.sum("n").alias("tickets"))
        .orderBy(F.desc("tickets"), "partner_name")
    )
