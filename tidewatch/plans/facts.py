"""The ticket fact and the ticket-tag bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import hours_between, month_start, split_rows, week_start
from tidewatch.settings import Settings

FACT_COLUMNS = (
    *("ticket_id", "investor_id", "rm_id", "partner_id"),
    *("requester_type", "requester_email", "requester_name", "partner_attribution_method"),
    *("requester_matched_both", "investor_email_is_ambiguous", "rm_email_is_ambiguous"),
    *("subject", "status", "priority", "partner_label", "created_at", "resolved_at"),
    *("created_date", "created_week", "created_month"),
    *("is_resolved", "is_open", "resolution_hours"),
)

#: what the fact and the bridge take from a resolved ticket
RESOLVED_COLUMNS = (
    *("ticket_id", "investor_id", "rm_id", "partner_id"),
    *("requester_type", "requester_email", "requester_name", "partner_attribution_method"),
    *("requester_matched_both", "investor_match_count", "rm_match_count"),
    *("subject", "status", "priority", "partner_label", "created_at", "resolved_at", "tags_raw"),
)


def ticket_measures(tickets: DataFrame, settings: Settings) -> DataFrame:
    """Calendar columns, flags and duration of a ticket. They need no resolution, so a mart
    that uses nothing else is planned on staged tickets, without the joins."""
    return tickets.withColumns(
        {
            "created_date": F.expr("date(created_at)"),
            "created_week": week_start("created_at"),
            "created_month": month_start("created_at"),
            "is_resolved": F.expr("resolved_at is not null"),
            "is_open": F.expr(settings.open_sql),
            "resolution_hours": hours_between("created_at", "resolved_at"),
        }
    )


def ticket_fact(resolved: DataFrame, settings: Settings) -> DataFrame:
    """One row per ticket, from resolved and attributed tickets."""
    ambiguous = {
        "investor_email_is_ambiguous": F.expr("coalesce(investor_match_count, 0) > 1"),
        "rm_email_is_ambiguous": F.expr("coalesce(rm_match_count, 0) > 1"),
    }
    return ticket_measures(resolved, settings).withColumns(ambiguous).selectExpr(*FACT_COLUMNS)


def ticket_tags(resolved: DataFrame) -> DataFrame:
    """One row per ticket and tag as written; a repeated tag stays repeated."""
    return split_rows(resolved, "tags_raw", ",", "tag").select(
        *("ticket_id", "investor_id", "rm_id", "partner_id", "requester_type", "created_at"),
        "tag",
    )
