"""Cleaning of the raw extracts: rename, cast, normalise. Narrow, no row is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _clean(column: str, out: str | None = None) -> str:
    return f"trim({column}) as {out or column}"


def _key(column: str, out: str | None = None) -> str:
    """Text that rows are matched or counted by."""
    return f"lower(trim({column})) as {out or column}"


def _as(kind: str, column: str, out: str | None = None) -> str:
    return f"cast({column} as {kind}) as {out or column}"


def stage_tickets(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "ticket_id",
        _key("requester_email"),
        _clean("requester_name"),
        _clean("subject"),
        _key("status"),
        _key("priority"),
        _as("timestamp_ntz", "created_at"),
        _as("timestamp_ntz", "resolved_at"),
        "tags as tags_raw",
        "nullif(trim(partner_label), '') as partner_label",
    )


def stage_entities(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "entity_id", _clean("entity_name"), "partner_id", _key("entity_type"), _key("kyc_status")
    )


def stage_closes(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "close_id",
        "fund_id",
        _clean("fund_name"),
        "partner_id",
        _as("int", "close_number"),
        _as("date", "scheduled_close_date"),
        _key("close_status"),
        _as("bigint", "total_committed_aum", "total_committed_aum_gbp"),
    )


def stage_investors(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "investor_id",
        "user_id",
        _key("email"),
        _clean("full_name"),
        "entity_id",
        _clean("country"),
        _as("timestamp_ntz", "created_at"),
        "relationship_manager_id",
    )


def stage_partners(raw: DataFrame) -> DataFrame:
    return raw.selectExpr("partner_id", _clean("partner_name"), _key("partner_type"))


def stage_managers(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "rm_id", "partner_id", _clean("name", "rm_name"), _key("email", "rm_email")
    )
