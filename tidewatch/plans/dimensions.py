"""Dimensions: registries flattened along many-to-one links, grain kept.

The right sides are plain scans with a unique key. Spark broadcasts those whose size it
knows to be under its threshold; for the others AQE splits skewed partitions, which it can
do here because both join inputs come straight from their shuffles. No size is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import month_start, week_start
from tidewatch.settings import Settings


def with_partner(df: DataFrame, partners: DataFrame) -> DataFrame:
    """Adds name and type of the partner that ``partner_id`` names."""
    return df.join(
        partners.select("partner_id", "partner_name", "partner_type"), "partner_id", "left"
    )


def investors_with_partner_id(investors: DataFrame, entities: DataFrame) -> DataFrame:
    """Investors with the partner of their entity; all that requester matching needs."""
    return investors.join(entities.select("entity_id", "partner_id"), "entity_id", "left")


def investors_enriched(
    investors: DataFrame, entities: DataFrame, partners: DataFrame, managers: DataFrame
) -> DataFrame:
    rm = managers.select(F.col("rm_id").alias("relationship_manager_id"), "rm_name", "rm_email")
    flat = with_partner(investors.join(entities, "entity_id", "left"), partners)
    return flat.join(rm, "relationship_manager_id", "left").select(
        *("investor_id", "user_id", "email", "full_name", "country", "created_at"),
        *("entity_id", "entity_name", "entity_type", "kyc_status"),
        *("partner_id", "partner_name", "partner_type"),
        *("relationship_manager_id", "rm_name", "rm_email"),
        F.col("relationship_manager_id").isNotNull().alias("is_rm_managed"),
    )


def managers_enriched(managers: DataFrame, partners: DataFrame) -> DataFrame:
    return with_partner(managers, partners).select(
        "rm_id", "rm_name", "rm_email", "partner_id", "partner_name", "partner_type"
    )


def dim_entity(entities: DataFrame, partners: DataFrame) -> DataFrame:
    return with_partner(entities, partners).select(
        *("entity_id", "entity_name", "entity_type", "kyc_status"),
        *("partner_id", "partner_name", "partner_type"),
    )


def close_calendar(closes: DataFrame, settings: Settings) -> DataFrame:
    """Closes with week, month, and whether they are upcoming, or upcoming but overdue."""
    return closes.withColumns(
        {
            "close_week": week_start("scheduled_close_date"),
            "close_month": month_start("scheduled_close_date"),
            "is_upcoming": F.expr("close_status = 'upcoming'"),
            "is_stale_upcoming": F.expr(
                f"close_status = 'upcoming' and scheduled_close_date < {settings.today_sql}"
            ),
        }
    )


def dim_close(closes: DataFrame, partners: DataFrame, settings: Settings) -> DataFrame:
    return with_partner(close_calendar(closes, settings), partners).select(
        *("close_id", "fund_id", "fund_name", "close_number", "scheduled_close_date"),
        *("close_status", "total_committed_aum_gbp"),
        *("partner_id", "partner_name", "partner_type"),
        *("close_week", "close_month", "is_upcoming", "is_stale_upcoming"),
    )
