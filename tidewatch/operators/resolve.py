"""Who raised a ticket, and for which partner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import norm_key
from tidewatch.operators.lookup import hot_keys, spread_lookup
from tidewatch.settings import Settings


def classify(rules: Sequence[tuple[str, Column]], otherwise: str) -> Column:
    """Label of the first rule that holds."""
    label = F
    for name, condition in rules:
        label = label.when(condition, F.lit(name))
    return label.otherwise(F.lit(otherwise))


def email_key(settings: Settings) -> Column:
    email = F.col("requester_email")
    return email if settings.blank_emails_match else F.nullif(email, F.lit(""))


def hot_ticket_keys(tickets: DataFrame, settings: Settings) -> DataFrame:
    """The e-mails and labels that very many tickets have, counted in one pass."""
    return hot_keys(tickets, email=[email_key(settings)], label=[norm_key("partner_label")])


def resolve_requesters(
    tickets: DataFrame, identities: DataFrame, settings: Settings, hot: DataFrame | None = None
) -> DataFrame:
    """Adds registry matches and the requester type; the ticket grain is kept.

    ``identities`` has one row per e-mail (``identity_lookup``), ``hot`` the hot keys of the
    tickets (``hot_ticket_keys``) if they are at hand.
    """
    email = F.col("requester_email")
    matched = spread_lookup(
        tickets.withColumn("email", email_key(settings)),
        identities,
        ["email"],
        spread_by="ticket_id",
        hot=hot,
        kind="email",
    ).drop("email")
    return matched.withColumns(
        {
            "matched_investor": F.expr("investor_id is not null"),
            "matched_rm": F.expr("rm_id is not null"),
            "requester_matched_both": F.expr("investor_id is not null and rm_id is not null"),
            **{name: email.like(p) for name, p in settings.internal_domains.items()},
            "requester_type": classify(
                [
                    ("investor", F.expr("investor_id is not null")),
                    ("relationship_manager", F.expr("rm_id is not null")),
                    ("internal", email.like(settings.internal_pattern)),
                ],
                otherwise="unknown",
            ),
        }
    )


def attribute(df: DataFrame, rungs: Sequence[tuple[Column, str]], out: str) -> DataFrame:
    """First non-null value along a chain of (gate, column) rungs of decreasing trust."""
    return df.withColumn(out, F.coalesce(*(F.when(gate, F.col(c)) for gate, c in rungs)))


def attribute_partners(
    requesters: DataFrame, labels: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Adds the partner and how it was found. ``hot`` are the hot keys of the tickets, if at hand;
    else frequent labels are counted on ``requesters``.

    The method follows the requester type, not the value: an investor without a partner
    takes the label's partner and still counts as an e-mail match. Internal and unknown
    requesters have the label only.
    """
    kind, label = F.col("requester_type"), norm_key("partner_label")
    labelled = spread_lookup(
        requesters.withColumn("label_norm", label),
        labels,
        ["label_norm"],
        spread_by="ticket_id",
        hot=hot,
        kind="label",
    ).drop("label_norm")
    chained = attribute(
        labelled,
        [
            (kind == "investor", "investor_partner_id"),
            (kind == "relationship_manager", "rm_partner_id"),
            (F.lit(True), "label_partner_id"),
        ],
        out="partner_id",
    )
    return chained.withColumn(
        "partner_attribution_method",
        classify(
            [
                ("investor_email_match", kind == "investor"),
                ("rm_email_match", kind == "relationship_manager"),
                ("partner_label_fallback", F.col("label_partner_id").isNotNull()),
            ],
            otherwise="unresolved",
        ),
    )
