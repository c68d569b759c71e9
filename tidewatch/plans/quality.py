"""What is checked on each table."""

from tidewatch.operators.checks import Reference, TableRules

# The domains the checks accept.
PARTNER_TYPES = ("wealth_manager", "fund_manager", "family_office")
ENTITY_TYPES = ("individual", "corporate", "trust", "pension_fund")
KYC_STATUSES = ("approved", "pending", "expired", "rejected")
CLOSE_STATUSES = ("upcoming", "completed", "cancelled")
TICKET_STATUSES = ("open", "pending", "resolved", "closed")
PRIORITIES = ("low", "medium", "high", "urgent")
REQUESTER_TYPES = ("investor", "relationship_manager", "internal", "unknown")
METHODS = ("investor_email_match", "rm_email_match", "partner_label_fallback", "unresolved")

_TO_STAGED_PARTNER = Reference("partner_id", "stg_partners", "partner_id")

STAGING_RULES = {
    "stg_partners": TableRules("partner_id", accepted={"partner_type": PARTNER_TYPES}),
    "stg_relationship_managers": TableRules("rm_id", references=(_TO_STAGED_PARTNER,)),
    "stg_entities": TableRules(
        "entity_id",
        accepted={"entity_type": ENTITY_TYPES, "kyc_status": KYC_STATUSES},
        references=(_TO_STAGED_PARTNER,),
    ),
    "stg_investors": TableRules(
        "investor_id",
        not_null=("email",),
        references=(Reference("entity_id", "stg_entities", "entity_id"),),
    ),
    "stg_fund_closes": TableRules(
        "close_id", accepted={"close_status": CLOSE_STATUSES}, references=(_TO_STAGED_PARTNER,)
    ),
    "stg_tickets": TableRules(
        "ticket_id",
        not_null=("requester_email",),
        accepted={"status": TICKET_STATUSES, "priority": PRIORITIES},
    ),
}

INTERMEDIATE_RULES = {
    "int_investors": TableRules("investor_id"),
    "int_relationship_managers": TableRules("rm_id"),
    "int_tickets": TableRules(
        "ticket_id",
        accepted={"requester_type": REQUESTER_TYPES, "partner_attribution_method": METHODS},
        strict=("requester_type", "partner_attribution_method"),
    ),
}

MART_RULES = {
    "dim_partner": TableRules("partner_id"),
    "dim_relationship_manager": TableRules("rm_id"),
    "dim_entity": TableRules("entity_id"),
    "dim_investor": TableRules("investor_id", not_null=("email",)),
    "dim_fund_close": TableRules("close_id"),
    "fct_tickets": TableRules(
        "ticket_id",
        accepted={"requester_type": REQUESTER_TYPES},
        references=(
            Reference("investor_id", "dim_investor", "investor_id"),
            Reference("partner_id", "dim_partner", "partner_id"),
        ),
        strict=("requester_type",),
    ),
    "mart_investor_ticket_summary": TableRules("investor_id"),
    "mart_is_pressure_weekly": TableRules("week_start"),
    "mart_attribution_health": TableRules("week_start"),
    "mart_staffing_forecast": TableRules("close_id"),
    "mart_close_ticket_pressure": TableRules("close_id"),
}

RULES = {**STAGING_RULES, **INTERMEDIATE_RULES, **MART_RULES}
