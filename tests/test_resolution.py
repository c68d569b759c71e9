from helpers import AS_OF, at, model, records

from tidewatch import Settings


def ticket(id, email, label=None, **more):
    return {"ticket_id": id, "requester_email": email, "partner_label": label, **more}


REGISTRIES = {
    "entities": [
        {"entity_id": "E1", "partner_id": "P1"},
        {"entity_id": "E2", "partner_id": None},
    ],
    "investors": [
        {"investor_id": "I1", "email": " Ann@x.com", "entity_id": "E1"},
        {"investor_id": "I2", "email": "both@x.com", "entity_id": "E2"},
        {"investor_id": "I3", "email": "", "entity_id": "E1"},
    ],
    "rms": [
        {"rm_id": "R1", "email": "RM@x.com ", "partner_id": "P2", "name": "Rae"},
        {"rm_id": "R2", "email": "both@x.com", "partner_id": "P3", "name": "Bo"},
    ],
    "label_synonyms": [{"label_raw": "Acme Ltd", "partner_id": "P9", "partner_name": "Acme"}],
}


def resolved(spark, tickets, settings=None):
    m = model(spark, settings, tickets=tickets, **REGISTRIES)
    return {r["ticket_id"]: r for r in records(m.resolved)}


def test_precedence_and_trust_chain(spark):
    got = resolved(
        spark,
        [
            ticket(1, "ANN@x.com "),
            ticket(2, "rm@x.com", "Acme Ltd"),
            ticket(3, "ops@corp.com", " ACME LTD"),
            ticket(4, "who@mail.com", "acme"),
            ticket(5, "ops@corp.io"),
            ticket(6, None, "Acme Ltd"),
        ],
    )
    seen = {
        i: (r["requester_type"], r["partner_id"], r["partner_attribution_method"])
        for i, r in got.items()
    }
    assert seen == {
        1: ("investor", "P1", "investor_email_match"),
        2: ("relationship_manager", "P2", "rm_email_match"),
        3: ("internal", "P9", "partner_label_fallback"),
        4: ("unknown", None, "unresolved"),
        5: ("internal", None, "unresolved"),
        6: ("unknown", "P9", "partner_label_fallback"),
    }
    assert got[3]["is_corp_com"] and not got[3]["is_corp_io"] and got[5]["is_corp_io"]


def test_method_follows_the_type_not_the_value(spark):
    """An e-mail in both registries is the investor's, and the manager's rung is skipped."""
    got = resolved(spark, [ticket(1, "both@x.com", "Acme Ltd"), ticket(2, "both@x.com")])
    assert got[1]["requester_matched_both"]
    assert (got[1]["requester_type"], got[1]["partner_id"]) == ("investor", "P9")
    assert got[1]["partner_attribution_method"] == "investor_email_match"
    assert got[2]["partner_id"] is None
    assert got[2]["partner_attribution_method"] == "investor_email_match"


def test_blank_emails_match_unless_told_otherwise(spark):
    assert resolved(spark, [ticket(1, "  ")])[1]["investor_id"] == "I3"
    strict = Settings(as_of=AS_OF, blank_emails_match=False)
    assert resolved(spark, [ticket(1, "  ")], strict)[1]["investor_id"] is None


def test_grain_is_kept_whatever_the_salting(spark):
    tickets = [
        ticket(i, ["ann@x.com", "rm@x.com", None, "nobody@y.com"][i % 4], [None, "Acme Ltd"][i % 2])
        for i in range(400)
    ]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        plain = resolved(spark, tickets)
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        salted = resolved(spark, tickets)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(plain) == 400 and plain == salted


def test_fact_flags(spark):
    m = model(
        spark,
        tickets=[
            ticket(1, "a@b.c", status=" Open", created_at=at("2024-05-31T10:00:00")),
            ticket(
                2,
                "a@b.c",
                status="open",
                created_at=at("2024-05-31T10:00:00"),
                resolved_at=at("2024-06-01T10:30:00"),
            ),
            ticket(3, "a@b.c", status="closed", resolved_at=at("2024-06-01T10:30:00")),
        ],
    )
    got = {r["ticket_id"]: r for r in records(m.ticket_fact)}
    assert (got[1]["is_open"], got[1]["is_resolved"], got[1]["resolution_hours"]) == (True, False, None)
    # open and resolved are independent
    assert (got[2]["is_open"], got[2]["is_resolved"], got[2]["resolution_hours"]) == (True, True, 24.5)
    assert (got[3]["is_resolved"], got[3]["resolution_hours"], got[3]["created_week"]) == (True, None, None)
    assert str(got[1]["created_week"]) == "2024-05-27" and str(got[1]["created_month"]) == "2024-05-01"
