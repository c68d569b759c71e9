"""Schemas of the raw extracts. Readers never infer types."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_DAY, _TIME = T.DateType(), T.TimestampNTZType()

RAW = {
    "partners": _struct(partner_id=_TEXT, partner_name=_TEXT, partner_type=_TEXT),
    "rms": _struct(rm_id=_TEXT, partner_id=_TEXT, name=_TEXT, email=_TEXT),
    "entities": _struct(
        entity_id=_TEXT, entity_name=_TEXT, partner_id=_TEXT, entity_type=_TEXT, kyc_status=_TEXT
    ),
    "investors": _struct(
        investor_id=_TEXT,
        user_id=_TEXT,
        email=_TEXT,
        full_name=_TEXT,
        entity_id=_TEXT,
        country=_TEXT,
        created_at=_TIME,
        relationship_manager_id=_TEXT,
    ),
    "closes": _struct(
        close_id=_TEXT,
        fund_id=_TEXT,
        fund_name=_TEXT,
        partner_id=_TEXT,
        close_number=_INT,
        scheduled_close_date=_DAY,
        close_status=_TEXT,
        total_committed_aum=_LONG,
    ),
    "tickets": _struct(
        ticket_id=_LONG,
        requester_email=_TEXT,
        requester_name=_TEXT,
        subject=_TEXT,
        status=_TEXT,
        priority=_TEXT,
        created_at=_TIME,
        resolved_at=_TIME,
        tags=_TEXT,
        partner_label=_TEXT,
    ),
    "label_synonyms": _struct(label_raw=_TEXT, partner_id=_TEXT, partner_name=_TEXT),
    "tag_themes": _struct(tag=_TEXT, theme=_TEXT, theme_label=_TEXT, theme_sort_order=_INT),
}
