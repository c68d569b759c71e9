"""Literal rows for the raw extracts; columns not given are null."""

from datetime import date, datetime

from tidewatch import Settings, Warehouse
from tidewatch.sources import RAW

AS_OF = date(2024, 6, 3)


def day(text):
    return date.fromisoformat(text)


def at(text):
    return datetime.fromisoformat(text)


def rows(spark, schema, records):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


def model(spark, settings=None, **extracts):
    """A warehouse over literal extracts; extracts not given are empty."""
    raw = {name: rows(spark, schema, extracts.get(name, [])) for name, schema in RAW.items()}
    return Warehouse(raw, settings or Settings(as_of=AS_OF))


def records(df):
    return [r.asDict() for r in df.collect()]
