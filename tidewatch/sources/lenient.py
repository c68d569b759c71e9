"""Loading extracts whose values may be malformed: good rows go on, bad ones are set aside with reasons.

Values arrive as texts and are cast one by one. A row with a text that is not of its column's type is
bad; it is kept in a quarantine, one line for each bad value, with the text as it came. If more than an
agreed share of the rows is bad, the load fails instead of going on with what is left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources.extracts import CSV_OPTIONS
from tidewatch.sources.tables import write_once

FAULTS, ROW = "_faults", "_row"
QUARANTINE = "row_id long, column_name string, value string, reason string"


class TooManyBadRows(Exception):
    """More rows are bad than the load accepts; ``quarantine`` has them."""

    def __init__(self, bad: int, rows: int, share: float, quarantine: DataFrame):
        super().__init__(f"{bad} of {rows} rows are bad, more than a share of {share:g}")
        self.bad, self.rows, self.quarantine = bad, rows, quarantine


@dataclass(frozen=True)
class Loaded:
    """Good rows in the declared types, and the quarantine (see ``QUARANTINE``)."""

    good: DataFrame
    quarantine: DataFrame
    rows: int
    bad: int


def text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def _fault(field: T.StructField) -> Column:
    """What is wrong with a value, null if nothing: an absent or blank one stands for null."""
    text = F.col(f"`{field.name}`")
    blank = F.trim(text) == ""
    if isinstance(field.dataType, T.StringType):
        bad, reason = F.lit(False), ""
    else:
        bad = text.isNotNull() & ~blank & text.try_cast(field.dataType).isNull()
        reason = f"not a {field.dataType.simpleString()}"
    if not field.nullable:
        missing = text.isNull() | blank
        return F.when(missing, _line(field, "missing")).when(bad, _line(field, reason))
    return F.when(bad, _line(field, reason))


def _line(field: T.StructField, reason: str) -> Column:
    return F.struct(
        F.lit(field.name).alias("column_name"),
        F.col(f"`{field.name}`").alias("value"),
        F.lit(reason).alias("reason"),
    )


def judged(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """All rows cast to the schema, with ``_faults``: a line for each value that could not be."""
    faults = F.filter(F.array(*(_fault(f) for f in schema.fields)), lambda line: line.isNotNull())
    typed = [
        F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType)
        else F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit("")).try_cast(f.dataType)
        for f in schema.fields
    ]
    return texts.select(
        *(c.alias(f.name) for c, f in zip(typed, schema.fields, strict=True)), faults.alias(FAULTS)
    )


def load(texts: DataFrame, schema: T.StructType, max_bad_share: float = 0.01) -> Loaded:
    """Splits rows of texts (columns named as in ``schema``) into good ones and a quarantine.

    The source is read once: the judged rows are written to the shared folder with a number that tells
    them apart, and both parts are scans of that copy. Of a row with several bad values the quarantine
    has several lines. ``max_bad_share`` is the greatest share of bad rows that is accepted.
    """
    return _split(judged(texts, schema), max_bad_share)


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, max_bad_share: float = 0.01, **options
) -> Loaded:
    """A CSV extract, read as texts. A line with too few or too many values is bad as a whole."""
    corrupt = "_line"
    texts = T.StructType([*text_schema(schema).fields, T.StructField(corrupt, T.StringType())])
    reader = spark.read.options(**{**CSV_OPTIONS, **options, "mode": "PERMISSIVE"})
    rows = reader.option("columnNameOfCorruptRecord", corrupt).schema(texts).csv(path)
    broken = F.struct(
        F.lit("").alias("column_name"), F.col(corrupt).alias("value"), F.lit("malformed line").alias("reason")
    )
    names = [F.col(f"`{f.name}`") for f in schema.fields]
    stored = write_once(rows)  # the malformed text is known only to a scan of all columns
    judged_rows = judged(stored.filter(F.col(corrupt).isNull()).select(*names), schema)
    whole = stored.filter(F.col(corrupt).isNotNull()).select(F.array(broken).alias(FAULTS))
    both = judged_rows.unionByName(whole, allowMissingColumns=True)
    return _split(both, max_bad_share)


def _split(judged_rows: DataFrame, max_bad_share: float) -> Loaded:
    stored = write_once(judged_rows.withColumn(ROW, F.monotonically_increasing_id()))
    is_bad = F.size(FAULTS) > 0
    counted = stored.agg(F.count("*").alias("rows"), F.count_if(is_bad).alias("bad")).first()
    quarantine = stored.filter(is_bad).select(F.col(ROW).alias("row_id"), F.inline(FAULTS))
    if counted["bad"] > max_bad_share * counted["rows"]:
        raise TooManyBadRows(counted["bad"], counted["rows"], max_bad_share, quarantine)
    return Loaded(stored.filter(~is_bad).drop(FAULTS, ROW), quarantine, counted["rows"], counted["bad"])
