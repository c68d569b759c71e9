"""Scans of the raw extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.sources.schemas import RAW

#: a header row, quotes doubled inside quoted texts, backslashes ordinary
CSV_OPTIONS = {"header": "true", "enforceSchema": "false", "escape": '"'}


def read_extract(
    spark: SparkSession, name: str, path: str, fmt: str = "csv", multi_line: bool = False
) -> DataFrame:
    """One raw extract. CSV files carry a header row and are held to the declared schema:
    a malformed record fails the read instead of turning into nulls.

    A quote inside a quoted text is doubled, as usual; backslashes are ordinary characters.
    ``multi_line`` allows line breaks inside quoted texts; such a file is read by one task, so
    large extracts should come in several files.
    """
    reader = spark.read.schema(RAW[name])
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS, mode="FAILFAST", multiLine=multi_line)
    return reader.format(fmt).load(path)


def read_extracts(
    spark: SparkSession, folder: str, fmt: str = "csv", multi_line: bool = False
) -> dict[str, DataFrame]:
    """All raw extracts of a landing folder, found as ``<folder>/<name>.<fmt>``."""
    return {
        name: read_extract(spark, name, f"{folder}/{name}.{fmt}", fmt, multi_line) for name in RAW
    }
