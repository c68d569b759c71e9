"""The expressions of the model as functions of the session, for those who write SQL.

They are SQL functions: the optimizer puts their bodies in place of the calls, so a query with them is
planned as if the expressions had been written out. ``register`` makes them known to a session. An
SQL function cannot be an aggregate; medians are Spark's own ``median`` and ``percentile_approx``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "week_start": "(at TIMESTAMP_NTZ) RETURNS DATE RETURN trunc(cast(at AS DATE), 'week')",
    "month_start": "(at TIMESTAMP_NTZ) RETURNS DATE RETURN trunc(cast(at AS DATE), 'month')",
    "datediff_hours": "(start_at TIMESTAMP_NTZ, end_at TIMESTAMP_NTZ) RETURNS DOUBLE "
    "RETURN timestampdiff(MICROSECOND, start_at, end_at) / 3.6e9D",
    "date_add_days": "(day DATE, days INT) RETURNS DATE RETURN date_add(day, days)",
    "date_sub_days": "(day DATE, days INT) RETURNS DATE RETURN date_sub(day, days)",
    "cast_int64": "(value STRING) RETURNS BIGINT RETURN cast(value AS BIGINT)",
    "norm_key": "(text STRING) RETURNS STRING RETURN lower(trim(text))",
    "rate_pct": "(part BIGINT, whole BIGINT) RETURNS DOUBLE "
    "RETURN round(cast(part AS DOUBLE) * 100.0D / nullif(whole, 0) * 100.0D, 0) / 100.0D",
    "unnest_split": "(text STRING, delimiter STRING) RETURNS TABLE (piece STRING) "
    r"RETURN SELECT explode(split(text, concat('\\Q', delimiter, '\\E')))",
}


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session, in place of those of the same names."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body}")
