"""Data checks. Each returns the failing rows; a report turns them into one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.settings import quoted


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.filter("n > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Non-null values outside the list, with their number of rows."""
    # the filter precedes the aggregate and reaches the scan
    odd = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return odd.groupBy(column).agg(F.count("*").alias("n"))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null values without a parent row, with their number of rows.

    The child side is reduced to its distinct values before the anti join, so a value that
    many rows carry is joined once.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_column).alias(column))
    return values.join(known, column, "left_anti")


def key_overlap(a: DataFrame, a_column: str, b: DataFrame, b_column: str) -> DataFrame:
    """Values of ``a_column`` that ``b_column`` holds too, with their number of rows in ``a``.

    As for ``relationships``, rows are reduced to values before the join.
    """
    values = a.filter(F.col(a_column).isNotNull()).groupBy(a_column).agg(F.count("*").alias("n"))
    return values.join(b.select(F.col(b_column).alias(a_column)), a_column, "left_semi")


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableRules:
    """What is checked on a table. The key must be unique and not null (severity error);
    accepted values and references find drift and only warn, unless listed in ``strict``."""

    key: str
    not_null: tuple[str, ...] = ()
    accepted: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    references: tuple[Reference, ...] = ()
    strict: tuple[str, ...] = ()


@dataclass(frozen=True)
class Overlap:
    """No value of one column may occur in another (severity error)."""

    name: str
    table: str
    column: str
    other_table: str
    other_column: str


@dataclass(frozen=True)
class _Check:
    kind: str
    table: str
    column: str
    severity: str
    accepted: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    name: str | None = None


def _checks(rules: Mapping[str, TableRules], overlaps: Sequence[Overlap]) -> list[_Check]:
    found = []
    for table, r in rules.items():
        found.append(_Check("unique", table, r.key, "error"))
        for c in (r.key, *r.not_null):
            found.append(_Check("not_null", table, c, "error"))
        for c, values in r.accepted.items():
            severity = "error" if c in r.strict else "warn"
            found.append(_Check("accepted_values", table, c, severity, accepted=values))
        for ref in r.references:
            parent = (ref.parent, ref.parent_column)
            found.append(_Check("relationships", table, ref.column, "warn", parent=parent))
    for o in overlaps:
        parent = (o.other_table, o.other_column)
        found.append(_Check("overlap", o.table, o.column, "error", parent=parent, name=o.name))
    return found


def _row_failures(tables: Mapping[str, DataFrame], checks: dict[int, _Check]) -> list[DataFrame]:
    """(probe, measure, failures) of null checks, which each row answers: one pass per table."""
    by_table: dict[str, dict[int, str]] = {}
    for n, c in checks.items():
        by_table.setdefault(c.table, {})[n] = f"{c.column} is null"
    found = []
    for name, failing in by_table.items():
        counts = (F.expr(f"count_if({f})").alias(f"c{n}") for n, f in failing.items())
        entries = ", ".join(f"{n}, 'rows', c{n}" for n in failing)
        answers = f"stack({len(failing)}, {entries}) as (probe, measure, failures)"
        found.append(tables[name].agg(*counts).selectExpr(answers))
    return found


def _value_failures(tables: Mapping[str, DataFrame], checks: dict[int, _Check]) -> DataFrame:
    """(probe, measure, failures) of checks that compare values across rows, by one census.

    Each table offers the values of its checked columns once, as held by the column or as known
    to it (its parent's); they are counted per check and value, combined before the shuffle. A
    value that a third of the rows hold is one row of a task, and no join is needed. The key's
    nulls are among the values that its uniqueness needs anyway; nulls of other columns and values
    that are accepted are not counted at all, so that little is left to count and to shuffle.
    """
    offers: dict[str, list[str]] = {}
    keys = [n for n, c in checks.items() if c.kind == "unique"]
    for n, c in checks.items():
        value = f"cast({c.column} as string)"
        if c.accepted:
            value = f"if({c.column} in ({quoted(*c.accepted)}), null, {value})"
        offers.setdefault(c.table, []).append(f"{n}, {value}, 1, 0")
        if c.parent:
            table, column = c.parent
            offers.setdefault(table, []).append(f"{n}, cast({column} as string), 0, 1")
    scans = [
        tables[name].selectExpr(f"stack({len(o)}, {', '.join(o)}) as (probe, value, held, known)")
        for name, o in offers.items()
    ]
    asked = F.col("value").isNotNull() | F.col("probe").isin(keys)
    census = (
        reduce(DataFrame.unionByName, (scan.filter(asked) for scan in scans))
        .groupBy("probe", "value")
        .agg(F.sum("held").alias("held"), F.max("known").alias("known"))
    )
    totals = census.groupBy("probe").agg(
        F.expr("count_if(value is not null and held > 1) as repeated"),
        F.expr("count_if(value is not null) as others"),
        F.expr("sum(if(value is null, held, 0)) as nulls"),
        F.expr("sum(if(value is not null and known = 0, held, 0)) as orphans"),
        F.expr("sum(if(value is not null and known = 1, held, 0)) as shared"),
    )
    measures = ("repeated", "others", "nulls", "orphans", "shared")
    entries = ", ".join(f"'{m}', {m}" for m in measures)
    return totals.selectExpr("probe", f"stack({len(measures)}, {entries}) as (measure, failures)")


def report(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules],
    overlaps: Sequence[Overlap] = (),
) -> DataFrame:
    """One row per check: failures as the number of failing rows or values, and the verdict.

    Nulls are counted in one pass per table, without a shuffle of values; uniqueness, accepted
    values and references are answered by one census of values.
    """
    checks = dict(enumerate(_checks(rules, overlaps)))
    unique = {(c.table, c.column): n for n, c in checks.items() if c.kind == "unique"}
    measures = {"unique": "repeated", "accepted_values": "others"}
    measures |= {"relationships": "orphans", "overlap": "shared"}
    by_row, by_value, lines = {}, {}, []
    for n, c in checks.items():
        probe, measure = n, measures.get(c.kind, "rows")
        if c.kind == "not_null" and (c.table, c.column) in unique:
            probe, measure = unique[c.table, c.column], "nulls"
        elif measure == "rows":
            by_row[n] = c
        else:
            by_value[n] = c
        lines.append((probe, measure, c.name or c.kind, c.table, c.column, c.severity))
    found = [*_row_failures(tables, by_row), _value_failures(tables, by_value)]
    failures = reduce(DataFrame.unionByName, found)
    listed = ", ".join(f"({probe}, {quoted(*texts)})" for probe, *texts in lines)
    lines = failures.sparkSession.sql(
        f"select * from values {listed} "
        "as t(probe, measure, check_name, table_name, column_name, severity)"
    )
    count = F.coalesce("failures", F.lit(0))
    return lines.join(failures, ["probe", "measure"], "left").select(
        "check_name",
        "table_name",
        "column_name",
        "severity",
        count.alias("failures"),
        (count == 0).alias("passed"),
    )
