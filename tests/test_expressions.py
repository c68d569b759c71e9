import pytest
from helpers import at, day
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.functions import (
    hours_between,
    month_start,
    norm_key,
    pct,
    round_half_up,
    split_rows,
    week_start,
)


def one(spark, column, **values):
    fields = ", ".join(f"{k} {t}" for k, (_, t) in values.items())
    df = spark.createDataFrame([tuple(v for v, _ in values.values())], fields)
    return df.select(column.alias("x")).first()[0]


def test_norm_key_trims_spaces_only(spark):
    assert one(spark, norm_key("a"), a=("  Bob@X.COM ", "string")) == "bob@x.com"
    assert one(spark, norm_key("a"), a=("\tBob ", "string")) == "\tbob"


def test_weeks_start_on_monday(spark):
    last = at("2024-06-02T23:59:59.999999")
    assert one(spark, week_start("t"), t=(last, "timestamp_ntz")) == day("2024-05-27")
    first = at("2024-06-03T00:00:00")
    assert one(spark, week_start("t"), t=(first, "timestamp_ntz")) == day("2024-06-03")
    assert one(spark, month_start("t"), t=(last, "timestamp_ntz")) == day("2024-06-01")


def test_hours_are_exact_and_know_no_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one(
            spark,
            hours_between("a", "b"),
            a=(at("2024-03-09T12:00:00"), "timestamp_ntz"),
            b=(at("2024-03-10T12:00:00.000036"), "timestamp_ntz"),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == 24 + 1e-8


@pytest.mark.parametrize(
    "value, scale, rounded",
    [(2.5, 0, 3.0), (-2.5, 0, -3.0), (2.45, 1, 2.5), (1.005, 2, 1.0), (None, 1, None)],
)
def test_round_half_up(spark, value, scale, rounded):
    assert one(spark, round_half_up(F.col("a"), scale), a=(value, "double")) == rounded


def test_pct_of_nothing_is_null(spark):
    assert one(spark, pct("n", "t"), n=(1, "bigint"), t=(0, "bigint")) is None
    assert one(spark, pct("n", "t"), n=(1, "bigint"), t=(3, "bigint")) == 33.33


@pytest.mark.parametrize(
    "text, tags",
    [(None, []), ("", []), (" , ", []), ("a, b,,a", ["a", "b", "a"]), (" X|y ", ["x|y"])],
)
def test_split_rows(spark, text, tags):
    df = spark.createDataFrame([(1, text)], "id int, tags string")
    assert [r.tag for r in split_rows(df, "tags", ",", "tag").collect()] == tags


def test_split_rows_takes_the_delimiter_literally(spark):
    df = spark.createDataFrame([(1, "a|b.c|d")], "id int, tags string")
    assert [r.tag for r in split_rows(df, "tags", "|", "tag").collect()] == ["a", "b.c", "d"]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab ,", max_size=12), min_size=1, max_size=8))
def test_split_rows_property(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, tags string")
    got = sorted((r.id, r.tag) for r in split_rows(df, "tags", ",", "tag").collect())
    expected = sorted(
        (i, piece.strip(" ").lower())
        for i, text in enumerate(texts)
        for piece in text.split(",")
        if piece.strip(" ")
    )
    assert got == expected
