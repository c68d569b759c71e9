import pytest
from pyspark.sql import types as T

from tidewatch.sources import lenient

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), nullable=False),
        T.StructField("name", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("a.b", T.DoubleType()),
    ]
)
ROWS = [
    ("1", "one", "2024-01-01", "2024-01-01 10:00:00", "1.5"),
    (" 2 ", None, "", None, " 7 "),
    ("x", "three", "2024-13-01", "2024-01-01 10:00:00", "1.5"),
    (None, "four", None, None, None),
    ("5", "  ", "yesterday", "noon", "1,5"),
    ("99999999999999999999", "six", None, None, "nan"),
]


def texts(spark, rows=ROWS):
    return spark.createDataFrame(rows, lenient.text_schema(SCHEMA))


def test_good_and_bad_rows(spark):
    loaded = lenient.load(texts(spark), SCHEMA, max_bad_share=0.9)
    good = sorted(map(tuple, loaded.good.collect()))
    assert [r[0] for r in good] == [1, 2] and good[1][1:4] == (None, None, None) and good[1][4] == 7.0
    assert loaded.good.dtypes == [(f.name, f.dataType.simpleString()) for f in SCHEMA.fields]
    assert (loaded.rows, loaded.bad) == (6, 4)
    lines = sorted(tuple(r)[1:] for r in loaded.quarantine.collect() if r["value"] is not None)
    assert lines == [
        ("a.b", "1,5", "not a double"),
        ("at", "noon", "not a timestamp_ntz"),
        ("day", "2024-13-01", "not a date"),
        ("day", "yesterday", "not a date"),
        ("id", "99999999999999999999", "not a bigint"),
        ("id", "x", "not a bigint"),
    ]
    missing = [tuple(r)[1:] for r in loaded.quarantine.collect() if r["value"] is None]
    assert missing == [("id", None, "missing")]
    assert loaded.quarantine.select("row_id").distinct().count() == 4


def test_the_limit(spark):
    with pytest.raises(lenient.TooManyBadRows, match="4 of 6") as failed:
        lenient.load(texts(spark), SCHEMA, max_bad_share=0.5)
    assert failed.value.quarantine.count() == 7
    assert lenient.load(texts(spark, ROWS[:2]), SCHEMA, max_bad_share=0).bad == 0
    assert lenient.load(texts(spark, []), SCHEMA).rows == 0


def test_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text(
        "id,name,day,at,a.b\n"
        '1,"one, ""quoted""",2024-01-01,2024-01-01 10:00:00,1.5\n'
        "2,two\n"
        "three,x,2024-01-01,,\n"
        "4,four,2024-01-01,,2.5,more\n"
        "5,five,,,\n"
    )
    loaded = lenient.load_csv(spark, str(tmp_path / "x.csv"), SCHEMA, max_bad_share=0.7)
    good = {r["id"]: r["name"] for r in loaded.good.collect()}
    assert good == {1: 'one, "quoted"', 5: "five"}
    lines = sorted((r["value"], r["reason"]) for r in loaded.quarantine.collect())
    assert lines == [
        ("2,two", "malformed line"),
        ("4,four,2024-01-01,,2.5,more", "malformed line"),
        ("three", "not a bigint"),
    ]


def test_one_scan_of_the_source(spark):
    """Both parts are scans of one stored copy."""
    loaded = lenient.load(texts(spark), SCHEMA, max_bad_share=1)
    for part in (loaded.good, loaded.quarantine):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "LogicalRDD" not in plan and "LocalRelation" not in plan
