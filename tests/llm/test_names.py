"""Extra columns of any name and type come through the operators that return documents."""

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import frame, sentence
from tidewatch.llm import bloom
from tidewatch.llm.decontaminate import decontaminate
from tidewatch.llm.exact_dedup import exact_dedup
from tidewatch.llm.quality import good_documents
from tidewatch.llm.rows import without
from tidewatch.llm.simhash import near_dedup

#: the names the operators and their helpers would use, and names that need quoting
HELPERS = [
    f"__{flag}_{part}{n}"
    for flag in ("__maybe", "__listed", "maybe", "touched")
    for part in ("place", "bucket", "bitmap")
    for n in (0, 1)
]
HELPERS += ["__maybe", "__listed", "__row_key", "__row", "__sha", "__key", "row_no", "key", "a.b"]
HELPERS += ["`tick`", "a.`b`.c", "two words"]


@pytest.fixture(scope="module")
def docs(spark):
    import random

    rng = random.Random(3)
    rows = [(n, sentence(rng, 60)) for n in range(30)]
    rows += [(100 + n, "a text that occurs more than once and is copied as a whole") for n in range(6)]
    rows += [(200, None), (201, ""), (rows[0][0], rows[0][1]), (rows[0][0], rows[0][1])]
    table = frame(spark, rows, clashing=False).withColumn("number", F.monotonically_increasing_id())
    marks = [F.concat(F.lit(f"{c}="), F.col("number")).alias(c) for c in HELPERS]
    table = table.select("*", *marks, F.create_map(F.lit("n"), F.col("number")).alias("of.map"))
    path = "file:" + str(spark.conf.get("spark.sql.warehouse.dir")).removeprefix("file:") + "/names"
    table.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def benchmark(spark, docs):
    text = docs.filter("doc_id = 5").first()["text"]
    return spark.createDataFrame([("one", text)], "item_id string, text string")


def labels(spark):
    return spark.createDataFrame([(n, n % 2) for n in range(30)], "doc_id long, quality int")


OPERATORS = {
    "exact": lambda spark, docs: exact_dedup(docs),
    "exact, all suspects": lambda spark, docs: exact_dedup(docs, max_bits=bloom.BITMAP_BITS),
    "near": lambda spark, docs: near_dedup(docs, shingle=3, radius=2),
    "quality": lambda spark, docs: good_documents(docs, labels(spark), threshold=0.3),
    "benchmark": lambda spark, docs: decontaminate(docs, benchmark(spark, docs), window=10),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_come_through_unchanged(spark, docs, name):
    got = OPERATORS[name](spark, docs)
    assert got.schema.names == docs.schema.names
    given = {row["number"]: row for row in docs.collect()}
    rows = got.collect()
    assert rows and all(row == given[row["number"]] for row in rows)
    assert len({row["number"] for row in rows}) == len(rows)


def test_rows_taken_out_once(spark, docs):
    from tidewatch.llm.rows import row_key

    keys = docs.select(row_key().alias("key"), "doc_id")
    repeated = keys.filter("doc_id = 0").select("key")
    removed = keys.filter("doc_id = 100").select("key")
    got = [row["doc_id"] for row in without(docs, removed, repeated).collect()]
    assert got.count(0) == 1 and 100 not in got and len(got) == docs.count() - 3
