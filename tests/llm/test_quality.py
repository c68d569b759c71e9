import random
import zlib

import numpy as np
import pytest

from tests.llm.cases import frame, multiset, rows_of, sentence, texts
from tidewatch.llm import quality
from tidewatch.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def area(scores, truth):
    """Chance that a good document scores above a bad one, ties counting half."""
    good, bad = scores[truth == 1], scores[truth == 0]
    return np.mean((good[:, None] > bad) + 0.5 * (good[:, None] == bad))


def test_held_out_accuracy(spark):
    got = QUERIES["op8_quality"](spark, SF_DIR).toPandas()
    told = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    both = got.merge(told, on="doc_id")
    for held, least in ((True, 0.97), (False, 0.98)):
        part = both[both["held_out"] == held]
        assert area(part["score"].to_numpy(), part["quality"].to_numpy()) > least
        assert (part["predicted"] == part["quality"]).mean() > 0.95
    assert ((got["score"] >= 0.3).astype(int) == got["predicted"]).all()
    for row in got.itertuples():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)


def corpus():
    rng = random.Random(13)
    rows = [(n, sentence(rng, 40) + ".") for n in range(200)]
    return rows + [(1000 + n, sentence(rng, 40).upper().replace(" ", "!! ")) for n in range(200)]


def test_held_out_labels_are_not_read(spark):
    rows = corpus()
    told = [(i, int(i < 1000), 0) for i, _ in rows]
    lying = [(i, q if zlib.crc32(str(i).encode()) % 5 else 1 - q, 0) for i, q, _ in told]
    docs = frame(spark, rows)
    one = rows_of(quality.quality_report(docs, labels(spark, told)).orderBy("doc_id"))
    other = rows_of(quality.quality_report(docs, labels(spark, lying)).orderBy("doc_id"))
    assert np.allclose([r[2] for r in one], [r[2] for r in other])
    assert all(r[3] == int(r[0] < 1000) for r in one)
    kept = quality.good_documents(docs, labels(spark, told))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == list(range(200))


@pytest.mark.parametrize("told", [[], [(1, 1, 0)], [(1, None, 0), (None, 1, 0)], [(1, 1, 0), (1, 0, 0)]])
def test_few_labels_and_odd_texts(spark, told):
    got = rows_of(quality.quality_report(frame(spark), labels(spark, told)))
    assert multiset(r[0] for r in got) == multiset(i for i, _ in texts())
    assert all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.3) for r in got)


def test_pooling():
    values, weights = np.array([1.0, 0.0, 2.0, 2.0, 1.0, 5.0]), np.array([1.0, 3, 1, 1, 2, 1])
    assert np.allclose(quality.pool(values, weights), [0.25, 0.25, 1.5, 1.5, 1.5, 5.0])


def test_sums_of_parts_are_the_sums_of_the_whole(spark):
    rows = corpus()
    stats = quality.described(frame(spark, rows), "doc_id", "text").cache()
    kernel = quality.Kernel.over(stats, 16, 4.0)
    labelled = stats.selectExpr("stats", "cast(id % 2 as int) as fold", "cast(id < 1000 as double) as quality")
    sums = quality.equations(labelled.repartition(7), kernel)
    data = labelled.toPandas()
    x = kernel.features(np.stack(data["stats"].to_list()))
    for fold in (0, 1):
        own = (data["fold"] == fold).to_numpy()
        want = x[own].T @ np.column_stack([x, data["quality"]])[own]
        assert np.allclose(sums[fold], want)


def test_empty_table(spark):
    told = labels(spark, [(1, 1, 0)])
    assert quality.quality_report(frame(spark, []), told).collect() == []
    assert quality.good_documents(frame(spark, []), told).collect() == []
