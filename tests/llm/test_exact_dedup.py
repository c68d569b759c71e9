import hashlib
import re
from collections import defaultdict

import duckdb
import pytest

from tests.llm.cases import frame, multiset, order, rows_of, texts
from tidewatch.llm import bloom, exact_dedup
from tidewatch.llm.oracle import ORACLE
from tidewatch.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[sha(t)].append(i)
    found = []
    for s, ids in groups.items():
        keep = min(ids, key=order)
        found += [(i, keep, len(ids), s) for i in ids]
    return found


@pytest.mark.parametrize("max_bits", [bloom.MAX_BITS, bloom.BITMAP_BITS])
def test_groups_against_brute_force(spark, max_bits):
    got = rows_of(exact_dedup.copy_groups(frame(spark), max_bits=max_bits))
    assert multiset((i, k, n, s) for i, k, n, _, s in got) == multiset(expected(texts()))
    kept = [(s, i) for i, _, _, stays, s in got if stays]
    assert len(kept) == len({s for s, _ in kept}) == len({sha(t) for _, t in texts()})
    assert all(i == k for i, k, _, stays, _ in got if stays)


def test_dedup_keeps_one_row_per_text_with_all_columns(spark):
    docs = frame(spark)
    got = exact_dedup.exact_dedup(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    rows = rows_of(got.select("doc_id", "text"))
    best = {}
    for i, t in texts():
        best.setdefault(sha(t), []).append(i)
    assert multiset((sha(t), i) for i, t in rows) == multiset(
        (s, min(ids, key=order)) for s, ids in best.items()
    )


def test_all_rows_equal(spark):
    rows = [(n, "same") for n in range(500)]
    got = rows_of(exact_dedup.copy_groups(frame(spark, rows)))
    assert {(k, n) for _, k, n, _, _ in got} == {(0, 500)}
    assert [i for i, _, _, stays, _ in got if stays] == [0]


def test_empty_table(spark):
    docs = frame(spark, [])
    assert exact_dedup.copy_groups(docs).collect() == []
    assert exact_dedup.exact_dedup(docs).collect() == []


def test_a_hash_that_occurs_twice_always_passes(spark):
    keys = spark.range(2000).selectExpr("xxhash64(id) as key")
    twice = keys.limit(50).unionByName(keys)
    bits = bloom.filter_bits(2050)
    flagged = bloom.passes(twice, "key", bloom.repeat_filter(twice, "key", bits), bits, "maybe")
    counts = flagged.groupBy("key", "maybe").count().collect()
    assert all(r["maybe"] for r in counts if r["count"] == 2)
    assert sum(r["maybe"] for r in counts if r["count"] == 1) < 200


def test_query_against_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as from '{SF_DIR}/documents.parquet'")
    result = duck.execute(ORACLE["op1_exact_dedup"])
    names = [d[0] for d in result.description]
    got = QUERIES["op1_exact_dedup"](spark, SF_DIR).select(*names)
    assert multiset(rows_of(got)) == multiset(result.fetchall())
