import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.cases import rows_of
from tests.llm.test_decontaminate import expected as contaminated
from tests.llm.test_exact_dedup import sha
from tests.llm.test_simhash import expected as near
from tidewatch.llm import bpe
from tidewatch.llm.queries import QUERIES, RANKS
from tidewatch.llm.shared import write_once

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage returns on the whole table, stored as the next stage reads it."""
    docs = corpus_pipeline.read(spark, SF_DIR, "documents")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = write_once(stage(spark, docs, SF_DIR))
        found.append(docs)
    return found


def pairs(df):
    return sorted(tuple(r) for r in df.select("doc_id", "text").collect())


def test_columns_stay(steps):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    for df in steps[1:5]:
        assert df.schema == steps[0].schema


def test_quality_stage_drops_what_the_operator_rejects(spark, steps):
    verdict = {r["doc_id"]: r["predicted"] for r in QUERIES["op8_quality"](spark, SF_DIR).collect()}
    assert pairs(steps[1]) == [p for p in pairs(steps[0]) if verdict[p[0]] == 1]


def test_exact_stage(steps):
    first = {}
    for i, t in pairs(steps[1]):
        first.setdefault(sha(t), (i, t))
    assert pairs(steps[2]) == sorted(first.values())


def test_near_stage(steps):
    rows = pairs(steps[2])
    assert pairs(steps[3]) == [p for p, r in zip(rows, near(rows), strict=True) if r[0] == r[2]]


def test_benchmark_stage(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = pairs(steps[3])
    want = [p for p, r in zip(rows, contaminated(rows, items), strict=True) if not r[5]]
    assert pairs(steps[4]) == want and len(want) < len(rows)


def test_token_stage(steps):
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(RANKS),
        special_tokens={},
    )
    text = dict(pairs(steps[4]))
    rows = steps[5].select("doc_id", "ids", "n_tokens").collect()
    assert len(rows) == len(text)
    for i, ids, count in rows:
        assert ids == library.encode_ordinary(text[i]) and count == len(ids)


def test_run_is_all_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(rows_of(got.select("doc_id", "ids_sha256"))) == sorted(
        rows_of(steps[5].select("doc_id", "ids_sha256"))
    )
    assert np.unique([r["doc_id"] for r in steps[5].select("doc_id").collect()]).size == steps[5].count()
