import pytest
from pyspark.sql import functions as F

from tests.llm.cases import frame, multiset, rows_of
from tests.llm.test_decontaminate import items_frame
from tests.llm.test_quality import corpus, labels
from tidewatch.llm import decontaminate, quality, rows


@pytest.fixture(params=["its own size", "all pass"])
def any_filter(request, monkeypatch):
    """The filter as it is, and one of a single bit, which all keys pass."""
    if request.param == "all pass":
        monkeypatch.setattr(rows, "filter_bits", lambda hashes: 1)


def numbered(docs):
    """The documents with a column that tells rows of equal id and text apart."""
    return docs.withColumn("own", F.monotonically_increasing_id()).cache()


def test_good_documents_keep_repeated_rows(spark, any_filter):
    texts = corpus()
    told = labels(spark, [(i, int(i < 1000), 0) for i, _ in texts])
    clean = [t for t in texts if t[0] < 1000]
    docs = numbered(frame(spark, texts + clean[:50] * 2 + [(None, clean[60][1])] * 3))
    kept = rows_of(quality.good_documents(docs, told).select("doc_id", "text", "own"))
    whole = rows_of(docs.filter("doc_id is null or doc_id < 1000").select("doc_id", "text", "own"))
    assert len(kept) == 303 and multiset(kept) == multiset(whole)


def test_decontaminate_keeps_repeated_rows(spark, any_filter):
    clean, bad = "a text of no benchmark at all", " ".join(f"b{n}" for n in range(12))
    docs = numbered(frame(spark, [(1, clean)] * 3 + [(2, bad)] * 2 + [(None, clean)] * 2 + [(3, None)] * 2))
    kept = rows_of(decontaminate.decontaminate(docs, items_frame(spark, [(1, bad)])).select("doc_id", "own"))
    assert multiset(kept) == multiset(rows_of(docs.filter("doc_id is distinct from 2").select("doc_id", "own")))


def test_only_listed_repeats_become_one(spark, any_filter):
    docs = frame(spark, [(1, "one")] * 3 + [(2, "two")] * 2 + [(3, "three")] * 2 + [(4, "four")] * 2)
    keys = lambda *ids: docs.filter(F.col("doc_id").isin(*ids)).select(rows.row_key().alias("key"))
    kept = rows.without(docs, keys(2, 4), keys(1, 4))
    assert kept.columns == docs.columns
    assert multiset(rows_of(kept.select("doc_id"))) == {(1,): 1, (3,): 2}
