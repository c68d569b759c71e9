"""The registered queries that have SQL, against it, on whole tables."""

import os
from collections import Counter

import duckdb
import pytest

from tidewatch.llm.oracle import ORACLE
from tidewatch.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(SF_DIR):
        duck.execute(f"create view {file.split('.')[0]} as from '{SF_DIR}/{file}'")
    found = duck.execute(ORACLE[name])
    types = {d[0]: TYPES[str(d[1])] for d in found.description}
    df = QUERIES[name](spark, SF_DIR).select(*types)
    want = Counter(found.fetchall())
    assert want and dict(df.dtypes) == types
    assert Counter(tuple(r) for r in df.collect()) == want
