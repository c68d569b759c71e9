import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tests.llm.cases import frame, multiset, order, rows_of, texts
from tidewatch.llm import simhash
from tidewatch.llm.components import components
from tidewatch.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def slow_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def groups(rows):
    """The fingerprint of each row, and the fingerprint that names its group."""
    prints = [slow_print(t) for _, t in rows]
    distinct = sorted(set(prints))
    values = np.array(distinct, np.uint64)
    near = [
        (a, distinct[j])
        for a in distinct
        for j in np.flatnonzero(np.bitwise_count(values ^ np.uint64(a)) <= 2)
    ]
    roots = roots_of(distinct, near)
    return prints, [roots[p] for p in prints]


def expected(rows):
    prints, roots = groups(rows)
    smallest = {}
    for (i, _), root in zip(rows, roots, strict=True):
        smallest[root] = min(smallest.get(root, float("inf")), order(i))
    name = lambda x: None if x == float("inf") else x
    return [
        (i, format(p, "016x"), name(smallest[root]))
        for (i, _), p, root in zip(rows, prints, roots, strict=True)
    ]


def test_against_brute_force(spark):
    assert multiset(rows_of(simhash.near_report(frame(spark)))) == multiset(expected(texts()))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = rows_of(QUERIES["op7_simhash"](spark, SF_DIR))
    assert multiset(got) == multiset(expected([tuple(d) for d in docs]))


def test_dedup_keeps_one_document_of_each_group(spark):
    docs = frame(spark)
    got = simhash.near_dedup(docs)
    assert got.columns == docs.columns
    rows = rows_of(got.select("doc_id", "text"))
    want = defaultdict(set)
    for row, root in zip(texts(), groups(texts())[1], strict=True):
        want[root].add(row)
    assert len(rows) == len(want)
    for group in want.values():
        first = min((order(i) for i, _ in group))
        assert sum(row in group for row in rows) == 1
        assert next(order(row[0]) for row in rows if row in group) == first


@pytest.mark.parametrize("tile", [4, 50, 10_000])
def test_links_in_tiles(spark, tile):
    rng = random.Random(11)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for centre in list(prints)[:4]:
        for _ in range(60):  # groups so close that they share every band
            near = centre
            for _ in range(rng.randint(1, 3)):
                near ^= 1 << rng.randrange(64)
            prints.add(near)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    forest = [tuple(r) for r in simhash.links(df, 2, tile=tile).collect()]
    values = sorted(map(signed, prints))
    near = [
        (a, b)
        for k, a in enumerate(values)
        for b in values[k + 1 :]
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    ]
    assert roots_of(values, forest) == roots_of(values, near)
    assert len(forest) <= 6 * 10 * len(values)


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(12)
    linked = [(n, n + 1) for n in range(0, 60)] + [(1000, n) for n in range(1001, 1100)]
    linked += [(2000, 2000), (2001, 2002), (2002, 2001), (2001, 2002)]
    linked += [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(120)]
    got = dict(rows_of(components(spark.createDataFrame(linked, "node long, other long"))))
    nodes = {n for pair in linked for n in pair}
    want = roots_of(nodes, linked)
    assert {n: got.get(n, n) for n in nodes} == want
    assert components(spark.createDataFrame([], "node long, other long")).collect() == []


def test_empty_table(spark):
    assert simhash.near_report(frame(spark, [])).collect() == []
    assert simhash.near_dedup(frame(spark, [])).collect() == []
