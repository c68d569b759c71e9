import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from tests.llm.cases import frame, rows_of, texts
from tidewatch.llm import sharding


def best_capacity(sizes, shards):
    """The smallest largest part over all ways to cut the list."""
    best = sum(sizes)
    for cuts in combinations(range(1, len(sizes)), min(shards, len(sizes)) - 1):
        edges = [0, *cuts, len(sizes)]
        best = min(best, max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:], strict=False)))
    return best


def test_capacity_is_the_smallest(spark):
    rng = random.Random(3)
    for _ in range(300):
        sizes = [rng.choice([1, 2, 3, 50]) for _ in range(rng.randint(1, 10))]
        shards = rng.randint(1, 5)
        keys = sorted(rng.sample(range(-1000, 1000), len(sizes)))
        whole = list(zip(keys, sizes, strict=True))

        def summed(groups, shift):
            cells = defaultdict(list)
            for key, size in groups:
                cells[key >> shift].append((key, size))
            return [
                sharding.Range(g[0][0], g[-1][0], sum(s for _, s in g), shift)
                for _, g in sorted(cells.items())
            ]

        def refine(wide, whole=whole, summed=summed):
            finer = []
            for r in wide:
                own = [(k, s) for k, s in whole if r.low <= k <= r.high]
                finer += summed(own, r.shift - 1)
            return finer

        capacity, starts = sharding.minimax_starts(summed(whole, 8), shards, refine)
        assert capacity == best_capacity(sizes, shards)
        edges = [-(10**9), *starts, 10**9]
        parts = [
            sum(s for k, s in whole if a <= k < b) for a, b in zip(edges, edges[1:], strict=False)
        ]
        assert max(parts) <= capacity and len(parts) <= shards


def groups_of(rows):
    found = defaultdict(set)
    for i, _, crc, _, shard, _, _ in rows:
        found[crc].add(shard)
    return found


def test_laws_hold(spark):
    rows = rows_of(sharding.shard(frame(spark), 16))
    want = Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts()
    )
    assert Counter(r[:3] for r in rows) == want
    assert all(len(shards) == 1 for shards in groups_of(rows).values())
    slots = defaultdict(list)
    for r in rows:
        assert r[3] == "bytes" and r[6] is None and 0 <= r[4] < 16
        slots[r[4]].append(r[5])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("hot", [0, 200])
def test_shards_are_as_small_as_the_order_allows(spark, hot):
    rng = random.Random(4)
    rows = [(n, "x" * rng.randint(0, 300) + str(n)) for n in range(600)]
    rows += [(1000 + n, "hot text") for n in range(hot)]
    docs = frame(spark, rows)
    got = rows_of(sharding.shard(docs, 4))
    keys = {
        r["text"]: r["key"] for r in docs.selectExpr("text", "xxhash64(text) as key").collect()
    }
    sizes = Counter()
    for _, t in rows:
        sizes[keys[t]] += len(t) + 1
    ordered = [sizes[k] for k in sorted(sizes)]
    low, high = max(ordered), sum(ordered)
    while low < high:
        middle, used, load = (low + high) // 2, 1, 0
        for s in ordered:
            used, load = (used + 1, s) if load + s > middle else (used, load + s)
        low, high = (low, middle) if used <= 4 else (middle + 1, high)
    shards = Counter()
    for r in got:
        shards[r[4]] += r[1]
    assert max(shards.values()) == low


def test_empty_table(spark):
    assert sharding.shard(frame(spark, [])).collect() == []
