"""Sharding: minimax contiguous partition of ordered atomic groups, law ``bytes``.

Equal texts are one atomic group; groups are ordered by the 64-bit hash of their text. Of all ways
to cut that order into contiguous shards, the largest shard is made as small as can be: its size
is found by binary search, each trial filling shards greedily, and the cuts are where the greedy
filling at that size makes them.

The order may hold billions of groups, so trials run on sums. Groups are summed by ranges of their
hash (at most 2**16 sums at a time reach the driver); trials that may cut a range anywhere, and
trials that may not cut it at all, bound the capacity from below and above; only ranges that a cut may
fall into are summed again more finely, until all cuts fall between known groups. Groups above
1/4096 of all bytes stand alone from the start.

A null text has no bytes; sizes are bytes + 1, so empty documents weigh something too. Null and
empty texts are one group. Long texts count whole; one above a fair share has a shard of
its own size. Ids may repeat or be null: every row gets a slot of its own. An empty
table gives an empty result; shards may stay empty if there are few groups.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.shared import shuffle_tasks, text_of, write_once

MAX_SUMS = 1 << 16
HOT_SHARE = 4096


@dataclass(frozen=True)
class Range:
    """Groups with hashes from ``low`` to ``high``: all of a cell of width 2**shift, or a part."""

    low: int
    high: int
    bytes: int
    shift: int

    @property
    def atomic(self) -> bool:
        return self.low == self.high


class Trials:
    """Greedy fillings of shards over an ordered list of ranges."""

    def __init__(self, ranges: list[Range]):
        self.ranges = ranges
        self.ends = [0, *accumulate(r.bytes for r in ranges)]

    @property
    def total(self) -> int:
        return self.ends[-1]

    def fill(self, capacity: int, shards: int, splitting: bool) -> list[int]:
        """Where the shards end, in bytes; ``splitting`` lets ranges of several groups be cut."""
        stops, at = [], 0
        for _ in range(shards):
            target = at + capacity
            if target >= self.total:
                at = self.total
            else:
                inside = bisect_right(self.ends, target) - 1
                free = splitting and not self.ranges[inside].atomic
                at = target if free else max(at, self.ends[inside])
            stops.append(at)
        return stops

    def smallest(self, shards: int, splitting: bool) -> int:
        """The smallest capacity with which ``shards`` shards hold everything."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.fill(middle, shards, splitting)[-1] == self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def undecided(self, low: int, high: int, shards: int) -> list[int]:
        """Ranges of several groups that a cut may fall into, for capacities from low to high."""
        found = set()
        for start, stop in zip(
            self.fill(low, shards, False), self.fill(high, shards, True), strict=True
        ):
            for i in range(max(0, bisect_right(self.ends, start) - 1), len(self.ranges)):
                if self.ends[i] >= stop:
                    break
                if not self.ranges[i].atomic:
                    found.add(i)
        return sorted(found)


def minimax_starts(
    ranges: list[Range], shards: int, refine: Callable[[list[Range]], list[Range]]
) -> tuple[int, list[int]]:
    """The smallest capacity and the first hash of every shard but the first."""
    while True:
        trials = Trials(ranges)
        low, high = trials.smallest(shards, True), trials.smallest(shards, False)
        doubtful = trials.undecided(low, high, shards)
        if not doubtful:
            break
        finer = refine([ranges[i] for i in doubtful])
        known = set(doubtful)
        ranges = sorted(
            [r for i, r in enumerate(ranges) if i not in known] + finer, key=lambda r: r.low
        )
    starts = []
    for stop in trials.fill(high, shards, False):
        i = bisect_right(trials.ends, stop) - 1
        if i < len(ranges):
            starts.append(ranges[i].low)
    return high, starts


def group_ranges(groups: DataFrame) -> tuple[list[Range], Callable[[list[Range]], list[Range]]]:
    """Sums of ``groups`` (key, bytes) by hash range, and the function that sums ranges finer."""
    spark = groups.sparkSession
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    hot = sorted(tuple(r) for r in groups.filter(F.col("bytes") * HOT_SHARE > total).collect())
    alone = [Range(key, key, size, 0) for key, size in hot]
    cool = groups.filter(F.col("bytes") * HOT_SHARE <= total)

    def summed(rows: DataFrame, shift: int) -> list[Range]:
        """One range per cell of width 2**shift, and per stretch of it between hot groups."""
        rows = rows.withColumn("cell", F.shiftright("key", shift))
        parts = F.lit(0)
        by_cell: dict[int, list[int]] = {}
        for key, _ in hot:
            by_cell.setdefault(key >> shift, []).append(key)
        if by_cell:
            marks = spark.createDataFrame(list(by_cell.items()), "cell long, marks array<long>")
            rows = rows.join(F.broadcast(marks), "cell", "left")
            parts = F.expr("coalesce(size(filter(marks, m -> m < key)), 0)")
        found = rows.groupBy("cell", parts.alias("part")).agg(
            F.min("key").alias("low"), F.max("key").alias("high"), F.sum("bytes").alias("bytes")
        )
        return [Range(r["low"], r["high"], r["bytes"], shift) for r in found.collect()]

    def refine(wide: list[Range]) -> list[Range]:
        bits = max(1, (MAX_SUMS // len(wide)).bit_length() - 1)
        finer = []
        for shift in {r.shift for r in wide}:
            cells = [(r.low >> shift, r.low, r.high) for r in wide if r.shift == shift]
            chosen = spark.createDataFrame(cells, "of long, first long, last long")
            inside = (F.shiftright("key", shift) == F.col("of")) & F.col("key").between(
                F.col("first"), F.col("last")
            )
            rows = cool.join(F.broadcast(chosen), inside).select("key", "bytes")
            finer += summed(rows, max(0, shift - bits))
        return finer

    ranges = summed(cool, 64 - (MAX_SUMS.bit_length() - 1)) + alone
    return sorted(ranges, key=lambda r: r.low), refine


def shard(
    docs: DataFrame, shards: int = 16, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    Slots number the rows of a shard without gaps, in the order of a hash of the row and, within
    the same hash bucket, of the id; no task numbers more than its share, however large a group.
    """
    spark = docs.sparkSession
    sized = write_once(
        docs.select(
            F.col(id),
            (F.octet_length(text_of(text)).cast("long") + 1).alias("size"),
            F.crc32(F.encode(text_of(text), "UTF-8")).alias("text_crc32"),
            F.xxhash64(text_of(text)).alias("key"),
            F.monotonically_increasing_id().alias("row_no"),
        )
    )
    groups = write_once(sized.groupBy("key").agg(F.sum("size").alias("bytes")))
    ranges, refine = group_ranges(groups)
    _, starts = minimax_starts(ranges, shards, refine)

    number = F.lit(0)
    for start in starts:
        number = number + (F.col("key") >= F.lit(start)).cast("int")
    buckets = shuffle_tasks(spark)
    placed = sized.select(
        "*",
        number.alias("shard"),
        F.pmod(F.xxhash64("row_no"), F.lit(buckets)).alias("bucket"),
    )
    # shards x buckets rows, whatever the number of documents
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    offsets = counts.selectExpr(
        "shard",
        "bucket",
        "sum(rows) over (partition by shard order by bucket) - rows as before",
    )
    slot = (
        "before + row_number() over "
        f"(partition by shard, bucket order by `{id}` nulls last, key, row_no) - 1"
    )
    return placed.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        id,
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.expr(slot).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
