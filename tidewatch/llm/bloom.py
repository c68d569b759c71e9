"""Two-pass Bloom filtering: which 64-bit hashes may occur more than once.

The first pass counts hits per filter position; the positions hit twice or more make a second
filter of bitmaps. A hash that occurs twice hits its positions twice, so it always passes; one
that occurs once passes only if other hashes hit both of its positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.shared import all_of, fresh

#: bits of the filter per hash, and in all: 2**29 bits are 64 MB, the most that is broadcast
BITS_PER_HASH = 16
MAX_BITS = 1 << 29
#: bits of one bitmap, as built by bitmap_construct_agg
BITMAP_BITS = 32768


def filter_bits(hashes: int, max_bits: int = MAX_BITS) -> int:
    """Size of the filter, a power of two."""
    wanted = max(BITMAP_BITS, hashes * BITS_PER_HASH)
    return min(max_bits, 1 << (wanted - 1).bit_length())


def positions(key: Column, bits: int) -> list[Column]:
    """The two positions of a hash: its lower and its upper half."""
    mask = F.lit(bits - 1)
    return [key.bitwiseAND(mask), F.shiftrightunsigned(key, 32).bitwiseAND(mask)]


def repeat_filter(hashes: DataFrame, key: str, bits: int) -> DataFrame:
    """Bitmaps (bucket, bitmap) of the positions hit at least twice; ``bits`` / 8 bytes at most."""
    hits = hashes.select(F.explode(F.array(*positions(F.col(key), bits))).alias("position"))
    twice = hits.groupBy("position").count().filter("count > 1")
    return twice.groupBy(F.shiftright("position", 15).alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(position & {BITMAP_BITS - 1})").alias("bitmap")
    )


def member_filter(hashes: DataFrame, key: str, bits: int) -> DataFrame:
    """Bitmaps of all positions that the hashes hit: a plain Bloom filter."""
    hits = hashes.select(F.explode(F.array(*positions(F.col(key), bits))).alias("position"))
    return hits.groupBy(F.shiftright("position", 15).alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(position & {BITMAP_BITS - 1})").alias("bitmap")
    )


def passes(rows: DataFrame, key: str, bitmaps: DataFrame, bits: int, flag: str) -> DataFrame:
    """Adds ``flag``: whether both positions of ``key`` are set. Rows stay where they are."""
    columns = all_of(rows.columns)
    both = F.lit(True)
    for n, position in enumerate(positions(F.col(key), bits)):
        names = (f"__{flag}_{x}{n}" for x in ("place", "bucket", "bitmap"))
        place, bucket, bitmap = (fresh(rows, name) for name in names)
        side = bitmaps.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap))
        rows = rows.withColumn(place, position).join(
            F.broadcast(side), F.shiftright(place, 15) == F.col(bucket), "left"
        )
        bit = F.col(place).bitwiseAND(F.lit(BITMAP_BITS - 1)).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(bitmap), F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10)
        is_set = F.getbit(byte.cast("int"), bit.bitwiseAND(F.lit(7))) == 1
        both = both & F.coalesce(is_set, F.lit(False))
    return rows.select(*columns, both.alias(flag))


def as_bytes(bitmaps: DataFrame, bits: int) -> bytes:
    """The filter as one run of bits, for tasks that test it themselves; ``bits`` / 8 bytes."""
    whole = bytearray(bits // 8)
    width = BITMAP_BITS // 8
    for row in bitmaps.toLocalIterator():
        whole[row["bucket"] * width : (row["bucket"] + 1) * width] = row["bitmap"]
    return bytes(whole)
