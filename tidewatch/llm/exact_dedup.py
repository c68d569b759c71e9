"""Exact dedup: two-pass Bloom filtering, after which only possibly repeated rows shuffle.

Texts are equal when they are identical after every run of white space (space, tab to carriage
return) became one space. A null text counts as empty. Of equal texts the row with the smallest
id stays, a null id coming last; rows that repeat both id and text are copies like any other, one
of them stays. An empty table gives an empty result. Texts are compared whole, by SHA-256.

The filter has 16 bits per row and at most 64 MB, which is what is broadcast. Beyond 33 million rows
it fills up: more rows that occur once are shuffled then, and the result stays the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bloom import MAX_BITS, filter_bits, passes, repeat_filter
from tidewatch.llm.shared import all_of, attach, content_hash, fresh, text_of, write_once

SPACES = r"[\x20\x09-\x0D]+"


def text_hash(text: str = "text") -> Column:
    """SHA-256 of the normalised text in UTF-8, lowercase hex."""
    return F.sha2(F.regexp_replace(text_of(text), SPACES, " "), 256)


def copy_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: the id that stays for its text, the size of its group, its hash.

    Columns: the id, keep_id, group_size, kept, text_sha256. Hashes are computed once and written
    to the shared folder, with a row number that tells repeated rows apart.
    """
    hashed = write_once(
        docs.select(
            F.col(id),
            F.unhex(text_hash(text)).alias("sha"),
            F.monotonically_increasing_id().alias("row_no"),
        ).withColumn("key", F.xxhash64("sha"))
    )
    total = hashed.count()
    bits = filter_bits(total, max_bits)
    rows = passes(hashed, "key", repeat_filter(hashed, "key", bits), bits, "maybe").drop("key")

    straight = rows.filter("not maybe").select(
        F.col(id),
        F.col(id).alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "sha",
    )
    suspects = rows.filter("maybe")
    first = F.min(F.struct(F.col(id).isNull().alias("last"), F.col(id).alias("id"), "row_no"))
    groups = suspects.groupBy("sha").agg(first.alias("keep"), F.count("*").alias("group_size"))
    grouped = attach(suspects, groups, "sha", "group_size", total).select(
        F.col(id),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("keep.row_no")).alias("kept"),
        "sha",
    )
    return straight.unionByName(grouped).select(
        id, "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def exact_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """The documents without copies, in the columns of ``docs``.

    Rows that cannot be repeated pass straight through; possibly repeated ones are reduced to one
    row per text by an aggregate that combines before its shuffle. Of rows with equal id and text
    the one with the smallest hash of all its columns stays.
    """
    columns = all_of(docs.columns)
    key, flag, sha, kept = (fresh(docs, x) for x in ("__key", "__maybe", "__sha", "__row"))
    hashes = docs.select(F.xxhash64(F.unhex(text_hash(text))).alias("key"))
    bits = filter_bits(docs.count(), max_bits)
    rows = docs.withColumn(sha, F.unhex(text_hash(text))).withColumn(key, F.xxhash64(sha))
    rows = passes(rows, key, repeat_filter(hashes, "key", bits), bits, flag)
    straight = rows.filter(~F.col(flag)).select(*columns)
    order = F.struct(F.col(id).isNull(), F.col(id), content_hash(docs))
    single = rows.filter(flag).groupBy(sha).agg(F.min_by(F.struct(*columns), order).alias(kept))
    return straight.unionByName(single.select(f"{kept}.*"))
