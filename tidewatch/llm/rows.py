"""Taking rows out of a table of texts without shuffling the texts that stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bloom import filter_bits, member_filter, passes
from tidewatch.llm.shared import all_of, content_hash, fresh, text_of


def row_key(id: str = "doc_id", text: str = "text") -> Column:
    """What tells rows apart: a hash of id and text. Rows equal in both are one document."""
    return F.xxhash64(F.col(id), text_of(text))


def excluding(rows: DataFrame, gone: DataFrame, key: str = "key") -> DataFrame:
    """``rows`` without those whose ``key`` is in ``gone``; only rows its Bloom filter holds shuffle.

    ``gone`` is a stored table with the column ``key``.
    """
    columns, flag = all_of(rows.columns), fresh(rows, "__listed")
    bits = filter_bits(gone.count())
    rows = passes(rows, key, member_filter(gone, key, bits), bits, flag)
    moving = rows.filter(flag).join(gone.select(key).distinct(), key, "left_anti")
    return rows.filter(~F.col(flag)).select(*columns).unionByName(moving.select(*columns))


def without(
    docs: DataFrame,
    removed: DataFrame,
    repeated: DataFrame | None = None,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` without the rows whose key is in ``removed``, and each in ``repeated`` once.

    Both have one column, key, and are stored or cheap. All other rows stay as often as they occur.
    Their Bloom filter is broadcast (64 MB at most, see bloom.py); rows that it does not hold stay
    where they are, only the others shuffle.
    """
    columns = all_of(docs.columns)
    key, flag = fresh(docs, "__row_key"), fresh(docs, "__listed")
    listed = removed if repeated is None else removed.unionByName(repeated)
    bits = filter_bits(listed.count())
    rows = passes(
        docs.withColumn(key, row_key(id, text)), key, member_filter(listed, "key", bits), bits, flag
    )
    moving = rows.filter(flag)

    def keys(of: DataFrame) -> DataFrame:
        return of.select(F.col("key").alias(key)).distinct()

    staying = rows.filter(~F.col(flag)).select(*columns)
    by_chance = moving.join(keys(listed), key, "left_anti").select(*columns)
    kept = staying.unionByName(by_chance)
    if repeated is None:
        return kept
    # grouped before the joins, so that rows with one key are combined before they shuffle
    once = moving.groupBy(key).agg(F.min_by(F.struct(*columns), content_hash(docs)).alias(flag))
    once = once.join(keys(repeated), key, "left_semi").join(keys(removed), key, "left_anti")
    return kept.unionByName(once.select(f"{flag}.*"))
