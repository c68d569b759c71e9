"""Keyed lookups: one row per key, and joins to them that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import norm_key


def nulls_last(columns: Sequence[str]) -> Column:
    """Sort key over several columns in which a null comes after every value.

    Structs order nulls first, so each column is preceded by its null flag.
    """
    return F.struct(*(part for c in columns for part in (F.col(c).isNull(), F.col(c))))


def first_per_key(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    keep: Sequence[str],
    count_as: str | None = None,
) -> DataFrame:
    """The first row of each non-null key, with the number of rows it stands for.

    An aggregate instead of row_number over a window: every task reduces its rows to one
    candidate per key before the shuffle, so a key that holds a third of the rows costs
    no more than any other, and the count comes out of the same pass.
    """
    chosen = F.min_by(F.struct(*keep), nulls_last(order_by)).alias("_chosen")
    counted = [F.count("*").alias(count_as)] if count_as else []
    picked = df.filter(F.col(key).isNotNull()).groupBy(key).agg(chosen, *counted)
    return picked.select(key, "_chosen.*", *([count_as] if count_as else []))


def investor_by_email(investors: DataFrame) -> DataFrame:
    """One investor per e-mail: earliest registration first, then the smallest id."""
    return first_per_key(
        investors.withColumnRenamed("partner_id", "investor_partner_id"),
        "email",
        ["created_at", "investor_id"],
        ["investor_id", "investor_partner_id"],
        "investor_match_count",
    )


def manager_by_email(managers: DataFrame) -> DataFrame:
    return first_per_key(
        managers.withColumnRenamed("partner_id", "rm_partner_id"),
        "rm_email",
        ["rm_id"],
        ["rm_id", "rm_partner_id"],
        "rm_match_count",
    )


def label_lookup(synonyms: DataFrame) -> DataFrame:
    """Partner per normalised label; spellings that normalise alike collapse to one row."""
    return first_per_key(
        synonyms.select(
            norm_key("label_raw").alias("label_norm"),
            "label_raw",
            F.col("partner_id").alias("label_partner_id"),
        ),
        "label_norm",
        ["label_raw", "label_partner_id"],
        ["label_partner_id"],
    )


def identity_lookup(investors: DataFrame, managers: DataFrame) -> DataFrame:
    """Both registries under one e-mail key, so that tickets are shuffled by e-mail once.

    Same rules per registry as ``investor_by_email`` and ``manager_by_email``; one
    aggregate over the union of the two serves both. Columns of a registry that does not
    know the e-mail are null.
    """
    is_investor = F.col("_rank_investor").isNotNull()
    people = investors.select(
        "email",
        F.struct("investor_id", F.col("partner_id").alias("investor_partner_id")).alias("_investor"),
        nulls_last(["created_at", "investor_id"]).alias("_rank_investor"),
    ).unionByName(
        managers.select(
            F.col("rm_email").alias("email"),
            F.struct("rm_id", F.col("partner_id").alias("rm_partner_id")).alias("_rm"),
            nulls_last(["rm_id"]).alias("_rank_rm"),
        ),
        allowMissingColumns=True,
    )
    return (
        people.filter(F.col("email").isNotNull())
        .groupBy("email")
        .agg(
            F.min_by("_investor", "_rank_investor").alias("_investor"),
            F.nullif(F.count(F.when(is_investor, 1)), F.lit(0)).alias("investor_match_count"),
            F.min_by("_rm", "_rank_rm").alias("_rm"),
            F.nullif(F.count(F.when(~is_investor, 1)), F.lit(0)).alias("rm_match_count"),
        )
        .select("email", "_investor.*", "investor_match_count", "_rm.*", "rm_match_count")
    )


def hot_keys(rows: DataFrame, **keys: Sequence[Column]) -> DataFrame:
    """(hash, salts): keys of ``rows`` with more rows than a task's fair share.

    ``keys`` gives each kind of key a name and its columns; all kinds are counted in one pass,
    combined before the shuffle. As a hot key holds more than one part in as many as there are
    shuffle tasks, there are fewer hot keys of a kind than tasks. ``salts`` is the number of tasks
    its rows need for none to get more than a fair share.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    offered = [
        F.struct(
            F.lit(number).alias("name"),  # of fixed width: the key of the count is two numbers
            F.when(
                reduce(and_, (c.isNotNull() for c in columns)), F.xxhash64(F.lit(name), *columns)
            ).alias("hash"),
        )
        for number, (name, columns) in enumerate(keys.items())
    ]
    counts = (
        rows.select(F.inline(F.array(*offered)))
        .filter("hash is not null")
        .groupBy("name", "hash")
        .agg(F.count("*").alias("rows"))
    )
    totals = counts.groupBy("name").agg(F.sum("rows").alias("of_all"))  # a row per kind
    return (
        counts.join(F.broadcast(totals), "name")
        .filter(f"rows * {tasks} > of_all")
        .selectExpr("hash", f"int(ceil(rows * {tasks} / of_all)) as salts")
    )


def spread_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread_by: str,
    hot: DataFrame | None = None,
    kind: str = "key",
) -> DataFrame:
    """Left join of ``facts`` to a lookup with one row per key, without a hot task.

    Rows of a hot key are spread over as many tasks as its share needs, and only its lookup row is
    copied, once per task. Rows without a key match nothing and are spread over all tasks. The
    salt is a hash of ``spread_by``, hence the same when a lost task is run again.

    ``hot`` (hash, salts) are the hot keys of ``facts`` as ``hot_keys`` finds them, if they were
    counted elsewhere, such as on the staged rows that ``facts`` was joined from; ``kind`` is the
    name they have there. Of a kind there are fewer than shuffle tasks, which bounds what is
    broadcast. Several lookups that use the same ``hot`` share its count and its broadcast.
    """
    on = list(on)
    if hot is None:
        hot = hot_keys(facts, **{kind: [F.col(c) for c in on]})
    hot = F.broadcast(hot.select(F.col("hash").alias("_hash"), F.col("salts").alias("_salts")))
    keyless = reduce(or_, (F.col(c).isNull() for c in on))
    spread = F.xxhash64(F.col(spread_by))
    salt = F.when(keyless, spread).otherwise(
        F.coalesce(F.pmod(spread, F.col("_salts")), F.lit(0)).cast("long")
    )
    key = F.xxhash64(F.lit(kind), *(F.col(c) for c in on))
    left = facts.withColumn("_key", key).join(hot, F.col("_key") == F.col("_hash"), "left")
    right = lookup.withColumn("_key", key).join(hot, F.col("_key") == F.col("_hash"), "left")
    every_salt = F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)).cast("long") - 1)
    helpers = ("_key", "_hash", "_salts")
    return (
        left.withColumn("_salt", salt)
        .drop(*helpers)
        .join(
            right.withColumn("_salt", F.explode(every_salt)).drop(*helpers),
            [*on, "_salt"],
            "left",
        )
        .drop("_salt")
    )
