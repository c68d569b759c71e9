"""Label synonyms from distinctive keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import norm_key


def distinctive_keywords(partners: DataFrame) -> DataFrame:
    """The first word of each partner's name that no other partner's name has."""
    words = partners.select("partner_id", F.posexplode(F.split(norm_key("partner_name"), " +")))
    owned = (
        words.filter(F.col("col") != "")
        .groupBy(F.col("col").alias("keyword"))
        .agg(
            F.min("partner_id").alias("partner_id"),
            F.max("partner_id").alias("_last"),
            F.min("pos").alias("_pos"),
        )
        .filter(F.col("partner_id") == F.col("_last"))
    )
    return owned.groupBy("partner_id").agg(F.min_by("keyword", "_pos").alias("keyword"))


def build_synonyms(labels: DataFrame, keywords: DataFrame) -> DataFrame:
    """Maps each distinct raw label to the partner whose keyword it contains.

    One row per label: the partner if exactly one keyword fits, else null, and whether the
    label is mapped, ambiguous or unmapped.

    "Contains" is turned into equality: a label offers its substrings of the lengths that
    keywords have, and these are equi-joined with the keywords. No label is compared with
    every keyword.
    """
    distinct = labels.filter(F.col("label_raw").isNotNull()).select("label_raw").distinct()
    keys = keywords.select(norm_key("keyword").alias("keyword"), "partner_id")
    keys = keys.filter(F.col("keyword") != "")
    lengths = keys.select(F.length("keyword").alias("n")).distinct()
    # one row: the lengths, at most as many as the longest keyword has letters
    pieces = (
        distinct.withColumns(
            {
                "_text": norm_key("label_raw"),
                "_n": lengths.agg(F.collect_set("n")).scalar(),
            }
        )
        .withColumn("_n", F.explode("_n"))
        .filter("length(_text) >= _n")
        .withColumn("_at", F.explode(F.expr("sequence(1, length(_text) - _n + 1)")))
        .selectExpr("label_raw", "substring(_text, _at, _n) as keyword")
        .distinct()
    )
    fits = (
        pieces.join(keys, "keyword")
        .groupBy("label_raw")
        .agg(
            F.min("partner_id").alias("partner_id"),
            F.count_distinct("partner_id").alias("partners"),
        )
    )
    n = F.coalesce(F.col("partners"), F.lit(0))
    return distinct.join(fits, "label_raw", "left").select(
        "label_raw",
        F.when(n == 1, F.col("partner_id")).alias("partner_id"),
        n.alias("partners"),
        F.when(n == 1, "mapped").when(n > 1, "ambiguous").otherwise("unmapped").alias("outcome"),
    )
