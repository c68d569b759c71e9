"""Tables clustered by key: bucketed within each partition, with an index of where keys are.

The index (``<table>_places``) holds the key and the partition of every row, bucketed like the table. It may
hold partitions a key has left, never lacks one a key is in: a merge adds places before it changes
the table, so a driver that dies in between leaves no key that is not found.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Clustering:
    """How a catalog table is clustered, and its folder if that is not the warehouse's."""

    table: str
    key: str
    partition: str
    buckets: int
    path: str | None = None

    @property
    def places(self) -> str:
        return f"{self.table}_places"

    def deal(self, df: DataFrame) -> DataFrame:
        """Rows dealt as they lie in the buckets: joins with the table move no row of the table."""
        return df.repartition(self.buckets, self.key)

    def write(self, df: DataFrame) -> DataFrame:
        """Replaces the table and its index by the rows of ``df``; one file per bucket of a partition."""
        spark = df.sparkSession
        self._save(self.deal(df), self.table, self.path, self.partition)
        self.write_places(spark)
        return spark.table(self.table)

    def write_places(self, spark: SparkSession) -> None:
        """Derives the index from the table again, without the places keys have left."""
        rows = spark.table(self.table).select(self.key, self.partition)
        self._save(self.deal(rows), self.places, self.path and f"{self.path}_places")

    def add_places(self, rows: DataFrame) -> None:
        self._save(
            self.deal(rows.select(self.key, self.partition)),
            self.places,
            self.path and f"{self.path}_places",
            mode="append",
        )

    def _save(
        self, df: DataFrame, name: str, path: str | None, partition: str | None = None, mode: str = "overwrite"
    ) -> None:
        writer = df.write.format("parquet").mode(mode).bucketBy(self.buckets, self.key).sortBy(self.key)
        if partition is not None:
            writer = writer.partitionBy(partition)
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(name)

    def find(self, rows: DataFrame) -> DataFrame:
        """Key and partition of every place a key of ``rows`` is, or was, in. The index stays where it is."""
        keys = self.deal(rows.select(self.key).distinct())
        return rows.sparkSession.table(self.places).join(keys, self.key, "left_semi")


def write_clustered(
    df: DataFrame, name: str, key: str, partition: str, buckets: int, path: str | None = None
) -> DataFrame:
    """Replaces a catalog table, partitioned by ``partition`` and clustered by ``key`` within.

    ``key`` is unique, so buckets are even. Take as many buckets as the keys of all partitions need tasks:
    each partition has up to that many files.
    """
    return Clustering(name, key, partition, buckets, path).write(df)


def clustering_of(spark: SparkSession, table: str, partition: str) -> Clustering | None:
    """How a table is clustered, from the catalog; None if it is not, or has no index."""
    if not spark.catalog.tableExists(f"{table}_places"):
        return None
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    columns = told.get("Bucket Columns", "[]").strip("[]").split(", ")
    if len(columns) != 1 or not columns[0]:
        return None
    path = told["Location"] if told.get("Type") == "EXTERNAL" else None
    return Clustering(table, columns[0].strip("`"), partition, int(told["Num Buckets"]), path)
