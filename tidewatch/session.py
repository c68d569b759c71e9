"""Session settings the engine is meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

CONF = {
    # timestamps carry no zone; UTC keeps conversions of them neutral
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # joins whose inputs come straight from a shuffle are split where a key is hot
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # and hashed instead of sorted where every partition of one side is seen to be small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # refreshes replace only the partitions they write
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a build runs a few hundred distinct stages; keep their compiled code
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.ui.enabled": "false",
}


def local_session(
    cpus: int, shuffle_partitions: int | None = None, **conf: str
) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tidewatch")
    settings = {
        **CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cpus),
        "spark.driver.memory": "8g",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
