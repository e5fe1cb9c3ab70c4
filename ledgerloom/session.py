"""A local session with the settings that the library expects; on a cluster the cluster's own session is used."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "ledgerloom", master: str = "local[*]", partitions: int = 8, memory: str = "8g", scratch: str | None = None) -> SparkSession:
    """scratch: a folder for tables between steps; operators use one of their own where a local session names none."""
    builder = (
        SparkSession.builder.master(master)
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = (builder.config("spark.checkpoint.dir", scratch) if scratch else builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
