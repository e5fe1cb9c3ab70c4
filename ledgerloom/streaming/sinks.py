"""One stream into two tables, each row once, whatever fails in between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.sources import blocks
from ledgerloom.sources.jsonl import found
from ledgerloom.streaming.feed import held


def split_sinks(rows: DataFrame, kept: Column, train: str, failed: str, checkpoint: str, flush_every: int = 50, between: Callable[[int], None] | None = None) -> None:
    """Writes the rows of a stream that `kept` holds for to the folder `train` and the others to `failed`, as JSON Lines
    of `flush_every` rows a file at most, and runs until all there is has been taken in. kept: null counts as false.

    A batch replaces its own part of both folders. If it breaks off after one sink, it comes again under its number with
    the same rows, so neither loses a row or has one twice. between: called with the batch's number between the sinks."""
    side = F.coalesce(kept, F.lit(False))

    def write(batch: DataFrame, number: int) -> None:
        marked = batch.withColumn("__kept", side).persist()
        try:
            for k, (path, own) in enumerate(((train, F.col("__kept")), (failed, ~F.col("__kept")))):
                if k and between:
                    between(number)
                blocks.write(marked.where(own).drop("__kept"), f"{path}/batch={number}", flush_every)
        finally:
            marked.unpersist()

    with held(rows.sparkSession, checkpoint):
        rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def written(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What a sink holds, with the number of the batch."""
    return spark.read.schema(f"{schema}, batch long").json(path)


def soft_quota(rows: DataFrame, key: str, table: str, checkpoint: str, total: int, order: str) -> None:
    """Takes rows of a stream into a folder until it has `total` different keys. Each batch looks at the total alone:
    sources share the work by a plan, but none is held to its share, and the last batch is cut to what is still asked
    for, the least by `order`. A batch that comes again takes the same rows, and later ones nothing once the total is
    met."""
    spark = rows.sparkSession

    def add(batch: DataFrame, number: int) -> None:
        fresh = batch.groupBy(key).agg(F.min_by(F.struct(*[c for c in batch.columns if c != key]), order).alias("__r")).select(key, "__r.*").select(*batch.columns)
        have = 0
        if found(spark, f"{table}/batch=*"):
            held = spark.read.schema(batch.schema.add("batch", "long")).parquet(table).where(F.col("batch") < number)
            fresh = fresh.join(held.select(key), key, "left_anti")
            have = held.count()
        if have < total:
            fresh.orderBy(order).limit(total - have).select(*batch.columns).write.mode("overwrite").parquet(f"{table}/batch={number}")

    rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
