"""Incremental forms: deduplicated intake from a growing folder, stall guard, latest states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.operators import reconcile


def intake(spark: SparkSession, path: str, schema, key: str, order: str, checkpoint: str, table: str, files_a_trigger: int = 1000, target: int | None = None) -> None:
    """Adds rows of new files under `path` whose key is not in `table` (a folder of Parquet) yet: of a batch, for each
    key the row with the least `order`. target: no more rows are added once the table has so many, the first of a batch
    by `order` fill it up. Runs until all files there are taken in; run it again for more. The keys taken in are looked up in the table
    itself, so no state grows in the query; a batch that is repeated after a failure adds nothing twice."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isFile():  # a source is a folder
        rows = reader.option("pathGlobFilter", hadoop.getName()).parquet(hadoop.getParent().toString())
    else:
        rows = reader.parquet(path)

    def add(batch: DataFrame, _: int) -> None:
        fresh = reconcile.first_seen(batch, F.col(key), order)
        have = 0
        if exists(spark, table):
            held = spark.read.schema(schema).parquet(table)
            fresh = fresh.join(held.select(key), key, "left_anti")
            have = held.count() if target is not None else 0
        if target is not None:
            fresh = fresh.orderBy(order).limit(max(0, target - have))
        fresh.write.mode("append").parquet(table)

    rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop) and bool(fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*.parquet")))


def deduplicated(stream: DataFrame, key: str, time: str, delay: str = "1 hour") -> DataFrame:
    """A stream with one row of each key within the delay; state goes when the watermark passes."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def runs(events: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Runs of equal values in the order of each key: key, value, run's first order, length."""
    w = Window.partitionBy(key).orderBy(order)
    island = F.row_number().over(w) - F.row_number().over(Window.partitionBy(key, value).orderBy(order))
    return events.withColumn("__island", island).groupBy(key, value, "__island").agg(F.min(order).alias("first"), F.count("*").alias("length")).drop("__island")


def stalls(events: DataFrame, key: str, order: str, value: str, stalled, least: int) -> DataFrame:
    """Keys with a run of `stalled` values of `least` or more, and where the first such run begins: there a run of work
    would have stopped."""
    return runs(events, key, order, value).where((F.col(value) == F.lit(stalled)) & (F.col("length") >= least)).groupBy(key).agg(F.min("first").alias("stopped_at"))


def stops(batches: DataFrame, key: str, order: str, found: str, failed: str, limit: int = 3) -> DataFrame:
    """Where each worker stops: at the `limit`-th batch in a row without a new input, or in a row that failed. batches:
    key, order, found (new inputs), failed (boolean). key, reason (empty_batches or error_batches), stopped_at."""
    state = F.when(F.col(failed), "error_batches").when(F.col(found) == 0, "empty_batches").otherwise("fine")
    seen = runs(batches.withColumn("__state", state).withColumn("__turn", F.row_number().over(Window.partitionBy(key).orderBy(order))), key, "__turn", "__state")
    ends = seen.where((F.col("__state") != "fine") & (F.col("length") >= limit)).groupBy(key).agg(F.min(F.struct((F.col("first") + limit - 1).alias("at"), F.col("__state").alias("reason"))).alias("__e"))
    return ends.select(key, F.col("__e.reason").alias("reason"), F.col("__e.at").alias("stopped_at"))


def correlated(requests: DataFrame, responses: DataFrame, key: str, asked: str, answered: str, wait: str = "10 minutes") -> DataFrame:
    """Each request with the response of its id, if that comes within `wait`. On streams both sides need a watermark,
    which bounds the state; tables join the same way."""
    right = responses.withColumnRenamed(key, "__id")
    near = (F.col(key) == F.col("__id")) & (F.col(answered) >= F.col(asked)) & (F.col(answered) <= F.col(asked) + F.expr(f"INTERVAL {wait}"))
    return requests.join(right, near, "left").drop("__id")


def answers(asked: DataFrame, said: DataFrame, key: str, wait: str = "10 minutes", delay: str = "1 minute") -> DataFrame:
    """Streams of requests and of answers (key, at) to key, asked, answered: each request with its answer if one comes
    within `wait`, with null once the watermark says that none will. Both sides have a watermark `delay` behind, which
    bounds what is held: requests that wait, and the ids of answers, so that an answer that comes again within the delay
    and the wait counts once. An answer that comes after its watermark is dropped."""
    left = asked.select(key, F.col("at").alias("asked")).withWatermark("asked", delay)
    right = said.select(F.col(key).alias("__id"), F.col("at").alias("answered")).withWatermark("answered", delay).dropDuplicatesWithinWatermark(["__id"])
    near = (F.col(key) == F.col("__id")) & (F.col("answered") >= F.col("asked")) & (F.col("answered") <= F.col("asked") + F.expr(f"INTERVAL {wait}"))
    return left.join(right, near, "left").drop("__id")
