"""Feeding a stream run by run: a table is staged by run once, and each run is moved under the stream's folder as a whole,
so a query that is started again on its checkpoint takes in what is new and ends."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.sources.jsonl import scratch


class Feed:
    """The runs of a table: `rows` has a column `run` with 0, 1, ...; stream() reads what has been released."""

    def __init__(self, rows: DataFrame, name: str, run: str = "run") -> None:
        self.spark: SparkSession = rows.sparkSession
        self.base, self.run = scratch(self.spark, name), run
        self.schema = rows.drop(run).schema
        cores = self.spark.sparkContext.defaultParallelism
        spread = F.pmod(F.xxhash64(*rows.columns), F.lit(cores))  # no run is one task's work
        rows.repartition(cores, run, spread).write.partitionBy(run).parquet(f"{self.base}/staged")
        path = self._path(self.base)
        self.fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(self._path(f"{self.base}/in"))

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def release(self, n: int) -> bool:
        """Moves run n, if it has rows, under the stream's folder; a folder is moved whole or not at all."""
        held = self._path(f"{self.base}/staged/{self.run}={n}")
        return self.fs.exists(held) and self.fs.rename(held, self._path(f"{self.base}/in/{n:06d}"))

    def stream(self, files_a_trigger: int | None = None) -> DataFrame:
        reader = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", True)
        reader = reader if files_a_trigger is None else reader.option("maxFilesPerTrigger", files_a_trigger)
        return reader.parquet(f"{self.base}/in")


@contextmanager
def held(spark: SparkSession, base: str, settings: dict[str, str] | None = None) -> Iterator[None]:
    """The session with some settings, and what it had before afterwards. base: where checkpoints stand."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    mounted = path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"
    settings = (settings or {}) | (MOUNTED if mounted else {})
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def appended(feeds: list[Feed], runs: int, query: Callable[..., DataFrame], settings: dict[str, str] | None = None, slices: int = 1) -> DataFrame:
    """What a streaming query emits over all runs: it is started anew for each, on one checkpoint. query: from the feeds'
    streams to the streaming frame. settings: of the session, while it runs. slices: of a run; the feed then counts slices,
    n * slices and on for run n, and each is released when the one before it has been taken in and what the watermark has
    passed is gone, so the state of a query with a watermark is that of a slice. Only one feed can be released so: of two, a
    batch may begin when one alone has been, and move the watermark past rows of the other."""
    if slices > 1 and len(feeds) > 1:
        raise ValueError("slices are of one feed")
    spark, base = feeds[0].spark, feeds[0].base
    with held(spark, base, settings):
        for n in range(runs):
            if slices == 1:
                for feed in feeds:
                    feed.release(n)
            found = query(*(feed.stream() for feed in feeds))
            writer = found.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/state")
            if slices == 1:
                writer.trigger(availableNow=True).start(f"{base}/out").awaitTermination()
                continue
            started = writer.start(f"{base}/out")
            try:
                for k in range(n * slices, (n + 1) * slices):
                    if feeds[0].release(k):
                        started.processAllAvailable()
            finally:
                started.stop()
    return spark.read.schema(found.schema).parquet(f"{base}/out")


#: What list states and timers need of the session.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
#: On a shared folder that is mounted (file:), Spark's usual manager of checkpoint files starts processes for each file it
#: writes; this one, which renames through the FileSystem, doesn't.
MOUNTED = {"spark.sql.streaming.checkpointFileManagerClass": "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"}
