"""Valid-time enrichment of sales (12): each sale with the version of its client that held when it was sold.

Sales and changes of clients come in batches, as one table of rows of both kinds, and go to a transformWithState query:
its state has, for each client, the versions in order and the sales that wait. Each batch brings clock rows, one for each
key, that carry both watermarks, so batches without other rows count too. For each key the processor tells late changes,
merges the others into its versions, emits the sales that the smaller watermark has passed (bisecting the versions of
their clients), lets the others wait, and then prunes: of the versions at or before the smaller watermark a client keeps
the last.

A key of the state is a shard of clients, and all clients of a shard are treated in one vectorized pass: a key a client
costs some calls over a socket for each client and batch (`shards=None` does so). A shard's ListStates
hold blocks of sorted rows rather than a row an entry, for the same reason. A client with more than `shard_rows` rows is
hot: its sales are dealt over several parts by a hash of their ids, and each part has its versions; fewer than HOT_KEYS
clients can be hot. What a task holds is a shard's rows of one batch and what it keeps, so the versions of one client
between two prunings have to fit.

Defined results: a sale without sold_at is emitted at once, without a version. A sale or change without a client belongs
to none: the sale has no version and n_held 0, the change can only be late. A change without valid_at is ignored; equal
rows of changes are one, equal rows of sales are as many sales. Versions of the same valid_at, seq and change_id stand in
the order of balance, then op; nulls come first in all orders. A null arrived_at counts as the last batch, a time before
the first batch as the first. Numbers of -2^63 stand for null. A balance that isn't finite, or has more cents than a long
holds, counts as null. Other columns, whatever their names, stay behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerloom.llm.shared import scratch, scratch_dir

BATCHES = 10
FIRST_DAY, DAYS = 19723, 152
#: Microseconds that a watermark stays behind the largest time seen.
DELAY = 36 * 3600 * 1_000_000
#: Rows of all batches that a shard has, about.
SHARD_ROWS = 50_000
HOT_KEYS = 65_536
#: Rows of an entry of a ListState.
BLOCK = 8192

NONE = -(1 << 63)
SALE, CHANGE, CLOCK = 0, 1, 2
#: A row of a batch. clock: id is the batch, at and seq are the watermarks of sales and changes, cents is 1 after the last.
ROWS = "kind tinyint, shard long, part int, client long, id long, at long, seq long, cents long, op string"
RESULT = "rec string, id long, batch long, n_held long, change_id long, balance_cents long, op string"
VERSIONS = pa.schema([(n, pa.int64()) for n in ("client", "at", "seq", "id", "cents")] + [("op", pa.string())])
WAITING = pa.schema([(n, pa.int64()) for n in ("client", "at", "id")])


def micros(time: str) -> Column:
    """Microseconds of a timestamp without a zone since 1970, whatever the session's zone."""
    day = F.datediff(F.col(time).cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    second = F.expr(f"extract(SECOND FROM `{time}`)") * 1_000_000
    return day * 86_400_000_000 + F.hour(time).cast("long") * 3_600_000_000 + F.minute(time).cast("long") * 60_000_000 + second.cast("long")


def batch_of(day: Column, batches: int = BATCHES, first: int = FIRST_DAY, days: int = DAYS) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(batches - 1), F.floor((day - first) * batches / days).cast("int")))


def sale_rows(sales: DataFrame, batch: Column) -> DataFrame:
    """Rows of sales (sale_id, client_id, sold_at), with `batch`."""
    null = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NONE))
    return sales.select(F.lit(SALE).cast("tinyint").alias("kind"), null("client_id").alias("client"), null("sale_id").alias("id"), F.coalesce(micros("sold_at"), F.lit(NONE)).alias("at"), F.lit(NONE).alias("seq"), F.lit(NONE).alias("cents"), F.lit(None).cast("string").alias("op"), batch.alias("batch"))


def change_rows(changes: DataFrame, batch: Column) -> DataFrame:
    """Rows of changes (change_id, client_id, seq, op, valid_at, balance), with `batch`."""
    null = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NONE))
    cents = F.floor(100 * F.col("balance") + 0.5)
    cents = F.when(F.abs("balance") < 9e16, cents)  # neither NaN nor an infinity
    known = changes.where(F.col("valid_at").isNotNull())
    return known.select(F.lit(CHANGE).cast("tinyint").alias("kind"), null("client_id").alias("client"), null("change_id").alias("id"), micros("valid_at").alias("at"), null("seq").alias("seq"), F.coalesce(cents, F.lit(NONE)).alias("cents"), F.col("op").cast("string").alias("op"), batch.alias("batch"))


def dealt(rows: DataFrame, shards: int | None, shard_rows: int) -> tuple[DataFrame, int | None, DataFrame | None, int]:
    """rows with shard and part, the number of shards, the parts there are but for part 0 (None: no client is hot), and
    the number of rows."""
    if shards is None:  # a key a client
        return rows.withColumn("shard", F.col("client")).withColumn("part", F.lit(0)), None, None, rows.count()
    spark = rows.sparkSession
    counts = scratch(rows.groupBy("client").agg(F.count("*").alias("n"), F.count_if(F.col("kind") == SALE).alias("sales")), "client-rows")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    shards = shards or max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // shard_rows)
    hot = counts.where((F.col("client") != NONE) & (F.col("n") > max(shard_rows, total // HOT_KEYS)))
    found = hot.select("client", F.greatest(F.lit(1), F.ceil(F.col("sales") / shard_rows)).cast("int").alias("parts")).collect()  # fewer than HOT_KEYS rows
    own = F.when(F.col("client") == NONE, F.xxhash64("id", "at")).otherwise(F.xxhash64("client"))
    rows = rows.withColumn("shard", F.pmod(own, F.lit(shards)))
    if not found:
        return rows.withColumn("part", F.lit(0)), shards, None, total
    table = spark.createDataFrame(found, "client long, parts int")
    rows = rows.join(F.broadcast(table), "client", "left")
    turn = 1 + F.pmod(F.xxhash64("id", "at"), F.col("parts")).cast("int")
    part = F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(F.col("kind") == SALE, F.array(turn)).otherwise(F.sequence(F.lit(1), F.col("parts")))
    keys = table.select(F.pmod(F.xxhash64("client"), F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(1), F.col("parts"))).alias("part")).distinct()
    return rows.withColumn("part", F.explode(part)).drop("parts"), shards, keys, total


def watermarks(rows: DataFrame, batches: int, delay: int) -> list[tuple[int, int]]:
    """For each batch the watermarks of sales and changes: a row a batch comes to the driver."""
    top = {(r["batch"], r["kind"]): r["at"] for r in rows.where(F.col("at") != NONE).groupBy("batch", "kind").agg(F.max("at").alias("at")).collect()}
    marks, most = [], [None, None]
    for b in range(batches):
        marks.append(tuple(NONE if m is None else m - delay for m in most))
        most = [max((x for x in (m, top.get((b, k))) if x is not None), default=None) for k, m in enumerate(most)]
    return marks


class Enrich(StatefulProcessor):
    """See the module. A group is a shard's rows of one batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions = handle.getListState("versions", "block binary")
        self.waiting = handle.getListState("waiting", "block binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        kind = new["kind"].to_numpy()
        clock = new[kind == CLOCK].iloc[0]
        batch, sold_to, valid_to, last = (int(clock[c]) for c in ("id", "at", "seq", "cents"))
        limit = min(sold_to, valid_to)
        changes, sales = new[kind == CHANGE], new[kind == SALE]

        late = changes["at"].to_numpy() < valid_to
        if key[1] <= 1 and late.any():  # each part has all changes of its client
            yield _late(changes["id"].to_numpy()[late], batch)
        versions = _merged(_loaded(self.versions, VERSIONS), changes[~late & (changes["client"].to_numpy() != NONE)])
        sales = pd.concat([_loaded(self.waiting, WAITING), sales[["client", "at", "id"]]], ignore_index=True)
        at = sales["at"].to_numpy()
        ready = np.full(len(at), True) if last == 1 else (at == NONE) | (at < limit)
        if ready.any():
            yield _enriched(sales[ready], versions, batch)
        _store(self.waiting, sales[~ready], WAITING)
        _store(self.versions, versions[_needed(versions, limit)], VERSIONS)

    def close(self) -> None:
        pass


def _loaded(state, schema: pa.Schema) -> pd.DataFrame:
    tables = [pa.ipc.open_stream(pa.py_buffer(block)).read_all() for (block,) in state.get()] if state.exists() else []
    return pa.concat_tables(tables or [schema.empty_table()]).to_pandas()


def _store(state, rows: pd.DataFrame, schema: pa.Schema) -> None:
    blocks = []
    for batch in pa.Table.from_pandas(rows, schema, preserve_index=False).to_batches(max_chunksize=BLOCK):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        blocks.append((sink.getvalue().to_pybytes(),))
    if blocks:
        state.put(blocks)
    elif state.exists():
        state.clear()


def _merged(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
    """Versions in the order of client, valid_at, seq, change_id, balance, op."""
    if new.empty:
        return old
    rows = pd.concat([old, new[VERSIONS.names]], ignore_index=True) if len(old) else new[VERSIONS.names]
    op = rows["op"].to_numpy()
    missing = rows["op"].isna().to_numpy()
    rank = np.unique(np.where(missing, "", op).astype(str), return_inverse=True)[1] + ~missing
    return rows.iloc[np.lexsort([rank, *(rows[c].to_numpy() for c in ("cents", "id", "seq", "at", "client"))])]


def _enriched(sales: pd.DataFrame, versions: pd.DataFrame, batch: int) -> pd.DataFrame:
    """Sales with the last version of their client at or before them: bisection, for all sales at once."""
    client, at = sales["client"].to_numpy(), sales["at"].to_numpy()
    own, valid = versions["client"].to_numpy(), versions["at"].to_numpy()
    first, end = np.searchsorted(own, client, "left"), np.searchsorted(own, client, "right")
    low, high = first.copy(), end.copy()
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) >> 1
        before = valid[middle] <= at[open_]
        low[open_[before]] = middle[before] + 1
        high[open_[~before]] = middle[~before]
    found = low > first
    pick = versions.iloc[np.maximum(low - 1, 0)[found]]
    out = {"rec": "sale", "id": _long(sales["id"].to_numpy()), "batch": batch, "n_held": end - first}
    for name, column in (("change_id", "id"), ("balance_cents", "cents")):
        values = np.full(len(client), NONE)
        values[found] = pick[column].to_numpy()
        out[name] = _long(values)
    op = np.full(len(client), None, object)
    op[found] = pick["op"].to_numpy()
    return pd.DataFrame(out | {"op": op})


def _late(ids: np.ndarray, batch: int) -> pd.DataFrame:
    nothing = pd.array([None] * len(ids), "Int64")
    return pd.DataFrame({"rec": "late", "id": _long(ids), "batch": batch, "n_held": nothing, "change_id": nothing, "balance_cents": nothing, "op": np.full(len(ids), None, object)})


def _long(values: np.ndarray):
    return pd.arrays.IntegerArray(values.astype(np.int64), values == NONE)


def _needed(versions: pd.DataFrame, limit: int) -> np.ndarray:
    """False for versions that a later one of their client at or before the limit replaces."""
    own, valid = versions["client"].to_numpy(), versions["at"].to_numpy()
    keep = np.full(len(own), True)
    keep[:-1] = (own[1:] != own[:-1]) | (valid[1:] > limit)
    return keep


#: What the state store needs, beside what the session has: its one provider with list states, and no instance that
#: stays in memory after its task, since each start of the query makes new ones.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
}
#: On a shared folder that is mounted (file:), Spark's usual manager of checkpoint files starts processes for each file it
#: writes; this one, which renames through the FileSystem, doesn't.
MOUNTED = {"spark.sql.streaming.checkpointFileManagerClass": "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"}
#: Rows of a staged file, about.
FILE_ROWS = 200_000


def enrich(rows: DataFrame, batches: int = BATCHES, delay: int = DELAY, shards: int | None = 0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Feeds rows (kind, client, id, at, seq, cents, op, batch) batch by batch to the query and gives what it emitted.
    shards: keys of the state, by default as many as the rows need; None: a key for each client."""
    spark = rows.sparkSession
    base = f"{scratch_dir(spark)}/sale-enrichment-{uuid.uuid4().hex}"
    if rows.isEmpty():
        return spark.createDataFrame([], RESULT)
    placed, shards, parts, total = dealt(rows, shards, shard_rows)
    names = [x.split()[0] for x in ROWS.split(", ")]
    pieces = max(1, total // FILE_ROWS)  # few files a batch: a stream lists each
    spread = placed.select(*names, "batch").repartition(max(pieces, int(spark.conf.get("spark.sql.shuffle.partitions"))), "batch", F.pmod(F.xxhash64("id", "part"), F.lit(pieces)))
    spread.write.partitionBy("batch").parquet(f"{base}/staged")
    staged = spark.read.schema(f"{ROWS}, batch int").parquet(f"{base}/staged")
    marks = watermarks(staged, batches, delay)
    fs_path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = fs_path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(f"{base}/in"))
    if shards is None:
        keys = staged.select("shard", "part").distinct()
        keys.write.parquet(f"{base}/keys")  # the staged rows move
        keys = spark.read.schema("shard long, part int").parquet(f"{base}/keys")
    else:
        keys = spark.range(shards).select(F.col("id").alias("shard"), F.lit(0).alias("part"))
        keys = (keys if parts is None else keys.unionByName(parts)).coalesce(1 + shards // FILE_ROWS)
    settings = STATE | (MOUNTED if fs.getUri().getScheme() == "file" else {})
    held = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for b in range(batches + 1):
            sold, valid = marks[b] if b < batches else (NONE, NONE)
            clock = {"kind": F.lit(CLOCK).cast("tinyint"), "client": F.lit(NONE), "id": F.lit(b).cast("long"), "at": F.lit(sold), "seq": F.lit(valid), "cents": F.lit(int(b == batches)).cast("long"), "op": F.lit(None).cast("string")}
            keys.withColumns(clock).select(*names).write.mode("append").parquet(f"{base}/staged/batch={b}")
            fs.rename(fs_path(f"{base}/staged/batch={b}"), fs_path(f"{base}/in/{b:05d}"))
            _feed(spark, base)
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    fs.delete(fs_path(f"{base}/in"), True)
    return spark.read.schema(RESULT).parquet(f"{base}/out")


def _feed(spark: SparkSession, base: str) -> None:
    """One start of the query: takes in what is new under `in`, and ends."""
    rows = spark.readStream.schema(ROWS).option("recursiveFileLookup", True).parquet(f"{base}/in")
    found = rows.groupBy("shard", "part").transformWithStateInPandas(Enrich(), RESULT, "Append", "None")
    found.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start(f"{base}/out").awaitTermination()


def batched(sales: DataFrame, changes: DataFrame) -> DataFrame:
    """The rows of both tables with their batches, as the contract of op12 cuts them."""
    day = lambda time: F.datediff(F.col(time).cast("date"), F.lit("1970-01-01").cast("date"))
    later = F.coalesce(F.crc32(F.col("change_id").cast("string").cast("binary")) % 4, F.lit(0)).cast("int")
    changes = changes.where(F.col("valid_at").isNotNull()).distinct()
    return sale_rows(sales, batch_of(day("arrived_at"))).unionByName(change_rows(changes, batch_of(day("valid_at") + later)))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: all sales with their versions, and late changes."""
    return enrich(batched(spark.read.parquet(f"{sf_dir}/sales.parquet"), spark.read.parquet(f"{sf_dir}/client_changes.parquet")))


#: The same by windows: what is unpruned at a batch follows from the last version that the batch before it has pruned to.
SQL = f"""
WITH c0 AS (SELECT DISTINCT * FROM client_changes WHERE valid_at IS NOT NULL),
crc AS (SELECT change_id, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(change_id::VARCHAR) + 1), lambda i: [ascii(substr(change_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda a, v: xor(xor(a, v) >> 1, (xor(a, v) & 1) * 3988292384)), 4294967295) & 3 AS later FROM (SELECT DISTINCT change_id FROM c0 WHERE change_id IS NOT NULL)),
c1 AS (SELECT c0.*, greatest(0, least({BATCHES} - 1, floor((date_diff('day', DATE '1970-01-01', valid_at::DATE) + coalesce(later, 0) - {FIRST_DAY}) * {BATCHES} / {DAYS})))::BIGINT AS b FROM c0 LEFT JOIN crc USING (change_id)),
s1 AS (SELECT row_number() OVER () AS rn, sale_id, client_id, sold_at, greatest(0, least({BATCHES} - 1, floor((date_diff('day', DATE '1970-01-01', arrived_at::DATE) - {FIRST_DAY}) * {BATCHES} / {DAYS})))::BIGINT AS b FROM sales),
marks AS (SELECT b, (SELECT max(sold_at) FROM s1 WHERE s1.b < t.b) - INTERVAL 36 HOUR AS ws, (SELECT max(valid_at) FROM c1 WHERE c1.b < t.b) - INTERVAL 36 HOUR AS wc FROM range({BATCHES}) t(b)),
limits AS (SELECT b, wc, CASE WHEN ws IS NOT NULL AND wc IS NOT NULL THEN least(ws, wc) END AS h FROM marks),
c2 AS (SELECT c1.*, coalesce(valid_at < wc, false) AS late FROM c1 JOIN limits USING (b)),
held AS (SELECT client_id, b, valid_at, change_id, balance, op, row_number() OVER (PARTITION BY client_id ORDER BY valid_at, seq NULLS FIRST, change_id NULLS FIRST, floor(100 * balance + 0.5) NULLS FIRST, op NULLS FIRST) AS place FROM c2 WHERE NOT late AND client_id IS NOT NULL),
sold AS (SELECT s1.*, coalesce((SELECT min(l.b) FROM limits l WHERE l.b >= s1.b AND (sold_at IS NULL OR sold_at < l.h)), {BATCHES}) AS e FROM s1),
asked AS (SELECT DISTINCT client_id, e FROM sold WHERE client_id IS NOT NULL),
cut AS (SELECT a.client_id, a.e, coalesce(max(v.place) FILTER (WHERE v.b < a.e AND v.valid_at <= l.h), 0) AS low FROM asked a JOIN held v USING (client_id) LEFT JOIN limits l ON l.b = a.e - 1 GROUP BY ALL),
kept AS (SELECT c.e, c.low, v.* FROM cut c JOIN held v USING (client_id) WHERE v.b = c.e OR v.b < c.e AND v.place >= c.low),
counted AS (SELECT client_id, e, count(*) AS n_held FROM kept GROUP BY ALL),
matched AS (SELECT s.rn, arg_max({{'change_id': change_id, 'cents': floor(100 * balance + 0.5)::BIGINT, 'op': op}}, place) AS v FROM sold s JOIN kept k ON k.client_id = s.client_id AND k.e = s.e AND k.valid_at <= s.sold_at GROUP BY s.rn)
SELECT 'sale' AS rec, sale_id AS id, e::BIGINT AS batch, coalesce(n_held, 0)::BIGINT AS n_held, v.change_id AS change_id, v.cents AS balance_cents, v.op AS op FROM sold LEFT JOIN counted USING (client_id, e) LEFT JOIN matched USING (rn)
UNION ALL SELECT 'late', change_id, b, NULL, NULL, NULL, NULL FROM c2 WHERE late
"""
