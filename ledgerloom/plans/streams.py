"""Queries that run streams: each table is staged in runs, and the query is started anew for each run on one checkpoint."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ledgerloom.plans.registry import query, table
from ledgerloom.sources import jsonl
from ledgerloom.streaming import incremental, jobs, logs, sinks
from ledgerloom.streaming.feed import KEYED_STATE, Feed, appended

RUNS = 4
#: Seconds after which a job that says nothing is taken for lost.
SILENCE = 2 * 86_400
_STATUSES = ("running", "stopping", "succeeded", "failed", "killed", "running", "running")


def _by_time(rows: DataFrame, order: str, runs: int = RUNS) -> DataFrame:
    """rows with `run`, in the order of a number: as many runs of equal width."""
    most = rows.agg(F.coalesce(F.max(order), F.lit(0))).head()[0]
    return rows.withColumn("run", F.least(F.lit(runs - 1), F.floor(F.col(order) * runs / (most + 1))).cast("int"))


# Jobs.


def _job_events(spark, sf) -> DataFrame:
    e = F.col("event_id")
    status = F.element_at(F.array(*map(F.lit, _STATUSES)), (F.floor(e / 10) % 7 + 1).cast("int"))
    return table(spark, sf, "events").select((F.col("user_id") * 2 + e % 2).cast("string").alias("job"), "event_id", F.col("ts").cast("timestamp").alias("at"), status.alias("status"))


_JOBS = f"""WITH RECURSIVE e AS (SELECT CAST(user_id * 2 + event_id % 2 AS VARCHAR) AS job, event_id, ts, CASE event_id // 10 % 7 {" ".join(f"WHEN {k} THEN '{s}'" for k, s in enumerate(_STATUSES))} END AS status,
      row_number() OVER (PARTITION BY user_id * 2 + event_id % 2 ORDER BY ts, event_id) AS k FROM events),
    s AS (SELECT job, 0::BIGINT AS k, NULL::VARCHAR AS now, NULL::TIMESTAMP AS heard, NULL::TIMESTAMP AS lost, NULL::BIGINT AS event_id, NULL::TIMESTAMP AS ts, NULL::VARCHAR AS status, false AS applied FROM e WHERE k = 1
      UNION ALL SELECT job, k, CASE WHEN ok THEN status ELSE before END, ts, CASE WHEN gone THEN heard + INTERVAL {SILENCE} SECOND END, event_id, ts, status, ok FROM (
        SELECT *, (before IS NULL AND status IN ('running', 'failed')) OR (before = 'running' AND status IN ('stopping', 'succeeded', 'failed', 'killed')) OR coalesce(before = 'stopping' AND status IN ('killed', 'failed'), false) AS ok FROM (
          SELECT s.job, e.k, e.event_id, e.ts, e.status, s.heard, coalesce(s.now IN ('running', 'stopping') AND e.ts > s.heard + INTERVAL {SILENCE} SECOND, false) AS gone,
            CASE WHEN s.now IN ('running', 'stopping') AND e.ts > s.heard + INTERVAL {SILENCE} SECOND THEN 'orphaned' ELSE s.now END AS before FROM s JOIN e ON e.job = s.job AND e.k = s.k + 1))),
    ends AS (SELECT job, heard + INTERVAL {SILENCE} SECOND AS due FROM s QUALIFY row_number() OVER (PARTITION BY job ORDER BY k DESC) = 1 AND now IN ('running', 'stopping'))
    SELECT job, event_id, epoch_us(ts) AS us, status, CASE WHEN applied THEN 'applied' ELSE 'refused' END AS verdict FROM s WHERE k > 0
    UNION ALL SELECT job, NULL, epoch_us(lost), 'orphaned', 'timed out' FROM s WHERE lost IS NOT NULL
    UNION ALL SELECT job, NULL, epoch_us(due), 'orphaned', 'timed out' FROM ends WHERE due < (SELECT max(ts) FROM events)"""


@query(_JOBS)
def job_state_stream(spark, sf):
    feed = Feed(_by_time(_job_events(spark, sf), "event_id"), "job-events")
    found = appended([feed], RUNS, lambda events: jobs.changes(events, SILENCE), KEYED_STATE)
    return found


# Requests and answers.

_WAIT, _DELAY = 600, 60
#: Requests of a slice for each core: what waits for its answer is held in the executors' memory, about 750 bytes a request.
SLICE = 250_000


@query(
    f"""WITH o AS (SELECT o_orderkey, least({RUNS - 1}, floor(o_orderkey * {RUNS} / ((SELECT max(o_orderkey) FROM orders) + 1))) AS run FROM orders)
    SELECT o_orderkey, o_orderkey % 5 IN (1, 4) OR (o_orderkey % 5 = 3 AND run > 0) AS answered FROM o"""
)
def request_answers_stream(spark, sf):
    """By key modulo 5: no answer, one twice (the second in the run after), one that comes after the wait, one of the first
    run that arrives two runs late, and one in time. Requests and answers are one feed, by key, so that a slice of a run holds
    the answers to its own requests, and those that come runs late come with the same slice of a later run."""
    k, m = F.col("o_orderkey"), F.col("o_orderkey") % 5
    orders = table(spark, sf, "orders").select("o_orderkey")
    slices = max(1, math.ceil(orders.count() / (RUNS * SLICE * spark.sparkContext.defaultParallelism)))
    after = lambda s: F.timestamp_seconds(F.lit(1_700_000_000) + k + s)
    ask = F.struct(F.lit(False).alias("answer"), after(0).alias("at"), F.col("run"))
    one = lambda s, late: F.struct(F.lit(True).alias("answer"), after(s).alias("at"), (F.col("run") + late * slices).alias("run"))
    said = F.when(m == 0, F.array(ask)).when(m == 1, F.array(ask, one(10, 0), one(20, 1))).when(m == 2, F.array(ask, one(_WAIT + 300, 0))).when((m == 3) & (F.col("run") < slices), F.array(ask, one(10, 2))).otherwise(F.array(ask, one(10, 0)))
    far = F.timestamp_seconds(F.lit(4_000_000_000))  # moves both watermarks past all there is
    last = spark.range(2).select(F.lit(-1).cast("bigint").alias("o_orderkey"), (F.col("id") == 1).alias("answer"), far.alias("at"), F.lit((RUNS + 1) * slices).alias("run"))
    rows = _by_time(orders, "o_orderkey", RUNS * slices).select("o_orderkey", F.inline(said)).unionByName(last)
    answers = lambda rows: incremental.answers(rows.where("NOT answer"), rows.where("answer"), "o_orderkey", f"{_WAIT} seconds", f"{_DELAY} seconds")
    found = appended([Feed(rows, "asks")], RUNS + 2, answers, slices=slices)
    return found.where("o_orderkey >= 0").select("o_orderkey", F.col("answered").isNotNull().alias("answered"))


# Sinks.


@query("SELECT CASE WHEN event_id % 3 <> 0 THEN 'train' ELSE 'failed' END AS side, count(*) AS n, sum(event_id)::BIGINT AS ids, true AS flushed FROM events GROUP BY 1")
def train_failed_sinks(spark, sf):
    """The second batch breaks off between its two sinks once, and comes again."""
    rows = table(spark, sf, "events").select("event_id", "event_type")
    feed = Feed(_by_time(rows, "event_id"), "outcomes")
    train, failed, every = f"{feed.base}/train", f"{feed.base}/failed", 50
    broken = []

    def crash(number: int) -> None:
        if number == 1 and not broken:
            broken.append(number)
            raise RuntimeError("planted")

    for n in range(RUNS):
        feed.release(n)
        for _ in range(2):
            try:
                sinks.split_sinks(feed.stream(), F.col("event_id") % 3 != 0, train, failed, f"{feed.base}/state", every, crash)
                break
            except Exception as error:  # the stream's error holds the planted one
                if "planted" not in str(error):
                    raise
    out = None
    for side, path in (("train", train), ("failed", failed)):
        files = sinks.written(spark, path, "event_id long, event_type string").groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
        one = files.agg(F.sum("n").alias("n"), F.sum("ids").alias("ids"), F.max("n").alias("most")).where("n IS NOT NULL").select(F.lit(side).alias("side"), "n", "ids", (F.col("most") <= every).alias("flushed"))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    """WITH q AS (SELECT count(*) // 2 AS total FROM (SELECT DISTINCT user_id * 7 + event_id % 7 AS k FROM events)),
    r AS (SELECT least(3, floor(event_id * 4 / ((SELECT max(event_id) FROM events) + 1))) AS run, user_id * 7 + event_id % 7 AS k, event_id FROM events),
    f AS (SELECT k, arg_min(event_id, (run, event_id)) AS event_id FROM r GROUP BY 1)
    SELECT k, event_id FROM f ORDER BY event_id LIMIT (SELECT total FROM q)"""
)
def soft_quota_stream(spark, sf):
    rows = table(spark, sf, "events").select((F.col("user_id") * 7 + F.col("event_id") % 7).alias("k"), "event_id")
    total = rows.select("k").distinct().count() // 2
    feed = Feed(_by_time(rows, "event_id"), "accepted")
    for n in range(RUNS):
        feed.release(n)
        sinks.soft_quota(feed.stream(), "k", f"{feed.base}/taken", f"{feed.base}/state", total, "event_id")
    return spark.read.schema("k long, event_id long, batch long").parquet(f"{feed.base}/taken").select("k", "event_id")


# Log lines.

_TAIL = 20


@query(
    f"""WITH l AS (SELECT CAST(user_id AS VARCHAR) AS job, event_id AS seq, event_type AS line FROM events), a AS (SELECT job, seq AS since, 's' || CAST(seq AS VARCHAR) AS subscriber FROM l WHERE seq % 50 = 7),
    x AS (SELECT a.subscriber, l.*, l.seq > a.since AS later, row_number() OVER (PARTITION BY a.subscriber, l.seq > a.since ORDER BY l.seq DESC) AS t FROM a JOIN l USING (job))
    SELECT subscriber, job, CASE WHEN later THEN 'line' ELSE 'snapshot' END AS kind, seq, line FROM x WHERE later OR t <= {_TAIL}"""
)
def log_fan_out(spark, sf):
    lines = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("job"), F.col("event_id").alias("seq"), F.col("event_type").alias("line"), F.lit(None).cast("string").alias("subscriber"))
    asks = lines.where("seq % 50 = 7").withColumn("subscriber", F.concat(F.lit("s"), F.col("seq").cast("string"))).withColumn("line", F.lit(None).cast("string"))
    feed = Feed(_by_time(lines.unionByName(asks), "seq"), "log-lines")
    return appended([feed], RUNS, lambda rows: logs.fan_out(rows, _TAIL), KEYED_STATE)


# Folders of runs, and label sources.


def _runs(spark, sf) -> DataFrame:
    k = F.col("s_suppkey")
    status = F.element_at(F.array(*map(F.lit, ("running", "succeeded", "failed", "stopping", "killed"))), (k % 5 + 1).cast("int"))
    return table(spark, sf, "supplier").select(F.format_string("run-%08d", k).alias("run"), k.cast("string").alias("id"), F.lit("flow").alias("flow"), F.col("s_name").alias("label"), status.alias("status"), F.when(k % 5 == 1, 0).cast("int").alias("exit_code"), F.lit("2024-01-01T00:00:00Z").alias("started_at"), F.lit(None).cast("string").alias("ended_at"))


@query(
    """SELECT printf('run-%08d', s_suppkey) AS run, CASE WHEN s_suppkey % 7 <> 0 THEN s_name END AS label, s_suppkey % 7 = 0 AS torn,
    CASE WHEN s_suppkey % 7 <> 0 THEN CASE s_suppkey % 5 WHEN 1 THEN 'succeeded' WHEN 2 THEN 'failed' WHEN 4 THEN 'killed' ELSE 'orphaned' END END AS status, 2::BIGINT AS lines FROM supplier"""
)
def run_folders(spark, sf):
    """Runs written as folders and read again: each seventh meta file is torn, those that had not ended are orphaned, and
    logs come in two batches."""
    from ledgerloom.operators import views
    from ledgerloom.sources import runfolders

    path = jsonl.scratch(spark, "runs").removeprefix("file://")
    runs = _runs(spark, sf)
    runfolders.by_run(runs).write.format("runs").mode("append").option("path", path).save()
    torn = runs.where("CAST(id AS BIGINT) % 7 = 0").select("run")
    tear(path, torn)
    lines = runs.select("run", F.inline(F.array(*[F.struct(F.lit(n).cast("bigint").alias("number"), F.format_string("line %d", F.lit(n)).alias("line"), F.lit(n).alias("run_no")) for n in range(2)])))
    feed = Feed(lines.withColumnRenamed("run_no", "n"), "run-lines", "n")
    for n in range(2):
        feed.release(n)
        runfolders.by_run(feed.stream()).writeStream.format("runs").option("path", path).option("checkpointLocation", f"{feed.base}/state").trigger(availableNow=True).start().awaitTermination()
    meta, log = runfolders.read_runs(spark, path), runfolders.read_runs(spark, path, "log").groupBy("run").agg(F.count("*").alias("lines"))
    status = F.when(F.col("status").isNotNull(), views.after_restart(F.col("status")))
    return meta.join(log, "run", "left").select("run", "label", "torn", status.alias("status"), "lines")


def tear(path: str, runs: DataFrame) -> None:
    """Cuts the meta files of some runs short, in tasks."""
    from ledgerloom.sources.runfolders import _folder, _put

    def cut(rows) -> None:
        _, system, at = _folder(path)
        for row in rows:
            _put(system, f"{at}/{row['run']}/meta.json", '{"id": "')

    runs.foreachPartition(cut)


@query(
    """WITH a AS (SELECT o_orderkey, o_orderkey % 25 % 4 AS m FROM orders), n AS (SELECT *, CASE m WHEN 1 THEN 2 WHEN 3 THEN 4 ELSE 1 END AS times FROM a)
    SELECT o_orderkey, t::INTEGER AS attempt, CASE m WHEN 1 THEN CASE WHEN t = 0 THEN 'ThrottlingException' END WHEN 2 THEN 'AccessDenied' WHEN 3 THEN 'ThrottlingException' END AS code,
    m = 0 OR (m = 1 AND t = 1) AS has_output FROM (SELECT *, unnest(range(times)) AS t FROM n)"""
)
def label_attempts(spark, sf):
    """Orders ask a fixture of nations, by key modulo 4 with an error that passes, one that doesn't, and one that stays."""
    from ledgerloom.sources import labels

    said = ('{"raw_output": "ok"}', '{"raw_output": "ok", "error": "ThrottlingException", "times": 1}', '{"error": "AccessDenied"}', '{"error": "ThrottlingException"}')
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    lines = {r["n_name"]: said[r["n_nationkey"] % 4] for r in nations.collect()}  # a fixture of 25 lines
    asks = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 25).alias("n_nationkey")).join(F.broadcast(nations), "n_nationkey").select("o_orderkey", "n_name")
    found = labels.attempts(asks, "n_name", "fake", {"fixture": lines}, base=0.0)
    return found.select("o_orderkey", "attempt", "code", F.col("raw_output").isNotNull().alias("has_output"))
