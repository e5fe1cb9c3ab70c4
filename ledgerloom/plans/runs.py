"""Queries over files and runs: JSON Lines in and out, fixtures, resumed intake, evaluation in full, run metrics.

Files are written from typed columns to the scratch folder first, so what reading them must give is known from those."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import jsonx, text as tx
from ledgerloom.functions.amounts import with_amounts
from ledgerloom.operators import audit, evalreport, metrics, reconcile, schedule, select, validate, views
from ledgerloom.plans.registry import query, table
from ledgerloom.sources import jsonl
from ledgerloom.streaming import incremental


def _written(rows: DataFrame, name: str) -> str:
    """rows (one column of lines) as a folder of text files."""
    path = jsonl.scratch(rows.sparkSession, name)
    rows.write.text(path)
    return path


def _lines(spark, sf) -> DataFrame:
    """Orders as JSON lines with a planted fault by key modulo 7."""
    k = F.col("o_orderkey")
    said = F.format_string("%d tea", k)
    forms = [
        F.format_string('{"input": "%s", "output": {"transactions": []}}', said), F.format_string('{"input": "%s", "output"', said), F.lit('{"input": 5, "output": {}}'),
        F.lit('{"input": "  ", "output": {}}'), F.format_string('{"input": "%s", "output": "x"}', said), F.lit("[1]"), F.lit(" "),
    ]
    return table(spark, sf, "orders").orderBy("o_orderkey").select(F.coalesce(*[F.when(k % 7 == n, f) for n, f in enumerate(forms)]).alias("value"))


# Files.


@query("SELECT count(CASE WHEN o_orderkey % 7 IN (0, 4) THEN 1 END) AS ok, count(CASE WHEN o_orderkey % 7 = 1 THEN 1 END) AS bad_json, count(CASE WHEN o_orderkey % 7 IN (2, 3, 5) THEN 1 END) AS bad_shape FROM orders")
def jsonl_inputs(spark, sf):
    return jsonl.inputs_summary(jsonl.read_lines(spark, _written(_lines(spark, sf), "inputs")))


@query("SELECT CASE o_orderkey % 7 WHEN 1 THEN 'bad_json' WHEN 2 THEN 'bad_input' WHEN 4 THEN 'bad_output' WHEN 5 THEN 'bad_input' END AS malformed, count(*) AS n FROM orders WHERE o_orderkey % 7 <> 6 GROUP BY 1")
def jsonl_malformed(spark, sf):
    return jsonl.parsed(jsonl.read_lines(spark, _written(_lines(spark, sf), "lines"))).groupBy("malformed").agg(F.count("*").alias("n"))


@query("SELECT event_id, row_number() OVER (ORDER BY event_id) AS line FROM events")
def jsonl_line_numbers(spark, sf):
    rows = table(spark, sf, "events").orderBy("event_id").select(F.to_json(F.struct("event_id")).alias("value"))
    lines = jsonl.line_numbers(jsonl.read_lines(spark, _written(rows, "numbered")), start=1)
    return lines.select(F.try_variant_get(F.try_parse_json("raw"), "$.event_id", "bigint").alias("event_id"), "line")


@query("SELECT DISTINCT CAST(o_orderkey AS VARCHAR) || ' tea' AS input FROM orders WHERE o_orderkey % 7 IN (0, 4)")
def jsonl_labelled(spark, sf):
    return jsonl.labelled_inputs(jsonl.read_lines(spark, _written(_lines(spark, sf).unionByName(_lines(spark, sf)), "labelled")))


@query(
    """SELECT 'now' AS state, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'bak', count(*), sum(c_custkey)::BIGINT FROM customer
    UNION ALL SELECT 'appended', 2 * count(*), 2 * sum(c_custkey)::BIGINT FROM customer"""
)
def jsonl_rewrite(spark, sf):
    path, log = jsonl.scratch(spark, "rewritten"), jsonl.scratch(spark, "appended")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name")
    jsonl.write(rows, path)
    read = lambda p: jsonl.read_strict(spark, p, "c_custkey long, c_name string")
    jsonl.rewrite(read(path).where("c_custkey % 3 = 0"), path)
    jsonl.write(rows, log, append=True)
    jsonl.write(rows, log, append=True)
    count = lambda p, state: read(p).agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys")).select(F.lit(state).alias("state"), "n", "keys")
    return count(path, "now").unionByName(count(f"{path}.bak", "bak")).unionByName(count(log, "appended"))


@query("SELECT count(*) AS n, sum(n_nationkey)::BIGINT AS keys, 0::BIGINT AS missing FROM nation")
def json_array_file(spark, sf):
    path = jsonl.scratch(spark, "array")
    rows = table(spark, sf, "nation").agg(F.to_json(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("value"))  # a small file that holds one array
    rows.write.text(path)
    found = jsonl.read_array(spark, path, "n_nationkey long, n_name string").agg(F.count("*").alias("n"), F.sum("n_nationkey").alias("keys"))
    return found.withColumn("missing", F.lit(jsonl.read_array(spark, f"{path}-none", "a long").count()).cast("long"))


@query(
    """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 0 ELSE 1 END::INTEGER AS kept, CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 1 ELSE 2 END::INTEGER AS dropped FROM orders"""
)
def response_lines(spark, sf):
    good, k = '{"input": "a", "output": {}}', F.col("o_orderkey")
    said = F.when(k % 3 == 0, F.lit(f"```json\n{good}\n\n{good}\noops\n```")).when(k % 3 == 1, F.lit("Sorry, no.")).otherwise(F.lit(f'{good}\n{{"input": "b"}}\n[]'))
    return table(spark, sf, "orders").select("o_orderkey", F.size(jsonl.response_rows(said)).alias("kept"), jsonl.response_dropped(said).alias("dropped"))


@query("SELECT CAST(p_partkey AS VARCHAR) || ' part' AS input, CASE WHEN p_partkey % 2 = 0 THEN 'raw ' || CAST(p_size AS VARCHAR) ELSE '{\"n\":' || CAST(p_size AS VARCHAR) || '}' END AS label FROM part")
def fixture_labels(spark, sf):
    k = F.col("p_partkey")
    later = F.when(k % 2 == 0, F.format_string('{"input": "%d part", "raw_output": "raw %d"}', k, F.col("p_size"))).otherwise(F.format_string('{"input": "%d part", "output": {"n": %d}}', k, F.col("p_size")))
    rows = table(spark, sf, "part").orderBy("p_partkey").select(F.explode(F.array(F.format_string('{"input": "%d part", "raw_output": "old"}', k), later)).alias("value"))
    return jsonl.fixture_labels(jsonl.read_lines(spark, _written(rows, "fixture")))


@query("WITH f AS (SELECT n_name AS input, row_number() OVER (ORDER BY n_nationkey) - 1 AS slot FROM nation) SELECT o_orderkey, input FROM orders JOIN f ON slot = o_orderkey % 25")
def fixture_cursor(spark, sf):
    rows = table(spark, sf, "nation").orderBy("n_nationkey").select(F.to_json(F.struct(F.col("n_name").alias("input"))).alias("value"))
    fixture = jsonl.read_inputs(jsonl.read_lines(spark, _written(rows, "cursor"))).select("ord", "input")
    return jsonl.cursor(fixture, table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("SELECT count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS x FROM documents) WHERE regexp_matches(x, '[^ \\t-\\r]')")
def nonblank_lines(spark, sf):
    return views.line_count(table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("line")), "line")


@query("SELECT md5(x) AS line, min(doc_id) AS doc_id FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents) GROUP BY x")
def exact_lines(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return views.distinct_lines(lines, "line", "doc_id").withColumn("line", F.md5("line"))


# Text of paths, times and numbers.


_QUANTS = "CASE p_partkey % 4 WHEN 0 THEN 'Q4_K_M' WHEN 1 THEN 'Q8_0' WHEN 2 THEN 'F16' ELSE 'TUNED' END"


def _paths(spark, sf) -> DataFrame:
    k = F.col("p_partkey")
    quant = F.element_at(F.array(*map(F.lit, ("q4_k_m", "Q8_0", "f16", "tuned"))), (k % 4 + 1).cast("int"))
    folder = F.when(k % 3 == 0, F.format_string("/models/student-m%d/gguf/", k % 5)).otherwise(F.lit("/other/"))
    end = F.when(k % 7 == 0, ".txt").otherwise(".gguf")
    return table(spark, sf, "part").select("p_partkey", F.concat(folder, F.format_string("app-base%d-", k % 2), quant, end).alias("path"))


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'm' || CAST(p_partkey % 5 AS VARCHAR) ELSE 'base' || CAST(p_partkey % 2 AS VARCHAR) || CASE WHEN p_partkey % 4 = 3 THEN '-tuned' ELSE '' END END AS model, {_QUANTS} AS quant FROM part")
def model_and_quant(spark, sf):
    model, quant = tx.model_and_quant(F.col("path"), "app-")
    return _paths(spark, sf).select("p_partkey", model.alias("model"), quant.alias("quant"))


@query("SELECT p_partkey FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 3 = 0 AND p_partkey % 5 IN (1, 2) AND p_partkey % 4 = 0")
def discover_models(spark, sf):
    return evalreport.discover(_paths(spark, sf), "path", ("m1", "m2"), "q4_k").select("p_partkey")


@query(
    """SELECT event_id, CASE WHEN s >= 3600 THEN CAST(s // 3600 AS VARCHAR) || 'h' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's'
      WHEN s >= 60 THEN CAST(s // 60 AS VARCHAR) || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' ELSE CAST(s AS VARCHAR) || 's' END AS took,
    strftime(make_timestamp(event_id * 9973 * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS at, 'run-' || lpad(CAST(event_id AS VARCHAR), 6, '0') AS batch,
    greatest(0, (event_id % 5 - 1) * 1000)::BIGINT AS ms, CAST(event_id * 1000 AS DOUBLE) AS value
    FROM (SELECT event_id, event_id * 7 % 9000 AS s FROM events)"""
)
def times_and_numbers(spark, sf):
    e = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id", tx.duration(e * 7 % 9000).alias("took"), tx.iso_utc((e * 9973).cast("double")).alias("at"), tx.batch_id(F.lit("run"), e).alias("batch"),
        tx.clamped_ms(F.lit(1.0), (e % 5).cast("double")).alias("ms"), tx.number(F.concat(e.cast("string"), F.lit(",000"))).alias("value"),
    )


# Failed rows.


def _failed(spark, sf) -> DataFrame:
    e = F.col("event_id")
    reason = F.when(e % 5 != 4, F.element_at(F.array(*map(F.lit, (*select.REASON_ORDER, "x"))), (e % 5 + 1).cast("int")))
    attempt = F.struct(F.when(e % 3 != 0, F.when(e % 3 == 1, "currency_mismatch").otherwise("provider_error")).alias("failure_reason"), F.col("event_type").alias("provider"), F.lit("m").alias("model"), (e % 4).cast("string").alias("raw_output"), F.lit(False).alias("is_repair_attempt"))
    key = F.when(e % 6 != 0, F.col("user_id"))
    return table(spark, sf, "events").select("event_id", key.alias("key"), reason.alias("reason"), F.array(attempt).alias("attempts"))


_REASON = "CASE event_id % 5 WHEN 0 THEN 'validation_failed' WHEN 1 THEN 'repair_exhausted' WHEN 2 THEN 'all_candidates_failed' WHEN 3 THEN 'provider_error' ELSE 'unknown' END"


@query(
    f"""SELECT 'row' AS level, {_REASON} AS reason, NULL AS provider, count(*) AS n FROM events GROUP BY 2
    UNION ALL SELECT 'attempt', CASE event_id % 3 WHEN 1 THEN 'currency_mismatch' WHEN 2 THEN 'provider_error' ELSE 'unknown' END, event_type, count(*) FROM events GROUP BY 2, 3"""
)
def failure_counters(spark, sf):
    return select.reason_counts(_failed(spark, sf))


@query(
    f"""WITH k AS (SELECT user_id, min(CASE event_id % 5 WHEN 4 THEN 99 ELSE event_id % 5 END) AS r FROM events WHERE event_id % 6 <> 0 GROUP BY 1)
    SELECT reason, sum(n)::BIGINT AS n FROM (SELECT {_REASON.replace('event_id % 5', 'r')} AS reason, count(*) AS n FROM k GROUP BY 1
    UNION ALL SELECT {_REASON}, count(*) FROM events WHERE event_id % 6 = 0 GROUP BY 1) GROUP BY 1"""
)
def reasons_after_dedupe(spark, sf):
    """Rows without a key stay, each for itself."""
    merged = reconcile.merge_failed(_failed(spark, sf), "key", "event_id")
    return merged.groupBy(F.coalesce("reason", F.lit("unknown")).alias("reason")).agg(F.count("*").alias("n"))


@query(
    """SELECT count(*) AS n, count(CASE WHEN event_id % 5 = 0 OR event_id % 3 = 1 THEN 1 END) AS validation, count(CASE WHEN event_id % 5 <> 4 THEN 1 END) AS legacy,
    count(CASE WHEN event_id % 4 IN (1, 2) THEN 1 END) AS by_status, count(CASE WHEN event_id % 3 IN (0, 1) THEN 1 END) AS by_code, count(CASE WHEN event_id % 3 = 2 THEN 1 END) AS all_provider FROM events"""
)
def failure_predicates(spark, sf):
    e, r, a = F.col("event_id"), F.col("reason"), F.col("attempts")
    status = F.element_at(F.array(*map(F.lit, (404, 429, 503, 400))), (e % 4 + 1).cast("int"))
    code = F.when(e % 3 == 1, "ThrottlingException").when(e % 3 == 2, "AccessDenied")
    why = select.top_reason(F.transform(a, lambda x: F.coalesce(x["failure_reason"], F.lit(""))), False)
    return _failed(spark, sf).agg(
        F.count("*").alias("n"), F.count_if(select.is_validation_row(r, a)).alias("validation"), F.count_if(select.skipped_legacy(r)).alias("legacy"),
        F.count_if(select.is_retryable(status)).alias("by_status"), F.count_if(select.is_retryable_code(code)).alias("by_code"), F.count_if(why == "provider_error").alias("all_provider"),
    )


@query("SELECT count(*) AS attempted, count(CASE WHEN event_id % 5 = 0 THEN 1 END) AS kept, count(CASE WHEN event_id % 5 = 0 THEN 1 END)::DOUBLE / greatest(count(*), 1) AS rate FROM events")
def keep_rate(spark, sf):
    found = table(spark, sf, "events").agg(F.count("*").alias("attempted"), F.count_if(F.col("event_id") % 5 == 0).alias("kept"))
    return found.withColumn("rate", metrics.keep_rate(F.col("kept"), F.col("attempted")))


@query("SELECT event_id, least(30.0, 0.5 * power(2.0, event_id % 10))::DOUBLE AS seconds FROM events")
def retry_delays(spark, sf):
    return table(spark, sf, "events").select("event_id", schedule.backoff(F.col("event_id") % 10, 0.5, 30.0).alias("seconds"))


@query("SELECT m AS mode, count(*) AS n, count(CASE WHEN m = 'warn' OR event_id % 2 = 0 THEN 1 END) AS ok, count(CASE WHEN event_id % 2 = 1 THEN 1 END) AS with_errors FROM events, (VALUES ('strict'), ('warn')) v(m) GROUP BY 1")
def validator_modes(spark, sf):
    error = F.struct(F.lit("AMOUNT_NOT_IN_INPUT").alias("code"), F.lit("/transactions/0/amount").alias("path"), F.lit("error").alias("severity"))
    errors = F.when(F.col("event_id") % 2 == 1, F.array(error)).otherwise(F.array().cast(validate.ERRORS))
    rows = table(spark, sf, "events").select(errors.alias("errors"))
    one = lambda mode: rows.select(F.lit(mode).alias("mode"), validate.result(F.col("errors"), mode).alias("r")).groupBy("mode").agg(F.count("*").alias("n"), F.count_if("r.ok").alias("ok"), F.count_if(F.size("r.errors") > 0).alias("with_errors"))
    return one("strict").unionByName(one("warn"))


# Evaluation.


def _results(spark, sf) -> DataFrame:
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    valid, schema = k % 5 != 0, (k % 5 != 0) & (k % 3 != 0)
    flags = (valid, schema, schema & (n % 2 == 0), schema & (n % 3 != 0), valid & (n % 4 != 0), n == 7, k % 11 == 0)
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_quantity").alias("latency_ms"), *[c.alias(f) for f, c in zip(evalreport.FLAGS, flags, strict=True)])


def _eval_sql() -> str:
    v, s = "l_orderkey % 5 <> 0", "l_orderkey % 5 <> 0 AND l_orderkey % 3 <> 0"
    when = dict(zip(evalreport.FLAGS, (v, s, f"{s} AND l_linenumber % 2 = 0", f"{s} AND l_linenumber % 3 <> 0", f"{v} AND l_linenumber % 4 <> 0", "l_linenumber = 7", "l_orderkey % 11 = 0"), strict=True))
    count = lambda c: f"count(CASE WHEN {c} THEN 1 END)"
    cells = ", ".join(f"{count(c)} AS {f}, round(100.0::DOUBLE * {count(c)} / count(*), 1) AS {f}_pct" for f, c in when.items())
    return f"""WITH g AS (SELECT l_returnflag, l_linestatus, count(*) AS n, {cells}, {count(f'NOT ({v})')} AS json_invalid, {count(f'{v} AND NOT ({s})')} AS schema_invalid,
      {count(f'{s} AND l_linenumber % 2 <> 0')} AS semantic_mismatch, avg(l_quantity) AS mean_ms, list_sort(list(l_quantity)) AS q FROM lineitem GROUP BY 1, 2)
    SELECT * EXCLUDE (q), q[CASE WHEN floor(len(q) * 0.95) < 1 THEN len(q) ELSE CAST(floor(len(q) * 0.95) AS BIGINT) END] AS p95_ms FROM g"""


@query(_eval_sql())
def eval_full(spark, sf):
    return evalreport.full_summary(_results(spark, sf), "l_returnflag", "l_linestatus")


@query(
    """WITH o AS (SELECT l_orderkey, list(l_linestatus ORDER BY l_linenumber, l_linestatus) AS e, list(l_returnflag ORDER BY l_linenumber, l_returnflag) FILTER (l_linenumber < 5 OR l_orderkey % 2 = 0) AS p FROM lineitem GROUP BY 1),
    z AS (SELECT unnest(e) AS expected, unnest(p) AS predicted FROM o WHERE len(e) = len(p)), c AS (SELECT count(*) AS n, count(CASE WHEN len(e) = len(p) THEN 1 END) AS eligible FROM o)
    SELECT expected, predicted, count(*) AS n, (SELECT eligible FROM c) AS eligible FROM z GROUP BY 1, 2"""
)
def confusion_positional(spark, sf):
    in_order = lambda c, keep: F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("l_linenumber", F.col(c).alias("c"))))), lambda x: x["c"])  # noqa: E731  an order has 7 lines at most
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(in_order("l_linestatus", F.lit(True)).alias("e"), in_order("l_returnflag", (F.col("l_linenumber") < 5) | (F.col("l_orderkey") % 2 == 0)).alias("p"))
    pairs = evalreport.confusion_pairs(rows, "e", "p").groupBy("expected", "predicted").agg(F.count("*").alias("n"))
    return pairs.crossJoin(F.broadcast(evalreport.eligible(rows, "e", "p").select("eligible")))  # one row


@query("SELECT n_nationkey, n_regionkey FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 2 = 0)")
def result_cache(spark, sf):
    done = table(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_nationkey").alias("n_nationkey"))
    return evalreport.uncached(table(spark, sf, "nation").select("n_nationkey", "n_regionkey"), done, ["n_nationkey"])


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS found FROM customer")
def results_with_models(spark, sf):
    found = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return evalreport.with_found(table(spark, sf, "customer").select("c_custkey"), found, "c_custkey")


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 5 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 6 END::BIGINT AS place FROM part")
def report_places(spark, sf):
    quant = tx.model_and_quant(F.col("path"))[1]
    return _paths(spark, sf).select("p_partkey", evalreport.report_order(quant, tx.QUANTS).cast("long").alias("place"))


# Metrics of a run.


@query(
    """SELECT count(*) AS calls, count(CASE WHEN event_id % 9 <> 0 THEN 1 END) AS ok, count(CASE WHEN event_id % 9 = 0 THEN 1 END) AS failed, count(CASE WHEN event_id % 10 = 0 THEN 1 END) AS repair_attempts,
    count(CASE WHEN event_id % 9 <> 0 AND event_id % 4 <> 0 THEN 1 END) AS accepted, count(CASE WHEN event_id % 9 <> 0 AND event_id % 4 = 0 THEN 1 END) AS rejected,
    count(CASE WHEN event_id % 9 <> 0 AND event_id % 4 <> 0 AND event_id % 10 = 0 THEN 1 END) AS repair_accepted, round(count(*) / 81.0::DOUBLE, 4) AS calls_per_sec, round(1000 / 81.0::DOUBLE, 4) AS inputs_per_sec FROM events"""
)
def run_summary(spark, sf):
    e = F.col("event_id")
    calls = table(spark, sf, "events").select("event_id", (e % 9 != 0).alias("success"), F.when(e % 10 == 0, "repair").otherwise("initial").alias("attempt_type"))
    candidates = calls.where("success").select((e % 4 != 0).alias("accepted"), (e % 10 == 0).alias("is_repair_attempt"))
    return metrics.run_summary(calls, candidates, 81.0, 1000)


_COST = "round(sum(event_id % 500 * 0.27 + event_id % 90 * 1.1)::DOUBLE / 1e6, 4)"


@query(
    f"""WITH g AS (SELECT event_type, count(*) AS calls, count(CASE WHEN event_id % 9 <> 0 THEN 1 END) AS ok, count(CASE WHEN event_id % 9 = 0 THEN 1 END) AS failed, sum(event_id % 500)::BIGINT AS prompt_tokens, sum(event_id % 90)::BIGINT AS completion_tokens, {_COST} AS cost,
      count(CASE WHEN event_id % 9 <> 0 AND event_id % 4 <> 0 THEN 1 END) AS accepted, count(CASE WHEN event_id % 9 <> 0 AND event_id % 4 = 0 THEN 1 END) AS rejected FROM events GROUP BY 1)
    SELECT sum(calls)::BIGINT AS calls, sum(ok)::BIGINT AS ok, sum(failed)::BIGINT AS failed, sum(prompt_tokens)::BIGINT AS prompt_tokens, sum(completion_tokens)::BIGINT AS completion_tokens, round(sum(cost), 4) AS cost, sum(accepted)::BIGINT AS accepted, sum(rejected)::BIGINT AS rejected FROM g"""
)
def metric_totals(spark, sf):
    e = F.col("event_id")
    calls = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("provider"), F.col("event_type").alias("provider_type"), F.lit(None).cast("string").alias("model"), F.col("value").alias("latency_ms"), (e % 500).alias("prompt_tokens"),
        (e % 90).alias("completion_tokens"), F.lit(False).alias("estimated_tokens"), (e % 9 != 0).alias("success"),
    )
    candidates = calls.where("success").select("provider", (e % 4 != 0).alias("accepted"))
    found = metrics.totals(metrics.provider_metrics(calls, candidates, {"default": (0.27, 1.1)}))
    return found.withColumn("cost", F.round("cost", 4))


# Views and intake.


@query(
    """WITH l AS (SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY 1, 2), t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC, event_type) AS turn FROM l)
    SELECT user_id, event_type, event_id, CAST(turn AS INTEGER) AS turn FROM t WHERE turn <= 2"""
)
def history(spark, sf):
    return views.history(table(spark, sf, "events").select("user_id", "event_type", "event_id"), "user_id", "event_type", "event_id", 2)


@query("SELECT count(DISTINCT l_orderkey) AS n_rows, count(*) AS n_txns, round(count(*)::DOUBLE / greatest(count(DISTINCT l_orderkey), 1), 2) AS per_row FROM lineitem")
def view_totals(spark, sf):
    return views.totals(table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("t")), "t")


@query("SELECT event_type IN ('view', 'click') AS live, count(*) AS n FROM events GROUP BY 1")
def live_jobs(spark, sf):
    state = F.when(F.col("event_type") == "view", "running").when(F.col("event_type") == "click", "stopping").otherwise("succeeded")
    return table(spark, sf, "events").groupBy(views.live(state).alias("live")).agg(F.count("*").alias("n"))


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1 ORDER BY 2 LIMIT 60")
def intake_to_target(spark, sf):
    """A folder that grows by three batches, each taken in as it comes, until the table has 60 users."""
    path, base = jsonl.scratch(spark, "batches"), jsonl.scratch(spark, "target")
    rows = table(spark, sf, "events").select("event_id", "user_id")
    most = rows.agg(F.max("event_id")).head()[0]
    for k in range(3):
        rows.where(F.floor(F.col("event_id") * 40 / (most + 1)).between((0, 1, 2)[k], (0, 1, 39)[k])).write.mode("append").parquet(path)
        incremental.intake(spark, path, rows.schema, "user_id", "event_id", f"{base}/checkpoint", f"{base}/table", target=60)
    return spark.read.parquet(f"{base}/table").select("user_id", "event_id")


@query(
    """WITH s AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS t, CASE WHEN event_type = 'error' THEN 'error_batches' WHEN value < 40 THEN 'empty_batches' ELSE 'fine' END AS s FROM events),
    h AS (SELECT *, lag(s, 1) OVER w AS a, lag(s, 2) OVER w AS b FROM s WINDOW w AS (PARTITION BY user_id ORDER BY t))
    SELECT user_id, arg_min(s, t) AS reason, CAST(min(t) AS INTEGER) AS stopped_at FROM h WHERE s <> 'fine' AND s = a AND s = b GROUP BY 1"""
)
def worker_stops(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", F.when(F.col("value") < 40, 0).otherwise(1).alias("found"), (F.col("event_type") == "error").alias("failed"))
    return incremental.stops(rows, "user_id", "event_id", "found", "failed").withColumn("stopped_at", F.col("stopped_at").cast("int"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS answer FROM orders")
def correlated_answers(spark, sf):
    at = F.timestamp_seconds(F.col("o_orderkey"))
    asked = table(spark, sf, "orders").select("o_orderkey", at.alias("asked"))
    answers = table(spark, sf, "orders").where("o_orderkey % 3 <> 2").select("o_orderkey", F.col("o_custkey").alias("answer"), F.timestamp_seconds(F.col("o_orderkey") + F.when(F.col("o_orderkey") % 3 == 0, 60).otherwise(6000)).alias("answered"))
    return incremental.correlated(asked, answers, "o_orderkey", "asked", "answered").select("o_orderkey", "answer")


@query(
    """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM (SELECT doc_id, regexp_replace(text, '[^A-Za-z]', ' ', 'g') AS text FROM documents)),
    k AS (SELECT token, count(*) AS n, min(doc_id) AS first FROM w WHERE length(token) >= 3 GROUP BY 1 HAVING count(*) >= 2)
    SELECT token, n, first FROM k WHERE token NOT IN (SELECT unnest(string_split('"""
    + " ".join(sorted({*audit.HINDI, *audit.ENGLISH, *audit.ALL_UNITS, "und"}))
    + "', ' ')))"
)
def token_frequency(spark, sf):
    return audit.token_counts(table(spark, sf, "documents"), "text", "doc_id", known=("und",))


@query("WITH t AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM conversations) SELECT conv_id, turn FROM t WHERE k <= 3")
def log_deltas(spark, sf):
    """A snapshot of the last lines of each log, then what came after it."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn")
    cut = rows.groupBy("conv_id").agg((F.max("turn") - 1).alias("cut"))
    old = select.tail(rows.join(cut, "conv_id").where("turn <= cut").drop("cut"), "conv_id", "turn", 2)
    return old.unionByName(rows.join(cut, "conv_id").where("turn > cut").drop("cut"))


# Lines of files, and counts by provider, reason and severity.


@query(
    """SELECT event_id % 16 AS f, event_id, sum(CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END) OVER (PARTITION BY event_id % 16 ORDER BY event_id)::BIGINT AS line FROM events"""
)
def jsonl_file_lines(spark, sf):
    """Sixteen files, each with a blank line before each third event: numbers run in each file, blank lines counted."""
    e = F.col("event_id")
    value = F.concat(F.when(e % 3 == 0, F.lit(" \t\n")).otherwise(F.lit("")), F.to_json(F.struct("event_id")))
    rows = table(spark, sf, "events").select((e % 16).alias("f"), "event_id", value.alias("value"))
    path = jsonl.scratch(spark, "files")
    rows.repartition("f").sortWithinPartitions("f", "event_id").select("f", "value").write.partitionBy("f").text(path)
    lines = jsonl.numbered_lines(spark, f"{path}/*/*")
    event = F.try_variant_get(F.try_parse_json("raw"), "$.event_id", "bigint")
    return lines.select((event % 16).alias("f"), event.alias("event_id"), "line")


@query(
    """WITH m AS (SELECT p_partkey % 4 AS m, count(*) AS n FROM part GROUP BY 1), x AS (SELECT 'rows' AS kind, 'scanned' AS name, n FROM m UNION ALL SELECT 'rows', CASE m WHEN 1 THEN 'failed' WHEN 3 THEN 'malformed' ELSE 'ok' END, n FROM m
    UNION ALL SELECT 'failure', 'AMOUNT_NOT_IN_INPUT', n FROM m WHERE m = 1 UNION ALL SELECT 'warning', 'TXN_COUNT_BELOW_CANDIDATES', n FROM m WHERE m = 2)
    SELECT kind, name, sum(n)::BIGINT AS n FROM x GROUP BY 1, 2"""
)
def probe_report(spark, sf):
    """From raw lines: by key modulo 4 right, with a wrong amount, with a transaction too few (a warning), and malformed."""
    k, m = F.col("p_partkey"), F.col("p_partkey") % 4
    n = k % 900 + 100
    said = F.when(m == 2, F.format_string("%d tea and %d cake", n, n + 1000)).otherwise(F.format_string("%d tea", n))
    txn = F.concat(F.lit('{"amount":'), F.when(m == 1, n + 7).otherwise(n).cast("string"), F.lit(',"currency":"INR","item":"tea","category":"Drinks","type":"expense"}'))
    bad = F.when(k % 8 == 3, F.lit('{"input": "x"')).otherwise(F.lit('{"input": 5, "output": {}}'))
    line = F.when(m == 3, bad).otherwise(F.concat(F.lit('{"input":"'), said, F.lit('","output":{"transactions":['), txn, F.lit("]}}")))
    rows = jsonl.parsed(jsonl.read_lines(spark, _written(table(spark, sf, "part").select(line.alias("value")), "probed")))
    out = F.try_variant_get("v", "$.output", "variant")
    rows = with_amounts(rows.withColumn("said", F.try_variant_get("v", "$.input", "string")), F.col("said")).withColumn("faults", jsonx.schema_errors(out))
    return validate.probe(rows.withColumn("errors", validate.validate(F.col("said"), jsonx.transactions(out), F.col("amounts"), F.col("faults"))))


@query(
    """SELECT 'pruned' AS what, event_type AS name, count(*) AS n FROM events WHERE event_id % 4 = 0 GROUP BY 2
    UNION ALL SELECT 'recovered', event_type, count(*) FROM (SELECT user_id, arg_min(event_type, (event_id % 4 = 1, event_id)) AS event_type FROM events WHERE value > 20 GROUP BY 1) GROUP BY 2
    UNION ALL SELECT 'orphaned', CASE user_id % 2 WHEN 0 THEN 'provider_error' ELSE 'unknown' END, count(*) FROM events WHERE user_id % 5 = 0 GROUP BY 2"""
)
def repair_counts(spark, sf):
    """What pruning, recovery and labels that came later take out of the failed rows, by provider and by reason."""
    e, u = F.col("event_id"), F.col("user_id")
    attempt = F.struct(F.lit("provider_error").alias("failure_reason"), F.when(e % 4 == 0, "HTTP 401").otherwise("timeout").alias("error"), F.col("event_type").alias("provider"))
    events = table(spark, sf, "events")
    failed = events.select(F.lit("provider_error").alias("reason"), F.array(attempt).alias("attempts"))
    tried = events.select("user_id", F.col("event_type").alias("provider"), (e % 4 == 1).alias("is_repair_attempt"), e.alias("pos"), (F.col("value") > 20).alias("ok"))
    late = events.select("user_id", F.when(u % 2 == 0, "provider_error").alias("reason"))
    marked = reconcile.mark_orphans(late, events.select("user_id").where("user_id % 5 = 0").distinct(), "user_id")
    named = lambda what, frame: frame.select(F.lit(what).alias("what"), F.col(frame.columns[0]).alias("name"), "n")
    return named("pruned", select.pruned_counts(failed)).unionByName(named("recovered", select.recovered_counts(tried, "user_id"))).unionByName(named("orphaned", select.orphan_counts(marked)))


@query(
    """SELECT o_orderkey, t::INTEGER AS place, CASE t WHEN 0 THEN CAST(o_orderkey AS VARCHAR) || ' tea' WHEN 2 THEN 'two cakes' ELSE 'Bus ' || CAST(o_orderkey % 7 AS VARCHAR) END AS line
    FROM orders, range(5) AS r(t) WHERE t IN (0, 2) OR (t = 4 AND o_orderkey % 2 = 0)"""
)
def provider_lines(spark, sf):
    """A provider's answer: bullets, a line that comes again in other letters, a lead-in, and more lines than asked for."""
    k = F.col("o_orderkey")
    said = F.concat(F.format_string("1. %d tea\n", k), F.lit("Output: x\n- two cakes\nTWO   cakes\n"), F.when(k % 2 == 0, F.format_string("Bus %d\n", k % 7)).otherwise(F.lit("ab\n")), F.lit("\n"))
    more = F.when(k % 2 == 0, F.lit("never seen\n")).otherwise(F.lit(""))
    rows = table(spark, sf, "orders").select("o_orderkey", F.concat(said, more).alias("said"))
    return tx.clean_lines(rows, "o_orderkey", "said", 3).select("o_orderkey", F.col("pos").alias("place"), "line")


@query("SELECT 0::BIGINT AS missing, 0::BIGINT AS broken, 0::BIGINT AS no_array, count(*) AS flags, sum(n_nationkey)::BIGINT AS keys, 0::BIGINT AS lines FROM nation")
def absent_and_broken_files(spark, sf):
    """Files that aren't there, or aren't what they should be, are empty tables."""
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    path, kind = jsonl.scratch(spark, "flags"), "n_nationkey long, n_name string"
    count = lambda rows: rows.count()
    broken, other = _written(nations.limit(1).select(F.lit("[{").alias("value")), "torn"), _written(nations.limit(1).select(F.lit('{"a": 1}').alias("value")), "object")
    jsonl.write_array(nations.limit(0), path)
    assert count(jsonl.read_array(spark, path, kind)) == 0
    jsonl.write_array(nations, path)  # in place of the empty one
    flags = jsonl.read_array(spark, path, kind).agg(F.count("*").alias("flags"), F.sum("n_nationkey").alias("keys"))
    none = {"missing": jsonl.read_array(spark, f"{path}-none", kind), "broken": jsonl.read_array(spark, broken, kind), "no_array": jsonl.read_array(spark, other, kind), "lines": jsonl.read_lines(spark, f"{path}-none")}
    return flags.withColumns({k: F.lit(count(v)).cast("long") for k, v in none.items()})
