"""Streams, run folders, label sources, and what must hold at any number of partitions."""

import difflib
import os
import random

import pytest
from pyspark.sql import Row, functions as F

from ledgerloom.functions import jsonx
from ledgerloom.operators import audit, validate
from ledgerloom.plans import streams
from ledgerloom.sources import blocks, jsonl, labels, runfolders
from ledgerloom.streaming import logs, sinks
from ledgerloom.streaming.feed import Feed, appended
from ledgerloom.streaming.jobs import ALLOWED, JobStates


@pytest.fixture
def eight_partitions(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    for k, v in held.items():
        spark.conf.set(k, v)


def test_line_numbers_over_many_partitions(eight_partitions):
    spark = eight_partitions
    rows = spark.range(40_000).select((F.col("id") * 7919 % 40_009).alias("ord"), F.col("id")).repartition(5)
    got = jsonl.line_numbers(rows, "ord", start=1).select("ord", "line").orderBy("ord").collect()
    assert [r["line"] for r in got] == list(range(1, 40_001))


def test_lines_are_counted_in_each_file_with_blank_ones(eight_partitions, tmp_path):
    spark = eight_partitions
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several blocks a file
    want = set()
    for name in ("a.jsonl", "b.jsonl"):
        said = [" \t" if k % 5 == 1 else "" if k % 5 == 2 else f"{name} {k}" for k in range(1, 3000)]
        (tmp_path / name).write_text("\n".join(said) + "\n")
        want |= {(name, k, s) for k, s in enumerate(said, 1) if s.strip()}
    lines = jsonl.numbered_lines(spark, f"{tmp_path}/*.jsonl")
    assert lines.rdd.getNumPartitions() > 4
    got = [(r["file"], r["line"], r["raw"]) for r in lines.collect()]
    assert len(got) == len(want) and set(got) == want


def test_nothing_there(spark, tmp_path):
    assert jsonl.read_lines(spark, f"{tmp_path}/none.jsonl").count() == jsonl.numbered_lines(spark, f"{tmp_path}/none.jsonl").count() == 0
    for text in ("", "[{", "{}", "5"):
        (tmp_path / "flags.json").write_text(text)
        assert jsonl.read_array(spark, str(tmp_path / "flags.json"), "a long").count() == 0


# JSON in answers, and schemas.


ANSWERS = [
    ('say "{x}" {"k":1}', '{"k":1}'), ('} {"k":1}', None), ('} { {"k":1} }', '{"k":1}'), ('{"a": "}"} x', '{"a": "}"}'), ('say "open {"k":1}', None),
    ('Here:\n```json\n{"k": [1]}\n```', '{"k": [1]}'), ('```json\n{"k": 1}\n```', '{"k": 1}'), ('```\n[1]\n```', None), (' {"k": 1}\n', '{"k": 1}'), ("", None), (None, None),
    ('a "\\"{" {"k": "\\""} {"z":2}', '{"k": "\\""}'), ("{bad} {\"k\": 1}", None), ("x" * 50_000 + '{"k": 1}', '{"k": 1}'), ('"' * 50_001 + '{"k": 1}', None),
]


def test_objects_in_answers(spark):
    got = spark.createDataFrame([(k, a) for k, (a, _) in enumerate(ANSWERS)], "k int, a string").select("k", jsonx.extract_json(F.col("a")).alias("j")).orderBy("k").collect()
    assert [r["j"] and r["j"].strip() for r in got] == [j for _, j in ANSWERS]


def test_another_schema_compiles(spark):
    schema = {"type": "object", "required": ["id"], "properties": {"id": {"type": "integer"}, "tags": {"type": "array", "items": {"type": "string", "minLength": 2}}, "on": {"type": "boolean"}, "at": {"type": "object", "additionalProperties": False, "properties": {"x": {"type": "number"}}}}}
    rows = [
        ('{"id": 1, "more": 2}', []), ('{"id": 1.5}', [("type", "/id")]), ('{"id": true, "on": 1}', [("type", "/id"), ("type", "/on")]), ("[]", [("type", "")]), ("null", [("type", "")]), (None, [("type", "")]),
        ('{"tags": ["ab", "a", 5]}', [("required", ""), ("minLength", "/tags/1"), ("type", "/tags/2")]), ('{"id": 1, "at": {"x": "1", "y": 2}}', [("additionalProperties", "/at"), ("type", "/at/x")]),
    ]
    errors = jsonx.compile_schema(schema)(F.try_parse_json("raw"))
    got = spark.createDataFrame([(k, r) for k, (r, _) in enumerate(rows)], "k int, raw string").select("k", errors.alias("e")).orderBy("k").collect()
    assert [[tuple(e) for e in r["e"]] for r in got] == [e for _, e in rows]


def test_probe_counts_severities_apart(spark):
    error = "array<struct<code:string,path:string,severity:string>>"
    rows = spark.createDataFrame([(None, [("A", "", "error"), ("W", "", "warning")]), (None, [("W", "", "warning")]), (None, []), ("bad_json", None)], f"malformed string, errors {error}")
    got = {(r["kind"], r["name"]): r["n"] for r in validate.probe(rows).collect()}
    assert got == {("rows", "scanned"): 4, ("rows", "malformed"): 1, ("rows", "ok"): 2, ("rows", "failed"): 1, ("failure", "A"): 1, ("warning", "W"): 2}


def test_one_value_and_nothing_after_it(spark):
    texts = ["{}", ' {"a": 1}\n', "[1, 2]", "5", '"x"', "null", '{"a": 1} x', "{} {}", "1, 2", "1] x", "1} x", "1]}", "", " ", "{", None, '{"v": 1}}', "]", "}"]
    got = [r[0] for r in spark.createDataFrame(enumerate(texts), "k int, t string").orderBy("k").select(jsonx.json_value(F.col("t")).isNotNull()).collect()]
    assert [t for t, ok in zip(texts, got, strict=True) if ok] == texts[:6]
    lines = spark.createDataFrame([('{"input": "a", "output": {}} x',), ('{"input": "a", "output": {}}',)], "raw string")
    assert [r["malformed"] for r in jsonl.parsed(lines).collect()] == ["bad_json", None]


# The vocabulary join.


def test_bounds_are_never_under_the_ratio():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdx") for _ in range(rnd.randint(1, 9)))
    words = sorted({word() for _ in range(40)})
    near = audit.Vocabulary(words, 0.72)
    tokens = [word() for _ in range(300)] + ["", "qqq"]
    bounds = near.bounds(tokens)
    one = difflib.SequenceMatcher()
    for token, row, found in zip(tokens, bounds, near.nearest(tokens), strict=True):
        one.set_seq2(token)
        ratios = []
        for w, bound in zip(near.words, row, strict=True):
            one.set_seq1(w)
            assert one.ratio() <= bound + 1e-12
            ratios.append((one.ratio(), w))
        want = difflib.get_close_matches(token, words, n=1, cutoff=0.72)
        assert (found[0] if found else None) == (want[0] if want else None)
        assert not found or found[0] == max(ratios)[1]


def test_planted_misspellings(spark):
    """A letter left out, doubled or changed, with the ratio that follows."""
    rows = [("pachchs", "pachchis", 2 * 7 / 15), ("chalees", "chalees", 1.0), ("bahattarr", "bahattar", 2 * 8 / 17), ("zzzzzz", None, None)]
    values = {"pachchis": 25, "chalees": 40, "bahattar": 72}
    got = {r["token"]: r for r in audit.similar(spark.createDataFrame([(t,) for t, _, _ in rows], "token string"), "token", values).collect()}
    for token, nearest, ratio in rows:
        assert (token in got) == (nearest is not None)
        if nearest:
            assert (got[token]["nearest"], got[token]["value"]) == (nearest, values[nearest]) and got[token]["ratio"] == pytest.approx(ratio)


def test_failed_texts_of_an_audit(spark):
    rows = spark.createDataFrame([('{"input": "a", "reason": "x"}',), ("",), ("{",), ('{"input": 5}',), ("[1]",), (None,)], "raw string")
    assert [r["input"] for r in audit.failed_texts(rows).collect()] == ["a"]


# States of jobs.


class Held:
    def __init__(self):
        self.value, self.timers = None, set()

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class Expired:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at

    getCurrentWatermarkInMs = getExpiryTimeInMs


def by_batches(events, cuts, silence):
    """What the processor of one job says when its events come in batches, timers fired after each by the largest time."""
    one, out, held = JobStates(silence), [], Held()
    one.handle = one.state = held
    for k in range(len(cuts) + 1):
        part = events[([0] + cuts)[k] : (cuts + [len(events)])[k]]
        if part:
            out += one.handleInputRows(("j",), iter([Row(event_id=e, us=us, status=said) for e, us, said in part]), None)
        mark = max((e[1] for e in events[: (cuts + [len(events)])[k]]), default=0) // 1000
        for at in sorted(t for t in held.timers if t <= mark):
            held.timers.discard(at)
            out += one.handleExpiredTimer(("j",), Expired(mark), Expired(at))
    return sorted(map(tuple, out), key=repr)


def test_job_states_do_not_depend_on_batches():
    rnd = random.Random(3)
    for _ in range(60):
        times = sorted(rnd.sample(range(0, 400_000, 1000), rnd.randint(1, 12)))
        events = [(k, t, rnd.choice(["running", "running", "stopping", "succeeded", "killed"])) for k, t in enumerate(times)]
        whole = by_batches(events, [], 50_000)
        for _ in range(3):
            cuts = sorted(rnd.sample(range(len(events) + 1), min(2, len(events))))
            assert by_batches(events, cuts, 50_000) == whole


def test_refused_changes_leave_the_state():
    out = by_batches([(1, 0, "succeeded"), (2, 1000, "running"), (3, 2000, "running"), (4, 3000, "stopping"), (5, 4000, "succeeded"), (6, 5000, "killed"), (7, 6000, "running")], [], 10**9)
    assert [(r[1], r[4]) for r in sorted(out, key=lambda r: r[1])] == [(1, "refused"), (2, "applied"), (3, "refused"), (4, "applied"), (5, "refused"), (6, "applied"), (7, "refused")]
    assert set(ALLOWED) == {None, "running", "stopping"}


# Requests and answers.


class States(logs.Progress):
    """Rows that the join holds, and sources, of each batch."""

    def onQueryProgress(self, event):
        p = event.progress
        held = [s.numRowsTotal for s in p.stateOperators if s.operatorName == "symmetricHashJoin"]
        self.batches.append((max(held, default=0), len(p.sources)))


def test_requests_that_wait_are_those_of_a_slice(spark, tmp_path, monkeypatch):
    spark.range(1000).select((F.col("id") * 41).alias("o_orderkey")).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(streams, "SLICE", 84 / spark.sparkContext.defaultParallelism, raising=False)  # of the 250 of a run
    states = States()
    spark.streams.addListener(states)
    try:
        rows = [tuple(r) for r in streams.request_answers_stream(spark, str(tmp_path)).collect()]
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(states)
    assert sorted(rows) == [(k, k % 5 in (1, 4) or (k % 5 == 3 and k * 4 // (999 * 41 + 1) > 0)) for k in range(0, 1000 * 41, 41)]
    most = max(held for held, _ in states.batches)
    assert 84 <= most < 250  # a run would be 400 and more
    assert {n for _, n in states.batches} == {1}  # requests and answers come in together


def test_slices_are_of_one_feed():
    with pytest.raises(ValueError, match="one feed"):
        appended([None, None], 1, None, slices=2)


# Sinks, logs, runs, label sources.


def test_sinks_hold_each_row_once_after_a_crash(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 4).cast("int").alias("run"))
    feed = Feed(rows, "crash")
    train, failed = f"{feed.base}/train", f"{feed.base}/failed"
    crashes = []

    def crash(number):
        if len(crashes) < 2:
            crashes.append(number)
            raise RuntimeError("planted")

    listener = logs.Progress()
    spark.streams.addListener(listener)
    try:
        for n in range(4):
            feed.release(n)
            for _ in range(3):
                try:
                    sinks.split_sinks(feed.stream(), F.when(F.col("id") % 10 != 0, F.col("id") % 3 == 0), train, failed, f"{feed.base}/state", 7, crash)
                    break
                except Exception as error:
                    assert "planted" in str(error)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(listener)
    assert crashes == [0, 0] and not feed.release(4)
    ids = {side: sorted(r["id"] for r in sinks.written(spark, path, "id long").collect()) for side, path in (("train", train), ("failed", failed))}
    assert ids["train"] == [k for k in range(1000) if k % 3 == 0 and k % 10]
    assert sorted(ids["train"] + ids["failed"]) == list(range(1000))
    assert max(r["n"] for r in sinks.written(spark, train, "id long").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()) == 7
    assert sum(n for _, _, n, _ in listener.batches) == 1000 and any(e for _, e in listener.ended)


def test_lines_of_many_jobs_under_one_key():
    """What a shard of jobs sends doesn't depend on batches, and equals what each job sends alone."""

    class Blocks(Held):
        put = Held.update

    def said(rows, cuts):
        one, out = logs.FanOut(3), []
        one.jobs = Blocks()
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            out += map(tuple, one.handleInputRows((7,), iter(rows[a:b]), None))
        return sorted(out, key=repr)

    rnd = random.Random(2)
    rows = [Row(job=rnd.choice(["a", "b", None, "c"]), seq=k, subscriber=f"s{k}" if rnd.random() < 0.2 else None, line=rnd.choice(["x", "ü", None])) for k in range(300)]
    whole = said(rows, [])
    assert whole == said(rows, [100, 101, 250])
    assert whole == sorted(sum((said([r for r in rows if r.job == j], []) for j in ("a", "b", None, "c")), []), key=repr)


def test_a_run_is_the_work_of_several_tasks(spark):
    feed = Feed(spark.range(4000).select("id", (F.col("id") % 2).cast("int").alias("run")), "spread")
    files = [r for r in os.walk(feed.base) if r[0].endswith(("run=0", "run=1"))]
    assert len(files) == 2 and all(sum(f.endswith(".parquet") for f in r[2]) > 1 for r in files)


def test_blocks_replace_their_folder(spark, tmp_path):
    at = f"{tmp_path}/out/batch=0"
    for rows in (90, 25):  # the second time there are fewer
        blocks.write(spark.range(rows).select("id", F.when(F.col("id") % 2 == 0, "ü\n").alias("t")).repartition(3), at, 10)
    got = spark.read.schema("id long, t string, batch long").json(f"{tmp_path}/out")
    assert {tuple(r) for r in got.collect()} == {(k, None if k % 2 else "ü\n", 0) for k in range(25)} and got.count() == 25
    assert max(r["n"] for r in got.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()) <= 10
    assert os.listdir(tmp_path / "out") == ["batch=0"]
    assert '"t":null' in "".join(open(f"{d}/{f}").read() for d, _, fs in os.walk(at) for f in fs)


def test_run_folders_round_trip(spark, tmp_path):
    at = str(tmp_path / "runs")
    assert runfolders.read_runs(spark, at).count() == 0
    rows = [(f"r{k}", str(k), "f", "ü\n", "running" if k % 2 else "succeeded", None if k % 2 else 0, "2024", None, False) for k in range(5)]
    frame = spark.createDataFrame(rows, runfolders.META)
    for _ in range(2):  # a second write replaces the first
        runfolders.by_run(frame).write.format("runs").mode("append").option("path", at).save()
    (tmp_path / "runs" / "r3" / "meta.json").write_text('{"id": "3", "sta')
    os.makedirs(tmp_path / "runs" / "empty")
    (tmp_path / "runs" / "r1" / "output.log").write_text("one\r\n\ntwo\nthr")
    (tmp_path / "runs" / "r1" / "output-000000000.log").write_text("four\n")
    got = {r["run"]: tuple(r) for r in spark.read.format("runs").option("runs_a_task", 2).load(at).collect()}
    assert {k for k, r in got.items() if r[-1]} == {"r3", "empty"}
    assert [got[f"r{k}"] for k in (0, 1, 2, 4)] == [rows[k] for k in (0, 1, 2, 4)]
    log = runfolders.read_runs(spark, at, "log").orderBy("number").collect()
    assert [tuple(r) for r in log] == [("r1", 1, "one"), ("r1", 2, "two"), ("r1", 3, "thr"), ("r1", 4, "four")]
    assert not [f for _, _, files in os.walk(at) for f in files if f.endswith(".new")]


def test_label_sources(spark):
    lines = {"a": '{"output": {"k": 1}}', "b": '{"raw_output": "x", "error": "ThrottlingException", "times": 2}', "c": '{"error": "AccessDenied"}', "d": '{"error": "ModelTimeoutException"}'}
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(["a", "b", "c", "d", "zzz", None, "a"])], "k int, input string")
    waits = []
    found = labels.attempts(rows.coalesce(1), "input", "fake", {"fixture": lines}, batch=3, retries=2, base=0.5, most=0.75, pause=waits.append)
    got = sorted((r["k"], r["attempt"], r["raw_output"], r["code"], r["waited"]) for r in found.select("k", "attempt", F.coalesce("raw_output", F.lit("")).alias("raw_output"), F.coalesce("code", F.lit("")).alias("code"), "waited").collect())
    late = "ModelTimeoutException"
    assert got == [
        (0, 0, '{"k":1}', "", 0.0), (1, 0, "", "ThrottlingException", 0.0), (1, 1, "", "ThrottlingException", 0.5), (1, 2, "x", "", 1.25), (2, 0, "", "AccessDenied", 0.0),
        (3, 0, "", late, 0.0), (3, 1, "", late, 0.5), (3, 2, "", late, 1.25), (4, 0, "", "NotInFixture", 0.0), (6, 0, '{"k":1}', "", 0.0),
    ]
    assert labels.attempts(rows.limit(0), "input", "fake", {"fixture": lines}).count() == 0
    with pytest.raises(KeyError):
        labels.attempts(rows, "input", "no such type", {})


