"""Sales with the versions of their clients: the processor against a plain run over batches, the query against its SQL."""

import bisect
import datetime
import os
import random
from collections import defaultdict

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import sale_enrichment as enrichment

SF = "/root/testdata/sf0.001"
NONE = enrichment.NONE


class Held:
    """A ListState of one key."""

    def __init__(self):
        self.rows = []

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def clear(self):
        self.rows = []


def by_processor(rows, batches, delay):
    """What the processor emits for one key that has all rows: (kind, client, id, at, seq, cents, op, batch)."""
    one, out = enrichment.Enrich(), []
    one.versions, one.waiting = Held(), Held()
    most = [None, None]
    for b in range(batches + 1):
        marks = [NONE if m is None else m - delay for m in most] if b < batches else [NONE, NONE]
        now = [(r[0], 0, 0, *r[1:7]) for r in rows if r[7] == b]
        now.append((enrichment.CLOCK, 0, 0, NONE, b, *marks, int(b == batches), None))
        frame = pd.DataFrame(now, columns=[c.split()[0] for c in enrichment.ROWS.split(", ")])
        for found in one.handleInputRows((0, 0), iter([frame[:2], frame[2:]] if len(frame) > 2 else [frame]), None):
            out += [tuple(None if pd.isna(x) else x for x in r) for r in found[["rec", "id", "batch", "n_held", "change_id", "balance_cents", "op"]].astype(object).itertuples(index=False)]
        for k in (0, 1):
            most[k] = max((r[3] for r in rows if r[7] == b and r[0] == k and r[3] != NONE and (most[k] is None or r[3] > most[k])), default=most[k])
    return sorted(out, key=repr)


def plainly(rows, batches, delay):
    versions, waiting, out, most = defaultdict(list), [], [], [None, None]
    for b in range(batches + 1):
        marks = [float("-inf") if m is None else m - delay for m in most]
        limit = min(marks)
        for kind, client, id_, at, seq, cents, op, batch in rows:
            if batch != b:
                continue
            if kind == enrichment.SALE:
                waiting.append((client, at, id_))
            elif at < marks[1]:
                out.append(("late", id_, b, None, None, None, None))
            else:
                bisect.insort(versions[client], (at, seq, id_, cents, op))
        still = []
        for client, at, id_ in waiting:
            if b < batches and at != NONE and at >= limit:
                still.append((client, at, id_))
                continue
            held = versions[client] if client != NONE else []
            fit = [v for v in held if v[0] <= at]
            v = fit[-1] if fit else (None,) * 5
            out.append(("sale", id_, b, len(held), v[2], v[3], v[4]))
        waiting = still
        for client, held in versions.items():
            past = [v for v in held if v[0] <= limit]
            versions[client] = past[-1:] + held[len(past) :]
        for k in (0, 1):
            most[k] = max((r[3] for r in rows if r[7] == b and r[0] == k and r[3] != NONE and (most[k] is None or r[3] > most[k])), default=most[k])
    return sorted(out, key=repr)


def test_processor_equals_a_plain_run(monkeypatch):
    monkeypatch.setattr(enrichment, "BLOCK", 3)
    rnd = random.Random(12)
    for _ in range(60):
        rows = []
        for i in range(rnd.randint(0, 70)):
            b = rnd.randint(0, 4)
            kind = rnd.choice([enrichment.SALE, enrichment.CHANGE])
            at = 10 * b + rnd.randint(-14, 14)
            if kind == enrichment.SALE:
                rows.append((kind, rnd.choice([1, 2, 3, NONE]), i, rnd.choice([at] * 6 + [NONE]), NONE, NONE, None, b))
            else:
                rows.append((kind, rnd.choice([1, 2, 3]), i, at, rnd.randint(0, 2), rnd.randint(0, 9), rnd.choice("IUD"), b))
        assert by_processor(rows, 5, 6) == plainly(rows, 5, 6)


def test_ties_and_equal_keys():
    """Versions of one time, seq and id stand by balance, then op."""
    rows = [(1, 1, 5, 10, 0, c, op, 0) for c, op in ((7, "U"), (7, "I"), (9, "A"), (2, "Z"))] + [(0, 1, 1, 10, NONE, NONE, None, 0)]
    assert by_processor(rows, 1, 0) == [("sale", 1, 1, 4, 5, 9, "A")]


def listed(frame):
    names = ["rec", "id", "batch", "n_held", "change_id", "balance_cents", "op"]
    assert sorted(frame.columns) == sorted(names)
    return sorted((tuple(None if pd.isna(x) else x if isinstance(x, str) else int(x) for x in r) for r in frame[names].astype(object).itertuples(index=False)), key=repr)


def by_sql(d, inner=""):
    con = duckdb.connect()
    for t in ("sales", "client_changes"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet{inner}'")
    return listed(con.sql(enrichment.SQL).df())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_query_with_hot_clients_equals_sql(spark):
    rows = enrichment.batched(spark.read.parquet(f"{SF}/sales.parquet"), spark.read.parquet(f"{SF}/client_changes.parquet"))
    _, _, parts, _ = enrichment.dealt(rows, 0, 100)
    assert parts.count() > 1
    before = {k: spark.conf.get(k, None) for k in enrichment.STATE | enrichment.MOUNTED}
    got = enrichment.enrich(rows, shard_rows=100)
    assert {k: spark.conf.get(k, None) for k in enrichment.STATE | enrichment.MOUNTED} == before
    assert got.dtypes == [("rec", "string"), ("id", "bigint"), ("batch", "bigint"), ("n_held", "bigint"), ("change_id", "bigint"), ("balance_cents", "bigint"), ("op", "string")]
    assert listed(got.toPandas()) == by_sql(SF)


def test_odd_rows_equal_sql(spark, tmp_path):
    day = lambda d, h=0: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=d, hours=h)
    sales = [(1, 7, day(1), day(1)), (1, 7, day(1), day(1)), (2, None, day(2), day(2)), (None, 7, day(30), day(31)), (3, 7, None, day(40)), (4, 8, day(3), day(90)), (5, 9, day(200), day(200)), (6, 7, day(-40), day(-40)), (7, 7, day(100), None)]
    changes = [(1, 7, 0, "I", day(0), 1.5), (1, 7, 0, "I", day(0), 1.5), (2, 7, 1, None, day(20), None), (None, 7, None, "U", day(20), -2.345), (3, None, 0, "U", day(1), 3.0), (4, 8, 0, "D", None, 1.0), (5, 8, 0, "D", day(50), 1e12), (6, 7, 0, "U", day(110), 0.005), (7, 8, 0, "U", day(2), 9.0), (8, 7, 3, "U", day(20), 5.0)]
    ntz = lambda frame, *names: frame.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names} | {n: F.lit("x") for n in ("kind", "shard", "id", "at", "batch", "op.x")})
    ntz(spark.createDataFrame(sales, "sale_id long, client_id long, sold_at timestamp, arrived_at timestamp"), "sold_at", "arrived_at").write.parquet(f"{tmp_path}/sales.parquet")
    ntz(spark.createDataFrame(changes, "change_id long, client_id long, seq long, op string, valid_at timestamp, balance double"), "valid_at").write.parquet(f"{tmp_path}/client_changes.parquet")
    got = listed(enrichment.enriched(spark, str(tmp_path)).toPandas())
    assert got == by_sql(str(tmp_path), "/*.parquet")
    assert sum(r[0] == "sale" for r in got) == len(sales)


def test_empty_tables(spark):
    sales = spark.createDataFrame([], "sale_id long, client_id long, sold_at timestamp_ntz, arrived_at timestamp_ntz")
    changes = spark.createDataFrame([], "change_id long, client_id long, seq long, op string, valid_at timestamp_ntz, balance double")
    assert enrichment.enrich(enrichment.batched(sales, changes)).count() == 0
