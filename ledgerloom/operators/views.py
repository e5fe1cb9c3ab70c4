"""Views of a table: search, pages, flags, statistics, jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: States in which a job has not ended.
LIVE = ("running", "stopping")
ENDED = ("succeeded", "failed", "killed", "orphaned")


def search(text: Column, query: str) -> Column:
    """Case-insensitive substring; an empty query matches all."""
    return F.contains(F.lower(text), F.lit(query.lower())) if query else F.lit(True)


def page(rows: DataFrame, order: str, number: int = 1, size: int = 20) -> DataFrame:
    """A page in the order of `order`: numbers from 1, sizes 1 to 100. Spark takes the first of each task, so what
    comes together is number x size rows a task."""
    size = min(100, max(1, size))
    return rows.orderBy(order).offset((max(1, number) - 1) * size).limit(size)


def page_count(rows: int, size: int) -> int:
    return max(1, -(-rows // min(100, max(1, size))))


def with_flags(rows: DataFrame, flags: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the number of flags on them and the last reason."""
    by_row = flags.groupBy(*keys).agg(F.count("*").alias("n_flags"), F.max_by("reason", "timestamp").alias("last_reason"))
    return rows.join(by_row, keys, "left").withColumn("n_flags", F.coalesce("n_flags", F.lit(0)))


def distribution(rows: DataFrame, txns: str, field: str) -> DataFrame:
    """Transactions by a field."""
    return rows.select(F.explode(txns).alias("t")).groupBy(F.col(f"t.{field}").alias(field)).agg(F.count("*").alias("n"))


def by_size(rows: DataFrame, txns: str) -> DataFrame:
    return rows.groupBy(F.size(txns).alias("n_txns")).agg(F.count("*").alias("n"))


def label_counts(rows: DataFrame, txns: str, fields: tuple[str, ...]) -> DataFrame:
    """kind, value, n: rows by number of transactions (kind size), and transactions by each field. One pass: a row's
    marks are counted together."""
    mark = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))
    of = lambda field: F.transform(txns, lambda t: mark(field, t[field]))
    marks = [F.array(mark("size", F.size(txns))), *map(of, fields)]
    return rows.select(F.inline(F.concat(*marks))).groupBy("kind", "value").agg(F.count("*").alias("n"))


def latest(events: DataFrame, key: str, order: str, state: str) -> DataFrame:
    """The last state of each key."""
    return events.groupBy(key).agg(F.max_by(state, order).alias(state), F.max(order).alias(order))


def after_restart(status: Column) -> Column:
    """A job that had not ended when the server stopped has lost its process."""
    return F.when(status.isin(*ENDED), status).otherwise("orphaned")


def live(status: Column) -> Column:
    return status.isin(*LIVE)


def history(events: DataFrame, owner: str, text: str, order: str, most: int = 20) -> DataFrame:
    """The last `most` different texts of each owner, each where it came last, the newest first (turn 1)."""
    last = events.groupBy(owner, text).agg(F.max(order).alias(order))
    turn = F.row_number().over(Window.partitionBy(owner).orderBy(F.desc(order), text))
    return last.withColumn("turn", turn).where(F.col("turn") <= most)


def totals(rows: DataFrame, txns: str) -> DataFrame:
    """One row: rows, transactions, and transactions a row."""
    return rows.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(F.size(txns)), F.lit(0)).alias("n_txns")).withColumn("per_row", F.round(F.col("n_txns") / F.greatest("n_rows", F.lit(1)), 2))


def distinct_lines(lines: DataFrame, line: str, order: str) -> DataFrame:
    """Each exact line once, where it comes first. Lines are hashed before they are shuffled."""
    key = F.struct(F.xxhash64(line), F.md5(line))
    return lines.groupBy(key.alias("__k")).agg(F.min_by(line, order).alias(line), F.min(order).alias(order)).drop("__k")


def line_count(lines: DataFrame, line: str) -> DataFrame:
    return lines.agg(F.count_if(F.trim(F.regexp_replace(line, "[\t-\r]", " ")) != "").alias("n"))
