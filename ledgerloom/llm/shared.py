"""Helpers that the corpus operators share: scratch tables, word cutting, streaming over sorted groups."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: Everything but 0-9, A-Z, a-z and non-ASCII parts words; A-Z become a-z.
_CUT = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
#: Bytes of UTF-8 that a word hash keeps at most before it starts anew, so a worker's memory is bounded.
_CACHE_WORDS = 150_000


def words_of(text: bytes | str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a whole text, as UTF-8; null has none."""
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_CUT).split()


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words, in text order; a shorter text that has words is one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, np.uint64(0x9E3779B97F4A7C15 + width), np.uint64)
        for i in range(width):
            out = (out ^ hashes[i : n - width + 1 + i]) * np.uint64(0xD6E8FEB86659FD93)
            out ^= out >> np.uint64(32)
    return out


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder of spark.checkpoint.dir and reads it back: later plans start from those files,
    so a lost executor costs no recomputation. The folder is the cluster's scratch space; clear_scratch() empties it."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for scratch tables. A session that names none gets a folder of its own on a local master, as in
    tests; on a cluster that is an error, since executors share no other folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/ledgerloom-checkpoints"
    return f"{base.rstrip('/')}/ledgerloom"


def clear_scratch(spark: SparkSession) -> None:
    """Removes what scratch() has written. Call it when no result that reads those tables is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_names(columns: list[str], *names: str) -> list[str]:
    """Names like these that no column has, whatever its case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def every(columns: list[str]) -> "list[F.Column]":
    """The columns by name, dots in names and all."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id (long), th (hash of the text) and text. Both keys together stand for a row: rows that repeat both are
    the same document and fare alike. Other columns, whatever their names, stay behind."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text")).alias("th"),
        F.col("text").cast("string").alias("text"),
        *more,
    )


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A column of strings as UTF-8, undecoded."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


#: Rows that a Python function holds at once: lists of what it finds in them are many times as large as the rows.
PART_ROWS = 1024


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, without a copy."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(at, PART_ROWS)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> DataFrame:
    """mapInArrow: make() runs once a task and gives the function from a batch to columns by name."""
    arrow = to_arrow(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in parts_of(batches):
            yield to_batch(one(batch), arrow)

    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow for frames whose columns may have any names, dots among them: run() goes by their places."""
    names = schema.names

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(parts_of(batches)):
            yield pa.RecordBatch.from_arrays(batch.columns, names=names)

    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]).mapInArrow(named, schema)


def to_arrow(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def to_batch(columns: dict, arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)


def map_groups(
    df: DataFrame, keys: list[str], one: Callable[[tuple, dict[str, list]], dict[str, list]], schema: str
) -> DataFrame:
    """Runs one(key, columns) for each group of equal keys, in one pass over partitions sorted by the keys. A group must
    fit a task's memory: callers bound it. Cheaper than applyInPandas where groups are small and many."""
    arrow = to_arrow(df.sparkSession, schema)
    names = df.columns
    at = [names.index(k) for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in names]
        out: dict[str, list] = {f.name: [] for f in arrow}
        current: tuple | None = None

        def close() -> None:
            if current is not None:
                for k, v in one(current, dict(zip(names, held, strict=True))).items():
                    out[k].extend(v)

        for batch in parts_of(batches):
            columns = [c.to_pylist() for c in batch.columns]
            marks = list(zip(*(columns[i] for i in at), strict=True))
            start = 0
            for i, mark in enumerate(marks):
                if mark != current:
                    for h, c in zip(held, columns, strict=True):
                        h.extend(c[start:i])
                    close()
                    held, current, start = [[] for _ in names], mark, i
            for h, c in zip(held, columns, strict=True):
                h.extend(c[start:])
            if len(next(iter(out.values()))) >= 5000:
                yield to_batch(out, arrow)
                out = {f.name: [] for f in arrow}
        close()
        if any(out.values()):
            yield to_batch(out, arrow)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


#: Keys that more than a HOT_KEYS-th of a join's rows have are hot, so there are fewer of them than that. A key of
#: HOT_ROWS rows or less is none: a task holds them anyway.
HOT_KEYS = 1024
HOT_ROWS = 1024
#: Parts that the rows of a hot key are dealt over.
SPLITS = 256


def spread_join(rows: DataFrame, side: DataFrame, keys: list[str], by: list[str], counts: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """rows joined with side on keys, however many rows have one key. side has a row a key, with n, the number of rows
    that have it; counts has the keys and n too, where side itself is dear to compute twice. Hot keys, fewer than
    HOT_KEYS of them, are sent to all tasks; their rows are dealt over SPLITS parts by a hash of the columns `by`, and
    their row of side goes to each part. Rows with a null key match nothing and are dealt likewise. n doesn't come
    along."""
    counts = side if counts is None else counts
    part, hot = free_names(rows.columns + side.columns, "part", "hot")
    many = F.col("n") > max((counts.agg(F.sum("n")).head()[0] or 0) // HOT_KEYS, HOT_ROWS)
    marks = F.broadcast(counts.where(many).select(*keys, F.lit(True).alias(hot)))
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    dealt = F.when(F.col(hot) | missing, F.pmod(F.xxhash64(*by), F.lit(SPLITS)).cast("int")).otherwise(F.lit(0))
    left = rows.join(marks, keys, "left").withColumn(part, dealt).drop(hot)
    parts = F.when(many, F.sequence(F.lit(0), F.lit(SPLITS - 1))).otherwise(F.array(F.lit(0)))
    right = side.withColumn(part, F.explode(parts)).drop("n")
    return left.join(right.hint("merge"), [*keys, part], how).drop(part)


def fold(doc_id) -> "F.Column":
    """crc32 of the id as text, modulo 4; a null id has none."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def sampled(df: DataFrame, group: str, n: int) -> DataFrame:
    """At most n rows of each value of `group`, in the order of a hash of doc_id. Counts of the groups decide how many
    hashes are looked at, so about 4 n rows a group are shuffled, however many there are. Groups must be few."""
    counts = {r[group]: r["count"] for r in df.groupBy(group).count().collect()}
    h = F.xxhash64("doc_id", F.lit(11))
    share = F.lit(0.0)
    for value, count in counts.items():
        share = F.when(F.col(group) == F.lit(value), F.lit(min(1.0, 4 * n / count) if count > 8 * n else 1.0)).otherwise(share)
    near = df.where(F.pmod(h, F.lit(1_000_000)) < share * 1_000_000)
    turn = Window.partitionBy(group).orderBy(h, "doc_id", *[F.xxhash64(c) for c in df.columns if c not in ("doc_id", group)])
    return near.withColumn("__turn", F.row_number().over(turn)).where(F.col("__turn") <= n).drop("__turn")
