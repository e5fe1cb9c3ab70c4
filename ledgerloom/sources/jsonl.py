"""JSON Lines in and out. Files are read as text with a global order, since their order is meant."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerloom.functions import jsonx


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of spark.checkpoint.dir. On a local master a session that names none has a folder
    of its own, as in tests; on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/ledgerloom-checkpoints"
    return f"{base.rstrip('/')}/ledgerloom/{name}-{uuid.uuid4().hex}"


def found(spark: SparkSession, path: str) -> bool:
    """Whether there is a file of this name or pattern."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop))


def _all_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, ord, raw of each line, blank or not; none if there is no such file. ord is a struct: file, block, and a
    number that counts the lines of a block one by one, since a task reads it from end to end."""
    if not found(spark, path):
        return spark.createDataFrame([], "file string, ord struct<f:string,b:bigint,i:bigint>, raw string")
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")).alias("ord"),
        F.col("value").alias("raw"),
    )


def _blank(raw: str) -> Column:
    return F.trim(F.regexp_replace(raw, "[\t-\r]", " ")) == ""


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, ord (by file and place in it), raw for each non-blank line. ord is a struct to order by."""
    return _all_lines(spark, path).where(~_blank("raw"))


#: Blocks of files whose offsets are sent to all tasks: one of each 128 MB, so these are 256 TB.
MOST_BLOCKS = 2_000_000


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, ord, raw, line for each non-blank line; line is its number in its file from 1, blank lines counted. A first
    pass counts the lines of each block, a second adds what stands before it: no line is moved for it."""
    lines = _all_lines(spark, path)
    at = scratch(spark, "blocks")
    lines.groupBy("ord.f", "ord.b").agg(F.count("*").alias("n"), F.min("ord.i").alias("first")).write.parquet(at)
    blocks = spark.read.schema("f string, b long, n long, first long").parquet(at)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("f", "b", (before - F.col("first") + 1).alias("__start"))
    few = F.broadcast if blocks.count() <= MOST_BLOCKS else (lambda frame: frame)
    own = lines.where(~_blank("raw")).withColumns({"f": F.col("ord.f"), "b": F.col("ord.b")})
    return own.join(few(starts), ["f", "b"]).select("file", "ord", "raw", (F.col("ord.i") + F.col("__start")).alias("line"))


def line_numbers(rows: DataFrame, order: str = "ord", start: int = 0) -> DataFrame:
    """Adds `line`: numbers in the order of `order`, without bringing all rows to one task: rows are dealt by range and
    written once, so that counts and numbers go by the same ranges, and each range starts where those before it end."""
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id())
    at = scratch(spark, "ranges")
    ranged.write.parquet(at)
    ranged = spark.read.schema(ranged.schema).parquet(at)
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("n"), F.min("__i").alias("first")).collect()  # one row a partition
    end, offsets = start, []
    for r in sorted(sizes, key=lambda r: r["__p"]):
        offsets.append((r["__p"], end - r["first"]))
        end += r["n"]
    table = spark.createDataFrame(offsets or [(0, 0)], "__p int, __off long")
    return ranged.join(F.broadcast(table), "__p").withColumn("line", F.col("__i") + F.col("__off")).drop("__p", "__i", "__off")


def parsed(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds v (VARIANT, null if the line is no JSON) and malformed (why a line is no labelled row, or null)."""
    v = jsonx.json_value(F.col(raw))
    kind = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit(""))
    why = F.when(v.isNull(), "bad_json").when(kind("$.input") != "STRING", "bad_input").when(~kind("$.output").startswith("OBJECT"), "bad_output")
    return rows.withColumn("v", v).withColumn("malformed", why)


def read_inputs(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """input and state (ok, bad_json, bad_shape) of each line."""
    v = jsonx.json_value(F.col(raw))
    text = F.try_variant_get(v, "$.input", "string")
    is_text = F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.input", "variant")) == "STRING", F.lit(False))
    state = F.when(v.isNull(), "bad_json").when(~is_text | (F.trim(text) == ""), "bad_shape").otherwise("ok")
    return rows.withColumn("state", state).withColumn("input", F.when(state == "ok", text))


def read_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON Lines of a trusted schema; a bad line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small file that holds one JSON array; an empty table if there is none, or if it holds anything else."""
    if not found(spark, path):
        return spark.createDataFrame([], schema)
    text = spark.read.option("wholetext", True).text(path)
    is_array = F.coalesce(F.schema_of_variant(jsonx.json_value(F.col("value"))).startswith("ARRAY"), F.lit(False))
    return text.where(is_array).select(F.inline(F.from_json("value", f"array<struct<{schema}>>")))


def write_array(rows: DataFrame, path: str) -> None:
    """One JSON array as a file in a folder, in place of what is there: for tables as small as flags are."""
    columns = F.struct(*rows.columns)
    rows.agg(F.coalesce(F.to_json(F.collect_list(columns), {"ignoreNullFields": "false"}), F.lit("[]")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write(rows: DataFrame, path: str, append: bool = False) -> None:
    """JSON Lines, non-ASCII as it is."""
    rows.write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def rewrite(rows: DataFrame, path: str) -> None:
    """Replaces a folder that rows may be read from: written beside it first, the old one kept as `.bak`."""
    spark = rows.sparkSession
    fs_path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    write(rows, f"{path}.new")
    fs.delete(fs_path(f"{path}.bak"), True)
    if fs.exists(fs_path(path)):
        fs.rename(fs_path(path), fs_path(f"{path}.bak"))
    fs.rename(fs_path(f"{path}.new"), fs_path(path))


def labelled_inputs(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Distinct inputs of lines that have one."""
    return read_inputs(rows, raw).where("state = 'ok'").select("input").distinct()


def inputs_summary(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """One row: lines that are inputs, that are no JSON, and that have no text as input."""
    state = read_inputs(rows, raw)
    return state.agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("ok", "bad_json", "bad_shape")])


def said_lines(text: Column) -> Column:
    """Lines of a model's answer but for blank and fence lines."""
    return F.filter(F.split(text, "\n"), lambda x: (F.trim(x) != "") & ~F.trim(x).startswith("```"))


def response_dropped(text: Column) -> Column:
    """How many lines of an answer response_rows() leaves out, blank and fence lines aside."""
    return F.size(said_lines(text)) - F.size(response_rows(text))


def response_rows(text: Column) -> Column:
    """JSON lines of a model's answer that have input and output; blank and fence lines are skipped."""
    lines = said_lines(text)
    own = lambda x: jsonx.keys(jsonx.json_value(x))
    return F.filter(lines, lambda x: F.coalesce(F.array_contains(own(x), "input") & F.array_contains(own(x), "output"), F.lit(False)))


def fixture_labels(rows: DataFrame, raw: str = "raw", order: str = "ord") -> DataFrame:
    """input and label of a fixture, the last of each input: raw_output as it stands, else output as compact JSON. A line
    without a text as input, or without either, fails the read."""
    v = jsonx.json_value(F.col(raw))
    kind = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit(""))
    own = jsonx.keys(v)
    label = F.when(kind("$.raw_output") == "STRING", F.try_variant_get(v, "$.raw_output", "string")).when(
        ~F.array_contains(own, "raw_output") & F.array_contains(own, "output"), F.to_json(F.try_variant_get(v, "$.output", "variant"))
    )
    fault = F.concat(F.lit("fixture line needs a text as input, and output or a text as raw_output: "), F.col(raw))
    good = (kind("$.input") == "STRING") & label.isNotNull()
    checked = rows.select(F.col(order).alias("__o"), F.when(F.coalesce(good, F.lit(False)), F.struct(F.try_variant_get(v, "$.input", "string").alias("input"), label.alias("label"))).otherwise(F.raise_error(fault).cast("struct<input:string,label:string>")).alias("__r"))
    return checked.groupBy("__r.input").agg(F.max_by("__r.label", "__o").alias("label"))


def cursor(fixture: DataFrame, calls: DataFrame, ordinal: str, text: str = "input", order: str = "ord") -> DataFrame:
    """What a fixture of inputs gives to the n-th call: its rows in turn, from the first again after the last."""
    numbered = line_numbers(fixture, order).select(F.col("line").alias("__slot"), text)
    size = fixture.count()
    if not size:
        return calls.withColumn(text, F.lit(None).cast("string")).limit(0)
    return calls.withColumn("__slot", F.pmod(F.col(ordinal), F.lit(size))).join(numbered, "__slot").drop("__slot")
