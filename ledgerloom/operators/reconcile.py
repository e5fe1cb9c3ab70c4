"""First-seen deduplication, pending work, and reconciliation of success and failure tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import jsonx
from ledgerloom.operators import select


def first_seen(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """One row of each key, that with the least order. A combined minimum, so a key with a third of all rows costs no
    task more than others. Null keys are one key."""
    row = F.struct(*[F.col(c) for c in rows.columns])
    kept = rows.groupBy(key.alias("__key")).agg(F.min_by(row, F.col(order)).alias("__row"))
    return kept.select("__row.*")


def drop_reason(raw: Column) -> Column:
    """The cleaning cascade on a raw JSON line, but for duplicates: null for a row to keep."""
    v = jsonx.json_value(raw)
    own = jsonx.keys(v)
    text = F.try_variant_get(v, "$.input", "variant")
    said = F.try_variant_get(v, "$.input", "string")
    out = F.try_variant_get(v, "$.output", "variant")
    is_text = F.coalesce(F.schema_of_variant(text) == "STRING", F.lit(False))
    is_object = lambda x: F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False))
    return (
        F.when(v.isNull(), "unparseable")
        .when(~is_object(v), "not_object")
        .when(~(F.array_contains(own, "input") & F.array_contains(own, "output")), "missing_keys")
        .when(~is_text | (F.trim(said) == ""), "bad_input")
        .when(~is_object(out), "output_not_object")
        .otherwise(jsonx.first_bucket(jsonx.schema_errors(out)))
    )


def split_side(key: Column, eval_percent: int = 10) -> Column:
    """`eval` or `train` by a hash of the key: stable when rows come or go."""
    return F.when(F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("long") % 100 < eval_percent, "eval").otherwise("train")


def split_exact(rows: DataFrame, order: str, eval_fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Parity mode for small tables: ordinals are shuffled on the driver as Python's random does, and joined back.
    Use split_side() beyond a few million rows."""
    import random

    ords = [r[0] for r in rows.select(order).orderBy(order).limit(5_000_001).collect()]
    if len(ords) > 5_000_000:
        raise ValueError("too many rows for an exact split; use split_side()")
    shuffled = list(range(len(ords)))
    random.Random(seed).shuffle(shuffled)
    n = max(1, round(len(ords) * eval_fraction))
    sides = [(ords[k], "eval" if place < n else "train") for place, k in enumerate(shuffled)]
    return rows.join(rows.sparkSession.createDataFrame(sides, f"`{order}` {dict(rows.dtypes)[order]}, side string"), order)


def pending(inputs: DataFrame, labeled: DataFrame, skip: DataFrame, key: str) -> DataFrame:
    """Inputs that are neither labeled nor to be skipped."""
    return inputs.join(labeled.select(key), key, "left_anti").join(skip.select(key), key, "left_anti")


def label_lookup(inputs: DataFrame, labels: DataFrame, key: str, label: str, order: str) -> DataFrame:
    """The label of each input, the last of several; empty text where there is none."""
    last = labels.groupBy(key).agg(F.max_by(label, order).alias(label))
    return inputs.join(last, key, "left").withColumn(label, F.coalesce(label, F.lit("")))


def mark_orphans(failed: DataFrame, train: DataFrame, key: str, mark: str = "labeled") -> DataFrame:
    """failed, and whether a row's key has been labeled since; rows without a key haven't. One join, so both sides of
    the answer come from one pass."""
    done = train.select(F.col(key).alias("__done")).where(F.col(key).isNotNull()).distinct()
    return failed.join(done, F.col(key) == F.col("__done"), "left").withColumn(mark, F.col("__done").isNotNull()).drop("__done")


def prune_orphans(failed: DataFrame, train: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Failed rows that stay (those without a key among them) and those whose key has been labeled since."""
    marked = mark_orphans(failed, train, key, "__labeled")
    return marked.where(~F.col("__labeled")).drop("__labeled"), marked.where("__labeled").drop("__labeled")


def merge_failed(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One failed row of each key: reason of the head (most telling reason, then most attempts, then first) and the
    attempts of all, the head's first, each (provider, model, raw_output, repair) once; a key with one row keeps its
    attempts as they are. Rows without a key all stay, as they are. A key's attempts are gathered: they are bounded by
    the retries of one input."""
    attempts = F.coalesce("attempts", F.array().cast(rows.schema["attempts"].dataType))
    ranked = rows.where(F.col(key).isNotNull()).select(key, "reason", attempts.alias("attempts"), F.struct(select.reason_rank(F.col("reason")).alias("r"), (-F.size(attempts)).alias("n"), F.col(order).alias("o")).alias("__rank"))
    heads = ranked.groupBy(key).agg(F.min("__rank").alias("__head"), F.collect_list(F.struct("__rank", "reason", "attempts")).alias("__rows"))
    # the head first, the others in their own order
    ordered = F.array_sort(F.transform("__rows", lambda x: F.struct((x["__rank"] != F.col("__head")).alias("later"), x["__rank"]["o"].alias("o"), x["reason"].alias("reason"), x["attempts"].alias("attempts"))))
    out = heads.select(key, ordered.alias("__o"))
    flat = F.flatten(F.transform("__o", lambda x: x["attempts"]))
    mark = lambda a: F.struct(a["provider"], a["model"], a["raw_output"], F.coalesce(a["is_repair_attempt"], F.lit(False)))
    out = out.withColumn("__flat", flat).withColumn("__marks", F.transform("__flat", mark))
    firsts = F.filter("__flat", lambda a, i: F.array_position("__marks", F.col("__marks")[i]) == i + 1)
    merged = out.select(key, F.col("__o")[0]["reason"].alias("reason"), F.when(F.size("__o") == 1, F.col("__flat")).otherwise(firsts).alias("attempts"))
    return merged.unionByName(rows.where(F.col(key).isNull()).select(key, "reason", attempts.alias("attempts")))


def same_amounts(a: Column, b: Column) -> Column:
    """Whether two arrays of doubles are equal as multisets within the tolerance; NaN equals nothing."""
    from ledgerloom.operators.validate import close

    pairs = F.arrays_zip(F.sort_array(a).alias("x"), F.sort_array(b).alias("y"))
    near = F.forall(pairs, lambda p: close(p["x"], p["y"]) & ~F.isnan(p["x"]) & ~F.isnan(p["y"]))
    return (F.size(a) == F.size(b)) & F.coalesce(near, F.lit(False))
