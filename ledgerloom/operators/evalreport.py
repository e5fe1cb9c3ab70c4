"""Evaluation summaries: rates, failure buckets, confusion, best variants, deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import text
from ledgerloom.operators import metrics


def failure_bucket(json_valid: Column, schema_valid: Column, exact: Column) -> Column:
    return F.when(~json_valid, "json_invalid").when(~schema_valid, "schema_invalid").when(~exact, "semantic_mismatch")


#: Flags of an evaluated row, and what failed first.
FLAGS = ("json_valid", "schema_valid", "exact_match", "amount_exact", "txn_count_exact", "duplicate_transactions_found", "superseded_amount_used")
BUCKETS = ("json_invalid", "schema_invalid", "semantic_mismatch")


def summary(results: DataFrame, *keys: str, flags: tuple[str, ...] = ("json_valid", "schema_valid", "exact_match")) -> DataFrame:
    """Rows, and count and percentage of each flag."""
    n = F.count("*")
    out = [n.alias("n")]
    for f in flags:
        out += [F.count_if(f).alias(f), text.percent(F.count_if(f), n).alias(f"{f}_pct")]
    return results.groupBy(*keys).agg(*out)


def full_summary(results: DataFrame, *keys: str, latency: str = "latency_ms") -> DataFrame:
    """Rows, all flags with percentages, how many rows failed at each step first, mean latency and its 95th percentile
    (rule a). Groups of any size: the percentile is found without gathering a group."""
    bucket = failure_bucket(F.col("json_valid"), F.col("schema_valid"), F.col("exact_match"))
    marked = results.withColumns({f"__{b}": F.coalesce(bucket == b, F.lit(False)) for b in BUCKETS})
    n = F.count("*")
    out = [n.alias("n")]
    for f in FLAGS:
        out += [F.count_if(f).alias(f), text.percent(F.count_if(f), n).alias(f"{f}_pct")]
    out += [F.count_if(f"__{b}").alias(b) for b in BUCKETS]
    rates = marked.groupBy(*keys).agg(*out, F.coalesce(F.avg(latency), F.lit(0.0)).alias("mean_ms"))
    late = metrics.order_statistics(results, [*keys], latency, {"p95_ms": metrics.RULES_A["p95_eval"]}).drop("n")
    return rates.join(late, [*keys], "left").withColumn("p95_ms", F.coalesce("p95_ms", F.lit(0.0)))


def confusion_pairs(rows: DataFrame, expected: str, predicted: str) -> DataFrame:
    """Pairs (expected, predicted) of equal place of two arrays, from rows where the arrays have one length."""
    pairs = positional_pairs(F.col(expected), F.col(predicted))
    return rows.where(pairs.isNotNull()).select(F.inline(pairs)).toDF("expected", "predicted")


def eligible(rows: DataFrame, expected: str, predicted: str) -> DataFrame:
    """One row: how many rows there are, and how many are in the confusion matrix."""
    fits = F.coalesce(F.size(expected) == F.size(predicted), F.lit(False))
    return rows.agg(F.count("*").alias("n"), F.count_if(fits).alias("eligible"))


def confusion(pairs: DataFrame, expected: str, predicted: str, classes: list) -> DataFrame:
    """Counts by expected (rows) and predicted class (columns, in order); rows without a count don't appear."""
    wide = pairs.where(F.col(expected).isin(classes)).groupBy(expected)
    return wide.agg(*[F.count_if(F.col(predicted) == c).alias(f"p_{c}") for c in classes])


def positional_pairs(expected: Column, predicted: Column) -> Column:
    """Pairs of equal place from two arrays of the same size; none if sizes differ."""
    zipped = F.arrays_zip(expected.alias("e"), predicted.alias("p"))
    return F.when(F.size(expected) == F.size(predicted), zipped)


def best_variant(summaries: DataFrame, model: str) -> DataFrame:
    """The variant of each model with the highest schema rate, then exact rate, then lowest mean latency, then name."""
    order = F.struct((-F.col("schema_pct")).alias("s"), (-F.col("exact_pct")).alias("e"), F.col("mean_ms").alias("m"), F.col("variant").alias("v"))
    row = F.struct(*[F.col(c) for c in summaries.columns if c != model])
    return summaries.groupBy(model).agg(F.min_by(row, order).alias("__b")).select(model, "__b.*")


def report_order(variant: Column, known: tuple[str, ...]) -> Column:
    """Sort key: place in the list of known variants, unknown ones last."""
    at = F.array_position(F.array(*map(F.lit, known)), variant)
    return F.when(at > 0, at).otherwise(len(known) + 1)


def deltas(values: DataFrame, name: str, side: str, value: str, base: str, other: str) -> DataFrame:
    """Value by name on either side, and their difference."""
    at = lambda s: F.max(F.when(F.col(side) == s, F.col(value)))
    return values.groupBy(name).agg(at(base).alias(base), at(other).alias(other)).withColumn("delta", F.round(F.col(other) - F.col(base), 4))


def report_markdown(rows: list[dict], columns: list[str]) -> str:
    """A table of a few summary rows, on the driver."""
    lines = ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    lines += ["| " + " | ".join(str(r[c]) for c in columns) + " |" for r in rows]
    return "\n".join(lines) + "\n"


def report(summaries: list[dict], title: str, order: tuple[str, ...]) -> str:
    """A report of summaries (model, variant, size, n, the flags' percentages, mean_ms, p95_ms): all of them in one
    table, then for each model its best variant and the details. Models by name, variants in a known order."""
    place = {v: k for k, v in enumerate(order)}
    rows = sorted(summaries, key=lambda r: (r["model"], place.get(r["variant"], len(order)), r["variant"]))
    part = lambda r, *flags: [f"{r[f + '_pct']:.1f}%" for f in flags]
    late = lambda r: [f"{r['mean_ms']:.0f}", f"{r['p95_ms']:.0f}"]

    def table(head: list[str], body: list[list[str]]) -> list[str]:
        line = lambda cells: "| " + " | ".join(cells) + " |"
        return [line(head), "|" + "---|" * len(head), *map(line, body), ""]

    out = [f"# {title}", "", f"Examples: {rows[0]['n'] if rows else 0}", "", "## Summary", ""]
    out += table(
        ["Model", "Variant", "Size", "JSON valid", "Schema valid", "Exact match", "Amount exact", "Mean ms", "P95 ms"],
        [[r["model"], r["variant"], str(r.get("size", "")), *part(r, "json_valid", "schema_valid", "exact_match", "amount_exact"), *late(r)] for r in rows],
    )
    out += ["## Models", ""]
    for model in dict.fromkeys(r["model"] for r in rows):
        own = [r for r in rows if r["model"] == model]
        best = min(own, key=lambda r: (-r["schema_valid_pct"], -r["exact_match_pct"], r["mean_ms"]))
        out += [f"### {model}", "", f"Best: {best['variant']} ({best['schema_valid_pct']:.1f}% schema valid, {best['mean_ms']:.0f} ms on average)", ""]
        out += table(
            ["Variant", "Schema", "Exact", "Amount", "Count", "Duplicates", "Superseded", "Mean ms", "P95 ms"],
            [[r["variant"], *part(r, "schema_valid", *FLAGS[2:]), *late(r)] for r in own],
        )
    return "\n".join(out)


def discover(paths: DataFrame, path: str, models: tuple[str, ...] = (), quant: str | None = None, folders: str = "student-") -> DataFrame:
    """Files of models (.gguf) by path: of these models' folders (all if none is named), and of a quantization."""
    stem = F.upper(F.regexp_replace(F.element_at(F.split(path, "/"), -1), "\\.[^.]*$", ""))
    keep = F.lower(path).endswith(".gguf")
    if models:
        keep &= F.arrays_overlap(F.split(path, "/"), F.array(*[F.lit(folders + m) for m in models]))
    if quant:
        keep &= F.contains(stem, F.lit(quant.upper()))
    return paths.where(keep)


def uncached(wanted: DataFrame, results: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """What has no result yet; all if forced."""
    return wanted if force else wanted.join(results.select(*keys).distinct(), keys, "left_anti")


def with_found(results: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """Results with whether their model has been found."""
    have = found.select(F.col(name).alias("__name")).distinct()
    return results.join(have, F.col(name) == F.col("__name"), "left").withColumn("found", F.col("__name").isNotNull()).drop("__name")
