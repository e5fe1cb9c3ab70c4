"""Run metrics, prices and the three percentile rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F


def price_keys(provider_type: Column, model: Column) -> Column:
    """Keys under which a price is looked for, the most special first."""
    special = F.when(model.isNotNull() & (model != ""), F.array(F.concat(provider_type, F.lit(":"), model), model)).otherwise(F.array().cast("array<string>"))
    return F.concat(special, F.array(provider_type, F.lit("default")))


def price(prices: dict[str, tuple[float, float]], provider_type: Column, model: Column, side: int) -> Column:
    """Price a million tokens, in (side 0) or out (side 1); 0 where no key is known. prices is a bounded config map."""
    table = F.create_map(*[x for k, v in prices.items() for x in (F.lit(k), F.lit(float(v[side])))]) if prices else F.create_map().cast("map<string,double>")
    found = F.filter(F.transform(price_keys(provider_type, model), lambda k: F.try_element_at(table, k)), lambda p: p.isNotNull())
    return F.coalesce(F.get(found, F.lit(0)), F.lit(0.0))


def _at(values: Column, k: Column) -> Column:
    """values[k] of a sorted array; k = -1 is the last."""
    return F.element_at(values, F.when(k < 0, F.lit(-1)).otherwise(k + 1).cast("int"))


def p95_eval(values: Column) -> Column:
    """Rule a, on a sorted array: index int(.95 n) - 1, zeros included; 0 if empty."""
    k = F.floor(F.size(values) * 0.95) - 1
    return F.when(F.size(values) == 0, 0.0).otherwise(_at(values, k))


def p50_report(values: Column) -> Column:
    """Rule b, on a sorted array, zeros excluded: index n // 2."""
    v = F.filter(values, lambda x: x > 0)
    return F.when(F.size(v) == 0, 0.0).otherwise(_at(v, F.floor(F.size(v) / 2)))


def p95_report(values: Column) -> Column:
    v = F.filter(values, lambda x: x > 0)
    return F.when(F.size(v) < 2, 0.0).otherwise(_at(v, F.floor(F.size(v) * 0.95) - 1))


def _exclusive(v: Column, i: int) -> Column:
    """The i-th of 19 cut points by the exclusive rule, on a sorted array."""
    m = F.size(v) + 1
    j = F.least(F.greatest(F.floor(m * i / 20), F.lit(1)), F.size(v) - 1)
    d = m * i - j * 20
    return (_at(v, j - 1) * (20 - d) + _at(v, j) * d) / 20


def p50_metrics(v: Column) -> Column:
    """Rule c, on a sorted array: the median below 20 values, the exclusive cut point from 20 on."""
    n = F.size(v)
    median = (_at(v, F.floor((n - 1) / 2)) + _at(v, F.floor(n / 2))) / 2
    return F.when(n == 0, 0.0).when(n < 20, median).otherwise(_exclusive(v, 10))


def p95_metrics(v: Column) -> Column:
    n = F.size(v)
    return F.when(n == 0, 0.0).when(n < 20, _at(v, n - 1)).otherwise(_exclusive(v, 19))


def order_statistics(rows: DataFrame, keys: list[str], value: str, wanted: dict[str, Callable[[Column], Column]], bins: int = 500) -> DataFrame:
    """Exact order statistics of groups of any size: for each name the value at the index (from 0) that its function
    gives from the group's size n; null where that is outside. Nulls are left out.

    A group isn't gathered: equal values are counted first, a sketch cuts a group into `bins` ranges of about equal
    size, offsets of the ranges are summed, and ranks are taken within a range alone."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("__v")).agg(F.count("*").alias("__c"))
    cuts = rows.groupBy(*keys).agg(F.percentile_approx(value, [k / bins for k in range(1, bins)], 10 * bins).alias("__cuts"))
    binned = counts.join(cuts, keys).withColumn("__bin", F.aggregate("__cuts", F.lit(0), lambda s, x: s + (x < F.col("__v")).cast("int"))).drop("__cuts")
    by_bin = binned.groupBy(*keys, "__bin").agg(F.sum("__c").alias("__n"))
    over = Window.partitionBy(*keys)  # `bins` rows of each key at most
    offsets = by_bin.withColumn("__before", F.sum("__n").over(over.orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1))).withColumn("n", F.sum("__n").over(over)).drop("__n")
    run = Window.partitionBy(*keys, "__bin").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = binned.join(offsets, [*keys, "__bin"]).withColumn("__upto", F.coalesce("__before", F.lit(0)) + F.sum("__c").over(run))
    pick = lambda k: F.min(F.when((F.col("__upto") > k) & (k >= 0), F.col("__v")))
    return ranked.groupBy(*keys).agg(F.first("n").alias("n"), *[pick(f(F.col("n"))).alias(name) for name, f in wanted.items()])


#: Indices that the rules take from a group of n values.
RULES_A = {"p95_eval": lambda n: F.when(F.floor(n * 0.95) < 1, n - 1).otherwise(F.floor(n * 0.95) - 1)}
RULES_B = {"p50_report": lambda n: F.floor(n / 2), "p95_report": lambda n: F.when(n < 2, -1).otherwise(F.when(F.floor(n * 0.95) < 1, n - 1).otherwise(F.floor(n * 0.95) - 1))}


def _cut(i: int, up: int) -> Callable[[Column], Column]:
    return lambda n: F.least(F.greatest(F.floor((n + 1) * i / 20), F.lit(1)), n - 1) - 1 + up


RULES_C = {
    "__lo": lambda n: F.floor((n - 1) / 2), "__hi": lambda n: F.floor(n / 2), "__max": lambda n: n - 1,
    "__a10": _cut(10, 0), "__b10": _cut(10, 1), "__a19": _cut(19, 0), "__b19": _cut(19, 1),
}


def metric_percentiles(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rule c for groups of any size: keys, p50_ms, p95_ms."""
    s = order_statistics(rows, keys, value, RULES_C)
    n = F.col("n")

    def exclusive(i: int) -> Column:
        j = F.least(F.greatest(F.floor((n + 1) * i / 20), F.lit(1)), n - 1)
        d = (n + 1) * i - j * 20
        return (F.col(f"__a{i}") * (20 - d) + F.col(f"__b{i}") * d) / 20

    few = n < 20
    return s.select(*keys, F.when(few, (F.col("__lo") + F.col("__hi")) / 2).otherwise(exclusive(10)).alias("p50_ms"), F.when(few, F.col("__max")).otherwise(exclusive(19)).alias("p95_ms"))


def provider_metrics(calls: DataFrame, candidates: DataFrame, prices: dict[str, tuple[float, float]]) -> DataFrame:
    """One row a provider: calls, failures, tokens, cost, latency percentiles (rule c) and acceptance."""
    cost = F.col("prompt_tokens") * price(prices, F.col("provider_type"), F.col("model"), 0) + F.col("completion_tokens") * price(prices, F.col("provider_type"), F.col("model"), 1)
    by_call = calls.groupBy("provider").agg(
        F.count("*").alias("calls"),
        F.count_if("success").alias("ok"),
        F.count_if(~F.col("success")).alias("failed"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.bool_or("estimated_tokens").alias("any_estimated"),
        F.round(F.sum(cost) / 1e6, 4).alias("cost"),
    )
    by_call = by_call.join(metric_percentiles(calls, ["provider"], "latency_ms"), "provider", "left").fillna(0.0, ["p50_ms", "p95_ms"])
    by_call = by_call.withColumn("failure_rate", F.round(F.col("failed") / F.col("calls"), 4))
    by_candidate = candidates.groupBy("provider").agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = by_call.join(by_candidate, "provider", "left").select(*by_call.columns, zero("accepted"), zero("rejected"))
    whole = F.col("accepted") + F.col("rejected")
    return out.withColumn("acceptance_rate", F.when(whole > 0, F.round(F.col("accepted") / whole, 4)).otherwise(0.0))


def totals(by_provider: DataFrame) -> DataFrame:
    """Sums over providers; the cost is the sum of the rounded costs."""
    return by_provider.agg(*[F.sum(c).alias(c) for c in ("calls", "ok", "failed", "prompt_tokens", "completion_tokens", "cost", "accepted", "rejected")])


def failure_histogram(calls: DataFrame, candidates: DataFrame, *keys: str) -> DataFrame:
    both = calls.select(*keys, "failure_reason").unionByName(candidates.select(*keys, "failure_reason"))
    return both.where(F.col("failure_reason").isNotNull()).groupBy(*keys, "failure_reason").agg(F.count("*").alias("n"))


def top_failures(histogram: DataFrame, key: str) -> DataFrame:
    """The most frequent failure of each key, the first by name on a tie."""
    return histogram.groupBy(key).agg(F.min_by(F.struct("failure_reason", "n"), F.struct((-F.col("n")).alias("m"), "failure_reason")).alias("__t")).select(key, "__t.*")


def run_summary(calls: DataFrame, candidates: DataFrame, seconds: float, inputs: int) -> DataFrame:
    """One row of a run: calls, attempts at repair and those accepted, and throughput. calls: success, attempt_type;
    candidates: accepted, is_repair_attempt. Two tables, each aggregated once."""
    c = calls.agg(F.count("*").alias("calls"), F.count_if("success").alias("ok"), F.count_if(~F.col("success")).alias("failed"), F.count_if(F.col("attempt_type") == "repair").alias("repair_attempts"))
    k = candidates.agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"), F.count_if(F.col("accepted") & F.col("is_repair_attempt")).alias("repair_accepted"))
    rate = lambda n: F.round(n / F.lit(seconds), 4) if seconds > 0 else F.lit(0.0)
    both = c.join(k, F.lit(True))  # one row each
    return both.withColumns({"calls_per_sec": rate(F.col("calls")), "inputs_per_sec": rate(F.lit(float(inputs)))})


def as_document(run: dict, totals_: dict, providers: list[dict], failures: dict[str, int], repair: dict | None) -> dict:
    """The metrics of a run as one object. All parts are small."""
    out = {"run": run, "totals": totals_, "providers": {p["provider"]: {k: v for k, v in p.items() if k != "provider"} for p in providers}, "failures": dict(failures)}
    return out | ({"repair": repair} if repair is not None else {})


def as_table(document: dict, top: dict[str, str]) -> str:
    """The metrics of a run as text: a head, a line a provider in columns, and repairs of a label run."""
    run, whole, label = document["run"], document["totals"], document["run"]["phase"] == "label"
    minutes, seconds = divmod(run["duration_ms"] // 1000, 60)
    took = f"{minutes}m{seconds:02d}s" if minutes else f"{seconds}s"
    wrote = f"Accepted: {whole['accepted']}  Failed rows: {whole['failed_rows']}" if label else f"Input rows: {whole['input_rows']}"
    lines = [
        f"Run ({run['phase']}): {run['inputs']} inputs, {took}",
        f"Calls: {whole['calls']} ({whole['ok']} ok, {whole['failed']} failed)  {wrote}",
        f"Estimated cost: ${whole['cost']:.4f} (prices: {run.get('prices') or 'none, all free'})",
        "",
    ]
    columns: list[tuple[str, Callable[[str, dict], str]]] = [("Provider", lambda n, p: n), ("Calls", lambda n, p: str(p["calls"])), ("Ok", lambda n, p: str(p["ok"])), ("Fail%", lambda n, p: f"{100 * p['failure_rate']:.2f}%")]
    columns += [("Acc", lambda n, p: str(p.get("accepted", 0)))] * label
    columns += [("Cost", lambda n, p: f"${p['cost']:.4f}"), ("p50", lambda n, p: str(int(p["p50_ms"]))), ("p95", lambda n, p: str(int(p["p95_ms"])))]
    columns += [("Top failure", lambda n, p: top.get(n, "-"))] * label
    rows = [[name for name, _ in columns]] + [[cell(n, p) for _, cell in columns] for n, p in document["providers"].items()]
    wide = [max(map(len, column)) for column in zip(*rows, strict=True)]
    lines += ["  ".join(["", *(x.ljust(w) for x, w in zip(row, wide, strict=True))]).rstrip() for row in rows]
    if label and "repair" in document:
        r = document["repair"]
        lines += ["", f"Repairs: {r['attempts']} tried, {r['accepted']} accepted, {r['exhausted']} exhausted"]
    return "\n".join(lines)


def keep_rate(kept: Column, attempted: Column) -> Column:
    return kept / F.greatest(attempted, F.lit(1))
