"""Quotas and orders of work among weighted providers. All are closed forms over a small table of providers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def quota(providers: DataFrame, total: int, idx: str = "idx", weight: str = "weight") -> DataFrame:
    """Largest remainder: floors of the shares, then one more by remainder, then index. Adds `quota`; sums to total.
    Weights are whole numbers, so remainders are exact."""
    whole = Window.partitionBy()
    w = F.sum(weight).over(whole)
    rows = providers.withColumn("__w", w).withColumn("__floor", F.expr(f"({total} * {weight}) div __w")).withColumn("__rest", F.expr(f"({total} * {weight}) % __w"))
    rows = rows.withColumn("__left", F.lit(total) - F.sum("__floor").over(whole)).withColumn("__turn", F.row_number().over(whole.orderBy(F.desc("__rest"), idx)))
    return rows.withColumn("quota", (F.col("__floor") + F.when(F.col("__turn") <= F.col("__left"), 1).otherwise(0)).cast("long")).drop("__w", "__floor", "__rest", "__left", "__turn")


def cycle(providers: DataFrame, idx: str = "idx", weight: str = "weight", most: int = 100_000) -> DataFrame:
    """Weighted interleave: the k-th of w turns of a provider comes at k / w of the cycle, ties by index. Adds `slot`
    from 0. Weights are first divided by their common divisor; a cycle of more than `most` slots is an error. The table
    of providers is small: its weights are summed up in one group."""
    gcd = lambda a, b: F.aggregate(F.sequence(F.lit(1), F.lit(64)), F.struct(a.alias("x"), b.alias("y")), lambda s, _: F.when(s["y"] == 0, s).otherwise(F.struct(s["y"].alias("x"), F.pmod(s["x"], F.greatest(s["y"], F.lit(1))).alias("y"))))["x"]
    common = providers.agg(F.aggregate(F.collect_list(F.col(weight).cast("long")), F.lit(0).cast("long"), gcd).alias("__g"), F.sum(weight).alias("__sum"))
    slots = (F.col("__sum") / F.col("__g")).cast("long")
    turns = F.when(slots > most, F.raise_error(F.concat(F.lit("a cycle has too many slots: "), slots)).cast("int")).otherwise((F.col(weight) / F.col("__g")).cast("int"))
    rows = providers.join(F.broadcast(common), F.col("__g") > 0).withColumn("__w", turns)
    rows = rows.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__w"))))
    order = Window.partitionBy().orderBy((F.col("__k").cast("double") / F.col("__w")), idx)
    return rows.withColumn("slot", F.row_number().over(order) - 1).drop("__k", "__w", "__g", "__sum")


def spread(weights: list[int]) -> list[int]:
    """Weights divided by their greatest common divisor."""
    import math

    if not weights or min(weights) < 0 or sum(weights) == 0:
        raise ValueError("weights must be whole, not negative and not all 0")
    g = math.gcd(*weights)
    return [w // g for w in weights]


def quota_of(weights: list[int], total: int) -> list[int]:
    """quota() of a few weights, on the driver."""
    whole = sum(weights)
    shares = [total * w // whole for w in weights]
    by_rest = sorted(range(len(weights)), key=lambda k: (-(total * weights[k] % whole), k))
    for k in by_rest[: total - sum(shares)]:
        shares[k] += 1
    return shares


def turns(weights: list[int]) -> list[int]:
    """cycle() of a few weights, on the driver: the index of each slot's provider."""
    own = spread(weights)
    return [k for _, k in sorted(((n + 1) / w, k) for k, w in enumerate(own) for n in range(w))]


def assign(rows: DataFrame, slots: DataFrame, length: int, ordinal: str = "ord") -> DataFrame:
    """The provider of the n-th call: slot n modulo the cycle's length. slots has `length` rows, one a slot."""
    return rows.withColumn("slot", F.pmod(F.col(ordinal), F.lit(length)).cast("int")).join(F.broadcast(slots) if length <= 100_000 else slots, "slot")


def rotation(turn: Column, kinds: int = 25) -> Column:
    """Round robin over `kinds` from a turn that counts from 1."""
    return F.pmod(turn - 1, F.lit(kinds))


def backoff(attempt: Column, base: float, most: float) -> Column:
    """Seconds before a further attempt (from 0), without jitter."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), attempt))
