"""Semantic validation of labels against the amounts of their input, as column expressions.

txns: typed transactions; amounts: what functions.amounts gives. An amount matches a transaction within a relative
1e-9 or an absolute 0.001, whichever is more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: What in an input justifies a repeated transaction, as substrings.
REPEAT_CUES = ("twice", "2x", "two times", "do baar", "again", "another", "aur ek", "phir se")
ERRORS = "array<struct<code:string,path:string,severity:string>>"


def close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.greatest(1e-9 * F.greatest(F.abs(a), F.abs(b)), F.lit(0.001))


def _error(code: str, path: Column, severity: str = "error") -> Column:
    return F.struct(F.lit(code).alias("code"), path.alias("path"), F.lit(severity).alias("severity"))


def _path(i: Column, field: str = "") -> Column:
    return F.concat(F.lit("/transactions/"), i.cast("string"), F.lit(field))


def _none() -> Column:
    return F.array().cast(ERRORS)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once: an expression that a lambda names is computed anew for each element."""
    return F.transform(F.array(value), body)[0]


def repeats(text: Column, txns: Column, amounts: Column) -> Column:
    """The check of repeated transactions alone, for a label without schema errors."""
    key = lambda t: F.struct(F.round(t["amount"], 3), F.lower(F.trim(t["item"])), t["category"], t["type"], t["currency"])

    def of_keys(keys: Column) -> Column:
        def of_repeat(t: Column, i: Column) -> Column:
            same = F.size(F.filter(keys, lambda k: k == keys[i]))
            first = F.array_position(keys, keys[i]) == i + 1
            cue = F.lower(text).rlike("|".join(REPEAT_CUES))
            named = F.regexp_count(F.lower(text), F.concat(F.lit("(?U)\\b\\Q"), F.lower(F.trim(t["item"])), F.lit("\\E\\b")))
            spoken = F.size(F.filter(amounts, lambda a: close(a["value"], F.round(t["amount"], 3))))
            return _let(same, lambda n: F.when((n > 1) & ~first & ~cue & ~((spoken >= n) & (named >= n)), _error("SUSPICIOUS_DUPLICATE", _path(i))))

        return F.array_compact(F.transform(txns, of_repeat))

    return F.when(F.size(txns) > 1, _let(F.transform(txns, key), of_keys)).otherwise(_none())


def validate(text: Column, txns: Column, amounts: Column, schema_errors: Column) -> Column:
    """Errors in the order of the checks. A label with schema errors has those alone."""
    each = lambda f: F.array_compact(F.transform(txns, f))

    def of_amount(t: Column, i: Column) -> Column:
        return _let(
            F.filter(amounts, lambda a: close(a["value"], t["amount"])),
            lambda near: F.when(F.size(near) == 0, _error("AMOUNT_NOT_IN_INPUT", _path(i, "/amount")))
            .when(F.forall(near, lambda a: a["status"] == "superseded"), _error("SUPERSEDED_AMOUNT_USED", _path(i, "/amount"))),
        )

    def of_active(active: Column) -> Column:
        unmatched = F.when((F.size(active) == 0) & (F.size(txns) > 0), F.array(_error("NO_AMOUNT_IN_INPUT", F.lit("/transactions"))))

        def of_currency(t: Column, i: Column) -> Column:
            hints = F.array_compact(F.transform(F.filter(active, lambda a: close(a["value"], t["amount"])), lambda a: a["currency_hint"]))
            return _let(hints, lambda h: F.when((F.size(h) > 0) & ~F.array_contains(h, t["currency"]), _error("CURRENCY_MISMATCH", _path(i, "/currency"))))

        count = (
            F.when(F.size(txns) > F.size(active), F.array(_error("TXN_COUNT_EXCEEDS_CANDIDATES", F.lit("/transactions"))))
            .when(F.size(txns) < F.size(active), F.array(_error("TXN_COUNT_BELOW_CANDIDATES", F.lit("/transactions"), "warning")))
            .otherwise(_none())
        )
        return F.concat(F.coalesce(unmatched, each(of_amount)), each(of_currency), count)

    semantic = F.concat(_let(F.filter(amounts, lambda a: a["status"] == "active"), of_active), repeats(text, txns, amounts))
    structural = F.transform(schema_errors, lambda e: _error("SCHEMA_INVALID", e["path"]))
    return F.when(F.size(schema_errors) > 0, structural).otherwise(semantic)


def codes(errors: Column, severity: str | None = None) -> Column:
    return F.transform(errors if severity is None else F.filter(errors, lambda e: e["severity"] == severity), lambda e: e["code"])


def probe(rows: DataFrame, malformed: str = "malformed", errors: str = "errors") -> DataFrame:
    """kind, name, n of checked lines: kind `rows` with scanned, malformed, ok and failed; `failure` and `warning` by code.
    A line that is malformed has no errors; one without an error is ok, whatever its warnings. One pass: a line's marks
    are counted together. Order by kind, n descending, name for a report."""
    mark = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
    bad, found = F.col(malformed).isNotNull(), F.col(errors)
    state = F.when(bad, "malformed").when(F.size(codes(found, "error")) > 0, "failed").otherwise("ok")
    by_code = lambda kind, severity: F.transform(codes(found, severity), lambda c: mark(kind, c))
    marks = F.concat(F.array(mark("rows", F.lit("scanned")), mark("rows", state)), F.when(~bad, F.concat(by_code("failure", "error"), by_code("warning", "warning"))).otherwise(F.array().cast("array<struct<kind:string,name:string>>")))
    return rows.select(F.inline(marks)).groupBy("kind", "name").agg(F.count("*").alias("n"))


def result(errors: Column, mode: str = "strict") -> Column:
    """ok and the flags. mode `warn`: always ok, errors kept."""
    has = lambda *c: F.arrays_overlap(codes(errors), F.array(*map(F.lit, c)))
    invalid = has("SCHEMA_INVALID")
    ok = F.lit(True) if mode == "warn" else F.size(codes(errors, "error")) == 0
    return F.struct(
        ok.alias("ok"),
        (~invalid & ~has("NO_AMOUNT_IN_INPUT", "AMOUNT_NOT_IN_INPUT", "SUPERSEDED_AMOUNT_USED")).alias("amount_values_match_active_candidates"),
        (~invalid & ~has("TXN_COUNT_EXCEEDS_CANDIDATES", "TXN_COUNT_BELOW_CANDIDATES")).alias("txn_count_matches_active_candidates"),
        has("SUSPICIOUS_DUPLICATE").alias("duplicate_transactions_found"),
        has("SUPERSEDED_AMOUNT_USED").alias("superseded_amount_used"),
        errors.alias("errors"),
    )


def primary_reason(errors: Column) -> Column:
    """The reason that a failed label is filed under."""
    found = codes(errors, "error")
    has = lambda c: F.array_contains(found, c)
    return (
        F.when(has("SCHEMA_INVALID"), "schema_invalid")
        .when(has("SUPERSEDED_AMOUNT_USED"), "superseded_amount_used")
        .when(has("CURRENCY_MISMATCH"), "currency_mismatch")
        .when(has("SUSPICIOUS_DUPLICATE"), "suspicious_duplicate")
        .when(F.size(found) > 0, "validation_failed")
    )


def score(failure_reason: Column, has_output: Column, errors: Column, count_matches: Column, rank: Column) -> Column:
    """0 for a failure or any error; else 80, and 10 for a matching count, 5 without warnings, 5 for the first rank."""
    failed = failure_reason.isNotNull() | ~has_output | errors.isNull() | (F.size(codes(errors, "error")) > 0)
    bonus = F.when(count_matches, 10).otherwise(0) + F.when(F.size(codes(errors, "warning")) == 0, 5).otherwise(0) + F.when(rank == 0, 5).otherwise(0)
    return F.when(failed, 0).otherwise(80 + bonus)
