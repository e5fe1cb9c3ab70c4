"""Choosing among attempts, and predicates on failed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Reasons, their order from the most telling on, and what an authentication error says.
REASON_ORDER = ("validation_failed", "repair_exhausted", "all_candidates_failed", "provider_error")
VALIDATOR_REASONS = ("validation_failed", "schema_invalid", "superseded_amount_used", "currency_mismatch", "suspicious_duplicate")
AUTH_ERROR = "(?i)AccessDeniedException|Authentication failed|API key|UnauthorizedOperation|InvalidSignatureException|ExpiredTokenException|expired token|invalid api key|invalid_api_key|401"
RETRYABLE_STATUS = (429, 500, 502, 503, 504)
RETRYABLE_CODES = ("ThrottlingException", "ServiceUnavailableException", "ModelTimeoutException", "ModelErrorException", "InternalServerException")


def pick_best(attempts: DataFrame, key: str) -> DataFrame:
    """The best attempt of each key: highest score, then lowest rank (null last), then provider. Failed attempts and
    scores of 0 don't count; a key without another has no row. One combined minimum a key, so no sort and no skew."""
    valid = attempts.where(F.col("failure_reason").isNull() & (F.col("score") > 0))
    order = F.struct((-F.col("score")).alias("s"), F.col("rank").isNull().alias("n"), "rank", "provider")
    row = F.struct(*[F.col(c) for c in attempts.columns if c != key])
    best = valid.groupBy(key).agg(F.min_by(row, order).alias("__best"))
    return best.select(key, "__best.*")


def top_reason(reasons: Column, repair: bool) -> Column:
    """Why an input without an accepted attempt failed, from the reasons of all its attempts."""
    otherwise = "repair_exhausted" if repair else "all_candidates_failed"
    return F.when(F.forall(reasons, lambda r: r == "provider_error"), "provider_error").otherwise(otherwise)


def is_auth_error(error: Column) -> Column:
    return F.coalesce(error.rlike(AUTH_ERROR), F.lit(False))


def all_auth_failures(reason: Column, attempts: Column) -> Column:
    """A provider error each of whose attempts (there is one at least) is an authentication error."""
    bad = lambda a: F.coalesce(a["failure_reason"] == "provider_error", F.lit(False)) & is_auth_error(a["error"])
    return F.coalesce((reason == "provider_error") & (F.size(attempts) > 0) & F.forall(attempts, bad), F.lit(False))


def has_validation_attempt(attempts: Column) -> Column:
    return F.coalesce(F.exists(attempts, lambda a: F.coalesce(a["failure_reason"].isin(*VALIDATOR_REASONS), F.lit(False))), F.lit(False))


def is_validation_row(reason: Column, attempts: Column) -> Column:
    return F.coalesce(reason == "validation_failed", F.lit(False)) | has_validation_attempt(attempts)


def skipped(reason: Column, attempts: Column, retry_failed: bool = False, retry_validation_failed: bool = False) -> Column:
    """Whether a failed input is left alone in the next run."""
    if retry_failed:
        return F.lit(False)
    if not retry_validation_failed:
        return F.lit(True)
    r = F.coalesce(reason, F.lit(""))
    again = (r == "validation_failed") | (r.isin("all_candidates_failed", "repair_exhausted") & has_validation_attempt(attempts))
    return ~again


def skipped_legacy(reason: Column, retry_failed: bool = False) -> Column:
    return F.lit(not retry_failed) & reason.isNotNull()


def is_retryable(status: Column) -> Column:
    return status.isin(*RETRYABLE_STATUS)


def is_retryable_code(code: Column) -> Column:
    """Whether an error of this code passes; one without a code is a time-out or a lost connection, and does."""
    return code.isNull() | code.isin(*RETRYABLE_CODES)


def reason_counts(failed: DataFrame) -> DataFrame:
    """Reasons of failed rows and of their attempts: level (row or attempt), reason (`unknown` for none), provider (null
    for rows), n. One pass."""
    named = lambda c: F.coalesce(c, F.lit("unknown"))
    entry = lambda level, reason, provider: F.struct(F.lit(level).alias("level"), named(reason).alias("reason"), provider.alias("provider"))
    attempts = F.transform(F.coalesce("attempts", F.array().cast(failed.schema["attempts"].dataType)), lambda a: entry("attempt", a["failure_reason"], a["provider"]))
    rows = failed.select(F.inline(F.concat(F.array(entry("row", F.col("reason"), F.lit(None).cast("string"))), attempts)))
    return rows.groupBy("level", "reason", "provider").agg(F.count("*").alias("n"))


def pruned_counts(failed: DataFrame) -> DataFrame:
    """provider, n: rows that go because all their attempts are authentication errors, by the provider of the first
    (`unknown` for none)."""
    gone = failed.where(all_auth_failures(F.col("reason"), F.col("attempts")))
    return gone.groupBy(F.coalesce(F.get("attempts", F.lit(0))["provider"], F.lit("unknown")).alias("provider")).agg(F.count("*").alias("n"))


def recovered_counts(attempts: DataFrame, key: str, by: str = "provider") -> DataFrame:
    """by, n: keys that an attempt recovers, by the provider of the attempt chosen."""
    return recovery_choice(attempts, key).groupBy(F.coalesce(by, F.lit("unknown")).alias(by)).agg(F.count("*").alias("n"))


def orphan_counts(marked: DataFrame, mark: str = "labeled") -> DataFrame:
    """reason, n of failed rows whose input has been labeled since."""
    return marked.where(mark).groupBy(F.coalesce("reason", F.lit("unknown")).alias("reason")).agg(F.count("*").alias("n"))


def reason_rank(reason: Column) -> Column:
    rank = F.array_position(F.array(*map(F.lit, REASON_ORDER)), F.coalesce(reason, F.lit("")))
    return F.when(rank > 0, rank).otherwise(99)


def recovery_choice(attempts: DataFrame, key: str) -> DataFrame:
    """Of the attempts that pass validation now (column ok) the first, those that aren't repairs before those that are."""
    order = F.struct(F.col("is_repair_attempt").alias("r"), "pos")
    row = F.struct(*[F.col(c) for c in attempts.columns if c != key])
    return attempts.where("ok").groupBy(key).agg(F.min_by(row, order).alias("__best")).select(key, "__best.*")


def tail(rows: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The last n rows of each key. Spark keeps n a key and task before it shuffles."""
    turn = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return rows.withColumn("__turn", turn).where(F.col("__turn") <= n).drop("__turn")
