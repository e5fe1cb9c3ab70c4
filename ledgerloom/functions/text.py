"""Scalar text functions as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Prompt text around an input, and known quantization names in order.
LEAD_WORDS = ("output:", "example")
SHORTEST, LONGEST = 3, 300
QUANTS = ("F16", "Q8_0", "Q6_K", "Q5_K_M", "Q4_K_M")
_WHITE = "(?U)[\\s\\x1c-\\x1f]+"


def normalize_key(text: Column) -> Column:
    """Lower case, runs of (Unicode) white space as one space, none outside."""
    return F.trim(F.regexp_replace(F.lower(text), _WHITE, " "))


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{_WHITE}|{_WHITE}$", "")


def clean_line(line: Column) -> Column:
    """A line without bullet or number and one pair of quotes; null if blank, fenced, a lead-in, or of a wrong length."""
    s = _strip(line)
    low = F.lower(s)
    lead = low.startswith("```") | low.startswith(LEAD_WORDS[0]) | low.startswith(LEAD_WORDS[1])
    body = _strip(F.regexp_replace(s, "(?U)^\\s*(?:[-*]\\s+|\\d+[.)]\\s+)", ""))
    quoted = body.rlike("(?s)^\".*\"$|^'.*'$|^[\"']$")
    body = F.when(quoted, _strip(F.substring(body, 2, F.greatest(F.length(body) - 2, F.lit(0))))).otherwise(body)
    return F.when((s != "") & ~lead & F.length(body).between(SHORTEST, LONGEST), body)


def clean_lines(rows: DataFrame, key: str, text: str, expected: int | None = None) -> DataFrame:
    """key, pos (place of the line), line: the cleaned lines of each text, each normalized line once (the first),
    `expected` of a text at most."""
    lines = rows.select(key, F.posexplode(F.split(F.col(text), "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")).alias("pos", "line"))
    lines = lines.withColumn("line", clean_line(F.col("line"))).where(F.col("line").isNotNull())
    firsts = lines.groupBy(key, normalize_key(F.col("line")).alias("__k")).agg(F.min("pos").alias("pos"), F.min_by("line", "pos").alias("line")).drop("__k")
    if expected is None:
        return firsts
    return firsts.withColumn("__turn", F.row_number().over(Window.partitionBy(key).orderBy("pos"))).where(F.col("__turn") <= expected).drop("__turn")


def estimate_tokens(text: Column) -> Column:
    """A quarter of the characters, rounded up, one at least; none for null and empty."""
    n = F.length(text)
    return F.when(text.isNull() | (n == 0), 0).otherwise(F.greatest(F.lit(1), F.ceil(n / 4))).cast("long")


def number(text: Column) -> Column:
    """A number with comma groups; null if it is none."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def duration(seconds: Column) -> Column:
    """`1h02m03s`, `2m03s` or `3s`."""
    s = F.floor(seconds).cast("long")
    h, m, r = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    return F.when(h > 0, F.format_string("%dh%02dm%02ds", h, m, r)).when(m > 0, F.format_string("%dm%02ds", m, r)).when(s.isNotNull(), F.format_string("%ds", r))


def percent(part: Column, whole: Column) -> Column:
    return F.round(100.0 * part / F.greatest(whole, F.lit(1)), 1)


def iso_utc(seconds: Column) -> Column:
    """ISO 8601 in UTC, to the microsecond, of seconds since 1970; the session's time zone doesn't matter. Years of five
    digits have no sign before them."""
    whole = F.floor(seconds).cast("long")
    micros = F.round((seconds - whole) * 1_000_000).cast("int")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(whole / 86400).cast("int"))
    left = F.pmod(whole, F.lit(86400))
    clock = F.format_string("%02d:%02d:%02d", F.floor(left / 3600).cast("int"), F.floor(left % 3600 / 60).cast("int"), (left % 60).cast("int"))
    return F.concat(F.ltrim(day.cast("string"), F.lit("+")), F.lit("T"), clock, F.when(micros > 0, F.format_string(".%06d", micros)).otherwise(""), F.lit("Z"))


def batch_id(run: Column, number: Column) -> Column:
    """`run-000007`: sorts like its number up to six digits, and longer numbers stay whole; null of null."""
    return F.when(run.isNotNull() & number.isNotNull(), F.format_string("%s-%06d", run, number))


def clamped_ms(began: Column, ended: Column) -> Column:
    """Milliseconds between two times in seconds, not below 0."""
    return F.greatest(F.lit(0), F.round((ended - began) * 1000).cast("long"))


def input_prompt(n: Column, focus: Column) -> Column:
    return F.format_string("Write %d distinct spending sentences, one a line. Focus: %s", n, focus)


def messages(system: Column, user: Column, assistant: Column | None = None) -> Column:
    """Chat turns as an array of (role, content); no assistant turn where it is null."""
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    turns = F.array(turn("system", system), turn("user", user))
    if assistant is None:
        return turns
    return F.when(assistant.isNull(), turns).otherwise(F.concat(turns, F.array(turn("assistant", assistant))))


def training_text(turns: Column) -> Column:
    """Chat turns as one text, each `<|role|>` and its content."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["content"])), "\n")


def failure_summary(attempts: Column) -> Column:
    """`provider: code, code, code` joined with `; `, 200 characters at most. attempts: array of (provider, reason,
    codes)."""
    one = lambda a: F.concat(a["provider"], F.lit(": "), F.when(a["reason"] == "provider_error", F.lit("provider error")).when(F.size(a["codes"]) > 0, F.array_join(F.slice(a["codes"], 1, 3), ", ")).otherwise(F.coalesce(a["reason"], F.lit("unknown"))))
    return F.substring(F.array_join(F.transform(attempts, one), "; "), 1, 200)


def repair_prompt(text: Column, amounts: Column, summary: Column) -> Column:
    """What a second attempt is told: the input, a line for each amount, and what went wrong."""
    line = lambda a: F.concat(F.lit("  - '"), a["raw"], F.lit("' -> "), a["value"].cast("string"), F.lit(" ("), F.coalesce(a["currency_hint"], F.lit("(no hint, default INR)")), F.lit(", "), a["status"], F.lit(")"))
    listed = F.when(F.coalesce(F.size(amounts), F.lit(0)) > 0, F.array_join(F.transform(amounts, line), "\n")).otherwise(F.lit("  (no amount candidates parsed)"))
    return F.concat(F.lit("The label for this input failed validation.\nINPUT:\n"), text, F.lit("\nAMOUNTS:\n"), listed, F.lit("\nFAILURES:\n"), summary, F.lit("\nUse only these amounts and currencies; answer with the JSON object alone."))


def line_diff(a: Column, b: Column) -> Column:
    """For each line of two texts whether it differs."""
    x, y = F.split(a, "\n"), F.split(b, "\n")
    at = F.sequence(F.lit(0), F.greatest(F.size(x), F.size(y)) - 1)
    return F.transform(at, lambda i: ~F.get(x, i).eqNullSafe(F.get(y, i)))


def model_and_quant(path: Column, prefix: str = "", folders: str = "student-") -> tuple[Column, Column]:
    """Model and quantization that a path names. The quantization is the first known one in the file's stem, else what
    stands after its last hyphen. The model is what follows `folders` in the nearest folder that begins so; without such
    a folder it is the stem, without `prefix` and the quantization at its end."""
    parts = F.split(path, "/")
    stem = F.regexp_replace(F.element_at(parts, -1), "\\.[^.]*$", "")
    known = F.filter(F.array(*map(F.lit, QUANTS)), lambda q: F.contains(F.upper(stem), q))
    quant = F.coalesce(F.get(known, F.lit(0)), F.element_at(F.split(F.upper(stem), "-"), -1))
    nearest = F.get(F.reverse(F.filter(F.slice(parts, 1, F.size(parts) - 1), lambda x: x.startswith(folders))), F.lit(0))
    bare = F.regexp_replace(stem, "^" + re.escape(prefix), "") if prefix else stem
    bare = F.regexp_replace(bare, "(?i)-(" + "|".join(map(re.escape, QUANTS)) + ")$", "")
    return F.coalesce(F.nullif(F.substring(nearest, len(folders) + 1, 1 << 20), F.lit("")), bare), quant


def render_section(template: str, heading: str, body: str) -> str:
    """A text with the body of one markdown section replaced; the section and one after it must be there."""
    start = template.find(heading)
    if start < 0:
        raise ValueError(f"no section {heading!r}")
    after = template.find("\n## ", start + len(heading))
    if after < 0:
        raise ValueError(f"no section after {heading!r}")
    return f"{template[: start + len(heading)]}\n\n{body.strip()}\n{template[after:]}"
