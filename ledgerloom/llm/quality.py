"""Quality rules (5): a table of thresholds compiled into one Spark projection, without user functions.

Words are what stands between ASCII white space, lines what stands between line feeds. A rule names a measure and the
least and most value that passes; a text is kept if every rule passes. Repeated 5-word windows are found by sorting the
window hashes of one text with their places, so a text costs n log n however often it repeats itself. Null and empty
texts have no words: they fail. Repeated rows fare alike. Other columns stay behind, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "it", "for", "was", "on", "are", "as", "a",
    "de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "dans", "que", "qui", "est", "pour", "pas", "sur",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "ist", "nicht", "ein", "eine", "auf", "für", "im",
    "el", "los", "las", "y", "por", "con", "para", "una", "su", "al", "lo", "como", "del", "se", "no",
)
WIDTH = 5
#: The base verdict: words at least, and per cent of words in repeated windows at most.
MIN_WORDS = 10
MAX_REPEATED = 20


@dataclass(frozen=True)
class Rule:
    """A measure passes from `least` to `most`; None: no bound."""

    measure: str
    least: float | None = None
    most: float | None = None

    def passes(self) -> Column:
        value = F.col(self.measure)
        bounds = [value >= F.lit(float(self.least))] if self.least is not None else []
        bounds += [value <= F.lit(float(self.most))] if self.most is not None else []
        return reduce(Column.__and__, bounds, F.lit(True))

    def sql(self) -> str:
        bounds = [f"{self.measure} >= {self.least}::DOUBLE"] if self.least is not None else []
        bounds += [f"{self.measure} <= {self.most}::DOUBLE"] if self.most is not None else []
        return " AND ".join(bounds) or "true"


RULES = (
    Rule("mean_word_length", 2, 14),
    Rule("symbols_per_word", None, 0.3),
    Rule("stop_word_share", 0.02, None),
    Rule("dup_line_share", None, 0.5),
)

_STOPS = sorted({*STOP_WORDS, *(w[:1].upper() + w[1:] for w in STOP_WORDS)})


def _layers() -> list[dict[str, Column]]:
    """Columns by name; each layer may use those before. The text is the column __text, not null."""
    t, words, h, ranked, lines = map(F.col, ("__text", "__words", "__hash", "__ranked", "__lines"))
    near = lambda i, k: ranked[i + k]["h"] == ranked[i]["h"]
    twice = lambda i: F.when(i > 0, near(i, -1)).otherwise(F.lit(False)) | F.when(i + 1 < F.size(ranked), near(i, 1)).otherwise(F.lit(False))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda s, p: F.struct((s["n"] + p + WIDTH - F.greatest(p, s["end"])).cast("long").alias("n"), (p + WIDTH).alias("end"))
    share = lambda n, of: F.when(F.col(of) > 0, F.col(n).cast("double") / F.col(of)).otherwise(F.lit(0.0))
    return [
        {
            "__words": F.filter(F.split(t, "[ \\t-\\r]+"), lambda w: w != ""),
            "__lines": F.filter(F.split(t, "\n"), lambda x: x.rlike("[^ \\t-\\r]")),
        },
        {"__hash": F.transform(words, lambda w: F.xxhash64(w)), "__joined": F.array_join(words, "")},
        {
            "__windows": F.when(
                F.size(h) >= WIDTH,
                F.transform(F.sequence(F.lit(0), F.size(h) - WIDTH), lambda i: F.xxhash64(*[h[i + k] for k in range(WIDTH)])),
            ).otherwise(F.array().cast("array<bigint>"))
        },
        {  # most texts repeat no window: those are not sorted
            "__ranked": F.when(
                F.size(F.array_distinct("__windows")) < F.size("__windows"),
                F.sort_array(F.transform("__windows", lambda x, i: F.struct(x.alias("h"), i.alias("p")))),
            ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
        },
        {"__places": F.sort_array(F.transform(F.filter(ranked, lambda x, i: twice(i)), lambda x: x["p"]))},
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length("__joined").cast("long"),
            "n_symbols": F.regexp_count("__joined", F.lit("[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": F.aggregate("__places", start, step)["n"],
            "n_lines": F.size(lines).cast("long"),
            "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*_STOPS))).cast("long"),
        },
        {
            "mean_word_length": share("word_chars", "n_words"),
            "symbols_per_word": share("n_symbols", "n_words"),
            "stop_word_share": share("n_stop_words", "n_words"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
        },
    ]


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the measures, base_failed and kept for each row of docs."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    for layer in _layers():
        rows = rows.withColumns(layer)
    return rows.withColumn("kept", ~F.col("base_failed") & reduce(Column.__and__, (r.passes() for r in rules)))


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: measures and verdict for each document."""
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return measured(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(*names)


_LIST = ", ".join(f"'{w}'" for w in _STOPS)
SQL = f"""
WITH cut AS (SELECT doc_id, row_number() OVER () AS r,
    list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS l FROM documents),
win AS (SELECT r, p, array_to_string(w[p : p + {WIDTH - 1}], ' ') AS s FROM (SELECT r, w, unnest(generate_series(1, len(w) - {WIDTH - 1})) AS p FROM cut)),
many AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1),
repeated AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(generate_series(p, p + {WIDTH - 1})) AS q FROM many) GROUP BY r),
counted AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(coalesce(array_to_string(w, ''), ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
    len(list_filter(w, lambda x: x IN ({_LIST}))) AS n_stop_words FROM cut LEFT JOIN repeated USING (r)),
shares AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END AS mean_word_length,
    CASE WHEN n_words > 0 THEN n_symbols::DOUBLE / n_words ELSE 0 END AS symbols_per_word,
    CASE WHEN n_words > 0 THEN n_stop_words::DOUBLE / n_words ELSE 0 END AS stop_word_share,
    CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS dup_line_share,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {" AND ".join(r.sql() for r in RULES)} AS kept FROM shares
"""
