"""Audit of tokens that look like numerals but aren't known."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.functions.amounts import ALL_UNITS, ENGLISH, HINDI
from ledgerloom.functions.jsonx import json_value


def token_counts(rows: DataFrame, text: str, order: str, least: int = 2, contexts: int = 0, known: tuple[str, ...] = ()) -> DataFrame:
    """Letter tokens of three letters or more that aren't known, with their count and where they come first. contexts:
    the first so many texts of each, as an array; each text is joined back by its order, so no token gathers its texts."""
    words = rows.select(F.col(order).alias("o"), F.explode(F.regexp_extract_all(F.col(text), F.lit("[A-Za-z]+"), F.lit(0))).alias("token"))
    words = words.select("o", F.lower("token").alias("token")).where(F.length("token") >= 3)
    stop = [*known, *HINDI, *ENGLISH, *ALL_UNITS]
    fresh = words.where(~F.col("token").isin(stop)).groupBy("token", "o").agg(F.count("*").alias("c"))
    counts = fresh.groupBy("token").agg(F.sum("c").alias("n"), F.min("o").alias("first")).where(F.col("n") >= least)
    if not contexts:
        return counts
    turn = F.row_number().over(Window.partitionBy("token").orderBy("o"))  # Spark keeps `contexts` a token and task
    firsts = fresh.withColumn("turn", turn).where(F.col("turn") <= contexts).join(rows.select(F.col(order).alias("o"), F.col(text).alias("t")), "o")
    shown = firsts.groupBy("token").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "t"))), lambda x: x["t"]).alias("contexts"))
    return counts.join(shown, "token")


class Vocabulary:
    """Nearest words of a vocabulary by the ratio of difflib, for blocks of tokens at once.

    The ratio is 2 M / (length of both), M the letters in matching blocks. M is no more than the shorter length, nor than
    the letters both have in common, however they stand. Both bounds are taken for a whole block of tokens by all words as
    matrices; the ratio itself only for pairs whose bound reaches the cutoff and what the token has found so far."""

    def __init__(self, words: list[str], cutoff: float) -> None:
        self.words, self.cutoff = sorted(words), cutoff
        self.letters = sorted(set("".join(words)))
        self.place = {c: k for k, c in enumerate(self.letters)}
        self.counts = self._counts(self.words)
        self.lengths = np.array([len(w) for w in self.words], np.int32)

    def _counts(self, words: list[str]) -> np.ndarray:
        """How often each word has each letter of the vocabulary."""
        out = np.zeros((len(words), len(self.letters)), np.int16)
        for k, w in enumerate(words):
            for c in w:
                if c in self.place:
                    out[k, self.place[c]] += 1
        return out

    def bounds(self, tokens: list[str]) -> np.ndarray:
        """An upper bound of the ratio of each token (rows) and word (columns)."""
        lengths = np.array([len(t) for t in tokens], np.int32)
        common = np.zeros((len(tokens), len(self.words)), np.int32)
        for mine, theirs in zip(self._counts(tokens).T, self.counts.T, strict=True):
            if mine.any():
                common += np.minimum(mine[:, None], theirs)
        return 2.0 * common / (lengths[:, None] + self.lengths)

    def nearest(self, tokens: list[str]) -> list[tuple[str, float] | None]:
        """The word of the highest ratio, the last by name among equals, if that ratio reaches the cutoff; with it, the
        ratio of token and word in this order."""
        out: list[tuple[str, float] | None] = []
        bounds = self.bounds(tokens)
        one = difflib.SequenceMatcher()
        for token, row in zip(tokens, bounds, strict=True):
            near = np.flatnonzero(row >= self.cutoff - 1e-12)
            best: tuple[float, str] = (0.0, "")
            if len(near):
                one.set_seq2(token)
            for k in near[np.argsort(-row[near], kind="stable")]:
                if row[k] < best[0] - 1e-12:
                    break
                one.set_seq1(self.words[k])
                best = max(best, (one.ratio(), self.words[k]))
            out.append((best[1], difflib.SequenceMatcher(None, token, best[1]).ratio()) if best[0] >= self.cutoff else None)
        return out


#: Tokens that are compared at once: a block is a matrix of so many rows.
BLOCK = 1024


def similar(tokens: DataFrame, token: str, values: dict[str, int], cutoff: float = 0.72) -> DataFrame:
    """Rows whose token has a near word in a vocabulary (a dictionary of the code, sent with it), with nearest, value and
    ratio. Rows are dealt over all tasks by a hash of the token."""
    partitions = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    @F.arrow_udf("struct<nearest:string,value:int,ratio:double>")
    def nearest(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Vocabulary(list(values), cutoff)
        for column in columns:
            asked, out = column.to_pylist(), []
            for k in range(0, len(asked), BLOCK):
                found = words.nearest([t or "" for t in asked[k : k + BLOCK]])
                out += [f and {"nearest": f[0], "value": values[f[0]], "ratio": f[1]} for f in found]
            yield pa.array(out, pa.struct([("nearest", pa.string()), ("value", pa.int32()), ("ratio", pa.float64())]))

    nearest = nearest.asNondeterministic()  # else the filter on it moves below what counts the tokens, and asks for each occurrence
    found = tokens.repartition(partitions, token).withColumn("__s", nearest(token)).where(F.col("__s").isNotNull())
    return found.select("*", "__s.*").drop("__s")


def suggestions(counts: DataFrame, cutoff: float = 0.72, top: int = 80) -> DataFrame:
    """The nearest known numeral of each token, where the ratio reaches the cutoff; the most frequent first."""
    found = similar(counts.select("token", "n"), "token", HINDI, cutoff)
    return found.orderBy(F.desc("n"), F.desc("ratio"), "token").limit(top)


def failed_texts(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """input of lines of failed rows that have a text there; blank lines, bad JSON and other shapes are skipped."""
    v = json_value(F.col(raw))
    kind = F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.input", "variant")), F.lit(""))
    return rows.where(kind == "STRING").select("*", F.try_variant_get(v, "$.input", "string").alias("input"))
