"""Toxicity (7): a weighted lexicon matched by Aho-Corasick on folded text, normalised by length.

Folding: homoglyphs and accented letters become the plain letter, invisible characters go, case goes; in a word with two
letters or more (or one, and two signs) digits and signs that stand for letters become those letters, wherever in the
word they stand (`!` and `|` not at its end), and three or more of one sign count as one; what is no letter then becomes a space. A lexicon entry is a
word or the beginning of words; of the entries that match a word the heaviest counts. A word inside an exception phrase
(an entry's word with the word after it) doesn't count. The sum of weights over the number of words goes through a
fitted logistic curve.

The lexicon, the exceptions and the curve are learned from labelled documents of the training fold: `toxic_rows` toxic
and `clean_rows` other ones at most, in the order of a hash of their ids. One half of them gives entries and
exceptions, all that reach the least counts and weight, the other half the curve. A document with several labels is toxic if one says so; null labels and ids are
left out. Null and empty texts have no words and the curve's lowest score. Repeated rows fare alike.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.shared import fold, map_batches, sampled, scratch

#: Bounds of the labelled sample.
TOXIC_ROWS = 4000
CLEAN_ROWS = 8000
#: An entry is in so many toxic documents, and such a share of them, at least, and e**MIN_WEIGHT times as frequent among their words as among those of others.
MIN_DOCS = 3
MIN_SHARE = 0.015
MIN_WEIGHT = 1.5
#: Share of words that is added to both sides, for all documents and for one, so that rare words prove little; most that
#: one document gives.
RARE_SHARE = 3e-5
DOC_SHARE = 0.004
MOST_SHARE = 0.05
PREFIXES = range(4, 9)
#: Words that a shorter text counts as, so that one word alone says less.
LEAST_WORDS = 15

#: Letters of other scripts that look like Latin ones.
_LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe",
}
_INVISIBLE = "­​‌‍⁠﻿"
#: Digits and signs that stand for letters.
_LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
#: A whole run of letters and signs with a sign in it, found from its beginning alone: a run of letters costs its length.
_TOKEN = re.compile(r"(?<![a-z0134578@$!|])[a-z]*+[0134578@$!|][a-z0134578@$!|]*+")
_RUN = re.compile(r"([0134578@$!|])\1{2,}")
_LOOSE = re.compile(r"[!|]+(?![a-z0134578@$])")


def _unsigned(m: re.Match) -> str:
    """A token with signs: letters for them if it has two letters or more, or one and two signs that are no digits."""
    word = _RUN.sub(r"\1", _LOOSE.sub(" ", m[0]))
    letters, digits = sum(map(str.isalpha, word)), sum(map(str.isdigit, word))
    if not letters or letters < 2 and len(word.rstrip()) - letters - digits < 2:
        return word
    return "".join(_LEET.get(c, c) for c in word)


def _table() -> dict[int, str]:
    out = {ord(c): "" for c in _INVISIBLE}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF21, 0xFF5B)]:
        plain = unicodedata.normalize("NFKD", chr(code))
        base = "".join(c for c in plain if not unicodedata.combining(c))
        if base and base != chr(code) and base.isascii():
            out[code] = base.lower()
    for c, plain in _LOOKALIKES.items():
        out[ord(c)] = plain
        if len(c.upper()) == 1:
            out[ord(c.upper())] = plain
    return out


_FOLD = _table()
_FLAT = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def folded(text: str | None) -> str:
    """Words between single spaces, with one on either side."""
    if not text:
        return " "
    text = text.translate(_FOLD) if not text.isascii() else text
    text = _TOKEN.sub(_unsigned, text.lower())
    words = text.encode().translate(_FLAT).split()
    return f" {b' '.join(words).decode()} " if words else " "


@dataclass
class Model:
    """entries: " begin" or " word " -> weight. exceptions: " word next ". curve: offset and slope over log density."""

    entries: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float] = (1.5, 1.0)


class Scorer:
    def __init__(self, model: Model) -> None:
        import ahocorasick

        self.curve = model.curve
        self.find = self.skip = None
        if model.entries:
            self.find = ahocorasick.Automaton()
            for entry, weight in model.entries.items():
                self.find.add_word(entry, (len(entry), weight))
            self.find.make_automaton()
        if model.exceptions:
            self.skip = ahocorasick.Automaton()
            for phrase in model.exceptions:
                self.skip.add_word(phrase, len(phrase))
            self.skip.make_automaton()

    def hits(self, flat: str) -> dict[int, float]:
        """Weight by the place before a word."""
        best: dict[int, float] = {}
        if self.find:
            for end, (n, weight) in self.find.iter(flat):
                at = end - n + 1
                if weight > best.get(at, 0):
                    best[at] = weight
        if best and self.skip:
            for end, n in self.skip.iter(flat):
                best.pop(end - n + 1, None)
        return best

    def density(self, text: str | None) -> float:
        flat = folded(text)
        return sum(self.hits(flat).values()) / max(LEAST_WORDS, flat.count(" ") - 1)

    def score(self, density: float) -> float:
        a, b = self.curve
        return float(1 / (1 + np.exp(-(a + b * np.log(density + 1e-4)))))


def _features(flat: str) -> Counter:
    out: Counter = Counter()
    for w, n in Counter(flat.split()).items():
        if len(w) > 2:
            out[f" {w} "] += n
        for k in PREFIXES:
            if len(w) >= k:
                out[f" {w[:k]}"] += n
    return out


def _counted(sample: DataFrame, features) -> DataFrame:
    """feature, t, c: in how many toxic and other documents of the sample it is; ft, fc: the sums of its share of their
    words, of which a document gives MOST_SHARE at most."""

    def make():
        def one(batch: pa.RecordBatch) -> dict:
            sums: dict[str, list[float]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                flat = folded(text)
                words = max(LEAST_WORDS, flat.count(" ") - 1)
                for name, n in features(flat).items():
                    s = sums.setdefault(name, [0, 0, 0.0, 0.0])
                    s[not toxic] += 1
                    s[2 + (not toxic)] += min(MOST_SHARE, n / words)
            return {"feature": list(sums)} | {c: [s[k] for s in sums.values()] for k, c in enumerate(("t", "c", "ft", "fc"))}

        return one

    counts = map_batches(sample.select("text", "toxic"), make, "feature string, t long, c long, ft double, fc double")
    return counts.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("t", "c", "ft", "fc")])


def learn(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isNotNull() & (fold("doc_id") != 2)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = sampled(known.where("toxic = 1"), "toxic", toxic_rows).unionByName(sampled(known.where("toxic = 0"), "toxic", clean_rows))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most toxic_rows + clean_rows ids are broadcast
    sample = scratch(rows.join(F.broadcast(chosen), "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2))), "labelled")
    first, second = sample.where("half = 0"), sample.where("half = 1")
    sizes = {r["toxic"]: r["count"] for r in first.groupBy("toxic").count().collect()}
    n_t, n_c = sizes.get(1, 0), sizes.get(0, 0)
    model = Model()
    if not n_t or not n_c:
        return model
    weight = F.log((F.col("ft") / n_t + RARE_SHARE + DOC_SHARE / n_t) / (F.col("fc") / n_c + RARE_SHARE + DOC_SHARE / n_t))
    least = max(MIN_DOCS, round(MIN_SHARE * n_t))
    best = _counted(first, _features).where((F.col("t") >= least) & (weight >= MIN_WEIGHT)).withColumn("w", weight)
    found = {r["feature"]: r["w"] for r in best.orderBy("feature").collect()}  # from the sample, so bounded by it
    # an entry that a shorter one says as well is left out
    model.entries = {
        e: w for e, w in found.items() if not any(w - 0.3 <= found.get(e[:n], -1) for n in range(5, len(e)))
    }
    benign = _counted(first, _Phrases(model)).where("t = 0 AND c >= 2").orderBy("feature")
    model.exceptions = tuple(r["feature"] for r in benign.collect())
    points = density(second, model, "toxic").collect()
    if len({p["toxic"] for p in points}) == 2:
        model.curve = _fit(np.array([p["density"] for p in points]), np.array([p["toxic"] for p in points], float))
    return model


class _Phrases:
    """The words that an entry matches, each with the next word."""

    def __init__(self, model: Model) -> None:
        self.model, self.scorer = model, None

    def __call__(self, flat: str) -> Counter:
        self.scorer = self.scorer or Scorer(self.model)
        out: Counter = Counter()
        for at in self.scorer.hits(flat):
            end = flat.find(" ", flat.find(" ", at + 1) + 1)
            if end > 0:
                out[flat[at : end + 1]] += 1
        return out


def _fit(density_: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression on the log of the density, with a little ridge."""
    x = np.stack([np.ones_like(density_), np.log(density_ + 1e-4)], 1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), x.T @ (y - p) - 0.1 * b)
        b += step
        if abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def density(docs: DataFrame, model: Model, *more: str) -> DataFrame:
    """doc_id, density of each row of docs (and more columns of integers)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # entries and exceptions of the bounded sample

    def make():
        scorer = Scorer(sent.value)

        def one(batch: pa.RecordBatch) -> dict:
            out = {"doc_id": batch.column(0), "density": [scorer.density(t) for t in batch.column(1).to_pylist()]}
            return out | {n: batch.column(k + 2) for k, n in enumerate(more)}

        return one

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)
    return map_batches(rows, make, "doc_id long, density double" + "".join(f", {n} int" for n in more))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, density, score for each row of docs."""
    a, b = model.curve
    return density(docs, model).withColumn("score", 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.log(F.col("density") + F.lit(1e-4))))))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: score and verdict for each document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = score(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return found.select("doc_id", F.coalesce(fold("doc_id") == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
