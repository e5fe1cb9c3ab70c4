"""Language identification (9) by compression: the language whose dictionary shortens a text most.

Texts are lower-cased, what isn't a letter becomes a space and a word that follows itself counts once. Training takes
`sample_rows` texts of the training fold at most for each language, those with the least hash of their ids: that bound is
the only one on what is learned from, and every language with a labelled text is learned. The texts of a language share
the `dict_bytes` of its raw-content zstandard dictionary evenly, each with slices from all over the text; all
dictionaries together hold `all_bytes` at most, so with many languages each is smaller.

Prediction cuts the whole text into pieces of `piece_bytes`, compresses each with each dictionary and sums the sizes,
and those of the text's endings of 1, 2, 4, ... `ENDING_WORDS` words, since the whole bytes of a short piece tell little.
The smallest sum wins, the more frequent language on a tie. The margin is how much larger the second smallest sum is; a
text whose margin is below `min_margin` is rejected.

Null texts and texts without a letter are `und`, score 0, and rejected. With no language learned all are `und`.
Repeated rows fare alike; rows without an id are in neither fold of the split: never held out, never learned from.
"""

from __future__ import annotations

import re
from itertools import groupby

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.shared import fold, map_batches, map_groups, map_rows, sampled

#: Labelled documents looked at for each language, bytes of its dictionary, and of all dictionaries.
SAMPLE_ROWS = 400
DICT_BYTES = 256 * 1024
ALL_BYTES = 64 << 20
#: Bytes of a slice of a text.
SLICE = 512
PIECE_BYTES = 2048
ENDING_WORDS = 16
LEVEL = 3
#: Relative distance of the two smallest sums below which a text is rejected.
MIN_MARGIN = 0.002


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, dict_bytes: int = DICT_BYTES, all_bytes: int = ALL_BYTES) -> dict[str, bytes]:
    """language -> dictionary, the more frequent first. Rows with null text, lang or id, or of fold 2, are left out."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id") != 2))
    order = [r["lang"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    size = min(dict_bytes, all_bytes // max(1, len(order)))

    def sliced():  # a text gives no more than a whole dictionary, so a language's texts fit a task
        def one(batch: pa.RecordBatch) -> dict:
            return {"lang": batch.column(0), "h": batch.column(1), "part": [spread(plain(t), size) for t in batch.column(2).to_pylist()]}

        return one

    rows = sampled(known, "lang", sample_rows).select("lang", F.xxhash64("doc_id", "text").alias("h"), "text")
    parts = map_batches(rows, sliced, "lang string, h long, part binary")
    one = lambda key, columns: {"lang": [key[0]], "dictionary": [dictionary([p for _, p in sorted(zip(columns["h"], columns["part"], strict=True))], size)]}
    found = {r["lang"]: bytes(r["dictionary"]) for r in map_groups(parts, ["lang"], one, "lang string, dictionary binary").collect()}  # all_bytes at most
    return {lang: found[lang] for lang in order}


def spread(text: bytes, n: int) -> bytes:
    """n bytes of a text at most, in slices that lie evenly all over it."""
    if len(text) <= n:
        return text
    k = -(-n // SLICE)
    wide = n // k
    return b"".join(text[at : at + wide] for at in (i * (len(text) - wide) // max(1, k - 1) for i in range(k)))


def dictionary(parts: list[bytes], size: int) -> bytes:
    """Different texts, each with the same share of `size` unless it is shorter than that."""
    parts = list(dict.fromkeys(parts))
    left, share = size, size
    for k, n in enumerate(sorted(map(len, parts))):
        share = left // (len(parts) - k)
        if n > share:
            break
        left -= n
    return b"".join(spread(p, share) for p in parts)[:size]


#: ASCII bytes that aren't lower-case letters become spaces.
_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def plain(text: str) -> bytes:
    return b" " + b" ".join(k for k, _ in groupby(text.lower().encode().translate(_LETTERS).split())) + b" "


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], piece_bytes: int = PIECE_BYTES) -> None:
        self.languages = list(dictionaries)  # the more frequent first: they win ties
        self.piece = piece_bytes
        self.squeeze = []
        for lang in self.languages:
            d = zstd.ZstdCompressionDict(dictionaries[lang] or b" ", dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.squeeze.append(
                zstd.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress
            )

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """language, score (0 to 1) and margin."""
        if text is None or not self.languages or not _letter(text):
            return "und", 0.0, 0.0
        n = self.piece
        flat = plain(text)
        pieces = [flat[i : i + n] for i in range(0, len(flat), n)] + endings(flat)
        sums = [sum(len(squeeze(p)) for p in pieces) for squeeze in self.squeeze]
        order = sorted(range(len(sums)), key=sums.__getitem__)
        best = sums[order[0]]
        if len(order) == 1:
            return self.languages[0], 1.0, 1.0
        margin = (sums[order[1]] - best) / best
        return self.languages[order[0]], min(1.0, 0.5 + 2 * margin), margin


def endings(flat: bytes) -> list[bytes]:
    """The last 1, 2, 4, ... ENDING_WORDS words, as far as the text goes."""
    words = flat.rsplit(maxsplit=ENDING_WORDS)[-ENDING_WORDS:]
    return [b" " + b" ".join(words[-k:]) + b" " for k in (1 << i for i in range(ENDING_WORDS.bit_length())) if k <= len(words)]


def _letter(text: str) -> bool:
    return _ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text))


_ASCII_LETTER = re.compile("[A-Za-z]")


def classify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """doc_id, lang_pred, score, rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)  # ALL_BYTES at most

    def make():
        classifier = Classifier(sent.value)

        def one(batch: pa.RecordBatch) -> dict:
            found = [classifier(t) for t in batch.column(1).to_pylist()]
            return {"doc_id": batch.column(0), "lang_pred": [x[0] for x in found], "score": [x[1] for x in found], "rejected": [x[2] < min_margin for x in found]}

        return one

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, make, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """docs without the texts that have no language or too narrow a margin; columns stay as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)
    at = docs.columns.index("text")

    def run(batches):
        classifier = Classifier(sent.value)
        for batch in batches:
            found = [classifier(t) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([lang != "und" and margin >= min_margin for lang, _, margin in found], pa.bool_()))

    return map_rows(docs, run, docs.schema)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: held_out, lang_pred, score (and rejected) for each document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = classify(docs, learn(docs))
    return found.select("doc_id", F.coalesce(fold("doc_id") == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
