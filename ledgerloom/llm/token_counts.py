"""Token counts (13) of whole texts under a piece model, without tokenizing most of their words.

Offline, once a model, the driver proves four things of its vocabulary: which strings encode alone as one token of
their own; that no piece has a space after another character, so nothing is ever merged across the gap between a word
and the space after it; which signs no piece has behind a letter or digit, so that a word and the signs at its end count
apart; and which control characters stand in no piece, so nothing is merged across them and each counts one token a byte.
The text then falls into pre-tokens, a run of spaces with the word after it, and its count is the sum of theirs: a
pre-token that is a proven string counts 1 without a merge, only the rest is merged by the library, and what that gave is
remembered up to `CACHE_BYTES`. A model of which the second can't be proven is merged whole text by text.

One pass without a shuffle. Null texts count as empty: no bytes, no tokens. Repeated rows fare alike, as do rows without
an id; texts of any length are taken whole. Other columns, whatever their names, stay behind.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.shared import map_batches

#: Tokens above which a text is over the limit.
LIMIT = 4096
#: Bytes of a model file that is broadcast, at most.
FILE_BYTES = 64 << 20
#: Bytes that remembered pre-tokens take in a worker, about; longer ones than LONG characters aren't remembered.
CACHE_BYTES = 160 << 20
LONG = 256
#: About what an entry of a dictionary takes beside its letters.
ENTRY_BYTES = 120

SPACE = "▁"  # as the models write a space
_RUNS = re.compile(" +[^ ]*")
_ALNUM = frozenset(string.ascii_letters + string.digits)


class Proof:
    """What holds of a model: `whole`, strings that are one token alone; `parts`, whether words stay apart at spaces;
    `tails`, signs that no piece has behind an ASCII letter or digit; `apart`, control characters that no piece holds, as
    a pattern (None: there are none)."""

    def __init__(self, model: bytes) -> None:
        merge = merger(model)
        pieces = {merge.id_to_piece(i).replace(SPACE, " "): i for i in range(merge.get_piece_size()) if not (merge.is_control(i) or merge.is_unknown(i) or merge.is_byte(i))}
        self.whole = frozenset(s for s, ids in zip(pieces, merge.encode(list(pieces)), strict=True) if ids == [pieces[s]])
        self.parts = not any(re.search("[^ ] ", s) for s in pieces)
        held = set("".join(pieces))
        loose = [c for c in map(chr, range(32)) if c not in held and len(merge.encode(c)) == 1]
        self.tails = "".join(sorted(set(string.punctuation) - {b for s in pieces for a, b in pairwise(s) if a in _ALNUM}))
        self.apart = f"[{re.escape(''.join(loose))}]" if loose else None


def merger(model: bytes):
    """The library's processor of a model, but without the space that it puts before a text. Raises for a model that
    normalizes texts, as its counts are no sum over parts."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model)
    n = spec.normalizer_spec
    if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("token counts need a model that keeps texts as they are")
    n.add_dummy_prefix = False
    return sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())


def prefixed(model: bytes) -> bool:
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model)
    return spec.normalizer_spec.add_dummy_prefix


class _Remembered(dict):
    """string -> tokens of `before` and the string. Proven strings stay. Others go when they haven't been asked for while
    half of the bytes allowed were filled: what is full becomes `old`, and is taken from there when asked for again."""

    def __init__(self, before: str, proven: Iterable[str], merge) -> None:
        self.proven, self.old, self.bytes = dict.fromkeys(proven, 1), {}, 0
        self.before, self.merge = before, merge
        super().__init__(self.proven)

    def __missing__(self, word: str) -> int:
        n = self.old.get(word)
        if n is None:
            n = len(self.merge.encode(self.before + word))
        if len(word) <= LONG:
            self.bytes += ENTRY_BYTES + 4 * len(word)
            if self.bytes > CACHE_BYTES // 4:
                self.old, self.bytes = dict(self), 0
                self.clear()
                self.update(self.proven)
            self[word] = n
        return n


class _Ended(_Remembered):
    """Words whose ending signs are counted apart: `tails` has those that no piece joins to the letter or digit before."""

    def __init__(self, before: str, proven: Iterable[str], merge, tails: str, alone: _Remembered) -> None:
        super().__init__(before, proven, merge)
        self.tails, self.alone = tails, alone

    def __missing__(self, word: str) -> int:
        if word and word[-1] in self.tails:
            core = word.rstrip(self.tails)
            if core and core[-1] in _ALNUM:
                return self[core] + self.alone[word[len(core) :]]
        return super().__missing__(word)


class Counter:
    """Tokens of a text."""

    def __init__(self, model: bytes, proof: Proof) -> None:
        self.merge = merger(model)
        self.first = " " if prefixed(model) else ""
        self.parts = proof.parts
        self.split = re.compile(proof.apart).split if proof.apart else lambda text: [text]
        self.alone = _Remembered("", proof.whole, self.merge)
        self.spaced = _Ended(" ", (s[1:] for s in proof.whole if s[0] == " " and " " not in s[1:]), self.merge, proof.tails, self.alone)

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        text = self.first + text.replace(SPACE, " ")
        if not self.parts:
            return len(self.merge.encode(text))
        lines = self.split(text)
        n = len(lines) - 1
        for line in lines:
            head, *words = line.split(" ")
            if head:
                n += self.alone[head]
            if "" in words:  # several spaces in a row, or one at the end
                n += sum(map(self.alone.__getitem__, _RUNS.findall(line, len(head))))
            else:
                n += sum(map(self.spaced.__getitem__, words))
        return n


_LOADED: dict[int, Counter] = {}


def count(docs: DataFrame, model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of each row. model: a file of the driver; executors need none."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    with open(model, "rb") as f:
        source = f.read(FILE_BYTES + 1)
    if len(source) > FILE_BYTES:
        raise ValueError(f"{model} is larger than {FILE_BYTES} bytes")
    sent = docs.sparkSession.sparkContext.broadcast((source, Proof(source)))

    def make():
        key = hash(sent.value[0])
        if key not in _LOADED:  # tasks of one worker share what it remembers
            _LOADED.clear()
            _LOADED[key] = Counter(*sent.value)
        counter = _LOADED[key]

        def one(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0), "n_bytes": batch.column(1), "n_tokens": [counter(t) for t in batch.column(2).to_pylist()]}

        return one

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    found = map_batches(rows, make, "doc_id long, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: tokens of all documents."""
    return count(spark.read.parquet(f"{sf_dir}/documents.parquet"))
