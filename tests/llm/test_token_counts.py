"""Token counts against the library's own, text by text."""

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from ledgerloom.llm import token_counts

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def proof():
    with open(MODEL, "rb") as f:
        return token_counts.Proof(f.read())


@pytest.fixture
def counter(proof):
    with open(MODEL, "rb") as f:
        return token_counts.Counter(f.read(), proof)


def test_all_documents(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = token_counts.counts(spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        text = texts[r["doc_id"]] or ""
        n = len(library.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 4096)


PARTS = ["a", "b", " ", "  ", "   ", "\n", "\t", "\r", "é", "ß", "▁", "😀", "日", "\x00", "1", "23", "<s>", "</s>", "<unk>", "<0x0A>", "hello", "world", ".", ",", "!?", ")", "_", "->", " the", "́", "\x1c", "\x85", " ", " ", "x" * 17]


def test_random_texts(library, counter):
    rnd = random.Random(13)
    for _ in range(5000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14)))
        assert counter(text) == len(library.encode(text)), repr(text)


def test_forgetting_changes_nothing(library, counter, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_BYTES", 4 * 20 * token_counts.ENTRY_BYTES)
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 9))) + rnd.choice(["", ".", "),"]) for _ in range(400)]
    for _ in range(30):
        text = " ".join(rnd.choices(words, k=50))
        assert counter(text) == len(library.encode(text))
    assert len(counter.spaced) - len(counter.spaced.proven) < 50


def test_proven_strings_are_one_token_and_are_not_merged(proof, counter, library):
    assert len(proof.whole) > 30_000 and proof.parts
    counter.merge = counter.alone.merge = counter.spaced.merge = None  # any merge would fail
    text = " ".join(s[1:] for s in sorted(proof.whole) if s[0] == " " and s[1:].isalpha())
    assert counter(text) == len(text.split(" ")) == len(library.encode(text))


def test_strings_that_split_are_not_proven():
    """A model in which one string of the vocabulary can't be reached by merges."""
    with open(MODEL, "rb") as f:
        spec = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    spec.pieces[-1].piece = "qzqzqzqz"
    spec.pieces[-1].type = 1
    proof = token_counts.Proof(spec.SerializeToString())
    assert "qzqzqzqz" not in proof.whole


def test_a_piece_across_a_gap_stops_the_cutting(library):
    with open(MODEL, "rb") as f:
        spec = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    spec.pieces[1000].piece = "s▁o"
    source = spec.SerializeToString()
    proof = token_counts.Proof(source)
    assert not proof.parts
    own = sentencepiece.SentencePieceProcessor(model_proto=source)
    for text in ("cats on mats", "", "a  b "):
        assert token_counts.Counter(source, proof)(text) == len(own.encode(text))


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "x y"), (2, ""), (3, "word " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("x")).withColumn("n.bytes", F.lit(1))
    found = sorted(map(tuple, token_counts.count(docs).collect()), key=repr)
    assert found == sorted([(1, 0, 0, False)] * 2 + [(None, 3, 2, False), (2, 0, 0, False), (3, 1_000_000, 200_001, True)], key=repr)
    assert token_counts.count(docs.limit(0)).count() == 0


def test_long_runs_cost_their_length(counter, library):
    text = "abc" * 300_000
    assert counter(text) == len(library.encode(text))
