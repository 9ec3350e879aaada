"""Ids and texts next to the library's."""

import hashlib
import random
import struct

import numpy as np
import pytest
import sentencepiece

from quadrat.llm import pieces
from quadrat.llm.queries import QUERIES, tokenizer_path
from tables import table  # noqa: F401

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


@pytest.fixture(scope="module")
def own():
    with open(tokenizer_path(), "rb") as f:
        vocabulary = pieces.Vocabulary(f.read())
    return pieces.Encoder(vocabulary), pieces.Decoder(vocabulary)


def test_random_texts(library, own):
    encoder, decoder = own
    rng = random.Random(7)
    for _ in range(1500):
        parts = ["".join(rng.choice("ab the tionéñ  ▁\n\t\0é日😀 �₿</s>") for _ in range(rng.randint(0, 12)))
                 + rng.choice(["", " in", "the ", " " * rng.randint(1, 40), "ing", "\n\n", "a" * 30]) for _ in range(rng.randint(0, 5))]
        text = "".join(parts)
        want = library.encode(text, add_bos=True, add_eos=True)
        packed = encoder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == want, repr(text)
        assert decoder.decode(packed) == library.decode(want)


def test_any_ids_decode_as_in_the_library(library, own):
    rng = random.Random(3)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(259)]) for _ in range(rng.randint(0, 9))]
        assert own[1].decode(struct.pack(f"<{len(ids)}I", *ids)) == library.decode(ids), ids


def test_small_memories_change_nothing(library, own, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS_KEPT", 3)
    monkeypatch.setattr(pieces, "PAIRS_KEPT", 5)
    for text in ("one two three four five six " * 20, "x" * 5000, "seven eight nine\nten " * 30):
        assert np.frombuffer(own[0].encode(text), "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_query_over_the_table(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in QUERIES["op2_piece_prefix_table"](spark, DATA).collect():
        ids = library.encode(texts.pop(r["doc_id"]) or "", add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert not texts


def test_odd_rows(table, library):
    df = table("doc_id bigint, text string, IDS string, n_tokens int", [(1, None, "x", 1), (1, None, "x", 1), (None, "", "y", 2), (2, "a b " * 50_000, None, None)])
    rows = {(r["doc_id"], r["n_tokens"]) for r in pieces.token_report(df, tokenizer_path()).collect()}
    assert rows == {(1, 2), (None, 2), (2, len(library.encode("a b " * 50_000)) + 2)}
    apart = pieces.decode(pieces.encode(df, tokenizer_path()), tokenizer_path())
    together = pieces.encode_decode(df, tokenizer_path())
    assert sorted(map(str, apart.select("ids", "decoded").collect())) == sorted(map(str, together.select("ids", "decoded").collect()))
    coded = pieces.encode(df, tokenizer_path())
    assert coded.columns == ["doc_id", "text", "n_tokens", "ids"] and coded.count() == 4
    assert pieces.token_report(df.limit(0), tokenizer_path()).count() == 0
