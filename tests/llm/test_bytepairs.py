"""Byte-level ids next to the tokenizer library."""

import base64
import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from quadrat.llm import bytepairs
from quadrat.llm.queries import QUERIES, RANKS
from tables import table  # noqa: F401

PATH, PATTERN = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_odd_rows(table, library):
    rng = random.Random(1)
    texts = [
        None, "", " ", "\n\n", "x  y   z\r\n\r\n  q ", "'s don't I'LL we'll they've", "1²³ ½ ٣ 12345", "\x00\x01 \x85 a\x1cb \xa0", "𐐷𝄞\U0001f600 \U00010570\u0870 \U000323b0",
        "日本語のテキスト" * 100, "a" * 3000, "ab" * 1500, " " * 2000 + "x", "=" * 1000, "".join(rng.choice("abcdefghij") for _ in range(3000)), "<|endoftext|>", "same text", "same text",
        "".join(chr(rng.choice([rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x30000)])) for _ in range(3000)), "the cat " * 20_000,
    ]
    rows = [(i // 2 if i < 4 else None, t, "", "", "") for i, t in enumerate(texts)]  # keys repeat and are null
    df = table("doc_id bigint, text string, IDS string, Decoded string, word string", rows)
    for most in (bytepairs.REMEMBERED, 0):
        got = bytepairs.decode(bytepairs.encode(df, PATH, PATTERN, most=most), PATH).collect()
        assert len(got) == len(texts)
        for r in got:
            assert r["ids"] == library.encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bytepairs.decode(bytepairs.encode(df.limit(0), PATH, PATTERN), PATH).count() == 0


def test_query_over_the_table(spark, library):
    got = sorted(tuple(r) for r in QUERIES["op13_byte_pair_fold"](spark, DATA).collect())
    want = []
    for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_long_words_and_few_remembered(table, library):
    rng = random.Random(2)
    texts = ["ab" * 40_000, "".join(rng.choice("etaoinshrdlu") for _ in range(20_000)), "語" * 5000 + "z" * 777, "-" * 100_000, " " * 50_000 + "end", "aab" * 3000 + " tail"]
    df = table("doc_id bigint, text string", list(enumerate(texts)))
    for most in (bytepairs.REMEMBERED, 1):
        got = bytepairs.encode(df, PATH, PATTERN, most=most).collect()
        assert [r["ids"] for r in sorted(got)] == [library.encode_ordinary(t) for t in texts]


def test_the_driver_holds_no_table_of_words_in_the_plan(table):
    df = table("doc_id bigint, text string", [(i, f"some words of text {i % 3}") for i in range(9)])
    assert len(bytepairs.encode(df, PATH, PATTERN)._jdf.queryExecution().toString()) < 200_000
