"""Fingerprints and groups next to brute force."""

import random
import re

import xxhash

from quadrat.llm import simhash
from quadrat.llm.components import components
from quadrat.llm.queries import QUERIES
from tables import table  # noqa: F401

DATA = "/root/testdata/sf0.01"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(n, near):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if near(i, j):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return [find(i) for i in range(n)]


def test_links_join_what_is_two_bits_apart(spark):
    rng = random.Random(2)
    fps = []
    for _ in range(40):
        fps.append(rng.getrandbits(64))
        for _ in range(rng.randint(0, 12)):
            fp = fps[-1]
            for _ in range(rng.randint(1, 3)):
                fp ^= 1 << rng.randrange(64)
            fps.append(fp)
    fps += [0, 1, 3, 7, 1 << 63, (1 << 64) - 1, (1 << 64) - 2, 0xF << 60, 0x7 << 60]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    want = roots(len(fps), lambda i, j: bin((fps[i] ^ fps[j]) & (2 ** 64 - 1)).count("1") <= 2)
    df = spark.createDataFrame([(f,) for f in fps] + [(None,), (fps[0],)], "fp bigint")
    links = simhash.links(df).cache()
    assert all(bin((r["a"] ^ r["b"]) & (2 ** 64 - 1)).count("1") <= 2 for r in links.collect())
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert [found.get(f, f) for f in fps] == [fps[w] for w in want]


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, i) for i in range(1001, 1400)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + star + [(None, 3), (7, 7)], "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1400)}


def test_query_over_the_table(spark):
    texts = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect())
    fps = [brute_fingerprint(t) for _, t in texts]
    want = roots(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    got = sorted(tuple(r) for r in QUERIES["op8_simhash_popcount_grid"](spark, DATA).collect())
    assert got == [(texts[i][0], f"{fps[i]:016x}", texts[want[i]][0]) for i in range(len(texts))]


def test_odd_rows(table):
    rows = [(5, None), (4, ""), (9, " \t\n"), (1, "One two"), (1, "one TWO"), (None, "one two"), (7, "é É"), (8, "w " * 200_000), (None, "alone here")]
    got = simhash.near_groups(table("doc_id bigint, text string, FP string, component_id string", [(*r, "", "") for r in rows])).collect()
    assert sorted(map(str, got)) == sorted(map(str, [g for g in got])) and len(got) == len(rows)
    group = {(r["doc_id"], r["fp"]): r["component_id"] for r in got}
    assert group[5, 0] == group[4, 0] == group[9, 0] == 4
    two = simhash.fingerprint_of("one two")
    assert group[1, two] == 1 and group[None, two] == 1
    assert group[None, simhash.fingerprint_of("alone here")] is None
    assert simhash.fingerprint_of("w " * 200_000) == simhash.fingerprint_of("w w w")
    assert simhash.near_groups(table("doc_id bigint, text string", [])).count() == 0
