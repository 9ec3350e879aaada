"""Phrases next to brute force and SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np

from quadrat.llm import phrases
from quadrat.llm.queries import ORACLES, QUERIES
from tables import table  # noqa: F401

DATA = "/root/testdata/sf0.01"


def brute(rows, threshold=30, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in (1, 2, 3, 4) for i in range(len(words) - k + 1))
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= threshold:
            found[lang, p] = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
    out = []
    for lang in n:
        own = [(-score, -f[lang, p], " ".join(p).encode(), p, k) for (of, p), (score, k) in found.items() if of == lang]
        inside = lambda p, q: len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
        own = sorted(x for x in own if not any(inside(x[3], y[3]) and 100 * y[1] <= 80 * x[1] for y in own))
        out += [(lang, i, x[2].decode(), -x[1], f[lang, x[3][:x[4]]], f[lang, x[3][x[4]:]], n[lang], -x[0]) for i, x in enumerate(own[:top], 1)]
    return sorted(out)


def made(n=400):
    rng = random.Random(5)
    words = ["of", "the", "New", "york", "City", "hall", "a\xa0b", "é", "x"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words) if rng.random() < 0.7 else "new York city hall opens" for _ in range(rng.randint(0, 60)))
        rows.append((i, re.sub(r"w1\b", ".", re.sub(r"w2\b", "\t\n", text)), rng.choice(["en", "de", None])))
    return rows + [(None, None, "en"), (None, "", None), (7, "the of " * 30_000, "fr"), (7, "the of " * 30_000, "fr"), (8, "only once", "es")]


def test_rows_next_to_brute_force(table):
    rows = made()
    df = table("doc_id bigint, text string, lang string, phrase string, rank int, N string", [(*r, "", 0, "") for r in rows])
    want = brute([(lang, text) for _, text, lang in rows])
    assert sorted(tuple(r) for r in phrases.collocations(df).collect()) == want and len(want) > 20
    assert phrases.collocations(df.limit(0)).count() == 0


def test_poor_samples_change_nothing(table, monkeypatch):
    rows = made(200)
    df = table("doc_id bigint, text string, lang string", rows)
    want = brute([(lang, text) for _, text, lang in rows], 20)
    for proposed, bits in ((10**9, 1 << 20), (1, 1 << 10)):  # nothing is proposed; a filter so full that nearly everything is counted
        monkeypatch.setattr(phrases, "LEAST_BITS", bits)
        monkeypatch.setattr(phrases, "MOST_BITS", bits)
        assert sorted(tuple(r) for r in phrases.collocations(df, threshold=20, proposed=proposed).collect()) == want


def test_hashes_agree():
    words = [b"one", b"two", b"three"]
    h = np.array([phrases._phrase_hash("en", w.decode()) for w in words], np.uint64)
    two = phrases._joined(h[:-1], h[1:])
    assert phrases._phrase_hash("en", "one two") == int(two[0]) and phrases._phrase_hash("en", "one two three") == int(phrases._joined(two[:1], h[2:])[0])


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = sorted(con.sql(ORACLES["op11_toivonen_phrases"]).fetchall())
    got = sorted(tuple(r) for r in QUERIES["op11_toivonen_phrases"](spark, DATA).collect())
    assert got == want and len(got) > 100
