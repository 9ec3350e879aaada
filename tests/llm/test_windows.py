"""Benchmark passages next to brute force."""

import hashlib
import random
import re

from quadrat.llm import windows
from quadrat.llm.queries import QUERIES
from tables import table  # noqa: F401

DATA = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    patterns = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            patterns.setdefault(tuple(w[i:i + 10]), set()).add("" if item is None else str(item))
    out = []
    for key, text in docs:
        w, hit, met = words(text), set(), set()
        for size in {len(p) for p in patterns}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in patterns:
                    hit.update(range(i, i + size))
                    met |= patterns[tuple(w[i:i + size])]
        out.append((key, len(w), len(hit), sorted(met)))
    return sorted(out, key=str)


def found(docs, table, **kw):
    rows = windows.find(docs, table, **kw).select("doc_id", "n_words", windows.hit_words().alias("n_hit"), "items").collect()
    return sorted(((r[0], r[1], r[2], sorted(r[3])) for r in rows), key=str)


def case():
    rng = random.Random(9)
    say = lambda n: " ".join(rng.choice(["a", "b", "A", "é1", "É1"]) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 3, 5, 9, 10, 11, 14])) if i > 2 else say(14)) for i in range(14)]
    items = [(i, t) for i, t in items if len(t.split()) > 2] + [(20, "x-y"), (21, None), (22, " .,"), (23, items[0][1]), (None, "zz zz zz")]
    docs = [(i, say(rng.randint(0, 60))) for i in range(60)] + [(90, items[0][1].replace(" ", " \n-") + " tail"), (91, None), (92, ""), (None, "x, Y."), (92, "zz zz zz zz"), (92, "zz zz zz zz"),
                                                              (93, ("q " * 1000 + items[1][1] + " ") * 20)]
    return docs, items


def test_find(table):
    docs, items = case()
    df = table("doc_id bigint, text string, SPANS int, items string, spans_so_far int, items_so_far int, row int", [(*d, 1, "", 0, 0, 0) for d in docs])
    bench = windows.patterns(table("item_id bigint, text string, words int", [(*i, 1) for i in items]))
    assert found(df, bench) == brute(docs, items)
    assert found(df, bench, limit=7) == brute(docs, items)  # several passes
    assert found(df.limit(0), bench) == []


def test_without_items(table):
    docs, _ = case()
    assert found(table("doc_id bigint, text string", docs), windows.patterns(table("item_id bigint, text string", []))) == brute(docs, [])


def test_shift_search_finds_every_place():
    rng = random.Random(0)
    for _ in range(300):
        size = rng.randint(1, 5)
        text = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 30))]
        patterns = {tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(size)): [k] for k in range(rng.randint(1, 6))}
        want = [(i, patterns[tuple(text[i:i + size])]) for i in range(len(text) - size + 1) if tuple(text[i:i + size]) in patterns]
        assert list(windows.Search(size, patterns).over(text)) == want


def test_query_over_the_table(spark):
    read = lambda name, key: [(r[key], r["text"]) for r in spark.read.parquet(f"{DATA}/{name}.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op9_benchmark_wu_manber"](spark, DATA).collect()), key=str)
    want = brute(read("documents", "doc_id"), read("benchmark", "item_id"))
    assert got == [(k, n, hit, len(met), hashlib.sha256(",".join(met).encode()).hexdigest(), hit > 0) for k, n, hit, met in want]
    assert any(r[5] for r in got)
