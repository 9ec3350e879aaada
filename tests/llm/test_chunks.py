"""Passages repeated across documents next to brute force."""

import random

from tables import table  # noqa: F401

from quadrat.llm import chunks


def bounds(raw):
    """Chunk ends, one byte after another."""
    out = []
    for e in range(1, len(raw)):
        h = sum(int(chunks._GEAR[b]) << j for j, b in enumerate(reversed(raw[max(0, e - 16):e]))) & 0xFFFF
        if h >> 11 == 0 and raw[e] & 0xC0 != 0x80:
            out.append(e)
    return [0, *out, len(raw)] if raw else [0]


def brute(rows):
    """Every byte string of two neighbouring chunks is looked for in the texts of smaller keys, as it is."""
    cut, owner = [], {}
    for k, t in rows:
        raw = (t or "").encode()
        at = bounds(raw)
        pairs = [raw[at[i]:at[i + 2]] for i in range(len(at) - 2)] or ([raw] if raw else [])
        cut.append((k, raw, at, pairs))
        if k is not None:
            for p in pairs:
                owner[p] = min(owner.get(p, k), k)
    out = []
    for k, raw, at, pairs in cut:
        gone, n, passages = set(), 0, 0
        known = [k is not None and owner[p] < k for p in pairs] + [False]
        first = last = None
        for i, yes in enumerate(known):
            if yes:
                first = i if first is None else first
            elif first is not None:
                a, b = max(first, last or 0), min(i + 1, len(at) - 1)
                part = raw[at[a]:at[b]]
                words = sum(1 if len(w.decode()) <= 30 else len(w.decode()) // 6 for w in part.split())
                last = b
                if words >= 15:
                    gone.update(range(at[a], at[b]))
                    n, passages = n + b - a, passages + 1
                first = None
        out.append((k, len(at) - 1, n, passages, bytes(x for i, x in enumerate(raw) if i not in gone).decode()))
    return sorted(out, key=str)


def say(rng, n):
    return " ".join("".join(rng.choice("abcdeéñ") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_gear_is_rolled_over_the_last_bytes():
    raw = say(random.Random(1), 400).encode()
    assert [0, *chunks.ends(raw)] == bounds(raw)


def test_passages_are_caught_and_clean_texts_left(table):
    rng = random.Random(2)
    passages = [say(rng, 60) for _ in range(30)]
    rows = [(i, say(rng, rng.randint(5, 80)) + " " + passages[i % 30] + say(rng, rng.randint(0, 80))) for i in range(60)] + [(100 + i, say(rng, 200)) for i in range(30)]
    rows += [(None, passages[0]), (300, None), (301, ""), (302, "x" * 30_000), (303, "x" * 30_000), (5, rows[5][1]), (304, "short"), (305, "short")]
    df = table("doc_id bigint, text string, KEPT int, n_chunks int, digest int, __key int, __known int, key int, row int, of int", [(*r, *[0] * 8) for r in rows])
    got = [tuple(r) for r in chunks.drop_repeated_passages(df).select("doc_id", "n_chunks", "n_dropped", "n_passages", "kept").collect()]
    assert sorted(got, key=str) == brute(rows)
    hit = {r[0] for r in got if r[3]} - {303}
    assert not any(k is None or k < 30 or k >= 100 for k in hit) and len(hit) >= 28
    assert chunks.drop_repeated_passages(df.limit(0)).count() == 0


def test_passages_without_blanks_are_caught(table):
    rng = random.Random(4)
    chinese, code = ("".join(chr(rng.randrange(low, high)) for _ in range(2_000)) for low, high in ((0x4E00, 0x9FA0), (0x21, 0x7F)))
    rows = [(1, chinese), (2, chinese), (3, code), (4, "before " + code + " after"), (5, "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(2_000)))]
    got = {r["doc_id"]: r for r in chunks.drop_repeated_passages(table("doc_id bigint, text string", rows)).collect()}
    assert [got[i]["n_passages"] for i in range(1, 6)] == [0, 1, 0, 1, 0]
    assert got[2]["kept"] == "" and len(got[4]["kept"]) < 400 and got[5]["kept"] == rows[4][1]


def test_what_is_dropped_stands_in_a_smaller_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: (r["text"] or "") for r in docs.collect()}
    whole = runs = 0
    owners, cut = {}, {}
    for k, t in sorted(texts.items()):
        stops, digests = chunks.chunks(t.encode())
        cut[k] = stops, digests
        for d in digests:
            owners.setdefault(d, k)
    for k, (stops, digests) in cut.items():
        raw = texts[k].encode()
        for a, b in chunks.runs(stops, digests, {d for d in digests if owners[d] < k}):
            part = raw[stops[a - 1] if a else 0:stops[b - 1]]
            if len(part.split()) >= chunks.RUN_WORDS:
                runs += 1
                whole += any(part in texts[j].encode() for j in {owners[d] for d in digests[a:b - 1]} if j < k)
    assert runs > 100 and whole >= 0.98 * runs, (whole, runs)  # the others are pieced together from near copies of one text, pair by pair
