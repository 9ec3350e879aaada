"""Exact copies and repeated lines next to brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np

from quadrat.llm import copies, lines
from tables import table  # noqa: F401

BLANK = " \t\n\x0b\x0c\r"


def brute_copies(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub("[ \t\n\x0b\x0c\r]", "", text or "")].append((-len(text or ""), key is None, key))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        out += [(m[2], members[0][2], len(members), i == 0, hashlib.sha256(norm.encode()).hexdigest()) for i, m in enumerate(members)]
    return sorted(out, key=str)


ROWS = [(i, random.Random(i % 7).choice(["a b", "ab ", "  ", "", "x\ny", "x\x0by\t", "é é", "É é"])) for i in range(60)]
ROWS += [(None, "ab"), (None, None), (3, "a b"), (3, "a b"), (99, "long " * 30_000), (98, "long" * 30_000), (100, "ab ")]


def test_copies(table):
    got = [tuple(r) for r in copies.exact_groups(table("doc_id bigint, text string, norm string, part int", [(*r, "n", 1) for r in ROWS])).collect()]
    assert sorted(got, key=str) == brute_copies(ROWS)


def test_copies_in_parts(table, monkeypatch):
    monkeypatch.setattr(copies, "PART_ROWS", 4)
    got = [tuple(r) for r in copies.exact_groups(table("doc_id bigint, text string", ROWS)).collect()]
    assert sorted(got, key=str) == brute_copies(ROWS)


def test_copies_of_nothing(table):
    assert copies.exact_groups(table("doc_id bigint, text string", [])).count() == 0


def brute_lines(rows):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANK))

    holders = defaultdict(set)
    for k, text in rows:
        if k is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= 20:
                    holders[key(line)].add(k)
    out = []
    for k, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if k is None or len(holders[key(x)]) < 3 or max(holders[key(x)]) == k]
        out.append((k, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def line_rows():
    rng = random.Random(5)
    pool = ["A common line of the corpus", " a COMMON line of the corpus\t", "short", "", "ééééééééééééééééééé", "éééééééééééééééééééé", "ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ",
            *[f"line number {i} has enough length" for i in range(40)]]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 8)))) for i in range(80)]
    return rows + [(None, pool[0]), (None, "\n".join(pool)), (5, rows[5][1]), (200, None), (201, ""), (202, "\n"), (203, "\n".join(pool) * 200)]


def got_lines(df, **kw):
    return sorted((tuple(r) for r in lines.drop_repeated_lines(df, **kw).select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=str)


def test_lines(table):
    rows = line_rows()
    df = table("doc_id bigint, text string, N_LINES int, line string, __key int, __dropped int, __both int, of int, row int", [(*r, 0, "z", 0, 0, 0, 0, 0) for r in rows])
    assert got_lines(df) == brute_lines(rows)


def test_full_filters_change_nothing(table):
    rows = line_rows()
    assert got_lines(table("doc_id bigint, text string", rows), bits=1 << 10) == brute_lines(rows)


def test_lines_of_nothing(table):
    assert got_lines(table("doc_id bigint, text string", [])) == []


def test_filter_has_what_was_set():
    h = np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64)
    f = np.zeros(1 << 13, np.uint8)
    lines._set(f, lines._places(h[:2500], 1 << 16))
    assert lines._has(f, lines._places(h[:2500], 1 << 16)).all()
    assert lines._has(f, lines._places(h[2500:], 1 << 16)).mean() < 0.05
