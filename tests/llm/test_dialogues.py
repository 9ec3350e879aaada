"""Repaired conversations next to a search through all cheapest edits, and to SQL."""

import hashlib
import random
import re
import zlib

import duckdb

from quadrat.llm import dialogues
from quadrat.llm.queries import ORACLES, QUERIES
from tables import table  # noqa: F401

DATA = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h:
            row = (conv, turn, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)
            out += [row] * (2 if h == 3 else 1)
    return out


def brute_repair(rows):
    """Report of one conversation's rows, by the best (cost, audit) for each initial before each row."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    rows = [(t, r or "", x or "") for _, t, r, x in rows]
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.rstrip(SPACE)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None)
        seen.add((role, text))
    initials = [r[1][:1] or "-" for r in rows]
    grow = lambda sofar, c: bool(re.fullmatch(r"s?(ua)*u?", sofar + c)) and not (c == "s" and sofar)
    ways = {"": (0, "", [])}  # by the last two initials that stand
    tail = lambda s: s if len(s) < 2 else "u" if s[-1] == "u" else "ua"

    def better(into, key, way):
        if key not in into or way[:2] < into[key][:2]:
            into[key] = way

    def with_inserts(ways):
        for _ in range(3):
            for key, (cost, audit, lines) in list(ways.items()):
                for role in ("user", "assistant"):
                    if grow(key, role[0]):
                        better(ways, tail(key + role[0]), (cost + 5, audit + "I", [*lines, f"{role}:"]))
        return ways

    for (_, role, text), fault, initial in zip(rows, faults, initials):
        then = {}
        for key, (cost, audit, lines) in with_inserts(ways).items():
            better(then, key, (cost + 2, audit + "D", lines))
            if fault in (None, "truncated"):
                more = 5 if fault else 0
                if grow(key, initial):
                    better(then, tail(key + initial), (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
                for new in ("user", "assistant"):
                    if grow(key, new[0]):
                        better(then, tail(key + new[0]), (cost + more + 1, audit + "R", [*lines, f"{new}:{text}"]))
        ways = then
    cost, audit, lines = min((w for key, w in with_inserts(ways).items() if key in ("", "ua")), key=lambda w: w[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute(rows):
    damaged = brute_damage(rows)
    return {conv: brute_repair([r for r in damaged if r[0] == conv]) for conv in {r[0] for r in rows}}


def made(n, longest, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]) if rng.random() < 0.4 else ("assistant" if turn % 2 else "user")
            text = rng.choice(["Yes.", "No!", "cut off", "", " \t\n", None, "What? \x0b", "end.\u00a0", f"text {turn}."]) if rng.random() < 0.5 else f"text {conv} {turn}."
            rows.append((None if conv == 3 else conv, None if rng.random() < 0.03 else turn + 2 * (turn > 5), role, text))
    return rows + [(1, 1, "user", "again."), (1, 1, "user", "again.")]


SCHEMA = "conv_id bigint, turn bigint, role string, text string, cid string, pos string, h int"


def test_rows_next_to_brute_force(table):
    rows = made(150, 9, 1) + [(900, i, "user" if i % 2 else "assistant", f"long {i % 40}.") for i in range(150)] + [(901, 0, "user", "x" * 1_000_000 + "."), (902, None, "system", "Only.")]
    rows += [(c, t, "user", "gone.") for c in range(1000, 1400) for t in [0]]  # some lose their only row
    df = table(SCHEMA, [(*r, "", "", 0) for r in rows])
    want = brute(rows)
    for segment in (dialogues.SEGMENT, 5):
        got = {r[0]: tuple(r)[1:] for r in dialogues.repair_report(df, dialogues.damaged(df), segment=segment).collect()}
        assert got == want
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) in want.values()
    assert dialogues.repair_report(df.limit(0), dialogues.damaged(df.limit(0))).count() == 0


def test_search_is_the_cheapest_first_audit():
    rng = random.Random(3)
    for _ in range(300):
        codes = "".join(rng.choice("suaxSUAXtvby" if rng.random() < 0.5 else "uuaas") for _ in range(rng.randint(0, 12)))
        rows = []
        for i, c in enumerate(codes):
            initial = c.lower().translate(str.maketrans("tvby", "suax"))
            rows.append((0, i, {"s": "system", "u": "user", "a": "assistant", "x": "tool"}[initial], "" if c in "SUAX" else f"{i}" + ("" if c in "tvby" else ".")))
        cost, audit, _ = dialogues.search(codes, dialogues.START, dialogues.FINAL, True)
        assert (cost, audit) == brute_repair(rows)[5:7]


def test_long_rows_of_one_role_stay_quick():
    cost, audit, _ = dialogues.search("u" * 512, dialogues.START, dialogues.FINAL, True)
    assert cost == 256 and audit.count("R") == 256


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    want = sorted(con.sql(ORACLES["op12_conversation_repair"]).fetchall())
    got = sorted(tuple(r) for r in QUERIES["op12_conversation_repair"](spark, DATA).collect())
    assert got == want
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: r[1:] for r in got} == brute(rows)
