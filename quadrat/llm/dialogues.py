"""Repair of conversation structure by iterative-deepening A*.

A conversation's rows are turned into one that reads ``system? (user assistant)+``, or into none,
by the cheapest edits: keep, give another role, delete, insert. The search goes depth first
through the edits in the order of their letters (D, I, K, R) under a cost bound, which rises to
the least cost that the last round could not rule out. A table of failed states (row, role
before it) remembers for each the least cost from there that is still possible. As the letters
are tried in order, the first accepting path is the cheapest audit that comes first.

Nothing needs a whole conversation at once. Rows are numbered inside range partitions, faults
come from joins, and rows go on as one character each in segments of ``SEGMENT``. A
conversation of several segments is searched segment by segment: searches from each to each
role before and behind a segment give its costs, a pass from the last segment to the first
gives the cost behind each, and with that cost each segment is searched by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quadrat.operators.numbering import with_row_numbers
from quadrat.session import cut_lineage

SEGMENT = 512
SPACE = " \t\n\x0b\x0c\r"
NEVER = 1 << 60

# Costs (fixed values).
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5

# What stands before a row: nothing, a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
_AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_WANTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the one role of the two that may follow
FINAL = [0, NEVER, NEVER, 0]
# A row as one character: its role's initial (others: x), capital if it must go; small letters shifted by one for truncated rows.
SOUND, GONE, CUT = "suax", "SUAX", "tvby"


def search(codes: str, before: int, behind: list[int], last: bool) -> tuple[int, str, int]:
    """Least cost, its first audit, and what stands behind it, for rows ``codes`` with ``before`` standing before them.

    ``behind`` is the cost still to come after the rows, by what stands there then. Rows can be
    inserted before each row and, where the conversation ends (``last``), behind the rows.
    """
    n = len(codes)
    must = [0] * (n + 1)  # no path from row i costs less
    for i in range(n - 1, -1, -1):
        must[i] = must[i + 1] + (0 if codes[i] in SOUND else DELETE)
    rest = min(behind)
    least: dict[tuple[int, int], int] = {}  # of failed states: least cost from there that is still possible

    def possible(i: int, q: int) -> int:
        return least.get((i, q), must[i] + rest)

    def edits(i: int, q: int) -> list[tuple[str, int, int, int]]:
        """(letter, cost, next row, what then stands before it) in order."""
        out, wanted = [], _WANTED[q]
        if i < n:
            out.append(("D", DELETE, i + 1, q))
        if i < n or last:
            out.append(("I", INSERT, i, wanted))
        if i < n and codes[i] not in GONE:
            cut = codes[i] in CUT
            then = _AFTER.get((q, SOUND[CUT.index(codes[i])] if cut else codes[i]))
            if then is not None:
                out.append(("K", TRUNCATED * cut, i + 1, then))
            out.append(("R", REROLE + TRUNCATED * cut, i + 1, wanted))
        return out

    bound = possible(0, before)
    while bound < NEVER:
        path: list[tuple[str, int, int, int]] = []
        stack = [(0, before, 0, iter(edits(0, before)))]
        while stack:
            i, q, spent, rests = stack[-1]
            if i == n and spent + behind[q] <= bound:
                return spent + behind[q], "".join(e[0] for e in path), q
            for edit in rests:
                if spent + edit[1] + possible(edit[2], edit[3]) <= bound:
                    path.append(edit)
                    stack.append((edit[2], edit[3], spent + edit[1], iter(edits(edit[2], edit[3]))))
                    break
            else:
                ways = [cost + possible(j, r) for _, cost, j, r in edits(i, q)] + ([behind[q]] if i == n else [])
                least[i, q] = max(possible(i, q), min(ways, default=NEVER))
                stack.pop()
                if path:
                    path.pop()
        bound = least[0, before]
    return NEVER, "", before


def costs(codes: str) -> list[int]:
    """Least cost from each to each of the four things that can stand before and behind the rows."""
    out = []
    for q in range(4):
        for r in range(4):
            reachable = r >= USER or q == r or (q == START and r == SYSTEM and any(c in "st" for c in codes))
            out.append(search(codes, q, [0 if x == r else NEVER for x in range(4)], False)[0] if reachable else NEVER)
    return out


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _each(df: DataFrame, fields: str, of: Callable[[dict], list[tuple]]) -> DataFrame:
    """Rows with ``fields`` made from each row on its own."""
    schema = to_arrow_schema(T._parse_datatype_string(fields))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                yield _rows(schema, [made for row in whole.slice(at, 64).to_pylist() for made in of(row)])

    return df.mapInArrow(step, fields)


def _along(df: DataFrame, order: list, fields: str, step: Callable[[dict, object], tuple[list[tuple], object]], end: Callable[[str, object], list[tuple]] | None = None) -> DataFrame:
    """Go through the rows of each ``cid`` in order with a small state, which is None at the first row.

    Rows stream through the task that sorts them; none but the current batch is held.
    """
    schema = to_arrow_schema(T._parse_datatype_string(fields))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cid = state = None
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                out = []
                for row in whole.slice(at, 512).to_pylist():
                    if row["cid"] != cid:
                        if cid is not None and end:
                            out += end(cid, state)
                        cid, state = row["cid"], None
                    made, state = step(row, state)
                    out += made
                yield _rows(schema, out)
        if cid is not None and end:
            yield _rows(schema, end(cid, state))

    return df.repartition("cid").sortWithinPartitions("cid", *order).mapInArrow(go, fields)


def damaged(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with made faults, by the CRC-32 of conversation and turn modulo 20.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes it a
    user row. Null roles and texts become one space, as nulls do under the CRC.
    """
    rows = df.select(F.col(conversation).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"))
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.withColumn("h", F.crc32(F.concat(of("conv"), F.lit(":"), of("turn")).cast("binary")) % 20).filter("h <> 0")
    copies = F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    text_ = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(F.col("conv").alias(conversation), F.col("turn").alias(turn), F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias(role), text_.alias(text), copies.alias("copy")).drop("copy")


def faults(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows as ``cid, pos, turn, role, text, fault, code``, written once.

    ``cid`` is never null. Rows stand by turn (nulls first), then role and text; ``pos`` counts
    from 0. The first fault counts: ``blank`` (nothing but white space), ``duplicate`` (role and
    text stand earlier), ``truncated`` (does not end in ``.!?``); null if there is none. Null
    roles and texts count as empty.
    """
    cid = F.when(F.col(conversation).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(conversation).cast("string")))
    rows = df.select(cid.alias("cid"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    rows = with_row_numbers(rows, [F.col("turn").asc_nulls_first(), "role", "text"], "pos", by=["cid"])
    mark = F.sha2(F.concat_ws("\n", "cid", F.length("role").cast("string"), "role", "text"), 256)
    rows = rows.withColumn("mark", mark)
    again = rows.groupBy("mark").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark", "first")
    said = F.rtrim("text", F.lit(SPACE))
    fault = F.when(said == "", "blank").when(F.col("pos") > F.col("first"), "duplicate").when(~F.substr(said, F.lit(-1)).isin(".", "!", "?"), "truncated")
    initial = F.when(F.substr("role", F.lit(1), F.lit(1)).isin("s", "u", "a"), F.substr("role", F.lit(1), F.lit(1))).otherwise("x")
    code = F.when(F.col("fault").isNull(), initial).when(F.col("fault") == "truncated", F.translate(initial, SOUND, CUT)).otherwise(F.upper(initial))
    return cut_lineage(rows.join(again, "mark", "left").withColumn("fault", fault).select("cid", "pos", "turn", "role", "text", "fault", code.alias("code")))


def _initials(codes: str) -> str:
    return codes.lower().translate(str.maketrans(CUT, SOUND))


def _illegal(initials: str) -> int:
    return sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def edits_of(rows: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """The edits of ``faults`` rows as ``cid, pos, ord, edit, role``, and of each segment ``cid, seg, cost, audit, illegal``.

    A conversation is searched in segments of ``segment`` rows. ``ord`` orders insertions before the row at ``pos``; the row's own edit comes behind them.
    ``role`` is the new one of inserted and changed rows, else null.
    """
    seg = F.floor(F.col("pos") / segment)
    coded = rows.groupBy("cid", seg.alias("seg")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]), "").alias("codes"))
    segments = cut_lineage(coded)
    many = segments.join(segments.filter("seg > 0").select("cid").distinct(), "cid", "left_semi")
    table = _each(many, "cid string, seg bigint, costs array<bigint>", lambda r: [(r["cid"], r["seg"], costs(r["codes"]))])

    def back(row: dict, state: list[int] | None):
        if state is None:  # the last segment; rows may be inserted behind it
            behind = [0, 2 * INSERT, INSERT, 0]
        else:
            behind = state
        c = row["costs"]
        return [(row["cid"], row["seg"], behind)], [min(c[4 * q + r] + behind[r] for r in range(4)) for q in range(4)]

    behind = _along(table, [F.desc("seg")], "cid string, seg bigint, behind array<bigint>", back)

    def solve(row: dict) -> list[tuple]:
        if row["behind"] is None:
            return [(row["cid"], row["seg"], row["codes"], [search(row["codes"], START, FINAL, True)])]
        end = FINAL if row["last"] else row["behind"]
        return [(row["cid"], row["seg"], row["codes"], [search(row["codes"], q, end, row["last"]) for q in range(4)])]

    ends = segments.groupBy("cid").agg(F.max("seg").alias("end"))
    ready = segments.join(behind, ["cid", "seg"], "left").join(ends, "cid").withColumn("last", F.col("seg") == F.col("end"))
    way = "array<struct<cost: bigint, audit: string, behind: int>>"
    solved = _each(ready.select("cid", "seg", "codes", "behind", "last"), f"cid string, seg bigint, codes string, ways {way}", lambda r: [
        (cid, s, codes, [{"cost": c, "audit": a, "behind": b} for c, a, b in ways]) for cid, s, codes, ways in solve(r)])

    def forth(row: dict, state: tuple[int, str] | None):
        q, before = state or (START, "")
        way, initials = row["ways"][q], _initials(row["codes"])
        cost = way["cost"] if row["seg"] == 0 else None  # that of the whole conversation
        return [(row["cid"], row["seg"], q, cost, way["audit"], _illegal(before + initials))], (way["behind"], initials[-1:])

    chosen = cut_lineage(_along(solved, ["seg"], "cid string, seg bigint, before int, cost bigint, audit string, illegal bigint", forth))

    def apart(row: dict) -> list[tuple]:
        """Edits with their roles; a kept row is followed by what its initial says."""
        out, i, q, k, first = [], 0, row["before"], 0, row["seg"] * segment
        initials = _initials(row["codes"])
        for letter in row["audit"]:
            role = ROLES[_WANTED[q]] if letter in "IR" else None
            out.append((row["cid"], first + i, k, letter, role))
            if letter in "IR":
                q = _WANTED[q]
            elif letter == "K":
                q = _AFTER[q, initials[i]]
            i, k = (i, k + 1) if letter == "I" else (i + 1, 0)
        return out

    edits = _each(chosen.join(segments, ["cid", "seg"]), "cid string, pos bigint, ord int, edit string, role string", apart)
    return edits, chosen.select("cid", "seg", "cost", "audit", "illegal")


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired conversations as ``cid, pos, ord, edit, role, text``; inserted rows have an empty text."""
    stay = edits.filter("edit <> 'D'").withColumn("at", F.when(F.col("edit") != "I", F.col("pos")))
    old = rows.select("cid", F.col("pos").alias("at"), F.col("role").alias("old"), "text")
    both = stay.join(old, ["cid", "at"], "left")
    return both.select("cid", "pos", "ord", "edit", F.coalesce("role", "old").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _digests(made: DataFrame) -> DataFrame:
    def add(row: dict, state):
        h = hashlib.sha256() if state is None else state
        h.update(("" if state is None else "\n").encode() + f"{row['role']}:{row['text']}".encode())
        return [], h

    return _along(made.select("cid", "pos", "ord", "role", "text"), ["pos", "ord"], "cid string, repaired_sha256 string", add, lambda cid, h: [(cid, h.hexdigest())])


def repair_report(original: DataFrame, df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """One row for each conversation of ``original``, which ``df`` has the rows of.

    Columns: the conversation, ``gaps`` (missing turn numbers; null turns do not count),
    ``blank``, ``duplicate``, ``truncated``, ``illegal`` (neighbours out of order), ``cost``,
    ``audit`` (letters of the edits), ``repaired_sha256`` (of ``role:text`` lines). A
    conversation without rows has zeros, an empty audit and the digest of nothing; rows without
    a conversation are one of their own. Repeated rows are duplicates of the first. A role
    counts by its first letter; one that does not begin with s, u or a (an empty one too) fits
    nowhere. An empty ``original`` gives no row. The audit of a conversation, and its digest,
    are one value each, as long as the conversation.
    """
    rows = faults(df, conversation, turn, role, text)
    edits, segments = edits_of(rows, segment)
    of_turn = rows.groupBy("cid", "turn").agg(*[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")])
    seen = of_turn.groupBy("cid").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    audits = segments.groupBy("cid").agg(
        F.sum("illegal").alias("illegal"), F.max("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    cid = F.when(F.col(conversation).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(conversation).cast("string")))
    all_ = original.select(F.col(conversation).alias("conv")).distinct().withColumn("cid", F.when(F.col("conv").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("conv").cast("string"))))
    joined = all_.join(seen, "cid", "left").join(audits, "cid", "left").join(_digests(repaired(rows, edits)), "cid", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return joined.select(
        F.col("conv").alias(conversation), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
