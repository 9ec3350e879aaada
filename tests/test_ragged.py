"""Ragged files next to Python's own reader of such files; long cells; control characters in texts."""

import csv
import io
import random

from conftest import rows

from quadrat.operators import substitute as U
from quadrat.sources import readers as S


def made(seed, n=300):
    rng = random.Random(seed)
    cells = ["", "a", "b c", "é", 'say ""x""', "x,y", "two\nlines", "three\n\nlines, \"\"q\"\"\n", " pad ", "\x01ctl", 'in"side']
    out = []
    for _ in range(n):
        line = []
        for _ in range(rng.randint(1, 5)):
            c = rng.choice(cells)
            line.append(f'"{c}"' if any(x in c for x in ',\n') or '""' in c or rng.random() < 0.2 and '"' not in c else c)
        out.append(",".join(line))
    return "\n".join(out) + "\n"


def read(text):
    lines, got, at = io.StringIO(text, newline="\n"), [], 0
    reader = csv.reader(lines, skipinitialspace=False)
    for record in reader:
        got.append((at, [c.strip(" ") for c in record if c.strip(" ")]))
        at = reader.line_num
    return got


def test_quoted_line_ends_over_many_blocks(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        for seed in range(3):
            text = made(seed)
            path = tmp_path / f"f{seed}"
            path.mkdir()
            (path / "a.csv").write_bytes(text.encode("latin1"))
            (path / "b.csv").write_bytes(b'x,"open\nto the end')
            got = rows(S.read_ragged(spark, str(path)), "row_no")
            want = read(text)
            assert got[:-1] == want and got[-1] == (text.count("\n"), ["x", '"open\nto the end'.lstrip('"')])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_long_cells(spark, tmp_path):
    (tmp_path / "l.csv").write_text('a,"' + "x" * 5_000_000 + '""' + "y\n" * 200_000 + '",b\nc,d\n')
    got = [(r["row_no"], [len(c) for c in r["cells"]]) for r in S.read_ragged(spark, str(tmp_path / "l.csv")).collect()]
    assert sorted(got) == [(0, [1, 5_000_001 + 400_000, 1]), (200_001, [1, 1])]


def test_control_characters_stay(spark):
    table = U.substitution_table(spark.createDataFrame([(0, ["feline", "cat"])], "row_no int, cells array<string>"))
    df = spark.createDataFrame([(1, "a\x01b cat c"), (2, "cat\x01cat \x01 Cat"), (3, "\x01"), (4, None), (5, "catalogue")], "id int, text string")
    got = rows(U.substitute_by_table(df, "id", "text", table, "out").select("id", "out"), "id")
    assert got == [(1, "a\x01b feline c"), (2, "feline\x01feline \x01 feline"), (3, "\x01"), (4, None), (5, "catalogue")]
