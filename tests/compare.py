"""Run registered queries next to their SQL and compare schema and rows.

    python tests/compare.py sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = Path("/root/testdata")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA / sf / name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if not isinstance(v, float) else (math.isnan(v), v)) for v in row)


def difference(df, con, sql: str) -> str | None:
    """None when the results are equal, otherwise what differs first."""
    got = df.toArrow()
    want = con.sql(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    names = sorted(got.column_names)
    kinds = [(n, str(got.schema.field(n).type).replace("large_", ""), str(want.schema.field(n).type).replace("large_", "")) for n in names]
    wrong = [k for k in kinds if k[1] != k[2]]
    if wrong:
        return f"types {wrong}"
    a = sorted(zip(*[got.column(n).to_pylist() for n in names]), key=_key)
    b = sorted(zip(*[want.column(n).to_pylist() for n in names]), key=_key)
    if len(a) != len(b):
        only_a, only_b = list(set(a) - set(b))[:2], list(set(b) - set(a))[:2]
        return f"rows {len(a)} != {len(b)}; spark only {only_a}; sql only {only_b}"
    for x, y in zip(a, b):
        if x != y:
            return f"{sum(p != q for p, q in zip(a, b))} rows differ, first {names}: {x} != {y}"
    return None


def main() -> None:
    from quadrat.queries import ORACLES, QUERIES
    from quadrat.session import build_session

    sf, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, str(DATA / sf))
            if name in ORACLES:
                problem = difference(df, con, ORACLES[name])
                state = "ok" if problem is None else f"DIFF {problem[:600]}"
            else:
                state = f"rows {df.count()}"
        except Exception as e:
            state = f"FAIL {type(e).__name__}: {str(e)[:700]}"
        bad += not state.startswith(("ok", "rows"))
        print(f"{name:28s} {time.time() - start:6.2f}s {state}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
