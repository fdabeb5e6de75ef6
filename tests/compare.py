"""Run registered queries next to their DuckDB equivalents: python tests/compare.py [sf] [names]"""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, folder: str, query, sql: str) -> list[str]:
    df = query(spark, folder)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = normal(names, cur.fetchall())
    out = []
    if sorted(df.columns) != sorted(names):
        out.append(f"columns {sorted(df.columns)} / {sorted(names)}")
    if len(ours) != len(theirs):
        out.append(f"rows {len(ours)} / {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    typed = [(a, b) for a, b in zip(ours, theirs)
             if [type(x) for x in a] != [type(x) for x in b]]
    if wrong:
        out.append(f"{len(wrong)} rows differ, first {wrong[0][0]} / {wrong[0][1]}")
    if typed and not wrong:
        out.append(f"types differ, first {typed[0][0]} / {typed[0][1]}")
    return out


def main() -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    chosen = sys.argv[2:]
    spark, con = make_session(8), duck(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries), set(oracle) - set(queries)
    bad = 0
    for name, query in queries.items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in oracle:
                problems = differences(spark, con, folder, query, oracle[name])
                verdict = "ok" if not problems else "DIFF " + "; ".join(problems)
            else:
                problems = []
                verdict = f"rows only: {query(spark, folder).count()}"
        except Exception as error:
            problems = [str(error)]
            verdict = "ERROR " + str(error)[:900]
        bad += bool(problems)
        print(f"{time.time() - start:6.1f} {name}: {verdict}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
