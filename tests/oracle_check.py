"""Run registered queries beside their SQL and compare values.

    python -m tests.oracle_check [--sf DIR] [name prefix ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if v != v else f"{v + 0.0:.6g}"
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short account of the difference."""
    got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want = canonical([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} vs {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} of {len(got[1])} rows differ, first {str(bad[0])[:400]}" if bad else None


def main(argv: list[str]) -> int:
    from cuelake.session import build_session
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = duck(sf), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        t0 = time.time()
        try:
            if name in sqls:
                problem = compare(fn(spark, sf), con, sqls[name])
                note = problem or "ok"
            else:
                problem, note = None, f"rows only: {len(fn(spark, sf).collect())}"
        except Exception as e:  # report and go on with the next query
            problem = note = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'pass'} {name} {time.time() - t0:.1f}s {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
