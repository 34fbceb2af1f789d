"""Compare registered queries with their SQL on the same tables.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        return float(v) if float(v) != int(v) else int(v)
    except (TypeError, ValueError):
        return str(v)


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_norm(r[i]) for i in order) for r in data), key=lambda r: tuple((x is None, str(type(x)), x) for x in r)
    )


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    got_cols, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in res.description], res.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ, columns {got_cols}, e.g.\n   {bad[0][0]}\n   {bad[0][1]}"
    return True, f"{len(got)} rows"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from tickloom.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name in argv[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                ok, note = compare(df, con, oracles[name])
            else:
                ok, note = True, f"{len(df.collect())} rows, no oracle"
        except Exception as exc:  # report and go on
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:600]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.2f}s  {note}", flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
