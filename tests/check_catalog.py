"""Compare catalogue queries with their SQL in DuckDB: python tests/check_catalog.py [sf_dir] [names...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from driftline.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canon(v):
    if isinstance(v, bool) or v is None:
        return (str(type(v)), str(v))
    if isinstance(v, (int, float)):
        return ("num", "nan" if isinstance(v, float) and math.isnan(v) else repr(float(v) + 0.0))
    return ("str", str(v))


def compare(spark, con, name: str, sf: str) -> str:
    df = E.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(canon(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    sql = E.oracle_sql().get(name)
    if sql is None:
        return f"rows {len(got)}" if got else "EMPTY"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"COLUMNS {cols} vs {sorted(names)}"
    pos = [names.index(c) for c in cols]
    want = sorted(tuple(canon(r[i]) for i in pos) for r in cur.fetchall())
    if got == want:
        return f"ok {len(got)}" if got else "EMPTY"
    diff = [(a, b) for a, b in zip(got, want) if a != b][:2]
    return f"DIFF {len(got)} vs {len(want)}: {cols} {diff}"


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session("check", spark__ui__showConsoleProgress="false")
    con = connect(sf)
    con.execute("SET TimeZone='UTC'")
    bad = 0
    for name in args[1:] or E.queries():
        started = time.perf_counter()
        try:
            out = compare(spark, con, name, sf)
        except Exception as exc:  # noqa: BLE001
            out = "ERROR " + str(exc)[:1500]
        bad += out.split()[0] not in ("ok", "rows")
        print(f"{name:26s} {time.perf_counter() - started:6.1f}s {out}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
