"""Spark-vs-DuckDB comparison used by the oracle tests.

Usage as a script:  python -m tests.harness [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "float": "FLOAT",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# decimal digits doubles are rounded to before comparing (None: exact)
FLOAT_DIGITS: int | None = 6


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if FLOAT_DIGITS is None else round(v, FLOAT_DIGITS)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_types = dict(spark_df.dtypes)
    s_recs = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    d_recs = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
        return False, "; ".join(problems)
    for c in s_cols:
        st = SPARK_TO_DUCK.get(s_types[c], s_types[c])
        if st != d_types.get(c):
            problems.append(f"type {c}: spark={s_types[c]} duck={d_types.get(c)}")
    if len(s_recs) != len(d_recs):
        problems.append(f"rows spark={len(s_recs)} duck={len(d_recs)}")
    else:
        a, b = _rows(s_cols, s_recs), _rows(d_cols, d_recs)
        if a != b:
            diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diffs}")
    return not problems, "; ".join(problems)


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries

    from clinsignal.session import local_session

    global FLOAT_DIGITS
    if argv and argv[0] == "--exact":
        FLOAT_DIGITS, argv = None, argv[1:]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    spark = local_session()
    con = duck(sf_dir)
    qs, os_ = queries(), oracle_sql()
    failed = 0
    for k in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            if k in os_:
                ok, msg = compare(df, con, os_[k])
            else:
                n = df.count()
                ok, msg = True, f"rows-only: {n} rows"
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(exc).__name__}: {str(exc)[:400]}"
        failed += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {k:28s} {time.time() - t0:6.1f}s {msg}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
