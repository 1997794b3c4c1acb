"""Run queries() against oracle_sql() the way the correctness gate does:
row count, column names, and an order-insensitive comparison of values."""
from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


SPARK_TO_DUCK = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
                 "int": "INTEGER"}


def compare(spark, name, query, sql, sf_dir, con) -> tuple[bool, str]:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} oracle={d_cols}"
    if s_types != d_types:
        return False, f"types differ: spark={s_types} oracle={d_types}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(s_rows)} rows, spark {t1 - t0:.2f}s"


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from pathfold.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"{name:28s} (no oracle)")
            continue
        try:
            ok, msg = compare(spark, name, q, sqls[name], sf_dir, con)
        except Exception as e:  # report and go on
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
