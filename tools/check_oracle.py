"""Run registered queries in Spark and their oracle SQL in DuckDB, compare results.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
Comparison: column names sorted, row count, order-insensitive multiset of rows
(floats rounded to 6 significant digits; an exact pass is reported too).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from revlens.plans.catalog import oracle_sql, queries  # noqa: E402
from revlens.session import get_spark  # noqa: E402
from revlens.sources.tables import TABLES  # noqa: E402


def norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0:
            return 0.0
        return float(f"{v:.{digits}g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist(), digits)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
                 "smallint": "SMALLINT", "tinyint": "TINYINT", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "array<string>": "VARCHAR[]"}


def type_diff(sdtypes, con, sql):
    dtypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for c, t in sdtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        if dtypes.get(c) != want:
            out.append(f"{c}: spark {t} vs duckdb {dtypes.get(c)}")
    return out


def rows_of(cols, rows, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns {sorted(scols)} vs {sorted(dcols)}")
            bad += 1
            continue
        if len(srows) != len(drows):
            print(f"FAIL {name}: rows {len(srows)} vs {len(drows)}")
            bad += 1
            continue
        exact = rows_of(scols, srows, 15) == rows_of(dcols, drows, 15)
        loose = rows_of(scols, srows, 6) == rows_of(dcols, drows, 6)
        tdiff = type_diff(df.dtypes, con, sqls[name])
        if loose:
            print(f"OK   {name}: {len(srows)} rows{'' if exact else ' (float-rounded)'} {ts:.1f}s"
                  + (f" TYPES {tdiff}" if tdiff else ""))
        else:
            a, b = rows_of(scols, srows, 6), rows_of(dcols, drows, 6)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"FAIL {name}: values differ, e.g. {diff}")
            bad += 1
    print(f"done, {bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
