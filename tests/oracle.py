"""Compare registered queries with their SQL on an independent engine: ``python tests/oracle.py [name-part ...]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("LAKEKIT_TESTDATA", "/root/testdata/sf0.01")


def connection(path: str = DATA):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in glob.glob(f"{path}/*.parquet"):
        name = os.path.basename(file)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    """Strict on type families; numbers keep 9 significant digits."""
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, int):
        return f"i:{value}"
    if isinstance(value, float):
        return f"f:{value + 0.0:.9g}"
    if isinstance(value, str):
        return f"s:{value}"
    if isinstance(value, decimal.Decimal | datetime.date | datetime.datetime | list | dict | tuple | bytes):
        raise TypeError(f"result value of type {type(value).__name__}: cast it to a plain type")
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark_columns, spark_rows, duck_columns, duck_rows) -> str | None:
    if sorted(spark_columns) != sorted(duck_columns):
        return f"columns {sorted(spark_columns)} != {sorted(duck_columns)}"
    a, b = rows_of(spark_columns, spark_rows), rows_of(duck_columns, duck_rows)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; first only here {sorted(set(a) - set(b))[:2]} only there {sorted(set(b) - set(a))[:2]}"
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. {sorted(set(a) - set(b))[:2]} vs {sorted(set(b) - set(a))[:2]}"
    if not a:
        return "no rows"
    return None


def main(parts: list[str]) -> int:
    import __spark_entry__ as entry
    from lakekit.session import build_session

    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connection()
    sqls = entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if parts and not any(name == p or name.startswith(p + "_") for p in parts):
            continue
        start = time.time()
        try:
            df = build(spark, DATA)
            rows = [tuple(r) for r in df.collect()]
            problem = None
            if name in sqls:
                cur = con.execute(sqls[name])
                problem = compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall())
            elif not rows:
                problem = "no rows"
            else:
                rows_of(df.columns, rows)
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={len(rows) if problem is None else '-'} "
              f"{'' if name in sqls else '(no sql) '}{time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
