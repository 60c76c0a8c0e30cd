"""Run registered queries on Spark and their SQL on DuckDB and compare rows."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from genoloom.plans.views import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, Decimal):
        v = float(v) if v != int(v) else int(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, int):
        return f"{float(v):.9g}" if abs(v) < 2**53 else str(v)
    return "NULL" if v is None else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """(row count, problem or None)."""
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return len(got), f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(df.columns, got), _rows(names, want)
    if a != b:
        only_a = [x for x in a if x not in set(b)][:3]
        only_b = [x for x in b if x not in set(a)][:3]
        return len(got), f"rows {len(a)} vs {len(b)}; spark only {only_a}; oracle only {only_b}"
    return len(got), None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = argv[0]
    wanted = argv[1:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    oracle = entry.oracle_sql()
    for key, fn in entry.queries().items():
        if wanted and not any(key == w or (w.endswith("*") and key.startswith(w[:-1])) for w in wanted):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if key in oracle:
                n, problem = compare(df, con, oracle[key])
            else:
                n, problem = df.count(), None
        except Exception as exc:  # noqa: BLE001
            n, problem = -1, f"{type(exc).__name__}: {str(exc)[:600]}"
        mark = "ok " if problem is None else "BAD"
        bad += problem is not None
        if problem or n == 0 or time.time() - t0 > 4 or wanted:
            print(f"{mark} {key:24s} {n:8d} rows {time.time() - t0:6.2f}s{'' if key in oracle else ' (no sql)'} {problem or ''}", flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
