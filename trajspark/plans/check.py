"""Compare registered queries with their SQL on the same parquet files: ``python -m trajspark.plans.check DIR [name …] [conf=value …]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

from trajspark.plans import load


def spark_session(cores: str = "8"):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def normal(value):
    """One spelling per value: integers, floats (no signed zero) and the rest as they are."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, sf_dir: str, fn, sql: str | None) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return True, f"{len(got)} rows, no SQL"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]).upper() for d in rel.description}
    want = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return False, f"{len(a)} rows != {len(b)}"
    same_kind = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT"}
    odd = [f"{n}:{k}/{kinds[n]}" for n, k in df.dtypes if k in same_kind and kinds[n] not in (same_kind[k], "NUMBER", "STRING", "BOOL")]
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    note = f" types {odd}" if odd else ""
    if bad:
        return False, f"{len(bad)} of {len(a)} rows differ, first {bad[0]}{note}"
    return not odd, f"{len(a)} rows{note}"


def main(argv) -> int:
    sf_dir, wanted = argv[0], [a for a in argv[1:] if "=" not in a]
    settings = dict(a.split("=", 1) for a in argv[1:] if "=" in a)
    queries, oracles = load()
    spark, con = spark_session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    for key, value in settings.items():
        spark.conf.set(key, value)
    failed = 0
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, fn, oracles.get(name))
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
