"""Run registered queries beside their checking SQL: ``python -m tests.oracle [-s sf] [names...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float) and math.isnan(value):
        return (1, "")
    return (2, f"{value!r}")


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: [_key(v) for v in r])


_KINDS = {bool: "bool", int: "int", float: "float", str: "str", datetime.date: "date"}


def kinds(rows, width):
    found = [set() for _ in range(width)]
    for r in rows:
        for i, v in enumerate(r):
            if v is not None:
                found[i].add(_KINDS.get(type(v), type(v).__name__))
    return found


def compare(spark_df, con, sql) -> str | None:
    """None when equal, else the difference."""
    cur = con.execute(sql)
    duck_cols = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    d_cols, d_rows = _normal(duck_cols, cur.fetchall())
    s_cols, s_rows = _normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if d_cols != s_cols:
        return f"columns differ: spark {s_cols} duck {d_cols}"
    pair = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}
    for c, t in spark_df.dtypes:
        if pair.get(types[c]) != t:
            return f"type of {c}: spark {t} duck {types[c]}"
    if len(d_rows) != len(s_rows):
        return f"rows differ: spark {len(s_rows)} duck {len(d_rows)}"
    bad = [(s, d) for s, d in zip(s_rows, d_rows) if s != d]
    if bad:
        return f"{len(bad)} of {len(s_rows)} rows differ; first spark {bad[0][0]} duck {bad[0][1]} columns {s_cols}"
    if not s_rows:
        return "both sides are empty"
    return None


def main():
    from tarmac.catalog import ORACLES, QUERIES
    from tarmac.plans.storage import drop_stages
    from tarmac.session import build_session

    args = sys.argv[1:]
    sf, parts = "0.01", "8"
    if args[:1] == ["-p"]:
        parts, args = args[1], args[2:]
    if args[:1] == ["-s"]:
        sf, args = args[1], args[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": parts, "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    failed = []
    for name in args or list(QUERIES):
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                note = compare(df, con, ORACLES[name])
            else:
                rows = df.collect()
                note = None if rows else "no rows"
                print("   ", str(rows[:2])[:300])
        except Exception as e:  # noqa: BLE001
            note = f"{type(e).__name__}: {str(e)[:1500]}"
        drop_stages(spark)
        print(f"{'ok  ' if note is None else 'FAIL'} {name} {time.time() - start:.1f}s {note or ''}", flush=True)
        if note:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
