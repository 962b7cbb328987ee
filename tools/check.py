"""Run registered queries beside their SQL in DuckDB and compare whole results.

usage: python tools/check.py [-s SF_DIR] [name ...]    (a name ending in * is a prefix)
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

#: The tables that tests run on.
SMALL_SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
FAMILY = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: "" if v is None else repr(list(v)) if hasattr(v, "__len__") and not isinstance(v, str) else repr(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, con, fn, sql, folder):
    df = fn(spark, folder)
    got, cols = canon([tuple(r) for r in df.collect()], df.columns)
    if sql is None:
        return "rows", f"{len(got)} rows {df.columns}"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    want, wcols = canon(rel.fetchall(), names)
    if cols != wcols:
        return "FAIL", f"columns {cols} != {wcols}"
    off = [(c, k, kinds[c]) for c, k in df.dtypes if FAMILY.get(k, k) != kinds[c] and k in FAMILY]
    if got != want:
        diff = sorted(set(got) ^ set(want))
        return "FAIL", f"{len(got)} vs {len(want)} rows, {len(diff)} differ {cols} {diff[:6]}"
    return ("types" if off else "ok"), f"{len(got)} rows {off or ''}"


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("-s", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from catalogue.registry import ORACLES, QUERIES

    pick = lambda q: not a.names or any(q == n or (n.endswith("*") and q.startswith(n[:-1])) for n in a.names)
    spark, con, bad = session(), duck(a.s), []
    for name, fn in QUERIES.items():
        if not pick(name):
            continue
        t0 = time.time()
        try:
            status, note = compare(spark, con, fn, ORACLES.get(name), a.s)
        except Exception as e:  # report and go on
            status, note = "ERROR", f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{status:6s} {time.time() - t0:6.1f}s {name}: {note}", flush=True)
        if status in ("FAIL", "ERROR"):
            bad.append(name)
    print("bad:", bad)


if __name__ == "__main__":
    main()
