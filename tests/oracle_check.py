"""Compare registered queries with their SQL twins on one scale's tables.

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(x):
    if hasattr(x, "item"):
        x = x.item()
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, float):
        return 0.0 if x == 0 else round(x, 9)
    return x


def rows_of(pdf) -> tuple[list[str], list[tuple]]:
    columns = sorted(pdf.columns)
    rows = [tuple(_plain(x) for x in r) for r in pdf[columns].itertuples(index=False, name=None)]
    return columns, sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def _kind(dtype) -> str:
    return {"i": "int", "u": "int", "f": "float", "b": "bool"}.get(dtype.kind, "other")


def difference(got, want) -> str:
    """'' when equal, else what differs."""
    (c1, r1), (c2, r2) = rows_of(got), rows_of(want)
    if c1 != c2:
        return f"columns {c1} != {c2}"
    if len(r1) != len(r2):
        return f"{len(r1)} rows != {len(r2)}"
    kinds = [
        f"{c}: {got[c].dtype} != {want[c].dtype}"
        for c in c1
        if len(r1) and _kind(got[c].dtype) != _kind(want[c].dtype)
    ]
    if kinds:
        return f"types {kinds}"
    bad = [(a, b) for a, b in zip(r1, r2) if a != b]
    return f"{len(bad)} of {len(r1)} rows differ, first {str(bad[0])[:400]}" if bad else ""


def main() -> int:
    from pyspark.sql import SparkSession

    from corpusloom.plans.oracles import SQL
    from corpusloom.plans.registry import QUERIES

    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failures = connect(folder), 0
    for name in names:
        started = time.time()
        try:
            got = QUERIES[name](spark, folder).toPandas()
            middle = time.time()
            if name in SQL:
                said = difference(got, con.execute(SQL[name]).fetchdf()) or "ok"
            else:
                said = "no sql"
        except Exception as e:  # noqa: BLE001
            got, middle, said = [], time.time(), f"{type(e).__name__}: {str(e)[:500]}"
        failures += said not in ("ok", "no sql")
        print(
            f"{name:26s} {len(got):7d} rows  spark {middle - started:6.2f}s"
            f"  sql {time.time() - middle:6.2f}s  {said}",
            flush=True,
        )
    print(f"{failures} of {len(names)} differ")
    return failures


if __name__ == "__main__":
    raise SystemExit(min(main(), 1))
