"""Run registered queries next to their SQL: ``python -m checks.compare [sf] [name...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from checks import QUERIES, SQL
from tabulon.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, bool):
        return str(v)
    return v


def _order(row):
    return tuple((x is not None, type(x).__name__ if isinstance(x, str) else "", x)
                 for x in row)


def _kind(name: str) -> str:
    name = name.lower()
    for kind, words in {"int": ("int", "long", "hugeint"), "float": ("double", "float", "decimal"),
                        "text": ("string", "varchar"), "bool": ("bool",)}.items():
        if any(w in name for w in words):
            return kind
    return name


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, float]:
    """("ok" or what differs, seconds)."""
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = [tuple(_plain(r[c]) for c in columns) for r in df.collect()]
    took = time.time() - start
    if name not in SQL:
        return (f"rows only ({len(rows)})" if rows else "EMPTY"), took
    found = con.execute(SQL[name])
    their = [d[0] for d in found.description]
    if sorted(their) != columns:
        return f"columns {columns} / {sorted(their)}", took
    kinds = {d[0]: _kind(str(d[1])) for d in found.description}
    mine = {f.name: _kind(f.dataType.simpleString()) for f in df.schema.fields}
    types = {c: (mine[c], kinds[c]) for c in columns if mine[c] != kinds[c]}
    at = [their.index(c) for c in columns]
    other = [tuple(_plain(r[i]) for i in at) for r in found.fetchall()]
    if len(rows) != len(other):
        return f"rows {len(rows)} / {len(other)}", took
    a, b = sorted(rows, key=_order), sorted(other, key=_order)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(rows)} rows differ, {columns}: {bad[:2]}", took
    return (f"types {types}" if types else f"ok ({len(rows)})"), took


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    if not os.path.isdir(sf_dir):
        sf_dir = f"/root/testdata/{sf_dir}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    failed = 0
    for name in argv[1:] or QUERIES:
        try:
            result, took = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001 - a report over all queries
            result, took = f"ERROR {type(e).__name__}: {str(e)[:600]}", 0.0
        good = result.startswith(("ok", "rows only"))
        failed += not good
        print(f"{'    ' if good else 'BAD '}{name:28s} {took:6.2f}s  {result}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
