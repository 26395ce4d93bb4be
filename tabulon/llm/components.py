"""Connected components of a table of links, by contraction and alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.session import stored

#: Links that one task contracts, about.
TASK_LINKS = 250_000


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) for the links given, without the smallest ones."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    low = np.arange(len(nodes))
    while True:
        new = low.copy()
        np.minimum.at(new, x, low[y])
        np.minimum.at(new, y, low[x])
        np.minimum.at(new, low, new)            # the node that stood for this one follows
        while (new[new] != new).any():
            new = new[new]
        if (new == low).all():
            break
        low = new
    far = low != np.arange(len(nodes))
    return nodes[far], nodes[low[far]]


def _contract(iterator) -> Iterator[pa.RecordBatch]:
    """One partition's links as stars, contracted whenever as much again has come in."""
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for batch in iterator:
        waiting.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        n += batch.num_rows
        if n > max(len(a), TASK_LINKS):
            a, b = _stars(np.concatenate([a, *(x for x, _ in waiting)]),
                          np.concatenate([b, *(y for _, y in waiting)]))
            waiting, n = [], 0
    if waiting:
        a, b = _stars(np.concatenate([a, *(x for x, _ in waiting)]),
                      np.concatenate([b, *(y for _, y in waiting)]))
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38,0)))"))
                 .first())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is its smallest node.

    Links are dealt to as many tasks as hold ``TASK_LINKS`` each, and every task turns its part
    into stars around smallest nodes, at most one link per node. Stars of several tasks are
    joined by alternating rounds: each links every node's larger neighbours, then its smaller
    ones, to the smallest node it knows, until one star per component is left, after about the
    logarithm of the number of nodes. Only row counts and a hash of the table reach the driver.
    Rows with a null and links from a node to itself are ignored.
    """
    given = stored(links.select(F.greatest("a", "b").cast("long").alias("a"),
                                F.least("a", "b").cast("long").alias("b"))
                   .where("a > b"), "links")
    tasks = max(1, -(-given.count() // TASK_LINKS))
    edges = stored(given.repartition(tasks).mapInArrow(_contract, "a long, b long"), "stars")
    before = _state(edges) if tasks > 1 else None
    for _ in range(max_rounds):
        if tasks == 1:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .selectExpr("case when b = m then a else b end as a", "m as b")
                 .where("a > b").distinct())
        edges = stored(small, "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
                         .distinct()))
