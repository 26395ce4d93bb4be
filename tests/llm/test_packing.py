"""Length buckets against all choices of boundaries; batches within the budget."""

import itertools
import random
import re

from pyspark.sql import functions as F

from tabulon.llm import packing


def test_boundaries_are_the_best_of_all():
    rng = random.Random(4)
    for _ in range(300):
        n, k = rng.randint(1, 8), rng.randint(1, 5)
        lengths = sorted(rng.sample(range(1, 60), n))
        counts = [rng.choice([1, 1, 5, 100, 1000]) for _ in lengths]
        bounds = packing.best_boundaries(lengths, counts, k)
        assert len(bounds) <= k and bounds == sorted(set(bounds)) and bounds[-1] == lengths[-1]
        best = min(packing.padding(lengths, counts, sorted({*c, lengths[-1]}))
                   for c in itertools.combinations(lengths, min(k, n) - 1)) if k > 1 else \
            packing.padding(lengths, counts, [lengths[-1]])
        assert packing.padding(lengths, counts, bounds) == best
    assert packing.best_boundaries([], [], 3) == []


def test_many_lengths():
    lengths = list(range(1, 20_001))
    counts = [1 + 10 ** 9 // (x * x) for x in lengths]
    bounds = packing.best_boundaries(lengths, counts, 16)
    near = [min(x + 1, 20_000) for x in bounds[:-1]] + bounds[-1:]
    assert packing.padding(lengths, counts, bounds) <= packing.padding(lengths, counts, near)


def packed(df, **options):
    rows = packing.pack(df, **options).collect()
    sizes = {}
    for r in rows:
        assert r["n_tokens"] <= r["bucket_length"]
        sizes.setdefault((r["bucket"], r["batch"]), []).append(r["place"])
    for places in sizes.values():
        assert sorted(places) == list(range(len(places)))
    return rows, sizes


def test_batches(docs, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_ROWS", 7)
    rows, sizes = packed(docs, n_buckets=4, budget=4000)
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.collect())
    lengths = {r["bucket"]: r["bucket_length"] for r in rows}
    assert len(lengths) <= 4
    for b, length in lengths.items():
        each = max(1, 4000 // length)
        full = [len(p) for (x, _), p in sorted(sizes.items()) if x == b]
        assert all(n == each for n in full[:-1]) and 0 < full[-1] <= each
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        assert r["n_tokens"] == len(re.findall("[^\x20\x09-\x0D]+", text[r["doc_id"]])) + 1
    histogram = sorted((r["n_tokens"], r["count"]) for r in
                       packing.pack(docs).groupBy("n_tokens").count().collect())
    bounds = packing.best_boundaries(*zip(*histogram), 4)
    assert sorted(lengths.values()) == bounds


def test_edges(edges, no_docs, spark, long_text):
    rows, _ = packed(edges, n_buckets=3, budget=30)
    assert len(rows) == edges.count()
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)] == [1, 1, 1]
    assert {"score", "kept"} <= set(rows[0].asDict())
    assert packing.pack(no_docs).count() == 0
    big = spark.createDataFrame([(1, long_text), (2, "a")], "doc_id long, text string")
    rows, sizes = packed(big, n_buckets=1, budget=1000)
    assert [len(p) for p in sizes.values()] == [1, 1] and rows[0]["bucket_length"] == 500_001


def test_given_lengths(spark):
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"),
                                (F.col("id") % 5 + 1).alias("size"))
    rows, _ = packed(df, length=F.col("size"), n_buckets=5, budget=10)
    assert all(r["n_tokens"] == r["bucket_length"] == r["size"] for r in rows)
