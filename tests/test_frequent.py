"""The most frequent values against a plain count, however many there are."""

import datetime
from collections import Counter

import numpy as np
import pytest

from tabulon.operators import clean, frequent, profile


@pytest.fixture
def summarised(monkeypatch):
    """Every column goes through the summaries, which hold few values."""
    monkeypatch.setattr(frequent, "FEW_VALUES", 0)
    monkeypatch.setattr(frequent, "COUNTERS", 5)
    monkeypatch.setattr(frequent, "BUCKETS", 64)


def columns():
    rng = np.random.default_rng(4)
    n = 3000
    heavy = [f"h{k}" for k in rng.integers(0, 3, n)]
    made = {
        "unique": [f"u{i:05d}" for i in rng.permutation(n)],
        "heavy": [h if i % 3 else f"x{i}" for i, h in enumerate(heavy)],
        "flat": [f"f{i % 500:03d}" for i in range(n)],
        "one": ["same"] * n,
        "pairs": [f"p{i // 2:05d}" for i in rng.permutation(n)],
        "late": [None if i % 5 else ("zz" if i % 2 else f"a{i}") for i in range(n)],
        "none": [None] * n,
        "text": [["", "Ä", "z\x00", "漢", "A"][k] for k in rng.integers(0, 5, n)],
    }
    return made


def want(values, top):
    counts = Counter(v for v in values if v is not None)
    order = sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))
    return order[:top]


@pytest.mark.parametrize("top", [1, 4, 30])
def test_top_values(spark, summarised, top):
    made = columns()
    df = spark.createDataFrame(list(zip(*made.values())),
                               ", ".join(f"{c} string" for c in made)).repartition(5)
    got = {}
    for r in profile.value_counts(df, list(made), top).collect():
        got.setdefault(r["column"], []).append((r["value"], r["count"]))
    for c, values in made.items():
        found = sorted(got.get(c, []), key=lambda x: (-x[1], x[0].encode()))
        assert found == want(values, top), c


def test_modes_keep_their_type(spark, summarised):
    rows = [(i, i % 7, float(i % 4) if i % 9 else float("nan"), datetime.date(2020, 1, 1 + i % 3),
             None) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, x double, d date, n int").repartition(3)
    got = clean.column_modes(df, ["a", "b", "x", "d", "n"])
    assert got["a"] == 0 and got["b"] == 0 and got["d"] == datetime.date(2020, 1, 1)
    counts = Counter(r[2] for r in rows if r[2] == r[2])
    assert got["x"] == min(counts, key=lambda v: (-counts[v], v)) and got["n"] is None
    assert clean.column_modes(df.limit(0), ["a", "d"]) == {"a": None, "d": None}


def test_few_buckets_stay_open(spark, monkeypatch):
    """A column of unique values is not counted value by value where buckets tell enough, nor
    one of many values of which some stand out."""
    seen = []
    real = frequent.open_buckets
    monkeypatch.setattr(frequent, "FEW_VALUES", 0)
    monkeypatch.setattr(frequent, "open_buckets",
                        lambda counts, top: seen.append(real(counts, top)) or seen[-1])
    df = spark.range(5000).selectExpr(
        "id", "format_string('name-%06d', id) as name",
        "if(id % 4 = 0, format_string('v%d', id % 16), format_string('w%06d', id)) as some")
    top = profile.value_counts(df, ["name"], 3).collect()
    assert sorted(r["value"] for r in top) == ["name-000000", "name-000001", "name-000002"]
    assert seen[-1].count() < 5000 / 10          # buckets that two names fall into by chance
    top = profile.value_counts(df, ["some"], 4).collect()
    assert {r["value"]: r["count"] for r in top} == {f"v{k}": 313 if k in (0, 4) else 312
                                                     for k in (0, 4, 8, 12)}
    assert seen[-1].count() == 0


def test_summary_holds_what_is_heavy():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    held, exact = {}, Counter()
    for _ in range(40):
        values = [f"h{k}" for k in rng.integers(0, 4, 300)]
        values += [f"r{k}" for k in rng.integers(0, 10**6, 700)]
        exact.update(values)
        counted = pa.array(values).value_counts()
        held = frequent._merge(held, counted.field("values"),
                               counted.field("counts").to_numpy(), 20)
    n = sum(exact.values())
    assert len(held) <= 40
    assert all(held[f"h{k}"] <= exact[f"h{k}"] <= held[f"h{k}"] + n / 20 for k in range(4))
