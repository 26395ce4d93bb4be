"""Near copies against all pairs by brute force."""

import random

import numpy as np
import pytest

from tabulon.llm import components, jaccard_join
from tabulon.llm.common import mixed


def brute(rows, size=5):
    """{row number: (set size, component id)} by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)}
                    or ({tuple(w)} if w else set()))
    group = list(range(len(rows)))

    def find(a):
        while group[a] != a:
            a = group[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                group[find(a)] = find(b)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    lowest = {g: min((x for x in ids if x is not None), default=None)
              for g, ids in members.items()}
    return [(rows[i][0], len(sets[i]), lowest[find(i)] if sets[i] else rows[i][0])
            for i in range(len(rows))]


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r)[:3] for r in jaccard_join.near_copies(df).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_table(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check(spark, rows)


def test_edges(edges):
    rows = [tuple(r) for r in edges.select("doc_id", "text").collect()]
    got = [tuple(r)[:3] for r in jaccard_join.near_copies(edges).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_chains_at_the_threshold(spark):
    """Groups held together by chains, some links just above and some just below 0.75."""
    rng = random.Random(5)
    rows, n = [], 0
    for _ in range(12):
        words = [f"v{rng.randrange(10 ** 6)}" for _ in range(60)]
        for _ in range(10):
            rows.append((n, " ".join(words)))
            n += 1
            for at in rng.sample(range(60), rng.choice([1, 1, 2, 3])):
                words[at] = f"v{rng.randrange(10 ** 6)}"
    common = " ".join(f"c{i}" for i in range(40))
    rows += [(n + i, f"{common} " + " ".join(f"u{i}x{k}" for k in range(i % 20)))
             for i in range(60)]
    check(spark, rows)


def test_every_link_of_a_group_counts(spark, docs, edges):
    """All pairs, those inside a group that other links already join included."""
    rng = random.Random(8)
    rows, n = [], 0
    for k in range(6):
        words = [f"g{k}x{i}" for i in range(200)]
        for _ in range(3 + 3 * k):                     # different texts, all above 0.75
            other = list(words)
            other[rng.randrange(200)] = f"y{n}"
            rows += [(n, " ".join(other))] * rng.choice([1, 1, 2])
            n += 1
    for given in (rows, [tuple(r) for r in docs.select("doc_id", "text").collect()],
                  [tuple(r) for r in edges.select("doc_id", "text").collect()]):
        sets = [set(jaccard_join.text_set((t or "").encode(), 5).tolist()) for _, t in given]
        want = [(given[i][0], sum(
            1 for k, y in enumerate(sets)
            if k != i and x and y and 100 * len(x & y) >= 75 * len(x | y)))
            for i, x in enumerate(sets)]
        df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
        got = [(r["doc_id"], r["n_links"]) for r in jaccard_join.near_copies(df).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)


def test_links_of_a_large_group_are_counted_not_listed(spark, monkeypatch):
    """One group with links just above and below 0.75, another around a core of two."""
    monkeypatch.setattr(jaccard_join, "LARGE", 8)
    rng = random.Random(4)
    rows, n = [], 0
    for k, (texts, most) in enumerate([(70, 4), (30, 1)]):
        words = [f"g{k}x{i}" for i in range(150)]
        for _ in range(texts):
            other = list(words)
            for at in rng.sample(range(150), rng.randint(0, most)):
                other[at] = f"y{rng.randrange(40)}"
            rows += [(n, " ".join(other))] * rng.choice([1, 1, 2])
            n += 1
    sets = [set(jaccard_join.text_set(t.encode(), 5).tolist()) for _, t in rows]
    near = [[i != k and 100 * len(x & y) >= 75 * len(x | y) for k, y in enumerate(sets)]
            for i, x in enumerate(sets)]
    assert not all(sum(x) in (0, len(rows) - 1) for x in near)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r["doc_id"], r["n_links"]) for r in jaccard_join.near_copies(df).collect()]
    assert sorted(got) == sorted((rows[i][0], sum(x)) for i, x in enumerate(near))
    links = jaccard_join.classes_and_links(df)[1].count()
    texts = {}
    for i, (_, text) in enumerate(rows):
        texts.setdefault(text, i)
    linked = sum(near[i][k] for i in texts.values() for k in texts.values()) // 2
    assert 3 * links < linked
    check(spark, rows)


def test_pairs_of_a_large_group_are_not_verified_one_by_one(spark, monkeypatch):
    """Also those that link by differences in common, or do not link, are told by a consensus."""
    monkeypatch.setattr(jaccard_join, "LARGE", 8)
    verified, verify = [], jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *more: (
        verified.append(pairs.count()), verify(pairs, *more))[1])
    rng = random.Random(12)
    words = [f"g{i}" for i in range(150)]
    rows = []
    for n in range(120):
        other = list(words)
        for at in rng.sample(range(0, 150, 3), rng.randint(0, 6)):
            other[at] = f"y{at}x{rng.randrange(3)}"
        rows.append((n, " ".join(other)))
    sets = [set(jaccard_join.text_set(t.encode(), 5).tolist()) for _, t in rows]
    near = [[i != k and 100 * len(x & y) >= 75 * len(x | y) for k, y in enumerate(sets)]
            for i, x in enumerate(sets)]
    assert sum(map(sum, near)) < 0.9 * 120 * 119
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r["doc_id"], r["n_links"]) for r in jaccard_join.near_copies(df).collect()]
    assert sorted(got) == [(i, sum(x)) for i, x in enumerate(near)]
    assert sum(verified) < 3 * 120, verified


def test_hot_tokens_take_the_other_path(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT", 3)
    base = [f"b{i}" for i in range(50)]
    rows = [(i, " ".join(base[:25 + i % 25] + [f"z{i}"])) for i in range(80)]
    check(spark, rows)


def test_empty_table_and_no_links(spark, no_docs):
    assert jaccard_join.near_copies(no_docs).count() == 0
    check(spark, [(1, "a b c d e f"), (2, "g h i j k l")])


def test_one_of_each_keeps_columns_and_rows(edges):
    kept = jaccard_join.one_of_each(edges)
    assert kept.columns == edges.columns
    rows = kept.select("doc_id", "text").collect()
    assert sorted((r["doc_id"] for r in rows if r["doc_id"] is not None)) == [
        1, 2, 3, 4, 5, 6, 9, 10]
    assert [r["text"][:8] for r in rows if r["doc_id"] is None] == ["null ids"]


def test_components_of_a_long_path_and_a_star(spark):
    path = spark.range(300).selectExpr("id as a", "id + 1 as b")
    star = spark.range(1001, 1500).selectExpr("id as a", "1000L as b")
    found = components.components(path.unionByName(star))
    rows = {r["node"]: r["component"] for r in found.collect()}
    assert all(rows[i] == 0 for i in range(301))
    assert all(rows[i] == 1000 for i in range(1000, 1500))


def test_long_text(long_text):
    s = jaccard_join.text_set(long_text.encode(), 5)
    assert len(s) == 7919 and (np.diff(s.astype(object)) > 0).all()


@pytest.mark.parametrize("values", [[0, 1, 2 ** 63, 2 ** 64 - 1]])
def test_mixing_is_one_to_one(values):
    from tabulon.llm.ngram_lm import unmixed

    h = np.array(values, np.uint64)
    assert (unmixed(mixed(h)) == h).all()
