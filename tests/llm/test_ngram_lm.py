"""The bigram model against its formula over plain dictionaries."""

import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.llm import ngram_lm, queries, shared_files
from tabulon.llm.common import crc_mod

END, START = " ", "  "


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [END]


def brute(rows, train):
    """{row number: (n_tokens, n_known, N, base, score)}."""
    words, pairs = Counter(), Counter()
    for _, t in train:
        w = tokens(t)
        words.update(w)
        pairs.update(zip([START, *w], w))
    before, after = Counter(w for _, w in pairs), defaultdict(list)
    for (v, w), n in pairs.items():
        after[v].append(n)

    def discounts(values):
        n = [sum(x == k for x in values) for k in (1, 2, 3, 4)]
        return (0.0, *ngram_lm._discounts(n))

    d, e = discounts(pairs.values()), discounts(before.values())
    total, types = sum(words.values()), len(words)
    left = sum(e[min(k, 3)] for k in before.values()) / len(pairs) if pairs else 1.0

    def p(v, w):
        k = before[w]
        lower = (max(k - e[min(k, 3)], 0) / max(len(pairs), 1) + left / (types + 1))
        if v not in after:
            return lower
        n, c = sum(after[v]), pairs[v, w]
        return (max(c - d[min(c, 3)], 0) + sum(d[min(x, 3)] for x in after[v]) * lower) / n

    out = []
    for i, t in rows:
        w = tokens(t)
        out.append((i, len(w), sum(x in words for x in w), total,
                    sum(log10((words[x] + 0.1) / (total + 0.1 * (types + 1))) for x in w),
                    sum(log10(p(v, x)) for v, x in zip([START, *w], w))))
    return out


def check(df, held):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    train = [(r["doc_id"], r["text"]) for r in df.where(~held).collect()]
    got = [tuple(r) for r in ngram_lm.language_model(df, ~held).select(
        "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], round(r[4], 4))
    for a, b in zip(sorted(got, key=order), sorted(brute(rows, train), key=order)):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-6)
    assert len(got) == len(rows)


def test_table(docs):
    check(docs, crc_mod("doc_id", 10) == 0)


def test_edges(edges):
    check(edges.repartition(2), F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False)))


def test_nothing_to_learn_from(edges, no_docs):
    check(edges, F.lit(True))
    assert ngram_lm.language_model(no_docs, F.lit(True)).count() == 0


def test_many_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(ngram_lm, "BLOCK", 64)
    monkeypatch.setattr(ngram_lm, "GATHER", 500)
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 60) % 900)) for i in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5),
          F.col("doc_id") % 5 == 0)


def test_held_out_text_is_likelier_than_by_single_words(spark):
    rows = (queries.op6_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out")
            .agg(F.sum("score"), F.sum("base_score")).first())
    assert rows[0] > 0.9 * rows[1]


def test_probabilities_sum_to_one(docs):
    """After any word, the known words and one unknown share probability 1."""
    texts = docs.limit(20).select(F.col("text").cast("binary").alias("text"))
    model, learned = ngram_lm.fit_bigrams(texts)
    n = model.vocabulary.size
    words = model.vocabulary._maps()
    counts = np.concatenate([np.asarray(a) for a in words[1].arrays])
    for v in (0, n // 2, n - 1):
        ids = np.empty(2 * (n + 1), np.int64)
        ids[0::2], ids[1::2] = v, [*range(n), -1]
        own = np.where(ids >= 0, counts[np.maximum(ids, 0)], 0)
        p = 10 ** model.log10_probabilities(ids, own, [2] * (n + 1), learned)[1::2]
        assert p.sum() == pytest.approx(1, abs=1e-5)


def brute_triples(train):
    """Probability of w after (u, v) by the formula of order 3."""
    triples = Counter()
    for _, t in train:
        w = tokens(t)
        triples.update(zip([START, START, *w], [START, *w], w))
    pairs = Counter((v, w) for _, v, w in triples)
    before = Counter(w for _, w in pairs)

    def level(counts):
        n = [sum(x == k for x in counts.values()) for k in (1, 2, 3, 4)]
        after = defaultdict(list)
        for key, x in counts.items():
            after[key[:-1]].append(x)
        return (0.0, *ngram_lm._discounts(n)), after

    (d3, after3), (d2, after2) = level(triples), level(pairs)
    d1 = (0.0, *ngram_lm._discounts([sum(x == k for x in before.values()) for k in (1, 2, 3, 4)]))
    left = sum(d1[min(k, 3)] for k in before.values()) / len(pairs)

    def mix(c, d, seen, lower):
        return (c - d[min(c, 3)] + sum(d[min(x, 3)] for x in seen) * lower) / sum(seen) \
            if seen else lower

    def p(u, v, w):
        k = before[w]
        lower = (k - d1[min(k, 3)]) / len(pairs) + left / (len(before) + 1)
        lower = mix(pairs[v, w], d2, after2.get((v,)), lower)
        return mix(triples[u, v, w], d3, after3.get((u, v)), lower)
    return p


def test_order_three(spark, docs, edges, monkeypatch):
    monkeypatch.setattr(ngram_lm, "BLOCK", 64)
    monkeypatch.setattr(ngram_lm, "GATHER", 500)
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.6, 80) % 50)) for i in range(60)]
    small = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for df in (small, edges.select("doc_id", "text").repartition(2), docs.limit(40)):
        held = F.coalesce(F.col("doc_id") % 5 == 0, F.lit(False))
        p = brute_triples([tuple(r) for r in df.where(~held).select("doc_id", "text").collect()])
        got = ngram_lm.language_model(df, ~held, order=3).collect()
        assert got
        for r in got:
            w = tokens(r["text"])
            want = sum(log10(p(*x)) for x in zip([START, START, *w], [START, *w], w))
            assert r["score"] == pytest.approx(want, rel=1e-6)


def test_large_counts_at_order_three(spark):
    """Triples seen 255 times and more, and a pair with more followers than are added up."""
    rows = ["a b c"] * 300 + ["a b d"] * 254 + ["a b e"] * 255
    rows += [f"x{i} p q{i % 40}" for i in range(300)] + ["a b"] * 2 + [f"r s t{i}" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    p = brute_triples(enumerate(rows))
    for r in ngram_lm.language_model(df, F.lit(True), order=3).collect():
        w = tokens(r["text"])
        want = sum(log10(p(*x)) for x in zip([START, START, *w], [START, *w], w))
        assert r["score"] == pytest.approx(want, rel=1e-6)


def test_packed_and_clipped_values(tmp_path):
    a = np.array([0, 1, 255, 256, 70_000, (1 << 40) + 3], "<u8")
    assert (ngram_lm.unpacked(ngram_lm.packed(a), "<u8") == a).all()
    url = f"file://{tmp_path}/n"
    ngram_lm.write_clipped(url, a.astype(np.int64))
    places, files = np.array([5, 1, 2, 3, 4, 2]), np.zeros(6, np.int64)
    assert (ngram_lm.Clipped([url]).take(places, files) == a[places]).all()
    assert ngram_lm.Clipped([None]).take(places, files).sum() == 0


def test_query_uses_two_words_of_context(spark, sf_dir, monkeypatch):
    orders, fit = [], ngram_lm.fit_bigrams
    monkeypatch.setattr(ngram_lm, "fit_bigrams",
                        lambda t, order=2: orders.append(order) or fit(t, order))
    assert queries.op6_lm_scoring(spark, sf_dir).count() and orders == [3]


def test_files_are_whole_and_mapped(tmp_path):
    url = f"file://{tmp_path}/a/b"
    shared_files.write_file(url, [b"12345678", b"abcdefgh"])
    assert shared_files.read_file(url) == b"12345678abcdefgh"
    assert shared_files.mapped(url, "<u8").tobytes() == b"12345678abcdefgh"
    shared_files.write_file(url, b"")
    assert len(shared_files.mapped(url, "<u8")) == 0
    assert zlib.crc32(shared_files.read_file(url)) == 0
