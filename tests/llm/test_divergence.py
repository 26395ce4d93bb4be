"""Divergence of sources against a plain count of everything."""

import re

import numpy as np
import pytest

from tabulon.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, min_docs=30, top=50):
    """rows: (text, lang, source), nulls allowed."""
    docs, counts, groups = {}, {}, {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.setdefault(lang, set()).add(source)
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        for t in set(terms):
            docs[lang, t] = docs.get((lang, t), 0) + 1
        for t in terms:
            counts[lang, source, t] = counts.get((lang, source, t), 0) + 1
    out = []
    for lang, sources in groups.items():
        kept = [t for (one, t), n in docs.items() if one == lang and n >= min_docs]
        v = len(kept)
        share = {}
        of = {s: [counts.get((lang, s, t), 0) for t in kept] for s in sources}
        whole = [sum(c) for c in zip(*of.values())] if kept else []
        for s, c in [*of.items(), (None, whole)]:
            share[s] = [1 + 10**9 * (x + 5) // (sum(c) + 5 * v) for x in c]
        for s in sources:
            pair = [(-sum(abs(p - q) for p, q in zip(share[s], share[o])), o.encode())
                    for o in sources if o != s]
            term = [(q - p, t.encode()) for t, p, q, n in
                    zip(kept, share[s], share[None], of[s]) if n and p > q]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, i.decode(), -x, k + 1)
                        for k, (x, i) in enumerate(found)]
    return sorted(out)


def run(df, *args):
    return sorted(tuple(r) for r in divergence.source_divergence(df, *args).collect())


def test_table(docs):
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    got = run(docs, 5)
    assert got == brute(rows, 5)
    assert {r[2] for r in got} == {"pair", "term"}


ROWS = [
    ("a b c", "en", "x"), ("a b", "en", "y"), ("A, b! b", "en", "z"), (None, "en", "w"),
    ("", "en", None), ("ü漢字 ÀB a1b_c", "de", "x"), ("ü漢字 àb", "de", "y"), (None, None, None),
    ("tie1 tie tie", None, "x"), ("a b c", "en", "x"), ("\x00A\x7fB", "en", "y"), ("q", "solo", "s"),
]


@pytest.mark.parametrize("min_docs", [1, 2, 3, 99])
def test_edges(spark, min_docs):
    df = spark.createDataFrame(ROWS, "text string, lang string, source string")
    df = df.selectExpr("*", "'x' as term", "'x' as docs", "1 as value", "'y' as part")
    assert run(df.repartition(3), min_docs) == brute(ROWS, min_docs)
    assert run(df.where("false"), min_docs) == []


def test_spills_and_blocks(spark, monkeypatch):
    """Maps that spill at every few terms, and several blocks of sources a language."""
    monkeypatch.setattr(divergence, "STRIPES", 3)
    monkeypatch.setattr(divergence, "SOURCES", 2)
    rng = np.random.default_rng(3)
    rows = [(" ".join(f"t{chr(97 + k)}" for k in rng.integers(0, 20, rng.integers(0, 30))),
             f"l{rng.integers(2)}", f"s{rng.integers(7)}") for _ in range(200)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert run(df, 10, 3) == brute(rows, 10, 3)


def test_a_hot_term_and_a_long_text(spark, long_text):
    rows = [("the " * 500 + f"u{k % 3}x", "en", "big" if k % 3 else f"s{k % 5}")
            for k in range(120)]
    rows.append((long_text, "en", "long"))
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    assert run(df) == brute(rows)


def test_shares_are_exact_beyond_64_bits():
    counts, totals = [[3_000_000_000_000, 7]], [9_000_000_000_001, 20]
    got = divergence.shares(counts, totals, 11)
    assert got.tolist() == [[1 + 10**9 * (c + 5) // (n + 55) for c, n in zip(counts[0], totals)]]
