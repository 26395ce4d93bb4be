"""License notices against a scan of every window."""

import math
import random
import re

import pytest

from tabulon.llm import licenses


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(w):
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def brute(rows):
    out = []
    for i, text in rows:
        w = words(text)
        s, found = shingles(w), {}
        for name, t in licenses.TEMPLATES.items():
            wanted = set(shingles(words(t)))
            m = len(wanted)
            step = licenses.step_of(m)
            for at in range(0, max(len(s), 1), step):
                held = len(wanted & set(s[at:at + m + step - 1]))
                if held >= licenses.CONTAINED * m:
                    found.setdefault(name, []).append((at, held))
        out.append((i, len(w), sorted(found),
                    sorted((n, a, h) for n, spans in found.items() for a, h in spans)))
    return out


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = [(r["doc_id"], r["n_words"], list(r["licenses"]),
            [tuple(s) for s in r["spans"]]) for r in licenses.notices(df).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    return got


def test_table(docs):
    found = check(docs)
    assert sum(bool(x[2]) for x in found) >= 3


def test_edges(edges, no_docs):
    check(edges)
    assert licenses.notices(no_docs).count() == 0


def test_whole_and_changed_notices(spark):
    rng = random.Random(3)
    rows = []
    for i, (name, t) in enumerate(licenses.TEMPLATES.items()):
        before = " ".join(f"b{rng.randrange(99)}" for _ in range(rng.randrange(40)))
        rows.append((i, f"{before} {t.upper()}; after it all"))
        w = t.split()
        w[len(w) // 2] = "CHANGED"
        rows.append((100 + i, f"{before} " + " ".join(w)))
        rows.append((200 + i, " ".join(t.split()[:len(t.split()) // 2])))
    found = {r[0]: r[2] for r in check(spark.createDataFrame(rows, "doc_id long, text string"))}
    for i, name in enumerate(licenses.TEMPLATES):
        assert name in found[i]
    # One changed word breaks five shingles of the long texts.
    assert "mit-text" in found[100 + list(licenses.TEMPLATES).index("mit-text")]


@pytest.mark.parametrize("m", [1, 2, 3, 4, 8, 20, 60, 300])
def test_bands_keep_the_promise(m):
    held = math.ceil(licenses.CONTAINED * m)
    similarity = held / (m + licenses.step_of(m) - 1 + m - held)
    assert (1 - similarity) ** licenses.bands_for(m) <= licenses.MISS * 1.0001


def test_long_text(spark, long_text):
    df = spark.createDataFrame(
        [(1, long_text + " released under the MIT License")], "doc_id long, text string")
    assert licenses.notices(df).first()["licenses"] == ["mit"]


def test_short_templates_are_refused(spark, edges):
    with pytest.raises(ValueError):
        licenses.notices(edges, {"x": "all rights reserved"})


def test_short_notices_are_found_as_phrases(spark, no_docs):
    rows = [(1, "Some text. All rights reserved. And all  RIGHTS-reserved"), (2, "all rights"),
            (3, "all rights were reserved"), (4, None), (5, "All rights reserved."), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: [tuple(s) for s in r["phrase_spans"]]
             for r in licenses.notices(df).collect()}
    name = "all-rights-reserved"
    assert found == {1: [(name, 2, 1), (name, 6, 1)], 2: [], 3: [], 4: [], 5: [(name, 0, 1)], 6: []}
    assert licenses.notices(no_docs).count() == 0
    with pytest.raises(ValueError):
        licenses.notices(df, phrases={"x": "..."})


def test_reserved_rights_of_the_table(spark, sf_dir):
    from tabulon.llm import queries

    found = {r["doc_id"]: r["licenses"].split(",") for r in
             queries.op8_license_scans(spark, sf_dir).collect()}
    for r in queries.read_table(spark, sf_dir, "documents").collect():
        reserved = " all rights reserved " in f" {' '.join(words(r['text']))} "
        assert ("all-rights-reserved" in found[r["doc_id"]]) == reserved
