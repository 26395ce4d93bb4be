"""Windows of benchmark items against a scan of every document."""

import hashlib
import re

from tabulon.llm import decontaminate
from tabulon.sources.tables import read_table

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, items, window=10):
    wanted = {}
    for item, text in items:
        w = WORDS.findall(lowered(text))
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if w else ():
            wanted.setdefault(tuple(w[k:k + n]), set()).add(item)
    out = []
    for i, text in docs:
        w, hit, found = WORDS.findall(lowered(text)), set(), set()
        for n in {len(x) for x in wanted}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wanted:
                    hit.update(range(k, k + n))
                    found |= wanted[tuple(w[k:k + n])]
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        n_items = len([x for x in found if x is not None])
        out.append((i, len(w), len(hit), n_items, hashlib.sha256(ids.encode()).hexdigest(),
                    bool(hit)))
    return out


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def check(df, items):
    got = [tuple(r) for r in decontaminate.contamination(df, items).select(*COLUMNS).collect()]
    want = brute([(r["doc_id"], r["text"]) for r in df.collect()],
                 [(r["item_id"], r["text"]) for r in items.collect()])
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_table(spark, sf_dir, docs):
    check(docs, read_table(spark, sf_dir, "benchmark"))


def test_edges(spark, edges):
    items = spark.createDataFrame(
        [(1, "one"), (2, None), (3, ""), (4, "!!"), (5, "d E f"), (6, "three"), (7, "three"),
         (8, "k l m n o p q r s t u v"), (None, "one two"), (9, "two three"),
         (10, "wörds ÀÉÎ straße"), (11, "line one is here line")],
        "item_id long, text string")
    check(edges, items)


def test_overlaps_and_copies_of_items(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame(
        [(1, text), (2, text + " x " + text), (3, " ".join(f"w{i}" for i in range(9))),
         (4, " ".join(f"w{i}" for i in range(5, 15))), (5, "w1 w2 " * 20)],
        "doc_id long, text string")
    items = spark.createDataFrame([(i, text) for i in range(20)] + [(30, "w1 w2 " * 8)],
                                  "item_id long, text string")
    check(df, items)


def test_empty_tables(spark, sf_dir, docs, no_docs):
    items = read_table(spark, sf_dir, "benchmark")
    assert decontaminate.contamination(no_docs, items).count() == 0
    none = decontaminate.contamination(docs, items.where("false"))
    assert none.where("contaminated or n_hit > 0").count() == 0 and none.count() == docs.count()


def test_clean_documents_keep_their_columns(spark, edges):
    items = spark.createDataFrame([(1, "three")], "item_id long, text string")
    kept = decontaminate.clean_documents(edges, items)
    assert kept.columns == edges.columns
    assert kept.count() == edges.count() - edges.where("text like '%three%'").count()


def test_long_text(spark, long_text):
    df = spark.createDataFrame([(1, long_text)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(7910, 7919)) + " w0")],
                                  "item_id long, text string")
    row = decontaminate.contamination(df, items).first()
    assert (row["n_words"], row["n_hit"]) == (500_000, 10 * (500_000 // 7919))
