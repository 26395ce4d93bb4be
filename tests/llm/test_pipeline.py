"""The pipeline's stages, each on what the one before kept."""

import importlib.util
import os
import sys

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import compare, connect
from tabulon.llm import line_crf, queries
from test_decontaminate import brute as windows
from test_jaccard_join import brute as groups
from test_quality import counted


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """[(name, rows as dictionaries)], from documents to the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [("documents", [r.asDict() for r in docs.collect()])]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, [r.asDict() for r in docs.collect()]))
    return out


def test_each_stage(stages, spark, sf_dir):
    (_, docs), (_, ruled), (_, good), (_, single), (_, clean), (_, batches) = stages
    for _, rows in stages[1:5]:
        assert list(rows[0]) == list(docs[0])
        assert all(r in docs for r in rows)
    for r in ruled:
        n = counted(r["text"])
        assert n[0] >= 20 and 100 * n[4] <= 30 * n[0]
    model = line_crf.fit_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                               spark.read.parquet(f"{sf_dir}/labels.parquet"),
                               usable=~queries.held_out("_id"))
    own, sizes, counts = line_crf._gather([r["text"].encode() for r in ruled])
    score = model.documents(model.lines(own, counts), sizes, counts)
    assert [r["doc_id"] for r, s in zip(ruled, score) if s >= 0.5] == [r["doc_id"] for r in good]
    assert sorted(r["doc_id"] for r in single) == sorted(
        {c for _, _, c in groups([(r["doc_id"], r["text"]) for r in good])})
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    hit = {r[0] for r in windows([(r["doc_id"], r["text"]) for r in single], items) if r[5]}
    assert sorted(r["doc_id"] for r in clean) == sorted(
        r["doc_id"] for r in single if r["doc_id"] not in hit)
    assert sorted(r["doc_id"] for r in batches) == sorted(r["doc_id"] for r in clean)


def test_run_gives_the_same(stages, spark, sf_dir):
    got = [r.asDict() for r in corpus_pipeline.run(spark, sf_dir).collect()]
    assert sorted(got, key=repr) == sorted(stages[-1][1], key=repr)


def test_stages_take_edges_and_clashing_columns(spark, sf_dir, edges, no_docs):
    for docs in (edges, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
        assert corpus_pipeline.packing_stage(spark, docs, sf_dir).count() == docs.count()


def test_all_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
    assert set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, sf_dir, name, monkeypatch):
    import checks.compare as c

    monkeypatch.setitem(c.QUERIES, name, queries.QUERIES[name])
    monkeypatch.setitem(c.SQL, name, queries.SQL[name])
    result, _ = compare(spark, connect(sf_dir), name, sf_dir)
    assert result.startswith("ok"), result


def test_entry_without_the_subpackage(monkeypatch):
    """The other queries stay when the text operators and the pipeline are not there."""
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith(
        ("tabulon.llm", "corpus_pipeline")) else real(name, *a))
    path = os.path.join(os.path.dirname(os.path.abspath(entry.__file__)), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("entry_alone", path)
    module = importlib.util.module_from_spec(spec)
    sys.modules["entry_alone"] = module
    spec.loader.exec_module(module)
    assert not any(x.startswith("op") and x[2:3].isdigit() for x in module.queries())
    assert len(module.queries()) > 100
