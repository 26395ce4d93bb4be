"""Token shards: ids of the library, exact round trips, access to single documents."""

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabulon.llm import shared_files, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def test_pieces_never_change_the_ids(library):
    rng = random.Random(7)
    parts = ["a", "bc", " ", "  ", "\n", "\t", "\xa0", " ", "'s", "é", "1", "²", ".", "!!",
             "<|endoftext|>", "\x1c", "\x85", "漢", "😀", "\r\n", "   ", "　", "\x00"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(3000)] + [None, ""]
    texts += ["plain words, with\nline ends. And more", " leads", "ends ", "a  b", "a \nb"]
    enc = token_files.Encoder(PATH)
    for _ in range(2):
        for t, ids in zip(texts, enc.encode(texts)):
            assert np.frombuffer(ids, enc.width).tolist() == library(t)


def test_added_tokens(spark, library):
    """Within a text, at both ends, doubled, glued to words, and broken."""
    e = "<|endoftext|>"
    texts = [f"Hello {e} world", e, f"{e}{e}", f"{e} a", f"a {e}", f"a{e}b", f" {e}\n{e} ",
             "<|endoftext", "<|endoftext |>", f"a  {e}  b", f"<{e}>"]
    enc = token_files.Encoder(PATH)
    for t, ids in zip(texts, enc.encode(texts)):
        assert np.frombuffer(ids, enc.width).tolist() == library(t)
    assert library(texts[0]) == [15496, 220, 50256, 995]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted(map(tuple, token_files.round_trip(df.repartition(3), PATH).collect()))
    assert found == brute(list(enumerate(texts)), library)


def test_generations_of_pieces(library, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_PIECES", 10)
    enc = token_files.Encoder(PATH)
    rng = random.Random(8)
    for _ in range(50):
        texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(9)) for _ in range(3)]
        for t, ids in zip(texts, enc.encode(texts)):
            assert np.frombuffer(ids, enc.width).tolist() == library(t)


def brute(rows, library):
    out, before = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library(text) + [0]
        out.append((i, before, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        before += len(ids)
    return out


def test_table(docs, library):
    found = token_files.round_trip(docs, PATH)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect())) == brute(
        [(r["doc_id"], r["text"]) for r in docs.collect()], library)


def test_edges(edges, no_docs, library):
    rows = token_files.round_trip(edges, PATH).collect()
    want = brute([(r["doc_id"], r["text"]) for r in edges.collect()], library)
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted(
        (i or 0, n, c) for i, _, n, c in want)
    starts = sorted((r["start"], r["n_tokens"]) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])][:2] == [None, None]
    assert token_files.round_trip(no_docs, PATH).count() == 0


def test_single_documents_and_the_dictionary(spark, docs, library, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    manifest = token_files.write_token_files(docs, folder, PATH)
    assert manifest == json.loads(shared_files.read_file(f"{folder}/manifest.json"))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for s in manifest["shards"]:
        shard = token_files.Shard(folder, s["file"])
        ids = shard.index.column("id").to_pylist()
        assert ids == sorted(ids) and sum(shard.index.column("n_ids").to_pylist()) == s["n_ids"]
        for row in (0, len(ids) - 1):
            assert shard.document(row).tolist() == library(text[ids[row]]) + [0]
    whole = token_files.read_token_files(spark, folder, with_ids=True).where("doc_id = 3").first()
    assert whole["ids"] == library(text[3]) + [0]
    name = f"{folder}/dictionary-{manifest['dictionary'][:16]}"
    shared_files.write_file(name, b"another dictionary")
    with pytest.raises(ValueError):
        token_files.Shard(folder, manifest["shards"][0]["file"])


def test_small_dictionaries():
    assert token_files.train_dictionary([]) == b""
    few = token_files.train_dictionary([b"12345678" * 4])
    assert few == b"12345678" * 4


def test_long_text(spark, long_text, library):
    df = spark.createDataFrame([(1, long_text), (2, None)], "doc_id long, text string")
    rows = token_files.round_trip(df, PATH).orderBy("doc_id").collect()
    assert rows[0]["n_tokens"] == len(library(long_text)) + 1 and rows[1]["n_tokens"] == 1
