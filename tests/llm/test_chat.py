"""Quotation linking on written conversations, and the registered query against its SQL."""

import pytest

from checks.compare import connect
from tabulon.llm import chat, queries

TALK = [
    (1, 0, "user", "How do I sort?\nI have a list."),
    (1, 1, "assistant", "> How do I sort?\nUse sorted()."),
    (1, 2, "user", "> > how   do i SORT?\n> Use sorted().\n\nThanks"),
    (1, 3, "assistant", ">I have a list.\n> How do I sort?\n> Use sorted().\nBoth"),
    (1, 4, "user", "> nobody said this\nhm"),
    (1, 5, "user", ">> Thanks\n> not said\n"),
    (2, 0, "user", "> Use sorted().\nOther talk"),
    (2, 1, "user", None),
    (2, 1, "user", "> Other talk"),
    (2, None, "user", "> Other talk\nno turn"),
    (None, 0, "a", "own line"),
    (None, 1, "b", "> own line\nreply"),
    (3, 0, "user", "same"), (3, 1, "user", "same"), (3, 2, "user", ">same\nlast"),
    (3, 2, "user", ">same\nlast"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def talk(spark):
    return spark.createDataFrame(TALK, SCHEMA).repartition(3)


def test_links(talk):
    rows = chat.linked_messages(talk).collect()
    assert len(rows) == len(TALK)
    by = {(r["conv_id"], r["turn"]): r for r in rows}
    assert by[1, 1]["reply_to"] == 0 and by[1, 1]["text"] == "Use sorted()."
    assert by[1, 2]["reply_to"] == 1 and by[1, 2]["path"] == [0, 1, 2]
    assert by[1, 2]["text"] == "Thanks" and by[1, 2]["n_linked"] == 2
    assert by[1, 3]["reply_to"] == 0 and by[1, 3]["n_linked"] == 3
    assert by[1, 4]["reply_to"] is None and by[1, 4]["n_quoted"] == 1
    assert by[1, 5]["reply_to"] == 2 and by[1, 5]["text"] == ""
    assert by[2, 0]["reply_to"] is None and by[2, 0]["n_linked"] == 0
    assert by[2, None]["path"] == [None] and by[2, None]["text"] == "no turn"
    assert by[None, 1]["reply_to"] == 0
    assert by[3, 2]["reply_to"] == 1


def test_long_threads(spark):
    rows = [(1, 0, "u", "line 0")] + [(1, t, "u", f"> line {t - 1}\nline {t}")
                                      for t in range(1, 40)]
    found = {r["turn"]: r["path"] for r in
             chat.linked_messages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(found[t] == list(range(t + 1)) for t in range(40))


def test_empty_table_and_extra_columns(talk):
    assert chat.linked_messages(talk.where("false")).count() == 0
    more = talk.selectExpr("*", "'x' as level", "'y' as parent", "1 as path")
    assert chat.linked_messages(more).count() == len(TALK)


def test_sql_agrees(spark, talk, tmp_path):
    talk.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = connect("/root/testdata/sf0.001")
    con.execute(f"create or replace view conversations as select * from "
                f"'{tmp_path}/conversations.parquet/*.parquet'")
    found = con.execute(queries.SQL["op3_chat_formatting"])
    names = [d[0] for d in found.description]
    mine = queries.op3_chat_formatting(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, mine), key=repr) == sorted(found.fetchall(), key=repr)
