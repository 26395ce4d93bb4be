"""Repair of conversations against a search over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tabulon.llm import conversations as conv

WHITE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(c, t, role, text)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    """[(role, text, fault)] of one conversation's rows in order."""
    out, seen = [], set()
    for _, _, role, text in rows:
        words = text.strip(WHITE)
        fault = ("blank" if not words else "duplicate" if (role, text) in seen else
                 "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def best(rows):
    """(cost, edits, lines), least, by trying every edit up to two insertions in a row.

    A search over (row, initials so far as a state) by shortest strings, without costs to go.
    """
    states = {("", 0): (0, "", ())}          # key: (state name, insertions in a row)
    for role, text, fault in [*rows, (None, None, "end")]:
        for _ in range(2):                   # insertions before the row
            for (state, k), (cost, edits, lines) in list(states.items()):
                initial = "a" if state == "u" else "u"
                key = (initial, k + 1)
                new = (cost + 5, edits + "I", (*lines, f"{ROLES[initial]}:"))
                if k < 2 and (key not in states or new < states[key]):
                    states[key] = new
        if fault == "end":
            break
        after = {}

        def put(key, value):
            if key not in after or value < after[key]:
                after[key] = value

        for (state, _), (cost, edits, lines) in states.items():
            put((state, 0), (cost + 2, edits + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            price = 5 if fault == "truncated" else 0
            i = role[:1]
            allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
            if i and i in allowed:
                put((i, 0), (cost + price, edits + "K", (*lines, f"{role}:{text}")))
            i = "a" if state == "u" else "u"
            put((i, 0), (cost + price + 1, edits + "R", (*lines, f"{ROLES[i]}:{text}")))
        states = after
    ends = [v for (state, _), v in states.items() if state in ("", "a")]
    return min(ends)


def everything(rows):
    """The same for a few rows by listing every string of edits."""
    found = []
    for edits in itertools.product(("D", "K", "Ru", "Ra"), repeat=len(rows)):
        for holes in itertools.product(("", "u", "a", "ua", "au"), repeat=len(rows) + 1):
            cost = 5 * sum(map(len, holes))
            audit, initials, lines = "", "", []
            for k in range(len(rows) + 1):
                audit += "I" * len(holes[k])
                initials += holes[k]
                lines += [f"{ROLES[i]}:" for i in holes[k]]
                if k == len(rows):
                    break
                role, text, fault = rows[k]
                e = edits[k]
                audit += e[0]
                if e == "D":
                    cost += 2
                    continue
                if fault in ("blank", "duplicate"):
                    cost += 10**9
                cost += (5 if fault == "truncated" else 0) + (e[0] == "R")
                role = role if e == "K" else ROLES[e[1]]
                initials += role[:1] or "-"
                lines.append(f"{role}:{text}")
            if re.fullmatch("(s?(ua)+)?", initials):
                found.append((cost, audit, tuple(lines)))
    return min(found)


def tie(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows, search=best):
    """{conv_id: report} of damaged rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    out = {}
    for c, own in groups.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, tie(r[2], r[3])))
        marked = faults(own)
        turns = {r[1] for r in own if r[1] is not None}
        initials = [r[0][:1] for r in marked]
        cost, audit, lines = search(marked)
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                  *[sum(f == name for _, _, f in marked)
                    for name in ("blank", "duplicate", "truncated")],
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                  cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def frame(spark, rows, n=3):
    return spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string").repartition(n)


def reports(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def some(rng, conversations, longest, blank=0.1):
    rows = []
    for c in range(conversations):
        for t in range(rng.randrange(1, longest + 1)):
            text = rng.choice(["Hm.", "Yes!", "cut off", f"t{rng.randrange(9)}.", "", " \n"]
                              if rng.random() < 0.6 else [f"own {t}.", f"own {t}"])
            rows.append((c if c else None, rng.choice([t, t + 1, None]),
                         rng.choice(["user", "assistant", "system", "user", "assistant", "tool",
                                     "", None, "Ünit"]), text))
    return rows


def test_both_searches_agree():
    rng = random.Random(1)
    for _ in range(60):
        rows = faults([(0, 0, r or " ", x) for _, _, r, x in some(rng, 1, 3)])
        assert best(rows) == everything(rows)


def test_table(spark, sf_dir):
    from tabulon.sources.tables import read_table

    table = read_table(spark, sf_dir, "conversations")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = reports(conv.audit(table))
    want = brute(damage(rows))
    empty = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    assert got == {c: want.get(c, empty) for c in {r[0] for r in rows}}


@pytest.mark.parametrize("piece", [4096, 3])
def test_faults_ties_nulls_and_repeats(spark, monkeypatch, piece):
    """Whole conversations, and such that are cut to pieces of three rows."""
    monkeypatch.setattr(conv, "PIECE", piece)
    rng = random.Random(2)
    rows = some(rng, 60, 14)
    rows += rows[:40] + [(7, None, "user", "again.")] * 9 + [(8, 3, "user", "")] * 8
    df = frame(spark, rows).selectExpr("*", "1 as place", "'x' as edit", "2 as part", "3 as key")
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert reports(conv.repair(df)) == brute(clean)
    assert {c: v for c, v in reports(conv.audit(df)).items() if v[6]} == \
        {c: v for c, v in brute(damage(rows)).items() if v[6]}
    turns = {}
    for r in conv.repaired_turns(df).orderBy("conv_id", "place").collect():
        assert r.place == len(turns.setdefault(r.conv_id, []))
        turns[r.conv_id].append(f"{r.role}:{r.text}")
    digest = {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in turns.items()}
    assert all(digest.get(c, hashlib.sha256(b"").hexdigest()) == v[-1]
               for c, v in brute(clean).items())


def test_one_long_conversation(spark, monkeypatch, long_text):
    monkeypatch.setattr(conv, "PIECE", 50)
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"text {t % 700}" + rng.choice([".", ""]))
            for t in range(2000)]
    rows += [(2, 0, "user", long_text + "?"), (2, 1, "assistant", long_text + ".")]
    assert reports(conv.repair(frame(spark, rows, 5))) == brute(rows)


def test_empty_table_and_all_dropped(spark):
    none = frame(spark, [])
    assert conv.audit(none).collect() == []
    gone = next(t for t in range(99) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = reports(conv.audit(frame(spark, [(5, gone, "user", "Hi.")])))
    assert got == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_checkpoints_do_not_change_the_walk():
    rng = random.Random(4)
    for n in (0, 1, 2, 3, 5, 8, 9, 10, 99, 100, 101, 1000):
        row = bytes(rng.choice([0, 1, 1, 2, 2, 3, 4, 5, 9, 10]) for _ in range(n))
        edits, cost = conv.cheapest_edits(row)
        plain = [(("system", "user", "assistant", "x")[r & 3], f"{i}",
                  "blank" if r & 4 else "truncated" if r & 8 else None)
                 for i, r in enumerate(row)]
        assert (cost, edits) == best(plain)[:2]
