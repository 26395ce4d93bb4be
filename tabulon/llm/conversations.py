"""Repair of the order of roles in conversations, by a dynamic program with checkpoints.

A conversation should be ``(s?(ua)+)?`` in the initials of its roles. Rows are kept, deleted or
given another role, and empty turns are inserted, at least cost; of the cheapest edits those whose
string of initials (D, I, K, R) is least.

The cost to go from each of four states, before each row, decides every edit. ``_walk`` stores
these vectors only at every square root of n rows while it runs backward, then walks forward and
recomputes one block of them at a time.

Long conversations are not held in one task. Rows are dealt and sorted by range of conversation
and turn, and cut into pieces of at most ``PIECE`` rows and about ``PIECE_BYTES`` of text:

1. A conversation that lies whole in one piece is done there.
2. Pieces of others give the cheapest way between any two states, a matrix of sixteen numbers.
   Matrices of a conversation are multiplied from its end, which gives the vector of costs
   behind every piece: checkpoints again, one a piece.
3. Every piece is walked by itself, once from each state, all in parallel.
4. The pieces of a conversation stream by in order, each continues from the state that the one
   before has ended in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import col
from tabulon.llm.common import batches, shuffles_removed, small_batches
from tabulon.session import BROADCAST_ROWS, stored

#: Rows, and bytes of text, of one piece of a conversation.
PIECE = 4096
PIECE_BYTES = 8 << 20
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

_FAR = 1 << 60
#: States: nothing yet, after the system turn, after a user's, after an assistant's.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: Where a user's or assistant's turn leads, by state.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
#: A row for the program: what it is kept as from each state (or none), and its price if kept.
#: The initial is in the low two bits.
_INITIAL = {"s": 0, "u": 1, "a": 2}
_OTHER, _GONE, _CUT = 3, 4, 8
_KEPT = ((_SYSTEM, None, None, None), (_USER, _USER, None, _USER),
         (None, None, _ASSISTANT, None), (None,) * 4)
_END = (0, 2 * INSERT, INSERT, 0)
_LEGAL = {"su", "ua", "au"}


def _before(row: int, after: tuple) -> tuple:
    """Costs to go before a row, from those after it; insertions may come first."""
    c = [DELETE + x for x in after]
    if not row & _GONE:
        price = TRUNCATED if row & _CUT else 0
        kept = _KEPT[row & 3]
        for state in range(4):
            c[state] = min(c[state], REROLE + price + after[_NEXT[state]],
                           price + after[kept[state]] if kept[state] else _FAR)
    user, assistant = min(c[2], INSERT + c[3]), min(c[3], INSERT + c[2])
    return min(c[0], INSERT + user), min(c[1], INSERT + user), user, assistant


def _walk(rows: bytes, after: tuple, state: int) -> tuple[str, int]:
    """(edits, state at the end): the ASCII-least cheapest edits from ``state`` on."""
    n = len(rows)
    step = isqrt(n) + 1
    marks = {n: after}
    vector = after
    for i in range(n - 1, -1, -1):
        vector = _before(rows[i], vector)
        if i % step == 0:
            marks[i] = vector
    edits = []
    for low in range(0, n, step):
        high = min(low + step, n)
        block = [marks[high]]
        for i in range(high - 1, low, -1):
            block.append(_before(rows[i], block[-1]))
        block.append(marks[low])
        block.reverse()
        i = low
        while i < high:
            now, then = block[i - low], block[i - low + 1]
            cost, row = now[state], rows[i]
            if cost == DELETE + then[state]:
                edits.append("D")
                i += 1
            elif cost == INSERT + now[_NEXT[state]]:
                edits.append("I")
                state = _NEXT[state]
            else:
                price = TRUNCATED if row & _CUT else 0
                kept = _KEPT[row & 3][state]
                if kept and cost == price + then[kept]:
                    edits.append("K")
                    state = kept
                else:
                    edits.append("R")
                    state = _NEXT[state]
                i += 1
    return "".join(edits), state


def _ending(state: int) -> tuple[str, int]:
    """Insertions behind the last row."""
    edits = ""
    while _END[state]:
        edits, state = edits + "I", _NEXT[state]
    return edits, state


def cheapest_edits(rows: bytes) -> tuple[str, int]:
    """(edits, cost) of a whole conversation, a byte a row."""
    vector = _END
    for row in reversed(rows):
        vector = _before(row, vector)
    edits, state = _walk(rows, _END, _START)
    return edits + _ending(state)[0], vector[_START]


_PIECE = T.StructType([
    *[T.StructField(n, T.LongType()) for n in
      "part seq blank duplicate truncated illegal turns first_turn last_turn".split()],
    T.StructField("whole", T.BooleanType()),
    T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType()),
    T.StructField("rows", T.BinaryType()),
    T.StructField("copies", T.ArrayType(T.LongType())),
    T.StructField("roles", T.ArrayType(T.StringType())),
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("matrix", T.ArrayType(T.LongType()))])


def _piece_schema(rows: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType),
                         *_PIECE.fields])


def _arrow(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


class _Piece:
    """Rows of one conversation, in order, as far as they fit."""

    def __init__(self, conv_id, seq: int, turn=None) -> None:
        self.conv_id, self.seq = conv_id, seq
        self.rows, self.size = bytearray(), 0
        self.copies, self.roles, self.texts = [], [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first_initial = self.last_initial = None

    def full(self) -> bool:
        return len(self.rows) >= PIECE or self.size >= PIECE_BYTES

    def add(self, turn, role: str, text: str, copies: int, repeated: bool) -> int:
        """Add a row, as often as it fits; returns how many of its copies are left."""
        taken = max(1, min(copies, PIECE - len(self.rows)))
        initial = role[:1]
        words = text.strip(" \t\n\x0b\x0c\r")
        row = _INITIAL.get(initial, _OTHER)
        if not words:
            self.blank += taken
            row |= _GONE
        else:
            self.duplicate += taken - (not repeated)
            if repeated:
                row |= _GONE
            elif words[-1] not in ".!?":
                self.truncated += 1
                row |= _CUT
        self.rows += bytes([row]) + bytes([row & 3 | _GONE]) * (taken - 1)
        self.illegal += taken - 1
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in _LEGAL
        else:
            self.first_initial = initial
        self.last_initial = initial
        if turn is not None:
            if turn != self.last_turn:
                self.turns += 1
            if self.first_turn is None:
                self.first_turn = turn
            self.last_turn = turn
        self.copies.append(taken)
        self.roles.append(role)
        self.texts.append(None if row & _GONE else text)     # deleted in any case
        self.size += 0 if row & _GONE else len(text)
        return copies - taken

    def record(self, part: int, whole: bool) -> dict:
        matrix = None
        if not whole:
            matrix = []
            for target in range(4):
                vector = tuple(0 if s == target else _FAR for s in range(4))
                for row in reversed(self.rows):
                    vector = tuple(min(x, _FAR) for x in _before(row, vector))
                matrix += vector
        return {"conv_id": self.conv_id, "part": part, "seq": self.seq, "blank": self.blank,
                "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "turns": self.turns, "first_turn": self.first_turn,
                "last_turn": self.last_turn, "whole": whole,
                "first_initial": self.first_initial, "last_initial": self.last_initial,
                "rows": bytes(self.rows), "copies": self.copies, "roles": self.roles,
                "texts": self.texts, "matrix": matrix}


def _cut(schema: T.StructType):
    """Arrow function: sorted rows to pieces. The first and the last conversation of a task may
    go on in another one; all others that are not cut are whole."""
    def cut(iterator) -> Iterator[pa.RecordBatch]:
        out = _arrow(schema)
        part = TaskContext.get().partitionId()
        seq, conversations, piece, was_cut = 0, 0, None, False
        done: list[dict] = []
        size = 0

        def close(whole: bool) -> None:
            nonlocal size
            done.append(piece.record(part, whole))
            size += piece.size + len(piece.rows)

        for batch in batches(iterator):
            for conv_id, turn, role, text, copies, repeated in zip(
                    *(batch[n] for n in ("conv_id", "turn", "role", "text", "copies",
                                         "repeated"))):
                if piece is None or conv_id != piece.conv_id:
                    if piece is not None:
                        close(conversations > 1 and not was_cut)
                    piece, was_cut = _Piece(conv_id, seq), False
                    seq, conversations = seq + 1, conversations + 1
                while copies:
                    if piece.full():
                        close(False)
                        piece, was_cut = _Piece(conv_id, seq), True
                        seq += 1
                    copies, repeated = piece.add(turn, role, text, copies, repeated), True
            if size > PIECE_BYTES or len(done) > 1000:
                yield pa.RecordBatch.from_pylist(done, schema=out)
                done, size = [], 0
        if piece is not None:
            close(False)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=out)

    return cut


def _behind(schema: T.StructType):
    """Arrow function: pieces from the last to the first of each conversation, to the costs to
    go behind each of them."""
    def behind(iterator) -> Iterator[pa.RecordBatch]:
        of, vector = object(), _END
        for batch in batches(iterator):
            found = []
            for conv_id, part, seq, m in zip(*(batch[n] for n in
                                               ("conv_id", "part", "seq", "matrix"))):
                if conv_id != of:
                    of, vector = conv_id, _END
                found.append({"part": part, "seq": seq, "behind": list(vector)})
                vector = tuple(min(m[4 * t + s] + vector[t] for t in range(4)) for s in range(4))
            yield pa.RecordBatch.from_pylist(found, schema=_arrow(schema))

    return behind


_BEHIND = T.StructType([T.StructField("part", T.LongType()), T.StructField("seq", T.LongType()),
                        T.StructField("behind", T.ArrayType(T.LongType()))])
_WALKS = T.StructType([T.StructField("edits", T.ArrayType(T.StringType())),
                       T.StructField("ends", T.ArrayType(T.LongType()))])


def _walks(rows: pa.Array, behind: pa.Array) -> pa.Array:
    """Each piece walked from each of the states."""
    out = []
    for row, after in zip(rows.to_pylist(), behind.to_pylist()):
        found = [_walk(row, tuple(after), s) for s in range(4)]
        out.append({"edits": [e for e, _ in found], "ends": [s for _, s in found]})
    return pa.array(out, pa.struct([("edits", pa.list_(pa.string())),
                                    ("ends", pa.list_(pa.int64()))]))


class _Conversation:
    """What the pieces of a conversation add up to, in order."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.first_turn = self.last_turn = self.last_initial = None
        self.turns, self.cost, self.place = 0, 0, 0
        self.audit: list[str] = []
        self.digest = hashlib.sha256()

    def _put(self, edit: str, role: str, text: str, out: list | None) -> None:
        self.digest.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        if out is not None:
            out.append({"conv_id": self.conv_id, "place": self.place, "role": role,
                        "text": text, "edit": edit})
        self.place += 1

    def add(self, p: dict, edits: str, state: int, out: list | None) -> None:
        """The next piece, edited from ``state`` on."""
        for name in self.counts:
            self.counts[name] += p[name]
        if self.last_initial is not None:
            self.counts["illegal"] += self.last_initial + p["first_initial"] not in _LEGAL
        self.last_initial = p["last_initial"]
        if p["first_turn"] is not None:
            self.turns += p["turns"] - (p["first_turn"] == self.last_turn)
            if self.first_turn is None:
                self.first_turn = p["first_turn"]
            self.last_turn = p["last_turn"]
        rows, of = p["rows"], [k for k, n in enumerate(p["copies"]) for _ in range(n)]
        at = 0
        for edit in edits:
            if edit == "I":
                state = _NEXT[state]
                self.cost += INSERT
                self._put(edit, _NAMES[state], "", out)
                continue
            row, k = rows[at], of[at]
            at += 1
            if edit == "D":
                self.cost += DELETE
                continue
            self.cost += (TRUNCATED if row & _CUT else 0) + (REROLE if edit == "R" else 0)
            state = _NEXT[state] if edit == "R" else _KEPT[row & 3][state]
            self._put(edit, _NAMES[state] if edit == "R" else p["roles"][k], p["texts"][k], out)
        self.audit.append(edits)

    def end(self, state: int, out: list | None) -> dict:
        edits, _ = _ending(state)
        for _ in edits:
            state = _NEXT[state]
            self.cost += INSERT
            self._put("I", _NAMES[state], "", out)
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": self.cost,
                "audit": "".join(self.audit) + edits,
                "repaired_sha256": self.digest.hexdigest()}


def _report_schema(conv: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("conv_id", conv),
        *[T.StructField(n, T.LongType()) for n in
          "gaps blank duplicate truncated illegal cost".split()],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def _turns_schema(conv: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("conv_id", conv), T.StructField("place", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("edit", T.StringType())])


def _finish(schema: T.StructType, turns: bool):
    """Arrow function: pieces in order, walked already if they have ``edits``, to reports, or to
    the repaired turns."""
    def finish(iterator) -> Iterator[pa.RecordBatch]:
        made = _arrow(schema)
        current, state = None, _START
        for batch in batches(iterator):
            reports: list[dict] = []
            out: list | None = [] if turns else None
            for values in zip(*batch.values()):
                p = dict(zip(batch, values))
                if current is None or p["whole"] or current.conv_id != p["conv_id"]:
                    if current is not None:
                        reports.append(current.end(state, out))
                    current, state = _Conversation(p["conv_id"]), _START
                if p["whole"]:
                    edits, end = _walk(p["rows"], _END, state)
                else:
                    edits, end = p["edits"][state], p["ends"][state]
                current.add(p, edits, state, out)
                state = end
                if out is not None and len(out) > 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=made)
                    out = []
            found = reports if out is None else out
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=made)
        if current is not None:
            out = [] if turns else None
            report = current.end(state, out)
            yield pa.RecordBatch.from_pylist([report] if out is None else out, schema=made)

    return finish


def pieces(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as stored pieces of conversations, in order."""
    given = conversations.select(
        col("conv_id").alias("conv_id"), col("turn").cast("long").alias("turn"),
        F.coalesce(col("role"), F.lit(" ")).alias("role"),
        F.coalesce(col("text"), F.lit(" ")).alias("text"))
    # Equal rows of a turn stand next to each other: one row with their number.
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = (given.withColumn("key", key).groupBy("conv_id", "turn", "key")
            .agg(F.first("role").alias("role"), F.first("text").alias("text"),
                 F.count("*").alias("copies")))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = stored(rows.groupBy("conv_id", "key")
                    .agg(F.min(at).alias("first"), F.count("*").alias("several"))
                    .where("several > 1")
                    .select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "first"),
                    "firsts")
    if firsts.count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    order = ["conv_id", "turn", "key"]
    dealt = (rows.join(firsts, F.expr("conv_id <=> c and key = k"), "left")
             .withColumn("repeated", F.coalesce(at > F.col("first"), F.lit(False)))
             .select(*order, "role", "text", "copies", "repeated")
             .repartitionByRange(*order).sortWithinPartitions(*order))
    schema = _piece_schema(given)
    return stored(dealt.mapInArrow(_cut(schema), schema), "pieces")


def _repaired(conversations: DataFrame, turns: bool) -> DataFrame:
    small_batches(conversations.sparkSession)
    with shuffles_removed(conversations.sparkSession):
        cut = pieces(conversations)
        make = _turns_schema if turns else _report_schema
        schema = make(cut.schema["conv_id"].dataType)
        whole = cut.where("whole").drop("matrix")
        parts = cut.where("not whole")
        behind = (parts.select("conv_id", "part", "seq", "matrix").repartition("conv_id")
                  .sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
                  .mapInArrow(_behind(_BEHIND), _BEHIND))
        # Not deterministic for the optimizer, which would run it once for each of its fields.
        walks = F.arrow_udf(_walks, _WALKS).asNondeterministic()
        walked = (parts.drop("matrix").join(behind, ["part", "seq"])
                  .withColumn("w", walks("rows", "behind")).select("*", "w.*").drop("w", "behind")
                  .repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq"))
        finish = _finish(schema, turns)
        return stored(whole.mapInArrow(finish, schema)
                      .unionByName(walked.mapInArrow(finish, schema)), "repaired")


def repair(conversations: DataFrame) -> DataFrame:
    """A report of each conversation of (conv_id, turn, role, text).

    ``gaps`` are turn numbers between the first and the last that no row has. ``blank``,
    ``duplicate`` (role and text seen earlier) and ``truncated`` (the last character that is not
    white space is none of ``.!?``) count rows by the first of these faults. ``illegal`` counts
    neighbours whose roles do not begin with su, ua or au. ``cost`` and ``audit`` are the cheapest
    edits, ``repaired_sha256`` the digest of the repaired ``role:text`` lines.

    Rows stand by turn, null turns first; rows of one turn by the SHA-256 of their length of role,
    role and text. Null roles and texts read as one space, a null ``conv_id`` is a conversation of
    its own. Equal rows are each a row. Texts may be as long as memory of one row allows, and
    conversations of any length; the report of one holds its audit, a character a row. An empty
    table gives no rows; other columns are not read.
    """
    return _repaired(conversations, turns=False)


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the turns after the repair, from place 0."""
    return _repaired(conversations, turns=True)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the crc32 of ``conv_id:turn`` modulo 20, nulls read as one space.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user's.
    """
    def known(c: str):
        return F.coalesce(col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    rows = (conversations.select("conv_id", "turn", known("role").alias("role"),
                                 known("text").alias("text"), kind.alias("kind"))
            .where("kind <> 0")
            .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2)))
                                          .otherwise(F.array(F.lit(1))))))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
        .alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"))


def audit(conversations: DataFrame) -> DataFrame:
    """The report of the damaged rows for every ``conv_id`` of ``conversations``. One without
    rows after the damage has zeros, an empty audit and the digest of nothing."""
    report = repair(damaged(conversations))
    ids = conversations.select(col("conv_id").alias("c")).distinct()
    empty = hashlib.sha256(b"").hexdigest()
    return (ids.join(report, F.expr("c <=> conv_id"), "left")
            .select(F.col("c").alias("conv_id"),
                    *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in
                      "gaps blank duplicate truncated illegal cost".split()],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")))
