"""Exact quantiles and order statistics that never sort a column in one task.

Whole-table ranks: a sketch of bounded size brackets each wanted rank, one scan
counts the rows around the bracket, and only the few values inside are
grouped and ranked. The bracket shrinks until it is small, so the shuffled data
does not grow with the table.

Ranks per group: few groups use the same method with one bracket per group;
groups with few distinct values use ``percentile`` over value counts; anything
else is ranked by a range-partitioned sort.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import as_column, balanced_sum, col

#: Size of the sketch: ranks are off by at most n / ACCURACY.
ACCURACY = 10_000
#: A bracket with at most this many rows is ranked directly.
BRACKET_ROWS = 50_000
#: Most distinct values per group for which ``percentile`` may hold them all.
GROUP_DISTINCT = 100_000
#: Up to this many groups get brackets of their own.
BRACKET_GROUPS = 8
MAX_ROUNDS = 64
#: Bytes of a text that are compared as one number; with their count it is exact as a double.
CODE_BYTES = 6


@dataclass
class _Target:
    """Bracket around neighbouring ranks; ``below`` rows are smaller than all of it."""

    expr: Column
    ranks: list[int]
    low: Any
    high: Any
    below: int
    rows: int
    low_open: bool = False
    high_open: bool = False
    guess: tuple = ()
    done: bool = False

    @property
    def bracket(self) -> tuple:
        return self.low, self.low_open, self.high, self.high_open

    @property
    def single(self) -> bool:
        return self.low == self.high

    def inside(self) -> Column:
        above = self.expr > F.lit(self.low) if self.low_open else self.expr >= F.lit(self.low)
        under = self.expr < F.lit(self.high) if self.high_open else self.expr <= F.lit(self.high)
        return above & under

    def narrow(self, below_low: int, to_low: int, below_high: int, to_high: int,
               bracket_rows: int) -> list[_Target]:
        """Shrink to the part around the guess that holds the ranks.

        The four counts are the rows below and not above either end of the guess. An
        end that is a frequent value settles its ranks at once, and strictly between
        the ends only the sketch's error is left. Ranks that end up in different parts
        become separate targets.
        """
        low, high = self.guess
        single = dict(low_open=False, high_open=False)
        parts = [
            (self.below, below_low, dict(high=low, high_open=True)),
            (below_low, to_low, dict(low=low, high=low, **single)),
            (to_low, below_high, dict(low=low, high=high, low_open=True, high_open=True)),
            (max(to_low, below_high), to_high, dict(low=high, high=high, **single)),
            (to_high, self.below + self.rows, dict(low=high, low_open=True)),
        ]
        made = []
        for start, end, change in parts:
            ranks = [r for r in self.ranks if start <= r < end]
            if ranks:
                t = replace(self, ranks=ranks, guess=(), below=start, rows=end - start,
                            **change)
                t.done = t.single or t.rows <= bracket_rows
                made.append(t)
        return made


def _neighbours(ranks: Sequence[int]) -> list[list[int]]:
    """Runs of consecutive ranks."""
    runs: list[list[int]] = []
    for r in sorted(set(ranks)):
        if runs and r == runs[-1][-1] + 1:
            runs[-1].append(r)
        else:
            runs.append([r])
    return runs


RanksOf = Callable[[int], Sequence[int]]


def select_ranks(df: DataFrame, wanted: Mapping[str, tuple[Column, RanksOf]],
                 hints: Sequence[float] = (), accuracy: int = ACCURACY,
                 bracket_rows: int = BRACKET_ROWS
                 ) -> dict[str, tuple[int, dict[int, tuple[Any, int, int]]]]:
    """``{key: (n, {rank: (value, rows below it, rows equal to it)})}``, ranks from 0.

    ``wanted`` maps a key to a numeric, date or timestamp expression and a function
    from its count of non-null values to the wanted ranks. All keys share their
    scans. ``hints`` are the expected positions (0 to 1) of the ranks; with them the
    first scan already sketches.
    """
    keys = list(wanted)
    probs = sorted({q for p in hints for q in (max(0.0, p - 2.0 / accuracy),
                                               min(1.0, p + 2.0 / accuracy))})
    first = []
    for i, k in enumerate(keys):
        e = wanted[k][0]
        first += [F.count(e).alias(f"n{i}"), F.min(e).alias(f"a{i}"), F.max(e).alias(f"b{i}")]
        if probs:
            first.append(F.percentile_approx(e, probs, accuracy).alias(f"q{i}"))
    start = df.agg(*first).first()
    sizes = {k: start[f"n{i}"] for i, k in enumerate(keys)}
    targets: dict[str, list[_Target]] = {}
    for i, k in enumerate(keys):
        e, ranks_of = wanted[k]
        n, ranks = sizes[k], sorted(set(ranks_of(sizes[k])))
        if ranks and (ranks[-1] >= n or ranks[0] < 0):
            raise ValueError(f"rank out of range for {k}: {n} values")
        targets[k] = []
        for run in _neighbours(ranks):
            t = _Target(e, run, start[f"a{i}"], start[f"b{i}"], 0, n)
            t.done = t.single
            if probs and not t.done:
                at = [r / max(n - 1, 1) for r in (run[0], run[-1])]
                lows = [v for q, v in zip(probs, start[f"q{i}"]) if q <= at[0] - 1.0 / accuracy]
                highs = [v for q, v in zip(probs, start[f"q{i}"]) if q >= at[1] + 1.0 / accuracy]
                t.guess = (lows[-1] if lows else t.low, highs[0] if highs else t.high)
            targets[k].append(t)

    for _ in range(MAX_ROUNDS):
        active = [t for ts in targets.values() for t in ts if not t.done]
        if not active:
            break
        if not all(t.guess for t in active):
            _guess(df, active, accuracy)
        _narrow(df, active, targets, bracket_rows)
    else:
        raise RuntimeError("order statistics did not converge")
    found = _finish(df, targets)
    return {k: (sizes[k], found[k]) for k in keys}


def _guess(df: DataFrame, active: list[_Target], accuracy: int) -> None:
    """Sketch a narrower bracket for every open target, one scan for all."""
    # Targets on the same expression and bracket share one sketch.
    groups: dict[tuple, list[_Target]] = {}
    for t in active:
        groups.setdefault((str(t.expr),) + t.bracket, []).append(t)
    aggs = []
    for g, ts in enumerate(groups.values()):
        t0 = ts[0]
        probs = []
        for t in ts:
            span, slack = max(t.rows - 1, 1), 2.0 / accuracy
            probs += [max(0.0, (t.ranks[0] - t.below) / span - slack),
                      min(1.0, (t.ranks[-1] - t.below) / span + slack)]
        value = F.when(t0.inside(), t0.expr)
        aggs.append(F.percentile_approx(value, probs, accuracy).alias(f"g{g}"))
    row = df.agg(*aggs).first()
    for g, ts in enumerate(groups.values()):
        for j, t in enumerate(ts):
            t.guess = (row[g][2 * j], row[g][2 * j + 1])


def _narrow(df: DataFrame, active: list[_Target], targets: dict[str, list[_Target]],
            bracket_rows: int) -> None:
    """Count around the guessed brackets and move every target into the right part."""
    aggs = []
    for i, t in enumerate(active):
        low, high = t.guess
        aggs += [F.count_if(t.expr < F.lit(low)).alias(f"a{i}"),
                 F.count_if(t.expr <= F.lit(low)).alias(f"b{i}"),
                 F.count_if(t.expr < F.lit(high)).alias(f"c{i}"),
                 F.count_if(t.expr <= F.lit(high)).alias(f"d{i}")]
    row = df.agg(*aggs).first()
    at = {id(t): i for i, t in enumerate(active)}
    for key, ts in targets.items():
        moved = []
        for t in ts:
            if id(t) in at:
                i = at[id(t)]
                moved.extend(t.narrow(*[row[f"{x}{i}"] for x in "abcd"], bracket_rows))
            else:
                moved.append(t)
        targets[key] = moved


def _finish(df: DataFrame, targets: Mapping[str, list[_Target]]
            ) -> dict[str, dict[int, tuple[Any, int, int]]]:
    """Rank the values inside the small brackets."""
    out: dict[str, dict[int, tuple[Any, int, int]]] = {k: {} for k in targets}
    brackets: dict[tuple, list[_Target]] = {}
    for k, ts in targets.items():
        for t in ts:
            if t.single:
                out[k].update({r: (t.low, t.below, t.rows) for r in t.ranks})
            else:
                brackets.setdefault((k,) + t.bracket, []).append(t)
    if not brackets:
        return out
    names = list(brackets)
    # One struct per bracket the row falls into; values keep their own type.
    by_type: dict[str, list[int]] = {}
    for b, key in enumerate(names):
        kind = df.select(brackets[key][0].expr.alias("v")).schema["v"].dataType
        by_type.setdefault(kind.simpleString(), []).append(b)
    for members in by_type.values():
        cells = []
        for b in members:
            t = brackets[names[b]][0]
            cells.append(F.when(t.inside(), F.struct(F.lit(b).alias("b"), t.expr.alias("v"))))
        any_inside = F.coalesce(*cells).isNotNull()
        counts = (df.filter(any_inside)
                  .select(F.explode(F.array_compact(F.array(*cells))).alias("c"))
                  .groupBy("c.b", "c.v").agg(F.count(F.lit(1)).alias("n")))
        running = F.expr("sum(n) over (partition by b order by v)")
        ranked = counts.select("b", "v", "n", running.alias("upto"))
        hit = F.lit(False)
        for b in members:
            for t in brackets[names[b]]:
                for r in t.ranks:
                    k = r - t.below
                    hit = hit | ((F.col("b") == b) & (F.col("upto") > k)
                                 & (F.col("upto") - F.col("n") <= k))
        for row in ranked.filter(hit).collect():
            for t in brackets[names[row["b"]]]:
                for r in t.ranks:
                    if row["upto"] - row["n"] <= r - t.below < row["upto"]:
                        out[names[row["b"]][0]][r] = (
                            row["v"], t.below + row["upto"] - row["n"], row["n"])
    return out


def _interpolate(n: int, p: float, at: Mapping[int, float]) -> float:
    position = p * (n - 1)
    k = math.floor(position)
    share = position - k
    if share == 0:
        return at[k]
    return (k + 1 - position) * at[k] + share * at[k + 1]


def _ranks_for(n: int, probs: Sequence[float]) -> list[int]:
    if not n:
        return []
    ranks = set()
    for p in probs:
        position = p * (n - 1)
        ranks.add(math.floor(position))
        ranks.add(math.ceil(position))
    return sorted(ranks)


def column_quantiles(df: DataFrame, columns: Sequence[str] | Mapping[str, Column],
                     probs: Sequence[float], **limits: int) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles of numeric columns, nulls ignored.

    Returns ``{column: [one value per prob]}``; None for a column without values.
    """
    exprs = (dict(columns) if isinstance(columns, Mapping)
             else {c: col(c) for c in columns})
    exprs = {k: e.cast("double") for k, e in exprs.items()}
    if not exprs:
        return {}
    found = select_ranks(df, {c: (e, lambda n: _ranks_for(n, probs)) for c, e in exprs.items()},
                         probs, **limits)
    return {c: [_interpolate(n, p, {r: v[0] for r, v in at.items()}) for p in probs]
            if n else [None] * len(probs)
            for c, (n, at) in found.items()}


def group_quantiles(df: DataFrame, by: Sequence[str], value: str | Column,
                    probs: Mapping[str, float], bracket_groups: int = BRACKET_GROUPS,
                    group_distinct: int = GROUP_DISTINCT) -> DataFrame:
    """(by..., one double column per entry of ``probs``): exact quantiles per group."""
    slim = df.select(*[col(b) for b in by], as_column(value).cast("double").alias("__v"))
    slim = slim.filter(F.col("__v").isNotNull())
    groups = slim.groupBy(*[col(b) for b in by]).agg(
        F.approx_count_distinct("__v").alias("__d"))
    few = groups.limit(bracket_groups + 1).collect()
    if len(few) <= bracket_groups:
        return _bracketed_groups(slim, by, few, probs)
    if groups.agg(F.max("__d")).first()[0] <= group_distinct:
        counted = slim.groupBy(*[col(b) for b in by], "__v").agg(
            F.count(F.lit(1)).alias("__n"))
        return counted.groupBy(*[col(b) for b in by]).agg(*[
            F.percentile("__v", p, F.col("__n")).alias(name) for name, p in probs.items()])
    return _sorted_groups(slim, by, probs)


def _bracketed_groups(slim: DataFrame, by: Sequence[str], groups: list,
                      probs: Mapping[str, float]) -> DataFrame:
    schema = T.StructType([slim.schema[b] for b in by]
                          + [T.StructField(p, T.DoubleType()) for p in probs])
    exprs = {}
    for i, g in enumerate(groups):
        here = F.lit(True)
        for b in by:
            here = here & col(b).eqNullSafe(F.lit(g[b]))
        exprs[str(i)] = F.when(here, F.col("__v"))
    values = column_quantiles(slim, exprs, list(probs.values()))
    rows = [tuple(g[b] for b in by) + tuple(values[str(i)]) for i, g in enumerate(groups)]
    return slim.sparkSession.createDataFrame(rows, schema)


def _sorted_groups(slim: DataFrame, by: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    from tabulon.operators.rowindex import with_group_rank

    ranked = with_group_rank(slim, by, [F.col("__v")], "__r", "__n")
    weights = []
    for i, p in enumerate(probs.values()):
        position = F.lit(p) * (F.col("__n") - 1)
        # Weight 1 - |distance| picks the two neighbours of the position.
        weights.append(F.greatest(F.lit(0.0), 1.0 - F.abs(F.col("__r") - position))
                       .alias(f"w{i}"))
    near = ranked.select(*[col(b) for b in by], "__v", *weights)
    near = near.filter(balanced_sum([F.col(f"w{i}") for i in range(len(probs))]) > 0)
    return near.groupBy(*[col(b) for b in by]).agg(*[
        F.sum(F.when(F.col(f"w{i}") > 0, F.col("__v") * F.col(f"w{i}"))).alias(name)
        for i, name in enumerate(probs)])


def _text_code(text: Column, at: int) -> Column:
    """A number whose order is that of texts which agree in their first ``at`` bytes.

    It holds the next bytes and how many there are, so a text comes before its continuations.
    """
    part = F.substring(text.cast("binary"), at + 1, CODE_BYTES)
    digits = F.rpad(F.hex(part), 2 * CODE_BYTES, "0")
    return F.conv(digits, 16, 10).cast("bigint") * 8 + F.length(part)


def text_ranks(df: DataFrame, text: Column, ranks: Sequence[int],
               bracket_rows: int = BRACKET_ROWS) -> dict[int, tuple[str, int, int]]:
    """``{rank: (value, rows below it, rows equal to it)}`` among texts without nulls.

    What all texts begin with is skipped. The next bytes as a number are bracketed like any
    number; where many rows share them, the search goes on behind them, among those rows only.
    """
    row = df.agg(F.min(text).alias("low"), F.max(text).alias("high"), F.count(text)).first()
    low, high, n = row
    if max(ranks) >= n or min(ranks) < 0:
        raise ValueError(f"rank out of range: {n} values")
    if low == high:
        return {r: (low, 0, n) for r in ranks}
    pairs = zip(low.encode(), high.encode())
    at = next((i for i, (x, y) in enumerate(pairs) if x != y), len(low.encode()))
    code = _text_code(text, at)
    _, found = select_ranks(df, {"c": (code, lambda _: ranks)},
                            [r / max(n - 1, 1) for r in ranks], bracket_rows=bracket_rows)["c"]
    out: dict[int, tuple[str, int, int]] = {}
    few: dict[int, list[int]] = {}
    for value, members in _by_value(found).items():
        _, below, equal = found[members[0]]
        # Texts that end within these bytes are equal to each other.
        if equal <= bracket_rows or value % 8 < CODE_BYTES:
            few[value] = members
            continue
        deeper = text_ranks(df.filter(code == F.lit(value)), text, [r - below for r in members],
                            bracket_rows)
        for r in members:
            v, under, same = deeper[r - below]
            out[r] = (v, below + under, same)
    if few:
        counts = (df.filter(code.isin(list(few))).groupBy(code.alias("c"), text.alias("v"))
                  .agg(F.count(F.lit(1)).alias("n")))
        # A bracket's different texts, or a single text, in each group.
        before = W.partitionBy("c").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
        counts = counts.withColumn("f", F.coalesce(F.sum("n").over(before), F.lit(0)))
        wanted = F.lit(False)
        for value, members in few.items():
            for r in members:
                place = F.lit(r - found[r][1])
                wanted = wanted | ((F.col("c") == value) & (F.col("f") <= place)
                                   & (place < F.col("f") + F.col("n")))
        for hit in counts.filter(wanted).collect():
            for r in few[hit["c"]]:
                below = found[r][1] + hit["f"]
                if below <= r < below + hit["n"]:
                    out[r] = (hit["v"], below, hit["n"])
    return out


def _by_value(found: Mapping[int, tuple[Any, int, int]]) -> dict[Any, list[int]]:
    groups: dict[Any, list[int]] = {}
    for r, (value, _, _) in found.items():
        groups.setdefault(value, []).append(r)
    return groups


def cut_by_rank(df: DataFrame, keys: Sequence[str], ranks: Sequence[int],
                tie_rows: int = BRACKET_ROWS, rows: int | None = None,
                nulls: int | None = None) -> list[tuple]:
    """Key tuples standing at ``ranks`` (from 0) in the order of ``keys``, nulls first.

    Works key by key: the value of the first key at a rank, then the rest of the
    key among the rows sharing that value, so a value on a third of all rows is no
    problem. Keys are numbers, dates, timestamps or texts, in the order of their UTF-8 bytes.
    ``rows`` and ``nulls``, the size of the table and the nulls of the first key where they
    are known, save a scan.
    """
    ranks = sorted(set(ranks))
    if not ranks:
        return []
    head, rest = keys[0], list(keys[1:])
    if nulls is None:
        rows, nulls = df.agg(F.count(F.lit(1)), F.count_if(col(head).isNull())).first()
    out: dict[int, tuple] = {}
    if nulls:
        among = [r for r in ranks if r < nulls]
        tails = (cut_by_rank(df.filter(col(head).isNull()), rest, among, tie_rows)
                 if rest else [()] * len(among))
        out.update({r: (None, *t) for r, t in zip(among, tails)})
        df = df.filter(col(head).isNotNull())
        rows = rows - nulls if rows else None
    after = [r - nulls for r in ranks if r >= nulls]
    if not after:
        return [out[r] for r in ranks]
    if isinstance(df.schema[head].dataType, T.StringType):
        found = text_ranks(df, col(head), after, tie_rows)
    else:
        hints = [min(1.0, r / max(rows - 1, 1)) for r in after] if rows else ()
        _, found = select_ranks(df, {head: (col(head), lambda n: after)}, hints)[head]
    if not rest:
        out.update({r + nulls: (found[r][0],) for r in after})
        return [out[r] for r in ranks]
    small = {r: f for r, f in found.items() if f[2] <= tie_rows}
    for r, (v, below, equal) in found.items():
        if r not in small:
            tail = cut_by_rank(df.filter(col(head) == F.lit(v)), rest, [r - below], tie_rows)
            out[r + nulls] = (v, *tail[0])
    if small:
        ties = df.filter(col(head).isin([f[0] for f in small.values()]))
        ordered = ", ".join("`" + k.replace("`", "``") + "`" for k in rest)
        head_sql = "`" + head.replace("`", "``") + "`"
        ties = ties.select(*[col(k) for k in keys], F.expr(
            f"row_number() over (partition by {head_sql} order by {ordered})").alias("__rn"))
        hit = F.lit(False)
        for r, (v, below, _) in small.items():
            hit = hit | ((col(head) == F.lit(v)) & (F.col("__rn") == r - below + 1))
        for row in ties.filter(hit).collect():
            for r, (v, below, _) in small.items():
                if row[head] == v and row["__rn"] == r - below + 1:
                    out[r + nulls] = tuple(row[k] for k in keys)
    return [out[r] for r in ranks]
