"""Quality rules learned as an ordered decision list.

Statistics of each text are counted in one pass. Sequential covering grows conjunctions of
thresholds on the labelled statistics until they cover no good document, prunes them on held-back
labels, and keeps those that stay precise. The list becomes one Spark conditional expression over
the statistics, so applying it is a narrow projection.

Defined results: null and empty texts have no words and fail the base rule; repeated rows are
judged one by one, alike; other columns are kept, and a column that has the name of an added one
is replaced. Without usable labels the list is empty and only the base rule decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import col
from tabulon.llm.common import WHITE, labelled_sample, small_batches, windows, word_hashes

#: Fixed values of the base rule.
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: At most this many labelled documents of each class are learned from.
SAMPLE_PER_CLASS = 6000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_upper", "n_letters", "n_digits", "n_punctuation", "n_adjacent", "n_distinct"]

_COUNT_TYPE = T.StructType([T.StructField(c, T.LongType(), False) for c in COUNTS])

_NOT_CHARS = WHITE + bytes(range(0x80, 0xC0))
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_PUNCTUATION = b".,;:!?"

#: Ratios the rules are built from, as SQL over the struct of counts.
RATIOS = {
    "symbol_ratio": "_counts.n_symbols / greatest(_counts.word_chars, 1)",
    "punctuation_ratio": "_counts.n_punctuation / greatest(_counts.word_chars, 1)",
    "digit_ratio": "_counts.n_digits / greatest(_counts.word_chars, 1)",
    "upper_ratio": "_counts.n_upper / greatest(_counts.n_letters, 1)",
    "mean_word_chars": "_counts.word_chars / greatest(_counts.n_words, 1)",
    "adjacent_ratio": "_counts.n_adjacent / greatest(_counts.n_words, 1)",
    "repeat_ratio": "_counts.n_repeat_words / greatest(_counts.n_words, 1)",
    "distinct_ratio": "_counts.n_distinct / greatest(_counts.n_words, 1)",
    "dup_line_ratio": "_counts.n_dup_lines / greatest(_counts.n_lines, 1)",
}


def _gone(data: bytes, characters: bytes) -> int:
    return len(data) - len(data.translate(None, characters))


def count_text(data: bytes | None) -> tuple[int, ...]:
    """The ``COUNTS`` of one UTF-8 text."""
    data = data or b""
    words = data.split()
    n = len(words)
    if not n:
        return (0, 0, _gone(data, SYMBOLS)) + (0,) * (len(COUNTS) - 3)
    lines = [x for x in data.split(b"\n") if x.strip()]
    h = word_hashes().of(words)
    repeated = 0
    if n > REPEAT_WINDOW:
        w = windows(h, REPEAT_WINDOW)
        order = np.argsort(w, kind="stable")
        same = w[order][1:] == w[order][:-1]
        if same.any():
            twice = np.zeros(len(w), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            edge = np.zeros(n + 1, np.int64)
            starts = np.flatnonzero(twice)
            edge[starts] += 1
            np.add.at(edge, starts + REPEAT_WINDOW, -1)
            repeated = int((np.cumsum(edge)[:n] > 0).sum())
    upper = _gone(data, _UPPER)
    return (n, len(data.translate(None, _NOT_CHARS)), _gone(data, SYMBOLS),
            len(lines) - len(set(lines)), repeated, len(lines), upper,
            upper + _gone(data, _LOWER), _gone(data, _DIGITS), _gone(data, _PUNCTUATION),
            int((h[1:] == h[:-1]).sum()), len(set(words)))


@F.arrow_udf(_COUNT_TYPE)
def _count(texts: pa.Array) -> pa.Array:
    rows = [count_text(x) for x in texts.to_pylist()]
    columns = list(zip(*rows)) if rows else [()] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=COUNTS)


def with_counts(docs: DataFrame, text: str = "text", to: str = "_counts") -> DataFrame:
    """``docs`` with a struct of the counts of each text."""
    small_batches(docs.sparkSession)
    return docs.withColumn(to, _count(F.col(text).cast("binary")))


@dataclass(frozen=True)
class Rule:
    """Rejects a document if every (ratio, "<=" or ">", threshold) holds."""

    conditions: tuple[tuple[str, str, float], ...]
    covered: int
    precision: float

    def sql(self) -> str:
        return " and ".join(f"({RATIOS[f]}) {op} {t!r}D" for f, op, t in self.conditions)


@dataclass(frozen=True)
class DecisionList:
    """Rules tried in order; a document that none rejects is kept."""

    rules: tuple[Rule, ...]

    def expression(self) -> Column:
        """Number of the first rule that holds (from 1), 0 if none does, over the counts."""
        if not self.rules:
            return F.lit(0)
        out = None
        for i, rule in enumerate(self.rules, 1):
            out = (F.when(F.expr(rule.sql()), i) if out is None
                   else out.when(F.expr(rule.sql()), i))
        return out.otherwise(0)


def _best_condition(x: np.ndarray, bad: np.ndarray, names: list[str]):
    """The threshold condition with the largest gain of information on the rows given."""
    p0, n0 = bad.sum(), (~bad).sum()
    base = np.log2(p0 / (p0 + n0))
    best = (0.0, None)
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        v, b = x[order, j], bad[order]
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        below_p, below_n = np.cumsum(b)[cuts], np.cumsum(~b)[cuts]
        for op, p, n in (("<=", below_p, below_n), (">", p0 - below_p, n0 - below_n)):
            gain = p * (np.log2(np.maximum(p, 1e-9) / (p + n)) - base)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                c = cuts[k]
                best = (float(gain[k]), (name, op, float((v[c] + v[c + 1]) / 2)))
    return best[1]


def _holds(x: np.ndarray, names: list[str], conditions) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, op, t in conditions:
        v = x[:, names.index(name)]
        out &= v <= t if op == "<=" else v > t
    return out


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], min_precision: float = 0.95,
          min_covered: int = 5, max_rules: int = 16, max_conditions: int = 5) -> DecisionList:
    """Sequential covering: rows 0, 1 of every three grow a rule, the third prunes it.

    Stops at the first rule that, after pruning, covers fewer than ``min_covered`` bad rows or
    is less precise than ``min_precision`` on either part.
    """
    left = np.ones(len(x), bool)
    pruning = np.arange(len(x)) % 3 == 2
    rules: list[Rule] = []
    while len(rules) < max_rules:
        grow = left & ~pruning
        conditions: list[tuple[str, str, float]] = []
        rows = np.flatnonzero(grow)
        while len(conditions) < max_conditions and bad[rows].any() and not bad[rows].all():
            c = _best_condition(x[rows], bad[rows], names)
            if c is None:
                break
            conditions.append(c)
            rows = rows[_holds(x[rows], names, [c])]
        if not conditions:
            break

        def worth(cs) -> float:
            hit = left & pruning & _holds(x, names, cs)
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            return (p - n) / (p + n) if p + n else -1.0

        conditions = max((conditions[:k] for k in range(len(conditions), 0, -1)), key=worth)
        hit = left & _holds(x, names, conditions)
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        if p < min_covered or p < min_precision * (p + n) or worth(conditions) < 2 * min_precision - 1:
            break
        rules.append(Rule(tuple(conditions), p + n, p / (p + n)))
        left &= ~hit
    return DecisionList(tuple(rules))


def fit_rules(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS,
              usable: Column | None = None) -> DecisionList:
    """Learn the list from a sample of labelled documents (see ``labelled_sample``).

    ``usable`` restricts the labels by their id column ``_id``. At most ``2 * per_class`` rows
    of statistics reach the driver.
    """
    names = list(RATIOS)
    sample = labelled_sample(docs, labels, ["text"], per_class, usable=usable)
    rows = (with_counts(sample.select("_id", "label", "text"))
            .selectExpr("_id", "label", *[f"{e} as {n}" for n, e in RATIOS.items()])
            .orderBy(F.crc32(F.col("_id").cast("string").cast("binary")), "_id").toPandas())
    bad = (rows["label"] == 0).to_numpy(bool) if len(rows) else np.zeros(0, bool)
    if not bad.any() or bad.all():
        return DecisionList(())
    return learn(rows[names].to_numpy(float), bad, names)


def judge(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``rule`` (0: none) and ``kept``."""
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = ((F.col("_counts.n_words") < MIN_WORDS)
              | (100 * F.col("_counts.n_repeat_words")
                 > MAX_REPEAT_PERCENT * F.col("_counts.n_words")))
    rule = rules.expression()
    taken = {*added, "base_failed", "rule", "kept", "_counts"}
    return with_counts(docs, text).select(
        *[col(c) for c in docs.columns if c.lower() not in taken],
        *[F.col(f"_counts.{c}").alias(c) for c in added],
        failed.alias("base_failed"), rule.alias("rule"), (~failed & (rule == 0)).alias("kept"))
