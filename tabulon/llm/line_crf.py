"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from features of itself and of its two neighbours; the chain
adds weights for each pair of labels in a row. Forward-backward gives each line's probability of
being good. A document's quality is the mean of these, weighted by line length, put through a
logistic curve fitted on the training documents.

Labels are given per document. Training starts with every line carrying its document's label,
then twice relabels those lines of bad documents that the model holds for good and for better
than the mean of their document, and fits again.

Defined results: lines without words carry no label; null and empty texts, and texts of such
lines only, score the share of label 1 among the training documents. Without both labels in
training every text scores 0.5. Repeated rows score alike. Columns of the input that have the name
of an added one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expr import col
from tabulon.llm.common import labelled_sample, small_batches

#: At most this many documents of each label are learned from, and of those only the ones of at
#: most ``SAMPLE_LINES`` lines, so that training data is bounded whatever the table.
SAMPLE_PER_CLASS = 2000
SAMPLE_LINES = 400

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_PUNCTUATION = b".,;:"
_MARKS = bytes(c for c in range(33, 127)
               if not chr(c).isalnum() and c not in _PUNCTUATION + b"'-\"()?")
_CONTINUED = bytes(range(0x80, 0xC0))

#: Own features of a line; a chain uses them for the line, the one before and the one after.
FEATURES = ("upper", "marks", "punctuation", "repeats", "distinct", "word_length",
            "single_marks", "length", "ends", "repeated")


def _gone(data: bytes, characters: bytes) -> int:
    return len(data) - len(data.translate(None, characters))


def line_features(line: bytes, words: list[bytes], repeated: bool) -> tuple[float, ...]:
    """The ``FEATURES`` of one line, each about 0 to 1; ``repeated``: the line before is the same."""
    n = len(words)
    size = sum(map(len, words))
    upper = _gone(line, _UPPER)
    letters = upper + _gone(line, _LOWER)
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    return (upper / letters if letters else 0.0,
            min(1.0, 4 * _gone(line, _MARKS) / size),
            min(1.0, 4 * _gone(line, _PUNCTUATION) / size),
            repeats / n,
            len(set(words)) / n,
            min(2.0, (size - _gone(line, _CONTINUED)) / n / 8),
            sum(len(w) == 1 and w in _MARKS for w in words) / n,
            min(1.0, np.log1p(size) / 10),
            1.0 if line.rstrip().endswith(b".") else 0.0,
            1.0 if repeated else 0.0)


def text_lines(data: bytes | None) -> tuple[list[tuple[float, ...]], list[int]]:
    """Features and lengths (bytes in words) of the lines that have words."""
    rows, sizes = [], []
    before = None
    for line in (data or b"").split(b"\n"):
        words = line.split()
        if words:
            rows.append(line_features(line, words, line == before))
            before = line
            sizes.append(sum(map(len, words)))
    return rows, sizes


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows of [1, own, before, after, has before, has after]; chains lie one after another."""
    n, k = own.shape
    out = np.zeros((n, 3 * k + 3))
    out[:, 0] = 1
    out[:, 1:k + 1] = own
    first = np.zeros(n, bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    last = np.roll(first, -1)
    inner = np.flatnonzero(~first)
    out[inner, k + 1:2 * k + 1] = own[inner - 1]
    out[inner, 3 * k + 1] = 1
    inner = np.flatnonzero(~last)
    out[inner, 2 * k + 1:3 * k + 1] = own[inner + 1]
    out[inner, 3 * k + 2] = 1
    return out


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(score: np.ndarray, counts: np.ndarray, step: np.ndarray,
              weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(P(good) of each line, expected label pairs 2x2, weighted by chain if asked for).

    ``score`` is each line's log-odds of good, ``step`` the 2x2 log weights of (label, next).
    Chains of similar length move through the recursions together.
    """
    starts = np.cumsum(counts) - counts
    out = np.empty(len(score))
    pairs = np.zeros((2, 2))
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    if not len(order):
        return out, pairs
    at, long = starts[order], counts[order]
    weight = np.ones(len(at)) if weight is None else weight[order]
    steps = int(long[0])
    # Chains still running at each step are the first ones, being sorted by length.
    running = np.searchsorted(-long, -np.arange(steps), side="left")
    forward = np.empty((len(score), 2))
    now = np.stack([np.zeros(len(at)), score[at]], 1)
    forward[at] = now
    for t in range(1, steps):
        k = running[t]
        prev, x = now[:k], score[at[:k] + t]
        now = np.stack([_add(prev[:, 0] + step[0, 0], prev[:, 1] + step[1, 0]),
                        _add(prev[:, 0] + step[0, 1], prev[:, 1] + step[1, 1]) + x], 1)
        forward[at[:k] + t] = now
    ends = at + long - 1
    z = _add(forward[ends, 0], forward[ends, 1])
    back = np.zeros((len(at), 2))
    for t in range(steps - 1, -1, -1):
        k = running[t]
        here = at[:k] + t
        out[here] = np.exp(forward[here, 1] + back[:k, 1] - z[:k])
        if t:
            before = forward[here - 1]
            x = score[here]
            for i in (0, 1):
                for j in (0, 1):
                    pairs[i, j] += np.exp(before[:, i] + step[i, j] + j * x + back[:k, j]
                                          - z[:k]) @ weight[:k]
            nxt = np.stack([_add(step[0, 0] + back[:k, 0], step[0, 1] + x + back[:k, 1]),
                            _add(step[1, 0] + back[:k, 0], step[1, 1] + x + back[:k, 1])], 1)
            back[:k] = nxt
    return out, pairs


@dataclass(frozen=True)
class LineModel:
    """Weights of the chain and of the logistic curve over a document's mean."""

    weights: tuple[float, ...]
    step: tuple[tuple[float, float], tuple[float, float]]
    curve: tuple[float, float]
    empty_score: float

    def lines(self, own: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """P(good) of each line."""
        score = with_neighbours(own, counts) @ np.array(self.weights)
        return marginals(score, counts, np.array(self.step))[0]

    def documents(self, p: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Score of each document from its lines' probabilities and lengths."""
        return np.where(counts > 0, _logistic(self.curve[0] * _means(p, sizes, counts)
                                              + self.curve[1]), self.empty_score)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _means(p: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    chain = np.repeat(np.arange(len(counts)), counts)
    top = np.bincount(chain, p * sizes, len(counts))
    return top / np.maximum(np.bincount(chain, sizes, len(counts)), 1)


def _fit_chain(x: np.ndarray, y: np.ndarray, counts: np.ndarray, weights: np.ndarray,
               step: np.ndarray, weight: np.ndarray, rounds: int, ridge: float = 1e-4
               ) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood, weighted by chain, with a small ridge, by Adam over all chains."""
    chain = np.repeat(np.arange(len(counts)), counts)
    each = weight[chain]
    follows = chain[1:] == chain[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][follows], y[1:][follows]), each[1:][follows])
    n = each.sum()
    state = np.concatenate([weights, step.ravel()])
    m, v = np.zeros_like(state), np.zeros_like(state)
    for r in range(1, rounds + 1):
        w, s = state[:-4], state[-4:].reshape(2, 2)
        p, pairs = marginals(x @ w, counts, s, weight)
        g = np.concatenate([x.T @ (each * (p - y)), (pairs - seen).ravel()]) / n + ridge * state
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        state = state - 0.1 * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.999 ** r)) + 1e-8)
    return state[:-4], state[-4:].reshape(2, 2)


def train(own: np.ndarray, sizes: np.ndarray, counts: np.ndarray, good: np.ndarray,
          rounds: int = 120) -> LineModel:
    """Fit on the lines of documents labelled ``good`` (0 or 1)."""
    x = with_neighbours(own, counts)
    document = np.repeat(good, counts).astype(np.int64)
    y = document.copy()
    w, step = np.zeros(x.shape[1]), np.zeros((2, 2))
    # Lines of good and of bad documents weigh the same in all.
    lines = np.array([counts[good == 0].sum(), counts[good == 1].sum()])
    weight = (1 / np.maximum(lines, 1))[good]
    for _ in range(3):
        w, step = _fit_chain(x, y, counts, w, step, weight, rounds)
        p = marginals(x @ w, counts, step)[0]
        better = p > np.repeat(_means(p, sizes, counts), counts) + 1e-9
        y = np.where((document == 0) & better & (p > 0.5), 1, document)
    m = _means(p, sizes, counts)[counts > 0]
    t = good[counts > 0].astype(float)
    # Both labels weigh the same in the curve, so that 0.5 lies between them.
    weight = np.where(t == 1, 0.5 / max(t.sum(), 1), 0.5 / max((1 - t).sum(), 1))
    a = np.array([4.0, -2.0])
    for _ in range(50):
        q = _logistic(a[0] * m + a[1])
        g = np.array([(weight * (q - t) * m).sum(), (weight * (q - t)).sum()]) + 1e-3 * a
        h = weight * q * (1 - q)
        hessian = np.array([[(h * m * m).sum(), (h * m).sum()], [(h * m).sum(), h.sum()]])
        a = a - np.linalg.solve(hessian + 1e-3 * np.eye(2), g)
    return LineModel(tuple(w.tolist()), tuple(map(tuple, step.tolist())), tuple(a.tolist()), 0.5)


def _gather(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, sizes, counts = [], [], []
    for data in texts:
        r, s = text_lines(data)
        rows += r
        sizes += s
        counts.append(len(r))
    return (np.array(rows, float).reshape(-1, len(FEATURES)), np.array(sizes, float),
            np.array(counts, np.int64))


def fit_lines(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS,
              usable: Column | None = None) -> LineModel:
    """Train on a sample of labelled documents (see ``labelled_sample``).

    The features are counted in Spark; the driver gets those of at most ``2 * per_class``
    documents of at most ``SAMPLE_LINES`` lines each.
    """
    kind = T.StructType([T.StructField("rows", T.BinaryType()),
                         T.StructField("sizes", T.BinaryType())])

    def features(texts: pa.Array) -> pa.Array:
        both = [text_lines(x) for x in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([np.array(r, "<f8").tobytes() for r, _ in both], pa.binary()),
             pa.array([np.array(s, "<f8").tobytes() for _, s in both], pa.binary())],
            names=["rows", "sizes"])

    sample = (labelled_sample(docs, labels, ["text"], per_class, usable=usable)
              .where(f"length(text) - length(replace(text, '\\n', '')) < {SAMPLE_LINES}")
              .select("_id", "label", F.arrow_udf(features, kind)(F.col("text").cast("binary"))
                      .alias("_f"))
              .orderBy("_id").select("label", "_f.rows", "_f.sizes").collect())
    sample = [r for r in sample if r["rows"]]
    good = np.array([r["label"] for r in sample], np.int64)
    if not len(good) or good.all() or not good.any():
        return LineModel((0.0,) * (3 * len(FEATURES) + 3), ((0.0, 0.0), (0.0, 0.0)),
                         (0.0, 0.0), 0.5)
    model = train(np.frombuffer(b"".join(r["rows"] for r in sample)).reshape(-1, len(FEATURES)),
                  np.frombuffer(b"".join(r["sizes"] for r in sample)),
                  np.array([len(r["sizes"]) // 8 for r in sample], np.int64), good)
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("label"))
    if usable is not None:
        known = known.where(usable)
    share = known.where("label in (0, 1)").agg(F.avg("label")).first()[0]
    return LineModel(model.weights, model.step, model.curve, float(share))


def score_documents(docs: DataFrame, model: LineModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``lines`` (P(good) of each line with words)."""
    kind = T.StructType([T.StructField("score", T.DoubleType()),
                         T.StructField("lines", T.ArrayType(T.DoubleType()))])

    def run(texts: pa.Array) -> pa.Array:
        own, sizes, counts = _gather(texts.to_pylist())
        p = model.lines(own, counts)
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(model.documents(p, sizes, counts), pa.float64()),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(p, pa.float64()))],
            names=["score", "lines"])

    small_batches(docs.sparkSession)
    taken = {"score", "predicted", "lines", "_crf"}
    scored = docs.withColumn("_crf", F.arrow_udf(run, kind)(F.col(text).cast("binary")))
    return scored.select(*[col(c) for c in docs.columns if c.lower() not in taken],
                         F.col("_crf.score").alias("score"),
                         (F.col("_crf.score") >= 0.5).cast("int").alias("predicted"),
                         F.col("_crf.lines").alias("lines"))
