"""Ridge and Lasso from sums of products.

One scan turns the rows into one matrix of products per group (fold, learning-curve
step), cut into blocks (group, block row, block column) that Spark adds up. Every penalty
and fold is then a problem on those matrices, solved in Spark tasks, so a grid search reads
the table once, whatever the number of features. Matrices that are small together come to
the driver; of others each task gathers those of one problem, and the driver gets
coefficients only. Both ways solve the same problems by the same functions.

Ridge minimises |y - Xw - b|^2 + alpha |w|^2 and Lasso |y - Xw - b|^2 / 2n + alpha |w|_1,
both with a free intercept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.functions.expr import balanced_sum, col
from tabulon.session import stored
from tabulon.sources.versions import save_together, saved_folder

#: Rows and columns of a block of products.
BLOCK = 256
#: Matrices of at most this many bytes in all are held by the driver.
LOCAL_BYTES = 64 << 20
#: Sums that a task holds before it hands them on.
TASK_BYTES = 96 << 20
#: Penalties tried when none are given.
RIDGE_ALPHAS = (0.001, 0.01, 0.1, 0.5, 1.0, 5.0, 10.0, 50.0, 100.0)
LASSO_ALPHAS = (0.0001, 0.001, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0, 10.0)
#: Penalties of the full pipeline.
RIDGE_GRID = (0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0)
LASSO_GRID = (0.0001, 0.001, 0.01, 0.1, 1.0, 10.0, 100.0)
#: Fixed value: a smaller coefficient counts as zero.
ZERO = 1e-10


@dataclass(frozen=True)
class LinearModel:
    """Coefficients of y = intercept + sum(coefficient * feature)."""

    kind: str
    alpha: float
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    metadata: Mapping[str, Any] = field(default_factory=dict)

    def expr(self) -> Column:
        """The prediction as a column expression."""
        terms = [col(f).cast("double") * F.lit(w)
                 for f, w in zip(self.features, self.coefficients) if w != 0.0]
        return F.lit(self.intercept) + balanced_sum(terms)

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.expr())

    def coefficient_table(self, spark: SparkSession) -> DataFrame:
        """(feature, coefficient, abs_coefficient, position), largest first."""
        rows = [(f, w, abs(w), i) for i, (f, w) in
                enumerate(zip(self.features, self.coefficients))]
        return spark.createDataFrame(
            rows, "feature string, coefficient double, abs_coefficient double, position int"
        ).orderBy(F.desc("abs_coefficient"), "position")

    def importance(self, spark: SparkSession, top: int = 20) -> DataFrame:
        """The ``top`` features with their rank."""
        place = W.partitionBy(F.lit(0)).orderBy(F.desc("abs_coefficient"), "position")
        return (self.coefficient_table(spark).withColumn("rank", F.row_number().over(place))
                .filter(F.col("rank") <= top))

    def info(self) -> dict[str, Any]:
        """Penalty, intercept, sizes; ``sparsity`` is the share of non-zero coefficients."""
        used = sum(abs(w) > ZERO for w in self.coefficients)
        scores = self.metadata.get("cv_scores") or []
        return {"model_type": self.kind, "alpha": self.alpha, "intercept": self.intercept,
                "n_features": len(self.features), "non_zero": used,
                "sparsity": used / len(self.features) if self.features else 0.0,
                "cv_mean": float(np.mean(scores)) if scores else None,
                "cv_std": float(np.std(scores)) if scores else None,
                "metadata": dict(self.metadata)}

    def save(self, spark: SparkSession, path: str) -> None:
        """Coefficients and metadata as Parquet tables below ``path``, all or none."""
        rows = [(i, f, w) for i, (f, w) in enumerate(zip(self.features, self.coefficients))]
        save_together(spark, path, {
            "coefficients": spark.createDataFrame(
                rows, "position int, feature string, coefficient double"),
            "model": spark.createDataFrame(
                [(self.kind, self.alpha, self.intercept, json.dumps(dict(self.metadata)))],
                "kind string, alpha double, intercept double, metadata string")})


def load_model(spark: SparkSession, path: str) -> LinearModel:
    path = saved_folder(spark, path)
    m = spark.read.parquet(f"{path}/model").first()
    rows = sorted(spark.read.parquet(f"{path}/coefficients").collect())
    return LinearModel(m["kind"], m["alpha"], tuple(r["feature"] for r in rows),
                       tuple(r["coefficient"] for r in rows), m["intercept"],
                       json.loads(m["metadata"]))


# --- sums of products --------------------------------------------------------------

@dataclass(frozen=True)
class Products:
    """Per group the matrix of products of [1, x - shift, y - shift].

    Either ``matrices`` are at hand, or ``blocks`` (g, i, j, v) holds their upper block
    triangles in the shared folder.
    """

    features: tuple[str, ...]
    shift: np.ndarray
    matrices: Mapping[int, np.ndarray] | None
    blocks: DataFrame | None = None
    names: tuple[int, ...] = ()

    def total(self) -> np.ndarray:
        return sum(self.matrices.values())

    def groups(self) -> list[int]:
        return sorted(self.matrices) if self.matrices is not None else sorted(self.names)


def _dense(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    flat = batch.column(name).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


_BLOCKS = "g int, i int, j int, v binary"


def _block_batch(g: int, m: np.ndarray) -> pa.RecordBatch:
    """The upper block triangle of a matrix."""
    starts = range(0, len(m), BLOCK)
    cells = [(a, b) for a in range(len(starts)) for b in range(a, len(starts))]
    return pa.RecordBatch.from_arrays(
        [pa.array([g] * len(cells), pa.int32()), pa.array([a for a, _ in cells], pa.int32()),
         pa.array([b for _, b in cells], pa.int32()),
         pa.array([np.ascontiguousarray(m[a * BLOCK:(a + 1) * BLOCK, b * BLOCK:(b + 1) * BLOCK])
                   .tobytes() for a, b in cells], pa.binary())], names=["g", "i", "j", "v"])


def _block_rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, np.ndarray]]:
    for g, i, j, v in zip(*(batch.column(n) for n in range(4))):
        yield g.as_py(), i.as_py(), j.as_py(), np.frombuffer(v.as_buffer(), float)


def _place(m: np.ndarray, i: int, j: int, v: np.ndarray) -> None:
    """Add a block, and its mirror image, to a matrix."""
    rows, columns = (slice(k * BLOCK, (k + 1) * BLOCK) for k in (i, j))
    part = v.reshape(m[rows, columns].shape)
    m[rows, columns] += part
    if i != j:
        m[columns, rows] += part.T


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by (g, i, j) to one of each."""
    key, held = None, None
    for batch in batches:
        done = []
        for g, i, j, v in _block_rows(batch):
            if (g, i, j) == key:
                held = held + v
            else:
                if key is not None:
                    done.append((*key, held.tobytes()))
                key, held = (g, i, j), v
        if done:
            yield pa.RecordBatch.from_pylist(
                [dict(zip("gijv", d)) for d in done], schema=_block_schema())
    if key is not None:
        yield pa.RecordBatch.from_pylist([dict(zip("gijv", (*key, held.tobytes())))],
                                         schema=_block_schema())


def _block_schema() -> pa.Schema:
    return pa.schema([("g", pa.int32()), ("i", pa.int32()), ("j", pa.int32()),
                      ("v", pa.binary())])


def products(df: DataFrame, features: Sequence[str], label: str, group: Column | None = None,
             held_out: Column | None = None, folds: int = 0, steps: int = 0) -> Products:
    """Sum the products of all rows, per ``group`` (an int column) where given.

    With ``held_out`` (the array made by ``learning_subsets``) a row is counted once
    per fold f under group ``f * (steps + 1) + s``, s being its entry for that fold.

    Rows must not contain nulls. Each task adds up its own rows. Where the matrices of all
    groups would not fit in a task, its rows are sorted by group first, so that it holds one
    or a few at a time; the sums of all tasks meet block by block.
    """
    features = tuple(features)
    names = list(features) + [label]
    # Shifting by the means keeps the sums free of cancellation.
    means = df.agg(*[F.avg(col(c).cast("double")).alias(f"m{i}")
                     for i, c in enumerate(names)]).first()
    if any(m is None for m in means):
        raise ValueError("a feature or the label has no values")
    shift = np.array(means, dtype=float)
    cells = df.select(
        F.array(*[col(c).cast("double") for c in names]).alias("z"),
        (group.cast("int") if group is not None else F.lit(0)).alias("g"),
        *([held_out.alias("h")] if held_out is not None else []))
    width = len(names)
    nested = held_out is not None
    size = 8 * (width + 1) ** 2
    wide = size * (folds * (steps + 1) if nested else 8) > TASK_BYTES
    if wide and nested:
        cells = (cells.select("z", F.posexplode("h").alias("f", "s"))
                 .select("z", (F.col("f") * (steps + 1) + F.col("s")).alias("g")))
        nested = False
    if wide:
        cells = cells.sortWithinPartitions("g")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}

        def add(g: int, rows: np.ndarray) -> None:
            m = rows.T @ rows
            if g in acc:
                acc[g] += m
            else:
                acc[g] = m

        for batch in batches:
            if not batch.num_rows:
                continue
            z = _dense(batch, "z", width) - shift
            z = np.hstack([np.ones((len(z), 1)), z])
            if nested:
                h = _dense(batch, "h", folds).astype(int)
                for f in range(folds):
                    for s in np.unique(h[:, f]):
                        add(f * (steps + 1) + int(s), z[h[:, f] == s])
            else:
                g = batch.column("g").to_numpy(zero_copy_only=False)
                for k in np.unique(g):
                    add(int(k), z[g == k])
                    if len(acc) > 1 and len(acc) * size > TASK_BYTES:
                        for old in [x for x in acc if x != k]:
                            yield _block_batch(old, acc.pop(old))
        for g, m in acc.items():
            yield _block_batch(g, m)

    order = ["g", "i", "j"]
    blocks = (cells.mapInArrow(sums, _BLOCKS).repartition(*order).sortWithinPartitions(*order)
              .mapInArrow(_add_blocks, _BLOCKS))
    if wide or size > LOCAL_BYTES:
        blocks = stored(blocks, "products")
        found = tuple(r["g"] for r in blocks.select("g").distinct().collect())
        if len(found) * size > LOCAL_BYTES:
            return Products(features, shift, None, blocks, found)
    matrices: dict[int, np.ndarray] = {}
    for r in blocks.collect():
        m = matrices.setdefault(r["g"], np.zeros((width + 1, width + 1)))
        _place(m, r["i"], r["j"], np.frombuffer(r["v"], float))
    if any(not np.isfinite(m).all() for m in matrices.values()):
        raise ValueError("features or label contain nulls or infinities")
    return Products(features, shift, matrices)


# --- solving -----------------------------------------------------------------------

def _centred(m: np.ndarray) -> tuple[float, np.ndarray, float, np.ndarray, np.ndarray, float]:
    n = m[0, 0]
    mean_x, mean_y = m[0, 1:-1] / n, m[0, -1] / n
    xx = m[1:-1, 1:-1] - n * np.outer(mean_x, mean_x)
    xy = m[1:-1, -1] - n * mean_x * mean_y
    return n, mean_x, mean_y, xx, xy, m[-1, -1] - n * mean_y ** 2


def _ridge(xx: np.ndarray, xy: np.ndarray, alpha: float) -> np.ndarray:
    a = xx + alpha * np.eye(len(xy))
    try:
        low = np.linalg.cholesky(a)
        return np.linalg.solve(low.T, np.linalg.solve(low, xy))
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(a, xy, rcond=None)[0]


def _lasso(xx: np.ndarray, xy: np.ndarray, n: float, alpha: float, sweeps: int = 300,
           tol: float = 1e-11, start: np.ndarray | None = None) -> np.ndarray:
    """Coordinate descent on the products, finished by an active-set method.

    Only coordinates in use and those that the gradient asks for are swept; the optimality
    gap over all of them decides whether any was left out wrongly. Descent alone crawls along
    directions in which features are collinear.
    """
    p = len(xy)
    a, b = xx / n, xy / n
    diag = np.diag(a)
    usable = np.flatnonzero(diag > 1e-14 * max(diag.max(initial=0.0), 1e-300))
    limit = tol * max(np.abs(b).max(initial=0.0), alpha, 1e-300)
    w = np.zeros(p)
    if start is not None:
        w[usable] = start[usable]
    while sweeps > 0:
        grad = b - a @ w
        if _gap(grad, w, alpha, usable) <= limit:
            return w
        work = usable[(w[usable] != 0) | (np.abs(grad[usable]) > alpha)]
        part, v, g = a[np.ix_(work, work)], w[work], grad[work]
        scale, every = diag[work].tolist(), np.arange(len(work))
        while sweeps > 0:
            sweeps -= 1
            for k, d in enumerate(scale):
                old = v[k]
                z = g[k] + d * old
                new = max(abs(z) - alpha, 0.0) / d * (1.0 if z > 0 else -1.0)
                if new != old:
                    g -= part[k] * (new - old)
                    v[k] = new
            g = b[work] - part @ v
            if _gap(g, v, alpha, every) <= limit:
                break
        w = np.zeros(p)
        w[work] = v
    if _gap(b - a @ w, w, alpha, usable) <= limit:
        return w
    return _active_set(a, b, alpha, w, usable, limit)


def _gap(grad: np.ndarray, w: np.ndarray, alpha: float, usable: np.ndarray) -> float:
    """Largest violation: the gradient is alpha * sign(w) where w is used, at most alpha
    elsewhere."""
    g, v = grad[usable], w[usable]
    return np.where(v != 0, np.abs(g - alpha * np.sign(v)),
                    np.maximum(np.abs(g) - alpha, 0)).max(initial=0.0)


def _active_set(a: np.ndarray, b: np.ndarray, alpha: float, w: np.ndarray,
                usable: np.ndarray, limit: float) -> np.ndarray:
    """Solve exactly for fixed signs, stepping to where a sign would change."""
    def objective(v: np.ndarray) -> float:
        return 0.5 * v @ a @ v - b @ v + alpha * np.abs(v).sum()

    best, best_gap = w.copy(), _gap(b - a @ w, w, alpha, usable)
    for _ in range(20 * len(w) + 50):
        grad = b - a @ w
        gap = _gap(grad, w, alpha, usable)
        if gap < best_gap:
            best, best_gap = w.copy(), gap
        if gap <= limit:
            break
        used = np.flatnonzero(w)
        sign = np.sign(w)
        if not len(used) or np.abs(grad[used] - alpha * sign[used]).max() <= limit:
            rest = np.setdiff1d(usable, used)
            j = rest[np.abs(grad[rest]).argmax()]
            sign[j] = np.sign(grad[j])
            used = np.append(used, j)
        slope = b[used] - alpha * sign[used] - a[np.ix_(used, used)] @ w[used]
        value, vector = np.linalg.eigh(a[np.ix_(used, used)])
        curved = value > 1e-11 * value[-1]
        along = vector[:, curved].T @ slope
        flat = slope - vector[:, curved] @ along
        endless = np.abs(flat).max() > 10 * limit
        step = flat if endless else vector[:, curved] @ (along / value[curved])
        with np.errstate(divide="ignore", invalid="ignore"):
            at = -w[used] / step
        at = np.where((w[used] != 0) & np.isfinite(at) & (at > 0), at, np.inf)
        stops = [t for t in np.unique(at) if t < (np.inf if endless else 1.0)]
        if endless:
            stops = stops[:1]
            if not stops:
                break
        else:
            stops.append(1.0)
        moved = []
        for t in stops:
            v = w.copy()
            v[used] = w[used] + t * step
            v[used[at == t]] = 0.0
            moved.append(v)
        w = min(moved, key=objective)
    return best


def solve(kind: str, m: np.ndarray, alpha: float, shift: np.ndarray,
          start: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) in the units of the data, descending from ``start``."""
    n, mean_x, mean_y, xx, xy, _ = _centred(m)
    if kind == "ridge":
        w = _ridge(xx, xy, alpha)
    elif kind == "lasso":
        w = _lasso(xx, xy, n, alpha, start=start)
    else:
        raise ValueError(f"unknown model {kind}")
    return w, float(shift[-1] + mean_y - w @ (shift[:-1] + mean_x))


def _errors(m: np.ndarray, w: np.ndarray, b: float, shift: np.ndarray) -> tuple[float, float]:
    """(MSE, R^2) on the rows summed in ``m``."""
    v = np.concatenate([[b + w @ shift[:-1] - shift[-1]], w, [-1.0]])
    mse = max(float(v @ m @ v) / float(m[0, 0]), 0.0)
    var = float(_centred(m)[5]) / float(m[0, 0])
    return mse, (1.0 - mse / var if var > 0 else float("nan"))


@dataclass(frozen=True)
class _Problem:
    """Train on the sum of some groups' products, test on those of another."""

    train: tuple[int, ...]
    test: int | None = None


def _by_fold(sums: Products) -> dict[int, _Problem]:
    groups = sums.groups()
    return {f: _Problem(tuple(g for g in groups if g != f), f) for f in groups}


_SCORED = ("problem int, position int, alpha double, rows double, train_mse double, "
           "test_mse double, train_r2 double, test_r2 double, w array<double>, b double")


def _scored(problem: int, train: np.ndarray, test: np.ndarray | None, kind: str,
            alphas: Sequence[tuple[int, float]], shift: np.ndarray) -> Iterator[tuple]:
    """Rows of ``_SCORED``; each penalty starts from the solution of the next larger one."""
    start = None
    for position, alpha in sorted(alphas, key=lambda x: -x[1]):
        w, b = solve(kind, train, alpha, shift, start)
        start = w
        fit = _errors(train, w, b, shift)
        held = _errors(test, w, b, shift) if test is not None else (None, None)
        yield (problem, position, alpha, float(train[0, 0]), fit[0], held[0], fit[1], held[1],
               w.tolist(), b)


def _solve_all(spark: SparkSession, sums: Products, problems: Mapping[int, _Problem],
               kind: str, alphas: Sequence[float]) -> list[Any]:
    """Rows of ``_SCORED`` for every problem and penalty, solved in parallel tasks."""
    grid = list(enumerate(map(float, alphas)))
    if sums.matrices is None:
        return _solve_wide(sums, problems, kind, grid)
    shared = spark.sparkContext.broadcast((sums.shift, dict(sums.matrices)))
    jobs = spark.createDataFrame([(k, i, a) for k in problems for i, a in grid],
                                 "problem int, position int, alpha double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, matrices = shared.value
        for batch in batches:
            rows = [r for k, i, a in zip(*(batch.column(c).to_pylist() for c in range(3)))
                    for r in _scored(k, sum(matrices[g] for g in problems[k].train),
                                     matrices.get(problems[k].test), kind, [(i, a)], shift)]
            if rows:
                yield _scored_batch(rows)

    tasks = min(len(problems) * len(grid), 4 * spark.sparkContext.defaultParallelism)
    return jobs.repartition(max(1, tasks)).mapInArrow(run, _SCORED).collect()


def _scored_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.float64()] * 6, pa.list_(pa.float64()), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
        names=[c.split()[0] for c in _SCORED.split(", ")])


def _solve_wide(sums: Products, problems: Mapping[int, _Problem], kind: str,
                alphas: Sequence[tuple[int, float]]) -> list[Any]:
    """The same where matrices are blocks in the shared folder.

    The blocks of all groups meet by place and become those of every problem; the blocks of a
    problem meet in the task that solves it for all penalties.
    """
    shift, width = sums.shift, len(sums.shift) + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {}

        def out() -> Iterator[pa.RecordBatch]:
            i, j = at
            for k, problem in problems.items():
                parts = [held[g] for g in problem.train if g in held]
                found = [(2 * k, sum(parts))] if parts else []
                if problem.test in held:
                    found.append((2 * k + 1, held[problem.test]))
                yield pa.RecordBatch.from_pylist(
                    [{"g": g, "i": i, "j": j, "v": np.asarray(v).tobytes()} for g, v in found],
                    schema=_block_schema())

        for batch in batches:
            for g, i, j, v in _block_rows(batch):
                if (i, j) != at:
                    if at is not None:
                        yield from out()
                    at, held = (i, j), {}
                held[g] = v
        if at is not None:
            yield from out()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, matrices = None, [None, None]

        def out() -> pa.RecordBatch:
            if not all(np.isfinite(m).all() for m in matrices if m is not None):
                raise ValueError("features or label contain nulls or infinities")
            return _scored_batch(list(_scored(of, *matrices, kind, alphas, shift)))

        for batch in batches:
            for g, i, j, v in _block_rows(batch):
                if g >> 1 != of:
                    if of is not None and matrices[0] is not None:
                        yield out()
                    of, matrices = g >> 1, [None, None]
                if matrices[g & 1] is None:
                    matrices[g & 1] = np.zeros((width, width))
                _place(matrices[g & 1], i, j, v)
        if of is not None and matrices[0] is not None:
            yield out()

    dealt = (sums.blocks.repartition("i", "j").sortWithinPartitions("i", "j", "g")
             .mapInArrow(deal, _BLOCKS))
    by_problem = F.shiftright("g", 1)
    tasks = max(len(problems), 1)
    return (dealt.repartition(tasks, by_problem).sortWithinPartitions("g", "i", "j")
            .mapInArrow(run, _SCORED).collect())


def fit_linear(df: DataFrame, features: Sequence[str], label: str, kind: str = "ridge",
               alpha: float = 1.0, sums: Products | None = None) -> LinearModel:
    sums = sums or products(df, features, label)
    if sums.matrices is None:
        whole = {0: _Problem(tuple(sums.groups()))}
        row = _solve_all(df.sparkSession, sums, whole, kind, [alpha])[0]
        w, b, n = row["w"], row["b"], row["rows"]
    else:
        m = sums.total()
        w, b = solve(kind, m, alpha, sums.shift)
        n = m[0, 0]
    return LinearModel(kind, float(alpha), sums.features, tuple(map(float, w)), b,
                       {"train_samples": int(n), "n_features": len(w)})


def mllib_model(df: DataFrame, features: Sequence[str], label: str, kind: str = "ridge",
                alpha: float = 1.0, tol: float = 1e-12, max_iter: int = 1000) -> LinearModel:
    """The same model from MLlib, whose L2 penalty is scaled by the label's std."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    names = [f"x{i}" for i in range(len(features))]
    slim = df.select(*[col(f).cast("double").alias(n) for f, n in zip(features, names)],
                     col(label).cast("double").alias("label"))
    stats = slim.agg(F.count("label").alias("n"), F.stddev_pop("label").alias("pop"),
                     F.stddev_samp("label").alias("samp"), F.avg("label").alias("mean")).first()
    if not stats["pop"]:
        return LinearModel(kind, alpha, tuple(features), (0.0,) * len(features), stats["mean"])
    normal = kind == "ridge" and len(features) <= 4096
    penalty = (alpha * (stats["pop"] if normal else stats["samp"]) / stats["n"]
               if kind == "ridge" else alpha)
    lr = LinearRegression(
        featuresCol="features", labelCol="label", standardization=False, regParam=penalty,
        elasticNetParam=0.0 if kind == "ridge" else 1.0, tol=tol, maxIter=max_iter,
        solver="normal" if normal else "l-bfgs")
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(slim)
    fitted = lr.fit(rows.select("features", "label"))
    return LinearModel(kind, alpha, tuple(features),
                       tuple(float(x) for x in fitted.coefficients.toArray()),
                       float(fitted.intercept), {"train_samples": stats["n"]})


def grid_scores(spark: SparkSession, sums: Products, kind: str, alphas: Sequence[float]
                ) -> DataFrame:
    """(position, alpha, fold, train_mse, test_mse, train_r2, test_r2), solved in tasks."""
    rows = [(r["position"], r["alpha"], r["problem"], r["train_mse"], r["test_mse"],
             r["train_r2"], r["test_r2"])
            for r in _solve_all(spark, sums, _by_fold(sums), kind, alphas)]
    return spark.createDataFrame(
        sorted(rows), "position int, alpha double, fold int, train_mse double, "
        "test_mse double, train_r2 double, test_r2 double")


def grid_table(scores: DataFrame) -> DataFrame:
    """Mean and population std per penalty, with the rank by mean test MSE."""
    per = scores.groupBy("position", "alpha").agg(
        F.avg("test_mse").alias("mean_test_mse"), F.stddev_pop("test_mse").alias("std_test_mse"),
        F.avg("train_mse").alias("mean_train_mse"),
        F.stddev_pop("train_mse").alias("std_train_mse"))
    place = W.partitionBy(F.lit(0)).orderBy("mean_test_mse")
    return per.withColumn("rank", F.rank().over(place))


def grid_search(df: DataFrame, features: Sequence[str], label: str, fold: str,
                kind: str = "ridge", alphas: Sequence[float] | None = None,
                sums: Products | None = None) -> tuple[LinearModel, DataFrame]:
    """Best penalty by mean test MSE (the first on ties), refitted on all rows, and the
    score of every penalty and fold."""
    spark = df.sparkSession
    alphas = list(alphas or (RIDGE_ALPHAS if kind == "ridge" else LASSO_ALPHAS))
    sums = sums or products(df, features, label, col(fold))
    scores = grid_scores(spark, sums, kind, alphas)
    best = grid_table(scores).orderBy("mean_test_mse", "position").first()
    model = fit_linear(df, features, label, kind, best["alpha"], sums)
    meta = dict(model.metadata) | {
        "best_params": {"alpha": best["alpha"]}, "best_cv_score": best["mean_test_mse"]}
    return LinearModel(kind, model.alpha, model.features, model.coefficients, model.intercept,
                       meta), scores


def fold_scores(df: DataFrame, features: Sequence[str], label: str, fold: str,
                kind: str = "ridge", alpha: float = 1.0, sums: Products | None = None
                ) -> DataFrame:
    """(fold, part, mse, mae, r2): models of all folds scored in one scan."""
    sums = sums or products(df, features, label, col(fold))
    solved = sorted(_solve_all(df.sparkSession, sums, _by_fold(sums), kind, [alpha]),
                    key=lambda r: r["problem"])
    folds = [r["problem"] for r in solved]
    weights = np.array([r["w"] for r in solved])
    starts = np.array([r["b"] for r in solved])
    width = len(sums.features) + 1
    cells = df.select(F.array(*[col(c).cast("double") for c in (*sums.features, label)])
                      .alias("z"), col(fold).cast("int").alias("g"))

    def residuals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((len(folds), len(folds), 2))     # model, fold of the row, (n, |e|)
        for batch in batches:
            if not batch.num_rows:
                continue
            z = _dense(batch, "z", width)
            g = batch.column("g").to_numpy(zero_copy_only=False)
            e = np.abs(z[:, -1:] - z[:, :-1] @ weights.T - starts)
            for k, f in enumerate(folds):
                acc[:, k, 0] += (g == f).sum()
                acc[:, k, 1] += e[g == f].sum(axis=0)
        m, k = np.meshgrid(folds, folds, indexing="ij")
        yield pa.RecordBatch.from_arrays(
            [pa.array(m.ravel(), pa.int32()), pa.array((m == k).ravel()),
             pa.array(acc[:, :, 0].ravel()), pa.array(acc[:, :, 1].ravel())],
            names=["fold", "test", "n", "e"])

    mae = (cells.mapInArrow(residuals, "fold int, test boolean, n double, e double")
           .groupBy("fold", "test").agg((F.sum("e") / F.sum("n")).alias("mae")))
    rows = [(r["problem"], part == "test", part, r[f"{part}_mse"], r[f"{part}_r2"])
            for r in solved for part in ("test", "train")]
    squared = df.sparkSession.createDataFrame(
        rows, "fold int, test boolean, part string, mse double, r2 double")
    return mae.join(F.broadcast(squared), ["fold", "test"]).select(
        "fold", "part", "mse", "mae", "r2")


def cross_validate(df: DataFrame, features: Sequence[str], label: str, fold: str,
                   kind: str = "ridge", alpha: float = 1.0, sums: Products | None = None
                   ) -> DataFrame:
    """(part, mse_mean, mse_std, mae_mean, mae_std, r2_mean, r2_std), population std."""
    scores = fold_scores(df, features, label, fold, kind, alpha, sums)
    return scores.groupBy("part").agg(*[
        f(c).alias(f"{c}_{n}") for c in ("mse", "mae", "r2")
        for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def learning_curve(df: DataFrame, features: Sequence[str], label: str, subsets: str,
                   folds: int, steps: int = 10, kind: str = "ridge", alpha: float = 1.0
                   ) -> DataFrame:
    """(step, train_rows, train_rmse, train_band, val_rmse, val_band) per prefix size.

    RMSE is the root of the mean MSE over folds, the band the root of its std.
    ``subsets`` is the column made by ``learning_subsets``. One scan serves all sizes:
    a prefix is the sum of the steps up to it.
    """
    sums = products(df, features, label, held_out=col(subsets), folds=folds, steps=steps)
    there = set(sums.groups())
    problems = {}
    for f in range(folds):
        base, so_far = f * (steps + 1), []
        for s in range(1, steps + 1):
            so_far += [base + s] if base + s in there else []
            if so_far:
                problems[base + s] = _Problem(tuple(so_far), base)
    rows = [(r["problem"] // (steps + 1), r["problem"] % (steps + 1), int(r["rows"]),
             r["train_mse"], r["test_mse"])
            for r in _solve_all(df.sparkSession, sums, problems, kind, [alpha])]
    scores = df.sparkSession.createDataFrame(
        rows, "fold int, step int, rows bigint, train double, val double")
    return scores.groupBy("step").agg(
        F.min("rows").alias("train_rows"),
        F.sqrt(F.avg("train")).alias("train_rmse"),
        F.sqrt(F.stddev_pop("train")).alias("train_band"),
        F.sqrt(F.avg("val")).alias("val_rmse"), F.sqrt(F.stddev_pop("val")).alias("val_band"),
    ).orderBy("step")
