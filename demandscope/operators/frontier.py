"""Stochastic frontier with half-normal inefficiency, fitted by distributed maximum likelihood.

Rows stay on the executors, packed so that what repeats from row to row is kept once: each evaluation adds up value and gradient in partitions and then by
component, so the driver sees a few dozen numbers whatever the data. Columns that depend on each other are handled by the pseudo-inverse of the Gram matrix; the search runs in
coordinates in which that matrix is the identity.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import log_normal_cdf, log_normal_cdf_udf, ratio
from .features import PROXIES

INTERCEPT = "Intercept"
LOG_SIGMA_START = 0.1
STILL = 0.1  # share of rows at which columns kept by stretches may change


@dataclass(frozen=True)
class Frontier:
    """Fitted parameters. Coefficients of columns that depend on each other aren't identified; predictions are."""

    features: tuple[str, ...]
    beta: tuple[float, ...]
    sigma_u: float
    sigma_v: float

    def log_frontier(self) -> Column:
        terms = [F.lit(b) if f == INTERCEPT else F.col(f).cast("double") * F.lit(b) for f, b in zip(self.features, self.beta, strict=True)]
        out = F.lit(0.0)
        for t in terms:
            out = out + t
        return out

    def potential(self) -> Column:
        return F.exp(self.log_frontier()) * F.lit(math.exp(0.5 * self.sigma_v**2))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row a parameter: (position, name, value)."""
        rows = [(k, f, b) for k, (f, b) in enumerate(zip(self.features, self.beta, strict=True))]
        rows += [(-1, "sigma_u", self.sigma_u), (-2, "sigma_v", self.sigma_v)]
        spark.createDataFrame(rows, "position int, name string, value double").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Frontier:
        rows = {r.position: r for r in spark.read.parquet(path).collect()}  # one row a parameter
        k = sorted(p for p in rows if p >= 0)
        return Frontier(tuple(rows[i].name for i in k), tuple(rows[i].value for i in k), rows[-1].value, rows[-2].value)


def log_likelihood(eps: np.ndarray, sigma_u: float, sigma_v: float) -> np.ndarray:
    """Log-likelihood of each residual."""
    sigma = math.hypot(sigma_u, sigma_v)
    z = eps / sigma
    return math.log(2 / sigma) - 0.5 * math.log(2 * math.pi) - 0.5 * z * z + log_normal_cdf(-z * sigma_u / sigma_v)


def value_and_gradient(x: np.ndarray | Packed, y: np.ndarray, beta: np.ndarray, log_u: float, log_v: float) -> np.ndarray:
    """Sum of log-likelihoods, its gradient in beta and the two logarithms, and the number of rows."""
    su, sv = math.exp(log_u), math.exp(log_v)
    s2 = su * su + sv * sv
    sigma, pu, pv, lam = math.sqrt(s2), su * su / s2, sv * sv / s2, su / sv
    z = (y - x @ beta) / sigma
    w = -z * lam
    log_cdf = log_normal_cdf(w)
    h = np.exp(-0.5 * w * w - 0.5 * math.log(2 * math.pi) - log_cdf)
    value = len(y) * (math.log(2 / sigma) - 0.5 * math.log(2 * math.pi)) + (log_cdf - 0.5 * z * z).sum()
    each = (z + h * lam) / sigma
    g = x.transposed(each) if isinstance(x, Packed) else x.T @ each
    gu = (z * z * pu - pu + h * w * pv).sum()
    gv = (z * z * pv - pv - h * w * (1 + pv)).sum()
    return np.concatenate([[value], g, [gu, gv, len(y)]])


class Packed:
    """The design of a batch of rows, each the sum of one row of ``slow`` and one of ``fast``, which are far fewer where rows repeat an outlet's columns.

    Columns that change at few of the rows stand in ``slow``, a row for each stretch; the combinations of the others in ``fast``. Nothing is lost: ``dense`` gives the rows back.
    """

    def __init__(self, slow: np.ndarray, stretch: np.ndarray, fast: np.ndarray, kind: np.ndarray, y: np.ndarray) -> None:
        self.slow, self.stretch, self.fast, self.kind, self.y = slow, stretch, fast, kind, y

    @staticmethod
    def of(x: np.ndarray, y: np.ndarray) -> Packed:
        changes = x[1:] != x[:-1]
        order = np.argsort(changes.sum(axis=0), kind="stable")
        together = np.logical_or.accumulate(changes[:, order], axis=1).sum(axis=0)
        still = np.zeros(x.shape[1], bool)
        still[order[together <= len(x) * STILL]] = True
        new = np.concatenate([[True], changes[:, still].any(axis=1)])
        slow, fast = np.where(still, x, 0.0)[new], np.ascontiguousarray(np.where(still, 0.0, x) + 0.0)
        _, first, kind = np.unique(fast.view(f"V{fast.shape[1] * 8}").ravel(), return_index=True, return_inverse=True)
        return Packed(slow, (np.cumsum(new) - 1).astype(np.int32), fast[first], kind.ravel().astype(np.int32), y)

    def dense(self) -> np.ndarray:
        return self.slow[self.stretch] + self.fast[self.kind]

    def __len__(self) -> int:
        return len(self.y)

    def __matmul__(self, beta: np.ndarray) -> np.ndarray:
        return (self.slow @ beta)[self.stretch] + (self.fast @ beta)[self.kind]

    def transposed(self, g: np.ndarray) -> np.ndarray:
        """``x.T @ g``."""
        return np.bincount(self.stretch, g, len(self.slow)) @ self.slow + np.bincount(self.kind, g, len(self.fast)) @ self.fast

    def moments(self) -> np.ndarray:
        """x.T @ x, x.T @ y and the number of rows, in one vector."""
        x = self.dense()
        return np.concatenate([(x.T @ x).ravel(), x.T @ self.y, [len(x)]])

    def arrays(self) -> list[np.ndarray]:
        return [self.slow, self.stretch, self.fast, self.kind, self.y]


def pack(data: DataFrame) -> DataFrame:
    """Batches of (x, y) as ``Packed``, a row a batch, its arrays as bytes."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                p = Packed.of(x, b.column(1).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]]), *[pa.array([a.tobytes()], pa.large_binary()).cast(pa.binary()) for a in p.arrays()]], names=["k", "slow", "stretch", "fast", "kind", "y"])

    return data.mapInArrow(run, "k long, slow binary, stretch binary, fast binary, kind binary, y binary")


def _sums(packed: DataFrame, size: int, part) -> np.ndarray:
    """Adds the vectors that ``part(Packed)`` makes of batches: partial sums in tasks, then by component."""

    def run(batches):
        total = np.zeros(size)
        for b in batches:
            for k, *raw in zip(*[b.column(i).to_pylist() for i in range(6)], strict=True):
                slow, stretch, fast, kind, y = (np.frombuffer(r, d) for r, d in zip(raw, ("f8", "i4", "f8", "i4", "f8"), strict=True))
                total += part(Packed(slow.reshape(-1, k), stretch, fast.reshape(-1, k), kind, y))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["k", "v"])

    rows = packed.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()  # size rows
    out = np.zeros(size)
    for r in rows:
        out[r.k] = r.v
    return out


def design(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(x, y) of rows without missing values."""
    x = F.array(*[F.lit(1.0) if f == INTERCEPT else F.col(f).cast("double") for f in features])
    return df.select(x.alias("x"), F.col(target).cast("double").alias("y")).where(F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull()))


def fit(df: DataFrame, features: Sequence[str], target: str = "ln_volume", most: int = 200, tolerance: float = 1e-6) -> Frontier:
    """Maximum likelihood from least squares, with log-sigmas from 0.1; raises if it doesn't converge, or without rows."""
    names = tuple(features) if INTERCEPT in features else (*features, INTERCEPT)
    k = len(names)
    data = pack(design(df, names, target)).persist()
    try:
        g = _sums(data, k * k + k + 1, Packed.moments)
        n = g[-1]
        if not n:
            raise ValueError("no rows to fit")
        gram, xy = g[: k * k].reshape(k, k), g[k * k : -1]
        scale = np.sqrt(np.maximum(np.diag(gram), 1e-300) / n)
        values, vectors = np.linalg.eigh(gram / n / np.outer(scale, scale))
        real = values > values.max() * 1e-10
        # beta = back @ theta, and the Gram matrix of theta is n times the identity
        back = (vectors[:, real] / np.sqrt(values[real])) / scale[:, None]
        theta = back.T @ xy / n

        def objective(p: np.ndarray) -> tuple[float, np.ndarray]:
            beta, lu, lv = back @ p[:-2], float(p[-2]), float(p[-1])
            got = _sums(data, k + 4, lambda x: value_and_gradient(x, x.y, beta, lu, lv))
            return -got[0] / n, -np.concatenate([back.T @ got[1 : k + 1], got[k + 1 : k + 3]]) / n

        p = lbfgs(objective, np.concatenate([theta, [LOG_SIGMA_START, LOG_SIGMA_START]]), most, tolerance)
        beta = back @ p[:-2]
        return Frontier(names, tuple(beta.tolist()), math.exp(p[-2]), math.exp(p[-1]))
    finally:
        data.unpersist()


def lbfgs(objective, start: np.ndarray, most: int, tolerance: float, memory: int = 10) -> np.ndarray:
    """Limited-memory quasi-Newton minimisation with a backtracking step.

    It ends where the gradient is below ``tolerance``, or where a step improves the value by less than a billionth of it, whatever the gradient; it raises
    RuntimeError where no step lowers the value although the gradient is large, and after ``most`` steps.
    """
    p = start
    value, g = objective(p)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(most):
        if np.abs(g).max() < tolerance:
            return p
        q, kept = g.copy(), []
        for s, t in reversed(steps):
            a = (s @ q) / (t @ s)
            kept.append(a)
            q -= a * t
        if steps:
            s, t = steps[-1]
            q *= (s @ t) / (t @ t)
        for (s, t), a in zip(steps, reversed(kept), strict=True):
            q += (a - (t @ q) / (t @ s)) * s
        way = -q
        if way @ g >= 0:
            way, steps = -g, []
        # log-sigmas move by at most one at once, so that the likelihood stays finite
        size = min(1.0, 1.0 / max(np.abs(way[-2:]).max(), 1e-12)) if steps else min(1.0, 1.0 / np.abs(way).max())
        while True:
            new = p + size * way
            v, ng = objective(new)
            if np.isfinite(v) and v <= value + 1e-4 * size * (way @ g):
                break
            size /= 2
            if size < 1e-10:
                if np.abs(g).max() < 1e3 * tolerance:
                    return p
                raise RuntimeError("no step lowers the objective")
        if (new - p) @ (ng - g) > 1e-14:
            steps = [*steps[1 - memory :], (new - p, ng - g)]
        done = value - v <= 1e-9 * max(1.0, abs(v))
        p, value, g = new, v, ng
        if done:
            return p
    raise RuntimeError("the fit didn't converge")


def likelihood_terms(df: DataFrame, model: Frontier, target: str = "ln_volume") -> DataFrame:
    """``df`` with each row's residual and log-likelihood."""
    sigma = math.hypot(model.sigma_u, model.sigma_v)
    eps = F.col(target) - model.log_frontier()
    z = F.col("residual") / F.lit(sigma)
    head = math.log(2 / sigma) - 0.5 * math.log(2 * math.pi)
    tail = log_normal_cdf_udf(-z * F.lit(model.sigma_u / model.sigma_v))
    return df.withColumn("residual", eps).withColumn("log_likelihood", F.lit(head) - z * z * F.lit(0.5) + tail)


def score(df: DataFrame, model: Frontier, actual: str = "Volume_Liters") -> DataFrame:
    """Adds Potential_Volume and Efficiency_Score (actual over potential, which luck can carry above 1)."""
    return df.withColumn("Potential_Volume", model.potential()).withColumn("Efficiency_Score", ratio(F.col(actual), F.col("Potential_Volume")))


def outlet_report(scored: DataFrame) -> DataFrame:
    """Per outlet: means of volume, potential, efficiency and the proxies."""
    means = {"Avg_Monthly_Volume": "Volume_Liters", "Potential_Volume": "Potential_Volume", "Efficiency_Score": "Efficiency_Score", **{p: p for p in PROXIES}}
    return scored.groupBy("Outlet_ID").agg(*[F.avg(c).alias(n) for n, c in means.items()])


def efficiency_correlation(report: DataFrame, columns: Sequence[str] = PROXIES, against: str = "Efficiency_Score") -> DataFrame:
    """(proxy, correlation): Pearson, over rows where both are there. One pass."""
    wide = report.agg(*[F.corr(against, c).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "proxy", "correlation")


def ranked_coefficients(spark: SparkSession, model: Frontier) -> DataFrame:
    """(feature, beta, rank) by size of the coefficient; rows are parameters."""
    rows = sorted(zip(model.features, model.beta, strict=True), key=lambda x: (-abs(x[1]), x[0]))
    return spark.createDataFrame([(f, b, k) for k, (f, b) in enumerate(rows, 1)], "feature string, beta double, rank int")


def variance_summary(model: Frontier) -> dict[str, float]:
    return {"sigma_u": model.sigma_u, "sigma_v": model.sigma_v, "sigma2": model.sigma_u**2 + model.sigma_v**2, "lambda": model.sigma_u / model.sigma_v}
