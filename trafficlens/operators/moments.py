"""Linear models from one pass of moments (M4-M6).

Everything a least-squares fit, its penalised forms, their cross-validation
and their errors need of the rows are counts, means and co-moments of the
features and the label. ``fold_moments`` takes them for every fold in one
aggregate (partial sums on the map side, one row per fold leaves it); folds
then merge by the parallel co-moment formula, and each of the settings x folds
fits is the solution of a system as wide as the features, on the driver. The
reference, like Spark's ``CrossValidator``, reads the training rows once or
more for each of them.

Co-moments are taken about the means (``covar_pop``), not as raw products, so
large byte counts do not cancel.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col

MOST_FEATURES = 64  # the aggregate has a column for each pair of features


@dataclass(frozen=True)
class Moments:
    """Count, means and co-moments (sums of products about the means) of the
    features and, last, the label."""

    n: int
    mean: np.ndarray
    comoment: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        step = other.mean - self.mean
        mean = self.mean + step * (other.n / n)
        comoment = self.comoment + other.comoment + np.outer(step, step) * (self.n * other.n / n)
        return Moments(n, mean, comoment)

    @staticmethod
    def none(width: int) -> Moments:
        return Moments(0, np.zeros(width), np.zeros((width, width)))


def fold_moments(df: DataFrame, features: Sequence[str], label: str = "label", group: str | None = None) -> DataFrame:
    """``group, n, mean, comoment``: one row per group (or one row of null
    group), ``mean`` over the features and the label, ``comoment`` the upper
    triangle by rows. Rows with a null in any of these columns are left out."""
    if len(features) > MOST_FEATURES:
        raise ValueError(f"at most {MOST_FEATURES} features")
    names = [*features, label]
    rows = df.select(
        (col(group) if group else F.lit(None).cast("int")).alias("group"),
        *[col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)],
    ).dropna(subset=[f"v{i}" for i in range(len(names))])
    n = F.count(F.lit(1))
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    return rows.groupBy("group").agg(
        n.alias("n"),
        F.array(*[F.avg(f"v{i}") for i in range(len(names))]).alias("mean"),
        F.array(*[(F.var_pop(f"v{i}") if i == j else F.covar_pop(f"v{i}", f"v{j}")) * n for i, j in pairs]).alias("comoment"),
    )


def collect_moments(moments: DataFrame) -> dict[object, Moments]:
    """Moments by group; as many numbers as groups x features squared."""
    out = {}
    for r in moments.toLocalIterator():
        width = len(r.mean)
        full = np.zeros((width, width))
        full[np.triu_indices(width)] = r.comoment
        out[r.group] = Moments(r.n, np.array(r.mean), full + np.triu(full, 1).T)
    return out


def ridge(m: Moments, reg: float = 0.0, intercept: bool = True) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the penalised least squares that Spark's
    ``LinearRegression`` minimises: the penalty applies to features and label
    in units of their standard deviation. A feature without variance gets 0;
    of linearly dependent features without a penalty the shortest solution."""
    p = len(m.mean) - 1
    if not m.n:
        raise ValueError("no rows to fit")
    cov = m.comoment / m.n
    spread = np.diag(cov).copy()
    square = cov if intercept else cov + np.outer(m.mean, m.mean)
    a, b = square[:p, :p].copy(), square[:p, p]
    if intercept and spread[p] == 0:
        return np.zeros(p), float(m.mean[p])
    unit = np.sqrt(spread[p]) if spread[p] > 0 else abs(m.mean[p]) or 1.0
    a[np.diag_indices(p)] += reg / unit * spread[:p]
    scale = np.sqrt(np.where(spread[:p] > 0, spread[:p], 1.0))
    used = spread[:p] > 0 if intercept else np.diag(square)[:p] > 0
    w = np.zeros(p)
    if used.any():
        # solved in units of the standard deviations, for well-conditioned systems
        scaled = a[np.ix_(used, used)] / np.outer(scale[used], scale[used])
        w[used] = np.linalg.lstsq(scaled, b[used] / scale[used], rcond=1e-13)[0] / scale[used]
    return w, float(m.mean[p] - w @ m.mean[:p]) if intercept else 0.0


def errors(m: Moments, w: np.ndarray, b: float) -> dict[str, float]:
    """MSE, RMSE and r2 of a linear model on the rows of ``m``, from the moments alone."""
    p = len(w)
    bias = m.mean[p] - b - w @ m.mean[:p]
    cov = m.comoment / m.n
    mse = max(0.0, float(cov[p, p] - 2 * w @ cov[:p, p] + w @ cov[:p, :p] @ w + bias * bias))
    return {"mse": mse, "rmse": float(np.sqrt(mse)), "r2": float(1 - mse / cov[p, p]) if cov[p, p] > 0 else float("nan")}


@dataclass(frozen=True)
class LinearFit:
    """A linear model; ``predict`` is a plain column expression."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    reg: float
    fit_intercept: bool
    n: int
    training: dict[str, float] = field(default_factory=dict)

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        total = F.lit(self.intercept)
        for name, w in zip(self.features, self.coefficients):
            total = total + col(name).cast("double") * F.lit(w)
        return df.withColumn(out, total)

    def table(self, spark: SparkSession) -> DataFrame:
        """``term, value``: a row per coefficient and one for the intercept."""
        rows = [*zip(self.features, self.coefficients), ("(intercept)", self.intercept)]
        return spark.createDataFrame([(t, float(v)) for t, v in rows], "term string, value double")


def fit_moments(m: Moments, features: Sequence[str], reg: float = 0.0, intercept: bool = True) -> LinearFit:
    w, b = ridge(m, reg, intercept)
    return LinearFit(tuple(features), tuple(map(float, w)), b, float(reg), bool(intercept), m.n, errors(m, w, b))


def fit_linear_once(df: DataFrame, features: Sequence[str], label: str = "label", reg: float = 0.0, intercept: bool = True) -> LinearFit:
    """Least squares from one aggregate over the rows (M4); equals ``models.fit_linear``."""
    groups = collect_moments(fold_moments(df, features, label))
    return fit_moments(reduce(Moments.__add__, groups.values(), Moments.none(len(features) + 1)), features, reg, intercept)


@dataclass(frozen=True)
class LinearCv:
    """``grid``: a row (reg, fit_intercept, fold, n, rmse) for each fit; ``best``
    the setting with the least mean RMSE, fitted on all folds."""

    grid: tuple[tuple[float, bool, int, int, float], ...]
    best: LinearFit

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.grid), "reg double, fit_intercept boolean, fold int, n bigint, rmse double")

    def averages(self, spark: SparkSession) -> DataFrame:
        """``reg, fit_intercept, avg_rmse``, as ``CrossValidatorModel.avgMetrics``."""
        return self.table(spark).groupBy("reg", "fit_intercept").agg(F.avg("rmse").alias("avg_rmse"))


def cross_validate_linear(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    fold: str = "fold",
    reg: Iterable[float] = (0.1, 0.01),
    intercept: Iterable[bool] = (True, False),
) -> LinearCv:
    """Cross-validation of all settings from one aggregate over the rows (M6).

    For every fold the other folds' moments are merged and solved for each
    setting, and the held-out error follows from the fold's own moments; no
    row is read again. Equals ``models.fit_linear_cv`` on the same folds, ties
    to the earlier setting as there. Rows without a fold are left out; a fold
    without rows does not count.
    """
    by_fold = {k: m for k, m in collect_moments(fold_moments(df, features, label, fold)).items() if k is not None}
    if len(by_fold) < 2:
        raise ValueError("cross-validation needs rows in two folds at least")
    empty = Moments.none(len(features) + 1)
    rest = {f: reduce(Moments.__add__, (by_fold[g] for g in sorted(by_fold) if g != f), empty) for f in by_fold}
    settings = [(float(r), bool(i)) for r in reg for i in intercept]
    grid, mean = [], {}
    for r, i in settings:
        rmses = [errors(by_fold[f], *ridge(rest[f], r, i))["rmse"] for f in sorted(by_fold)]
        grid += [(r, i, int(f), by_fold[f].n, e) for f, e in zip(sorted(by_fold), rmses)]
        mean[r, i] = float(np.mean(rmses))
    best = min(settings, key=mean.__getitem__)
    everything = reduce(Moments.__add__, (by_fold[f] for f in sorted(by_fold)), empty)
    return LinearCv(tuple(grid), fit_moments(everything, features, *best))
