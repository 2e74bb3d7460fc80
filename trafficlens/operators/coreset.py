"""K-means for many k on a weighted coreset.

``kmeans_sweep`` fits every k on all rows. Here one pass takes means and
spread, a second keeps each row with a probability that grows with its squared
distance from the mean (half of it uniform) and gives it the inverse as weight,
so sums over the kept rows estimate sums over all; their number is bounded in
expectation whatever the table's size. Every k is fitted on them, and one more
pass over all rows takes the true cost of all fitted models together: three
passes, however many k.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col

SIZE = 20_000  # expected rows of a coreset


def uniform(key: str, salt: str = "coreset"):
    """A number in [0, 1) from the md5 of the key, the same on every run."""
    text = F.concat(F.lit(f"{salt}:"), F.coalesce(col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def kmeans_coreset(df: DataFrame, features: Sequence[str], key: str, size: int = SIZE) -> DataFrame:
    """Rows of ``df`` with a ``weight``: about ``size`` of them, or all of a
    smaller table. Rows with a null feature are left out. ``key`` should tell
    rows apart: rows of one key are kept or dropped together."""
    known = df.dropna(subset=list(features))
    spread = sum((F.var_pop(f) for f in features), F.lit(0.0))
    stats = known.agg(F.count(F.lit(1)).alias("n"), spread.alias("var"), *[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)]).first()
    if not stats.n:
        return known.withColumn("weight", F.lit(1.0))
    far = sum((F.pow(col(f) - F.lit(float(stats[f"m{i}"])), 2) for i, f in enumerate(features)), F.lit(0.0))
    share = F.lit(0.5 / stats.n) + (far / F.lit(2.0 * stats.var * stats.n) if stats.var > 0 else F.lit(0.5 / stats.n))
    kept = F.least(F.lit(1.0), F.lit(float(size)) * share)
    return known.withColumn("weight", 1 / kept).where(uniform(key) < kept)


@dataclass(frozen=True)
class Sweep:
    """Centres and true cost by k."""

    centres: dict[int, np.ndarray]
    costs: dict[int, float]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(k, float(c)) for k, c in sorted(self.costs.items())], "k int, wssse double")

    def knee(self) -> int:
        """The k whose cost lies farthest below the line from the first to the
        last one, both axes scaled to their ranges; the smaller k of equals."""
        ks = sorted(self.costs)
        cost = np.array([self.costs[k] for k in ks])
        if len(ks) < 3 or cost[0] <= cost[-1]:
            return ks[0]
        x = (np.array(ks, float) - ks[0]) / (ks[-1] - ks[0])
        return ks[int(np.argmax(1 - x - (cost - cost[-1]) / (cost[0] - cost[-1])))]


def cost_of_all(df: DataFrame, features: Sequence[str], centres: dict[int, np.ndarray]) -> dict[int, float]:
    """Sum of squared distances to the nearest centre for every set of centres,
    in one pass; a task sends one row per set."""
    shared = df.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(shared.value, 0.0)
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns])
                for k, c in shared.value.items():
                    total[k] += float(((x[:, None, :] - c[None]) ** 2).sum(axis=2).min(axis=1).sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.float64())], names=["k", "cost"])

    narrow = df.dropna(subset=list(features)).select(*[col(f).cast("double") for f in features])
    sums = narrow.mapInArrow(run, "k int, cost double").groupBy("k").agg(F.sum("cost").alias("cost"))
    return {r.k: r.cost for r in sums.collect()}  # one row per k


def weighted_kmeans(x: np.ndarray, weight: np.ndarray, k: int, seed: int, rounds: int = 100) -> tuple[np.ndarray, float]:
    """Centres and cost of weighted points: k-means++ seeds (plain for even
    ``seed``, the best of several draws for odd), then Lloyd rounds until the
    cost stands still. A cluster that loses all its points moves to the point
    that is farthest off."""
    rng = np.random.default_rng(seed)
    distance = lambda c: ((x - c) ** 2).sum(axis=1)
    centres = [x[rng.choice(len(x), p=weight / weight.sum())]]
    near = distance(centres[0])
    while len(centres) < k and (near * weight).sum() > 0:
        tries = rng.choice(len(x), 1 if seed % 2 == 0 else 2 + int(np.log(k)), p=near * weight / (near * weight).sum())
        options = [np.minimum(near, distance(x[t])) for t in tries]
        best = int(np.argmin([(o * weight).sum() for o in options]))
        centres.append(x[tries[best]])
        near = options[best]
    c, last = np.array(centres), np.inf
    for _ in range(rounds):
        to = np.stack([distance(p) for p in c], axis=1)
        own = to.argmin(axis=1)
        near = to[np.arange(len(x)), own]
        cost = float((near * weight).sum())
        if cost >= last * (1 - 1e-9):
            break
        last = cost
        mass = np.bincount(own, weight, len(c))
        sums = np.stack([np.bincount(own, weight * x[:, d], len(c)) for d in range(x.shape[1])], axis=1)
        c = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-300)[:, None], x[near.argmax()])
    return c, last


def coreset_sweep(
    df: DataFrame, features: Sequence[str], key: str, ks: Iterable[int] = range(4, 12), size: int = SIZE, starts: int = 24, finalists: int = 3, seed: int = 1
) -> Sweep:
    """Centres and cost over all rows for each k, fitted on a coreset of about
    ``size`` rows from ``starts`` seeds each; the cost over all rows chooses among
    the ``finalists`` best of them (M14). The coreset is
    broadcast (``size`` rows bound it) and the fits, one for each k and seed,
    are dealt to tasks. With fewer different rows than k there are fewer centres."""
    spark = df.sparkSession
    few = kmeans_coreset(df, features, key, size).select(*[col(f).cast("double") for f in features], "weight").toPandas().to_numpy(float)
    if not len(few):
        raise ValueError("no rows to cluster")
    few = few[np.lexsort(few.T)]  # the same order on any partitioning
    shared = spark.sparkContext.broadcast(few)
    tasks = [(int(k), s) for k in sorted(set(map(int, ks))) for s in range(starts)]

    def fit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, weight = shared.value[:, :-1], shared.value[:, -1]
        for part in parts:
            made = [weighted_kmeans(x, weight, k, seed + s) for k, s in zip(part["k"], part["start"])]
            yield part.assign(cost=[m[1] for m in made], centres=[m[0].ravel().tolist() for m in made])

    grid = spark.createDataFrame(tasks, "k int, start int").repartition(len(tasks))
    fits = grid.mapInPandas(fit, "k int, start int, cost double, centres array<double>").collect()
    sets: dict[int, np.ndarray] = {}
    for k in {k for k, _ in tasks}:
        # the best few by their cost on the coreset; the true cost decides between them
        own = sorted((r for r in fits if r.k == k), key=lambda r: (r.cost, r.start))
        different = {round(r.cost, 9): r for r in reversed(own)}
        for r in sorted(different.values(), key=lambda r: r.cost)[:finalists]:
            sets[k * starts + r.start] = np.array(r.centres).reshape(-1, len(features))
    costs = cost_of_all(df, features, sets)
    best = {k: min((i for i in sets if i // starts == k), key=lambda i: costs[i]) for k, _ in tasks}
    return Sweep({k: sets[i] for k, i in best.items()}, {k: costs[i] for k, i in best.items()})
