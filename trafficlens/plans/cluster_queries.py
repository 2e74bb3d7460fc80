"""Registered queries on clustering users: coresets, sweeps, checks of fits."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ..functions.columns import col
from ..operators import coreset as CS
from ..operators import models as M
from ..operators import quantile_ranges as QR
from ..sources.tables import materialize
from .queries import GAP_6H, KMEANS_K, KMEANS_SWEEP, RANGED, USER_FEATURES, Query, _filled_users, _fixed_groups, _user_features, rounded

CORESET = 60  # expected users of a coreset, fewer than there are


def _users(spark, sf):
    return materialize(_filled_users(_user_features(spark, sf, GAP_6H)), name="users")


def _by_device(spark, sf, make):
    """``make(device, its users)`` for each device, as one table."""
    users = _users(spark, sf)
    parts = [make(dev, users.where(col("device") == dev)) for dev in KMEANS_K]
    return parts[0].unionByName(parts[1])


def q_kmeans_coreset(spark, sf):
    """The weighted rows that stand for all users of a device."""
    kept = lambda dev, part: CS.kmeans_coreset(part, USER_FEATURES, "cl_ip", CORESET).select("device", "cl_ip", "weight")
    return rounded(_by_device(spark, sf, kept))


def q_kmeans_coreset_sweep(spark, sf):
    """True cost of every k, fitted on coresets, and whether it is the knee."""

    def sweep(dev, part):
        found = CS.coreset_sweep(part, USER_FEATURES, "cl_ip", KMEANS_SWEEP[dev])
        return found.table(spark).select(F.lit(dev).alias("device"), "k", "wssse", (col("k") == found.knee()).alias("is_knee"))

    return rounded(_by_device(spark, sf, sweep))


def q_kmeans_mean_check(spark, sf):
    """Clusters whose centre is not the mean of their members, that have no
    member, or that share their centre with another: a fit that ran until
    nothing moved has none (M12)."""

    def check(dev, part):
        feats = M.assemble(part, USER_FEATURES)
        model = M.fit_kmeans(feats, KMEANS_K[dev], max_iter=300)
        rows = [(i, *map(float, c)) for i, c in enumerate(model.clusterCenters())]
        centres = spark.createDataFrame(rows, "prediction int, " + ", ".join(f"c{i} double" for i in range(len(USER_FEATURES))))
        means = M.score(model, feats).groupBy("prediction").agg(F.count(F.lit(1)).alias("users"), *[F.avg(f).alias(f"m{i}") for i, f in enumerate(USER_FEATURES)])
        off = F.lit(False)
        for i in range(len(USER_FEATURES)):
            off = off | (F.abs(col(f"c{i}") - col(f"m{i}")) > F.lit(1e-3) * F.greatest(F.lit(1.0), F.abs(f"m{i}")))
        both = centres.join(means, "prediction", "left")
        place = F.concat_ws(",", *[col(f"c{i}").cast("string") for i in range(len(USER_FEATURES))])
        return both.agg(
            F.lit(dev).alias("device"),
            F.sum("users").alias("n"),
            (F.count_if(F.coalesce(off, F.lit(True))) + F.count(F.lit(1)) - F.count_distinct(place)).alias("violations"),
        )

    return _by_device(spark, sf, check)


def q_kmeans_cost_recomputed(spark, sf):
    """Values of k whose swept cost is not the sum of squared distances to the
    nearest of the fitted centres, computed by SQL functions over all users (M13, M14)."""
    users = _users(spark, sf)
    checked = []
    with ThreadPoolExecutor(max_workers=2) as pool:
        sweeps = pool.map(lambda d: CS.coreset_sweep(users.where(col("device") == d), USER_FEATURES, "cl_ip", KMEANS_SWEEP[d], size=CORESET), KMEANS_K)
    for dev, sweep in zip(KMEANS_K, sweeps):
        near = [
            F.sum(F.least(*[sum((F.pow(col(f) - F.lit(float(x)), 2) for f, x in zip(USER_FEATURES, c)), F.lit(0.0)) for c in centres]))
            for _, centres in sorted(sweep.centres.items())
        ]
        off = [(F.abs(s - F.lit(sweep.costs[k])) > F.lit(1e-9) * s).cast("bigint") for s, k in zip(near, sorted(sweep.costs))]
        row = users.where(col("device") == dev).agg(F.lit(dev).alias("device"), F.count(F.lit(1)).alias("n"), sum(off[1:], off[0]).alias("violations"))
        checked.append(row)
    return checked[0].unionByName(checked[1])


def q_quantile_ranges(spark, sf):
    """Users of each fixed group, and how many of its four range ends have a
    rank more than three points and one user from 10 or 90 per cent (M15)."""
    users = materialize(_fixed_groups(spark, sf, GAP_6H), name="grouped-users")
    keys = ["device", "grp"]
    both = QR.quantile_interval(users, RANGED, keys, 0.1, 0.9)
    off = F.lit(0)
    for v in RANGED:
        n = F.count(F.lit(1))
        # the rank of an end lies between the shares of users below it and up to it
        for end, rank in (("lo", 0.1), ("hi", 0.9)):
            under, up_to = (F.avg(c.cast("double")) for c in (col(v) < col(f"{v}_{end}"), col(v) <= col(f"{v}_{end}")))
            off = off + F.when((under > rank + 0.03 + 1 / n) | (up_to < rank - 0.03 - 1 / n), 1).otherwise(0)
    return both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), off.cast("bigint").alias("violations"))


QUERIES: dict[str, Query] = {
    "quantile_ranges": q_quantile_ranges,
    "kmeans_coreset": q_kmeans_coreset,
    "kmeans_coreset_sweep": q_kmeans_coreset_sweep,
    "kmeans_mean_check": q_kmeans_mean_check,
    "kmeans_cost_recomputed": q_kmeans_cost_recomputed,
}
