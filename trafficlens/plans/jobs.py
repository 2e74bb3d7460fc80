"""The four batch jobs a user of the reference runs, as compositions of the operators.

Each job reads a path, writes its tables under an output folder with the
given save mode, and returns the paths it wrote. They hand over through
parquet exactly like the reference's programs: raw text -> parsed hits ->
session log -> {load forecasting, user clustering}.

    python -m trafficlens.plans.jobs parse    <log text path> <out>
    python -m trafficlens.plans.jobs sessions <hits parquet>  <out>
    python -m trafficlens.plans.jobs load     <hits parquet>  <out>
    python -m trafficlens.plans.jobs users    <session log>   <out>
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import MOBILE, WEB, col, epoch_seconds
from ..operators import devices as D
from ..operators import load as L
from ..operators import models as M
from ..operators import moments as MO
from ..operators import sessions as S
from ..operators import stats as ST
from ..sources import logs
from ..sources.tables import cache, read_table, write_table

LOAD_FEATURES = L.FEATURE_COLUMNS
USER_FEATURES = ["avg_rqpt", "avg_recb", "ct_url", "session_secs"]
RANGES = ["session_secs_lo", "session_secs_hi", "ct_url_lo", "ct_url_hi"]


def _out(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def parse_job(
    spark: SparkSession,
    lines_path: str,
    out: str,
    mode: str = "errorifexists",
    parse_mode: str = "lenient",
    write_rejects: bool = True,
) -> dict:
    """Raw log text -> typed hits table; unmatched lines kept aside.

    Hits and rejects are the two halves of one parsed frame (``is_valid``),
    so they agree as long as the input does not change between the two
    writes. Each output is one scan of the text; with ``write_rejects=False``
    (CLI ``--no-rejects``) the job scans once.
    """
    parsed = logs.transform_log(
        logs.parse_access_log(logs.read_lines(spark, lines_path), mode=parse_mode, keep=["value"]), mode=parse_mode
    )
    paths = {"hits": write_table(parsed.where("is_valid").drop("is_valid", "value"), _out(out, "hits"), mode)}
    if write_rejects:
        paths["rejects"] = write_table(parsed.where(~col("is_valid")).select("value"), _out(out, "rejects"), mode)
    return paths


def sessions_job(
    spark: SparkSession, hits_path: str, out: str, mode: str = "errorifexists", gap_secs: int = 900, k: int = 100
) -> dict:
    """Session log, session lengths, distinct URLs per session, engaged users."""
    hits = read_table(spark, hits_path)
    log_path = write_table(S.sessionize(hits, gap_secs=gap_secs), _out(out, "session_log"), mode)
    sessions = S.session_table(read_table(spark, log_path))  # the plan is cut at the written log
    paths = {"session_log": log_path}
    paths["sessions"] = write_table(sessions, _out(out, "sessions"), mode)
    paths["avg_session_length"] = write_table(S.avg_session_length(sessions), _out(out, "avg_session_length"), mode)
    paths["avg_urls_per_session"] = write_table(
        S.avg_urls_per_session(sessions), _out(out, "avg_urls_per_session"), mode
    )
    paths["engaged_users"] = write_table(S.engaged_users(sessions), _out(out, "engaged_users"), mode)
    paths["top_users"] = write_table(S.top_users(sessions, k=k), _out(out, "top_users"), mode)
    return paths


def _metrics_row(name: str, scored: DataFrame) -> DataFrame:
    return ST.regression_metrics(scored).select(F.lit(name).alias("model"), "*")


def load_job(
    spark: SparkSession,
    hits_path: str,
    out: str,
    mode: str = "errorifexists",
    unit: str = "second",
    holdout: str = "5 minutes",
    lags: int = 6,
) -> dict:
    """Load features, holdout cut, linear (plain and CV) and tree models with
    their test metrics, lag correlations and the moving-average forecast."""
    hits = read_table(spark, hits_path)
    feats_path = write_table(
        L.add_next(L.load_features(hits, unit=unit, methods=["GET", "POST"])), _out(out, "load_features"), mode
    )
    # all request types, also those the models do not use
    types_path = write_table(L.request_type_counts(hits, unit=unit), _out(out, "request_types"), mode)
    feats = read_table(spark, feats_path)
    # absent averages (a bucket whose hits all lack a backend) count as 0, as in the reference (P20)
    known = L.time_cut(L.fill_zero(L.label(feats), LOAD_FEATURES), last=holdout).where(~col("is_holdout"))
    # the assembled, split model input is written once; fits and scoring read it back
    split = ST.hash_split(M.assemble(known, LOAD_FEATURES).withColumn("_key", epoch_seconds("bucket")), "_key")
    data = read_table(spark, write_table(split, _out(out, "model_input"), mode))
    train, test = data.where(col("split") == "train"), data.where(col("split") == "test")

    linear = M.fit_linear(train)
    # all settings and folds from one aggregate; only the best is fitted as a model to save
    grid = MO.cross_validate_linear(train, LOAD_FEATURES)
    cv = M.fit_linear(train, reg=grid.best.reg, intercept=grid.best.fit_intercept)
    tree = M.fit_tree(train)
    metrics = (
        _metrics_row("linear", M.score(linear, test))
        .unionByName(_metrics_row("linear_cv", M.score(cv, test)))
        .unionByName(_metrics_row("tree", M.score(tree, test)))
    )
    lagged = L.add_lags(feats, n=lags).withColumn("ct_url", col("ct_url").cast("double"))
    ma = L.moving_average(feats, n=lags).withColumn("ct_url", col("ct_url").cast("double"))
    metrics = metrics.unionByName(
        ST.regression_metrics(ma, label="ct_url", prediction="autoregressive_value").select(
            F.lit("moving_average").alias("model"), "*"
        )
    )
    paths = {"load_features": feats_path, "request_types": types_path}
    paths["linear_summary"] = write_table(M.linear_summary(linear), _out(out, "linear_summary"), mode)
    paths["linear_cv_grid"] = write_table(grid.table(spark), _out(out, "linear_cv_grid"), mode)
    paths["residuals"] = write_table(M.residuals(linear), _out(out, "residuals"), mode)
    paths["metrics"] = write_table(metrics, _out(out, "metrics"), mode)
    paths["lag_correlation"] = write_table(
        ST.corr_matrix(lagged, ["ct_url", *[f"lag_{i}" for i in range(1, lags + 1)]]), _out(out, "lag_correlation"), mode
    )
    paths["feature_correlation"] = write_table(
        ST.corr_with(L.label(feats), LOAD_FEATURES, "label"), _out(out, "feature_correlation"), mode
    )
    for name, model in (("linear", linear), ("linear_cv", cv), ("tree", tree)):
        paths[f"model_{name}"] = M.save_model(model, _out(out, f"model_{name}"), overwrite=mode == "overwrite")
    return paths


def users_job(
    spark: SparkSession,
    session_log_path: str,
    out: str,
    mode: str = "errorifexists",
    k: dict | None = None,
    sweep: dict | None = None,
    standardize: bool = False,
) -> dict:
    """Per-device user features, k-means per device with a k sweep, cluster
    statistics and per-session predicted ranges chosen by the first hit's device.

    ``standardize=True`` scales the features to unit variance per device
    before clustering (the reference clusters raw values).
    """
    k = {MOBILE: 6, WEB: 7, **(k or {})}
    sweep = {MOBILE: range(4, 12), WEB: range(4, 11), **(sweep or {})}
    session_hits = read_table(spark, session_log_path)
    hits = session_hits.drop("prev_ts", "is_new_session", "session_id")
    # a user whose every request time is -1 has no mean time: counted as 0, as the load job does (P20)
    users = L.fill_zero(D.user_features(hits, session_hits=session_hits), USER_FEATURES)
    feats = cache(M.assemble(users, USER_FEATURES))
    paths = {"device_counts": write_table(D.device_counts(hits), _out(out, "device_counts"), mode)}
    paths["device_gap"] = write_table(D.device_gap(session_hits), _out(out, "device_gap"), mode)
    scored, sweeps = [], []
    for dev in (MOBILE, WEB):
        part = feats.where(col("device") == dev)
        if part.isEmpty():  # no traffic of this class: no model for it
            continue
        if standardize:
            part = M.standardize(part).drop("features").withColumnRenamed("scaled", "features")
        model = M.fit_kmeans(part, k[dev])
        paths[f"kmeans_{dev}"] = M.save_model(model, _out(out, f"kmeans_{dev}"), overwrite=mode == "overwrite")
        scored.append(M.score(model, part))
        sweeps.append(M.kmeans_sweep(part, sweep[dev]).select(F.lit(dev).alias("device"), "k", "wssse"))
    if not scored:
        feats.unpersist()
        return paths
    clustered = scored[0] if len(scored) == 1 else scored[0].unionByName(scored[1])
    clustered = clustered.drop("features")
    keys = ["device", "prediction"]
    stats = clustered.groupBy(*keys).agg(
        F.avg("session_secs").alias("mean_session_secs"),
        F.stddev_pop("session_secs").alias("sd_session_secs"),
        F.avg("ct_url").alias("mean_ct_url"),
        F.stddev_pop("ct_url").alias("sd_ct_url"),
        F.count(F.lit(1)).alias("users"),
    )
    # one statistics table: the cluster summary and each user's interval (M15) come from it
    intervals = clustered.join(
        stats.select(
            *keys,
            (col("mean_session_secs") - col("sd_session_secs")).alias("session_secs_lo"),
            (col("mean_session_secs") + col("sd_session_secs")).alias("session_secs_hi"),
            (col("mean_ct_url") - col("sd_ct_url")).alias("ct_url_lo"),
            (col("mean_ct_url") + col("sd_ct_url")).alias("ct_url_hi"),
        ),
        keys,
    )
    all_sweeps = sweeps[0] if len(sweeps) == 1 else sweeps[0].unionByName(sweeps[1])
    paths["kmeans_sweep"] = write_table(all_sweeps, _out(out, "kmeans_sweep"), mode)
    paths["clusters"] = write_table(intervals, _out(out, "clusters"), mode)
    paths["cluster_stats"] = write_table(stats.orderBy(*keys), _out(out, "cluster_stats"), mode)
    firsts = D.first_hit_device(session_hits)
    paths["session_predictions"] = write_table(
        D.session_intervals(firsts, intervals, ranges=RANGES), _out(out, "session_predictions"), mode
    )
    feats.unpersist()
    return paths


JOBS = {"parse": parse_job, "sessions": sessions_job, "load": load_job, "users": users_job}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="trafficlens.plans.jobs")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("input")
    ap.add_argument("output")
    ap.add_argument("--mode", default="errorifexists")
    ap.add_argument("--no-rejects", action="store_true", help="parse: write hits only (one scan of the text)")
    ap.add_argument("--parse-mode", choices=["lenient", "strict"], help="parse: the line pattern")
    ap.add_argument("--gap-secs", type=int, help="sessions: inactivity gap in seconds")
    ap.add_argument("--top", type=int, dest="k", help="sessions: number of top users")
    ap.add_argument("--unit", choices=["second", "minute", "hour"], help="load: time bucket")
    ap.add_argument("--holdout", help="load: interval before the last bucket, such as '5 minutes'")
    ap.add_argument("--lags", type=int, help="load: number of lags")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    taken = {"parse": ["parse_mode"], "sessions": ["gap_secs", "k"], "load": ["unit", "holdout", "lags"], "users": []}
    extra = {p: v for p in taken[args.job] if (v := getattr(args, p)) is not None}
    if args.job == "parse" and args.no_rejects:
        extra["write_rejects"] = False
    for name, path in JOBS[args.job](spark, args.input, args.output, mode=args.mode, **extra).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
