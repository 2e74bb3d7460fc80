"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Every query reads the driver's tables (``events``, ``pages``) through
``sources.fixtures`` and runs over all their rows. Doubles are rounded to 6
places in the output only, so that the DuckDB oracle can compare them.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, epoch_seconds
from ..operators import devices as D
from ..operators import load as L
from ..operators import models as M
from ..operators import sessions as S
from ..operators import stats as ST
from ..runtime import scratch_path
from ..sources import fixtures as fx
from ..sources import logs
from ..sources.tables import materialize, read_table, write_table

GAP = 900
GAP_6H = 21_600
DIGITS = 6
LAGS = 6
KMEANS_K = {"mobile": 6, "web": 7}
KMEANS_SWEEP = {"mobile": range(4, 12), "web": range(4, 11)}
USER_FEATURES = ["avg_rqpt", "avg_recb", "ct_url", "session_secs"]

Query = Callable[[SparkSession, str], DataFrame]


def round_double(c, digits: int = DIGITS):
    """Round half away from zero on the decimal value. The first step to 9 places
    removes last-bit noise of summation order, so engines that add in another
    order still round a decimal tie (0.8154375) the same way."""
    return F.round(F.round(c, 9).try_cast("decimal(38,9)"), digits).cast("double")


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (output only)."""
    return df.select(
        *[
            round_double(col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else col(f.name)
            for f in df.schema.fields
        ]
    )


# ---- shared inputs -------------------------------------------------------------

def _hits(spark: SparkSession, sf: str) -> DataFrame:
    return fx.hits(spark, sf)


def _session_hits(spark: SparkSession, sf: str, gap: int = GAP, strategy: str = "compact") -> DataFrame:
    return S.sessionize(_hits(spark, sf), gap_secs=gap, strategy=strategy)


def _sessions(spark: SparkSession, sf: str, gap: int = GAP) -> DataFrame:
    return S.session_table(_session_hits(spark, sf, gap))


METHODS = ["DELETE", "GET", "POST"]


def _features(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly load features with the request types named (no discovery job)."""
    return L.load_features(_hits(spark, sf), unit="hour", methods=METHODS)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly features with the next hour's load as label; rows without one dropped."""
    return L.ensure_methods(L.label(L.add_next(_features(spark, sf))), L.FEATURE_COLUMNS[-2:])


def _model_frame(spark: SparkSession, sf: str) -> DataFrame:
    df = M.assemble(L.fill_zero(_labelled(spark, sf), L.FEATURE_COLUMNS), L.FEATURE_COLUMNS)
    return ST.hash_split(df.withColumn("_key", epoch_seconds("bucket")), "_key")


def _user_features(spark: SparkSession, sf: str, gap: int = GAP) -> DataFrame:
    return D.user_features(_hits(spark, sf), gap_secs=gap)


# ---- sources -------------------------------------------------------------------

def q_parse_access_log(spark, sf):
    raw = logs.parse_access_log(fx.log_lines(spark, sf), keep=["event_id"])
    return logs.transform_log(raw)


def q_parse_strict(spark, sf):
    raw = logs.parse_access_log(fx.log_lines(spark, sf), mode="strict", keep=["event_id"])
    out = logs.transform_log(raw, mode="strict")
    return out.select(
        "event_id", "is_valid", "cl_ip", "bck_ip", "date_time", "request_type", "url", "get_params",
        "backend_processing_time", "elb_status_code", "ssl_protocol",
    )


def q_parse_rejects(spark, sf):
    return logs.rejects(fx.log_lines(spark, sf), keep=["event_id"])


def q_url_split(spark, sf):
    pages = fx.table(spark, sf, "pages").select("page_id", col("url").alias("page_url"))
    out = logs.split_url(pages, "page_url")
    return out.select("page_id", col("page_url").alias("url"), col("url").alias("path"), col("get_params").alias("query"))


def q_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "hits")
    write_table(_hits(spark, sf), path, cluster_by=["cl_ip"])
    return read_table(spark, path)


# ---- sessions ------------------------------------------------------------------

def _session_cols(df: DataFrame) -> DataFrame:
    return df.select("event_id", "cl_ip", "date_time", "prev_ts", "is_new_session", "session_id")


def q_sessionize_hits(spark, sf):
    return _session_cols(_session_hits(spark, sf, GAP))


def q_sessionize_hits_6h(spark, sf):
    return _session_cols(_session_hits(spark, sf, GAP_6H))


def q_sessionize_hot_second(spark, sf):
    """A third of all hits on one client in one second, ordered by their id."""
    hot = F.col("event_id") % 3 == 0
    hits = _hits(spark, sf)
    hits = hits.withColumn("cl_ip", F.when(hot, F.lit("10.0.0.0")).otherwise(F.col("cl_ip")))
    hits = hits.withColumn("date_time", F.when(hot, F.expr("timestamp_ntz'2024-01-01 00:00:00'")).otherwise(F.col("date_time")))
    return _session_cols(S.sessionize(hits, gap_secs=GAP_6H, tie_break="event_id"))


def q_sessionize_window(spark, sf):
    return _session_cols(_session_hits(spark, sf, GAP, strategy="window"))


def q_session_window_table(spark, sf):
    return S.session_windows(_hits(spark, sf), gap_secs=GAP_6H)


def q_session_spans(spark, sf):
    return S.session_spans(_hits(spark, sf), gap_secs=GAP_6H)


def q_session_length(spark, sf):
    return _sessions(spark, sf, GAP).select("cl_ip", "session_id", "session_secs", "hits")


def q_session_log_cut(spark, sf):
    """The reference writes the session log and reads it back before the
    session questions (S7); here the cut lands in the shared checkpoint folder."""
    cut = materialize(_session_hits(spark, sf, GAP), how="table", name="session-log")
    return S.session_table(cut).select("cl_ip", "session_id", "session_secs", "hits")


def q_session_length_6h(spark, sf):
    return _sessions(spark, sf, GAP_6H).select("cl_ip", "session_id", "session_secs", "hits")


def q_avg_session_length(spark, sf):
    return rounded(S.avg_session_length(_sessions(spark, sf, GAP)))


def q_urls_per_session(spark, sf):
    return S.urls_per_session(_sessions(spark, sf, GAP_6H))


def q_avg_urls_per_session(spark, sf):
    return rounded(S.avg_urls_per_session(_sessions(spark, sf, GAP)))


def q_avg_urls_per_session_6h(spark, sf):
    return rounded(S.avg_urls_per_session(_sessions(spark, sf, GAP_6H)))


def q_engaged_users(spark, sf):
    return rounded(S.engaged_users(_sessions(spark, sf, GAP)))


def q_engaged_users_6h(spark, sf):
    return rounded(S.engaged_users(_sessions(spark, sf, GAP_6H)))


def q_top_users(spark, sf):
    return rounded(S.top_users(_sessions(spark, sf, GAP_6H), k=100))


# ---- load features -------------------------------------------------------------

def q_load_features(spark, sf):
    return rounded(_features(spark, sf))


def q_load_features_second(spark, sf):
    return rounded(L.load_features(_hits(spark, sf), unit="second", methods=METHODS))


def q_request_type_counts(spark, sf):
    """Every request type the data has, in long form."""
    return L.request_type_counts(_hits(spark, sf), unit="hour")


def q_load_features_minute(spark, sf):
    return rounded(L.load_features(_hits(spark, sf), unit="minute", methods=["GET", "POST"]))


def q_next_load(spark, sf):
    nxt = L.add_next(_features(spark, sf))
    return L.label(nxt, fill=0).select("bucket", "ct_url", "next_load", "label")


def q_next_load_dense(spark, sf):
    minute = L.load_features(_hits(spark, sf), unit="minute", methods=["GET", "POST"])
    dense = L.add_next(L.densify(minute, unit="minute"))
    return dense.select("bucket", "ct_url", "GET", "POST", "hour", "next_load")


def q_load_lags(spark, sf):
    return L.add_lags(_features(spark, sf), n=LAGS).select(
        "bucket", "ct_url", *[f"lag_{k}" for k in range(1, LAGS + 1)]
    )


def q_moving_average(spark, sf):
    return rounded(L.moving_average(_features(spark, sf), n=LAGS).select("bucket", "ct_url", "autoregressive_value"))


def q_time_cut(spark, sf):
    # cut first: the latest bucket is read from the written features, not computed again
    return L.time_cut(materialize(_features(spark, sf), name="features"), last="1 day").select("bucket", "ct_url", "is_holdout")


CUTOFF = "2024-01-25 12:00:00"


def q_time_cut_literal(spark, sf):
    """A cutoff given as text, as the reference's constant cut time."""
    return L.time_cut(_features(spark, sf), cutoff=CUTOFF).select("bucket", "ct_url", "is_holdout")


# ---- devices -------------------------------------------------------------------

def q_device_counts(spark, sf):
    return D.device_counts(_hits(spark, sf))


def q_device_session_time(spark, sf):
    return rounded(D.device_session_time(_session_hits(spark, sf, GAP_6H)))


def q_device_gap(spark, sf):
    return rounded(D.device_gap(_session_hits(spark, sf, GAP_6H)))


def q_user_features(spark, sf):
    return rounded(_user_features(spark, sf))


def q_user_features_6h(spark, sf):
    return rounded(_user_features(spark, sf, GAP_6H))


def q_first_hit_device(spark, sf):
    return D.first_hit_device(_session_hits(spark, sf, GAP_6H), tie_break=["event_id"])


def q_first_hit_device_hash(spark, sf):
    """The default tie rule: one ``min`` of a long per session, a hash aggregate."""
    return D.first_hit_device(_session_hits(spark, sf, GAP_6H))


# ---- statistics ----------------------------------------------------------------

def q_weekday_index(spark, sf):
    return M.index_labels(_features(spark, sf), "day_week").select("bucket", "day_week", "day_week_idx")


def q_hash_split(spark, sf):
    return ST.hash_split(_hits(spark, sf), "event_id").select("event_id", "split", "fold")


def q_corr_matrix(spark, sf):
    lags = L.add_lags(_features(spark, sf), n=LAGS).withColumn("ct_url", col("ct_url").cast("double"))
    return rounded(ST.corr_matrix(lags, ["ct_url", *[f"lag_{k}" for k in range(1, LAGS + 1)]]))


def q_corr_with_label(spark, sf):
    return rounded(ST.corr_with(_labelled(spark, sf), L.FEATURE_COLUMNS, "label"))


def q_linear_one_feature(spark, sf):
    df = M.assemble(_labelled(spark, sf), ["ct_url"])
    model = M.fit_linear(df)
    return rounded(
        spark.range(1).select(
            F.lit(float(model.coefficients[0])).alias("slope"), F.lit(float(model.intercept)).alias("intercept")
        )
    )


def q_moving_average_metrics(spark, sf):
    ma = L.moving_average(_features(spark, sf), n=LAGS).withColumn("ct_url", col("ct_url").cast("double"))
    return rounded(ST.regression_metrics(ma, label="ct_url", prediction="autoregressive_value"))


def q_linear_one_feature_scores(spark, sf):
    """The fitted line applied to every row (M8)."""
    df = M.assemble(_labelled(spark, sf), ["ct_url"])
    return rounded(M.score(M.fit_linear(df), df).select("bucket", "label", "prediction"))


def q_linear_one_feature_summary(spark, sf):
    """Training summary of the one-feature fit (M5)."""
    summary = M.linear_summary(M.fit_linear(M.assemble(_labelled(spark, sf), ["ct_url"])))
    return rounded(summary.select("n", "rmse", "r2"))


CV_REG = (0.1, 0.01)


def q_linear_cv_one_feature(spark, sf):
    """Mean test RMSE over the five hash folds for each penalty (M6)."""
    df = M.assemble(_labelled(spark, sf), ["ct_url"])
    df = ST.hash_split(df.withColumn("_key", epoch_seconds("bucket")), "_key")
    cv = M.fit_linear_cv(df, reg=CV_REG, intercept=[True], fold_col="fold")
    return rounded(spark.createDataFrame(list(zip(CV_REG, map(float, cv.avgMetrics))), "reg double, avg_rmse double"))


def _fixed_groups(spark, sf, gap: int = GAP):
    return _user_features(spark, sf, gap).withColumn("grp", ST.hash_bucket("cl_ip", 4).cast("int"))


def q_cluster_stats(spark, sf):
    return rounded(ST.group_mean_sd(_fixed_groups(spark, sf), "grp", "session_secs"))


def q_cluster_stats_6h(spark, sf):
    return rounded(ST.group_mean_sd(_fixed_groups(spark, sf, GAP_6H), "grp", "session_secs"))


def q_cluster_stats_urls(spark, sf):
    """The same for distinct URLs."""
    return rounded(ST.group_mean_sd(_fixed_groups(spark, sf, GAP_6H), "grp", "ct_url"))


RANGED = ["session_secs", "ct_url"]
RANGES = ["session_secs_lo", "session_secs_hi", "ct_url_lo", "ct_url_hi"]


def q_cluster_interval_fixed(spark, sf):
    """Both predicted ranges (M15) over fixed groups in place of fitted clusters."""
    out = M.cluster_interval(_fixed_groups(spark, sf, GAP_6H), RANGED, cluster=["device", "grp"])
    return rounded(out.select("device", "cl_ip", "grp", *RANGED, *RANGES))


def q_session_prediction_fixed(spark, sf):
    """Per session the ranges of the user's fixed group (M15, M16); null without an agent."""
    log = materialize(_session_hits(spark, sf, GAP_6H), name="session-log")
    users = D.user_features(_plain(log), session_hits=log)
    grouped = users.withColumn("grp", ST.hash_bucket("cl_ip", 4).cast("int"))
    intervals = M.cluster_interval(grouped, RANGED, cluster=["device", "grp"])
    out = D.session_intervals(D.first_hit_device(log), intervals, ranges=RANGES)
    return rounded(out.select("cl_ip", "session_id", "device", *RANGES))


# ---- models (rows-only checks; invariants in tests) ----------------------------

def q_linear_fit(spark, sf):
    df = _model_frame(spark, sf)
    model = M.fit_linear(df.where(col("split") == "train"))
    return rounded(M.score(model, df.where(col("split") == "test")).select("bucket", "label", "prediction"))


def q_linear_summary(spark, sf):
    df = _model_frame(spark, sf)
    return M.linear_summary(M.fit_linear(df.where(col("split") == "train")))


def q_linear_metrics(spark, sf):
    df = _model_frame(spark, sf)
    model = M.fit_linear(df.where(col("split") == "train"))
    return rounded(ST.regression_metrics(M.score(model, df.where(col("split") == "test"))))


def q_linear_cv(spark, sf):
    df = _model_frame(spark, sf)
    cv = M.fit_linear_cv(df.where(col("split") == "train"), fold_col="fold")
    best = cv.bestModel
    scored = M.score(cv, df.where(col("split") == "test"))
    return rounded(
        ST.regression_metrics(scored).select(
            "*",
            F.lit(float(best.getRegParam())).alias("reg_param"),
            F.lit(bool(best.getFitIntercept())).alias("fit_intercept"),
        )
    )


def q_tree_fit(spark, sf):
    df = _model_frame(spark, sf)
    model = M.fit_tree(df.where(col("split") == "train"))
    return M.score(model, df.where(col("split") == "test")).select("bucket", "label", "prediction")


def _plain(session_hits: DataFrame) -> DataFrame:
    return session_hits.drop("prev_ts", "is_new_session", "session_id")


def _filled_users(users: DataFrame) -> DataFrame:
    """User features without nulls, as doubles where they are means."""
    return L.fill_zero(users, USER_FEATURES)


def _device_models(users: DataFrame) -> dict:
    """``device -> (model, its users)``. ``users`` is written first, so the fits
    and the scoring read one small table and the sessioniser runs once; the
    independent fits run as concurrent Spark jobs."""
    feats = M.assemble(materialize(_filled_users(users), name="users"), USER_FEATURES)
    parts = {dev: feats.where(col("device") == dev) for dev in KMEANS_K}
    with ThreadPoolExecutor(max_workers=len(parts)) as pool:
        models = pool.map(lambda d: M.fit_kmeans(parts[d], KMEANS_K[d]), parts)
        return {dev: (model, parts[dev]) for dev, model in zip(parts, models)}


def _clustered(spark, sf, users: DataFrame | None = None) -> DataFrame:
    """Each device's users scored by that device's k-means model."""
    users = _user_features(spark, sf) if users is None else users
    scored = [M.score(model, part) for model, part in _device_models(users).values()]
    return scored[0].unionByName(scored[1])


def q_kmeans_users(spark, sf):
    return _clustered(spark, sf).select("device", "cl_ip", "prediction")


def q_kmeans_sweep(spark, sf):
    feats = M.assemble(materialize(_filled_users(_user_features(spark, sf)), name="users"), USER_FEATURES)
    sweeps = [
        M.kmeans_sweep(feats.where(col("device") == dev), ks).select(F.lit(dev).alias("device"), "k", "wssse")
        for dev, ks in KMEANS_SWEEP.items()
    ]
    return sweeps[0].unionByName(sweeps[1])


def q_cluster_stats_kmeans(spark, sf):
    """Mean and sd of session length and distinct URLs per real cluster of each device's model."""
    clustered = _clustered(spark, sf).withColumn("cluster", F.concat_ws(":", "device", col("prediction").cast("string")))
    secs = ST.group_mean_sd(clustered, "cluster", "session_secs").select(
        "cluster", col("mean").alias("mean_session_secs"), col("sd").alias("sd_session_secs"), "n"
    )
    urls = ST.group_mean_sd(clustered, "cluster", "ct_url").select(
        "cluster", col("mean").alias("mean_ct_url"), col("sd").alias("sd_ct_url")
    )
    return rounded(secs.join(urls, "cluster").orderBy("cluster"))


def q_cluster_interval(spark, sf):
    out = M.cluster_interval(_clustered(spark, sf), RANGED, cluster=["device", "prediction"])
    return rounded(out.select("device", "cl_ip", "prediction", *RANGED, *RANGES))


def q_session_prediction(spark, sf):
    """Per session: the first hit's device picks the model, the user's cluster
    in it gives the ranges of session length and distinct URLs. The session
    log is written once; the user features and the first hits both read it."""
    log = materialize(_session_hits(spark, sf, GAP), name="session-log")
    clustered = _clustered(spark, sf, D.user_features(_plain(log), session_hits=log))
    intervals = M.cluster_interval(clustered, RANGED, cluster=["device", "prediction"])
    out = D.session_intervals(D.first_hit_device(log), intervals, ranges=RANGES)
    return rounded(out.select("cl_ip", "session_id", "device", *RANGES))


def q_model_roundtrip(spark, sf):
    df = _model_frame(spark, sf)
    model = M.fit_linear(df.where(col("split") == "train"))
    path = M.save_model(model, scratch_path(spark, "linear-model"))
    return rounded(M.score(M.load_linear(path), df.where(col("split") == "test")).select("bucket", "prediction"))


# ---- model invariants: counts of violations over all rows, which must be 0 --------

def _near(a, b, tol: float = 1e-6):
    return F.abs(a - b) <= F.lit(tol) * F.greatest(F.lit(1.0), F.abs(a), F.abs(b))


def q_linear_residual_check(spark, sf):
    """Least squares leaves residuals orthogonal to each of the eight features and to the intercept (M4, M5)."""
    train = materialize(_model_frame(spark, sf).where(col("split") == "train"), name="train")
    scored = M.score(M.fit_linear(train), train).withColumn("_r", col("label") - col("prediction"))
    sums = scored.withColumn("_one", F.lit(1.0))
    off = [
        (F.abs(F.sum(col("_r") * col(c))) > F.lit(1e-6) * F.sqrt(F.sum(col("_r") * col("_r")) * F.sum(col(c) * col(c)))).cast("bigint")
        for c in ["_one", *L.FEATURE_COLUMNS]
    ]
    return sums.agg(F.count(F.lit(1)).alias("n"), sum(off[1:], off[0]).alias("violations"))


def q_tree_leaf_check(spark, sf):
    """A tree predicts the label mean of the training rows in its leaf (M7, M8)."""
    train = materialize(_model_frame(spark, sf).where(col("split") == "train"), name="train")
    leaves = M.score(M.fit_tree(train), train).groupBy("prediction").agg(
        F.avg("label").alias("mean"), F.count(F.lit(1)).alias("rows")
    )
    return leaves.agg(
        F.sum("rows").alias("n"), F.count_if(~_near(col("mean"), col("prediction"))).alias("violations")
    )


def _squared_distances(model) -> list:
    """Squared distance of a user to each centre, as column expressions."""
    return [
        sum((F.pow(col(f) - F.lit(float(x)), 2) for f, x in zip(USER_FEATURES, centre)), F.lit(0.0))
        for centre in model.clusterCenters()
    ]


def q_kmeans_cost_check(spark, sf):
    """WSSSE is the sum of squared distances to the own centre."""
    checked = []
    for dev, (model, part) in _device_models(_user_features(spark, sf, GAP_6H)).items():
        own = F.get(F.array(*_squared_distances(model)), col("prediction"))
        same = _near(F.sum(own), F.lit(M.wssse(model)))
        checked.append(
            M.score(model, part).agg(
                F.lit(dev).alias("device"), F.count(F.lit(1)).alias("n"), (~same).cast("bigint").alias("violations")
            )
        )
    return checked[0].unionByName(checked[1])


def q_kmeans_sweep_check(spark, sf):
    """Each k of the sweep costs no more than one cluster, n times the summed variances."""
    users = materialize(_filled_users(_user_features(spark, sf, GAP_6H)), name="users")
    checked = []
    for dev, ks in KMEANS_SWEEP.items():
        part = users.where(col("device") == dev)
        spread = [F.var_pop(f) * F.count(F.lit(1)) for f in USER_FEATURES]
        total = part.agg(sum(spread[1:], spread[0]).alias("total"), F.count(F.lit(1)).alias("n")).first()
        bad = ~col("wssse").between(0, float(total.total or 0.0) * (1 + 1e-6))
        costs = M.kmeans_sweep(M.assemble(part, USER_FEATURES), ks)
        checked.append(
            costs.select(F.lit(dev).alias("device"), "k", F.lit(total.n).cast("bigint").alias("n"), bad.cast("bigint").alias("violations"))
        )
    return checked[0].unionByName(checked[1])


def q_kmeans_centre_check(spark, sf):
    """Every user belongs to the nearest centre of the device's model."""
    checked = []
    for dev, (model, part) in _device_models(_user_features(spark, sf, GAP_6H)).items():
        dist = _squared_distances(model)
        own = F.get(F.array(*dist), col("prediction"))
        least = F.least(*dist) if len(dist) > 1 else dist[0]
        checked.append(
            M.score(model, part).agg(
                F.lit(dev).alias("device"),
                F.count(F.lit(1)).alias("n"),
                F.count_if(~_near(own, least)).alias("violations"),
            )
        )
    return checked[0].unionByName(checked[1])


def q_model_roundtrip_check(spark, sf):
    """Rows whose prediction differs after saving and loading, for all three kinds of model."""
    frame = materialize(_model_frame(spark, sf), name="frame")
    train, test = frame.where(col("split") == "train"), frame.where(col("split") == "test")
    kinds = [("linear", M.fit_linear(train), M.load_linear, test), ("tree", M.fit_tree(train), M.load_tree, test)]
    for dev, (model, part) in _device_models(_user_features(spark, sf)).items():
        kinds.append((f"kmeans_{dev}", model, M.load_kmeans, part))
    out = None
    for kind, model, load, rows in kinds:
        again = load(M.save_model(model, scratch_path(spark, f"{kind}-model")))
        both = M.score(again, M.score(model, rows).withColumnRenamed("prediction", "_before"))
        row = both.agg(
            F.lit(kind).alias("kind"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(~col("_before").eqNullSafe(col("prediction"))).alias("violations"),
        )
        out = row if out is None else out.unionByName(row)
    return out


# ---- flagship -------------------------------------------------------------------

def most_engaged_from_lines(spark: SparkSession, sf: str, k: int = 100) -> DataFrame:
    """Raw log lines -> parse -> sessionise -> sessions -> top users."""
    parsed = logs.read_access_log(spark, fx.log_text_path(spark, sf))
    return rounded(S.top_users(S.session_table(S.sessionize(parsed, gap_secs=GAP)), k=k))


def q_engaged_from_lines(spark, sf):
    return most_engaged_from_lines(spark, sf)


QUERIES: dict[str, Query] = {
    "parse_access_log": q_parse_access_log,
    "parse_strict": q_parse_strict,
    "parse_rejects": q_parse_rejects,
    "url_split": q_url_split,
    "parquet_roundtrip": q_parquet_roundtrip,
    "sessionize_hits": q_sessionize_hits,
    "sessionize_hits_6h": q_sessionize_hits_6h,
    "sessionize_hot_second": q_sessionize_hot_second,
    "sessionize_window": q_sessionize_window,
    "session_window_table": q_session_window_table,
    "session_spans": q_session_spans,
    "session_length": q_session_length,
    "session_log_cut": q_session_log_cut,
    "session_length_6h": q_session_length_6h,
    "avg_session_length": q_avg_session_length,
    "urls_per_session": q_urls_per_session,
    "avg_urls_per_session": q_avg_urls_per_session,
    "engaged_users": q_engaged_users,
    "top_users": q_top_users,
    "engaged_from_lines": q_engaged_from_lines,
    "load_features": q_load_features,
    "load_features_minute": q_load_features_minute,
    "next_load": q_next_load,
    "next_load_dense": q_next_load_dense,
    "load_lags": q_load_lags,
    "moving_average": q_moving_average,
    "time_cut": q_time_cut,
    "time_cut_literal": q_time_cut_literal,
    "device_counts": q_device_counts,
    "device_session_time": q_device_session_time,
    "device_gap": q_device_gap,
    "user_features": q_user_features,
    "first_hit_device": q_first_hit_device,
    "weekday_index": q_weekday_index,
    "hash_split": q_hash_split,
    "corr_matrix": q_corr_matrix,
    "corr_with_label": q_corr_with_label,
    "linear_one_feature": q_linear_one_feature,
    "moving_average_metrics": q_moving_average_metrics,
    "cluster_stats": q_cluster_stats,
    "linear_fit": q_linear_fit,
    "linear_summary": q_linear_summary,
    "linear_metrics": q_linear_metrics,
    "linear_cv": q_linear_cv,
    "tree_fit": q_tree_fit,
    "kmeans_users": q_kmeans_users,
    "kmeans_sweep": q_kmeans_sweep,
    "cluster_stats_kmeans": q_cluster_stats_kmeans,
    "cluster_interval": q_cluster_interval,
    "session_prediction": q_session_prediction,
    "model_roundtrip": q_model_roundtrip,
    "load_features_second": q_load_features_second,
    "request_type_counts": q_request_type_counts,
    "avg_urls_per_session_6h": q_avg_urls_per_session_6h,
    "engaged_users_6h": q_engaged_users_6h,
    "user_features_6h": q_user_features_6h,
    "first_hit_device_hash": q_first_hit_device_hash,
    "linear_one_feature_scores": q_linear_one_feature_scores,
    "linear_one_feature_summary": q_linear_one_feature_summary,
    "linear_cv_one_feature": q_linear_cv_one_feature,
    "cluster_stats_6h": q_cluster_stats_6h,
    "cluster_stats_urls": q_cluster_stats_urls,
    "cluster_interval_fixed": q_cluster_interval_fixed,
    "session_prediction_fixed": q_session_prediction_fixed,
    "kmeans_cost_check": q_kmeans_cost_check,
    "kmeans_sweep_check": q_kmeans_sweep_check,
    "linear_residual_check": q_linear_residual_check,
    "tree_leaf_check": q_tree_leaf_check,
    "kmeans_centre_check": q_kmeans_centre_check,
    "model_roundtrip_check": q_model_roundtrip_check,
}
