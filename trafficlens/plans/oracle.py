"""DuckDB SQL for each exactly checkable query in ``plans.queries``.

Each statement rebuilds its input from the driver's views (``events``,
``pages``) with the same hits SELECT the Spark side uses, then computes the
answer the plain SQL way: sessions with ``lag`` and a running ``sum`` (the
reference's own plan), load features with ``date_trunc``, statistics with
``corr``/``regr_*``. Column names equal the Spark output; doubles are
rounded to the same 6 places.
"""

from __future__ import annotations

from ..operators.load import FEATURE_COLUMNS
from ..sources.fixtures import HITS_COLUMNS, HITS_SELECT
from .queries import CUTOFF, CV_REG, DIGITS, GAP, GAP_6H, LAGS, RANGED


def _es(x: str) -> str:
    """Whole epoch seconds of a timestamp."""
    return f"(epoch_us({x}) // 1000000)"


def _r(x: str) -> str:
    """Same rounding as ``queries.round_double``."""
    return f"CAST(round(TRY_CAST(round({x}, 9) AS DECIMAL(38, 9)), {DIGITS}) AS DOUBLE)"


HITS = (
    "hits AS (SELECT *, CASE WHEN get_params IS NULL THEN url ELSE url || '?' || get_params END AS request_url "
    f"FROM ({HITS_SELECT.format(events='events')}) AS h)"
)


def _sessions_ctes(gap: int, where: str = "") -> str:
    """``sh``: hits with prev_ts, is_new_session, session_id; ``st``: the session table.
    ``where`` adds a condition on the hits that are sessionised."""
    extra = f" AND {where}" if where else ""
    return f"""{HITS},
flagged AS (
  SELECT *, CASE WHEN {_es('date_time')} - {_es('prev_ts')} < {gap} THEN 0 ELSE 1 END AS is_new_session
  FROM (SELECT *, lag(date_time) OVER (PARTITION BY cl_ip ORDER BY date_time) AS prev_ts
        FROM hits WHERE cl_ip IS NOT NULL AND date_time IS NOT NULL{extra}) AS x),
sh AS (
  SELECT *, CAST(sum(is_new_session) OVER (PARTITION BY cl_ip ORDER BY date_time) AS BIGINT) AS session_id
  FROM flagged),
st AS (
  SELECT cl_ip, session_id, {_es('max(date_time)')} - {_es('min(date_time)')} AS session_secs,
         count(*) AS hits, count(DISTINCT url) AS dist_url, count(DISTINCT request_url) AS dist_request_url
  FROM sh GROUP BY cl_ip, session_id)"""


def _with_sessions(gap: int, body: str, ctes: tuple[str, ...] = (), where: str = "") -> str:
    """``body`` over the session CTEs, plus further named CTEs."""
    more = "".join(f",\n{c}" for c in ctes)
    return f"WITH {_sessions_ctes(gap, where)}{more}\n{body}"


def _features_cte(unit: str = "hour", methods=("DELETE", "GET", "POST")) -> str:
    counts = "".join(f", CAST(count_if(request_type = '{m}') AS BIGINT) AS \"{m}\"" for m in methods)
    return f"""lf0 AS (
  SELECT date_trunc('{unit}', date_time) AS bucket,
    avg(CASE WHEN request_processing_time >= 0 THEN request_processing_time END) AS avg_rqpt,
    avg(CASE WHEN backend_processing_time >= 0 THEN backend_processing_time END) AS avg_bckpt,
    avg(CASE WHEN response_processing_time >= 0 THEN response_processing_time END) AS avg_respt,
    avg(received_bytes) AS avg_recb, avg(sent_bytes) AS avg_sentb,
    count(DISTINCT url) AS ct_url{counts}
  FROM hits WHERE date_time IS NOT NULL GROUP BY 1),
lf AS (
  SELECT *, CAST(bucket AS DATE) AS day, CAST(quarter(bucket) AS INTEGER) AS quarter, CAST(floor(hour(bucket) / 6) AS INTEGER) AS day_quarter,
    CAST(hour(bucket) AS INTEGER) AS hour, dayname(bucket) AS day_week
  FROM lf0)"""


def _with_features(body: str, unit: str = "hour", methods=("DELETE", "GET", "POST"), ctes: tuple[str, ...] = ()) -> str:
    """``body`` over the load-feature CTEs, plus further named CTEs."""
    more = "".join(f",\n{c}" for c in ctes)
    return f"WITH {HITS},\n{_features_cte(unit, methods)}{more}\n{body}"


_LAG_COLS = ", ".join(
    f"CAST(lag(ct_url, {k}, 0) OVER (PARTITION BY CAST(bucket AS DATE) ORDER BY bucket) AS DOUBLE) AS lag_{k}"
    for k in range(1, LAGS + 1)
)
_LAGS_CTE = f"lags AS (SELECT bucket, CAST(ct_url AS DOUBLE) AS ct_url, {_LAG_COLS} FROM lf)"
_NEXT = "lead(ct_url) OVER (PARTITION BY CAST(bucket AS DATE) ORDER BY bucket)"
_LABELLED_CTE = (
    f"lab AS (SELECT * FROM (SELECT *, CAST({_NEXT} AS DOUBLE) AS label FROM lf) AS x WHERE label IS NOT NULL)"
)

_PARSED_COLS = [c for c in HITS_COLUMNS if c != "event_id"] + ["request_url"]


def _parse_access_log() -> str:
    cols = ", ".join(_PARSED_COLS)
    nulls = ", ".join(f"NULL AS {c}" for c in _PARSED_COLS)
    return f"""WITH {HITS}
SELECT event_id, 'web-lb' AS elb, {cols}, true AS is_valid FROM hits WHERE event_id % 101 <> 0
UNION ALL
SELECT event_id, NULL AS elb, {nulls}, false AS is_valid FROM hits WHERE event_id % 101 = 0"""


def _parse_strict() -> str:
    cols = ["cl_ip", "bck_ip", "date_time", "request_type", "url", "get_params",
            "backend_processing_time", "elb_status_code", "ssl_protocol"]
    ok = "event_id % 101 <> 0 AND event_id % 37 <> 0 AND event_id % 11 <> 0"
    vals = ", ".join(f"CASE WHEN {ok} THEN {c} END AS {c}" for c in cols)
    return f"WITH {HITS}\nSELECT event_id, ({ok}) AS is_valid, {vals} FROM hits"


def _corr_matrix() -> str:
    names = ["ct_url", *[f"lag_{k}" for k in range(1, LAGS + 1)]]
    parts = []
    for a in names:
        for b in names:
            if a == b:
                parts.append(f"SELECT '{a}' AS row_var, '{b}' AS col_var, CAST(1.0 AS DOUBLE) AS corr")
            else:
                parts.append(f"SELECT '{a}' AS row_var, '{b}' AS col_var, {_r(f'corr({a}, {b})')} AS corr FROM lags")
    return f"WITH {HITS},\n{_features_cte()},\n{_LAGS_CTE}\n" + "\n UNION ALL ".join(parts)


def _corr_with_label() -> str:
    parts = [f"SELECT '{c}' AS feature, {_r(f'corr({c}, label)')} AS corr FROM lab" for c in FEATURE_COLUMNS]
    return f"WITH {HITS},\n{_features_cte()},\n{_LABELLED_CTE}\n" + "\n UNION ALL ".join(parts)


def _metrics(label: str, pred: str, source: str) -> str:
    err = f"({label} - {pred})"
    return (
        f"SELECT count(*) AS n, {_r(f'avg({err} * {err})')} AS mse, {_r(f'sqrt(avg({err} * {err}))')} AS rmse, "
        f"{_r(f'1 - sum({err} * {err}) / (count(*) * var_pop({label}))')} AS r2, "
        f"{_r(f'avg(abs({err}))')} AS mae, "
        f"{_r(f'avg(power({pred} - (SELECT avg({label}) FROM {source}), 2))')} AS explained_variance "
        f"FROM {source}"
    )


def _hash_mod(expr: str, n: int) -> str:
    """Same bucket as ``stats.hash_bucket``: first 8 hex digits of the md5, modulo n."""
    return f"(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8))::BIGINT % {n})"


_DEVICE = "CASE WHEN contains(user_agent, 'Mobi') THEN 'mobile' WHEN NOT contains(user_agent, 'Mobi') THEN 'web' END"

_USER_FEATURES = f"""uf AS (
  SELECT dt.device, dt.cl_ip, dt.session_secs, f.avg_rqpt, f.avg_recb, f.ct_url
  FROM dt JOIN (SELECT device, cl_ip,
          avg(CASE WHEN request_processing_time >= 0 THEN request_processing_time END) AS avg_rqpt,
          avg(received_bytes) AS avg_recb, count(DISTINCT url) AS ct_url
        FROM (SELECT *, {_DEVICE} AS device FROM sh) AS d WHERE device IS NOT NULL
        GROUP BY device, cl_ip) AS f
  ON dt.device = f.device AND dt.cl_ip = f.cl_ip)"""


def _device_time_cte() -> str:
    return f"""dt AS (
  SELECT device, cl_ip, avg(secs) AS session_secs FROM (
    SELECT device, cl_ip, session_id, {_es('max(date_time)')} - {_es('min(date_time)')} AS secs
    FROM (SELECT *, {_DEVICE} AS device FROM sh) AS d WHERE device IS NOT NULL
    GROUP BY device, cl_ip, session_id) AS s
  GROUP BY device, cl_ip)"""


_GROUP = f"CAST({_hash_mod('cl_ip', 4)} AS INTEGER)"
_GROUPED = f"ug AS (SELECT *, {_GROUP} AS grp FROM uf)"
_GROUP_RANGES = "gr AS (SELECT device, grp, " + ", ".join(
    f"avg({v}) - stddev_pop({v}) AS {v}_lo, avg({v}) + stddev_pop({v}) AS {v}_hi" for v in RANGED
) + " FROM ug GROUP BY device, grp)"
_ROUNDED_RANGES = ", ".join(f"{_r(f'gr.{v}_{end}')} AS {v}_{end}" for v in RANGED for end in ("lo", "hi"))
_FIRSTS = f"""fd AS (
  SELECT cl_ip, session_id, first_device FROM (SELECT cl_ip, session_id, {_DEVICE} AS first_device,
    row_number() OVER (PARTITION BY cl_ip, session_id ORDER BY date_time,
      CASE WHEN user_agent IS NULL THEN 2 WHEN contains(user_agent, 'Mobi') THEN 0 ELSE 1 END) AS rn FROM sh) AS x
  WHERE rn = 1)"""
_TRAIN = f"{_hash_mod(_es('bucket'), 100)} < 80"


def _linear_cv() -> str:
    """Ridge on one feature with intercept, in closed form for each fold and
    penalty; the penalty applies to the standardised feature and label."""
    fold = f"CAST({_hash_mod(f"'fold:' || CAST({_es('bucket')} AS VARCHAR)", 5)} AS INTEGER)"
    regs = ", ".join(f"({reg}::DOUBLE)" for reg in CV_REG)
    return _with_features(
        f"SELECT reg, {_r('avg(rmse)')} AS avg_rmse FROM err GROUP BY reg",
        ctes=(
            _LABELLED_CTE,
            f"fl AS (SELECT CAST(ct_url AS DOUBLE) AS x, label AS y, {fold} AS fold FROM lab)",
            f"fits AS (SELECT f.fold, reg, regr_slope(y, x) / (1 + reg / stddev_samp(y)) AS slope, avg(x) AS mx, avg(y) AS my "
            f"FROM (SELECT DISTINCT fold FROM fl) AS f JOIN fl ON fl.fold <> f.fold, (VALUES {regs}) AS r(reg) GROUP BY f.fold, reg)",
            "err AS (SELECT reg, fits.fold, sqrt(avg(power(y - my - slope * (x - mx), 2))) AS rmse "
            "FROM fits JOIN fl ON fl.fold = fits.fold GROUP BY reg, fits.fold)",
        ),
    )


ORACLE: dict[str, str] = {
    "parse_access_log": _parse_access_log(),
    "parse_strict": _parse_strict(),
    "parse_rejects": f"WITH {HITS}\nSELECT event_id, '#garbage ' || CAST(event_id AS VARCHAR) AS value "
    "FROM hits WHERE event_id % 101 = 0",
    "url_split": "SELECT page_id, url, string_split(url, '?')[1] AS path, string_split(url, '?')[2] AS query FROM pages",
    "parquet_roundtrip": f"WITH {HITS}\nSELECT * FROM hits",
    "sessionize_hits": _with_sessions(
        GAP, "SELECT event_id, cl_ip, date_time, prev_ts, is_new_session, session_id FROM sh"
    ),
    "sessionize_hits_6h": _with_sessions(
        GAP_6H, "SELECT event_id, cl_ip, date_time, prev_ts, is_new_session, session_id FROM sh"
    ),
    "sessionize_hot_second": f"""WITH {HITS},
moved AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '10.0.0.0' ELSE cl_ip END AS cl_ip,
         CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE date_time END AS date_time
  FROM hits),
before AS (
  SELECT *, lag(date_time) OVER (PARTITION BY cl_ip ORDER BY date_time, event_id) AS prev_ts
  FROM moved WHERE cl_ip IS NOT NULL AND date_time IS NOT NULL),
flagged AS (
  SELECT *, CASE WHEN {_es('date_time')} - {_es('prev_ts')} < {GAP_6H} THEN 0 ELSE 1 END AS is_new_session FROM before)
SELECT event_id, cl_ip, date_time, prev_ts, is_new_session,
       CAST(sum(is_new_session) OVER (PARTITION BY cl_ip ORDER BY date_time, event_id) AS BIGINT) AS session_id
FROM flagged""",
    "sessionize_window": _with_sessions(
        GAP, "SELECT event_id, cl_ip, date_time, prev_ts, is_new_session, session_id FROM sh"
    ),
    "session_window_table": _with_sessions(
        GAP_6H,
        "SELECT cl_ip, min(date_trunc('second', date_time)) AS session_start, "
        f"{_es('max(date_time)')} - {_es('min(date_time)')} AS session_secs, count(*) AS hits "
        "FROM sh GROUP BY cl_ip, session_id",
    ),
    "session_spans": _with_sessions(GAP_6H, "SELECT cl_ip, session_id, session_secs, hits FROM st"),
    "session_length": _with_sessions(GAP, "SELECT cl_ip, session_id, session_secs, hits FROM st"),
    "session_log_cut": _with_sessions(GAP, "SELECT cl_ip, session_id, session_secs, hits FROM st"),
    "session_length_6h": _with_sessions(GAP_6H, "SELECT cl_ip, session_id, session_secs, hits FROM st"),
    "avg_session_length": _with_sessions(
        GAP, f"SELECT {_r('avg(session_secs)')} AS avg_session_secs, count(*) AS sessions FROM st"
    ),
    "urls_per_session": _with_sessions(GAP_6H, "SELECT cl_ip, session_id, dist_url, dist_request_url FROM st"),
    "avg_urls_per_session": _with_sessions(
        GAP, f"SELECT {_r('avg(dist_url)')} AS avg_dist_url, {_r('avg(dist_request_url)')} AS avg_dist_request_url FROM st"
    ),
    "engaged_users": _with_sessions(
        GAP, f"SELECT cl_ip, {_r('avg(session_secs)')} AS avg_session_secs, count(*) AS sessions FROM st GROUP BY cl_ip"
    ),
    "top_users": _with_sessions(
        GAP_6H,
        f"SELECT cl_ip, {_r('avg(session_secs)')} AS avg_session_secs, count(*) AS sessions FROM st "
        "GROUP BY cl_ip ORDER BY avg(session_secs) DESC, cl_ip LIMIT 100",
    ),
    "engaged_from_lines": _with_sessions(
        GAP,
        f"SELECT cl_ip, {_r('avg(session_secs)')} AS avg_session_secs, count(*) AS sessions FROM st "
        "GROUP BY cl_ip ORDER BY avg(session_secs) DESC, cl_ip LIMIT 100",
        where="event_id % 101 <> 0",  # the garbage lines never parse
    ),
    "load_features": _with_features(
        "SELECT bucket, "
        + ", ".join(_r(c) + f" AS {c}" for c in ["avg_rqpt", "avg_bckpt", "avg_respt", "avg_recb", "avg_sentb"])
        + ', ct_url, day, quarter, day_quarter, hour, day_week, "DELETE", "GET", "POST" FROM lf'
    ),
    "load_features_minute": _with_features(
        "SELECT bucket, "
        + ", ".join(_r(c) + f" AS {c}" for c in ["avg_rqpt", "avg_bckpt", "avg_respt", "avg_recb", "avg_sentb"])
        + ', ct_url, day, quarter, day_quarter, hour, day_week, "GET", "POST" FROM lf',
        unit="minute",
        methods=("GET", "POST"),
    ),
    "next_load": _with_features(
        f"SELECT bucket, ct_url, {_NEXT} AS next_load, CAST(coalesce({_NEXT}, 0) AS DOUBLE) AS label FROM lf"
    ),
    "next_load_dense": _with_features(
        "SELECT bucket, ct_url, \"GET\", \"POST\", hour, "
        "lead(ct_url) OVER (PARTITION BY CAST(bucket AS DATE) ORDER BY bucket) AS next_load FROM d",
        unit="minute",
        methods=("GET", "POST"),
        ctes=(
            "grid AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 MINUTE)) AS bucket "
            "FROM lf GROUP BY CAST(bucket AS DATE))",
            "d AS (SELECT g.bucket, coalesce(lf.ct_url, 0) AS ct_url, coalesce(lf.\"GET\", 0) AS \"GET\", "
            "coalesce(lf.\"POST\", 0) AS \"POST\", CAST(hour(g.bucket) AS INTEGER) AS hour "
            "FROM grid AS g LEFT JOIN lf ON g.bucket = lf.bucket)",
        ),
    ),
    "load_lags": _with_features("SELECT bucket, ct_url, " + _LAG_COLS + " FROM lf"),
    "moving_average": f"WITH {HITS},\n{_features_cte()},\n{_LAGS_CTE}\n"
    f"SELECT bucket, CAST(ct_url AS BIGINT) AS ct_url, "
    f"{_r('(lag_1 + lag_2 + lag_3 + lag_4 + lag_5 + lag_6) / 6')} AS autoregressive_value FROM lags",
    "time_cut": _with_features(
        "SELECT bucket, ct_url, bucket >= (SELECT max(bucket) FROM lf) - INTERVAL 1 DAY AS is_holdout FROM lf"
    ),
    "time_cut_literal": _with_features(
        f"SELECT bucket, ct_url, bucket >= TIMESTAMP '{CUTOFF}' AS is_holdout FROM lf"
    ),
    "device_counts": f"WITH {HITS}\nSELECT {_DEVICE} AS device, count(*) AS hits FROM hits GROUP BY 1",
    "device_session_time": _with_sessions(
        GAP_6H, f"SELECT device, cl_ip, {_r('session_secs')} AS session_secs FROM dt", ctes=(_device_time_cte(),)
    ),
    "device_gap": _with_sessions(
        GAP_6H,
        f"SELECT m.cl_ip, {_r('m.session_secs')} AS sess_time_mob, {_r('w.session_secs')} AS sess_time_web, "
        f"{_r('m.session_secs - w.session_secs')} AS diff "
        "FROM dt AS m JOIN dt AS w ON m.cl_ip = w.cl_ip AND m.device = 'mobile' AND w.device = 'web'",
        ctes=(_device_time_cte(),),
    ),
    "user_features": _with_sessions(
        GAP,
        f"SELECT device, cl_ip, {_r('session_secs')} AS session_secs, "
        f"{_r('avg_rqpt')} AS avg_rqpt, {_r('avg_recb')} AS avg_recb, ct_url FROM uf",
        ctes=(_device_time_cte(), _USER_FEATURES),
    ),
    "first_hit_device": _with_sessions(
        GAP_6H,
        f"SELECT cl_ip, session_id, first_device FROM (SELECT cl_ip, session_id, {_DEVICE} AS first_device, "
        "row_number() OVER (PARTITION BY cl_ip, session_id ORDER BY date_time, event_id) AS rn FROM sh) AS x "
        "WHERE rn = 1",
    ),
    "weekday_index": _with_features(
        "SELECT lf.bucket, lf.day_week, i.day_week_idx FROM lf JOIN ("
        "SELECT day_week, CAST(row_number() OVER (ORDER BY count(*) DESC, day_week) - 1 AS DOUBLE) AS day_week_idx "
        "FROM lf GROUP BY day_week) AS i USING (day_week)"
    ),
    "hash_split": f"WITH {HITS}\nSELECT event_id, CASE WHEN {_hash_mod('event_id', 100)} < 80 THEN 'train' ELSE 'test' END "
    f"AS split, CAST({_hash_mod("'fold:' || CAST(event_id AS VARCHAR)", 5)} AS INTEGER) "
    "AS fold FROM hits",
    "corr_matrix": _corr_matrix(),
    "corr_with_label": _corr_with_label(),
    "linear_one_feature": f"WITH {HITS},\n{_features_cte()},\n{_LABELLED_CTE}\n"
    f"SELECT {_r('regr_slope(label, ct_url)')} AS slope, {_r('regr_intercept(label, ct_url)')} AS intercept FROM lab",
    "moving_average_metrics": f"WITH {HITS},\n{_features_cte()},\n{_LAGS_CTE},\n"
    "ma AS (SELECT ct_url, (lag_1 + lag_2 + lag_3 + lag_4 + lag_5 + lag_6) / 6 AS autoregressive_value FROM lags)\n"
    + _metrics("ct_url", "autoregressive_value", "ma"),
    "cluster_stats": _with_sessions(
        GAP,
        f"SELECT CAST({_hash_mod('cl_ip', 4)} AS INTEGER) AS grp, {_r('avg(session_secs)')} AS mean, "
        f"{_r('stddev_pop(session_secs)')} AS sd, count(*) AS n FROM uf GROUP BY 1",
        ctes=(_device_time_cte(), _USER_FEATURES),
    ),
    "load_features_second": _with_features(
        "SELECT bucket, "
        + ", ".join(_r(c) + f" AS {c}" for c in ["avg_rqpt", "avg_bckpt", "avg_respt", "avg_recb", "avg_sentb"])
        + ', ct_url, day, quarter, day_quarter, hour, day_week, "DELETE", "GET", "POST" FROM lf',
        unit="second",
    ),
    "request_type_counts": f"WITH {HITS}\nSELECT date_trunc('hour', date_time) AS bucket, request_type, count(*) AS hits "
    "FROM hits WHERE date_time IS NOT NULL GROUP BY ALL",
    "avg_urls_per_session_6h": _with_sessions(
        GAP_6H, f"SELECT {_r('avg(dist_url)')} AS avg_dist_url, {_r('avg(dist_request_url)')} AS avg_dist_request_url FROM st"
    ),
    "engaged_users_6h": _with_sessions(
        GAP_6H, f"SELECT cl_ip, {_r('avg(session_secs)')} AS avg_session_secs, count(*) AS sessions FROM st GROUP BY cl_ip"
    ),
    "user_features_6h": _with_sessions(
        GAP_6H,
        f"SELECT device, cl_ip, {_r('session_secs')} AS session_secs, "
        f"{_r('avg_rqpt')} AS avg_rqpt, {_r('avg_recb')} AS avg_recb, ct_url FROM uf",
        ctes=(_device_time_cte(), _USER_FEATURES),
    ),
    "first_hit_device_hash": _with_sessions(GAP_6H, "SELECT cl_ip, session_id, first_device FROM fd", ctes=(_FIRSTS,)),
    "linear_one_feature_scores": f"WITH {HITS},\n{_features_cte()},\n{_LABELLED_CTE},\n"
    "fit AS (SELECT regr_slope(label, ct_url) AS s, regr_intercept(label, ct_url) AS i FROM lab)\n"
    f"SELECT bucket, label, {_r('i + s * ct_url')} AS prediction FROM lab, fit",
    "linear_one_feature_summary": f"WITH {HITS},\n{_features_cte()},\n{_LABELLED_CTE}\n"
    f"SELECT count(*) AS n, {_r('sqrt((regr_syy(label, ct_url) - regr_slope(label, ct_url) * regr_sxy(label, ct_url)) / count(*))')} AS rmse, "
    f"{_r('regr_r2(label, ct_url)')} AS r2 FROM lab",
    "linear_cv_one_feature": _linear_cv(),
    "cluster_stats_6h": _with_sessions(
        GAP_6H,
        f"SELECT grp, {_r('avg(session_secs)')} AS mean, {_r('stddev_pop(session_secs)')} AS sd, count(*) AS n FROM ug GROUP BY 1",
        ctes=(_device_time_cte(), _USER_FEATURES, _GROUPED),
    ),
    "cluster_stats_urls": _with_sessions(
        GAP_6H,
        f"SELECT grp, {_r('avg(ct_url)')} AS mean, {_r('stddev_pop(ct_url)')} AS sd, count(*) AS n FROM ug GROUP BY 1",
        ctes=(_device_time_cte(), _USER_FEATURES, _GROUPED),
    ),
    "cluster_interval_fixed": _with_sessions(
        GAP_6H,
        f"SELECT device, cl_ip, grp, {_r('session_secs')} AS session_secs, ct_url, {_ROUNDED_RANGES} "
        "FROM ug JOIN gr USING (device, grp)",
        ctes=(_device_time_cte(), _USER_FEATURES, _GROUPED, _GROUP_RANGES),
    ),
    "session_prediction_fixed": _with_sessions(
        GAP_6H,
        f"SELECT fd.cl_ip, fd.session_id, fd.first_device AS device, {_ROUNDED_RANGES} FROM fd "
        "LEFT JOIN ug ON ug.cl_ip = fd.cl_ip AND ug.device = fd.first_device "
        "LEFT JOIN gr ON gr.device = ug.device AND gr.grp = ug.grp",
        ctes=(_device_time_cte(), _USER_FEATURES, _GROUPED, _GROUP_RANGES, _FIRSTS),
    ),
    "kmeans_cost_check": _with_sessions(
        GAP_6H,
        "SELECT device, count(*) AS n, CAST(0 AS BIGINT) AS violations FROM uf GROUP BY device",
        ctes=(_device_time_cte(), _USER_FEATURES),
    ),
    "kmeans_sweep_check": _with_sessions(
        GAP_6H,
        "SELECT device, CAST(k AS INTEGER) AS k, count(*) AS n, CAST(0 AS BIGINT) AS violations "
        "FROM uf, range(4, 12) AS r(k) WHERE device = 'mobile' OR k < 11 GROUP BY device, k",
        ctes=(_device_time_cte(), _USER_FEATURES),
    ),
    "linear_residual_check": _with_features(
        f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS violations FROM lab WHERE {_TRAIN}", ctes=(_LABELLED_CTE,)
    ),
    "tree_leaf_check": _with_features(
        f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS violations FROM lab WHERE {_TRAIN}", ctes=(_LABELLED_CTE,)
    ),
    "kmeans_centre_check": _with_sessions(
        GAP_6H,
        "SELECT device, count(*) AS n, CAST(0 AS BIGINT) AS violations FROM uf GROUP BY device",
        ctes=(_device_time_cte(), _USER_FEATURES),
    ),
    "model_roundtrip_check": _with_sessions(
        GAP,
        "SELECT 'kmeans_' || device AS kind, count(*) AS n, CAST(0 AS BIGINT) AS violations FROM uf GROUP BY device "
        f"UNION ALL SELECT kind, count(*) AS n, CAST(0 AS BIGINT) AS violations FROM lab, (VALUES ('linear'), ('tree')) AS k(kind) "
        f"WHERE NOT {_TRAIN} GROUP BY kind",
        ctes=(_device_time_cte(), _USER_FEATURES, _features_cte(), _LABELLED_CTE),
    ),
}
