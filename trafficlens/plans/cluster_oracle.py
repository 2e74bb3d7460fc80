"""DuckDB SQL for the queries in ``plans.cluster_queries``."""

from __future__ import annotations

from .cluster_queries import CORESET
from .oracle import _GROUPED, _USER_FEATURES, _device_time_cte, _r, _with_sessions
from .queries import GAP_6H, USER_FEATURES

_FILLED = "us AS MATERIALIZED (SELECT device, cl_ip, " + ", ".join(f"coalesce(CAST({f} AS DOUBLE), 0) AS {f}" for f in USER_FEATURES) + " FROM uf)"
_FAR = " + ".join(f"power({f} - m_{f}, 2)" for f in USER_FEATURES)
_NONE = "SELECT device, count(*) AS n, CAST(0 AS BIGINT) AS violations FROM uf GROUP BY device"
_UNIFORM = "('0x' || substr(md5('coreset:' || cl_ip), 1, 8))::BIGINT / 4294967296.0::DOUBLE"

ORACLE: dict[str, str] = {
    "kmeans_coreset": _with_sessions(
        GAP_6H,
        f"SELECT device, cl_ip, {_r('1 / kept')} AS weight FROM (SELECT device, cl_ip, "
        f"least(1.0, {CORESET} * (0.5 / n + ({_FAR}) / (2 * spread * n))) AS kept FROM us JOIN st8 USING (device)) AS q "
        f"WHERE {_UNIFORM} < kept",
        ctes=(
            _device_time_cte(),
            _USER_FEATURES,
            _FILLED,
            f"st8 AS (SELECT device, count(*) AS n, {' + '.join(f'var_pop({f})' for f in USER_FEATURES)} AS spread, "
            f"{', '.join(f'avg({f}) AS m_{f}' for f in USER_FEATURES)} FROM us GROUP BY device)",
        ),
    ),
    "quantile_ranges": _with_sessions(
        GAP_6H,
        "SELECT device, grp, count(*) AS n, CAST(0 AS BIGINT) AS violations FROM ug GROUP BY device, grp",
        ctes=(_device_time_cte(), _USER_FEATURES, _GROUPED),
    ),
    "kmeans_mean_check": _with_sessions(GAP_6H, _NONE, ctes=(_device_time_cte(), _USER_FEATURES)),
    "kmeans_cost_recomputed": _with_sessions(GAP_6H, _NONE, ctes=(_device_time_cte(), _USER_FEATURES)),
}
