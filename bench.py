"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPEAT`` (default 3; the best run counts). Every query
is forced through a ``noop`` write, so all rows are computed and nothing is
collected. Rendering the raw log text from ``events`` is setup, not timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trafficlens.operators import devices as D  # noqa: E402
from trafficlens.functions.columns import epoch_seconds  # noqa: E402
from trafficlens.operators import load as L  # noqa: E402
from trafficlens.operators import models as M  # noqa: E402
from trafficlens.operators import sessions as S  # noqa: E402
from trafficlens.operators import stats as ST  # noqa: E402
from trafficlens.runtime import local_session  # noqa: E402
from trafficlens.sources import fixtures as fx  # noqa: E402
from trafficlens.sources import logs  # noqa: E402
from trafficlens.sources.tables import materialize  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)

    text_path = fx.log_text_path(spark, sf_dir)
    hits = fx.hits(spark, sf_dir)

    def parsed():
        return logs.read_access_log(spark, text_path)

    def linear_fit():
        feats = L.label(L.add_next(L.load_features(hits, "second", ["GET", "POST"])))
        data = ST.hash_split(
            M.assemble(L.fill_zero(feats, L.FEATURE_COLUMNS), L.FEATURE_COLUMNS).withColumn("_k", epoch_seconds("bucket")),
            "_k",
        )
        model = M.fit_linear(data.where("split = 'train'"))
        return ST.regression_metrics(M.score(model, data.where("split = 'test'")))

    def kmeans_users():
        users = L.fill_zero(D.user_features(hits), ["avg_rqpt", "avg_recb", "ct_url", "session_secs"])
        # fit and scoring read the written user table, so the features are computed once
        feats = M.assemble(materialize(users.where("device = 'web'")), ["avg_rqpt", "avg_recb", "ct_url", "session_secs"])
        return M.score(M.fit_kmeans(feats, 7), feats)

    plans = {
        "parse_log_lines": lambda: parsed(),
        "parse_filtered": lambda: parsed().where("cl_ip IS NOT NULL AND date_time IS NOT NULL"),
        "sessionize": lambda: S.sessionize(hits),
        "sessionize_window": lambda: S.sessionize(hits, strategy="window"),
        "session_table": lambda: S.session_table(S.sessionize(hits)),
        "session_windows_6h": lambda: S.session_windows(hits, gap_secs=21_600),
        "session_spans": lambda: S.session_spans(hits),
        "top_users_from_lines": lambda: S.top_users(S.session_table(S.sessionize(parsed())), k=100),
        "load_features_second": lambda: L.moving_average(
            L.add_lags(L.add_next(L.load_features(hits, "second", ["DELETE", "GET", "POST"])))
        ),
        "user_features": lambda: D.user_features(hits),
        "corr_matrix_hourly": lambda: ST.corr_matrix(
            L.add_lags(L.load_features(hits, "hour", ["GET"])).withColumn("ct_url", L.F.col("ct_url").cast("double")),
            ["ct_url"] + [f"lag_{k}" for k in range(1, 7)],
        ),
        "linear_fit_second": linear_fit,
        "kmeans_users_web": kmeans_users,
    }

    # warm the JVM and the file listing caches
    hits.write.format("noop").mode("overwrite").save()

    times = {}
    for name, build in plans.items():
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "rows_events": spark.read.parquet(f"{sf_dir}/events.parquet").count(),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
