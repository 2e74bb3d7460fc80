"""Summarise the physical plans of the headline operators (PLANS.md is its output).

For each plan: every shuffle with its keys, joins, windows with their
partition keys, expands, aggregates, and what reaches the parquet scan
(pushed filters, read schema). Plans are taken with AQE off and broadcast
joins disabled, so they show the shape a very large input gets.
Usage: python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trafficlens.operators import devices as D  # noqa: E402
from trafficlens.operators import load as L  # noqa: E402
from trafficlens.operators import sessions as S  # noqa: E402
from trafficlens.operators import stats as ST  # noqa: E402
from trafficlens.runtime import local_session  # noqa: E402
from trafficlens.sources import fixtures as fx  # noqa: E402
from trafficlens.sources import logs  # noqa: E402

KEEP = ("Exchange", "SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin", "Window", "Expand",
        "HashAggregate", "TakeOrderedAndProject", "FileScan", "ReusedExchange", "Generate")


def _short(line: str) -> str:
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r", \[plan_id=\d+\]", "", line)
    m = re.search(r"(FileScan \w+) \[([^\]]*)\].*?PushedFilters: (\[[^\]]*\]).*?ReadSchema: (struct\S*)", line)
    if m:
        return f"{line[:line.index('FileScan')]}{m.group(1)} pushed={m.group(3)} schema={m.group(4)}"
    return line[:200]


def summary(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        body = line.lstrip(" :+-*()0123456789")
        if body.startswith(KEEP):
            out.append(_short(line.rstrip()))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    path = os.path.join(tempfile.mkdtemp(prefix="run-plans-"), "hits")
    fx.hits(spark, sf_dir).write.parquet(path)
    hits = spark.read.parquet(path)
    text = fx.log_text_path(spark, sf_dir)
    cases = {
        "parse (text -> hits)": logs.read_access_log(spark, text),
        "sessionize, compact (default)": S.sessionize(hits),
        "sessionize, window (reference plan)": S.sessionize(hits, strategy="window"),
        "session_table over compact sessions": S.session_table(S.sessionize(hits)),
        "session_spans (chunked session table)": S.session_spans(hits),
        "session_windows (session_window per client and day)": S.session_windows(hits),
        "top_users": S.top_users(S.session_table(S.sessionize(hits))),
        "load_features (second) + next + lags": L.add_lags(L.add_next(L.load_features(hits, "second", ["GET", "POST"]))),
        "user_features": D.user_features(hits),
        "device_gap": D.device_gap(S.sessionize(hits)),
        "mobile hits only (pushdown)": D.only_device(hits, "mobile").select("cl_ip", "url"),
        "corr_matrix": ST.corr_matrix(L.add_lags(L.load_features(hits, "hour", ["GET"])).withColumn(
            "ct_url", L.F.col("ct_url").cast("double")), ["ct_url", "lag_1", "lag_2"]),
    }
    print("# Physical plans of the headline operators\n")
    print("Generated by `python scripts/plan_report.py` on sf0.01 hits written to parquet; AQE off and")
    print("broadcast joins disabled, i.e. the shape a very large input gets. At run time AQE may coalesce")
    print("partitions, reuse exchanges (the compacted table of the compact sessioniser is built once) and")
    print("turn joins with a measured-small side into broadcasts.\n")
    for name, df in cases.items():
        lines = summary(df)
        n_ex = sum(1 for x in lines if "Exchange" in x and "Reused" not in x)
        print(f"## {name}\n\n{n_ex} exchanges\n\n```")
        print("\n".join(lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
