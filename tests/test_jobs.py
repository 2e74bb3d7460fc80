"""The four batch jobs run end to end on sf0.001 and hand over through parquet."""

import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF001
from trafficlens.plans import jobs
from trafficlens.sources import fixtures as fx


def test_four_jobs_end_to_end(spark):
    out = tempfile.mkdtemp(prefix="tl-jobs-")
    lines = fx.log_text_path(spark, SF001)
    p = jobs.parse_job(spark, lines, f"{out}/parse")
    hits = spark.read.parquet(p["hits"])
    rejects = spark.read.parquet(p["rejects"])
    assert hits.count() == 990 and rejects.count() == 10
    assert {r.value.split()[0] for r in rejects.collect()} == {"#garbage"}
    assert hits.where("cl_ip IS NULL").count() == 0 and "value" not in hits.columns
    s = jobs.sessions_job(spark, p["hits"], f"{out}/sessions")
    assert spark.read.parquet(s["session_log"]).count() == hits.count()
    assert spark.read.parquet(s["top_users"]).count() == 15
    ld = jobs.load_job(spark, p["hits"], f"{out}/load", unit="minute", holdout="1 day")
    models = {r.model for r in spark.read.parquet(ld["metrics"]).collect()}
    assert models == {"linear", "linear_cv", "tree", "moving_average"}
    assert spark.read.parquet(ld["lag_correlation"]).count() == 49
    u = jobs.users_job(spark, s["session_log"], f"{out}/users", k={"mobile": 3, "web": 3},
                       sweep={"mobile": [2, 3], "web": [2, 3]})
    assert spark.read.parquet(u["kmeans_sweep"]).count() == 4
    preds = spark.read.parquet(u["session_predictions"])
    assert preds.count() == spark.read.parquet(s["sessions"]).count()  # none is lost, with an interval or without
    assert {"session_secs_lo", "session_secs_hi", "ct_url_lo", "ct_url_hi"} <= set(preds.columns)
    assert preds.where("session_secs_lo <= session_secs_hi AND ct_url_lo <= ct_url_hi").count() > 0
    types = spark.read.parquet(ld["request_types"])
    assert {r.request_type for r in types.select("request_type").distinct().collect()} == {
        r.request_type for r in hits.select("request_type").distinct().collect()
    }
    assert types.agg(F.sum("hits")).first()[0] == hits.count()
    summary = spark.read.parquet(ld["linear_summary"]).first()
    res = spark.read.parquet(ld["residuals"])
    assert res.count() == summary.n and abs(res.agg(F.avg("residuals")).first()[0]) < 1e-6


def test_users_job_standardized(spark):
    out = tempfile.mkdtemp(prefix="tl-jobs-std-")
    lines = fx.log_text_path(spark, SF001)
    p = jobs.parse_job(spark, lines, f"{out}/parse")
    s = jobs.sessions_job(spark, p["hits"], f"{out}/sessions")
    u = jobs.users_job(spark, s["session_log"], f"{out}/users", k={"mobile": 2, "web": 2},
                       sweep={"mobile": [2], "web": [2]}, standardize=True)
    stats = spark.read.parquet(u["cluster_stats"]).collect()
    assert {r.device for r in stats} == {"mobile", "web"} and sum(r.users for r in stats) > 0


def test_users_job_with_one_device_class_only(spark):
    from pyspark.sql import functions as F

    from trafficlens.operators import sessions as S

    out = tempfile.mkdtemp(prefix="tl-jobs-web-")
    hits = fx.hits(spark, SF001).where(~F.col("user_agent").contains("Mobi"))
    S.sessionize(hits).write.parquet(f"{out}/log")
    u = jobs.users_job(spark, f"{out}/log", f"{out}/users", k={"web": 2}, sweep={"web": [2]})
    assert "kmeans_mobile" not in u and "kmeans_web" in u
    assert {r.device for r in spark.read.parquet(u["cluster_stats"]).collect()} == {"web"}


def test_cli_parse_without_rejects(spark, capsys):
    out = tempfile.mkdtemp(prefix="tl-jobs-cli-")
    jobs.main(["parse", fx.log_text_path(spark, SF001), f"{out}/parse", "--no-rejects"])
    printed = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert set(printed) == {"hits"}
    assert spark.read.parquet(printed["hits"]).count() == 990
