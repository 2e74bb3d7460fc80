"""Edges found in review: separator inside a field, degenerate metrics, gap filling, day keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trafficlens.operators import load as L
from trafficlens.operators import stats as ST
from trafficlens.sources import logs

LINE = ('2015-07-22T09:00:28.019143Z lb 203.0.113.7:54635 10.0.6.158:80 0.000022 0.026109 0.00002 '
        '200 200 0 699 "GET https://shop.example.com:443/a?x=1 HTTP/1.1" "{agent}" CIPHER TLSv1.2')


def test_separator_inside_a_field_parses_exactly(spark):
    agent = "Mozilla\u0001odd"
    df = spark.createDataFrame([(LINE.format(agent=agent),)], "value string")
    r = logs.transform_log(logs.parse_access_log(df)).first()
    assert r.is_valid and r.user_agent == agent
    assert (r.ssl_cipher, r.ssl_protocol, r.sent_bytes, r.url) == ("CIPHER", "TLSv1.2", 699, "https://shop.example.com:443/a")


def test_metrics_constant_label_and_missing_predictions(spark):
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0), (5.0, None), (None, 1.0)], "label double, prediction double")
    r = ST.regression_metrics(df).first()
    assert r.n == 2 and r.mse == pytest.approx(1.0) and r.mae == pytest.approx(1.0)
    assert r.r2 is None
    assert r.explained_variance == pytest.approx(1.0)


def test_densify_zero_fills_counts_only(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0), 3, 2), (dt.datetime(2024, 1, 1, 0, 3), 5, 1)]
    f = spark.createDataFrame(rows, "bucket timestamp_ntz, ct_url bigint, GET bigint")
    f = L.add_next(f)
    dense = {r.bucket.minute: r for r in L.densify(f, unit="minute").collect()}
    assert sorted(dense) == [0, 1, 2, 3]
    assert (dense[1].ct_url, dense[1].GET, dense[1].next_load) == (0, 0, None)
    assert dense[0].next_load == 5


def test_day_column_used_only_when_it_is_the_bucket_date(spark):
    rows = [(dt.datetime(2024, 1, 1, 23), "x", 1), (dt.datetime(2024, 1, 2, 0), "x", 2)]
    f = spark.createDataFrame(rows, "bucket timestamp_ntz, day string, ct_url bigint")
    out = {r.ct_url: r.next_load for r in L.add_next(f).collect()}
    assert out == {1: None, 2: None}  # a text 'day' is not trusted: days split at midnight
    assert L.add_next(f).columns == f.columns + ["next_load"]


def test_ensure_methods_adds_zero_columns(spark):
    f = spark.createDataFrame([(1,)], "GET bigint")
    r = L.ensure_methods(f, ["GET", "POST"]).first()
    assert (r.GET, r.POST) == (1, 0)
    assert F is not None


def test_time_bucket_of_zoned_timestamps_uses_utc_wall_clock(spark):
    from trafficlens.functions.columns import time_bucket

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-01-01 10:20:30",), ("2024-01-01 10:00:00",)], "s string").select(
            F.col("s").cast("timestamp").alias("ts")
        )
        out = [(r.s, r.h) for r in df.select(time_bucket("ts", "second").alias("s"), time_bucket("ts", "hour").alias("h")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert out == [
        (dt.datetime(2024, 1, 1, 15, 20, 30), dt.datetime(2024, 1, 1, 15)),
        (dt.datetime(2024, 1, 1, 15, 0, 0), dt.datetime(2024, 1, 1, 15)),
    ]


def test_first_hit_device_prefers_an_agent_at_a_tie(spark):
    from trafficlens.operators import devices as D

    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("ip", 1, t, None), ("ip", 1, t, "x Mobi"), ("ip", 2, t, "web agent")],
        "cl_ip string, session_id bigint, date_time timestamp_ntz, user_agent string",
    )
    got = {r.session_id: r.first_device for r in D.first_hit_device(df).collect()}
    assert got == {1: "mobile", 2: "web"}


def test_every_zone_becomes_utc(spark):
    zones = {"+02": 7, "+2": 7, "+02:00": 7, "+0200": 7, "+02:00:00": 7, " Europe/Paris": 7, "[Europe/Paris]": None, " GMT+2": 7, "UTC+02:00": 7, " PST": 16, "Z": 9, " UTC": 9, "": 9, ".25": 9, ".25-03:30": 12}
    rows = spark.createDataFrame([(z, "2015-07-22T09:00:28" + z) for z in zones], "z string, t string")
    for r in rows.select("z", logs.utc_wall_clock(F.col("t")).cast("string").alias("u")).collect():
        if zones[r.z] is None:
            assert r.u is None
        else:
            assert r.u.startswith(f"2015-07-22 {zones[r.z]:02d}:{'30' if r.z == '.25-03:30' else '00'}:28"), r
