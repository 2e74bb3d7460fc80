"""Hand-made rows for the edges of parsing and sessionising (FIXTURES.md section 5)."""

import datetime as dt

import pytest

from trafficlens.functions.columns import url_path, url_query
from trafficlens.operators import devices as D
from trafficlens.operators import load as L
from trafficlens.operators import sessions as S
from trafficlens.sources import logs

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
SCHEMA = "event_id bigint, cl_ip string, date_time timestamp_ntz, url string, request_url string, user_agent string"


def _hits(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _ids(df):
    return {r.event_id: r.session_id for r in df.collect()}


@pytest.mark.parametrize("strategy", ["window", "compact"])
def test_gap_edges(spark, strategy):
    times = [T0, T0 + dt.timedelta(seconds=899), T0 + dt.timedelta(seconds=1799),
             T0 + dt.timedelta(seconds=2700)]
    rows = [(i, "1.1.1.1", t, "/a", "/a", "x") for i, t in enumerate(times)]
    out = S.sessionize(_hits(spark, rows), gap_secs=900, strategy=strategy, chunk_secs=1000)
    assert _ids(out) == {0: 1, 1: 1, 2: 2, 3: 3}
    flags = {r.event_id: r.is_new_session for r in out.collect()}
    assert flags == {0: 1, 1: 0, 2: 1, 3: 1}


@pytest.mark.parametrize("strategy", ["window", "compact"])
def test_sub_second_gap_counts_whole_seconds(spark, strategy):
    rows = [(1, "ip", dt.datetime(2024, 1, 1, 0, 0, 0, 900000), "/a", "/a", "x"),
            (2, "ip", dt.datetime(2024, 1, 1, 0, 15, 0, 100000), "/a", "/a", "x")]
    assert _ids(S.sessionize(_hits(spark, rows), strategy=strategy)) == {1: 1, 2: 2}


@pytest.mark.parametrize("strategy", ["window", "compact"])
def test_tie_after_gap_shares_session(spark, strategy):
    later = T0 + dt.timedelta(hours=1)
    rows = [(1, "ip", T0, "/a", "/a", "x"), (2, "ip", later, "/b", "/b", "x"), (3, "ip", later, "/c", "/c", "x")]
    out = S.sessionize(_hits(spark, rows), strategy=strategy)
    assert _ids(out) == {1: 1, 2: 2, 3: 2}
    assert sorted(r.is_new_session for r in out.collect()) == [0, 1, 1]


def test_single_hit_and_null_rows(spark):
    rows = [(1, "ip", T0, "/a", "/a", "x"), (2, None, T0, "/a", "/a", "x"), (3, "ip2", None, "/a", "/a", "x")]
    sh = S.sessionize(_hits(spark, rows))
    assert _ids(sh) == {1: 1}
    st = S.session_table(sh).collect()
    assert [(r.cl_ip, r.session_secs, r.hits) for r in st] == [("ip", 0, 1)]


def test_chunk_stitching_matches_window(spark):
    """Sessions that run across many chunk borders, with tiny chunks."""
    rows, i = [], 0
    for ip, step in (("a", 300), ("b", 1000), ("c", 899), ("d", 900)):
        t = T0
        for _ in range(40):
            rows.append((i, ip, t, "/u", "/u", "x"))
            i += 1
            t += dt.timedelta(seconds=step)
    hits = _hits(spark, rows)
    a = S.sessionize(hits, strategy="window").select("event_id", "prev_ts", "is_new_session", "session_id")
    for chunk in (60, 600, 3600, 86400):
        b = S.sessionize(hits, strategy="compact", chunk_secs=chunk).select(
            "event_id", "prev_ts", "is_new_session", "session_id")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_session_window_and_spans_match_session_table(spark):
    rows = [(i, "ip", T0 + dt.timedelta(seconds=s), "/a", "/a", "x")
            for i, s in enumerate([0, 10, 899, 1799, 2698, 5000, 5000, 9000])]
    hits = _hits(spark, rows)
    st = sorted((r.session_secs, r.hits) for r in S.session_table(S.sessionize(hits)).collect())
    sw = sorted((r.session_secs, r.hits) for r in S.session_windows(hits).collect())
    sp = sorted((r.session_secs, r.hits) for r in S.session_spans(hits, chunk_secs=1000).collect())
    assert st == sw == sp


def test_url_split(spark):
    df = spark.createDataFrame([("/a",), ("/a?x=1",), ("/a?x=1?y=2",)], "u string")
    got = [(r.p, r.q) for r in df.select(url_path("u").alias("p"), url_query("u").alias("q")).collect()]
    assert got == [("/a", None), ("/a", "x=1"), ("/a", "x=1")]


LINE = ('2015-07-22T09:00:28.019143Z shop-lb 203.0.113.7:54635 {backend} 0.000022 {bt} 0.00002 '
        '200 200 0 699 "GET https://shop.example.com:443/cart/checkout?code=f2405b HTTP/1.1" "{agent}" '
        'ECDHE-RSA-AES128-GCM-SHA256 TLSv1.2')


def test_parse_modes(spark):
    lines = [
        LINE.format(backend="10.0.6.158:80", bt="0.026109", agent="Mozilla/5.0 Mobile"),
        LINE.format(backend="-", bt="-1", agent="Mozilla/5.0"),
        LINE.format(backend="10.0.6.158:80", bt="0.026109", agent=""),
        "garbage",
        LINE.format(backend="10.0.6.158:80", bt="0.026109", agent="x") + " trailing fields",
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "event_id bigint, value string")
    lenient = {r.event_id: r for r in logs.transform_log(logs.parse_access_log(df, keep=["event_id"])).collect()}
    strict = {r.event_id: r for r in
              logs.transform_log(logs.parse_access_log(df, mode="strict", keep=["event_id"]), mode="strict").collect()}
    assert [lenient[i].is_valid for i in range(5)] == [True, True, True, False, True]
    assert [strict[i].is_valid for i in range(5)] == [True, False, False, False, True]
    r = lenient[0]
    assert (r.cl_ip, r.cl_port, r.bck_ip, r.bck_port) == ("203.0.113.7", "54635", "10.0.6.158", "80")
    assert r.date_time == dt.datetime(2015, 7, 22, 9, 0, 28, 19143)
    assert (r.request_type, r.url, r.get_params) == ("GET", "https://shop.example.com:443/cart/checkout", "code=f2405b")
    assert r.backend_processing_time == pytest.approx(0.026109) and r.received_bytes == 0 and r.sent_bytes == 699
    assert (lenient[1].bck_ip, lenient[1].bck_port, lenient[1].backend_processing_time) == (None, None, -1.0)
    assert lenient[3].cl_ip is None and lenient[3].date_time is None
    rej = [r.event_id for r in logs.rejects(df, keep=["event_id"]).collect()]
    assert rej == [3]


def test_null_agent_in_neither_class(spark):
    rows = [(1, "ip", T0, "/a", "/a", None), (2, "ip", T0, "/a", "/a", "Mobi"), (3, "ip", T0, "/a", "/a", "Web")]
    counts = {r.device: r.hits for r in D.device_counts(_hits(spark, rows)).collect()}
    assert counts == {None: 1, "mobile": 1, "web": 1}


def test_lags_at_day_start_are_zero(spark):
    rows = [(dt.datetime(2024, 1, 1, h), c) for h, c in [(0, 5), (1, 7), (2, 9)]] + [(dt.datetime(2024, 1, 2, 0), 4)]
    f = spark.createDataFrame(rows, "bucket timestamp_ntz, ct_url bigint")
    out = {r.bucket: r for r in L.moving_average(L.add_lags(L.add_next(f), n=2), n=2).collect()}
    first = out[dt.datetime(2024, 1, 1, 0)]
    assert (first.lag_1, first.lag_2, first.autoregressive_value, first.next_load) == (0.0, 0.0, 0.0, 7)
    third = out[dt.datetime(2024, 1, 1, 2)]
    assert (third.lag_1, third.lag_2, third.autoregressive_value, third.next_load) == (7.0, 5.0, 6.0, None)
    nxt = out[dt.datetime(2024, 1, 2, 0)]
    assert (nxt.lag_1, nxt.autoregressive_value) == (0.0, 0.0)
