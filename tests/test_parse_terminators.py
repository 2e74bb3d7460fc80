"""Line terminators, time offsets and a single regex under filters."""

import datetime as dt

import pytest

from trafficlens.sources import logs

LINE = (
    '2015-07-22T09:00:28.019143{z} shop 1.2.3.4:55 10.0.0.1:80 0.1 0.2 0.3 200 200 0 699 '
    '"GET https://x.com:443/a?b=1 HTTP/1.1" "agent{mid}" ECDHE-RSA TLSv1.2{end}'
)


@pytest.mark.parametrize("mode", ["lenient", "strict"])
def test_line_terminators_in_ignored_text(spark, mode):
    texts = [LINE.format(z="Z", mid="", end=e) for e in ("", " more", " a b", " a\u0085", "  ")]
    if mode == "strict":
        texts.append("before " + texts[0])
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = logs.parse_access_log(lines, mode=mode).collect()
    assert all(r.is_valid and r.ssl_protocol == "TLSv1.2" for r in rows)
    assert logs.rejects(lines, mode=mode).count() == 0


def test_offsets_become_utc(spark):
    zones = ["Z", "+02:00", "-0530"]
    lines = spark.createDataFrame([(LINE.format(z=z, mid="", end=""),) for z in zones], "value string")
    got = [r.date_time for r in logs.transform_log(logs.parse_access_log(lines)).select("date_time").collect()]
    at = dt.datetime(2015, 7, 22, 9, 0, 28, 19143)
    assert got == [at, at - dt.timedelta(hours=2), at + dt.timedelta(hours=5, minutes=30)]


def test_filters_do_not_repeat_the_regex(spark):
    lines = spark.createDataFrame([(LINE.format(z="Z", mid="", end=""),)], "value string")
    parsed = logs.transform_log(logs.parse_access_log(lines)).where("is_valid and cl_ip is not null and date_time is not null")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
    assert parsed.count() == 1
