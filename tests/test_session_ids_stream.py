"""Per-hit session ids on a stream equal the batch ids; late hits are kept apart."""

import datetime as dt
import os
import tempfile

import pytest

from tests.conftest import SF001
from trafficlens.operators import sessions as S
from trafficlens.sources import fixtures as fx
from trafficlens.streaming import session_ids as SI

START = dt.datetime(2024, 3, 1)
SCHEMA = "cl_ip string, date_time timestamp_ntz, hit long, agent string"


class Feed:
    """A folder that hits arrive in, file by file, and the query on it."""

    def __init__(self, spark, watermark="10 seconds", **options):
        root = tempfile.mkdtemp(prefix="tl-ids-")
        self.spark, self.source, self.sink = spark, os.path.join(root, "in"), os.path.join(root, "out")
        self.options = {"watermark": watermark, "gap_secs": 60, "keep": ("hit", "agent"), **options}
        self.sent = 0

    def send(self, rows):
        hits = [(c, None if s is None else START + dt.timedelta(seconds=s), self.sent + i, None) for i, (c, s) in enumerate(rows)]
        self.sent += len(rows)
        self.spark.createDataFrame(hits, SCHEMA).coalesce(1).write.mode("append").parquet(self.source)
        return hits

    def run(self):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(self.source)
        SI.start_session_ids(stream, self.sink, **self.options).awaitTermination(300)

    def ids(self):
        return {r.hit: (r.session_id, r.is_new_session) for r in SI.read_session_ids(self.spark, self.sink).collect()}

    def late(self):
        return sorted(r.hit for r in SI.read_session_ids(self.spark, self.sink, late=True).collect())


def test_ids_late_hits_and_restart(spark):
    feed = Feed(spark)
    feed.send([("a", 0), ("a", 5), ("b", 3), (None, 4), ("a", None)])
    feed.send([("a", 2), ("a", 64), ("b", 70)])  # 2 is out of order, but within the watermark
    feed.run()
    feed.send([("a", 200), ("b", 203.5)])  # a new run of the query on the same folders
    feed.run()
    feed.send([("a", 63), ("c", 1), ("a", 201), ("b", 264)])  # 63 and 1 are long passed
    feed.send([("z", 1000)])
    feed.send([("z", 1001)])
    feed.run()
    # hit numbers: 0-4, 5-7, 8-9, 10-13, 14, 15
    assert feed.ids() == {
        0: (1, 1), 5: (1, 0), 1: (1, 0), 6: (1, 0), 8: (2, 1), 12: (2, 0),
        2: (1, 1), 7: (2, 1), 9: (3, 1), 13: (4, 1),
    }
    assert feed.late() == [10, 11]


def test_gap_counts_whole_seconds(spark):
    feed = Feed(spark)
    feed.send([("a", 0.9), ("a", 60.1), ("b", 0.0), ("b", 59.999)])
    feed.send([("z", 500)])
    feed.send([("z", 501)])
    feed.run()
    assert feed.ids() == {0: (1, 1), 1: (2, 1), 2: (1, 1), 3: (1, 0)}


def test_expired_clients_begin_anew(spark):
    feed = Feed(spark, expire_secs=300)
    for rows in ([("a", 0)], [("z", 100)], [("a", 200)], [("z", 700)], [("z", 701)], [("a", 800)], [("z", 1300)], [("z", 1301)]):
        feed.send(rows)
    feed.run()
    ids = feed.ids()
    assert ids[0] == (1, 1) and ids[2] == (2, 1)  # silent for 200 s: the count goes on
    assert ids[5] == (1, 1)  # silent for 600 s: forgotten
    with pytest.raises(ValueError):
        feed.options["expire_secs"] = 5
        feed.run()


def test_stream_ids_equal_batch_ids(spark):
    """All hits of sf0.001 in four files, each a quarter of the time span."""
    hits = fx.hits(spark, SF001).select("cl_ip", "date_time", "event_id").orderBy("date_time").collect()
    root = tempfile.mkdtemp(prefix="tl-ids-")
    schema = "cl_ip string, date_time timestamp_ntz, event_id long"
    quarter = len(hits) // 4 + 1
    parts = [hits[i : i + quarter] for i in range(0, len(hits), quarter)]
    end = hits[-1].date_time + dt.timedelta(days=30)
    parts += [[("z", end, -1)], [("z", end + dt.timedelta(seconds=1), -2)]]
    for p in parts:
        spark.createDataFrame([tuple(r) for r in p], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    SI.start_session_ids(stream, f"{root}/out", "1 hour", gap_secs=21_600, keep=["event_id"]).awaitTermination(300)
    got = sorted((r.event_id, r.cl_ip, r.date_time, r.session_id) for r in SI.read_session_ids(spark, f"{root}/out").collect())
    batch = S.sessionize(fx.hits(spark, SF001), gap_secs=21_600)
    want = sorted((r.event_id, r.cl_ip, r.date_time, r.session_id) for r in batch.select("event_id", "cl_ip", "date_time", "session_id").collect())
    assert got == want
    assert SI.read_session_ids(spark, f"{root}/out", late=True).count() == 0


def test_python_is_called_by_slot_not_by_client(spark):
    """Many clients share a call and a row of state, and every slot keeps its own numbers."""
    root = tempfile.mkdtemp(prefix="tl-ids-")
    schema = "cl_ip string, date_time timestamp_ntz, hit long"
    times = [[0, 10, 70], [200], [9000], [9001]]
    for i, seconds in enumerate(times):
        clients = [f"c{n}" for n in range(50)] if i < 2 else ["clock"]
        rows = [(c, START + dt.timedelta(seconds=s), None if s == 10 else 2**53 + 1 + s) for c in clients for s in seconds]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        SI.start_session_ids(stream, f"{root}/out", "10 seconds", gap_secs=60, keep=["hit"], slots=4).awaitTermination(300)
    out = SI.read_session_ids(spark, f"{root}/out").where("cl_ip <> 'clock'")
    got = {}
    for r in out.collect():
        got.setdefault(r.cl_ip, set()).add(((r.date_time - START).seconds, r.hit, r.session_id))
    big = 2**53 + 1
    assert len(got) == 50
    assert all(g == {(0, big, 1), (10, None, 1), (70, big + 70, 2), (200, big + 200, 3)} for g in got.values())
    state = spark.read.format("statestore").option("stateVarName", "done").load(f"{root}/out_checkpoint")
    assert state.count() <= 4
