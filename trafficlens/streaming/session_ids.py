"""Session ids of single hits on a stream (W1-W3), by ``transformWithState``.

A hit is held in its client's state until the watermark has passed its time,
since an earlier hit may still arrive. Then a timer lets the held hits go in
order of time, numbered as the batch ``sessionize`` numbers them. Hits that come
after the watermark has passed them cannot be numbered any more; they leave at
once, marked, into a side table (``is_late=true`` of the sink), so none is lost.

State holds the hits younger than the watermark and, of each client, the time of
the last numbered hit and the session count. With ``expire_secs`` the last two
are cleared once the client has been silent that long; its next session is 1
again. Clients are dealt into slots by their hash, and a slot is the key of the
state: Python is called, and its hits numbered in one go, once per slot and
micro-batch, not once or more for every client.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.columns import col, epoch_micros
from ..operators.sessions import DEFAULT_GAP_SECS

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# whole numbers travel as text, as pandas makes floats of those beside a null
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Sessions(StatefulProcessor):
    """The hits of the clients of one slot. ``columns`` are those of a hit: the
    client, ``_us`` (the time in microseconds) and the kept ones. State holds
    them as arrays, a row for each part that came in. One timer is set per slot,
    for the first time at which something is due."""

    def __init__(self, columns: T.StructType, gap_secs: int, expire_secs: int | None):
        self.columns, self.gap, self.expire = columns, gap_secs, expire_secs
        self.names = columns.fieldNames()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kinds = [f.dataType for f in self.columns]
        arrays = lambda *kinds: T.StructType([T.StructField(f"c{i}", T.ArrayType(k)) for i, k in enumerate(kinds)])
        self.waiting = handle.getListState("waiting", arrays(*kinds))
        # client, time of its last numbered hit, its sessions
        self.done = handle.getValueState("done", arrays(kinds[0], T.LongType(), T.LongType()))
        self.due = handle.getValueState("due", T.StructType([T.StructField("ms", T.LongType())]))

    def _hold(self, part: pd.DataFrame) -> None:
        """Add hits to the state."""
        values = [part[c].astype(object).where(part[c].notna(), None).tolist() for c in self.names]
        self.waiting.appendValue(tuple(values))

    def _held(self) -> pd.DataFrame:
        whole: list[list] = [[] for _ in self.names]
        for part in self.waiting.get() if self.waiting.exists() else ():
            for values, more in zip(whole, part):
                values.extend(more)
        return pd.DataFrame({c: pd.Series(v, dtype="int64" if c == "_us" else None) for c, v in zip(self.names, whole)})

    def _wake(self, ms: int) -> None:
        """See that a timer runs out at ``ms`` or before."""
        set_for = self.due.get()[0] if self.due.exists() else None
        if set_for is not None and set_for <= ms:
            return
        if set_for is not None:
            self.handle.deleteTimer(set_for)
        self.handle.registerTimer(ms)
        self.due.update((ms,))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        first = None
        for part in rows:
            # by place: the optimizer may rename the computed columns
            part = part.iloc[:, 1:].set_axis(self.names, axis=1)
            is_late = part["_us"] < passed * 1000
            fresh, late = part[~is_late], part[is_late]
            if len(fresh):
                self._hold(fresh)
                first = min([int(fresh["_us"].min())] + ([] if first is None else [first]))
            if len(late):
                none = [None] * len(late)
                yield late.assign(is_late=True, is_new_session=pd.array(none, "Int32"), session_id=pd.array(none, "Int64"))
        if first is not None:
            self._wake(first // 1000 + 1)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        held = self._held()
        is_ready = held["_us"] < passed * 1000
        ready, left = held[is_ready], held[~is_ready]
        seen = {c: (last, n) for c, last, n in zip(*self.done.get())} if self.done.exists() else {}
        if len(ready):
            yield self._number(ready, seen)
            self.waiting.clear()
            if len(left):
                self._hold(left)
        due = [int(left["_us"].min()) // 1000 + 1] if len(left) else []
        if self.expire is not None:
            still = set(left[self.names[0]])
            ends = {c: last // 1000 + self.expire * 1000 for c, (last, _) in seen.items() if c not in still}
            seen = {c: v for c, v in seen.items() if ends.get(c, passed) >= passed}
            due += [ends[c] + 1 for c in seen if c in ends]
        if seen:
            self.done.update(([*seen], [last for last, _ in seen.values()], [n for _, n in seen.values()]))
        elif self.done.exists():
            self.done.clear()
        self.due.clear()
        if due:
            self._wake(min(due))

    def _number(self, ready: pd.DataFrame, seen: dict) -> pd.DataFrame:
        """Session ids of hits in order of client and time, going on from ``seen``, which is brought up to date."""
        code, clients = pd.factorize(ready[self.names[0]])
        order = np.lexsort((ready["_us"], code))
        out, code = ready.iloc[order].reset_index(drop=True), code[order]
        us = out["_us"].to_numpy()
        begins = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        ends = np.r_[begins[1:], len(code)] - 1
        secs = us // 1_000_000
        before = np.r_[secs[:1], secs[:-1]]
        known = [seen.get(c) for c in clients]
        before[begins] = [secs[b] - self.gap if k is None else k[0] // 1_000_000 for b, k in zip(begins, known)]
        new = (secs - before >= self.gap).astype("int64")
        so_far = np.cumsum(new)
        earlier = np.array([0 if k is None else k[1] for k in known]) - (so_far[begins] - new[begins])
        number = so_far + earlier[code]
        seen.update(zip(clients, zip(us[ends].tolist(), number[ends].tolist())))
        return out.assign(is_late=False, is_new_session=new.astype("int32"), session_id=number)

    def close(self) -> None:
        pass


def session_ids_stream(
    hits: DataFrame,
    watermark: str,
    user: str = "cl_ip",
    ts: str = "date_time",
    gap_secs: int = DEFAULT_GAP_SECS,
    keep: Sequence[str] = (),
    expire_secs: int | None = None,
    slots: int = 1024,
) -> DataFrame:
    """``user, ts, <keep>, is_late, is_new_session, session_id`` of a hit stream.

    The ids equal those of the batch ``sessionize`` over all hits that were not
    late; a hit leaves when the watermark has passed it. Late hits have null
    ids. Hits without a user or time are left out, as in the batch form. Of
    hits at one time any may be the first of a session. ``expire_secs`` must
    exceed ``gap_secs``. Needs the RocksDB state store (``start_session_ids``
    sets it). A client's hits of a micro-batch meet in one task, which holds the
    hits of the watermark's delay of one of ``slots`` slots at a time, and
    rewrites the slot's clients when any of them moves on. ``slots`` is the most
    tasks that share the work; a checkpoint goes on with its number of slots only.
    """
    if expire_secs is not None and expire_secs < gap_secs:
        raise ValueError("expire_secs must not be below gap_secs")
    known = hits.where(col(user).isNotNull() & col(ts).isNotNull())
    known = known.withColumn("_us", epoch_micros(ts))
    # the clock moves by this column; it is then dropped, or Spark would discard late hits before they are seen
    timed = known.withColumn("_clock", F.timestamp_micros("_us")).withWatermark("_clock", watermark)
    whole = {c: hits.schema[c].dataType for c in keep if isinstance(hits.schema[c].dataType, _WHOLE)}
    texts = [col(c).cast("string").alias(c) if c in whole else col(c) for c in keep]
    dealt = timed.select(F.pmod(F.hash(user), F.lit(slots)).alias("_slot"), user, "_us", *texts)
    columns = T.StructType(dealt.schema.fields[1:])
    out = T.StructType(
        [
            *columns.fields,
            T.StructField("is_late", T.BooleanType()),
            T.StructField("is_new_session", T.IntegerType()),
            T.StructField("session_id", T.LongType()),
        ]
    )
    numbered = dealt.groupBy("_slot").transformWithStateInPandas(
        statefulProcessor=_Sessions(columns, gap_secs, expire_secs), outputStructType=out, outputMode="Append", timeMode="EventTime"
    )
    zoned = isinstance(hits.schema[ts].dataType, T.TimestampType)
    wall = F.timestamp_add("MICROSECOND", col("_us"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    time = F.timestamp_micros("_us") if zoned else wall
    kept = [col(c).cast(whole[c]).alias(c) if c in whole else col(c) for c in keep]
    return numbered.select(user, time.alias(ts), *kept, "is_late", "is_new_session", "session_id")


def start_session_ids(
    hits: DataFrame,
    sink_dir: str,
    watermark: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    **options,
) -> StreamingQuery:
    """Run ``session_ids_stream`` into a parquet table partitioned by
    ``is_late``: the numbered hits, and the side table of late ones. Started
    again on the same folders it goes on where it stopped. The state store
    setting is made for this query only."""
    numbered = session_ids_stream(hits, watermark, **options)
    conf = hits.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKSDB)
    try:
        writer = (
            numbered.writeStream.format("parquet")
            .option("path", sink_dir)
            .option("checkpointLocation", checkpoint or sink_dir.rstrip("/") + "_checkpoint")
            .partitionBy("is_late")
            .outputMode("append")
        )
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        return writer.start()
    finally:
        if before is None:
            conf.unset(_PROVIDER)
        else:
            conf.set(_PROVIDER, before)


def read_session_ids(spark: SparkSession, sink_dir: str, late: bool = False) -> DataFrame:
    """The numbered hits of ``start_session_ids``, or its late ones."""
    return spark.read.parquet(sink_dir).where(col("is_late") == F.lit(late)).drop("is_late")
