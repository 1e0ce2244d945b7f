"""Streaming palm-position smoothing of frames that arrive in any order.

A frame is held in its subject's state until the watermark passes its event time;
an event-time timer then releases what is due, in frame order. What comes later
than that and belongs before a released frame is given out as late and changes
nothing. How far frames may be out of order is the watermark's delay, which also
bounds what a subject holds.

The state is a list of held frames, and one value: the last released frame, its
smoothed point and whether a run is open. ``transformWithStateInPandas`` keeps
them in RocksDB state stores, so they are not limited by the workers' memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from strata.operators.landmarks import SMOOTH_ALPHA, ship_by_value

EMITTED_SCHEMA = "subject long, frame_no long, cx int, cy int, late boolean"
_HELD_SCHEMA = "frame_no long, at_ms long, visivel boolean, x int, y int"
_LAST_SCHEMA = "frame_no long, px int, py int, open boolean"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"


class _OrderedSmoothing(StatefulProcessor):
    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _HELD_SCHEMA)
        self.last = handle.getValueState("last", _LAST_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = []
        for part in rows:
            part = part[part["frame_no"].notna()]  # a row without a frame only moves the watermark
            for frame, at, seen, x, y in zip(part["frame_no"], part["at_ms"], part["visivel"], part["cx_raw"], part["cy_raw"]):
                seen = bool(seen)
                fresh.append((int(frame), int(at), seen, int(x) if seen else None, int(y) if seen else None))
        yield from self._release(key, fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._release(key, [], timerValues.getCurrentWatermarkInMs())

    def _release(self, key, fresh: list[tuple], watermark: int) -> Iterator[pd.DataFrame]:
        """Give out the frames up to the watermark and hold the rest."""
        frames = list(self.held.get()) + fresh if self.held.exists() else fresh
        frames = sorted(tuple(f) for f in frames)
        due = [f for f in frames if f[1] <= watermark]
        rest = [f for f in frames if f[1] > watermark]
        last, px, py, is_open = self.last.get() if self.last.exists() else (None, 0, 0, False)
        out = []
        for frame, _, seen, x, y in due:
            if last is not None and frame <= last:
                out.append((key[0], frame, None, None, True))
                continue
            last = frame
            if not seen:
                is_open = False
                continue
            if is_open:
                px = int(SMOOTH_ALPHA * x + (1 - SMOOTH_ALPHA) * px)
                py = int(SMOOTH_ALPHA * y + (1 - SMOOTH_ALPHA) * py)
            else:
                is_open, px, py = True, x, y
            out.append((key[0], frame, px, py, False))
        if due:
            self.last.update((last, px, py, is_open))
        if rest:
            self.held.put(rest)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(min(f[1] for f in rest))
        elif due:
            self.held.clear()
        types = {"subject": "Int64", "frame_no": "int64", "cx": "Int32", "cy": "Int32", "late": "bool"}
        if out:
            yield pd.DataFrame(out, columns=list(types)).astype(types)

    def close(self) -> None:
        pass


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which lists and timers
    need; the session's own setting is put back afterwards."""
    before = spark.conf.get(_PROVIDER_CONF, None)
    spark.conf.set(_PROVIDER_CONF, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER_CONF)
        else:
            spark.conf.set(_PROVIDER_CONF, before)


def smooth_in_order(visible: DataFrame, time_col: str, delay: str) -> DataFrame:
    """``visible``: streaming rows ``(subject, frame_no, visivel, cx_raw, cy_raw)``
    and an event time. Every visible frame with its smoothed position and ``late``
    false, in frame order whatever order they came in; and every frame that came
    after the watermark had released a later one, with NULL positions and ``late``
    true.

    Repeated frames are late but for the first. Rows with a NULL frame number
    carry an event time only: a source that pauses sends one to have its last
    frames released. Start the stream inside ``rocksdb_state``.
    """
    ship_by_value(__name__)
    marked = visible.withWatermark(time_col, delay).select(
        # The time goes on as a plain number, so rows behind the watermark are not
        # thrown away but reach the state and are given out as late.
        "subject",
        "frame_no",
        F.unix_millis(F.col(time_col)).alias("at_ms"),
        F.coalesce("visivel", F.lit(False)).alias("visivel"),
        F.coalesce("cx_raw", F.lit(0)).cast("int").alias("cx_raw"),
        F.coalesce("cy_raw", F.lit(0)).cast("int").alias("cy_raw"),
    )
    return marked.groupBy("subject").transformWithStateInPandas(
        statefulProcessor=_OrderedSmoothing(), outputStructType=EMITTED_SCHEMA, outputMode="Append", timeMode="EventTime"
    )
