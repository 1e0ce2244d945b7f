"""Structured Streaming: JSON append stream with checkpoint restart, complete
mode product-month, and the stateful smoothing stream."""

import json
import os

from pyspark.sql import functions as F

from strata.operators import landmarks as lm
from strata.plans import bindings as B
from strata.plans import retail as lj
from strata.sources import snapshots as snap
from strata.streaming import smoothing, streams as st

from conftest import SF_SMALL


def _write_json(path, name, records):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for r in records:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def _run_append(spark, landing, sink, ckpt):
    q = st.start_append(st.orders_stream(spark, landing, max_files=1), sink, ckpt, trigger={"availableNow": True})
    st.run_until_done(q)
    return spark.read.parquet(sink)


def test_append_restart_late_rows_and_malformed_fields(spark, tmp_dir):
    landing, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    _write_json(landing, "a.json", [
        {"order_id": 1, "customer_id": 1, "product": "p", "amount": 10.5, "status": "ok", "event_time": "2024-01-01T12:00:00"},
        {"order_id": 2, "customer_id": 1, "product": "p", "amount": "n/a", "status": "ok", "event_time": "2024-01-01T12:01:00", "extra": 1},
    ])
    out = _run_append(spark, landing, sink, ckpt)
    assert out.count() == 2
    assert out.filter("order_id = 2").collect()[0].amount is None  # malformed field -> NULL, row kept
    # A row far behind the watermark, in a new file; restart on the same checkpoint.
    _write_json(landing, "b.json", [
        {"order_id": 3, "customer_id": 2, "product": "q", "amount": 1.0, "status": "ok", "event_time": "2023-12-31T00:00:00"},
    ])
    out = _run_append(spark, landing, sink, ckpt)
    assert sorted(r.order_id for r in out.collect()) == [1, 2, 3]  # late row kept, nothing duplicated
    out = _run_append(spark, landing, sink, ckpt)
    assert out.count() == 3  # a rerun with no new files adds nothing


def test_complete_mode_product_month_equals_batch(spark, tmp_dir):
    silver = lj.silver_retail(B.lj_vendas_raw(spark, SF_SMALL))
    src, gold = f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    halves = silver.randomSplit([0.5, 0.5], seed=3)
    halves[0].write.parquet(src)
    stream = st.table_stream(spark, src, silver.schema, max_files=1)
    q = st.start_complete(lj.product_month(stream), gold, f"{tmp_dir}/ck", trigger={"availableNow": True})
    st.run_until_done(q)
    halves[1].write.mode("append").parquet(src)
    q = st.start_complete(lj.product_month(st.table_stream(spark, src, silver.schema, max_files=1)), gold,
                          f"{tmp_dir}/ck", trigger={"availableNow": True})
    st.run_until_done(q)
    got = sorted(map(tuple, snap.read_snapshot(spark, gold).collect()))
    want = sorted(map(tuple, lj.product_month(silver).collect()))
    assert got == want
    ops = {r.operation for r in snap.snapshot_history(spark, gold).collect()}
    assert ops == {"STREAMING UPDATE"}


def _gold(spark, src, gold, ckpt):
    stream = st.table_stream(spark, src, "k long, v long")
    q = st.start_complete(stream.groupBy("k").agg(F.sum("v").alias("v")), gold, ckpt, trigger={"availableNow": True})
    st.run_until_done(q)
    return sorted(map(tuple, snap.read_snapshot(spark, gold).collect()))


def test_complete_sink_replays_and_new_checkpoints(spark, tmp_dir):
    src, gold, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/gold", f"{tmp_dir}/ck"
    spark.createDataFrame([(1, 1)], "k long, v long").write.parquet(src)
    assert _gold(spark, src, gold, ckpt) == [(1, 1)]
    # A crash after the snapshot's commit and before the stream's own.
    os.remove(f"{ckpt}/commits/0")
    if os.path.exists(f"{ckpt}/commits/.0.crc"):
        os.remove(f"{ckpt}/commits/.0.crc")
    assert _gold(spark, src, gold, ckpt) == [(1, 1)]
    assert snap.snapshot_history(spark, gold).count() == 1
    spark.createDataFrame([(1, 100), (2, 5)], "k long, v long").write.mode("append").parquet(src)
    assert _gold(spark, src, gold, ckpt) == [(1, 101), (2, 5)]
    # A new checkpoint on the same gold: its batches are the next versions.
    assert _gold(spark, src, gold, f"{tmp_dir}/ck2") == [(1, 101), (2, 5)]
    assert snap.snapshot_history(spark, gold).count() == 3


def test_wait_for_any_stream(spark, tmp_dir):
    spark.createDataFrame([(1, 1)], "k long, v long").write.parquet(f"{tmp_dir}/src")
    spark.streams.resetTerminated()
    q = st.start_append(st.table_stream(spark, f"{tmp_dir}/src", "k long, v long"), f"{tmp_dir}/out", f"{tmp_dir}/ck",
                        trigger={"availableNow": True})
    assert st.wait_for_any(spark, 60) and not q.isActive


def test_smoothing_stream_equals_batch(spark, tmp_dir):
    feats = lm.frame_features(B.landmark_frames(spark, SF_SMALL), B.landmarks(spark, SF_SMALL))
    visible = lm.visible_frames(feats)
    src = f"{tmp_dir}/visible"
    # Frames land in order, in three files written one after another.
    bounds = [0, 150, 300, 10**9]
    for lo, hi in zip(bounds, bounds[1:]):
        visible.filter((F.col("frame_no") >= lo) & (F.col("frame_no") < hi)).coalesce(1).write.mode("append").parquet(src)
    stream = st.table_stream(spark, src, visible.schema, max_files=1)
    q = (smoothing.smooth_stream(stream).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{tmp_dir}/ck").option("path", f"{tmp_dir}/out")
         .trigger(availableNow=True).start())
    st.run_until_done(q)
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/out").collect()))
    want = sorted(map(tuple, lm.smoothed_position(visible).collect()))
    assert got == want and len(got) > 0


def test_late_frames_are_rejected_and_change_nothing(spark, tmp_dir):
    schema = "subject long, frame_no long, visivel boolean, cx_raw int, cy_raw int"
    src = f"{tmp_dir}/frames"

    def land(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(src)
        q = (smoothing.smooth_frames(st.table_stream(spark, src, schema)).writeStream.format("parquet")
             .outputMode("append").option("checkpointLocation", f"{tmp_dir}/ck").option("path", f"{tmp_dir}/out")
             .trigger(availableNow=True).start())
        st.run_until_done(q)

    land((1, 3, True, 200, 200), (1, 1, True, 100, 100))  # one batch: put in order
    land((1, 2, True, 0, 0), (1, 3, True, 9, 9), (2, 1, True, 5, 5))
    land((1, 4, True, 400, 400))
    rows = {(r.subject, r.frame_no, r.late): (r.cx, r.cy) for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert rows == {
        (1, 1, False): (100, 100), (1, 3, False): (125, 125), (1, 2, True): (None, None), (1, 3, True): (None, None),
        (2, 1, False): (5, 5), (1, 4, False): (193, 193),
    }
