"""Streams whose input comes out of order, again, or with more columns."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import landmarks as lm
from strata.plans import bindings as B
from strata.streaming import ordering
from strata.streaming import streams as st

from conftest import SF_SMALL

FRAMES = "subject long, frame_no long, visivel boolean, cx_raw int, cy_raw int, at timestamp"


def run(spark, src, out, ck, delay="10 seconds", max_files=None):
    with ordering.rocksdb_state(spark):
        stream = ordering.smooth_in_order(st.table_stream(spark, src, FRAMES, max_files), "at", delay)
        query = st.start_append(stream, out, ck, trigger={"availableNow": True})
    st.run_until_done(query)
    return sorted(map(tuple, spark.read.schema(ordering.EMITTED_SCHEMA).parquet(out).collect()), key=str)


def land(spark, src, rows):
    """(subject, frame, visible, x, y, second) rows."""
    df = spark.createDataFrame(rows, "subject long, frame_no long, visivel boolean, cx_raw int, cy_raw int, s double")
    df.withColumn("at", F.timestamp_millis((F.col("s") * 1000).cast("long"))).drop("s").coalesce(1).write.mode("append").parquet(src)


def test_any_arrival_equals_the_batch(spark, tmp_dir):
    feats = lm.frame_features(B.landmark_frames(spark, SF_SMALL), B.landmarks(spark, SF_SMALL))
    visible = lm.visible_frames(feats).withColumn("at", F.timestamp_millis(F.col("frame_no") * 40))
    # Frames arrive up to 100 frames late, in five files read one after another.
    arrival = F.col("frame_no") + F.pmod(F.xxhash64("subject", "frame_no"), F.lit(100))
    for lo in range(0, 1000, 120):
        visible.filter((arrival >= lo) & (arrival < lo + 120)).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/src")
    land(spark, f"{tmp_dir}/src", [(None, None, None, None, None, 10.0**6)])
    got = run(spark, f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck", delay="5 seconds", max_files=1)
    want = [(*r, False) for r in map(tuple, lm.smoothed_position(visible.drop("at")).collect())]
    assert got == sorted(want, key=str) and len(got) > 0


def test_frames_wait_and_only_later_ones_are_late(spark, tmp_dir):
    src, out, ck = (f"{tmp_dir}/{x}" for x in ("src", "out", "ck"))
    land(spark, src, [(1, 3, True, 200, 200, 3.0), (1, 1, True, 100, 100, 1.0)])
    assert run(spark, src, out, ck) == []  # the watermark is 10 seconds behind
    land(spark, src, [(1, 2, False, None, None, 2.0), (1, 4, True, 9, 9, 4.0), (2, 1, True, 5, 5, 13.5)])
    assert run(spark, src, out, ck) == [(1, 1, 100, 100, False), (1, 3, 200, 200, False)]  # frame 2 ended the run
    land(spark, src, [(1, 2, True, 0, 0, 2.0), (1, 5, True, 13, 13, 5.0), (1, 3, True, 1, 1, 3.0), (3, 1, True, 1, 1, 30.0)])
    got = run(spark, src, out, ck)
    assert [r for r in got if r[4]] == [(1, 2, None, None, True), (1, 3, None, None, True)]
    assert (1, 4, 152, 152, False) in got and (1, 5, 117, 117, False) in got and (2, 1, 5, 5, False) in got
    assert spark.conf.get(ordering._PROVIDER_CONF, None) != ordering._ROCKSDB


def test_the_sink_takes_new_and_wider_columns(spark, tmp_dir):
    src, sink, ck = (f"{tmp_dir}/{x}" for x in ("src", "sink", "ck"))

    def go(schema, *rows):
        spark.createDataFrame(list(rows), schema).write.mode("append").parquet(f"{src}/{len(schema)}")
        stream = st.table_stream(spark, f"{src}/{len(schema)}", schema)
        st.run_until_done(st.start_evolving_append(stream, sink, f"{ck}/{len(schema)}", trigger={"availableNow": True}))

    go("k int, a string", (1, "x"))
    go("k int, a string, b double", (2, "y", 2.5))
    go("k long, b double", (2**40, 3.5))
    rows = sorted(map(tuple, st.read_evolved(spark, sink).collect()))
    assert rows == [(1, "x", None), (2, "y", 2.5), (2**40, None, 3.5)]
    assert dict(st.read_evolved(spark, sink).dtypes) == {"k": "bigint", "a": "string", "b": "double"}
    with pytest.raises(Exception, match="does not fit"):
        go("k long, a int, b double", (4, 4, 4.0))
    with pytest.raises(FileNotFoundError):
        st.read_evolved(spark, f"{tmp_dir}/none")
    assert st.reconciled(spark.range(1), StructType()).columns == ["id"]


def test_the_stream_goes_on_where_its_checkpoint_is(spark, tmp_dir):
    src, sink, ck = (f"{tmp_dir}/{x}" for x in ("src", "sink", "ck"))
    for i, schema in enumerate(["k int, a string", "k int, a string, b double"]):
        spark.createDataFrame([(i, "x", 1.5)][:1], "k int, a string, b double").select(*[c.split()[0] for c in schema.split(", ")]).write.mode(
            "append"
        ).parquet(src)
        st.run_until_done(st.start_evolving_append(st.table_stream(spark, src, schema), sink, ck, trigger={"availableNow": True}))
    assert sorted(map(tuple, st.read_evolved(spark, sink).collect())) == [(0, "x", None), (1, "x", 1.5)]


def test_one_row_per_key_within_the_watermark(spark, tmp_dir):
    src, out, ck = (f"{tmp_dir}/{x}" for x in ("src", "out", "ck"))
    rng = random.Random(1)
    seen = []
    for batch in range(3):
        rows = [(k, batch * 60 + rng.randrange(60)) for k in range(batch * 5, batch * 5 + 10) for _ in range(3)]
        seen += rows
        spark.createDataFrame(rows, "k int, s int").select("k", F.timestamp_seconds("s").alias("at")).write.mode("append").parquet(src)
        stream = st.table_stream(spark, src, "k int, at timestamp").withWatermark("at", "10 minutes")
        st.run_until_done(st.start_append(st.one_per_key(stream, ["k"]), out, ck, trigger={"availableNow": True}))
    got = [r.k for r in spark.read.parquet(out).collect()]
    assert sorted(got) == sorted({k for k, _ in seen})
