"""Landmark heuristics on hand-built frames: no face, zero width, ratio
exactly 0.5, two hands with one label, open -> closed -> open smoothing,
pinch clamps."""

import pytest

from pyspark.sql import functions as F

from strata.operators import landmarks as lm

W, H = 640, 480
L_SCHEMA = "subject long, frame_no long, part string, label string, detection_idx int, landmark_id int, x double, y double"


def _frames(spark, n):
    return spark.createDataFrame([(1, f, W, H) for f in range(n)], "subject long, frame_no long, w int, h int")


def _face(frame, left, right, top, bottom):
    pts = {lm.MOUTH_LEFT: left, lm.MOUTH_RIGHT: right, lm.MOUTH_TOP: top, lm.MOUTH_BOTTOM: bottom}
    return [(1, frame, "face", None, None, k, x / W, y / H) for k, (x, y) in pts.items()]


def _hand(frame, label, det, open_hand=True, palm=(320, 240), thumb=(100, 100), index=(150, 100)):
    rows = []
    for tip, joint in lm.FINGER_PAIRS:
        ty, jy = (100, 200) if open_hand else (200, 100)
        rows.append((1, frame, "hand", label, det, tip, 0.3, ty / H))
        rows.append((1, frame, "hand", label, det, joint, 0.3, jy / H))
    rows = [r for r in rows if r[5] not in (lm.THUMB_TIP, lm.INDEX_TIP)]
    rows.append((1, frame, "hand", label, det, lm.THUMB_TIP, thumb[0] / W, (100 if open_hand else 200) / H))
    rows.append((1, frame, "hand", label, det, lm.INDEX_TIP, index[0] / W, (100 if open_hand else 200) / H))
    rows.append((1, frame, "hand", label, det, lm.MIDDLE_MCP, palm[0] / W, palm[1] / H))
    return rows


def test_expressions(spark):
    rows = (
        _face(1, (100, 200), (100, 200), (100, 200), (100, 200))  # zero width -> neutro
        + _face(2, (100, 200), (200, 200), (150, 180), (150, 230))  # ratio exactly 0.5 -> not surprised
        + _face(3, (100, 200), (200, 200), (150, 180), (150, 231))  # ratio 0.51 -> surpreso
        + _face(4, (100, 200), (230, 200), (150, 180), (150, 220))  # width 130, ratio 0.31 -> feliz
    )
    feats = lm.frame_features(_frames(spark, 5), spark.createDataFrame(rows, L_SCHEMA))
    got = {r.frame_no: r.expressao for r in lm.expression_label(feats).collect()}
    assert got == {0: "sem rosto", 1: "neutro", 2: "neutro", 3: "surpreso", 4: "feliz"}
    dist = {r.frame_no: (r.largura_boca, r.altura_boca) for r in lm.mouth_distances(feats).collect()}
    assert dist[4] == (130.0, 40.0)


def test_movements(spark):
    def pose(frame, lw, rw, ls, rs):
        pts = {lm.NOSE: (320, 50), lm.LEFT_WRIST: lw, lm.RIGHT_WRIST: rw, lm.LEFT_SHOULDER: ls, lm.RIGHT_SHOULDER: rs}
        return [(1, frame, "pose", None, None, k, x / W, y / H) for k, (x, y) in pts.items()]

    rows = (
        pose(1, (100, 100), (540, 100), (250, 200), (390, 200))  # both hands up, arms open
        + pose(2, (300, 300), (340, 300), (250, 200), (390, 200))  # crossed
        + pose(3, (200, 300), (440, 300), (250, 200), (390, 200))  # neutral
    )
    feats = lm.frame_features(_frames(spark, 4), spark.createDataFrame(rows, L_SCHEMA))
    got = {r.frame_no: r.movimentos for r in lm.movement_labels(feats).collect()}
    assert got[0] == ["sem corpo detectado"]
    assert got[1] == ["mão esquerda levantada", "mão direita levantada", "braços abertos"]
    assert got[2] == ["braço esquerdo cruzado", "braço direito cruzado"]
    assert got[3] == ["posição neutra"]


def test_fingers_first_hand_pinch_and_smoothing(spark):
    rows = []
    rows += _hand(0, "Left", 0, palm=(320, 240))
    rows += _hand(0, "Left", 1, open_hand=False)  # second 'Left' detection is ignored
    rows += _hand(1, "Left", 0, palm=(400, 240)) + _hand(1, "Right", 1, thumb=(100, 100), index=(110, 100))
    rows += _hand(2, "Left", 0, open_hand=False)  # closed: run ends
    rows += _hand(3, "Left", 0, palm=(100, 100)) + _hand(3, "Right", 0, thumb=(0, 100), index=(600, 100))
    rows += _hand(4, "Left", 0, palm=(200, 200))
    feats = lm.frame_features(_frames(spark, 6), spark.createDataFrame(rows, L_SCHEMA))
    fingers = {r.frame_no: (r.dedos_levantados, r.mao_aberta) for r in lm.raised_fingers(feats).collect()}
    assert fingers == {0: (5, True), 1: (5, True), 2: (0, False), 3: (5, True), 4: (5, True), 5: (0, False)}
    first = {(r.frame_no, r.label): r.detection_idx for r in lm.first_hand_per_label(spark.createDataFrame(rows, L_SCHEMA)).collect()}
    assert first[(0, "Left")] == 0
    scale = {r.frame_no: r.escala for r in lm.pinch_scale(feats).collect()}
    assert scale[0] == 1.5 and scale[1] == pytest.approx(0.7) and scale[3] == pytest.approx(3.0)
    smooth = {r.frame_no: (r.cx, r.cy) for r in lm.smoothed_position(lm.visible_frames(feats)).collect()}
    # frame 1: int(0.25*400 + 0.75*320) = 340; frame 3 restarts; frame 4: int(0.25*200 + 0.75*100) = 125 for both
    assert smooth == {0: (320, 240), 1: (340, 240), 3: (100, 100), 4: (125, 125)}
    pairs = lm.fingertip_pairs(feats).collect()
    assert sorted({r.frame_no for r in pairs}) == [1, 3] and len(pairs) == 10


def test_run_detection_across_chunks(spark):
    vis = spark.createDataFrame(
        [(1, f, f not in (3, 9), 10 * f, 10 * f) for f in range(12)],
        "subject long, frame_no long, visivel boolean, cx_raw int, cy_raw int",
    )
    a = {r.frame_no: r.run_start for r in lm.visible_runs(vis, chunk=4).collect()}
    b = {r.frame_no: r.run_start for r in lm.visible_runs(vis, chunk=1000).collect()}
    assert a == b and a[0] is None and a[4] == 3 and a[11] == 9


def _plain_smoothing(frames):
    """{(subject, frame): (x, y)} by the recurrence, one frame after another."""
    out, last = {}, {}
    for subject, frame, seen, x, y in sorted(frames, key=lambda f: (str(f[0]), f[1])):
        if not seen:
            last.pop(subject, None)
            continue
        before = last.get(subject, (x, y))
        last[subject] = out[subject, frame] = tuple(int(0.25 * r + 0.75 * p) for r, p in zip((x, y), before))
    return out


def test_smoothing_in_chunks_equals_the_recurrence(spark):
    import random

    rng = random.Random(11)
    frames = []
    for subject in (1, 2, None):
        base = 2**53 if subject == 2 else 0  # frame numbers that a double cannot hold
        for f in range(700):
            seen = rng.random() > (0.002 if subject == 1 else 0.1)
            frames.append((subject, base + f, seen, rng.randrange(-30, 640) if seen else None, rng.randrange(480) if seen else None))
    table = spark.createDataFrame(frames, "subject long, frame_no long, visivel boolean, cx_raw int, cy_raw int").repartition(3)
    want = _plain_smoothing(frames)
    for chunk in (5, 64, 1 << 16):
        got = {(r.subject, r.frame_no): (r.cx, r.cy) for r in lm.smoothed_position(table, chunk=chunk).collect()}
        assert got == want
    assert lm.smoothed_position(table.limit(0)).count() == 0


def test_one_long_run_is_smoothed_by_several_tasks(spark):
    n, chunk = 120_000, 10_000
    table = spark.range(n).select(
        F.lit(1).cast("long").alias("subject"), F.col("id").alias("frame_no"), F.lit(True).alias("visivel"),
        (F.col("id") * 7919 % 640).cast("int").alias("cx_raw"), (F.col("id") * 104729 % 480).cast("int").alias("cy_raw"),
    )
    out = lm.smoothed_position(table, chunk=chunk)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    try:
        tasks = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == n
    x = None
    want = []
    for i in range(n):
        raw = i * 7919 % 640
        x = raw if x is None else int(0.25 * raw + 0.75 * x)
        want.append(x)
    got = {r.frame_no: r.cx for r in out.filter(F.col("frame_no") % 997 == 0).collect()}
    assert got == {i: want[i] for i in range(0, n, 997)}
