"""Gesture, expression and position operators over landmark tables.

Input is a long table of detected points, ``(subject, frame_no, part, label,
detection_idx, landmark_id, x, y)`` with ``x, y`` normalised to [0, 1], and a
frame table ``(subject, frame_no, w, h)``. One ``groupBy(subject, frame_no)``
pivots each frame into a wide row (filtered aggregates, partial aggregation,
no self-join); every label is then a column expression. A frame is a bounded
group (a fixed number of landmarks), whatever the skew across subjects.

The smoothing of the palm position is a sequential recurrence (truncation at
each step). Runs of visible frames are found with a two-level scan, so no
task holds a whole subject, and a run is smoothed in chunks of frames: each
chunk is first summarised as the map from its incoming position to its last
one, the maps are chained, and the chunks are then smoothed side by side. All
passes stream over sorted partitions, one Arrow batch in memory.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import clamp, pixel_distance, trunc_int
from strata.session import ensure_checkpoint_dir

# Labels of the expression heuristic.
NO_FACE = "sem rosto"
NEUTRAL = "neutro"
SURPRISED = "surpreso"
HAPPY = "feliz"

# Labels of the movement heuristic, in output order.
LEFT_HAND_UP = "mão esquerda levantada"
RIGHT_HAND_UP = "mão direita levantada"
ARMS_OPEN = "braços abertos"
LEFT_ARM_CROSSED = "braço esquerdo cruzado"
RIGHT_ARM_CROSSED = "braço direito cruzado"
NEUTRAL_POSE = "posição neutra"
NO_BODY = "sem corpo detectado"

# Landmark numbering (public pose / hand / face-mesh models).
NOSE, LEFT_SHOULDER, RIGHT_SHOULDER, LEFT_WRIST, RIGHT_WRIST = 0, 11, 12, 15, 16
MOUTH_TOP, MOUTH_BOTTOM, MOUTH_LEFT, MOUTH_RIGHT = 13, 14, 61, 291
THUMB_TIP, INDEX_TIP, MIDDLE_TIP, RING_TIP, PINKY_TIP = 4, 8, 12, 16, 20
THUMB_IP, INDEX_PIP, MIDDLE_PIP, RING_PIP, PINKY_PIP = 3, 6, 10, 14, 18
MIDDLE_MCP = 9
FINGER_PAIRS = [
    (THUMB_TIP, THUMB_IP),
    (INDEX_TIP, INDEX_PIP),
    (MIDDLE_TIP, MIDDLE_PIP),
    (RING_TIP, RING_PIP),
    (PINKY_TIP, PINKY_PIP),
]
TIPS = [THUMB_TIP, INDEX_TIP, MIDDLE_TIP, RING_TIP, PINKY_TIP]

# Thresholds of the heuristics.
SURPRISE_RATIO = 0.5
SMILE_WIDTH_PX = 120
SMILE_RATIO = 0.25
ARMS_OPEN_FRACTION = 0.6
ARM_CROSSED_FRACTION = 0.25
OPEN_HAND_FINGERS = 4
PINCH_DIVISOR = 120.0
PINCH_MIN, PINCH_MAX, PINCH_DEFAULT = 0.7, 3.0, 1.5
SMOOTH_ALPHA = 0.25

_POSE_IDS = [NOSE, LEFT_SHOULDER, RIGHT_SHOULDER, LEFT_WRIST, RIGHT_WRIST]
_FACE_IDS = [MOUTH_TOP, MOUTH_BOTTOM, MOUTH_LEFT, MOUTH_RIGHT]
_LEFT_IDS = sorted({i for pair in FINGER_PAIRS for i in pair} | {MIDDLE_MCP})
_RIGHT_IDS = TIPS


def first_hand_per_label(landmarks: DataFrame) -> DataFrame:
    """The first detected hand of each handedness label in a frame:
    ``(subject, frame_no, label, detection_idx)``."""
    return (
        landmarks.filter(F.col("part") == "hand")
        .groupBy("subject", "frame_no", "label")
        .agg(F.min("detection_idx").alias("detection_idx"))
    )


def _point(part: str, lid: int, coord: str, label: str | None = None) -> Column:
    if label is None:
        return F.expr(f"max({coord}) FILTER (WHERE part = '{part}' AND landmark_id = {lid})")
    # Coordinate of the first detection with this label (lowest detection_idx).
    return F.expr(
        f"min_by({coord}, detection_idx) FILTER "
        f"(WHERE part = '{part}' AND label = '{label}' AND landmark_id = {lid})"
    )


def frame_features(frames: DataFrame, landmarks: DataFrame) -> DataFrame:
    """One wide row per frame: size, presence flags and the points the
    heuristics use (``pose_<id>_x``, ``face_<id>_y``, ``left_<id>_x``, ...).
    Hands are the first detection labelled Left / Right."""
    cols = ["subject", "frame_no", "w", "h", "part", "label", "detection_idx", "landmark_id", "x", "y"]
    framed = frames.select(
        "subject", "frame_no", "w", "h",
        F.lit(None).cast("string").alias("part"),
        F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("int").alias("detection_idx"),
        F.lit(None).cast("int").alias("landmark_id"),
        F.lit(None).cast("double").alias("x"),
        F.lit(None).cast("double").alias("y"),
    )
    pts = landmarks.select(
        "subject", "frame_no",
        F.lit(None).cast("int").alias("w"),
        F.lit(None).cast("int").alias("h"),
        "part", "label", "detection_idx", "landmark_id", "x", "y",
    ).select(*cols)
    aggs = [
        F.max("w").alias("w"),
        F.max("h").alias("h"),
        F.coalesce(F.max(F.col("part") == "pose"), F.lit(False)).alias("has_pose"),
        F.coalesce(F.max(F.col("part") == "face"), F.lit(False)).alias("has_face"),
        F.coalesce(F.max((F.col("part") == "hand") & (F.col("label") == "Left")), F.lit(False)).alias("has_left"),
        F.coalesce(F.max((F.col("part") == "hand") & (F.col("label") == "Right")), F.lit(False)).alias("has_right"),
    ]
    for lid in _POSE_IDS:
        aggs += [_point("pose", lid, c).alias(f"pose_{lid}_{c}") for c in ("x", "y")]
    for lid in _FACE_IDS:
        aggs += [_point("face", lid, c).alias(f"face_{lid}_{c}") for c in ("x", "y")]
    for lid in _LEFT_IDS:
        aggs += [_point("hand", lid, c, "Left").alias(f"left_{lid}_{c}") for c in ("x", "y")]
    for lid in _RIGHT_IDS:
        aggs += [_point("hand", lid, c, "Right").alias(f"right_{lid}_{c}") for c in ("x", "y")]
    # Frames without a frame row (landmarks of unknown frames) are dropped.
    return framed.unionByName(pts).groupBy("subject", "frame_no").agg(*aggs).filter(F.col("w").isNotNull())


def _dist(wide_prefix_a: str, a: int, wide_prefix_b: str, b: int) -> Column:
    return pixel_distance(
        f"{wide_prefix_a}_{a}_x", f"{wide_prefix_a}_{a}_y", f"{wide_prefix_b}_{b}_x", f"{wide_prefix_b}_{b}_y", "w", "h"
    )


def mouth_distances(features: DataFrame) -> DataFrame:
    """Pixel width (corner to corner) and height (top to bottom) of the mouth,
    for frames with a face; coordinates truncated to whole pixels first."""
    return features.filter("has_face").select(
        "subject",
        "frame_no",
        _dist("face", MOUTH_LEFT, "face", MOUTH_RIGHT).alias("largura_boca"),
        _dist("face", MOUTH_TOP, "face", MOUTH_BOTTOM).alias("altura_boca"),
    )


def expression_label(features: DataFrame) -> DataFrame:
    """surprised when height/width > 0.5; happy when width > 120 px and the
    ratio > 0.25; else neutral (also for a zero width); no face -> 'sem rosto'."""
    width = _dist("face", MOUTH_LEFT, "face", MOUTH_RIGHT)
    height = _dist("face", MOUTH_TOP, "face", MOUTH_BOTTOM)
    ratio = height / width
    label = (
        F.when(~F.col("has_face"), NO_FACE)
        .when(width == 0, NEUTRAL)
        .when(ratio > SURPRISE_RATIO, SURPRISED)
        .when((width > SMILE_WIDTH_PX) & (ratio > SMILE_RATIO), HAPPY)
        .otherwise(NEUTRAL)
    )
    return features.select("subject", "frame_no", label.alias("expressao"))


def movement_labels(features: DataFrame) -> DataFrame:
    """Array of movement labels per frame, in rule order; 'posição neutra'
    when none applies, 'sem corpo detectado' without a body."""
    w = F.col("w")
    checks = [
        (F.col(f"pose_{LEFT_WRIST}_y") < F.col(f"pose_{LEFT_SHOULDER}_y"), LEFT_HAND_UP),
        (F.col(f"pose_{RIGHT_WRIST}_y") < F.col(f"pose_{RIGHT_SHOULDER}_y"), RIGHT_HAND_UP),
        (_dist("pose", LEFT_WRIST, "pose", RIGHT_WRIST) > w * ARMS_OPEN_FRACTION, ARMS_OPEN),
        (_dist("pose", LEFT_WRIST, "pose", RIGHT_SHOULDER) < w * ARM_CROSSED_FRACTION, LEFT_ARM_CROSSED),
        (_dist("pose", RIGHT_WRIST, "pose", LEFT_SHOULDER) < w * ARM_CROSSED_FRACTION, RIGHT_ARM_CROSSED),
    ]
    found = F.filter(F.array(*[F.when(cond, F.lit(text)) for cond, text in checks]), lambda v: v.isNotNull())
    labels = (
        F.when(~F.col("has_pose"), F.array(F.lit(NO_BODY)))
        .when(F.size(found) == 0, F.array(F.lit(NEUTRAL_POSE)))
        .otherwise(found)
    )
    return features.select("subject", "frame_no", labels.alias("movimentos"))


def _fingers_up() -> Column:
    up = [
        F.when(F.col(f"left_{tip}_y") < F.col(f"left_{joint}_y"), 1).otherwise(0) for tip, joint in FINGER_PAIRS
    ]
    total = up[0]
    for u in up[1:]:
        total = total + u
    return F.when(F.col("has_left"), total).otherwise(0)


def raised_fingers(features: DataFrame) -> DataFrame:
    """Raised fingers of the left hand (tip above its joint), 0 without a left
    hand; the hand is open with 4 or more."""
    n = _fingers_up()
    return features.select(
        "subject", "frame_no", n.alias("dedos_levantados"), (n >= OPEN_HAND_FINGERS).alias("mao_aberta")
    )


def pinch_scale(features: DataFrame) -> DataFrame:
    """Right-hand thumb-to-index distance in pixels (not truncated) / 120,
    clamped to [0.7, 3.0]; 1.5 without a right hand."""
    dist = pixel_distance(
        f"right_{THUMB_TIP}_x", f"right_{THUMB_TIP}_y", f"right_{INDEX_TIP}_x", f"right_{INDEX_TIP}_y",
        "w", "h", truncate=False,
    )
    scale = F.when(F.col("has_right"), clamp(dist / F.lit(PINCH_DIVISOR), PINCH_MIN, PINCH_MAX)).otherwise(
        F.lit(PINCH_DEFAULT)
    )
    return features.select("subject", "frame_no", scale.alias("escala"))


def visible_frames(features: DataFrame) -> DataFrame:
    """Frames where the left hand is present and open; with the palm (middle
    finger MCP) in whole pixels."""
    visible = F.col("has_left") & (_fingers_up() >= OPEN_HAND_FINGERS)
    return features.select(
        "subject",
        "frame_no",
        visible.alias("visivel"),
        F.when(visible, trunc_int(F.col(f"left_{MIDDLE_MCP}_x") * F.col("w"))).alias("cx_raw"),
        F.when(visible, trunc_int(F.col(f"left_{MIDDLE_MCP}_y") * F.col("h"))).alias("cy_raw"),
    )


def fingertip_pairs(features: DataFrame) -> DataFrame:
    """For frames with both hands: one row per fingertip with the left and
    right tip in whole pixels."""
    both = features.filter(F.col("has_left") & F.col("has_right"))
    pairs = F.array(
        *[
            F.struct(
                F.lit(t).alias("landmark_id"),
                trunc_int(F.col(f"left_{t}_x") * F.col("w")).alias("x1"),
                trunc_int(F.col(f"left_{t}_y") * F.col("h")).alias("y1"),
                trunc_int(F.col(f"right_{t}_x") * F.col("w")).alias("x2"),
                trunc_int(F.col(f"right_{t}_y") * F.col("h")).alias("y2"),
            )
            for t in TIPS
        ]
    )
    return both.select("subject", "frame_no", F.inline(pairs))


# --- smoothing ---------------------------------------------------------------

# Frames per scan chunk of the run detection: bounds the rows of one window.
RUN_CHUNK = 1 << 16


def visible_runs(visible: DataFrame, chunk: int = RUN_CHUNK) -> DataFrame:
    """Tag each visible frame with ``run_start``: the last non-visible frame
    of its subject before it (NULL for a run at the start).

    A running max split in two levels: within ``(subject, frame_no div chunk)``
    by a window, across chunks from a table with one row per subject-chunk.
    """
    v = visible.withColumn("_chunk", F.floor(F.col("frame_no") / F.lit(chunk)).cast("bigint"))
    hidden = F.when(~F.col("visivel"), F.col("frame_no"))
    w_in = (
        Window.partitionBy("subject", "_chunk").orderBy("frame_no").rowsBetween(Window.unboundedPreceding, 0)
    )
    local = v.withColumn("_in_chunk", F.max(hidden).over(w_in))
    per_chunk = v.groupBy("subject", "_chunk").agg(F.max(hidden).alias("_chunk_last"))
    w_carry = Window.partitionBy("subject").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(
        F.col("subject").alias("_subject"), F.col("_chunk").alias("_of"), F.max("_chunk_last").over(w_carry).alias("_carry")
    )
    same = F.col("subject").eqNullSafe(F.col("_subject")) & (F.col("_chunk") == F.col("_of"))
    tagged = local.join(carry, same, "left")
    return tagged.filter("visivel").select(
        "subject", "frame_no", "cx_raw", "cy_raw", F.coalesce("_in_chunk", "_carry").alias("run_start"),
        F.col("_chunk").alias("chunk"),
    )


def _step(raw: int, position: int) -> int:
    """One smoothing step, truncating."""
    return int(SMOOTH_ALPHA * raw + (1 - SMOOTH_ALPHA) * position)


class _ChunkMap:
    """The map from a chunk's incoming position, any whole number in [low, high],
    to its last one, in constant space.

    A step is monotone and brings two positions a quarter nearer, so the paths
    from both extremes close in on each other. Until they are ``NEAR`` apart (after
    at most some 150 frames, whatever the range) the raw positions are kept as they
    are, in ``head``; from there on the map is a staircase over the few positions
    between the two paths: ``starts`` and the end that each leads to."""

    NEAR = 8

    def __init__(self, low: int, high: int):
        self.low, self.high = low, high
        self.head: list[int] = []
        self.starts: list[int] = []
        self.ends: list[int] = []

    def step(self, raw: int) -> None:
        if len(self.ends) == 1:  # one stair is left
            self.ends[0] = _step(raw, self.ends[0])
            return
        if self.ends:
            ends = [_step(raw, e) for e in self.ends]
            new = [k for k, e in enumerate(ends) if not k or e != ends[k - 1]]
            self.starts, self.ends = [self.starts[k] for k in new], [ends[k] for k in new]
            return
        self.head.append(raw)
        self.low, self.high = _step(raw, self.low), _step(raw, self.high)
        if self.high - self.low <= self.NEAR:
            self.starts = list(range(self.low, self.high + 1))
            self.ends = list(self.starts)


def _follow(head, starts, ends, position: int) -> int:
    """Where a chunk map leads from an incoming position."""
    for raw in head:
        position = _step(raw, position)
    return int(ends[np.searchsorted(starts, position, side="right") - 1]) if len(starts) else position


_MAP_PARTS = ("head", "starts", "ends")
CHUNK_MAP_SCHEMA = "subject bigint, run_start bigint, chunk bigint, first_x bigint, first_y bigint, " + ", ".join(
    f"{part}_{axis} array<bigint>" for axis in "xy" for part in _MAP_PARTS
)


def _chunk_maps(batches: Iterator[pd.DataFrame], low: int, high: int) -> Iterator[pd.DataFrame]:
    """One row per chunk over rows sorted by (subject, run_start, chunk,
    frame_no): its first raw position and the maps of both coordinates."""
    key, maps, done = None, None, []

    def row():
        return (*key, *firsts, *[getattr(m, part) for m in maps for part in _MAP_PARTS])

    names = [c.split()[0] for c in CHUNK_MAP_SCHEMA.split(", ")]
    for pdf in batches:
        for *k, rx, ry in zip(*(pdf[c].tolist() for c in ("subject", "run_start", "chunk", "cx_raw", "cy_raw"))):
            if k != key:
                if key is not None:
                    done.append(row())
                key, maps, firsts = k, (_ChunkMap(low, high), _ChunkMap(low, high)), (rx, ry)
            maps[0].step(rx)
            maps[1].step(ry)
        if done:
            yield pd.DataFrame(done, columns=names)
            done = []
    if key is not None:
        yield pd.DataFrame([row()], columns=names)


def _chain_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The incoming position of each chunk, over chunk maps sorted by (subject,
    run_start, chunk). A run's first chunk comes in at its own first raw
    position: a step from a position to itself stays there."""
    run, x, y = None, 0, 0
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            if (r.subject, r.run_start) != run:
                run, x, y = (r.subject, r.run_start), r.first_x, r.first_y
            out.append((r.subject, r.run_start, r.chunk, x, y))
            x, y = _follow(r.head_x, r.starts_x, r.ends_x, x), _follow(r.head_y, r.starts_y, r.ends_y, y)
        yield pd.DataFrame(out, columns=["subject", "run_start", "chunk", "in_x", "in_y"])


def _smooth_partitions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Exponential smoothing over rows sorted by (subject, run_start, chunk,
    frame_no): every frame is ``int(0.25 * raw + 0.75 * previous)``. A chunk begins
    with the row of its incoming position (no frame number). State carries
    across batches."""
    px = py = 0
    for pdf in batches:
        rows = [pdf[c].tolist() for c in ("subject", "frame_no", "chunk_in", "cx_raw", "cy_raw")]
        out = []
        for subject, frame, comes_in, rx, ry in zip(*rows):
            if comes_in:
                px, py = rx, ry
                continue
            px, py = _step(rx, px), _step(ry, py)
            out.append((subject, frame, px, py))
        yield pd.DataFrame(out, columns=["subject", "frame_no", "cx", "cy"])


def ship_by_value(module_name: str) -> None:
    """Pickle the module's functions by value, so Python workers run them
    without the package installed on the executors."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def smoothed_position(visible: DataFrame, materialize: bool = True, chunk: int = RUN_CHUNK) -> DataFrame:
    """Smoothed palm position per visible frame, restarting after every frame
    where the hand is gone or closed. A run is as many tasks as it has chunks of
    ``chunk`` frame numbers."""
    ship_by_value(__name__)
    if materialize:
        # One small row per frame; the branches below read it instead of re-running
        # the landmark pivot.
        ensure_checkpoint_dir(visible.sparkSession)
        visible = visible.checkpoint(eager=True)
    # NULL subjects and starts go as plain integers, so frame numbers never become floats.
    no = F.lit(-(2**63))
    by = ["subject", "run_start", "chunk"]
    runs = visible_runs(visible, chunk).select(
        F.coalesce("subject", no).alias("subject"), F.coalesce("run_start", no).alias("run_start"),
        "chunk", "frame_no", F.col("cx_raw").cast("bigint"), F.col("cy_raw").cast("bigint"),
    )
    low, high = runs.agg(F.min(F.least("cx_raw", "cy_raw")), F.max(F.greatest("cx_raw", "cy_raw"))).first()
    low, high = low or 0, high or 0
    maps = runs.repartition(*by).sortWithinPartitions(*by, "frame_no").mapInPandas(
        lambda b: _chunk_maps(b, low, high), CHUNK_MAP_SCHEMA
    )
    incoming = (
        maps.repartition("subject", "run_start")
        .sortWithinPartitions(*by)
        .mapInPandas(_chain_chunks, "subject bigint, run_start bigint, chunk bigint, in_x bigint, in_y bigint")
    )
    # The incoming position travels with the chunk's frames, as its first row: no join.
    frames = runs.withColumn("chunk_in", F.lit(False)).unionByName(
        incoming.select(*by, no.alias("frame_no"), F.col("in_x").alias("cx_raw"), F.col("in_y").alias("cy_raw"), F.lit(True).alias("chunk_in"))
    )
    ready = frames.repartition(*by).sortWithinPartitions(*by, F.desc("chunk_in"), "frame_no")
    out = ready.mapInPandas(_smooth_partitions, "subject bigint, frame_no bigint, cx int, cy int")
    return out.withColumn("subject", F.nullif("subject", no))
