"""Streaming palm-position smoothing: one state per subject.

Frames of a subject are expected in frame order over micro-batches. The state
is the last frame, the last smoothed point and whether a run is open; a frame
where the hand is gone or closed ends the run, the next visible frame starts a
new one with its raw value. A frame at or before the subject's last one has
come too late to be smoothed: it changes nothing and is given out as rejected.
With ``idle_minutes`` a subject that sends nothing for so long is forgotten, and
a later frame starts it afresh. That is for streams that run on: Spark keeps
running batches to look for timeouts, so an ``availableNow`` query would not end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strata.operators.landmarks import SMOOTH_ALPHA, ship_by_value

OUTPUT_SCHEMA = "subject long, frame_no long, cx int, cy int"
STATE_SCHEMA = "last_frame long, px int, py int, open boolean"
_EMITTED_SCHEMA = OUTPUT_SCHEMA + ", late boolean"


def _smooth_subject(
    key: tuple, batches: Iterator[pd.DataFrame], state: GroupState, idle_ms: int | None
) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    if state.exists:
        last_frame, px, py, is_open = state.get
    else:
        last_frame, px, py, is_open = None, 0, 0, False
    # Four numbers a frame of one subject's share of a micro-batch, which the source's
    # rate limit bounds; sorted once, whatever order the batches come in.
    columns = [[b[c].to_numpy() for c in ("frame_no", "visivel", "cx_raw", "cy_raw")] for b in batches]
    frames, seen, xs, ys = (np.concatenate(c) for c in zip(*columns))
    out = []
    for i in np.argsort(frames, kind="stable"):
        frame = int(frames[i])
        if last_frame is not None and frame <= last_frame:
            out.append((key[0], frame, None, None, True))
            continue
        last_frame = frame
        if not seen[i]:
            is_open = False
            continue
        if is_open:
            px = int(SMOOTH_ALPHA * xs[i] + (1 - SMOOTH_ALPHA) * px)
            py = int(SMOOTH_ALPHA * ys[i] + (1 - SMOOTH_ALPHA) * py)
        else:
            is_open, px, py = True, int(xs[i]), int(ys[i])
        out.append((key[0], frame, px, py, False))
    state.update((last_frame, px, py, is_open))
    if idle_ms is not None:
        state.setTimeoutDuration(idle_ms)
    types = {"subject": "int64", "frame_no": "int64", "cx": "Int32", "cy": "Int32", "late": "bool"}
    yield pd.DataFrame(out, columns=list(types)).astype(types)


def smooth_frames(visible: DataFrame, idle_minutes: float | None = None) -> DataFrame:
    """``visible``: streaming rows ``(subject, frame_no, visivel, cx_raw,
    cy_raw)``. Every visible frame with its smoothed position and ``late``
    false, and every frame that came too late (visible or not) with NULL
    positions and ``late`` true."""
    ship_by_value(__name__)
    idle_ms = None if idle_minutes is None else int(idle_minutes * 60_000)
    return visible.groupBy("subject").applyInPandasWithState(
        lambda key, batches, state: _smooth_subject(key, batches, state, idle_ms),
        _EMITTED_SCHEMA,
        STATE_SCHEMA,
        "append",
        GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout,
    )


def smooth_stream(visible: DataFrame, idle_minutes: float | None = None) -> DataFrame:
    """The smoothed position of every visible frame that came in order."""
    return smooth_frames(visible, idle_minutes).filter(~F.col("late")).drop("late")


def late_frames(visible: DataFrame, idle_minutes: float | None = None) -> DataFrame:
    """``(subject, frame_no)`` of the frames that came too late: the reject output."""
    return smooth_frames(visible, idle_minutes).filter("late").select("subject", "frame_no")
