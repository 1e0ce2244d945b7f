"""Token ids in packed matrices: best-fit-decreasing over a segment tree.

Documents are encoded where they lie, closed with the end-of-document id and
split losslessly into segments of at most ``context`` tokens. The segments of a
group (``GROUP_TOKENS`` tokens) are placed longest first, each into the row
with the least remaining room that still holds it; a segment tree over the
rooms finds that row in log(context) steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.bpe import encoder

GROUP_TOKENS = 1 << 20

PACKED_SCHEMA = (
    "pack string, row int, input_ids binary, cu_seqlens array<int>, position_ids binary, "
    "doc_ids array<bigint>, segment_starts array<bigint>"
)


class Rooms:
    """Rows by the room they have left, in a segment tree over 0..capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [0] * (2 * self.leaves)  # rows below a node
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._count(room, 1)

    def best(self, need: int) -> tuple[int, int] | None:
        """Take out a row with the least room of at least ``need``: (room, row)."""
        k = self.leaves + need
        if not self.any[k]:
            while k > 1 and (k & 1 or not self.any[k + 1]):  # up to the first right sibling with rows
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.leaves:
                k = 2 * k if self.any[2 * k] else 2 * k + 1
        room = k - self.leaves
        row = self.rows[room].pop()
        self._count(room, -1)
        return room, row

    def _count(self, room: int, by: int) -> None:
        k = self.leaves + room
        while k:
            self.any[k] += by
            k >>= 1


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of segment numbers: best-fit-decreasing, ties in the given order."""
    rows: list[list[int]] = []
    rooms = Rooms(capacity)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        need = lengths[k]
        if not 0 < need <= capacity:
            raise ValueError(f"segment of {need} tokens")
        found = rooms.best(need)
        if found is None:
            room, row = capacity, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(k)
        rooms.put(room - need, row)
    return rows


def pack_documents(
    docs: DataFrame,
    end_id: int,
    context: int = 2048,
    ranks_path: str | None = None,
    pattern: str | None = None,
    dtype: str = "<u2",
    id_col: str = "doc_id",
    text_col: str = "text",
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Rows of packed matrices (``PACKED_SCHEMA``), ``context`` ids each.

    The ids are those of the byte-pair rank file with its pattern, or of the
    texts' UTF-8 bytes where none is given. input_ids and position_ids are
    ``dtype`` integers in binary, padded with ``end_id`` and 0; cu_seqlens holds 0 and the end of each segment;
    positions begin at 0 with each segment; doc_ids and segment_starts say which
    tokens of which document a segment holds. Every document ends in ``end_id``,
    so an empty or NULL text still has one token. Rows with a NULL id are packed
    with a NULL in doc_ids, repeated rows each on their own, other columns are
    ignored, an empty table gives no rows. A group is packed by the task that
    read it; its name is the task's partition and a count, the same in every
    attempt.
    """
    most = int(np.iinfo(np.dtype(dtype)).max)
    if context > most:
        raise ValueError(f"positions up to {context} do not fit {dtype}")
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe = encoder(ranks_path, pattern)
        part, count = TaskContext.get().partitionId(), 0
        held: list[tuple[int | None, int, np.ndarray]] = []
        size = 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for doc, ids in zip(batch.column("doc").to_pylist(), bpe.encode_batch(texts)):
                ids = np.append(ids, np.uint32(end_id))
                if int(ids.max()) > most:
                    raise ValueError(f"token id {int(ids.max())} does not fit {dtype}")
                for start in range(0, len(ids), context):
                    held.append((doc, start, ids[start : start + context]))
                    size += len(held[-1][2])
                    if size >= group_tokens:
                        yield _packed(held, context, end_id, dtype, f"{part}-{count}")
                        held, size, count = [], 0, count + 1
        if held:
            yield _packed(held, context, end_id, dtype, f"{part}-{count}")

    return source.mapInArrow(run, PACKED_SCHEMA)


def _packed(held, context: int, end_id: int, dtype: str, pack: str) -> pa.RecordBatch:
    rows = pack_lengths([len(ids) for _, _, ids in held], context)
    ids = np.full((len(rows), context), end_id, dtype)
    positions = np.zeros((len(rows), context), dtype)
    ends, docs, starts = [], [], []
    for r, row in enumerate(rows):
        at = [0]
        for k in row:
            segment = held[k][2]
            ids[r, at[-1] : at[-1] + len(segment)] = segment
            positions[r, at[-1] : at[-1] + len(segment)] = np.arange(len(segment))
            at.append(at[-1] + len(segment))
        ends.append(at)
        docs.append([held[k][0] for k in row])
        starts.append([held[k][1] for k in row])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([pack] * len(rows)),
            pa.array(range(len(rows)), pa.int32()),
            pa.array([x.tobytes() for x in ids], pa.binary()),
            pa.array(ends, pa.list_(pa.int32())),
            pa.array([x.tobytes() for x in positions], pa.binary()),
            pa.array(docs, pa.list_(pa.int64())),
            pa.array(starts, pa.list_(pa.int64())),
        ],
        names=["pack", "row", "input_ids", "cu_seqlens", "position_ids", "doc_ids", "segment_starts"],
    )
