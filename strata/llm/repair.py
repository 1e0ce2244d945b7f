"""Repair of conversations by weighted interval parsing.

A repaired conversation's role initials follow ``(s?(ua)+)?``. Edits of a turn:
Keep (0), Rerole to user or assistant (1), Delete (2); an empty user or
assistant turn may be Inserted anywhere (5); a truncated turn that stays adds 5.

The repair grammar is in Chomsky normal form. Its nonterminals are the pairs
[p, q] of the language's states; [p, r] -> [p, q] [q, r] joins two adjacent spans
and [p, q] -> edit covers one turn. A span's cell holds, for each nonterminal,
the least (cost, audit) that derives the span, closed under insertions on both
sides, and cells are combined bottom-up by span length. In this grammar every
cut of a span gives the same cell (joining is associative), so of all cuts only
one at a power of two is tried. A cell depends on the kinds of its turns alone,
so cells of equal spans are shared.

Two audits of one span and cost never are prefixes of one another (a longer one
would have paid for its insertions), so the least audit of a joined span is the
join of the least ones.

A conversation goes to one task, as its digest is one chain; the task reads its
turns in order, parses them in chunks and joins the chunks' cells, so a
conversation of any length takes bounded memory beside its audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
CHUNK = 4096  # turns parsed together

# States: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an
# assistant turn; 0 and 3 accept.
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
Cell = dict[tuple[int, int], tuple[int, str]]


def _join(left: Cell, right: Cell) -> Cell:
    out: Cell = {}
    for (p, q), (cost, audit) in left.items():
        for r in range(4):
            more = right.get((q, r))
            if more is not None:
                new = (cost + more[0], audit + more[1])
                if (p, r) not in out or new < out[p, r]:
                    out[p, r] = new
    return out


def _inserted() -> Cell:
    """The cell of an empty span: any number of insertions."""
    cell: Cell = {(q, q): (0, "") for q in range(4)}
    once: Cell = dict(cell)
    for role in "ua":
        for p, q in STEPS[role].items():
            once[p, q] = (INSERT, "I")
    for _ in range(4):
        cell = _join(cell, once)
    return cell


EMPTY = _inserted()


@lru_cache(maxsize=1 << 15)
def span_cell(kinds: str) -> Cell:
    """The cell of a span of turns. A turn's kind is ``s``, ``u``, ``a`` or ``o``
    (another role) by its initial, in upper case if it is truncated, or ``x`` if
    it has to be deleted."""
    if not kinds:
        return EMPTY
    if len(kinds) > 1:
        cut = 1 << ((len(kinds) - 1).bit_length() - 1)
        return _join(span_cell(kinds[:cut]), span_cell(kinds[cut:]))
    cell: Cell = {(q, q): (DELETE, "D") for q in range(4)}
    if kinds != "x":
        more = TRUNCATED if kinds.isupper() else 0
        for role in "ua":
            for p, q in STEPS[role].items():
                cell[p, q] = (REROLE + more, "R")
        for p, q in STEPS.get(kinds.lower(), {}).items():
            cell[p, q] = (more, "K")
    return _join(_join(EMPTY, cell), EMPTY)


def damage(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """(``id_col``, ``turn_col``, role, text, present): turns with seeded faults.

    crc32 of ``conv_id:turn`` modulo 20 decides: 0 drops the turn (present is
    false; it only names its conversation), 1 empties the text, 2 removes its
    ``.!?``, 3 repeats the turn, 4 makes its role user. A NULL role or text is one
    space, and so is a NULL id or turn in the crc32's text. Empty tables give no
    rows; other columns are ignored.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (id_col, turn_col)]
    key = F.concat(parts[0], F.lit(":"), parts[1])
    fault = F.pmod(F.crc32(F.encode(key, "UTF-8")), F.lit(20))
    rows = turns.select(
        F.col(id_col).alias("_conv"),
        F.col(turn_col).cast("long").alias("_at"),
        fault.alias("_fault"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("_role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("_text"),
    )
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text"))
    copies = F.explode(F.array_repeat(F.lit(True), F.when(F.col("_fault") == 3, 2).otherwise(1)))
    present = F.col("_fault") != 0
    return rows.select(
        F.col("_conv").alias(id_col),
        F.col("_at").alias(turn_col),
        F.when(F.col("_fault") == 4, "user").otherwise(F.col("_role")).alias("role"),
        F.when(present, text).otherwise("").alias("text"),
        present.alias("present"),
        copies.alias("_copy"),
    ).drop("_copy")


_SPACE = " \t\n\x0b\x0c\r"


def _judged(turns: DataFrame, id_col: str, turn_col: str) -> DataFrame:
    """(conv, at, role, text, present, fault, kind), a conversation's turns in one
    partition, sorted by turn (NULLs first), role and text."""
    names = {c.lower() for c in turns.columns}
    rows = turns.select(
        F.col(id_col).alias("conv"),
        F.col(turn_col).cast("long").alias("at"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.coalesce(F.col("present").cast("boolean"), F.lit(True)) if "present" in names else F.lit(True)).alias("present"),
    ).repartition("conv")
    # The hash partitioning by conversation serves the window too: one shuffle in all.
    same = Window.partitionBy("conv", "role", "text", "present").orderBy(F.col("at").asc_nulls_first())
    last = F.substring(F.rtrim(F.col("text"), F.lit(_SPACE)), -1, 1)
    fault = (
        F.when(F.length(F.translate("text", _SPACE, "")) == 0, "b")
        .when(F.row_number().over(same) > 1, "d")
        .when(~last.isin(".", "!", "?"), "t")
        .otherwise("")
    )
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return (
        rows.withColumn("fault", fault)
        .withColumn("kind", F.when(F.col("fault").isin("b", "d"), "x").when(F.col("fault") == "t", F.upper(known)).otherwise(known))
        .sortWithinPartitions(F.col("conv").asc_nulls_first(), F.col("at").asc_nulls_first(), "role", "text")
    )


class _Conversation:
    """One conversation read in order: its counts, and for each state that its
    repaired beginning may be in the least (cost, audit) and the digest so far."""

    def __init__(self, chunk: int):
        self.chunk = chunk
        self.least = self.most = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None
        self.rows: list[tuple[str, bytes]] = []
        self.kinds: list[str] = []
        self.paths = {0: (0, "", hashlib.sha256())}

    def add(self, at: int | None, role: str, text: bytes, fault: str, kind: str) -> None:
        if at is not None:
            if self.least is None:
                self.least = at
            if at != self.turn:
                self.turns += 1
            self.most = self.turn = at
        self.blank += fault == "b"
        self.duplicate += fault == "d"
        self.truncated += fault == "t"
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if len(self.rows) == self.chunk:
            self._parse(range(4))
        self.rows.append((role, text))
        self.kinds.append(kind)

    def _parse(self, ends) -> None:
        """Join the cell of the chunk's turns to the paths so far."""
        cell = span_cell("".join(self.kinds))
        paths = {}
        for end in ends:
            best = None
            for start, (cost, audit, _) in self.paths.items():
                more = cell.get((start, end))
                if more is not None:
                    new = (cost + more[0], audit + more[1], start, more[1])
                    if best is None or new < best:
                        best = new
            if best is not None:
                paths[end] = (best[0], best[1], self._digest(best[2], best[3]))
        self.paths, self.rows, self.kinds = paths, [], []

    def _digest(self, state: int, audit: str):
        out = self.paths[state][2].copy()
        at = 0
        for edit in audit:
            if edit == "D":
                at += 1
                continue
            role, text = ("assistant" if state == 2 else "user"), b""
            if edit != "I":
                role, text = (self.rows[at][0] if edit == "K" else role), self.rows[at][1]
                at += 1
            out.update(b"\n" if state else b"")
            out.update(role.encode() + b":" + text)
            state = STEPS[role[:1]][state]
        return out

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        # Which end is cheaper is known before the last chunk is read out.
        cell = span_cell("".join(self.kinds))
        ends = {}
        for end in (0, 3):
            found = [(c + cell[s, end][0], a + cell[s, end][1]) for s, (c, a, _) in self.paths.items() if (s, end) in cell]
            if found:
                ends[end] = min(found)
        end = min(ends, key=ends.get)
        self._parse([end])
        cost, audit, digest = self.paths[end]
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest.hexdigest()


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair_conversations(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", chunk: int = CHUNK
) -> DataFrame:
    """One row per conversation: ``id_col``, gaps, blank, duplicate, truncated,
    illegal, cost (longs), audit, repaired_sha256.

    ``turns`` has ``id_col``, ``turn_col``, role, text and, if some rows only name
    their conversation, a boolean present (false there; NULL: true). Turns are
    taken by ``turn_col``, NULLs first, ties by role and text. A NULL role or text
    is one space; rows with a NULL id are one conversation. A turn is blank,
    else duplicate (role and text seen earlier), else truncated. A role that does
    not begin with s, u or a cannot be kept. A conversation without turns gives
    zeros, the empty audit and the digest of the empty string; an empty table
    gives no rows. Repeated rows are turns like any other; other columns are
    ignored.
    """
    rows = _judged(turns, id_col, turn_col).select("conv", "at", "role", F.col("text").cast("binary").alias("text"), "present", "fault", "kind")
    schema = rows.select(
        "conv", *[F.lit(0).cast("long").alias(c) for c in _COUNTS], F.lit("").alias("audit"), F.lit("").alias("repaired_sha256")
    ).schema
    kind = turns.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        arrow = None
        now, held = None, None

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found))
            arrays = [pa.array(columns[0], arrow), *[pa.array(c, pa.int64()) for c in columns[1:7]]]
            return pa.RecordBatch.from_arrays([*arrays, *[pa.array(c, pa.string()) for c in columns[7:]]], names=schema.names)

        for batch in batches:
            arrow = batch.schema.field(0).type
            for conv, at, role, text, present, fault, what in zip(*[c.to_pylist() for c in batch.columns]):
                if held is None or conv != now:
                    if held is not None:
                        done.append((now, *held.row()))
                    now, held = conv, _Conversation(chunk)
                if present:
                    held.add(at, role, text, fault, what)
            if len(done) >= 4096:
                yield batch_of(done)
                done = []
        if held is not None:
            done.append((now, *held.row()))
        if done:
            yield batch_of(done)

    found = rows.mapInArrow(run, schema)
    return found.select(F.col("conv").cast(kind).alias(id_col), *_COUNTS, "audit", "repaired_sha256")


def repaired_turns(turns: DataFrame, repaired: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """The repaired conversations themselves: (``id_col``, position from 0, edit,
    role, text, ``turn_col``) for every turn that is kept, reroled or inserted.

    ``repaired`` is what ``repair_conversations`` found for ``turns``; its audits
    are laid out as one row an edit and meet the turns by their number. An
    inserted turn has an empty text and a NULL ``turn_col``. NULLs, ties, empty
    tables and other columns as there.
    """
    rows = _judged(turns, id_col, turn_col).filter("present")
    order = Window.partitionBy("conv").orderBy(F.col("at").asc_nulls_first(), "role", "text")
    numbered = rows.select("conv", "at", F.col("role").alias("had"), "text", F.row_number().over(order).alias("number"))
    edits = repaired.select(F.col(id_col).alias("of"), F.posexplode(F.split("audit", "")).alias("place", "edit")).filter(F.col("edit") != "")
    upto = Window.partitionBy("of").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    edits = edits.select(
        "of",
        "edit",
        F.when(F.col("edit") != "I", F.sum((F.col("edit") != "I").cast("int")).over(upto)).alias("at_row"),
        (F.sum((F.col("edit") != "D").cast("int")).over(upto) - 1).alias("position"),
    ).filter(F.col("edit") != "D")
    met = edits.join(numbered, F.col("of").eqNullSafe(F.col("conv")) & (F.col("at_row") == F.col("number")), "left")
    whole = Window.partitionBy("of")
    system = F.max(((F.col("position") == 0) & (F.col("edit") == "K") & F.col("had").startswith("s")).cast("int")).over(whole)
    turn = F.when((F.col("position") - system) % 2 == 0, "user").otherwise("assistant")
    return met.select(
        F.col("of").alias(id_col),
        F.col("position").cast("long").alias("position"),
        "edit",
        F.when(F.col("edit") == "K", F.col("had")).otherwise(turn).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("at").alias(turn_col),
    )

