"""Divergence of the sources of a language, over a quadtree of term counts.

The count matrix of a language has a row for each of its sources and a column
for each kept term. It is cut into tiles of columns (terms by hash, about
``COLUMNS`` in each) and of pairs of row blocks (``ROWS`` sources each). A tile is
a k2-tree with k = 2: a node has four quadrants, a quadrant without counts is
not a node, and counts lie in the leaves. Pairs of sources are traversed jointly
from the root: where both quadrants of the same columns are empty they are priced
by their width alone, where one is not the pair goes down, and at the leaves the
two shares meet. Tiles give sums for each pair, which add up.

Text is counted where it lies: a task hands on one row for each source and term
it met, and tiles travel by their number, so neither a frequent term nor a source
with a third of all rows gathers in one task. Arithmetic is on integers: shares
are 1 + floor(10^9 (count + 1) / (N + V)) by long division.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import stored

COLUMNS = 4096  # terms in a tile, about
ROWS = 128  # sources in a row block
HELD_TERMS = 1 << 19  # terms counted in a task before they are handed on
FRONTIER = 1 << 18  # quadrant pairs looked at together

# A-Z become a-z; a-z and the bytes of all other characters stay; the rest separates.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def count_terms(docs: DataFrame, held_terms: int = HELD_TERMS) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in ``docs`` (lang,
    source, text as binary) and the rows it is in, in partial sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, rows) in counts.items():
                terms = list(n)
                for at in range(0, len(terms), 1 << 16):
                    part = terms[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(part), pa.string()),
                            pa.array([source] * len(part), pa.string()),
                            pa.array(part, pa.binary()).cast(pa.string()),
                            pa.array([n[t] for t in part], pa.int64()),
                            pa.array([rows[t] for t in part], pa.int64()),
                        ],
                        names=["lang", "source", "term", "n", "docs"],
                    )
            counts.clear()

        for batch in batches:
            for lang, source, text in zip(*[c.to_pylist() for c in batch.columns]):
                words = text.translate(_LETTERS).split()
                n, rows = counts.setdefault((lang, source), (Counter(), Counter()))
                held -= len(n)
                n.update(words)
                rows.update(set(words))
                held += len(n)
                if held >= held_terms:
                    yield from flush()
                    held = 0
        yield from flush()

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def shares(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / total), exact while total is under 9 * 10^15."""
    whole, rest = np.divmod(count + 1, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


class CountTree:
    """k2-tree (k = 2) of a sparse matrix: for each level the number of every
    node's four quadrants among the next level's nodes (-1: all zero), and the
    place of each leaf's cell."""

    def __init__(self, row: np.ndarray, col: np.ndarray, height: int):
        code = np.zeros(len(row), np.int64)
        for bit in range(height):
            code |= ((row >> bit) & 1) << (2 * bit + 1) | ((col >> bit) & 1) << (2 * bit)
        self.height = height
        self.cell = np.argsort(code, kind="stable")
        code = code[self.cell]
        nodes = np.zeros(min(1, len(code)), np.int64)
        self.quadrants: list[np.ndarray] = []
        for level in range(height):
            below = np.unique(code >> (2 * (height - level - 1)))
            numbers = np.full(4 * len(nodes), -1, np.int64)
            numbers[4 * np.searchsorted(nodes, below >> 2) + (below & 3)] = np.arange(len(below))
            self.quadrants.append(numbers)
            nodes = below


_SIDES = np.array([(r, s, c) for r in (0, 1) for s in (0, 1) for c in (0, 1)])[:, :, None]


def pair_sums(
    tree: CountTree, rows: int, cols: int, share: np.ndarray, empty: np.ndarray, cut: int | None = None
) -> np.ndarray:
    """For rows a, b the sum of floor((p - q)^2 / q) over the tile's columns, p the
    share of a and q that of b.

    ``share`` are the cells' shares, ``empty`` the rows' shares of a term they do
    not have. With ``cut``, only pairs of a row before it and one from it on.
    """
    height = tree.height
    sums = np.zeros((rows, rows), np.int64)
    blank = [np.zeros((((rows - 1) >> (height - k)) + 1,) * 2, np.int64) for k in range(height + 1)]
    leaf = share[tree.cell]
    root = np.array([0 if len(leaf) else -1], np.int64)
    zero = np.zeros(1, np.int64)
    stack = []
    if len(leaf):
        stack.append((0, zero, zero, zero, root, root))
    else:
        blank[0][0, 0] = cols
    while stack:
        level, x, y, c, a, b = stack.pop()
        if len(x) > FRONTIER:
            half = len(x) // 2
            stack += [(level, *(v[:half] for v in (x, y, c, a, b))), (level, *(v[half:] for v in (x, y, c, a, b)))]
            continue
        if level == height:
            p = np.where(a >= 0, leaf[a], empty[x])
            q = np.where(b >= 0, leaf[b], empty[y])
            square = (p - q) ** 2
            np.add.at(sums, (x, y), square // q)
            np.add.at(sums, (y, x), square // p)
            continue
        down = height - level - 1
        r, s, k = _SIDES[:, 0], _SIDES[:, 1], _SIDES[:, 2]
        x2, y2, c2 = 2 * x + r, 2 * y + s, 2 * c + k
        meant = (x2 <= y2) & ((y2 << down) < rows) & ((c2 << down) < cols)
        if not down:
            meant &= x2 < y2
        if cut is not None:
            meant &= ((x2 << down) < cut) & (((y2 + 1) << down) > cut)
        numbers = tree.quadrants[level]
        a2 = np.where(a < 0, -1, numbers[4 * np.maximum(a, 0) + 2 * r + k])
        b2 = np.where(b < 0, -1, numbers[4 * np.maximum(b, 0) + 2 * s + k])
        none = (a2 < 0) & (b2 < 0)
        priced = meant & none
        width = np.minimum(cols, (c2 + 1) << down) - (c2 << down)
        np.add.at(blank[level + 1], (x2[priced], y2[priced]), width[priced])
        on = meant & ~none
        if on.any():
            stack.append((level + 1, x2[on], y2[on], c2[on], a2[on], b2[on]))
    index = np.arange(rows)
    wide = sum(blank[k][np.ix_(index >> (height - k), index >> (height - k))] for k in range(height + 1))
    wide = np.triu(wide, 1)
    if cut is not None:
        wide[cut:] = 0
        wide[:, :cut] = 0
    wide = wide + wide.T
    p, q = empty[:, None], empty[None, :]
    return sums + wide * ((p - q) ** 2 // q)


def _tile(lang, i, j, first, second, whole, cols, row, col, n, total, terms, top, rows_a_block) -> Iterator[pa.RecordBatch]:
    """Sums of the pairs of one tile and, where it is on the diagonal, the best
    terms of its sources."""
    totals = np.maximum(np.array(first + (second if j > i else []), np.int64), 1)
    rows = len(totals)
    height = max(1, int(max(rows, cols) - 1).bit_length())
    share = shares(n, totals[row])
    sums = pair_sums(CountTree(row, col, height), rows, cols, share, shares(np.zeros(rows, np.int64), totals), len(first) if j > i else None)
    a, b = np.nonzero(~np.eye(rows, dtype=bool))
    if j > i:
        cross = (a < len(first)) != (b < len(first))
        a, b = a[cross], b[cross]
    numbers = np.concatenate([np.arange(len(first)) + i * rows_a_block, np.arange(rows - len(first)) + j * rows_a_block])
    yield _rows(lang, numbers[a], numbers[b], pa.nulls(len(a), pa.string()), sums[a, b])
    if i == j and len(n):
        q = shares(total, max(whole, 1))
        over = np.flatnonzero(share > q)
        value = (share[over] - q[over]) ** 2 // q[over]
        order = np.lexsort((col[over], -value, row[over]))  # columns are in the terms' order
        over, value = over[order], value[order]
        start = np.searchsorted(row[over], row[over])
        best = np.arange(len(over)) - start < top
        over, value = over[best], value[best]
        yield _rows(lang, numbers[row[over]], np.full(len(over), -1), terms.take(pa.array(over)), value)


def _rows(lang, a, b, item, value) -> pa.RecordBatch:
    arrays = [pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), item, pa.array(value, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["lang", "a", "b", "item", "value"])


def _tiles(batches: Iterator[pa.RecordBatch], top: int, rows_a_block: int) -> Iterator[pa.RecordBatch]:
    """The tiles of a sorted partition; a tile begins with the row that names it
    and is held whole (about COLUMNS terms of two row blocks at most)."""
    head, held = None, []

    def done() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held) if held else None
        if table is None or not table.num_rows:
            none = np.zeros(0, np.int64)
            yield from _tile(*head, none, none, none, none, None, top, rows_a_block)
            return
        terms = table["term"].combine_chunks()
        if isinstance(terms, pa.ChunkedArray):
            terms = pa.concat_arrays(terms.chunks)
        col = terms.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        row, n, total = (table[c].to_numpy().astype(np.int64) for c in ("row", "n", "total"))
        yield from _tile(*head, row, col, n, total, terms, top, rows_a_block)

    for batch in batches:
        heads = np.flatnonzero(batch.column("term").is_null().to_numpy(zero_copy_only=False))
        at = 0
        for k in heads.tolist():
            held.append(batch.slice(at, k - at))
            if head is not None:
                yield from done()
            held, at = [], k + 1
            head = [batch.column(c)[k].as_py() for c in ("lang", "i", "j", "first", "second", "whole", "cols")]
            head[3:5] = [[int(n) for n in sizes.split(",")] for sizes in head[3:5]]
        held.append(batch.slice(at))
    if head is not None:
        yield from done()


def audit_sources(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = 3,
    top: int = 200,
    columns: int = COLUMNS,
    rows_a_block: int = ROWS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of a language
    are from each other (part ``pair``, item the other source) and the ``top``
    terms that a source has more of than its language (part ``term``).

    NULL lang, source and text are ''. A row is a document: repeated rows count
    each. A language keeps the terms of at least ``min_docs`` documents; without
    any, pairs have value 0. A source without terms is a source like any other. An
    empty table gives no rows; other columns are ignored.
    """
    blank = F.lit("")
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), blank).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), blank).alias("source"),
        F.coalesce(F.col(text_col).cast("string"), blank).cast("binary").alias("text"),
    )
    cells = count_terms(rows).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    column = Window.partitionBy("lang", "term")
    kept = (
        cells.withColumn("in_docs", F.sum("docs").over(column))
        .withColumn("total", F.sum("n").over(column))
        .withColumn("lead", (F.row_number().over(column.orderBy("source")) == 1).cast("int"))
        .filter(F.col("in_docs") >= min_docs)
        .select("lang", "source", "term", "n", "total", "lead")
    )
    kept = stored(kept, "divergence-cells")

    # One row per source, then per language: sizes, and the sources' row numbers.
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum("lead").alias("terms"))
    lang = Window.partitionBy("lang")
    groups = (
        rows.select("lang", "source")
        .distinct()
        .join(sizes, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("terms", F.lit(0)).alias("terms"))
        .withColumn("v", F.sum("terms").over(lang))
        .withColumn("whole", F.sum("n").over(lang) + F.col("v"))
        .withColumn("sources", F.count("*").over(lang))
        .withColumn("number", (F.row_number().over(lang.orderBy("source")) - 1).cast("int"))
        .withColumn("tiles", F.greatest(F.lit(1), F.ceil(F.col("v") / columns)).cast("int"))
        .withColumn("block", (F.col("number") / rows_a_block).cast("int"))
        .withColumn("blocks", F.ceil(F.col("sources") / rows_a_block).cast("int"))
        .select("lang", "source", "number", "block", "blocks", "tiles", "whole", (F.col("n") + F.col("v")).alias("size"))
    )
    groups = stored(groups, "divergence-groups")

    tile = F.pmod(F.xxhash64("term"), F.col("tiles")).cast("int").alias("tile")
    places = kept.join(groups, ["lang", "source"]).select("lang", "term", "n", "total", "lead", "number", "block", "blocks", tile)
    widths = places.filter("lead = 1").groupBy("lang", "tile").agg(F.count("*").alias("cols"))
    members = groups.groupBy("lang", "block").agg(
        # As text: Arrow fills in a list column of mostly NULLs row by row, again and again.
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "size"))), lambda x: x["size"].cast("string")), ",").alias("sizes")
    )
    langs = groups.filter("number = 0").select("lang", "whole", "blocks", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    pairs = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.col("blocks") - 1),
                lambda i: F.transform(F.sequence(i, F.col("blocks") - 1), lambda j: F.struct(i.alias("i"), j.alias("j"))),
            )
        )
    )
    heads = (
        langs.join(widths, ["lang", "tile"], "left")
        .select("lang", "tile", "whole", F.coalesce("cols", F.lit(0)).cast("int").alias("cols"), pairs.alias("p"))
        .select("lang", "tile", "whole", "cols", "p.i", "p.j")
        .join(members.select("lang", F.col("block").alias("i"), F.col("sizes").alias("first")), ["lang", "i"])
        .join(members.select("lang", F.col("block").alias("j"), F.col("sizes").alias("second")), ["lang", "j"])
    )
    # A cell goes to the tiles that pair its row block with each other one.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = places.select("lang", "tile", "term", "n", "total", "number", "block", other).select(
        "lang",
        "tile",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "term",
        "n",
        "total",
        (F.col("number") % rows_a_block + F.when(F.col("block") > F.col("other"), rows_a_block).otherwise(0)).alias("row"),
    )
    tiles = heads.unionByName(spread, allowMissingColumns=True)
    order = ["lang", "tile", "i", "j"]
    dealt = tiles.repartition(*order).sortWithinPartitions(*order, F.col("term").asc_nulls_first(), "row")
    found = stored(
        dealt.mapInArrow(lambda batches: _tiles(batches, top, rows_a_block), "lang string, a int, b int, item string, value long"),
        "divergence-sums",
    )

    named = groups.select("lang", F.col("number").alias("a"), "source")
    other_named = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"))
    pair = (
        found.filter("b >= 0").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
        .join(named, ["lang", "a"]).join(other_named, ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    term = found.filter("b < 0").join(named, ["lang", "a"]).select("lang", "source", F.lit("term").alias("part"), "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return pair.select("*", rank).unionByName(term.select("*", rank).filter(F.col("rank") <= top))
