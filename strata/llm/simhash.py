"""SimHash near-duplicates: links between fingerprints found in BK-trees.

Fingerprints are 64-bit SimHash values over word shingles. Two fingerprints
within ``radius`` bits agree in at least one of ``radius + 1`` bit blocks, so
the distinct fingerprints are sharded by (block, value of the block) and a
BK-tree is built for each shard: a node's children are keyed by their integer
Hamming distance to it, and a search follows only the edges within the radius
of the query's own distance to the node (triangle inequality). A shard of more
than ``TREE_NODES`` fingerprints is sharded again by blocks of its other bits; what
is still larger at the last level becomes several trees, and all fingerprints
of the shard query each of them.

The trees of one executor's shards go with their queries by one shuffle rather
than by a broadcast: all trees together grow with the corpus, and a broadcast
would have no size bound. Tasks hand on a spanning set of links (each linked
fingerprint with one root), never all pairs, and only distinct fingerprints
take part, so a group of exact copies is one node however large it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.components import connected_components
from strata.llm.tables import free_name, stored

TREE_NODES = 4096  # fingerprints in one tree
FRONTIER = 1 << 17  # (query, node) pairs looked at together
CHUNK = 1 << 15  # shingles whose bits are counted together
MOST_PATHS = 1000  # ways to choose the bits of a shard, over all levels


def simhash64(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of one text as a signed 64-bit integer.

    A-Z are lower-cased, words are runs of bytes other than ASCII white space,
    shingles are ``shingle`` words joined by one space, repeats included (fewer
    words: the whole sequence). NULL and blank texts give 0. A bit is 1 when it
    is set in over half of the XXH64 (seed 42) values.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    view = memoryview(joined)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        pairs = zip(starts[at : min(n, at + CHUNK)].tolist(), last[at : at + CHUNK].tolist())
        hashes = np.array([digest(view[s:e], 42) for s, e in pairs], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """The columns of ``docs`` without its text, and the SimHash ``out`` (long).

    Rows stay where they are; each text is fingerprinted whole. A column of
    ``docs`` already called ``out`` is replaced.
    """
    kept = [c for c in docs.columns if c not in (text_col, out)]
    source = docs.select(*kept, F.col(text_col).cast("binary").alias(free_name(docs, "_text")))
    schema = docs.select(*kept, F.lit(0).cast("long").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [simhash64(t.as_py(), shingle) for t in batch.column(len(kept))]
            columns = [batch.column(i) for i in range(len(kept))] + [pa.array(fps, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=kept + [out])

    return source.mapInArrow(run, schema)


def _finer(masks: list[int], radius: int) -> list[list[int]]:
    """For each mask of bits that a shard's members agree in, the masks that add
    one of ``radius + 1`` groups of the bits left."""
    out = []
    for mask in masks:
        free = [b for b in range(64) if not mask >> b & 1]
        n = radius + 1
        cuts = [len(free) * i // n for i in range(n + 1)]
        out.append([mask | sum(1 << b for b in free[x:y]) for x, y in zip(cuts, cuts[1:])])
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _sharded(distinct: DataFrame, radius: int, tree_nodes: int) -> DataFrame:
    """(path, bits, fp, n): each fingerprint in the shards where it may meet others,
    n their sizes.

    Two fingerprints within ``radius`` bits agree in one of ``radius + 1`` groups of
    any set of bits. A shard of more than ``tree_nodes`` members is therefore sharded
    again by groups of the bits that its members do not yet agree in, so a value
    that very many fingerprints share costs ``radius + 1`` rows a member and level,
    not one for each other tree. The last level is kept as it is.
    """
    masks = [m for group in _finer([0], radius) for m in group]
    first = F.array(*[F.struct(F.lit(i).alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for i, m in enumerate(masks)])
    members = stored(distinct.select("fp", F.inline(first)), "simhash-members")
    done: list[DataFrame] = []
    while True:
        sizes = members.groupBy("path", "bits").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
        sized = members.join(sizes, ["path", "bits"])
        if len(masks) * (radius + 1) > MOST_PATHS:
            done.append(sized)
            break
        done.append(sized.filter(F.col("n") <= tree_nodes))
        large = sized.filter(F.col("n") > tree_nodes)
        if not sizes.filter(F.col("n") > tree_nodes).head(1):
            break
        finer = _finer(masks, radius)
        masks = [m for group in finer for m in group]
        table = F.array(*[F.array(*[F.lit(_signed(m)) for m in group]) for group in finer])
        deeper = F.posexplode(F.element_at(table, F.col("path") + 1)).alias("group", "mask")
        members = stored(
            large.select("fp", "path", deeper).select(
                "fp",
                (F.col("path") * (radius + 1) + F.col("group")).alias("path"),
                F.col("fp").bitwiseAND(F.col("mask")).alias("bits"),
            ),
            "simhash-members",
        )
    # Paths of different levels count from 0 each: the level tells them apart.
    return reduce(DataFrame.unionByName, [d.withColumn("path", F.col("path") * 16 + level) for level, d in enumerate(done)])


def links(fps: DataFrame, radius: int = 2, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Spanning links (a, b) between the distinct values of ``fps.fp`` that are
    within ``radius`` bits: their components are those of all such pairs."""
    distinct = fps.select("fp").filter(F.col("fp").isNotNull()).distinct()
    members = _sharded(distinct, radius, tree_nodes)
    # A shard of n fingerprints has t trees. Unit (i, j): tree i is searched for the
    # members of tree j >= i, so each pair of members meets in one unit.
    trees = F.ceil(F.col("n") / F.lit(tree_nodes)).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit("tree")), F.col("t")).cast("int")
    units = F.transform(
        F.sequence(F.lit(0), F.col("t") - 1),
        lambda k: F.struct(
            F.least(k, F.col("own")).alias("i"),
            F.greatest(k, F.col("own")).alias("j"),
            (k >= F.col("own")).alias("node"),
            (k <= F.col("own")).alias("query"),
        ),
    )
    dealt = (
        members.withColumn("t", trees)
        .withColumn("own", own)
        .select("path", "bits", "fp", F.inline(units))
        .withColumn("unit", F.xxhash64("path", "bits", "i", "j"))
        .select("unit", "fp", "node", "query")
    )
    grouped = dealt.repartition("unit").sortWithinPartitions("unit", "fp")
    return grouped.mapInArrow(lambda batches: _search(batches, radius), "a long, b long").distinct()


def _search(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of each unit of a sorted partition; a unit (two trees' worth of
    rows at most) is held whole, and small units are searched together."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("unit", "fp", "node", "query")))
        rows += batch.num_rows
        if rows < 1 << 16:
            continue
        unit, fp, node, query = (np.concatenate(x) for x in zip(*held))
        cut = int(np.searchsorted(unit, unit[-1], side="left"))  # the last unit may go on
        if cut:
            yield _linked(unit[:cut], fp[:cut], node[:cut], query[:cut], radius)
        held = [(unit[cut:], fp[cut:], node[cut:], query[cut:])]
        rows = len(unit) - cut
    if rows:
        yield _linked(*(np.concatenate(x) for x in zip(*held)), radius)


def _linked(unit, fp, node, query, radius: int) -> pa.RecordBatch:
    _, start = np.unique(unit, return_inverse=True)
    trees = BKForest(fp[node].view(np.uint64), start[node])
    seekers, at = fp[query].view(np.uint64), start[query]
    root = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    for a, b in trees.within(seekers, at, radius):
        found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        for x, y in found.tolist():
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
    ends = list(root)
    b = np.array([find(x) for x in ends], np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(b), pa.array(np.array(ends, np.uint64).view(np.int64))], names=["a", "b"])


class BKForest:
    """BK-trees over 64-bit values, one for each shard number, built and
    searched a level at a time.

    ``values[k]`` belongs to the tree ``shard[k]``. A tree's root is its first
    value; every other value goes down the edge labelled with its Hamming
    distance to the node it stands at, and becomes a node where that edge is
    free. Equal values are kept once.
    """

    def __init__(self, values: np.ndarray, shard: np.ndarray):
        self.values = values
        n = len(values)
        shards, first = np.unique(shard, return_index=True)
        self.root = dict(zip(shards.tolist(), first.tolist()))
        parent = np.full(n, -1, np.int64)
        edge = np.zeros(n, np.int64)
        left = np.setdiff1d(np.arange(n), first)
        at = np.zeros(n, np.int64)
        at[left] = first[np.searchsorted(shards, shard[left])]
        while len(left):
            d = np.bitwise_count(values[left] ^ values[at[left]]).astype(np.int64)
            left, d = left[d > 0], d[d > 0]
            if not len(left):
                break
            slot, lead, back = np.unique(at[left] * 65 + d, return_index=True, return_inverse=True)
            child = left[lead]
            parent[child], edge[child] = at[child], d[lead]
            at[left] = child[back]
            stay = np.ones(len(left), bool)
            stay[lead] = False
            left = left[stay]
        kids = np.flatnonzero(parent >= 0)
        kids = kids[np.argsort(parent[kids], kind="stable")]
        self.kids, self.edge = kids, edge[kids]
        self.begin = np.searchsorted(parent[kids], np.arange(n), side="left")
        self.end = np.searchsorted(parent[kids], np.arange(n), side="right")

    def within(self, queries: np.ndarray, shard: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query value, tree value) within ``radius`` bits in the query's
        own shard, in several arrays; a value does not meet itself."""
        roots = np.array([self.root.get(s, -1) for s in shard.tolist()], np.int64)
        stack = [(np.flatnonzero(roots >= 0), roots[roots >= 0])]
        while stack:
            q, at = stack.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                stack += [(q[:half], at[:half]), (q[half:], at[half:])]
                continue
            d = np.bitwise_count(queries[q] ^ self.values[at]).astype(np.int64)
            hit = (d <= radius) & (d > 0)
            if hit.any():
                yield queries[q[hit]], self.values[at[hit]]
            many = self.end[at] - self.begin[at]
            total = int(many.sum())
            if not total:
                continue
            offset = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
            edges = np.repeat(self.begin[at], many) + offset
            near = np.abs(self.edge[edges] - np.repeat(d, many)) <= radius
            stack.append((np.repeat(q, many)[near], self.kids[edges[near]]))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 2,
    mark: Column | None = None,
) -> DataFrame:
    """(``id_col``, mark, fp, root, component_id) for every row of ``docs``.

    Rows whose fingerprints are within ``radius`` bits are linked; root is the
    least linked fingerprint and component_id the least id of the component.

    NULL or blank texts have fingerprint 0 and are linked like any other. Rows
    with a NULL id are linked too but give no component_id (NULL where all ids
    of a component are NULL). Repeated rows and repeated ids give one result
    row each. An empty table gives no rows. Other columns are ignored; ``mark``
    (default NULL) is an expression on them that is carried along.
    """
    mark = F.lit(None).cast("long") if mark is None else mark
    rows = docs.select(F.col(id_col).alias("_id"), mark.alias("mark"), F.col(text_col).alias("_text"))
    fps = stored(with_fingerprint(rows, "_text", shingle), "simhash")
    kinds = fps.groupBy("fp").agg(F.min("_id").alias("least"))
    roots = connected_components(links(fps, radius))
    rooted = kinds.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root")
    return fps.join(named, "fp").select(F.col("_id").alias(id_col), "mark", "fp", "root", "component_id")


def hex16(fp: Column) -> Column:
    """16 lower-case hex digits of a long's 64 bits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
