"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A document's set is its distinct word shingles, as 64-bit hashes. A signature
needs two permutations only: the first scatters the shingles over ``PLACES``
places, the second ranks the places, and coordinate k is the least rank of the
set's places shifted by k round the circle. The K ranks that one shingle offers
to the K coordinates lie side by side, so a signature is the minimum of
contiguous windows.

Bands of ``BAND_ROWS`` coordinates give candidates; two sets of similarity 0.85
share none of the 32 bands with a probability of 3 in 10^7. Every link is then
confirmed on the full sets:

* equal sets are one node, however many copies there are;
* in each bucket the node that shares most buckets with others meets all other
  nodes (a star, so a group of near copies costs one pair a copy);
* where a bucket still holds nodes of different components, its nodes are laid
  in blocks of bounded size, and pairs of blocks with different components are
  compared whole inside one task, by a blocked product of their incidence
  matrices. Blocks of one component never meet, so what is left costs nothing
  where the stars have joined a group.

Tasks hand on spanning links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.components import connected_components
from strata.llm.tables import stored, with_running_sum

PLACES = 1 << 20
BANDS, BAND_ROWS = 32, 6
SEED = 20
PERCENT = 85  # least similarity of a link
BLOCK = 1 << 18  # shingles in a block of sets compared inside one task
EACH = 256  # a set's weight in a block beside its shingles: at most BLOCK / EACH sets
RARE = 16  # shingles of more sets than this go through the matrix product


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The scattering permutation, the windows of ranks for every place, and the
    odd multipliers of the shingle and band hashes."""
    rng = np.random.default_rng(SEED)
    scatter = rng.permutation(PLACES).astype(np.int64)
    ranks = rng.permutation(PLACES).astype(np.uint32)
    k = BANDS * BAND_ROWS
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[:k]]), k)
    odd = rng.integers(1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return scatter, windows, odd


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words; with fewer words
    the whole sequence is one shingle, without words there are none. A-Z are
    lower-cased; words are runs of bytes other than ASCII white space."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    odd = _permutations()[2]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    size = min(size, n)
    total = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        total += _mixed(hashes[j : n - size + 1 + j] + odd[32 + j]) * odd[j]
    return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The circulant MinHash of a set that is not empty."""
    scatter, windows, _ = _permutations()
    places = scatter[(shingles % np.uint64(PLACES)).astype(np.int64)]
    least = windows[places[:1]][0]
    for at in range(0, len(places), 4096):
        least = np.minimum(least, windows[places[at : at + 4096]].min(axis=0))
    return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature (rows)."""
    odd = _permutations()[2]
    bands = signatures.reshape(len(signatures), BANDS, BAND_ROWS).astype(np.uint64)
    total = (bands * odd[:BAND_ROWS]).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * odd[40]
    return _mixed(total)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def with_bands(docs: DataFrame, text_col: str, size: int) -> DataFrame:
    """The columns of ``docs`` without its text, and n, d1, d2 (the size and the
    128-bit digest of its set) and keys (of its bands)."""
    kept = [c for c in docs.columns if c != text_col]
    source = docs.select(*kept, F.col(text_col).cast("binary").alias("_text"))
    schema = docs.select(
        *kept, *[F.lit(0).cast("long").alias(c) for c in ("n", "d1", "d2")], F.array().cast("array<bigint>").alias("keys")
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, signatures = [], [], []
            for text in batch.column(len(kept)):
                shingles = shingle_set(text.as_py(), size)
                n.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                if len(shingles):
                    signatures.append(signature(shingles))
            keys = [np.zeros(0, np.uint64)] * len(n)
            if signatures:
                for place, key in zip(np.flatnonzero(n), band_keys(np.stack(signatures))):
                    keys[place] = key
            digest = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            made = [pa.array(n, pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]), _lists(keys)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in range(len(kept))] + made, names=schema.names)

    return source.mapInArrow(run, schema)


def _sets_of(texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, held, sets = 0, 0, []
            for k in range(batch.num_rows):
                sets.append(shingle_set(batch.column(1)[k].as_py(), size))
                held += len(sets[-1])
                if held > 1 << 20 or k == batch.num_rows - 1:
                    nodes = batch.column(0).slice(at, len(sets))
                    yield pa.RecordBatch.from_arrays([nodes, _lists(sets)], names=["node", "shingles"])
                    at, held, sets = k + 1, 0, []

    return texts.select("node", F.col("text").cast("binary")).mapInArrow(run, "node long, shingles array<bigint>")


def _near(both: Column, n: Column, m: Column, percent: int) -> Column:
    return F.lit(100) * both >= F.lit(percent) * (n + m - both)


def _star_links(shared: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The leader of each bucket, and the links between leaders and their bucket's
    other nodes."""
    score = shared.groupBy("node").agg(F.sum("members").alias("score"))
    best = F.max_by(F.struct("node", "n"), F.struct("score", (-F.col("node")).alias("first")))
    leaders = stored(
        shared.join(score, "node").groupBy("key").agg(best.alias("l")).select("key", F.col("l.node").alias("leader"), F.col("l.n").alias("leader_n")),
        "circulant-leaders",
    )
    pairs = (
        shared.join(leaders, "key")
        .filter(F.col("leader") != F.col("node"))
        .filter(100 * F.least("n", "leader_n") >= percent * F.greatest("n", "leader_n"))
        .select(F.col("leader").alias("a"), F.col("leader_n"), F.col("node").alias("b"), "n")
        .distinct()
    )
    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b")
    with_a = with_b.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a")
    both = F.size(F.array_intersect("of_a", "of_b"))
    return leaders, stored(with_a.filter(_near(both, F.col("n"), F.col("leader_n"), percent)).select("a", "b"), "circulant-links")


def _block_links(open_: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links (a, b) between components (labels) found by comparing all nodes of
    different labels that buckets of ``open_`` (key, node, n, label) connect."""
    hub = open_.groupBy("key").agg(F.min("node").alias("hub"))
    stars = open_.join(hub, "key").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    blobs = connected_components(stars).select("node", F.col("root").alias("blob"))
    nodes = open_.select("node", "n", "label").distinct().join(blobs, "node")
    weight = F.col("n") + EACH
    numbered = with_running_sum(nodes, ["blob"], [F.col("label"), F.col("node")], weight, "upto", "circulant-blocks")
    placed = stored(
        numbered.select("blob", "node", "n", "label", F.floor((F.col("upto") - weight) / block).cast("long").alias("block")),
        "circulant-placed",
    )
    blocks = placed.groupBy("blob", "block").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    i, j = [blocks.select("blob", *[F.col(c).alias(f"{c}_{s}") for c in ("block", "lo", "hi", "least", "most")]) for s in "ij"]
    units = (
        i.join(j, "blob")
        .filter("block_i <= block_j")
        .filter((F.least("lo_i", "lo_j") < F.greatest("hi_i", "hi_j")))
        .filter((100 * F.col("most_i") >= percent * F.col("least_j")) & (100 * F.col("most_j") >= percent * F.col("least_i")))
        .withColumn("unit", F.xxhash64("blob", "block_i", "block_j"))
    )
    ends = units.select("blob", "unit", F.col("block_i").alias("block")).unionByName(
        units.filter("block_i < block_j").select("blob", "unit", F.col("block_j").alias("block"))
    )
    dealt = (
        placed.join(ends, ["blob", "block"])
        .join(sets, "node")
        .select("unit", "node", "label", "shingles")
        .repartition("unit")
        .sortWithinPartitions("unit", "node")
    )
    return dealt.mapInArrow(lambda batches: _compared(batches, percent), "a long, b long").distinct()


def _compared(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links between the labels of each unit (two blocks of sets at most)."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        unit = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1).tolist(), len(unit)]
        for start, stop in zip(cuts[:-1], cuts[1:]):
            if held and unit[start] != now:
                yield _unit_links(pa.Table.from_batches(held), percent)
                held = []
            if stop > start:
                now = unit[start]
                held.append(batch.slice(start, stop - start))
    if held:
        yield _unit_links(pa.Table.from_batches(held), percent)


def _unit_links(unit: pa.Table, percent: int) -> pa.RecordBatch:
    label = unit["label"].to_numpy()
    lists = unit["shingles"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    both = shared_counts(lists.flatten().to_numpy(), np.repeat(np.arange(len(size)), size), len(size))
    near = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    near &= label[:, None] != label[None, :]
    a, b = np.nonzero(np.triu(near, 1))
    found = np.unique(np.stack([np.minimum(label[a], label[b]), np.maximum(label[a], label[b])], axis=1), axis=0)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    spanning = []
    for x, y in found.tolist():
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            spanning.append((x, y))
    columns = list(zip(*spanning)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])


def shared_counts(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many values each two of the ``n`` owners have in common (each owner's
    values are distinct). Frequent values by a product of 0/1 matrices, some
    columns at a time, the others pair by pair."""
    _, number, times = np.unique(values, return_inverse=True, return_counts=True)
    out = np.zeros((n, n), np.int64)
    often = np.flatnonzero(times > RARE)
    column = np.full(len(times), -1, np.int64)
    column[often] = np.arange(len(often))
    at = column[number]
    for start in range(0, len(often), 2048):
        part = (at >= start) & (at < start + 2048)
        have = np.zeros((n, min(2048, len(often) - start)), np.float32)
        have[owner[part], at[part] - start] = 1
        out += (have @ have.T).astype(np.int64)
    few = (times[number] > 1) & (at < 0)
    order = np.argsort(number[few], kind="stable")
    what, who = number[few][order], owner[few][order]
    for step in range(1, RARE):
        same = what[step:] == what[:-step]
        if not same.any():
            break
        np.add.at(out, (who[step:][same], who[:-step][same]), 1)
        np.add.at(out, (who[:-step][same], who[step:][same]), 1)
    return out


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = PERCENT,
    block: int = BLOCK,
) -> DataFrame:
    """(``id_col``, n_shingles, component_id, kept) for every row of ``docs``.

    Rows whose sets have 100 * intersection >= ``percent`` * union (0.85 by
    default; the bands are cut for that or more) are linked, component_id is the
    least id reachable, and kept says whether that is the row's own.

    NULL and blank texts have no shingles and are linked with nothing. A row
    with a NULL id is linked like any other; component_id is NULL where all ids
    of its component are, and kept is true for it there only. Repeated rows and
    ids give a row each. An empty table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    rows = with_bands(texts, "text", size).withColumn("rid", F.monotonically_increasing_id())
    rows = stored(rows, "circulant-bands")  # the numbers stay as they were written
    of = F.min(F.struct("rid", "id", "t")).alias("first")  # the row whose text stands for the set
    classes = rows.filter("n > 0").groupBy("d1", "d2").agg(of, F.min("id").alias("least"))
    classes = stored(classes.select("d1", "d2", F.col("first.rid").alias("node"), "first.id", "first.t", "least"), "circulant-classes")
    members = stored(
        rows.select("rid", "n", "keys").join(classes.select(F.col("node").alias("rid")), "rid")
        .select(F.col("rid").alias("node"), "n", F.explode("keys").alias("key")),
        "circulant-members",
    )
    sizes = members.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    shared = stored(members.join(sizes, "key"), "circulant-shared")
    # Sets are kept for nodes that share a bucket only: their texts are read once more.
    wanted = classes.join(shared.select("node").distinct(), "node").select("node", F.col("id").alias("_id"), F.col("t").alias("_t"))
    found = texts.join(wanted, (F.col("t") == F.col("_t")) & F.col("id").eqNullSafe(F.col("_id")))
    sets = stored(_sets_of(found.groupBy("node").agg(F.min("text").alias("text")), size), "circulant-sets")

    leaders, links = _star_links(shared, sets, percent)
    starred = stored(connected_components(links), "circulant-stars")
    # Pairs with a leader are settled; other nodes of a bucket meet if their labels differ.
    label = F.coalesce("root", F.col("at")).alias("label")
    left = (
        shared.filter("members > 2")
        .join(leaders, "key")
        .filter("node != leader")
        .select("key", F.col("node").alias("at"), "n")
        .join(starred, F.col("at") == F.col("node"), "left")
        .select("key", F.col("at").alias("node"), "n", label)
    )
    left = stored(left, "circulant-left")
    split = left.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
    open_ = stored(left.join(split, "key"), "circulant-open")
    joined = connected_components(_block_links(open_, sets, percent, block)).select(
        F.col("node").alias("label"), F.col("root").alias("final")
    )
    rooted = (
        classes.join(starred, "node", "left")
        .select("d1", "d2", "least", F.coalesce("root", "node").alias("label"))
        .join(joined, "label", "left")
        .select("d1", "d2", "least", F.coalesce("final", "label").alias("root"))
    )
    rooted = stored(rooted, "circulant-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(least, "root").select("d1", "d2", "component")
    ids = rows.select("id", "n", F.when(F.col("n") > 0, F.col("d1")).alias("e1"), "d2")
    found = ids.join(named, (F.col("e1") == named["d1"]) & (ids["d2"] == named["d2"]), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return found.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
