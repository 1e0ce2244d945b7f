"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from strata.llm import queries, simhash
from strata.llm.components import connected_components


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute_roots(fps, radius):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in keys}


def expected(rows):
    fps = [brute_fingerprint(r[1]) for r in rows]
    roots = brute_roots(set(fps), 2)
    least = {}
    for r, f in zip(rows, fps):
        if r[0] is not None:
            least[roots[f]] = min(r[0], least.get(roots[f], r[0]))
    return sorted(((r[0], f"{f:016x}", least.get(roots[f])) for r, f in zip(rows, fps)), key=str)


def found(docs):
    out = simhash.near_duplicates(docs).select("doc_id", simhash.hex16(F.col("fp")).alias("f"), "component_id")
    return sorted(map(tuple, out.collect()), key=str)


def test_equals_brute_force(docs, rows):
    assert found(docs) == expected(rows)


def test_extra_columns_and_empty_table(clashing, rows, empty):
    assert found(clashing) == expected(rows)
    assert found(empty) == []


def test_query_equals_brute_force_on_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op1_simhash(spark, sf).collect()), key=str)
    assert got == expected(rows)


def test_links_in_split_shards_and_chains(spark):
    """Fingerprints around a few centres, so shards are larger than a tree."""
    rng = random.Random(3)
    fps = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(120):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 6))))
    fps |= {rng.getrandbits(64) for _ in range(200)}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    table = spark.createDataFrame([(f,) for f in signed + signed[:50]], "fp long")
    for nodes in (16, 4096):
        edges = simhash.links(table, radius=2, tree_nodes=nodes)
        assert edges.count() <= 3 * 3 * len(fps) * (1 + len(fps) // nodes)
        got = {r.node: r.root for r in connected_components(edges).collect()}
        want = brute_roots(fps, 2)
        groups = {}
        for f, s in zip(fps, signed):
            groups.setdefault(want[f], set()).add(got.get(s, s))
        assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_a_hot_block_costs_rows_in_proportion(spark):
    """Fingerprints that agree in a whole block are sharded by their other bits."""
    counts = []
    for n in (5_000, 20_000):
        fps = spark.range(n).select(F.xxhash64("id").bitwiseAND(F.lit(~((1 << 22) - 1))).alias("fp")).distinct()
        shards = simhash._sharded(fps, 2, 64)
        assert shards.agg(F.max("n")).first()[0] <= 64
        counts.append(shards.count())
    assert counts[0] <= 9 * 5_000 and counts[1] <= 9 * 20_000  # not in the square
    near = spark.createDataFrame([(1,), (1 ^ 3 << 60,), (1 ^ 7 << 50,)], "fp long").unionAll(fps)
    edges = [tuple(r) for r in simhash.links(near, radius=2, tree_nodes=64).collect()]
    assert (min(1, 1 ^ 3 << 60), max(1, 1 ^ 3 << 60)) in edges


def test_forest_finds_all_within_radius():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 2**64, 300, dtype=np.uint64)
    values = np.concatenate([values, values[:100] ^ np.uint64(5), values[:50]])
    shard = rng.integers(0, 3, len(values))
    trees = simhash.BKForest(values, shard)
    for radius in (0, 2, 5):
        got = {(int(a), int(b)) for x, y in trees.within(values, shard, radius) for a, b in zip(x, y)}
        want = {
            (int(values[i]), int(values[j]))
            for i in range(len(values))
            for j in range(len(values))
            if shard[i] == shard[j] and 0 < (int(values[i]) ^ int(values[j])).bit_count() <= radius
        }
        assert got == want


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i + 1, i) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star + [(7, 7), (2000, 2000), (1000, 1001), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert connected_components(edges.limit(0)).count() == 0
