"""Circulant MinHash near-duplicates: against all pairs by definition."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.circulant import band_keys, near_duplicates, shared_counts, shingle_set, signature

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def plain(rows):
    """(id, text) rows -> sorted (id, n, component, kept)."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(((d, len(s), least[find(i)], d == least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def found(df, **more):
    return sorted(map(tuple, near_duplicates(df, **more).collect()), key=str)


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**9)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def families():
    """A base with copies that are near to it but hardly to each other, a chain
    of small steps, mixed likeness around the threshold, and singles."""
    rng = random.Random(9)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows = [(i, " ".join(new(rng.choice([1, 2, 4, 5, 6, 60, 300])))) for i in range(60)]
    base = new(400)
    rows += [(1000, " ".join(base))] + [(1001 + i, edited(rng, base, 4)) for i in range(60)]
    chain = new(300)
    for i in range(40):
        rows.append((2000 + i, " ".join(chain)))
        chain[rng.randrange(300)] = f"c{i}"
    other = new(200)
    rows += [(3000 + i, edited(rng, other, rng.randrange(1, 9))) for i in range(80)]
    rows += [(4000 + i, edited(rng, base, 12)) for i in range(30)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1 << 18, 3000])
def test_families(spark, families, block):
    df = spark.createDataFrame(families, "doc_id long, text string").repartition(4)
    assert found(df, block=block) == plain(families)


def test_odd_rows(spark, docs, clashing, rows, empty):
    want = plain([(r[0], r[1]) for r in rows])
    assert found(docs) == want
    extra = clashing.withColumns({c: F.lit(1) for c in ("key", "node", "n", "rid", "id", "keys", "shingles", "label", "unit")})
    assert found(extra) == want
    assert found(empty) == []


def test_sets_by_definition(rows):
    texts = [r[1] for r in rows] + ["a b c d", "a b c d e", "A  b\tc d E", "a b c d e f", "é É a"]
    ours = [shingle_set(None if t is None else t.encode()) for t in texts]
    theirs = [plain_set(t) for t in texts]
    for a, s in zip(ours, theirs):
        assert len(a) == len(s)
        for b, t in zip(ours, theirs):
            assert len(np.intersect1d(a, b)) == len(s & t)


def test_coordinates_agree_as_often_as_the_sets_are_alike():
    rng = np.random.default_rng(2)
    hit, want = [], []
    for _ in range(60):
        both, more = int(rng.integers(50, 400)), int(rng.integers(0, 60))
        x = rng.integers(1 << 62, size=both + 2 * more, dtype=np.uint64)
        a, b = x[: both + more], np.concatenate([x[:both], x[both + more :]])
        hit.append((signature(a) == signature(b)).mean())
        want.append(both / (both + 2 * more))
    assert abs(np.mean(hit) - np.mean(want)) < 0.01 and np.abs(np.array(hit) - want).max() < 0.15


def test_bands_find_what_is_near():
    rng = np.random.default_rng(3)
    for _ in range(300):
        x = rng.integers(1 << 62, size=300 + 54, dtype=np.uint64)
        a, b = band_keys(np.stack([signature(x[:327]), signature(np.concatenate([x[:300], x[327:]]))]))
        assert (a == b).any()  # similarity 300 / 354 = 0.847


def test_counts_in_common():
    rng = np.random.default_rng(4)
    for n, size in [(1, 5), (30, 20), (60, 90)]:
        sets = [rng.choice(120, size=int(rng.integers(0, size + 1)), replace=False) for _ in range(n)]
        got = shared_counts(np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets]), n)
        for i in range(n):
            for j in range(n):
                if i != j:
                    assert got[i, j] == len(set(sets[i].tolist()) & set(sets[j].tolist()))
