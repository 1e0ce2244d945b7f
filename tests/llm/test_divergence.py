"""Source divergence: against exact arithmetic on small tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.divergence import CountTree, audit_sources, count_terms, pair_sums, shares

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, top=200):
    """(lang, source, text) rows -> the operator's rows."""
    groups, df = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(words)
        df[lang or ""].update(set(words))
    out = []
    for lang in df:
        kept = [t for t, n in df[lang].items() if n >= 3]
        own = {s: c for (g, s), c in groups.items() if g == lang}
        whole = Counter()
        for c in own.values():
            whole.update(c)

        def share(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p = {s: share(c) for s, c in own.items()}
        q = share(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in own:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in own if o != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(found[:most])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ["The", "é", "中", "x", "Ab"] for b in "qwertyuiopasdfghjk"]
    out = [(lang, f"s{rng.randrange(n)}", " ".join(rng.choices(words, weights=range(1, len(words) + 1), k=rng.randrange(60))))
           for lang, n in (("en", 9), ("de", 2), ("fr", 1)) for _ in range(60)]
    out += [("en", "hot", "The the THE the_the 12the")] * 50
    out += [(None, None, "a b a"), (None, "", "a b"), ("", "z", "A c"), ("es", "one", None), ("es", "two", "12 ..."), ("es", None, "a")]
    return out


@pytest.mark.parametrize("columns, block", [(4096, 128), (7, 128), (16, 2), (1, 1)])
def test_against_exact_arithmetic(spark, texts, columns, block):
    df = spark.createDataFrame(texts, "lang string, source string, text string").repartition(3)
    got = audit_sources(df, top=5, columns=columns, rows_a_block=block).collect()
    assert sorted(map(tuple, got), key=str) == plain(texts, 5)


def test_joint_traversal_against_the_dense_matrix():
    rng = np.random.default_rng(1)
    for _ in range(60):
        rows, cols = int(rng.integers(1, 20)), int(rng.integers(1, 50))
        dense = rng.integers(0, 40, (rows, cols)) * (rng.random((rows, cols)) < rng.choice([0, 0.02, 0.3, 1]))
        row, col = np.nonzero(dense)
        total = dense.sum(axis=1) + cols
        share = shares(dense, total[:, None])
        empty = shares(np.zeros(rows, np.int64), total)
        height = max(1, int(max(rows, cols) - 1).bit_length())
        got = pair_sums(CountTree(row, col, height), rows, cols, share[row, col], empty)
        want = np.array([[((share[a] - share[b]) ** 2 // share[b]).sum() for b in range(rows)] for a in range(rows)])
        assert (got == want).all()
        if rows > 1:
            cut = int(rng.integers(1, rows))
            got = pair_sums(CountTree(row, col, height), rows, cols, share[row, col], empty, cut)
            assert (got[:cut, cut:] == want[:cut, cut:]).all() and (got[cut:, :cut] == want[cut:, :cut]).all()


def test_shares_are_exact():
    for count, total in [(0, 1), (10**15, 10**15 + 7), (8_999_999_999_999_999, 9 * 10**15), (3, 7), (123456789, 987654321987)]:
        assert shares(np.array([count]), total)[0] == 1 + 10**9 * (count + 1) // total


def test_counts_are_handed_on_in_parts(spark, texts):
    df = spark.createDataFrame(texts, "lang string, source string, text string").select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce("text", F.lit("")).cast("binary").alias("text")
    ).coalesce(1)
    whole, parts = [
        {tuple(r)[:3]: tuple(r)[3:] for r in count_terms(df, n).groupBy("lang", "source", "term").agg(F.sum("n"), F.sum("docs")).collect()}
        for n in (1 << 18, 5)
    ]
    assert whole == parts and len(whole) > 100


def test_odd_tables(spark, clashing, empty):
    assert audit_sources(empty).count() == 0
    kept = clashing.select("lang", "source", "text").collect()
    extra = clashing.withColumns({c: F.lit(1) for c in ("term", "n", "total", "tile", "item", "value")})
    assert sorted(map(tuple, audit_sources(extra).collect()), key=str) == plain([tuple(r) for r in kept])
