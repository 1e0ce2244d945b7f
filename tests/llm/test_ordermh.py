"""Order MinHash in Spark functions against a plain one."""

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from strata.llm import ordermh, queries

M64 = (1 << 64) - 1


def edited(rows):
    """(id, text) -> edited text, over distinct (id, text) in the documented order."""
    def th(t):
        return int.from_bytes(xxhash.xxh64(t.encode(), seed=42).digest(), "big", signed=True)

    keys = sorted({(r[0], r[1] or "") for r in rows}, key=lambda k: (k[0] is None, -(k[0] or 0), -th(k[1])))
    out = {}
    for i, (k, t) in enumerate(keys):
        nxt = keys[(i + 1) % len(keys)][1]
        cut = len(t) // 3
        out[k, t] = (t[: len(t) - cut] + nxt[:cut], nxt)
    return out


def kmers(text, k=3):
    words = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", text or "") if w]
    return [tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1 if words else 0))]


def reference(spark, texts, ell=2):
    """The operator's definition, step by step in Python; only the hash values come
    from Spark's xxhash64."""
    def signed(values, kinds):
        if not values:
            return {}
        df = spark.createDataFrame(values, kinds)
        return {tuple(v): r for v, r in zip(values, [x[0] for x in df.select(F.xxhash64(*df.columns)).collect()])}

    grams = {t: kmers(t) for t in texts}
    by_size = {n: signed(sorted({g for gs in grams.values() for g in gs if len(g) == n}), ", ".join(f"w{i} string" for i in range(n))) for n in (1, 2, 3)}
    kh = {t: [by_size[len(g)][g] for g in gs] for t, gs in grams.items()}
    pairs = set()
    for hs in kh.values():
        seen = {}
        for h in hs:
            pairs.add((h, seen.setdefault(h, 0)))
            seen[h] += 1
    ph = signed(sorted(pairs), "h long, n int")
    out = {}
    for t, hs in kh.items():
        shift = len(bin(len(hs))) - 2
        seen, elements = {}, []
        for pos, h in enumerate(hs):
            g = ph[h, seen.setdefault(h, 0)]
            seen[h] += 1
            elements.append(((g >> shift << shift) | pos, pos))
        elements.sort()
        bins = {}
        for g, pos in elements:
            bins.setdefault((g & M64) >> 58, []).append(pos)
        out[t] = {b: tuple(hs[p] for p in sorted(ps[:ell])) for b, ps in bins.items()}
    tuples = sorted({v for bs in out.values() for v in bs.values()})
    df = spark.createDataFrame([(list(v),) for v in tuples], "a array<long>")
    th = dict(zip(tuples, [(r[0] & M64) >> 38 for r in df.select(F.xxhash64("a")).collect()]))
    return {t: sorted(b << 26 | th[v] for b, v in bs.items()) for t, bs in out.items()}


def test_fingerprints_equal_the_definition(spark, docs, rows):
    texts = sorted({r[1] or "" for r in rows}) + ["a a a a a a", "x y x y x y x y z", "b " * 500]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: list(r.fp) for r in ordermh.with_fingerprint(df, F.col("text"), "fp").collect()}
    assert got == reference(spark, texts)


def test_edited_texts_and_likeness(docs, rows, clashing, empty):
    want = edited(rows)
    for table in (docs, clashing):
        out = ordermh.edited_fingerprints(table).collect()
        assert len(out) == len(rows)
        by_text: dict = {}
        got = sorted(((r.doc_id, r.n_chars, r.edited) for r in out), key=str)
        assert got == sorted(((r[0], len(r[1] or ""), want[r[0], r[1] or ""][0]) for r in rows), key=str)
        for r in out:
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            by_text.setdefault(r.edited, set()).add(tuple(r.edited_fingerprint))
        assert all(len(f) == 1 for f in by_text.values())  # equal texts, equal fingerprints
    assert ordermh.edited_fingerprints(empty).count() == 0


def test_likeness_follows_the_edits(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(9999)}" for _ in range(600)]
    moved = base[300:] + base[:300]
    shuffled = sorted(base, key=lambda w: rng.random())
    few = [w if rng.random() > 0.02 else "new" for w in base]
    texts = {"base": base, "few": few, "moved": moved, "shuffled": shuffled}
    df = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "name string, text string")
    fps = {r.name: r.fp for r in ordermh.with_fingerprint(df, F.col("text"), "fp").collect()}

    def near(a, b):
        pair = spark.createDataFrame([(fps[a], fps[b])], "a array<long>, b array<long>")
        return pair.select(ordermh.likeness(F.col("a"), F.col("b"))).first()[0]

    assert near("base", "base") == 1
    assert near("base", "few") > 0.6 > 0.1 > near("base", "shuffled")
    # The same k-mers in another order: order MinHash sees it, plain MinHash would not.
    assert near("base", "moved") < 0.75


def test_short_texts_in_another_order_differ(spark):
    """Against 64 permutations of a plain order MinHash, over texts with
    the same words in another order."""
    rng = random.Random(5)
    for n in (20, 40, 100):
        pairs = []
        for _ in range(20):
            base = [f"w{rng.randrange(9999)}" for _ in range(n)]
            pairs.append((base, base[n // 2 :] + base[: n // 2]))
        rows = [(2 * i + j, " ".join(t)) for i, p in enumerate(pairs) for j, t in enumerate(p)]
        out = ordermh.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
        got = {r.doc_id: r.fingerprint for r in out.collect()}
        assert all(len(f) == 64 for f in got.values())
        near = sum(len(set(got[2 * i]) & set(got[2 * i + 1])) for i in range(20)) / (20 * 64)
        want = 0.0
        for a, b in pairs:
            for seed in range(64):
                first, second = [
                    [g for g in kmers(" ".join(t)) if g in set(sorted(kmers(" ".join(t)), key=lambda g: xxhash.xxh64_intdigest(" ".join(g), seed))[:2])]
                    for t in (a, b)
                ]
                want += (first == second) / (20 * 64)
        assert abs(near - want) < 0.12, (n, near, want)


def test_filled_bins_equal_the_definition(spark, docs, rows):
    """Bins with ``ell`` elements keep their component; the others count on round the circle."""
    texts = sorted({r[1] or "" for r in rows})
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    both = ordermh.with_fingerprint(ordermh.with_fingerprint(df, F.col("text"), "fp"), F.col("text"), "full", filled=True)
    for r in both.collect():
        assert [x >> 26 for x in r.full] == (list(range(64)) if r.fp else [])
        if len(kmers(r.text)) > 3000:
            assert r.fp == r.full
        if len(kmers(r.text)) in (1, 2):  # one tuple of all elements
            assert len({x & (1 << 26) - 1 for x in r.full}) == 1


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = edited(rows)
    texts = dict(rows)
    out = queries.op4_order_minhash(spark, sf).collect()
    assert len(out) == len(rows)
    for r in out:
        t = texts[r.doc_id]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(want[r.doc_id, t][0].encode()).hexdigest()
        if len(t) > 1500:
            assert r.near_edited > 0.03
    assert sum(r.near_edited for r in out) > 3 * sum(r.near_next for r in out if texts[r.doc_id] != want[r.doc_id, texts[r.doc_id]][1])


def test_native_plan(docs):
    plan = ordermh.edited_fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow", "CartesianProduct", "NestedLoop"))


def test_one_and_two_documents(spark):
    one = spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")
    r = ordermh.edited_fingerprints(one).first()
    assert (r.edited, r.near_next) == ("abcdab", 1.0)
    two = spark.createDataFrame([(4, "abcdef"), (9, "x")], "doc_id long, text string")
    got = {r.doc_id: r.edited for r in ordermh.edited_fingerprints(two).collect()}
    assert got == {4: "abcdx", 9: "x"}
