"""Flat token files and packed matrices: exact counts and round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from strata.llm import bpe, flat, packing, queries

RANKS = queries.tokenizer(queries.BYTE_PAIR_RANKS)
END = queries.BYTE_PAIR_END


def direct(text):
    return bpe.encoder(RANKS, public_tokenizers.PATTERN)._encoding.encode_ordinary(text or "")


def test_cut_words_encode_as_whole_texts():
    rng = random.Random(2)
    coder = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    assert isinstance(coder._encoding, tiktoken.Encoding)
    texts = ["", " ", "a ", " a", "a  b"] + [
        "".join(rng.choice(" \n\ta'sb.,é中1\x1c\x85\xa0　😀") for _ in range(rng.randrange(40))) for _ in range(3000)
    ]
    assert [x.tolist() for x in coder.encode_batch(texts)] == [direct(t) for t in texts]


def test_counts_of_documents(docs, rows, empty):
    manifest = flat.write_flat_tokens(docs, RANKS, public_tokenizers.PATTERN, END)
    for block in (1 << 20, 7):  # documents in one block, and across many
        counts = flat.count_tokens(manifest.select("file", "bytes"), END, block_tokens=block)
        got = sorted(map(tuple, flat.name_documents(counts, manifest).collect()), key=str)
        assert got == sorted(((r[0], len(direct(r[1]))) for r in rows), key=str)
    assert flat.write_flat_tokens(empty, RANKS, public_tokenizers.PATTERN, END).count() == 0


def test_clashing_names(docs, clashing):
    from pyspark.sql import functions as F

    extra = clashing.withColumns({c: F.lit(1) for c in ("doc", "file", "bytes", "first", "docs", "pack", "input_ids", "cu_seqlens", "doc_ids")})
    totals = []
    for table in (docs, extra):
        manifest = flat.write_flat_tokens(table, RANKS, public_tokenizers.PATTERN, END)
        counts = flat.name_documents(flat.count_tokens(manifest.select("file", "bytes"), END), manifest)
        packed = packing.pack_documents(table, END, 64)
        totals.append((sorted(map(str, counts.collect())), sum(int(r.cu_seqlens[-1]) for r in packed.collect())))
    assert totals[0] == totals[1]


@pytest.mark.parametrize("ids", [[], [9], [5, 5, 9], [9, 9, 1, 9, 2], [1, 2, 3, 9, 9], [1] * 10, [9] * 10])
def test_counts_of_odd_files(spark, tmp_path, ids):
    path = tmp_path / "t.bin"
    path.write_bytes(np.array(ids, "<u2").tobytes())
    docs, run = [], 0
    for i in ids:
        run = run + 1 if i != 9 else (docs.append(run) or 0)
    docs += [run] if run else []
    files = spark.createDataFrame([(str(path), 2 * len(ids)), (str(path), 2 * len(ids)), (None, 4)], "file string, bytes long")
    for block in (1, 2, 3, 100):
        out = flat.count_tokens(files, 9, block_tokens=block).orderBy("ordinal").collect()
        assert [(r.ordinal, r.n_tokens) for r in out] == list(enumerate(docs))


def test_listing_and_broken_file(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(np.array([1, 9], "<u2").tobytes())
    assert flat.count_tokens(flat.listed_files(spark, str(tmp_path)), 9).collect()[0].n_tokens == 1
    (tmp_path / "a.bin").write_bytes(b"123")
    with pytest.raises(Exception, match="whole ids"):
        flat.count_tokens(flat.listed_files(spark, str(tmp_path)), 9).collect()


def brute_rooms(lengths, capacity):
    rooms = []
    for need in sorted(lengths, reverse=True):
        best = min((i for i, r in enumerate(rooms) if r >= need), key=lambda i: rooms[i], default=None)
        if best is None:
            rooms.append(capacity - need)
        else:
            rooms[best] -= need
    return sorted(rooms)


def test_best_fit_decreasing():
    rng = random.Random(4)
    for _ in range(300):
        capacity = rng.randrange(1, 40)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(0, 50))]
        rows = packing.pack_lengths(lengths, capacity)
        assert sorted(k for r in rows for k in r) == list(range(len(lengths)))
        assert sorted(capacity - sum(lengths[k] for k in r) for r in rows) == brute_rooms(lengths, capacity)
    with pytest.raises(ValueError):
        packing.pack_lengths([5], 4)


@pytest.mark.parametrize("ranks, pattern, end", [(None, None, 1), (RANKS, public_tokenizers.PATTERN, END)])
def test_round_trip(docs, rows, empty, ranks, pattern, end):
    context = 64
    out = packing.pack_documents(docs, end, context, ranks, pattern, group_tokens=2000).collect()
    pieces: dict = {}
    for r in out:
        ids, positions = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(positions) == context and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] <= context
        for k, (doc, start) in enumerate(zip(r.doc_ids, r.segment_starts)):
            a, b = r.cu_seqlens[k], r.cu_seqlens[k + 1]
            assert positions[a:b].tolist() == list(range(b - a))
            pieces.setdefault(doc, []).append((start, ids[a:b].tolist()))
        assert (ids[r.cu_seqlens[-1] :] == end).all() and not positions[r.cu_seqlens[-1] :].any()
    encode = direct if ranks else lambda t: [b + 3 for b in (t or "").encode()]
    want: dict = {}
    for r in rows:
        ids = encode(r[1]) + [end]
        want.setdefault(r[0], []).extend((s, ids[s : s + context]) for s in range(0, len(ids), context))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.pack_documents(empty, end, context, ranks, pattern).count() == 0
    again = packing.pack_documents(docs, end, context, ranks, pattern, group_tokens=2000).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
