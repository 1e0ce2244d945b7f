"""SentencePiece encoding and decoding over a distinct-chunk table.

With whitespace-split BPE no piece crosses a whitespace marker (U+2581) from
the left: a marker only begins a piece. A normalised text is therefore the
concatenation of its marked words (a run of markers and the characters up to
the next marker), and its ids are those of its marked words in order.

A task keeps a table of the distinct marked words of its block of texts. The
words that a batch adds to the table are segmented, each once, in one call of
the library; a text is the numbers of its words by position, and its ids are
read off the table by those numbers. The table starts afresh with the next
block, so it is bounded by ``BLOCK_WORDS`` and one batch. Texts stay where they
are read: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import free_name, located

MARK = "▁"
BLOCK_WORDS = 400_000  # distinct words after which a block ends
_WORD = re.compile(f"{MARK}+[^{MARK}]*")


@cache
def processor(model: str):
    """The model's processor, loaded once in a Python worker."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=located(model))


def check_model(model: str) -> None:
    """Raise unless texts may be cut at whitespace markers for this model:
    identity normalisation, a dummy prefix, no whitespace removal, markers only
    at a piece's beginning, no user-defined symbols."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model, "rb") as f:
        proto.ParseFromString(f.read())
    norm = proto.normalizer_spec
    plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
    inner = any(MARK in p.piece.lstrip(MARK) for p in proto.pieces)
    user = any(p.type == sentencepiece_model_pb2.ModelProto.SentencePiece.USER_DEFINED for p in proto.pieces)
    if not plain or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix or inner or user:
        raise ValueError(f"{model}: pieces may cross whitespace markers")


def marked_words(text: str) -> list[str]:
    """The marked words of a text's normalised form, each without its first
    marker (the library's dummy prefix puts it back). The empty text has none."""
    if not text:
        return []
    return [w[1:] for w in _WORD.findall(MARK + text.replace(" ", MARK))]


def encode_texts(docs: DataFrame, model: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all but the text), with ids
    (binary: little-endian unsigned 32-bit integers, begin and end ids
    included) and decoded (string: the library's decode of the ids).

    Exactly the library's encode without sampling. A NULL text counts as empty
    (begin and end only). Rows are carried as they are, so NULL or repeated ids
    and extra columns do no harm; input columns named ids or decoded are replaced
    by the results. An empty table gives no rows.
    """
    check_model(model)
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    keep = [c for c in keep if c.lower() not in ("ids", "decoded")]
    source = docs.select(*keep, F.col(text_col).cast("string").alias(free_name(docs, "_text")))
    schema = docs.select(*keep, F.lit(b"").alias("ids"), F.lit("").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, table = processor(model), WordTable(model)
        for batch in batches:
            ids = table.encode(batch.column(len(keep)).to_pylist())
            decoded = [sp.decode(x.tolist()) for x in ids]
            columns = [pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + columns, names=[*keep, "ids", "decoded"])

    return source.mapInArrow(run, schema)


class WordTable:
    """The distinct marked words of a block, numbered, with their ids."""

    def __init__(self, model: str, block_words: int = BLOCK_WORDS):
        self.sp = processor(model)
        self.block_words = block_words
        self._begin_block()

    def _begin_block(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.zeros(0, "<u4")  # ids of all words, one after another
        self.ends = np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, begin and end ids included."""
        if len(self.number) > self.block_words:
            self._begin_block()
        known, number = len(self.number), self.number
        codes = []
        for text in texts:
            words = marked_words(text or "")
            codes.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
        self._segment(list(islice(number, known, None)))
        edge = (np.array([self.sp.bos_id()], "<u4"), np.array([self.sp.eos_id()], "<u4"))
        return [np.concatenate((edge[0], self._read(c), edge[1])) for c in codes]

    def _segment(self, words: list[str]) -> None:
        """Add the ids of new words. A word that is a lone marker has an empty
        rest, for which the library gives no ids: they are the marker's own."""
        lone = [self.sp.piece_to_id(MARK)]
        ids = [x or lone for x in self.sp.encode(words, num_threads=1)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(self.ends[-1]) if len(self.ends) else 0
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(ids), "<u4", int(lengths.sum()))))
        self.ends = np.concatenate((self.ends, total + np.cumsum(lengths)))

    def _read(self, codes: np.ndarray) -> np.ndarray:
        """The ids of the words ``codes``, one after another."""
        if not len(codes):
            return np.zeros(0, "<u4")
        end = self.ends[codes]
        many = end - np.where(codes > 0, self.ends[codes - 1], 0)
        stop = np.cumsum(many)
        return self.flat[np.arange(int(stop[-1])) + np.repeat(end - stop, many)]
