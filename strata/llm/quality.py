"""Quality classifier: hashed word n-grams, logistic regression trained by FTRL.

A document becomes a sparse vector of hashed word n-grams. Words are runs of
letters and digits, and runs of other characters; the n-grams are one and two
lower-cased words, and one to three words by shape, where a word that repeats
one of the two before it has a shape of its own. Training is follow-the-regularised-leader with per-coordinate rates
(McMahan et al., Ad Click Prediction, 2013) over a bounded sample of labelled
rows; the weights are one array of fixed size, sent with the scoring tasks, and
a score is the logistic of a sparse dot product.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import free_name

BITS = 18  # log2 of the number of weights
MAX_TRAIN_ROWS = 6000  # labelled rows the classifier is fitted on, at most
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W_]+|[^\w\s]+|_+")
CACHED_WORDS = 200_000  # words whose code a worker remembers


def _shape(word: str) -> str:
    if not word[0].isalnum():
        return word[0] + ("+" if len(word) > 1 else "")
    if word.isdigit():
        return "9"
    if word.isupper() and len(word) > 1:
        return "XX"
    if word[1:].islower() or len(word) == 1:
        return ("x" if word[0].islower() else "X") + ("l" if len(word) > 12 else "")
    return "Xx"


class _Codes(dict):
    """Word -> 48 bits of the lower-cased word's hash, 16 bits of its shape's."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        digest = xxhash.xxh64_intdigest
        code = self[word] = (digest(word.lower()) >> 16 << 16) | (digest(_shape(word)) >> 48)
        return code


_CODES = _Codes()
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD], np.uint64)
_REPEAT = np.uint64(0xFFFF)  # the shape of a word that repeats one of the two before it


def _slots(kind: int, *grams: np.ndarray) -> np.ndarray:
    """Weight numbers of n-grams given by the codes of their words."""
    mixed = np.full(len(grams[0]), kind + 1, np.uint64) * _MIX[3]
    for gram, factor in zip(grams, _MIX):
        mixed = (mixed ^ gram) * factor
        mixed ^= mixed >> np.uint64(29)
    return (mixed * _MIX[0] >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashed indices, values) of a text; values are log(1 + count),
    scaled to length 1. NULL and blank texts have no features."""
    words = _WORD.findall(text) if text else []
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    codes = np.fromiter(map(_CODES.__getitem__, words), np.uint64, len(words))
    word, shape = codes >> np.uint64(16), codes & np.uint64(0xFFFF)
    repeat = np.zeros(len(words), bool)
    repeat[1:] = word[1:] == word[:-1]
    repeat[2:] |= word[2:] == word[:-2]
    shape[repeat] = _REPEAT
    index = np.concatenate(
        (
            _slots(0, word),
            _slots(1, word[:-1], word[1:]),
            _slots(2, shape),
            _slots(3, shape[:-1], shape[1:]),
            _slots(4, shape[:-2], shape[1:-1], shape[2:]),
        )
    )
    at, count = np.unique(index, return_counts=True)
    value = np.log1p(count)
    return at, value / np.sqrt(value @ value)


def logistic(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


@dataclass
class FTRL:
    """Per-coordinate FTRL-proximal logistic regression."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.01
    l2: float = 0.1
    epochs: int = 4

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, float]:
        """Weights and bias from (indices, values, 0 or 1) rows, in their order.
        The bias is the log odds of the labels (each counted once more than it
        is), so a text without known features scores the share of label 1."""
        z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        ones = sum(label for _, _, label in rows)
        bias = float(np.log((ones + 1) / (len(rows) - ones + 1)))
        for _ in range(self.epochs):
            for at, value, label in rows:
                w = self._weights(z[at], n[at])
                g = (logistic(w @ value + bias) - label) * value
                sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / self.alpha
                z[at] += g - sigma * w
                n[at] += g * g
        return self._weights(z, n).astype(np.float32), bias

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)


def sample_labels(labels: DataFrame, id_col: str, label_col: str, allowed: Column | None, limit: int) -> DataFrame:
    """(id, label) of at most ``limit`` labelled ids, those with the least md5 of
    the id. NULL ids and labels are left out, and so are ids with both labels."""
    rows = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if allowed is not None:
        rows = rows.filter(allowed)
    one = rows.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_label"), F.max(label_col).alias("_other"))
    one = one.filter(F.col("_label") == F.col("_other")).select("_id", F.col("_label").cast("int").alias("_label"))
    return one.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(limit)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    allowed: Column | None = None,
    max_rows: int = MAX_TRAIN_ROWS,
    model: FTRL | None = None,
) -> tuple[np.ndarray, float]:
    """Weights and bias fitted on at most ``max_rows`` labelled documents.

    The sampled ids are few by their bound and are sent to the documents; each
    sampled id's text of the least hash is turned into its sparse vector, and only
    those vectors, one for each id, reach the driver. ``allowed`` restricts the rows of ``labels``.
    Where no row is labelled, or ``docs`` is empty, the weights are all zero (every
    score 0.5). A NULL text is a text without features; rows with a NULL id are not
    sampled; of rows that repeat an id one counts; other columns are ignored.
    """
    picked = sample_labels(labels, id_col, label_col, allowed, max_rows)
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("_text"))
    joined = rows.join(F.broadcast(picked), F.col("_doc") == F.col("_id")).select("_doc", "_label", "_text")
    by_hash = F.struct(F.xxhash64("_text"), "_text")  # rows that repeat an id count once
    joined = joined.groupBy("_doc", "_label").agg(F.min_by("_text", by_hash).alias("_text"))
    vectors = joined.mapInArrow(_vectors, "doc long, label int, at binary, value binary")
    found = vectors.toArrow().to_pylist()
    found.sort(key=lambda r: (xxhash.xxh64_intdigest(str(r["doc"])), r["doc"]))
    data = [(np.frombuffer(r["at"], np.int32).astype(np.int64), np.frombuffer(r["value"], np.float32).astype(np.float64), r["label"]) for r in found]
    return (model or FTRL()).fit(data)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, value = [], []
        for text in batch.column("_text"):
            i, v = features(text.as_py())
            at.append(i.astype(np.int32).tobytes())
            value.append(v.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_doc").cast(pa.int64()), batch.column("_label").cast(pa.int32()), pa.array(at, pa.binary()), pa.array(value, pa.binary())],
            names=["doc", "label", "at", "value"],
        )


def score(docs: DataFrame, weights: np.ndarray, bias: float, text_col: str = "text", out: str = "score") -> DataFrame:
    """The columns of ``docs`` and ``out``, the probability of label 1 (double).

    Scored from the whole text alone; NULL and blank texts get the logistic of
    the bias. Repeated rows are scored each, extra columns are carried, and an
    input column already called ``out`` is replaced. An empty table gives no
    rows.
    """
    kept = [c for c in docs.columns if c != out]
    source = docs.select(*kept, F.col(text_col).cast("string").alias(free_name(docs, "_text")))
    schema = docs.select(*kept, F.lit(0.0).alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for text in batch.column(len(kept)):
                at, value = features(text.as_py())
                scores.append(logistic(weights[at].astype(np.float64) @ value + bias))
            columns = [batch.column(i) for i in range(len(kept))] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=kept + [out])

    return source.mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text, modulo 4, is 2 (NULL ids are not)."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
