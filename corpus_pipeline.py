"""A training corpus from ``documents``: quality, near-duplicates, mixing, token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written and reread as the next one's docs. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import mixing, pieces, quality, queries, simhash
from strata.llm.tables import free_name, stored


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score 0.7 or more). A NULL
    text is scored as an empty one; repeated rows and ids are scored each; an empty
    table stays empty; other columns are carried along."""
    weights, bias = queries.quality_model(spark, sf_dir)
    name = free_name(docs, "score")
    scored = quality.score(docs, weights, bias, out=name)
    return scored.filter(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, with the operator's own shingles and
    radius (3 words, 2 bits): the one of the least doc_id (NULL last), then of the
    least hash of its text and of its whole row, so reruns keep the same one.
    NULL and blank texts are one group, repeated rows are copies, an empty table
    stays empty; other columns are carried along."""
    whole = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in sorted(docs.columns)])
    mark = F.struct(F.xxhash64("text").alias("of_text"), whole.alias("of_row"))
    found = simhash.near_duplicates(docs, shingle=3, radius=2, mark=mark)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "mark")
    first = found.groupBy("root").agg(F.min_by(F.struct("doc_id", "mark"), order).alias("first"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), mark.alias("mark"))
    same = rows["id"].eqNullSafe(first["first.doc_id"]) & (rows["mark"] == first["first.mark"])
    return rows.join(first, same).dropDuplicates(["root"]).select("row.*")  # only equal rows are left


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources have their target weights.
    A NULL source is a source, a NULL or empty text has size 0 and is taken the whole
    epochs of its source; repeated rows are mixed each; an empty table stays empty;
    other columns are carried along."""
    mixed = mixing.mix(docs, queries.MIX_WEIGHTS, queries.MIX_BUDGET, queries.MIX_EPOCHS)
    return mixing.repeat_documents(docs, mixed)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The SentencePiece ids of each document: digests as in the operator's query,
    and the ids themselves (little-endian unsigned 32-bit integers). A NULL text
    counts as empty (begin and end ids); NULL or repeated doc_ids give a row each;
    an empty table gives none; other columns are left out."""
    coded = pieces.encode_texts(docs, queries.tokenizer(queries.PIECE_MODEL), keep=["doc_id"])
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", keep_good_quality),
    ("near_duplicates", keep_one_of_each_group),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL = None  # a trained classifier and a subword model are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
