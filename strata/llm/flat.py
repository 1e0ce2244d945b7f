"""Token counts of documents in flat token files without an index.

A flat file is the documents' ids one after another, each document closed by
the end-of-document id. It is read in blocks: each task searches its blocks for
that id with one vectorised comparison, and a prefix scan over the blocks'
summaries (running number of ends, last end so far) stitches the documents
that cross a block's boundary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.bpe import encoder
from strata.llm.tables import stored
from strata.session import scratch_dir

BLOCK_TOKENS = 1 << 20
DTYPE = "<u2"


def open_store(uri: str):
    """(file system, path) of a file's URI or absolute path. The object store's
    ``s3a`` and ``s3n`` are Hadoop's names for ``s3``."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"s3://{rest}" if colon and scheme in ("s3a", "s3n") else uri)


def write_flat_tokens(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    end_id: int,
    folder: str | None = None,
    dtype: str = DTYPE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode ``docs`` into one flat file per task below ``folder`` (default: a
    fresh one in the shared checkpoint folder); the stored manifest (file,
    bytes, first, docs) lists the files and, in order, the ids of the documents
    in them from the document number ``first`` on.

    Each attempt of a task writes a file of its own; the manifest is committed
    by Spark and holds those of the attempts that counted.

    A NULL or empty text is an empty document (its end alone). Rows with NULL or
    repeated ids, and repeated rows, are documents each. An empty table gives an
    empty manifest and no file. Other columns, whatever their names, are ignored.
    """
    folder = folder or scratch_dir(docs.sparkSession, "flat-tokens")
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    most = int(np.iinfo(np.dtype(dtype)).max)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        bpe = encoder(ranks_path, pattern)
        name = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}.bin"
        out, size, first, listed = None, 0, 0, []
        for batch in batches:
            ids = [np.append(x, np.uint32(end_id)) for x in bpe.encode_batch(batch.column("text").to_pylist())]
            if not ids:
                continue
            flat = np.concatenate(ids)
            if int(flat.max()) > most:
                raise ValueError(f"token id {int(flat.max())} does not fit {dtype}")
            if out is None:
                store, path = open_store(name)
                store.create_dir(path.rpartition("/")[0], recursive=True)
                out = store.open_output_stream(path)
            out.write(flat.astype(dtype).tobytes())
            size += len(flat) * np.dtype(dtype).itemsize
            listed.append((first, batch.column("doc")))
            first += len(ids)
        if out is not None:
            out.close()
        for begin, doc in listed:
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([size], pa.int64()), pa.array([begin], pa.int64()), pa.array([doc.to_pylist()], pa.list_(pa.int64()))],
                names=["file", "bytes", "first", "docs"],
            )

    return stored(source.mapInArrow(run, "file string, bytes long, first long, docs array<long>"), "flat-manifest")


def listed_files(spark, folder: str) -> DataFrame:
    """(file, bytes) of the files in a folder, without reading them."""
    return spark.read.format("binaryFile").load(folder).select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def count_tokens(files: DataFrame, end_id: int, dtype: str = DTYPE, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, ordinal, n_tokens) for every document of the flat ``files`` (file,
    bytes), in order from ordinal 0, the end-of-document id not counted.

    Two ends in a row are an empty document (0 tokens). Tokens after a file's
    last end are one more document; nothing after it is none. Empty files and
    NULL names give no rows. A file listed twice counts once. A file whose
    length is not a whole number of ids is an error.
    """
    width = np.dtype(dtype).itemsize
    sized = files.select("file", F.col("bytes").cast("long").alias("bytes")).filter(F.col("file").isNotNull() & (F.col("bytes") > 0)).distinct()
    step = block_tokens * width
    blocks = sized.select(
        "file", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(step).cast("long"))).alias("block", "offset"), "bytes"
    )
    dealt = blocks.repartition("file", "block")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, offset, size in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "offset", "bytes"))):
                if size % width:
                    raise ValueError(f"{file}: {size} bytes are not whole ids of {width} bytes")
                store, path = open_store(file)
                with store.open_input_file(path) as f:
                    ids = np.frombuffer(f.read_at(min(step, size - offset), offset), dtype)
                ends = np.flatnonzero(ids == end_id).astype(np.int64) + offset // width
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block], pa.int32()), pa.array([size // width], pa.int64()),
                     pa.array([offset + step >= size]), pa.array([ends], pa.list_(pa.int64()))],
                    names=["file", "block", "total", "final", "ends"],
                )

    scanned = stored(dealt.mapInArrow(scan, "file string, block int, total long, final boolean, ends array<long>"), "flat-blocks")
    # Prefix scan over the summaries: one small row a block.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summary = scanned.select("file", "block", F.size("ends").alias("n"), F.array_max("ends").alias("last"))
    prefix = summary.select(
        "file",
        "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).cast("long").alias("open"),
    )
    stitched = scanned.join(prefix, ["file", "block"])
    last = F.coalesce(F.array_max("ends"), F.col("open"))
    rest = F.when(F.col("final") & (last < F.col("total") - 1), F.array(F.col("total"))).otherwise(F.array().cast("array<long>"))
    stops = F.concat("ends", rest)
    begun = F.concat(F.array("open"), "ends")
    lengths = F.zip_with(stops, F.slice(begun, F.lit(1), F.size(stops)), lambda stop, start: stop - start - 1)
    rows = stitched.select("file", "base", F.posexplode(lengths).alias("pos", "n_tokens"))
    return rows.select("file", (F.col("base") + F.col("pos")).cast("long").alias("ordinal"), "n_tokens")


def name_documents(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """(doc_id, n_tokens) of counted documents, by the manifest's order.

    A row for each document, NULL and repeated ids included; documents that are
    counted but not listed, or listed but not counted, have none. Empty tables give
    no rows.
    """
    listed = manifest.select("file", "first", F.posexplode("docs").alias("pos", "doc_id"))
    listed = listed.select("file", (F.col("first") + F.col("pos")).alias("ordinal"), "doc_id")
    return listed.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
