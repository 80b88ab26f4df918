"""Token counts by a separator scan over flat, unindexed token files.

A token file is nothing but little-endian ids, documents one after another, each closed by an end-of-document id. Files
are cut into blocks of fixed size wherever those fall. Each block is one task's range read: a vectorised search gives its
separators, the lengths of the documents that lie inside, and the tokens before its first and after its last separator.
Blocks are then stitched by a prefix scan over the blocks of each file: the separators before a block number its
documents, and the tokens carried in since the last separator complete its first one, over any number of blocks.

Memory is bounded by a block. A block hands on one array of lengths; the scan sees a row of counts per block.

Files are reached through pyarrow's file systems by URI, on any executor. A writing task writes to a name of its own
and renames when done, so a task that is lost and run again, or run twice, leaves the same file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenantgraph.llm.shared import discard, new_path, slices, stash
from tenantgraph.llm.tokens import token_bytes

END = 50256
_COUNTS = "file string, block long, n long, separators long, head long, tail long, inner array<int>"


def _open(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pa.fs.LocalFileSystem(), uri)


def write_token_files(docs: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text", tokenizers: str | None = None) -> DataFrame:
    """Writes one file of 16-bit ids per partition to the folder; (file, at, nth, id) says which document is where.

    Texts are encoded as ordinary text, so the end-of-document id comes from document ends alone.
    """
    read = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    close = np.array([END], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_bytes(tokenizers, special_is_text=True)
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}.tokens"
        fs, path = _open(name)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        own, at, nth = f"{path}.{uuid.uuid4().hex}", 0, 0
        with fs.open_output_stream(own) as out:
            for batch, texts in slices(batches, 1, 4 << 20):
                places = []
                for text in texts:
                    ids = np.frombuffer(encode(text), "<u4").astype("<u2").tobytes() + close
                    out.write(ids)
                    places.append(at)
                    at += len(ids)
                k = len(texts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * k), pa.array(places, pa.int64()), pa.array(range(nth, nth + k), pa.int64()), batch.column(0)], ["file", "at", "nth", "id"])
                nth += k
        fs.move(own, path)

    return read.mapInArrow(run, f"file string, at long, nth long, id {read.schema['id'].dataType.simpleString()}")


def scan_block(tokens: np.ndarray, end: int) -> tuple[int, int, int, int, np.ndarray]:
    """Tokens, separators, tokens before the first and after the last of them, lengths of the documents between."""
    at = np.flatnonzero(tokens == end)
    if not len(at):
        return len(tokens), 0, 0, len(tokens), at
    return len(tokens), len(at), int(at[0]), len(tokens) - int(at[-1]) - 1, np.diff(at) - 1


def count_tokens(spark: SparkSession, files: DataFrame, *, end: int = END, dtype: str = "<u2", block_bytes: int = 4 << 20) -> DataFrame:
    """files (file) to (file, nth, n_tokens, closed), one row per document; a file's last one may lack its separator."""
    width = np.dtype(dtype).itemsize
    step = block_bytes - block_bytes % width

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                fs, path = _open(name)
                size = fs.get_file_info(path).size
                rows += [(name, k, at, min(step, size - at)) for k, at in enumerate(range(0, size - size % width, step))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["file", "block", "at", "size"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, block, at, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, path = _open(name)
                with fs.open_input_file(path) as f:
                    f.seek(at)
                    raw = f.read(size - size % width)
                n, separators, head, tail, inner = scan_block(np.frombuffer(raw, dtype), end)
                values = ((name, pa.string()), (block, pa.int64()), (n, pa.int64()), (separators, pa.int64()), (head, pa.int64()), (tail, pa.int64()), (inner.tolist(), pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], ["file", "block", "n", "separators", "head", "tail", "inner"])

    blocks = files.select("file").distinct().mapInArrow(cut, "file string, block long, at long, size long")
    blocks = blocks.repartition(F.col("file"), F.col("block")).mapInArrow(scan, _COUNTS)
    counts = stash(blocks, "tokens-blocks")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    scanned = counts.select("file", "block", "separators", "head", "tail").withColumns({
        "nth": F.coalesce(F.sum("separators").over(before), F.lit(0)),
        "since": F.sum((F.col("separators") > 0).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "last": F.lead("block").over(order).isNull(),
    })
    run = F.sum("tail").over(Window.partitionBy("file", "since").orderBy("block").rowsBetween(Window.unboundedPreceding, 0))
    scanned = scanned.withColumn("run", run).withColumn("carry", F.coalesce(F.lag("run").over(order), F.lit(0)))
    inner = counts.select("file", "block", "inner")
    whole = scanned.join(inner, ["file", "block"]).where("separators > 0")
    lengths = F.concat(F.array((F.col("carry") + F.col("head")).cast("long")), F.col("inner").cast("array<long>"))
    closed = whole.select("file", "nth", F.posexplode(lengths).alias("k", "n_tokens")).select("file", (F.col("nth") + F.col("k")).alias("nth"), "n_tokens", F.lit(True).alias("closed"))
    open_ = scanned.where("last and run > 0").select("file", (F.col("nth") + F.col("separators")).alias("nth"), F.col("run").alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(open_)


def token_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizers: str | None = None, block_bytes: int = 4 << 20) -> DataFrame:
    """(id, n_tokens) of each row of docs: its texts written to flat token files, and those scanned. The files go at the end."""
    spark = docs.sparkSession
    folder = new_path(spark, "tokens-files")
    where = stash(write_token_files(docs, folder, id_col=id_col, text_col=text_col, tokenizers=tokenizers), "tokens-where")
    counts = stash(count_tokens(spark, where.where("nth = 0"), block_bytes=block_bytes), "tokens-counts")
    discard(spark, folder)
    return where.join(counts, ["file", "nth"]).select(F.col("id").alias(id_col), "n_tokens")
