"""What the operators share: the shared folder, tables written to it and their removal, words, and batches cut by bytes."""

from __future__ import annotations

import contextlib
import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantgraph.scratch import shared_dir

#: A word is a maximal run of anything but space, tab, newline, vertical tab, form feed, carriage return.
#: ``bytes.split()`` without arguments cuts UTF-8 texts at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_DEFAULT_BATCH, _OUR_BATCH = "67108864b", str(4 << 20)
_written: dict[str, list[str]] = defaultdict(list)


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written[spark.sparkContext.applicationId].append(path)
    return path


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts, Spark hands rows to Python in record batches of 4 MB: a batch lies in the executor's and the Python
    worker's memory several times over. A size that the session has set itself stays; afterwards the session is as it was."""
    if spark.conf.get(BATCH_BYTES) != _DEFAULT_BATCH:
        yield
        return
    spark.conf.set(BATCH_BYTES, _OUR_BATCH)
    try:
        yield
    finally:
        spark.conf.unset(BATCH_BYTES)


def stash(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write a table to the shared folder and read it back. Lost executors cost nothing after that."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    with contextlib.suppress(ValueError):
        _written[spark.sparkContext.applicationId].remove(path)


def mark(spark: SparkSession) -> int:
    """A place in the list of written tables, for release()."""
    return len(_written[spark.sparkContext.applicationId])


def release(spark: SparkSession, since: int = 0, but: int = 0) -> None:
    """Deletes the tables written since a mark, but the last `but`. A result is lazy and reads its operator's tables, so call
    this when the result has been written or collected."""
    paths = _written[spark.sparkContext.applicationId][since:]
    for path in paths[: len(paths) - but]:
        discard(spark, path)


def named(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def checked(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """A stashed table with a broadcast hint where it is counted to have at most so many rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def n_words(text: Column) -> Column:
    """Words of a text as long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lowered(text: str) -> str:
    """Lower case, character by character where a character has a longer one: offsets stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def quoted(schema: DataFrame | list) -> str:
    """Fields as a schema string, for mapInArrow."""
    fields = schema.schema if isinstance(schema, DataFrame) else schema
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)


def slices(batches: Iterator[pa.RecordBatch], column: int, max_bytes: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut record batches so that the values of one text column stay near max_bytes; a longer text comes alone."""
    for batch in batches:
        values = batch.column(column)
        start, held = 0, 0
        sizes = [0 if x is None else x for x in pa.compute.binary_length(values).to_pylist()]
        for i, size in enumerate(sizes):
            if i > start and held + size > max_bytes:
                yield batch.slice(start, i - start), values.slice(start, i - start).to_pylist()
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start), values.slice(start).to_pylist()
