"""Intermediate tables and files in the folder that driver and executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork import scratch
from loomwork.scratch import shared_path

__all__ = ["broadcast_up_to", "discard", "neutral", "open_fs", "publish", "shared_path", "spread", "written"]

#: Bytes of the Arrow batches that Python workers get while a table is written, and rows that the Parquet reader decodes at once.
BATCH_BYTES, READ_ROWS = 8 << 20, 512


@contextmanager
def _batches_of(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    settings = {"spark.sql.execution.arrow.maxBytesPerBatch": most_bytes, "spark.sql.parquet.columnarReaderBatchSize": READ_ROWS}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def written(df: DataFrame, name: str, *, by: str | None = None) -> DataFrame:
    """scratch.written(), with Arrow batches of BATCH_BYTES: a worker's memory does not follow the size of rows."""
    with _batches_of(df.sparkSession, BATCH_BYTES):
        return scratch.written(df, name, by=by)


def discard(df: DataFrame) -> None:
    """Delete the files of a table of written() that nothing will read again."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    files = df.inputFiles()
    if files:
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(conf).delete(folder, True)


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows; else left to a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def neutral(docs: DataFrame, *own: str) -> DataFrame:
    """``docs`` with its columns but ``own`` renamed by place, so that no name of theirs can clash or need quotes; toDF(*docs.columns) brings them back."""
    return docs.toDF(*[c if c in own else f"_{k}" for k, c in enumerate(docs.columns)])


def open_fs(uri: str):
    """The pyarrow file system of a URI and the path in it; works in executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def publish(uri: str, data_chunks) -> int:
    """Write chunks to a new file; returns the bytes written.

    The name holds the task's attempt, and only the row that the attempt returns
    names the file.  So a repeated or speculative attempt writes a file of its own,
    and one that fails leaves a file that nothing reads.
    """
    store, path = open_fs(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    total = 0
    with store.open_output_stream(path, compression=None) as out:
        for chunk in data_chunks:
            out.write(chunk)
            total += len(chunk)
    return total


#: Tables of fewer bytes for each core are dealt out to all cores before Python works on their texts.
SPREAD_BYTES = 8 << 20


def spread(docs: DataFrame) -> DataFrame:
    """``docs`` with a partition for each core if the table is so small that its files may give fewer.

    Larger tables stay as they are, and their texts are not shuffled.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return docs.repartition(cores) if size < cores * SPREAD_BYTES else docs
