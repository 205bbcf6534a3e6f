"""Token counts by a scan for end-of-document ids.

A flat file holds ids only: no index, no lengths.  It is read in blocks of a
fixed number of ids; in each block one vectorised comparison finds the
separators.  A document that begins in an earlier block ends at the first
separator of a later one, so its start is the last separator before it: a
running maximum over the blocks of a file.  Files start and end with whole
documents, so every file is scanned by itself, and a second prefix sum, over the
files, gives each document its place in the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared_folder import broadcast_up_to, open_fs, publish, shared_path, spread, written
from .token_frames import encoded, id_width

BLOCK_IDS = 1 << 20
BROADCAST_ROWS = 1_000_000


def flat_name(shard: int, attempt: int) -> str:
    return f"flat-{shard:06d}-{attempt}.bin"


def write_flat_files(docs: DataFrame, tokenizer_path: str, end_id: int, *, folder: str | None = None) -> tuple[str, int, list, DataFrame]:
    """A flat file for each partition: folder, bytes of an id, (shard, name, ids) of the files, (shard, ordinal, doc_id) of the documents.

    Partitions of large tables stay as they are, so their texts are not shuffled;
    in a file, documents go by doc_id and text.  Strings of added tokens in a text
    are encoded as text, so the end id stands between documents only.
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "flat-tokens")
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    setup = spark.sparkContext.broadcast(text)
    width = id_width(text)
    schema = pa.schema([("shard", pa.int64()), ("ordinal", pa.int64()), ("doc_id", pa.int64()), ("name", pa.string()), ("ids", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        order: list[int | None] = []

        def chunks():
            for doc_id, ids in encoded(batches, setup.value, int(end_id).to_bytes(width, "little"), id_bytes=width, text_only=True):
                order.append(doc_id)
                yield ids

        parts = chunks()
        if (head := next(parts, None)) is None:
            return
        shard, name = task.partitionId(), flat_name(task.partitionId(), task.taskAttemptId())
        size = publish(f"{folder}/{name}", (x for part in ((head,), parts) for x in part))
        yield pa.RecordBatch.from_pylist([{"shard": shard, "name": name, "ids": size // width}], schema=schema)
        for a in range(0, len(order), 10_000):
            some = order[a : a + 10_000]
            yield pa.RecordBatch.from_pydict({"shard": [shard] * len(some), "ordinal": list(range(a, a + len(some))), "doc_id": some, "name": [None] * len(some), "ids": [None] * len(some)}, schema=schema)

    rows = spread(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).sortWithinPartitions("doc_id", "text")
    # A row for the file, then a row for each of its documents.
    order = written(rows.mapInArrow(write, "shard long, ordinal long, doc_id long, name string, ids long"), "flat-order")
    files = sorted(tuple(r) for r in order.where("name is not null").select("shard", "name", "ids").collect())
    return folder, width, files, order.where("name is null").select("shard", "ordinal", "doc_id")


def scan_flat_files(spark: SparkSession, files: list[tuple[int, str]], width: int, end_id: int, *, block_ids: int = BLOCK_IDS) -> DataFrame:
    """shard, ordinal, start, n_tokens of every document in (shard, uri) files.

    start counts ids from the file's first; n_tokens leaves the end id out.  Ids
    after the last separator of a file form a last document.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_fs(row["uri"])
                n = -(-store.get_file_info(path).size // (width * block_ids))
                yield pa.RecordBatch.from_pylist([{"shard": row["shard"], "uri": row["uri"], "block": k} for k in range(n)], schema=pa.schema([("shard", pa.int64()), ("uri", pa.string()), ("block", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_fs(row["uri"])
                with store.open_input_file(path) as file:
                    size = file.size() // width
                    file.seek(row["block"] * block_ids * width)
                    ids = np.frombuffer(file.read(block_ids * width), dtype=f"<u{width}")
                base = row["block"] * block_ids
                ends = np.flatnonzero(ids == end_id) + base
                if base + len(ids) == size and len(ids) and ids[-1] != end_id:
                    ends = np.append(ends, size)
                # A block's first document waits for the separator before the block.
                starts = np.concatenate(([-1], ends[:-1] + 1)) if len(ends) else ends
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ends), row["shard"]), pa.int64()), pa.array(np.full(len(ends), row["block"]), pa.int64()), pa.array(np.arange(len(ends)), pa.int64()), pa.array(starts, pa.int64(), mask=starts < 0), pa.array(ends, pa.int64())],
                    names=["shard", "block", "place", "start", "end"],
                )

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = spark.createDataFrame(files, "shard long, uri string").repartition(max(1, min(len(files), partitions)))
    listed = listed.mapInArrow(blocks, "shard long, uri string, block long").repartition(partitions)
    found = written(listed.mapInArrow(scan, "shard long, block long, place long, start long, end long"), "separators")
    # Prefix scan over the blocks that have a separator: one row for each block.
    sums = found.groupBy("shard", "block").agg(F.count("*").alias("n"), F.max("end").alias("last"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"), F.coalesce(F.max("last").over(before) + 1, F.lit(0)).alias("carry"))
    start = F.coalesce("start", "carry")
    return found.join(carried, ["shard", "block"]).select("shard", (F.col("earlier") + F.col("place")).alias("ordinal"), start.alias("start"), (F.col("end") - start).alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer_path: str, end_id: int, *, block_ids: int = BLOCK_IDS) -> DataFrame:
    """doc_id, shard, start, n_tokens of every row of ``docs`` (doc_id, text), counted in flat files.

    There is a flat file, a shard, for each partition of the table; the corpus is
    the files in order.  start is the document's place in the corpus, separators
    included, and n_tokens leaves the separator out.  Null and empty texts have 0
    tokens.  Rows that share a doc_id each have a row, and so have rows without
    one.  Other columns are not read; an empty table gives an empty result.  The
    driver sees a row for each file.
    """
    spark = docs.sparkSession
    folder, width, files, order = write_flat_files(docs, tokenizer_path, end_id)
    found = scan_flat_files(spark, [(s, f"{folder}/{name}") for s, name, _ in files], width, end_id, block_ids=block_ids)
    bases, total = [], 0
    for shard, _, ids in files:
        bases.append((shard, total))
        total += ids
    base = broadcast_up_to(spark.createDataFrame(bases, "shard long, base long"), BROADCAST_ROWS)
    rows = order.join(found, ["shard", "ordinal"]).join(base, "shard")
    return rows.select("doc_id", "shard", (F.col("base") + F.col("start")).alias("start"), "n_tokens")
