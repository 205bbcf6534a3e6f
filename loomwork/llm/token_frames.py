"""Token ids in seekable zstandard files.

A file holds one zstandard frame for each document, in document order; then a
skippable frame with the documents' ids; then the seek table of the public
zstandard seekable format: compressed size, size and checksum of every frame
(the low 32 bits of XXH64 over the frame's content), and the footer.  Any
zstandard decoder reads the file as one stream.  A reader that wants some
documents reads both tables at the end and then only those documents' bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .library_encoder import encoder_of
from .shared_folder import open_fs, publish, shared_path
from .textbytes import in_pieces

# Fixed values of the zstandard seekable format.
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
#: Skippable frame of this format: "ids", bytes of an id, then for each document a flag and its doc_id.
INDEX_MAGIC = 0x184D2A51

END_ID = 2
LEVEL = 1
READ_BYTES = 8 << 20


class CorruptFrame(ValueError):
    """A frame's content does not have the checksum in the seek table."""


def file_chunks(documents: Iterable[tuple[int | None, bytes]], id_bytes: int, level: int = LEVEL) -> Iterator[bytes]:
    """The bytes of a file of (doc_id, ids) documents."""
    compressor = zstandard.ZstdCompressor(level=level, write_checksum=False)
    table, index = bytearray(), bytearray()
    n = 0
    for doc_id, ids in documents:
        frame = compressor.compress(ids)
        table += struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF)
        index += struct.pack("<Bq", doc_id is not None, doc_id or 0)
        n += 1
        yield frame
    yield struct.pack("<IIB", INDEX_MAGIC, 1 + len(index), id_bytes) + index
    yield struct.pack("<II", SEEK_TABLE_MAGIC, len(table) + 9) + table + struct.pack("<IBI", n, CHECKSUM_FLAG, SEEKABLE_MAGIC)


class FrameFile:
    """Random access to one file."""

    def __init__(self, uri: str):
        store, path = open_fs(uri)
        self._file = store.open_input_file(path)
        end = self._file.size()
        self._file.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", self._file.read(9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise CorruptFrame(f"{uri} has no seek table")
        self._file.seek(end - 9 - 12 * n)
        table = np.frombuffer(self._file.read(12 * n), dtype="<u4").reshape(n, 3)
        self.compressed, self.sizes, self.checksums = table[:, 0].astype(np.int64), table[:, 1].astype(np.int64), table[:, 2]
        self.offsets = np.concatenate(([0], np.cumsum(self.compressed)))
        self._file.seek(int(self.offsets[-1]))
        _, size, self.id_bytes = struct.unpack("<IIB", self._file.read(9))
        index = np.frombuffer(self._file.read(size - 1), dtype=[("known", "u1"), ("doc_id", "<i8")])
        self.doc_ids = [int(x["doc_id"]) if x["known"] else None for x in index]
        self._decompressor = zstandard.ZstdDecompressor()

    def _content(self, k: int, frame: bytes) -> np.ndarray:
        data = self._decompressor.decompress(frame, max_output_size=int(self.sizes[k])) if self.sizes[k] else b""
        if len(data) != self.sizes[k] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checksums[k]:
            raise CorruptFrame(f"frame {k}")
        return np.frombuffer(data, dtype=f"<u{self.id_bytes}")

    def fetch(self, k: int) -> np.ndarray:
        """Ids of the k-th document; reads its bytes only."""
        self._file.seek(int(self.offsets[k]))
        return self._content(k, self._file.read(int(self.compressed[k])))

    def __iter__(self) -> Iterator[np.ndarray]:
        """Ids of all documents, reading ahead in blocks."""
        n, k = len(self.sizes), 0
        while k < n:
            last = max(int(np.searchsorted(self.offsets, self.offsets[k] + READ_BYTES, side="right")) - 1, k + 1)
            self._file.seek(int(self.offsets[k]))
            block = self._file.read(int(self.offsets[last] - self.offsets[k]))
            for j in range(k, last):
                a = int(self.offsets[j] - self.offsets[k])
                yield self._content(j, block[a : a + int(self.compressed[j])])
            k = last

    def close(self) -> None:
        self._file.close()


def in_id_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text) range-partitioned and sorted by doc_id, null first.

    Rows that share a doc_id, or have none, go by the hash of their texts: so they
    fill as many ranges as their number asks for.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    order = ("doc_id", "tie", "text")
    return docs.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order[:2]).sortWithinPartitions(*order).select("doc_id", "text")


def encoded(batches: Iterator[pa.RecordBatch], tokenizer_json: str, end: bytes, **options) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids with the end id) of every row."""
    encoder = encoder_of(tokenizer_json, **options)
    for batch in batches:
        for piece in in_pieces(batch):
            texts = [x or "" for x in piece.column("text").to_pylist()]
            for doc_id, ids in zip(piece.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                yield doc_id, ids + end


def write_token_files(docs: DataFrame, tokenizer_path: str, *, folder: str | None = None, end_id: int = END_ID) -> tuple[str, list]:
    """Write one file for each range of doc_ids; the folder and a (shard, name, n_docs, n_tokens) row for each file."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "token-frames")
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    setup = spark.sparkContext.broadcast(text)
    id_bytes = id_width(text)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        n = [0, 0]

        def counted():
            for doc_id, ids in encoded(batches, setup.value, int(end_id).to_bytes(id_bytes, "little"), id_bytes=id_bytes):
                n[0] += 1
                n[1] += len(ids) // id_bytes
                yield doc_id, ids

        documents = counted()
        if (head := next(documents, None)) is None:
            return
        name = shard_name(task.partitionId(), task.taskAttemptId())
        publish(f"{folder}/{name}", file_chunks((x for part in ((head,), documents) for x in part), id_bytes))
        yield pa.RecordBatch.from_pydict({"shard": [task.partitionId()], "name": [name], "n_docs": n[:1], "n_tokens": n[1:]}, schema=pa.schema([("shard", pa.int64()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    shards = in_id_order(docs).mapInArrow(write, "shard long, name string, n_docs long, n_tokens long")
    return folder, sorted(shards.collect())


def id_width(tokenizer_json: str) -> int:
    """Bytes that hold every id of a tokenizer."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_str(tokenizer_json).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def shard_name(shard: int, attempt: int) -> str:
    return f"shard-{shard:06d}-{attempt}.zst"


def read_token_files(spark, folder: str, shards: list) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    starts, total = [], 0
    for _, name, _, n_tokens in shards:
        starts.append((name, total))
        total += n_tokens

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = FrameFile(f"{folder}/{row['name']}")
                start, out = row["start"], ([], [], [], [])
                for doc_id, ids in zip(file.doc_ids, file, strict=True):
                    for column, x in zip(out, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True):
                        column.append(x)
                    start += len(ids)
                file.close()
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = spark.createDataFrame(starts, "name string, start long").repartition(max(1, len(starts)))
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, *, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the token files of ``docs`` (doc_id, text) and describe every document as read back.

    A null or empty text is the end id alone.  Rows that share a doc_id each get
    a frame, in the order of their texts' hashes.  Rows without a doc_id come first.  Other columns are not read; an
    empty table gives no file and no row.  The driver sees a row for each file.
    """
    folder, shards = write_token_files(docs, tokenizer_path, folder=folder, end_id=end_id)
    return read_token_files(docs.sparkSession, folder, shards)
