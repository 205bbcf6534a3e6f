"""GIF files: LZW code streams, palettes, disposal, transparency, timed frames.

Decoding is array operations on a segment of codes between two clear codes: the
width of a code follows from its place in the segment alone, and its string is a
copy of what stands earlier in the segment's output, so no code table is kept.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared_folder import spread
from .textbytes import in_pieces

# Fixed values of the format.
MOST_CODES = 4096
KEEP, BACKGROUND, PREVIOUS = 1, 2, 3

#: Payloads are 192 samples wide, 64 rows a frame, and every frame lasts 4/100 s.
WIDTH, ROWS, DELAY = 192, 64, 4

#: Red is the sample itself, so that colours lead back to it; green and blue spread it.
PALETTE = np.stack([np.arange(256), np.arange(256) * 5 % 256, np.arange(256) * 11 % 256], axis=1).astype(np.uint8)


#: Samples of a frame, and pixels of the part of the screen that a file draws on, at most: a few bytes can ask for billions.
MOST_PIXELS = 1 << 26


class GifError(ValueError):
    """Bytes that are no whole GIF, or one that asks for more than MOST_PIXELS."""


def _widths(least: int, n: int) -> np.ndarray:
    """Bits of the first n codes after a clear code; the table gets its next entry with every code but the first."""
    free = (1 << least) + 2 + np.maximum(np.arange(n) - 1, 0)
    return np.clip(np.ceil(np.log2(free + 1)).astype(np.int64), least + 1, 12)


_SIZES = {least: _widths(least, MOST_CODES + 2) for least in range(2, 9)}
_STARTS = {least: np.concatenate(([0], np.cumsum(_SIZES[least]))) for least in range(2, 9)}
_FULL_SIZES = np.full(MOST_CODES, 12)
_FULL_STARTS = np.arange(MOST_CODES + 1) * 12


def _strings(codes: np.ndarray, least: int) -> bytes:
    """Samples of the codes of one segment.

    The entry that a code i > 0 made says: the string of code i - 1 and the first
    sample of code i.  So the string of a code that names entry j is what the
    output holds from the start of code j on, one sample longer than code j's
    string.  Lengths, and then the place each sample is copied from, follow by
    pointer doubling, in steps that grow with the logarithm of the longest string.
    """
    clear, n = 1 << least, len(codes)
    place = np.arange(n)
    literal = codes < clear
    named = codes - (clear + 2)
    if (~literal & (named >= np.minimum(place, MOST_CODES - clear - 2))).any():
        raise GifError("a code that the table does not have")
    parent = np.where(literal, place, named)
    hops = (~literal).astype(np.int64)
    while not literal[parent].all():
        hops += hops[parent]
        parent = parent[parent]
    lengths = hops + 1
    starts = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    source = np.arange(total) + np.repeat(np.where(literal, 0, starts[np.maximum(named, 0)] - starts), lengths)
    while True:
        further = source[source]
        if (further == source).all():
            break
        source = further
    samples = np.zeros(total, dtype=np.uint8)
    samples[starts[literal]] = codes[literal]
    return samples[source].tobytes()


def lzw_decode(data: bytes, least: int, pixels: int) -> bytes:
    """Samples of a code stream with ``least`` bits a sample; stops at the end code or after ``pixels`` samples."""
    clear, end = 1 << least, (1 << least) + 1
    stream = np.frombuffer(data + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
    windows = stream[:-2] | stream[1:-1] << np.uint32(8) | stream[2:] << np.uint32(16)
    bits, at, made = len(data) * 8, 0, 0
    out: list[bytes] = []
    segment: list[np.ndarray] = []

    def close() -> int:
        if not segment:
            return 0
        out.append(_strings(np.concatenate(segment), least))
        segment.clear()
        return len(out[-1])

    while made < pixels:
        # As many codes as there may be up to the next clear code; 12 bits each once the table is full.
        starts, sizes = (_STARTS[least], _SIZES[least]) if not segment else (_FULL_STARTS, _FULL_SIZES)
        fits = int(np.searchsorted(starts[1:], bits - at, side="right"))
        places, sizes = at + starts[:fits], sizes[:fits]
        codes = (windows[places >> 3].astype(np.int64) >> (places & 7)) & ((1 << sizes) - 1)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        n = int(stops[0]) if len(stops) else fits
        if n:
            segment.append(codes[:n])
        if not len(stops):
            if fits < MOST_CODES:
                break
            at = int(places[-1] + sizes[-1])
            continue
        at = int(places[n] + sizes[n])
        made += close()
        if codes[n] == end:
            break
    close()
    return b"".join(out)[:pixels]


def lzw_encode(samples: bytes, least: int = 8) -> bytes:
    """A code stream with a clear code at its start and whenever the table is full."""
    clear = 1 << least
    # Codes of the table are kept as the upper bits of a key, whose lower byte is the next sample.
    first, full = clear + 2 << 8, MOST_CODES << 8
    codes: list[int] = [clear << 8]
    ends = []
    if not samples:
        codes.append(clear + 1 << 8)
    else:
        table: dict[int, int] = {}
        emit = codes.append
        prefix, free = samples[0] << 8, first
        for sample in samples[1:]:
            key = prefix | sample
            if key in table:
                prefix = table[key]
                continue
            emit(prefix)
            prefix = sample << 8
            table[key] = free
            free += 256
            if free == full:
                emit(clear << 8)
                ends.append(len(codes))
                table.clear()
                free = first
        emit(prefix)
        emit(clear + 1 << 8)
    values = np.fromiter(codes, dtype=np.int64, count=len(codes)) >> 8
    segments = np.diff([1, *ends, len(codes)])
    sizes = np.concatenate([[least + 1], *(_SIZES[least][:n] for n in segments)])
    # A code lies in three bytes at most; codes share no bit, so sums put them together.
    at = np.cumsum(sizes) - sizes
    n_bytes = int(at[-1] + sizes[-1] + 7) >> 3
    values <<= at & 7
    at >>= 3
    out = np.zeros(n_bytes + 2)
    for k in range(3):
        out[k : k + n_bytes] += np.bincount(at, weights=values >> 8 * k & 255, minlength=n_bytes)
    return out[:n_bytes].astype(np.uint8).tobytes()


@dataclass
class Frame:
    left: int
    top: int
    indices: np.ndarray
    palette: np.ndarray
    transparent: int | None
    disposal: int
    delay: int

    def colours(self) -> np.ndarray:
        """Palette applied: rows x columns x RGB."""
        return self.palette[self.indices]


@dataclass
class Gif:
    width: int
    height: int
    frames: list[Frame]

    def bounds(self) -> tuple[int, int, int, int]:
        """Left, top, right and bottom of the part of the screen that any frame draws on."""
        boxes = [(f.left, f.top, min(f.left + f.indices.shape[1], self.width), min(f.top + f.indices.shape[0], self.height)) for f in self.frames]
        boxes = [b for b in boxes if b[0] < b[2] and b[1] < b[3]]
        if not boxes:
            return 0, 0, 0, 0
        lefts, tops, rights, bottoms = zip(*boxes, strict=True)
        return min(lefts), min(tops), max(rights), max(bottoms)

    def canvases(self) -> Iterator[np.ndarray]:
        """What is shown within bounds() at each frame: rows x columns x RGBA, alpha 0 where nothing was drawn.  The next step changes it."""
        left, top, right, bottom = self.bounds()
        if (right - left) * (bottom - top) > MOST_PIXELS:
            raise GifError("a canvas of too many pixels")
        canvas = np.zeros((bottom - top, right - left, 4), dtype=np.uint8)
        # A pixel as one number.
        pixels = canvas.view(np.uint32)[:, :, 0] if canvas.size else np.zeros(canvas.shape[:2], dtype=np.uint32)
        for frame in self.frames:
            rows, columns = frame.indices.shape
            y, x = max(frame.top - top, 0), max(frame.left - left, 0)
            inside = frame.left < self.width and frame.top < self.height
            part = pixels[y : y + rows * inside, x : x + columns * inside]
            indices = frame.indices[: part.shape[0], : part.shape[1]]
            saved = part.copy() if frame.disposal == PREVIOUS else None
            colours = np.full((len(frame.palette), 4), 255, dtype=np.uint8)
            colours[:, :3] = frame.palette
            drawn = colours.view(np.uint32)[:, 0][indices]
            np.copyto(part, drawn, where=True if frame.transparent is None else indices != frame.transparent)
            yield canvas
            if frame.disposal == BACKGROUND:
                part[:] = 0
            elif saved is not None:
                part[:] = saved


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    """Content of data sub-blocks and the place after their end."""
    out = []
    while True:
        if at >= len(data):
            raise GifError("sub-blocks without an end")
        n = data[at]
        if not n:
            return b"".join(out), at + 1
        out.append(data[at + 1 : at + 1 + n])
        at += n + 1


def decode_gif(data: bytes) -> Gif:
    try:
        return _decode(data)
    except (IndexError, struct.error) as e:
        raise GifError("the file ends early") from e


def _decode(data: bytes) -> Gif:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise GifError("no GIF signature")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    at = 13

    def colours(flags: int) -> np.ndarray:
        nonlocal at
        n = 2 << (flags & 7)
        table = np.zeros((256, 3), dtype=np.uint8)
        table[:n] = np.frombuffer(data[at : at + 3 * n], dtype=np.uint8).reshape(-1, 3)[:n] if len(data) >= at + 3 * n else _early()
        at += 3 * n
        return table

    shared = colours(flags) if flags & 0x80 else PALETTE
    frames: list[Frame] = []
    control = (0, 0, None)
    while data[at] != 0x3B:
        kind = data[at]
        if kind == 0x21:
            label = data[at + 1]
            content, at = _blocks(data, at + 2)
            if label == 0xF9 and len(content) >= 4:
                control = ((content[0] >> 2) & 7, struct.unpack_from("<H", content, 1)[0], content[3] if content[0] & 1 else None)
        elif kind == 0x2C:
            left, top, columns, rows, flags = struct.unpack_from("<HHHHB", data, at + 1)
            at += 10
            if columns * rows > MOST_PIXELS:
                raise GifError("a frame of too many samples")
            palette = colours(flags) if flags & 0x80 else shared
            least = data[at]
            if not 2 <= least <= 8:
                raise GifError("samples of an impossible size")
            content, at = _blocks(data, at + 1)
            samples = lzw_decode(content, least, columns * rows)
            if len(samples) < columns * rows:
                raise GifError("a frame without all its samples")
            indices = np.frombuffer(samples, dtype=np.uint8).reshape(rows, columns)
            if flags & 0x40:
                order = [r for first, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for r in range(first, rows, step)]
                straight = np.empty_like(indices)
                straight[order] = indices
                indices = straight
            disposal, delay, transparent = control
            frames.append(Frame(left, top, indices, palette, transparent, disposal, delay))
            control = (0, 0, None)
        else:
            raise GifError("an unknown block")
    return Gif(width, height, frames)


def _early():
    raise GifError("the file ends early")


def encode_gif(frames: list[Frame], width: int, height: int, palette: np.ndarray = PALETTE) -> bytes:
    """A GIF89a with one palette of 256 colours."""
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), palette.tobytes()]
    for f in frames:
        rows, columns = f.indices.shape
        out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, f.disposal << 2 | (f.transparent is not None), f.delay, f.transparent or 0, 0))
        out.append(struct.pack("<BHHHHBB", 0x2C, f.left, f.top, columns, rows, 0, 8))
        codes = lzw_encode(f.indices.tobytes())
        out += [bytes([len(b := codes[k : k + 255])]) + b for k in range(0, len(codes), 255)]
        out.append(b"\0")
    return b"".join([*out, b"\x3b"])


def histogram(canvas: np.ndarray) -> np.ndarray:
    """Drawn pixels in each of 64 colours: four levels of red, green and blue."""
    pixels = canvas.reshape(-1, 4)
    pixels = pixels[pixels[:, 3] > 0] if not pixels[:, 3].all() else pixels
    if not len(pixels):
        return np.zeros(64, dtype=np.int64)
    colours = np.ascontiguousarray(pixels).view("<u4")[:, 0]
    # The upper two bits of red, green and blue.
    return np.bincount(colours >> 2 & 48 | colours >> 12 & 12 | colours >> 22 & 3, minlength=64)


def payload_of(text: str) -> bytes:
    data = text.encode()
    return data + b" " * (-len(data) % WIDTH or WIDTH * (not data))


def _changes(frame: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, int | None]:
    """A frame with what is as before made transparent, and the colour that says so: the first that the frame has not; None if it has all."""
    free = np.flatnonzero(np.bincount(frame.ravel(), minlength=256) == 0)
    if not len(free):
        return frame, None
    return np.where(frame == before[: len(frame)], np.uint8(free[0]), frame), int(free[0])


def gif_of(payload: bytes, *, delta: bool = False) -> bytes:
    """A payload as frames of up to ROWS rows; each frame replaces the one before it.

    With delta a frame stays, and the next one draws only what changes.
    """
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, WIDTH)
    parts = [rows[k : k + ROWS] for k in range(0, len(rows), ROWS)]
    frames = [Frame(0, 0, part, PALETTE, None, KEEP if delta else BACKGROUND, DELAY) for part in parts]
    if delta:
        for frame, part, before in zip(frames[1:], parts[1:], parts, strict=False):
            frame.indices, frame.transparent = _changes(part, before)
    return encode_gif(frames, WIDTH, min(ROWS, len(rows)))


def described(data: bytes) -> tuple[bytes, str]:
    """Payload read back from a GIF, by the colours it shows, and its feature: frames, hundredths of a second, colours and their pixels."""
    gif = decode_gif(data)
    payload, total = [], np.zeros(64, dtype=np.int64)
    for frame, canvas in zip(gif.frames, gif.canvases(), strict=True):
        payload.append(canvas[: len(frame.indices), :, 0].tobytes())
        total += histogram(canvas)
    colours = " ".join(f"{k}={total[k]}" for k in np.flatnonzero(total))
    return b"".join(payload), f"{len(gif.frames)} frames, {sum(f.delay for f in gif.frames)} cs, {colours}"


MEDIA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def text_media(docs: DataFrame, *, with_media: bool = False, delta: bool = False) -> DataFrame:
    """Texts stored as GIFs and read back; with_media adds the GIF itself as media, delta stores changes between frames.

    A null text counts as empty, which is one row of 192 blanks.  Rows keep their
    doc_id, null or repeated; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in in_pieces(whole)):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            rows, size = [], 0
            for i, text in zip(ids, texts, strict=True):
                stored = gif_of(payload_of(text or ""), delta=delta)
                payload, feature = described(stored)
                row = (i, len((text or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature)
                rows.append((*row, stored) if with_media else row)
                size += len(stored)
                if size > 16_000_000:
                    yield as_batch(rows)
                    rows, size = [], 0
            if rows:
                yield as_batch(rows)

    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in MEDIA.split(", ")] + ["media"]

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=names[: len(columns)])

    docs = spread(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, MEDIA + ", media binary" * with_media)


def text_gifs(docs: DataFrame, *, delta: bool = False) -> DataFrame:
    """(doc_id, media): the GIFs of text_media(), which are not read back here; for those who read them anyway."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in in_pieces(whole)):
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            first, size, media = 0, 0, []
            for k, text in enumerate(texts):
                media.append(gif_of(payload_of(text or ""), delta=delta))
                size += len(media[-1])
                if size > 16_000_000 or k + 1 == len(texts):
                    yield pa.RecordBatch.from_arrays([ids[first : k + 1], pa.array(media, pa.binary())], names=["doc_id", "media"])
                    first, size, media = k + 1, 0, []

    docs = spread(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, media binary")


FRAMES = "doc_id long, frame int, start_ms long, duration_ms long, left int, top int, width int, height int, disposal int, transparent int, histogram array<long>, error string"


def timed_frames(media: DataFrame) -> DataFrame:
    """A row for each frame of the GIFs in ``media`` (doc_id, media): when it shows, where it draws, and the colours then on the canvas.

    A null or empty GIF gives no row, and neither does one without a frame.  Bytes
    that are no whole GIF, or ask for more than MOST_PIXELS, give one row with the
    reason in error and nothing else but the doc_id.  Rows keep their doc_id, null
    or repeated; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("frame", pa.int32()), ("start_ms", pa.int64()), ("duration_ms", pa.int64()), ("left", pa.int32()), ("top", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("disposal", pa.int32()), ("transparent", pa.int32()), ("histogram", pa.list_(pa.int64())), ("error", pa.string())])
        for batch in batches:
            for i, data in zip(batch.column("doc_id").to_pylist(), batch.column("media").to_pylist(), strict=True):
                if not data:
                    continue
                try:
                    gif, rows, start = decode_gif(data), [], 0
                    for k, (f, canvas) in enumerate(zip(gif.frames, gif.canvases(), strict=True)):
                        rows.append({"doc_id": i, "frame": k, "start_ms": start, "duration_ms": f.delay * 10, "left": f.left, "top": f.top, "width": f.indices.shape[1], "height": f.indices.shape[0], "disposal": f.disposal, "transparent": f.transparent, "histogram": histogram(canvas).tolist()})
                        start += f.delay * 10
                except GifError as e:
                    rows = [{"doc_id": i, "error": str(e)}]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return media.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("media").cast("binary").alias("media")).mapInArrow(run, FRAMES)
