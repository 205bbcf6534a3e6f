"""Document quality from a linear-chain CRF over lines.

Every line is a token with the labels bad and good.  Its features are shares and
lengths counted in the line and in the lines before and after it.  The marginals
of ``good``, weighted by the lines' lengths, are the document's share of good
text; a logistic curve in that share, fitted on the same sample, is the score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .crf import Chains, forward_backward, train
from .labelled import FOLDS, held_out, sample
from .shared_folder import neutral, spread
from .textbytes import flat_bytes, in_pieces, word_bounds, word_hashes

#: The classifier is fitted on at most so many labelled documents of each class.
SAMPLE_PER_CLASS = 800
THRESHOLD = 0.3
#: Lines of a document that the fit looks at, spread over its length; scores look at all.
SAMPLE_LINES = 2_000
#: Texts that are taken apart at once: a line has some 700 bytes of features, however short it is.
PIECE_BYTES = 500_000

_KINDS = np.zeros(256, dtype=np.uint8)
for _kind, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"()-", b"!?", b"|", b"#$%&*@^~_=+<>{}[]\\/`", b" \t\r\x0b\x0c"), start=1):
    _KINDS[list(_bytes)] = _kind
_KINDS[128:192] = 9
_KINDS[192:] = 10
N_KINDS = 11
#: Lower, upper, digit, stop, mark, bar, symbol and non-Latin shares; repeated
#: neighbours; repeated words; word length; log length; no words; first; last; constant.
N_LINE = 16


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines (with those of neighbours), lengths, and the n+1 line offsets of the texts.

    A line ends at a newline or at the end of the text, so every text has a line.
    """
    data, offsets = flat_bytes(column)
    breaks = np.flatnonzero(data == 10)
    # A line starts where its text does or after a newline; it ends at the next one.
    text_of = np.searchsorted(offsets, breaks, side="right") - 1
    starts = np.concatenate((offsets[:-1], breaks + 1))
    ends = np.concatenate((breaks, offsets[1:]))
    owner = np.concatenate((np.arange(len(offsets) - 1), text_of))
    starts = starts[np.lexsort((starts, owner))]
    ends = ends[np.lexsort((ends, np.concatenate((text_of, np.arange(len(offsets) - 1)))))]
    counts = 1 + np.bincount(text_of, minlength=len(offsets) - 1)
    lines = np.concatenate(([0], np.cumsum(counts)))
    length = ends - starts
    n = len(starts)

    kind = _KINDS[data]
    sums = np.zeros((len(data) + 1,), dtype=np.int64)
    shares = np.empty((n, N_KINDS))
    for k in range(N_KINDS):
        np.cumsum(kind == k, out=sums[1:])
        shares[:, k] = sums[ends] - sums[starts]
    # Continuation bytes belong to the letter before them.
    letters = shares[:, 1] + shares[:, 2] + shares[:, 10]
    visible = np.maximum(length - shares[:, 8] - shares[:, 9], 1)

    w_start, w_end, _ = word_bounds(data, np.unique(np.concatenate((offsets, starts))))
    words = word_hashes(data, w_start, w_end)
    w_line = np.searchsorted(starts, w_start, side="right") - 1
    # Empty lines share their start with the next text's first line; a word is in the line that reaches past it.
    n_words = np.bincount(w_line, minlength=n)
    same = np.zeros(len(words), dtype=bool)
    same[1:] = (words[1:] == words[:-1]) & (w_line[1:] == w_line[:-1])
    in_order = np.lexsort((words, w_line))
    again = np.zeros(len(words), dtype=bool)
    again[1:] = (words[in_order][1:] == words[in_order][:-1]) & (w_line[in_order][1:] == w_line[in_order][:-1])
    repeated = np.bincount(w_line[in_order][again], minlength=n)

    x = np.zeros((n, N_LINE))
    x[:, 0] = shares[:, 1] / visible
    x[:, 1] = shares[:, 2] / np.maximum(letters, 1)
    for column_no, k in ((2, 3), (3, 4), (4, 5), (5, 6), (6, 7), (7, 10)):
        x[:, column_no] = shares[:, k] / visible
    x[:, 8] = np.bincount(w_line[same], minlength=n) / np.maximum(n_words, 1)
    x[:, 9] = repeated / np.maximum(n_words, 1)
    x[:, 10] = visible / np.maximum(n_words, 1) / 10
    x[:, 11] = np.log1p(length) / 5
    x[:, 12] = n_words == 0
    x[lines[:-1], 13] = 1
    x[lines[1:] - 1, 14] = 1
    x[:, 15] = 1
    x[:, [2, 4, 5, 6]] = np.minimum(x[:, [2, 4, 5, 6]] * 4, 2)
    before, after = np.zeros((n, 12)), np.zeros((n, 12))
    before[1:], after[:-1] = x[:-1, :12], x[1:, :12]
    before[lines[:-1]], after[lines[1:] - 1] = 0, 0
    return np.concatenate((x, before, after), axis=1), length, lines


@dataclass
class QualityModel:
    weights: np.ndarray
    transitions: np.ndarray
    slope: float
    offset: float

    def good_shares(self, features: np.ndarray, length: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the lines' marginals of good; empty lines count as one byte."""
        marginals, _, _ = forward_backward(features @ self.weights, self.transitions, Chains(lines))
        weight = np.maximum(length, 1)
        return np.add.reduceat(marginals[:, 1] * weight, lines[:-1]) / np.add.reduceat(weight, lines[:-1])

    def scores(self, column: pa.Array) -> np.ndarray:
        share = self.good_shares(*line_features(column)) if len(column) else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.slope * share + self.offset, -30, 30)))


def fit(features: np.ndarray, length: np.ndarray, lines: np.ndarray, good: np.ndarray, prior: float) -> QualityModel:
    """A model from documents' lines and labels; each class counts by its part of all labelled rows."""
    counts = np.bincount(good, minlength=2)
    share = np.where(good == 1, prior / max(counts[1], 1), (1 - prior) / max(counts[0], 1)) * len(good)
    even = np.where(good == 1, 0.5 / max(counts[1], 1), 0.5 / max(counts[0], 1)) * len(good)
    labels = np.repeat(good, np.diff(lines))
    w, a = train(features, labels, lines, 2, weights=even / np.sqrt(np.diff(lines)))
    model = QualityModel(w, a, 0.0, 0.0)
    x = model.good_shares(features, length, lines)
    # Logistic regression in one variable by Newton's steps.
    design, beta = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (share * (good - p)) - 1e-2 * beta
        curve = (design * (share * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta + np.linalg.solve(curve, slope)
    return QualityModel(w, a, float(beta[0]), float(beta[1]))


def _spread(lines: int) -> np.ndarray:
    """Places of at most SAMPLE_LINES of so many lines: all, or stretches of 100 at even distances."""
    if lines <= SAMPLE_LINES:
        return np.arange(lines)
    starts = np.linspace(0, lines - 100, SAMPLE_LINES // 100).astype(np.int64)
    return np.unique((starts[:, None] + np.arange(100)).ravel())


def learn(docs: DataFrame, labels: DataFrame, *, per_class: int = SAMPLE_PER_CLASS) -> QualityModel | None:
    """A model from the labelled rows outside the held-out part; None if a class has no row there.

    The sample is the rows of smallest hash in each class, at most ``per_class``
    of each, whatever the size of the tables; of a document of more than
    SAMPLE_LINES lines stretches of 100 lines are used, spread over its length, so that what reaches the driver is bounded.
    """
    found = sample(docs, labels, "quality", per_class)
    if found is None:
        return None
    chosen, share = found

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in in_pieces(batch, PIECE_BYTES):
                x, length, lines = line_features(piece.column("text"))
                x = x.astype(np.float32)
                some = [a + _spread(b - a) for a, b in zip(lines.tolist(), lines[1:].tolist(), strict=False)]
                data = [x[at].tobytes() for at in some]
                sizes = [length[at].astype("<i8").tobytes() for at in some]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("quality"), pa.array(data, pa.binary()), pa.array(sizes, pa.binary())], names=["doc_id", "quality", "x", "length"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    found = texts.select("doc_id", "quality", "text").mapInArrow(features, "doc_id long, quality int, x binary, length binary").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    if len({r.quality for r in found}) < 2:
        return None
    lengths = [np.frombuffer(r.length, "<i8") for r in found]
    x = np.concatenate([np.frombuffer(r.x, np.float32).reshape(len(n), -1) for r, n in zip(found, lengths, strict=True)]).astype(np.float64)
    lines = np.concatenate(([0], np.cumsum([len(n) for n in lengths])))
    return fit(x, np.concatenate(lengths), lines, np.array([r.quality for r in found]), share)


def _scored(batches: Iterator[pa.RecordBatch], model: QualityModel | None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for piece in in_pieces(batch, PIECE_BYTES):
            yield piece, model.scores(piece.column("text")) if model else np.full(piece.num_rows, 0.5)


def quality_scores(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text).

    Null texts count as empty: one line without words, scored as such.  A null
    doc_id is not held out.  Labels that contradict each other, repeat or lack a
    document are left out.  If a class has no labelled row, all scores are 0.5.
    Labels and other columns never enter a score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, per_class=per_class))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, score in _scored(batches, shared.value):
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32), pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    rows = spread(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with their own columns.

    Null and empty texts are one line without words and are judged as such; rows
    that share a doc_id, or have none, are judged row by row.  If a class has no
    labelled row, all scores are 0.5 and every row stays.  An empty table stays empty.
    """
    rows = neutral(docs, "doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(learn(rows, labels, per_class=per_class))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, score in _scored(batches, shared.value):
            yield piece.filter(pa.array(score >= threshold))

    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)


def crc_fold(doc_id: int) -> int:
    """The fold of a doc_id, as the query computes it."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS
