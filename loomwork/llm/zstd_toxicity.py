"""Toxicity by how much shorter a toxic dictionary makes a text's windows.

Two zstandard dictionaries are trained, one on windows of ordinary text, one on
toxic text.  Of the toxic text only pieces are taken that it has far more often than
ordinary text, by the documents that hold each run of six bytes: other pieces would
fill the dictionary's room with what both have.  A
window is compressed behind the ordinary dictionary alone, and behind both with the
toxic one in front: matches in the ordinary one cost the same in both, so the
lengths differ where toxic text says more.  The thresholds of a window's saving and
the weights of what a document saves are calibrated on labelled documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, logistic, sample
from .shared_folder import spread
from .textbytes import flat_bytes, in_pieces

#: The classifier is fitted on at most so many labelled documents of each class, and on so many windows of each.
SAMPLE_PER_CLASS, SAMPLE_WINDOWS = 2_500, 64
THRESHOLD = 0.5
#: Bytes of a window, and of the two dictionaries.
WINDOW, ORDINARY_BYTES, TOXIC_BYTES = 96, 16_384, 1_024
#: Bytes of a gram, as long as those that the dictionary's training counts; a gram of the toxic dictionary has so much
#: evidence (log-likelihood ratio), and one of these shares of the strongest gram's, whichever separates the sample best.
GRAM, EVIDENCE, SHARES = 6, 15.0, (0.05, 0.1, 0.2)
PIECE_BYTES = 1_000_000


def windows(text: bytes, width: int = WINDOW) -> list[bytes]:
    """The text in windows of up to ``width`` bytes, cut before a blank where one is there, in small letters; one, if it is empty."""
    text, out, at = text.lower(), [], 0
    while len(text) - at > width:
        end = text.rfind(b" ", at + 1, at + width)
        end = end if end > at else at + width
        out.append(text[at:end])
        at = end
    out.append(text[at:])
    return out


def _grams(text: bytes) -> np.ndarray:
    """The runs of GRAM bytes of a text as numbers, one for each place."""
    data = np.frombuffer(text, dtype=np.uint8).astype(np.uint64)
    n = max(0, len(data) - GRAM + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        out = (out << np.uint64(8)) | data[k : k + n]
    return out


def _evidence(toxic: np.ndarray, ordinary: np.ndarray, n_toxic: int, n_ordinary: int) -> np.ndarray:
    """Log-likelihood ratios of what so many documents of either kind hold; 0 where toxic ones hold it less often."""
    expected = (toxic + ordinary) * n_toxic / (n_toxic + n_ordinary)
    other = toxic + ordinary - expected
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (toxic * np.log(toxic / expected) + np.where(ordinary > 0, ordinary * np.log(ordinary / other), 0.0))
    return np.where(toxic > expected, ratio, 0.0)


def _telling(toxic: list[bytes], ordinary: list[bytes], share: float) -> list[bytes]:
    """Of each toxic text the pieces whose grams are evidence, joined by blanks."""
    held = [np.unique(_grams(t)) for t in toxic]
    grams, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    grams, n = grams[n > 1], n[n > 1]
    if not len(grams):
        return []
    others = np.zeros(len(grams), dtype=np.int64)
    for t in ordinary:
        own = np.unique(_grams(t))
        at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        others[at[grams[at] == own]] += 1
    evidence = _evidence(n, others, len(toxic), len(ordinary))
    telling = grams[evidence >= max(EVIDENCE, share * evidence.max())]
    out = []
    for t in toxic:
        edges = np.zeros(len(t) + 1, dtype=np.int64)
        at = np.flatnonzero(np.isin(_grams(t), telling))
        np.add.at(edges, at, 1)
        np.add.at(edges, at + GRAM, -1)
        covered = np.concatenate(([0], (np.cumsum(edges[:-1]) > 0).astype(np.int8), [0]))
        step = np.diff(covered)
        pieces = [t[i:j].strip() for i, j in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True)]
        if pieces:
            out.append(b" " + b" ".join(pieces) + b" ")
    return out


def _trained(texts: list[bytes], size: int, **options) -> bytes:
    """A dictionary trained on texts; where they are too few or too short to train on, their own last bytes."""
    try:
        return zstandard.train_dictionary(size, texts, **options).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-size:] or b" "


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    #: Savings from which a window counts, and the weights of a document's features.
    thresholds: tuple[int, ...] = (2, 3)
    weights: tuple[float, ...] = ()

    def savings(self, parts: list[bytes]) -> np.ndarray:
        """Bytes that the toxic dictionary saves of each window."""
        alone, both = _compressors(self.ordinary, self.toxic)
        return np.fromiter((len(alone.compress(w)) - len(both.compress(w)) for w in parts), dtype=np.int64, count=len(parts))

    def features(self, column: pa.Array) -> np.ndarray:
        """Of every text: the largest saving, the windows at each threshold, their shares, and the mean saving."""
        data, ends = flat_bytes(column)
        raw, out = data.tobytes(), []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            s = self.savings(windows(raw[a:b]))
            at = [int((s >= t).sum()) for t in self.thresholds]
            out.append([min(int(s.max()), 10), *[math.log1p(n) for n in at], *[min(100 * n / len(s), 20) for n in at], min(max(10 * s.mean(), -5), 20), 1.0])
        return np.array(out, dtype=np.float64).reshape(len(out), 3 + 2 * len(self.thresholds))

    def scores(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(column) @ np.array(self.weights), -30, 30)))


@lru_cache(maxsize=4)
def _compressors(ordinary: bytes, toxic: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    # Tables that hold every place of both dictionaries; frames without what would only add bytes.
    log = max(10, (len(ordinary) + len(toxic)).bit_length())
    how = zstandard.ZstdCompressionParameters(
        window_log=max(16, log + 1), hash_log=log, chain_log=log, search_log=5, min_match=4, target_length=32, strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    contents = (ordinary, toxic + ordinary)
    return tuple(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(c, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=how) for c in contents)


def fit_dictionaries(texts: list[list[bytes]], toxic: list[int], share: float = SHARES[0]) -> ToxicityModel:
    """Dictionaries from the windows of labelled documents; the model has no weights yet."""
    of = [[parts for parts, label in zip(texts, toxic, strict=True) if label == k] for k in (0, 1)]
    said = _telling([b"".join(parts) for parts in of[1]], [b"".join(parts) for parts in of[0]], share)
    ordinary = [part for parts in of[0] for part in parts if part]
    return ToxicityModel(_trained(ordinary, ORDINARY_BYTES, level=3), _trained(said, TOXIC_BYTES, k=16, d=GRAM, level=3))


def learn(docs: DataFrame, labels: DataFrame, *, per_class: int = SAMPLE_PER_CLASS, most_windows: int = SAMPLE_WINDOWS) -> ToxicityModel | None:
    """A model from labelled rows outside the held-out part; None if a class has none there.

    Dictionaries come from at most ``per_class`` documents of each class and
    ``most_windows`` windows of each, spread over its length; of rows with the same
    text one counts.  Weights come from the whole texts of these documents, whose
    features alone reach the driver.
    """
    found = sample(docs, labels, "toxic", per_class)
    if found is None:
        return None
    chosen, share = found
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in in_pieces(batch, PIECE_BYTES):
                parts = []
                for text in piece.column("text").to_pylist():
                    every = windows((text or "").encode("utf-8", "surrogatepass"))
                    parts.append([every[i] for i in np.unique(np.linspace(0, len(every) - 1, most_windows).astype(np.int64))])
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("toxic"), pa.array(parts, pa.list_(pa.binary()))], names=["doc_id", "toxic", "parts"])

    rows = texts.mapInArrow(some, "doc_id long, toxic int, parts array<binary>").dropDuplicates(["doc_id"]).dropDuplicates(["parts"]).orderBy("doc_id").collect()
    if len({r.toxic for r in rows}) < 2:
        return None
    parts, toxic = [[bytes(p) for p in r.parts] for r in rows], [r.toxic for r in rows]
    models = [fit_dictionaries(parts, toxic, s) for s in SHARES]
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in in_pieces(batch, PIECE_BYTES):
                x = np.concatenate([m.features(piece.column("text")) for m in shared.value], axis=1)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("toxic"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "toxic", "x"])

    seen = texts.mapInArrow(measured, "doc_id long, toxic int, x array<double>").orderBy("doc_id", "x").collect()
    x, y = np.array([r.x for r in seen]), np.array([r.toxic for r in seen])
    counts = np.bincount(y, minlength=2)
    weights = np.where(y == 1, share / max(counts[1], 1), (1 - share) / max(counts[0], 1)) * len(y)
    best: tuple[float, ToxicityModel | None] = (math.inf, None)
    for model, own in zip(models, np.split(x, len(models), axis=1), strict=True):
        beta = logistic(own, y, weights, ridge=0.1)
        loss = float((weights * np.logaddexp(0, np.where(y == 1, -1, 1) * (own @ beta))).sum())
        if loss < best[0]:
            best = loss, ToxicityModel(model.ordinary, model.toxic, model.thresholds, tuple(beta))
    return best[1]


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text).

    Null texts count as empty: one empty window, scored as such.  A null doc_id is
    not held out.  Labels that contradict each other, repeat or lack a document are
    left out.  If a class has no labelled row, all scores are 0.5.  Rows that share
    a doc_id are scored each; an empty table gives an empty result.  Labels and other
    columns never enter a score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for piece in in_pieces(batch, PIECE_BYTES):
                score = model.scores(piece.column("text")) if model else np.full(piece.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32), pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    rows = spread(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id").cast("long")), F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
