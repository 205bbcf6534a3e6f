"""k-means with Elkan's bounds, in exact integer arithmetic.

Vectors become integers, centroids are floors of means, and nearness is the squared
Euclidean distance, ties to the smaller number: so the result does not depend on how
rows are dealt out.  A table keeps for each vector its centroid, an upper bound of
the distance to it and a lower bound of the distance to every centroid.  After a
round each bound is loosened by how far its centroid has moved.  A distance is
worked out only where the lower bound, and half the distance between the two
centroids, do not exceed the upper bound.

Bounds are roots, which are rounded: upper ones up and lower ones down, always away
from the truth.  A centroid is skipped only where it is farther for certain, so one
at the same distance is compared, and the smaller number wins.  Compared are
integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared_folder import discard, spread, written
from .textbytes import flat_bytes

DIMENSIONS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
#: Rows that one step of a task takes.
STEP = 4_096
#: Components up to here are held in 32 bits, and their squared distances in 64 (for up to 128 components).
SMALL = 1 << 27
_UP, _DOWN = np.inf, -np.inf
_INT64 = (1 << 63) - 1


def _doubles(x: np.ndarray) -> np.ndarray:
    """The nearest doubles of integers; infinity beyond all doubles."""
    if x.dtype != object:
        return x.astype(np.float64)
    return np.array([float(v) if v.bit_length() < 1024 else np.inf for v in x.tolist()])


def root_up(x: np.ndarray) -> np.ndarray:
    """A double that is not below the root of an integer."""
    return np.nextafter(np.sqrt(np.nextafter(_doubles(x), _UP)), _UP)


def root_down(x: np.ndarray) -> np.ndarray:
    """A double that is not above the root of an integer, nor below 0."""
    return np.maximum(np.nextafter(np.sqrt(np.maximum(np.nextafter(_doubles(x), _DOWN), 0)), _DOWN), 0)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of integer vectors (int64, or Python's integers) from one vector."""
    d = x - c
    return (d * d).sum(axis=1)


@dataclass(frozen=True)
class Centroids:
    """The vectors, half the distances between them, rounded down, and how far each has moved, rounded up and down."""

    vectors: np.ndarray
    halves: np.ndarray
    moved: np.ndarray

    @classmethod
    def of(cls, vectors: list[list[int]], before: list[list[int]] | None) -> Centroids:
        large = any(abs(v) > SMALL for row in [*vectors, *(before or [])] for v in row)
        x = np.array(vectors, dtype=object if large else np.int64)
        halves = np.stack([root_down(squared(x, row)) for row in x]) / 2
        moved = np.zeros(len(x)) if before is None else root_up(((x - np.array(before, dtype=x.dtype)) ** 2).sum(axis=1))
        if before is not None:
            moved[[a == b for a, b in zip(vectors, before, strict=True)]] = 0
        return cls(x, halves, moved)


class Assigned:
    """Vectors with their centroids and bounds."""

    def __init__(self, x: np.ndarray, nearest: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        self.x, self.nearest, self.upper, self.lower = x, nearest, upper, lower
        self.computed = 0

    @classmethod
    def unknown(cls, x: np.ndarray, k: int) -> Assigned:
        return cls(x, np.zeros(len(x), dtype=np.int32), np.full(len(x), np.inf), np.zeros((len(x), k)))

    def follow(self, moved: np.ndarray) -> None:
        """Loosen the bounds by how far the centroids have moved."""
        self.upper = np.where(moved[self.nearest] == 0, self.upper, np.nextafter(self.upper + moved[self.nearest], _UP))
        self.lower = np.where(moved == 0, self.lower, np.maximum(np.nextafter(self.lower - moved, _DOWN), 0))

    def assign(self, c: Centroids) -> None:
        """Every vector to its nearest centroid, smaller numbers first among equals."""
        k = len(c.vectors)
        others = c.halves + np.where(np.eye(k, dtype=bool), np.inf, 0)
        # Vectors whose other centroids are all farther for certain need no distance at all.
        rows = np.flatnonzero(others.min(axis=1)[self.nearest] <= self.upper) if k > 1 else np.zeros(0, dtype=np.int64)
        if not len(rows):
            return
        x, near, upper, lower = self.x[rows], self.nearest[rows].copy(), self.upper[rows], self.lower[rows]
        some = ((lower <= upper[:, None]) & (others[near] <= upper[:, None])).any(axis=1)
        rows, x, near, upper, lower = rows[some], x[some], near[some], upper[some], lower[some]
        # The upper bound becomes the distance itself.
        best = self._distances(x, c.vectors[near])
        upper = root_up(best)
        lower[np.arange(len(rows)), near] = root_down(best)
        for j in range(k):
            open_ = np.flatnonzero((near != j) & (lower[:, j] <= upper) & (others[near, j] <= upper))
            if not len(open_):
                continue
            d = self._distances(x[open_], c.vectors[j])
            lower[open_, j] = root_down(d)
            closer = (d < best[open_]) | ((d == best[open_]) & (j < near[open_]))
            at = open_[closer]
            near[at], best[at] = j, d[closer]
            upper[at] = root_up(best[at])
        self.nearest[rows], self.upper[rows], self.lower[rows] = near, upper, lower

    def _distances(self, x: np.ndarray, c: np.ndarray) -> np.ndarray:
        self.computed += len(x)
        return squared(x, c)


def _integers(column: pa.Array, d: int) -> np.ndarray:
    """Vectors from their stored form, as int64 or, where one is large, as Python's integers."""
    data, ends = flat_bytes(column)
    if (np.diff(ends) == 4 * d).all():
        return data.view("<i4").reshape(-1, d).astype(np.int64)
    return np.array([np.frombuffer(r, "<i4").tolist() if len(r) == 4 * d else [int(v) for v in r.split(b",")] for r in column.to_pylist()], dtype=object)


def _stored(x: np.ndarray) -> list[bytes]:
    """floor(SCALE * component) of rows of doubles: 4 bytes a component, or decimal numbers of another length in all where one is large."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * SCALE)
    small = (np.abs(scaled) <= SMALL).all(axis=1)
    packed = np.where(small[:, None], scaled, 0).astype("<i4")
    out = [row.tobytes() for row in packed]
    for i in np.flatnonzero(~small).tolist():
        # SCALE is a power of two: the product is exact unless it is too large for a double.
        text = b",".join(b"%d" % (int(s) if np.isfinite(s) else int(v) * SCALE) for s, v in zip(scaled[i].tolist(), x[i].tolist(), strict=True))
        out[i] = text + b" " * (len(text) == 4 * x.shape[1])
    return out


_STATE = "vec_id long, x binary, nearest int, upper double, lower binary"


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            yield batch.slice(at, STEP)


def _prepare(k: int, d: int):
    """Vectors as integers, with bounds that say nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            n = batch.num_rows
            x = pa.array(_stored(batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)), pa.binary())
            lower = pa.array([np.zeros(k, "<f8").tobytes()] * n, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), x, pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, np.inf)), lower], names=["vec_id", "x", "nearest", "upper", "lower"])

    return run


def _round(shared, d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        k = len(c.vectors)
        for batch in _steps(batches):
            x = _integers(batch.column("x"), d)
            lower = flat_bytes(batch.column("lower"))[0].view("<f8").reshape(-1, k)
            own = Assigned(x, batch.column("nearest").to_numpy().copy(), batch.column("upper").to_numpy().copy(), lower.copy())
            own.follow(c.moved)
            own.assign(c)
            stored = [row.tobytes() for row in own.lower.astype("<f8")]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), pa.array(own.nearest.astype(np.int32)), pa.array(own.upper), pa.array(stored, pa.binary())], names=["vec_id", "x", "nearest", "upper", "lower"])

    return run


def _sums(d: int):
    """Vectors of each centroid and their sum, a row for each centroid of a batch; sums as decimal text, of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in _steps(batches):
            x, near = _integers(batch.column("x"), d), batch.column("nearest").to_numpy()
            for j in np.unique(near).tolist():
                part = x[near == j]
                n, sums = total.get(j, (0, [0] * d))
                total[j] = [n + len(part), [a + int(b) for a, b in zip(sums, part.sum(axis=0).tolist(), strict=True)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v[0] for v in total.values()], pa.int64()), pa.array([",".join(map(str, v[1])) for v in total.values()], pa.string())],
            names=["nearest", "n", "sums"],
        )

    return run


def _merged(d: int):
    """One row for each centroid of a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for j, n, sums in zip(*(batch.column(c).to_pylist() for c in ("nearest", "n", "sums")), strict=True):
                before = total.get(j, (0, [0] * d))
                total[j] = [before[0] + n, [a + int(b) for a, b in zip(before[1], sums.split(","), strict=True)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v[0] for v in total.values()], pa.int64()), pa.array([",".join(map(str, v[1])) for v in total.values()], pa.string())],
            names=["nearest", "n", "sums"],
        )

    return run


def _distances(shared, d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in _steps(batches):
            x, near = _integers(batch.column("x"), d), batch.column("nearest").to_numpy()
            exact = squared(x, c.vectors[near]).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("nearest"), pa.array([str(v) for v in exact], pa.string())], names=["vec_id", "cluster", "squared"])

    return run


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def clustered(vectors: DataFrame, *, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector of ``vectors`` (vec_id, embedding) that takes part.

    Those take part that have ``dimensions`` components, none null or non-finite;
    each component becomes floor(256 * x).  The first centroids are the ``k``
    vectors of smallest SHA-256 of ``seed:vec_id``, or all if there are fewer.
    Rows that share a vec_id are vectors of their own; ties of the hash go by the
    components, and rows without a vec_id come last.  Distances are exact however
    large the components; one that a long can't hold is null, as is a sum.  An empty
    table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    fine = (F.size("embedding") == dimensions) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    x = spread(vectors).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("embedding").isNotNull() & fine)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = x.orderBy(order.asc_nulls_last(), "embedding").limit(k).select("embedding").collect()
    if not first:
        return spark.createDataFrame([], RESULT)
    centroids, before = _as_lists([r.embedding for r in first], dimensions), None
    state = written(x.mapInArrow(_prepare(len(centroids), dimensions), _STATE), "elkan-0")
    for n in range(rounds + 1):
        shared = spark.sparkContext.broadcast(Centroids.of(centroids, before))
        after = written(state.mapInArrow(_round(shared, dimensions), _STATE), f"elkan-{n + 1}")
        # The table that this one was made from is not read again.
        discard(state)
        state = after
        if n == rounds:
            break
        # At most k rows leave a task, and k rows reach the driver.
        parts = state.select("x", "nearest").mapInArrow(_sums(dimensions), "nearest int, n long, sums string")
        merged = parts.repartition("nearest").mapInArrow(_merged(dimensions), "nearest int, n long, sums string")
        before, centroids = centroids, list(centroids)
        for r in merged.collect():
            centroids[r.nearest] = [int(s) // r.n for s in r.sums.split(",")]
    final = spark.sparkContext.broadcast(Centroids.of(centroids, None))
    found = written(state.select("vec_id", "x", "nearest").mapInArrow(_distances(final, dimensions), "vec_id long, cluster int, squared string"), "distances")
    discard(state)
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    # Distances beyond a long are few if any: those that fit are summed by Spark.
    exact = F.expr("try_cast(squared as bigint)")
    by_cluster = found.groupBy("cluster").agg(F.sum(exact.cast("decimal(38,0)")).alias("s"), F.sum(exact.isNull().cast("int")).alias("beyond")).collect()
    sums = {r.cluster: None if r.beyond or int(r.s) > _INT64 else int(r.s) for r in by_cluster}
    total = None if any(r.beyond for r in by_cluster) else sum(int(r.s) for r in by_cluster)
    total = None if total is None or total > _INT64 else total
    table = spark.createDataFrame([(j, s, total, hashes[j]) for j, s in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", exact.alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")


def _as_lists(vectors: list[list[float]], d: int) -> list[list[int]]:
    return [[int(v) for v in row] for row in _integers(pa.array(_stored(np.array(vectors, dtype=np.float64)), pa.binary()), d)]


def sql(k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: int = SEED) -> str:
    """The same with all distances of every round."""
    near = "SELECT x.vec_id, x.x, arg_min(c.j, (list_sum(list_transform(list_zip(x.x, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.j)) AS j FROM x, c{n} c GROUP BY x.row, x.vec_id, x.x"
    text = f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda v: CAST(floor(CAST(v AS DOUBLE) * {SCALE}) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {dimensions}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), x) - 1 AS j, x AS c FROM x QUALIFY j < {k}
)"""
    for n in range(rounds):
        text += f""", a{n} AS MATERIALIZED ({near.format(n=n)}), c{n + 1} AS MATERIALIZED (
  SELECT c.j, coalesce(m.c, c.c) AS c FROM c{n} c LEFT JOIN (
    SELECT j, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
      SELECT j, i, sum(x[i]) AS s, count(*) AS n FROM a{n}, range(1, {dimensions + 1}) r(i) GROUP BY j, i) GROUP BY j
  ) m ON m.j = c.j
)"""
    last = f"c{rounds}"
    return f"""{text}, a AS MATERIALIZED ({near.format(n=rounds)}), d AS (
  SELECT a.vec_id, a.j, list_sum(list_transform(list_zip(a.x, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance, sha256(array_to_string(c.c, ',')) AS h FROM a JOIN {last} c ON c.j = a.j
)
SELECT vec_id, CAST(j AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, h AS centroid_sha256 FROM d
"""
