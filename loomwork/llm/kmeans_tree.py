"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample: each node splits its vectors into
``branch`` clusters until ``leaf_sample`` or fewer remain.  Every row of the
table is then put into the leaf that greedy descent finds, so the index holds
all rows.  Leaves that hold more than ``leaf_rows`` rows are split further, each
by a tree fitted in a task of its own on a bounded sample of its rows: so leaves
keep their size as the table grows, and their number grows.  A query walks the tree best bin first: a priority queue holds the
branches seen so far by their distance, and leaves come out nearest first.  How
many leaves a query visits is widened until a sample of queries, held against
all rows, reaches the wanted recall; it goes on while they hold fewer than ``k``
rows of other ids.

Vectors are unit length in the tree, where nearness by cosine and by distance
agree.  Rows with the same vector are one entry of the index with the smallest
``k`` + 1 of their distinct ids, each up to ``k`` times: no more of them can be
among a query's nearest, whichever id is its own.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared_folder import written

K = 5
QUERY_EVERY = 50
#: Rows that the tree is fitted on, and queries that calibrate it, at most.
SAMPLE = 16_384
CALIBRATION = 256
BRANCH = 16
LEAF_SAMPLE = 128
#: Wanted recall on the calibration queries; searches must reach 0.9.
RECALL = 0.97
#: Rows of a leaf that is not split further, and rows that its split is fitted on, at most.
LEAF_ROWS = 2_000
SPLIT_SAMPLE = 4_096
#: Centres of the whole tree, which is broadcast: beyond that leaves grow, and are cut into blocks.
MOST_CENTRES = 100_000
#: Entries of a leaf, and queries at a leaf, that one task compares at once.
BLOCK = 4096


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component to 0.5 up to 1: squares neither under- nor overflow, no digit changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1]) if x.size else x


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = x[np.sort(rng.choice(len(x), k, replace=False))]
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres, (x @ centres.T).argmax(axis=1)


@dataclass
class Tree:
    """children[n] is the first child of node n, or -1 - leaf; the children of a node stand together."""

    centres: np.ndarray
    children: list[int]
    widths: list[int]
    leaves: int

    @classmethod
    def fit(cls, x: np.ndarray, *, branch: int = BRANCH, leaf_sample: int = LEAF_SAMPLE, seed: int = 2) -> Tree:
        rng = np.random.default_rng(seed)
        centres, children, widths, leaves = [np.zeros(x.shape[1])], [0], [0], 0
        waiting = [(0, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            parts: list = []
            if len(rows) > leaf_sample:
                points, near = _k_means(x[rows], min(branch, len(rows)), rng)
                parts = [(points[c], rows[near == c]) for c in range(len(points)) if (near == c).any()]
            if len(parts) < 2:
                children[node], leaves = -1 - leaves, leaves + 1
                continue
            children[node], widths[node] = len(centres), len(parts)
            for point, own in parts:
                waiting.append((len(centres), own))
                centres.append(point)
                children.append(0)
                widths.append(0)
        return cls(np.array(centres), children, widths, leaves)

    def graft(self, splits: dict[int, Tree]) -> Tree:
        """This tree with some of its leaves replaced by trees; leaves are numbered anew."""
        centres, children, widths = [self.centres], list(self.children), list(self.widths)
        size, leaves = len(self.children), 0
        for node in range(len(self.children)):
            if self.children[node] >= 0:
                continue
            split = splits.get(-1 - self.children[node])
            if split is None or split.leaves < 2:
                children[node], leaves = -1 - leaves, leaves + 1
                continue
            # The split's root is this node; its other nodes follow those that are there.
            children[node], widths[node] = size + split.children[0] - 1, split.widths[0]
            for own, width in zip(split.children[1:], split.widths[1:], strict=True):
                children.append(size + own - 1 if own >= 0 else -1 - leaves)
                leaves += own < 0
                widths.append(width)
            centres.append(split.centres[1:])
            size = len(children)
        return Tree(np.concatenate(centres), children, widths, leaves)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf that descent to the nearest centre ends in, for every row."""
        out = np.zeros(len(x), dtype=np.int64)
        waiting = [(0, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            first = self.children[node]
            if first < 0:
                out[rows] = -1 - first
                continue
            near = (x[rows] @ self.centres[first : first + self.widths[node]].T).argmax(axis=1)
            waiting += [(first + c, rows[near == c]) for c in np.unique(near)]
        return out

    def nearest_leaves(self, q: np.ndarray, most: int, rows: np.ndarray | None = None, least: int = 0) -> list[int]:
        """Leaves in best-bin-first order: ``most``, and more until their ``rows`` come to ``least``."""
        out: list[int] = []
        held = 0 if rows is not None else least
        queue = [(0.0, 0)]
        while queue and (len(out) < most or held < least):
            _, node = heapq.heappop(queue)
            while self.children[node] >= 0:
                first, width = self.children[node], self.widths[node]
                far = -(self.centres[first : first + width] @ q)
                best = int(far.argmin())
                for c in range(width):
                    if c != best:
                        heapq.heappush(queue, (float(far[c]), first + c))
                node = first + best
            out.append(-1 - self.children[node])
            if rows is not None:
                held += rows[out[-1]]
        return out


def _vectors(values: list) -> np.ndarray:
    return np.array(values, dtype=np.float64)


def _score(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of rows of q with rows of x, each pair summed in the same order wherever it is computed."""
    q, x = scaled(q), scaled(x)
    return (q * x).sum(axis=-1) / np.sqrt((q * q).sum(axis=-1) * (x * x).sum(axis=-1))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part: those with a vec_id whose vector is whole and not zero."""
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    return x.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)


def _splits(index: DataFrame, held: np.ndarray, leaf_rows: int, split_sample: int, room: int) -> dict[int, Tree]:
    """Trees for the leaves of ``index`` (leaf, entry, embedding) that hold too many rows; a leaf is one task's work."""
    large = np.flatnonzero(held > leaf_rows)
    parts = -(-held // leaf_rows)
    # So many parts that all centres find room.
    scale = min(1.0, room / max(1, int(parts[large].sum()) * 2))
    wanted = {int(leaf): max(1, int(parts[leaf] * scale)) for leaf in large}
    if not any(n > 1 for n in wanted.values()):
        return {}
    place = F.row_number().over(Window.partitionBy("leaf").orderBy(F.xxhash64("entry", F.lit(3)), "entry"))
    some = index.where(F.col("leaf").isin([k for k, n in wanted.items() if n > 1])).select("leaf", "entry", "embedding").withColumn("place", place).where(F.col("place") <= split_sample)

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = unit(_vectors(rows.sort_values("place")["embedding"].tolist()))
        tree = Tree.fit(x, leaf_sample=max(4, len(x) // wanted[int(key[0])]))
        return pd.DataFrame([{"leaf": key[0], "centres": tree.centres.astype("<f8").tobytes(), "children": tree.children, "widths": tree.widths, "leaves": tree.leaves}])

    out = {}
    for r in some.groupBy("leaf").applyInPandas(fit, "leaf long, centres binary, children array<int>, widths array<int>, leaves long").collect():
        out[r.leaf] = Tree(np.frombuffer(r.centres, "<f8").reshape(len(r.children), -1), list(r.children), list(r.widths), r.leaves)
    return out


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest of every row and any that nearly tie with the last of them."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, dtype=bool)
    kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
    return scores >= kth - 1e-9


def _own(names: np.ndarray, ids: list[list[int]]) -> np.ndarray:
    """Whether an entry (sorted ids, a column) holds nothing but the query's id (a row)."""
    first, last = np.array([i[0] for i in ids]), np.array([i[-1] for i in ids])
    return (names[:, None] == first) & (names[:, None] == last)


RESULT = "query_id long, rank int, vec_id long, score double"


def nearest(vectors: DataFrame, *, every: int = QUERY_EVERY, **options) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose vec_id divides by ``every``.

    Rows (vec_id, embedding) that are null, zero, or hold null or non-finite
    components take no part.  Vectors of one length are searched among themselves:
    others have no cosine with them.  Rows that share a vec_id are candidates each,
    but never of their own vec_id.  Ties go to the smaller vec_id.  An empty table
    gives an empty result; other columns are not read.
    """
    rows = written(usable(vectors), "vectors")
    lengths = sorted(r.d for r in rows.select(F.size("embedding").alias("d")).distinct().collect())
    out = vectors.sparkSession.createDataFrame([], RESULT)
    for d in lengths:
        found = _nearest(rows.where(F.size("embedding") == d) if len(lengths) > 1 else rows, every=every, **options)
        out = found if len(lengths) == 1 else out.unionByName(found)
    return out


def _nearest(rows: DataFrame, *, every: int, k: int = K, sample: int = SAMPLE, calibration: int = CALIBRATION, recall: float = RECALL, block: int = BLOCK, leaf_rows: int = LEAF_ROWS, split_sample: int = SPLIT_SAMPLE, most_centres: int = MOST_CENTRES) -> DataFrame:
    """nearest() of vectors of one length."""
    spark = rows.sparkSession
    # Equal vectors: the smallest k + 1 distinct ids (a row each, with its count), limited before the shuffle.
    by_vector = Window.partitionBy("embedding").orderBy("vec_id")
    each = rows.groupBy("embedding", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"))
    few = each.withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= k + 1)
    entries = written(few.groupBy("embedding").agg(F.array_sort(F.flatten(F.collect_list(F.array_repeat("vec_id", F.col("n"))))).alias("ids")).select(F.element_at("ids", 1).alias("entry"), "ids", "embedding"), "entries")
    asked = written(rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding").dropDuplicates(["query_id", "embedding"]), "queries")
    schema = "query_id long, vec_id long, score double"

    some = entries.orderBy(F.xxhash64("entry", F.lit(2)), "entry").limit(sample).select("embedding").toPandas()
    if some.empty:
        return spark.createDataFrame([], RESULT)

    def indexed(tree: Tree) -> tuple[DataFrame, np.ndarray]:
        """All entries with their leaf, and the entries of each leaf."""
        shared = spark.sparkContext.broadcast(tree)

        def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf = shared.value.leaf_of(unit(_vectors(batch.column("embedding").to_pylist()))) if batch.num_rows else []
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], names=[*batch.schema.names, "leaf"])

        index = written(entries.mapInArrow(put, "entry long, ids array<long>, embedding array<double>, leaf long"), "index")
        held = np.zeros(tree.leaves, dtype=np.int64)
        for leaf, n in index.groupBy("leaf").count().collect():
            held[leaf] = n
        return index, held

    tree = Tree.fit(unit(_vectors(some["embedding"].tolist())))
    index, held = indexed(tree)
    if splits := _splits(index, held, leaf_rows, split_sample, most_centres - len(tree.children)):
        tree = tree.graft(splits)
        index, held = indexed(tree)
    shared = spark.sparkContext.broadcast(tree)

    # Calibration: exact neighbours of some queries among all entries, and the leaves they are in.
    trial = asked.orderBy(F.xxhash64("query_id", F.lit(5)), "query_id").limit(calibration).toPandas()
    if trial.empty:
        return spark.createDataFrame([], RESULT)
    tried = spark.sparkContext.broadcast((trial["query_id"].to_numpy(), _vectors(trial["embedding"].tolist())))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q = tried.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x, leaf, ids = _vectors(batch.column("embedding").to_pylist()), batch.column("leaf").to_numpy(), batch.column("ids").to_pylist()
            cosine = unit(q) @ unit(x).T
            cosine[_own(names, ids)] = -np.inf
            top = np.argsort(-cosine, axis=1, kind="stable")[:, :k]
            at = np.arange(len(names))[:, None]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(names)), top.shape[1]), pa.int64()), pa.array(leaf[top].ravel(), pa.int64()), pa.array(cosine[at, top].ravel(), pa.float64())], names=["q", "leaf", "score"])

    found = index.mapInArrow(exact, "q long, leaf long, score double").where("score >= -1")
    found = found.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "leaf"))).where(F.col("place") <= k).toPandas()
    order = {}
    for n, v in enumerate(unit(tried.value[1])):
        order[n] = {leaf: place for place, leaf in enumerate(tree.nearest_leaves(v, tree.leaves), start=1)}
    needed = np.sort([order[q][leaf] for q, leaf in zip(found["q"], found["leaf"], strict=True)])
    visits = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) if len(needed) else 1

    # Rows of every leaf, and of them those that are a query's own.
    held = np.zeros(tree.leaves, dtype=np.int64)
    for leaf, n in index.groupBy("leaf").agg(F.sum(F.size("ids"))).collect():
        held[leaf] = n
    own_rows = index.select("leaf", F.explode("ids").alias("query_id")).where(F.col("query_id") % every == 0).groupBy("query_id", "leaf").agg(F.count("*").alias("n"))
    own_rows = own_rows.groupBy("query_id").agg(F.collect_list("leaf").alias("own_leaves"), F.collect_list("n").alias("own_rows"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = unit(_vectors(batch.column("embedding").to_pylist())) if batch.num_rows else []
            leaves = []
            for v, own, n in zip(q, batch.column("own_leaves").to_pylist(), batch.column("own_rows").to_pylist(), strict=True):
                others = held.copy()
                others[np.array(own or [], dtype=np.int64)] -= np.array(n or [], dtype=np.int64)
                leaves.append(shared.value.nearest_leaves(v, visits, others, k))
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("embedding"), pa.array(leaves, pa.list_(pa.int64()))], names=["query_id", "embedding", "leaves"])

    # Leaves of many entries, and leaves that many queries visit, are cut into blocks.
    dealt = asked.join(own_rows, "query_id", "left").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    visit = written(dealt.mapInArrow(walk, "query_id long, embedding array<double>, leaves array<long>").select("query_id", "embedding", F.explode("leaves").alias("leaf")), "visits")
    entry_blocks = index.groupBy("leaf").agg(F.ceil(F.count("*") / block).alias("e_blocks"))
    query_blocks = visit.groupBy("leaf").agg(F.ceil(F.count("*") / block).alias("q_blocks"))
    grid = entry_blocks.join(query_blocks, "leaf")
    left = index.join(grid, "leaf").withColumn("e", F.pmod(F.xxhash64("entry"), "e_blocks")).withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("q_blocks") - 1))).select("leaf", "e", "q", "ids", "embedding")
    right = visit.join(grid, "leaf").withColumn("q", F.pmod(F.xxhash64("query_id"), "q_blocks")).withColumn("e", F.explode(F.sequence(F.lit(0).cast("long"), F.col("e_blocks") - 1))).select("leaf", "e", "q", "query_id", "embedding")

    def compare(_: tuple, x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(x) and len(q):
            points, asks, ids = _vectors(x["embedding"].tolist()), _vectors(q["embedding"].tolist()), x["ids"].tolist()
            cosine = unit(asks) @ unit(points).T
            names = q["query_id"].to_numpy()
            # Each entry that stays has a row of another id.
            cosine[_own(names, ids)] = -np.inf
            a, b = np.nonzero(_best(cosine, k) & (cosine > -np.inf))
            scores = _score(asks[a], points[b])
            for i, j, s in zip(a, b, scores, strict=True):
                out += [(names[i], v, s) for v in ids[j] if v != names[i]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    pairs = left.groupBy("leaf", "e", "q").cogroup(right.groupBy("leaf", "e", "q")).applyInPandas(compare, schema)
    nearest_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
