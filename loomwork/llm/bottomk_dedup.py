"""Near-duplicate documents by bottom-k sketches.

A document's set holds the 64-bit hashes of its distinct five-word shingles.
Its sketch is the ``k`` smallest of them: one hash function serves both as the
shingle's identity and as its random order.

1.  Documents with equal sets form one class; from here on a class is one node.
2.  Retained values are counted over all nodes.  Values of one node alone link
    nothing.  Two sets of similarity 0.75 that both have k shingles or more share
    at least ``need`` of the values that both retain: the k smallest values of
    their union are a random sample of it, and sure() sets ``need`` so that at
    most one such pair in 10^15 shares fewer (need = 18 for k = 64).  A set of n < k shingles surely shares 0.75 n with
    a partner that retains all of its own; a larger partner has up to n / 0.75 and
    leaves out all but k of them, so n + k - n / 0.75 are sure.  So it is enough that
    each node enters the inverted lists of its ``size - least + 1`` rarest values,
    ``least`` being what it shares with any partner.
3.  Star round: in each list the node with the most common values is the hub,
    and every other member is compared with it.  Links give components.
4.  Lists that hold one component need nothing more.  Of the others, short lists
    give their pairs across components.  Long lists never give their pairs: of a
    hub whose members stand in several components, two members either share a
    shingle outside the hub's set, and then meet in a list of such shingles; or
    their common part lies within it.  For the second case each member is a set of
    bits over the hub's shingles, blocks of members meet in numpy, and only links
    become rows.  Either way nothing is lost; _members_alike() says how these lists
    stay short.
5.  Pairs pass the union-sketch estimate, then exact Jaccard on full sets.  A
    hub's set comes once for each block of its members, which stream past it.

Only pairs that can change the components are looked at.  Rows grow with a group's
members times its hubs.  What can grow with the square of a group is the number of
bit sets compared in the tasks of step 4: members that no link has joined to their
hub, of fitting sizes, each with the others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared_folder import broadcast_up_to, discard, neutral, spread, written
from .textbytes import flat_bytes, in_pieces, mix, shingle_hashes, word_bounds, word_hashes

WIDTH = 5
K = 64
#: Links: 100 * intersection >= 75 * union.
PERCENT = 75
#: The chance that a link of two sets beyond the sketch shares fewer retained values than is asked for.
MISSED = 1e-15
#: A sketch that holds any set whole.
ALL = 1 << 40
#: Lists of up to so many nodes give their pairs across components.
SHORT = 24
#: The wanted (node, doc_id) rows are broadcast up to so many, and joined by a shuffle beyond.
BROADCAST_ROWS = 500_000
#: Members that one task compares with their hub before another task takes more of them.
MEMBERS = 250
#: Members of a hub, of either side, whose bit sets one task compares.
BIT_ROWS = 1_000
#: Nodes of so many edges have their edges joined where they are, not dealt to one task.
HEAVY = 10_000
#: Rounds of lists of first parts, and values that join a hub's set in one round at most.
ROUNDS, JOIN_AT_ONCE = 3, 1_000


def sure(k: int, percent: int, missed: float = MISSED) -> int:
    """Retained values that two linked sets beyond the sketch share, but for a chance of ``missed``.

    Of the k smallest values of the union each is common with a chance of percent
    / 100 at least; a draw without repetition strays less than the binomial does.
    """
    p, tail, need = percent / 100, 0.0, 0
    while need < k and (tail := tail + math.comb(k, need) * p**need * (1 - p) ** (k - need)) <= missed:
        need += 1
    return need


def _sets(column: pa.Array, width: int) -> list[np.ndarray]:
    data, offsets = flat_bytes(column)
    starts, ends, words = word_bounds(data, offsets)
    shingles, bounds = shingle_hashes(word_hashes(data, starts, ends), words, width)
    return [np.unique(shingles[bounds[i] : bounds[i + 1]]) for i in range(len(words) - 1)]


def _sketch(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_pieces(whole):
                sets = _sets(batch.column("text"), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_set_key(s) for s in sets], pa.binary()),
                        pa.array([s[:k].view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "hash", "n_shingles", "key", "sketch"],
                )

    return run


def _set_key(s: np.ndarray) -> bytes | None:
    """128 bits that stand for a set: two sums of independently mixed values."""
    if not len(s):
        return None
    with np.errstate(over="ignore"):
        return mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum().tobytes() + mix(s ^ np.uint64(0x14057B7EF767814F)).sum().tobytes()


def _full_sets(width: int):
    """Sets of the rows (node, key, text) whose text has the key's set; a doc_id can have other texts too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_pieces(whole):
                sets = [s if _set_key(s) == key else None for s, key in zip(_sets(batch.column("text"), width), batch.column("key").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([None if s is None else s.tobytes() for s in sets], pa.binary())], names=["node", "shingles"])

    return run


def _estimated(a: np.ndarray, b: np.ndarray, k: int) -> int | None:
    """Common values among the k smallest of the union of two sketches; None if the union is smaller."""
    merged = np.sort(np.concatenate((a, b)))
    first = np.concatenate(([True], merged[1:] != merged[:-1]))
    distinct = np.flatnonzero(first)
    if len(distinct) < k:
        return None
    upto = int(distinct[k - 1]) + 1
    # The k-th value counts as common if it stands twice.
    upto += upto < len(merged) and merged[upto] == merged[upto - 1]
    return upto - k


def _bits(at: np.ndarray, n: int) -> bytes:
    """A set of places below n, in whole words of 64 bits."""
    out = np.zeros(-(-max(n, 1) // 64) * 64, dtype=bool)
    out[at] = True
    return np.packbits(out).tobytes()


def _verify(k: int, need: int, percent: int):
    """Estimate, then exact intersection of hubs and members; ``outside`` only for members of long lists.

    Rows come by hub: the hub's own set first, then its members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            data, offsets = flat_bytes(batch.column("shingles"))
            rows, common, linked, outside, inside = [], [], [], [], []
            for row, (a, member, wanted) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").is_valid().to_pylist(), batch.column("long").to_pylist(), strict=True)):
                b = data[offsets[row] : offsets[row + 1]].view(np.uint64)
                if not member:
                    hub, own = a, b.copy()
                    continue
                if a != hub:
                    raise ValueError("a member without its hub")
                rows.append(row)
                if not wanted and (shared := _estimated(own[:k], b[:k], k)) is not None and shared < need:
                    common.append(None)
                    linked.append(False)
                    outside.append(None)
                    inside.append(None)
                    continue
                at = np.minimum(np.searchsorted(own, b), len(own) - 1)
                both = own[at] == b
                n = int(both.sum())
                common.append(n)
                linked.append(100 * n >= percent * (len(own) + len(b) - n))
                outside.append(b[~both].view(np.int64) if wanted else None)
                inside.append(_bits(at[both], len(own)) if wanted else None)
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*[kept.column(c) for c in ("a", "b", "long", "n_a", "n_b")], pa.array(common, pa.int64()), pa.array(linked, pa.bool_()), pa.array(outside, pa.list_(pa.int64())), pa.array(inside, pa.binary())],
                names=["a", "b", "long", "n_a", "n_b", "common", "linked", "outside", "inside"],
            )

    return run


def _all_stars(edges: DataFrame) -> bool:
    """Each larger end has one edge and is no other edge's smaller end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty()


def _with_low(edges: DataFrame, heavy: int) -> DataFrame:
    """Edges (u, v) with m, the smallest neighbour of u.

    A node of many edges would bring them all to one task.  There are few such
    nodes, one for ``heavy`` edges at most: their rows are broadcast up to a size,
    and their edges stay where they are.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    if edges.count() < heavy:
        return edges.join(low.select("u", "m"), "u").select("u", "v", "m")
    hot = written(low.where(F.col("n") >= heavy).select(F.col("u").alias("hot"), F.col("m").alias("hot_m")), "heavy-nodes")
    low = low.where(F.col("n") < heavy).select("u", "m")
    if hot.isEmpty():
        return edges.join(low, "u").select("u", "v", "m")
    marked = edges.join(broadcast_up_to(hot, BROADCAST_ROWS), F.col("u") == F.col("hot"), "left")
    return marked.where("hot is not null").select("u", "v", F.col("hot_m").alias("m")).unionByName(marked.where("hot is null").select("u", "v").join(low, "u").select("u", "v", "m"))


def components(edges: DataFrame, *, heavy: int = HEAVY) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node reachable.

    Alternates large-star and small-star steps, which keep connectivity and end
    with stars, in a number of rounds that grows with the logarithm of the size.
    Each round is a min per key (combined before the shuffle) and a join.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while not _all_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _with_low(both, heavy).select("u", "v", F.least("u", "m").alias("m"))
        large = written(low.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-stars")
        low = _with_low(large, heavy)
        small = low.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        edges = written(small.distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _sizes_fit(percent: int):
    """Sets of these sizes can be similar enough."""
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def _across(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of a list's nodes (value, node, n, root) that stand in different components."""
    mixed = entries.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("value")
    entries = entries.join(mixed, "value", "left_semi")
    a = entries.select("value", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("root_a"))
    b = entries.select("value", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("root").alias("root_b"))
    return a.join(b, (a["value"] == b["value"]) & (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & _sizes_fit(percent)).select("a", "b", "n_a", "n_b").distinct()


def _linked_bits(apart: pd.DataFrame, others: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links (a, b) across components of members whose common part within the hub's set suffices.

    Rows are b, n, common, root, apart, inside (bits over the hub's shingles) and extra
    (values that have joined them).  Sizes and common parts are looked at before bits.
    """
    empty = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    if not len(apart) or not len(others):
        return empty
    extras = [[np.asarray(v if v is not None else [], dtype=np.int64) for v in side["extra"]] for side in (apart, others)]
    known = np.unique(np.concatenate([v for side in extras for v in side]))

    def bits(side: pd.DataFrame, extra: list[np.ndarray]) -> np.ndarray:
        joined = [bytes(x) + _bits(np.searchsorted(known, v), len(known)) for x, v in zip(side["inside"], extra, strict=True)]
        return np.frombuffer(b"".join(joined), dtype=np.uint64).reshape(len(side), -1)

    left, right = bits(apart, extras[0]), bits(others, extras[1])
    b, n, common, root, is_apart = (others[c].to_numpy() for c in ("b", "n", "common", "root", "apart"))
    found = []
    for i, (x, n_x, common_x, root_x) in enumerate(zip(apart["b"].to_numpy(), apart["n"].to_numpy(), apart["common"].to_numpy(), apart["root"].to_numpy(), strict=True)):
        # Two members that are both apart come once.
        fits = (root != root_x) & (~is_apart | (b > x)) & (np.minimum(common, common_x) * (100 + percent) >= percent * (n + n_x))
        rows = np.flatnonzero(fits)
        if len(rows):
            both = np.bitwise_count(right[rows] & left[i]).sum(axis=1, dtype=np.int64)
            found += [(x, y) for y in b[rows[both * (100 + percent) >= percent * (n[rows] + n_x)]]]
    return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64) if found else empty


def _within(members: DataFrame, percent: int, rows: int) -> DataFrame:
    """Links (a, b) of a hub's members in different components whose common part within the hub's set suffices.

    Of two linked members one at least is apart from the hub's component, and their
    sizes are in the same class or in neighbouring ones, each of which reaches to
    100 / percent of its least.  A hub's members of one class are cut into blocks;
    a block of those apart and a block of any are one task.
    """
    values = ("b", "n", "common", "root", "apart", "inside", "extra")
    # Each step is written: one plan of all of them would fill the driver.
    members = written(members.select("a", *values, F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9).alias("sizes")), "bits")
    blocks = members.groupBy("a", "sizes").agg(F.ceil(F.count("*") / rows).alias("of_any"), F.ceil(F.sum(F.col("apart").cast("int")) / rows).alias("of_apart"))
    blocks = written(blocks, "bit-blocks")
    near = F.explode(F.array(F.col("sizes") - 1, F.col("sizes"), F.col("sizes") + 1)).alias("near")
    # Those apart go to their own class's row and to its neighbours', a copy for each block that they meet there.
    apart = members.where("apart").join(blocks.select("a", "sizes", "of_apart"), ["a", "sizes"]).select("a", near, F.pmod(F.xxhash64("b"), "of_apart").alias("i"), F.col("sizes").alias("own"), *values)
    apart = apart.join(blocks.select("a", F.col("sizes").alias("near"), "of_any"), ["a", "near"]).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("of_any") - 1))).drop("of_any")
    # Others go to the blocks of those apart in their own and the neighbouring classes.
    any_ = members.join(blocks.select("a", "sizes", "of_any"), ["a", "sizes"]).select("a", F.col("sizes").alias("near"), F.pmod(F.xxhash64("b"), "of_any").alias("j"), F.explode(F.array(F.col("sizes") - 1, F.col("sizes"), F.col("sizes") + 1)).alias("own"), *values)
    any_ = any_.join(blocks.where("of_apart > 0").select("a", F.col("sizes").alias("own"), "of_apart"), ["a", "own"]).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("of_apart") - 1))).drop("of_apart")
    keys = ("a", "own", "near", "i", "j")
    # Both sides come from one table: one gets columns of its own.
    any_ = any_.select(*[F.col(c).alias(c) for c in (*keys, *values)])
    links = written(apart.groupBy(*keys).cogroup(any_.groupBy(*keys)).applyInPandas(lambda left, right: _linked_bits(left, right, percent), "a long, b long"), "bit-links")
    discard(members)
    return links


def _met(listed: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs across components of the short lists (a, b, value)."""
    entries = listed.join(members.select("a", "b", "n", "root"), ["a", "b"])
    return _across(entries.select(F.struct("a", "value").alias("value"), F.col("b").alias("node"), "n", "root"), percent)


def _listed(long_pairs: DataFrame, outside) -> DataFrame:
    """(a, b, value, members) of the values in ``outside`` that several members of a hub have."""
    values = long_pairs.select("a", "b", F.explode(outside).alias("value"))
    shared = values.groupBy("a", "value").agg(F.count("*").alias("members")).where("members > 1")
    return values.join(shared, ["a", "value"])


def _members_alike(long_pairs: DataFrame, percent: int, short: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Members of one hub in different components: pairs (a, b, n_a, n_b) that may link, and links (a, b).

    Two linked members f and y share 75 % of each.  Put the shingles outside the
    hub's set C first, in the order of their values: then the first 25 % and one of
    f and of y have their first common one among them.  If that lies outside C, they
    meet in its list.  If it lies in C, their whole common part does, and _within()
    finds the link.  A list of more than ``short`` members gives no pairs: its value
    joins C, and its members are taken again.  After ROUNDS all that more than
    ``short`` of those that remain share joins C, and what is left outside gives
    short lists.
    """
    # Of two members in different components one at least is apart from the hub's.
    rest = long_pairs.select("a", "b", F.col("n_b").alias("n"), "common", F.col("root_b").alias("root"), (F.col("root_a") != F.col("root_b")).alias("apart"), "outside", "inside", F.array().cast("array<bigint>").alias("extra"))
    links = _within(rest, percent, rows)
    pairs = None

    def met(listed: DataFrame, members: DataFrame) -> None:
        nonlocal pairs
        found = written(_met(listed, members, percent), "met")
        pairs = found if pairs is None else pairs.unionByName(found)

    for _ in range(ROUNDS):
        first = written(_listed(rest, F.slice("outside", F.lit(1), (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))), "first-parts")
        met(first.where(F.col("members") <= short), rest)
        long = first.where(F.col("members") > short)
        again = written(long.select("a", "b").distinct(), "taken-again")
        if again.isEmpty():
            return pairs, links
        # The most frequent of a hub's long lists, so many at once that a row holds them.
        by_hub = Window.partitionBy("a").orderBy(F.desc("members"), "value")
        joins = long.select("a", "value", "members").distinct().withColumn("place", F.row_number().over(by_hub)).where(F.col("place") <= JOIN_AT_ONCE)
        joins = written(joins.groupBy("a").agg(F.collect_list("value").alias("moved")), "joins-hub")
        left = F.array_except("outside", "moved")
        rest = rest.join(again, ["a", "b"], "left_semi").join(broadcast_up_to(joins, BROADCAST_ROWS // 50), "a")
        taken = (F.col("common") + F.size("outside") - F.size(left)).alias("common")
        rest = written(rest.select("a", "b", "n", taken, "root", "apart", left.alias("outside"), "inside", F.concat("extra", F.array_intersect("outside", "moved")).alias("extra")), "rest")
        links = links.unionByName(_within(rest, percent, rows))
    whole = written(_listed(rest, F.col("outside")), "whole-parts")
    more = whole.where(F.col("members") > short).groupBy("a", "b").agg(F.collect_list("value").alias("more"))
    more = F.coalesce("more", F.array().cast("array<bigint>")), more
    rest = rest.join(more[1], ["a", "b"], "left").withColumns({"common": F.col("common") + F.size(more[0]), "extra": F.concat("extra", more[0])}).drop("more")
    met(whole.where(F.col("members") <= short), rest)
    return pairs, links.unionByName(_within(rest, percent, rows))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  Null, empty and
    wordless texts have no shingles and are linked with nothing.  Equal texts are
    linked.  Rows with one doc_id and several texts keep a row each.  Rows
    without a doc_id get their n_shingles, take part with the other rows' links,
    and are kept only if nothing of their component has a doc_id.  An empty table
    gives an empty result; other columns are not read.
    """
    return labelled(docs, **options).select("doc_id", "n_shingles", "component_id", "kept")


def labelled(docs: DataFrame, *, width: int = WIDTH, k: int = K, percent: int = PERCENT, short: int = SHORT, members: int = MEMBERS, heavy: int = HEAVY, bit_rows: int = BIT_ROWS, missed: float = MISSED) -> DataFrame:
    """near_duplicates() with the key of the row's set, null without shingles.

    With ``missed`` 0 no chance is taken: every shingle is retained, which costs an
    index of all of them; then what is sure of sets below the sketch holds for all.
    """
    if missed == 0:
        k = ALL
    need = sure(k, percent, missed) if missed else 0
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    # doc_id and the text's hash find a row again, even where many rows share a doc_id or have none.
    docs = spread(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    rows = written(docs.mapInArrow(_sketch(width, k), "doc_id long, hash long, n_shingles long, key binary, sketch array<long>"), "sketches")
    # A node is a number from here on: lists and pairs hold 8 bytes of it.
    nodes = written(
        rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "hash")).alias("first"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")).withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    rows_repeat = not rows.groupBy("doc_id", "hash").count().where("count > 1").isEmpty()

    # Inverted lists of the rarest retained values that at least two nodes have.
    retained = nodes.select("node", "n", F.explode("sketch").alias("value"))
    shared = retained.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    m = F.least("n", F.lit(k))
    # A partner of more than k shingles retains k of them: of a small set's common values it can leave out the rest.
    small = F.least(F.ceil(F.col("n") * percent / 100), F.col("n") + k - F.floor(F.col("n") * 100 / percent))
    least = F.when(F.col("n") < k, small).otherwise(F.lit(need))
    by_node = Window.partitionBy("node")
    entries = (
        retained.join(shared, "value")
        .withColumn("rare", F.row_number().over(by_node.orderBy("df", "value")))
        .withColumn("n_shared", F.count("*").over(by_node))
        .withColumn("common_sum", F.sum("df").over(by_node))
        # Values of one node alone come first of all.
        .where(F.col("rare") + m - F.col("n_shared") <= m - least + 1)
        .select("value", "node", "n", (F.col("common_sum") / m).alias("typical"))
    )
    entries = written(entries, "lists")
    hubs = entries.groupBy("value").agg(F.max(F.struct("typical", "node", "n")).alias("hub"), F.count("*").alias("members")).where("members > 1")
    starred = entries.join(hubs.select("value", F.col("hub.node").alias("a"), F.col("hub.n").alias("n_a"), "members"), "value").where("a <> node")
    stars = starred.groupBy("a", F.col("node").alias("b")).agg(F.first("n_a").alias("n_a"), F.first("n").alias("n_b"), (F.max("members") > short).alias("long"))
    stars = written(stars.where(F.col("long") | _sizes_fit(percent)), "stars")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs with their estimate and exact intersection; full sets are made again from one text of each node."""
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        texts = written(nodes.select("node", "key", F.col("first.doc_id").alias("of_id"), F.col("first.hash").alias("of_hash")).join(wanted, "node"), "wanted")
        found = docs.join(broadcast_up_to(texts, BROADCAST_ROWS), F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("hash") == F.col("of_hash")))
        full = found.select("node", "key", "text").mapInArrow(_full_sets(width), "node long, shingles binary").where("shingles is not null")
        full = written(full.dropDuplicates(["node"]) if rows_repeat else full, "sets")
        # Hubs of many members are cut into blocks; there is one such hub for ``members`` pairs at most.
        large = written(pairs.groupBy("a").agg(F.ceil(F.count("*") / members).alias("blocks")).where("blocks > 1"), "large-hubs")
        block = F.pmod(F.xxhash64("b"), F.coalesce("blocks", F.lit(1)))
        dealt = written(pairs.join(broadcast_up_to(large, BROADCAST_ROWS), "a", "left").select("a", block.alias("block"), "b", "long", "n_a", "n_b"), "dealt-pairs")
        # One join brings the sets of members and of hubs; then each block's go to one task, the hub's first.
        of_hubs = dealt.select("a", "block").distinct().select(F.col("a").alias("node"), "a", "block", *[F.lit(None).cast(t).alias(c) for c, t in (("b", "long"), ("long", "boolean"), ("n_a", "long"), ("n_b", "long"))])
        with_sets = of_hubs.unionByName(dealt.withColumn("node", F.col("b"))).join(full, "node").drop("node")
        by_hub = with_sets.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())
        out = written(by_hub.mapInArrow(_verify(k, need, percent), "a long, b long, long boolean, n_a long, n_b long, common long, linked boolean, outside array<long>, inside binary"), name)
        # What was made for this comparison alone is not read again.
        for table in (texts, full, dealt):
            discard(table)
        return out

    star_pairs = verified(stars, "star_pairs")
    links = star_pairs.where("linked").select("a", "b")
    root = written(components(links, heavy=heavy), "roots")

    def rooted(df: DataFrame, column: str, name: str) -> DataFrame:
        of = root.select(F.col("node").alias(column), F.col("root").alias(name))
        return df.join(of, column, "left").withColumn(name, F.coalesce(name, column))

    # Short lists: pairs across components.
    open_lists = entries.join(hubs.where(F.col("members") <= short).select("value"), "value", "left_semi")
    across = _across(rooted(open_lists, "node", "root"), percent)

    # Long lists: shingles outside the hub, and members that sizes leave open.
    # A hub whose members are one component has nothing more to find.
    of_long = written(rooted(rooted(star_pairs.where("long"), "a", "root_a"), "b", "root_b"), "long_pairs")
    several = written(of_long.groupBy("a").agg(F.min("root_b").alias("low"), F.max("root_b").alias("high")).where("low <> high").select("a"), "open-hubs")
    long_pairs = of_long.join(broadcast_up_to(several, BROADCAST_ROWS), "a", "left_semi")
    some, inside = _members_alike(long_pairs, percent, short, bit_rows)

    more = across.unionByName(some).where(_sizes_fit(percent)).distinct().withColumn("long", F.lit(False))
    later = verified(written(more, "pairs"), "later_pairs").where("linked").select("a", "b")
    root = written(components(links.unionByName(later).unionByName(inside), heavy=heavy), "roots")

    of_node = nodes.select("key", "node", "low").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    labels = of_node.groupBy("root").agg(F.min("low").alias("component_id"))
    of_key = of_node.select("key", "root").join(labels, "root").select("key", "component_id")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    labelled_rows = rows.select("doc_id", "n_shingles", "key").join(of_key, "key", "left").select("doc_id", "n_shingles", "key", component.alias("component_id"))
    return labelled_rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, *, width: int = WIDTH, **options) -> DataFrame:
    """The rows of ``docs`` that near_duplicates() keeps, with their own columns.

    Of rows that share doc_id and set one stays.  A doc_id with several rows is
    judged row by row, by the set of its text; so are rows without a doc_id.
    """
    docs, said = neutral(docs, "doc_id", "text"), docs.columns
    names, schema = docs.columns, docs.schema
    verdicts = written(labelled(docs, width=width, **options).select("doc_id", "key", "kept"), "verdicts")
    by_id = verdicts.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    several = (F.col("n") > 1) | F.col("doc_id").isNull()
    left = docs.join(written(by_id.where(~several & ~F.col("kept")).select("doc_id"), "gone"), "doc_id", "left_anti").select(names)
    shared = written(by_id.where(several).select(F.col("doc_id").alias("m_id")), "shared-ids")
    if shared.isEmpty():
        return left.toDF(*said)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_pieces(whole):
                keys = [_set_key(s) for s in _sets(batch.column("text"), width)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=[*names, "m_key"])

    of_shared = F.col("doc_id").eqNullSafe(F.col("m_id"))
    rows = docs.join(shared, of_shared, "left_semi").mapInArrow(keyed, T.StructType([*schema.fields, T.StructField("m_key", T.BinaryType())]))
    bad = verdicts.where(~F.col("kept")).select(F.col("doc_id").alias("b_id"), F.col("key").alias("b_key")).distinct()
    rows = rows.join(bad, F.col("doc_id").eqNullSafe(F.col("b_id")) & F.col("m_key").eqNullSafe(F.col("b_key")), "left_anti")
    once = rows.where("m_key is not null").dropDuplicates(["doc_id", "m_key"]).unionByName(rows.where("m_key is null"))
    return left.join(shared, of_shared, "left_anti").unionByName(once.select(names)).toDF(*said)


#: The same by all pairs that share a shingle.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS shingle FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), ways AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT a AS doc_id, a AS low FROM ways UNION SELECT ways.b, reach.low FROM reach JOIN ways ON reach.doc_id = ways.a
), low AS (
  SELECT doc_id, min(low) AS low FROM reach GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(low.low, d.doc_id) AS component_id, coalesce(low.low, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""
