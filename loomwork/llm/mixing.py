"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

The words of a source, in doc_id order within each part of a shard, are cut into blocks of
equal size.  Sources get blocks by highest quotients weight / (2 s + 1), where s
is what they have already; then each source's shards get theirs in the same way.
So every shard has an integer quota.  A quota of q from n blocks means q // n
whole passes over the shard and q % n blocks besides, chosen by a permutation of
the blocks that a seed and the shard's number fix.  Whether a block is chosen so
follows from its number alone: no table of blocks is built or joined.

Only sums for each source and shard reach the driver.
"""

from __future__ import annotations

import heapq
import math
import random
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared_folder import broadcast_up_to, neutral, written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating; null comes last.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_PASSES = 2
BLOCK_WORDS = 32
#: Words of a shard, and shards of a source at most: beyond that shards grow, and are placed in parts of so many words.
SHARD_WORDS = 1 << 20
MOST_SHARDS = 4096
BROADCAST_ROWS = 100_000
SEED = 8


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST_PASSES) -> list[float]:
    """Weighted parts of ``share`` times all sizes, none above ``most`` times its size; excess goes to the others by weight."""
    out = [0.0] * len(sizes)
    open_, left = [k for k in range(len(sizes)) if sizes[k] > 0], share * sum(sizes)
    while open_:
        level = left / sum(weights[k] for k in open_)
        full = [k for k in open_ if weights[k] * level > most * sizes[k]]
        for k in full or open_:
            out[k] = float(most * sizes[k]) if full else weights[k] * level
        if not full:
            break
        left -= sum(out[k] for k in full)
        open_ = [k for k in open_ if k not in set(full)]
    return out


def sainte_lague(weights: list[float], seats: int, limits: list[int]) -> list[int]:
    """Seats by highest quotients weight / (2 s + 1), none above its limit; ties go to the earlier.

    Rounding weight / divisor gives the first so many quotients at once; a heap
    hands out the few that remain.
    """
    seats = min(seats, sum(m for w, m in zip(weights, limits, strict=True) if w > 0))

    def rounded(divisor: float) -> list[int]:
        return [min(m, math.floor(w / divisor + 0.5)) for w, m in zip(weights, limits, strict=True)]

    if seats <= 0:
        return [0] * len(weights)
    high = 2 * max(weights) + 1.0
    low = high
    while sum(rounded(low)) <= seats and low > 1e-12:
        high, low = low, low / 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if sum(rounded(middle)) <= seats else (middle, high)
    out = rounded(high)
    heap = [(-w / (2 * s + 1), k) for k, (w, s, m) in enumerate(zip(weights, out, limits, strict=True)) if s < m and w > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, k = heapq.heappop(heap)
        out[k] += 1
        if out[k] < limits[k]:
            heapq.heappush(heap, (-weights[k] / (2 * out[k] + 1), k))
    return out


@dataclass
class Mix:
    """(source, source_no, n_shards, n_parts, source_size, target) rows, (source_no, shard, words, blocks, passes, extra, step, shift) rows,
    and, where shards have several parts, the table of the words before each part."""

    sources: list[tuple]
    shards: list[tuple]
    before: DataFrame | None = None


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


SOURCE_SCHEMA = pa.schema({"m_source": pa.string(), "m_no": pa.int32(), "m_shards": pa.int32(), "m_parts": pa.int32(), "source_size": pa.int64(), "target": pa.float64()})
SHARD_SCHEMA = pa.schema({"m_no": pa.int32(), "m_shard": pa.int32()} | dict.fromkeys(("m_words", "m_blocks", "m_passes", "m_extra", "m_step", "m_shift"), pa.int64()))


def _table(like: DataFrame, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """Rows as a table to join with: broadcast up to BROADCAST_ROWS, by a shuffle beyond.

    They go to Spark as Arrow columns.  A list of rows would start plain Python workers
    in every executor, which stay beside those of the stages that follow.
    """
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    table = like.sparkSession.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))
    return F.broadcast(table) if len(rows) <= BROADCAST_ROWS else table


def _in_shards(sized: DataFrame, sources: list[tuple]) -> DataFrame:
    """Adds the source's row, the shard and the part of it.  m_key tells rows apart that share a doc_id."""
    table = _table(sized, sources, SOURCE_SCHEMA)
    dealt = lambda salt, n: F.pmod(F.xxhash64("doc_id", "m_key", F.lit(salt)), F.col(n)).cast("int")
    return sized.join(table, F.col("source").eqNullSafe(F.col("m_source"))).withColumns({"m_shard": dealt(SEED, "m_shards"), "m_part": dealt(SEED + 1, "m_parts")})


def plan(sized: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_PASSES, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, most_shards: int = MOST_SHARDS, seed: int = SEED) -> Mix:
    """The mix of rows (doc_id, source, size, m_key)."""
    totals = sorted(((r.source, r.words or 0) for r in sized.groupBy("source").agg(F.sum("size").alias("words")).collect()), key=lambda r: (r[0] is None, r[0] or ""))
    want = targets([n for _, n in totals], [weights[k % len(weights)] for k in range(len(totals))], share, most)
    sources = []
    for k, ((name, n), t) in enumerate(zip(totals, want, strict=True)):
        n_shards = max(1, min(most_shards, -(-n // shard_words)))
        sources.append((name, k, n_shards, max(1, -(-n // (n_shards * shard_words))), n, t))
    if not sources:
        return Mix([], [])
    before = None
    if max(s[3] for s in sources) > 1:
        earlier = Window.partitionBy("m_no", "m_shard").orderBy("m_part").rowsBetween(Window.unboundedPreceding, -1)
        sums = _in_shards(sized, sources).groupBy("m_no", "m_shard", "m_part").agg(F.sum("size").alias("words"))
        before = written(sums.select("m_no", "m_shard", "m_part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("m_before")), "parts")
    words: dict[int, dict[int, int]] = {}
    for r in _in_shards(sized, sources).groupBy("m_no", "m_shard").agg(F.sum("size").alias("words")).where("words > 0").collect():
        words.setdefault(r.m_no, {})[r.m_shard] = r.words
    blocks = {no: {s: max(1, round(n / block_words)) for s, n in of.items()} for no, of in words.items()}
    numbers = sorted(words)
    # Blocks of a source in its own block size, which is block_words but for rounding.
    shares = [want[no] * sum(blocks[no].values()) / sum(words[no].values()) for no in numbers]
    seats = sainte_lague(shares, round(sum(shares)), [most * sum(blocks[no].values()) for no in numbers])
    shards = []
    for no, quota in zip(numbers, seats, strict=True):
        own = sorted(words[no])
        parts = sainte_lague([float(words[no][s]) for s in own], quota, [most * blocks[no][s] for s in own])
        for s, q in zip(own, parts, strict=True):
            n = blocks[no][s]
            pick = random.Random(f"{seed}:{no}:{s}")
            step = next(x for x in iter(lambda: pick.randrange(1, n + 1), None) if math.gcd(x, n) == 1)
            shards.append((no, s, words[no][s], n, q // n, q % n, step % n if n > 1 else 0, pick.randrange(n)))
    return Mix(sources, shards, before)


def _chosen(block: Column) -> Column:
    return (block * F.col("m_step") + F.col("m_shift")) % F.col("m_blocks") < F.col("m_extra")


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of numbers that are not negative, without going through doubles."""
    return F.call_function("div", a, b)


def _edge(block: Column) -> Column:
    """The first word of a block: ceil(block * words / blocks)."""
    return _div(block * F.col("m_words") + F.col("m_blocks") - 1, F.col("m_blocks"))


def placed(sized: DataFrame, mix: Mix) -> DataFrame:
    """Rows of (doc_id, source, size, m_key, ...) with the numbers of their source and shard.

    m_start is the row's first word in its shard; m_extra_words counts the words
    of chosen blocks, besides m_passes whole passes.
    """
    table = _table(sized, mix.shards, SHARD_SCHEMA)
    rows = _in_shards(sized, mix.sources).join(table, ["m_no", "m_shard"], "left")
    order = Window.partitionBy("m_no", "m_shard", "m_part").orderBy("doc_id", "size", "m_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("m_end", F.sum("size").over(order))
    if mix.before is not None:
        rows = rows.join(broadcast_up_to(mix.before, BROADCAST_ROWS), ["m_no", "m_shard", "m_part"]).withColumn("m_end", F.col("m_end") + F.col("m_before"))
    rows = rows.withColumn("m_start", F.col("m_end") - F.col("size"))
    first = _div(F.col("m_start") * F.col("m_blocks"), F.col("m_words"))
    last = _div((F.col("m_end") - 1) * F.col("m_blocks"), F.col("m_words"))

    def part(total: Column, block: Column) -> Column:
        inside = F.least(F.col("m_end"), _edge(block + 1)) - F.greatest(F.col("m_start"), _edge(block))
        return total + F.when(_chosen(block), inside).otherwise(F.lit(0))

    some = F.aggregate(F.sequence(first, last), F.lit(0).cast("long"), part)
    return rows.withColumn("m_extra_words", F.when((F.col("size") > 0) & (F.col("m_extra") > 0), some).otherwise(F.lit(0).cast("long")))


def _columns(text: Column) -> list[Column]:
    """doc_id, source, size, and the hash of the text: rows that agree in all of them are equal but for columns that the mix does not read."""
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64(text).alias("m_key")]


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(*_columns(F.col("text").cast("string")))


def mix_quotas(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``docs`` (doc_id, source, text).

    Null and wordless texts have size 0 and nothing is taken of them.  A null
    source is a source of its own, the last.  Rows that share a doc_id are rows of
    their own.  Other columns are not read; an empty table gives an empty result.
    """
    sized = written(_sized(docs), "sizes")
    mix = plan(sized, **options)
    taken = F.col("size") * F.coalesce("m_passes", F.lit(0)) + F.col("m_extra_words")
    return placed(sized, mix).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, once for each whole pass, and once more with the words of their chosen blocks.

    Rows of which nothing is taken go, null, empty and wordless texts among them.
    A row that is taken in part keeps its words' own white space between them.
    n_chars, where it is a column, follows.  A null source is a source; rows that
    share a doc_id are rows of their own.  Reruns agree.  An empty table stays empty.
    """
    docs, said = neutral(docs, "doc_id", "text", "source", "n_chars"), docs.columns
    names = docs.columns
    mix = plan(written(_sized(docs), "sizes"), **options)
    # A row's text goes through the shuffle once, in the row.
    rows = placed(docs.select(F.struct(*names).alias("m_row"), *_columns(F.col("text").cast("string"))), mix)
    rows = rows.where((F.col("size") > 0) & ((F.col("m_extra_words") > 0) | (F.coalesce("m_passes", F.lit(0)) > 0)))
    text = F.col("m_row")["text"].cast("string")
    words = F.regexp_extract_all(text, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    part = F.array_join(F.filter(words, lambda _, i: _chosen(_div((F.col("m_start") + i) * F.col("m_blocks"), F.col("m_words")))), "")
    part = F.when((F.col("m_extra_words") > 0) & (F.col("m_extra_words") < F.col("size")), F.regexp_replace(part, r"[\x20\x09-\x0D]+$", ""))
    # Null stands for the whole text, so that passes carry no copies of it.
    passes = F.array_repeat(F.lit(None).cast("string"), (F.coalesce("m_passes", F.lit(0)) + (F.col("m_extra_words") == F.col("size")).cast("long")).cast("int"))
    taken = F.when(part.isNotNull(), F.concat(passes, F.array(part))).otherwise(passes)
    rows = rows.select("m_row", F.explode(taken).alias("m_part")).withColumn("m_text", F.coalesce("m_part", text))
    new = {"text": F.col("m_text"), "n_chars": F.length("m_text").cast("long")}
    return rows.select(*[new[c].alias(c) if c in new else F.col("m_row")[c].alias(c) for c in names]).toDF(*said)
