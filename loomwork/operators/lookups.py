"""Vocabularies: distinct values, first spelling of a normal form, ids, resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.functions.text import blank_to_null, normalize_text
from loomwork.scratch import written


def vocabulary(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of several columns that are not blank."""
    return df.select(F.explode(F.array(*[blank_to_null(F.col(c)) for c in columns])).alias("value")).where("value is not null").distinct()


def first_spelling(df: DataFrame, value: str, *order: str) -> DataFrame:
    """(norm, value, spellings): for each normal form the first value in ``order``, and how many spellings it has.

    One aggregation with a minimum over (order, value): no window, no sort.
    """
    return df.groupBy(normalize_text(F.col(value)).alias("norm")).agg(F.min(F.struct(*order, value)).alias("first"), F.countDistinct(value).alias("spellings")).select("norm", F.col("first")[value].alias(value), "spellings")


def with_ids(df: DataFrame, *order: str, start: int | Column = 0, name: str = "id") -> DataFrame:
    """Consecutive ids after ``start`` in an order, without gathering the rows in one task.

    Rows are cut into ranges, sorted and written once, each with its range and its
    place in it; a range's ids start after the rows of those before it.  Counts
    and rows come from the same written table: a range exchange that ran twice
    could draw other bounds the second time.  Rows that tie in ``order`` get
    their ids in any order among themselves.  A row for each range is broadcast.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # Within a partition these go up by one from partition * 2^33.
    rows = written(parts.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = rows.groupBy(part.alias("_part")).agg((F.max(place) + 1).alias("n"))
    before = counts.select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return rows.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn(name, (F.lit(start) + F.col("_before") + place + 1).cast("long")).drop("_part", "_before", "_at")


def next_id(df: DataFrame, column: str = "id") -> int:
    return int(df.agg(F.coalesce(F.max(column), F.lit(0))).first()[0])


def resolve(df: DataFrame, column: str, lookup: DataFrame, *, into: str) -> DataFrame:
    """``df`` with the id of the lookup's entry of the same normal form, or null.

    ``lookup`` has id and norm, a row for each norm; Spark broadcasts it when it
    is small, and joins by a shuffle when it is not.
    """
    found = lookup.select(F.col("id").alias(into), F.col("norm").alias("_norm"))
    return df.withColumn("_norm", normalize_text(F.col(column))).join(found, "_norm", "left").drop("_norm")


def in_order(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """(key, value, order_index) of the columns that are not blank; a value that repeats keeps its first place."""
    rows = df.select(key, F.posexplode(F.array(*[blank_to_null(F.col(c)) for c in columns])).alias("pos", "value")).where("value is not null")
    return rows.groupBy(key, "value").agg((F.min("pos") + 1).cast("int").alias("order_index"))
