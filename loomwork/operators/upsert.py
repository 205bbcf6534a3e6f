"""Rows of a table changed by newer rows of the same keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(current: DataFrame, changes: DataFrame, key: str, *, at: Column | None = None) -> DataFrame:
    """``current`` with the rows of ``changes`` put in: new keys are added, known keys take the new values.

    ``current`` has created_at and updated_at; ``changes`` has the key and any of
    the other columns, a row for each key.  A row whose values really change gets
    ``at`` (now) as updated_at; a new row as both; any other row stays as it is.
    Nulls are values.  One shuffle by the key.
    """
    at = F.current_timestamp() if at is None else at
    values = [c for c in changes.columns if c != key]
    new = changes.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in values], F.lit(True).alias("_new"))
    rows = current.withColumn("_old", F.lit(True)).join(new, F.col(key) == F.col("_key"), "full")
    known, given = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    changed = F.lit(False)
    for c in values:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    changed = given & changed
    out = []
    for c in current.columns:
        if c == key:
            column = F.coalesce(key, "_key")
        elif c == "created_at":
            column = F.when(known, F.col(c)).otherwise(at)
        elif c == "updated_at":
            column = F.when(known & ~changed, F.col(c)).otherwise(at)
        elif c in values:
            column = F.when(given, F.col(f"_{c}")).otherwise(F.col(c))
        else:
            column = F.col(c)
        out.append(column.alias(c))
    return rows.select(*out)
