"""Balances, agendas, histories and free slots of the target model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.functions.text import normal_form, normalize_text


def period_totals(entries: DataFrame, period: str = "period") -> DataFrame:
    """(period, total_income, total_expenses, net) of entries (period, type, amount)."""
    part = lambda t: F.sum(F.when(F.col("type") == t, F.col("amount")).otherwise(F.lit(0).cast("decimal(12,2)")))
    return entries.groupBy(period).agg(part("income").alias("total_income"), part("expense").alias("total_expenses")).withColumn("net", F.col("total_income") - F.col("total_expenses"))


def running_balance(totals: DataFrame, period: str = "period") -> DataFrame:
    """Adds opening_balance and closing_balance.  A row for each period: the window has as many rows as the calendar."""
    so_far = Window.orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return totals.withColumn("closing_balance", F.sum("net").over(so_far)).withColumn("opening_balance", F.col("closing_balance") - F.col("net"))


def current_balance(snapshots: DataFrame, entries: DataFrame) -> DataFrame:
    """The latest closed snapshot's balance and what has moved since: one row.

    The snapshot is one row, so the range join is a filter by a broadcast value.
    """
    last = snapshots.where("status = 'closed'").orderBy(F.desc("period_end")).limit(1).select("period_end", "closing_balance")
    zero = F.lit(0).cast("decimal(12,2)")
    part = lambda t: F.coalesce(F.sum(F.when(F.col("type") == t, F.col("amount"))), zero)
    joined = F.broadcast(last).join(entries, entries["date"] > last["period_end"], "right").where("period_end is not null")
    moved = joined.groupBy().agg(part("income").alias("income"), part("expense").alias("expense"))
    return last.join(moved).select("period_end", (F.col("closing_balance") + F.col("income") - F.col("expense")).alias("balance"))


def agenda(appointments: DataFrame, *by: str, day: str = "day", status: tuple[str, ...] | None = None) -> DataFrame:
    """Appointments a day for each value of ``by``; only those of the given states, if any are given."""
    rows = appointments if status is None else appointments.where(F.col("status").isin(*status))
    return rows.groupBy(*by, day).agg(F.count("*").alias("n"))


def search_names(people: DataFrame, name: str, *columns: str) -> DataFrame:
    """Rows whose normal form of ``columns``, joined by blanks, has every word of ``name`` at the beginning of a word.

    Case and accents make no difference; a name without letters finds nothing.
    """
    said = F.concat(F.lit(" "), F.concat_ws(" ", *[normalize_text(F.col(c)) for c in columns]))
    words = normal_form(name).split()
    found = F.lit(bool(words))
    for word in words:
        found = found & said.contains(f" {word}")
    return people.where(found)


def search_document(people: DataFrame, number: str, column: str = "doc_number") -> DataFrame:
    """Rows of a document's number; blanks and punctuation make no difference.  The number as written is a filter that reaches the scan."""
    plain = lambda x: F.regexp_replace(x, r"[\s.\-/]+", "")
    return people.where((F.col(column) == number) | (plain(F.col(column)) == plain(F.lit(number))))


def history(rows: DataFrame, key: str, at: str, tie: str, most: int | None = None) -> DataFrame:
    """All rows of every key, or the newest ``most``, with their place."""
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(at), F.desc(tie))))
    return placed if most is None else placed.where(F.col("place") <= most)


def free_slots(slots: DataFrame, taken: DataFrame, *on: str) -> DataFrame:
    """Slots that nothing takes."""
    return slots.join(taken.select(*on), list(on), "left_anti")
