"""Queries of what stands around a load: its report in files, resets, settings, and errors of dumps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.catalog_load import dump_of
from loomwork.plans import report as R
from loomwork.plans.config import load_config
from loomwork.plans.ledger import Ledger
from loomwork.plans.pipeline import SCHEMAS
from loomwork.plans.store import TableStore
from loomwork.registry import Tables, query
from loomwork.scratch import shared_path
from loomwork.sources.mysqldump import parse_mysql_dump, read_mysql_dump, rendered


def _each(df: DataFrame, schema: str, say: Callable[..., tuple]) -> DataFrame:
    """A row of ``schema`` for each row of ``df``, from a function of its columns."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([say(*r) for r in frame.itertuples(index=False)], columns=names)

    return df.mapInPandas(run, schema)


@query("dump_parse_counts", "SELECT 'nation,part' AS tables, (SELECT count(*) FROM nation) + (SELECT count(*) FROM part) AS records")
def _(t: Tables) -> DataFrame:
    """Table names and the number of rows of a dump."""
    found = parse_mysql_dump(t.spark, dump_of(t.spark, {"nation": t.nation, "part": t.part}))
    return t.spark.createDataFrame([(",".join(found["tables"]), found["records"])], "tables string, records long")


@query("dump_arity_error", "SELECT 4 AS columns, CAST(NULL AS VARCHAR) AS error, count(*) AS n FROM part UNION ALL SELECT 3, 'part: a row has 4 values for 3 columns', 0")
def _(t: Tables) -> DataFrame:
    """A row of another length than its table's definition fails the read and says so."""
    rows, out = t.part.select("p_partkey", "p_name", "p_brand", "p_size"), []
    for columns in (4, 3):
        path = shared_path(t.spark, "dump")
        # The definition of a narrower table, the rows of the wide one.
        rendered(rows.select(*rows.columns[:columns]).where("false"), "part").unionByName(rendered(rows, "part").where("value like 'INSERT%'")).write.option("lineSep", ";\n").text(path)
        try:
            out.append((columns, None, read_mysql_dump(t.spark, path).tables["part"].where("p_partkey is not null").count()))
        except Exception as e:  # what a user gets to see
            said = next((x for x in str(e).splitlines() if "a row has" in x), str(e))
            out.append((columns, said[said.find("part:") :].split(" SQLSTATE")[0], 0))
    return t.spark.createDataFrame(out, "columns int, error string, n long")


@query(
    "reset_modes",
    "SELECT * FROM (VALUES ('none', 1, 1), ('log-only', 0, 1), ('full', 0, 0)) v(mode, a, b), LATERAL (SELECT CAST(a * count(*) AS BIGINT) AS entries, CAST(b * count(*) AS BIGINT) AS rows FROM customer)".replace("SELECT *", "SELECT mode, entries, rows", 1),
)
def _(t: Tables) -> DataFrame:
    """What each reset leaves of the ledger and of a target table."""
    store, out = TableStore(t.spark, shared_path(t.spark, "target")), []
    ledger = Ledger(store)
    now, none = F.current_timestamp(), lambda c: F.lit(None).cast(c)
    columns = [c.split(" ", 1) for c in SCHEMAS["patients"].split(", ")]
    said = {"id": F.col("c_custkey"), "last_name": F.col("c_name")}
    store.append("patients", t.customer.select(*[said.get(name, none(kind)).cast(kind).alias(name) for name, kind in columns]))
    ledger.record(t.customer.select(F.lit("fichas").alias("source_table"), F.col("c_custkey").cast("string").alias("source_pk"), F.lit("patients").alias("target_table"), F.col("c_custkey").cast("long").alias("target_id"), F.lit("migrated").alias("status"), F.lit("").alias("payload_hash"), now.alias("migrated_at")))
    for mode in ("none", "log-only", "full"):
        ledger.reset(mode)
        out.append((mode, ledger.entries().count(), store.read("patients", SCHEMAS["patients"]).count()))
    return t.spark.createDataFrame(out, "mode string, entries long, rows long")


def _report(t: Tables) -> dict:
    """The report of events made of the orders; a table's name holds a sign that Markdown must escape."""
    kind = F.when(F.col("o_orderstatus") == "F", "migrated").when(F.col("o_orderstatus") == "O", "warning").otherwise("error")
    table = F.when(F.col("o_orderkey") % 2 == 0, "even|orders").otherwise("odd orders")
    audit = t.orders.select(table.alias("table"), F.col("o_orderkey").cast("string").alias("source_id"), kind.alias("type"), F.lit("a | b").alias("message"), F.lit(None).cast("string").alias("details"))
    began = datetime(2024, 2, 29, 23, 59, 59, tzinfo=timezone.utc)
    return R.build(audit, began, datetime(2024, 3, 1, 1, 1, 1, tzinfo=timezone.utc), excluded=["medias"], unknown=[])


_COUNTED = "WITH e AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'even|orders' ELSE 'odd orders' END AS t, CASE o_orderstatus WHEN 'F' THEN 'migrated' WHEN 'O' THEN 'warning' ELSE 'error' END AS type FROM orders), c AS (SELECT coalesce(t, 'total') AS name, count(*) FILTER (WHERE type = 'migrated') AS migrated, count(*) FILTER (WHERE type = 'warning') AS warning, count(*) FILTER (WHERE type = 'error') AS error FROM e GROUP BY ROLLUP (t))"


@query("report_json", _COUNTED + " SELECT name, migrated, warning, error, '1h 1m 2s' AS duration, '2024-02-29T23:59:59+00:00' AS started_at FROM c")
def _(t: Tables) -> DataFrame:
    """The JSON report, written and read back by Spark."""
    path = shared_path(t.spark, "report")
    t.spark.createDataFrame([(R.to_json(_report(t)),)], "value string").write.text(path)
    schema = "started_at string, duration string, tables array<struct<table: string, migrated: long, warning: long, error: long>>"
    read = t.spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("r")).select("r.started_at", "r.duration", F.explode("r.tables").alias("c"))
    return read.select(F.col("c.table").alias("name"), "c.migrated", "c.warning", "c.error", "duration", "started_at")


@query("report_markdown", _COUNTED + " SELECT replace(name, '|', '\\|') AS name, CAST(migrated AS VARCHAR) AS migrated, CAST(warning AS VARCHAR) AS warning FROM c")
def _(t: Tables) -> DataFrame:
    """The counts of the Markdown report's first table, its lines taken apart at bars that are not escaped."""
    lines = t.spark.createDataFrame([(R.to_markdown(_report(t)),)], "text string").select(F.explode(F.split("text", "\n")).alias("line"))
    cells = F.split("line", r"(?<!\\)\|")
    rows = lines.select(cells.alias("c")).where((F.size("c") == 2 + 1 + len(R.COUNTERS)) & ~F.trim(F.col("c")[1]).isin("table", "---"))
    at = {name: 2 + k for k, name in enumerate(R.COUNTERS)}
    return rows.select(F.trim(F.col("c")[1]).alias("name"), *[F.trim(F.col("c")[at[c]]).alias(c) for c in ("migrated", "warning")])


@query("report_file_names", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, 'migration-report-%Y%m%d-000000.json') AS json, strftime(o_orderdate, 'migration-report-%Y%m%d-000000.md') AS markdown FROM orders")
def _(t: Tables) -> DataFrame:
    """The names of a report's files at the beginning of each day that has an order."""
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return _each(days, "day date, json string, markdown string", lambda day: (day, *R.file_names(datetime(day.year, day.month, day.day))))


@query("report_durations", "SELECT o_orderkey, CASE WHEN s >= 3600 THEN s // 3600 || 'h ' ELSE '' END || CASE WHEN s >= 60 THEN s // 60 % 60 || 'm ' ELSE '' END || s % 60 || 's' AS took FROM (SELECT o_orderkey, CAST(floor(o_totalprice / 20) AS BIGINT) AS s FROM orders)")
def _(t: Tables) -> DataFrame:
    """A twentieth of each order's price as a duration in seconds."""
    return _each(t.orders.select("o_orderkey", (F.col("o_totalprice").cast("double") / 20).alias("s")), "o_orderkey long, took string", lambda key, s: (key, R.duration(s)))


@query(
    "config_thresholds",
    """WITH v AS (SELECT DISTINCT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount * 12 END AS confidence, l_tax * 12 AS minimum, l_linenumber % 3 AS kind FROM lineitem),
 g AS (SELECT confidence, minimum, kind, CASE kind WHEN 0 THEN 0.75 ELSE minimum END AS used, coalesce(confidence, 0.92) AS sure FROM v)
 SELECT confidence, minimum, kind, CASE WHEN kind = 1 THEN 'margin is no number: x' WHEN sure > 1 THEN 'confidence must be from 0 to 1' WHEN used > sure THEN 'minimum must not exceed confidence' ELSE 'fine' END AS outcome FROM g""",
)
def _(t: Tables) -> DataFrame:
    """Settings from text: blank ones take their default, odd ones are refused before anything starts."""
    values = t.lineitem.select(F.when(F.col("l_linenumber") != 7, F.col("l_discount").cast("double") * 12).alias("confidence"), (F.col("l_tax").cast("double") * 12).alias("minimum"), (F.col("l_linenumber") % 3).cast("int").alias("kind")).distinct()

    def outcome(confidence: float, minimum: float, kind: int) -> tuple:
        given = ["--dump=d", "--target", "t", "--confidence=" + ("  " if pd.isna(confidence) else repr(float(confidence)))]
        try:
            load_config(given, ({} if kind == 0 else {"LOOMWORK_MINIMUM": repr(float(minimum))}) | ({"LOOMWORK_MARGIN": "x"} if kind == 1 else {}))
            said = "fine"
        except ValueError as e:
            said = str(e)
        return None if pd.isna(confidence) else confidence, minimum, kind, said

    return _each(values, "confidence double, minimum double, kind int, outcome string", outcome)
