"""SQL text dumps as DataFrames.

dump_scan cuts files into lists of values and other statements, block by block, so
an INSERT of any length is read by many tasks.  They are written once, in a folder
for each table, and every table reads its own.  Tuples and values come out of a
list by regular expressions with possessive quantifiers, in the JVM.  Only the
CREATE TABLE statements are parsed on the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.text import unescape_sql
from loomwork.scratch import written

from .dump_scan import cut_dump

# Tables of the legacy system that are read, and those that are left out.
IN_SCOPE = ("caja", "cirugias", "fichas", "historiaclinica", "inst_doctor", "inst_horarios", "inst_motivo", "inst_obrasoc", "inst_turnos")
EXCLUDED = ("inst_alt", "medias", "ventamedias")

_LITERAL = r"'(?:[^'\\]++|\\.)*+'"
_TUPLE = rf"(?s)\((?:{_LITERAL}|[^'()]++)*+\)"
_VALUE = rf"(?s)((?:{_LITERAL}|[^',]++)*+),"
_NO_COLUMN = ("PRIMARY", "UNIQUE", "INDEX", "KEY", "CONSTRAINT", "FOREIGN", "FULLTEXT", "CHECK")


@dataclass
class Dump:
    """Tables by name, columns as text; null, empty and 0 stay apart.  Names by class."""

    tables: dict[str, DataFrame]
    in_scope: list[str] = field(default_factory=list)
    excluded: list[str] = field(default_factory=list)
    unknown: list[str] = field(default_factory=list)


def parse_create(statement: str) -> tuple[str, list[str]] | None:
    """Table and columns of a CREATE TABLE statement, however it is laid out in lines."""
    head = re.match(r"\s*CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?`?([^`\s(]+)`?\s*\(", statement, re.IGNORECASE)
    if not head:
        return None
    parts, depth, quote, start = [], 0, "", head.end()
    for k in range(head.end(), len(statement)):
        c = statement[k]
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif c == "(":
            depth += 1
        elif c == ")" and depth:
            depth -= 1
        elif c in ",)" and not depth:
            parts.append(statement[start:k].strip())
            start = k + 1
            if c == ")":
                break
    words = [re.match(r"`([^`]+)`|([^\s(]+)", p) for p in parts if p]
    return head[1], [w[1] or w[2] for w in words if w and not (w[2] and w[2].upper() in _NO_COLUMN)]


def statements(spark: SparkSession, path: str, *, block_bytes: int | None = None) -> DataFrame:
    """(statement, table) rows: lists of values with the table that they are for, and other statements with a null table.

    Statements come without the comments, locks and blanks before them.  A piece
    that does not begin as a statement does, or a literal without an end, fails the
    read: nothing is left out in silence.
    """
    return written(cut_dump(spark, path, block_bytes=block_bytes), "dump-statements", by="table")


def literal(value):
    """Null for NULL, the content of a quoted literal, anything else as it is."""
    x = F.trim(value)
    return F.when(F.lower(x) == "null", None).when(x.startswith("'"), unescape_sql(F.substring(x, F.lit(2), F.length(x) - 2))).otherwise(x)


def read_mysql_dump(spark: SparkSession, path: str, *, in_scope: tuple[str, ...] = IN_SCOPE, excluded: tuple[str, ...] = EXCLUDED, block_bytes: int | None = None) -> Dump:
    """All tables of a dump that have a CREATE TABLE statement; a row of another length than its table fails the read.

    The first definition of a table counts.  Rows for tables without a definition
    and for excluded tables are not read.  A column list after the table's name is
    ignored: values go by position.  Files are read in blocks of ``block_bytes``, the
    session's setting if that is not given; a statement of any length takes many.
    """
    every = statements(spark, path, block_bytes=block_bytes)
    defined: dict[str, list[str]] = {}
    # Definitions are a handful of short statements.
    for row in every.where(F.col("table").isNull() & F.col("statement").rlike(r"(?i)\ACREATE\s+TABLE")).collect():
        found = parse_create(row.statement)
        if found:
            defined.setdefault(*found)
    rest = F.regexp_replace("statement", _TUPLE, "")
    whole = F.when(rest.rlike(r"\A[\s,]*+(?:(?i)ON\s+DUPLICATE\s+KEY\b|\z)"), F.col("statement")).otherwise(F.raise_error(F.concat("table", F.lit(": no list of values: "), F.substring(F.trim(rest), 1, 60))).cast("string"))
    rows = every.where("table is not null").select("table", F.explode(F.regexp_extract_all(whole, F.lit(_TUPLE), F.lit(0))).alias("tuple"))
    values = F.regexp_extract_all(F.concat(F.expr("substring(tuple, 2, length(tuple) - 2)"), F.lit(",")), F.lit(_VALUE), F.lit(1))
    rows = rows.select("table", values.alias("values"))

    def table(name: str) -> DataFrame:
        columns = defined[name]
        n = len(columns)
        message = F.format_string(f"{name}: a row has %d values for {n} columns", F.size("values"))
        checked = F.when(F.size("values") == n, F.col("values")).otherwise(F.raise_error(message).cast("array<string>"))
        own = rows.where(F.col("table") == name).select(checked.alias("v"))
        return own.select(*[literal(F.col("v")[k]).alias(c) for k, c in enumerate(columns)])

    read = [t for t in defined if t not in excluded]
    return Dump(
        {t: table(t) for t in read},
        [t for t in defined if t in in_scope],
        [t for t in defined if t in excluded],
        [t for t in defined if t not in in_scope and t not in excluded],
    )


def parse_mysql_dump(spark: SparkSession, path: str) -> dict:
    """Table names and row count of a dump."""
    dump = read_mysql_dump(spark, path)
    return {"tables": sorted(dump.tables), "records": sum(df.count() for df in dump.tables.values())}


def counted_classes(dump: Dump) -> DataFrame:
    """(name, class, n): the tables of a dump, their class, and the rows of those that are read, counted in one job."""
    spark = next(iter(dump.tables.values())).sparkSession
    names = spark.createDataFrame([(t, c) for c in ("in_scope", "excluded", "unknown") for t in getattr(dump, c)], "name string, class string")
    rows = None
    for name, df in dump.tables.items():
        own = df.select(F.lit(name).alias("name"))
        rows = own if rows is None else rows.unionByName(own)
    return names.join(rows.groupBy("name").agg(F.count("*").alias("n")), "name", "left").select("name", "class", F.coalesce("n", F.lit(0)).cast("int").alias("n"))


def _said(df: DataFrame, escape_breaks: bool) -> Column:
    """The rows' values as a dump says them, in brackets."""
    escapes = {"\\": "\\\\", "'": "\\'"} | ({"\n": "\\n", "\r": "\\r"} if escape_breaks else {})

    def quoted(c: str):
        x = F.col(c).cast("string")
        for plain, escaped in escapes.items():
            x = F.replace(x, F.lit(plain), F.lit(escaped))
        return F.concat(F.lit("'"), x, F.lit("'"))

    said = [F.coalesce(quoted(c) if t == "string" else F.col(c).cast("string"), F.lit("NULL")) for c, t in df.dtypes]
    return F.concat(F.lit("("), F.concat_ws(",", *said), F.lit(")"))


def _definition(df: DataFrame, table: str) -> str:
    body = ",\n".join(f"  `{c}` text" for c in df.columns)
    return f"-- structure\nCREATE TABLE `{table}` (\n{body},\n  PRIMARY KEY (`{df.columns[0]}`)\n) ENGINE=InnoDB"


def rendered(df: DataFrame, table: str, *, escape_breaks: bool = True) -> DataFrame:
    """(value) rows that say ``df`` as a dump does: the definition, then an INSERT a row; for tests and exports."""
    rows = df.select(F.concat(F.lit(f"INSERT INTO `{table}` VALUES "), _said(df, escape_breaks)).alias("value"))
    return df.sparkSession.createDataFrame([(_definition(df, table),)], "value string").unionByName(rows)


def write_extended(df: DataFrame, table: str, path: str, *, escape_breaks: bool = True) -> None:
    """Add ``df`` to the dump in a folder: its definition, and a file for each partition with one INSERT for all its rows, in one line."""
    df.sparkSession.createDataFrame([(_definition(df, table),)], "value string").write.mode("append").option("lineSep", ";\n").text(path)
    # The first row of a partition has a number whose lower 33 bits are 0.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    rows = df.select(F.concat(F.when(first, f"INSERT INTO `{table}` VALUES ").otherwise(""), _said(df, escape_breaks)).alias("value"))
    rows.write.mode("append").option("lineSep", ",").text(path)
