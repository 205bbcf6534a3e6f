"""SQL dumps cut into statements and lists of values by many tasks, inside statements too.

Dump tools write one INSERT for thousands of rows, in one line.  So a file is not
read by lines or statements: Spark cuts it into blocks, and each block's task reads
on from the first closing bracket in it.  Whether a block begins inside a literal
or a comment depends on all blocks before it.  A first pass finds for each block
where each possible state leads; these maps, composed in the blocks' order, give
each block's true state.  A second pass cuts the block at semicolons and between
tuples, outside literals and comments.  What lies before a block's first cut and
after its last is put together across blocks, by their places in the file; and a
block whose statement began earlier takes that statement's table from the block
where it began.

Memory is that of a batch and of the longest stretch without a cut, which is a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.scratch import written

PLAIN, LITERAL, LINE, BLOCK, NAME = range(5)
#: What opens a state, and what ends it.
_OPENS = {LITERAL: b"'", LINE: b"#", BLOCK: b"/*", NAME: b"`"}
_ENDS = {LITERAL: re.compile(rb"(?s:[^'\\]++|\\.)*+'"), LINE: re.compile(rb"[^\n]*+\n"), BLOCK: re.compile(rb"(?s:.)*?\*/"), NAME: re.compile(rb"[^`]*+`")}
_WHOLE = rb"'(?s:[^'\\]++|\\.)*+'|`[^`]*+`|/\*(?s:.*?)\*/|(?:--(?=\s)|#)[^\n]*+\n|/(?!\*)|-(?!-\s)"
_ALL_PLAIN = re.compile(rb"(?:[^'`/#-]++|" + _WHOLE + rb")*+")
_NEXT_CUT = re.compile(rb"(?:[^'`/#;)-]++|" + _WHOLE + rb"|\)(?!\s*+,\s*+\())*+(?:(;)|\)\s*+,\s*+(?=\())")
_LEADING = re.compile(rb"(?i)(?:\s++|(?:--|#)[^\n]*+(?:\n|\Z)|/\*(?s:.*?)\*/;?|(?:UN)?LOCK TABLES[^\n;]*+;?|;)*+")
_INSERT = re.compile(rb"(?is)(?:INSERT(?:\s++IGNORE)?|REPLACE)\s++INTO\s++`?([^`\s(]++)`?[^']*?\bVALUES\s*+")
#: Lists of values are given out in parts of so many bytes, of one tuple at least.
PART_BYTES = 65_536
#: Stands for the table of a statement that is no INSERT.
OTHER = b""


def state_after(text: bytes, state: int) -> int:
    """The state behind a text that begins in ``state``; the text ends at a closing bracket, so no sign is cut in two."""
    at = 0
    if state != PLAIN:
        end = _ENDS[state].match(text)
        if not end:
            return state
        at = end.end()
    rest = text[_ALL_PLAIN.match(text, at).end() :][:1]
    return {b"": PLAIN, b"'": LITERAL, b"`": NAME, b"/": BLOCK}.get(rest, LINE)


class Cutter:
    """Cuts one block's text, which comes in order; pieces are (kind, table, text).

    Kinds: part (a list of values of table, null if its statement began in an
    earlier block), statement, head (all before the first cut of a block that
    begins inside a statement), middle (a block without a cut), and what follows the
    last cut: fresh (behind a statement's end), known (inside a statement of the
    table), carried (inside a statement that began in an earlier block).
    """

    def __init__(self, first: bool, state: int = PLAIN):
        self.rest = _OPENS.get(state, b"") if not first else b""
        self.added = len(self.rest)
        # inside: the block's start belongs to a statement that is not known yet.
        self.inside, self.table, self.fresh = not first, None, first
        self.part = b""

    def feed(self, text: bytes) -> Iterator[tuple[str, bytes | None, bytes]]:
        text = self.rest + text if self.rest else text
        at = 0
        while m := _NEXT_CUT.match(text, at):
            ends = m[1] is not None
            # A cut between tuples counts inside lists of values only; the start of a statement tells which it is.
            if not ends and self.fresh and not _INSERT.match(text, _LEADING.match(text, at).end()):
                end = self._end_of_statement(text, m.end())
                if end < 0:
                    break
                yield from self._other(text[at:end])
                at = end
                continue
            piece = text[at : m.end()]
            at = m.end()
            if self.inside:
                yield "head", None, piece[self.added :]
                self.inside, self.added, self.fresh = False, 0, ends
                continue
            yield from self._piece(piece, ends)
        self.rest = text[at:]

    @staticmethod
    def _end_of_statement(text: bytes, at: int) -> int:
        while m := _NEXT_CUT.match(text, at):
            at = m.end()
            if m[1] is not None:
                return at
        return -1

    def _other(self, piece: bytes) -> Iterator[tuple[str, bytes | None, bytes]]:
        body = piece[_LEADING.match(piece).end() :]
        if body:
            yield "statement", None, body
        self.fresh, self.table = True, OTHER

    def _piece(self, piece: bytes, ends: bool) -> Iterator[tuple[str, bytes | None, bytes]]:
        if self.fresh:
            at = _LEADING.match(piece).end()
            found = _INSERT.match(piece, at)
            if not found:
                yield from self._other(piece)
                return
            self.table, piece, self.fresh = found[1], piece[found.end() :], False
        self.part += piece
        if ends or len(self.part) >= PART_BYTES:
            yield from self._flush()
        if ends:
            self.fresh, self.table = True, OTHER

    def _flush(self) -> Iterator[tuple[str, bytes | None, bytes]]:
        if self.part:
            yield "part", self.table, self.part
        self.part = b""

    def close(self) -> Iterator[tuple[str, bytes | None, bytes]]:
        """The rest of the block; its table tells what statement the block ends in."""
        yield from self._flush()
        if self.inside:
            yield "middle", None, self.rest[self.added :]
        else:
            yield "fresh" if self.fresh else "carried" if self.table is None else "known", None if self.fresh else self.table, self.rest


def whole_pieces(text: bytes, table: bytes | None, fresh: bool) -> tuple[list[tuple[str, bytes | None, bytes]], bytes | None]:
    """Pieces of a text put together across blocks, from a cut on; and the table of the statement that it ends in."""
    own = Cutter(True)
    own.fresh, own.table = fresh, table
    out, rest = list(own.feed(text)), own.rest
    if own.fresh:
        # The end of the file, where a semicolon can lack.
        at = _LEADING.match(rest).end()
        found = _INSERT.match(rest, at)
        if found:
            own.table, own.fresh, rest = found[1], False, rest[found.end() :]
        else:
            out += own._other(rest)
            rest = b""
    if own.part + rest and not own.fresh:
        out.append(("part", own.table, own.part + rest))
    return out, OTHER if own.fresh else own.table


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes, bool]]:
    """((file, block, ...), text, whether it is the block's last) in the order of the file, each closing bracket put back."""
    key, texts = None, []
    for batch in batches:
        others = [batch.column(c).to_pylist() for c in batch.schema.names if c != "value"]
        values = batch.column("value").to_pylist()
        start = 0
        keys = list(zip(*others, strict=True))
        for k in range(1, len(keys) + 1):
            if k == len(keys) or keys[k] != keys[start]:
                if key is not None and key != keys[start]:
                    yield key, b"", True
                key = keys[start]
                texts = values[start:k]
                yield key, b")".join(texts) + b")", False
                start = k
    if key is not None:
        yield key, b"", True


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, size = list(range(5)), 0
    for (file, block, file_size), text, last in _blocks(batches):
        if not last:
            to = {s: state_after(text, s) for s in set(now)}
            now, size = [to[s] for s in now], size + len(text)
            continue
        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block], pa.int64()), pa.array([file_size], pa.int64()), pa.array([now], pa.list_(pa.int32())), pa.array([size], pa.int64())], names=["file", "block", "file_size", "leads_to", "bytes"])
        now, size = list(range(5)), 0


def _true_states(blocks: pd.DataFrame) -> pd.DataFrame:
    """Each block's state at its start, of one file; whether a bracket was put behind the file's end."""
    blocks = blocks.sort_values("block")
    state, out = PLAIN, []
    for leads_to in blocks["leads_to"]:
        out.append(state)
        state = int(leads_to[state])
    if state == LITERAL:
        raise ValueError(f"{blocks['file'].iloc[0]}: a literal has no end")
    blocks = blocks.assign(state=out)
    blocks["spare"] = 0
    blocks.loc[blocks.index[-1], "spare"] = int(blocks["bytes"].sum() - blocks["file_size"].iloc[0])
    return blocks[["file", "block", "state", "spare"]]


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter, spare = None, b""
    for (file, block, state, extra), text, last in _blocks(batches):
        out = []
        if cutter is None:
            cutter = Cutter(block == 0, state)
        if not last:
            # The bracket that may stand behind the file's end is held back.
            text, spare = spare + text[:-1], text[-1:]
            out = list(cutter.feed(text))
        else:
            out = [*cutter.feed(b"" if extra else spare), *cutter.close()]
            cutter, spare = None, b""
        if out:
            yield _as_batch({"file": [file] * len(out), "block": [block] * len(out)}, out)


def _as_batch(keys: dict[str, list], pieces: list[tuple[str, bytes | None, bytes]]) -> pa.RecordBatch:
    columns = {k: pa.array(v, pa.string() if k == "file" else pa.int64()) for k, v in keys.items()}
    columns |= {"kind": pa.array([k for k, _, _ in pieces], pa.string()), "table": pa.array([t and t.decode() for _, t, _ in pieces], pa.string()), "text": pa.array([x for _, _, x in pieces], pa.binary())}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of each chain, and an ``end`` with the table of the statement that it ends in."""
    for batch in batches:
        for r in batch.to_pylist():
            table = r["table"] and r["table"].encode()
            out, end = whole_pieces(b"".join(r["texts"]), table, r["kind"] == "fresh")
            out.append(("end", end, b""))
            yield _as_batch({"file": [r["file"]] * len(out), "block": [r["chain"]] * len(out)}, out)


@contextmanager
def _blocks_of(spark: SparkSession, most_bytes: int | None) -> Iterator[None]:
    """While it lasts, files are cut into blocks of so many bytes."""
    settings = dict.fromkeys(("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"), most_bytes) if most_bytes else {}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def cut_dump(spark: SparkSession, path: str, *, block_bytes: int | None = None) -> DataFrame:
    """(statement, table) rows: lists of values with their table, and other statements with a null table.

    Comments, locks and blanks before a statement are left out.  A literal without
    an end fails the read; so does a statement that is no INSERT, holds a list of
    lists and goes over several blocks.
    """
    source = spark.read.text(path, lineSep=")")
    records = source.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("file_size"))
    with _blocks_of(spark, block_bytes):
        states = written(records.select("value", "file", "block", "file_size").mapInArrow(_states, "file string, block long, file_size long, leads_to array<int>, bytes long"), "dump-states")
    # A row a block: some thousands for a terabyte.
    known = {(r.file, r.block): (r.state, r.spare) for r in states.groupBy("file").applyInPandas(_true_states, "file string, block long, state int, spare int").collect()}
    shared = spark.sparkContext.broadcast(known)

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def with_states() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of = [shared.value[key] for key in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("value"), batch.column("file"), batch.column("block"), pa.array([s for s, _ in of], pa.int32()), pa.array([x for _, x in of], pa.int32())], names=["value", "file", "block", "state", "spare"])

        return _cuts(with_states())

    with _blocks_of(spark, block_bytes):
        pieces = written(records.select("value", "file", "block").mapInArrow(cuts, "file string, block long, kind string, table string, text binary"), "dump-pieces")
    # What follows a block's last cut goes on up to the first cut of a later block: a chain, named by the block where it begins.
    edges = pieces.where("kind in ('head', 'middle', 'fresh', 'known', 'carried')")
    chain_of: dict[tuple[str, int], int] = {}
    begins: dict[tuple[str, int], tuple[str, str | None]] = {}
    at: dict[str, int] = {}
    for r in edges.where("kind <> 'head'").select("file", "block", "kind", "table").orderBy("file", "block").collect():
        chain_of[r.file, r.block] = at.get(r.file, -1)
        if r.kind != "middle":
            at[r.file] = r.block
            begins[r.file, r.block] = r.kind, r.table
    if not begins:
        return _checked(pieces.where("false").select("kind", "table", "text"))
    names = spark.createDataFrame([(f, b, c) for (f, b), c in chain_of.items()], "file string, block long, before long")
    own = edges.join(names, ["file", "block"]).select("file", F.when(F.col("kind").isin("head", "middle"), F.col("before")).otherwise(F.col("block")).alias("chain"), "block", F.when(F.col("kind") == "head", 0).otherwise(1).alias("sub"), "kind", "table", "text")
    joined = own.groupBy("file", "chain").agg(F.array_sort(F.collect_list(F.struct("block", "sub", "kind", "table", "text"))).alias("parts"))
    joined = joined.select("file", "chain", F.col("parts")[0]["kind"].alias("kind"), F.col("parts")[0]["table"].alias("table"), F.transform("parts", lambda p: p["text"]).alias("texts"))
    closed = written(joined.mapInArrow(_chains, "file string, block long, kind string, table string, text binary"), "dump-chains")
    # The table of the statement in which each chain ends; a chain inside a carried statement has that of the chain before it.
    table_of: dict[tuple[str, int], str | None] = {}
    last: dict[str, str | None] = {}
    for r in closed.where("kind = 'end'").select("file", "block", "table").orderBy("file", "block").collect():
        last[r.file] = table_of[r.file, r.block] = last.get(r.file) if r.table is None else r.table
    carried = [(f, b, table_of.get((f, c)), "block") for (f, b), c in chain_of.items()]
    carried += [(f, b, table_of.get((f, chain_of[f, b])), "chain") for f, b in table_of]
    carried = spark.createDataFrame(carried, "file string, block long, carried string, source string")
    every = pieces.where("kind in ('part', 'statement')").withColumn("source", F.lit("block")).unionByName(closed.where("kind in ('part', 'statement')").withColumn("source", F.lit("chain")))
    open_ = (F.col("kind") == "part") & F.col("table").isNull()
    taken = every.where(open_).drop("table").join(carried.withColumnRenamed("carried", "table"), ["file", "block", "source"])
    return _checked(every.where(~open_).select("kind", "table", "text").unionByName(taken.select("kind", "table", "text")))


def _checked(pieces: DataFrame) -> DataFrame:
    text = F.regexp_replace(F.col("text").cast("string"), r"[\s;]++\z", "")
    no_insert = (F.col("kind") == "part") & (F.coalesce("table", F.lit("")) == "")
    no_statement = (F.col("kind") == "statement") & ~text.rlike(r"\A(?:[A-Za-z]|/\*!)")
    said = F.when(no_insert | no_statement, F.raise_error(F.concat(F.lit("no statement: "), F.substring(text, 1, 60))).cast("string")).otherwise(text)
    return pieces.select(said.alias("statement"), F.when(F.col("kind") == "part", F.col("table")).alias("table")).where("statement <> ''")
