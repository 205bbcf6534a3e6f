"""A training corpus from raw documents: quality, near duplicates, personal data, mix, token ids.

Each stage takes the documents that the stage before it kept and returns
documents; the last returns what the encoder makes of them.

In every stage rows are judged row by row: rows that share a doc_id, or have
none, stay rows of their own; an empty table gives an empty one; columns besides
doc_id, text, source and n_chars are carried along and never read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm.bottomk_dedup import without_near_duplicates
from loomwork.llm.bpe_segment_tree import bpe_round_trip
from loomwork.llm.mixing import mix_documents
from loomwork.llm.pii_crf import without_pii
from loomwork.llm.quality_crf import accepted
from loomwork.llm.queries import tokenizer_file
from loomwork.llm.shared_folder import written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts.

    Null and empty texts are one line without words and are judged as such.  Where
    no labels teach a class, every score is 0.5 and every document stays.
    """
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id.

    Null, empty and wordless texts are near duplicates of nothing and stay.  Of
    rows that share doc_id and words one stays.  Rows without a doc_id go if a
    document with one is in their group; else one of each text stays.
    """
    return without_near_duplicates(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows.

    Every document stays.  A null text stays null, with a null n_chars; an empty
    one stays empty.
    """
    clean = without_pii(docs)
    at = [k for k, c in enumerate(clean.columns) if c == "n_chars"]
    plain = clean.toDF(*["text" if c == "text" else f"_{k}" for k, c in enumerate(clean.columns)])
    return plain.withColumns({f"_{k}": F.length("text").cast("long") for k in at}).toDF(*clean.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the numbers that the sources' quotas ask for.

    A document comes once for each whole pass over it, and once more with the words
    of its chosen blocks; n_chars follows.  Documents of which nothing is taken go,
    null, empty and wordless ones among them.  A null source is the last source.
    """
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document: their number and hash, and the hash of the decoded text.

    A null or empty text has no ids and the hashes of nothing.
    """
    return bpe_round_trip(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Classifier, sketches and token ids have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again, over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
