"""The pipeline, stage by stage against plain computations."""

import hashlib
import re

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from loomwork.llm import queries
from loomwork.llm.mixing import mix_quotas
from loomwork.llm.pii_crf import PiiModel, find_all, labelled_table, redact
from loomwork.llm.quality_crf import quality_scores

from .conftest import SF
from .test_dedup import brute


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_stages(spark, table):
    docs, seen = table("documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF), f"test-{name}")
        seen.append(docs)
    quality, single, clean, mixed, encoded = seen
    columns = table("documents").columns
    assert all(x.columns == columns for x in seen[:4])
    good = {r.doc_id for r in quality_scores(table("documents"), table("labels")).where("predicted = 1").collect()}
    kept = {r.doc_id: r.text for r in quality.collect()}
    assert set(kept) == good and len(good) > 100
    rows = sorted(kept.items())
    assert {r.doc_id for r in single.collect()} == {d for d, _, c in brute(rows) if d == c}
    model = PiiModel(labelled_table())
    alone = {r.doc_id: r.text for r in single.collect()}
    redacted = {d: redact(t, full) for (d, t), (_, full) in zip(alone.items(), find_all(list(alone.values()), model), strict=True)}
    assert {r.doc_id: r.text for r in clean.collect()} == redacted and all(r.n_chars == len(r.text) for r in clean.collect())
    taken = {r.doc_id: r.taken for r in mix_quotas(clean).collect()}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + words(r.text)
        assert r.n_chars == len(r.text) and (r.text == redacted[r.doc_id] or words(r.text) < words(redacted[r.doc_id]))
    assert got == {d: n for d, n in taken.items() if n}
    library = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    sha = lambda ids: hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    want = sorted((r.doc_id, len(i := library.encode(r.text, add_special_tokens=False).ids), sha(i)) for r in mixed.collect())
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in encoded.collect()) == want
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, encoded.collect()))


def test_stages_take_odd_and_empty_documents(spark, odd_docs, no_docs):
    for start in (odd_docs, no_docs):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, SF), f"odd-{name}")
            assert name == "encoding" or docs.columns == odd_docs.columns
        assert start is odd_docs or docs.count() == 0


def test_stages_take_any_names_of_columns(spark, odd_docs):
    own = ("m_id", "m_key", "b_id", "m_row", "x.y", "place", "n", "key", "hash", "`q`", "a b")
    docs = odd_docs.select("doc_id", "text", "source", "n_chars").toDF("doc_id", "text", "source", "n_chars")
    wide = docs.select("*", *[F.lit(c).alias(c) for c in own])
    plain, docs = docs, wide
    for name, stage in corpus_pipeline.STAGES:
        docs, plain = (corpus_pipeline.written(stage(spark, x, SF), f"names-{name}") for x in (docs, plain))
        if name != "encoding":
            assert docs.columns == wide.columns
            assert all(tuple(r)[4:] == own for r in docs.collect())
        rows = [sorted(str(tuple(r)[:4]) for r in x.collect()) for x in (docs, plain)]
        assert rows[0] == rows[1]
