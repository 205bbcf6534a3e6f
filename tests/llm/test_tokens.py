"""Operators 1, 7 and 10."""

import hashlib
import json
import random
import sys
import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from loomwork.llm import queries
from loomwork.llm.bpe_segment_tree import SegmentTreeBPE, bpe_round_trip
from loomwork.llm.library_encoder import LibraryEncoder
from loomwork.llm.separator_scan import scan_flat_files, token_counts
from loomwork.llm.token_frames import CorruptFrame, FrameFile, file_chunks, token_files, write_token_files

from .conftest import SF

BYTES, WORDS = (queries.tokenizer_file(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", " ", "a", " a b ", "a  b", "a \n b", "a\n b c", "x <|endoftext|> y<|startoftext|>", "it's They'll 'RE 123 4", "a\x1cb \x1c c", "é́ q　w", "ΣΑΣ ΟΔΟΣ", "İstanbul ẞ", "漢字 🎉 ½", "ab" * 5000]


def strange_texts():
    pick = random.Random(4)
    letters = "ab1 \n' ́s.É!\t Σσ<|>İß漢é"
    wide = lambda: chr(pick.choice([pick.randint(0, 0x3000), pick.randint(0, 255), 32, pick.randint(0x10000, 0x1F9FF)]))
    return ODD + ["".join(pick.choice(letters) for _ in range(pick.randint(0, 30))) for _ in range(1500)] + ["".join(wide() for _ in range(20)) for _ in range(500)]


def test_cached_encoding_is_the_librarys():
    with open(BYTES, encoding="utf-8") as f:
        setup = f.read()
    library, encoder = Tokenizer.from_str(setup), LibraryEncoder(setup)
    texts = strange_texts() * 2
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_segment_tree_encodes_and_decodes_as_the_library():
    with open(WORDS, encoding="utf-8") as f:
        setup = f.read()
    library, bpe = Tokenizer.from_str(setup), SegmentTreeBPE(setup)
    for text in strange_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text) == ids
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_texts_are_encoded_together_as_alone():
    with open(WORDS, encoding="utf-8") as f:
        setup = f.read()
    library, bpe, texts = Tokenizer.from_str(setup), SegmentTreeBPE(setup), strange_texts()
    # Twice: from the trees, then from the cache.
    for _ in range(3):
        assert bpe.encode_all(texts) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_trees_of_many_words_merge_as_one_tree_does():
    with open(WORDS, encoding="utf-8") as f:
        bpe = SegmentTreeBPE(f.read())
    pick = random.Random(7)
    words = list({bytes(pick.choice(b"aehinorst") if pick.random() < 0.9 else pick.randrange(256) for _ in range(pick.choice([1, 2, 3, 4, 5, 8, 9, 17, 33, 64, 128, 129, 130, 200]))) for _ in range(3000)})
    got = bpe._merged_words(words)
    assert all(got[w] == bpe._word(w) for w in words) and set(got) == set(words)


def test_added_tokens_of_any_spelling():
    with open(WORDS, encoding="utf-8") as f:
        setup = json.load(f)
    setup["added_tokens"] += [{"id": len(setup["model"]["vocab"]) + 10 + k, "content": x, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True} for k, x in enumerate(["[SEP]", "@@stop"])]
    text = json.dumps(setup)
    library, bpe = Tokenizer.from_str(text), SegmentTreeBPE(text)
    for x in ("a [SEP] b", "a@@stop[SEP]b c@@sto", "[SEP]", "<|endoftext|>[SEP]x", "plain @ text ["):
        ids = library.encode(x, add_special_tokens=False).ids
        assert bpe.encode(x) == ids and bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_a_cache_that_is_full_gives_the_same_ids(monkeypatch):
    with open(WORDS, encoding="utf-8") as f:
        setup = f.read()
    monkeypatch.setattr("loomwork.llm.bpe_segment_tree.PIECES", 20)
    monkeypatch.setattr("loomwork.llm.bpe_segment_tree.MARKS", 64)
    library, bpe, texts = Tokenizer.from_str(setup), SegmentTreeBPE(setup), strange_texts()[:300]
    for _ in range(3):
        for text in texts:
            assert bpe.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert len(bpe._pieces) <= 40


def test_a_cached_piece_takes_four_bytes_an_id():
    with open(WORDS, encoding="utf-8") as f:
        bpe = SegmentTreeBPE(f.read())
    text = " ".join(f"word{k}x{k * 7919}" for k in range(3000))
    # A piece is kept when it is seen again.
    assert bpe.encode_all([text]) == bpe.encode_all([text])
    assert len(bpe._pieces) == 3000
    assert sum(sys.getsizeof(x) for x in bpe._pieces.values()) <= sum(sys.getsizeof(b"") + 4 * len(bpe.encode(x)) for x in bpe._pieces)


def test_other_tokenizer_files_are_refused():
    with open(BYTES, encoding="utf-8") as f, pytest.raises(ValueError):
        SegmentTreeBPE(f.read())


def ids_of(path, texts):
    return dict(zip(texts, (x.ids for x in Tokenizer.from_file(path).encode_batch(list(texts.values()), add_special_tokens=False)), strict=True))


def test_query_1_against_the_library(spark, texts):
    found, start = {r.doc_id: r for r in queries.op1_token_frames(spark, SF).collect()}, 0
    assert len(found) == len(texts)
    for doc_id, ids in sorted(ids_of(BYTES, texts).items()):
        data = np.array([*ids, 2], "<u4").tobytes()
        assert (found[doc_id].start, found[doc_id].n_tokens, found[doc_id].ids_crc32) == (start, len(ids) + 1, zlib.crc32(data))
        start += len(ids) + 1


def test_files_are_zstandard_and_read_by_document(tmp_path):
    docs = [(5, b"\1\0\2\0"), (None, b""), (7, b"\3\0" * 5000)]
    path = tmp_path / "f.zst"
    path.write_bytes(b"".join(file_chunks(docs, 2)))
    file = FrameFile(f"file://{path}")
    assert file.doc_ids == [5, None, 7] and file.fetch(2).tolist() == [3] * 5000 and [x.tolist() for x in file][:2] == [[1, 2], []]
    stream = zstandard.ZstdDecompressor().stream_reader(path.open("rb"), read_across_frames=True)
    assert stream.read() == b"".join(x for _, x in docs)
    data = bytearray(path.read_bytes())
    data[int(file.offsets[2]) + 9] ^= 1
    path.write_bytes(data)
    broken = FrameFile(f"file://{path}")
    assert broken.fetch(0).tolist() == [1, 2]
    with pytest.raises((CorruptFrame, zstandard.ZstdError)):
        broken.fetch(2)


def test_frames_of_odd_documents(spark, odd_docs, no_docs):
    folder, shards = write_token_files(odd_docs, BYTES)
    files = [FrameFile(f"{folder}/{s.name}") for s in shards]
    assert [i for f in files for i in f.doc_ids] == [None, None, 1, 2, 3, 4, 4, 4, 5, 7, 8, 9, 10]
    rows = token_files(odd_docs, BYTES).orderBy("start").collect()
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2)] == [1, 1]
    assert [r.start for r in rows] == np.concatenate(([0], np.cumsum([r.n_tokens for r in rows])[:-1])).tolist()
    assert token_files(no_docs, BYTES).count() == 0


def test_rows_without_an_id_fill_many_files(spark):
    docs = spark.createDataFrame([(None if k % 2 else 7, f"text {k}") for k in range(4000)], "doc_id long, text string")
    _, shards = write_token_files(docs, BYTES)
    assert len(shards) == 4 and max(s.n_docs for s in shards) < 2000
    rows = token_files(docs, BYTES).orderBy("start").collect()
    assert len(rows) == 4000 and [r.doc_id for r in rows] == [None] * 2000 + [7] * 2000


def test_query_7_against_the_library(spark, texts):
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    found, start = {r.doc_id: r for r in queries.op7_separator_scan(spark, SF).collect()}, 0
    assert set(found) == set(texts) and len({r.shard for r in found.values()}) > 1
    # The corpus is the files in order, and in each the documents in order.
    for r in sorted(found.values(), key=lambda r: (r.shard, r.doc_id)):
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.start, r.n_tokens) == (start, n)
        start += n + 1


@pytest.mark.parametrize("block", [1, 3, 7, 100])
def test_documents_across_blocks(spark, tmp_path, block):
    pick = random.Random(block)
    ids = np.array([pick.choice([9, 1, 2, 3]) for _ in range(60)] + [9, 1, 1], "<u2")
    (tmp_path / "f.bin").write_bytes(ids.tobytes())
    (tmp_path / "empty.bin").write_bytes(b"")
    rows = scan_flat_files(spark, [(0, f"file://{tmp_path}/f.bin"), (1, f"file://{tmp_path}/empty.bin")], 2, 9, block_ids=block).orderBy("ordinal").collect()
    lengths, n = [], 0
    for x in ids:
        n, lengths = (0, [*lengths, n]) if x == 9 else (n + 1, lengths)
    assert [r.n_tokens for r in rows] == [*lengths, n] and [r.ordinal for r in rows] == list(range(len(rows)))


def test_counts_of_odd_documents(odd_docs, no_docs):
    rows = token_counts(odd_docs, BYTES, 50256, block_ids=1000).collect()
    assert len(rows) == odd_docs.count() and [r.n_tokens for r in rows if r.doc_id in (1, 2)] == [0, 0]
    assert token_counts(no_docs, BYTES, 50256).count() == 0


def test_query_10_against_the_library(spark, texts):
    library = Tokenizer.from_file(WORDS)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = {r.doc_id: r for r in queries.op10_bpe_segment_tree(spark, SF).collect()}
    for doc_id, ids in ids_of(WORDS, texts).items():
        assert (found[doc_id].n_tokens, found[doc_id].ids_sha256, found[doc_id].decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_round_trip_of_odd_documents(odd_docs, no_docs):
    rows = bpe_round_trip(odd_docs, WORDS, with_ids=True).collect()
    assert len(rows) == odd_docs.count() and all(len(r.ids) == r.n_tokens for r in rows)
    assert {r.ids_sha256 for r in rows if r.doc_id in (1, 2, 3)} == {hashlib.sha256(b"").hexdigest()}
    assert bpe_round_trip(no_docs, WORDS).count() == 0
