"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs.

A leaf stands for each symbol and holds the rank of its pair with the next
symbol; an inner node holds the lowest rank below it.  The root's rank is the
next merge; going down, left first, finds its leftmost place.  A merge changes
three leaves, each in logarithmic time, until the root shows no mergeable pair.
Words of any length so take n log n steps.

The words of a group of texts that no cache holds go through their trees
together: trees of one size are rows of one numpy table, and each step makes one
merge in every row that still has one.  Few or very long words take the same
steps in plain Python.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .library_encoder import byte_characters, no_collection
from .shared_folder import spread
from .textbytes import in_pieces

NO_MERGE = np.iinfo(np.int32).max
#: Pieces that are kept, and characters of such a piece; marks of pieces that were seen once.
PIECES, KEPT_CHARS, MARKS = 250_000, 40, 1 << 22
#: Words of more symbols, and groups of fewer words, are merged one by one; cells of one table of trees.
TREE_SYMBOLS, FEW_WORDS, CELLS = 129, 16, 2_000_000
#: Bytes of texts that are encoded together; one longer text is a group of its own.
GROUP_BYTES = 1_000_000

#: White space of the Unicode standard; Python's split() also takes 0x1C-0x1F.
_SPACES = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_LATIN = regex.compile(r"[\x00-\u024f]*")
_SEPARATORS = regex.compile(r"[\x1c-\x1f]")


class SegmentTreeBPE:
    """Encodes and decodes as the tokenizers library does for the same file.

    Takes files with a BPE model, byte-level symbols, an optional end-of-word
    suffix, the normalizers NFC, white space to one space and lower case, and one
    pattern of words; anything else raises ValueError.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        setup = json.loads(tokenizer_json)
        library = Tokenizer.from_str(tokenizer_json)
        self._normalizer, self._cutter = library.normalizer, library.pre_tokenizer
        model = setup["model"]
        self._suffix = model.get("end_of_word_suffix") or ""
        vocabulary = model["vocab"]
        self._names = {i: name for name, i in vocabulary.items()}
        # The library numbers added tokens that the model does not have by itself.
        self._added = {x["content"]: library.token_to_id(x["content"]) for x in setup["added_tokens"]}
        self._names |= {i: name for name, i in self._added.items()}
        steps = (setup["normalizer"] or {}).get("normalizers", [])
        cuts = (setup["pre_tokenizer"] or {}).get("pretokenizers", [])
        supported = (
            model["type"] == "BPE"
            and [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": r"\s+"}
            and steps[1]["content"] == " "
            and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["behavior"] == "Removed"
            and cuts[0]["invert"]
            and not cuts[1]["use_regex"]
            and not cuts[1]["add_prefix_space"]
            and setup["post_processor"] is None
            and setup["decoder"] is None
            and not regex.findall(cuts[0]["pattern"]["Regex"], "\n")
            and not any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in setup["added_tokens"])
        )
        if not supported:
            raise ValueError("this tokenizer file needs steps that are not built")
        self._pattern = regex.compile(cuts[0]["pattern"]["Regex"])
        #: Words of many pieces at once, with a line break after each piece.
        self._by_line = regex.compile(r"\n|" + self._pattern.pattern)
        self._added_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self._added, key=len, reverse=True))) + ")") if self._added else None
        characters = byte_characters()
        self._byte = {c: b for b, c in enumerate(characters)}
        self._first = [vocabulary[c] for c in characters]
        self._last = [vocabulary[c + self._suffix] for c in characters]
        #: Pair to (rank, merged id), pairs as one number; and the same as sorted arrays.
        self._merge: dict[int, tuple[int, int]] = {}
        self._wide = max(self._names) + 1
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self._merge.setdefault(vocabulary[a] * self._wide + vocabulary[b], (rank, vocabulary[a + b]))
        self._merged = np.zeros(len(model["merges"]), dtype=np.int32)
        for rank, merged in self._merge.values():
            self._merged[rank] = merged
        # One more pair than any stands behind the last, so that a search always finds a place.
        pairs = sorted(self._merge)
        self._pairs = np.array([*pairs, np.iinfo(np.int64).max], dtype=np.int64)
        self._ranks = np.array([*(self._merge[x][0] for x in pairs), NO_MERGE], dtype=np.int32)
        self._first_ids, self._last_ids = np.array(self._first, dtype=np.int32), np.array(self._last, dtype=np.int32)
        #: Ids by piece, 4 bytes each (tuples of numbers take three times the memory), and where pieces that were seen once have left a mark; names and decimal numbers by id.
        self._pieces: dict[str, bytes] = {}
        self._marks, self._marked = bytearray(MARKS), 0
        self._name_of = [self._names.get(i, "") for i in range(self._wide)]
        self._decimal = [str(i) for i in range(self._wide)]
        self._heads = {x[0] for x in self._added if x}

    def _word(self, data: bytes) -> bytes:
        """Ids of a word, 4 bytes each."""
        first = self._first
        symbols = [first[b] for b in data[:-1]]
        symbols.append(self._last[data[-1]])
        n = len(symbols)
        if n == 1:
            return array("i", symbols).tobytes()
        merge, wide = self._merge.get, self._wide
        no_pair = (NO_MERGE, 0)
        size = 1 << (n - 2).bit_length()
        # node[1] is the root, node[size + k] the leaf of symbol k's pair.
        leaves = [merge(a * wide + b, no_pair)[0] for a, b in zip(symbols, symbols[1:], strict=False)]
        node = [NO_MERGE] * size + leaves + [NO_MERGE] * (size - n + 1)
        for k in range(size - 1, 0, -1):
            left, right = node[2 * k], node[2 * k + 1]
            node[k] = left if left <= right else right
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while node[1] != NO_MERGE:
            low, k = node[1], 1
            while k < size:
                k *= 2
                if node[k] != low:
                    k += 1
            k -= size
            gone = after[k]
            merged = merge(symbols[k] * wide + symbols[gone])[1]
            symbols[k], symbols[gone] = merged, -1
            after[k] = follows = after[gone]
            changed = [(k, NO_MERGE)]
            if follows < n:
                before[follows] = k
                changed = [(k, merge(merged * wide + symbols[follows], no_pair)[0]), (gone, NO_MERGE)]
            if (p := before[k]) >= 0:
                changed.append((p, merge(symbols[p] * wide + merged, no_pair)[0]))
            for place, rank in changed:
                place += size
                node[place] = rank
                place >>= 1
                while place:
                    left, right = node[2 * place], node[2 * place + 1]
                    low = left if left <= right else right
                    if node[place] == low:
                        break
                    node[place] = low
                    place >>= 1
        return array("i", [x for x in symbols if x >= 0]).tobytes()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NO_MERGE for a pair without a merge, or with -1 for an id."""
        key = left.astype(np.int64) * self._wide + right
        at = np.searchsorted(self._pairs, key)
        return np.where((self._pairs[at] == key) & (left >= 0) & (right >= 0), self._ranks[at], NO_MERGE)

    def _trees(self, words: list[bytes], size: int) -> list[bytes]:
        """_word() of words of 2 to size + 1 symbols, in trees of ``size`` leaves that go step by step together."""
        rows, width = len(words), size + 2
        lengths = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        last = np.cumsum(lengths) - 1
        inside = np.arange(width) < lengths[:, None]
        symbols = np.full((rows, width), -1, dtype=np.int32)
        ids = self._first_ids[data]
        ids[last] = self._last_ids[data[last]]
        symbols[inside] = ids
        # Leaves stand from ``size`` on, the root at 1; a leaf more than needed takes changes beyond the last pair.
        node = np.full((rows, 2 * size + 2), NO_MERGE, dtype=np.int32)
        node[:, size : 2 * size] = self._rank(symbols[:, :size], symbols[:, 1 : size + 1])
        level = size
        while level > 1:
            node[:, level >> 1 : level] = np.minimum(node[:, level : 2 * level : 2], node[:, level + 1 : 2 * level : 2])
            level >>= 1
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), (rows, 1))
        before = np.tile(np.arange(-1, width - 1, dtype=np.int32), (rows, 1))
        # Flat views: row r begins at r * columns.
        flat, tree, nexts, backs = symbols.ravel(), node.ravel(), after.ravel(), before.ravel()
        row = np.arange(rows)
        while True:
            row = row[tree[row * (2 * size + 2) + 1] != NO_MERGE]
            if not len(row):
                break
            at, base = row * (2 * size + 2), row * width
            low, k = tree[at + 1], np.ones(len(row), dtype=np.int64)
            while k[0] < size:
                k *= 2
                k += tree[at + k] != low
            k -= size
            gone = nexts[base + k]
            follows = nexts[base + gone]
            merged = self._merged[low]
            flat[base + k], flat[base + gone] = merged, -1
            nexts[base + k] = follows
            some = follows < width
            backs[(base + follows)[some]] = k[some]
            right = np.where(some, flat[base + np.where(some, follows, 0)], -1)
            p = backs[base + k].astype(np.int64)
            left = np.where(p >= 0, flat[base + np.maximum(p, 0)], -1)
            # Leaf ``size`` of a word without a place takes what has no leaf of its own.
            places = [k, gone.astype(np.int64), np.where(p >= 0, p, k)]
            ahead = self._rank(merged, right)
            behind = np.where(p >= 0, self._rank(left, merged), ahead)
            for place, rank in zip(places, (ahead, NO_MERGE, behind), strict=True):
                tree[at + size + place] = rank
            places = [np.where(x < size, x + size, size + k) for x in places]
            while size > 1 and places[0][0] > 1:
                for x in places:
                    x >>= 1
                    tree[at + x] = np.minimum(tree[at + 2 * x], tree[at + 2 * x + 1])
        return [r[r >= 0].tobytes() for r in symbols]

    def _merged_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct words."""
        out, by_size = {}, {}
        for word in words:
            n = len(word)
            if n < 2 or n > TREE_SYMBOLS:
                out[word] = self._word(word)
            else:
                by_size.setdefault(1 << (n - 2).bit_length() if n > 2 else 1, []).append(word)
        for size, some in by_size.items():
            if len(some) < FEW_WORDS:
                out |= {w: self._word(w) for w in some}
                continue
            step = max(1, CELLS // (4 * size))
            for a in range(0, len(some), step):
                part = some[a : a + step]
                out |= zip(part, self._trees(part, size), strict=True)
        return out

    def _cut(self, piece: str) -> list[bytes]:
        """Normalized words of text without white space, by the tokenizer file's own steps."""
        shown = self._cutter.pre_tokenize_str(self._normalizer.normalize_str(piece))
        return [bytes([self._byte[c] for c in word]) for word, _ in shown]

    def _cut_all(self, pieces: list[str]) -> dict[str, list[bytes]]:
        """Normalized words of distinct pieces.

        Latin pieces are cut together.  Beyond Latin letters the libraries' tables
        of letters come from different editions of Unicode; there the file's own
        steps decide.
        """
        out = {x: self._cut(x) for x in pieces if not _LATIN.fullmatch(x)}
        latin = [x for x in pieces if x not in out] if out else pieces
        words = self._by_line.findall(unicodedata.normalize("NFC", "\n".join([*latin, ""])).lower())
        data = {x: x.encode() for x in set(words)}
        start = 0
        for piece in latin:
            end = words.index("\n", start)
            out[piece] = [data[x] for x in words[start:end]]
            start = end + 1
        return out

    def _keep(self, known: dict[str, bytes]) -> None:
        """Pieces that left a mark before are kept.  Early ones are the most frequent, so a full cache forgets its newer half."""
        marks = self._marks
        for piece, ids in known.items():
            if len(piece) > KEPT_CHARS:
                continue
            place = hash(piece) % MARKS
            if marks[place]:
                self._pieces[piece] = ids
            else:
                marks[place] = 1
                self._marked += 1
        if self._marked > MARKS // 4:
            self._marks, self._marked = bytearray(MARKS), 0
        if len(self._pieces) > PIECES:
            self._pieces = dict(islice(self._pieces.items(), PIECES // 2))

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces that the cache does not have."""
        cut = self._cut_all(list(pieces))
        known = self._merged_words(list({w for words in cut.values() for w in words}))
        new = {x: known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words]) for x, words in cut.items()}
        self._keep(new)
        return new

    def _parts(self, text: str) -> list[str | int]:
        """The pieces of a text between white space, and ids of added tokens in it."""
        if not any(h in text for h in self._heads) or not self._added_pattern.search(text):
            return _pieces(text)
        out: list[str | int] = []
        for k, part in enumerate(self._added_pattern.split(text)):
            out += [self._added[part]] if k % 2 else _pieces(part)
        return out

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of every text."""
        return [numbers(x) for x in self.encoded(texts)]

    def encoded(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, 4 bytes each; what no cache has is worked out for all of them together."""
        with no_collection():
            return self._encoded(texts)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        parts = [self._parts(x) for x in texts]
        found = [list(map(self._pieces.get, x)) for x in parts]
        missing = {x for x, ids in zip(chain.from_iterable(parts), chain.from_iterable(found), strict=True) if ids is None}
        new = {x: array("i", [x]).tobytes() for x in missing if isinstance(x, int)}
        new |= self._learn(missing.difference(new))
        return [b"".join(ids if None not in ids else [new[x] if y is None else y for x, y in zip(own, ids, strict=True)]) for own, ids in zip(parts, found, strict=True)]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decimal(self, ids: list[int]) -> str:
        """The ids as decimal numbers joined by one space."""
        return " ".join(map(self._decimal.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """Names of the ids joined by spaces: what a file without a decoder gives."""
        return " ".join(map(self._name_of.__getitem__, ids))


def numbers(ids: bytes) -> list[int]:
    return np.frombuffer(ids, dtype=np.int32).tolist()


def _pieces(text: str) -> list[str]:
    return text.split() if not _SEPARATORS.search(text) else [x for x in _SPACES.split(text) if x]


_kept: dict[int, SegmentTreeBPE] = {}


def bpe_of(tokenizer_json: str) -> SegmentTreeBPE:
    """One encoder for each Python worker, kept between tasks."""
    key = hash(tokenizer_json)
    if key not in _kept:
        _kept.clear()
        _kept[key] = SegmentTreeBPE(tokenizer_json)
    return _kept[key]


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, *, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs`` (doc_id, text); with_ids adds ids and decoded.

    A null text counts as empty: no ids, and the hashes of nothing.  Rows keep
    their doc_id, null or repeated; other columns are not read.  The decoded text
    is decode() of the ids.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        setup = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(setup.value)
        for batch in batches:
            for piece in in_pieces(batch, GROUP_BYTES):
                encoded = bpe.encoded([x or "" for x in piece.column("text").to_pylist()])
                count, ids_hash, text_hash, all_text = [], [], [], []
                # Numbers of one text at a time; what is decoded is the ids themselves.
                for ids in map(numbers, encoded):
                    plain = bpe.decode(ids)
                    count.append(len(ids))
                    ids_hash.append(hashlib.sha256(bpe.decimal(ids).encode()).hexdigest())
                    text_hash.append(hashlib.sha256(plain.encode()).hexdigest())
                    if with_ids:
                        all_text.append(plain)
                columns = [piece.column("doc_id"), pa.array(count, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns += [pa.array(map(numbers, encoded), pa.list_(pa.int32())), pa.array(all_text, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    return spread(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
