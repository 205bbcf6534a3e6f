"""The tokenizers library behind bounded caches of pieces and words.

Byte-level pre-tokenization cuts a text wherever one space stands between two
other characters, whatever is around it.  So a text's ids are those of its
space-separated pieces, each with its leading space, in order; a piece's ids are
those of its words, and a word goes to the library's model once.  Texts with
other white space next to a space, or with an added token in them, and texts of
other tokenizers go to the library whole.
"""

from __future__ import annotations

import gc
import json
import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Entries of each cache, and characters of a piece or word that is kept.
PIECES, WORDS, KEPT_CHARS = 500_000, 700_000, 40

# Fixed values of byte-level BPE: the pattern of words, and the characters that stand for bytes.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LATIN = regex.compile(r"[\x00-\u024f]*")
PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]


def byte_characters() -> list[str]:
    """The character of each byte: printable bytes stand for themselves, the others follow from 256 on."""
    rest = iter(range(256, 512))
    return [chr(b) if b in PRINTABLE else chr(next(rest)) for b in range(256)]


def keep(entries: dict, passing: dict, most: int, key, value) -> None:
    """Add to ``entries`` while it has room; beyond that to ``passing``, which starts anew when full."""
    if len(entries) < most:
        entries[key] = value
        return
    if len(passing) >= most // 10:
        passing.clear()
    passing[key] = value


@contextmanager
def no_collection() -> Iterator[None]:
    """Without the search for objects that refer to themselves: encoders make none, and it takes long among so many."""
    collecting = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if collecting:
            gc.enable()


class LibraryEncoder:
    """Little-endian ids of whole texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, tokenizer_json: str, *, id_bytes: int = 4, text_only: bool = False):
        """text_only: strings of added tokens in a text are ordinary text."""
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(tokenizer_json)
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        self._tokenizer.encode_special_tokens = text_only
        self._model = self._tokenizer.model
        self._type = {2: "<u2", 4: "<u4"}[id_bytes]
        setup = json.loads(tokenizer_json)
        self._added = [] if text_only else [x["content"] for x in setup["added_tokens"]]
        before = setup["pre_tokenizer"] or {}
        self._by_piece = (
            setup["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and all(x["special"] and not (x["lstrip"] or x["rstrip"] or x["normalized"] or x["single_word"]) for x in setup["added_tokens"])
        )
        self._characters = dict(enumerate(byte_characters()))
        self._pieces, self._late_pieces = {}, {}
        self._words, self._late_words = {}, {}

    def _word(self, word: str) -> bytes:
        shown = word.encode().decode("latin-1").translate(self._characters)
        ids = np.array([x.id for x in self._model.tokenize(shown)], dtype=self._type).tobytes()
        if len(word) <= KEPT_CHARS:
            keep(self._words, self._late_words, WORDS, word, ids)
        return ids

    def _run(self, text: str) -> bytes:
        if not LATIN.fullmatch(text):
            # Beyond Latin letters, tables of letters come from different editions of Unicode.
            return self._library([text])[0]
        words = PATTERN.findall(text)
        out = list(map(self._words.get, words))
        if None in out:
            for k, ids in enumerate(out):
                if ids is None:
                    out[k] = self._late_words.get(words[k]) or self._word(words[k])
        return b"".join(out)

    def _text(self, text: str) -> bytes:
        # The first piece has no space before it, so it never has an entry.
        first, *pieces = text.split(" ")
        ids = list(map(self._pieces.get, pieces))
        if None in ids:
            missing = [k for k, x in enumerate(ids) if x is None]
            if any(not (p := pieces[k]) or p[0].isspace() or p[-1].isspace() for k in missing):
                return self._run(text)
            for k in missing:
                piece = pieces[k]
                ids[k] = self._late_pieces.get(piece) or self._run(" " + piece)
                if len(piece) <= KEPT_CHARS and "\n" not in piece:
                    keep(self._pieces, self._late_pieces, PIECES, piece, ids[k])
        if pieces and (not first or first[-1].isspace()):
            return self._run(text)
        return self._run(first) + b"".join(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self._by_piece:
            return self._library(texts)
        with no_collection():
            return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [self._library([x])[0] if any(a in x for a in self._added) else self._text(x) for x in texts]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, dtype=self._type).tobytes() for x in self._tokenizer.encode_batch(texts, add_special_tokens=False)]


_kept: dict[tuple, LibraryEncoder] = {}


def encoder_of(tokenizer_json: str, **options) -> LibraryEncoder:
    """One encoder for each Python worker, kept between tasks."""
    key = (hash(tokenizer_json), *sorted(options.items()))
    if key not in _kept:
        _kept.clear()
        _kept[key] = LibraryEncoder(tokenizer_json, **options)
    return _kept[key]
