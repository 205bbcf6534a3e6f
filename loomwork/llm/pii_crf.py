"""Personal data by fixed patterns and a linear-chain CRF over word shapes.

The patterns find what is written in the usual way.  The CRF adds what they miss:
phone numbers without a plus sign, card numbers with other separators, addresses
with a masked @.  Its tokens are words with a digit, an @ or a mask in brackets;
any other word is outside by definition, so a text falls apart into short chains
of such words, and decoding chains by themselves gives the same labels as decoding
the text.  Words are cut into their fields first, as JSON, CSV and addresses of pages
need it: whatever a word's length, in training and in use.  Chains of a whole batch
are decoded together by Viterbi in numpy.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .crf import Chains, train, viterbi
from .shared_folder import neutral, spread
from .textbytes import in_pieces

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", "B-email", "B-ip", "B-card", "I-card", "B-phone", "I-phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is entered at its first digit only: from a later one the same rest follows.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]|[\[(](?:at|AT)[\])]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The fields of a word: masks, area codes and numbers such as 12/30 stay whole.
_FIELD = re.compile(r"""(?:[^\[\](),;"'{}|<>&?=:/\\]++|[\[(](?:at|AT|dot|DOT)[\])]|\([0-9]++\)|(?<=[0-9])[/:](?=[0-9]))++""")
#: Longer words are not kept in the cache of shapes.
CACHED = 400
_NO_DIGITS = str.maketrans("", "", " -().+/_\t")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Looks around each @: the part before it can be as long as it likes."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            done = found.end()
        # Left of the next @ nothing reaches over this one.
        done = max(done, at + 1)
        at = text.find("@", done)
    return out


def base_spans(text: str) -> dict[str, list[Span]]:
    """Pattern matches, leftmost and without overlap for each kind; failing ones are dropped."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = _emails(text)
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := m[0].translate(_NO_DIGITS)) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out["phone"].append(m.span())
    return out


CUES = {
    "email": ("mail", "email", "e-mail", "contact", "write", "adresse", "correo"),
    "ip": ("ip", "host", "server", "address", "from"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "telefon", "téléphone", "teléfono", "cell"),
}
_CUE_OF = {w: k for k, kind in enumerate(KINDS) for w in CUES[kind]}


def _own(word: str) -> list[float]:
    """Shape of a word: what kinds of characters it has, and in what arrangement."""
    core = word.strip(".,;:!?\"'")
    digits = sum(c.isdigit() for c in core)
    letters = sum(c.isalpha() for c in core)
    shape = re.sub(r"9+", "9", re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]+", "a", core)))
    groups = re.findall(r"[0-9]+", core)
    return [
        1.0,
        digits == 0,
        1 <= digits <= 2,
        digits == 3,
        digits == 4,
        5 <= digits <= 6,
        7 <= digits <= 12,
        13 <= digits <= 19,
        digits > 19,
        letters > 0,
        letters > digits,
        "@" in core and shape.count("@") == 1 and "." in core.rpartition("@")[2],
        "@" in core,
        bool(re.search(r"[\[(](at|AT)[\])]", core)),
        bool(re.search(r"[\[(](dot|DOT)[\])]", core)),
        shape == "9.9.9.9",
        shape == "9.9.9.9" and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        shape in ("9-9", "9-9-9") and [len(g) for g in groups] in ([3, 4], [3, 3, 4], [4, 4]),
        shape == "9-9-9" and [len(g) for g in groups] == [4, 2, 2],
        shape in ("(9)", "(9)9-9"),
        shape == "9" and len(core) == 4,
        shape == "9" and len(core) == 3,
        shape == "9" and core.startswith("0") and len(core) >= 4,
        shape in ("9.9.9", "9/9/9", "9:9", "9.9", "9,9"),
        core.startswith("+"),
        shape.startswith("a=") or shape.startswith('"'),
        core != word,
        bool(re.search(r"[$€%£#]", core)),
        shape in ("9.9.9.9", "9_9_9_9", "9/9/9/9") and [len(g) for g in groups] == [4, 4, 4, 4],
        shape == "9.9.9" and [len(g) for g in groups] == [3, 3, 4],
        len(core) > 40,
    ]


@lru_cache(maxsize=20_000)
def _own_of(word: str) -> tuple[float, ...]:
    return tuple(map(float, _own(word)))


N_OWN = len(_own(""))
#: Own shape, the shapes before and after in the chain, place in the chain, and the last plain word's cue.
N_FEATURES = 3 * N_OWN + 2 + len(KINDS)


def chain_features(words: list[str], cue: str | None) -> np.ndarray:
    x = np.zeros((len(words), N_FEATURES))
    own = np.array([_own_of(w) if len(w) <= CACHED else _own(w) for w in words])
    x[:, :N_OWN] = own
    x[1:, N_OWN : 2 * N_OWN] = own[:-1]
    x[:-1, 2 * N_OWN : 3 * N_OWN] = own[1:]
    x[0, 3 * N_OWN] = x[-1, 3 * N_OWN + 1] = 1
    if (k := _CUE_OF.get((cue or "").strip(".,;:!?\"'()").lower())) is not None:
        x[:, 3 * N_OWN + 2 + k] = 1
    return x


def labelled_table(seed: int = 9, rows: int = 900) -> list[tuple[str | None, list[str], list[str]]]:
    """(word before, words of a chain, labels): a small invented table, about a half of it without personal data."""
    pick = random.Random(seed)

    def d(n: int) -> str:
        return "".join(pick.choice("0123456789") for _ in range(n))

    def name() -> str:
        return "".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(pick.randint(3, 8)))

    def card() -> str:
        body = pick.choice("3456") + d(14)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def plain() -> list[str]:
        return pick.choice([
            lambda: [f"{pick.randint(1900, 2100)}"], lambda: [f"{pick.randint(1, 30)}."], lambda: [f"{d(2)}:{d(2)}"], lambda: [f"{pick.randint(1900, 2100)}-{d(2)}-{d(2)}"],
            lambda: [f"{pick.randint(1, 31)}.{pick.randint(1, 12)}.{pick.randint(1900, 2100)}"], lambda: [f"${pick.randint(1, 999)},{d(3)}.{d(2)}"], lambda: [f"{pick.randint(1, 100)}%"],
            lambda: [f"{pick.randint(0, 9)}.{pick.randint(0, 20)}"], lambda: [f"{pick.randint(0, 9)}.{pick.randint(0, 20)}.{pick.randint(0, 20)}"], lambda: ["AKIA" + "".join(pick.choice("ABCDEFGHJKLMNPQRSTUVWXYZ0123456789") for _ in range(16))],
            lambda: ["key=" + "".join(pick.choice("abcdef0123456789") for _ in range(pick.randint(12, 40)))], lambda: ['"' + "".join(pick.choice("abcdef0123456789") for _ in range(32)) + '"'], lambda: [d(pick.randint(1, 6))],
            lambda: [f"{pick.randint(1, 999)},{d(3)}", d(2)], lambda: [f"@{name()}"], lambda: [f"{name()}{d(2)}"], lambda: [f"{d(pick.randint(7, 12))}"], lambda: [d(4), d(4)], lambda: [f"{d(2)}/{d(2)}/{pick.randint(1900, 2100)}"],
            lambda: [f"{d(3)}", f"{d(3)}"], lambda: [d(pick.randint(20, 30))], lambda: [f"{pick.randint(1, 99)}-{pick.randint(1, 99)}"], lambda: [f"{d(5)}-{d(4)}"],
        ])()

    def personal() -> tuple[str, list[str]]:
        number = card()
        fours = [number[k : k + 4] for k in range(0, 16, 4)]
        mark = pick.choice("._/")
        return pick.choice([
            lambda: ("email", [f"{name()}.{name()}@{name()}.com"]), lambda: ("email", [f"{name()}{d(2)}@{name()}.{name()}.org"]), lambda: ("email", [f"{name()}[at]{name()}.com"]), lambda: ("email", [f"{name()}(at){name()}(dot)org"]),
            lambda: ("ip", [".".join(str(pick.randint(1, 255)) for _ in range(4))]),
            lambda: ("card", [number]), lambda: ("card", fours), lambda: ("card", ["-".join(fours)]), lambda: ("card", [mark.join(fours)]), lambda: ("card", [mark.join(fours)]),
            lambda: ("phone", [f"+{d(1)}", f"({d(3)})", f"{d(3)}-{d(4)}"]), lambda: ("phone", [f"({d(3)})", f"{d(3)}-{d(4)}"]), lambda: ("phone", [f"{d(3)}-{d(3)}-{d(4)}"]), lambda: ("phone", [f"({d(3)}){d(3)}-{d(4)}"]),
            lambda: ("phone", [f"{d(3)}.{d(3)}.{d(4)}"]), lambda: ("phone", [f"+{d(2)}", f"{d(3)}", f"{d(7)}"]),
        ])()

    table = []
    for k in range(rows):
        before, words, labels = pick.choice([None, name(), name(), "the", "and"]), [], []
        if k % 2:
            kind, words = personal()
            labels = [f"B-{kind}"] + [f"I-{kind}"] * (len(words) - 1)
            if pick.random() < 0.4:
                before = pick.choice(CUES[kind])
            if pick.random() < 0.2:
                words[-1] += pick.choice(".,;")
        else:
            words = plain()
            labels = ["O"] * len(words)
        # Now and then something plain stands beside it.
        if pick.random() < 0.15:
            more = plain()
            words, labels = (words + more, labels + ["O"] * len(more)) if pick.random() < 0.5 else (more + words, ["O"] * len(more) + labels)
        table.append((before, words, labels))
    return table


class PiiModel:
    """A CRF trained on a labelled table."""

    def __init__(self, table: list[tuple[str | None, list[str], list[str]]]):
        chains = [c for before, words, labels in table for c in _labelled_chains(before, words, labels)]
        x = np.concatenate([chain_features(words, before) for before, words, _ in chains])
        y = np.array([LABELS.index(label) for _, _, labels in chains for label in labels])
        offsets = np.concatenate(([0], np.cumsum([len(words) for _, words, _ in chains])))
        self.weights, self.transitions = train(x, y, offsets, len(LABELS), rounds=150, decay=3e-5)
        for k, label in enumerate(LABELS):
            if label.startswith("I-"):
                for j, before in enumerate(LABELS):
                    if before[2:] != label[2:]:
                        self.transitions[j, k] = -1e6

    def label(self, chains: list[tuple[str | None, list[str]]]) -> list[list[str]]:
        if not chains:
            return []
        x = np.concatenate([chain_features(words, before) for before, words in chains])
        offsets = np.concatenate(([0], np.cumsum([len(words) for _, words in chains])))
        emissions = x @ self.weights
        # A chain cannot begin inside a number.
        inside = [k for k, label in enumerate(LABELS) if label.startswith("I-")]
        emissions[np.ix_(offsets[:-1], inside)] -= 1e6
        labels = viterbi(emissions, self.transitions, Chains(offsets))
        return [[LABELS[k] for k in labels[a:b]] for a, b in zip(offsets, offsets[1:], strict=False)]


def chains_of(text: str) -> list[tuple[str | None, list[tuple[int, int]]]]:
    """(plain field before, spans of the fields) of every chain of fields with a sign.

    Only the first field of a word goes on with the chain of the word before.
    """
    out, before, chain = [], None, []
    for m in _WORD.finditer(text):
        if not _SIGN.search(text, *m.span()):
            if chain:
                out.append((before, chain))
                chain = []
            before = m.span()
            continue
        for k, f in enumerate(_FIELD.finditer(text, *m.span())):
            sign = _SIGN.search(text, *f.span())
            if chain and (k or not sign):
                out.append((before, chain))
                chain = []
            if sign:
                chain.append(f.span())
            else:
                before = f.span()
    if chain:
        out.append((before, chain))
    return [(_last_field(text, b), c) for b, c in out]


def _last_field(text: str, span: tuple[int, int] | None) -> str | None:
    fields = _FIELD.findall(text, *span) if span else []
    return fields[-1] if fields else None


def _labelled_chains(before: str | None, words: list[str], labels: list[str]) -> list[tuple[str | None, list[str], list[str]]]:
    """The chains of a labelled row's fields; the longest field of a word has the word's label."""
    text, out = " ".join(words), []
    starts = [0, *np.cumsum([len(w) + 1 for w in words]).tolist()]
    longest = [max((f.span() for f in _FIELD.finditer(text, a, a + len(w))), key=lambda s: s[1] - s[0], default=None) for a, w in zip(starts, words, strict=False)]
    said = {span: label for span, label in zip(longest, labels, strict=True) if span}
    for own, chain in chains_of(text):
        out.append((own or before, [text[a:b] for a, b in chain], [said.get(span, "O") for span in chain]))
    return out


def _plausible(kind: str, word: str) -> bool:
    digits = sum("0" <= c <= "9" for c in word)
    if kind == "card":
        number = re.sub(r"[^0-9]", "", word)
        return 13 <= digits <= 19 and luhn(number)
    return {"email": "@" in word or "(at)" in word.lower() or "[at]" in word.lower(), "ip": word.count(".") == 3, "phone": 7 <= digits <= 15}[kind]


def find_all(texts: list[str], model: PiiModel) -> list[tuple[dict[str, list[Span]], dict[str, list[Span]]]]:
    """(base spans, all spans) of every text."""
    base = [base_spans(t) if _SIGN.search(t) else {k: [] for k in KINDS} for t in texts]
    where = [(i, before, chain) for i, t in enumerate(texts) if _SIGN.search(t) for before, chain in chains_of(t)]
    labels = model.label([(before, [texts[i][a:b] for a, b in chain]) for i, before, chain in where])
    full = [{k: list(v) for k, v in b.items()} for b in base]
    for (i, _, chain), found in zip(where, labels, strict=True):
        k = 0
        while k < len(found):
            if not found[k].startswith("B-"):
                k += 1
                continue
            kind, last = found[k][2:], k + 1
            while last < len(found) and found[last] == f"I-{kind}":
                last += 1
            start, end = chain[k][0], chain[last - 1][1]
            while end > start and texts[i][end - 1] in ".,;:!?\"'":
                end -= 1
            while start < end and texts[i][start] in "\"'":
                start += 1
            clear = all(end <= a or b <= start for spans in full[i].values() for a, b in spans)
            if clear and _plausible(kind, texts[i][start:end]):
                full[i][kind].append((start, end))
            k = last
    for spans in full:
        for kind in KINDS:
            spans[kind].sort()
    return list(zip(base, full, strict=True))


def shown(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in spans[kind])


def redact(text: str, spans: dict[str, list[Span]]) -> str:
    """The text with every span replaced by its kind in brackets; spans that overlap become one."""
    out, done = [], 0
    flat = sorted((a, b, kind) for kind in KINDS for a, b in spans[kind])
    for a, b, kind in flat:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def _trained(spark):
    return spark.sparkContext.broadcast(PiiModel(labelled_table()))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of ``docs`` (doc_id, text).

    The counts and the hash are those of the patterns' matches; spans holds them
    and what the CRF adds, in code points with the end left out.  Added spans
    never overlap others.  Null and empty texts have no spans.  Rows keep their
    doc_id, null or repeated; other columns are not read.
    """
    model = _trained(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in in_pieces(batch):
                found = find_all([x or "" for x in piece.column("text").to_pylist()], model.value)
                counts = [pa.array([len(b[kind]) for b, _ in found], pa.int64()) for kind in KINDS]
                hashes = pa.array([hashlib.sha256(shown(b).encode()).hexdigest() for b, _ in found], pa.string())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *counts, hashes, pa.array([shown(f) for _, f in found], pa.string())], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    docs = spread(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def without_pii(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their spans of personal data replaced by their kinds.

    Every row stays, with its own columns; a null text stays null, an empty one
    empty.  text must be a column of strings.  An empty table stays empty.
    """
    model = _trained(docs.sparkSession)
    docs, said = neutral(docs, "text"), docs.columns
    names = docs.columns
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in in_pieces(batch):
                texts = piece.column("text").to_pylist()
                found = find_all([x or "" for x in texts], model.value)
                columns = list(piece.columns)
                columns[place] = pa.array([None if t is None else redact(t, f) for t, (_, f) in zip(texts, found, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [T.StructField("text", T.StringType()) if f.name == "text" else f for f in docs.schema.fields]
    return docs.mapInArrow(run, T.StructType(fields)).toDF(*said)
