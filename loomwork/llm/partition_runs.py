"""Periodic runs of words by Crochemore's partition refinement.

Two places of a text are in one class of level l if the l words from each on are
the same.  Level 1 is by word; level l + 1 comes from level l by splitting classes
by the class of the next place.  Only the places before members of *small* classes
are looked at: of the parts that a class falls into all but a largest are small, so
a place is in a small class at most log n times and all levels together take
n log n steps.

Each class is a linked list in the order of places.  A place whose next member
stands exactly l words on begins a square whose half has l words and is no power of
a shorter word; so a stretch of c such places one after the other is a run with
smallest period l and c - 1 + 2 l words, which no neighbouring word extends.
Periods above a third of a text are not asked for, so its levels end there.

While many places move at a level, levels are array operations over all texts of a
piece at once; what is left then, mostly texts with long repeats, goes on text by
text over sets, at a few steps for each place that moves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared_folder import spread
from .textbytes import flat_bytes, in_pieces

#: A run has so many words at least, and so many of its periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
PIECE_BYTES = 1_000_000
#: Levels at which fewer places move are worked out over sets.
FEW = 600
_BITS = 21

Run = tuple[int, int, int]


def _sorted(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """The order of rows by three columns of numbers from 0."""
    limit = 1 << _BITS
    if len(first) < limit and (not len(first) or max(int(first.max()), int(second.max()), len(first)) < limit):
        # Columns and the row's number in one word; rows come in order of the third.
        by_third = np.argsort(third, kind="stable")
        packed = np.sort((first[by_third] << (2 * _BITS)) | (second[by_third] << _BITS) | np.arange(len(first)))
        return by_third[packed & (limit - 1)]
    return np.lexsort((third, second, first))


class Classes:
    """The classes of one level over the places of many texts, each with a word of its own behind its end."""

    def __init__(self, words: np.ndarray, text_of: np.ndarray, most: np.ndarray):
        """words: numbers of the words, those behind the ends not the same as any other; most: the highest level wanted at each place."""
        n = len(words)
        self.level, self.most = 1, most
        order = _sorted(text_of, words, np.arange(n))
        t, w = text_of[order], words[order]
        new = np.ones(n, dtype=bool)
        new[1:] = (t[1:] != t[:-1]) | (w[1:] != w[:-1])
        number = np.cumsum(new) - 1
        self.of = np.empty(n, dtype=np.int64)
        self.of[order] = number
        self.size = np.bincount(number)
        self.next, self.before = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        same = ~new[1:]
        self.next[order[:-1][same]] = order[1:][same]
        self.before[order[1:][same]] = order[:-1][same]
        self.alive = np.flatnonzero(self.size[self.of] > 1)
        self.small = np.arange(n)

    def squares(self) -> np.ndarray:
        """Places, in order, whose next member stands as many words on as the level."""
        return self.alive[self.next[self.alive] - self.alive == self.level]

    def refine(self) -> None:
        p = self.small[self.small > 0] - 1
        p = p[(self.size[self.of[p]] > 1) & (self.most[p] > self.level)]
        own, after = self.of[p], self.of[p + 1]
        order = _sorted(own, after, p)
        p, own, after = p[order], own[order], after[order]
        self.level += 1
        self.small = np.zeros(0, dtype=np.int64)
        if len(p):
            self._split(p, own, after)
        self.alive = self.alive[(self.size[self.of[self.alive]] > 1) & (self.most[self.alive] >= self.level)]

    def _split(self, p: np.ndarray, own: np.ndarray, after: np.ndarray) -> None:
        """Part the classes ``own`` of places p by the classes ``after``; rows come in order of both and of the place."""
        head = np.ones(len(p), dtype=bool)
        head[1:] = (own[1:] != own[:-1]) | (after[1:] != after[:-1])
        group = np.cumsum(head) - 1
        count, of_class = np.bincount(group), own[head]
        first = np.ones(len(count), dtype=bool)
        first[1:] = of_class[1:] != of_class[:-1]
        parent = np.cumsum(first) - 1
        classes, moved = of_class[first], np.bincount(parent, weights=count).astype(np.int64)
        rest, parts = self.size[classes] - moved, np.bincount(parent)
        # One part and no rest: the class stays as it is.
        whole = (rest == 0) & (parts == 1)
        stays = whole[parent][group]
        p, group = p[~stays], group[~stays]
        if not len(p):
            return
        # The largest part of each class; where nothing rests it keeps the class's number.
        by_size = np.lexsort((count, parent))
        last = np.ones(len(count), dtype=bool)
        last[:-1] = parent[by_size][1:] != parent[by_size][:-1]
        largest = by_size[last]
        keeps = np.zeros(len(count), dtype=bool)
        keeps[largest[rest == 0]] = True
        fresh = ~keeps & ~whole[parent]
        number = np.where(fresh, len(self.size) + np.cumsum(fresh) - 1, of_class)
        self._unlink(p)
        self.size[classes[~whole]] = rest[~whole]
        self.size = np.concatenate((self.size, count[fresh]))
        self.size[of_class[keeps & ~whole[parent]]] = count[keeps & ~whole[parent]]
        self.of[p] = number[group]
        chained = group[1:] == group[:-1]
        self.next[p], self.before[p] = -1, -1
        self.next[p[:-1][chained]] = p[1:][chained]
        self.before[p[1:][chained]] = p[:-1][chained]
        # Small: all parts but a largest, the rest among them.
        rest_largest = rest >= count[largest]
        small = np.zeros(len(self.size), dtype=bool)
        small[number[fresh]] = True
        big = ~rest_largest & ~whole
        small[number[largest[big]]] = False
        some_rest = classes[big & (rest > 0)]
        small[some_rest] = True
        at = p[small[self.of[p]]]
        if len(some_rest):
            # What rests has not moved: it is found among all that live.
            is_rest = np.zeros(len(self.size), dtype=bool)
            is_rest[some_rest] = True
            at = np.concatenate((at, self.alive[is_rest[self.of[self.alive]]]))
        self.small = at

    def _unlink(self, p: np.ndarray) -> None:
        """Take places out of their lists; neighbours that go together go as one stretch."""
        order = _sorted(self.of[p], np.zeros_like(p), p)
        p = p[order]
        gone = np.zeros(len(self.of) + 1, dtype=bool)
        gone[p] = True
        before, after = self.before[p], self.next[p]
        # Place -1 is the spare flag at the end, which is never set.
        left, right = before[~gone[before]], after[~gone[after]]
        self.next[left[left >= 0]] = right[left >= 0]
        self.before[right[right >= 0]] = left[right >= 0]


def _by_sets(level: int, most: int, of: dict[int, int], following: dict[int, int], small: list[int]) -> Iterator[tuple[int, list[int]]]:
    """(level, places of squares) of the levels from ``level`` on, of one text.

    of: the class of each place whose class has others; following: its next member.
    small: places of small classes, those alone in their class among them.
    """
    members: dict[int, set[int]] = {}
    for i, c in of.items():
        members.setdefault(c, set()).add(i)
    before = {j: i for i, j in following.items()}
    gaps: dict[int, list[int]] = {}
    for i, j in following.items():
        if j - i >= level:
            gaps.setdefault(j - i, []).append(i)
    number = max(of.values(), default=0) + 1
    alone = -1
    while level <= most:
        # A gap is entered again where neighbours move together.
        found = sorted({i for i in gaps.pop(level, ()) if following.get(i) == i + level})
        if found:
            yield level, found
        if not small:
            # Nothing changes any more: all gaps that are left stay.
            left = [g for g in gaps if g > level]
            if not left:
                return
            level = min(left)
            continue
        parts: dict[tuple[int, int], list[int]] = {}
        for j in sorted(small):
            c = of.get(j - 1)
            if c is not None:
                d = of.get(j)
                if d is None:
                    alone -= 1
                    d = alone
                parts.setdefault((c, d), []).append(j - 1)
        by_class: dict[int, list[list[int]]] = {}
        for (c, _), places in parts.items():
            by_class.setdefault(c, []).append(places)
        level += 1
        small = []
        for c, groups in by_class.items():
            own = members[c]
            if len(groups) == 1 and len(groups[0]) == len(own):
                continue
            for places in groups:
                for i in places:
                    own.discard(i)
                    a, b = before.pop(i, None), following.pop(i, None)
                    if a is not None:
                        if b is None:
                            del following[a]
                        else:
                            following[a] = b
                            gaps.setdefault(b - a, []).append(a)
                    if b is not None:
                        if a is None:
                            del before[b]
                        else:
                            before[b] = a
            sets = [own] if own else []
            for places in groups:
                for a, b in zip(places, places[1:], strict=False):
                    following[a], before[b] = b, a
                    gaps.setdefault(b - a, []).append(a)
                members[number] = part = set(places)
                for i in places:
                    of[i] = number
                sets.append(part)
                number += 1
            if not own:
                del members[c]
            largest = max(sets, key=len)
            for part in sets:
                if part is not largest:
                    small += part
                if len(part) == 1:
                    (i,) = part
                    del members[of.pop(i)]


def _stretches(places: np.ndarray, level: int, least: int, periods: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and numbers of words of the runs that begin with squares at ``places``, which are in order."""
    edge = np.flatnonzero(np.diff(places) != 1)
    first, last = np.concatenate(([0], edge + 1)), np.concatenate((edge, [len(places) - 1]))
    length = last - first + 2 * level
    keep = length >= max(least, periods * level)
    return places[first[keep]], length[keep]


def runs_of(words: np.ndarray, offsets: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[list[Run]]:
    """(start, length, period) of the runs of every text, by start and period; text t has the numbers words[offsets[t]:offsets[t + 1]]."""
    texts = len(offsets) - 1
    out: list[list[Run]] = [[] for _ in range(texts)]
    n = np.diff(offsets)
    wide = np.flatnonzero(n >= least)
    if not len(wide):
        return out
    # Texts that can hold a run, each with a word behind its end that is no other's.
    lengths = n[wide] + 1
    starts = np.concatenate(([0], np.cumsum(lengths)))
    text_of = np.repeat(np.arange(len(wide)), lengths)
    place = np.arange(starts[-1]) - starts[text_of]
    inside = place < n[wide][text_of]
    numbers = np.empty(starts[-1], dtype=np.int64)
    numbers[inside] = words[(offsets[wide][text_of] + place)[inside]]
    numbers[~inside] = (int(words.max()) + 1 if len(words) else 0) + np.arange(len(wide))
    most = (n[wide] // periods)[text_of]
    classes = Classes(numbers, text_of, most)

    def enter(places: np.ndarray, level: int) -> None:
        if len(places):
            at, length = _stretches(places, level, least, periods)
            for s, k, t in zip(at.tolist(), length.tolist(), text_of[at].tolist(), strict=True):
                out[wide[t]].append((s - int(starts[t]), k, level))

    enter(classes.squares(), 1)
    while len(classes.alive) and len(classes.small) > FEW:
        classes.refine()
        enter(classes.squares(), classes.level)
    level = classes.level
    alive = classes.alive
    owner = text_of[alive]
    small = np.sort(classes.small)
    small_of = text_of[small]
    for t in np.unique(owner).tolist():
        own = alive[slice(*np.searchsorted(owner, (t, t + 1)))]
        following = classes.next[own]
        has = following >= 0
        moved = small[slice(*np.searchsorted(small_of, (t, t + 1)))]
        found = _by_sets(level, int(n[wide[t]]) // periods, dict(zip(own.tolist(), classes.of[own].tolist(), strict=True)), dict(zip(own[has].tolist(), following[has].tolist(), strict=True)), moved.tolist())
        for at, places in found:
            # Squares of this level have been entered before.
            if at > level and len(places) >= max(least, periods * at) - 2 * at + 1:
                enter(np.array(places), at)
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without the repeats: of each run the first period stays, unless another run takes it."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, *, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period) and collapsed text of every row of ``docs`` (doc_id, text).

    Words are ``[^\\x20\\x09-\\x0D]+`` and differ by case.  A run is a longest
    stretch with its smallest period, of ``least`` words and ``periods`` periods or
    more; runs come by start, then period.  The collapsed text drops the words that
    any run holds after its first period, and joins the rest by one blank.

    Null, empty and wordless texts have no runs and an empty collapsed text.  Rows
    that share a doc_id, or have none, are rows of their own.  An empty table gives
    an empty result; other columns are not read.  A text is one task's work and
    takes memory in proportion to its length.
    """
    if least < 2 or periods < 2:
        raise ValueError("least and periods must be 2 or more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in in_pieces(batch, PIECE_BYTES):
                data, ends = flat_bytes(piece.column("text"))
                raw = data.tobytes()
                texts = [raw[a:b].split() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                offsets = np.concatenate(([0], np.cumsum([len(w) for w in texts], dtype=np.int64)))
                numbers = pa.array([w for words in texts for w in words], pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
                found = runs_of(numbers, offsets, least, periods)
                flat = np.array([r for runs in found for r in runs], dtype=np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
                bounds = pa.array(np.concatenate(([0], np.cumsum([len(r) for r in found]))), pa.int32())
                collapsed = pa.array([_collapsed(w, r) for w, r in zip(texts, found, strict=True)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(bounds, structs), collapsed], names=["doc_id", "n_words", "runs", "collapsed"])

    rows = spread(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs``, where each doc_id of crc32 divisible by 10 gets a repeat up to its end.

    With g = crc32 / 10 and n words, word i from a = g % n on becomes word a + (i -
    a) % p, p = 1 + (n - a) / (3 + g % 8).  Other texts, and those without words or
    a doc_id, stay as they are.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    # Slices and repeats instead of a lookup for each word, which would split the text again each time.
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    repeated = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return docs.select(doc_id.alias("doc_id"), F.when((h % 10 == 0) & (n > 0), repeated).otherwise(text).alias("text"))


def run_report(docs: DataFrame, **options) -> DataFrame:
    """The runs of planted() texts: their number, the one of the highest exponent, and hashes of all and of the collapsed text."""
    found = periodic_runs(planted(docs), **options)

    def better(best, r):
        exponent = r["length"] * best["period"] - best["length"] * r["period"]
        return F.when(best.isNull() | (exponent > 0), r).otherwise(best)

    # Runs come by start, then period, so of equal exponents the first stays.
    best = F.aggregate("runs", F.lit(None).cast("struct<start: long, length: long, period: long>"), better)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id",
        "n_runs",
        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
