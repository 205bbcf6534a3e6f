"""Operator 6."""

import random
import re

import numpy as np
import pyarrow as pa

from loomwork.llm import queries
from loomwork.llm.bottomk_dedup import _bits, _estimated, _within, components, near_duplicates, sure, without_near_duplicates
from loomwork.llm.textbytes import flat_bytes, word_bounds, word_hashes

from .conftest import SF


def brute(rows, percent=75):
    """(n_shingles, component, kept) of rows (doc_id, text) by all pairs that share a shingle."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[k : k + 5]) for k in range(max(len(words) - 4, min(len(words), 1)))})
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(k)] = min(low.get(find(k), doc_id), doc_id)
    return sorted(((d, len(s), low.get(find(k)) if s else d) for k, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def found(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.doc_id is not None)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def test_query_against_all_pairs(spark, texts):
    assert found(queries.op6_minhash_near_dedup(spark, SF)) == brute(sorted(texts.items()))


def hot_rows(seed):
    """A large group of near copies at all distances, a passage in many texts, copies and short texts."""
    pick = random.Random(seed)
    word = lambda: f"w{pick.randint(0, 5000)}"
    base, passage = [word() for _ in range(90)], [word() for _ in range(60)]
    out = []
    for k in range(150):
        copy = list(base)
        for _ in range(pick.randint(0, 6)):
            copy[pick.randrange(len(copy))] = word() if pick.random() < 0.6 else f"v{pick.randint(0, 3)}"
        out.append(copy[pick.randint(0, 4) : len(copy) - pick.randint(0, 4)])
    for k in range(60):
        out.append(passage + [word() for _ in range(pick.randint(1, 60))])
    out += [out[0]] * 20 + [[word() for _ in range(pick.randint(1, 6))] for _ in range(30)] + [["a", "b"], ["A", "b"], ["a", "b", "c", "d", "e"], ["a", "b", "c", "d", "e", "f"]]
    pick.shuffle(out)
    return [(k, " ".join(x)) for k, x in enumerate(out)]


def test_large_groups_keep_every_link(spark, monkeypatch):
    for seed in (1, 2):
        rows = hot_rows(seed)
        if seed == 2:
            # Few rounds and few values a round, so that members remain for the last step.
            monkeypatch.setattr("loomwork.llm.bottomk_dedup.ROUNDS", 1)
            monkeypatch.setattr("loomwork.llm.bottomk_dedup.JOIN_AT_ONCE", 2)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        # The second time with hubs in blocks of few members, and nodes of few edges handled as heavy ones.
        assert found(near_duplicates(df, short=4, **({"members": 7, "heavy": 5} if seed == 2 else {}))) == brute(rows)


def test_small_sets_with_partners_beyond_the_sketch(spark):
    pick = random.Random(6)
    rows = []
    for n in range(56, 65):
        for k in range(40):
            # n shingles, and up to n / 0.75 in a text that goes on.
            words = [f"w{pick.getrandbits(40)}" for _ in range(n * 4 // 3 + 4 - k % 3)]
            rows += [(len(rows), " ".join(words[: n + 4])), (len(rows) + 1, " ".join(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(near_duplicates(df))
    assert got == brute(rows)
    assert len({c for _, _, c in got}) == len(rows) // 2


def test_sets_at_and_just_above_the_threshold(spark):
    """Pairs of every size from 49 to 63 with partners of 65 to 84 shingles, some within the other and some not."""
    pick = random.Random(61)
    rows = []
    for n in range(49, 64):
        for k in range(24):
            common = n - k % 3
            larger = next((m for m in range(100 * common // 75 - n + common + 1, n, -1) if 100 * common >= 75 * (n + m - common)), None)
            if larger is None or not 65 <= larger <= 84:
                continue
            words = [f"w{pick.getrandbits(40)}" for _ in range(larger + 4)]
            tail = [f"x{pick.getrandbits(40)}" for _ in range(n - common)]
            rows += [(len(rows), " ".join(words[: common + 4] + tail)), (len(rows) + 1, " ".join(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(near_duplicates(df))
    assert len(rows) > 400 and got == brute(rows) and len({c for _, _, c in got}) == len(rows) // 2


def test_what_is_sure():
    assert sure(64, 75) == 18 and sure(64, 50) < 6 and sure(8, 75) == 0
    pick = random.Random(62)
    for k in (5, 20):
        for _ in range(500):
            a, b = (np.unique(np.array([pick.randrange(60) for _ in range(pick.randint(1, 40))], np.uint64)) for _ in range(2))
            union = np.union1d(a[:k], b[:k])
            want = None if len(union) < k else len(np.intersect1d(np.intersect1d(a[:k], b[:k]), union[:k]))
            assert _estimated(a[:k], b[:k], k) == want


def test_other_thresholds_lose_nothing(spark):
    rows = hot_rows(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_duplicates(df, percent=50, short=4)) == brute(rows, 50)


def test_rows_without_ids_are_found_again(spark):
    rows = [(None if k % 2 else 5, t) for k, (_, t) in enumerate(hot_rows(4))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), short=4)
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got.collect()) == sorted((d or -1, n, c or -1) for d, n, c in brute(rows))


def test_odd_documents(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = near_duplicates(odd_docs)
    assert sorted((r.n_shingles, r.component_id or -1) for r in got.collect()) == sorted((n, c or -1) for _, n, c in brute(rows))
    assert [r.kept for r in got.where("doc_id = 4 or doc_id = 5").orderBy("doc_id", "n_shingles").collect()] == [True, True, True, False]
    assert near_duplicates(no_docs).count() == 0


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), heavy=2).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100}


def test_word_hashes():
    texts = pa.array(["Foo  bar\tfoo", None, "", "fOO", "é É"], pa.string())
    data, offsets = flat_bytes(texts)
    starts, ends, words = word_bounds(data, offsets)
    h = word_hashes(data, starts, ends)
    assert np.diff(words).tolist() == [3, 0, 0, 1, 2]
    assert h[0] == h[2] == h[3] != h[1] and h[4] != h[5]


def test_rows_that_stay(spark, odd_docs, no_docs):
    same, other = "a b c d e f g h", "p q r s t u v w"
    rows = [(1, same, 0), (2, same, 1), (3, other, 2), (3, same, 3), (3, other, 4), (None, same, 5), (None, "only here at all", 6), (4, None, 7), (4, "", 8), (5, "x y", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    assert sorted((r.doc_id or -1, r.text or "") for r in without_near_duplicates(df).collect()) == sorted([(1, same), (3, other), (-1, "only here at all"), (4, ""), (4, ""), (5, "x y")])
    stay = without_near_duplicates(odd_docs)
    assert stay.columns == odd_docs.columns and stay.where("doc_id = 4").count() == 2
    assert without_near_duplicates(no_docs).count() == 0


def test_members_within_a_hub_meet_as_bits(spark):
    # A hub of 300 shingles; members hold parts of it, and values beyond it that have joined.
    rng = np.random.default_rng(6)
    members = []
    for b in range(120):
        if b % 3 and members:
            own = members[rng.integers(len(members))][1] ^ (rng.random(300) < rng.choice([0.02, 0.2]))
        else:
            own = rng.random(300) < rng.choice([0.2, 0.5, 0.9])
        extra = sorted(int(v) for v in rng.choice(40, rng.integers(0, 8), replace=False))
        beyond = int(rng.integers(0, 5))
        members.append((b, own, extra, int(own.sum()) + len(extra) + beyond, b % 7))
    rows = [(hub, b, n, int(own.sum()) + len(extra), root, root != 0, _bits(np.flatnonzero(own), 300), extra) for hub in (1000, 1001) for b, own, extra, n, root in members]
    table = spark.createDataFrame(rows, "a long, b long, n long, common long, root long, apart boolean, inside binary, extra array<long>")
    want = set()
    for x in members:
        for y in members:
            both = int((x[1] & y[1]).sum()) + len(set(x[2]) & set(y[2]))
            if x[0] < y[0] and x[4] != y[4] and both * 175 >= 75 * (x[3] + y[3]):
                want.add((x[0], y[0]))
    for block in (1000, 7):
        links = [(min(r), max(r)) for r in _within(table, 75, block).collect()]
        assert set(links) == want and len(links) == 2 * len(want) and len(want) > 20


def test_no_chance_is_taken_if_none_is_wanted(spark):
    pick = random.Random(4)
    rows = []
    for i in range(60):
        words = [f"w{pick.randrange(10_000)}" for _ in range(pick.choice([8, 90, 200]))]
        rows.append((2 * i, " ".join(words)))
        rows.append((2 * i + 1, " ".join(words[: len(words) * pick.choice([70, 76, 90]) // 100])))
    assert found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), missed=0)) == brute(rows)
