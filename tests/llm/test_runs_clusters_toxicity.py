"""Operators 11 to 13 against brute force and held-out rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomwork.llm import elkan, partition_runs, queries
from loomwork.llm.elkan import clustered
from loomwork.llm.partition_runs import periodic_runs, planted, run_report, runs_of
from loomwork.llm.zstd_toxicity import ToxicityModel, fit_dictionaries, learn, toxicity_scores, windows

from .conftest import SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w, least=24, periods=3):
    out = []
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if n >= max(least, periods * q) and not any(all(w[k] == w[k + d] for k in range(i, i + n - d)) for d in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(pick):
    n, k = pick.randint(0, 150), pick.choice([1, 2, 3, 8])
    w = [pick.randint(0, k) for _ in range(n)]
    if n and pick.random() < 0.6:
        a = pick.randrange(n)
        p = pick.randint(1, max(1, (n - a) // 3))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    if pick.random() < 0.2:
        x, y = [0], [0, 1]
        while len(y) < n:
            x, y = y, y + x
        w = y[:n]
    return w


@pytest.mark.parametrize("few", [600, 0, 3, 10**9])
def test_runs_against_all_periods(monkeypatch, few):
    # Levels by arrays, by sets, and by both.
    monkeypatch.setattr(partition_runs, "FEW", few)
    pick = random.Random(few)
    for _ in range(80):
        texts = [repetitive(pick) for _ in range(pick.randint(1, 6))]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        flat = np.array([x for t in texts for x in t], dtype=np.int64)
        for least, periods in ((24, 3), (4, 2), (2, 3)):
            assert runs_of(flat, offsets, least, periods) == [plain_runs(t, least, periods) for t in texts]


def test_many_places_move_and_large_numbers():
    # More places than fit into a packed word, and one word all along.
    n = 3_000_000
    assert runs_of(np.zeros(n, dtype=np.int64), np.array([0, n])) == [[(0, n, 1)]]
    assert runs_of(np.arange(n), np.array([0, n])) == [[]]


def plain_report(doc_id, text):
    words = WORDS.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *(best or (None, None, None)), best and best[1] * 1000 // best[2], sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_11_against_all_periods(spark, texts):
    some = 0
    for r in queries.op11_crochemore_runs(spark, SF).collect():
        if len(texts[r.doc_id]) < 20_000:
            assert tuple(r)[1:] == plain_report(r.doc_id, texts[r.doc_id]), r.doc_id
            some += r.n_runs > 0
    assert some > 20


def test_runs_of_odd_documents(spark, odd_docs, no_docs):
    rows = run_report(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    want = sorted(str((r.doc_id, plain_report(r.doc_id, r.text))) for r in odd_docs.collect())
    assert sorted(str((r.doc_id, tuple(r)[1:])) for r in rows) == want
    assert run_report(no_docs).count() == periodic_runs(no_docs).count() == planted(no_docs).count() == 0
    long = "x y z " * 100_000
    own = spark.createDataFrame([(1, long, 0), (1, "A a " * 20, 1), (None, " \t\n", 2)], "doc_id long, text string, runs int")
    found = {(r.doc_id, r.n_words): r for r in periodic_runs(own).collect()}
    assert [tuple(x) for x in found[1, 300_000].runs] == [(0, 300_000, 3)] and found[1, 300_000].collapsed == "x y z"
    assert [tuple(x) for x in found[1, 40].runs] == [(0, 40, 2)] and found[1, 40].collapsed == "A a"
    assert found[None, 0].runs == [] and found[None, 0].collapsed == ""
    with pytest.raises(ValueError):
        periodic_runs(own, periods=1)


def plain_clusters(rows, k=40, rounds=5):
    """rows: (vec_id, integers) that take part; Python's integers throughout."""
    first = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [list(r[1]) for r in first]
    d = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    near = lambda x: min(range(len(c)), key=lambda j: (d(x, c[j]), j))
    for _ in range(rounds):
        own = [near(x) for _, x in rows]
        for j in range(len(c)):
            part = [x for (_, x), n in zip(rows, own, strict=True) if n == j]
            if part:
                c[j] = [sum(v) // len(part) for v in zip(*part, strict=True)]
    return [(i, near(x), d(x, c[near(x)]), hashlib.sha256(",".join(map(str, c[near(x)])).encode()).hexdigest()) for i, x in rows]


def test_clusters_against_all_distances(spark):
    pick = np.random.default_rng(4)
    # Few values, so that distances tie; clusters, so that bounds prune; repeated and null ids.
    x = np.concatenate([pick.integers(-2, 3, (120, 64)), pick.integers(-2, 3, (80, 64)) + 40 * pick.integers(0, 3, (80, 1))]) / 256
    ids = [int(i) for i in pick.integers(0, 150, 195)] + [None] * 5
    odd = [(900, None), (901, [0.0] * 63), (902, [0.0] * 63 + [None]), (903, [float("nan")] + [0.0] * 63), (904, [float("inf")] * 64), (905, [])]
    rows = [(i, [float(v) for v in r]) for i, r in zip(ids, x, strict=True)]
    table = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, cluster int")
    for k in (40, 7, 1):
        want = plain_clusters([(i, [int(np.floor(v * 256)) for v in r]) for i, r in rows], k=k)
        got = clustered(table, k=k).collect()
        assert sorted(map(str, want)) == sorted(str((r.vec_id, r.cluster, r.distance, r.centroid_sha256)) for r in got)
        assert {r.inertia for r in got} == {sum(w[2] for w in want)}
        for r in got:
            assert r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster)
    assert clustered(table.limit(0)).count() == 0
    assert len({r.cluster for r in clustered(table.where("vec_id < 10")).collect()}) <= table.where("vec_id < 10").count()


def test_clusters_of_huge_components_are_exact(spark):
    rows = [(1, [1e300] * 64), (2, [1e300] * 63 + [-1.5]), (3, [0.5] * 64), (4, [1e-300] * 64), (5, [2.0**21] * 64), (6, [1.7e308] * 64)]
    whole = lambda v: int(v * 256) if abs(v) < 1e300 and v >= 0 else -384 if v < 0 else int(v) * 256
    want = plain_clusters([(i, [whole(v) for v in r]) for i, r in rows], k=3)
    got = clustered(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3).collect()
    fits = lambda d: d if d < 1 << 63 else None
    assert sorted((i, j, str(fits(d)), h) for i, j, d, h in want) == sorted((r.vec_id, r.cluster, str(r.distance), r.centroid_sha256) for r in got)
    assert {r.inertia for r in got} == {None}


def test_bounds_hold_and_spare_distances():
    pick = np.random.default_rng(5)
    middles = pick.integers(-4000, 4000, (8, 64))
    x = (middles[pick.integers(0, 8, 4000)] + pick.integers(-20, 21, (4000, 64))).astype(np.int64)
    c = [r.tolist() for r in x[:8]]
    own, before = elkan.Assigned.unknown(x, 8), None
    for _ in range(6):
        at = elkan.Centroids.of(c, before)
        own.follow(at.moved)
        own.assign(at)
        true = np.stack([elkan.squared(x, np.array(r)) for r in c], axis=1)
        assert (own.nearest == true.argmin(axis=1)).all()
        assert (own.upper**2 >= true[np.arange(len(x)), own.nearest]).all() and (own.lower**2 <= true).all()
        before, c = c, [[int(v) for v in x[own.nearest == j].sum(axis=0) // max(1, (own.nearest == j).sum())] if (own.nearest == j).any() else c[j] for j in range(8)]
    assert own.computed < 0.6 * 6 * 8 * len(x)


def test_clusters_do_not_depend_on_partitions(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    one, many = (sorted(map(tuple, clustered(t, rounds=2).collect())) for t in (table.coalesce(1), table.repartition(13)))
    assert one == many


def auc(score, label):
    order = np.argsort(np.argsort(score)) + 1
    n1 = label.sum()
    return (order[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


def test_query_13_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = queries.op13_zstd_toxicity(spark, SF).join(labels, "doc_id").toPandas()
    for r in rows.itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = rows[rows.held_out]
    assert auc(held["score"].to_numpy(), held["toxic"].to_numpy()) > 0.7
    assert held[held.toxic == 0].predicted.mean() < 0.05


def test_planted_words_are_caught(spark):
    pick = random.Random(3)
    plain = lambda n: [pick.choice("thing other ending water before reason number people".split()) + pick.choice("ing ed s ly".split()) for _ in range(n)]
    docs, labels = [], []
    for i in range(400):
        words = plain(pick.randint(20, 400))
        if i % 4 == 0:
            for _ in range(1 + len(words) // 40):
                words[pick.randrange(len(words))] = pick.choice(["zogglewump", "BLARGHEAD", "snoutface"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    scores = toxicity_scores(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).toPandas()
    held = scores[scores.held_out]
    assert (held.predicted == (held.doc_id % 4 == 0)).mean() > 0.95


def test_windows_hold_the_whole_text():
    for text in (b"", b"a" * 1000, b"A b " * 500, " é".encode() * 400):
        parts = windows(text)
        assert b"".join(parts) == text.lower() and all(len(p) <= 96 for p in parts) and parts
    model = fit_dictionaries([[b""], [b""]], [1, 0])
    assert isinstance(model, ToxicityModel) and model.features(pa.array([None, "", "x" * 10_000])).shape[0] == 3


def test_toxicity_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity_scores(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity_scores(no_docs, labels).count() == 0
    assert {r.score for r in toxicity_scores(odd_docs, labels.where("toxic = 0")).collect()} == {0.5}
    assert {r.score for r in toxicity_scores(odd_docs, labels.where("doc_id is null")).collect()} == {0.5}
    assert learn(no_docs, labels) is None
