"""Operators on embeddings and word runs, compared with plain Python."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest

from tertulia.llm import knn_join, registered, whitening, word_runs
from tests.llm import brute

NAN, INF = float("nan"), float("inf")


def vectors(spark, sf):
    return [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_top_k(spark, sf):
    rows = vectors(spark, sf)
    assert found(registered.op11_top_k(spark, sf)) == brute.top_k(rows)


@pytest.mark.parametrize("group, slice_rows", [(64 << 20, 1 << 17), (256, 7)])
def test_top_k_of_hard_vectors(spark, monkeypatch, group, slice_rows):
    monkeypatch.setattr(knn_join, "GROUP_BYTES", group)
    monkeypatch.setattr(knn_join, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(knn_join, "TILE", (3, 8))
    rng = random.Random(2)
    points = [[rng.gauss(0, 1) + 9 * (i % 3) for _ in range(4)] for i in range(150)]
    points += [[5.0, 5.0, 5.0, 5.0]] * 120 + [None, [], [1.0, None, 2.0, 3.0], [NAN, 1.0, 1.0, 1.0], [INF, 0.0, 0.0, 0.0], [0.0] * 4, [2.0], [1.0] * 6]
    rows = list(enumerate(points))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert found(knn_join.top_k(df, df.vec_id % 10 == 0)) == brute.top_k(single, every=10)


def test_top_k_of_huge_and_few_vectors(spark):
    rows = [(0, [2.0**20, 2.0**18]), (1, [2.0**20 + 1, -5.0]), (2, [2.0**20, 2.0**18 + 1]), (3, [-(2.0**60), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(knn_join.top_k(df, df.vec_id == 0)) == [r for r in brute.top_k(rows, every=5)]
    again = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (None, [1.0]), (5, [1.0])], "vec_id long, embedding array<double>")
    best = [(r.query_id, r["rank"], r.vec_id) for r in knn_join.top_k(again, again.vec_id == 0).collect()]
    assert sorted(best, key=str) == sorted([(0, 1, 0), (0, 2, 5), (0, 3, None)] * 2, key=str)
    assert knn_join.top_k(df.limit(0), df.vec_id == 0).count() == knn_join.top_k(df, df.vec_id == 77).count() == 0


def test_cells_far_away_are_left_out(spark):
    """Two groups of vectors on opposite sides: no row is copied to the other side's queries."""
    rng = random.Random(4)
    rows = [(i, [(1 if i % 2 else -1) * 50.0 + rng.random(), rng.random()]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    space = knn_join._Space([[12800.0, 100.0], [-12800.0, 100.0]], 13000.0)
    usable = df.selectExpr("vec_id AS row", "vec_id AS key", "vec_id % 50 < 2 AS asks", "embedding AS vector")
    placed = knn_join._placed(usable, space, 256.0, "bigint").cache()
    reach = {r.q_cell: r.m for r in placed.filter("q_cell >= 0").groupBy("q_cell").agg({"q_far": "max"}).withColumnRenamed("max(q_far)", "m").collect()}
    assert sorted((cell, group) for cell, group, *_ in knn_join._needs(space, placed, {0: (0, 1), 1: (1, 1)}, reach, 5)) == [(0, 0), (1, 1)]


def test_groups_are_bounded():
    rng = np.random.default_rng(1)
    space = knn_join._Space(rng.normal(size=(20, 3)).tolist(), 9.0)
    counts = {i: int(n) for i, n in enumerate(rng.integers(1, 40, 20))} | {3: 1000}
    groups = knn_join._groups(space, counts, 64)
    assert groups[3][1] == 16
    loads = {}
    for cell, (first, parts) in groups.items():
        for g in range(first, first + parts):
            loads[g] = loads.get(g, 0) + math.ceil(counts[cell] / parts)
    assert max(loads.values()) <= 64 and sorted(loads) == list(range(len(loads)))


def runs_of(df):
    return {r.doc_id: tuple(r)[1:] for r in df.collect()}


def test_word_runs(spark, sf, rows):
    names = "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    got = runs_of(registered.op12_word_runs(spark, sf).select(*names))
    want = {}
    for doc, text in rows:
        words = registered.repeated_tail(doc, (text or "").encode().split())
        runs = brute.word_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        milli = best[1] * 1000 // best[2] if runs else None
        want[doc] = (len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
    assert got == want and any(n for n, *_ in got.values())


def test_repeated_tail():
    doc = next(i for i in itertools.count() if zlib.crc32(str(i).encode()) % 10 == 0)
    words = [b"w%d" % i for i in range(100)]
    g = zlib.crc32(str(doc).encode()) // 10
    a, p = g % 100, 1 + (100 - g % 100) // (3 + g % 8)
    assert registered.repeated_tail(doc, words) == [words[i] if i < a else words[a + (i - a) % p] for i in range(100)]
    assert registered.repeated_tail(None, words) == words and registered.repeated_tail(doc, []) == []


def test_runs_of_hard_sequences():
    rng = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            kinds, text = rng.choice([1, 2, 3, 5]), []
            for _ in range(rng.randrange(6)):
                base = [rng.randrange(kinds) for _ in range(rng.randrange(1, 8))]
                text += [base[i % len(base)] for i in range(rng.randrange(40))]
                text += [rng.randrange(kinds) for _ in range(rng.randrange(4))]
            texts.append(text * rng.choice([1, 1, 1, 4, 5]))
        bounds = np.cumsum([0, *map(len, texts)])
        got = [[] for _ in texts]
        for doc, *run in word_runs.find_runs(np.array(sum(texts, []), np.int64), bounds).T.tolist():
            got[doc].append(tuple(run))
        assert got == [brute.word_runs(t) for t in texts]


def test_runs_of_long_texts(monkeypatch):
    monkeypatch.setattr(word_runs, "PAIRS", 1000)
    tail = list(range(5000))
    for text, want in [([0] * 200_000, [(0, 200_000, 1)]), ([9] + tail * 7 + tail[:3], [(1, 35_003, 5000)]), (list(range(100_000)), [])]:
        assert [tuple(r[1:]) for r in word_runs.find_runs(np.array(text, np.int64), np.array([0, len(text)])).T.tolist()] == want


def test_runs_of_odd_rows(spark, odd):
    got = word_runs.word_runs(odd.withColumnRenamed("lang", "runs"))
    assert got.columns == ["doc_id", "runs", "collapsed"] and got.count() == odd.count() and word_runs.word_runs(odd.limit(0)).count() == 0
    texts = spark.createDataFrame([(1, "a b " * 3 + "a"), (2, "a b " * 4), (3, "x y z " * 5), (4, "é " * 6)], "doc_id long, text string")
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in word_runs.word_runs(texts).collect()}
    assert got == {1: ([], "a b a b a b a"), 2: ([(0, 8, 2)], "a b"), 3: ([(0, 10, 2)], "x y z"), 4: ([(0, 6, 1)], "é")}


def whitened(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (str(r[0]), r[1]))


def check_whitening(rows, got, most=32):
    """Against a covariance in fractions of whole numbers and numpy's eigenvectors, up to sign."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(0)
    centred = x * n - sums
    cov = (centred.T @ centred / n**3).astype(float)
    value, axes = np.linalg.eigh(cov)
    value, axes = value[::-1][:most], axes[:, ::-1][:, :most]
    k = len(value)
    assert len(got) == n * k
    table = np.array([[r[4] for r in got[i * k : (i + 1) * k]] for i in range(n)])
    order = sorted(range(n), key=lambda i: str(rows[i][0]))
    want = ((centred / n).astype(float) @ axes / np.sqrt(value))[order]
    sign = np.sign((table * want).sum(0))
    assert np.abs(table - want * sign).max() < 1e-6
    for i, place in enumerate(order):
        for j, (key, component, count, deviation, _, explained, error) in enumerate(got[i * k : (i + 1) * k]):
            assert (key, component, count, deviation) == (rows[place][0], j + 1, n, int((centred[place] ** 2).sum()))
            assert abs(explained / (value[j] / np.trace(cov)) - 1) < 1e-8 and error < 1e-9


def test_whitening(spark, sf):
    check_whitening(vectors(spark, sf), whitened(registered.op13_whitening(spark, sf)))


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(x) for x in rng.normal(size=5) * [1, 2, 3, 4, 5] + 1e6]) for i in range(60)]
    bad = [(70, None), (71, []), (72, [1.0] * 4), (73, [1.0, None, 1.0, 1.0, 1.0]), (74, [NAN] * 5), (75, [INF, 1.0, 1.0, 1.0, 1.0]), (76, [1e300] * 5), (None, None)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("n", spark.range(1).count() + 0 * whitening.F.col("vec_id"))
    check_whitening(good, whitened(whitening.whiten(df)))
    equal = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(equal).count() == whitening.whiten(equal.limit(1)).count() == whitening.whiten(equal.limit(0)).count() == 0
    large = spark.createDataFrame([(1, [2.0**54, 1.0]), (2, [-(2.0**54), 2.0]), (3, [2.0**54 - 4096, 5.0])], "vec_id long, embedding array<double>")
    rows = whitening.whiten(large).collect()
    assert {r.component for r in rows} == {1} and all(r.deviation is None for r in rows) and max(r.identity_error for r in rows) < 1e-4
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], "vec_id long, embedding array<double>")
    assert {r.component for r in whitening.whiten(line).collect()} == {1}


def test_components_of_hard_matrices():
    rng = np.random.default_rng(0)
    for d, spectrum in itertools.product([1, 2, 7, 40], ["full", "equal", "steep", "tied", "few"]):
        turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
        values = {"full": rng.random(d) + 0.1, "equal": np.ones(d), "steep": 10.0 ** -np.arange(d), "tied": np.repeat([5.0, 3, 3, 1], (d + 3) // 4)[:d], "few": np.arange(d) < 3}[spectrum]
        matrix = turn @ np.diag(values.astype(float) * 100) @ turn.T
        value, axes = whitening.leading_components(matrix)
        true = np.sort(values.astype(float) * 100)[::-1][:32]
        true = true[true > 2e-11 * true[0]]
        assert len(true) <= len(value) <= len(true) + 1
        assert np.abs(value[: len(true)] - true).max() < 1e-12 * true[0]
        assert np.abs(axes.T @ axes - np.eye(len(value))).max() < 1e-13 and np.abs(matrix @ axes - axes * value).max() < 1e-12 * true[0]
