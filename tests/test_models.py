import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tertulia.operators import coherence as co
from tertulia.operators import topics as tm
from tests.test_operators import token_table


def brute_windows(lists, words, size):
    total, both = 0, Counter()
    for tokens in lists:
        for i in range(max(len(tokens) - size, 0) + 1):
            inside = set(tokens[i : i + size]) & words
            total += 1
            both.update((a, b) for a in inside for b in inside)
    return total, both


@pytest.mark.parametrize("size", [3, 10])
def test_window_counts(spark, size):
    rng = random.Random(size)
    lists = [[rng.choice("abcdefghxyzuvw") for _ in range(rng.choice([0, 1, 2, 5, 9, 10, 11, 40]))] for _ in range(120)]
    lists.append(list("xyz" * 10 + "a" * 7 + "y" * 50 + "ba"))
    total, both = brute_windows(lists, set("abcd"), size)
    got = {(r.a, r.b): r.co for r in co.window_counts(token_table(spark, lists).repartition(3), list("abcd"), size).collect()}
    assert got.pop((None, None)) == total
    assert got == dict(both)


def test_coherence_by_definition(spark):
    rng = random.Random(1)
    lists = [[rng.choice("abcdef") if rng.random() < 0.3 else "zz" for _ in range(rng.randint(3, 30))] for _ in range(60)]
    terms = {0: ["a", "b", "c"], 1: ["d", "e", "a"]}
    total, both = brute_windows(lists, set("abcde"), 5)

    def npmi(a, b):
        p = both[a, b] / total + 1e-12
        return math.log(p / (both[a, a] / total * both[b, b] / total)) / -math.log(p)

    def score(ws):
        rows = [[npmi(a, b) for b in ws] for a in ws]
        whole = [sum(c) for c in zip(*rows)]
        dot = lambda x, y: sum(i * j for i, j in zip(x, y))
        return sum(dot(r, whole) / math.sqrt(dot(r, r) * dot(whole, whole)) for r in rows) / len(ws)

    table = spark.createDataFrame([(t, w) for t, ws in terms.items() for w in ws], "topic int, word string")
    got = {r.topic: r.coherence for r in co.coherence_by_topic(token_table(spark, lists), table, 5).collect()}
    assert got == pytest.approx({t: score(ws) for t, ws in terms.items()})


def curve(spark, values):
    return spark.createDataFrame([(k, float(v)) for k, v in values], "k int, coherence double")


def brute_knee(values):
    xs, ys = [k for k, _ in values], [v for _, v in values]
    unit = lambda v: [(x - min(v)) / (max(v) - min(v)) for x in v]
    x, y = unit(xs), unit(ys)
    d = [b - a for a, b in zip(x, y)]
    n = len(d)
    high = [d[i] >= d[max(i - 1, 0)] and d[i] >= d[min(i + 1, n - 1)] for i in range(n)]
    low = [d[i] <= d[max(i - 1, 0)] and d[i] <= d[min(i + 1, n - 1)] for i in range(n)]
    gap = sum(b - a for a, b in zip(x, x[1:])) / (n - 1)
    for tenth in range(10, 0, -1):
        limit = knee = None
        for i in range(n - 1):
            if high[i]:
                limit, knee = d[i] - tenth / 10 * gap, xs[i]
            if knee is None:
                continue
            if low[i]:
                limit = 0.0
            if d[i + 1] < limit:
                return knee
    return max(values, key=lambda p: (p[1], -p[0]))[0]


def test_knee_and_fallback(spark):
    clear = [(2, 0.1), (3, 0.5), (4, 0.8), (5, 0.82), (6, 0.83), (7, 0.84)]
    assert tm.choose_k(curve(spark, clear)) == 4 == brute_knee(clear)
    falling = [(2, 0.9), (3, 0.5), (4, 0.2)]
    assert tm.choose_k(curve(spark, falling)) == brute_knee(falling)
    assert tm.choose_k(curve(spark, [(5, 0.3)])) == 5


def test_knee_on_random_curves(spark):
    rng = random.Random(11)
    for _ in range(8):
        values, level = [], 0.2
        for k in range(2, 2 + rng.randint(3, 9)):
            level += rng.choice([0.125, 0.0625, 0.03125, -0.03125])
            values.append((k, level))
        if len({v for _, v in values}) > 1:
            assert tm.choose_k(curve(spark, values)) == brute_knee(values), values


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(2)
    groups = [[f"{g}{i}" for i in range(30)] for g in ("perro", "luna", "tren")]
    lists = [rng.choices(groups[i % 3], k=25) for i in range(150)]
    tokens = token_table(spark, lists).drop("topic")
    settings = tm.LdaSettings(passes=20)
    vectors = tm.vectorize(tokens, settings)
    return tokens, vectors, tm.lda_fit(vectors, 3, settings), settings


def test_topics_are_found_again(spark, fitted, tmp_path):
    tokens, vectors, model, settings = fitted
    done = tm.classify(tokens, model, vectors.counter)
    rows = done.select(F.col("post_id") % 3, "topic", "topic_proba").collect()
    assert all(sum(r.topic_proba) == pytest.approx(1, abs=1e-6) for r in rows)
    best = Counter((r[0], r.topic) for r in rows)
    assert sum(max(n for (g, _), n in best.items() if g == k) for k in range(3)) / len(rows) > 0.9
    wide = tm.topic_proba_wide(done, 3)
    assert wide.columns[-4:] == ["Topic", "Topic_0_proba", "Topic_1_proba", "Topic_2_proba"]
    terms = tm.topic_terms(model, vectors.counter, 5)
    assert terms.count() == 15
    tm.save_model(model, vectors.counter, str(tmp_path), 3)
    again = tm.topic_terms(*tm.load_model(str(tmp_path), 3), 5)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, terms.collect()))
    twice = tm.lda_fit(vectors, 3, settings)
    assert (twice.topicsMatrix().toArray() == model.topicsMatrix().toArray()).all()
    assert tm.topic_projection_2d(done).count() == len(rows)


def test_only_missing_models_are_fitted(spark, fitted, tmp_path):
    tokens, *_ = fitted
    stored = curve(spark, [(2, 0.25)])
    got = tm.lda_range(tokens, [2, 3], str(tmp_path), stored, tm.LdaSettings(passes=2))
    rows = {r.k: r.coherence for r in got.collect()}
    assert rows[2] == 0.25 and set(rows) == {2, 3}
    assert [p.name for p in tmp_path.iterdir()] == ["k=3"]


def test_languages_are_found_again(spark):
    """Four languages in the documents: four topics should tell most of them apart. The floor is the one of the blueprint."""
    from tertulia.plans import queries

    rows = queries._classified(spark, "/root/testdata/sf0.01").groupBy("lang_topic", "topic").count().collect()
    best = Counter()
    for r in rows:
        best[r.topic] = max(best[r.topic], r["count"])
    assert sum(best.values()) / sum(r["count"] for r in rows) > 0.7


def test_posts_without_known_terms_get_the_prior(spark):
    docs = token_table(spark, [["a", "b"], ["a", "c"], ["b", "c", "c"]] * 4)
    vectors = tm.vectorize(docs)
    model = tm.lda_fit(vectors, 2)
    rows = tm.classify(token_table(spark, [[], ["zzz"], ["a"]]), model, vectors.counter).orderBy("post_id").collect()
    assert rows[0].topic_proba == rows[1].topic_proba == [0.5, 0.5] and rows[0].topic == 0
    assert all(sum(r.topic_proba) == pytest.approx(1) for r in rows)


def test_a_round_asks_the_driver_for_few_jobs(spark):
    vectors = tm.vectorize(token_table(spark, [["a", "b"], ["a", "c"], ["b", "c", "c"]] * 10))
    sc, jobs = spark.sparkContext, {}
    for passes in (1.0, 2.0):
        sc.setJobGroup(f"rounds-{passes}", "rounds of a fit")
        tm.lda_fit(vectors, 2, tm.LdaSettings(passes=passes, batch=0.5))
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        jobs[passes] = len(sc.statusTracker().getJobIdsForGroup(f"rounds-{passes}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    # the two more rounds: their table, and one query of their sums that shuffles nothing
    assert 0 < (jobs[2.0] - jobs[1.0]) / 2 <= 7


def test_all_terms_are_kept_or_fitting_stops(spark):
    docs = token_table(spark, [[f"t{i}" for i in range(40)], ["t1"]])
    assert len(tm.vectorize(docs).counter.vocabulary) == 40
    with pytest.raises(ValueError, match="bytes on the driver"):
        tm.lda_fit(tm.vectorize(docs), 3, tm.LdaSettings(matrix_bytes=40 * 2 * 8))


def test_a_range_goes_on_where_it_stopped(spark, tmp_path):
    docs = token_table(spark, [["a", "b"], ["a", "c"], ["b", "c", "c"]] * 4)
    first = {r.k: r.coherence for r in tm.lda_range(docs, [2], str(tmp_path)).collect()}
    stored = spark.createDataFrame([(2, -5.0)], "k int, coherence double")
    stored.write.mode("overwrite").parquet(f"{tmp_path}/k=2/coherence")  # a value that no fit gives
    after = {r.k: r.coherence for r in tm.lda_range(docs, [2, 3], str(tmp_path)).collect()}
    assert set(first) == {2} and after[2] == -5.0 and set(after) == {2, 3}


def test_topics_without_a_common_term_have_a_distance(spark):
    from tertulia.operators.relevance import topic_distance

    terms = spark.createDataFrame([(0, "a", 1.0), (1, "b", 1.0), (2, "a", 0.5), (2, "c", 0.5)], "topic int, word string, p double")
    found = {(r.topic_a, r.topic_b): r.distance for r in topic_distance(terms).collect()}
    assert set(found) == {(0, 1), (0, 2), (1, 2)}
    assert found[0, 1] == found[1, 2] == pytest.approx(math.log(2)) and 0 < found[0, 2] < math.log(2)


def test_long_emoji_sequences_stay_whole(spark):
    from tertulia.operators import tokens as tk

    text = "\u200d".join(["\U0001F469"] * 12)
    table = spark.createDataFrame([(text, "twelve")], "emoji string, alias string")
    rows = tk.demojize(spark.createDataFrame([(1, f"x {text} y")], "post_id long, content string"), table)
    assert rows.first().content == "x :twelve: y"


def test_other_masters_need_a_shared_folder(spark, monkeypatch):
    from tertulia import session

    class Context:
        master = "spark://host:7077"
        getConf = lambda self: self
        get = lambda self, *a: None
        getCheckpointDir = lambda self: None

    class Session:
        sparkContext = conf = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_models_are_measured_in_one_pass(spark, tmp_path):
    rng = random.Random(21)
    docs = token_table(spark, [[rng.choice("abcdefgh") for _ in range(rng.randrange(1, 40))] for _ in range(60)])
    terms = {2: [(0, "a"), (0, "b"), (0, "zz"), (1, "c"), (1, "d")], 3: [(0, "a"), (0, "h"), (1, "b"), (1, "c"), (2, "e"), (2, "f")]}
    table = spark.createDataFrame([(k, *t) for k, ts in terms.items() for t in ts], "k int, topic int, word string")
    both = {(r.k, r.topic): r.coherence for r in co.coherence_of_models(docs, table, 7).collect()}
    for k, ts in terms.items():
        one = co.coherence_by_topic(docs, spark.createDataFrame(ts, "topic int, word string"), 7).collect()
        assert {(k, r.topic): pytest.approx(r.coherence) for r in one} == {key: v for key, v in both.items() if key[0] == k}


def test_a_stored_model_is_measured_without_a_fit(spark, tmp_path, monkeypatch):
    docs = token_table(spark, [["a", "b"], ["a", "c"], ["b", "c", "c"]] * 4)
    vectors = tm.vectorize(docs)
    tm.save_model(tm.lda_fit(vectors, 2), vectors.counter, str(tmp_path), 2)
    monkeypatch.setattr(tm, "lda_fit", lambda *a: pytest.fail("fitted again"))
    assert [r.k for r in tm.lda_range(docs, [2], str(tmp_path)).collect()] == [2]


def test_topic_map_keeps_distances(spark):
    """Topics on a line, at 0, 1 and 3, and shares of their words."""
    from tertulia.operators.relevance import topic_map

    far = spark.createDataFrame([(0, 1, 1.0), (0, 2, 3.0), (1, 2, 2.0)], "topic_a int, topic_b int, distance double")
    terms = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 1.0), (2, 4.0)], "topic int, n double")
    rows = topic_map(far, terms).orderBy("topic").collect()
    assert [r.share for r in rows] == [0.125, 0.25, 0.625]
    assert [abs(a.x - b.x) for a, b in [(rows[0], rows[1]), (rows[1], rows[2])]] == pytest.approx([1, 2])
    assert [r.y for r in rows] == pytest.approx([0, 0, 0], abs=1e-6)
    one = topic_map(far.limit(0), terms.where("topic = 0")).collect()
    assert [tuple(r) for r in one] == [(0, 0.0, 0.0, 1.0)]


def test_a_model_in_slabs_and_blocks(spark, tmp_path, monkeypatch):
    """No part holds all terms or posts; mixes are those of plain inference, ranks those of the whole matrix."""
    import numpy as np

    from tertulia.operators import lda

    monkeypatch.setattr(lda, "SLAB_TERMS", 3)
    monkeypatch.setattr(lda, "BLOCK_POSTS", 5)
    rng = random.Random(8)
    lists = [[rng.choice("abcdefgh" if i % 2 else "opqrstuvwxyz") + "x" for _ in range(rng.randrange(0, 30))] for i in range(60)]
    docs = token_table(spark, [*lists, None, ["ax", None, "zzz"]]).drop("topic")
    vectors = tm.vectorize(docs, tm.LdaSettings(min_df=2))
    model = tm.lda_fit(vectors, 2)
    assert vectors.counter.table.count() > 4 and vectors.table.select("block").distinct().count() > 4
    words, matrix = vectors.counter.vocabulary, model.topicsMatrix().toArray()
    assert set(words) == {w for ws in lists for w in ws} and len(words) == len(matrix) == vectors.counter.size
    assert model.totals == pytest.approx(matrix.sum(0))
    share = matrix / matrix.sum(0)
    for t in range(2):
        want = sorted(range(len(words)), key=lambda i: (-share[i, t], words[i]))[:6]
        got = tm.topic_terms(model, vectors.counter, 6).where(F.col("topic") == t).orderBy("rank").collect()
        assert [(r.word, pytest.approx(r.weight)) for r in got] == [(words[i], share[i, t]) for i in want]
    assert tm.topic_weights(model).count() == 2 * len(words)
    beta = np.exp(lda._digamma(matrix) - lda._digamma(matrix.sum(0)))
    for r in tm.classify(docs, model, vectors.counter).collect():
        uses = Counter(w for w in r.processed or [] if w in words)
        rows, n, gamma = beta[[words.index(w) for w in uses]], np.array(list(uses.values())), np.ones(2)
        for _ in range(2000 if uses else 0):
            theta = np.exp(lda._digamma(gamma) - lda._digamma(gamma.sum()))
            gamma = 1 + theta * (rows.T @ (n / (rows @ theta)))
        assert r.topic_proba == pytest.approx(gamma / gamma.sum(), abs=1e-3)


def test_posts_leap_to_where_steps_end():
    """Topics that hardly differ: plain steps crawl. Leaps need few steps and end at rest, as the same posts do beside others."""
    import numpy as np

    from tertulia.operators import lda

    rng = np.random.default_rng(4)
    beta = rng.gamma(100, 0.01, (500, 4)) / 500
    lengths = np.array([40, 3, 41, 40, 1, 300, 33])
    at = np.concatenate([rng.choice(500, n, False) for n in lengths])
    at[84:124] = at[:40]
    uses = rng.integers(1, 4, len(at))
    uses[84:124] = uses[:40]
    steps, step = [], lda._step
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(lda, "_step", lambda *a: steps.append(1) or step(*a))
        start = np.ones((len(lengths), 4)) + np.arange(4) / 10
        gamma, ratio = lda._infer(beta, at, uses, lengths, 1.0, start)
    plain, ends = 0, np.cumsum(lengths)
    for low, high, first, last, parts in zip(ends - lengths, ends, start, gamma, np.split(ratio, ends[:-1])):
        rows, n = beta[at[low:high]], uses[low:high]
        step_of = lambda g: 1 + lda._theta(g[None])[0] * (rows.T @ (n / (rows @ lda._theta(g[None])[0])))  # noqa: E731, B023
        assert np.abs(step_of(last) - last).mean() < 1e-3
        assert parts == pytest.approx(n / (rows @ lda._theta(last[None])[0]))
        while np.abs(step_of(first) - first).mean() >= 1e-3:
            first, plain = step_of(first), plain + 1
    assert len(steps) < plain / 3
    assert (gamma[0] == gamma[3]).all()
    assert (lda._infer(beta, at[:40], uses[:40], lengths[:1], 1.0, start[:1])[0][0] == gamma[0]).all()
    x = np.array([[1e-3, 0.3, 2.0, 1e6]])
    assert lda._theta(x) == pytest.approx(np.exp(lda._digamma(x) - lda._digamma(x.sum(1))), rel=1e-9)


def test_rounds_shuffle_no_posts(spark):
    from tertulia.operators import lda

    posts = spark.createDataFrame([], lda._BLOCK)
    linked = spark.createDataFrame([], "slab int, block int, at binary")
    counts, linked = lda._kept(lda._counts_of(posts), "block", 2), lda._kept(linked, "slab", 2)
    weights = spark.createDataFrame([], lda._WEIGHTS)
    plan = lda._inferred(counts, weights, linked, 2, lambda block, sent: sent, "slab int, block int, sent binary")
    text = plan._jdf.queryExecution().executedPlan().toString()
    counts.unpersist()
    linked.unpersist()
    # the slabs' weights and what they send; posts and links lie where they were put
    assert text.count("InMemoryTableScan") == 2 and text.count("ENSURE_REQUIREMENTS") == 2


@pytest.mark.parametrize("least", [1.0, 2, 0.2])
def test_terms_are_those_of_the_vocabulary(spark, least):
    from tertulia.operators import tokens as tk

    rng = random.Random(5)
    docs = token_table(spark, [*([rng.choice("abcdefghijñ\U0001F600") * rng.randrange(1, 4) for _ in range(rng.randrange(0, 9))] for _ in range(40)), None, [None, "a"]])
    n = least if least >= 1 else least * docs.count()
    want = {r.term for r in tk.vocabulary(docs).where(F.col("term").isNotNull() & (F.col("df") >= n)).collect()}
    counter = tm.vectorize(docs, tm.LdaSettings(min_df=least)).counter
    assert sorted(counter.vocabulary) == sorted(want) and counter.size == len(want)
