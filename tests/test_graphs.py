import math
import random
from collections import Counter, deque
from itertools import combinations

import pytest

from tertulia.operators import cycles, graphs
from tests.test_operators import token_table


def edge_table(spark, edges, topic=0):
    return spark.createDataFrame([(topic, min(a, b), max(a, b), 0.5) for a, b in edges], "topic int, src string, dst string, weight double")


def brute(edges):
    """Closeness and betweenness by plain search from every node (Brandes 2001)."""
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    n, close, between = len(near), {}, Counter({v: 0.0 for v in near})
    for s in near:
        dist, paths, order, queue = {s: 0}, Counter({s: 1}), [], deque([s])
        while queue:
            u = queue.popleft()
            order.append(u)
            for v in near[u]:
                if v not in dist:
                    dist[v] = dist[u] + 1
                    queue.append(v)
                if dist[v] == dist[u] + 1:
                    paths[v] += paths[u]
        r = len(dist) - 1
        close[s] = (r / sum(dist.values())) * (r / (n - 1)) if r else 0.0
        dep = Counter()
        for v in reversed(order):
            for u in near[v]:
                if dist[u] == dist[v] - 1:
                    dep[u] += paths[u] / paths[v] * (1 + dep[v])
            if v != s:
                between[v] += dep[v]
    scale = (n - 1) * (n - 2)
    return close, {v: b / scale if scale else 0.0 for v, b in between.items()}


def test_path(spark):
    edges = edge_table(spark, [("a", "b"), ("b", "c")])
    assert {r.term: r.closeness for r in graphs.closeness(edges).collect()} == pytest.approx({"a": 2 / 3, "b": 1, "c": 2 / 3})
    assert {r.term: r.betweenness for r in graphs.betweenness(edges).collect()} == {"a": 0, "b": 1, "c": 0}


def test_centralities_of_random_graphs(spark):
    rng, frames, wanted_c, wanted_b = random.Random(4), [], {}, {}
    for topic, (n, p) in enumerate([(60, 0.05), (25, 0.5), (12, 0.15)]):
        edges = [(f"n{a:02}", f"n{b:02}") for a, b in combinations(range(n), 2) if rng.random() < p]
        frames.append(edge_table(spark, edges, topic))
        close, between = brute(edges)
        wanted_c |= {(topic, v): x for v, x in close.items()}
        wanted_b |= {(topic, v): x for v, x in between.items()}
    edges = frames[0].union(frames[1]).union(frames[2])
    assert {(r.topic, r.term): r.closeness for r in graphs.closeness(edges).collect()} == pytest.approx(wanted_c)
    assert {(r.topic, r.term): r.betweenness for r in graphs.betweenness(edges).collect()} == pytest.approx(wanted_b)


def test_cosine_edges(spark):
    rng = random.Random(9)
    lists = [[rng.choice(["aa", "bb", "cc", "dd", "ee", "ff", "Gg"]) for _ in range(rng.randint(0, 5))] for _ in range(200)]
    df = token_table(spark, lists).union(token_table(spark, lists[:50], 1)).repartition(5)
    vocab = graphs.topic_vocabulary(df, 5)
    got = {(r.topic, r.src, r.dst): r.weight for r in graphs.term_cosine_edges(df, vocab).collect()}
    wanted = {}
    for topic, some in ((0, lists), (1, lists[:50])):
        sets = [{w.lower() for w in t} for t in some]
        freq = Counter(w for s in sets for w in s)
        top = sorted(freq, key=lambda w: (-freq[w], w))[:5]
        for a, b in combinations(sorted(top), 2):
            both = sum(a in s and b in s for s in sets)
            if both:
                wanted[topic, a, b] = both / math.sqrt(freq[a] * freq[b])
    assert got == pytest.approx(wanted)


def pair_table(spark, edges, topic=0):
    return spark.createDataFrame([(topic, a, b, n) for a, b, n in edges], "topic int, word string, next_word string, n long")


def test_lightest_edge_of_a_cycle_goes(spark):
    left = graphs.break_cycles(pair_table(spark, [("a", "b", 3), ("b", "c", 2), ("c", "a", 1)]))
    assert sorted((r.word, r.next_word) for r in left.collect()) == [("a", "b"), ("b", "c")]
    story = graphs.topic_story(left).orderBy("level", "word").collect()
    assert [r.word for r in story] == ["a", "b", "c"]


def one_by_one(edges):
    """Take the lightest edge that lies on a cycle until there is none."""
    left = sorted(edges, key=lambda e: (e[2], [-ord(c) for c in e[0]], [-ord(c) for c in e[1]]))

    def reaches(edges, a, b):
        seen, todo = {a}, [a]
        while todo:
            u = todo.pop()
            for x, y, _ in edges:
                if x == u and y not in seen:
                    seen.add(y)
                    todo.append(y)
        return b in seen

    while True:
        found = next((e for e in left if reaches(left, e[1], e[0])), None)
        if found is None:
            return {(a, b) for a, b, _ in left}
        left.remove(found)


@pytest.mark.parametrize("part_edges", [10_000, 0])
def test_cycles_of_random_graphs(spark, part_edges):
    rng, frames, wanted = random.Random(6), [], set()
    for topic in range(3):
        names = "abcdefghij"
        edges = [(a, b, rng.randint(1, 6)) for a in names for b in names if a != b and rng.random() < 0.25]
        frames.append(pair_table(spark, edges, topic))
        wanted |= {(topic, *e) for e in one_by_one(edges)}
    left = graphs.break_cycles(frames[0].union(frames[1]).union(frames[2]), part_edges)
    assert {(r.topic, r.word, r.next_word) for r in left.collect()} == wanted
    level = {(r.topic, r.word): r.level for r in graphs.topic_story(left).collect()}
    assert all(level[t, a] < level[t, b] for t, a, b in wanted)


def parts_of(edges):
    """Strongly connected parts of two nodes or more, by searching from every node."""
    after = {}
    for a, b, _ in edges:
        after.setdefault(a, set()).add(b)

    def reached(a):
        seen, todo = set(), [a]
        while todo:
            for b in after.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        return seen

    reach = {a: reached(a) for a in after}
    return {frozenset(b for b in reach[a] if a in reach.get(b, ())) for a in after if a in reach[a]} - {frozenset()}


def test_strong_parts(spark):
    rng = random.Random(8)
    names = [f"w{i:02}" for i in range(60)]
    edges = [(a, b, 1) for a in names for b in names if a != b and rng.random() < 0.02]
    found = {}
    for r in cycles.strong_parts(pair_table(spark, edges + [("x", "x", 1)])).collect():
        found.setdefault(r.part, set()).update((r.word, r.next_word))
    assert {frozenset(v) for v in found.values()} == parts_of(edges)


@pytest.mark.parametrize("part_edges", [10_000, 0])
def test_a_thousand_parts(spark, part_edges):
    """Rings of three to seven words, two by two linked: each loses its lightest edge, the links between them stay."""
    rng, edges, light = random.Random(9), [], set()
    for i in range(1000):
        size = rng.randint(3, 7)
        ring = [(f"{i}-{j}", f"{i}-{(j + 1) % size}", rng.randint(1, 9)) for j in range(size)]
        edges += ring + ([(f"{i - 1}-0", f"{i}-0", 1)] if i % 2 else [])
        light.add(max(ring, key=lambda e: (-e[2], e[0], e[1]))[:2])
    left = {(r.word, r.next_word) for r in graphs.break_cycles(pair_table(spark, edges), part_edges).collect()}
    assert left == {e[:2] for e in edges} - light


def test_edge_to_itself_goes(spark):
    left = graphs.break_cycles(pair_table(spark, [("a", "a", 9), ("a", "b", 1)])).collect()
    assert [(r.word, r.next_word) for r in left] == [("a", "b")]
    assert graphs.break_cycles(pair_table(spark, [("a", "b", 1)]).limit(0)).count() == 0


def test_story_of_a_cycle_is_an_error(spark):
    with pytest.raises(ValueError):
        graphs.topic_story(pair_table(spark, [("a", "b", 1), ("b", "a", 1)]))


def test_graph_without_cycles_stays(spark):
    edges = pair_table(spark, [("a", "b", 3), ("b", "c", 2)])
    assert graphs.break_cycles(edges).count() == 2


@pytest.mark.parametrize("ranked", [10_000, 2])
def test_top_edges_with_ties(spark, ranked):
    edges = [(f"w{i}", f"x{i % 7}", 1 + i % 2) for i in range(101)] + [("s", "s", 50)]
    got = {(r.word, r.next_word) for r in graphs.top_sqrt_edges(pair_table(spark, edges), ranked).collect()}
    best = sorted((e for e in edges if e[0] != e[1]), key=lambda e: (-e[2], e[0], e[1]))[:11]
    assert got == {(a, b) for a, b, _ in best}


def test_isolated_terms_keep_zero(spark):
    df = token_table(spark, [["aa", "bb"], ["cc"]])
    vocab = graphs.topic_vocabulary(df)
    edges = graphs.term_cosine_edges(df, vocab)
    nodes = graphs.graph_nodes(vocab, graphs.closeness(edges), graphs.betweenness(edges)).collect()
    assert {r.term: (r.rank, r.closeness) for r in nodes} == {"aa": (0, 1.0), "bb": (1, 1.0), "cc": (2, 0.0)}


def test_larger_graphs_are_an_error(spark):
    """What holds a matrix of terms per topic says so before anything is collected."""
    edges = spark.createDataFrame([(0, "a", "b", 1.0), (0, "b", "c", 1.0)], "topic int, src string, dst string, weight double")
    for measure in (graphs.closeness, graphs.betweenness):
        with pytest.raises(ValueError, match="max_terms=2"):
            measure(edges, max_terms=2)
        assert measure(edges, max_terms=3).count() == 3
    df = token_table(spark, [["aa", "bb", "cc"]])
    with pytest.raises(ValueError, match="3 terms"):
        graphs.term_cosine_edges(df, graphs.topic_vocabulary(df), max_terms=2)
    assert graphs.term_cosine_edges(df.limit(0), graphs.topic_vocabulary(df)).count() == 0
