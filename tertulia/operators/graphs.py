"""Term graphs per topic: similarity edges, centralities, and the story of leading word pairs.

Similarity graphs have at most ``max_terms`` nodes per topic whatever the size of the collection; word-pair graphs have
about the square root of the number of distinct pairs. All topics go through each loop together, and each round is
written before the next one starts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tertulia.functions.sequences import adjacent
from tertulia.operators.cycles import break_cycles  # noqa: F401
from tertulia.operators.selection import RANKED, first_rows, number_text
from tertulia.operators.timeline import doc_freq, top_per_topic
from tertulia.session import stage

MAX_TERMS = 500
# Tasks that add up the matrices of all others.
ADDERS = 32


def topic_vocabulary(df: DataFrame, max_terms: int = MAX_TERMS, column: str = "processed") -> DataFrame:
    """The terms of each topic found in most posts: ``(topic, term, df, freq)``, at most ``max_terms`` per topic."""
    words = F.filter(F.transform(F.col(column), F.lower), lambda t: F.length(t) >= 2)
    lowered = df.select("topic", words.alias(column))
    return top_per_topic(doc_freq(lowered, column=column), max_terms, by="df", word="term").drop("rank")


def _pair_counts(batches: Iterator[pa.RecordBatch], terms: dict[int, dict[str, int]]) -> Iterator[pa.RecordBatch]:
    """Posts holding both terms, per topic, summed over one task with a 0/1 matrix product."""
    sums = {topic: np.zeros((len(ids), len(ids))) for topic, ids in terms.items()}
    for batch in batches:
        topics, lists = batch.column(0).to_numpy(), batch.column(1)
        words = lists.flatten().dictionary_encode()
        names, index = words.dictionary.to_pylist(), words.indices.to_numpy()
        row = np.repeat(np.arange(len(topics)), lists.value_lengths().to_numpy())
        for topic in np.unique(topics).tolist():
            ids, mine = terms[topic], topics[row] == topic
            code = np.array([ids.get(name, -1) for name in names], np.int64)
            at, col = row[mine], code[index[mine]]
            for low in range(0, len(topics), 2048):
                inside = (at >= low) & (at < low + 2048)
                if inside.any():
                    seen = np.zeros((2048, len(ids)), np.float32)
                    seen[at[inside] - low, col[inside]] = 1
                    sums[topic] += seen.T @ seen
    for topic, total in sums.items():
        if total.any():
            upper = total[np.triu_indices(len(total), 1)].astype(np.int64)
            yield pa.record_batch([pa.array([topic], pa.int32()), pa.array([upper.tobytes()])], names=["topic", "counts"])


def _added(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
    """Matrices of a task added up per topic."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for topic, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(counts, np.int64)
            sums[topic] = sums[topic] + part if topic in sums else part
    return sums


def _half_added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for topic, total in _added(batches).items():
        yield pa.record_batch([pa.array([topic], pa.int32()), pa.array([total.tobytes()])], names=["topic", "counts"])


def _as_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for topic, total in _added(batches).items():
        size = round((1 + (1 + 8 * len(total)) ** 0.5) / 2)
        a, b = (side[total > 0] for side in np.triu_indices(size, 1))
        columns = [pa.array(c.astype(np.int32)) for c in (np.full(len(a), topic), a, b)] + [pa.array(total[total > 0])]
        yield pa.record_batch(columns, names=["topic", "a", "b", "co"])


def _at_most(nodes: DataFrame, max_terms: int, by: str = "topic") -> None:
    """An error where a topic has more than ``max_terms`` rows: what follows holds a matrix of them per topic."""
    largest = nodes.groupBy(by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest > max_terms:
        raise ValueError(f"a topic has {largest} terms, more than max_terms={max_terms}")


def term_cosine_edges(df: DataFrame, vocab: DataFrame, column: str = "processed", max_terms: int = MAX_TERMS) -> DataFrame:
    """Cosine of the 0/1 post vectors of each two vocabulary terms of a topic that share a post: ``src < dst``.

    The vocabulary of a topic (``max_terms`` at most, else an error) travels to the posts as one array. Each task adds its
    posts up in one matrix per topic. The matrices are added up in two steps, ``ADDERS`` tasks and then one per topic, and
    pairs of terms become rows only after that, once per topic whatever the number of tasks.
    """
    _at_most(vocab, max_terms)
    terms: dict[int, dict[str, int]] = {}
    for r in vocab.select("topic", "term").orderBy("topic", "term").collect():
        ids = terms.setdefault(r.topic, {})
        ids[r.term] = len(ids)
    shared = df.sparkSession.sparkContext.broadcast(terms)
    lists = vocab.groupBy("topic").agg(F.collect_set("term").alias("_vocab"))
    lowered = F.array_distinct(F.transform(F.col(column), F.lower))
    posts = df.join(F.broadcast(lists), "topic").select(
        F.col("topic").cast("int").alias("topic"), F.array_intersect(lowered, F.col("_vocab")).alias("terms")
    )
    sums = posts.mapInArrow(lambda b: _pair_counts(b, shared.value), "topic int, counts binary")
    half = sums.repartition(ADDERS).mapInArrow(_half_added, "topic int, counts binary")
    counts = half.repartition("topic").mapInArrow(_as_pairs, "topic int, a int, b int, co long")
    place = F.row_number().over(Window.partitionBy("topic").orderBy("term")) - 1
    df_term = F.col("df").cast("double").alias("df")
    known = vocab.select(F.col("topic").cast("int").alias("topic"), "term", df_term, place.alias("id"))
    left = F.broadcast(known.select("topic", F.col("id").alias("a"), F.col("term").alias("src"), F.col("df").alias("df_a")))
    right = F.broadcast(known.select("topic", F.col("id").alias("b"), F.col("term").alias("dst"), F.col("df").alias("df_b")))
    weighted = counts.join(left, ["topic", "a"]).join(right, ["topic", "b"])
    return weighted.select("topic", "src", "dst", (F.col("co") / F.sqrt(F.col("df_a") * F.col("df_b"))).alias("weight"))


def inverse_weight(edges: DataFrame) -> DataFrame:
    return edges.withColumn("weight", 1 / F.col("weight"))


def node_frequency_rank(vocab: DataFrame) -> DataFrame:
    """Position of each term when the topic's terms are ordered by frequency, rarest first, from 0."""
    order = Window.partitionBy("topic").orderBy("freq", "term")
    return vocab.select("topic", "term", "freq", (F.row_number().over(order) - 1).alias("rank"))


def _numbered(edges: DataFrame, max_terms: int) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(topic, term, id)`` with small numbers, and every edge in both directions by number; an error where a topic
    has more than ``max_terms`` nodes."""
    ends = edges.select("topic", F.col("src").alias("term")).union(edges.select("topic", F.col("dst").alias("term")))
    order = Window.partitionBy("topic").orderBy("term")
    nodes = stage(ends.distinct().withColumn("id", F.row_number().over(order) - 1), "graph-nodes")
    _at_most(nodes, max_terms)
    u = F.broadcast(nodes.select("topic", F.col("term").alias("src"), F.col("id").alias("u")))
    v = F.broadcast(nodes.select("topic", F.col("term").alias("dst"), F.col("id").alias("v")))
    one = edges.join(u, ["topic", "src"]).join(v, ["topic", "dst"]).select("topic", "u", "v")
    return nodes, stage(one.union(one.select("topic", F.col("v"), F.col("u"))), "graph-edges")


def _ones(words: list[Column]) -> Column:
    total = F.bit_count(words[0])
    for w in words[1:]:
        total = total + F.bit_count(w)
    return total


def closeness(edges: DataFrame, max_terms: int = MAX_TERMS) -> DataFrame:
    """Closeness by number of hops, scaled by the share of the graph a node reaches: ``(topic, term, closeness)``.

    Each node keeps the set of nodes within d hops as bits in a row of integers. One round ORs the sets of its
    neighbours; the bits gained in round d are the nodes at distance d.
    """
    nodes, arcs = _numbered(edges, max_terms)
    width = (nodes.agg(F.max("id")).first()[0] or 0) // 64 + 1
    names = [f"w{i}" for i in range(width)]
    bit = F.expr("shiftleft(1L, id % 64)")
    own = [F.when(F.floor(F.col("id") / 64) == i, bit).otherwise(F.lit(0)).cast("long").alias(w) for i, w in enumerate(names)]
    state = nodes.select("topic", "id", *own, F.lit(1).alias("reached"), F.lit(0).cast("long").alias("distance"))
    reached, hops = -1, 0
    while True:
        state = stage(state, "closeness")
        now = state.agg(F.sum("reached")).first()[0]
        if now == reached:
            break
        reached, hops = now, hops + 1
        sets = F.broadcast(state.select("topic", F.col("id").alias("v"), *names))
        near = arcs.join(sets, ["topic", "v"]).groupBy("topic", F.col("u").alias("id"))
        near = near.agg(*[F.bit_or(w).alias(f"n_{w}") for w in names])
        grown = state.join(near, ["topic", "id"]).select(
            "topic", "id", "reached", "distance", *[F.col(w).bitwiseOR(F.col(f"n_{w}")).alias(w) for w in names]
        )
        count = _ones([F.col(w) for w in names])
        gained = F.col("distance") + hops * (count - F.col("reached"))
        state = grown.select("topic", "id", *names, count.alias("reached"), gained.alias("distance"))
    sizes = nodes.groupBy("topic").agg(F.count(F.lit(1)).alias("size"))
    others = F.col("reached") - 1
    scaled = F.try_divide(others, F.col("distance")) * F.try_divide(others, F.col("size") - 1)
    return (
        state.join(F.broadcast(nodes), ["topic", "id"])
        .join(F.broadcast(sizes), "topic")
        .select("topic", "term", F.coalesce(scaled, F.lit(0.0)).alias("closeness"))
    )


def _push(batches: Iterator[pa.RecordBatch], links: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Values held at nodes, passed to the neighbours of those nodes: one matrix product per topic and batch."""
    for batch in batches:
        topics = batch.column(0).to_numpy()
        sources = batch.column(1).to_numpy()
        row = np.repeat(np.arange(len(topics)), batch.column(2).value_lengths().to_numpy())
        at, value = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
        for topic in np.unique(topics):
            mine, matrix = topics[row] == topic, links[int(topic)]
            held = np.zeros((len(topics), len(matrix)))
            held[row[mine], at[mine]] = value[mine]
            passed = held @ matrix
            s, v = np.nonzero(passed)
            ids = [np.full(len(s), topic, np.int32), sources[s].astype(np.int32), v.astype(np.int32)]
            yield pa.record_batch([pa.array(c) for c in [*ids, passed[s, v]]], names=["topic", "s", "v", "value"])


def betweenness(edges: DataFrame, max_terms: int = MAX_TERMS) -> DataFrame:
    """Share of shortest paths (by hops) through each node: ``(topic, term, betweenness)``; Brandes 2001 by levels.

    Forward, the nodes a source reached in the last round pass their path counts to their neighbours; pairs seen before
    are taken out. Backward, each level hands its dependencies to the level before it. Spark keeps the pairs and levels;
    each task multiplies its sources' values with the 0/1 neighbour matrix of the topic, ``max_terms`` wide at most.
    """
    nodes, arcs = _numbered(edges, max_terms)
    spark = edges.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # at most max_terms rows of at most max_terms numbers per topic
    near = arcs.groupBy("topic", "u").agg(F.collect_list("v").alias("near")).collect()
    sizes = {r.topic: r.n for r in nodes.groupBy("topic").agg(F.count(F.lit(1)).alias("n")).collect()}
    links = {topic: np.zeros((n, n), bool) for topic, n in sizes.items()}
    for r in near:
        links[r.topic][r.u, r.near] = True
    shared = spark.sparkContext.broadcast(links)

    def push(values: DataFrame) -> DataFrame:
        """For each source the sum of ``value`` that nodes receive from their neighbours."""
        held = F.collect_list("v").alias("at"), F.collect_list("value").alias("value")
        lists = values.repartition(parts, "topic", "s").groupBy("topic", "s").agg(*held)
        return lists.mapInArrow(lambda b: _push(b, shared.value), "topic int, s int, v int, value double")

    on = ["topic", "s", "v"]
    levels = [stage(arcs.select("topic", F.col("u").alias("s"), "v", F.lit(1.0).alias("value")), "paths")]
    seen = levels[0].select(on).union(nodes.select("topic", F.col("id").alias("s"), F.col("id").alias("v")))
    while True:
        level = stage(push(levels[-1]).join(seen, on, "left_anti"), "paths")
        if level.isEmpty():
            break
        levels.append(level)
        seen = seen.union(level.select(on))
    zero = F.lit(0.0)
    share = levels[-1].withColumnRenamed("value", "paths").withColumn("share", zero)
    shares = []
    for before in levels[-2::-1]:
        give = share.select(*on, ((1 + F.col("share")) / F.col("paths")).alias("value"))
        paths, given = before.withColumnRenamed("value", "paths"), push(give)
        handed = F.coalesce(F.col("paths") * F.col("value"), zero).alias("share")
        share = stage(paths.join(given, on, "left").select(*on, "paths", handed), "shares")
        shares.append(share.groupBy("topic", "v").agg(F.sum("share").alias("share")))
    sizes = nodes.groupBy("topic").agg(F.count(F.lit(1)).alias("size"))
    out = nodes.join(F.broadcast(sizes), "topic").withColumnRenamed("id", "v")
    if not shares:
        return out.select("topic", "term", zero.alias("betweenness"))
    total = shares[0]
    for part in shares[1:]:
        total = total.union(part)
    total = total.groupBy("topic", "v").agg(F.sum("share").alias("share"))
    scale = (F.col("size") - 1) * (F.col("size") - 2)
    value = F.coalesce(F.try_divide(F.col("share"), scale), zero)
    return out.join(total, ["topic", "v"], "left").select("topic", "term", value.alias("betweenness"))


def graph_nodes(vocab: DataFrame, close: DataFrame, between: DataFrame) -> DataFrame:
    """Every vocabulary term with its measures; a term without edges keeps 0."""
    on = ["topic", "term"]
    joined = node_frequency_rank(vocab).join(F.broadcast(close), on, "left").join(F.broadcast(between), on, "left")
    return joined.fillna(0.0, ["closeness", "betweenness"])


def adjacent_words(df: DataFrame, column: str = "processed") -> DataFrame:
    """Uses of each ordered pair of neighbouring words per topic, lower-cased; combined before the shuffle."""
    lowered = df.select("topic", F.transform(F.col(column), F.lower).alias("_words"))
    pairs = lowered.select("topic", F.explode(adjacent(F.col("_words"))).alias("p"))
    return pairs.groupBy("topic", F.col("p.a").alias("word"), F.col("p.b").alias("next_word")).agg(F.count(F.lit(1)).alias("n"))


def top_sqrt_edges(pairs: DataFrame, ranked: int = RANKED) -> DataFrame:
    """Per topic the ``ceil(sqrt(E))`` most used word pairs, E being the topic's pairs of two different words.

    The limit grows with the topic, so where it is large the last pair is found by counting, and no task ranks all of them.
    """
    proper = stage(pairs.where("word <> next_word"), "word-pairs")
    limits = proper.groupBy("topic").agg(F.ceil(F.sqrt(F.count(F.lit(1)))).alias("limit"))
    # a separator below all letters keeps the order of the words
    order = F.concat(number_text(-F.col("n")), "word", F.lit("\u0001"), "next_word")
    # the first round counts the pairs of each number of uses, 20 digits: there are few of them
    return first_rows(proper, order, limits, ["topic"], ranked, lead=20).select("topic", "word", "next_word", "n")


def topic_story(edges: DataFrame, steps: int = 4) -> DataFrame:
    """Level of each word of an acyclic graph: the length of the longest way to it, ``(topic, word, level)``.

    Ordered by level and word, the words are a topological order. Levels rise along the edges until nothing changes;
    each round takes ``steps`` steps before it is written.
    """
    e = stage(edges.select("topic", "word", "next_word"), "story")
    words = e.select("topic", "word").union(e.select("topic", F.col("next_word").alias("word"))).distinct()
    state = stage(words.withColumn("level", F.lit(0)), "story-levels")
    most, before, rounds = state.count(), -1, 0
    while True:
        now = state.agg(F.sum("level")).first()[0] or 0
        if now == before:
            return state
        if (rounds - 1) * steps >= most:
            raise ValueError("the graph has a cycle; call break_cycles first")
        before, rounds = now, rounds + 1
        for _ in range(steps):
            raised = e.join(state, ["topic", "word"]).groupBy("topic", F.col("next_word").alias("word"))
            raised = raised.agg((F.max("level") + 1).alias("_up"))
            level = F.greatest("level", F.coalesce("_up", F.lit(0))).alias("level")
            state = state.join(raised, ["topic", "word"], "left").select("topic", "word", level)
        state = stage(state, "story-levels")
