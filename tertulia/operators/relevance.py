"""How strongly terms belong to topics, and how far topics lie apart."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_relevance(topic_terms: DataFrame, counts: DataFrame) -> DataFrame:
    """Leading terms of each topic with their weight and their number of uses in the collection.

    ``topic_terms`` has a few dozen rows per topic. Broadcasting it reduces the unbounded word counts to those terms
    first; the outer join that brings back unused terms then sees two small tables.
    """
    wanted = topic_terms.select("word").distinct()
    used = counts.join(F.broadcast(wanted), "word", "left_semi")
    joined = topic_terms.join(F.broadcast(used), "word", "left")
    return joined.select(
        "word", F.col("topic").alias("topic_id"), F.col("weight").alias("importance"), F.coalesce("n", F.lit(0)).alias("word_count")
    ).orderBy("topic_id", "importance", "word")


def empirical_terms(counts: DataFrame) -> DataFrame:
    """``(topic, word, n)`` counts to ``(topic, word, n, p)`` with p the share of the topic's words."""
    totals = counts.groupBy("topic").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "topic").select("topic", "word", "n", (F.col("n") / F.col("total")).alias("p"))


def term_relevance(terms: DataFrame, weight: float = 0.6) -> DataFrame:
    """Relevance of each term to each topic (Sievert and Shirley 2014) and its saliency (Chuang et al. 2012).

    ``terms`` has ``topic, word, n, p`` where p is the probability of the word in the topic.
    """
    marginal = terms.groupBy("word").agg(F.sum("n").alias("n_word"))
    topics = terms.groupBy("topic").agg(F.sum("n").alias("n_topic"))
    total = topics.agg(F.sum("n_topic").alias("n_all")).scalar()
    shares = topics.withColumn("n_all", total).select("topic", (F.col("n_topic") / F.col("n_all")).alias("p_topic"), "n_all")
    joined = terms.join(marginal, "word").join(F.broadcast(shares), "topic")
    p_word = F.col("n_word") / F.col("n_all")
    lift = F.log(F.col("p") / p_word)
    given = F.col("n") / F.col("n_word")
    scored = joined.select(
        "topic",
        "word",
        (weight * F.log("p") + (1 - weight) * lift).alias("relevance"),
        (given * F.log(given / F.col("p_topic"))).alias("_d"),
        p_word.alias("p_word"),
    )
    salient = scored.groupBy("word").agg((F.max("p_word") * F.sum("_d")).alias("saliency"))
    return scored.join(salient, "word").select("topic", "word", "relevance", "saliency")


def topic_distance(terms: DataFrame) -> DataFrame:
    """Jensen-Shannon divergence of each pair of topics.

    Terms that only one topic has contribute ``ln(2) / 2`` times their probability, so an equi-join on shared terms is
    enough; a term has at most one row per topic.
    """
    a = terms.select("word", F.col("topic").alias("topic_a"), F.col("p").alias("pa"))
    b = terms.select("word", F.col("topic").alias("topic_b"), F.col("p").alias("pb"))
    shared = a.join(b, "word").where("topic_a < topic_b")
    mid = (F.col("pa") + F.col("pb")) / 2
    both = F.col("pa") * F.log(F.col("pa") / mid) + F.col("pb") * F.log(F.col("pb") / mid)
    topics = terms.agg(F.collect_set("topic").alias("all"))
    first = topics.select("all", F.explode("all").alias("topic_a"))
    pairs = first.select("topic_a", F.explode(F.filter("all", lambda t: t > F.col("topic_a"))).alias("topic_b"))
    sums = shared.groupBy("topic_a", "topic_b").agg(F.sum(both).alias("both"), F.sum(F.col("pa") + F.col("pb")).alias("mass"))
    alone = F.log(F.lit(2.0)) * (2 - F.coalesce("mass", F.lit(0.0)))
    # one row per pair of topics, also where they have no term in common
    whole = pairs.join(sums, ["topic_a", "topic_b"], "left")
    return whole.select("topic_a", "topic_b", ((F.coalesce("both", F.lit(0.0)) + alone) / 2).alias("distance"))


def model_terms(terms: DataFrame, mixes: DataFrame, column: str = "processed") -> DataFrame:
    """``(topic, word, n, p)`` of a fitted model: ``p`` is the weight of the word in the topic, ``n`` the words of the posts
    that fall to it. ``terms`` has all words of all topics ``(topic, word, weight)``, ``mixes`` the classified posts, whose
    words are shared out by the mix of their post."""
    sizes = mixes.select(F.size(column).alias("_n"), F.posexplode("topic_proba").alias("topic", "_part"))
    sizes = sizes.groupBy("topic").agg(F.sum(F.col("_n") * F.col("_part")).alias("_size"))
    return terms.join(F.broadcast(sizes), "topic").select("topic", "word", (F.col("weight") * F.col("_size")).alias("n"), F.col("weight").alias("p"))


def topic_centred(distances: DataFrame, topics: DataFrame) -> DataFrame:
    """The double-centred matrix of squared distances, times -1/2: ``(topic_a, topic_b, value)`` for all pairs of ``topics``.

    Both tables have one row per (pair of) topics of one model.
    """
    squared = distances.select("topic_a", "topic_b", (F.col("distance") * F.col("distance")).alias("d"))
    turned = squared.select(F.col("topic_b").alias("topic_a"), F.col("topic_a").alias("topic_b"), "d")
    own = topics.select(F.col("topic").alias("topic_a"), F.col("topic").alias("topic_b"), F.lit(0.0).alias("d"))
    full = squared.unionByName(turned).unionByName(own)
    means = full.groupBy("topic_a").agg(F.avg("d").alias("mean"))
    whole = means.agg(F.avg("mean")).scalar()
    both = full.join(means.withColumnRenamed("mean", "mean_a"), "topic_a")
    both = both.join(means.select(F.col("topic_a").alias("topic_b"), F.col("mean").alias("mean_b")), "topic_b")
    value = -(F.col("d") - F.col("mean_a") - F.col("mean_b") + F.col("_whole")) / 2
    return both.withColumn("_whole", whole).select("topic_a", "topic_b", value.alias("value"))


def topic_map(distances: DataFrame, terms: DataFrame) -> DataFrame:
    """A place for each topic such that distances in the plane come near those of the words' distributions, and its share of
    all words: ``(topic, x, y, share)``, classical scaling (Torgerson 1952).

    ``terms`` has ``topic, n``. The driver takes the two leading eigenvectors of a matrix of topics by topics. Axes point to
    where their largest coordinate is positive; one topic lies at 0, and two topics on the x axis.
    """
    sizes = terms.groupBy("topic").agg(F.sum("n").cast("double").alias("size"))
    shares = sizes.crossJoin(F.broadcast(sizes.agg(F.sum("size").alias("whole"))))
    rows = shares.select("topic", (F.col("size") / F.col("whole")).alias("share")).orderBy("topic").collect()
    place = {r.topic: i for i, r in enumerate(rows)}
    matrix = np.zeros((len(rows), len(rows)))
    for r in topic_centred(distances, sizes).collect():
        matrix[place[r.topic_a], place[r.topic_b]] = r.value
    value, axes = np.linalg.eigh(matrix)
    points = np.zeros((len(rows), 2))
    for i, (v, axis) in enumerate(list(zip(value, axes.T))[::-1][:2]):
        if v > 1e-12 * max(1e-300, value[-1]):
            points[:, i] = np.sqrt(v) * axis * np.sign(axis[np.abs(axis).argmax()])
    data = [(r.topic, *points[i].tolist(), r.share) for i, r in enumerate(rows)]
    return terms.sparkSession.createDataFrame(data, "topic int, x double, y double, share double")
