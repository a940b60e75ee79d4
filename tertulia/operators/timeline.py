"""Topics over time: distributions, word timelines and the leading words of each topic.

Every table here groups first and ranks afterwards. Ranking within a topic keeps at most n rows per task before the
shuffle, so a topic that holds a third of the words does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tertulia.functions.text import fold_tildes, split_tokens


def topic_distribution(df: DataFrame, topic: str = "topic") -> DataFrame:
    return df.groupBy(topic).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), topic)


def topic_share(df: DataFrame, topic: str = "topic") -> DataFrame:
    """Share of the posts in each topic; the window runs over one row per topic."""
    counts = df.groupBy(topic).agg(F.count(F.lit(1)).alias("count"))
    share = F.col("count") / F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.select(topic, share.alias("share"))


def topic_timeline(df: DataFrame, grain: str | None = None, topic: str = "topic") -> DataFrame:
    """Posts with a known author per date and topic; ``grain`` ("day", "month" ...) coarsens the full timestamp."""
    when = F.date_trunc(grain, "date").alias("date") if grain else F.col("date")
    return df.groupBy(when, topic).agg(F.count("author").alias("author"))


CARRIED = ("date", "topic", "processed")


def explode_words(df: DataFrame, carry: tuple[str, ...] = CARRIED, column: str = "processed") -> DataFrame:
    """One row per word of each post; ``column`` is the joined text.

    The published table repeats the whole text on every row. Where only the words matter, ``carry`` the post's key in
    its place: rows then stay small whatever the length of the posts.
    """
    present = df.dropna("any", subset=[*carry, column])
    return present.select(*carry, F.explode(split_tokens(F.col(column))).alias("word"))


def words_topic_timeline(df: DataFrame, carry: tuple[str, ...] = CARRIED, column: str = "processed") -> DataFrame:
    """Like :func:`explode_words`, plus one row with an empty word per post, as the published table has it."""
    present = df.dropna("any", subset=[*carry, column])
    words = F.concat(split_tokens(F.col(column)), F.array(F.lit("")))
    return present.select(*carry, F.explode(words).alias("word"))


def topic_word_count(df: DataFrame, topic: str = "topic") -> DataFrame:
    """Uses of each accent-folded word per topic, from rows ``(topic, word)``; the empty word does not count."""
    words = df.select(topic, fold_tildes(F.col("word")).alias("word")).where("word <> ''")
    return words.groupBy(topic, "word").agg(F.count(F.lit(1)).alias("n"))


def top_per_topic(counts: DataFrame, n: int, by: str = "n", word: str = "word", topic: str = "topic") -> DataFrame:
    """The ``n`` rows of each topic with the highest ``by``; equal values in order of the word. Adds ``rank`` from 1."""
    order = Window.partitionBy(topic).orderBy(F.desc(by), word)
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_words_per_topic(df: DataFrame, n: int = 6, topic: str = "topic") -> DataFrame:
    return top_per_topic(topic_word_count(df, topic), n, topic=topic)


def words_timeline_topic(timeline: DataFrame, top: DataFrame, topic: str = "topic") -> DataFrame:
    """Rows of the word timeline whose folded word is among the topic's leading words.

    ``top`` holds a handful of words per topic, so it is broadcast and the timeline is not shuffled.
    """
    folded = timeline.withColumn("word", fold_tildes(F.col("word")))
    return folded.join(F.broadcast(top.select(topic, "word")), [topic, "word"], "left_semi")


def topic_weight_scale(weights: DataFrame, weight: str = "importance", topic: str = "topic") -> DataFrame:
    """Upper axis limit per topic: a ninth above the largest weight, rounded up to 1/500."""
    return weights.groupBy(topic).agg((F.ceil(F.max(weight) / 0.9 * 500) / 500).alias("scale"))


def doc_freq(df: DataFrame, topic: str = "topic", column: str = "processed") -> DataFrame:
    """Posts per topic and term (``df``) and their share of the topic's posts (``freq``)."""
    terms = df.select(topic, F.explode(F.array_distinct(column)).alias("term"))
    counts = terms.groupBy(topic, "term").agg(F.count(F.lit(1)).alias("df"))
    totals = df.groupBy(topic).agg(F.count(F.lit(1)).alias("n_docs"))
    # one row per topic
    return counts.join(F.broadcast(totals), topic).select(topic, "term", "df", (F.col("df") / F.col("n_docs")).alias("freq"))
