"""The posts that the registered queries run on, built from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tertulia.functions.words import stopword_list
from tertulia.operators.tokens import clean_posts, word_count
from tertulia.sources.files import spread_out
from tertulia.session import stage

NETWORKS = ["click", "purchase", "view"]
EXTRA_STOP = ["mas", "asi", "aca"]


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per document with the event and the page of the same number.

    ``content`` and ``content_tagged`` lack text on some rows, for the operators that deal with missing text;
    ``full_text`` is the text of every document. ``topic`` stands in for a model's topic.
    """
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    d = spread_out(d.withColumnRenamed("doc_id", "post_id"), "post_id")
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("event_id", "post_id")
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumnRenamed("page_id", "post_id").select("post_id", "url")
    joined = d.join(e, "post_id", "left").join(p, "post_id", "left")
    missing = F.col("post_id") % 50 == 7
    tagged = F.concat_ws(" ", "text", F.concat(F.lit("#"), "event_type"), F.concat(F.lit("#"), "lang"), "url")
    return joined.select(
        "post_id",
        F.col("user_id").cast("string").alias("author"),
        F.when(~missing, F.col("text")).alias("content"),
        F.when(~missing, tagged).alias("content_tagged"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.col("props").alias("context"),
        F.col("url").alias("link"),
        F.col("event_type").alias("domain_group"),
        F.col("lang").alias("country"),
        F.col("source").alias("type"),
        F.when(F.col("lang") == "de", 0).when(F.col("lang") == "en", 1).when(F.col("lang") == "es", 2).otherwise(3).alias("topic"),
        F.col("text").alias("full_text"),
    )


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with the token list of their whole text."""
    cleaned = clean_posts(posts(spark, sf_dir), "full_text")
    return cleaned.select("post_id", "topic", "date", "author", "processed")


def joined_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like :func:`tokens`, with the tokens joined by blanks."""
    return tokens(spark, sf_dir).withColumn("processed", F.array_join("processed", " "))


def stop_words() -> list[str]:
    return stopword_list("english", EXTRA_STOP)


def curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A concave curve ``(k, coherence)``: the share of all tokens that the k most used words cover, k = 1 to 12."""
    counts = stage(word_count(tokens(spark, sf_dir)), "word-counts")
    total = counts.agg(F.sum("n").alias("n")).scalar()
    top = counts.orderBy(F.desc("n"), "word").limit(12)
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "word")
    covered = F.sum("n").over(order)
    ranked = top.select(F.row_number().over(order).alias("k"), covered.alias("covered"))
    return ranked.select("k", F.round(F.col("covered") / total, 6).alias("coherence"))


def lexicon(words: DataFrame) -> DataFrame:
    """A lexicon ``(form, pos, lemma)`` for a vocabulary ``(word)``: part of speech and lemma by ending.

    Words of two letters count as determiners; words without a known ending are left out of the lexicon.
    """
    form = F.col("word")
    pos = (
        F.when(F.length(form) == 2, "DET")
        .when(form.endswith("tion"), "NOUN")
        .when(form.endswith("ly"), "ADV")
        .when(form.endswith("ing"), "VERB")
        .when(form.endswith("er"), "ADJ")
    )
    lemma = F.regexp_replace(form, F.lit("(ing|er)$"), F.lit(""))
    return words.select(form.alias("form"), pos.alias("pos"), lemma.alias("lemma")).where("pos is not null")


def topic_mix(df: DataFrame) -> DataFrame:
    """A topic mix for each post: equal parts, its own topic counted twice."""
    parts = [F.when(F.col("topic") == i, 2.0).otherwise(1.0) / 5 for i in range(4)]
    return df.select("post_id", F.array(*parts).alias("topic_proba"))
