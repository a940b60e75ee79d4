"""The three jobs of a listening: process and model, classify and report, choose the number of topics."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tertulia.functions.words import stopword_list
from tertulia.operators import coherence, dedupe, graphs, naming, profile, relevance, report, timeline
from tertulia.operators import tokens as tk
from tertulia.operators import topics as tm
from tertulia.session import stage
from tertulia.sources import files
from tertulia.sources.emoji import unicode_aliases
from tertulia.sources.layout import RunLayout


@dataclass(frozen=True)
class MiningConfig:
    """What to read, what to keep, and which models to fit.

    ``key`` names a column of the input that identifies a post. Without one, posts are numbered in the order of file names
    and lines, so that the first of equal posts is the first in the files.
    """

    path: str
    layout: RunLayout
    sep: str = ","
    multiline: bool = True
    language: str = "spanish"
    column_names: Mapping[str, str] = field(default_factory=lambda: dict(profile.COLUMN_NAMES))
    networks: list[str] = field(default_factory=lambda: list(profile.NETWORKS))
    extra_stop_words: list[str] = field(default_factory=list)
    key: str | None = None
    min_topics: int = 1
    max_topics: int = 12
    step: int = 1
    k: int | None = None
    sample_frac: float | None = None
    n_volume: int | None = None
    n_data: int | None = None
    skip_bad_lines: bool = True
    strict_urls: bool = False
    conflict: str = "fail"
    lda: tm.LdaSettings = tm.LdaSettings()


@dataclass(frozen=True)
class MiningResult:
    k: int
    layout: RunLayout
    processed: str
    volumes: dict[str, int]


class _Clock:
    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}

    @contextmanager
    def time(self, name: str) -> Iterator[None]:
        start = time.time()
        yield
        self.seconds[name] = round(time.time() - start, 3)


def _read(spark: SparkSession, c: MiningConfig) -> DataFrame:
    reader = files.scan_csv_tolerant if c.skip_bad_lines else files.scan_csv
    df = reader(spark, c.path, c.sep, c.multiline)
    if c.key:
        return df.withColumnRenamed(c.key, "post_id").withColumn("post_id", F.col("post_id").cast("long"))
    return files.in_file_order(df)


def mine_topics(
    spark: SparkSession, c: MiningConfig, emoji: DataFrame | None = None, lexicon: DataFrame | None = None
) -> MiningResult:
    """Read, profile, clean, deduplicate, find phrases, fit models, choose k, and store everything.

    The order matters and is fixed: samples come before all statistics; posts per network count missing, repeated and
    unlisted posts; repeated posts and hashtags are counted before deduplication; and texts are deduplicated before
    networks are filtered, so the first post of a text decides. Emoji become words, named by ``emoji (emoji, alias)`` or
    else by their Unicode names.
    """
    began = datetime.now()
    layout, mode = c.layout.settle(spark, c.conflict)
    clock, volumes = _Clock(), profile.Volumes()

    with clock.time("Reading"):
        raw = _read(spark, c)
        if c.n_data:
            raw = profile.head_n(raw, c.n_data)
        raw = dedupe.sample_posts(raw, c.sample_frac, c.n_volume)
        named = profile.normalize_columns(raw, c.column_names, keep=["post_id"])
        posts = stage(volumes.watch(named, "read"), "posts")
    with clock.time("Network distribution"):
        files.write_csv(profile.network_distribution(posts), layout.table("network_distribution"), mode)
    present = profile.drop_null_content(posts)
    with clock.time("Repeated post"):
        files.write_csv(profile.repeated_posts(present), layout.table("Repeated_posts"), mode)
    with clock.time("Hash tags table"):
        files.write_csv(profile.hashtag_counts(present), layout.table("Hash_global"), mode)
    with clock.time("Text cleaning"):
        unique = volumes.watch(dedupe.dedupe_content(present), "distinct_text")
        kept = profile.filter_networks(profile.parse_date(unique), c.networks)
        emoji = unicode_aliases(spark) if emoji is None else emoji
        cleaned = stage(tk.clean_posts(kept, emoji=emoji, strict_urls=c.strict_urls), "cleaned")
    with clock.time("Drop duplicates after cleaning"):
        distinct = stage(volumes.watch(dedupe.dedupe_tokens(cleaned), "distinct_tokens"), "distinct")
    with clock.time("Bigram instance"):
        phrases = stage(tk.phrase_model(distinct), "phrases")
    with clock.time("Text processing"):
        stop = stopword_list(c.language, c.extra_stop_words)
        done = tk.process_words(distinct, stop, phrases, lexicon)
        files.write_processed(done, layout.results, mode, csv=True)
        processed = f"{layout.results}/df_processed.parquet"
        done = files.scan_parquet(spark, processed)
        tk.bag_of_words(done).write.mode(mode).parquet(layout.table("bow"))
    with clock.time("Modeling LDA"):
        ks = [c.k] if c.k else list(range(c.min_topics, c.max_topics, c.step))
        curve = stage(tm.lda_range(done, ks, layout.models, settings=c.lda), "coherence")
        pairs = curve.select(F.col("k").alias("Topics"), F.col("coherence").alias("Coherence")).orderBy("Topics")
        files.write_csv(pairs, layout.table("Coherence_values"), mode)
        k = c.k or tm.choose_k(curve)

    rows = volumes.rows()
    values = {
        "Recommended k": k,
        "Path_raw_data": c.path,
        "Path_output": layout.results,
        "Path_output_model": layout.models,
        "Used Library": "pyspark",
        "Column_used_and_new_names": dict(c.column_names),
        "Social_networks_used": c.networks,
        "Time process": clock.seconds,
        "Optimization": True,
        "Number of cpus": spark.sparkContext.defaultParallelism,
        "data volume": rows,
        "Start date": began.strftime("%Y-%m-%d %H:%M:%S"),
        "End Date": datetime.now().strftime("%Y-%m-%d %H:%M:%S"),
    }
    record = report.run_report(spark, values, c.k, c.min_topics, c.max_topics)
    files.write_document(report.as_document(record), layout.table("metadata"), mode)
    return MiningResult(k, layout, processed, rows)


def classify_and_report(
    spark: SparkSession, layout: RunLayout, k: int, num_words: int = 25, graphs_too: bool = False, mode: str = "errorifexists",
    context: str = "", title_language: str = "Spanish",
) -> DataFrame:
    """Classify every processed post with the stored model for ``k`` and write the reports; gives the classified posts.

    Topics are labelled by their first words. The request for better names goes to ``topic_requests``; :func:`name_topics`
    takes the replies.
    """
    done = files.scan_parquet(spark, f"{layout.results}/df_processed.parquet")
    model, counter = tm.load_model(layout.models, k)
    path = layout.table("df_classified.parquet")
    tm.classify(done, model, counter).write.mode(mode).parquet(path)
    posts = files.scan_parquet(spark, path)

    def out(df: DataFrame, name: str, by: list[str] | None = None) -> None:
        files.write_csv(df, layout.table(name), mode, by)

    out(timeline.topic_distribution(posts).withColumnRenamed("topic", "Topic"), "topic_distribution")
    flat = posts.withColumn("processed", F.array_join("processed", " "))
    out(tm.topic_proba_wide(flat, k), "df_classified")
    terms = stage(tm.topic_terms(model, counter, num_words), "terms")
    out(relevance.word_relevance(terms, tk.word_count(posts)), "words_global")
    out(timeline.topic_timeline(posts).withColumnRenamed("topic", "Topic"), "timeline_topicsAll")
    words = timeline.words_topic_timeline(flat)
    out(words.select("date", F.col("topic").alias("Topic"), "processed", F.col("word").alias("Palabra")), "Words_Topic_Timeline")
    short = timeline.words_topic_timeline(flat, carry=("post_id", "date", "topic"))
    top = stage(timeline.top_words_per_topic(short), "top-words")
    hits = timeline.words_timeline_topic(words, top)
    named = hits.select("date", F.col("topic").alias("Topic"), "processed", F.col("word").alias("Palabra"), F.col("topic").alias("topic_id"))
    out(named, "words_timeline_topic", ["topic_id"])
    labels = naming.default_labels(terms)
    out(labels, "topic_names")
    naming.request_table(naming.topic_prompt(terms, context, title_language)).write.mode(mode).json(layout.table("topic_requests"))
    # the view of the model: all its weights, and the posts' words shared out by their mixes
    weights = tm.topic_weights(model)
    modelled = stage(relevance.model_terms(weights, posts), "model-terms")
    out(relevance.term_relevance(modelled), "term_relevance")
    distances = stage(relevance.topic_distance(modelled), "topic-distances")
    out(distances, "topic_distance")
    out(relevance.topic_map(distances, modelled), "topic_map")
    if graphs_too:
        _report_graphs(posts, terms, layout, mode)
    return posts


def name_topics(spark: SparkSession, layout: RunLayout, k: int, replies: DataFrame) -> DataFrame:
    """Turn ``replies (request_id, reply)`` into ``topic_names``: titles from good replies, labels for all others.

    Requests that are still open are written to ``open_requests``, which replaces those of an earlier call.
    """
    requests = files.scan_json_lines(spark, layout.table("topic_requests"), "request_id string, prompt string")
    replies = stage(replies.select("request_id", "reply"), "replies")
    labels = naming.default_labels(tm.topic_terms(*tm.load_model(layout.models, k), 3))
    named = stage(naming.topic_names(requests, replies, labels, k), "topic-names")
    files.write_csv(named, layout.table("topic_names"), "overwrite")
    naming.open_requests(requests, replies, k).write.mode("overwrite").json(layout.table("open_requests"))
    return named


def _report_graphs(posts: DataFrame, terms: DataFrame, layout: RunLayout, mode: str) -> None:
    vocab = stage(graphs.topic_vocabulary(posts), "vocab")
    edges = stage(graphs.term_cosine_edges(posts, vocab), "edges")
    nodes = stage(graphs.graph_nodes(vocab, graphs.closeness(edges), graphs.betweenness(edges)), "nodes")
    top = stage(graphs.top_sqrt_edges(graphs.adjacent_words(posts)), "top-edges")
    story = graphs.topic_story(graphs.break_cycles(top))
    naming.visual_payload(terms, nodes, edges, story).write.mode(mode).json(layout.table("visualization"))
    tm.topic_projection_2d(posts).write.mode(mode).json(layout.table("points"))


def choose_from_stored(spark: SparkSession, layout: RunLayout) -> DataFrame:
    """The stored coherence curve with the recommended number of topics marked."""
    curve = files.scan_coherence(spark, layout.table("Coherence_values"))
    return coherence.coherence_curve(curve, tm.choose_k(curve))


def more_topics(spark: SparkSession, c: MiningConfig, layout: RunLayout, ks: list[int]) -> DataFrame:
    """The values of the requested numbers of topics; only missing ones are fitted, and the stored curve is extended by them."""
    stored = stage(files.scan_coherence(spark, layout.table("Coherence_values")), "coherence")
    done = files.scan_parquet(spark, f"{layout.results}/df_processed.parquet")
    found = stage(tm.lda_range(done, ks, layout.models, stored, replace(c.lda)), "coherence")
    curve = stored.join(found, "k", "left_anti").select("k", "coherence").unionByName(found.select("k", "coherence"))
    pairs = curve.select(F.col("k").alias("Topics"), F.col("coherence").alias("Coherence")).orderBy("Topics")
    files.write_csv(pairs, layout.table("Coherence_values"), "overwrite")
    return found
