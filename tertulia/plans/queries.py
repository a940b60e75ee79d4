"""One query per operator, each over the whole of the given tables.

Every function takes the session and the folder of the tables and gives a DataFrame of scalar columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tertulia.functions import text as tx
from tertulia.operators import coherence as co
from tertulia.operators import dedupe, graphs, naming, profile, relevance, report, timeline
from tertulia.operators import tokens as tk
from tertulia.operators import topics as tm
from tertulia.plans import fixtures as fx
from tertulia.session import new_folder, stage
from tertulia.sources import emoji, files
from tertulia.sources.layout import RunLayout

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
# back to the headers of the export
_HEADERS = {new: old for old, new in profile.COLUMN_NAMES.items()}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts as an export has them: the eight columns under their headers, all text."""
    return fx.posts(spark, sf_dir).select(*[F.col(new).alias(old) for new, old in _HEADERS.items()])


def _joined(df: DataFrame, column: str = "processed") -> DataFrame:
    return df.select("post_id", F.array_join(column, " ").alias("processed"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# sources


@query
def scan_csv(spark, sf_dir):
    path = new_folder(spark, "export")
    files.write_csv(_export(spark, sf_dir), path)
    return profile.normalize_columns(files.scan_csv(spark, path))


@query
def scan_csv_dir(spark, sf_dir):
    path = new_folder(spark, "exports")
    files.write_csv(_export(spark, sf_dir), path)
    return profile.normalize_columns(files.scan_csv_dir(spark, path))


@query
def empty_to_null(spark, sf_dir):
    blanks = fx.posts(spark, sf_dir).select("post_id", F.coalesce("link", F.lit("")).alias("link"), "author")
    return files.empty_to_null(blanks)


@query
def skip_bad_lines(spark, sf_dir):
    """German posts get a field too many, Spanish posts lack fields."""
    path = new_folder(spark, "lines")
    line = (
        F.when(F.col("country") == "de", F.concat_ws(",", "post_id", "domain_group", "type", F.lit("more")))
        .when(F.col("country") == "es", F.col("post_id").cast("string"))
        .otherwise(F.concat_ws(",", "post_id", "domain_group", "type"))
    )
    # one column that holds whole lines, written with a separator that no line has
    lines = fx.posts(spark, sf_dir).select(line.alias("post_id,domain_group,type"))
    lines.write.option("header", True).option("sep", "\u0001").csv(path)
    return files.scan_csv_tolerant(spark, path).select("post_id", "domain_group", "type")


@query
def scan_parquet(spark, sf_dir):
    path = new_folder(spark, "processed")
    files.write_processed(fx.tokens(spark, sf_dir).select("post_id", "processed"), path)
    return _joined(files.scan_parquet(spark, f"{path}/df_processed.parquet"))


@query
def scan_json(spark, sf_dir):
    path = new_folder(spark, "metadata")
    counts = fx.posts(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("data_volume"),
        F.count("content").alias("with_text"),
        F.count_distinct("domain_group").alias("networks"),
    )
    files.write_document(counts.select(F.to_json(F.struct("data_volume", "with_text", "networks"))), path)
    return files.scan_json(spark, path, "data_volume long, with_text long, networks long")


@query
def scan_outputs_by_name(spark, sf_dir):
    folder = new_folder(spark, "results")
    files.write_csv(profile.network_distribution(fx.posts(spark, sf_dir)), f"{folder}/network_distribution")
    files.write_csv(profile.hashtag_counts(fx.posts(spark, sf_dir), "content_tagged"), f"{folder}/Hash_global")
    found = files.scan_outputs_by_name(spark, folder, "net")
    return found.select("domain_group", F.col("count").cast("long").alias("count"))


@query
def scan_coherence(spark, sf_dir):
    path = new_folder(spark, "coherence")
    files.write_csv(fx.curve(spark, sf_dir).select(F.col("k").alias("Topics"), F.col("coherence").alias("Coherence")), path)
    return files.scan_coherence(spark, path)


@query
def union_sources(spark, sf_dir):
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    talks = talks.select(F.col("conv_id").alias("post_id"), F.col("text").alias("content"))
    return files.union_sources([fx.posts(spark, sf_dir).select("post_id", "content", "link"), talks])


# sinks


@query
def write_processed(spark, sf_dir):
    path = new_folder(spark, "processed")
    files.write_processed(fx.tokens(spark, sf_dir).select("post_id", "processed"), path, csv=True)
    return files.scan_csv(spark, f"{path}/df_processed.csv")


@query
def run_report(spark, sf_dir):
    """Row volumes observed while the stages are written, read back from the run's record."""
    volumes = profile.Volumes()
    read = volumes.watch(fx.posts(spark, sf_dir), "read")
    present = volumes.watch(profile.drop_null_content(read), "with_text")
    stage(present, "watched")
    volumes.watch(dedupe.dedupe_content(fx.posts(spark, sf_dir)), "distinct_text").write.format("noop").mode("overwrite").save()
    record = report.run_report(spark, volumes.rows(), min_topics=4, max_topics=10)
    path = new_folder(spark, "metadata")
    files.write_document(report.as_document(record), path)
    stored = files.scan_json(spark, path, "read long, with_text long, distinct_text long")
    return stored.unpivot([], ["read", "with_text", "distinct_text"], "stage", "rows")


@query
def bow_store(spark, sf_dir):
    return stage(tk.bag_of_words(fx.tokens(spark, sf_dir)), "bow")


@query
def run_layout(spark, sf_dir):
    """A second run under the same version goes to a version of its own."""
    wanted = RunLayout(new_folder(spark, "runs"), "listening", "2024-01", "v1")
    for _ in range(2):
        layout, mode = wanted.settle(spark, "rename")
        files.write_csv(profile.network_distribution(fx.posts(spark, sf_dir)), layout.table("network_distribution"), mode)
    found = files.scan_csv(spark, layout.table("network_distribution"))
    return found.select("domain_group", F.col("count").cast("long").alias("count"))


@query
def coherence_resume(spark, sf_dir):
    curve = fx.curve(spark, sf_dir)
    return co.coherence_todo(curve.select("k"), curve.where("coherence > 0.2"))


# projections and filters


@query
def normalize_columns(spark, sf_dir):
    return profile.normalize_columns(
        fx.posts(spark, sf_dir).select("post_id", *[F.col(new).alias(old) for new, old in _HEADERS.items()]), keep=["post_id"]
    )


@query
def drop_null_content(spark, sf_dir):
    return profile.drop_null_content(fx.posts(spark, sf_dir)).select("post_id", "content")


@query
def filter_networks(spark, sf_dir):
    return profile.filter_networks(fx.posts(spark, sf_dir), fx.NETWORKS).select("post_id", "domain_group")


@query
def filter_has_hash(spark, sf_dir):
    return profile.filter_has_hash(fx.posts(spark, sf_dir), "content_tagged").select("post_id", "content_tagged")


@query
def head_n(spark, sf_dir):
    return profile.head_n(fx.posts(spark, sf_dir).select("post_id", "date"), 100)


@query
def parse_date(spark, sf_dir):
    return profile.parse_date(fx.posts(spark, sf_dir).select("post_id", "date"))


@query
def distinct_networks(spark, sf_dir):
    return profile.distinct_networks(fx.posts(spark, sf_dir))


@query
def stage_volumes(spark, sf_dir):
    posts, tokens = stage(fx.posts(spark, sf_dir), "posts"), fx.tokens(spark, sf_dir)
    present = profile.drop_null_content(posts)
    stages = {"read": posts, "with_text": present, "distinct_text": dedupe.dedupe_content(posts)}
    return profile.stage_volumes(stages | {"distinct_tokens": dedupe.dedupe_tokens(tokens)})


@query
def date_range(spark, sf_dir):
    return profile.date_range(profile.parse_date(fx.posts(spark, sf_dir)))


@query
def fill_empty_text(spark, sf_dir):
    return profile.fill_empty_text(fx.posts(spark, sf_dir).select("post_id", "content"), "content")


@query
def drop_null_any(spark, sf_dir):
    return profile.drop_null_any(fx.posts(spark, sf_dir).select("post_id", "date", "link", "content"), ["date", "link", "content"])


# duplicates and samples


@query
def dedupe_content(spark, sf_dir):
    return dedupe.dedupe_content(fx.posts(spark, sf_dir).select("post_id", "content", "domain_group"))


@query
def dedupe_tokens(spark, sf_dir):
    # cleaned once: both the grouping and the chosen rows read the stored lists
    return _joined(dedupe.dedupe_tokens(stage(fx.tokens(spark, sf_dir).select("post_id", "processed"), "tokens")))


@query
def sample_fraction(spark, sf_dir):
    return dedupe.sample_posts(fx.posts(spark, sf_dir).select("post_id"), fraction=0.25)


@query
def sample_n(spark, sf_dir):
    return dedupe.sample_posts(fx.posts(spark, sf_dir).select("post_id"), n=150)


# aggregations


@query
def network_distribution(spark, sf_dir):
    return profile.network_distribution(fx.posts(spark, sf_dir))


@query
def repeated_posts(spark, sf_dir):
    return profile.repeated_posts(fx.posts(spark, sf_dir))


@query
def repeated_posts_top(spark, sf_dir):
    return profile.repeated_posts_top(fx.posts(spark, sf_dir))


@query
def hashtag_counts(spark, sf_dir):
    return profile.hashtag_counts(fx.posts(spark, sf_dir), "content_tagged")


@query
def topic_distribution(spark, sf_dir):
    return timeline.topic_distribution(fx.posts(spark, sf_dir))


@query
def topic_share(spark, sf_dir):
    return _rounded(timeline.topic_share(fx.posts(spark, sf_dir)), "share")


@query
def topic_timeline(spark, sf_dir):
    return timeline.topic_timeline(profile.parse_date(fx.posts(spark, sf_dir)))


@query
def word_count(spark, sf_dir):
    return tk.word_count(fx.tokens(spark, sf_dir))


def _topic_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(topic, word, n)``: word counts stand in for a model's weights."""
    words = tk.each_token(fx.tokens(spark, sf_dir), "topic")
    return timeline.topic_word_count(words)


def _topic_terms(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    top = timeline.top_per_topic(_topic_words(spark, sf_dir), n)
    return top.select("topic", "word", F.col("n").cast("double").alias("weight"), "rank")


@query
def topic_word_count(spark, sf_dir):
    return _topic_words(spark, sf_dir)


@query
def topic_weight_scale(spark, sf_dir):
    return _rounded(timeline.topic_weight_scale(_topic_words(spark, sf_dir), "n"), "scale")


@query
def adjacent_words(spark, sf_dir):
    return graphs.adjacent_words(fx.tokens(spark, sf_dir))


@query
def doc_freq(spark, sf_dir):
    return _rounded(timeline.doc_freq(fx.tokens(spark, sf_dir)), "freq")


# ranks


@query
def top_words_per_topic(spark, sf_dir):
    words = tk.each_token(fx.tokens(spark, sf_dir), "topic")
    return timeline.top_words_per_topic(words)


def _timeline_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined tokens, cleaned once and stored; a digest of the text stands for it in the long tables."""
    joined = fx.joined_text(spark, sf_dir).withColumnRenamed("processed", "words")
    return stage(joined.select("date", "topic", "words", F.md5("words").alias("processed")), "joined")


@query
def words_timeline_topic(spark, sf_dir):
    rows = timeline.words_topic_timeline(_timeline_text(spark, sf_dir), column="words")
    return timeline.words_timeline_topic(rows, timeline.top_words_per_topic(rows))


@query
def topic_terms_top_n(spark, sf_dir):
    return _topic_terms(spark, sf_dir, 25)


@query
def vocab_top500(spark, sf_dir):
    return _rounded(graphs.topic_vocabulary(fx.tokens(spark, sf_dir)), "freq")


@query
def top_sqrt_edges(spark, sf_dir):
    return graphs.top_sqrt_edges(graphs.adjacent_words(fx.tokens(spark, sf_dir)))


# joins


@query
def join_topic_mix(spark, sf_dir):
    posts = fx.posts(spark, sf_dir).select("post_id", "topic")
    joined = posts.join(fx.topic_mix(posts), "post_id")
    return joined.select("post_id", "topic", *[F.get("topic_proba", F.lit(i)).alias(f"p{i}") for i in range(4)])


@query
def join_word_count(spark, sf_dir):
    tokens = stage(fx.tokens(spark, sf_dir), "tokens")
    words = timeline.topic_word_count(tk.each_token(tokens, "topic"))
    terms = timeline.top_per_topic(words, 25).withColumnRenamed("n", "weight")
    joined = relevance.word_relevance(terms, tk.word_count(tokens))
    return joined.select(F.col("topic_id").alias("topic"), "word", F.col("word_count").alias("n"))


@query
def semi_join_top_words(spark, sf_dir):
    tokens = stage(fx.tokens(spark, sf_dir), "tokens")
    words = tk.each_token(tokens, "post_id", "topic")
    return timeline.words_timeline_topic(words, timeline.top_words_per_topic(words)).select("post_id", "topic", "word")


@query
def anti_join_stopwords(spark, sf_dir):
    return tk.word_count(tk.remove_stopwords(fx.tokens(spark, sf_dir), fx.stop_words()))


@query
def join_nodes_metrics(spark, sf_dir):
    tokens = stage(fx.tokens(spark, sf_dir), "tokens")
    vocab = stage(graphs.topic_vocabulary(tokens), "vocab")
    close = graphs.closeness(stage(graphs.term_cosine_edges(tokens, vocab), "edges"))
    none = close.limit(0).withColumnRenamed("closeness", "betweenness")
    return _rounded(graphs.graph_nodes(vocab, close, none).drop("betweenness"), "freq", "closeness")


# the cleaning chain, step by step


def _step(spark: SparkSession, sf_dir: str, step: Callable[[Column], Column], source: Column | None = None) -> DataFrame:
    tagged = F.concat_ws(
        " ",
        "full_text",
        F.concat(F.lit("#"), "domain_group"),
        F.concat(F.lit("@"), "author"),
        F.concat(F.lit("$"), "type"),
        "link",
    )
    posts = fx.posts(spark, sf_dir).select("post_id", (tagged if source is None else source).alias("t"))
    return posts.select("post_id", step(F.col("t")).alias("result"))


@query
def extract_hashtags(spark, sf_dir):
    return _step(spark, sf_dir, lambda c: F.array_join(tx.extract_hashtags(c), " "), F.col("content_tagged"))


@query
def strip_at_tokens(spark, sf_dir):
    return _step(spark, sf_dir, tx.strip_at_tokens)


@query
def collapse_space(spark, sf_dir):
    return _step(spark, sf_dir, tx.collapse_space)


@query
def strip_quotes(spark, sf_dir):
    return _step(spark, sf_dir, tx.strip_quotes)


@query
def strip_urls(spark, sf_dir):
    return _step(spark, sf_dir, tx.strip_urls)


@query
def strip_tickers(spark, sf_dir):
    return _step(spark, sf_dir, tx.strip_tickers)


@query
def strip_rt(spark, sf_dir):
    return _step(spark, sf_dir, tx.strip_rt, F.concat(F.lit("RT "), "full_text"))


@query
def lower_text(spark, sf_dir):
    return _step(spark, sf_dir, tx.lower_text)


@query
def fold_vowels(spark, sf_dir):
    return _step(spark, sf_dir, tx.fold_vowels)


@query
def demojize(spark, sf_dir):
    picture = (
        F.when(F.col("domain_group") == "click", "👍")
        .when(F.col("domain_group") == "view", "👀")
        .when(F.col("domain_group") == "purchase", "💰💰")
        .otherwise("⚡")
    )
    posts = fx.posts(spark, sf_dir).select("post_id", F.concat("full_text", F.lit(" "), picture).alias("content"))
    named = tk.demojize(posts, emoji.unicode_aliases(spark))
    return named.select("post_id", F.col("content").alias("result"))


@query
def strip_punct(spark, sf_dir):
    return _step(spark, sf_dir, tx.strip_punct)


@query
def collapse_repeats(spark, sf_dir):
    spaced = lambda c: tx.strip_punct(tx.collapse_space(c))
    return _step(spark, sf_dir, lambda c: tx.collapse_repeats(spaced(c)), F.col("full_text"))


@query
def tokenize(spark, sf_dir):
    return _step(spark, sf_dir, lambda c: F.array_join(tx.tokenize(c), " "), F.col("full_text"))


@query
def clean_text(spark, sf_dir):
    return _joined(tk.clean_posts(fx.posts(spark, sf_dir), "content_tagged"))


@query
def retokenize(spark, sf_dir):
    tokens = stage(fx.tokens(spark, sf_dir).select("post_id", "processed"), "tokens")
    return _joined(tk.retokenize(tk.apply_phrases(tokens, tk.phrase_model(tokens))))


@query
def fold_tildes(spark, sf_dir):
    return _step(spark, sf_dir, tx.fold_tildes, F.col("full_text"))


@query
def join_tokens(spark, sf_dir):
    return fx.tokens(spark, sf_dir).select("post_id", tx.join_tokens(F.col("processed")).alias("processed"))


@query
def split_tokens(spark, sf_dir):
    words = fx.joined_text(spark, sf_dir).select("post_id", tx.split_tokens(F.col("processed")).alias("w"))
    return words.select("post_id", F.size("w").cast("long").alias("n"), F.get("w", F.lit(0)).alias("first"))


# token lists


@query
def stopword_list(spark, sf_dir):
    """The list with the number of uses of each word in the collection."""
    listed = spark.createDataFrame([(w,) for w in fx.stop_words()], "word string")
    used = tk.word_count(fx.tokens(spark, sf_dir).withColumn("processed", F.filter("processed", lambda t: t.isin(fx.stop_words()))))
    return F.broadcast(listed).join(used, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


@query
def remove_stopwords(spark, sf_dir):
    return _joined(tk.remove_stopwords(fx.tokens(spark, sf_dir), fx.stop_words()))


@query
def phrase_counts(spark, sf_dir):
    return tk.phrase_counts(fx.tokens(spark, sf_dir))


@query
def phrase_model(spark, sf_dir):
    return _rounded(tk.phrase_model(stage(fx.tokens(spark, sf_dir).select("processed"), "tokens")), "score")


@query
def apply_phrases(spark, sf_dir):
    tokens = stage(fx.tokens(spark, sf_dir).select("post_id", "processed"), "tokens")
    bare = tk.remove_stopwords(tokens, fx.stop_words())
    return _joined(tk.apply_phrases(bare, tk.phrase_model(tokens)))


@query
def lemma_pos_filter(spark, sf_dir):
    tokens = stage(fx.tokens(spark, sf_dir).select("post_id", "processed"), "tokens")
    return _joined(tk.lemma_pos_filter(tokens, fx.lexicon(tk.word_count(tokens))))


@query
def process_words(spark, sf_dir):
    tokens = stage(fx.tokens(spark, sf_dir).select("post_id", "processed"), "tokens")
    lexicon = fx.lexicon(tk.word_count(tokens))
    return _joined(tk.process_words(tokens, fx.stop_words(), tk.phrase_model(tokens), lexicon))


@query
def vocabulary(spark, sf_dir):
    return tk.vocabulary(fx.tokens(spark, sf_dir))


@query
def bag_of_words(spark, sf_dir):
    return tk.bag_of_words(fx.tokens(spark, sf_dir))


@query
def binary_terms(spark, sf_dir):
    return tk.binary_terms(fx.tokens(spark, sf_dir))


@query
def explode_words(spark, sf_dir):
    return timeline.explode_words(_timeline_text(spark, sf_dir), column="words")


@query
def words_topic_timeline(spark, sf_dir):
    return timeline.words_topic_timeline(_timeline_text(spark, sf_dir), column="words")


@query
def map_chunks(spark, sf_dir):
    def lengths(chunk: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"post_id": chunk.post_id, "n": chunk.full_text.str.len()})

    return tk.map_chunks(fx.posts(spark, sf_dir).select("post_id", "full_text"), lengths, "post_id long, n long")


# topic models


@lru_cache(maxsize=4)
def _model(app: str, sf_dir: str, k: int = 4):
    """Tokens, vectors and model that the model queries share within one session."""
    spark = SparkSession.active()
    kept = tk.remove_stopwords(fx.tokens(spark, sf_dir), fx.stop_words())
    tokens = stage(kept.select("post_id", "topic", "processed").withColumnRenamed("topic", "lang_topic"), "tokens")
    vectors = tm.vectorize(tokens)
    return tokens, vectors, tm.lda_fit(vectors, k)


def _fitted(spark: SparkSession, sf_dir: str):
    return _model(spark.sparkContext.applicationId, sf_dir)


@query
def lda_fit(spark, sf_dir):
    """Per topic: how many leading terms there are, how many of them the posts have, and whether weights fall."""
    tokens, vectors, model = _fitted(spark, sf_dir)
    return _term_summary(tokens, tm.topic_terms(model, vectors.counter, 10))


def _term_summary(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    known = tk.vocabulary(tokens).select(F.col("term").alias("word"), F.lit(1).alias("known"))
    weights = F.col("rows.weight")
    falling = F.forall(F.zip_with(weights, F.slice(weights, 2, F.size(weights)), lambda a, b: b.isNull() | (a >= b)), lambda x: x)
    rows = terms.join(known, "word", "left").groupBy("topic").agg(
        F.sort_array(F.collect_list(F.struct("rank", "weight"))).alias("rows"), F.sum("known").alias("n_known"), F.sum("weight").alias("mass")
    )
    return rows.select("topic", F.size("rows").cast("long").alias("n_terms"), "n_known", falling.alias("falling"), (F.col("mass") <= 1 + 1e-9).alias("is_share"))


@query
def lda_range(spark, sf_dir):
    tokens, _, _ = _fitted(spark, sf_dir)
    curve = tm.lda_range(tokens, [2, 3, 4])
    return curve.select("k", F.col("coherence").between(0, 1).alias("in_range"))


@query
def topic_terms(spark, sf_dir):
    tokens, vectors, model = _fitted(spark, sf_dir)
    return _term_summary(tokens, tm.topic_terms(model, vectors.counter, 25))


@query
def model_store(spark, sf_dir):
    _, vectors, model = _fitted(spark, sf_dir)
    folder = new_folder(spark, "models")
    tm.save_model(model, vectors.counter, folder, 4)
    before = tm.topic_terms(model, vectors.counter, 25).withColumnRenamed("weight", "was")
    after = tm.topic_terms(*tm.load_model(folder, 4), 25)
    both = before.join(after, ["topic", "rank", "word"], "full")
    return both.groupBy("topic").agg(F.count("weight").alias("n_terms"), F.count_if(~F.col("was").eqNullSafe(F.col("weight"))).alias("n_different"))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, vectors, model = _fitted(spark, sf_dir)
    return tm.classify(tokens, model, vectors.counter)


@query
def classify(spark, sf_dir):
    mix = F.col("topic_proba")
    whole = F.round(F.aggregate(mix, F.lit(0.0), lambda a, x: a + x), 6)
    best = F.get(mix, F.col("topic")) == F.array_max(mix)
    return _classified(spark, sf_dir).select("post_id", F.col("topic").between(0, 3).alias("known_topic"), best.alias("is_largest"), whole.alias("mix"))


@query
def topic_proba_wide(spark, sf_dir):
    wide = tm.topic_proba_wide(_classified(spark, sf_dir).drop("processed", "lang_topic"), 4)
    parts = [F.col(f"Topic_{i}_proba") for i in range(4)]
    own = F.get(F.array(*parts), F.col("Topic")) == F.greatest(*parts)
    return wide.select("post_id", own.alias("topic_has_largest"), F.round(sum(parts[1:], parts[0]), 6).alias("mix"))


@query
def topic_projection_2d(spark, sf_dir):
    points = tm.topic_projection_2d(_classified(spark, sf_dir))
    finite = F.abs("x").between(0, 2) & F.abs("y").between(0, 2)  # mixes lie in the unit simplex
    listed = F.get(F.array(*[F.lit(c) for c in tm.COLOURS]), F.col("topic")) == F.col("colour")
    return points.select("post_id", finite.alias("on_plane"), listed.alias("own_colour"))


@query
def coherence_cv(spark, sf_dir):
    tokens = stage(fx.tokens(spark, sf_dir), "tokens")
    words = timeline.topic_word_count(tk.each_token(tokens, "topic"))
    return _rounded(co.coherence_by_topic(tokens, stage(timeline.top_per_topic(words, 20), "terms")), "coherence")


@query
def coherence_curve(spark, sf_dir):
    return co.coherence_curve(fx.curve(spark, sf_dir), 4)


@query
def select_k(spark, sf_dir):
    return co.select_k(fx.curve(spark, sf_dir))


@query
def word_relevance(spark, sf_dir):
    tokens = stage(fx.tokens(spark, sf_dir), "tokens")
    words = timeline.topic_word_count(tk.each_token(tokens, "topic"))
    terms = timeline.top_per_topic(words, 25).withColumn("weight", F.col("n").cast("double")).drop("n")
    return relevance.word_relevance(terms, tk.word_count(tokens))


@query
def term_relevance(spark, sf_dir):
    counts = stage(_topic_words(spark, sf_dir), "topic-words")
    return _rounded(relevance.term_relevance(relevance.empirical_terms(counts)), "relevance", "saliency")


@query
def topic_distance(spark, sf_dir):
    counts = stage(_topic_words(spark, sf_dir), "topic-words")
    return _rounded(relevance.topic_distance(relevance.empirical_terms(counts)), "distance")


@query
def topic_centred(spark, sf_dir):
    terms = stage(relevance.empirical_terms(_topic_words(spark, sf_dir)), "empirical")
    return _rounded(relevance.topic_centred(stage(relevance.topic_distance(terms), "distances"), terms.select("topic").distinct()), "value")


@query
def topic_map(spark, sf_dir):
    """The shares of the map. Its points are free to turn with the last digit, so tests compare their distances."""
    terms = stage(relevance.empirical_terms(_topic_words(spark, sf_dir)), "empirical")
    placed = relevance.topic_map(stage(relevance.topic_distance(terms), "distances"), terms)
    return _rounded(placed.select("topic", "share"), "share")


@query
def topic_names(spark, sf_dir):
    """Titles for the languages' topics: one reply that names them all, one that is no JSON and one for another request."""
    terms = timeline.top_per_topic(_topic_words(spark, sf_dir), 5).withColumn("weight", F.col("n").cast("double")).drop("n")
    terms = stage(terms, "terms")
    requests = stage(naming.request_table(naming.topic_prompt(terms, "posts in four languages")), "requests")
    pairs = F.collect_list(F.struct(F.col("topic").cast("string"), F.upper("word")))
    good = terms.where("rank = 1").agg(F.to_json(F.map_from_entries(pairs)).alias("reply"))
    replies = requests.select("request_id").crossJoin(good.unionByName(good.select(F.lit("not json").alias("reply"))))
    replies = replies.unionByName(good.select(F.lit("other").alias("request_id"), F.lit('{"0": "wrong"}').alias("reply")))
    return naming.topic_names(requests, replies, naming.default_labels(terms), terms.select("topic").distinct().count())


# graphs


def _term_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    tokens = stage(fx.tokens(spark, sf_dir).select("post_id", "topic", "processed"), "tokens")
    vocab = stage(graphs.topic_vocabulary(tokens), "vocab")
    return tokens, vocab, graphs.term_cosine_edges(tokens, vocab)


@query
def term_cosine_edges(spark, sf_dir):
    return _rounded(_term_graph(spark, sf_dir)[2], "weight")


@query
def inverse_weight(spark, sf_dir):
    return _rounded(graphs.inverse_weight(_term_graph(spark, sf_dir)[2]), "weight")


@query
def node_frequency_rank(spark, sf_dir):
    return _rounded(graphs.node_frequency_rank(graphs.topic_vocabulary(fx.tokens(spark, sf_dir))), "freq")


@query
def closeness(spark, sf_dir):
    return _rounded(graphs.closeness(stage(_term_graph(spark, sf_dir)[2], "edges")), "closeness")


@query
def betweenness(spark, sf_dir):
    return _rounded(graphs.betweenness(stage(_term_graph(spark, sf_dir)[2], "edges")), "betweenness")


def _acyclic(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = graphs.top_sqrt_edges(graphs.adjacent_words(fx.tokens(spark, sf_dir)))
    return graphs.break_cycles(stage(top, "top-edges"))


@query
def break_cycles(spark, sf_dir):
    return _acyclic(spark, sf_dir)


@query
def topic_story(spark, sf_dir):
    return graphs.topic_story(_acyclic(spark, sf_dir))


# naming and the viewer


@query
def topic_prompt_payload(spark, sf_dir):
    counts = stage(_topic_words(spark, sf_dir), "topic-words")
    top = timeline.top_per_topic(relevance.empirical_terms(counts), 25)
    return naming.topic_payload(top.withColumnRenamed("p", "weight"))


@query
def parse_topic_names(spark, sf_dir):
    """Replies made from the posts: German ones are no JSON, Spanish ones name one topic only."""
    posts = fx.posts(spark, sf_dir).withColumn("domain_group", F.coalesce("domain_group", F.lit("none")))
    titles = F.when(F.col("country") == "es", F.create_map(F.lit("0"), "domain_group")).otherwise(
        F.create_map(F.lit("0"), "domain_group", F.lit("1"), "country")
    )
    fenced = F.concat(F.lit("```json\n"), F.to_json(titles), F.lit("\n```"))
    replies = posts.select("post_id", F.when(F.col("country") == "de", F.lit("no idea")).otherwise(fenced).alias("reply"))
    parsed = naming.parse_topic_names(replies, k=2)
    return parsed.select("post_id", F.try_element_at("names", F.lit("0")).alias("first_title"), "complete")


@query
def visual_payload(spark, sf_dir):
    tokens, vocab, edges = _term_graph(spark, sf_dir)
    edges = stage(edges, "edges")
    words = timeline.topic_word_count(tk.each_token(tokens, "topic"))
    weights = timeline.top_per_topic(words, 25).withColumnRenamed("n", "weight")
    nodes = graphs.graph_nodes(vocab, graphs.closeness(edges), graphs.betweenness(edges))
    top = stage(graphs.top_sqrt_edges(graphs.adjacent_words(tokens)), "top-edges")
    payload = naming.visual_payload(weights, nodes, edges, graphs.topic_story(graphs.break_cycles(top)))
    shape = "weights array<struct<word:string>>, nodes array<struct<term:string>>, edges array<struct<src:string>>, story array<struct<word:string>>"
    parts = payload.select("topic", F.from_json("payload", shape).alias("p"))
    return parts.select("topic", *[F.size(f"p.{name}").cast("long").alias(name) for name in ("weights", "nodes", "edges", "story")])
