"""Token lists: stop words, phrases, lexicon, vocabulary, bag of words."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tertulia.functions import text
from tertulia.functions.sequences import adjacent, merge_at, merge_pairs, without_words
from tertulia.session import fits_broadcast, lookup_join, stage

# Parts of speech kept by the lexicon filter.
KEPT_POS = ["NOUN", "ADJ", "VERB", "ADV", "PROPN", "NUM"]

# Most phrases that travel inside the plan.
PHRASES_IN_ROW = 100_000

# Blocks that hold pictographs, skin tones, and sequences joined by a zero-width joiner; two letters make a flag.
PICTOGRAPH = r"[\x{2300}-\x{23FF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{1F000}-\x{1FAFF}]"
_TONE = r"\x{FE0F}?[\x{1F3FB}-\x{1F3FF}]?"
FLAG = r"[\x{1F1E6}-\x{1F1FF}]{2}"
EMOJI = rf"{FLAG}|{PICTOGRAPH}{_TONE}(?:\x{{200D}}{PICTOGRAPH}{_TONE})*+"


def clean_posts(
    df: DataFrame, column: str = "content", emoji: DataFrame | None = None, strict_urls: bool = False, key: str = "post_id"
) -> DataFrame:
    """Add ``processed``, the token list of ``column``. With an ``emoji`` table (emoji, alias) emoji become words."""
    if emoji is None:
        return df.withColumn("processed", text.clean_text(F.col(column), strict_urls))
    half = df.withColumn("processed", text.clean_before_emoji(F.col(column), strict_urls))
    named = demojize(half, emoji, "processed", key)
    return named.withColumn("processed", text.clean_after_emoji(F.col("processed")))


def demojize(df: DataFrame, emoji: DataFrame, column: str = "content", key: str = "post_id") -> DataFrame:
    """Replace every emoji by ``:alias:``, the longest match first: a whole sequence (a flag, a skin tone, pictographs that
    are joined) that the table has, else the parts of it that the table has. What the table lacks stays.

    Only posts that hold a pictograph or a flag are split, joined and put together again; all others pass through unchanged.
    """
    marked = F.regexp_replace(F.col(column), F.lit(rf"({EMOJI})"), F.lit("\u0000$1\u0000"))
    pieces = df.where(F.col(column).rlike(f"{PICTOGRAPH}|{FLAG}")).select(key, F.posexplode(F.split(marked, "\u0000")).alias("_at", "_piece"))
    # every second piece is a sequence; its parts are looked up beside it
    parts = F.regexp_extract_all("_piece", F.lit(r"(?s)[^\x{200D}\x{FE0F}]"), F.lit(0))
    looked_up = F.when(F.col("_at") % 2 == 1, F.concat(F.array("_piece"), parts)).otherwise(F.array("_piece"))
    spread = pieces.select(key, "_at", F.posexplode(looked_up).alias("_part", "emoji"))
    named = lookup_join(spread, emoji.select("emoji", "alias"), ["emoji"], "left", key)
    word = F.concat(F.lit(":"), "alias", F.lit(":"))
    entry = F.struct("_part", "emoji", word.alias("word"))
    whole = named.groupBy(key, "_at").agg(F.array_sort(F.collect_list(entry)).alias("_all"))
    first, rest = F.get("_all", F.lit(0)), F.slice("_all", F.lit(2), F.size("_all"))
    known = F.exists(rest, lambda p: p["word"].isNotNull())
    joined = F.array_join(F.transform(rest, lambda p: F.coalesce(p["word"], p["emoji"])), "")
    text_of = F.coalesce(first["word"], F.when(known, joined), first["emoji"])
    texts = whole.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_at", text_of.alias("s")))).alias("_parts"))
    texts = texts.select(key, F.array_join(F.col("_parts.s"), "").alias("_named"))
    return df.join(texts, key, "left").withColumn(column, F.coalesce("_named", column)).drop("_named")


def remove_stopwords(df: DataFrame, words: list[str], column: str = "processed") -> DataFrame:
    return df.withColumn(column, without_words(F.col(column), words))


def retokenize(df: DataFrame, column: str = "processed") -> DataFrame:
    return df.withColumn(column, text.retokenize(F.col(column)))


def _followers(df: DataFrame, column: str) -> DataFrame:
    """Counts ``(a, b, n)`` of each word with the word after it; ``b`` is null where ``a`` ends a post."""
    tokens = F.col(column)
    following = F.arrays_zip(tokens.alias("a"), F.slice(tokens, F.lit(2), F.size(tokens)).alias("b"))
    links = df.select(F.explode(following).alias("u")).select("u.a", "u.b")
    return links.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def _words_and_pairs(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every use of a word is in one of its links, so the word counts are sums over the much shorter table of links."""
    return links.groupBy("a").agg(F.sum("n").alias("n")), links.where("b is not null")


def phrase_counts(df: DataFrame, column: str = "processed") -> DataFrame:
    """Counts ``(a, b, n)`` of words (``b`` null) and of adjacent pairs, from one pass over the tokens.

    The links are written once: the filter of the pairs would move below their count, and the texts be cleaned for each side.
    """
    words, pairs = _words_and_pairs(stage(_followers(df, column), "followers"))
    return words.select("a", F.lit(None).cast("string").alias("b"), "n").unionByName(pairs)


def phrase_model(df: DataFrame, min_count: int = 5, threshold: float = 20.0, column: str = "processed") -> DataFrame:
    """Pairs worth merging: ``(n_ab - min_count) / (n_a * n_b) * V`` above ``threshold`` (Mikolov et al. 2013).

    ``V`` is the number of distinct words plus distinct pairs. Only pairs that can pass (``n_ab > min_count``) are written;
    of all others, most of them, one row says how many there are. The pairs meet the word counts in two joins on unique
    keys, whose skewed partitions the adaptive plan splits. ``df`` is read twice: hand over a stored table.
    """
    tokens = F.col(column)
    words = df.select(F.explode(F.slice(tokens, F.lit(1), F.greatest(F.size(tokens), F.lit(0)))).alias("a"))
    words = stage(words.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "words")
    links = df.select(F.explode(adjacent(tokens)).alias("u")).select("u.a", "u.b").where("b is not null")
    links = links.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    frequent = [F.when(F.col("n") > min_count, F.col(c)).alias(c) for c in ("a", "b")]
    links = links.select(*frequent, "n").groupBy("a", "b").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("_pairs"))
    links = stage(links, "followers")
    size = words.count() + (links.agg(F.sum("_pairs")).first()[0] or 0)
    pairs = links.where("b is not null").drop("_pairs")
    # as doubles: the product of two large counts does not fit a long
    left = words.select("a", F.col("n").cast("double").alias("n_a"))
    right = words.select(F.col("a").alias("b"), F.col("n").cast("double").alias("n_b"))
    score = (F.col("n") - min_count) / (F.col("n_a") * F.col("n_b")) * F.lit(float(size))
    scored = pairs.join(left, "a").join(right, "b").withColumn("score", score)
    return scored.where(F.col("score") > threshold).select("a", "b", "n", "score")


def apply_phrases(
    df: DataFrame, phrases: DataFrame, column: str = "processed", key: str = "post_id", max_phrases: int = PHRASES_IN_ROW
) -> DataFrame:
    """Merge phrases to ``a_b``, greedily from left to right, without overlap.

    The phrases are counted. Up to ``max_phrases`` travel in the plan as a hash table, and each list is merged inside its
    row: nothing is shuffled, and no position is ever a row. More of them are joined to the positions, and of the positions
    only matching ones are shuffled. Both ways give the same lists.
    """
    table = stage(phrases.select("a", "b"), "phrase-pairs")
    if fits_broadcast(table, max_phrases):
        return df.withColumn(column, merge_pairs(F.col(column), _pair_table(table)))
    return _apply_many_phrases(df, table, column, key)


def _pair_table(table: DataFrame) -> Callable[[Column, Column], Column]:
    """A test for the pairs of a small table: one constant of buckets, of which a look-up compares the few pairs of one."""
    number = 2 * table.count() + 1
    bucket = lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(number)).cast("int")
    buckets: list[list[dict[str, str]]] = [[] for _ in range(number)]
    for r in table.select(bucket("a", "b").alias("at"), "a", "b").collect():
        buckets[r.at].append({"a": r.a, "b": r.b})
    constant = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<a:string,b:string>>>")
    return lambda a, b: F.exists(F.get(constant, bucket(a, b)), lambda p: (p["a"] == a) & (p["b"] == b))


def _apply_many_phrases(df: DataFrame, phrases: DataFrame, column: str, key: str) -> DataFrame:
    """A phrase position is taken greedily exactly when it is the 1st, 3rd, 5th ... of a run of consecutive ones."""
    pairs = df.select(key, F.posexplode(adjacent(F.col(column))).alias("at", "p")).select(key, "at", "p.a", "p.b")
    hits = lookup_join(pairs, phrases, ["a", "b"], "left_semi", key).select(key, "at")
    order = Window.partitionBy(key).orderBy("at")
    runs = hits.withColumn("run", F.col("at") - F.row_number().over(order))
    runs = runs.groupBy(key, "run").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    starts = F.sequence(F.col("first"), F.col("last"), F.lit(2))
    merges = runs.groupBy(key).agg(F.array_sort(F.flatten(F.collect_list(starts))).alias("_starts"))
    joined = df.join(merges, key, "left")
    merged = F.when(F.col("_starts").isNull(), F.col(column)).otherwise(merge_at(F.col(column), F.col("_starts")))
    return joined.withColumn(column, merged).drop("_starts")


def lemma_pos_filter(
    df: DataFrame, lexicon: DataFrame, pos: list[str] | None = None, column: str = "processed", key: str = "post_id"
) -> DataFrame:
    """Replace tokens by their lemma and drop unwanted parts of speech, from a table ``(form, pos, lemma)``.

    Forms the table lacks stay as they are. The rows are partitioned by post first, so that taking the lists apart and
    putting them together again needs no shuffle of single tokens. The other columns travel with a post's first token, so
    the posts are read once and not joined back.
    """
    forms = lexicon.groupBy("form").agg(F.min(F.struct("pos", "lemma")).alias("_entry"))
    forms = forms.select("form", F.col("_entry.pos").alias("_pos"), F.col("_entry.lemma").alias("_lemma"))
    others = [c for c in df.columns if c not in (key, column)]
    rest = F.struct(F.lit(True).alias("_here"), *[F.col(f"`{c}`") for c in others])
    placed = df.select(key, column, rest.alias("_rest")).repartition(key)
    exploded = placed.select(key, "_rest", F.posexplode_outer(column).alias("_at", "form"))
    first = F.coalesce("_at", F.lit(0)) == 0
    exploded = exploded.where(F.col("form").isNotNull() | first).withColumn("_rest", F.when(first, F.col("_rest")))
    known = lookup_join(exploded, forms, ["form"], "left", key)
    kept = F.col("form").isNotNull() & (F.col("_pos").isNull() | F.col("_pos").isin(pos or KEPT_POS))
    word = F.when(kept, F.struct("_at", F.coalesce("_lemma", "form").alias("w")))
    lists = known.groupBy(key).agg(F.array_sort(F.collect_list(word)).alias("_kept"), F.any_value("_rest", F.lit(True)).alias("_rest"))
    values = {key: F.col(key), column: F.col("_kept.w")}
    return lists.select(*[values[c].alias(c) if c in values else F.col("_rest").getField(c).alias(c) for c in df.columns])


def process_words(
    df: DataFrame,
    stop_words: list[str],
    phrases: DataFrame | None = None,
    lexicon: DataFrame | None = None,
    column: str = "processed",
    key: str = "post_id",
) -> DataFrame:
    """Stop words, phrases, lexicon, length filter, stop words again: the final token list of each post.

    The lists come from :func:`clean_posts`, whose tokens already have the allowed lengths.
    """
    if phrases is not None:
        df = apply_phrases(remove_stopwords(df, stop_words, column), phrases, column, key)
    if lexicon is not None:
        df = lemma_pos_filter(df, lexicon, None, column, key)
    return remove_stopwords(retokenize(df, column), stop_words, column)


def each_token(df: DataFrame, *keep: str, column: str = "processed", name: str = "word") -> DataFrame:
    """One row per token, with the ``keep`` columns.

    A plain ``explode`` of a column makes the optimizer filter on the column's size, and that filter moves below the
    projection and cleans every text a second time. The outer form with a check of the result does not.
    """
    return df.select(*keep, F.explode_outer(column).alias(name)).where(F.col(name).isNotNull())


def word_count(df: DataFrame, column: str = "processed") -> DataFrame:
    words = each_token(df, column=column)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(df: DataFrame, column: str = "processed") -> DataFrame:
    """Each term with its number of uses (``cf``) and of posts (``df``)."""
    uses = F.transform(F.col(column), lambda t: F.struct(t.alias("term"), F.lit(1).alias("use"), F.lit(0).alias("post")))
    posts = F.transform(
        F.array_distinct(column), lambda t: F.struct(t.alias("term"), F.lit(0).alias("use"), F.lit(1).alias("post"))
    )
    units = df.select(F.explode(F.concat(uses, posts)).alias("u")).select("u.*")
    return units.groupBy("term").agg(F.sum("use").alias("cf"), F.sum("post").alias("df"))


def bag_of_words(df: DataFrame, column: str = "processed", key: str = "post_id") -> DataFrame:
    """``(post, term, n)``, counted inside the row: equal terms stand side by side in the sorted list. Nothing is shuffled.

    A list of one element taken apart keeps Spark from working out the sorted list again for each of its elements.
    """
    lists = df.select(key, F.explode(F.array(F.array_sort(F.array_compact(column)))).alias("_terms"))
    n = F.size("_terms")
    begins = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("_terms", i) != F.get("_terms", i - 1)))
    lists = lists.where(n > 0).select(key, "_terms", F.explode(F.array(begins)).alias("_at"))
    runs = F.transform(
        "_at", lambda i, j: F.struct(F.get("_terms", i).alias("term"), (F.coalesce(F.get("_at", j + 1), n) - i).cast("long").alias("n"))
    )
    return lists.select(key, F.explode(runs).alias("_u")).select(key, "_u.term", "_u.n")


def binary_terms(df: DataFrame, column: str = "processed", keep: tuple[str, ...] = ("post_id", "topic")) -> DataFrame:
    """Each distinct term of each post. Terms are made distinct inside the row, so nothing is shuffled."""
    return df.select(*keep, F.explode(F.array_distinct(column)).alias("term"))


def map_chunks(df: DataFrame, func: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a user's pandas function to the rows, chunk by chunk, in Arrow batches."""

    def run(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return map(func, chunks)

    return df.mapInPandas(run, schema)
