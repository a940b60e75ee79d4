"""Requests for topic names, the replies to them, and the nested payload for a viewer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSTRUCTION = (
    "You name the topics found by an LDA model. Context: %s\n"
    "Input: one JSON object; keys are topic numbers, values list the topic's words with their probabilities, and a "
    "higher probability means a more important word.\n"
    "Give each of the %d topics one short title in %s that covers its words without using them. Answer with one JSON "
    'object of the form {"0": "title of topic 0", "1": "title of topic 1"} and nothing else.\n'
    "Input: %s"
)


def topic_payload(topic_terms: DataFrame) -> DataFrame:
    """``(topic, words)``: the leading words of each topic with their weights as JSON, heaviest first."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", "word", "weight")))
    lists = topic_terms.groupBy("topic").agg(pairs.alias("p"))
    words = F.to_json(F.transform("p", lambda t: F.struct(t.word.alias("word"), F.round(t.weight, 6).alias("p"))))
    return lists.select("topic", words.alias("words"))


def topic_prompt(topic_terms: DataFrame, context: str, language: str = "Spanish") -> DataFrame:
    """The request as one row ``prompt``. Its size is bounded: some 25 words for each of a model's topics."""
    lists = topic_payload(topic_terms)
    entries = F.array_sort(F.collect_list(F.struct("topic", "words")))
    body = F.array_join(F.transform("e", lambda t: F.concat(F.lit('"'), t.topic.cast("string"), F.lit('": '), t.words)), ", ")
    text = F.format_string(
        INSTRUCTION, F.lit(context), F.size("e"), F.lit(language), F.concat(F.lit("{"), body, F.lit("}"))
    )
    return lists.agg(entries.alias("e")).select(text.alias("prompt"))


def parse_topic_names(replies: DataFrame, k: int | None = None, column: str = "reply") -> DataFrame:
    """Add ``names``, the map topic to title, null for a reply that is no JSON object; ``complete`` checks its size."""
    body = F.regexp_replace(F.col(column), F.lit(r"^```(?:json)?\n?"), F.lit(""))
    body = F.trim(F.regexp_replace(body, F.lit(r"`+$"), F.lit("")))
    parsed = F.from_json(F.when(body.startswith("{"), body), "map<string,string>", {"mode": "PERMISSIVE"})
    out = replies.withColumn("names", parsed)
    return out if k is None else out.withColumn("complete", F.coalesce(F.size("names") == k, F.lit(False)))


def request_table(prompts: DataFrame) -> DataFrame:
    """``(request_id, prompt)``: requests under a digest of their text, by which replies find them again."""
    return prompts.select(F.sha2("prompt", 256).alias("request_id"), "prompt").distinct()


def good_replies(requests: DataFrame, replies: DataFrame, k: int) -> DataFrame:
    """``(request_id, names)``: for each request a reply that names all ``k`` topics; of several the least text decides."""
    known = replies.join(requests.select("request_id"), "request_id", "left_semi")
    whole = parse_topic_names(known, k).where("complete")
    return whole.groupBy("request_id").agg(F.min("reply").alias("reply")).join(whole, ["request_id", "reply"]).select("request_id", "names").dropDuplicates(["request_id"])


def open_requests(requests: DataFrame, replies: DataFrame, k: int) -> DataFrame:
    """Requests without a good reply, to be sent again."""
    return requests.join(good_replies(requests, replies, k), "request_id", "left_anti")


def topic_names(requests: DataFrame, replies: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """``(topic, title)`` for each topic of ``labels (topic, label)``: its title in the reply, or else its label.

    ``requests`` and ``replies`` of one model are a few rows; a topic without a title in a good reply keeps its label too.
    """
    titles = good_replies(requests, replies, k).select(F.explode("names").alias("topic", "title")).groupBy("topic").agg(F.min("title").alias("title"))
    rows = labels.select(F.col("topic").cast("string").alias("topic"), "label").join(F.broadcast(titles), "topic", "left")
    return rows.select("topic", F.coalesce(F.nullif(F.trim("title"), F.lit("")), "label").alias("title"))


def default_labels(topic_terms: DataFrame, n: int = 3) -> DataFrame:
    """A label from the first words of each topic, for use without a naming service."""
    words = F.array_sort(F.collect_list(F.struct("rank", "word")))
    lists = topic_terms.where(F.col("rank") <= n).groupBy("topic").agg(words.alias("w"))
    return lists.select("topic", F.array_join(F.col("w.word"), ", ").alias("label"))


def visual_payload(weights: DataFrame, nodes: DataFrame, edges: DataFrame, story: DataFrame) -> DataFrame:
    """One JSON document per topic with its word weights, graph and story.

    A topic has a few dozen weights, at most 500 nodes with their edges, and the few words of its story, so each
    collected list has a fixed bound. Points of posts stay a table of their own.
    """

    def lists(df: DataFrame, name: str, *columns: str) -> DataFrame:
        return df.groupBy("topic").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))

    parts = [
        lists(weights, "weights", "rank", "word", "weight"),
        lists(nodes, "nodes", "term", "freq", "rank", "closeness", "betweenness"),
        lists(edges, "edges", "src", "dst", "weight"),
        lists(story, "story", "level", "word"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, "topic", "left")
    return out.select("topic", F.to_json(F.struct("weights", "nodes", "edges", "story")).alias("payload"))
