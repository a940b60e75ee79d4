"""Cycles of directed, weighted word graphs: strongly connected parts, and the edges that close a cycle."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.session import stage

# Most edges of a part that one task orders by itself; its reach sets take that number squared in bits at most.
PART_EDGES = 10_000
_EDGE = ["topic", "word", "next_word", "n"]


def _spread(edges: DataFrame, state: DataFrame, value: str, best: Column, steps: int) -> DataFrame:
    """Pass ``value`` of the nodes ``state (topic, word, value)`` along the edges until no node changes.

    ``best`` chooses between the value a node has and the one it is given (``_new``, null if none). A round takes ``steps``
    steps, is written, and keeps one row per node.
    """
    before = None
    while True:
        state = stage(state, "spread")
        now = state.agg(F.sum(F.xxhash64("topic", "word", value).cast("decimal(38,0)"))).first()[0]
        if now == before:
            return state
        before = now
        for _ in range(steps):
            given = edges.join(state, ["topic", "word"]).groupBy("topic", F.col("next_word").alias("word")).agg(F.min(value).alias("_new"))
            state = state.join(given, ["topic", "word"], "left").select("topic", "word", best.alias(value))


def strong_parts(edges: DataFrame, steps: int = 4) -> DataFrame:
    """The edges that lie on a cycle of two words or more, with the name of their strongly connected ``part``.

    Forward-backward colouring (Orzan 2004): each word takes the least word that reaches it as its colour; the words of a
    colour that lead back to that word are a part. What is left, edges inside one colour between words without a part, goes
    through the next round. Rounds keep one row per edge and one per word, whatever the size of the parts.
    """
    left = stage(edges.where("word <> next_word").select(*_EDGE), "cyclic")
    out = None
    while not left.isEmpty():
        # words without a way in or out lie on no cycle
        heads = left.select("topic", F.col("next_word").alias("word")).distinct()
        tails = left.select("topic", F.col("word").alias("next_word")).distinct()
        left = stage(left.join(heads, ["topic", "word"], "left_semi").join(tails, ["topic", "next_word"], "left_semi").select(*_EDGE), "cyclic")
        words = left.select("topic", "word").union(left.select("topic", "next_word")).distinct()
        colours = _spread(left, words.withColumn("colour", F.col("word")), "colour", F.least("colour", "_new"), steps)
        ends = colours.select("topic", F.col("word").alias("next_word"), F.col("colour").alias("_other"))
        inside = left.join(colours, ["topic", "word"]).join(ends, ["topic", "next_word"]).where("colour = _other").drop("_other")
        inside = stage(inside, "one-colour")
        # backwards from the word that gave the colour: 0 where it is reached
        back = inside.select("topic", F.col("next_word").alias("word"), F.col("word").alias("next_word"))
        seen = colours.select("topic", "word", F.when(F.col("word") == F.col("colour"), 0).otherwise(1).alias("away"))
        seen = _spread(back, seen, "away", F.least("away", "_new"), steps)
        mark = inside.join(seen.select("topic", "word", F.col("away").alias("_from")), ["topic", "word"])
        mark = mark.join(seen.select("topic", F.col("word").alias("next_word"), F.col("away").alias("_to")), ["topic", "next_word"])
        mark = stage(mark, "marked")
        part = mark.where("_from = 0 AND _to = 0").select(*_EDGE, F.col("colour").alias("part"))
        out = part if out is None else out.unionByName(part)
        left = mark.where("_from = 1 AND _to = 1").select(*_EDGE)
    return out if out is not None else left.select(*_EDGE, F.lit(None).cast("string").alias("part"))


def _closing(edges: pd.DataFrame) -> pd.DataFrame:
    """Of the edges of one part those whose head leads back to the tail over heavier edges: edges are added from the heaviest
    down, and each word keeps the set of words it reaches, as the bits of one number."""
    ordered = edges.sort_values(["n", "word", "next_word"], ascending=[False, True, True], kind="stable")
    ids: dict[str, int] = {}
    pairs = [(ids.setdefault(a, len(ids)), ids.setdefault(b, len(ids))) for a, b in zip(ordered["word"], ordered["next_word"])]
    reach = [1 << i for i in range(len(ids))]
    closes = []
    for a, b in pairs:
        closes.append(bool(reach[b] >> a & 1))
        if not reach[a] >> b & 1:
            gained, bit = reach[b], 1 << a
            reach = [r | gained if r & bit else r for r in reach]
    return ordered[closes][["topic", "word", "next_word"]]


def _search(e: DataFrame) -> DataFrame:
    """The same for parts of any size: all edges search at once along heavier edges of their part, one step per round, and an
    edge that found its way back stops."""
    heavier = (F.col("h.n") > F.col("r.n")) | (
        (F.col("h.n") == F.col("r.n")) & (F.struct("h.word", "h.next_word") < F.struct("r.word", "r.next_word"))
    )
    seen = e.withColumn("at", F.col("next_word"))
    front, dropped = seen, None
    step = (F.col("h.topic") == F.col("r.topic")) & (F.col("h.part") == F.col("r.part")) & (F.col("h.word") == F.col("r.at"))
    while True:
        reach = front.alias("r").join(e.alias("h"), step & heavier)
        reach = reach.select("r.topic", "r.part", "r.word", "r.next_word", "r.n", F.col("h.next_word").alias("at")).distinct()
        fresh = stage(reach.join(seen, ["topic", "part", "word", "next_word", "at"], "left_anti"), "cycle-front")
        back = fresh.where("at = word").select("topic", "word", "next_word")
        dropped = back if dropped is None else dropped.union(back)
        if fresh.isEmpty():
            return dropped.distinct()
        seen = seen.unionByName(fresh)
        front = fresh.join(back, ["topic", "word", "next_word"], "left_anti")


def break_cycles(edges: DataFrame, part_edges: int = PART_EDGES) -> DataFrame:
    """Drop every edge that is the lightest of some cycle; what is left has no cycle.

    Taking the lightest edge that lies on a cycle, again and again, removes exactly these edges: an edge goes when its
    head leads back to its tail over heavier edges only. Equal weights are ordered by the words, and an edge from a word to
    itself goes. All cycles lie inside strongly connected parts, so only these are searched: a part of up to ``part_edges``
    edges by one task, larger ones by joins.
    """
    e = stage(strong_parts(edges), "parts")
    sizes = e.groupBy("topic", "part").agg((F.count(F.lit(1)) <= part_edges).alias("small"))
    e = stage(e.join(sizes, ["topic", "part"]), "sized-parts")
    small, large = e.where("small").drop("small"), e.where("NOT small").drop("small")
    names = edges.select("topic", "word", "next_word").schema
    dropped = small.groupBy("topic", "part").applyInPandas(_closing, names)
    if not large.isEmpty():
        dropped = dropped.unionByName(_search(large))
    return edges.where("word <> next_word").join(dropped, ["topic", "word", "next_word"], "left_anti")
