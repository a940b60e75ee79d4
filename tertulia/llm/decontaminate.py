"""Passages of benchmark items inside documents, found by winnowing; DataFrame functions only.

Words are replaced by their 64-bit hashes. The fingerprint of a text is the least hash of ``GRAM`` words in every run of
``window - GRAM + 1`` neighbouring grams. Two texts that share ``window`` words share such a run and so its least hash:
no shared window is missed. Fingerprints of documents are joined with those of the items. Only documents with a common
fingerprint go on: their windows are compared with the windows of the items by 128-bit hashes over the words, every
occurrence is extended to the words it covers, and words are counted once.

Items shorter than a window are windows themselves. Winnowing promises nothing for them, so all runs of that many words
are compared, for each of the few lengths that occur.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.llm.tables import box, unbox
from tertulia.session import lookup_join, stage

WINDOW = 10
GRAM = 5
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_hashes(text: Column) -> Column:
    """A hash per word; words are runs of digits, letters and all characters beyond ASCII, with A-Z lower-cased."""
    words = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAKS, -1)
    return F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w))


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once per row, also where lambdas refer to it again and again."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _fingerprints(df: DataFrame, window: int, gram: int) -> DataFrame:
    """``df`` with ``h`` (word hashes) plus the distinct fingerprints; null for texts shorter than a window."""
    n = F.size("h")
    grams = F.transform(F.sequence(F.lit(0), n - gram), lambda i: F.xxhash64(*[F.get("h", i + j) for j in range(gram)]))
    with_grams = held(df, "g", F.when(n >= window, grams))
    least = F.transform(F.sequence(F.lit(0), n - window), lambda i: F.least(*[F.get("g", i + j) for j in range(window - gram + 1)]))
    return with_grams.withColumn("prints", F.when(n >= window, F.array_distinct(least))).drop("g")


def _windows(df: DataFrame, length: int) -> DataFrame:
    """A row ``(at, a, b)`` for each run of ``length`` words, beside the other columns of ``df``."""
    at = F.posexplode(F.transform(F.sequence(F.lit(1), F.size("h") - length + 1), lambda i: F.slice("h", i, length))).alias("at", "words")
    rows = df.filter(F.size("h") >= length).select("*", at).drop("h")
    return rows.withColumns({"length": F.lit(length), "a": F.xxhash64("words"), "b": F.xxhash64(F.lit(length), "words")}).drop("words")


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Two hashes over key and text name a row; rows that repeat both are alike in all that follows."""
    return docs.withColumns({"k1": F.xxhash64(F.col(key), F.col(text)), "k2": F.xxhash64(F.lit(1), F.col(key), F.col(text))})


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    max_broadcast: int = 1_000_000,
) -> DataFrame:
    """One row ``(key, k1, k2, n_words, n_hit, item_ids)`` per row of ``docs``; ``item_ids`` are sorted strings.

    A null or empty text has no words, is hit by nothing and hits nothing. Items with equal texts are all reported; an
    item id that repeats is reported once, and null item ids are left out. Other columns are ignored.
    """
    rows = keyed(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), "id", "text")
    bench = stage(items.select(F.col(item_key).cast("string").alias("item"), word_hashes(F.col(item_text)).alias("h")), "items")
    lengths = [r[0] for r in bench.select(F.least(F.size("h"), F.lit(window)).alias("n")).filter("n > 0").distinct().collect()]

    # documents with a fingerprint of some item; a row is a document again right after the join, inside the same task
    prints = _fingerprints(bench, window, gram).select(F.explode("prints").alias("print")).distinct().withColumn("known", F.lit(1))
    hashed = held(rows, "h", word_hashes(F.col("text"))).drop("text")
    own = _fingerprints(hashed, window, gram).select("id", "k1", "k2", F.size("h").alias("n_words"), F.posexplode_outer("prints").alias("no", "print"))
    met = lookup_join(own, prints, ["print"], "left", salt_by="k1", max_rows=max_broadcast)
    first = F.coalesce(F.col("no"), F.lit(0)) == 0
    base = met.groupBy("id", "k1", "k2", "n_words").agg(F.max("known").alias("known"), F.count_if(first).alias("copies"))
    base = stage(base, "fingerprints-met")

    # their windows against those of the items
    found = []
    texts = rows.select("k1", "k2", "text")
    if window in lengths:
        near = base.filter("known = 1").select("k1", "k2").distinct()
        texts_met = lookup_join(texts, near, ["k1", "k2"], "left_semi", salt_by="k2", max_rows=max_broadcast)
        found.append(_windows(held(texts_met, "h", word_hashes(F.col("text"))).drop("text"), window))
    for length in sorted(set(lengths) - {window}):
        found.append(_windows(held(texts, "h", word_hashes(F.col("text"))).drop("text"), length))
    if not found:
        return base.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
            F.col("id").alias(key), "k1", "k2", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("item_ids")
        )
    lists = reduce(DataFrame.unionByName, [_windows(bench if n == window else bench.filter(F.size("h") == n), n) for n in lengths])
    lists = stage(lists.select("item", "length", "a", "b").distinct(), "item-windows")
    known = lists.select("length", "a", "b").distinct()
    hits = lookup_join(reduce(DataFrame.unionByName, found), known, ["length", "a", "b"], "left_semi", salt_by="k1", max_rows=max_broadcast)
    hits = stage(hits, "hits")
    covered = hits.select("k1", "k2", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("length") - 1)).alias("word"))
    n_hit = covered.distinct().groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_hit"))
    pairs = hits.select("k1", "k2", "length", "a", "b").distinct().join(lists, ["length", "a", "b"]).select("k1", "k2", "item").distinct()
    per_doc = pairs.groupBy("k1", "k2").agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    out = base.join(n_hit, ["k1", "k2"], "left").join(per_doc, ["k1", "k2"], "left")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(
        F.col("id").alias(key), "k1", "k2", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that no window of an item occurs in, with all their columns."""
    hit = contamination(docs, items, key, text, **settings).filter("n_hit > 0").select("k1", "k2").distinct()
    boxed = box(docs, k1=F.xxhash64(docs[key], docs[text]), k2=F.xxhash64(F.lit(1), docs[key], docs[text]))
    return unbox(lookup_join(boxed, hit, ["k1", "k2"], "left_anti", salt_by="k2"))
