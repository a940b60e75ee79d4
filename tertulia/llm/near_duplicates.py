"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

A document is the set of its shingles (``SHINGLE`` words each, A-Z lower-cased), held as 64-bit hashes. Under each of
``PERMUTATIONS`` hash functions both the least and the greatest value are kept: either agrees between two sets with a
probability of their Jaccard similarity, so half as many hash evaluations give a signature of the same length, unbiased
and of lower variance. ``BANDS`` bands of four values each go into buckets; two sets of similarity 0.8 share none with a
probability of 1.4e-7.

Equal sets are one class, found by a 128-bit digest, and only class representatives go on. The members of a bucket are a
group around its pivot, the member that shares most buckets with others: the text that copies were made from, where it is
there. Each member is compared with the pivot on full sets, and what is linked makes up components. A pair inside a
component needs no look, nor does one of two members linked to the pivot. What is left is compared too: in groups of up to
``SMALL`` members pair by pair; in larger ones in blocks, where each member that is not linked meets all others in matrix
products of one task per pair of blocks. A block gives back the links that join components, fewer than it has members, so
no group yields its pairs as rows. A group of many copies that hang together thus costs about one comparison per member; one
whose members are all just below the threshold costs the products of its blocks, spread over tasks. No link is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tertulia.llm.components import connected
from tertulia.llm.tables import box, free_shuffles, map_rows, unbox
from tertulia.session import stage

SHINGLE = 4
BANDS = 30
SMALL = 16
# Members of a block, and shingles of all of them together, about.
BLOCK = 512
BLOCK_SHINGLES = 1 << 19
PERMUTATIONS = 2 * BANDS
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64(0x9E3779B97F4A7C15)
_SLOT = _RNG.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = _RNG.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(text: str, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each word; words are runs of anything but ASCII white space, ``fold`` lower-cases A-Z."""
    data = text.encode("utf-8", "surrogatepass")
    codes = np.frombuffer(b" " + (data.lower() if fold else data) + b" ", dtype=np.uint8)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    lengths = ends - starts
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), _PLACE, np.uint64), dtype=np.uint64)
        inside = np.flatnonzero(~blank)
        before = np.concatenate(([0], np.cumsum(lengths)))
        place = np.arange(len(inside)) - np.repeat(before[:-1], lengths)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[codes[inside]] * powers[place], dtype=np.uint64)))
        return _mix(total[before[1:]] - total[before[:-1]])


def shingle_set(text: str | None, length: int = SHINGLE) -> np.ndarray:
    """Distinct shingles, sorted; a text of fewer words is one shingle, a text without words has none."""
    words = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(length, len(words))))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.full(len(words) - n + 1, n, np.uint64)
        for i in range(n):
            h = h + words[i : len(words) - n + 1 + i] * _SLOT[i]
        return _mix(h)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """The bucket of each band: two permutations, least and greatest value of each."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):
            values = _A[:, None] * shingles[None, at : at + 2048] + _B[:, None]
            low = np.minimum(low, values.min(1))
            high = np.maximum(high, values.max(1))
        key = np.arange(BANDS, dtype=np.uint64)
        for i, part in enumerate((low[0::2], high[0::2], low[1::2], high[1::2])):
            key = _mix(key + part * _SLOT[i])
    return key.view(np.int64)


def _sets(docs: DataFrame, length: int) -> DataFrame:
    """``(doc, n, d1, d2, bands)`` per row; no bands for empty sets."""
    kind = docs.schema["doc"].dataType.simpleString()

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, text in rows:
            s = shingle_set(text, length)
            yield doc, len(s), *_digest(s), band_keys(s).tolist() if len(s) else None

    return map_rows(docs, run, f"doc {kind}, n long, d1 long, d2 long, bands array<long>")


def _linked(percent: int) -> Column:
    """Of the sets ``set_a`` and ``set_b``: whether 100 * intersection >= percent * union."""

    @F.pandas_udf(T.BooleanType())
    def compare(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            same = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
            out.append(100 * same >= percent * (len(x) + len(y) - same))
        return pd.Series(out, dtype=bool)

    return compare(F.col("set_a"), F.col("set_b"))


def _with_sets(pairs: DataFrame, full: DataFrame, a: str, b: str) -> DataFrame:
    """``set_a`` and ``set_b`` beside the classes in columns ``a`` and ``b``."""
    left = full.select(F.col("c").alias(a), F.col("shingles").alias("set_a"))
    right = full.select(F.col("c").alias(b), F.col("shingles").alias("set_b"))
    return pairs.join(left, a).join(right, b)


def _buckets(classes: DataFrame) -> DataFrame:
    """``(c, n, first)``: classes in buckets of two and more, and the pivot of the bucket, a struct like ``(c, n)``."""
    banded = classes.select("n", F.struct("d1", "d2").alias("c"), F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = stage(banded.join(shared, "bucket"), "buckets")
    weight = members.groupBy("c").agg(F.sum("m").alias("weight"))
    weighed = members.join(weight, "c")
    # most weight, then the least digest
    pivot = weighed.groupBy("bucket").agg(F.min(F.struct((-F.col("weight")).alias("w"), "c", "n")).alias("p"))
    pivot = pivot.select("bucket", F.struct("p.c", "p.n").alias("first"))
    return members.join(pivot, "bucket").select("c", "n", "first")


def _close(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _pairs_of_small(rows: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: pairs of different components ``g`` in small groups that were not compared yet."""
    mine = rows.filter(~F.col("linked")).select("p", F.struct("x", "g").alias("u"))
    others = rows.select("p", F.struct("x", "g", "linked").alias("v"))
    # of two members that are both not linked to the pivot, the smaller one asks
    ask = (F.col("u.g") != F.col("v.g")) & (F.col("v.linked") | (F.col("u.x") < F.col("v.x"))) & _close(F.col("u.x.n"), F.col("v.x.n"), percent)
    pairs = mine.join(others, "p").filter(ask).select(F.col("u.x.c").alias("a"), F.col("v.x.c").alias("b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _blocks_of_large(rows: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: links that join different components ``g`` inside large groups.

    Members are dealt into blocks by their digest; blocks of those that are not linked to the pivot meet all blocks.
    """
    size = lambda when: F.ceil(F.greatest(F.count_if(when) / BLOCK, F.sum(F.when(when, F.col("x.n"))) / BLOCK_SHINGLES)).cast("int")
    number = rows.groupBy("p").agg(size(~F.col("linked")).alias("na"), size(F.lit(True)).alias("nb")).filter("na > 0")
    rows = rows.join(number, "p").select("na", "nb", "linked", "p", F.col("x.c").alias("c"), F.struct("x.c.d1", "x.c.d2", "x.n", "g").alias("x"))
    rows = rows.join(full, "c").withColumn("hash", F.xxhash64("c.d1", "c.d2"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod("hash", F.col(n)).cast("int")
    flat = ["p.c.d1 AS p1", "p.c.d2 AS p2", "ab", "bb", "x.d1", "x.d2", "x.n", "x.g.d1 AS g1", "x.g.d2 AS g2", "shingles"]
    asking = rows.filter("NOT linked").withColumn("ab", own("na")).withColumn("bb", each("nb")).selectExpr(*flat, "true AS asks")
    others = rows.withColumn("bb", own("nb")).withColumn("ab", each("na")).selectExpr(*flat, "false AS asks")
    found = asking.unionByName(others).groupBy("p1", "p2", "ab", "bb").applyInPandas(lambda members: _block_links(members, percent), "a1 long, a2 long, b1 long, b2 long")
    return found.select(F.struct(F.col("a1").alias("d1"), F.col("a2").alias("d2")).alias("a"), F.struct(F.col("b1").alias("d1"), F.col("b2").alias("d2")).alias("b"))


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each two sets, by products of 0/1 matrices over some columns at a time."""
    total = np.zeros((len(left), len(right)))
    known = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    places = []
    for sets in (left, right):
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
        inside = known[at] == flat if len(known) else np.zeros(len(flat), bool)
        order = np.argsort(at[inside], kind="stable")
        places.append((at[inside][order], owner[inside][order], len(sets)))
    for low in range(0, len(known), 2048):
        matrices = []
        for at, owner, n in places:
            cut = slice(*np.searchsorted(at, [low, low + 2048]))
            matrices.append(np.zeros((n, 2048), np.float32))
            matrices[-1][owner[cut], at[cut] - low] = 1
        total += matrices[0] @ matrices[1].T
    return total


def _block_links(members: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between members of two blocks (``asks`` or not) that join components, no more than it takes to join them."""
    out: list[tuple[int, int, int, int]] = []
    left, right = members[members["asks"]], members[~members["asks"]]
    if len(left) and len(right):
        a, b = ([np.frombuffer(s, np.uint64) for s in df["shingles"]] for df in (left, right))
        same = _shared_counts(a, b)
        sizes = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])
        names = [df[["d1", "d2"]].to_numpy(np.int64) for df in (left, right)]
        group = pd.factorize(pd.MultiIndex.from_frame(pd.concat([left[["g1", "g2"]], right[["g1", "g2"]]])))[0]
        mine, theirs = group[: len(a)], group[len(a) :].copy()
        linked = 100 * same >= percent * (sizes - same)
        for i in range(len(a)):
            while len(found := np.flatnonzero(linked[i] & (theirs != mine[i]))):
                j = found[0]
                out.append((*names[0][i].tolist(), *names[1][j].tolist()))
                # the two components are one from here on
                old = theirs[j]
                theirs[theirs == old], mine[mine == old] = mine[i], mine[i]
    return pd.DataFrame(out, columns=["a1", "a2", "b1", "b2"]).astype("int64")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = SHINGLE, percent: int = 80) -> DataFrame:
    """One row ``(key, d1, d2, n_shingles, component_id)`` per row of ``docs``; ``d1, d2`` is the digest of the set.

    Null, empty and blank texts have an empty set and are linked with nothing: their component is their own id. Rows that
    repeat an id are documents of their own which share a name. Rows without an id are linked like others but name no
    component; where no linked row has an id, the component is null. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    sets = stage(_sets(rows, length), "shingle-digests")
    classes = sets.filter("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc").alias("rep"), F.any_value("bands").alias("bands"))
    classes = stage(classes, "classes")
    members = stage(_buckets(classes), "bucket-pivots")
    full = stage(_full_sets(rows, sets, members.select("c.d1", "c.d2").distinct(), length), "full-sets")

    around = members.filter("c <> first.c").select(F.col("first").alias("p"), F.struct("c", "n").alias("x")).distinct()
    around = around.withColumns({"pc": F.col("p.c"), "xc": F.col("x.c")})
    compared = stage(_with_sets(around, full, "pc", "xc").select("p", "x", _linked(percent).alias("linked")), "compared")
    links = compared.filter("linked").select(F.col("p.c").alias("a"), F.col("x.c").alias("b")).distinct()
    free_shuffles(spark)
    groups = connected(links)
    free_shuffles(spark)

    sizes = compared.groupBy("p").agg((F.count(F.lit(1)) > SMALL).alias("large"))
    labelled = compared.withColumn("node", F.col("x.c")).join(groups, "node", "left").withColumn("g", F.coalesce("component", "node"))
    labelled = stage(labelled.join(sizes, "p").select("p", "x", "linked", "g", "large"), "labelled")
    rest = _pairs_of_small(labelled.filter("NOT large"), percent)
    more = _with_sets(rest, full, "a", "b").select("a", "b", _linked(percent).alias("linked")).filter("linked").select("a", "b")
    more = stage(more.unionByName(_blocks_of_large(labelled.filter("large"), full, percent)), "links")
    free_shuffles(spark)
    if not more.isEmpty():
        # the components found before stand for their links
        groups = connected(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    free_shuffles(spark)

    named = classes.select("n", "d1", "d2", "rep", F.struct("d1", "d2").alias("node")).join(groups, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    ids = named.groupBy("component").agg(F.min("rep").alias("least"))
    of_class = stage(named.join(ids, "component").select("n", "d1", "d2", "least"), "class-components")
    out = sets.drop("bands").join(of_class, ["n", "d1", "d2"], "left")
    return out.select(F.col("doc").alias(key), "d1", "d2", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("component_id"))


def _digest(shingles: np.ndarray) -> list[int]:
    return np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64).tolist()


def _full_sets(rows: DataFrame, sets: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The full set of one document of each wanted class, as bytes; rows without an id are all looked at."""
    of_doc = sets.join(wanted, ["d1", "d2"], "left_semi").groupBy("d1", "d2").agg(F.min("doc").alias("doc"))
    texts = rows.join(of_doc.select("doc").distinct(), "doc", "left_semi").select("text")
    texts = texts.unionByName(rows.filter("doc IS NULL").select("text"))

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (text,) in rows:
            s = shingle_set(text, length)
            if len(s):
                yield *_digest(s), s.tobytes()

    found = map_rows(texts, run, "d1 long, d2 long, shingles binary")
    # rows that repeat an id may bring further sets or the same set twice
    return found.groupBy(F.struct("d1", "d2").alias("c")).agg(F.any_value("shingles").alias("shingles"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, of those with its id; texts without words all stay.

    A row without an id stays if its component has no row with one. Of rows that repeat an id each is judged by its own
    text; equal rows count once.
    """
    found = stage(near_duplicates(docs, key, text).withColumnRenamed(key, "_id"), "components")
    often = found.groupBy("_id").agg(F.count(F.lit(1)).alias("m")).filter("m > 1 AND _id IS NOT NULL").select("_id")
    often = stage(often, "repeated-ids")
    gone = found.filter("_id <> component_id").join(often, "_id", "left_anti").select("_id")
    boxed = box(docs, _id=docs[key], _text=docs[text])
    once = boxed.join(often.unionByName(gone), "_id", "left_anti").filter("_id IS NOT NULL").select("row")
    # rows whose id does not tell them apart get the digest of their text
    twice = boxed.join(often, "_id", "left_semi").unionByName(boxed.filter("_id IS NULL"))
    if twice.isEmpty():
        return unbox(once)
    rows = stage(twice.withColumn("_at", F.monotonically_increasing_id()), "rows-of-repeated-ids")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for at, text in rows:
            s = shingle_set(text)
            yield at, len(s), *_digest(s)

    digests = map_rows(rows.select("_at", "_text"), run, "_at long, n long, d1 long, d2 long")
    of_row = found.select("_id", "d1", "d2", "component_id").distinct()
    same = F.col("r._id").eqNullSafe(F.col("f._id")) & (F.col("r.d1") == F.col("f.d1")) & (F.col("r.d2") == F.col("f.d2"))
    judged = rows.join(digests, "_at").alias("r").join(of_row.alias("f"), same).select("r._at", "r._id", "n", "component_id")
    first = judged.filter("n > 0 AND _id = component_id").groupBy("component_id").agg(F.min("_at").alias("_at")).select("_at")
    stay = first.unionByName(judged.filter("n = 0 OR (_id IS NULL AND component_id IS NULL)").select("_at"))
    return unbox(once.unionByName(rows.join(stay, "_at", "left_semi").select("row")))
