"""Exact token counts of whole texts; huge texts are encoded as overlapping chunks that are joined again.

A text of at most ``chunk`` code points is encoded whole, in the task that reads it. A longer one is cut into chunks that
overlap by ``overlap`` code points. The chunks are dealt over all tasks and encoded with offsets. Neighbours are joined at a
position where *both* begin a pre-token. Such a position is proven stable: pre-tokens are found from left to right, and
what follows the start of one depends on the text from there on only. So if the left chunk is right up to the position
(it starts right, and the position lies far enough from its end that no look-ahead or added token reaches the end), the
right chunk is right from there on. Equal token boundaries alone would not prove it and are not used.

Where an overlap holds no common position, as in long runs without a word boundary, the text is done again with chunks
and overlaps four times as wide, until every overlap has one or the text is a single chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.llm.encoding import encoder
from tertulia.llm.tables import map_rows
from tertulia.session import stage

CHUNK = 32_768
OVERLAP = 1_024


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row ``(key, n_bytes, n_tokens)`` per row of ``docs``; the key keeps its type.

    A null or empty text has no tokens. Rows with equal or null keys are counted one by one; other columns are ignored.
    """
    if overlap * 2 >= chunk:
        raise ValueError("chunks must be more than twice as long as overlaps")
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    kind = docs.schema[key].dataType.simpleString()
    whole = _count_whole(rows.filter(F.length("t") <= chunk), path, kind)
    # a stored number tells rows with the same key apart
    huge = rows.filter(F.length("t") > chunk).select(F.monotonically_increasing_id().alias("row"), "k", "t")
    huge = stage(huge, "huge-texts")
    parts = [whole]
    while not huge.isEmpty():
        if not encoder(path).can_splice:
            parts.append(_count_whole(huge.select("k", "t"), path, kind))
            break
        counted = stage(_count_spliced(huge, path, chunk, overlap), "huge-counts")
        done = counted.filter("n_tokens IS NOT NULL")
        parts.append(huge.drop("t").join(done, "row").select("k", "n_bytes", "n_tokens"))
        failed = counted.filter("n_tokens IS NULL").select("row")
        if failed.isEmpty():
            break
        huge = huge.join(failed, "row", "left_semi")
        chunk, overlap = chunk * 4, overlap * 4
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.withColumnRenamed("k", key)


def _count_whole(rows: DataFrame, path: str, kind: str) -> DataFrame:
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        find = encoder(path).ids
        for k, t in rows:
            yield k, len(t.encode()), len(find(t)) if t else 0

    return map_rows(rows, run, f"k {kind}, n_bytes long, n_tokens long")


def _count_spliced(huge: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``(row, n_bytes, n_tokens)``; the count is null where some overlap has no common word start."""
    step = chunk - overlap

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        for row, text in rows:
            size = len(text)
            for no, start in enumerate(range(0, max(1, size - overlap), step)):
                yield row, no, start, start + chunk >= size, text[start : start + chunk]

    def encode(rows: Iterator[tuple]) -> Iterator[tuple]:
        """A row per overlap that the chunk has a part in, and one for its own tokens."""
        own = encoder(path)
        for row, no, start, last, text in rows:
            at, before, n = own.word_starts(text)
            at = at + start
            fresh = len(text.encode()) if no == 0 else len(text[overlap:].encode())
            yield row, -1 - no, None, None, n if last else 0, fresh
            end = start + len(text)
            if no:
                seen = at < start + overlap
                yield row, no, at[seen].tolist(), (-before[seen]).tolist(), 0, 0
            if not last:
                seen = (at >= end - overlap) & (at < end - own.longest_added)
                yield row, no + 1, at[seen].tolist(), before[seen].tolist(), 0, 0

    chunks = map_rows(huge.select("row", "t"), cut, "row long, no long, start long, last boolean, text string")
    # dealt by row and number, so that a text of many chunks is spread over all tasks
    dealt = chunks.repartition(F.col("row"), F.col("no"))
    marks = map_rows(dealt, encode, "row long, seam long, at array<long>, tokens array<long>, n long, n_bytes long")
    # each seam has exactly two rows: the left chunk's word starts and the right one's, whose counts are negative
    pair = F.collect_list(F.map_from_arrays("at", "tokens"))
    seams = marks.groupBy("row", "seam").agg(
        F.sum("n").alias("n"), F.sum("n_bytes").alias("n_bytes"), F.when(F.col("seam") >= 0, pair).alias("pair")
    )
    a, b = F.col("pair")[0], F.col("pair")[1]
    common = F.array_min(F.array_intersect(F.map_keys(a), F.map_keys(b)))
    ok = F.when(F.col("seam") < 0, F.lit(0)).otherwise(F.element_at(a, common) + F.element_at(b, common))
    parts = seams.select("row", "n", "n_bytes", ok.cast("long").alias("joined"))
    total = F.when(F.count("joined") == F.count(F.lit(1)), F.sum(F.col("n") + F.col("joined")))
    return parts.groupBy("row").agg(F.sum("n_bytes").cast("long").alias("n_bytes"), total.cast("long").alias("n_tokens"))
