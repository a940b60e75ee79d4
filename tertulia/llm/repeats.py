"""Removal of repeated byte strings of ``LENGTH`` or more, by ranking strings of growing length.

A suffix array tells equal strings by sorting; distributed prefix doubling gets there by ranks of short strings, pairs of
which rank strings of twice the length, dropping positions as soon as they are unique. Ranking every byte moves each
position through several shuffles, many times the input. So the ranks start at anchors: of every window of ``LENGTH`` bytes
the ``GRAM`` bytes of least hash. Equal windows have the same anchor at the same place, so windows are ranked in runs that
share an anchor, and a run is refined only as long as it is not decided:

1. runs of all windows with the same anchor, told apart by the anchor, then by all bytes the run spans;
2. runs of ``BLOCK`` windows at fixed distances from the anchor, told apart by the bytes all of them share (90 of 100);
3. single windows.

On each level a run whose first string occurs once in the corpus is unique and dropped. Of runs that span equal bytes all
but the first in order of the corpus are repeated: all their bytes go. The first one is decided too, unless its short
string also occurs in a run of other bytes; only such runs go on to the next level. This is exact: a window is removed if
and only if an equal one starts earlier.

Strings are compared by 64-bit hashes of two kinds at once (the short and the long one). Between levels a bitmap of at most
``BITS`` bits, filled from the hashes that occur twice, tells tasks what to emit; a bit set by chance costs a row and
changes nothing. Sums are formed before every shuffle, and very frequent keys are split by the join that follows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tertulia.llm.tables import box, delete_folder, free_shuffles, unbox
from tertulia.session import new_folder, stage

LENGTH = 100
GRAM = 32
BLOCK = 11
BITS = 1 << 28
# Windows of a part of a huge text, and bytes hashed side by side: few enough for a core's cache.
PART = 1 << 16
BUFFER = 1 << 16
PLACE_BITS = 17  # places in a buffer
# Rows after which a task hands on what it has found.
ROWS = 500_000
# A position is a number below 2**40, above it 23 bits of the text's hash: rows that repeat an id are told apart.
PLACE = (1 << 40) - 1

_RNG = np.random.default_rng(1729)
_BYTES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


_KNOWN: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; the longest list so far is kept, ``BUFFER`` and a little of them."""
    if base not in _KNOWN or len(_KNOWN[base]) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        with np.errstate(over="ignore"):
            _KNOWN[base] = np.cumprod(out, out=out)
    return _KNOWN[base][:n]


class Hashes:
    """Hashes of any spans of a buffer in constant time each."""

    def __init__(self, codes: np.ndarray):
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        self.back = _powers(_INVERSE, len(codes) + 1)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTES[codes] * _powers(_BASE, len(codes) + 1)[:-1], out=self.sums[1:])

    def every(self, width: int) -> np.ndarray:
        """The hashes of all spans of one width, not mixed: their upper bits are good."""
        with np.errstate(over="ignore"):
            h = self.sums[width:] - self.sums[:-width]
            h *= self.back[: len(h)]
            return h

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix((self.sums[end] - self.sums[start]) * self.back[start])


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """In every run of ``w`` the least of the upper bits, the leftmost of equal ones, with its place in the lower bits."""
    n = len(h)
    key = (h >> np.uint64(32 + PLACE_BITS)).astype(np.uint32) << np.uint32(PLACE_BITS)
    key |= np.arange(n, dtype=np.uint32)
    # the least of runs of doubling length, until two of them overlap to one of w
    size = 1
    while 2 * size <= w:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    return np.minimum(key[: n - w + 1], key[w - size : w - size + n - w + 1])


class Pieces(NamedTuple):
    """Texts, or parts of huge ones, side by side in a buffer that fits a core's cache."""

    codes: np.ndarray
    owner: np.ndarray  # row of each piece
    place: np.ndarray  # where in its text a piece starts
    begin: np.ndarray  # where in the buffer


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where each row starts and the last one ends."""
    column = column.cast(pa.large_binary())
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data if data is not None else b"", np.uint8), at


def _pieces(column: pa.Array, rows: np.ndarray, part_size: int) -> Iterator[Pieces]:
    """The texts of ``rows``, each of ``LENGTH`` bytes or more; huge ones in parts of ``part_size`` windows."""
    data, at = _bytes_of(column)
    held: list[np.ndarray] = []
    marks: list[tuple[int, int, int]] = []
    size = 0
    for row in rows.tolist():
        low, high = int(at[row]), int(at[row + 1])
        for start in range(low, high - LENGTH + 1, part_size):
            piece = data[start : min(high, start + part_size + LENGTH - 1)]
            if held and size + len(piece) > BUFFER:
                yield Pieces(np.concatenate(held), *np.array(marks, dtype=np.int64).T)
                held, marks, size = [], [], 0
            held.append(piece)
            marks.append((row, start - low, size))
            size += len(piece)
    if held:
        yield Pieces(np.concatenate(held), *np.array(marks, dtype=np.int64).T)


def anchor_runs(codes: np.ndarray, begin: np.ndarray) -> tuple[Hashes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, and of each run its anchor, its first window, the number of windows and its piece; no run crosses pieces."""
    end = np.append(begin[1:], len(codes))
    hashes = Hashes(codes)
    least = _least(hashes.every(GRAM), LENGTH - GRAM + 1)
    # windows that lie across two pieces are runs of their own and go
    new = np.zeros(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[begin] = True
    new[(end - LENGTH + 1)[:-1]] = True
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(least)))
    piece = np.searchsorted(begin, first, "right") - 1
    whole = first + LENGTH <= end[piece]
    first, n, piece = first[whole], n[whole], piece[whole]
    anchor = (least[first] & np.uint32((1 << PLACE_BITS) - 1)).astype(np.int64)
    return hashes, anchor, first, n, piece


def _is_set(bitmap: np.ndarray | None, values: np.ndarray) -> np.ndarray:
    if bitmap is None:
        return np.ones(len(values), bool)
    at = _mix(values.astype(np.int64).view(np.uint64)) & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _anchored(docs: DataFrame, schema: str, pick, texts: Broadcast | None = None) -> DataFrame:
    """Columns that ``pick(hashes, codes, anchor, first, n, row, at)`` takes of the runs of a buffer; ``at`` holds the tag too."""
    part_size = PART

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags = batch.column(1).to_numpy()
            rows = np.flatnonzero(_is_set(texts.value if texts is not None else None, tags))

            def found() -> Iterator[tuple[np.ndarray, ...]]:
                for codes, owner, place, begin in _pieces(batch.column(2), rows, part_size):
                    hashes, anchor, first, n, piece = anchor_runs(codes, begin)
                    row = owner[piece]
                    yield pick(hashes, codes, anchor, first, n, row, first - begin[piece] + place[piece] + tags[row])

            yield from _batches(found(), batch.column(0), schema)

    return docs.mapInArrow(run, schema)


def _batches(found: Iterator[tuple[np.ndarray, ...]], ids: pa.Array, schema: str) -> Iterator[pa.RecordBatch]:
    """Columns as batches of about ``ROWS`` rows; a column ``doc`` holds numbers of rows and becomes their ids."""
    names = [part.split()[0] for part in schema.split(", ")]
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = dict(zip(names, (np.concatenate(x) for x in zip(*held))))
        arrays = {}
        for name, values in columns.items():
            if name == "doc":
                arrays[name] = ids.take(pa.array(values))
            else:
                arrays[name] = pa.array(values.view(np.int64) if values.dtype == np.uint64 else values)
        return pa.RecordBatch.from_pydict(arrays)

    for columns in found:
        held.append(columns)
        size += len(columns[0])
        if size > ROWS:
            yield batch()
            held, size = [], 0
    if size:
        yield batch()


def _grams(docs: DataFrame) -> DataFrame:
    """The short string of every run."""
    return _anchored(docs, "short long", lambda hashes, codes, anchor, first, n, row, at: (hashes.spans(anchor, anchor + GRAM),))


def _whole_runs(docs: DataFrame, seen: Broadcast) -> DataFrame:
    """The runs whose short strings ``seen`` lets through."""

    def pick(hashes, codes, anchor, first, n, row, at):
        short = hashes.spans(anchor, anchor + GRAM)
        keep = np.flatnonzero(_is_set(seen.value, short.view(np.int64)))
        first, n = first[keep], n[keep]
        return short[keep], hashes.spans(first, first + n - 1 + LENGTH), row[keep], at[keep], n.astype(np.int32)

    return _anchored(docs, f"short long, long long, doc {_kind(docs)}, at long, n int", pick)


def _open_runs(docs: DataFrame, texts: Broadcast, runs: Broadcast) -> DataFrame:
    """The bytes of undecided runs, under 200 each, with the way from the first window to the anchor."""

    def pick(hashes, codes, anchor, first, n, row, at):
        keep = np.flatnonzero(_is_set(runs.value, at))
        first, n = first[keep], n[keep]
        body = np.empty(len(keep), object)
        body[:] = [codes[a:b].tobytes() for a, b in zip(first.tolist(), (first + n - 1 + LENGTH).tolist())]
        return row[keep], at[keep], n.astype(np.int32), (anchor[keep] - first).astype(np.int32), body

    return _anchored(docs, f"doc {_kind(docs)}, at long, n int, lead int, body binary", pick, texts)


def _within(runs: DataFrame, blocks: Broadcast | None, seen: Broadcast | None, count: bool) -> DataFrame:
    """Blocks of windows of the undecided runs or, where ``blocks`` tells the undecided ones, single windows of those.

    With ``count`` the short strings alone, else all columns of those that ``seen`` lets through.
    """
    schema = "short long" if count else f"short long, long long, doc {_kind(runs)}, at long, n int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batches(found(batch), batch.column(0), schema)

    def found(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        data, off = _bytes_of(batch.column(4))
        at, n, lead = (batch.column(i).to_numpy() for i in (1, 2, 3))
        low = 0
        while low < len(at):
            high = max(low + 1, int(np.searchsorted(off, off[low] + BUFFER, "right")) - 1)
            first = off[low:high] - off[low]
            hashes = Hashes(data[off[low] : off[high]])
            short, long, row, window, size = _split(hashes, first, n[low:high].astype(np.int64), first + lead[low:high], at[low:high] - first)
            keep = np.flatnonzero(_is_set(seen.value if seen is not None else None, short.view(np.int64)))
            if count:
                yield (short[keep],)
            else:
                place = window[keep] + (at[low:high] - first)[row[keep]]
                yield short[keep], long[keep], row[keep] + low, place, size[keep].astype(np.int32)
            low = high

    def _split(hashes, first, n, anchor, shift):
        row, window = _every(first, n)
        block = (anchor[row] - window) // BLOCK
        start = np.flatnonzero(np.concatenate(([True], (block[1:] != block[:-1]) | (row[1:] != row[:-1]))))
        size = np.diff(np.append(start, len(window)))
        row, window, block = row[start], window[start], block[start]
        if blocks is None:
            # all windows of a full block share these bytes, whether the run holds all of them or not
            low = anchor[row] - block * BLOCK
            return hashes.spans(low, low - (BLOCK - 1) + LENGTH), hashes.spans(window, window + size - 1 + LENGTH), row, window, size
        live = _is_set(blocks.value, window + shift[row])
        row = row[live]
        of, window = _every(window[live], size[live])
        whole = hashes.spans(window, window + LENGTH)
        return whole, whole, row[of], window, np.ones(len(window), np.int64)

    return runs.mapInArrow(run, schema)


def _every(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of runs, with the number of the run of each."""
    row = np.repeat(np.arange(len(n)), n)
    return row, first[row] + np.arange(len(row)) - (np.cumsum(n) - n)[row]


def _kind(df: DataFrame) -> str:
    return df.schema["doc"].dataType.simpleString()


def _bitmap(values: DataFrame) -> Broadcast:
    """A bitmap with the bits of all values (one column) set, 64 bits per value but ``BITS`` at most."""
    spark = values.sparkSession
    values = stage(values.distinct(), "bits")
    bits = min(BITS, max(1 << 16, 1 << (64 * values.count()).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = (_mix(batch.column(0).to_numpy().astype(np.int64).view(np.uint64)) & np.uint64(bits - 1)).view(np.int64)
            yield pa.RecordBatch.from_pydict({"part": pa.array(at >> 15), "place": pa.array(at & 32767)})

    placed = values.mapInArrow(place, "part long, place long")
    out = np.zeros(bits // 8, np.uint8)
    for row in placed.groupBy("part").agg(F.bitmap_construct_agg("place").alias("b")).collect():  # BITS bits at most
        out[row["part"] * 4096 : row["part"] * 4096 + 4096] |= np.frombuffer(row["b"], np.uint8)[: len(out)]
    free_shuffles(spark)
    return spark.sparkContext.broadcast(out)


def _decided(rows: DataFrame, last: bool) -> DataFrame:
    """``(doc, at, n, repeated)``: repeated runs, and those that are open; on the last level none is open.

    The two are found one after the other, so that the shuffles of one are gone when the other begins.
    """
    spark, path = rows.sparkSession, new_folder(rows.sparkSession, "ranked-runs")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    found = stage(_repeated(rows), "runs")
    free_shuffles(spark)
    if not last:
        found = stage(_undecided(rows), "runs").unionByName(found)
    delete_folder(spark, path)
    free_shuffles(spark)
    return found


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("short", "long").agg(F.min(F.struct("doc", "at", "n")).alias("first"), F.count(F.lit(1)).alias("m"))


def _repeated(rows: DataFrame) -> DataFrame:
    """All but the first of runs with equal bytes."""
    later = rows.join(_groups(rows).filter("m > 1").select("short", "long", "first"), ["short", "long"])
    later = later.filter(~(F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("at") == F.col("first.at"))))
    return later.select("doc", "at", "n", F.lit(True).alias("repeated"))


def _undecided(rows: DataFrame) -> DataFrame:
    """The first of runs with equal bytes where runs of other bytes have the same short string."""
    several = rows.groupBy("short").agg((F.min("long") < F.max("long")).alias("several")).filter("several").select("short")
    return _groups(rows).join(several, "short").select("first.doc", "first.at", "first.n", F.lit(False).alias("repeated"))


def _several(strings: DataFrame) -> Broadcast:
    """A bitmap of the strings that occur more than once."""
    return _bitmap(strings.groupBy("short").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("short"))


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, tag, start, size)``: spans of bytes covered by strings that also start earlier; they may overlap.

    Texts are ordered by id (null first), then by a hash of the text; ``tag`` is that hash.
    """
    tagged = docs.select(F.col(key).alias("doc"), _tag(text).alias("tag"), F.col(text).alias("text")).filter(F.octet_length("text") >= LENGTH)
    decided = _decided(_whole_runs(tagged, _several(_grams(tagged))), last=False)
    found = [decided.filter("repeated")]
    still = decided.filter(~F.col("repeated"))
    if not still.isEmpty():
        texts = _bitmap(still.select((F.col("at") - F.col("at").bitwiseAND(F.lit(PLACE))).alias("v")))
        runs = stage(_open_runs(tagged, texts, _bitmap(still.select("at"))), "open-runs")
        decided = _decided(_within(runs, None, None, count=False), last=False)
        found.append(decided.filter("repeated"))
        still = decided.filter(~F.col("repeated"))
        if not still.isEmpty():
            blocks = _bitmap(still.select("at"))
            seen = _several(_within(runs, blocks, None, count=True))
            found.append(_decided(_within(runs, blocks, seen, count=False), last=True))
    spans = found[0]
    for part in found[1:]:
        spans = spans.unionByName(part)
    place = F.col("at").bitwiseAND(F.lit(PLACE))
    return spans.select("doc", (F.col("at") - place).alias("tag"), place.alias("start"), (F.col("n") - 1 + LENGTH).alias("size"))


def _tag(text: str):
    return F.shiftleft(F.xxhash64(text).bitwiseAND(F.lit((1 << 23) - 1)), 40)


@F.pandas_udf(T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())]))
def _cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for text, own in zip(texts, spans):
        data = text.encode("utf-8", "surrogatepass")
        start = np.array([s["start"] for s in own], dtype=np.int64)
        order = np.argsort(start, kind="stable")
        start = start[order]
        reach = np.maximum.accumulate(start + np.array([s["size"] for s in own], dtype=np.int64)[order])
        first = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))  # spans that touch are one
        begin, end = start[first], reach[np.append(first[1:], len(start)) - 1]
        kept = b"".join(data[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(data)]))
        out.append((kept, int((end - begin).sum()), len(first)))
    return pd.DataFrame(out, columns=["kept", "n_removed", "n_spans"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``kept`` (the bytes that stay), ``n_bytes``, ``n_removed`` and ``n_spans``.

    A null text counts as empty. Matches never cross rows. Rows that repeat both id and text are one text and get the same
    result; rows without an id come first in the order.
    """
    spans = repeated_runs(docs, key, text).groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    spans = stage(spans, "removed-spans")
    free_shuffles(docs.sparkSession)
    spans = spans.withColumnRenamed("doc", "_doc").withColumnRenamed("tag", "_tag")
    body = F.coalesce(docs[text], F.lit(""))
    rows = box(docs, doc=docs[key], tag=_tag(text), text=body)
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("tag") == F.col("_tag"))
    hit = rows.join(spans, same).withColumn("r", _cut("text", "spans"))
    clean = rows.join(spans.select("_doc", "_tag"), same, "left_anti")
    size = F.octet_length("text").cast("long")
    zero = F.lit(0).cast("long")
    return unbox(hit, added={"kept": F.col("r.kept"), "n_bytes": size, "n_removed": F.col("r.n_removed"), "n_spans": F.col("r.n_spans")}).unionByName(
        unbox(clean, added={"kept": F.col("text").cast("binary"), "n_bytes": size, "n_removed": zero, "n_spans": zero})
    )
