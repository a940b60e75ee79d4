"""Packing of token pieces into sequences: first-fit decreasing inside random groups.

Every document is encoded, closed by an end id and cut into pieces of at most ``size`` ids. Full pieces are sequences of
their own. The rest, one piece per document at most, are spread over groups at random. In each group a task sorts its
pieces by falling length and puts each into the first sequence with room, found by walking a tournament tree whose inner
nodes hold the largest free capacity below them: O(log n) per piece. Groups hold about ``group_size`` pieces whatever the
size of the input, and sequences never cross groups, so the waste per group is that of one first-fit run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tertulia.llm.encoding import encoder
from tertulia.llm.tables import map_rows

SIZE = 1024
GROUP_SIZE = 8192


def cut_pieces(docs: DataFrame, path: str, size: int = SIZE, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(key, start, length, ids, doc_tokens)``, every id of every document in exactly one of them.

    ``ids`` are little-endian unsigned 32-bit numbers. A null or empty text is the end id alone. Rows with equal or null
    keys are encoded one by one; other columns are ignored. A huge text, long runs of white space included, is encoded whole
    by one task.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        find = encoder(path).ids
        for k, t in rows:
            ids = np.append(find(t) if t else np.zeros(0, np.uint32), end_id).astype("<u4")
            for start in range(0, len(ids), size):
                piece = ids[start : start + size]
                yield k, start, len(piece), piece.tobytes(), len(ids)

    pieces = map_rows(docs.select(F.col(key), F.col(text)), run, f"k {kind}, start long, length long, ids binary, doc_tokens long")
    return pieces.withColumnRenamed("k", key)


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece; pieces of equal length keep their order."""
    order = np.argsort(-lengths, kind="stable")
    leaves = 1 << max(0, int(len(lengths) - 1).bit_length())
    room = [size] * (2 * leaves)  # room[1] is the root, the leaves are the sequences
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in order:
        need, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, size - room[node]
        room[node] -= need
        node //= 2
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node //= 2
    return bins, offsets


def pack(pieces: DataFrame, size: int = SIZE, group_size: int = GROUP_SIZE, seed: int = 7) -> DataFrame:
    """``pieces`` (a stored table with ``length`` from 1 to ``size``) plus ``sequence_id`` and ``offset``.

    All other columns are carried along. Sequence ids are unique: even ones are single full pieces, odd ones hold the
    group and the number in the group. Equal rows are separate pieces; an empty table gives an empty one.
    """
    numbered = pieces.withColumn("sequence_id", F.monotonically_increasing_id())
    full = numbered.filter(F.col("length") >= size).withColumn("sequence_id", F.col("sequence_id") * 2).withColumn("offset", F.lit(0).cast("long"))
    rest = numbered.filter(F.col("length") < size)
    groups = max(1, -(-pieces.filter(F.col("length") < size).count() // group_size))
    # by the row's number, not by its key: a key on very many rows is spread like all others
    grouped = rest.withColumn("_group", F.pmod(F.xxhash64("sequence_id", F.lit(seed)), F.lit(groups)))
    schema = T.StructType([*full.schema.fields])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows["_group"].iloc[0])
        rows = rows.sort_values("sequence_id", kind="stable").reset_index(drop=True)
        bins, offsets = first_fit_decreasing(rows["length"].to_numpy(), size)
        out = rows.drop(columns="_group")
        out["sequence_id"] = ((group << 32) + bins) * 2 + 1
        out["offset"] = offsets
        return out

    return full.unionByName(grouped.groupBy("_group").applyInPandas(fit, schema))
