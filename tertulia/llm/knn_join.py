"""The k rows of highest inner product for each query row, exactly: a kNN join over Voronoi cells.

Entries become whole numbers ``floor(scale * entry)``. Let M be at least every vector's length. A row x gets one more
coordinate that makes its length M, a query is stretched to length M and gets 0 there: then |q - x|^2 falls as the inner
product rises, and its nearest rows are its best ones.

Rows and queries go to their nearest of some pivots. Summaries of the cells (how far the queries of a cell lie from the pivot
at most, and how near its nearest k + 1 rows) bound, by the triangle inequality, how far the k-th best row of any query of a
cell can be; rows that lie further from all queries of a cell are not copied to it. Cells are joined to groups of bounded size,
large ones split. Each group meets the rows it needs in slices, each a stream past the group's queries, which keeps the k
best of each; the best of all slices are the result. So a task holds one group of queries and a batch of rows, whatever
the size of a cell. How much can be left out depends on the data: the rows are always right, but far apart vectors in
many dimensions meet nearly all groups.

Shorter vectors are compared as if filled up with zeros.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tertulia.session import stage

SCALE = 256.0
# Pivots: a quarter of the square root of the number of rows, within these limits.
PIVOTS = (16, 1024)
GROUP_BYTES = 64 << 20
SLICE_ROWS = 1 << 17
# Slices of a small table, so that several tasks share it.
SLICES = 16
TILE = (1024, 2048)
EXACT = 2.0**53


def _usable(vector: str, scale: float) -> Column:
    """Not null, and all entries are finite numbers, scaled ones too."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | ~(F.abs(x.cast("double") * scale) < float("inf")))
    return F.col(vector).isNotNull() & ~bad


def _by_length(batch: pa.RecordBatch, scale: float = 1.0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the rows whose vectors (last column) have the same length, and those vectors scaled to whole numbers."""
    lists = batch.column(batch.num_columns - 1)
    flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield at, flat[starts[at][:, None] + np.arange(d)]


class _Space:
    """Pivots and distances in the space where all rows have the length ``top``."""

    def __init__(self, pivots: list[list[float]], top: float) -> None:
        self.top, width = top, max(map(len, pivots), default=0)
        self.pivots = np.array([[*p, *[0.0] * (width - len(p))] for p in pivots]).reshape(len(pivots), width)
        self.last = self._lift(self.pivots)

    def _lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.top**2 - (x * x).sum(1), 0))

    def _apart(self, x: np.ndarray, last: np.ndarray) -> np.ndarray:
        d = min(x.shape[1], self.pivots.shape[1])
        product = x[:, :d] @ self.pivots[:, :d].T + np.outer(last, self.last)
        size = (x * x).sum(1) + last**2
        return np.sqrt(np.maximum(size[:, None] + self.top**2 - 2 * product, 0))

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self._apart(x, self._lift(x))

    def queries(self, x: np.ndarray) -> np.ndarray:
        size = np.sqrt((x * x).sum(1))
        stretched = x * (self.top / np.where(size > 0, size, 1))[:, None]
        return self._apart(stretched, np.zeros(len(x)))

    def between(self) -> np.ndarray:
        return self._apart(self.pivots, self.last)


def _placed(rows: DataFrame, space: _Space, scale: float, key_type: str) -> DataFrame:
    """Each row with its cell and the distance to the pivot, for queries also those of the stretched vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, asks = batch.num_rows, batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            cell, far, q_cell, q_far = np.zeros(n, np.int32), np.zeros(n), np.full(n, -1, np.int32), np.zeros(n)
            whole: list = [None] * n
            for at, x in _by_length(batch, scale):
                apart = np.nan_to_num(space.rows(x), nan=np.inf)
                cell[at], far[at] = apart.argmin(1), apart.min(1)
                mine = asks[at]
                if mine.any():
                    apart = np.nan_to_num(space.queries(x[mine]), nan=np.inf)
                    q_cell[at[mine]], q_far[at[mine]] = apart.argmin(1), apart.min(1)
                for i, vector in zip(at.tolist(), x):
                    whole[i] = vector
            columns = [batch.column(0), batch.column(1), pa.array(cell), pa.array(far), pa.array(q_cell), pa.array(q_far), pa.array(whole, pa.list_(pa.float64()))]
            yield pa.record_batch(columns, names=["row", "key", "cell", "far", "q_cell", "q_far", "vector"])

    return rows.mapInArrow(run, f"row long, key {key_type}, cell int, far double, q_cell int, q_far double, vector array<double>")


def _groups(space: _Space, counts: dict[int, int], most: int) -> dict[int, tuple[int, int]]:
    """For each cell of queries its first group and the number of groups that it is dealt over. Neighbouring cells share one
    group as long as they have ``most`` queries together; a larger cell has several of its own."""
    between, left, at = space.between(), dict(counts), None
    out: dict[int, tuple[int, int]] = {}
    group, held = -1, most
    while left:
        at = min(left, key=lambda j: (between[at, j] if at is not None else 0, j))
        n = left.pop(at)
        if n > most:
            parts = math.ceil(n / most)
            out[at], group, held = (group + 1, parts), group + parts, most
            continue
        if held + n > most:
            group, held = group + 1, 0
        out[at], held = (group, 1), held + n
    return out


def _needs(space: _Space, placed: DataFrame, groups: dict[int, tuple[int, int]], reach: dict[int, float], k: int) -> list[tuple]:
    """``(cell, group, parts, low, high)``: groups that need the rows of a cell between two distances from its pivot."""
    near = Window.partitionBy("cell").orderBy("far")
    best = placed.select("cell", "far").withColumn("_rank", F.row_number().over(near)).filter(F.col("_rank") <= k + 1)
    ends = {r.cell: (r.low, r.high) for r in placed.groupBy("cell").agg(F.min("far").alias("low"), F.max("far").alias("high")).collect()}
    known = [(r.cell, r.far) for r in best.collect()]
    of, far = np.array([c for c, _ in known], int), np.array([f for _, f in known])
    between, slack = space.between(), 1e-6 * (space.top + 1)
    out: dict[tuple[int, int, int], tuple[float, float]] = {}
    for i, (group, parts) in groups.items():
        bound = reach[i] + between[i, of] + far
        # one of the k + 1 nearest may be the query's own row
        limit = np.sort(bound)[k] if len(bound) > k else np.inf
        for j, (first, last) in ends.items():
            low, high = between[i, j] - reach[i] - limit - slack, between[i, j] + reach[i] + limit + slack
            low, high = (low if np.isfinite(low) else -np.inf), (high if np.isfinite(high) else np.inf)
            if not (low > last or high < first):
                old = out.get((j, group, parts), (np.inf, -np.inf))
                out[j, group, parts] = min(float(low), old[0]), max(float(high), old[1])
    return [(*where, *span) for where, span in out.items()]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: as doubles where they fit, as Python integers where they do not."""
    bound = math.sqrt((a * a).sum(1).max(initial=0)) * math.sqrt((b * b).sum(1).max(initial=0))
    if bound < EXACT:
        return a @ b.T
    whole = np.frompyfunc(int, 1, 1)
    return whole(a) @ whole(b).T


def _first(score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """In each row the places of the k best scores, best first; of equal ones the earlier in ``order``."""
    if score.dtype == object:
        return np.array([sorted(range(len(s)), key=lambda j: (-s[j], o[j]))[:k] for s, o in zip(score, order)])
    return np.lexsort((order, -score), axis=-1)[:, :k]


class _Best:
    """Queries of one length, and of each the best rows so far: scores, order of the rows, keys."""

    def __init__(self, row: np.ndarray, key: list, x: np.ndarray, k: int) -> None:
        self.row, self.key, self.x, self.k = row, key, x, k
        self.score, self.order = np.full((len(row), k), -np.inf), np.full((len(row), k), np.iinfo(np.int64).max)
        self.name = np.full((len(row), k), None, object)
        self._sorted = np.argsort(row)

    def meet(self, x: np.ndarray, row: np.ndarray, key: np.ndarray, order: np.ndarray) -> None:
        at = np.minimum(np.searchsorted(self.row, row, sorter=self._sorted), len(self.row) - 1)
        own = self._sorted[at]
        column = np.flatnonzero(self.row[own] == row)
        own = own[column]
        d = min(x.shape[1], self.x.shape[1])
        for low in range(0, len(self.row), TILE[0]):
            some = np.arange(low, min(low + TILE[0], len(self.row)))
            score = _products(self.x[some, :d], x[:, :d])
            if score.dtype == object:
                self.score = self.score.astype(object)
            inside = (own >= low) & (own < low + TILE[0])
            score[own[inside] - low, column[inside]] = -np.inf
            better = np.flatnonzero(score.max(1) >= self.score[some, -1])
            if len(better):
                self._merge(some[better], score[better], key, order)

    def _merge(self, some: np.ndarray, score: np.ndarray, key: np.ndarray, order: np.ndarray) -> None:
        n, m = score.shape
        if m > self.k and score.dtype != object and np.abs(score, where=np.isfinite(score), out=np.zeros_like(score)).max() * m < EXACT:
            # score and order in one number, so that ties are told apart
            pick = np.argpartition(np.arange(m) - score * m, self.k - 1, axis=1)[:, : self.k]
        else:
            pick = _first(score, np.broadcast_to(order, (n, m)), self.k)
        score = np.concatenate([self.score[some], np.take_along_axis(score, pick, 1)], axis=1)
        order = np.concatenate([self.order[some], order[pick]], axis=1)
        name = np.concatenate([self.name[some], key[pick]], axis=1)
        top = _first(score, order, self.k)
        self.score[some], self.order[some], self.name[some] = (np.take_along_axis(v, top, 1) for v in (score, order, name))


class _Held:
    """The queries of one group beside one slice of rows."""

    def __init__(self, place: tuple[int, int], k: int) -> None:
        self.place, self.k, self._seen = place, k, 0
        self._parts: list[pa.RecordBatch] = []
        self._best: list[_Best] | None = None

    def add(self, batch: pa.RecordBatch) -> None:
        self._parts.append(batch)

    def meet(self, batch: pa.RecordBatch) -> None:
        if self._best is None:
            table: dict[int, list] = {}
            for part in self._parts:
                row, key = part.column(3).to_numpy(), part.column(4).to_pylist()
                for at, x in _by_length(part):
                    table.setdefault(x.shape[1], []).append((row[at], [key[i] for i in at], x))
            self._parts = []
            self._best = [_Best(np.concatenate([r for r, _, _ in f]), [k for _, ks, _ in f for k in ks], np.concatenate([x for _, _, x in f]), self.k) for f in table.values()]
        row = batch.column(3).to_numpy()
        key = np.empty(len(row), object)
        key[:] = batch.column(4).to_pylist()
        for at, x in _by_length(batch):
            for low in range(0, len(at), TILE[1]):
                here = at[low : low + TILE[1]]
                for best in self._best:
                    best.meet(x[low : low + TILE[1]], row[here], key[here], self._seen + here)
        self._seen += batch.num_rows

    def results(self) -> Iterator[tuple]:
        for best in self._best or []:
            for row, key, scores, names in zip(best.row.tolist(), best.key, best.score.tolist(), best.name.tolist()):
                for score, name in zip(scores, names):
                    if score != -math.inf:
                        yield row, key, name, max(-(2**63), min(2**63 - 1, int(score)))


def _search(batches: Iterator[pa.RecordBatch], k: int, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows ordered by group, slice, queries before data, key: the k best of each query within the slice."""
    names, kinds = ["q_row", "q_key", "key", "score"], [pa.int64(), key_type, key_type, pa.int64()]

    def out(held: _Held) -> Iterator[pa.RecordBatch]:
        rows = list(held.results())
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    held: _Held | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        group, part, data = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
        cuts = np.flatnonzero(np.diff(group) | np.diff(part) | np.diff(data)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            place = (int(group[low]), int(part[low]))
            if held is None or held.place != place:
                if held is not None:
                    yield from out(held)
                held = _Held(place, k)
            (held.meet if data[low] else held.add)(batch.slice(low, high - low))
    if held is not None:
        yield from out(held)


def top_k(df: DataFrame, asks: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row for which ``asks`` is true, the k other rows of highest inner product
    of the scaled vectors, ties to the smaller key, null keys last; all of them where there are fewer.

    Vectors that are null or hold null, NaN or infinite entries take no part, nor do those that are infinite when scaled.
    A row is not its own result, but rows that repeat its id or vector are rows like others, and a repeated id asks once for
    each of its rows. Vectors of another length count as filled up with zeros, an empty one has a score of 0 with all. Scores
    beyond a long are cut to its range. Other columns are ignored.
    """
    spark = df.sparkSession
    key_type = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.coalesce(asks, F.lit(False)).alias("asks"), F.col(vector).alias("vector"))
    rows = rows.filter(_usable("vector", scale))
    result = f"q_row long, q_key {key_type}, key {key_type}, score long"
    size = F.aggregate("vector", F.lit(0.0), lambda total, x: total + F.pow(F.abs(x.cast("double") * scale) + 1, F.lit(2.0)))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asking"), F.max(size).alias("top"), F.max(F.size("vector")).alias("width")).first()
    if not facts.asking:
        return _named(spark.createDataFrame([], result), k)
    number = min(max(int(math.sqrt(facts.n) / 4), PIVOTS[0]), PIVOTS[1])
    chosen = rows.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(number).collect()
    space = _Space([np.floor(np.array(r.vector, float) * scale).tolist() for r in chosen], math.sqrt(facts.top))
    placed = stage(_placed(rows.select(F.monotonically_increasing_id().alias("row"), "key", "asks", "vector"), space, scale, key_type), "placed")

    asking = placed.filter("q_cell >= 0")
    cells = asking.groupBy("q_cell").agg(F.count(F.lit(1)).alias("n"), F.max("q_far").alias("reach")).collect()
    groups = _groups(space, {r.q_cell: r.n for r in cells}, max(1, GROUP_BYTES // (8 * max(1, facts.width))))
    needs = _needs(space, placed, groups, {r.q_cell: r.reach for r in cells}, k)
    # at most one row per pair of pivots
    needs = F.broadcast(spark.createDataFrame(needs, "cell int, group int, parts int, low double, high double"))
    homes = F.broadcast(spark.createDataFrame([(c, g, p) for c, (g, p) in groups.items()], "q_cell int, group int, parts int"))
    slices = max(SLICES, math.ceil(facts.n / SLICE_ROWS))

    columns = ["group", "slice", "data", "row", "key", "vector"]
    copies = placed.join(needs, "cell").filter("far >= low AND far <= high")
    copies = copies.withColumn("group", F.explode(F.sequence(F.col("group"), F.col("group") + F.col("parts") - 1)))
    copies = copies.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int")).withColumn("data", F.lit(True))
    held = asking.join(homes, "q_cell").withColumn("group", F.col("group") + F.pmod(F.xxhash64("row", F.lit(7)), F.col("parts")).cast("int"))
    held = held.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).withColumn("data", F.lit(False))
    both = held.select(columns).unionByName(copies.select(columns)).repartition("group", "slice")
    both = both.sortWithinPartitions("group", "slice", "data", F.asc_nulls_last("key"), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _search(batches, k, arrow)

    arrow = _arrow_type(df, key)
    return _named(both.mapInArrow(run, result), k)


def _arrow_type(df: DataFrame, key: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[key].dataType)


def _named(found: DataFrame, k: int) -> DataFrame:
    """The best of all slices."""
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("q_key").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score")
