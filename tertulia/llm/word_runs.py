"""Runs of repeating words: every stretch of period q that is at least ``max(SHORTEST, POWER * q)`` words long.

Grammar-compressed detection. The word ids of the texts of a batch are compressed by Re-Pair: adjacent symbols that occur
most often together become a new symbol, again and again, until no pair occurs twice; what is left is paired up evenly. Each
run lies across the middle of one symbol of the parse at least, and in full within the smallest such symbol. So the periods
that cross a symbol's middle are worked out once for each symbol (on one of its occurrences), carried over to all places
where the symbol is derived, and pieces of one run are joined to its maximal interval. Common extensions of two places are
exact: they compare names of stretches of doubling length.

Words that cannot lie in a run are left out first: each three words of a run occur three times or more inside of it.

A batch holds about ``BATCH_WORDS`` words; a longer text is a batch of its own, and one task holds it with some hundred bytes
per word, mostly in the parts that may repeat. Rows meet no other rows, so a table of very many copies costs what its rows cost.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.llm.tables import map_rows

SHORTEST = 6
POWER = 4
BATCH_WORDS = 1_000_000
# Pairs of a symbol and a period that are looked at together.
PAIRS = 2_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)

Rewrite = Callable[[Any, list[bytes]], list[bytes]]


def _ids(values: np.ndarray) -> np.ndarray:
    return pd.factorize(values)[0].astype(np.int64)


def _ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each list of these sizes the number of the list and the place in it, one after the other."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _stretches(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts that may hold runs: each three words in a row occur three times in the same part.

    A run of ``max(6, 4 q)`` words has 4 q - 2 places of three words at least (four if q is 1), hence three of each kind.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(codes) < SHORTEST:
        return none
    pairs = _ids(codes[:-1] * (int(codes.max()) + 1) + codes[1:])
    triples = _ids(pairs[:-1] * (int(codes.max()) + 1) + codes[2:])
    kinds = int(triples.max()) + 1
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(text[:-2] == text[2:])
    part = text[at]
    while len(at):
        kind = _ids(part * kinds + triples[at])
        often = np.bincount(kind)[kind] >= 3
        whole = bool(often.all())
        at, part = at[often], part[often]
        if not len(at):
            break
        part = np.cumsum(np.concatenate(([0], (np.diff(at) != 1) | (np.diff(part) != 0))))
        long = np.bincount(part)[part] >= SHORTEST - 2
        if whole and long.all():
            first = np.flatnonzero(np.concatenate(([True], np.diff(part) != 0)))
            last = np.concatenate((first[1:], [len(at)])) - 1
            return at[first], at[last] + 3
        at, part = at[long], part[long]
    return none


class _Parse:
    """Re-Pair over symbols of several texts: one occurrence ``(start, middle, end)`` of each new symbol, and all starts."""

    def __init__(self, text: np.ndarray, part: np.ndarray) -> None:
        self._symbol, self._part = _ids(text), part
        self._start, self._length = np.arange(len(text)), np.ones(len(text), np.int64)
        self._next, self._rules = int(self._symbol.max()) + 1, 0
        spans: list[np.ndarray] = []
        found: list[np.ndarray] = []
        while (chosen := self._choose()) is not None:
            at, rule = chosen
            start, middle = self._start[at], self._start[at + 1]
            end = middle + self._length[at + 1]
            _, first = np.unique(rule, return_index=True)
            spans.append(np.stack([start, middle, end])[:, first])
            found.append(np.stack([rule + self._rules, start]))
            self._replace(at, rule)
        shape = np.zeros((3, 0), np.int64)
        self.start, self.middle, self.end = np.concatenate([shape, *spans], axis=1)
        self.rule, self.place = np.concatenate([shape[:2], *found], axis=1)

    def _choose(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Places of pairs that become symbols now, and which ones; pairs that would overlap leave it to the better one."""
        beside = self._part[:-1] == self._part[1:]
        if not beside.any():
            return None
        pair = _ids(self._symbol[:-1] * self._next + self._symbol[1:])
        count = np.bincount(pair[beside], minlength=int(pair.max()) + 1)
        good = beside & (count[pair] >= 2)
        if not good.any():
            # no pair occurs twice: neighbours in even places
            first = np.concatenate(([True], ~beside))
            at = np.arange(len(self._part))
            even = (at - at[first][np.cumsum(first) - 1]) % 2 == 0
            at = np.flatnonzero(beside & even[:-1])
            return at, np.arange(len(at))
        # most frequent pair first, then the shorter expansion, then by chance, so that equal pairs do not form chains
        _, one = np.unique(pair, return_index=True)
        size = (self._length[:-1] + self._length[1:])[one]
        chance = (np.arange(len(one), dtype=np.uint64) + np.uint64(self._rules + 1)) * _ODD
        rank = np.empty(len(one), np.int64)
        rank[np.lexsort((chance ^ (chance >> np.uint64(29)), size, -count))] = np.arange(len(one))
        rank = np.where(good, rank[pair], len(one))
        # the same pair in neighbouring places (a word said again and again): every second of them
        fresh = np.concatenate(([True], rank[1:] != rank[:-1]))
        block = np.cumsum(fresh) - 1
        heads = np.flatnonzero(fresh)
        of_block = rank[heads]
        before = np.concatenate(([len(one)], of_block[:-1]))
        after = np.concatenate((of_block[1:], [len(one)]))
        best = (of_block < before) & (of_block < after)
        at = np.flatnonzero(good & best[block] & ((np.arange(len(rank)) - heads[block]) % 2 == 0))
        return at, _ids(pair[at])

    def _replace(self, at: np.ndarray, rule: np.ndarray) -> None:
        self._symbol[at] = self._next + rule
        self._length[at] += self._length[at + 1]
        kept = np.ones(len(self._symbol), bool)
        kept[at + 1] = False
        self._symbol, self._part, self._start, self._length = self._symbol[kept], self._part[kept], self._start[kept], self._length[kept]
        new = int(rule.max()) + 1
        self._next, self._rules = self._next + new, self._rules + new


class _Extensions:
    """How far the text agrees from two places on, forwards and backwards; stretches of 2^j words have names."""

    def __init__(self, text: np.ndarray, longest: int) -> None:
        self._names = [_ids(text).astype(np.int32)]
        while 2 ** len(self._names) <= longest:
            half, width = self._names[-1].astype(np.int64), 2 ** (len(self._names) - 1)
            self._names.append(_ids(half[:-width] * (int(half.max()) + 1) + half[width:]).astype(np.int32))

    def forward(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
        done = np.zeros(len(x), np.int64)
        for j in range(len(self._names) - 1, -1, -1):
            can = np.flatnonzero(done + 2**j <= limit)
            same = self._names[j][(x + done)[can]] == self._names[j][(y + done)[can]]
            done[can[same]] += 2**j
        return done

    def backward(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Agreement of the words before ``x`` with those before ``y``."""
        done = np.zeros(len(x), np.int64)
        for j in range(len(self._names) - 1, -1, -1):
            can = np.flatnonzero(done + 2**j <= limit)
            same = self._names[j][(x - done)[can] - 2**j] == self._names[j][(y - done)[can] - 2**j]
            done[can[same]] += 2**j
        return done


def _crossing(text: np.ndarray, parse: _Parse) -> np.ndarray:
    """Rows ``(rule, start, end, period)``: runs across the middle of each symbol, within its one occurrence.

    A run of four periods has two of them on one side of the middle, so the words at the middle agree with those one period
    to that side.
    """
    rule = np.flatnonzero(parse.end - parse.start >= SHORTEST)
    most = (parse.end - parse.start)[rule] // POWER
    if not len(rule):
        return np.zeros((4, 0), np.int64)
    compare = _Extensions(text, int((parse.end - parse.start).max()))
    found = []
    group = (np.cumsum(most) - most) // PAIRS
    for low in np.split(np.arange(len(rule)), np.flatnonzero(np.diff(group)) + 1):
        owner, q = _ragged(most[low])
        node, q = rule[low][owner], q + 1
        s, b, e = parse.start[node], parse.middle[node], parse.end[node]
        for side in (0, 1):
            # the place that the middle is compared with: x = b, y = b + q, or one period earlier
            x = b - side * q
            inside = np.flatnonzero((x > s) & (x + q < e))
            hit = inside[(text[x[inside]] == text[(x + q)[inside]]) & (text[x[inside] - 1] == text[(x + q)[inside] - 1])]
            left, right = x[hit], (x + q)[hit]
            end = right + compare.forward(left, right, e[hit] - right)
            start = left - compare.backward(left, right, left - s[hit])
            long = end - start >= np.maximum(SHORTEST, POWER * q[hit])
            found.append(np.stack([node[hit], start, end, q[hit]])[:, long])
    rows = np.concatenate(found, axis=1)
    # the same interval with a multiple of its period
    rows = rows[:, np.lexsort((rows[3], rows[2], rows[1], rows[0]))]
    return rows[:, np.concatenate(([True], (np.diff(rows[:3], axis=1) != 0).any(0)))] if rows.shape[1] else rows


def find_runs(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows ``(text, start, length, period)`` in order for texts of word ids ``codes[bounds[i]:bounds[i + 1]]``."""
    starts, ends = _stretches(codes, bounds)
    if not len(starts):
        return np.zeros((4, 0), np.int64)
    part, place = _ragged(ends - starts)
    origin = starts[part] + place
    text = codes[origin]
    parse = _Parse(text, part)
    node, start, end, period = _crossing(text, parse)
    # every place where the symbol is derived
    order = np.argsort(parse.rule, kind="stable")
    uses = np.bincount(parse.rule, minlength=len(parse.start))
    run, at = _ragged(uses[node])
    moved = parse.place[order[(np.cumsum(uses) - uses)[node][run] + at]] - parse.start[node][run]
    pieces = np.unique(np.stack([period[run], start[run] + moved, end[run] + moved]), axis=1)
    if not pieces.shape[1]:
        return np.zeros((4, 0), np.int64)
    # pieces of one run overlap by a period or more
    q, start, end = pieces
    shift = _ids(q) * (len(text) + 1)
    reach = np.maximum.accumulate(end + shift)
    fresh = np.flatnonzero(np.concatenate(([True], (start + shift)[1:] > reach[:-1] - q[1:])))
    last = np.concatenate((fresh[1:], [len(q)])) - 1
    begin, length = origin[start[fresh]], (reach - shift)[last] - start[fresh]
    doc = np.searchsorted(bounds, begin, side="right") - 1
    rows = np.stack([doc, begin - bounds[doc], length, q[fresh]])
    return rows[:, np.lexsort((rows[3], rows[1], rows[0]))]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(kept))


def word_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """``(key, runs, collapsed)`` per row: all runs (``start``, ``length``, ``period`` in words) by start and period, and the
    words joined by one space without those that a run repeats.

    Words are separated by ASCII white space. ``rewrite(key, words)`` may change the words of a row first. Null, empty and
    blank texts have no runs and an empty ``collapsed``. Rows are independent: those that repeat an id or a text, or have no
    id, are rows of their own. Other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()

    def batches(rows: Iterator[tuple]) -> Iterator[list[tuple[Any, list[bytes]]]]:
        held, size = [], 0
        for name, data in rows:
            words = (data or b"").split()
            held.append((name, rewrite(name, words) if rewrite else words))
            size += len(words)
            if size >= BATCH_WORDS:
                yield held
                held, size = [], 0
        yield held

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for held in batches(rows):
            ids: defaultdict[bytes, int] = defaultdict()
            ids.default_factory = ids.__len__
            codes = [np.fromiter(map(ids.__getitem__, words), np.int64, len(words)) for _, words in held]
            bounds = np.cumsum([0, *map(len, codes)])
            of_doc: defaultdict[int, list[tuple[int, int, int]]] = defaultdict(list)
            for doc, *found in find_runs(np.concatenate([*codes, np.zeros(0, np.int64)]), bounds).T.tolist():
                of_doc[doc].append(tuple(found))
            for i, (name, words) in enumerate(held):
                runs = of_doc.get(i, [])
                yield name, [dict(zip(("start", "length", "period"), r)) for r in runs], _collapsed(words, runs).decode("utf-8", "replace")

    rows = docs.select(F.col(key).alias("doc"), F.col(text).cast("binary").alias("text"))
    found = map_rows(rows, run, f"doc {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.withColumnRenamed("doc", key)
