"""Expressions over token arrays. All are linear in the number of tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def adjacent(tokens: Column) -> Column:
    """Array of structs ``(a, b)``: each token with the one after it."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(tokens, F.lit(1), pairs).alias("a"),
        F.slice(tokens, F.lit(2), pairs).alias("b"),
    )


def without_words(tokens: Column, words: list[str]) -> Column:
    """Drop the given words, keep order and duplicates. The list becomes a hash set in the plan."""
    return F.filter(tokens, lambda t: ~t.isin(words)) if words else tokens


def merge_at(tokens: Column, starts: Column) -> Column:
    """Join token ``s`` and ``s + 1`` with ``_`` for each 0-based ``s`` in the ascending array ``starts``.

    Starts lie at least two apart. The result is built from the stretches between merges.
    """

    def piece(s: Column, i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.get(starts, i - 1) + 2)
        merged = F.concat(F.get(tokens, s), F.lit("_"), F.get(tokens, s + 1))
        return F.concat(F.slice(tokens, begin + 1, s - begin), F.array(merged))

    tail = F.coalesce(F.try_element_at(starts, F.lit(-1)) + 2, F.lit(0))
    rest = F.slice(tokens, tail + 1, F.size(tokens) - tail)
    return F.concat(F.flatten(F.transform(starts, piece)), rest)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it, also inside of lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def greedy_starts(tokens: Column, is_pair: Callable[[Column, Column], Column]) -> Column:
    """0-based places where pairs are merged from left to right, without overlap, ascending.

    The scan's state only matters inside a run of consecutive matching places: there it takes the 1st, 3rd, 5th ... place.
    So the runs' ends say all, and no state is carried from token to token.
    """
    places = F.when(F.size(tokens) > 1, F.sequence(F.lit(0), F.size(tokens) - 2)).otherwise(F.array().cast("array<int>"))
    hits = F.filter(places, lambda i: is_pair(F.get(tokens, i), F.get(tokens, i + 1)))

    def runs(found: Column) -> Column:
        first = F.filter(found, lambda p, j: (j == 0) | (F.get(found, j - 1) < p - 1))
        last = F.filter(found, lambda p, j: F.coalesce(F.get(found, j + 1) > p + 1, F.lit(True)))
        return F.flatten(F.zip_with(first, last, lambda s, e: F.sequence(s, e, F.lit(2))))

    return bind(hits, runs)


def merge_pairs(tokens: Column, is_pair: Callable[[Column, Column], Column]) -> Column:
    """Token list with matching neighbours joined by ``_``, greedily from the left; lists without a match stay as they are."""

    def merged(words: Column) -> Column:
        return bind(greedy_starts(words, is_pair), lambda starts: F.when(F.size(starts) > 0, merge_at(words, starts)).otherwise(words))

    return bind(tokens, merged)
