"""Quality rules whose cutoffs come with a guarantee.

A rule rejects a document when a ratio of its base statistics passes a cutoff. Cutoffs are not set by hand, and those of a
stratum (a language) may be used only if the share of good documents that they reject there, all rules together, is proven
to be at most ``risk``. Labelled documents are divided by a hash of their ids. On a third of them cutoffs are looked for:
one step after the other is taken that adds rejected bad documents, less ``caution`` times the good ones, those first that
cost least. So each combination of cutoffs rejects what the one before rejects and more. The other documents, on which
nothing was fitted, prove them in this order: the exact binomial (Clopper-Pearson) upper bound of the good documents that
any rule rejects must be at most ``risk``. The first combination that fails ends the search, and the last proven one is
used. An order that is fixed before needs no correction for the number of combinations, so with ``S`` strata the bounds are
taken at an error of ``error / S`` each: with probability ``1 - error`` all strata keep their promise at once. Where nothing
is proven or helps, the rules are off. The base check is no rule and not part of the promise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tertulia.llm.near_duplicates import window_hashes, word_hashes
from tertulia.llm.tables import map_rows
from tertulia.session import lookup_join, stage

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEATED = 20  # per cent of the words
REPEAT_WINDOW = 5


@dataclass(frozen=True)
class Settings:
    """``risk`` bounds the share of good documents that all rules together may reject in a stratum."""

    risk: float = 0.02
    error: float = 0.05
    caution: float = 5.0


# The ratio of each rule and its cutoffs, laxest first; a document above the cutoff is rejected.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / greatest(n_words, 1)", (1.0, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02)),
    "duplicate_lines": ("n_dup_lines / greatest(n_lines, 1)", (0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", (0.18, 0.15, 0.12, 0.1, 0.08)),
    "long_words": ("word_chars / greatest(n_words, 1)", (12.0, 10.0, 9.0, 8.0, 7.5, 7.0, 6.5, 6.0)),
    "short_words": ("-word_chars / greatest(n_words, 1)", (-2.0, -2.5, -3.0, -3.5, -4.0)),
}


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """``(key, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words)`` per row; null texts have no words.

    ``n_lines`` counts lines with a word. A null stratum is one of its own.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, part, body in rows:
            words = word_hashes(body, fold=False)
            chars = len(body) - sum(body.count(c) for c in SPACES)
            symbols = sum(body.count(c) for c in SYMBOLS)
            lines = [line for line in body.split("\n") if line.strip(SPACES)]
            windows = window_hashes(words, REPEAT_WINDOW)
            repeated = 0
            if len(windows):
                _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
                edge = np.zeros(len(words) + 1, np.int64)
                often = np.flatnonzero(counts[inverse] > 1)
                np.add.at(edge, often, 1)
                np.add.at(edge, often + REPEAT_WINDOW, -1)
                repeated = int((np.cumsum(edge) > 0).sum())
            yield doc, part, len(words), chars, symbols, len(lines) - len(set(lines)), len(lines), repeated

    rows = docs.select(F.col(key), F.coalesce(F.col(stratum).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    columns = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long"
    return map_rows(rows, run, f"id {kind}, stratum string, {columns}")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)


def upper_bound(rejected: int, n: int, error: float) -> float:
    """The largest rate at which ``rejected`` or fewer of ``n`` still have a probability of ``error``."""
    if n == 0 or rejected >= n:
        return 1.0
    k = np.arange(rejected + 1)
    choose = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in k])

    def below(p: float) -> float:
        logs = choose + k * math.log(p) + (n - k) * math.log1p(-p)
        top = logs.max()
        return top + math.log(np.exp(logs - top).sum())

    low, high = rejected / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        if middle in (0.0, 1.0) or below(middle) > math.log(error):
            low = middle
        else:
            high = middle
    return high


def cutoffs(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", settings: Settings = Settings()) -> DataFrame:
    """``(stratum, <rule>...)``: the chosen cutoff of each rule, null where it is off.

    Labelled documents that fail the base check say nothing about the rules and are left out. Rows that repeat an id count
    once per row; of contradicting labels the better one counts; null ids and labels are left out.
    """
    truth = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(label).alias("good"))
    held = stats.filter(~base_failed()).join(truth, "id")
    # how many of its cutoffs a document passes says all of a rule: these are the strictest ones
    passed = [sum((F.expr(ratio) > step).cast("int") for step in steps).alias(rule) for rule, (ratio, steps) in RULES.items()]
    proof = (F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(3)) != 0).alias("proof")
    alike = held.select("stratum", proof, *passed, (F.col("good") == 1).alias("is_good")).groupBy("stratum", "proof", *RULES)
    table = stage(alike.agg(F.count_if("is_good").alias("good"), F.count_if(~F.col("is_good")).alias("bad")), "rule-counts")
    error = settings.error / max(1, table.select("stratum").distinct().count())
    schema = T.StructType([T.StructField("stratum", T.StringType()), *(T.StructField(rule, T.DoubleType()) for rule in RULES)])

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        found = _proven(rows, settings, error)
        out = {"stratum": rows["stratum"].iloc[0]} | {r: RULES[r][1][i] if i >= 0 else None for r, i in found.items()}
        return pd.DataFrame([out], columns=schema.fieldNames()).astype({r: "float64" for r in RULES})

    return table.groupBy("stratum").applyInPandas(choose, schema)


def _proven(rows: pd.DataFrame, settings: Settings, error: float) -> dict[str, int]:
    """The number of the cutoff of each rule in one stratum, -1 where it is off."""
    good, bad, proof = rows["good"].to_numpy(), rows["bad"].to_numpy(), rows["proof"].to_numpy(bool)
    passed = {rule: rows[rule].to_numpy() for rule in RULES}
    n_good, n_bad, n_proof = max(1, good[~proof].sum()), max(1, bad[~proof].sum()), int(good[proof].sum())
    used, gone = {rule: -1 for rule in RULES}, np.zeros(len(rows), bool)
    while True:
        best = None
        for rule, (_, steps) in RULES.items():
            for i in range(used[rule] + 1, len(steps)):
                more = gone | (passed[rule] >= len(steps) - i)
                cost = good[more & ~gone & ~proof].sum()
                gain = bad[more & ~gone & ~proof].sum() / n_bad - settings.caution * cost / n_good
                if gain > 0 and (best is None or gain / (cost + 1) > best[0]):
                    best = (gain / (cost + 1), rule, i, more)
        if best is None or upper_bound(int(good[best[3] & proof].sum()), n_proof, error) > settings.risk:
            return used
        _, rule, i, gone = best
        used = used | {rule: i}


def assess(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", label: str = "quality",
    settings: Settings = Settings(),
) -> DataFrame:
    """Statistics per row of ``docs`` plus ``base_failed``, ``rejected_by`` (names of rules) and ``kept``.

    Other columns of ``docs`` are ignored. A stratum without labels has all its rules off.
    """
    stats = stage(statistics(docs, key, text, stratum), "statistics")
    chosen = cutoffs(stats, labels, key, label, settings)
    ruled = lookup_join(stats, chosen, ["stratum"], "left", salt_by="id")
    # a rule that is off may come as null or not a number
    fails = [F.when(F.expr(ratio) > F.nanvl(F.col(rule), F.lit(math.inf)), F.lit(rule)) for rule, (ratio, _) in RULES.items()]
    ruled = ruled.withColumn("rejected_by", F.array_compact(F.array(*fails))).withColumn("base_failed", base_failed())
    ruled = ruled.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
    return ruled.drop(*RULES).withColumnRenamed("id", key)
