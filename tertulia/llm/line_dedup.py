"""Removal of lines that many documents share, with levelled sorted runs of line hashes.

A run is a stored table ``(h1, h2, n_docs, last)``, bucketed and sorted by the 128-bit hash of a line's key: in how many
documents the key was found and the largest id among them. A batch of documents is merge-anti-joined with the runs: a key
that some run has in enough documents, with an id as large, is settled and tells nothing new. What is left becomes a run
at level 0, so a line that stands in every document is not stored again and again. Two runs of one level are merged into
one run of the next: a corpus of B batches is held in O(log B) runs and each hash is rewritten O(log B) times. All runs
have the same buckets, so both are sort-merge joins of stored buckets and shuffle no run.

Lines are dropped in a second pass, when the counts are complete: the lines of each document are joined with the keys of
the merged runs that are common enough, and leave unless the document is the last holder of the key.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tertulia.llm.tables import box, delete_folder, map_rows, unbox
from tertulia.session import lookup_join, new_folder, stage

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 6  # at least; more where these would hold over ``BATCH_DOCS`` documents each
BATCH_DOCS = 100_000_000
SPACE = b" \t\n\x0b\x0c\r"


class LineRuns:
    """The runs of one corpus. ``add`` takes a batch, ``common`` gives the keys of at least ``min_docs`` documents.

    Counts are exact below ``min_docs`` and at least ``min_docs`` above; ``last`` is exact.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS):
        self.spark, self.min_docs = spark, min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def runs(self) -> list[tuple[str, str]]:
        return [run for level in self.levels for run in level]

    def _write(self, keys: DataFrame) -> tuple[str, str]:
        """``keys`` are partitioned by hash already, so a task writes whole buckets."""
        name, path = f"line_run_{uuid.uuid4().hex}", new_folder(self.spark, "line-run")
        keys.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", path).saveAsTable(name)
        return name, path

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE {name}")
            delete_folder(self.spark, path)

    def _merge(self, one: tuple[str, str], other: tuple[str, str]) -> DataFrame:
        a, b = self.spark.table(one[0]).alias("a"), self.spark.table(other[0]).alias("b").hint("merge")
        same = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2"))
        return a.join(b, same, "full_outer").select(
            F.coalesce("a.h1", "b.h1").alias("h1"),
            F.coalesce("a.h2", "b.h2").alias("h2"),
            (F.coalesce("a.n_docs", F.lit(0)) + F.coalesce("b.n_docs", F.lit(0))).alias("n_docs"),
            F.greatest("a.last", "b.last").alias("last"),
        )

    def add(self, lines: DataFrame) -> None:
        """``lines``: ``(h1, h2, doc)``, a key once per document."""
        new = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("last"))
        for name, _ in self.runs():
            a, b = new.alias("a"), self.spark.table(name).filter(F.col("n_docs") >= self.min_docs).alias("b").hint("merge")
            same = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2"))
            # a null id is smaller than all others
            new = a.join(b, same & (F.col("a.last").isNull() | F.coalesce(F.col("a.last") <= F.col("b.last"), F.lit(False))), "left_anti")
        self._put(0, self._write(new))

    def _put(self, level: int, run: tuple[str, str]) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == 2:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._write(self._merge(*full)))
            self._drop(full)

    def common(self) -> DataFrame:
        """``(h1, h2, last)``, stored."""
        # read as plain files: above a union, scans lose their buckets while the plan still counts on them
        runs = [self.spark.read.schema(self.spark.table(name).schema).parquet(path) for name, path in self.runs()]
        found = reduce(DataFrame.unionAll, runs).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("last").alias("last"))
        return stage(found.filter(F.col("n_docs") >= self.min_docs).select("h1", "h2", "last"), "common-lines")

    def close(self) -> None:
        """Drop all runs."""
        self._drop(self.runs())
        self.levels = []


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row per document and distinct long key: its hash and the numbers of its lines."""
    kind = docs.schema["doc"].dataType.simpleString()

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, digest, batch, text in rows:
            found: dict[bytes, list[int]] = {}
            for no, line in enumerate(text.encode().lower().split(b"\n")):  # bytes.lower() changes A-Z only
                line = line.strip(SPACE)
                if len(line) >= min_chars and len(line.decode()) >= min_chars:
                    found.setdefault(line, []).append(no)
            for line, at in found.items():
                h = hashlib.blake2b(line, digest_size=16).digest()
                yield doc, digest, batch, int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True), at

    return map_rows(docs, run, f"doc {kind}, digest long, batch int, h1 long, h2 long, at array<int>")


def drop_common_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int | None = None,
    max_broadcast: int = 200_000,
) -> DataFrame:
    """All columns of ``docs`` with the text rewritten, plus ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without white space at its ends and with A-Z lower-cased. A key of at least ``min_chars`` code
    points found in at least ``min_docs`` documents loses all its lines except those in the document of the largest id.
    Null and empty texts are one empty line and stay as they are (a null text stays null). Rows that repeat an id count as
    documents of their own; when the largest id repeats, all its rows keep the line. Rows without an id count too and come
    before all ids. The result does not depend on ``batches``.
    """
    spark = docs.sparkSession
    batches = batches or max(BATCHES, -(-docs.count() // BATCH_DOCS))
    named = box(docs, id=docs[key], digest=F.xxhash64(docs[text]), text=docs[text])
    batch = F.pmod(F.xxhash64("id", "digest"), F.lit(batches)).cast("int")
    source = named.select(F.col("id").alias("doc"), "digest", batch.alias("batch"), "text")
    lines = _lines(source.filter(F.length("text") >= min_chars), min_chars)
    path = new_folder(spark, "lines")
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    runs = LineRuns(spark, min_docs)
    for number in range(batches):
        runs.add(lines.filter(F.col("batch") == number).select("h1", "h2", "doc"))
    common = runs.common()
    runs.close()
    found = lookup_join(lines.drop("batch"), common, ["h1", "h2"], "inner", salt_by="digest", max_rows=max_broadcast)
    losing = found.filter(~F.col("doc").eqNullSafe(F.col("last")))
    # rows of the same id and text have the same lines, so they share one list of numbers
    drops = losing.groupBy(F.col("doc").alias("_doc"), F.col("digest").alias("_d")).agg(
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("_drop")
    )
    joined = named.join(drops, F.col("id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_d")), "left")
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")
    n_dropped = F.coalesce(F.size("_drop"), F.lit(0)).cast("long")
    return unbox(joined, {text: _without_lines("text", "_drop")}, {"n_lines": n_lines, "n_dropped": n_dropped})


@F.pandas_udf(T.StringType())
def _without_lines(texts: pd.Series, drops: pd.Series) -> pd.Series:
    """The text without the lines of these numbers."""
    out = []
    for text, drop in zip(texts, drops):
        if drop is not None:
            gone = set(drop)
            text = "\n".join(line for no, line in enumerate(text.split("\n")) if no not in gone)
        out.append(text)
    return pd.Series(out, dtype=object)
