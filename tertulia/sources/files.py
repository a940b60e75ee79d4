"""Reading exports and results, and writing result tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tertulia.session import fits_broadcast, stage

_TEXT = T.StringType()


def scan_csv(spark: SparkSession, path: str, sep: str = ",", multiline: bool = True) -> DataFrame:
    """A delimited file or folder, every column text, one header per file.

    ``multiline`` keeps quoted line breaks inside a post, but a file is then read by one task: export large collections
    as many files, or switch it off when no post has line breaks, so that files are split.
    """
    return _reader(spark, sep, multiline).csv(path)


def scan_csv_dir(spark: SparkSession, folder: str, ending: str = "csv", sep: str = ",", multiline: bool = True) -> DataFrame:
    """All files of a folder whose name has the ending, as one scan; empty text becomes null.

    Headers are checked against each other: a file with other columns is an error. Folders whose files differ are read
    one by one and joined with :func:`union_sources`.
    """
    reader = _reader(spark, sep, multiline).option("pathGlobFilter", f"*{ending}").option("enforceSchema", False)
    return empty_to_null(reader.csv(folder))


def _reader(spark: SparkSession, sep: str, multiline: bool):
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("encoding", "UTF-8")
    )


def _with_fields(spark: SparkSession, path: str, sep: str, multiline: bool) -> tuple[DataFrame, int]:
    """Rows with the number of fields of those that differ from the header (``_fields``, else null), and the header's number."""
    names = _reader(spark, sep, multiline).csv(path).columns
    schema = T.StructType([T.StructField(n, _TEXT) for n in [*names, "_raw"]])
    reader = _reader(spark, sep, multiline).schema(schema).option("mode", "PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", "_raw").csv(path)
    unquoted = F.regexp_replace("_raw", F.lit('"[^"]*"'), F.lit(""))
    separators = (F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit("")))) / len(sep)
    return rows.withColumn("_fields", (separators + 1).cast("int")).drop("_raw"), len(names)


def scan_csv_tolerant(spark: SparkSession, path: str, sep: str = ",", multiline: bool = True) -> DataFrame:
    """Like :func:`scan_csv`, but lines with too many fields are left out; short lines are filled with nulls.

    The reader hands over the raw text of lines whose number of fields is not the header's; separators outside quotes
    tell the long ones from the short ones.
    """
    rows, width = _with_fields(spark, path, sep, multiline)
    return rows.where(F.col("_fields").isNull() | (F.col("_fields") <= width)).drop("_fields")


def count_skipped(spark: SparkSession, path: str, sep: str = ",", multiline: bool = True) -> int:
    """How many lines :func:`scan_csv_tolerant` leaves out."""
    rows, width = _with_fields(spark, path, sep, multiline)
    # the reader refuses queries on the raw text alone, so a column of the file is counted along
    return rows.agg(F.count_if(F.col("_fields") > width), F.count(F.col(f"`{rows.columns[0]}`"))).first()[0]


def in_file_order(rows: DataFrame, key: str = "post_id") -> DataFrame:
    """Number the rows of a file scan from 0 in the order of file names and of lines, as column ``key``.

    Two passes: the rows are stored once with the part of the file they come from and their place in it, then the rows of
    each part are counted and the counts added up. So the numbers do not depend on how files are split or dealt to tasks.
    ``rows`` may filter and compute columns, but must come from a scan without a shuffle in between.
    """
    named = rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at")
    )
    stored = stage(named, "rows-in-order")
    # rows of a part lie side by side in one task, so its numbers have no gaps
    parts = stored.groupBy("_file", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy(F.lit(0)).orderBy("_file", "_start")) - F.col("_rows")
    # one row per part of a file
    offsets = stage(parts.select("_file", "_start", (before - F.col("_first")).alias("_offset")), "offsets")
    offsets = F.broadcast(offsets) if fits_broadcast(offsets) else offsets
    joined = stored.join(offsets, ["_file", "_start"])
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns if c != key], (F.col("_at") + F.col("_offset")).alias(key))


def empty_to_null(df: DataFrame) -> DataFrame:
    """Empty text to null in every text column."""
    texts = {f.name for f in df.schema if f.dataType == _TEXT}
    return df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns])


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames below each other, columns by name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def spread_out(table: DataFrame, key: str) -> DataFrame:
    """Give a stored table that lies in fewer parts than there are cores one part per core.

    Text cleaning is all processor time, so a small table in one file would keep one core busy. Tables with enough parts
    are left as they are and not shuffled. ``table`` must be a plain scan: its parts are known without running it.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, key) if table.rdd.getNumPartitions() < cores else table


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def scan_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One document per line, as Spark writes them."""
    return spark.read.schema(schema).json(path)


def scan_outputs_by_name(spark: SparkSession, folder: str, part: str, sep: str = ",") -> DataFrame:
    """Result tables below ``folder`` whose own folder has ``part`` in its name."""
    return _reader(spark, sep, True).csv(f"{folder}/*{part}*")


def scan_coherence(spark: SparkSession, path: str) -> DataFrame:
    """A stored coherence curve as ``(k, coherence)``, in order of k."""
    rows = _reader(spark, ",", False).csv(path)
    return rows.select(F.col("Topics").cast("int").alias("k"), F.col("Coherence").cast("double").alias("coherence")).orderBy("k")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    """A delimited table with header. Quotes are doubled, so :func:`scan_csv` reads back the same text."""
    writer = df.write.mode(mode).option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
    writer = writer.option("ignoreTrailingWhiteSpace", False)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_processed(df: DataFrame, path: str, mode: str = "errorifexists", csv: bool = False) -> None:
    """The processed posts: Parquet with token arrays; with ``csv`` also as text, tokens joined by blanks."""
    df.write.mode(mode).parquet(f"{path}/df_processed.parquet")
    if csv:
        stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/df_processed.parquet")
        joined = stored.withColumn("processed", F.array_join("processed", " "))
        write_csv(joined, f"{path}/df_processed.csv", mode)


def write_document(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One row holding a JSON document, as a text file."""
    df.coalesce(1).write.mode(mode).text(path)
