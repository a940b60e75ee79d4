"""Small helpers shared by the operators: reading a table, and rows through Arrow in batches of bounded size."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Code points a Python task gathers before it hands a batch on.
BATCH_CHARS = 4_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """``fn`` turns the tuples of one partition into output tuples, both one at a time.

    Batches are cut by the size of what they hold, so a run of very long texts does not pile up in one batch.
    """
    kinds = df.sparkSession.createDataFrame([], schema).schema
    names = kinds.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kinds)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                yield from zip(*columns)

        held: list[tuple] = []
        size = 0
        for row in fn(rows()):
            held.append(row)
            size += 64 + sum(len(x) for x in row if isinstance(x, (str, bytes, list)))
            if size >= BATCH_CHARS:
                yield _batch(held, names, arrow)
                held, size = [], 0
        if held:
            yield _batch(held, names, arrow)

    return df.mapInArrow(run, kinds)


def _batch(rows: list[tuple], names: list[str], arrow: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished queries deleted: Spark does that when the driver collects its garbage, which a
    driver with memory left puts off while the disks fill. The last query's files go with the second collection."""
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.3)
    spark.sparkContext._jvm.System.gc()


def box(docs: DataFrame, **named: Column) -> DataFrame:
    """All columns of ``docs`` as one column ``row`` beside the named ones, so that no name of the input can clash."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in named.items()])


def unbox(df: DataFrame, changed: dict[str, Column] | None = None, added: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``row`` again, some of them changed; an added column takes the place of one of the same name."""
    changed, added = changed or {}, added or {}
    taken = {c.lower() for c in added}
    names = [f.name for f in df.schema["row"].dataType if f.name.lower() not in taken]
    return df.select(*[changed.get(n, F.col("row").getField(n)).alias(n) for n in names], *[c.alias(n) for n, c in added.items()])
