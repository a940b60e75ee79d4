"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.llm.tables import delete_folder
from tertulia.session import new_folder


def connected(links: DataFrame) -> DataFrame:
    """``links (a, b)`` between different ids; gives ``(node, component)`` for all nodes, the component being its least id.

    Every round keeps the components and hangs nodes on smaller neighbours, so the number of rounds grows with the
    logarithm of the longest path. Each round is a stored table of at most as many rows as there are links, and shuffles
    them four times; the links of one node to smaller ones meet in one task, in sums and joins that spill.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    kept, mark = _write(edges)
    while True:
        edges = spark.read.schema(edges.schema).parquet(kept)
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        # larger neighbours of a node hang on its least neighbour, or on the node itself
        large = edges.join(least.select(F.col("u").alias("v"), "m"), "v", "left").select("u", F.coalesce("m", "v").alias("v"))
        # dealt once, for the sum and for the join
        lower = large.filter("u <> v").repartition("u")
        least = lower.groupBy("u").agg(F.min("v").alias("m"))
        # a node and its smaller neighbours all hang on the least of them
        small = lower.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        path, new = _write(small.filter("u <> v").distinct())
        delete_folder(spark, kept)
        kept = path
        if new == mark:
            break
        mark = new
    edges = spark.read.schema(edges.schema).parquet(kept)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def _write(edges: DataFrame) -> tuple[str, tuple]:
    """Store a round; its size and a checksum tell whether anything has changed."""
    path = new_folder(edges.sparkSession, "links")
    edges.write.parquet(path)
    back = edges.sparkSession.read.schema(edges.schema).parquet(path)
    row = back.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
    return path, (row[0], row[1])
