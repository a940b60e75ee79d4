"""The first n rows of an order, for an n that grows with the data.

``orderBy(...).limit(n)`` sends n rows to one task. Here the order becomes one text per row, and the n-th text is found digit
by digit: each round counts the rows per prefix, a few characters longer than the one before, and goes on inside the prefix
that holds the n-th row. What lies before it stays without being sorted, and only rows of the last, small prefix are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tertulia.session import stage

# Up to so many rows are ranked by one task. Spark keeps no more than the limit per task before the shuffle only up to
# ``spark.sql.optimizer.windowGroupLimitThreshold``, 1,000 by default; beyond it one task would read a whole group.
RANKED = 1_000
# Characters that each round adds to the prefix.
STEP = 3


def number_text(number: Column) -> Column:
    """A long as text that sorts like it."""
    return F.lpad((number.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0")


def first_rows(
    df: DataFrame, order: Column, limits: DataFrame | int, group: list[str] | None = None, ranked: int = RANKED, step: int = STEP,
    lead: int = STEP,
) -> DataFrame:
    """Of each group the ``limits`` rows whose text ``order`` comes first; ``limits`` is a number or a small table
    ``(group columns, limit)`` of one row per group. Texts should tell the rows of a group apart; of rows with equal texts
    at the limit any may stay, and one task ranks them. Rows without a text come last.

    Each round reads ``order`` and the group columns of ``df`` once: hand over a stored table. ``lead`` is the length of the
    first prefix, for texts that begin with a number of few distinct values.
    """
    group = group or []
    if isinstance(limits, int):
        limits = df.sparkSession.createDataFrame([(limits,)], "limit long")
    order = F.coalesce(order, F.lit("\U0010ffff"))
    state = limits.select(*group, F.col("limit").cast("long").alias("_left"), F.lit("").alias("_prefix"), F.lit(False).alias("_all"))
    state = stage(state.where("_left > 0"), "selection")
    keyed = df.select(*group, order.alias("_order"))
    ranked = min(ranked, int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", str(RANKED))))
    if (state.agg(F.max("_left")).first()[0] or 0) <= ranked:
        return _ranked(df, order, state, group)
    while True:
        inside = _beside(keyed, state, group).where(~F.col("_all") & F.startswith("_order", F.col("_prefix")))
        width = F.when(F.length("_prefix") == 0, F.lit(lead)).otherwise(F.length("_prefix") + step)
        counts = inside.groupBy(*group, "_prefix", "_left", F.substring("_order", F.lit(1), width).alias("_next"))
        counts = counts.agg(F.count(F.lit(1)).alias("_n"))
        # some thousand prefixes per group, whatever its size
        so_far = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_next")
        up_to = F.sum("_n").over(so_far)
        met = counts.withColumn("_before", up_to - F.col("_n")).where("_before < _left AND _before + _n >= _left")
        found = met.select(*group, F.col("_next").alias("_to"), F.col("_before"), F.col("_n"))
        # no prefix is met where a group has fewer rows than it may keep: all of them stay
        moved = state.join(found, group, "left") if group else state.join(found, how="left")
        whole = F.col("_to").isNull()
        grown = stage(
            moved.select(
                *group, F.when(whole, F.col("_left")).otherwise(F.col("_left") - F.col("_before")).alias("_left"),
                F.coalesce("_to", "_prefix").alias("_prefix"), whole.alias("_all"), F.coalesce("_n", F.lit(0)).alias("_n"),
                (whole | (F.col("_to") == F.col("_prefix"))).alias("_done"),
            ),
            "selection",
        )
        state = grown.select(*group, "_left", "_prefix", "_all")
        if grown.where((F.col("_n") > ranked) & ~F.col("_done")).isEmpty():
            return _ranked(df, order, state, group)


def _beside(rows: DataFrame, state: DataFrame, group: list[str]) -> DataFrame:
    """Each row with the state of its group, one row per group."""
    return rows.join(F.broadcast(state), group) if group else rows.join(F.broadcast(state))


def _ranked(df: DataFrame, order: Column, state: DataFrame, group: list[str]) -> DataFrame:
    """Rows before the prefix, and as many of those with the prefix as are left, ranked among themselves."""
    both = _beside(df.withColumn("_order", order), state, group)
    inside = ~F.col("_all") & F.startswith("_order", F.col("_prefix"))
    before = both.where(F.col("_all") | (~inside & (F.col("_order") < F.col("_prefix"))))
    rank = F.row_number().over(Window.partitionBy(*(group or [F.lit(0)])).orderBy("_order"))
    least = state.agg(F.max("_left")).first()[0] or 0
    among = both.where(inside).withColumn("_rank", rank).where((F.col("_rank") <= F.lit(int(least))) & (F.col("_rank") <= F.col("_left")))
    names = df.columns
    return before.select(*names).unionByName(among.select(*names))
