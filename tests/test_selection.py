"""The first n rows of an order, compared with sorting."""

import random

import pytest
from pyspark.sql import functions as F

from tertulia.operators import dedupe, profile
from tertulia.operators.selection import first_rows, number_text


@pytest.mark.parametrize("ranked", [10_000, 3, 0])
@pytest.mark.parametrize("n", [0, 1, 7, 40, 150, 1000])
def test_first_rows_by_number(spark, ranked, n):
    rng = random.Random(n)
    keys = [rng.randrange(-(2**62), 2**62) for _ in range(120)] + rng.sample(range(500), 100) + [-(2**63), 2**63 - 1, 0]
    keys = list(dict.fromkeys(keys))
    df = spark.createDataFrame([(k, str(k)) for k in keys], "post_id long, _n string").repartition(4)
    got = first_rows(df, number_text(F.col("post_id")), n, ranked=ranked)
    assert got.columns == df.columns and sorted(r.post_id for r in got.collect()) == sorted(keys)[:n]


@pytest.mark.parametrize("ranked", [100, 2])
def test_first_rows_by_group(spark, ranked):
    rng = random.Random(4)
    rows = list({(t, "".join(rng.choice("abé😀") for _ in range(rng.randrange(1, 9)))) for t in range(4) for _ in range(120)})
    rows += [(2, None)] * 5
    limits = {0: 5, 1: 60, 2: 500, 3: 0}
    table = spark.createDataFrame(list(limits.items()), "topic int, limit int")
    got = first_rows(spark.createDataFrame(rows, "topic int, word string"), F.col("word"), table, ["topic"], ranked)
    want = {(t, w) for t, n in limits.items() for w in sorted((w for u, w in rows if u == t), key=lambda w: (w or "\U0010ffff").encode())[:n]}
    assert {tuple(r) for r in got.collect()} == want


def test_samples_do_not_depend_on_the_way(spark, monkeypatch):
    df = spark.range(500).withColumnRenamed("id", "post_id")
    few = {r.post_id for r in dedupe.sample_n(df, 60).collect()}
    assert few == {r.post_id for r in df.orderBy(dedupe._lot("post_id", 42), "post_id").limit(60).collect()}
    monkeypatch.setattr(dedupe, "first_rows", lambda *a: first_rows(*a, ranked=5))
    assert few == {r.post_id for r in dedupe.sample_n(df, 60).collect()}
    assert [r.post_id for r in profile.head_n(df, 3).orderBy("post_id").collect()] == [0, 1, 2]


@pytest.mark.parametrize("lead", [3, 20])
def test_long_limits_are_found_by_counting(spark, monkeypatch, lead):
    """Spark cuts ranks before the shuffle up to 1,000 rows; beyond, no group is ranked whole."""
    from tertulia.operators import selection

    states, ranked = [], selection._ranked
    monkeypatch.setattr(selection, "_ranked", lambda df, order, state, group: states.append(state) or ranked(df, order, state, group))
    df = spark.range(9000).select((F.col("id") % 2).alias("topic"), (F.col("id") % 900).alias("n"), "id")
    order = F.concat(number_text(-F.col("n")), F.lpad(F.col("id").cast("string"), 5, "0"))
    limits = spark.createDataFrame([(0, 1500), (1, 1003)], "topic int, limit int")
    got = {(r.topic, r.id) for r in first_rows(df, order, limits, ["topic"], lead=lead).collect()}
    rows = sorted((-(i % 900), i) for i in range(9000))
    want = {(t, i) for t, n in ((0, 1500), (1, 1003)) for _, i in [r for r in rows if r[1] % 2 == t][:n]}
    assert got == want and all(r._prefix for r in states[0].collect())
