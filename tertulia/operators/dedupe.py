"""Keep-first deduplication and reproducible samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.operators.selection import first_rows, number_text


def _keep_first(df: DataFrame, digest: Column, key: str) -> DataFrame:
    """One row per digest, the one with the lowest key.

    Only the digest and the key are grouped: a hash aggregate with fixed-size buffers that combines equal texts before
    the shuffle, so one text that makes up a third of all rows costs one row per task. The chosen keys are unique and
    select the full rows through a semi join.
    """
    first = df.groupBy(digest.alias("_digest")).agg(F.min(key).alias(key))
    return df.join(first.select(key), key, "left_semi")


def dedupe_content(df: DataFrame, column: str = "content", key: str = "post_id") -> DataFrame:
    """Drop rows without text, then keep the first row of each text."""
    present = df.where(F.col(column).isNotNull())
    return _keep_first(present, F.sha2(F.col(column), 256), key)


def dedupe_tokens(df: DataFrame, column: str = "processed", key: str = "post_id") -> DataFrame:
    """Keep the first post of each token list; all posts without tokens count as equal."""
    present = df.where(F.col(column).isNotNull())
    return _keep_first(present, F.sha2(F.array_join(F.col(column), " "), 256), key)


def _lot(key: str, seed: int) -> Column:
    """An even random number per key as 32 hexadecimal digits, the same on any partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42, key: str = "post_id") -> DataFrame:
    """A share of the posts: those whose lot is below the share. A filter, without a shuffle."""
    if fraction >= 1:
        return df
    return df.where(_lot(key, seed) < F.lit(f"{int(fraction * 2**32):08x}"))


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str = "post_id") -> DataFrame:
    """Exactly ``n`` posts (or all, if fewer): those with the lowest lots. No task holds ``n`` rows if ``n`` is large."""
    return first_rows(df, F.concat(_lot(key, seed), number_text(F.col(key))), n)


def sample_posts(df: DataFrame, fraction: float | None = None, n: int | None = None) -> DataFrame:
    """Sample by share or by number; the share wins when both are given."""
    if fraction:
        return sample_fraction(df, fraction)
    return sample_n(df, n) if n else df
