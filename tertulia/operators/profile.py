"""First look at a collection: counts, filters, dates, and the row volumes of a run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tertulia.functions.text import extract_hashtags
from tertulia.operators.selection import first_rows, number_text

# Headers of the export and the names used here.
COLUMN_NAMES = {
    "Autor": "author",
    "Contenido de la publicación": "content",
    "Creado": "date",
    "Contexto": "context",
    "Link para la fuente": "link",
    "Grupo de dominio": "domain_group",
    "País": "country",
    "Tipo específico": "type",
}
# Networks kept when the caller names none.
NETWORKS = ["Twitter", "Facebook", "Instagram", "Photos & Video"]
DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"


def normalize_columns(df: DataFrame, names: Mapping[str, str] = COLUMN_NAMES, keep: Iterable[str] = ()) -> DataFrame:
    """Only the mapped columns, renamed; ``keep`` names extra columns (a row key) to carry along."""
    missing = [c for c in [*names, *keep] if c not in df.columns]
    if missing:
        raise KeyError(f"columns not in the input: {missing}")
    return df.select(*keep, *[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def drop_null_content(df: DataFrame, column: str = "content") -> DataFrame:
    return df.dropna(subset=[column])


def drop_null_any(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna("any", subset=columns)


def filter_networks(df: DataFrame, networks: list[str] | None = None, column: str = "domain_group") -> DataFrame:
    return df.where(F.col(column).isin(networks or NETWORKS))


def filter_has_hash(df: DataFrame, column: str = "content") -> DataFrame:
    return df.where(F.contains(F.col(column), F.lit("#")))


def head_n(df: DataFrame, n: int, key: str = "post_id") -> DataFrame:
    """First ``n`` posts by key: stored tables have no row order of their own. No task holds ``n`` rows if ``n`` is large."""
    return first_rows(df, number_text(F.col(key)), n)


def parse_date(df: DataFrame, column: str = "date") -> DataFrame:
    """Text to timestamp; text in another form becomes null."""
    return df.withColumn(column, F.try_to_timestamp(F.col(column), F.lit(DATE_FORMAT)))


def fill_empty_text(df: DataFrame, column: str = "processed") -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit("<EMPTY>")))


def distinct_networks(df: DataFrame, column: str = "domain_group") -> DataFrame:
    return df.select(column).distinct()


def date_range(df: DataFrame, column: str = "date") -> DataFrame:
    return df.agg(F.min(column).alias("first_date"), F.max(column).alias("last_date"))


def network_distribution(df: DataFrame, column: str = "domain_group") -> DataFrame:
    """Posts per network, largest first. Run it before rows are dropped."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), column)


def _counted_texts(df: DataFrame, column: str, key: str, least: int) -> DataFrame:
    """``(column, count)`` of the texts found ``least`` times or more.

    Only digests and keys are grouped, combined before the shuffle: a text that makes up a third of all rows costs one row
    per task. Each text is fetched once, from the row with the lowest key.
    """
    present = df.where(F.col(column).isNotNull())
    counts = present.groupBy(F.sha2(F.col(column), 256).alias("_digest")).agg(F.count(F.lit(1)).alias("count"), F.min(key).alias(key))
    return present.select(key, column).join(counts.where(F.col("count") >= least).select(key, "count"), key).select(column, "count")


def repeated_posts(df: DataFrame, column: str = "content", key: str = "post_id") -> DataFrame:
    """How often each exact text occurs, most frequent first. ``key`` tells rows apart."""
    return _counted_texts(df, column, key, 1).orderBy(F.desc("count"), column)


def repeated_posts_top(df: DataFrame, n: int = 15, column: str = "content", key: str = "post_id") -> DataFrame:
    return _counted_texts(df, column, key, 2).orderBy(F.desc("count"), column).limit(n)


def hashtag_counts(df: DataFrame, column: str = "content") -> DataFrame:
    """Hashtags and their number of uses, most used first; case matters."""
    tags = filter_has_hash(df, column).select(F.explode(extract_hashtags(F.col(column))).alias("hashs"))
    return tags.groupBy("hashs").agg(F.count(F.lit(1)).alias("Conteo")).orderBy(F.desc("Conteo"), "hashs")


class Volumes:
    """Row counts of the stages of a run, taken while the stages run: no extra counting job."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        self._seen[name] = Observation(name)
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("rows"))

    def rows(self) -> dict[str, int]:
        """Waits for the stages that were watched; ask only after they ran."""
        return {name: seen.get["rows"] for name, seen in self._seen.items()}


def stage_volumes(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named stage, as a table."""
    counts: list[DataFrame] = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows") for name, df in stages.items()
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


