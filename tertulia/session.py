"""Session settings, written stages and size-checked lookups.

Everything that cuts lineage goes through :func:`stage`, which writes a Parquet table below the shared folder the
cluster names in ``spark.checkpoint.dir``. A written table survives the loss of executors, can be pruned by column, and
gives the planner its real size.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest lookup table (rows) sent to every executor. Wider or longer tables take the salted join instead.
BROADCAST_ROWS = 1_000_000
# How many ways a hot key is split when a lookup table is too large to broadcast.
SALTS = 16


def build_session(app: str = "tertulia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library relies on; ``conf`` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    if master and master.startswith("local"):
        settings |= {
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("TERTULIA_DRIVER_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": "8",
        }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


@lru_cache(maxsize=None)
def _ship(app: str) -> None:
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tertulia-code-"), "tertulia")
    path = shutil.make_archive(archive, "zip", os.path.dirname(here), os.path.basename(here))
    SparkSession.active().sparkContext.addPyFile(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application: they may run where it is not installed."""
    _ship(spark.sparkContext.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local master may do without one and gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="tertulia-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name below the shared folder that no other stage uses."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tertulia/{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: later steps start from the stored table."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (cheap on a staged table: row counts sit in the footers)."""
    return df.limit(max_rows + 1).count() <= max_rows


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str,
    salt_by: str,
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join many ``rows`` to a lookup ``table`` that is unique on ``on``.

    The table is counted first. A small one is broadcast, so ``rows`` is not shuffled. A large one is repeated
    ``salts`` times and joined on the key plus a salt taken from ``salt_by``, so that a key holding a large share of the
    rows is spread over ``salts`` tasks. Both ways give the same rows.
    """
    table = stage(table, "lookup")
    if fits_broadcast(table, max_rows):
        return rows.join(F.broadcast(table), on, how)
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    return spread.join(salted, [*on, "_salt"], how).drop("_salt")
