"""Where a run keeps its data, results and models."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class RunLayout:
    """Folders ``root/listening/period/version/{data, output/lda, output/lda/models}``."""

    root: str
    listening: str
    period: str
    version: str

    @property
    def base(self) -> str:
        return f"{self.root.rstrip('/')}/{self.listening}/{self.period}/{self.version}"

    @property
    def data(self) -> str:
        return f"{self.base}/data"

    @property
    def results(self) -> str:
        return f"{self.base}/output/lda"

    @property
    def models(self) -> str:
        return f"{self.results}/models"

    def table(self, name: str) -> str:
        return f"{self.results}/{name}"

    def settle(self, spark: SparkSession, conflict: str = "fail") -> tuple[RunLayout, str]:
        """The layout and the save mode to use: ``fail``, ``replace``, or ``rename`` to the next free version."""
        if conflict == "fail":
            return self, "errorifexists"
        if conflict == "replace":
            return self, "overwrite"
        if conflict != "rename":
            raise ValueError(f"unknown conflict mode: {conflict}")
        free, n = self, 1
        while _exists(spark, free.results):
            free, n = replace(self, version=f"{self.version} {n}"), n + 1
        return free, "errorifexists"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
