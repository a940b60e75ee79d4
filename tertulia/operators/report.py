"""The record of a run."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What stands in the record for a value that is missing.
MISSING = {
    "Recommended k": "Not K",
    "Path_raw_data": "Not path data",
    "Path_output": "No path output model",
    "Path_output_model": "No path output model",
    "Used Library": "no selected lib",
    "Column_used_and_new_names": "No selected columns and names",
    "Social_networks_used": "No social network selection",
    "Time process": "No Time process",
}


def run_report(
    spark: SparkSession,
    values: Mapping[str, object],
    k: int | None = None,
    min_topics: int | None = None,
    max_topics: int | None = None,
) -> DataFrame:
    """One row per entry, ``(name, value)`` with the value as JSON text; missing values become a sentence."""
    record: dict[str, object] = {
        "Range_LDA": not k,
        "Min Topics": k or min_topics,
        "Max Topics": k or max_topics,
    }
    record |= {name: values.get(name) or sentence for name, sentence in MISSING.items()}
    record |= {name: value for name, value in values.items() if name not in MISSING}
    rows = [(name, json.dumps(value, ensure_ascii=False, default=str)) for name, value in record.items()]
    return spark.createDataFrame(rows, "name string, value string")


def as_document(report: DataFrame) -> DataFrame:
    """The report as one row ``document``, a JSON object. Its size does not depend on the data."""
    entry = F.concat(F.to_json(F.array("name")).substr(F.lit(2), F.length(F.to_json(F.array("name"))) - 2), F.lit(": "), "value")
    entries = F.array_sort(F.collect_list(entry))
    return report.agg(F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}")).alias("document"))
