"""The registered queries of this subpackage, and their SQL for DuckDB."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tertulia.llm import decontaminate, html_text, knn_join, licenses, line_dedup, near_duplicates, oracles, packing, quality_rules, repeats, token_counts, toxicity, whitening, word_runs
from tertulia.llm.tables import read
from tertulia.session import ship_package, stage

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Where a public tokenizer file lies; every worker has the files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Fitted on labelled rows that are not held out."""
    return toxicity.learn(docs, labels.filter(~_held_out()), "doc_id", "text", "toxic")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality_rules.assess(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licenses whose notices it holds, comma-joined, and the number of them.

    A notice that rights are reserved is no license and has a column of its own.
    """
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    templates = spark.createDataFrame(licenses.TEMPLATES, "license_id string, template string, must array<string>")
    granted = F.col("license_id") != licenses.RESERVED
    found = licenses.scan(docs, templates, must="must").groupBy(F.col("doc_id").alias("_doc")).agg(
        F.array_join(F.array_sort(F.collect_list(F.when(granted, F.col("license_id")))), ",").alias("licenses"),
        F.count_if(granted).alias("n_licenses"),
        F.round(F.max(F.when(granted, F.col("containment"))), 6).alias("containment"),
        F.count_if(~granted).alias("reserved"),
    )
    joined = docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    return joined.select(
        "doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_licenses", F.lit(0)).alias("n_licenses"), "containment",
        (F.coalesce("reserved", F.lit(0)) > 0).alias("rights_reserved"),
    )


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.cut_pieces(docs, vocabulary("byte_bpe_50k.json"))
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(stage(digests, "pieces"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_join.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document (by a checksum of its id) with a tail that repeats a few of them."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs.word_runs(read(spark, sf_dir, "documents"), rewrite=repeated_tail)
    # exact comparison of length / period; runs are in order, so that the first of equals stays
    better = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", F.aggregate("runs", none, better))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_text": op4_html_text, "op5_token_counts": op5_token_counts, "op6_licenses": op6_licenses, "op7_packing": op7_packing, "op8_line_dedup": op8_line_dedup, "op9_near_duplicates": op9_near_duplicates, "op10_decontaminate": op10_decontaminate,
    "op11_top_k": op11_top_k,
    "op12_word_runs": op12_word_runs,
    "op13_whitening": op13_whitening,
}
SQL: dict[str, str] = oracles.SQL
