"""Every registered query beside its SQL at the smallest scale, and the shape of the plans."""

import subprocess
import sys

import pytest

import __spark_entry__ as registered
from tests.compare import compare, connect

QUERIES, SQL = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


@pytest.mark.parametrize("name", [q for q in QUERIES if not q.startswith("op") and q != "pipeline"])
def test_query(spark, sf, db, name):
    ok, note = compare(spark, db, sf, name, QUERIES[name], SQL.get(name))
    assert ok, note


def test_entry(spark):
    rows = registered.entry(spark)
    assert rows.columns == ["topic", "word", "n", "rank"] and rows.count() == 24


def test_sql_has_only_known_names():
    assert set(SQL) <= set(QUERIES)


def test_sql_needs_neither_jars_nor_a_session():
    code = "import sys; sys.modules['pyspark'] = None; from tertulia.plans.oracles import oracle_sql; print(len(oracle_sql()))"
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) > 90


def test_listed_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    from tertulia.plans.oracles import ENGLISH_STOP_WORDS

    assert list(StopWordsRemover.loadDefaultStopWords("english")) == ENGLISH_STOP_WORDS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["word_count", "clean_text", "hashtag_counts", "top_words_per_topic", "phrase_counts", "bag_of_words"])
def test_no_python_in_hot_paths(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert not any(x in text for x in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct"))


def test_texts_are_cleaned_once(spark, sf):
    assert plan(QUERIES["word_count"](spark, sf)).count("regexp_extract_all") == 1


def test_scan_reads_only_used_columns(spark, sf):
    text = plan(QUERIES["network_distribution"](spark, sf))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text
    assert "text:string" not in text


def test_top_k_is_cut_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan(QUERIES["top_words_per_topic"](spark, sf))
