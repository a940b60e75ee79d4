import json
import math

import pytest
from pyspark.sql import functions as F

from tertulia.operators.profile import COLUMN_NAMES
from tertulia.operators.topics import LdaSettings
from tertulia.plans import fixtures as fx
from tertulia.plans import pipeline
from tertulia.sources import files
from tertulia.sources.layout import RunLayout


@pytest.fixture(scope="module")
def run(spark, sf, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    posts = fx.posts(spark, sf)
    export = posts.select("post_id", *[F.col(new).alias(old) for old, new in COLUMN_NAMES.items()])
    files.write_csv(export, str(base / "export"))
    config = pipeline.MiningConfig(
        path=str(base / "export"),
        layout=RunLayout(str(base), "posts", "2024-01", "v1"),
        key="post_id",
        language="english",
        networks=fx.NETWORKS,
        min_topics=2,
        max_topics=5,
        lda=LdaSettings(passes=2),
    )
    return config, pipeline.mine_topics(spark, config)


def test_mining_writes_the_contract(spark, run):
    config, result = run
    layout = result.layout
    assert 2 <= result.k < 5
    assert result.volumes["read"] == 200
    done = spark.read.parquet(result.processed)
    assert {"post_id", "author", "content", "date", "domain_group", "processed"} <= set(done.columns)
    assert {r.domain_group for r in done.select("domain_group").distinct().collect()} <= set(fx.NETWORKS)
    assert done.where("content is null").isEmpty()
    assert 0 < done.count() <= result.volumes["distinct_tokens"] <= result.volumes["distinct_text"] < 200
    net = files.scan_csv(spark, layout.table("network_distribution"))
    assert sum(int(r["count"]) for r in net.collect()) == 200
    text = spark.read.text(layout.table("metadata")).first()[0]
    meta = json.loads(text)
    assert meta["Recommended k"] == result.k and "Text cleaning" in meta["Time process"]
    curve = pipeline.choose_from_stored(spark, layout).collect()
    assert [r.k for r in curve] == [2, 3, 4] and sum(r.is_recommended for r in curve) == 1


def test_reports_follow_from_the_stored_model(spark, run):
    _, result = run
    layout = result.layout
    posts = pipeline.classify_and_report(spark, layout, 3, graphs_too=True)
    n = posts.count()
    mapped = sorted(files.scan_csv(spark, layout.table("topic_map")).collect(), key=lambda r: int(r.topic))
    assert [int(r.topic) for r in mapped] == [0, 1, 2] and sum(float(r.share) for r in mapped) == pytest.approx(1)
    # three topics lie in a plane, so the map keeps their distances
    at = {int(r.topic): (float(r.x), float(r.y)) for r in mapped}
    for r in files.scan_csv(spark, layout.table("topic_distance")).collect():
        assert math.dist(at[int(r.topic_a)], at[int(r.topic_b)]) == pytest.approx(float(r.distance), abs=1e-6)
    payload = spark.read.json(layout.table("visualization"))
    assert payload.count() == 3 and spark.read.json(layout.table("points")).count() == n
    documents = [json.loads(r.payload) for r in payload.collect()]
    assert all(d["weights"] and d["nodes"] for d in documents)
    shares = files.scan_csv(spark, layout.table("topic_distribution")).collect()
    assert sum(int(r["count"]) for r in shares) == n
    wide = files.scan_csv(spark, layout.table("df_classified"))
    assert wide.count() == n and "Topic_2_proba" in wide.columns
    words = files.scan_csv(spark, layout.table("words_global"))
    assert words.columns == ["word", "topic_id", "importance", "word_count"] and words.count() == 75
    top = spark.read.option("header", True).csv(layout.table("words_timeline_topic"))
    assert top.columns == ["date", "Topic", "processed", "Palabra", "topic_id"] and top.count() > 0
    assert top.where("Palabra = '' or Topic <> topic_id").isEmpty()


def test_replies_become_topic_names(spark, run):
    """After the reports: a bad reply leaves the labels and the request open, a good one closes it."""
    _, result = run
    layout = result.layout
    request = files.scan_json_lines(spark, layout.table("topic_requests"), "request_id string, prompt string").collect()
    assert len(request) == 1 and "0" in request[0].prompt
    reply = lambda *texts: spark.createDataFrame([(request[0].request_id, t) for t in texts], "request_id string, reply string")
    labels = {r.topic: r.title for r in pipeline.name_topics(spark, layout, 3, reply('{"0": "only one"}', "no json")).collect()}
    still = files.scan_json_lines(spark, layout.table("open_requests"), "request_id string, prompt string")
    assert set(labels) == {"0", "1", "2"} and "only one" not in labels.values() and still.count() == 1
    good = '```json\n{"0": "a", "1": " ", "2": "c"}\n```'
    named = {r.topic: r.title for r in pipeline.name_topics(spark, layout, 3, reply("no json", good, good)).collect()}
    assert named == {"0": "a", "1": labels["1"], "2": "c"}
    still = spark.read.schema("request_id string, prompt string").json(layout.table("open_requests"))
    assert still.count() == 0
    assert {r.topic for r in files.scan_csv(spark, layout.table("topic_names")).collect()} == {"0", "1", "2"}


def test_more_topics_keeps_stored_values(spark, run):
    config, result = run
    before = {r.k: r.coherence for r in files.scan_coherence(spark, result.layout.table("Coherence_values")).collect()}
    after = {r.k: r.coherence for r in pipeline.more_topics(spark, config, result.layout, [3, 4, 5]).collect()}
    assert set(after) == {3, 4, 5} and after[3] == pytest.approx(before[3])
    stored = {r.k for r in files.scan_coherence(spark, result.layout.table("Coherence_values")).collect()}
    assert stored == {2, 3, 4, 5}


def test_a_second_run_does_not_overwrite(spark, run):
    config, _ = run
    with pytest.raises(Exception):
        pipeline.mine_topics(spark, config)
