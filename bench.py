"""Time the headline queries and print one JSON line.

Reads the tables in ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Each query runs to the end into Spark's ``noop`` sink, so
nothing is returned to the driver and no query can leave work out.
"""

from __future__ import annotations

import json
import os
import time

from tertulia.plans import queries as registered
from tertulia.session import build_session

HEADLINE = [
    "network_distribution",
    "repeated_posts",
    "hashtag_counts",
    "dedupe_content",
    "clean_text",
    "dedupe_tokens",
    "word_count",
    "phrase_model",
    "apply_phrases",
    "process_words",
    "bag_of_words",
    "top_words_per_topic",
    "words_timeline_topic",
    "topic_timeline",
    "lda_fit",
    "classify",
    "coherence_cv",
    "word_relevance",
    "term_relevance",
    "term_cosine_edges",
    "closeness",
    "betweenness",
    "top_sqrt_edges",
    "break_cycles",
    "topic_story",
    "visual_payload",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{"spark.ui.showConsoleProgress": "false"})
    run = registered.queries()
    run["network_distribution"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the engine
    seconds: dict[str, float] = {}
    for name in names:
        start = time.time()
        run[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf")}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
