"""Operators that compare documents: repeats, licenses, lines, near duplicates, benchmark passages, and the pipeline."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tertulia.llm import components, decontaminate, licenses, line_dedup, near_duplicates, registered, repeats
from tests.llm import brute


def by_id(df, *names):
    return {r.doc_id: tuple(r[n] for n in names) for r in df.collect()}


def test_repeats(spark, sf, rows):
    assert by_id(registered.op2_suffix_dedup(spark, sf), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.suffix_dedup(rows)


@pytest.mark.parametrize("part", [37, 1 << 22])
def test_repeats_of_hard_texts(spark, monkeypatch, part):
    monkeypatch.setattr(repeats, "PART", part)
    rng = random.Random(3)
    base = "".join(rng.choice("abcé") for _ in range(400))
    texts = ["q" * 350, base, base[:99] + "X" + base[100:], base[50:260] + base[40:250], "", None, base, "ab" * 200, base[7:107], base[120:219]]
    texts += [base[: rng.randrange(400)] + base[rng.randrange(400) :] for _ in range(20)]
    data = list(enumerate(texts))
    found = repeats.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"))
    found = found.withColumn("sha", F.sha2("kept", 256))
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "sha") == brute.suffix_dedup(data)


def _shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_repeats_leave_no_shuffles_behind(spark):
    """Decided runs are stored; the shuffles they came from, several times the input, go before the next step begins."""
    rows = [(s % 5, s % 3, s, 0, 1) for s in range(60)]
    runs = spark.createDataFrame(rows, "short long, long long, doc long, at long, n int")
    before = _shuffle_files(spark)
    found = repeats._decided(runs, last=False)
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert found.filter("repeated").count() == 45 and found.filter("not repeated").count() == 15


def test_repeats_of_odd_rows(odd):
    assert repeats.remove_repeats(odd.withColumn("kept", F.lit(1))).count() == odd.count()
    assert repeats.remove_repeats(odd.limit(0)).count() == 0


def test_licenses(spark, sf, rows):
    assert by_id(registered.op6_licenses(spark, sf), "licenses", "n_licenses", "containment") == brute.licenses(rows, licenses.TEMPLATES)


def test_licenses_inside_long_texts(spark):
    rng = random.Random(5)
    noise = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) + str(rng.randrange(999)) for _ in range(n))
    data = [(i, f"{noise(rng.randrange(80))} {text.upper()} {noise(rng.randrange(80))}") for i, (_, text) in enumerate(licenses.NOTICES * 3)] + [(99, None), (98, "a")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    templates = spark.createDataFrame(licenses.NOTICES, "license_id string, template string")
    found = {(r.doc_id, r.license_id) for r in licenses.scan(docs, templates).collect()}
    assert {(i, name) for i, (name, _) in enumerate(licenses.NOTICES * 3)} <= found
    assert licenses.scan(docs, templates, max_broadcast=0).count() == len(found)
    assert licenses.scan(docs.limit(0), templates).count() == licenses.scan(docs, templates.limit(0)).count() == 0


def test_licenses_of_other_forms(spark, tmp_path):
    texts = {
        "Licensed under the MIT License": "MIT", "x SPDX-License-Identifier: MPL-2.0 y": "MPL-2.0", "under CC BY 4.0.": "CC-BY-4.0", "GPLv2": "GPL-2.0",
        "the GNU Lesser General Public License, version 2.1": "LGPL-2.1", "CC BY-SA 4.0": "CC-BY-SA-4.0", "BSD 3-Clause": "BSD-3-Clause", "ISC License": "ISC",
        "CC0 1.0": "CC0-1.0", "GNU Affero General Public License version 3": "AGPL-3.0", "MIT is no license": "", "all rights": "", None: "",
    }
    data = [(i, t) for i, t in enumerate([*texts, "(c) All Rights Reserved"])]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = by_id(registered.op6_licenses(spark, str(tmp_path)), "licenses", "rights_reserved")
    assert found == {i: (want, False) for i, want in enumerate(texts.values())} | {len(texts): ("", True)}


def test_headers_of_one_family(spark, tmp_path):
    gnu = (
        "This {what} is free software; you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software "
        "Foundation; either version {v} of the License, or (at your option) any later version.\n\nThis {what} is distributed in the hope that it will be useful"
    )
    start = (
        "Copyright (c) 2001, A. Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.\n"
    )
    third = "3. Neither its name nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
    end = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"'
    texts = {
        gnu.format(what="program", name="GNU General Public License", v="2"): "GPL-2.0",
        gnu.format(what="program", name="GNU General Public License", v="3"): "GPL-3.0",
        gnu.format(what="library", name="GNU Lesser General Public License", v="2.1"): "LGPL-2.1",
        gnu.format(what="library", name="GNU Lesser General Public License", v="3"): "LGPL-3.0",
        gnu.format(what="program", name="GNU Affero General Public License", v="3"): "AGPL-3.0",
        "modify it under the terms of version 2 of the GNU General Public License as published by the Free Software Foundation.": "GPL-2.0",
        start + end: "BSD-2-Clause", start + third + end: "BSD-3-Clause", start.replace("1. ", "* ").replace("2. ", "* ") + end: "BSD-2-Clause",
        "nothing": "",
    }
    data = [(i, f"some words before it {t}") for i, t in enumerate(texts)]
    data += [(None, f"{data[0][1]} x"), (None, "a b c d e f")]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = registered.op6_licenses(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.licenses for r in got if r.doc_id is not None} == dict(enumerate(texts.values()))
    assert [r.licenses for r in got if r.doc_id is None] == ["GPL-2.0"] * 2
    expected = brute.licenses([d for d in data if d[0] is not None], licenses.TEMPLATES)
    assert {r.doc_id: (r.licenses, r.n_licenses, r.containment) for r in got if r.doc_id is not None} == expected


def test_lines(spark, sf, rows):
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, (n, k, t) in brute.line_dedup(rows).items()}
    assert by_id(registered.op8_line_dedup(spark, sf), "n_lines", "n_dropped", "kept_sha256") == want


def test_lines_of_odd_rows(odd):
    found = line_dedup.drop_common_lines(odd, max_broadcast=0).orderBy("doc_id").collect()
    assert len(found) == odd.count() and found[0].doc_id is None and found[0].n_dropped == 1
    assert {r.doc_id for r in found if r.n_dropped} == {None, 4, 5, 6, 7}  # 9 is the last to hold the line, 8 has another one
    assert [r.text for r in found if r.doc_id == 0] == [None]
    assert line_dedup.drop_common_lines(odd.limit(0)).count() == 0


def test_runs_of_several_levels(spark):
    rng = random.Random(9)
    found = [(k, None if rng.random() < 0.1 else d) for d in range(200) for k in {int(40 * rng.random() ** 3) for _ in range(6)}]
    runs = line_dedup.LineRuns(spark, min_docs=5)
    lines = spark.createDataFrame([(k, -k, d, d is None or d * 7 % 11) for k, d in found], "h1 long, h2 long, doc long, batch string").cache()
    sizes = []
    for batch in sorted({r.batch for r in lines.select("batch").distinct().collect()}):
        runs.add(lines.filter(F.col("batch") == batch).drop("batch"))
        sizes.append([len(level) for level in runs.levels])
    assert sizes[0] == [1] and sizes[7] == [0, 0, 0, 1] and max(map(sum, sizes)) <= 4
    stored = sum(spark.table(name).count() for name, _ in runs.runs())
    want = {}
    for k, d in found:
        n, last = want.get(k, (0, -1))
        want[k] = n + 1, max(last, -1 if d is None else d)
    assert {r.h1: -1 if r.last is None else r.last for r in runs.common().collect()} == {k: last for k, (n, last) in want.items() if n >= 5}
    assert stored < lines.select("h1", "batch").distinct().count()  # settled keys are not stored again
    # runs meet without moving
    assert "Exchange" not in runs._merge(*runs.runs()[:2])._jdf.queryExecution().executedPlan().toString()
    runs.close()
    assert not runs.runs()


@pytest.mark.parametrize("batches", [1, 9])
def test_lines_in_any_number_of_batches(spark, rows, batches):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.drop_common_lines(docs, batches=batches).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in found} == brute.line_dedup(rows)


def test_near_duplicates(spark, sf, rows):
    assert by_id(registered.op9_near_duplicates(spark, sf), "n_shingles", "component_id", "kept") == brute.near_duplicates(rows)


@pytest.mark.parametrize("small", [1, 16])
def test_groups_of_many_copies(spark, monkeypatch, small):
    """Copies with edits of their own and shared ones, around the threshold, in groups of either kind."""
    monkeypatch.setattr(near_duplicates, "SMALL", small)
    rng = random.Random(11)
    bases = [[f"w{rng.randrange(10**6)}" for _ in range(90)] for _ in range(3)]
    bases[1] = bases[0][:70] + bases[1][70:]
    data = []
    for i in range(150):
        words = list(bases[i % 3])
        for _ in range(rng.randrange(8)):
            words[rng.randrange(90)] = f"e{rng.randrange(12)}"
        data.append((i, " ".join(words)))
    found = near_duplicates.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"))
    found = found.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    assert by_id(found, "n_shingles", "component_id", "kept") == brute.near_duplicates(data)


def edited(base, rng, edits):
    words = list(base)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"edit{rng.randrange(10**9)}"
    return " ".join(words)


def test_copies_with_edits_of_their_own(spark, monkeypatch):
    """Groups whose members are not linked to one pivot: blocks give links that join components, never all pairs."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 40)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(80)]
    apart = [edited(base, rng, 2) for _ in range(150)]
    chains = [" ".join(f"c{i + j}" for i in range(100)) for j in range(0, 120, 4)]
    data = list(enumerate(rng.sample(apart + chains, len(apart) + len(chains))))
    made = []
    stage = near_duplicates.stage
    monkeypatch.setattr(near_duplicates, "stage", lambda df, label: made.append((label, stage(df, label))) or made[-1][1])
    found = near_duplicates.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"))
    found = found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    assert by_id(found, "n_shingles", "component_id", "kept") == brute.near_duplicates(data)
    rows = {label: df.count() for label, df in made}
    assert rows["links"] < 2 * len(data) and rows["compared"] < 20 * len(data)
    # with the text they were made from all hang together at once
    data.append((999, " ".join(base)))
    found = near_duplicates.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"))
    found = found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    assert by_id(found, "n_shingles", "component_id", "kept") == brute.near_duplicates(data)


def test_rows_are_judged_one_by_one(spark):
    rng = random.Random(13)
    base = [f"w{i}" for i in range(100)]
    a, other = " ".join(base), " ".join(f"v{i}" for i in range(50))
    near, bridge = edited(base, rng, 2), " ".join(base[7:] + [f"x{i}" for i in range(7)])
    far = " ".join(base[14:] + [f"x{i}" for i in range(14)])
    docs = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    kept = lambda rows: sorted(map(tuple, near_duplicates.keep_first(docs(rows)).collect()), key=str)
    assert kept([(3, a), (7, near), (7, other)]) == [(3, a), (7, other)]
    assert kept([(3, a), (3, a), (3, near), (4, near)]) in ([(3, a)], [(3, near)])
    assert kept([(3, a), (None, near), (None, other), (None, ""), (5, ""), (5, None)]) == sorted([(3, a), (None, other), (None, ""), (5, ""), (5, None)], key=str)
    found = near_duplicates.near_duplicates(docs([(3, a), (None, near)])).collect()
    assert {r.component_id for r in found} == {3}
    assert brute.near_duplicates([(1, a), (2, far)])[2][1] == 2 and brute.near_duplicates([(1, a), (2, far), (3, bridge)])[2][1] == 1
    joined = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs([(1, a), (2, far), (None, bridge)])).collect()}
    assert joined == {1: 1, 2: 1, None: 1}


def test_near_duplicates_of_odd_rows(odd):
    found = near_duplicates.near_duplicates(odd)
    assert found.count() == odd.count() and near_duplicates.near_duplicates(odd.limit(0)).count() == 0
    alone = {r.doc_id: r.component_id for r in found.collect() if r.n_shingles == 0}
    assert alone == {0: 0, 1: 1, 2: 2}
    assert near_duplicates.keep_first(odd).columns == odd.columns


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1064)]
    links = [x for x in links if x[0] != x[1]]
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    found = components.connected(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {x: find(x) for x in parent} and len(found) == len(parent)


def test_a_round_of_components_shuffles_four_times(spark, monkeypatch):
    plans, write = [], components._write

    def written(edges):
        edges.collect()
        plans.append(edges._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0])
        return write(edges)

    monkeypatch.setattr(components, "_write", written)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = components.connected(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.component for r in found} == {0} and len(found) == 41
    assert len(plans) > 2 and all(len(re.findall(r"[+:]- Exchange hash", p)) <= 4 for p in plans)


def test_contamination(spark, sf, rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert by_id(registered.op10_decontaminate(spark, sf), *names) == brute.contamination(rows, items)


def test_contamination_by_short_and_odd_items(spark, odd):
    data = [(1, "a b c D e f g h i j k l"), (2, None), (3, ""), (4, "zz yy"), (5, "q ZZ-yy"), (6, "a b c d e f g h i x j")]
    items = [(1, "x b c d e f g h i j k"), (2, "zz, yy"), (3, None), (4, ""), (2, "j k l")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    want = {d: (n, hit, k) for d, (n, hit, k, _, _) in brute.contamination(data, items).items()}
    for bound in (0, 1_000_000):
        found = decontaminate.contamination(docs, bench, max_broadcast=bound)
        assert by_id(found.withColumn("n", F.size("item_ids")), "n_words", "n_hit", "n") == want
    assert decontaminate.contamination(odd, bench).count() == odd.count()
    assert decontaminate.contamination(odd, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.drop_contaminated(odd, bench).columns == odd.columns
    assert decontaminate.drop_contaminated(odd.limit(0), bench).count() == 0


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    steps = dict(corpus_pipeline.STAGES)
    kept = corpus_pipeline.stage(steps["toxicity"](spark, docs, sf), "t")
    assert set(texts(kept)) <= set(texts(docs)) and kept.columns == columns
    lines = corpus_pipeline.stage(steps["line_dedup"](spark, kept, sf), "t")
    assert texts(lines) == {d: t for d, (_, _, t) in brute.line_dedup(texts(kept).items()).items()} and lines.columns == columns
    single = corpus_pipeline.stage(steps["near_duplicates"](spark, lines, sf), "t")
    want = brute.near_duplicates(texts(lines).items())
    assert texts(single) == {d: t for d, t in texts(lines).items() if want[d][2]} and single.columns == columns
    clean = corpus_pipeline.stage(steps["decontamination"](spark, single, sf), "t")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hit = brute.contamination(texts(single).items(), items)
    assert texts(clean) == {d: t for d, t in texts(single).items() if not hit[d][4]} and clean.columns == columns
    packed = steps["packing"](spark, clean, sf)
    assert {r.doc_id for r in packed.collect()} == set(texts(clean))


def test_pipeline_of_odd_rows(spark, odd, sf):
    for rows in (odd, odd.limit(0)):
        docs = rows
        for name, step in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage(step(spark, docs, sf), name)
        assert docs.count() >= 0


def test_native_operators_run_no_python(spark, sf):
    for name in ("op6_licenses", "op10_decontaminate"):
        plan = registered.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow", "CartesianProduct", "NestedLoop"))


@pytest.mark.parametrize("name", sorted(registered.SQL))
def test_queries_equal_their_sql(spark, sf, name):
    from tests.compare import compare, connect

    ok, note = compare(spark, connect(sf), sf, name, registered.QUERIES[name], registered.SQL[name])
    assert ok, note
