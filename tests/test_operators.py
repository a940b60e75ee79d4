import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tertulia.operators import dedupe, naming, profile, relevance, timeline
from tertulia.operators import tokens as tk
from tertulia.session import lookup_join


def token_table(spark, lists, topic=0):
    return spark.createDataFrame([(i, topic, w) for i, w in enumerate(lists)], "post_id long, topic int, processed array<string>")


def words(df):
    return [r.processed for r in df.orderBy("post_id").collect()]


def test_first_row_of_each_text_stays(spark):
    rows = [(i, "spam" if i % 3 == 1 else (None if i % 7 == 0 else f"t{i // 2}")) for i in range(600)]
    df = spark.createDataFrame(rows, "post_id long, content string").repartition(7)
    got = sorted(tuple(r) for r in dedupe.dedupe_content(df).collect())
    first = {}
    for i, t in rows:
        if t is not None:
            first.setdefault(t, i)
    assert got == sorted((i, t) for t, i in first.items())
    again = dedupe.dedupe_content(spark.createDataFrame(got, "post_id long, content string"))
    assert again.count() == len(got)


def test_empty_token_lists_count_as_equal(spark):
    df = token_table(spark, [[], ["a"], [], ["a"], ["a", "b"]])
    assert sorted(r.post_id for r in dedupe.dedupe_tokens(df).collect()) == [0, 1, 4]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumnRenamed("id", "post_id")
    for draw in (lambda d: dedupe.sample_fraction(d, 0.3), lambda d: dedupe.sample_n(d, 100)):
        a = {r.post_id for r in draw(df.repartition(3)).collect()}
        assert a == {r.post_id for r in draw(df.repartition(11)).collect()}
    assert 1350 < dedupe.sample_fraction(df, 0.3).count() < 1650
    assert dedupe.sample_n(df, 100).count() == 100


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("2025-04-01 10:00:00",), ("1/4/2025",), (None,)], "date string")
    assert [r.date is None for r in profile.parse_date(df).collect()] == [False, True, True]


def test_missing_column_is_an_error(spark):
    with pytest.raises(KeyError):
        profile.normalize_columns(spark.range(1), {"Autor": "author"})


def greedy(tokens, phrases):
    out, i = [], 0
    while i < len(tokens):
        if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) in phrases:
            out.append(f"{tokens[i]}_{tokens[i + 1]}")
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return out


@pytest.mark.parametrize("bound, in_row", [(1, 100), (1_000_000, 0), (1, 0)])
def test_phrases_merge_greedily(spark, bound, in_row, monkeypatch):
    monkeypatch.setattr(tk, "lookup_join", lambda *a: lookup_join(*a, max_rows=bound))
    rng = random.Random(3)
    lists = [[rng.choice("abc") for _ in range(rng.randint(0, 30))] for _ in range(300)] + [list("abcab"), []]
    pairs = {("a", "b"), ("b", "b"), ("b", "c"), ("c", "a")}
    phrases = spark.createDataFrame(sorted(pairs), "a string, b string")
    merged = tk.apply_phrases(token_table(spark, lists), phrases, max_phrases=in_row)
    assert words(merged) == [greedy(t, pairs) for t in lists]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" not in plan and "Generate" not in plan) == (in_row > 0)
    none = tk.apply_phrases(token_table(spark, lists), phrases.limit(0), max_phrases=in_row)
    assert words(none) == lists


def test_phrases_with_any_character(spark):
    pairs = {("a\u0000b", "c"), ("'", '"'), ("\\", "é😀"), ("", "x")}
    lists = [[*p, *p] for p in pairs] + [["a", "b\u0000c"], ["a\u0000b", "c", "c"], ["x", "x"]]
    phrases = spark.createDataFrame(sorted(pairs), "a string, b string")
    assert words(tk.apply_phrases(token_table(spark, lists), phrases)) == [greedy(t, pairs) for t in lists]


def test_phrase_scores(spark):
    rng = random.Random(5)
    lists = [rng.choices(["a", "b", "c", "d"] + [f"w{i}" for i in range(200)], k=20) + ["new", "york"] for _ in range(100)]
    uni = Counter(w for t in lists for w in t)
    bi = Counter(p for t in lists for p in zip(t, t[1:]))
    size = len(uni) + len(bi)
    wanted = {p: (n - 5) / (uni[p[0]] * uni[p[1]]) * size for p, n in bi.items()}
    got = {(r.a, r.b): r.score for r in tk.phrase_model(token_table(spark, lists), threshold=1.0).collect()}
    assert got == pytest.approx({p: s for p, s in wanted.items() if s > 1.0})
    assert ("new", "york") in got


@pytest.mark.parametrize("bound", [1_000_000, 1])
def test_lexicon_replaces_and_drops(spark, bound, monkeypatch):
    monkeypatch.setattr(tk, "lookup_join", lambda *a: lookup_join(*a, max_rows=bound))
    lex = spark.createDataFrame([("los", "DET", "el"), ("gatos", "NOUN", "gato"), ("comen", "VERB", "comer")], "form string, pos string, lemma string")
    df = token_table(spark, [["los", "gatos", "comen", "gatos", "zzz"], ["los"], []])
    assert words(tk.lemma_pos_filter(df, lex)) == [["gato", "comer", "gato", "zzz"], [], []]
    wide = df.selectExpr("'x' AS pos", "post_id", "post_id AS _at", "processed", "CAST(NULL AS int) AS topic")
    kept = tk.lemma_pos_filter(wide, lex)
    assert kept.columns == wide.columns and words(kept) == [["gato", "comer", "gato", "zzz"], [], []]
    assert {(r.pos, r._at == r.post_id, r.topic) for r in kept.collect()} == {("x", True, None)}


def test_emoji_become_words(spark):
    table = spark.createDataFrame([("😀", "cara"), ("👍🏽", "pulgar_medio"), ("👍", "pulgar"), ("🇨🇴", "colombia")], "emoji string, alias string")
    df = spark.createDataFrame([(0, "hola 😀😀 👍🏽 👍 🇨🇴 🚀"), (1, "nada"), (2, None)], "post_id long, content string")
    got = [r.content for r in tk.demojize(df, table).orderBy("post_id").collect()]
    assert got == ["hola :cara::cara: :pulgar_medio: :pulgar: :colombia: 🚀", "nada", None]
    clean = tk.clean_posts(df.where("post_id < 2"), emoji=table)
    assert words(clean) == [["hola", "cara", "cara", "pulgar_medio", "pulgar", "colombia"], ["nada"]]


def test_vocabulary_and_bag(spark):
    df = token_table(spark, [["a", "b", "a"], ["a"], []])
    assert {(r.term, r.cf, r.df) for r in tk.vocabulary(df).collect()} == {("a", 3, 2), ("b", 1, 1)}
    assert {tuple(r) for r in tk.bag_of_words(df).collect()} == {(0, "a", 2), (0, "b", 1), (1, "a", 1)}


def test_timeline_has_an_empty_word_per_post(spark):
    df = spark.createDataFrame([("d", 0, "uno dos"), (None, 0, "x")], "date string, topic int, processed string")
    assert [r.word for r in timeline.words_topic_timeline(df).collect()] == ["uno", "dos", ""]
    top = timeline.top_words_per_topic(timeline.words_topic_timeline(df), 1)
    assert [tuple(r) for r in top.collect()] == [(0, "dos", 1, 1)]


def test_weight_scale(spark):
    df = spark.createDataFrame([(0, 0.01), (0, 0.0333), (1, 0.9)], "topic int, importance double")
    assert {tuple(r) for r in timeline.topic_weight_scale(df).collect()} == {(0, 0.038), (1, 1.0)}


def test_unused_terms_count_zero(spark):
    terms = spark.createDataFrame([(0, "a", 0.5, 1), (0, "z", 0.1, 2)], "topic int, word string, weight double, rank int")
    counts = spark.createDataFrame([("a", 7), ("b", 9)], "word string, n long")
    assert [tuple(r) for r in relevance.word_relevance(terms, counts).collect()] == [("z", 0, 0.1, 0), ("a", 0, 0.5, 7)]


def test_replies(spark):
    replies = ['```json\n{"0":"x"}\n```', "not json", '{"0":"a","1":"b"}', "```\n{\"0\": \"y\"}```", '["x"]']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, reply string")
    got = naming.parse_topic_names(df, k=1).orderBy("i").collect()
    assert [r.names for r in got] == [{"0": "x"}, None, {"0": "a", "1": "b"}, {"0": "y"}, None]
    assert [r.complete for r in got] == [True, False, False, True, False]


def test_prompt_holds_every_topic(spark):
    terms = spark.createDataFrame([(t, f"w{t}", 0.5, 1) for t in range(12)], "topic int, word string, weight double, rank int")
    prompt = naming.topic_prompt(terms, "salud").first().prompt
    assert "salud" in prompt and "12 topics" in prompt and all(f'"{t}": [{{"word":"w{t}"' in prompt for t in range(12))
    assert naming.default_labels(terms).count() == 12


def test_lookup_join_both_ways(spark):
    rows = spark.range(2000).select(F.col("id").alias("post_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("w"))
    table = spark.createDataFrame([("hot", 1), ("3", 2)], "w string, v int")
    for how in ("left", "inner", "left_semi"):
        small = lookup_join(rows, table, ["w"], how, "post_id")
        large = lookup_join(rows, table, ["w"], how, "post_id", max_rows=1, salts=5)
        assert sorted(map(str, small.collect())) == sorted(map(str, large.select(small.columns).collect()))


def test_flags_tones_and_families_become_words(spark):
    """With the default names: the longest match of the table, else the parts; the order of the text stays."""
    from tertulia.sources.emoji import unicode_aliases

    texts = {
        "hola \U0001F1E8\U0001F1F4 fin": "hola :flag_co: fin",
        "\U0001F468\u200D\U0001F469\u200D\U0001F467": ":man::woman::girl:",
        "ok \U0001F44D\U0001F3FD\U0001F44D": "ok :thumbs_up_sign::medium_skin_tone::thumbs_up_sign:",
        "\u2764\uFE0F x": ":heavy_black_heart: x",
        "no emoji": "no emoji",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "post_id long, content string")
    got = tk.demojize(df, unicode_aliases(spark)).orderBy("post_id").collect()
    assert [r.content for r in got] == list(texts.values())
    own = spark.createDataFrame([("\U0001F44D\U0001F3FD", "pulgar"), ("\U0001F44D", "otro")], "emoji string, alias string")
    got = tk.demojize(spark.createDataFrame([(1, "a\U0001F44D\U0001F3FDb\U0001F44D\U0001F3FFc\U0001F600")], "post_id long, content string"), own)
    assert got.first().content == "a:pulgar:b:otro:\U0001F3FFc\U0001F600"
    words = tk.clean_posts(df, emoji=unicode_aliases(spark)).orderBy("post_id").collect()
    assert words[0].processed == ["hola", "flag_co", "fin"] and words[1].processed == ["man", "woman", "girl"]


def test_repeated_posts_are_counted_by_digest(spark):
    from tertulia.operators import profile

    texts = ["b", "a", "b", None, "", "a", "b", "é"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "post_id long, content string, count string")
    counts = profile.repeated_posts(df)
    assert [tuple(r) for r in counts.collect()] == [("b", 3), ("a", 2), ("", 1), ("é", 1)]
    assert [tuple(r) for r in profile.repeated_posts_top(df, 1).collect()] == [("b", 3)]
    grouped = [line for line in counts._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in line]
    assert len(grouped) == 1 and "Aggregate [_groupingexpression" in grouped[0]
    assert profile.repeated_posts(df.limit(0)).count() == 0


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_phrase_counts_clean_once(spark):
    from tertulia.operators import tokens as tk

    posts = spark.createDataFrame([(1, "uno dos uno dos"), (2, "uno"), (3, None)], "post_id long, content string")
    got = tk.phrase_counts(tk.clean_posts(posts))
    assert "regexp" not in plan(got)
    assert {tuple(r) for r in got.collect()} == {("uno", None, 3), ("dos", None, 2), ("uno", "dos", 2), ("dos", "uno", 1)}


def test_rare_pairs_are_counted_not_stored(spark, monkeypatch):
    from tertulia.operators import tokens as tk

    stored = {}
    monkeypatch.setattr(tk, "stage", lambda df, label, keep=tk.stage: stored.setdefault(label, keep(df, label)))
    lists = [["a", "b"]] * 8 + [[f"x{i}", f"y{i}"] for i in range(50)] + [["a"], [], None]
    got = tk.phrase_model(token_table(spark, lists), min_count=5, threshold=0.0).collect()
    # 102 words and 51 pairs
    assert [(r.a, r.b, r.n, r.score) for r in got] == [("a", "b", 8, pytest.approx((8 - 5) / (9 * 8) * 153))]
    assert stored["followers"].count() == 2


def test_tokens_of_bad_length_are_never_made(spark):
    from tertulia.functions import text

    rows = spark.createDataFrame([("a bb " + "c" * 15 + " " + "d" * 16 + " _ee ñu1xx\u216f\u216f " + "é" * 40,)], "t string")
    got = rows.select(text.tokenize(F.col("t"), False).alias("w"))
    assert got.first().w == ["bb", "c" * 15, "ñu", "xx\u217f\u217f"] and "filter" not in plan(got)


def test_an_export_folder_is_written_in_as_many_files_as_there_are_parts(spark, sf, monkeypatch):
    from tertulia.plans import queries
    from tertulia.sources import files

    seen, write = [], files.write_csv
    monkeypatch.setattr(files, "write_csv", lambda df, path: seen.append(plan(df)) or write(df, path))
    queries.queries()["scan_csv_dir"](spark, sf)
    assert "Repartition 4" not in seen[0]
