import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tertulia.functions import sequences, text
from tertulia.functions.words import stopword_list


def run(spark, fn, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.r for r in df.select("i", fn(F.col("s")).alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("step", "given", "wanted"),
    [
        (text.strip_at_tokens, "hola a@b.com fin @user x", "hola fin x"),
        (text.strip_urls, "visita hola.mundo esto desaparece, pero esto no", "visita , pero esto no"),
        (text.strip_urls, "ver https://t.co/a1 ya! HOLA.es fin", "ver ! HOLA.es fin"),
        (text.strip_tickers, "RT sube $GE hoy", "RT sube  hoy"),
        (text.strip_rt, "RT sube  hoy", "sube  hoy"),
        (text.collapse_space, "a \n\t b c d", "a b c d"),
        (text.strip_quotes, "l'été d’été", "lété d’été"),
        (text.collapse_repeats, "no no, no gol gol  gol #gol gol", "no, no gol  gol #gol"),
        (text.fold_tildes, "niño café", "niño cafe"),
        (text.tokenize, "abc123def _x a niño", ["abc", "def", "nino"]),
        (text.tokenize, "café Ａ", ["cafe"]),
        (text.extract_hashtags, "#Uno\n#dos_2 # #más", ["#Uno", "#dos_2", "#más"]),
    ],
)
def test_steps(spark, step, given, wanted):
    assert run(spark, step, given) == [wanted]


def test_comma_keeps_words_apart(spark):
    both = lambda c: text.collapse_repeats(text.strip_punct(c))
    assert run(spark, both, "no, no") == ["no  no"]


def test_strict_urls_keep_the_following_words(spark):
    assert run(spark, lambda c: text.strip_urls(c, strict=True), "ver hola.mundo/x ya") == ["ver  ya"]


def test_long_phrases_vanish_when_tokenised_again(spark):
    assert run(spark, lambda c: text.retokenize(F.split(c, " ")), "palabra_larga_frase corta_frase") == [["corta_frase"]]


# The patterns of the chain in Python's notation, before and after lower-casing.
EARLY = {
    r"\S*@\S*\s?": "",
    r"\s+": " ",
    r"'": "",
    r"(https?:\/\/)?([\da-z\.-]+)\.([a-z\.]{2,6})([\/\w \.-]*)": "",
    r"\$\w*": "",
    r"^RT[\s]+": "",
}
LATE = {
    r"""[¡!"$%&'()*+,\-./:;<=>?\[\\\]`{|}~]""": " ",
    r"\b(\w+)( \1\b)+": r"\1",
}


def plain_chain(text):
    """The same tokens with Python's regular expressions and its Unicode tables."""
    for pattern, new in EARLY.items():
        text = re.sub(pattern, new, text)
    text = text.lower().translate(str.maketrans("áéíóúü", "aeiouu"))
    for pattern, new in LATE.items():
        text = re.sub(pattern, new, text)
    bare = "".join(ch for ch in unicodedata.normalize("NFD", text) if unicodedata.category(ch) != "Mn")
    runs = re.split(r"\W|\d", unicodedata.normalize("NFC", bare))
    return [run for run in runs if len(run) in range(2, 16) and run[0] != "_"]


def test_chain_on_random_text(spark):
    rng = random.Random(7)
    parts = ["hola", "Más", "no", "no", "a@b.c", "@x", "#gol", "gol", "$GE", "http://t.co/x", "t.co", "RT", "ñandú", "x_y", "_z",
             "12ab34", "…", "’", "¿qué?", "a.b-c.de/f", "\n", "\t", " ", ",", ".", "'", "été", "ÜBER", "½x", "٣", "été.es", "https://", "Ab.cd"]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", " ", "", "\n"]) for _ in range(rng.randint(0, 25))) for _ in range(800)]
    assert run(spark, text.clean_text, *texts) == [plain_chain(t) for t in texts]


def test_long_texts_do_not_break_the_patterns(spark):
    longest = ["no " * 30_000, "a" * 300_000, "a." * 60_000 + "!", "x@" * 50_000, "ab" * 100_000 + "@c"]
    wanted = [["no"], [], [], [], []]
    assert run(spark, text.clean_text, *longest) == wanted


def test_merge_at(spark):
    rows = [(0, list("abcab"), [0, 3]), (1, ["x"], []), (2, list("abcdef"), [1, 3])]
    df = spark.createDataFrame(rows, "i int, t array<string>, s array<int>")
    out = df.select("i", sequences.merge_at(F.col("t"), F.col("s")).alias("m")).orderBy("i").collect()
    assert [r.m for r in out] == [["a_b", "c", "a_b"], ["x"], ["a", "b_c", "d_e", "f"]]


def test_stop_words(spark):
    plain, folded = stopword_list("spanish", ["solo"]), stopword_list("spanish", ["solo"], fold=True)
    assert "también" in plain and "tambien" not in plain and plain[-1] == "solo"
    assert "tambien" in folded and len(folded) == len(set(folded))
