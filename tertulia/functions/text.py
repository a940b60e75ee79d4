r"""The cleaning chain as native column expressions.

Java's ``\w``, ``\s``, ``\d`` and ``\b`` only know ASCII, so every class is spelled out with Unicode properties. The
patterns keep matching linear in the length of the text: runs are entered only at their first character, and no group is
repeated (a repeated group recurses in the JVM and overflows the stack on long repetitions).
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Classes name the frequent ASCII letters first, and patterns look for printable ASCII before they try a long class: most
# characters are decided by one comparison.
WORD = r"a-z\p{L}\p{N}_"
# White space other than the blank: control characters, then Unicode's space, line and paragraph separators.
ODD_SPACE = r"\t\n\x0B\f\r\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
SPACE = " " + ODD_SPACE

# The accented vowels folded by the chain, and their replacements.
VOWELS_FROM, VOWELS_TO = "áéíóúü", "aeiouu"
# The letters folded before words are counted on the timelines (ñ stays).
TILDES_FROM, TILDES_TO = "áéíóú", "aeiou"
# The special characters that become a space, as a character class.
SPECIAL = r"""[¡!"$%&'()*+,\-./:;<=>?\[\\\]`{|}~]"""
# Shortest and longest token kept.
MIN_LEN, MAX_LEN = 2, 15


def _accent_table() -> tuple[str, str]:
    """Every character that Unicode decomposes to one base character plus combining marks, with that base."""
    source, target = [], []
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        parts = unicodedata.normalize("NFD", ch)
        if parts == ch:
            continue
        base = unicodedata.normalize("NFC", "".join(p for p in parts if unicodedata.category(p) != "Mn"))
        if len(base) == 1 and base != ch:
            source.append(ch)
            target.append(base)
    return "".join(source), "".join(target)


def _combining_marks() -> str:
    return "".join(ch for ch in map(chr, range(0x300, sys.maxunicode + 1)) if unicodedata.category(ch) == "Mn")


COMBINING_MARKS = _combining_marks()
ACCENTS_FROM, ACCENTS_TO = _accent_table()


def _where_present(c: Column, mark: str, step: Callable[[Column], Column]) -> Column:
    """Apply a regular expression only to texts that hold ``mark``; ``c`` is bound once and not evaluated again."""
    bound = F.transform(F.array(c), lambda x: F.when(F.contains(x, F.lit(mark)), step(x)).otherwise(x))
    return F.get(bound, F.lit(0))


def extract_hashtags(c: Column) -> Column:
    """All hashtags in order, case kept; a line break ends a tag."""
    return F.regexp_extract_all(c, F.lit(rf"#[{WORD}]+"), F.lit(0))


def strip_at_tokens(c: Column) -> Column:
    """Remove every token with an ``@`` (e-mail addresses and mentions) and one space after it."""
    token = rf"(?<![!-~])(?<![^{SPACE}])[^{SPACE}@]*+@[^{SPACE}]*+[{SPACE}]?"
    return _where_present(c, "@", lambda x: F.regexp_replace(x, F.lit(token), F.lit("")))


def collapse_space(c: Column) -> Column:
    """Runs of white space become one blank. Single blanks, the common case, are not touched."""
    return F.regexp_replace(c, F.lit(rf"(?![!-~])(?:[{ODD_SPACE}][{SPACE}]*+| [{SPACE}]++)"), F.lit(" "))


def strip_quotes(c: Column) -> Column:
    return F.replace(c, F.lit("'"), F.lit(""))


def strip_urls(c: Column, strict: bool = False) -> Column:
    """Remove URL-like text.

    By default the path part may hold spaces and so takes the words after an address with it; this matches the results
    users have today. ``strict`` ends an address at the first space.
    """
    host = r"[\p{Nd}a-z.\-]"
    path = rf"[/{WORD}.\-]" if strict else rf"[/{WORD} .\-]"
    # a run without a dot is left at once
    url = rf"(?:https?://|(?<!{host}))(?=[\p{{Nd}}a-z\-]*+\.){host}+\.[a-z.]{{2,6}}{path}*"
    return _where_present(c, ".", lambda x: F.regexp_replace(x, F.lit(url), F.lit("")))


def strip_tickers(c: Column) -> Column:
    return _where_present(c, "$", lambda x: F.regexp_replace(x, F.lit(rf"\$[{WORD}]*"), F.lit("")))


def strip_rt(c: Column) -> Column:
    return F.regexp_replace(c, F.lit(rf"^RT[{SPACE}]+"), F.lit(""))


def lower_text(c: Column) -> Column:
    return F.lower(c)


def fold_vowels(c: Column) -> Column:
    # byte by byte: translating makes an object of each character
    for old, new in zip(VOWELS_FROM, VOWELS_TO):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def strip_punct(c: Column) -> Column:
    return F.regexp_replace(c, F.lit(SPECIAL), F.lit(" "))


def collapse_repeats(c: Column) -> Column:
    """Keep one of several equal words in a row, when exactly one blank separates them."""
    repeated = rf"(?<![{WORD}])([{WORD}]++) (?=\1(?![{WORD}]))"
    return F.regexp_replace(c, F.lit(repeated), F.lit(""))


def fold_accents(c: Column) -> Column:
    """Drop all accents: precomposed letters become their base, loose combining marks vanish."""
    folded = lambda x: F.translate(x, ACCENTS_FROM + COMBINING_MARKS, ACCENTS_TO)
    bound = F.transform(F.array(c), lambda x: F.when(F.octet_length(x) > F.length(x), folded(x)).otherwise(x))
    return F.get(bound, F.lit(0))


def tokenize(c: Column, deaccent: bool = True) -> Column:
    """Lower-case runs of letters (digits split them), 2 to 15 characters long, not starting with ``_``."""
    text = F.lower(c)
    if deaccent:
        text = fold_accents(text)
    kind = r"[a-z\p{L}\p{Nl}\p{No}_]"
    return F.regexp_extract_all(text, F.lit(rf"(?<!{kind})(?!_){kind}{{{MIN_LEN},{MAX_LEN}}}+(?!{kind})"), F.lit(0))


def retokenize(tokens: Column) -> Column:
    """Tokenise a token list again, accents kept: merged phrases over 15 characters disappear here."""
    return tokenize(F.array_join(tokens, " "), deaccent=False)


def clean_before_emoji(c: Column, strict_urls: bool = False) -> Column:
    """The steps of the chain that come before emoji are named."""
    c = strip_quotes(collapse_space(strip_at_tokens(c)))
    c = strip_tickers(strip_urls(c, strict_urls))
    return fold_vowels(lower_text(strip_rt(c)))


def clean_after_emoji(c: Column) -> Column:
    """The steps of the chain that come after emoji are named; gives the token list."""
    return tokenize(collapse_repeats(strip_punct(c)))


def clean_text(c: Column, strict_urls: bool = False) -> Column:
    """The whole chain without emoji names: text to token list."""
    return clean_after_emoji(clean_before_emoji(c, strict_urls))


def fold_tildes(c: Column) -> Column:
    return F.translate(c, TILDES_FROM, TILDES_TO)


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def split_tokens(c: Column) -> Column:
    return F.split(c, " ")
