"""Names for emoji."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession

_BLOCKS = [(0x2300, 0x23FF), (0x2600, 0x27BF), (0x2B00, 0x2BFF), (0x1F000, 0x1FAFF)]


# The five skin tones, U+1F3FB to U+1F3FF.
_TONES = ["light_skin_tone", "medium_light_skin_tone", "medium_skin_tone", "medium_dark_skin_tone", "dark_skin_tone"]


def unicode_aliases(spark: SparkSession) -> DataFrame:
    """``(emoji, alias)`` from the English Unicode names; flags are named by their two letters, skin tones by their tone.

    Joined sequences are named by their parts. Supply a table of your own for other names or languages.
    """
    chars = (chr(code) for low, high in _BLOCKS for code in range(low, high + 1))
    named = ((ch, unicodedata.name(ch, "")) for ch in chars)
    rows = {ch: name.lower().replace(" ", "_").replace("-", "_") for ch, name in named if name}
    letters = [chr(0x1F1E6 + i) for i in range(26)]
    rows |= {a + b: f"flag_{chr(97 + i)}{chr(97 + j)}" for i, a in enumerate(letters) for j, b in enumerate(letters)}
    rows |= {chr(0x1F3FB + i): tone for i, tone in enumerate(_TONES)}
    return spark.createDataFrame(list(rows.items()), "emoji string, alias string")
