"""License notices inside documents, retrieved by MinHash bands over text windows; DataFrame functions only.

Templates fall into classes by length: class ``C`` holds those of more than ``C / 2`` and at most ``C`` words. For a class a
document is cut into blocks of ``C / 2`` words, and every three neighbouring blocks are a window, so a passage of ``C``
words lies whole inside one. A window with at least ``CONTAINED`` of a template's shingles has a Jaccard similarity of
1/8 or more with it (the worst case is a template of a single shingle). Signatures have ``BANDS`` bands of one MinHash
value: such a window misses all of them with a probability below (7/8) ** 128 = 4e-8. What the bands retrieve is verified
by exact containment of the template's shingles in the window.

Only windows that hold some shingle of some template can share a MinHash value with one. They are found first, by a join
on shingles, and all others are left alone; this loses nothing.

Templates of fewer than ``SHINGLE`` words have no shingle. They are found word for word, by a join on their first word.

Headers of one family differ in a name or a version only, which containment forgives. Templates can name phrases that
tell them apart; all shingles of these must be in the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.llm.decontaminate import held, keyed, word_hashes
from tertulia.session import lookup_join, stage

SHINGLE = 5
BANDS = 128
CONTAINED = 0.8
SMALLEST = 8


def _grams(words: Column) -> Column:
    """A hash for each run of ``SHINGLE`` words; null where there are fewer words."""
    last = F.size(words) - SHINGLE
    grams = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]))
    return F.when(last >= 0, grams)


def _shingles(df: DataFrame) -> DataFrame:
    """``df`` with the shingles ``g`` in place of the words ``h``."""
    return held(df, "g", _grams(F.col("h"))).drop("h")


def _telling(phrases: Column) -> Column:
    """The shingles of all phrases."""
    return F.array_distinct(F.flatten(F.transform(F.coalesce(phrases, F.array()), lambda p: F.coalesce(_grams(word_hashes(p)), F.array()))))


def _bands(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a row per band and its MinHash value over the shingles in ``name``."""

    def least(seed: int) -> Column:
        return F.array_min(F.transform(name, lambda x: F.xxhash64(x, F.lit(seed))))

    values = [least(i) for i in range(BANDS)]
    return df.select("*", F.posexplode(F.array(*values)).alias("band", "least"))


def _short(rows: DataFrame, short: DataFrame, max_broadcast: int) -> DataFrame:
    """``(id, license, containment)`` for the short templates that occur word for word."""
    starts = short.groupBy(F.get("h", F.lit(0)).alias("x")).agg(F.collect_set(F.struct("license", "h")).alias("starts"))
    hashed = held(rows, "h", word_hashes(F.col("text"))).drop("text")
    runs = F.transform("h", lambda w, i: F.struct(w.alias("x"), F.slice("h", i + 1, SHINGLE - 1).alias("words")))
    spots = hashed.select("id", "k1", F.explode(runs).alias("r")).select("id", "k1", "r.x", "r.words")
    met = lookup_join(spots, starts, ["x"], "inner", salt_by="k1", max_rows=max_broadcast)
    here = F.filter("starts", lambda t: F.slice("words", F.lit(1), F.size(t["h"])) == t["h"])
    return met.select("id", F.explode(F.transform(here, lambda t: t["license"])).alias("license")).distinct().withColumn("containment", F.lit(1.0))


def scan(
    docs: DataFrame, templates: DataFrame, key: str = "doc_id", text: str = "text", license_key: str = "license_id", template_text: str = "template",
    must: str | None = None, max_broadcast: int = 1_000_000,
) -> DataFrame:
    """``(key, license_id, containment)``: a row for each document and license found in it, with the largest containment.

    Words are compared without case and punctuation. Null and empty texts have no license; templates of fewer than
    ``SHINGLE`` words must occur word for word, and those without words are found nowhere. Rows that repeat an id give one result together, and rows without an id are one
    document called null. A license may have several templates. ``must`` names a column with the phrases that a template of
    ``SHINGLE`` words or more cannot do without; phrases of fewer words and null ask for nothing. Other columns are ignored.
    """
    rows = keyed(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), "id", "text")
    telling = _telling(F.col(must) if must else F.array().cast("array<string>")).alias("must")
    known = templates.select(F.col(license_key).alias("license"), word_hashes(F.col(template_text)).alias("h"), telling)
    short = stage(known.filter((F.size("h") > 0) & (F.size("h") < SHINGLE)).select("license", "h").distinct(), "short-templates")
    size = F.greatest(F.lit(SMALLEST), F.pow(F.lit(2), F.ceil(F.log2(F.size("h")))).cast("int"))
    known = _shingles(known.filter(F.size("h") >= SHINGLE).withColumn("c", size))
    known = stage(known.select("license", "c", F.array_distinct("g").alias("g"), "must").distinct(), "templates")
    # one power of two per length of templates, so a handful
    classes = [r["c"] for r in known.select("c").distinct().collect()] or [SMALLEST]

    # windows with some shingle of a template
    some = known.select(F.explode("g").alias("x")).distinct()
    hashed = _shingles(held(rows, "h", word_hashes(F.col("text"))).drop("text", "id"))
    spots = lookup_join(hashed.select("k1", "k2", F.posexplode("g").alias("at", "x")), some, ["x"], "left_semi", salt_by="k1", max_rows=max_broadcast)
    spots = stage(spots.select("k1", "k2", "at").distinct(), "license-spots")
    block = F.floor(F.col("at") / (F.col("c") / 2)).cast("int")
    per_class = spots.select("*", F.explode(F.array(*[F.lit(c) for c in classes])).alias("c"))
    windows = per_class.select("k1", "k2", "c", F.explode(F.sequence(F.greatest(block - 2, F.lit(0)), block)).alias("block"))
    wanted = windows.groupBy("k1", "k2").agg(F.collect_set(F.struct("c", "block")).alias("wanted"))
    texts = keyed(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), "id", "text")
    near = lookup_join(texts, spots.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi", salt_by="k2", max_rows=max_broadcast)
    near = _shingles(held(near.dropDuplicates(["k1", "k2"]), "h", word_hashes(F.col("text"))).drop("text"))
    both = near.join(wanted, ["k1", "k2"])
    # three blocks hold 3 * c / 2 words
    cut = F.transform(
        "wanted",
        lambda w: F.struct(
            w["c"].alias("c"),
            F.array_distinct(F.slice("g", w["block"] * (w["c"] / 2).cast("int") + 1, (w["c"] * 3 / 2).cast("int") - SHINGLE + 1)).alias("s"),
        ),
    )
    cut = stage(both.select("id", F.explode(cut).alias("w")).select("id", "w.c", F.col("w.s").alias("s")).filter("size(s) > 0"), "license-windows")

    # retrieval by bands, verification by containment
    template_bands = _bands(known, "g").select("c", "band", "least", "license", F.col("g").alias("t"), "must")
    found = _bands(cut.select("id", "c", "s"), "s").join(template_bands, ["c", "band", "least"]).drop("band", "least")
    share = F.size(F.array_intersect("s", "t")) / F.size("t")
    whole = found.filter(F.size(F.array_except("must", "s")) == 0)
    verified = whole.select("id", "license", share.alias("containment")).filter(F.col("containment") >= CONTAINED)
    if not short.isEmpty():
        verified = verified.unionByName(_short(texts, short, max_broadcast))
    best = verified.groupBy("id", "license").agg(F.max("containment").alias("containment"))
    return best.select(F.col("id").alias(key), F.col("license").alias(license_key), "containment")


# Notices as licenses ask for them, and short forms in common use.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
]

# Further headers, titles and short forms. Each differs from those of other licenses in more than a fifth of its shingles.
RESERVED = "LicenseRef-All-Rights-Reserved"
_FORMS = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "AGPL-3.0": [
        "GNU Affero General Public License version 3", "GNU Affero General Public License v3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "GNU Affero General Public License as published by the", "AGPLv3", "AGPL v3", "AGPL-3.0",
    ],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 license", "Apache License Version 2.0, January 2004"],
    "BSD-2-Clause": [
        "BSD 2-Clause", "2-Clause BSD", "Simplified BSD License",
    ],
    "BSD-3-Clause": [
        "may be used to endorse or promote products derived from this software without specific prior written permission",
        "BSD 3-Clause", "3-Clause BSD", "New BSD License", "Modified BSD License",
    ],
    "BSL-1.0": ["Boost Software License"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International", "CC BY 4.0"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International", "CC BY-SA 4.0"],
    "CC-BY-SA-3.0": ["Creative Commons Attribution-ShareAlike 3.0", "CC BY-SA 3.0"],
    "CC-BY-ND-4.0": ["Creative Commons Attribution-NoDerivatives 4.0 International", "CC BY-ND 4.0"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International", "CC BY-NC 4.0"],
    "CC-BY-NC-SA-4.0": ["Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", "CC BY-NC-SA 4.0"],
    "CC-BY-NC-ND-4.0": ["Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International", "CC BY-NC-ND 4.0"],
    "CC0-1.0": ["CC0 1.0 Universal", "CC0 1.0", "has waived all copyright and related or neighboring rights to"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License - v 2.0"],
    "GPL-2.0": ["GNU General Public License version 2", "GNU General Public License v2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "GPLv2", "GPL v2"],
    "GPL-3.0": ["GNU General Public License version 3", "GNU General Public License v3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June", "GPLv3", "GPL v3"],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies",
        "ISC License",
    ],
    "LGPL-2.1": ["GNU Lesser General Public License version 2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "LGPLv2.1", "LGPL v2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License version 3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "LGPLv3", "LGPL v3"],
    "MIT": ["MIT License", "Licensed under MIT", "Released under MIT"],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Mozilla Public License 2.0", "Mozilla Public License Version 2.0", "MPL 2.0",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
        "from the use of this software",
        "zlib License",
    ],
}
FORMS = [(name, form) for name, forms in _FORMS.items() for form in [*forms, f"SPDX-License-Identifier: {name}"]] + [(RESERVED, "All rights reserved.")]

# File headers that all but agree: their license, its name and version.
_HEADERS = [
    ("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"), ("AGPL-3.0", "Affero General Public License", "3"),
    ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3"),
]
_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published "
    "by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
_ONLY = "under the terms of version {version} of the GNU {name} as published by the Free Software Foundation"
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY"
)
TELLING = [
    *[(i, _HEADER.format(name=n, version=v), [f"the GNU {n}", f"version {v} of the License"]) for i, n, v in _HEADERS],
    *[(i, _ONLY.format(name=n, version=v), [f"terms of version {v} of the GNU {n}"]) for i, n, v in _HEADERS],
    # the notice of three clauses goes on with the third one here
    ("BSD-2-Clause", _BSD, ["with the distribution. THIS SOFTWARE"]),
]
TEMPLATES = [(name, form, None) for name, form in NOTICES + FORMS] + TELLING
