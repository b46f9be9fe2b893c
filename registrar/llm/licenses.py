"""License scan: passages compared with licence templates by Dice over word bigrams."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from functools import reduce
from itertools import groupby
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import let

#: Public licence notices.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License.",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met:",
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "CC-BY-NC-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the Software without restriction.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
}
#: Passages of the standard texts, and usual notices.
MORE = {
    "AGPL-3.0": (
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works,"
        " specifically designed to ensure cooperation with the community in the case of network server software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to"
        " You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce,"
        " prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such"
        " Derivative Works in Source or Object form.",
    ),
    "BSD-3-Clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission.",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and"
        " accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute,"
        " execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties"
        " to whom the Software is furnished to do so, all subject to the following:",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this"
        " work.",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to"
        " this software to the public domain worldwide. This software is distributed without any warranty.",
    ),
    "GPL-2.0": (
        "This License applies to any program or other work which contains a notice placed by the copyright holder saying it"
        " may be distributed under the terms of this General Public License.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License version 2 as published by the Free Software Foundation.",
    ),
    "GPL-3.0": ("The GNU General Public License is a free, copyleft license for software and other kinds of works.",),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-2.1": (
        "This License Agreement applies to any software library or other program which contains a notice placed by the"
        " copyright holder or other authorized party saying it may be distributed under the terms of this Lesser General"
        " Public License (also called \"this License\").",
    ),
    "LGPL-3.0": (
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU"
        " General Public License, supplemented by the additional permissions listed below.",
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE"
        " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
        " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
        " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "This project is licensed under the MIT License - see the LICENSE file for details.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form"
        " or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE"
        " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE"
        " LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,"
        " OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held"
        " liable for any damages arising from the use of this software.",
    ),
}
#: The GNU licences' kinds and versions, the parts of Creative Commons names, and its versions.
GNU = [("GPL", "", "2.0"), ("GPL", "", "3.0"), ("LGPL", "Library ", "2.0"), ("LGPL", "Lesser ", "2.1"),
       ("LGPL", "Lesser ", "3.0"), ("AGPL", "Affero ", "3.0")]
CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
CC_KINDS = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = {"4.0": "International", "3.0": "Unported"}
#: Words that tell one licence from another, or turn its meaning round: passage and template must have the same ones.
VARIANTS = ("1", "2", "3", "4", "5", "affero", "lesser", "nc", "nd", "never", "no", "noncommercial", "noderivatives",
            "noderivs", "not", "sa", "sharealike")
#: Words taken first as key words, as they are rare outside of licences; after them the longest ones.
RARE = ("spdx", "licensed", "license", "commons", "cc", "gnu", "mozilla", "apache", "redistribute", "redistribution",
        "sublicense", "merchantability", "noninfringement", "unencumbered", "copyright")


def _ruled() -> dict[str, list[str]]:
    """Notices that differ in the licence's kind and version only."""
    made: dict[str, list[str]] = {}
    for short, kind, version in GNU:
        number = version.removesuffix(".0")
        made.setdefault(f"{short}-{version}", []).extend([
            f"This work is licensed under the GNU {kind}General Public License, version {number}.",
            f"This {'library' if short == 'LGPL' else 'program'} is free software: you can redistribute it and/or modify it"
            f" under the terms of the GNU {kind}General Public License as published by the Free Software Foundation, either"
            f" version {number} of the License, or (at your option) any later version.",
        ])
    for kind in CC_KINDS:
        name = "-".join(CC_PARTS[part] for part in kind.split("-"))
        for version, place in CC_VERSIONS.items():
            made[f"CC-{kind}-{version}"] = [
                f"This work is licensed under a Creative Commons {name} {version} {place} License.",
                f"Licensed under CC {kind} {version}.",
            ]
    return made


_RULED = _ruled()
#: All of them, with the SPDX line of each licence.
ALL = {
    n: tuple(dict.fromkeys((*TEMPLATES.get(n, ()), *MORE.get(n, ()), *_RULED.get(n, ()), f"SPDX-License-Identifier: {n}")))
    for n in sorted({*TEMPLATES, *MORE, *_RULED})
}
#: Most lines that are put together to a passage.
LINES = 4
LEAST_DICE = 0.8
# A list mark in front of a passage is no part of it. The patterns stand in the SQL, too.
_MARK = r"^[^a-z0-9]*(?:\(?[a-z0-9]\)|[0-9]+[.)])[ \t]+"
_BLANK = r"\n[ \t\r]*\n"
_SPACES = r"[ \t\n\f\r]+"
_OPENING, _THIRD = "redistribution and use in source and binary forms", "neither the name of"


def _words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def _bigrams(text: str) -> list[str]:
    words = _words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _bounds(size: int, least: float) -> tuple[int, int]:
    """Bigram counts that can reach the coefficient with a template of ``size`` bigrams."""
    return math.ceil(size * least / (2 - least) - 1e-9), math.floor(size * (2 - least) / least + 1e-9)


def _key_words(grams: list[str], least: float) -> set[str]:
    """Words of which every matching passage has one.

    A passage with the coefficient lacks at most size - low of the template's
    bigrams, so it has one of any size - low + 1 of them. Words are taken, the
    rare ones first, until their bigrams are so many.
    """
    low, _ = _bounds(len(grams), least)
    pairs = [g.split() for g in grams]
    rank = {w: i for i, w in enumerate(RARE)}
    order = sorted({w for pair in pairs for w in pair}, key=lambda w: (rank.get(w, len(RARE)), -len(w), w))
    taken: set[str] = set()
    for word in order:
        if sum(1 for pair in pairs if taken & set(pair)) > len(grams) - low:
            break
        taken.add(word)
    return taken


def _key_test(keys: list[str]):
    """Whether a lower-case text has one of the words, as a column.

    Plain searches for their shortest forms turn most texts away at a tenth
    of the pattern's cost; the pattern then sees to the words' borders.
    """
    if not keys:
        return lambda text: F.lit(False)
    stems = [k for k in keys if not any(o in k for o in keys if o != k)]
    by_letter = [f"{k}(?:{'|'.join(w[1:] for w in words)})" for k, words in groupby(keys, key=lambda w: w[0])]
    pattern = rf"(?<![a-z0-9])(?:{'|'.join(by_letter)})(?![a-z0-9])"
    return lambda text: reduce(or_, [text.contains(s) for s in stems]) & text.rlike(pattern)


def scan(
    docs: DataFrame,
    templates: Mapping[str, tuple[str, ...]] = ALL,
    least: float = LEAST_DICE,
) -> DataFrame:
    """``docs`` with the licences that a passage of the text carries.

    Passages are the text's paragraphs (between blank lines), lines, sentences
    (of a line, and of a paragraph across line ends) and runs of up to LINES
    lines. Normalised, a passage is lower-case runs of a-z and 0-9 without a
    list mark in front. It carries the licence of the template whose bigram
    set has the greatest Dice coefficient with its own (ties: the first name),
    if that is ``least`` or more; templates whose VARIANTS words are not those
    of the passage are out of the question. The opening notice that BSD
    licences share counts for BSD-2-Clause only where it stands more often
    than the third clause. Templates whose size bounds a passage misses are
    not compared with it, and only passages with one of the templates' key
    words are made.

    Added: ``licenses array<struct<license, dice>>`` (best coefficient of each,
    by name), ``n_licenses`` and ``best_dice`` (0 if none). Columns of these
    names are replaced. Null and empty texts carry none; rows that repeat are
    looked at one by one. The templates are a small fixed list and part of the
    plan; the scan has no shuffle.
    """
    known = [(name, t, g) for name, texts in sorted(templates.items()) for t in texts if (g := _bigrams(t))]
    keys = sorted(set().union(*[_key_words(g, least) for _, _, g in known])) if known else []
    names = [c for c in docs.columns if c not in ("licenses", "n_licenses", "best_dice")]
    struct = "struct<dice:double,rank:int,license:string>"
    table = F.array(*[
        F.struct(
            F.lit(-i).alias("rank"), F.lit(name).alias("license"), F.split(F.lit("|".join(g)), r"\|").alias("grams"),
            F.lit(len(g)).alias("n"), F.lit(_bounds(len(g), least)[0]).alias("low"),
            F.lit(_bounds(len(g), least)[1]).alias("high"),
            F.lit(" ".join(sorted(set(_words(t)) & set(VARIANTS)))).alias("variants"),
        )
        for i, (name, t, g) in enumerate(known)
    ]) if known else None

    def best_match(words: Column) -> Column:
        """The best template of a passage; null if none reaches the coefficient."""
        if table is None:
            return F.lit(None).cast(struct)
        own = F.array_join(F.array_sort(F.array_intersect(words, F.array(*map(F.lit, VARIANTS)))), " ")
        return let(_pairs(words), lambda grams: let(own, lambda v: F.array_max(F.filter(
            F.transform(
                F.filter(table, lambda t: F.size(grams).between(t.low, t.high) & (t.variants == v)),
                lambda t: F.struct(
                    (2.0 * F.size(F.array_intersect(grams, t.grams)) / (F.size(grams) + t.n)).alias("dice"),
                    t["rank"].alias("rank"), t.license.alias("license"),
                ),
            ),
            lambda x: x.dice >= least,
        ))))

    has_key = _key_test(keys)

    def keyed(passages: Column) -> Column:
        return F.filter(passages, has_key)

    def runs(lines: Column, at: Column, n: int) -> Column:
        """Runs of ``n`` lines that hold one of the lines ``at``."""
        last = F.size(lines) - n
        starts = F.array_distinct(F.flatten(F.transform(
            at, lambda i: F.sequence(F.greatest(i - (n - 1), F.lit(0)), F.least(i, last))
        )))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(lines, i + 1, n), " "))
        return F.when(last >= 0, joined).otherwise(F.array().cast("array<string>"))

    def of_lines(lines: Column) -> Column:
        with_key = F.filter(F.transform(lines, lambda l, i: F.when(has_key(l), i)), lambda i: i.isNotNull())
        return let(with_key, lambda at: let(F.transform(at, lambda i: F.get(lines, i)), lambda own: F.concat(
            own,
            keyed(F.flatten(F.transform(own, lambda l: F.split(l, r"(?<=[.!?])[ \t]+", -1)))),
            *[runs(lines, at, n) for n in range(2, LINES + 1)],
        )))

    def of_paragraphs(paragraphs: Column) -> Column:
        wrapped = F.transform(paragraphs, lambda p: F.split(F.regexp_replace(p, _SPACES, " "), "(?<=[.!?]) ", -1))
        return F.concat(paragraphs, keyed(F.flatten(wrapped)))

    def carried(lower: Column) -> Column:
        passages = F.array_distinct(F.concat(
            let(F.split(lower, "\n", -1), of_lines), let(keyed(F.split(lower, _BLANK, -1)), of_paragraphs),
        ))
        matched = F.transform(passages, lambda p: let(_passage_words(p), best_match))
        return F.filter(matched, lambda x: x.isNotNull())

    text = F.lower(F.coalesce(F.col("text"), F.lit("")))
    found = let(text, lambda t: F.when(has_key(t), carried(t)).otherwise(F.array().cast(f"array<{struct}>")))
    plain = F.regexp_replace(text, "[^a-z0-9]+", " ")
    times = lambda phrase: F.size(F.split(plain, phrase, -1))
    found = let(found, lambda f: F.when(
        F.array_contains(F.transform(f, lambda x: x.license), "BSD-3-Clause") & (times(_OPENING) <= times(_THIRD)),
        F.filter(f, lambda x: x.license != "BSD-2-Clause"),
    ).otherwise(f))
    raw = docs.select(*names, found.alias("__found"))
    # For each licence that occurs, in name order, its best coefficient.
    best = let(F.col("__found"), lambda f: F.transform(
        F.array_sort(F.array_distinct(F.transform(f, lambda x: x.license))),
        lambda name: F.struct(
            name.alias("license"),
            F.array_max(F.transform(F.filter(f, lambda x: x.license == name), lambda x: x.dice)).alias("dice"),
        ),
    ))
    done = raw.select(*names, best.alias("licenses"))
    return done.withColumns({
        "n_licenses": F.size("licenses").cast("long"),
        "best_dice": F.coalesce(F.array_max(F.col("licenses.dice")), F.lit(0.0)),
    })


def _passage_words(passage: Column) -> Column:
    return F.split(F.btrim(F.regexp_replace(F.regexp_replace(passage, _MARK, ""), "[^a-z0-9]+", " ")), " ", -1)


def _pairs(words: Column) -> Column:
    return F.when(
        F.size(words) > 1,
        F.array_distinct(F.transform(
            F.sequence(F.lit(0), F.size(words) - 2),
            lambda i: F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1)),
        )),
    ).otherwise(F.array().cast("array<string>"))


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = F.array_join(F.col("licenses.license"), ",")
    return scan(docs).select("doc_id", "n_licenses", names.alias("licenses"), F.round("best_dice", 6).alias("best_dice"))


_ROWS = ",\n    ".join(
    f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')"
    for i, (name, text) in enumerate((n, t) for n, ts in ALL.items() for t in ts)
)
_RUNS = ", ".join(
    f"list_transform(range(1, len(lines) - {n - 2}), lambda i: array_to_string(lines[i:i + {n - 1}], ' '))"
    for n in range(2, LINES + 1)
)
SQL = rf"""
WITH template(t, license, text) AS (VALUES
    {_ROWS}
), text AS (
    SELECT doc_id, lower(text) AS text, string_split(lower(text), chr(10)) AS lines,
           regexp_split_to_array(lower(text), '{_BLANK}') AS paragraphs
    FROM documents WHERE text IS NOT NULL
), passage AS (
    SELECT doc_id, unnest(list_distinct(list_concat(
        paragraphs, lines, {_RUNS},
        flatten(list_transform(lines,
            lambda l: string_split(regexp_replace(l, '([.!?])[ \t]+', '\1' || chr(1), 'g'), chr(1)))),
        flatten(list_transform(paragraphs, lambda p: string_split(
            regexp_replace(regexp_replace(p, '{_SPACES}', ' ', 'g'), '([.!?]) ', '\1' || chr(1), 'g'), chr(1))))
    ))) AS p FROM text
), words AS (
    SELECT 'p' AS kind, row_number() OVER () AS id, doc_id AS owner, '' AS license,
           regexp_extract_all(regexp_replace(p, '{_MARK}', ''), '[a-z0-9]+') AS w FROM passage
    UNION ALL
    SELECT 't', t, t, license, regexp_extract_all(lower(text), '[a-z0-9]+') FROM template
), marked AS (
    SELECT *, array_to_string(list_sort(list_distinct(
        list_filter(w, lambda x: x IN ({", ".join(f"'{v}'" for v in VARIANTS)})))), ' ') AS variants
    FROM words
), gram AS (
    SELECT DISTINCT kind, id, owner, license, variants, w[pos] || ' ' || w[pos + 1] AS g
    FROM (SELECT *, unnest(generate_series(1, len(w) - 1)) AS pos FROM marked WHERE len(w) > 1)
), sized AS (
    SELECT kind, id, count(*) AS n FROM gram GROUP BY ALL
), shared AS (
    SELECT a.id AS p, a.owner AS doc_id, b.id AS t, b.license, count(*) AS n
    FROM gram a JOIN gram b ON a.g = b.g AND a.variants = b.variants AND a.kind = 'p' AND b.kind = 't' GROUP BY ALL
), best AS (
    SELECT doc_id, license, 2.0 * shared.n / (x.n + y.n) AS dice
    FROM shared JOIN sized x ON x.kind = 'p' AND x.id = p JOIN sized y ON y.kind = 't' AND y.id = t
    WHERE 2.0 * shared.n / (x.n + y.n) >= {LEAST_DICE}
    QUALIFY row_number() OVER (PARTITION BY p ORDER BY dice DESC, license) = 1
), matched AS (
    SELECT doc_id, license, max(dice) AS dice FROM best GROUP BY ALL
), third AS (
    SELECT doc_id FROM matched JOIN (SELECT doc_id, regexp_replace(text, '[^a-z0-9]+', ' ', 'g') AS plain FROM text)
    USING (doc_id) WHERE license = 'BSD-3-Clause'
    AND len(string_split(plain, '{_OPENING}')) <= len(string_split(plain, '{_THIRD}'))
), summed AS (
    SELECT doc_id, count(*) AS n, string_agg(license, ',' ORDER BY license) AS names, max(dice) AS best
    FROM matched WHERE license <> 'BSD-2-Clause' OR doc_id NOT IN (SELECT doc_id FROM third) GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_licenses, coalesce(names, '') AS licenses,
       round(CAST(coalesce(best, 0) AS DOUBLE), 6) AS best_dice
FROM documents LEFT JOIN summed USING (doc_id)
"""
