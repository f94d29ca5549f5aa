"""Licence scans by sentence rules.

A text is cut into sentences and each is normalised. A sentence that the sentence table knows becomes its identifier, all
others ``-``. Ordered rules then look for runs of identifiers, the most specific first; what a rule has matched is
used up. All of it is one projection of built-in functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.quality import bound

# Identifier and pattern of a whole normalised sentence (lower case, quotes dropped, white space and
# punctuation other than . - as one blank). The first pattern that fits names the sentence.
SENTENCES: list[tuple[str, str]] = [
    ("spdx-mit", r"(?:spdx-license-identifier )mit"),
    ("spdx-apache2", r"(?:spdx-license-identifier )apache-2.0"),
    ("spdx-gpl2", r"(?:spdx-license-identifier )gpl-2.0(?:-only|-or-later| )?"),
    ("spdx-gpl3", r"(?:spdx-license-identifier )gpl-3.0(?:-only|-or-later| )?"),
    ("spdx-bsd3", r"(?:spdx-license-identifier )bsd-3-clause"),
    ("mit-released", r"(?:this (?:work|software|file|project|program) is )?(?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?mit license"),
    ("mit-title", r"(?:the )?mit license(?: mit)?"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction .*"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("as-is-software", r"the software is provided as is without warranty of any kind .*"),
    ("no-liability", r"in no event shall the (?:authors|author|copyright holders|copyright holder|copyright owner|regents) .*be liable .*"),
    ("isc-grant", r"permission to use copy modify and ?(?:or)? distribute this software for any purpose with or without fee is hereby granted .*"),
    ("apache2-licensed", r"(?:this (?:work|software|file|project|program) is )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?apache license version 2.0(?: the license)?"),
    ("apache2-title", r"apache license version 2.0(?: january 2004)?"),
    ("apache2-compliance", r"you may not use this file except in compliance with the license"),
    ("apache2-copy", r"you may obtain a copy of the license at .*"),
    ("apache2-unless", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis .*"),
    ("gpl3-licensed", r"(?:this (?:work|software|file|project|program) is )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?gnu general public license version 3"),
    ("gpl2-licensed", r"(?:this (?:work|software|file|project|program) is )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?gnu general public license version 2"),
    ("gpl-free", r"this program is free software you can redistribute it and ?(?:or)? modify it under the terms of the gnu general public license as published by the free software foundation either version (?:2|3) of the license or at your option any later version"),
    ("gpl-hope", r"this program is distributed in the hope that it will be useful but without any warranty .*"),
    ("gpl-received", r"you should have received a copy of the gnu general public license along with this program .*"),
    ("lgpl-licensed", r"(?:this (?:work|software|file|project|program|library) is )?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?gnu lesser general public license version (?:2.1|3)"),
    ("mpl2-subject", r"this source code form is subject to the terms of the mozilla public license v. 2.0"),
    ("bsd-redistribution", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", r".*redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", r".*redistributions in binary form must reproduce the above copyright notice .*"),
    ("bsd-endorse", r".*neither the name of .* may be used to endorse or promote products .*"),
    ("bsd-as-is", r"this software is provided by the .* as is and any express or implied warranties .*"),
    ("cc-by-nc", r"(?:this (?:work|text|document|page) is )?(?:released|licensed) under (?:a |the )?(?:creative commons |cc )(?:by-nc|attribution-noncommercial) 4.0(?: international)?(?: license)?"),
    ("cc-by-sa", r"(?:this (?:work|text|document|page) is )?(?:released|licensed) under (?:a |the )?(?:creative commons |cc )(?:by-sa|attribution-sharealike) 4.0(?: international)?(?: license)?"),
    ("cc-by", r"(?:this (?:work|text|document|page) is )?(?:released|licensed) under (?:a |the )?(?:creative commons |cc )(?:by|attribution) 4.0(?: international)?(?: license)?"),
    ("cc0", r"(?:to the extent possible under law .* waived all copyright .*|(?:released|licensed) under cc0 1.0(?: universal)?)"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("rights-reserved", r"all rights reserved"),
    ("copyright", r"(?:©|copyright|copr.).*\d{4}.*"),
]

# Licence, the identifiers that must follow each other (other sentences may not stand between them), and
# whether the licence lets the text be used for any purpose.
RULES: list[tuple[str, tuple[str, ...], bool]] = [
    ("MIT", ("mit-grant", "mit-notice", "as-is-software"), True),
    ("Apache-2.0", ("apache2-licensed", "apache2-compliance", "apache2-copy", "apache2-unless"), True),
    ("GPL", ("gpl-free", "gpl-hope", "gpl-received"), False),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"), True),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-as-is"), True),
    ("ISC", ("isc-grant", "as-is-software"), True),
    ("MIT", ("mit-grant", "mit-notice"), True),
    ("MIT", ("mit-released",), True),
    ("MIT", ("mit-title",), True),
    ("MIT", ("spdx-mit",), True),
    ("Apache-2.0", ("apache2-licensed", "apache2-compliance"), True),
    ("Apache-2.0", ("apache2-licensed",), True),
    ("Apache-2.0", ("apache2-title",), True),
    ("Apache-2.0", ("spdx-apache2",), True),
    ("GPL-3.0", ("gpl3-licensed",), False),
    ("GPL-3.0", ("spdx-gpl3",), False),
    ("GPL-2.0", ("gpl2-licensed",), False),
    ("GPL-2.0", ("spdx-gpl2",), False),
    ("GPL", ("gpl-free",), False),
    ("LGPL", ("lgpl-licensed",), False),
    ("MPL-2.0", ("mpl2-subject",), False),
    ("BSD-3-Clause", ("spdx-bsd3",), True),
    ("ISC", ("isc-grant",), True),
    ("CC-BY-NC-4.0", ("cc-by-nc",), False),
    ("CC-BY-SA-4.0", ("cc-by-sa",), False),
    ("CC-BY-4.0", ("cc-by",), True),
    ("CC0-1.0", ("cc0",), True),
    ("Unlicense", ("unlicense",), True),
]

# A text or normalised sentence without one of these letter runs fits no pattern (a test has an example of each); most texts have
# none and are not cut at all.
HINT = r"(?i)licen[sc]e|copyright|copr\.|©|permission|warrant|liable|redistribut|endorse|rights[\W_]+reserved|public[\W_]+domain|creative[\W_]+commons|(?<![\p{L}\p{N}])cc(?!\p{L})"
# Sentences that begin a line even if the line before looks unfinished.
_OPENING = r"(?i:permission |redistribution|licensed |released |copyright|all rights reserved|this software is provided|the software is provided|in no event)"
# A line that goes on: in capitals, after a comma, or after a word that ends no sentence of a licence.
_UNFINISHED = r"(?<=[A-Z\"',]{2}[ \t]{0,4})\n(?=\s*[A-Z]{2})|(?<=,[ \t]{0,4})\n|(?<=\b(?i:the|a|of|by|or|and|in|to|under|with|for|this|gnu|lesser|general|public|free|mozilla|mit|creative|commons)[ \t]{0,4})\n|\n(?=\s*Version \d)"
# Ends: punctuation before white space (not after a list number, in "v. 2.0" or "Copr. 2020", in an SPDX tag or inside the sentences of the GPL),
# blank lines (not before the address of a licence), lines before a capital that do not go on, and both ends of an SPDX tag.
SENTENCE_END = "|".join(
    [
        r"(?<!(?:^|\n|[.;:!?]\s)[ \t#*/]{0,20}(?:\d{1,3}|\b[a-z]))(?<!\b(?i:v|copr)(?=\.\s{1,9}\d))[.](?:[.!?;:]*)(?=\s|$)",
        r"[!?][.!?;:]*(?=\s|$)",
        r"(?<!(?i:spdx-license-identifier|free\s{1,20}software|any\s{1,20}warranty|this\s{1,20}program))[;:][.!?;:]*(?=\s|$)",
        r"(?<!(?i:license\sat)\s{0,4})\n\s*\n",
        rf"\n(?=\s*{_OPENING})",
        rf"(?!{_UNFINISHED})\n(?=\s*[A-Z©])",
        r"(?<=(?i:spdx-license-identifier):[^\n]{0,80})\n",
        r"\s(?=(?i:spdx-license-identifier):)",
        r"\r",
    ]
)
NOISE = r"[^\p{L}\p{N}.©-]+"


def normalised(sentence: Column) -> Column:
    """Lower case, one blank for white space and punctuation, no full stop at the ends and no list number."""
    s = F.regexp_replace(F.lower(sentence), r"['\"‘’“”]", "")
    s = F.regexp_replace(s, NOISE, " ")
    return F.regexp_replace(s, r"^[ .]+(?:(?:\d{1,3}|[a-z])\. )?|^(?:\d{1,3}|[a-z])\. |[ .]+$", "")


def identifiers(text: Column, sentences: list[tuple[str, str]] = SENTENCES) -> Column:
    """The identifier of every sentence with words, in order; ``-`` where the table has none."""

    def name(s: Column) -> Column:
        found = F.when(~s.rlike(HINT), F.lit("-"))
        for key, pattern in sentences:
            # the blank lets a sentence end where " .*" of its pattern begins
            found = found.when(F.concat(s, F.lit(" ")).rlike(f"^(?:{pattern}) ?$"), F.lit(key))
        return found.otherwise(F.lit("-"))

    parts = F.filter(F.transform(F.split(text, SENTENCE_END), normalised), lambda s: s != "")
    return F.transform(parts, name)


def _step(run: str, rule: int) -> Callable[[Column], Column]:
    def step(s: Column) -> Column:
        hit = F.contains(s["rest"], F.lit(run))
        return F.struct(
            F.when(hit, F.replace(s["rest"], F.lit(run), F.lit(",=,"))).otherwise(s["rest"]).alias("rest"),
            F.when(hit, F.array_append(s["found"], F.lit(rule))).otherwise(s["found"]).alias("found"),
        )

    return step


def match(sequence: Column, rules: list[tuple[str, tuple[str, ...], bool]] = RULES) -> Column:
    """Names of the rules that fit the sequence ``,a,b,-,c,`` in order; matched identifiers are used up."""
    state = F.struct(sequence.alias("rest"), F.array().cast("array<int>").alias("found"))
    for k, (_, keys, _) in enumerate(rules):
        state = bound(state, _step("," + ",,".join(keys) + ",", k))
    return state


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``license_sentences`` (identifiers found, in order), ``licenses`` (sorted names) and ``license_verdict``.

    The verdict is ``none`` without a known sentence, ``unknown`` if known sentences fit no rule, ``restricted`` if any licence
    found restricts the use, else ``free``. Null and empty texts have none. Columns of these names are replaced.
    """
    added = {"license_sentences", "licenses", "license_verdict"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    source = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    empty = F.array().cast("array<string>")
    names = F.array(*[F.lit(n) for n, _, _ in RULES])
    free = F.array(*[F.lit(f) for _, _, f in RULES])

    def result(ids: Column) -> Column:
        known = F.filter(ids, lambda x: x != "-")

        def conclude(s: Column) -> Column:
            found = s["found"]
            return F.struct(
                known.alias("license_sentences"),
                F.array_sort(F.array_distinct(F.transform(found, lambda k: names[k]))).alias("licenses"),
                F.when(F.size(known) == 0, "none")
                .when(F.size(found) == 0, "unknown")
                .when(F.exists(found, lambda k: ~free[k]), "restricted")
                .otherwise("free")
                .alias("license_verdict"),
            )

        sequence = F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(","))
        return F.when(F.size(known) == 0, F.struct(empty.alias("license_sentences"), empty.alias("licenses"), F.lit("none").alias("license_verdict"))).otherwise(
            bound(match(sequence), conclude)
        )

    cut = F.when(source.rlike(HINT), identifiers(source)).otherwise(empty)
    return docs.withColumn("_l", bound(cut, result)).select(*[F.col(f"`{c}`") for c in docs.columns], "_l.*")
