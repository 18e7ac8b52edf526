"""Licence recognition by sentences: sentences map to identifiers, rules are ordered lists of them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctrflow.llm.frames import let

# Sentences of public licences and notices, as they are worded there.
SENTENCES = {
    "all-rights": "All rights reserved.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit-tag": "Released under the MIT License.",
    "mit-tag-2": "Licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "apache-tag": "Licensed under the Apache License, Version 2.0.",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl-free": "This program is free software:",
    "gpl3-grant": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-grant": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl2-version": "either version 2 of the License, or (at your option) any later version.",
    "lgpl-grant": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "lgpl21-version": "either version 2.1 of the License, or (at your option) any later version.",
    "agpl3-grant": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "gpl3-tag": "This work is licensed under the GNU General Public License, version 3.",
    "mpl-start": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl-tag": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense-1": "This is free and unencumbered software released into the public domain.",
    "unlicense-2": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "cc-by-nc-tag": "Licensed under CC BY-NC 4.0.",
    "cc-by-tag": "Licensed under CC BY 4.0.",
    "cc-by-sa-tag": "Licensed under CC BY-SA 4.0.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}

# Which sentences, in this order, make up which licence.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-tag",)),
    ("MIT", ("mit-tag-2",)),
    ("MIT", ("mit-title", "mit-grant")),
    ("MIT", ("mit-title-2", "mit-grant")),
    ("ISC", ("isc-grant", "isc-as-is")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("Apache-2.0", ("apache-tag",)),
    ("Apache-2.0", ("apache-grant", "apache-use", "apache-copy")),
    ("Apache-2.0", ("apache-grant", "apache-as-is", "apache-see")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-grant")),
    ("GPL-3.0-or-later", ("gpl3-grant", "gpl-hope", "gpl-implied", "gpl-see")),
    ("GPL-3.0-only", ("gpl3-tag",)),
    ("GPL-2.0-or-later", ("gpl2-grant", "gpl2-version")),
    ("GPL-2.0-or-later", ("gpl2-version", "gpl-hope", "gpl-implied", "gpl-see")),
    ("LGPL-2.1-or-later", ("lgpl-grant", "lgpl21-version")),
    ("AGPL-3.0-or-later", ("agpl3-grant",)),
    ("MPL-2.0", ("mpl-tag",)),
    ("MPL-2.0", ("mpl-start", "mpl-copy")),
    ("Unlicense", ("unlicense-1", "unlicense-2")),
    ("CC-BY-NC-4.0", ("cc-by-nc-tag",)),
    ("CC-BY-4.0", ("cc-by-tag",)),
    ("CC-BY-4.0", ("cc-by-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-tag",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-work",)),
    ("CC0-1.0", ("cc0",)),
    ("all-rights-reserved", ("all-rights",)),
)

#: Unknown sentences that may stand between two sentences of a rule.
GAP = 3
#: A sentence ends at one of these before white space; the lines of a text are looked at by themselves too.
SENTENCE_END = r"[.!?:;]+[\x09-\x0D\x20]+"
LINE_END = r"[\n\r]+"
#: Headings and copyright lines have no full stop: a line without letters and digits (blanks, comment marks) ends a
#: sentence too, and so does a copyright line.
_MARKS = r"\x09\x0B\x0C\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E"
PARAGRAPH_END = (
    rf"\n[\n\r{_MARKS}]*\n|\r[\r{_MARKS}]*\r"
    r"|copyright[\x09\x20]*(?:\(c\)|\u00A9|[0-9]{4})[^\n\r]*[\n\r]+"
)
_OTHER = r"[^a-z0-9]+"


def normalised(sentence: str) -> str:
    return re.sub(_OTHER, " ", sentence.lower()).strip()


def dictionary(sentences: dict[str, str] = SENTENCES) -> list[tuple[str, str]]:
    """Normalised sentences, each once, with their names."""
    return list({normalised(words): name for name, words in sentences.items()}.items())


def hints(known: list[tuple[str, str]]) -> list[str]:
    """A few words of which every known sentence holds at least one."""
    left, out = [set(k.split()) for k, _ in known], []
    while left:
        counts: dict[str, int] = {}
        for words in left:
            for w in words:
                counts[w] = counts.get(w, 0) + 1
        best = max(counts, key=lambda w: (len(w) >= 6, counts[w], len(w), w))
        out.append(best)
        left = [words for words in left if best not in words]
    return out


def identifiers(text: Column, end: str, known: list[tuple[str, str]]) -> Column:
    """The identifiers in a text, in order, as text: `` 3  7 | 9 ``; a bar where more than GAP others stand between."""
    names = list(dict.fromkeys(n for _, n in known))
    longest = max(len(k) for k, _ in known)
    shortest = min(len(k) for k, _ in known)
    table = F.array(*[F.lit(k) for k, _ in known])
    numbers = F.array(*[F.lit(names.index(n)) for _, n in known])

    def number(unit: Column) -> Column:
        # position among the known ones, or null; far too long or short units are not normalised at all
        at = F.array_position(table, F.trim(F.regexp_replace(unit, _OTHER, " ")))
        length = F.length(unit)
        return F.when(
            (length >= shortest) & (length <= 4 * longest) & (at > 0), F.get(numbers, (at - 1).cast("int"))
        )

    def joined(some: Column) -> Column:
        return F.array_join(
            F.transform(
                some,
                lambda s, i: F.concat(
                    F.when((i > 0) & (s["at"] - F.get(some, i - 1)["at"] > GAP + 1), "|").otherwise(""),
                    F.lit(" "), s["id"].cast("string"), F.lit(" "),
                ),
            ),
            "",
        )

    units = F.transform(F.split(text, end, -1), lambda u, i: F.struct(i.alias("at"), number(u).alias("id")))
    return let(F.filter(units, lambda s: s["id"].isNotNull()), joined)


def rule_pattern(rule: tuple[str, ...], names: list[str]) -> str:
    """The rule's identifiers in order, others between them, but no bar."""
    return "( [0-9]+ )*".join(f" {names.index(s)} " for s in rule)


def recognise(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None,
    sentences: dict[str, str] = SENTENCES, rules: tuple = RULES,
) -> DataFrame:
    """Add ``sentences`` (names of known sentences found, sorted) and ``licences`` (names of rules met, sorted).

    Sentences are compared by their letters and digits, A-Z as a-z, wrapped over lines or on a line of their own, also
    after a heading or a copyright line without a full stop if a blank line or the copyright line ends there. A rule
    is met where its sentences follow each other in order with at most GAP unknown sentences between two
    known ones. Null and empty texts have none. Each row stands for itself, in its own task; the sentences and rules
    are fixed lists of some hundreds at most. ``keep`` names the columns that stay (default: all).
    """
    added = ["sentences", "licences"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    known = dictionary(sentences)
    names = list(dict.fromkeys(n for _, n in known))
    lower = F.lower(F.coalesce(docs[f"`{text}`"], F.lit("")))

    def scanned(t: Column) -> Column:
        some = F.lit(False)
        for h in hints(known):
            some = some | F.contains(t, F.lit(h))
        views = [identifiers(t, e, known) for e in (SENTENCE_END, LINE_END, f"{SENTENCE_END}|{PARAGRAPH_END}")]
        return F.when(some, F.concat_ws("#", *views)).otherwise("")

    sequence = F.col("__sequence")
    met = [F.when(F.rlike(sequence, F.lit(rule_pattern(r, names))), F.lit(licence)) for licence, r in rules]
    named = F.transform(
        F.array_distinct(F.regexp_extract_all(sequence, F.lit("[0-9]+"), F.lit(0))),
        lambda i: F.get(F.array(*[F.lit(n) for n in names]), i.cast("int")),
    )
    return docs.select(*[docs[f"`{c}`"] for c in keep], let(lower, scanned).alias("__sequence")).select(
        *keep, F.sort_array(named).alias("sentences"),
        F.when(sequence == "", F.array().cast("array<string>"))
        .otherwise(F.sort_array(F.array_distinct(F.array_compact(F.array(*met))))).alias("licences"),
    )
