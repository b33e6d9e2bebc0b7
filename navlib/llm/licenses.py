"""Licence scan by sentence rules, in DataFrame functions only.

A text is cut into sentences; each is normalised (lower case, runs of other
characters than a-z and 0-9 as one blank) and looked up among known licence
sentences.  The identifiers found, in text order, are matched against ordered
rules: a rule names its sentences, which must follow each other, with others
between them or not.  A rule that another found rule contains is left out, and
"All rights reserved." counts only where no licence is found.

Before that, comment marks (of C, shell, SQL, TeX, HTML, …) leave the starts
and ends of lines, so that a line of marks alone is blank; a line that starts
with a copyright sign, a copyright year or an address is a sentence of its own; and so is an SPDX line, whose
identifier is looked up like any sentence.  An address ends a sentence, a company's short form (Inc.) doesn't.

A sentence ends at . ! ? ; : before white space or the end, or at a blank line;
in a sentence that runs over lines each line counts as well, so that a notice
after an unfinished line is found.  A sentence that names a holder in
its midst is known by what stands around the name.

Defined cases: null and empty texts have no sentences and no licence;
licences are named once each, sorted; repeated rows are alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navlib.llm._frames import pick

# Sentences of published licence texts and notices.
SENTENCES: dict[str, str] = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit-title": "MIT License",
    "mit-title-old": "The MIT License (MIT)",
    "mit-style": "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-project": "This project is licensed under the MIT License.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-grant-old": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "isc-title": "ISC License",
    "isc-as-is": "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-author": "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-style": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "apache-licensed": "Licensed under the Apache License, Version 2.0.",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the License);",
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-unless": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-title": "Apache License Version 2.0, January 2004",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl21-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "gpl2-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl3-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation.",
    "lgpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "lgpl21-version": "either version 2.1 of the License, or (at your option) any later version.",
    "lgpl21-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-version": "either version 3 of the License, or (at your option) any later version.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-free": "This program is free software:",
    "gpl3-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl2-version": "either version 2 of the License, or (at your option) any later version.",
    "lgpl3-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-later": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-warranty": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-start": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl-title": "Mozilla Public License Version 2.0",
    "zlib-as-is": "This software is provided as-is, without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "boost-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "boost-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "boost-header": "Distributed under the Boost Software License, Version 1.0.",
    "epl2-title": "Eclipse Public License - v 2.0",
    "epl2-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl2-header-line": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    "epl2-header-http": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0/",
    "epl2-header-v2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-2.0/",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd": "Licensed under CC BY-NC-ND 4.0.",
    "cc0": "Licensed under CC0 1.0.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-work": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-sa-work": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "cc-by-nc-nd-work": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "cc0-title": "CC0 1.0 Universal",
    "reserved": "All rights reserved.",
}

# Ordered sentences of each rule, and its licence.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["mit-grant", "mit-condition", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-title"]),
    ("MIT", ["mit-title-old"]),
    ("MIT-style", ["mit-style"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-project"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-grant-old"]),
    ("ISC", ["isc-title"]),
    ("0BSD", ["0bsd-grant"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-author"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-style", ["bsd-style"]),
    ("Apache-2.0", ["apache-header", "apache-use", "apache-copy", "apache-unless"]),
    ("Apache-2.0", ["apache-header", "apache-use"]),
    ("Apache-2.0", ["apache-licensed"]),
    ("Apache-2.0", ["apache-title"]),
    ("GPL-3.0-only", ["gpl3-work"]),
    ("GPL-3.0-only", ["gpl3-only"]),
    ("GPL-3.0", ["gpl3-title"]),
    ("GPL-2.0", ["gpl2-title"]),
    ("LGPL-3.0", ["lgpl3-title"]),
    ("LGPL-2.1", ["lgpl21-title"]),
    ("AGPL-3.0", ["agpl3-title"]),
    ("GPL-2.0-only", ["gpl2-only"]),
    ("LGPL-2.1-or-later", ["lgpl-terms", "lgpl21-version"]),
    ("LGPL-2.1-or-later", ["lgpl21-later"]),
    ("LGPL-3.0-or-later", ["lgpl-terms", "lgpl3-version"]),
    ("GPL-3.0-or-later", ["gpl2-terms", "lgpl3-version"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("LGPL-3.0-or-later", ["lgpl3-later"]),
    ("AGPL-3.0-or-later", ["agpl3-later"]),
    ("GPL-2.0-only", ["gpl2-work"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl2-terms", "gpl2-version"]),
    ("GPL-2.0-or-later", ["gpl2-later"]),
    ("LGPL-3.0-or-later", ["gpl-free", "lgpl3-later"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl3-later"]),
    ("MPL-2.0", ["mpl-subject"]),
    ("MPL-2.0", ["mpl-start"]),
    ("MPL-2.0", ["mpl-title"]),
    ("Zlib", ["zlib-as-is", "zlib-grant"]),
    ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["boost-title"]),
    ("BSL-1.0", ["boost-grant"]),
    ("BSL-1.0", ["boost-header"]),
    ("EPL-2.0", ["epl2-title"]),
    ("EPL-2.0", ["epl2-header"]),
    ("EPL-2.0", ["epl2-header-line"]),
    ("EPL-2.0", ["epl2-header-http"]),
    ("EPL-2.0", ["epl2-header-v2"]),
    ("Unlicense", ["unlicense"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-ND-4.0", ["cc-by-nd"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa"]),
    ("CC-BY-NC-ND-4.0", ["cc-by-nc-nd"]),
    ("CC0-1.0", ["cc0"]),
    ("CC-BY-4.0", ["cc-by-work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-work"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-work"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-work"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-work"]),
    ("CC-BY-NC-ND-4.0", ["cc-by-nc-nd-work"]),
    ("CC0-1.0", ["cc0-title"]),
    ("Proprietary", ["reserved"]),
]
_NO_LICENCE = "Proprietary"

# SPDX lines: a sentence and a rule for every licence that the rules name, but for the two families without an identifier
for _name in sorted({name for name, _ in RULES} - {_NO_LICENCE, "BSD-style", "MIT-style"}):
    SENTENCES[f"spdx-{_name}"] = f"SPDX-License-Identifier {_name}"
    RULES.append((_name, [f"spdx-{_name}"]))

# Before sentences are cut: pattern, replacement in Spark, replacement in DuckDB.
_LINES = [
    (r"(^|\n)[ \t]*(?:/\*+!?|\*+/|\*+|#+!?|//+!?|--+|;+|%+|<!--)", "$1", r"\1"),
    (r"\*+/|-->", "", ""),
    (r"(^|\n)([ \t]*(?:(?:[Cc]opyright|COPYRIGHT)[ \t]*(?:\([Cc]\)|©|[ \t][0-9]{4})|\([Cc]\)[ \t]|©|https?://)[^\n]*)", "$1\n$2\n", "\\1\n\\2\n"),
    (r"(https?://[^ \t\r\n]+)", "$1\n\n", "\\1\n\n"),
    (r"\b(Inc|Ltd|Corp|Co)\.", "$1", r"\1"),
    (r"SPDX-License-Identifier:[ \t]*([^\n]*)", "\n\nSPDX-License-Identifier $1\n\n", "\n\nSPDX-License-Identifier \\1\n\n"),
]
# Sentences with a name in their midst: start, end, and the sentence they count as (normalised).
_HOLDER = ("neither the name of ", " may be used to endorse or promote products derived from this software without specific prior written permission")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SENTENCE_END = r"[.!?;:]+(?:[ \t\r\n]+|$)|\n[ \t\r]*\n"


def _plain(sentence: str) -> str:
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower()).split())


#: normalised sentence to identifier
KNOWN = {_plain(text): name for name, text in SENTENCES.items()}


def _order(rule: list[str]) -> str:
    """Rules are matched on the identifiers as one string |a|b|…|."""
    return r"\|" + r"\|(?:[^|]+\|)*".join(rule) + r"\|"


def _contained(rule: list[str], other: list[str]) -> bool:
    rest = iter(other)
    return rule != other and all(s in rest for s in rule)


def _normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, _UPPER, _LOWER), "[^a-z0-9]+", " "))


def _without_holder(plain: Column) -> Column:
    start, end = _HOLDER
    return F.when(plain.startswith(start) & plain.endswith(end), F.lit(_plain(SENTENCES["bsd-endorse"]))).otherwise(plain)


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_sentences, sentences (identifiers in order, comma-joined), n_unknown, licences (comma-joined).

    n_unknown counts sentences that speak of a licence but are not known.
    """
    rows = pick(docs, doc_id="doc_id", text="text")
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    text = F.coalesce("text", F.lit(""))
    for pattern, new, _ in _LINES:
        text = F.regexp_replace(text, pattern, new)
    with_lines = F.transform("s", lambda s: F.when(F.instr(s, "\n") > 0, F.concat(F.array(s), F.split(s, "\n"))).otherwise(F.array(s)))
    plain = lambda x: _without_holder(_normalised(x))
    named = (
        rows.select("doc_id", F.split(text, _SENTENCE_END).alias("s"))
        .select("doc_id", F.transform("s", plain).alias("s"), F.transform(F.flatten(with_lines), plain).alias("w"))
        .select(
            "doc_id",
            F.filter("s", lambda x: x != "").alias("s"),
            # a set tells the few known ones, a map is searched for those only
            F.transform(F.filter("w", lambda x: x.isin(*KNOWN)), lambda x: F.try_element_at(known, x)).alias("ids"),
        )
    )
    speaks = F.filter("s", lambda x: x.rlike("(^| )(licen[cs]e|licen[cs]ed|copyright|spdx)( |$)") & ~x.isin(*KNOWN))
    line = F.concat(F.lit("|"), F.array_join("ids", "|"), F.lit("|"))
    hit = [line.rlike(_order(rule)) for _, rule in RULES]
    licences = []
    for (name, rule), found in zip(RULES, hit, strict=True):
        larger = [hit[k] for k, (other_name, other) in enumerate(RULES) if other_name != name and _contained(rule, other)]
        licences.append(F.when(reduce(lambda a, b: a & ~b, larger, found), F.lit(name)))
    every = F.array_sort(F.array_distinct(F.array_compact(F.array(*licences))))
    found = F.when(F.size(every) > 1, F.array_remove(every, _NO_LICENCE)).otherwise(every)
    return named.select(
        "doc_id",
        F.size("s").cast("bigint").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentences"),
        F.size(speaks).cast("bigint").alias("n_unknown"),
        F.when(F.size("ids") == 0, F.lit("")).otherwise(F.array_join(found, ",")).alias("licences"),
    )


def oracle() -> str:
    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    known = "MAP {" + ", ".join(f"{text(k)}: {text(v)}" for k, v in KNOWN.items()) + "}"
    lines = "coalesce(text, '')"
    for pattern, _, new in _LINES:
        lines = f"regexp_replace({lines}, {text(pattern)}, {text(new)}, 'g')"
    normal = f"trim(regexp_replace(translate(x, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g'))"
    start, end = map(text, _HOLDER)
    plain = f"CASE WHEN starts_with({normal}, {start}) AND ends_with({normal}, {end}) THEN {text(_plain(SENTENCES['bsd-endorse']))} ELSE {normal} END"
    cases = []
    for name, rule in RULES:
        larger = [_order(other) for other_name, other in RULES if other_name != name and _contained(rule, other)]
        tests = [f"regexp_matches(line, {text(_order(rule))})"] + [f"NOT regexp_matches(line, {text(o)})" for o in larger]
        cases.append(f"CASE WHEN {' AND '.join(tests)} THEN {text(name)} END")
    return f"""
WITH a AS (SELECT doc_id, string_split_regex({lines}, {text(_SENTENCE_END)}) AS s FROM documents),
b AS (
  SELECT doc_id,
    list_filter(list_transform(s, lambda x: {plain}), lambda x: x <> '') AS s,
    list_filter(list_transform(list_transform(flatten(list_transform(s, lambda x: CASE WHEN contains(x, chr(10)) THEN list_concat([x], string_split(x, chr(10))) ELSE [x] END)),
      lambda x: {plain}), lambda x: element_at({known}, x)[1]), lambda x: x IS NOT NULL) AS ids
  FROM a),
c AS (SELECT *, '|' || array_to_string(ids, '|') || '|' AS line FROM b),
d AS (SELECT *, CASE WHEN len(ids) = 0 THEN [] ELSE list_sort(list_distinct(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL))) END AS found FROM c)
SELECT doc_id, len(s) AS n_sentences, array_to_string(ids, ',') AS sentences,
  len(list_filter(s, lambda x: regexp_matches(x, '(^| )(licen[cs]e|licen[cs]ed|copyright|spdx)( |$)') AND len(element_at({known}, x)) = 0)) AS n_unknown,
  array_to_string(CASE WHEN len(found) > 1 THEN list_filter(found, lambda x: x <> {text(_NO_LICENCE)}) ELSE found END, ',') AS licences
FROM d
"""
