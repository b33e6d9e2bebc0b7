import textwrap

import duckdb
import pandas as pd
import pytest

from navlib.llm import licenses as L

MIT = "\n".join(f"# {L.SENTENCES[s]}" for s in ("mit-grant", "mit-condition")) + "\n\n" + L.SENTENCES["mit-as-is"] + " " + L.SENTENCES["mit-liability"]
BSD3 = " ".join(f"{i}. {L.SENTENCES[s]}" for i, s in enumerate(("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")))


def licences(df):
    return {r.doc_id: r.licences for r in L.scan(df).collect()}


def test_rules_in_order(make_docs, extra):
    texts = [
        MIT,
        BSD3,
        BSD3.replace(L.SENTENCES["bsd-endorse"], "Other words."),
        " ".join(L.SENTENCES[s] for s in ("bsd-binary", "bsd-source", "bsd-grant")),
        "some words without a stop\nLicensed under CC BY-NC 4.0.\nmore",
        "Intro. Released under the MIT License. And licensed\n under the Apache License, Version 2.0.\n\nLicensed under the Apache License, Version 2.0.",
        None,
        "",
        "Licence unknown to all.",
        L.SENTENCES["gpl-free"] + " " + L.SENTENCES["gpl3-later"],
        L.SENTENCES["gpl2-later"],
        "x. " * 20000 + "This work is licensed under the GNU General Public License, version 3.",
    ]
    got = licences(extra(make_docs(texts + texts[:1])))
    assert [got[i] for i in range(len(texts) + 1)] == [
        "MIT",
        "BSD-3-Clause",
        "BSD-2-Clause",
        "",
        "CC-BY-NC-4.0",
        "Apache-2.0,MIT",
        "",
        "",
        "",
        "GPL-3.0-or-later",
        "GPL-2.0-or-later",
        "GPL-3.0-only",
        "MIT",
    ]


def test_digest_columns(make_docs):
    row = L.scan(make_docs(["A line. Licence unknown to all. " + BSD3])).collect()[0]
    assert row.sentences == "bsd-grant,bsd-source,bsd-binary,bsd-endorse" and row.n_unknown == 1
    assert L.scan(make_docs(["x"]).limit(0)).collect() == []


def test_no_python_in_the_plan(make_docs):
    plan = L.scan(make_docs(["x"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Published notices as they stand in files: licence, lines about the holder, paragraphs.
HOLDER = "Copyright (c) 2021, Jane Doe <jane@example.org>"
WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
)
MIT_PARTS = [
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
]
BSD_PARTS = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
]
BSD_NAME = "3. Neither the name of the University of Somewhere, Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.'
NOTICES = [
    ("MIT", [HOLDER], MIT_PARTS),
    ("MIT", ["MIT License", "", HOLDER], MIT_PARTS),
    ("MIT", ["The MIT License (MIT)", "", HOLDER], MIT_PARTS[:2]),
    ("BSD-2-Clause", [HOLDER, "All rights reserved."], [*BSD_PARTS, BSD_END]),
    ("BSD-3-Clause", [HOLDER + ". All rights reserved."], [*BSD_PARTS, BSD_NAME, BSD_END]),
    ("BSD-3-Clause", [HOLDER], [*BSD_PARTS, "3. The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission.", BSD_END]),
    ("Apache-2.0", ["Copyright 2021 The Authors"], [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
        "    http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ]),
    ("GPL-2.0-or-later", [HOLDER], ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", WARRANTY]),
    ("GPL-2.0-only", [HOLDER], ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."]),
    ("GPL-3.0-or-later", [HOLDER], ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", WARRANTY]),
    ("GPL-3.0-or-later", ["(C) 2021 Jane Doe"], ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."]),
    ("LGPL-2.1-or-later", [HOLDER], ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."]),
    ("LGPL-3.0-or-later", [HOLDER], ["This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."]),
    ("AGPL-3.0-or-later", [HOLDER], ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."]),
    ("MPL-2.0", [], ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."]),
    ("ISC", ["Copyright (c) 2021 Jane Doe"], ["Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.']),
    ("0BSD", [HOLDER], ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."]),
    ("Zlib", [HOLDER], ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"]),
    ("BSL-1.0", [HOLDER], ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"]),
    ("BSL-1.0", ["Boost Software License - Version 1.0 - August 17th, 2003"], ['Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:']),
    ("EPL-2.0", [HOLDER], ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"]),
    ("CC-BY-SA-4.0", [HOLDER], ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/."]),
    ("CC-BY-4.0", [], ["This work is licensed under a Creative Commons Attribution 4.0 International License."]),
    ("Unlicense", [], ["This is free and unencumbered software released into the public domain."]),
    ("GPL-3.0", ["                    GNU GENERAL PUBLIC LICENSE", "                       Version 3, 29 June 2007", "", " Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>", " Everyone is permitted to copy and distribute verbatim copies", " of this license document, but changing it is not allowed."], ["Preamble"]),
    ("LGPL-2.1", ["                  GNU LESSER GENERAL PUBLIC LICENSE", "                       Version 2.1, February 1999"], ["Preamble"]),
    ("Apache-2.0", ["                                 Apache License", "                           Version 2.0, January 2004", "                        http://www.apache.org/licenses/"], ["TERMS AND CONDITIONS"]),
    ("Proprietary", [HOLDER + ". All rights reserved."], ["No part of this may be copied."]),
]


def lines_of(holder, parts, width=72):
    lines = list(holder)
    for p in parts:
        lines += [""] * bool(lines) + (textwrap.wrap(p, width, break_on_hyphens=False, break_long_words=False) if not p.startswith(" ") else [p])
    return lines


STYLES = {
    "plain": lambda x: "\n".join(x) + "\n",
    "block": lambda x: "/*\n" + "\n".join(f" * {line}".rstrip() for line in x) + "\n */\nint main(void)\n{\n",
    "open block": lambda x: "/* " + "\n   ".join(x) + " */\nint x;\n",
    "slashes": lambda x: "\n".join(f"// {line}".rstrip() for line in x) + "\npackage main\n",
    "hashes": lambda x: "#!/bin/sh\n#\n" + "\n".join(f"# {line}".rstrip() for line in x) + "\n#\nset -e\n",
    "dashes": lambda x: "\n".join(f"-- {line}".rstrip() for line in x) + "\nSELECT 1\n",
    "semicolons": lambda x: "\n".join(f";; {line}".rstrip() for line in x) + "\n(car x)\n",
    "html": lambda x: "<!--\n" + "\n".join(x) + "\n-->\n<p>text\n",
    "windows": lambda x: "\r\n".join(f"// {line}".rstrip() for line in x) + "\r\nint x\r\n",
}


@pytest.mark.parametrize("style", STYLES)
def test_published_notices(make_docs, style):
    for width in (72, 60):
        texts = [STYLES[style](lines_of(holder, parts, width)) for _, holder, parts in NOTICES]
        got = licences(make_docs(texts))
        wrong = [(k, n[0], got[k]) for k, n in enumerate(NOTICES) if got[k] != n[0]]
        assert not wrong


def test_spdx_lines(make_docs):
    texts = ["// SPDX-License-Identifier: MIT\nint x;", "/* SPDX-License-Identifier: GPL-2.0-only */", "# SPDX-License-Identifier: Apache-2.0", "x SPDX-License-Identifier: Unknown-1.0\n", "a\nSPDX-License-Identifier:BSD-3-Clause\nb. c"]
    rows = {r.doc_id: r for r in L.scan(make_docs(texts)).collect()}
    assert [rows[i].licences for i in range(5)] == ["MIT", "GPL-2.0-only", "Apache-2.0", "", "BSD-3-Clause"]
    assert rows[3].n_unknown == 1


def test_prose_is_left_alone(make_docs):
    texts = [
        "I asked for permission to use, copy and modify the house. It was hereby granted, free of charge.",
        "The MIT License is short. Apache License is longer; GNU General Public License longest.",
        "Neither the name of the rose nor the names of its petals matter.",
        "* item\n* item\n# Heading\n-- a dash\n% percent",
        "Copyright law is old\nand all rights are reserved to the people.",
    ]
    assert set(licences(make_docs(texts)).values()) == {""}


def test_sql_on_notices(spark, make_docs, odd_texts):
    texts = [style(lines_of(h, p)) for style in STYLES.values() for _, h, p in NOTICES] + [t for t in odd_texts if t is None or len(t) < 5000]
    docs = make_docs(texts)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": pd.Series(texts, dtype=object)}))
    assert sorted(map(tuple, L.scan(docs).collect())) == sorted(con.execute(L.oracle()).fetchall())
