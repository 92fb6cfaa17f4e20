import re

import duckdb
import pytest

from cadenza.llm import licences as L

MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use. '
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING ANY. '
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER."
)
CASES = [
    ("Prose here.\nThis work is licensed under the GNU General Public License, version 3.\nMore.", "GPL-3.0-only"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
    ("Released under the MIT License.", "MIT"),
    ("x y.\nLicensed under the Apache License, Version 2.0.\nMIT is a place. Released under the MIT License", "Apache-2.0,MIT"),
    (MIT, "MIT"),
    (MIT.replace("The above", "Odd words. The above"), ""),
    ('Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.', "Apache-2.0"),
    ("Copyright (c) 2020 A. B. All rights reserved.", "all-rights-reserved"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "GPL-3.0-or-later"),
    ("the licence of poets", ""),
    ("no cue at all", ""),
    ("", ""),
    (None, ""),
    ("long words " * 20000 + ". Released under the MIT License.", "MIT"),
]


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, (t, _) in enumerate(CASES)] + [(2, CASES[2][0], "x", 1), (None, None, "x", 1)], "doc_id long, text string, licences string, marks int")
    return L.scan(docs).collect()


def test_cases(rows):
    assert len(rows) == len(CASES) + 2
    for r in rows:
        if r.doc_id is not None:
            assert r.licences == CASES[r.doc_id][1], CASES[r.doc_id][0]
        assert r.n_known == len([x for x in r.sentence_ids.split(",") if x])


def test_every_sentence_has_a_cue():
    def has(s):
        return any(c in s for c in L.CUES)

    assert all(has(w) for w in re.search(r"\((licensed[^)]*)\)", L._GRANT).group(1).split("|"))
    rest = {n: re.sub(r"\([^()]*\)\?", "", p) for n, p in L.SENTENCES if L._GRANT not in p}
    assert {n for n, p in rest.items() if not has(p)} <= {"apache2_comply"}  # its "license" is at the end of a group
    assert has("you may not use this file except in compliance with the license")
    assert {x for _, ids in L.RULES for x in ids} <= {n for n, _ in L.SENTENCES}


def test_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(L.oracle_sql()).fetchall()
    got = [tuple(r) for r in L.scan(spark.read.parquet(f"{sf}/documents.parquet")).collect()]
    assert sorted(got) == sorted(want) and any(r[3] for r in got)


def test_native_plan_without_shuffle(spark):
    df = L.scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert df.limit(0).collect() == []


WHOLE = {
    "MIT": """MIT License

Copyright (c) 2020 A. B.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE.
""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS".
""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
""",
}
KNOWN = {
    "MIT": "mit_grant,mit_notice,mit_as_is,mit_liability",
    "BSD-3-Clause": "bsd_allow,bsd_source,bsd_binary,bsd_names",
    "GPL-2.0-or-later": "gpl2_later,gpl_hope",
    "Apache-2.0": "apache2_named,apache2_comply,apache2_copy,apache2_as_is,apache2_see",
}


def whole_forms(text):
    yield text
    yield re.sub(r"(?<!\n)\n(?!\n) *", " ", text)  # a paragraph a line
    yield " ".join(text.split())  # one line
    yield text.replace("\n", "\r\n")
    for prefix in ("# ", "// ", ";; ", "! ", "dnl "):
        yield "".join(f"{prefix}{line}".rstrip() + "\n" for line in text.splitlines())
    yield "/*\n" + "".join(f" * {line}".rstrip() + "\n" for line in text.splitlines()) + " */\nint main;\n"


def test_whole_texts(spark):
    cases = [(name, form) for name, text in WHOLE.items() for form in whole_forms(text)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    for r in L.scan(docs).collect():
        name, text = cases[r.doc_id]
        assert KNOWN[name] in r.sentence_ids and r.licences == name, (r, text)


def test_runs_of_segments(spark):
    cases = [
        ("A title\nReleased under the MIT License\nmore text", "mit_named", "MIT"),
        ("Released under the\nMIT License\nmore text", "mit_named", "MIT"),
        ("Distributed under the terms of the GNU General Public License, version\n3.", "gpl3_named", "GPL-3.0-only"),
        ("Copyright 2020 A\nAll rights reserved.", "copyright,reserved", "all-rights-reserved"),
        (WHOLE["MIT"].replace("The above", "Odd words.\nThe above"), "copyright,mit_grant,mit_notice,mit_as_is,mit_liability", ""),
        (WHOLE["MIT"].replace("The above", "да.\nThe above"), "copyright,mit_grant,mit_notice,mit_as_is,mit_liability", ""),
        ("Released under the. MIT License", "", ""),
        ("license" + "\n" * 100_000 + "1. " * 100_000 + "Released under the MIT License", "mit_named", "MIT"),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: (r.sentence_ids, r.licences) for r in L.scan(docs).collect()}
    for i, (text, ids, licences) in enumerate(cases):
        assert got[i] == (ids, licences), text[:200]


def test_cues_however_their_words_are_parted(spark):
    texts = ["All  Rights\u00a0Reserved", "ALL-RIGHTS-RESERVED", "All rights\treserved.", "All rights\nreserved.", "Dedicated to the public\ndomain."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.licences for r in L.scan(docs).collect()}
    assert got == {**dict.fromkeys(range(4), "all-rights-reserved"), 4: "CC0-1.0"}


HEADERS = [
    ("// SPDX-License-Identifier: MIT\nint main;", "MIT"),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0-or-later"),
    ("# SPDX-License-Identifier: LGPL-2.1+\n", "LGPL-2.1"),
    ("SPDX-License-Identifier: MIT OR Odd-1.0", ""),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    ("The contents of this file are subject to the Mozilla Public License, v. 1.1.", ""),
    (" * This program is free software; you can redistribute it and/or modify\n * it under the terms of the GNU General Public License version 2 as\n * published by the Free Software Foundation.", "GPL-2.0-only"),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.", "LGPL-2.1-or-later"),
    ("Distributed under the Boost Software License, Version 1.0.\n(See accompanying file)", "BSL-1.0"),
    ("Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation covered by\nthis license (the \"Software\") to use, reproduce, display.", "BSL-1.0"),
    ("This is free and unencumbered software released into the public domain.\n\nAnyone is free.", "Unlicense"),
    ("This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\narising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin", "Zlib"),
]


def test_tags_and_headers(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(HEADERS)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in L.scan(docs).collect()}
    assert got == {i: licence for i, (_, licence) in enumerate(HEADERS)}
