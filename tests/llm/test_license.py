"""Licence scan: rules, order, overlaps and edge cases."""

from voltweave.llm import license_scan as L


def scan(spark, make_docs, texts):
    return [(r.sentence_ids, r.rules, r.licenses) for r in sorted(L.scan(make_docs(texts)).collect(), key=lambda r: r.doc_id)]


def whole(*ids):
    return "\n".join(L.SENTENCES[k][0].capitalize() + "." for k in ids)


def test_rules(spark, make_docs):
    got = scan(spark, make_docs, [
        "Words. Released under the MIT License.\nMore.",
        "Licensed under the Apache License, Version 2.0.\nFine",
        "This work is licensed under the GNU General Public License, version 3.",
        whole("bsd-grant", "bsd-source", "bsd-binary", "bsd-name"),
        whole("bsd-grant", "bsd-source", "bsd-binary"),
        whole("bsd-binary", "bsd-source", "bsd-grant"),
        "x " + whole("mit-grant") + "\nother words\n" + whole("mit-condition", "mit-warranty"),
    ])
    assert got[0] == (["mit-note"], ["mit-notice"], ["MIT"])
    assert got[1][2] == ["Apache-2.0"] and got[2][2] == ["GPL-3.0"]
    assert got[3][2] == ["BSD-3-Clause"] and got[4][2] == ["BSD-2-Clause"] and got[5][2] == []
    assert got[6][0] == ["mit-condition", "mit-warranty"]  # the first sentence has a word too many
    assert got[6][2] == []


def test_edge_cases(spark, make_docs):
    got = scan(spark, make_docs, [None, "", "license", "a" * 300_000 + " license.", "MIT LICENSE", "mit   license.\nMIT license"])
    assert [g[2] for g in got] == [[], [], [], [], ["MIT"], ["MIT"]]
    assert L.scan(make_docs([])).collect() == []
    extra = L.scan(make_docs(["the mit license"]).selectExpr("*", "1 AS rules_", "2 AS known"))
    assert extra.first().known == 2


MIT = """The MIT License (MIT)

Copyright (c) 2015 A. Author

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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


GPL2 = GPL.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2")
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details."""
LGPL3 = GPL.replace("GNU General Public License as", "GNU Lesser General Public License as")
AGPL = GPL.replace("GNU General Public License as", "GNU Affero General Public License as")
BSD2 = BSD[: BSD.index("3. Neither")]
EPL1 = """All rights reserved. This program and the accompanying materials
are made available under the terms of the Eclipse Public License v1.0
which accompanies this distribution, and is available at
http://www.eclipse.org/legal/epl-v10.html
"""
EPL2 = """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/

SPDX-License-Identifier: EPL-2.0"""
BOOST = """         Copyright A. Author 2004 - 2006.
Distributed under the Boost Software License, Version 1.0.
   (See accompanying file LICENSE_1_0.txt or copy at
         https://www.boost.org/LICENSE_1_0.txt)"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty.  In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:"""
CC0 = """To the extent possible under law, the author(s) have dedicated all copyright
and related and neighboring rights to this software to the public domain
worldwide. This software is distributed without any warranty."""
#: Published texts beside the operator's own table, and the licences they state.
PUBLISHED = {
    "MIT": MIT, "Apache-2.0": APACHE, "GPL-3.0": GPL, "BSD-3-Clause": BSD, "ISC": ISC, "MPL-2.0": MPL, "GPL-2.0": GPL2, "LGPL-2.1": LGPL, "LGPL-3.0": LGPL3,
    "AGPL-3.0": AGPL, "BSD-2-Clause": BSD2, "EPL-2.0": EPL2, "BSL-1.0": BOOST, "Zlib": ZLIB, "CC0-1.0": CC0,
}


def forms():
    """Each published text as it is, on one line, with line feeds of another kind, and as a comment of several languages."""
    comment = lambda mark, t: "\n".join(f"{mark} {line}" for line in t.splitlines())
    for name, t in PUBLISHED.items():
        paragraphs = "\n".join(" ".join(p.split()) for p in t.split("\n\n"))
        for form in (t, paragraphs, t.replace("\n", "\r\n"), "/*\n" + comment(" *", t) + "\n */\nint main;", *(comment(m, t) for m in ("#", "//", "--", ";;", "REM", "dnl", "%"))):
            yield name, form


def test_published_texts_in_every_form(spark, make_docs):
    cases = list(forms())
    got = scan(spark, make_docs, [t for _, t in cases])
    assert [(n, g[2]) for (n, _), g in zip(cases, got, strict=True)] == [(n, [n]) for n, _ in cases]
    assert scan(spark, make_docs, [EPL1])[0][2] == ["EPL-1.0", "Proprietary"]  # it reserves all rights, too


def test_sql_finds_the_same_in_wrapped_texts(spark, make_docs, tmp_path):
    import duckdb

    texts = [t for _, t in forms()] + [EPL1, None, "", "not\nreleased under the\nMIT license", "x" * 50_000 + "\nMIT license", "MIT license. MIT\nLicense;\n\nMIT", "\u212aIT the mit license"]
    make_docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    names = ["doc_id", "n_sentences", "sentence_ids", "rules", "licenses"]
    got = sorted(tuple(r) for r in L.op8_license_scan(spark, str(tmp_path)).select(names).collect())
    assert got == sorted(c.execute(f"SELECT {', '.join(names)} FROM ({L.ORACLE})").fetchall())


def test_clashing_columns(spark, make_docs):
    docs = make_docs(["the MIT license"]).selectExpr("*", "1 AS rules", "2 AS Licenses", "3 AS sentence_ids", "4 AS `a.b`")
    r = L.scan(docs).first()
    assert r.rules == ["mit-notice"] and r.licenses == ["MIT"] and r.sentence_ids == ["mit-note"] and r["a.b"] == 4


def test_published_texts_as_wrapped(spark, make_docs):
    comment = lambda mark, t: "\n".join(f"{mark} {line}" for line in t.splitlines())
    texts = [MIT, APACHE, GPL, BSD, ISC, MPL]
    want = [["MIT"], ["Apache-2.0"], ["GPL-3.0"], ["BSD-3-Clause"], ["ISC"], ["MPL-2.0"]]
    got = scan(spark, make_docs, texts + [comment("#", t) for t in texts] + ["/*\n" + comment(" *", t) + "\n */\nint main;" for t in texts] + [t.replace("\n", "\r\n") for t in texts])
    assert [g[2] for g in got] == want * 4
    assert got[0][0] == ["mit-grant", "mit-condition", "mit-warranty"]
    assert got[1][0] == ["apache-2-note", "apache-terms", "apache-copy", "apache-warranty"]
    assert got[2][0] == ["gpl-free", "gpl-hope"] and got[5][0] == ["mpl-2-note"]
    assert scan(spark, make_docs, ["not\nreleased under the\nMIT license", "the MIT\nlicense is"])[1] == ([], [], [])
