"""Licence scan by sentence rules (operator 8), with SQL functions only.

Texts are cut into pieces at line feeds and end marks and these normalised (lower case, everything but ASCII letters and
digits is one space). A fixed table maps normalised sentences to licence-sentence identifiers. A sentence is found where a
run of whole pieces, joined, equals it: so wrapped lines, comment marks (``#``, ``//``, ``*``, ``rem``, ``dnl``), and marks within
a sentence ("free software: you", "v. 2.0") do not hide it. Of sentences that begin at one piece the longest counts, and
the next begins behind it. Every document becomes the sequence of the identifiers it holds. Ordered rules are matched against the
sequence: a rule names identifiers that must follow each other in its order, with any others between them,
and the licence they prove; a licence whose rule another's contains gives way to it.

Everything is expressions over one row: no join, no shuffle, no Python on the executors.

Edge cases: null and empty texts have no sentences and no licence; sentences longer than any rule's are looked
up like others and found nowhere; repeated rows are each scanned; other columns pass through, but for sentence_ids, rules and licenses, which
the results replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, sql_string, table, without

#: Licence sentences, normalised: identifier -> texts. Fixed values, from the licences' published texts.
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-note": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "distributed under the mit license", "mit license", "the mit license"),
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    "mit-condition": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "mit-warranty": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    ),
    "apache-2-note": ("licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "released under the apache license version 2 0", "apache license version 2 0"),
    "apache-terms": ("you may not use this file except in compliance with the license",),
    "apache-copy": ("you may obtain a copy of the license at http www apache org licenses license 2 0",),
    "apache-warranty": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    "gpl-3-note": (
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "released under the gnu general public license version 3",
    ),
    "gpl-2-note": ("this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"),
    "gpl-free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        "this software is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    "gpl-2-free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
        "this software is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    ),
    "agpl-3-free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    "lgpl-3-free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    "lgpl-2-1-free": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    ),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
        "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
        "this software is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    ),
    "agpl-3-note": ("licensed under the gnu affero general public license version 3", "this work is licensed under the gnu affero general public license version 3"),
    "lgpl-note": ("licensed under the gnu lesser general public license version 3", "this work is licensed under the gnu lesser general public license version 3"),
    "bsd-grant": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "bsd-source": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    "bsd-name": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    ),
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "mpl-2-note": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "epl-1-note": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
    ),
    "epl-2-note": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
        "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at https www eclipse org legal epl 2 0",
    ),
    "boost-note": ("distributed under the boost software license version 1 0", "boost software license version 1 0 august 17th 2003"),
    "zlib-as-is": ("this software is provided as is without any express or implied warranty",),
    "zlib-grant": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    ),
    "cc0-note": ("to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "cc-by-note": ("this work is licensed under a creative commons attribution 4 0 international license",),
    "cc-by-sa-note": ("this work is licensed under a creative commons attribution sharealike 4 0 international license",),
    "all-rights": ("all rights reserved",),
}

#: (rule, licence, identifiers in order). ``OVERRIDES`` says which licence gives way to which.
RULES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("mit-notice", "MIT", ("mit-note",)),
    ("mit-text", "MIT", ("mit-grant", "mit-condition", "mit-warranty")),
    ("mit-short-text", "MIT", ("mit-grant", "mit-warranty")),
    ("apache-notice", "Apache-2.0", ("apache-2-note",)),
    ("apache-header", "Apache-2.0", ("apache-2-note", "apache-terms", "apache-warranty")),
    ("gpl-3-notice", "GPL-3.0", ("gpl-3-note",)),
    ("gpl-3-header", "GPL-3.0", ("gpl-free", "gpl-hope")),
    ("gpl-2-notice", "GPL-2.0", ("gpl-2-note",)),
    ("gpl-2-header", "GPL-2.0", ("gpl-2-free", "gpl-hope")),
    ("agpl-notice", "AGPL-3.0", ("agpl-3-note",)),
    ("agpl-header", "AGPL-3.0", ("agpl-3-free", "gpl-hope")),
    ("lgpl-notice", "LGPL-3.0", ("lgpl-note",)),
    ("lgpl-3-header", "LGPL-3.0", ("lgpl-3-free", "gpl-hope")),
    ("lgpl-2-1-header", "LGPL-2.1", ("lgpl-2-1-free", "gpl-hope")),
    ("bsd-2-text", "BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("bsd-3-text", "BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("isc-text", "ISC", ("isc-grant",)),
    ("mpl-2-notice", "MPL-2.0", ("mpl-2-note",)),
    ("epl-1-notice", "EPL-1.0", ("epl-1-note",)),
    ("epl-2-notice", "EPL-2.0", ("epl-2-note",)),
    ("boost-notice", "BSL-1.0", ("boost-note",)),
    ("zlib-text", "Zlib", ("zlib-as-is", "zlib-grant")),
    ("cc0-notice", "CC0-1.0", ("cc0-note",)),
    ("unlicense-text", "Unlicense", ("unlicense",)),
    ("cc-by-notice", "CC-BY-4.0", ("cc-by-note",)),
    ("cc-by-sa-notice", "CC-BY-SA-4.0", ("cc-by-sa-note",)),
    ("all-rights-notice", "Proprietary", ("all-rights",)),
)
OVERRIDES = {"BSD-2-Clause": "BSD-3-Clause"}

#: Words that mark comment lines in some languages.
_REMARK = r"(?m)^[ \t]*(?:rem|dnl)[ \t]"
#: A piece ends at a line feed, or at . ! ? ; : before white space or the end.
_END = r"\n|[.!?;:]+(?=\s|$)"
#: The sentences over normalised text, in which a space parts words and a line feed pieces; the longer first.
_KNOWN = "(?m)^(?:" + "|".join(s.replace(" ", "[ \\n]") for s in sorted((s for texts in SENTENCES.values() for s in texts), key=len, reverse=True)) + ")$"
#: Every licence sentence has a word with one of these; a text without any needs no cutting. Normalising keeps words whole.
STEMS = ("licens", "softw", "redistrib", "warrant", "reserved")
assert all(any(x in s for x in STEMS) for texts in SENTENCES.values() for s in texts)


def sentence_ids(text: Column) -> Column:
    """Identifiers of the licence sentences of a text, in order."""
    known = F.create_map(*(F.lit(x) for k, texts in SENTENCES.items() for s in texts for x in (s, k)))
    low = F.lower(text)
    some = "|".join(STEMS)
    pieces = F.regexp_replace(F.regexp_replace(F.regexp_replace(low, _REMARK, ""), _END, "\n"), "[^a-z0-9\n]+", " ")
    pieces = F.trim(F.regexp_replace(pieces, " ?\n[ \n]*", "\n"))
    found = F.transform(F.regexp_extract_all(pieces, F.lit(_KNOWN), F.lit(0)), lambda s: known[F.translate(s, "\n", " ")])
    return F.when(low.rlike(some), found).otherwise(F.array().cast("array<string>"))


def matched(ids: Column) -> Column:
    """Names of the rules whose identifiers follow each other in the sequence."""
    joined = F.concat(F.lit("/"), F.array_join(ids, "/"), F.lit("/"))
    tests = [F.when(joined.rlike("/(?:.*/)?".join(["/" + parts[0], *parts[1:]]) + "/"), F.lit(name)) for name, _, parts in RULES]
    return F.when(F.size(ids) > 0, F.array_compact(F.array(*tests))).otherwise(F.array().cast("array<string>"))


def licenses(rules: Column) -> Column:
    """Licences that the rules prove, sorted; one that gives way to another present goes."""
    of = F.create_map(*(F.lit(x) for name, licence, _ in RULES for x in (name, licence)))
    all_of = F.array_sort(F.array_distinct(F.transform(rules, lambda r: of[r])))
    for weak, strong in OVERRIDES.items():
        all_of = F.when(F.array_contains(all_of, strong), F.array_remove(all_of, weak)).otherwise(all_of)
    return all_of


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` without text, with sentence_ids, rules and licenses (arrays)."""
    docs = without(docs, "sentence_ids", "rules", "licenses")
    rest = [quoted(c) for c in docs.columns if c != "text"]
    out = docs.select(*rest, sentence_ids(F.col("text")).alias("sentence_ids"))
    out = out.withColumn("rules", matched(F.col("sentence_ids")))
    return out.withColumn("licenses", licenses(F.col("rules")))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("rules", ",").alias("rules"),
        F.array_join("licenses", ",").alias("licenses"),
    )


_MAP = ", ".join(f"({sql_string(s)}, {sql_string(k)})" for k, texts in SENTENCES.items() for s in texts)
_RULES = ", ".join(
    f"({i}, {sql_string(name)}, {sql_string(licence)}, {sql_string('/' + '/(?:.*/)?'.join(parts) + '/')})" for i, (name, licence, parts) in enumerate(RULES)
)
ORACLE = f"""
WITH known(sentence, id) AS (VALUES {_MAP}), rule(i, name, licence, pattern) AS (VALUES {_RULES}),
low AS (SELECT doc_id, regexp_replace(lower(coalesce(text, '')), {sql_string(_REMARK)}, '', 'g') || ' ' AS l FROM documents),
cut AS (
  -- DuckDB's patterns have no look-ahead: the white space behind an end mark is kept by a group.
  SELECT doc_id, regexp_replace(regexp_replace(l, '[.!?;:]+([ \t\r\f\v\n])', chr(10) || '\1', 'g'), '[^a-z0-9\n]+', ' ', 'g') AS l FROM low
), runs AS (
  SELECT doc_id, regexp_extract_all(trim(regexp_replace(l, ' ?\n[ \n]*', chr(10), 'g'), ' '), {sql_string(_KNOWN)}) AS found FROM cut
), sentences AS (SELECT doc_id, generate_subscripts(found, 1) AS n, translate(unnest(found), chr(10), ' ') AS sentence FROM runs),
seq AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY s.n) AS ids FROM sentences s JOIN known USING (sentence) GROUP BY doc_id),
hit AS (SELECT doc_id, i, name, licence FROM seq, rule WHERE regexp_matches('/' || replace(ids, ',', '/') || '/', pattern)),
rules AS (SELECT doc_id, string_agg(name, ',' ORDER BY i) AS rules FROM hit GROUP BY doc_id),
lic AS (
  SELECT doc_id, string_agg(licence, ',' ORDER BY licence) AS licenses FROM (SELECT DISTINCT doc_id, licence FROM hit) h
  WHERE NOT (licence = 'BSD-2-Clause' AND EXISTS (SELECT 1 FROM hit o WHERE o.doc_id = h.doc_id AND o.licence = 'BSD-3-Clause')) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(rules, '') AS rules, coalesce(licenses, '') AS licenses
FROM documents d LEFT JOIN seq USING (doc_id) LEFT JOIN rules USING (doc_id) LEFT JOIN lic USING (doc_id)
"""
