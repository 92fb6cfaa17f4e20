"""Licence scan by sentence rules, in DataFrame functions only.

A text is cut into segments at line ends and after sentences, and normalised
(lower case, runs of other characters than letters and digits as one space).
A licence sentence is a run of whole segments: its words may stand on several
lines, behind comment signs, and around ``;`` or an empty line, but not across
a full stop. Each gets its identifier; segments without letters or digits and
bare list numbers are no sentences. The sequence of identifiers is
then matched against ordered rules: the first rule takes its places out of
the sequence, the next sees what is left, so a whole licence text or header
is recognised before a sentence of it could pass for something weaker.
Unknown sentences stay in the sequence and keep rules from matching across
them.

Only texts with the last word of one of ``CUES``, one of which is in every
licence sentence, are cut up.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentence breaks, and the licence sentences as patterns over normalised sentences.
BREAK = r"[.!?;]+[ \t\r\n]+|\n"
CUES = ["licen", "copyright", "rights reserved", "warrant", "redistribut", "permission", "public domain", "liab", "free software", "released", "distributed", "published", "available"]

_GRANT = "((this|the) (work|file|program|software|project|code|text|document|content|material|article) is )?(licensed|released|distributed|published|available|made available) under (the )?(terms of the )?"

#: GNU licences whose headers state a version: (short name, name, version in words).
GNU_VERSIONS = [
    *((short, name, n) for short, name in (("gpl", "general public license"), ("lgpl", "lesser general public license"), ("agpl", "affero general public license")) for n in ("2", "3")),
    ("lgpl", "lesser general public license", "2 1"),
]

#: Identifiers of a tag line as normalised, with the licence each names. A plus sign is not kept, so a bare GNU version says neither only nor later.
SPDX: list[tuple[str, str]] = [
    *((re.sub("[^a-z0-9]+", " ", x.lower()), x) for x in ("MIT", "MIT-0", "ISC", "Zlib", "BSL-1.0", "Unlicense", "0BSD", "Apache-2.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0")),
    *((f"{short} {n.replace('.', ' ')}{suffix.replace('-', ' ')}", f"{short.upper()}-{n}{suffix}") for short, n in (("gpl", "2.0"), ("gpl", "3.0"), ("lgpl", "2.1"), ("lgpl", "3.0"), ("agpl", "3.0")) for suffix in ("-only", "-or-later", "")),
]

SENTENCES: list[tuple[str, str]] = [
    ("apache2_named", _GRANT + "apache (software )?license( version)? 2( 0)?( the license)?"),
    ("apache2_comply", "you may not use this file except in compliance with the license"),
    ("apache2_copy", "you may obtain a copy of the license at( https?)?( www apache org licenses license 2 0)?"),
    ("apache2_as_is", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache2_see", "see the license for the specific language governing permissions and limitations under the license"),
    ("mit_named", _GRANT + "(mit|expat) license"),
    ("mit_grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction .*"),
    ("mit_notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit_as_is", "the software is provided as is without warranty of any kind express or implied .*"),
    ("mit_liability", "in no event shall the authors or copyright holders be liable for any claim damages or other liability .*"),
    ("isc_named", _GRANT + "isc license"),
    ("isc_grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted .*"),
    *((f"bsd{n}_named", _GRANT + f"bsd {n} clause license") for n in (2, 3)),
    ("bsd_named", _GRANT + "bsd license"),
    ("bsd_allow", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd_source", "([0-9] )?redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd_binary", "([0-9] )?redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd_names", "([0-9] )?neither the name of .* nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    *((f"{short}{n}_named", _GRANT + f"gnu {name}( license)?( as published by the free software foundation)?( either)?( version)? {n}( 0)?( of the license)?") for short, name in (("gpl", "general public license"), ("lgpl", "lesser general public license"), ("agpl", "affero general public license")) for n in (1, 2, 3)),
    *((f"{short}_named", _GRANT + f"gnu {name}") for short, name in (("gpl", "general public license"), ("lgpl", "lesser general public license"), ("agpl", "affero general public license"))),
    *((f"{short}{n.replace(' ', '')}_only", f"(this (program|library|file) is free software )?you can redistribute it and or modify it under the terms of the gnu {name}( version {n} as published by the free software foundation| as published by the free software foundation version {n}( of the license)?)") for short, name, n in GNU_VERSIONS),
    *((f"{short}{n.replace(' ', '')}_later", f"(this (program|library|file) is free software )?you can redistribute it and or modify it under the terms of the gnu {name} as published by the free software foundation either version {n} of the license or at your option any later version") for short, name, n in GNU_VERSIONS),
    ("gpl_free", "this (program|library|file) is free software"),
    ("gpl_hope", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl_copy", "you should have received a copy of the gnu general public license along with this program( if not see .*)?"),
    ("mpl2_named", "((this|the) source code form is subject to the terms of the|" + _GRANT + ")( )?mozilla public license( v| version)? 2( 0)?"),
    ("mpl2_form", "(this|the) source code form is subject to the terms of the mozilla public license v"),
    ("boost_named", _GRANT + "boost software license( version)?( 1 0)?"),
    ("boost_grant", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license .*"),
    ("zlib_named", _GRANT + "zlib( libpng)? license"),
    ("zlib_as_is", "this software is provided as is without any express or implied warranty"),
    ("zlib_liability", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib_grant", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("unlicense_named", _GRANT + "unlicense"),
    ("unlicense_free", "this is free and unencumbered software released into the public domain"),
    *((f"spdx_{words.replace(' ', '_')}", f"spdx license identifier {words}") for words, _ in SPDX),
    *((f"cc_{kind.replace(' ', '_')}", _GRANT + f"(a )?(cc|creative commons) {words}( license)?( [0-9] [0-9])?( (international|unported|generic))?( license)?") for kind, words in (("by", "(by|attribution)"), ("by sa", "(by sa|attribution sharealike)"), ("by nd", "(by nd|attribution noderivatives)"), ("by nc", "(by nc|attribution noncommercial)"), ("by nc sa", "(by nc sa|attribution noncommercial sharealike)"), ("by nc nd", "(by nc nd|attribution noncommercial noderivatives)"))),
    ("cc0_named", "(" + _GRANT + "(cc0|creative commons zero)( license)?( 1 0)?( universal)?( license)?|.*dedicated to the public domain( under .*)?)"),
    ("reserved", "(copyright .* )?all rights reserved"),
    ("copyright", "copyright (c )?[0-9]{4}.*"),
]

#: Ordered rules: (licence, identifiers in sequence). Fixed values.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["apache2_named", "apache2_comply", "apache2_copy", "apache2_as_is", "apache2_see"]),
    ("Apache-2.0", ["apache2_named", "apache2_comply"]),
    ("MIT", ["mit_grant", "mit_notice", "mit_as_is", "mit_liability"]),
    ("MIT", ["mit_grant", "mit_notice"]),
    ("BSD-3-Clause", ["bsd_allow", "bsd_source", "bsd_binary", "bsd_names"]),
    ("BSD-2-Clause", ["bsd_allow", "bsd_source", "bsd_binary"]),
    *((f"{short.upper()}-{n.replace(' ', '.') if ' ' in n else n + '.0'}-{kind}", [*before, f"{short}{n.replace(' ', '')}_{end}"]) for end, kind in (("later", "or-later"), ("only", "only")) for short, _, n in GNU_VERSIONS for before in (["gpl_free"], [])),
    ("Zlib", ["zlib_as_is", "zlib_liability", "zlib_grant"]),
    ("Zlib", ["zlib_grant"]),
    ("BSL-1.0", ["boost_grant"]),
    ("Unlicense", ["unlicense_free"]),
    *((licence, [f"spdx_{words.replace(' ', '_')}"]) for words, licence in SPDX),
    ("ISC", ["isc_grant"]),
    ("Apache-2.0", ["apache2_named"]),
    ("MIT", ["mit_named"]),
    ("ISC", ["isc_named"]),
    ("BSD-2-Clause", ["bsd2_named"]),
    ("BSD-3-Clause", ["bsd3_named"]),
    ("BSD", ["bsd_named"]),
    *((f"{short.upper()}-{n}.0-only", [f"{short}{n}_named"]) for short in ("gpl", "lgpl", "agpl") for n in (1, 2, 3)),
    *((short.upper(), [f"{short}_named"]) for short in ("gpl", "lgpl", "agpl")),
    ("MPL-2.0", ["mpl2_named"]),
    ("MPL-2.0", ["mpl2_form"]),
    ("BSL-1.0", ["boost_named"]),
    ("Zlib", ["zlib_named"]),
    ("Unlicense", ["unlicense_named"]),
    *((f"CC-{kind}", [f"cc_{kind.lower().replace('-', '_')}"]) for kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")),
    ("CC0-1.0", ["cc0_named"]),
    ("all-rights-reserved", ["reserved"]),
]


def _mark(name: str) -> str:
    return f"<{name}>"


#: Sentences whose ``.*`` may run over line ends, up to the end of the sentence or paragraph.
PROSE = {"boost_grant", "mit_grant", "mit_as_is", "mit_liability", "isc_grant", "bsd_names"}
#: In lower-cased text S, P and L stand for the end of a sentence, a paragraph (or what leads a list) and a line; U for a segment in another script.
CUTS = [
    (r"(?m)^[ \t]*(?:[!#%;*/>-]+|dnl|rem)(?=[ \t\r\n]|$)", ""),  # comment signs
    (r"[.!?][.!?;]*[ \t\r\n]+", "S"),
    (r"((?:conditions|are met) *:|apache\.org/licenses/license-2\.0)[ \t\r\n]+", "$1P"),
    (r"\n[^\p{L}\p{N}]*\n", "P"),
    (r"\n|;+[ \t\r\n]+", "L"),
    (r"([SP])(?:[^\p{L}\p{N}]*+[SPL])++", "$1"),  # segments without letters and digits
    (r"L[^\p{L}\p{N}]*+(?=[SPL])", ""),
    (r"([SPL])(?=[^a-zSPL]*+[SPL])[^\p{L}]*+[\p{L}&&[^a-zSPL]][^SPL]*+", "$1U"),
    (r"[^a-z0-9SPLU]+", " "),
    (r" ?([SPL]) ?", "$1"),
]


def _over_lines(name: str, pattern: str) -> str:
    """The pattern of a sentence over a run of segments."""
    any_word, space = ("[a-z0-9 L]", "[ L]") if name in PROSE else ("[a-z0-9 ]", " ")
    around = {" ": space, ".*": f"{any_word}*"}
    first, *rest = re.split(r"( ?)(\.\*)( ?)", pattern)
    words = [p.replace(" ", "[ LP]") if k % 4 == 3 else around.get(p, p) for k, p in enumerate(rest)]
    return first.replace(" ", "[ LP]") + "".join(words)


def _marks(text: Column) -> Column:
    """The identifiers of a text's sentences in order, each as <name>, others as <?>."""
    stream = F.concat(F.lit("S\n"), F.lower(text), F.lit("\nS"))
    for pattern, mark in CUTS:
        stream = F.regexp_replace(stream, pattern, mark)
    # Prose comes last, so that it ends where another sentence begins.
    patterns = [(n, _over_lines(n, p)) for n, p in sorted(SENTENCES, key=lambda x: x[0] in PROSE)]
    marked = stream
    for name, pattern in patterns:
        marked = F.regexp_replace(marked, f"([SPL])(?:{pattern})(?=[SPL])", f"$1{_mark(name)}")
    any_of = "|".join(p for _, p in patterns)
    marked = F.when(stream.rlike(f"[SPL](?:{any_of})[SPL]"), marked).otherwise(F.lit(""))
    marked = F.regexp_replace(marked, "[SPL][0-9 ]++(?=[SPL])", "")
    marked = F.regexp_replace(marked, "[SPL](?!<)[^SPL]*+(?=[SPL])", "<?>")
    return F.regexp_replace(marked, "[SPL]", "")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_known, sentence_ids and licences for every row of ``docs(doc_id, text)``.

    n_known counts the licence sentences, sentence_ids names them in the order
    of the text, licences names the matched rules' licences in the order of
    the rules, each once (all comma-joined). Null and empty texts have none;
    repeated rows give repeated rows; further columns are ignored; no rows
    give no rows. One pass over the texts, without a shuffle.
    """
    lowered = F.lower("text")
    cue = F.lit(False)
    for word in CUES:
        cue = cue | lowered.contains(word.split()[-1])  # one word: what parts the words of a cue may be anything
    marks = F.coalesce(F.when(cue, _marks(F.col("text"))), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), marks.alias("marks"))
    rows = rows.select("doc_id", "marks", F.regexp_extract_all("marks", F.lit("<([a-z0-9_]+)>"), F.lit(1)).alias("known"))
    rules = F.array(*(F.struct(F.lit(licence).alias("licence"), F.lit("".join(map(_mark, ids))).alias("marks")) for licence, ids in RULES))
    start = F.struct(F.col("marks").alias("left"), F.array().cast("array<string>").alias("found"))

    def apply(state: Column, rule: Column) -> Column:
        hit = state["left"].contains(rule["marks"])
        return F.struct(
            F.when(hit, F.replace(state["left"], rule["marks"], F.lit("<#>"))).otherwise(state["left"]).alias("left"),
            F.when(hit, F.array_union(state["found"], F.array(rule["licence"]))).otherwise(state["found"]).alias("found"),
        )

    found = F.when(F.size("known") > 0, F.aggregate(rules, start, apply, lambda s: F.array_join(s["found"], ","))).otherwise(F.lit(""))
    return rows.select("doc_id", F.size("known").cast("long").alias("n_known"), F.array_join("known", ",").alias("sentence_ids"), found.alias("licences"))


def oracle_sql() -> str:
    """The same scan as DuckDB SQL: one step per rule, each on what the earlier ones left."""

    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    cue = " OR ".join(f"contains(lower(text), {text(w)})" for w in CUES)
    cases = "\n".join(f"WHEN regexp_matches(x, {text(f'^({p})$')}) THEN {text(n)}" for n, p in SENTENCES)
    steps = ["step0 AS (SELECT doc_id, known, marks, CAST([] AS VARCHAR[]) AS found FROM marked)"]
    for i, (licence, ids) in enumerate(RULES):
        marks = text("".join(map(_mark, ids)))
        steps.append(
            f"step{i + 1} AS (SELECT doc_id, known, replace(marks, {marks}, '<#>') AS marks, "
            f"CASE WHEN contains(marks, {marks}) AND NOT list_contains(found, {text(licence)}) THEN list_append(found, {text(licence)}) ELSE found END AS found FROM step{i})"
        )
    return f"""
        WITH cut AS (
            SELECT doc_id, CASE WHEN {cue} THEN string_split_regex(text, {text(BREAK)}) ELSE [] END AS sentences FROM documents
        ), normal AS (
            SELECT doc_id, list_transform(coalesce(sentences, []), lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))) AS sentences FROM cut
        ), named AS (
            SELECT doc_id, list_transform(sentences, lambda x: CASE {cases} END) AS ids FROM normal
        ), marked AS (
            SELECT doc_id, list_filter(ids, lambda x: x IS NOT NULL) AS known,
                   coalesce(array_to_string(list_transform(ids, lambda x: coalesce('<' || x || '>', '<?>')), ''), '') AS marks
            FROM named
        ), {", ".join(steps)}
        SELECT doc_id, CAST(len(known) AS BIGINT) AS n_known, coalesce(array_to_string(known, ','), '') AS sentence_ids,
               coalesce(array_to_string(found, ','), '') AS licences
        FROM step{len(RULES)}
    """
