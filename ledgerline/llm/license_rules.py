"""Licence scan by sentence rules (DataFrame functions only).

A text is cut into sentences (at line ends and after ``.``, ``!`` or ``?``
followed by white space) and each is normalised: A-Z lowered, everything but
a-z and 0-9 to single spaces.  A sentence that equals a known licence sentence becomes
its identifier; the identifiers of a text, in order, form a sequence.  A licence
sentence is also known where it is wrapped over several lines, blank lines and
comment or list leaders between, if it starts and ends with a line or sentence and has no
stop inside; there the official sentences are known in full.  ``ORACLE`` knows
sentences of one line only: on other texts it finds less.

Sentences that name a licence have slots: ``DECLARED`` and ``SPDX`` say where the name stands ("this project
is released under the ... license", "SPDX-License-Identifier: ..."), and the normalised name is looked up in a map of names; several
names joined by "or", "and" or "with" are looked up one by one.  A name that is not in the map gives nothing.  Licence
rules are tried in their order: a rule matches where its identifiers follow one
another in what earlier rules have left of the sequence, and takes them out.

Nulls and empty texts have no sentences and no licence.  Very long texts are scanned whole.  Repeated rows are
scanned one by one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Known sentences, normalised, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "ap1",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "ap2",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "ap3",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ap4",
    "see the license for the specific language governing permissions and limitations under the license": "ap5",
    "released under the mit license": "mi1",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mi2",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mi3",
    "this work is licensed under the gnu general public license version 3": "gp1",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gp2",
    "this program is distributed in the hope that it will be useful but without any warranty": "gp3",
    "see the gnu general public license for more details": "gp4",
    "licensed under cc by nc 4 0": "cc1",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc2",
    "licensed under cc by 4 0": "cc3",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bs1",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bs2",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bs3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "g21",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "g22",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lg1",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lg2",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "ag1",
    "this source code form is subject to the terms of the mozilla public license v": "mp1",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mp2",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "is1",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "ob1",
    "this is free and unencumbered software released into the public domain": "un1",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "un2",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zl1",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "bo1",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "c01",
    "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies": "pg1",
    "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed": "wt1",
}
# Official sentences that go on where those above stop, and their identifiers.
OFFICIAL = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mi2",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software": "mi3",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gp3",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "ap3",
}
# Ordered rules (identifier sequence, licence, kind); longer ones come first.
RULES = (
    ("ap2 ap3 ap4 ap5", "Apache-2.0", "permissive"),
    ("bs1 bs2 bs3", "BSD-3-Clause", "permissive"),
    ("gp2 gp3 gp4", "GPL-3.0", "copyleft"),
    ("bs1 bs2", "BSD-2-Clause", "permissive"),
    ("mi2 mi3", "MIT", "permissive"),
    ("ap2", "Apache-2.0", "permissive"),
    ("gp2", "GPL-3.0", "copyleft"),
    ("mi2", "MIT", "permissive"),
    ("ap1", "Apache-2.0", "permissive"),
    ("mi1", "MIT", "permissive"),
    ("gp1", "GPL-3.0", "copyleft"),
    ("cc1", "CC-BY-NC-4.0", "noncommercial"),
    ("cc2", "CC-BY-NC-4.0", "noncommercial"),
    ("cc3", "CC-BY-4.0", "permissive"),
)
# Further notices by their sentences.
RULES += (
    ("g21 gp3 gp4", "GPL-2.0", "copyleft"),
    ("mp1 mp2", "MPL-2.0", "copyleft"),
    ("un1 un2", "Unlicense", "permissive"),
    ("g21", "GPL-2.0", "copyleft"),
    ("g22", "GPL-2.0", "copyleft"),
    ("lg1", "LGPL-2.1", "copyleft"),
    ("lg2", "LGPL-3.0", "copyleft"),
    ("ag1", "AGPL-3.0", "copyleft"),
    ("mp1", "MPL-2.0", "copyleft"),
    ("is1", "ISC", "permissive"),
    ("ob1", "0BSD", "permissive"),
    ("un1", "Unlicense", "permissive"),
    ("zl1", "Zlib", "permissive"),
    ("bo1", "BSL-1.0", "permissive"),
    ("c01", "CC0-1.0", "permissive"),
    ("pg1", "PostgreSQL", "permissive"),
    ("wt1", "WTFPL", "permissive"),
)
# Licences by SPDX identifier, their kind, and names in sentences (normalised, without "license").
NAMED = (
    ("MIT", "permissive", ("mit", "expat", "mit expat")),
    ("MIT-0", "permissive", ("mit no attribution",)),
    ("Apache-2.0", "permissive", ("apache 2", "apache version 2 0", "apache v2", "apache v2 0", "apache software version 2 0")),
    ("BSD-2-Clause", "permissive", ("2 clause bsd", "simplified bsd", "freebsd")),
    ("BSD-3-Clause", "permissive", ("3 clause bsd", "new bsd", "modified bsd", "revised bsd")),
    ("ISC", "permissive", ()),
    ("0BSD", "permissive", ("zero clause bsd",)),
    ("Unlicense", "permissive", ("unlicense",)),
    ("Zlib", "permissive", ("zlib libpng",)),
    ("BSL-1.0", "permissive", ("boost software 1 0", "boost software version 1 0", "boost")),
    ("WTFPL", "permissive", ()),
    ("PostgreSQL", "permissive", ()),
    ("Artistic-2.0", "permissive", ("artistic 2 0", "artistic version 2 0")),
    ("PSF-2.0", "permissive", ("python software foundation", "psf")),
    ("NCSA", "permissive", ("university of illinois ncsa open source",)),
    ("OFL-1.1", "permissive", ("sil open font 1 1", "sil open font version 1 1")),
    ("CC0-1.0", "permissive", ("cc0", "creative commons zero", "creative commons zero v1 0 universal")),
    ("CC-BY-3.0", "permissive", ("creative commons attribution 3 0", "creative commons attribution 3 0 unported")),
    ("CC-BY-4.0", "permissive", ("creative commons attribution 4 0", "creative commons attribution 4 0 international")),
    ("CC-BY-SA-3.0", "copyleft", ("creative commons attribution sharealike 3 0", "creative commons attribution sharealike 3 0 unported")),
    ("CC-BY-SA-4.0", "copyleft", ("creative commons attribution sharealike 4 0", "creative commons attribution sharealike 4 0 international")),
    ("CC-BY-ND-4.0", "noderivatives", ("creative commons attribution noderivatives 4 0 international",)),
    ("CC-BY-NC-4.0", "noncommercial", ("creative commons attribution noncommercial 4 0",)),
    ("CC-BY-NC-SA-4.0", "noncommercial", ("creative commons attribution noncommercial sharealike 4 0 international",)),
    ("CC-BY-NC-ND-4.0", "noncommercial", ("creative commons attribution noncommercial noderivatives 4 0 international",)),
    ("GPL-2.0", "copyleft", ("gplv2", "gnu gpl v2", "gnu general public version 2", "gnu general public v2")),
    ("GPL-3.0", "copyleft", ("gplv3", "gnu gpl v3", "gnu general public version 3", "gnu general public v3")),
    ("LGPL-2.1", "copyleft", ("lgplv2 1", "gnu lesser general public version 2 1", "gnu lesser general public v2 1")),
    ("LGPL-3.0", "copyleft", ("lgplv3", "gnu lesser general public version 3", "gnu lesser general public v3")),
    ("AGPL-3.0", "copyleft", ("agplv3", "gnu affero general public version 3", "gnu affero general public v3")),
    ("MPL-2.0", "copyleft", ("mozilla public 2 0", "mozilla public version 2 0", "mozilla public v 2 0")),
    ("EPL-2.0", "copyleft", ("eclipse public 2 0", "eclipse public version 2 0", "eclipse public v2 0")),
    ("EUPL-1.2", "copyleft", ("european union public 1 2", "european union public version 1 2")),
    ("CDDL-1.0", "copyleft", ("common development and distribution 1 0",)),
)
# Where a normalised sentence names its licence.
SPDX = "(?:^| )spdx license identifier ([a-z0-9 ]+)$"
DECLARED = ("^(?:(?:this|the|our|all|these|its|source|code|content|software|project|package|work|file|files|library|program|data|dataset|documentation|text|model|is|are|and|"
            "has|been|in|repository|released|licensed) )*(?:released|licensed|distributed|available|published|provided) under (?:the |a |an )?(?:terms of )?"
            "(?:the |a |an )?([a-z0-9 ]+)$")
BETWEEN = " (?:or|and|with) "
# Words that start a comment line, and marks of a list (others are not letters or digits and go anyway).
COMMENT, LISTED = "(?:rem|dnl|c)", "(?:[0-9]{1,2}|[ab])"
# The strictest kind among a text's licences is its verdict.
KINDS = ("noncommercial", "noderivatives", "copyleft", "permissive")


def plain_name(name: str) -> str:
    """A name without "license"; GNU identifiers also without "only" and "or later" (which is split off before)."""
    return re.sub(r" (?:only|later)$", "", re.sub(r"(?:^| )(?:license|licence)(?= |$)", "", name)).strip()


# Identifier of a named licence: l and its place; names from SPDX identifiers are made by the rule of all sentences.
NAMES = {plain_name(n): f"l{k}" for k, (spdx, _, names) in enumerate(NAMED)
         for n in (re.sub("[^a-z0-9]+", " ", spdx.lower()), *names)}
RULES += tuple((f"l{k}", spdx, kind) for k, (spdx, kind, _) in enumerate(NAMED))


def pieces(text: Column) -> Column:
    """Normalised lines and sentences of a text, in order; blank ones are empty, and a stop is followed by one that is ``.``."""
    cut = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?])[\x20\x09-\x0D]+", "$1\n.\n"), "\n")
    return F.transform(cut, lambda s: F.when(s == ".", s).otherwise(F.trim(F.regexp_replace(common.ascii_lower(s), "[^a-z0-9]+", " "))))


def declared(sentence: Column) -> Column:
    """The sentence, or identifiers of the licences that it names in a slot, each marked and on its own line."""
    name = F.coalesce(F.nullif(F.regexp_extract(sentence, SPDX, 1), F.lit("")), F.regexp_extract(sentence, DECLARED, 1))
    known = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    plain = lambda n: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(n, "^(?:the|a|an) ", ""), "(?:^| )(?:license|licence)(?= |$)", ""), " (?:only|later)$", ""))
    ids = F.filter(F.transform(F.split(name, BETWEEN), lambda n: F.try_element_at(known, plain(n))), lambda i: i.isNotNull())
    marked_ids = F.array_join(F.transform(ids, lambda i: F.concat(F.lit("#"), i)), "\n")
    # Most sentences name nothing: only those with one of these words are looked at.
    slot = F.contains(sentence, F.lit(" under ")) | F.contains(sentence, F.lit("spdx license identifier"))
    return F.when(slot & ~sentence.isin(*SENTENCES) & (F.size(ids) > 0), marked_ids).otherwise(sentence)


def marked(found: Column) -> Column:
    """The pieces that are not blank, each between line ends."""
    return F.concat(F.lit("\n"), F.array_join(F.filter(found, lambda s: s != ""), "\n"), F.lit("\n"))


def flat(lines: Column) -> Column:
    """Marked pieces in one line, without comment words."""
    return F.regexp_replace(F.regexp_replace(lines, rf"\n{COMMENT}(?: |(?=\n))", "\n"), r"\n+", " ")


def identifiers(lines: Column, line: Column) -> Column:
    """`` ap1  mi1 ``: identifiers of the known sentences, in order, each between its own spaces.

    Of the sentences that a text contains, longer ones are replaced first.
    """
    known = sorted((SENTENCES | OFFICIAL).items(), key=lambda pair: -len(pair[0]))
    gap = rf"(?: |(?:\n{COMMENT})*\n(?:{COMMENT} )?)"
    steps = F.array(*[F.when(F.contains(line, F.lit(s)), F.struct(
        F.lit(rf"\n(?:{COMMENT} )?(?:{LISTED} )?{s.replace(' ', gap)}(?=\n)").alias("p"), F.lit(f"\n#{i}").alias("r"))) for s, i in known])
    ids = F.aggregate(F.filter(steps, lambda k: k.isNotNull()), lines, lambda text, k: F.regexp_replace(text, k["p"], k["r"]))
    return F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(ids, F.lit("#([a-z0-9]+)"), F.lit(1)), "  "), F.lit(" "))


def _needle(rule: str) -> str:
    return f" {rule.replace(' ', '  ')} "


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, sentence_ids, licenses (distinct, in rule order) and the verdict of each text."""
    found = docs.select("doc_id", pieces(F.col("text")).alias("_s"))
    n_sentences = F.size(F.filter("_s", lambda s: ~s.isin("", ".")))
    found = found.select("doc_id", n_sentences.cast("long").alias("n_sentences"), marked(F.transform("_s", declared)).alias("_lines"))
    found = found.withColumn("_line", flat(F.col("_lines")))
    out = found.select("doc_id", "n_sentences", identifiers(F.col("_lines"), F.col("_line")).alias("_ids"))
    left, hits = F.col("_ids"), []
    for rule, licence, kind in RULES:
        hits.append(F.when(F.contains(left, F.lit(_needle(rule))), F.struct(F.lit(licence).alias("l"), F.lit(kind).alias("k"))))
        left = F.replace(left, F.lit(_needle(rule)), F.lit("  / "))
    out = out.withColumn("_hits", F.filter(F.array(*hits), lambda h: h.isNotNull()))
    kinds = F.transform("_hits", lambda h: h["k"])
    has = {k: F.array_contains(kinds, k) for k in KINDS}
    verdict = F.lit("none")
    for kind in reversed(KINDS):
        verdict = F.when(has[kind], F.lit(kind)).otherwise(verdict)
    return out.select("doc_id", "n_sentences", F.trim(F.regexp_replace("_ids", " +", " ")).alias("sentence_ids"),
                      F.array_join(F.array_distinct(F.transform("_hits", lambda h: h["l"])), ",").alias("licenses"),
                      verdict.alias("verdict"))


def query(spark, sf_dir: str) -> DataFrame:
    """op2: licences of all documents."""
    return scan(common.read_table(spark, sf_dir, "documents"))


def _oracle() -> str:
    values = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    names = ", ".join(f"('{n}', '{i}')" for n, i in NAMES.items())
    left, steps = "ids", []
    for rule, licence, kind in RULES:
        steps.append(f"CASE WHEN contains({left}, '{_needle(rule)}') THEN '{licence}|{kind}' END")
        left = f"replace({left}, '{_needle(rule)}', '  / ')"
    return rf"""
WITH known(s, i) AS (VALUES {values}),
named(name, i) AS (VALUES {names}),
t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
c AS (SELECT rid, doc_id, list_filter(list_transform(
        string_split(regexp_replace(text, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)),
        lambda s: trim(regexp_replace(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'))),
        lambda s: s <> '') AS ss FROM t),
e AS (SELECT rid, unnest(ss) AS s, unnest(range(1, len(ss) + 1)) AS n FROM c),
o AS (SELECT rid, n, 0 AS p, s, coalesce(nullif(regexp_extract(s, '{SPDX}', 1), ''), regexp_extract(s, '{DECLARED}', 1)) AS name
      FROM e WHERE (contains(s, ' under ') OR contains(s, 'spdx license identifier')) AND s NOT IN (SELECT s FROM known)),
q AS (SELECT rid, n, unnest(regexp_split_to_array(name, '{BETWEEN}')) AS name, generate_subscripts(regexp_split_to_array(name, '{BETWEEN}'), 1) AS p FROM o),
j AS (SELECT rid, n, p, i FROM (SELECT rid, n, p, trim(regexp_replace(regexp_replace(' ' || regexp_replace(name, '^(?:the|a|an) ', '') || ' ', ' (?:license|licence) ', ' ', 'g'), ' (?:only|later) $', '')) AS name FROM q)
      JOIN named USING (name)
      UNION ALL SELECT rid, n, 0, i FROM e JOIN known USING (s)),
k AS (SELECT rid, string_agg(i, '  ' ORDER BY n, p) AS ids FROM j GROUP BY rid),
m AS (SELECT c.doc_id, len(ss)::BIGINT AS n_sentences, ' ' || coalesce(k.ids, '') || ' ' AS ids FROM c LEFT JOIN k USING (rid)),
h AS (SELECT *, list_filter([{", ".join(steps)}], lambda x: x IS NOT NULL) AS hits FROM m),
d AS (SELECT *, list_transform(hits, lambda x: string_split(x, '|')[1]) AS ls, list_transform(hits, lambda x: string_split(x, '|')[2]) AS ks FROM h)
SELECT doc_id, n_sentences, trim(regexp_replace(ids, ' +', ' ', 'g')) AS sentence_ids,
       array_to_string(list_filter(ls, lambda x, i: list_position(ls, x) = i), ',') AS licenses,
       CASE {" ".join(f"WHEN list_contains(ks, '{k}') THEN '{k}'" for k in KINDS)} ELSE 'none' END AS verdict
FROM d
"""


ORACLE = _oracle()
