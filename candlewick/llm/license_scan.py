"""License scans: sentence rules.

A text is cut into normalised sentences; known licence sentences get an
identifier (many wordings share one), and the sequence of identifiers is
matched against ordered rules.  A sentence is looked up in a hash set, which
holds any number of sentences at the same cost; only the few that are in it
are mapped to their identifier.  ``SPDX-License-Identifier`` tags name their
licences themselves.  "All rights reserved" makes a text proprietary only
beside a copyright line, and if nothing else is named.  Texts without any word
that a known sentence needs are not cut.  Everything is a row-wise expression:
no shuffle, no key that could be hot, and the tables are literals of the plan.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.line_dedup import LOWER, UPPER

# Licences by SPDX identifier, as sentences name them, and how
# such sentences open ("under" and a name stands for all of them).  All is
# normalised (a-z, 0-9, blanks).
NAMED = {
    "MIT": ["the mit license", "mit license", "the mit licence", "mit", "the expat license"],
    "MIT-0": ["the mit no attribution license", "mit 0"],
    "Apache-2.0": ["the apache license version 2 0", "apache license version 2 0", "the apache license 2 0",
                   "apache license 2 0", "the apache 2 0 license", "apache 2 0", "the apache license version 2 0 the license"],
    "Apache-1.1": ["the apache software license version 1 1", "the apache license version 1 1"],
    "BSD-2-Clause": ["the bsd 2 clause license", "the simplified bsd license", "a 2 clause bsd license",
                     "the two clause bsd license", "the 2 clause bsd license"],
    "BSD-3-Clause": ["the bsd 3 clause license", "the new bsd license", "the modified bsd license", "a bsd style license",
                     "the three clause bsd license", "the 3 clause bsd license", "the revised bsd license"],
    "BSD-4-Clause": ["the original bsd license", "the bsd 4 clause license"],
    "0BSD": ["the bsd zero clause license", "0bsd"],
    "ISC": ["the isc license", "isc license", "isc"],
    "Zlib": ["the zlib license", "the zlib libpng license", "the zlib png license"],
    "BSL-1.0": ["the boost software license version 1 0", "the boost software license"],
    "Unlicense": ["the unlicense", "the unlicense license"],
    "WTFPL": ["the wtfpl", "the do what the fuck you want to public license"],
    "MPL-1.1": ["the mozilla public license version 1 1", "the mpl 1 1"],
    "MPL-2.0": ["the mozilla public license version 2 0", "the mozilla public license 2 0", "mpl 2 0", "the mpl 2 0",
                "the mozilla public license v 2 0"],
    "EPL-1.0": ["the eclipse public license v1 0", "the eclipse public license version 1 0", "the eclipse public license 1 0"],
    "EPL-2.0": ["the eclipse public license v2 0", "the eclipse public license version 2 0", "the eclipse public license 2 0"],
    "CDDL-1.0": ["the common development and distribution license version 1 0", "the cddl 1 0", "the cddl"],
    "CPL-1.0": ["the common public license version 1 0", "the common public license 1 0"],
    "EUPL-1.2": ["the european union public licence version 1 2", "the eupl version 1 2", "the eupl 1 2", "the eupl"],
    "MS-PL": ["the microsoft public license", "the microsoft public license ms pl"],
    "MS-RL": ["the microsoft reciprocal license", "the microsoft reciprocal license ms rl"],
    "OSL-3.0": ["the open software license version 3 0", "the open software license 3 0"],
    "AFL-3.0": ["the academic free license version 3 0", "the academic free license 3 0"],
    "Artistic-1.0": ["the artistic license 1 0"],
    "Artistic-2.0": ["the artistic license 2 0", "the artistic license version 2 0"],
    "PSF-2.0": ["the python software foundation license", "the psf license"],
    "PostgreSQL": ["the postgresql license", "the postgresql licence"],
    "NCSA": ["the university of illinois ncsa open source license", "the ncsa open source license"],
    "OFL-1.1": ["the sil open font license version 1 1", "the sil open font license", "the open font license 1 1"],
    "ODbL-1.0": ["the open database license", "the open data commons open database license"],
    "PDDL-1.0": ["the public domain dedication and license", "the open data commons public domain dedication and license"],
    "CC0-1.0": ["cc0", "cc0 1 0", "cc0 1 0 universal", "creative commons zero", "the creative commons cc0 1 0 universal license"],
    "GPL-1.0-only": ["the gnu general public license version 1"],
    "GPL-2.0-only": ["the gnu general public license version 2", "the gnu gpl version 2", "the gnu gpl v2", "the gpl v2",
                     "the gplv2", "gplv2", "the gnu general public license v2", "the gnu general public license v2 0"],
    "GPL-3.0-only": ["the gnu general public license version 3", "the gnu gpl version 3", "the gnu gpl v3", "the gpl v3",
                     "the gplv3", "gplv3", "the gnu general public license v3", "the gnu general public license v3 0"],
    "GPL-2.0-or-later": ["the gnu general public license version 2 or later", "the gnu gpl v2 or later", "gplv2 or later",
                         "the gnu general public license version 2 or any later version"],
    "GPL-3.0-or-later": ["the gnu general public license version 3 or later", "the gnu gpl v3 or later", "gplv3 or later",
                         "the gnu general public license version 3 or any later version"],
    "LGPL-2.0-only": ["the gnu library general public license version 2"],
    "LGPL-2.1-only": ["the gnu lesser general public license version 2 1", "the gnu lgpl version 2 1", "the lgpl v2 1"],
    "LGPL-3.0-only": ["the gnu lesser general public license version 3", "the gnu lgpl version 3", "the lgpl v3", "lgplv3"],
    "LGPL-2.1-or-later": ["the gnu lesser general public license version 2 1 or later"],
    "LGPL-3.0-or-later": ["the gnu lesser general public license version 3 or later"],
    "AGPL-3.0-only": ["the gnu affero general public license version 3", "the gnu agpl version 3", "the agpl v3", "agplv3",
                      "the gnu affero general public license v3", "the gnu affero general public license v3 0"],
    "AGPL-3.0-or-later": ["the gnu affero general public license version 3 or later"],
}
VERBS = ["licensed", "released", "distributed", "available", "published"]
OPENING = ("^(?:(?:this|the|our|all) )?(?:(?:work|works|software|project|program|file|files|code|source code|library|"
           f"package|document|content|text|font software|it) (?:is|are) )?(?:{'|'.join(VERBS)}) under (?:the terms of )?")
# Creative Commons licences by part and version, as written out.
CC_PARTS = {"by": "attribution", "by-sa": "attribution sharealike", "by-nc": "attribution noncommercial",
            "by-nd": "attribution noderivatives", "by-nc-sa": "attribution noncommercial sharealike",
            "by-nc-nd": "attribution noncommercial noderivatives"}
CC_VERSIONS = {"2.0": "generic", "2.5": "generic", "3.0": "unported", "4.0": "international"}
# The published notices of the GNU licences: kind, its word, versions.
GNU = {"GPL": ("", ["1.0", "2.0", "3.0"]), "LGPL": ("lesser ", ["2.1", "3.0"]), "AGPL": ("affero ", ["3.0"])}

# Sentences of published notices by identifier, each as ``_units``
# cuts it (notices go on after ``:``, ``;`` and ``v.``).
SENTENCES = {
    "apache-not-use": ["you may not use this file except in compliance with the license"],
    "apache-copy": ["you may obtain a copy of the license at"],
    "apache-as-is": ["unless required by applicable law or agreed to in writing software distributed under the license "
                     "is distributed on an as is basis without warranties or conditions of any kind either express or "
                     "implied"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and "
                  "associated documentation files the software to deal in the software without restriction including "
                  "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                  "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                  "the following conditions"],
    "mit0-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and "
                   "associated documentation files the software to deal in the software without restriction including "
                   "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                   "copies of the software and to permit persons to whom the software is furnished to do so"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or "
                   "substantial portions of the software"],
    "gnu-free": ["this program is free software", "this library is free software", "this file is free software"],
    "gnu-warranty": ["this program is distributed in the hope that it will be useful but without any warranty",
                     "this library is distributed in the hope that it will be useful but without any warranty"],
    "gnu-without-even": ["without even the implied warranty of merchantability or fitness for a particular purpose"],
    "gnu-warranty-whole": ["this program is distributed in the hope that it will be useful but without any warranty "
                           "without even the implied warranty of merchantability or fitness for a particular purpose"],
    "bsd-redistribution": ["redistribution and use in source and binary forms with or without modification are "
                           "permitted provided that the following conditions are met"],
    "bsd-no-endorse": [f"neither the name of {x} nor the names of its contributors may be used to endorse or promote "
                       "products derived from this software without specific prior written permission"
                       for x in ("the copyright holder", "the copyright holders", "the organization", "the university",
                                 "the copyright owner", "the author")],
    "bsd-advertising": ["all advertising materials mentioning features or use of this software must display the "
                        "following acknowledgement", "all advertising materials mentioning features or use of this "
                        "software must display the following acknowledgment"],
    "isc-grant": [f"permission to use copy modify {x} distribute this software for any purpose with or without fee is "
                  "hereby granted provided that the above copyright notice and this permission notice appear in all "
                  "copies" for x in ("and or", "and")],
    "0bsd-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee "
                   "is hereby granted"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial "
                   "applications and to alter it and redistribute it freely subject to the following restrictions"],
    "boost-grant": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the "
                    "software and accompanying documentation covered by this license the software to use reproduce "
                    "display distribute execute and transmit the software and to prepare derivative works of the "
                    "software and to permit third parties to whom the software is furnished to do so all subject to "
                    "the following"],
    "unlicense-free": ["this is free and unencumbered software released into the public domain"],
    "mpl2-form": ["this source code form is subject to the terms of the mozilla public license v",
                  "this source code form is subject to the terms of the mozilla public license v 2 0"],
    "epl2-terms": ["this program and the accompanying materials are made available under the terms of the eclipse "
                   "public license 2 0 which is available at https www eclipse org legal epl 2 0"],
    "epl1-terms": ["all rights reserved this program and the accompanying materials are made available under the terms "
                   "of the eclipse public license v1 0 which accompanies this distribution and is available at http "
                   "www eclipse org legal epl v10 html"],
    "cddl-terms": ["the contents of this file are subject to the terms of the common development and distribution "
                   "license the license"],
    "rights-reserved": ["all rights reserved"],
}

# Ordered rules (licence, identifiers in sequence): an earlier rule takes its
# sentences, so a later, shorter rule does not report them again.
RULES = [
    ("Apache-2.0", ["name:Apache-2.0", "apache-not-use", "apache-copy", "apache-as-is"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("BSD-4-Clause", ["bsd-redistribution", "bsd-advertising", "bsd-no-endorse"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-no-endorse"]),
    ("BSD-4-Clause", ["bsd-redistribution", "bsd-advertising"]),
    ("Apache-2.0", ["apache-not-use"]), ("MIT", ["mit-grant"]), ("MIT-0", ["mit0-grant"]),
    ("BSD-2-Clause", ["bsd-redistribution"]), ("ISC", ["isc-grant"]), ("0BSD", ["0bsd-grant"]), ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["boost-grant"]), ("Unlicense", ["unlicense-free"]), ("MPL-2.0", ["mpl2-form"]),
    ("EPL-2.0", ["epl2-terms"]), ("EPL-1.0", ["epl1-terms"]), ("CDDL-1.0", ["cddl-terms"]),
]
PROPRIETARY = "LicenseRef-proprietary"
RESERVED = "rights-reserved"
# Beside it: a line with a copyright mark and a year.
COPYRIGHT = r"(?i)(?:copyright|\(c\)|\x{a9})[^\n]{0,200}\b(?:19|20)[0-9][0-9]\b"
# Licences that a file names by tag, up to the line's end, without operators.
SPDX = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() -]+)"
OPERATORS = ["AND", "OR", "WITH", "NONE", "NOASSERTION"]


def known_licenses() -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """(identifier by sentence, rules): the tables above with the sentences
    that follow a rule: names after openings, Creative Commons licences by
    part and version, notices of the GNU licences by kind and version."""
    names = {k: list(v) for k, v in NAMED.items()}
    for part, long in CC_PARTS.items():
        for version, port in CC_VERSIONS.items():
            v, p = version.replace(".", " "), part.replace("-", " ")
            names[f"CC-{part.upper()}-{version}"] = [x for n in (f"cc {p} {v}", f"creative commons {long} {v}",
                                                                f"creative commons {long} {v} {port}")
                                                     for x in (n, f"{n} license", f"the {n} license", f"a {n} license")]
    known = {s: k for k, group in SENTENCES.items() for s in group}
    rules = list(RULES)
    for spdx, own in names.items():
        known.update({f"under {n}": f"name:{spdx}" for n in own})
        rules.append((spdx, [f"name:{spdx}"]))
    several = []
    for kind, (word, versions) in GNU.items():
        start = (f"you can redistribute it and or modify it under the terms of the gnu {word}general public license "
                 "as published by the free software foundation")
        ways = [start, *[f"this {x} is free software {start}" for x in ("program", "library")]]
        known.update({way: f"terms:{kind}" for way in ways})  # the version follows after a mark
        for version in versions:
            v = version.removesuffix(".0").replace(".", " ")
            for key, ends in (("or-later", [f"either version {v} of the license or at your option any later version",
                                            f"either version {v} of the license or any later version"]),
                              ("only", [f"version {v} of the license", f"version {v}", f"version {v} only"])):
                spdx = f"{kind}-{version}-{key}"
                known.update({end: f"{key}:{v}" for end in ends})
                known.update({f"{way} {end}": f"terms:{spdx}" for way in ways for end in ends})
                rules.append((spdx, [f"terms:{spdx}"]))
                several.append((spdx, [f"terms:{kind}", f"{key}:{v}"]))
    rules[:0] = several
    return known, rules


def _units(text: Column, joined: bool) -> Column:
    """Normalised sentences.  A sentence ends at a line end or at ``.!?:;``
    before white space; ``joined`` reads a single line end as a blank, for
    licence texts wrapped over lines.  Openings before a name become one."""
    t = F.translate(text, UPPER, LOWER)
    t = F.regexp_replace(t, "\r", "")
    if joined:
        t = F.regexp_replace(F.regexp_replace(t, "\n[ \t]*\n+", ". "), "\n", " ")
    t = F.regexp_replace(t, "[.!?:;][ \t]+", "\n")
    t = F.regexp_replace(t, "[^a-z0-9\n]+", " ")
    return F.transform(F.split(t, "\n"), lambda s: F.regexp_replace(F.btrim(s), OPENING, "under "))


def anchors(sentences) -> list[str]:
    """Words of which every text with a known sentence holds one: the verbs for
    sentences that name a licence; for others, one after the other, the word
    that most of those not yet covered hold, of seven letters or more (or the
    longest)."""
    left = [set(s.split()) for s in sentences if not s.startswith("under ")]
    out = list(VERBS) if len(left) < len(sentences) else []
    left = [w for w in left if not w & set(out)]
    while left:
        counts: dict[str, int] = {}
        for words in left:
            longest = max(map(len, words))
            for w in words:
                if len(w) >= min(7, longest):
                    counts[w] = counts.get(w, 0) + 1
        out.append(max(counts, key=lambda w: (counts[w], len(w), w)))
        left = [words for words in left if out[-1] not in words]
    return sorted(out)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  sentences: dict[str, str] | None = None,
                  rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """Licences named in each text.

    Returns one row per input row: ``id_col``, ``sentence_ids`` (identifiers
    of the known sentences in text order: line by line, then those found only
    across wrapped lines), ``licenses`` (rule names, in rule order, then those
    of SPDX tags, each once) and ``license`` (the first, else null).
    ``sentences`` (identifier by normalised sentence) and ``rules`` are those
    of :func:`known_licenses` unless given.  Null or empty text: empty arrays.
    Texts of any length are read whole.  Repeated rows give repeated results; a
    sentence that occurs twice is listed twice.  No rows give no rows.  Other
    columns are not read.
    """
    if sentences is None or rules is None:
        sentences, rules = known_licenses()
    named = list(dict.fromkeys(sentences.values()))
    codes = {k: f"<{i + 1}>" for i, k in enumerate(named)}
    known = F.array(*[F.lit(s) for s in sentences])
    number = F.array(*[F.lit(named.index(k) + 1) for k in sentences.values()])
    names = F.array(*[F.lit(k) for k in named])
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(codes[i] for i in ids)).alias("seq"))
                      for name, ids in rules])

    def found(units: Column) -> Column:
        """Numbers of the identifiers: the hash set decides, the place in the
        table is looked for only where there is one."""
        hits = F.filter(units, lambda u: u.isin(list(sentences)))
        return F.transform(hits, lambda u: F.element_at(number, F.array_position(known, u).cast("int")))

    low = F.lower(F.col(text_col))
    may = reduce(or_, [F.contains(low, F.lit(w)) for w in anchors(sentences)], F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.when(may, F.col(text_col)).alias("text"),
                       F.coalesce(F.regexp_extract_all(text_col, F.lit(SPDX), F.lit(1)),
                                  F.array().cast("array<string>")).alias("tags"))
    rows = rows.select("id", "text", "tags", found(_units(F.col("text"), False)).alias("u"),
                       found(_units(F.col("text"), True)).alias("w"))
    rows = rows.select("id", "text", "tags", "u", "w",
                       F.filter("w", lambda p: ~F.array_contains(F.col("u"), p)).alias("x"))
    spell = lambda c: F.array_join(F.transform(c, lambda p: F.concat(F.lit("<"), p.cast("string"), F.lit(">"))), "")
    rows = rows.select("id", "text", "tags", F.concat("u", "x").alias("ids"),
                       F.concat(spell(F.col("u")), F.lit("|"), spell(F.col("w"))).alias("seq"))
    step = lambda acc, r: F.when(
        F.contains(acc["seq"], r["seq"]),
        F.struct(F.replace(acc["seq"], r["seq"], F.lit("|")).alias("seq"),
                 F.concat(acc["hits"], F.array(r["name"])).alias("hits"))).otherwise(acc)
    none = F.array().cast("array<string>")
    start = F.struct(F.col("seq").alias("seq"), none.alias("hits"))
    hits = F.when(F.size("ids") > 0, F.aggregate(table, start, step)["hits"]).otherwise(none)
    tagged = F.flatten(F.transform("tags", lambda t: F.filter(
        F.split(t, "[() ]+"), lambda w: (w != "") & ~w.isin(OPERATORS))))
    rows = rows.select("id", "text", "ids", F.array_distinct(F.concat(hits, tagged)).alias("licenses"))
    if RESERVED in codes:
        reserved = F.array_contains("ids", named.index(RESERVED) + 1) & F.col("text").rlike(COPYRIGHT)
        rows = rows.withColumn("licenses", F.when((F.size("licenses") == 0) & reserved, F.array(F.lit(PROPRIETARY)))
                               .otherwise(F.col("licenses")))
    ids = F.coalesce("ids", F.array().cast("array<int>"))
    return rows.select(F.col("id").alias(id_col),
                       F.transform(ids, lambda p: F.element_at(names, p)).alias("sentence_ids"),
                       "licenses", F.get("licenses", F.lit(0)).alias("license"))


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    out = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
                      F.array_join("sentence_ids", ",").alias("sentence_ids"),
                      F.array_join("licenses", ",").alias("licenses"), "license")


def _values(rows) -> str:
    """Rows of a VALUES list."""
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")"
                     for r in rows)


def _sql() -> str:
    """The same in DuckDB: units as rows joined with the table of sentences;
    the rules of several sentences in sequence, then those of one."""
    sentences, rules = known_licenses()
    named = list(dict.fromkeys(sentences.values()))
    code = {k: f"<{i + 1}>" for i, k in enumerate(named)}
    out, left = [], "q"
    for o, (name, ids) in enumerate(rules):
        seq = "".join(code[i] for i in ids)
        out.append(f"{{'o': {o}, 'lic': '{name}', 'hit': contains({'z' if len(ids) == 1 else left}, '{seq}')}}")
        if len(ids) > 1:
            left = f"replace({left}, '{seq}', '|')"
    hits = ",\n  ".join(out)
    return f"""
WITH k(s, i, name) AS (VALUES {_values((s, named.index(k) + 1, k) for s, k in sentences.items())}),
t AS (SELECT doc_id, replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), chr(13), '') AS t
      FROM documents),
b AS (SELECT doc_id, 0 AS way, t FROM t
      UNION ALL
      SELECT doc_id, 1, replace(regexp_replace(t, '\\n[ \\t]*\\n+', '. ', 'g'), chr(10), ' ') FROM t),
u AS (SELECT doc_id, way, string_split(regexp_replace(regexp_replace(t, '[.!?:;][ \\t]+', chr(10), 'g'),
             '[^a-z0-9\\n]+', ' ', 'g'), chr(10)) AS us FROM b),
e AS (SELECT doc_id, way, pos, regexp_replace(trim(s), '{OPENING}', 'under ') AS s FROM
        (SELECT doc_id, way, unnest(range(len(us))) AS pos, unnest(us) AS s FROM u)),
h AS (SELECT doc_id, way, pos, i, name FROM e JOIN k USING (s)),
x AS (SELECT * FROM h a WHERE way = 0 OR NOT EXISTS
        (SELECT 1 FROM h b WHERE b.doc_id = a.doc_id AND b.way = 0 AND b.i = a.i)),
l AS (SELECT doc_id, count(*) AS n_sentences, bool_or(name = '{RESERVED}') AS reserved,
             string_agg(name, ',' ORDER BY way, pos) AS sentence_ids FROM x GROUP BY doc_id),
q AS (SELECT *, {left} AS z FROM (
        SELECT doc_id, coalesce(string_agg('<' || i || '>', '' ORDER BY pos) FILTER (way = 0), '') || '|'
               || coalesce(string_agg('<' || i || '>', '' ORDER BY pos) FILTER (way = 1), '') AS q
        FROM h GROUP BY doc_id)),
r AS (SELECT doc_id, unnest([{hits}]) AS x FROM q),
g AS (SELECT doc_id, unnest(regexp_extract_all(text, '{SPDX}', 1)) AS tag FROM documents),
m AS (SELECT doc_id, lic, min(o) AS o FROM (
        SELECT doc_id, x.lic AS lic, x.o AS o FROM r WHERE x.hit
        UNION ALL
        SELECT doc_id, lic, {len(rules)} + o FROM (SELECT doc_id, unnest(w) AS lic, unnest(range(len(w))) AS o FROM
          (SELECT doc_id, regexp_split_to_array(string_agg(tag, ' '), '[() ]+') AS w FROM g GROUP BY doc_id))
        WHERE lic <> '' AND lic NOT IN ({", ".join(f"'{w}'" for w in OPERATORS)})) GROUP BY ALL),
n AS (SELECT doc_id, string_agg(lic, ',' ORDER BY o) AS licenses, arg_min(lic, o) AS license
      FROM m GROUP BY doc_id),
p AS (SELECT doc_id, CASE WHEN reserved AND regexp_matches(text, '{COPYRIGHT}') THEN '{PROPRIETARY}' END AS own
      FROM documents LEFT JOIN l USING (doc_id))
SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(sentence_ids, '') AS sentence_ids,
       coalesce(licenses, own, '') AS licenses, coalesce(license, own) AS license
FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN p USING (doc_id)
"""


OP2_SQL = _sql()
