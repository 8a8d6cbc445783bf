"""Licence scan by sentence recognition, in DataFrame functions only.

A text becomes normalised sentences; the known ones become identifiers; and the sequence of a document's
identifiers is matched against ordered rules.  A rule that matches consumes its part of the sequence.
A sentence may be wrapped over lines, with comment or list marks at their starts.
"""

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences as their authors publish them, normalised (a-z and 0-9, single spaces).
SENTENCES = {
    "licensed under the apache license version 2 0": "ApacheRef2",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "you may obtain a copy of the license at": "ApacheCopyAt",
    "released under the mit license": "MitRef",
    "licensed under the mit license": "MitRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MitWarranty",
    "this work is licensed under the gnu general public license version 3": "GplRef3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GplGrant2Plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GplGrant3Plus",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GplWarranty",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BsdEndorse",
    "licensed under cc by nc 4 0": "CcByNcRef4",
    "licensed under cc by 4 0": "CcByRef4",
    "this work is licensed under a creative commons attribution 4 0 international license": "CcByRef4",
    "all rights reserved": "Reserved",
    "apache license version 2 0 january 2004": "ApacheTitle2",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "IscGrant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "GplGrant2Only",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation": "GplGrant3Only",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "LgplGrant21Plus",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "LgplWarranty",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "LgplGrant3Plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "AgplGrant3Plus",
    "this source code form is subject to the terms of the mozilla public license v": "MplRef2",
    "this is free and unencumbered software released into the public domain": "UnlicenseGrant",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "CcBySaRef4",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "CcByNcRef4",
    "licensed under cc by sa 4 0": "CcBySaRef4",
    "licensed under cc0 1 0": "Cc0Ref1",
}

# The rules in the order in which they are tried; the sequence is written as " Id Id Id ".
RULES = [
    ("Apache-2.0", " ApacheRef2(?: ApacheComply)?(?: ApacheCopyAt)?"),
    ("MIT", " MitGrant MitNotice(?: MitWarranty)?"),
    ("MIT", " MitRef"),
    ("GPL-2.0-or-later", " GplGrant2Plus(?: GplWarranty)?"),
    ("GPL-3.0-or-later", " GplGrant3Plus(?: GplWarranty)?"),
    ("GPL-3.0-only", " GplRef3"),
    ("BSD-3-Clause", " BsdGrant BsdSource BsdBinary BsdEndorse"),
    ("BSD-2-Clause", " BsdGrant BsdSource BsdBinary"),
    ("CC-BY-NC-4.0", " CcByNcRef4"),
    ("CC-BY-4.0", " CcByRef4"),
    ("Apache-2.0", " ApacheTitle2"),
    ("ISC", " IscGrant"),
    ("GPL-2.0-only", " GplGrant2Only(?: GplWarranty)?"),
    ("GPL-3.0-only", " GplGrant3Only(?: GplWarranty)?"),
    ("LGPL-2.1-or-later", " LgplGrant21Plus(?: LgplWarranty)?"),
    ("LGPL-3.0-or-later", " LgplGrant3Plus(?: GplWarranty)?"),
    ("AGPL-3.0-or-later", " AgplGrant3Plus(?: GplWarranty)?"),
    ("MPL-2.0", " MplRef2"),
    ("Unlicense", " UnlicenseGrant"),
    ("CC-BY-SA-4.0", " CcBySaRef4"),
    ("CC0-1.0", " Cc0Ref1"),
    ("Proprietary", " Reserved"),
]

# Licences by the names that references use, with the identifier of a reference to each.
NAMED = {
    "mit license": "MitRef", "apache license version 2 0": "ApacheRef2", "apache license 2 0": "ApacheRef2", "mozilla public license version 2 0": "MplRef2", "mozilla public license 2 0": "MplRef2", "gnu general public license version 3": "GplRef3",
    "gnu general public license version 2": "GplRef2", "gnu lesser general public license version 3": "LgplRef3", "gnu lesser general public license version 2 1": "LgplRef21", "bsd 3 clause license": "Bsd3Ref", "bsd 2 clause license": "Bsd2Ref", "isc license": "IscRef",
}
REFERRED = ("licensed under the", "released under the", "distributed under the", "available under the", "under the terms of the", "published under the")

#: Sentences that a lead-in of a few words may precede ("This software is ..."), unless it says not.
AFTER_LEAD_IN = {f"{verb} {name}": i for name, i in NAMED.items() for verb in REFERRED} | {s: i for s, i in SENTENCES.items() if "Ref" in i and s.split()[0] in ("licensed", "released")}
AFTER_LEAD_IN |= {f"licensed under either of {x} or {y}{end}": f"{NAMED[x]} {NAMED[y]}" for x in NAMED for y in NAMED if x != y for end in ("", " at your option")}
SENTENCES |= AFTER_LEAD_IN

# Titles.
SENTENCES |= {
    "gnu general public license version 3 29 june 2007": "GplTitle3", "gnu general public license version 2 june 1991": "GplTitle2", "gnu lesser general public license version 3 29 june 2007": "LgplTitle3", "gnu lesser general public license version 2 1 february 1999": "LgplTitle21",
    "gnu affero general public license version 3 19 november 2007": "AgplTitle3", "mozilla public license version 2 0": "MplRef2",
    "the gnu general public license is a free copyleft license for software and other kinds of works": "GplPreamble",
}
RULES[-1:-1] = [
    ("GPL-3.0-only", " GplTitle3(?: GplPreamble)?"), ("GPL-2.0-only", " GplTitle2"), ("LGPL-3.0-only", " LgplTitle3"), ("LGPL-2.1-only", " LgplTitle21"), ("AGPL-3.0-only", " AgplTitle3"), ("GPL-2.0-only", " GplRef2"), ("LGPL-3.0-only", " LgplRef3"),
    ("LGPL-2.1-only", " LgplRef21"), ("BSD-3-Clause", " Bsd3Ref"), ("BSD-2-Clause", " Bsd2Ref"), ("ISC", " IscRef"),
]
LEAD_IN = 12  # words

#: Licences of an SPDX expression, by lower-case identifier; the older forms without "only", or with a plus, too.
SPDX = {name.lower(): name for name, _ in RULES[:-1]}
for _base in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"):
    SPDX |= {_base.lower(): f"{_base}-only", f"{_base.lower()}-only": f"{_base}-only", f"{_base.lower()}+": f"{_base}-or-later", f"{_base.lower()}-or-later": f"{_base}-or-later"}
_spdx_id = lambda name: "Spdx" + "".join(c for c in name if c.isalnum())
RULES[-1:-1] = [(name, f" {_spdx_id(name)}") for name in dict.fromkeys(SPDX.values())]
#: The expression of a line, and what in it is no licence: operators, and exceptions behind WITH.
SPDX_LINE, SPDX_TOKEN = "spdx-license-identifier:[ \t]*([a-z0-9 \t.+()-]+)", "with[ \t(]+[a-z0-9.-]+|[a-z0-9.+-]+"
#: A text that speaks of a licence isn't proprietary because it reserves rights.
SPEAKS = "(?:licensed|released|distributed|available|published) under|spdx-license-identifier"

#: Cues of the DuckDB SQL, sought before normalising: it misses "rights reserved" with other than one blank between.
CUES = "licen|permission|warranty|redistribut|copyright|rights reserved|unencumbered"
#: Every known sentence holds a word with one of these, whatever stands between words, so texts without them are not normalised.
WORDS = "licen|permission|warranty|redistribut|copyright|reserved|unencumbered"

# Gaps between words become one character: H ends a sentence (.!? and a blank, or a blank line), C may end or lie in one
# (a line break, ; or :), O may do so but starts none (a parenthesis), a blank only lies in one.  Every step is linear.
_GAPS = [
    ("\r\n?", "\n"),
    ("\n[ \t]*(?:rem|dnl)(?=[ \t\n])", "\n"),
    ("\n[^a-z0-9\n]*(?:[0-9]{1,2}|[a-z]|[ivx]{2,4})\\)(?=[ \t])", "\n"),
    ("\n[^a-z0-9\n]*\n", "H"),
    ("[.!?][ \t\n]", "H"),
    ("[\n;:]", "C"),
    ("\\(", "O"),
    ("[^a-z0-9HCO]+", " "),
    (" ?([HCO]) ?", "$1"),
    ("(?<![HCO])[CO]*+H[HCO]*+", "H"),
    ("(?<![HCO])O*+C[CO]*+", "C"),
    ("O+", "O"),
]
_any = lambda sentences: "|".join(s.replace(" ", "[ CO]") for s in sorted(sentences, key=len, reverse=True))
_LED = _any(AFTER_LEAD_IN)
_KNOWN = f"(?<=[HC])(?:(?:(?!(?:not|never|no)[ CO])[a-z0-9]++[ CO]){{1,{LEAD_IN}}}?(?=(?:{_LED})[HCO]))?({_any(SENTENCES)})(?=[HCO])"


def sentence_ids(text: Column) -> Column:
    """The identifiers of a text's known sentences, in order, and then those of its SPDX lines."""
    low = F.lower(text)
    marked = F.concat(F.lit("\n\n"), low, F.lit("\n\n"))
    for gap, mark in _GAPS:
        marked = F.regexp_replace(marked, gap, mark)
    marked = F.when(low.rlike(WORDS), marked).otherwise(F.lit(""))
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(SENTENCES.items())])
    found = F.regexp_extract_all(marked, F.lit(_KNOWN), F.lit(1))
    spdx = F.create_map(*[F.lit(x) for k, v in SPDX.items() for x in (k, _spdx_id(v))])
    tokens = F.flatten(F.transform(F.regexp_extract_all(low, F.lit(SPDX_LINE), F.lit(1)), lambda e: F.regexp_extract_all(e, F.lit(SPDX_TOKEN), F.lit(0))))
    return F.concat(F.transform(found, lambda s: known[F.translate(s, "CO", "  ")]), F.array_compact(F.transform(tokens, lambda t: F.try_element_at(spdx, t))))


def scan_licenses(documents: DataFrame) -> DataFrame:
    """Recognise licences in every whole text.

    Returns ``doc_id, n_sentences long`` (known licence sentences, and licences named on SPDX lines), ``licenses string`` (names in the
    order of the rules, comma-separated, each at most once; empty if none) and ``rest string`` (identifiers that no rule consumed), a
    row for each input row.  A reference may follow a lead-in of up to 12 words without a "not".  ``Proprietary`` is named only
    where no licence is and the text speaks of none.  Null and empty texts have no sentences.  A narrow projection: no shuffle, no state
    beyond a row, so ids may be null, repeated or clash with nothing; further columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = documents.select("doc_id", sentence_ids(text).alias("ids"), F.lower(text).rlike(SPEAKS).alias("speaks"))
    df = df.withColumn("seq", F.concat(F.lit(" "), F.array_join("ids", " "), F.lit(" ")))
    hits = []
    for i, (name, rule) in enumerate(RULES):  # one stage for each rule of a fixed list
        hits.append(F.when(F.col(f"hit{i}"), F.lit(name)))
        df = df.withColumn(f"hit{i}", F.col("seq").rlike(f"{rule} ")).withColumn("seq", F.regexp_replace("seq", f"{rule}(?= )", ""))
    named = F.array_distinct(F.array_compact(F.array(*hits[:-1])))
    own = F.when((F.size("named") == 0) & ~F.col("speaks") & F.col(f"hit{len(RULES) - 1}"), RULES[-1][0]).otherwise(F.array_join("named", ","))
    return df.withColumn("named", named).select("doc_id", F.size("ids").cast("long").alias("n_sentences"), own.alias("licenses"), F.trim("seq").alias("rest"))


def oracle_sql() -> str:
    """The scan of one-line sentences in DuckDB SQL; it finds no wrapped ones."""
    whole = " ".join(f"when '{s}' then '{i}'" for s, i in SENTENCES.items())
    led = "|".join(sorted(AFTER_LEAD_IN, key=len, reverse=True))
    known = " ".join(f"when '{s}' then '{i}'" for s, i in AFTER_LEAD_IN.items())
    spdx = " ".join(f"when '{k}' then '{_spdx_id(v)}'" for k, v in SPDX.items())
    sql = f"""with cut as (select doc_id, lower(coalesce(text, '')) as low, list_transform(list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '([.!?])[ \\t\\r]+', '\\1' || chr(10), 'g'), chr(10)),
      lambda s: regexp_matches(s, '{CUES}')), lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))) as ss from documents),
    said as (select doc_id, low, list_filter(list_transform(ss, lambda s: coalesce(case s {whole} end, case when not regexp_matches(s, '(^| )(not|never|no) ') then
      case regexp_extract(s, '^(?:[a-z0-9]+ ){{0,{LEAD_IN}}}({led})$', 1) {known} end end)), lambda i: i is not null) as a,
      list_filter(list_transform(flatten(list_transform(regexp_extract_all(low, '{SPDX_LINE}', 1), lambda e: regexp_extract_all(e, '{SPDX_TOKEN}'))), lambda t: case t {spdx} end), lambda i: i is not null) as b from cut),
    r0 as (select doc_id, low, cast(len(a) + len(b) as bigint) as n_sentences, ' ' || array_to_string(list_transform(list_concat(a, b), lambda i: i || ' '), '') as s0 from said)"""
    for i, (_, rule) in enumerate(RULES):
        sql += f",\n r{i + 1} as (select *, regexp_matches(s{i}, '{rule} ') as h{i}, regexp_replace(s{i}, '(?:{rule})+ ', ' ', 'g') as s{i + 1} from r{i})"
    last = len(RULES) - 1
    names = ", ".join(f"case when h{i} then '{name}' end" for i, (name, _) in enumerate(RULES[:-1]))
    ordered = ", ".join(f"case when list_contains(found, '{n}') then '{n}' end" for n in dict.fromkeys(name for name, _ in RULES[:-1]))
    own = f"case when h{last} and len(list_filter(found, lambda n: n is not null)) = 0 and not regexp_matches(low, '{SPEAKS}') then '{RULES[-1][0]}' else concat_ws(',', {ordered}) end"
    return sql + f",\n f as (select *, trim(s{len(RULES)}) as rest, [{names}] as found from r{len(RULES)})\nselect doc_id, n_sentences, {own} as licenses, rest from f"
