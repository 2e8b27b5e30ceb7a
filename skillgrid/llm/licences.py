"""Licence scan by sentence rules, in DataFrame functions only.

A text is cut into sentences: after signs that end one, and at lines that do not go on in lower case. Each
is normalised (lower case; anything but letters and digits, comment signs included, becomes one space), and
known licence sentences are mapped to identifiers. As a cut may fall within a sentence (wrapped lines in
capitals, "v. 2.0", "software: you can"), a known sentence is one piece or several that follow each
other. Names that differ from text to text (of holders, of those who provide) are first replaced by the usual words. The
identifiers of a text, in order, are then matched against ordered rules: a licence
is found where the identifiers of its rule follow each other. A sentence that is none of the known ones but reads as a clause of
a licence comes between them, so that a text with a further clause is not taken for the licence without it. Everything is one
projection: no shuffle, no Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Sentences of well-known licences, normalised, with identifiers of our own.
SENTENCES = {
    "apache-line": "licensed under the apache license version 2 0",
    "apache-header": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "apache-title": "apache license version 2 0 january 2004 http www apache org licenses",
    "mit-line": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-title": "the mit license mit",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-asis": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-asis": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "gpl-classpath": "as a special exception the copyright holders of this library give you permission to link this library with independent modules to produce an executable regardless of the license terms of these independent modules and to copy and distribute the resulting executable under terms of your choice provided that you also meet for each linked independent module the terms and conditions of the license of that module",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-see": "see the gnu lesser general public license for more details",
    "lgpl3-title": "gnu lesser general public license version 3 29 june 2007",
    "lgpl21-title": "gnu lesser general public license version 2 1 february 1999",
    "agpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-see": "see the gnu affero general public license for more details",
    "agpl-title": "gnu affero general public license version 3 19 november 2007",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-asis": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-line": "licensed under the bsd license",
    "mpl2-terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl2-title": "mozilla public license version 2 0",
    "zlib-asis": "this software is provided as is without any express or implied warranty",
    "zlib-liable": "in no event will the authors be held liable for any damages arising from the use of this software",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "bsl-line": "distributed under the boost software license version 1 0",
    "bsl-title": "boost software license version 1 0 august 17th 2003",
    "epl2-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "ccby-line": "licensed under cc by 4 0",
    "ccbysa-line": "licensed under cc by sa 4 0",
    "ccbync-line": "licensed under cc by nc 4 0",
    "ccby-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "ccbysa-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc0-work": "this work is dedicated to the public domain under the cc0 1 0 universal licence",
    "bsd-author": "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-advert": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "gpl2only-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl2only-also": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 2 of the license",
    "lgpl20-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "lgpl20-see": "see the gnu library general public license for more details",
    "lgpl20-title": "gnu library general public license version 2 june 1991",
    "epl1-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
    "epl1-title": "eclipse public license v 1 0",
    "wtfpl-title": "do what the fuck you want to public license version 2 december 2004",
    "wtfpl-terms": "do what the fuck you want to public license terms and conditions for copying distribution and modification",
    "artistic2-title": "the artistic license 2 0",
    "ofl-line": "this font software is licensed under the sil open font license version 1 1",
    "cddl-terms": "the contents of this file are subject to the terms of the common development and distribution license",
    "cddl-title": "common development and distribution license cddl version 1 0",
    "rights": "all rights reserved",
}
# Places with a name of the text's own, as the words before, the words after, and what is read there.
NAMES = (
    ("neither the name of ", "nor the names of ", "the copyright holder "),
    ("this software is provided by ", "as is and any express", "the copyright holders and contributors "),
)
#: Words of such a name at most, and what makes an unknown sentence a clause.
NAME_WORDS, CLAUSE, OTHER = 15, "endorse or promote|advertising materials|redistributions|this list of conditions|must be retained", "other"
# Licences by the identifiers that follow each other; several rules may give one licence.
RULES = (
    ("Apache-2.0", ("apache-line",)),
    ("Apache-2.0", ("apache-header",)),
    ("Apache-2.0", ("apache-use", "apache-copy", "apache-basis", "apache-see")),
    ("Apache-2.0", ("apache-title",)),
    ("MIT", ("mit-line",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-asis")),
    ("ISC", ("isc-grant", "isc-asis")),
    ("GPL-3.0", ("gpl3-work",)),
    ("GPL-3.0", ("gpl-free", "gpl-hope", "gpl-see")),
    ("GPL-3.0", ("gpl3-title",)),
    ("GPL-2.0", ("gpl2-free", "gpl-hope", "gpl-see")),
    ("GPL-2.0", ("gpl2-title",)),
    ("Classpath-exception-2.0", ("gpl-classpath",)),
    ("LGPL-2.1", ("lgpl21-free", "lgpl-hope", "lgpl-see")),
    ("LGPL-2.1", ("lgpl21-title",)),
    ("LGPL-3.0", ("lgpl3-free", "lgpl-hope", "lgpl-see")),
    ("LGPL-3.0", ("lgpl3-title",)),
    ("AGPL-3.0", ("agpl-free", "gpl-hope", "agpl-see")),
    ("AGPL-3.0", ("agpl-title",)),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-asis")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-asis")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-author", "bsd-asis")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-name", "bsd-asis")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-author", "bsd-asis")),
    ("GPL-2.0", ("gpl2only-free", "gpl-hope", "gpl-see")),
    ("GPL-2.0", ("gpl2only-also", "gpl-hope", "gpl-see")),
    ("LGPL-2.0", ("lgpl20-free", "lgpl-hope", "lgpl20-see")),
    ("LGPL-2.0", ("lgpl20-title",)),
    ("EPL-1.0", ("epl1-terms",)),
    ("EPL-1.0", ("epl1-title",)),
    ("WTFPL", ("wtfpl-title",)),
    ("WTFPL", ("wtfpl-terms",)),
    ("Artistic-2.0", ("artistic2-title",)),
    ("OFL-1.1", ("ofl-line",)),
    ("CDDL-1.0", ("cddl-terms",)),
    ("CDDL-1.0", ("cddl-title",)),
    ("BSD", ("bsd-grant", "bsd-asis")),
    ("BSD", ("bsd-line",)),
    ("MPL-2.0", ("mpl2-terms",)),
    ("MPL-2.0", ("mpl2-title",)),
    ("Zlib", ("zlib-asis", "zlib-liable")),
    ("Unlicense", ("unlicense",)),
    ("BSL-1.0", ("bsl-line",)),
    ("BSL-1.0", ("bsl-title",)),
    ("EPL-2.0", ("epl2-terms",)),
    ("CC-BY-4.0", ("ccby-line",)),
    ("CC-BY-4.0", ("ccby-work",)),
    ("CC-BY-SA-4.0", ("ccbysa-line",)),
    ("CC-BY-SA-4.0", ("ccbysa-work",)),
    ("CC-BY-NC-4.0", ("ccbync-line",)),
    ("CC0-1.0", ("cc0-work",)),
    ("proprietary", ("rights",)),
)
#: A reservation of all rights stands in the notices of many licences, so it counts only where no licence is found.
WEAK = "proprietary"
# every licence also by its identifier in a header
for _name in dict.fromkeys(n for n, _ in RULES if n not in (WEAK, "BSD", "Classpath-exception-2.0")):
    for _more in ("", "-only", "-or-later") if "GPL" in _name else ("",):
        _id = f"{_name}{_more}".lower()
        SENTENCES[f"spdx-{_id}"] = "spdx license identifier " + re.sub("[^a-z0-9]+", " ", _id)
        RULES += ((_name, (f"spdx-{_id}",)),)
#: Every known sentence has one of these words; texts without any need no cutting.
CUES = "licen|advertising materials|permission|warrant|redistribution|copyright|public domain|rights reserved|compliance|cc by|held liable"
#: Ends of sentences, and line ends before a line that does not go on in lower case.
_END, _LINE = r"([.;:!?])[ \t\r\n]+", r"[ \t\r]*\n[ \t\r\n]*([^a-z \t\r\n])"
#: What stands between sentences after cutting.
_MARK = "\u0001"


def _known_pattern() -> str:
    """Any known sentence from the start of a piece to the end of one, the longest that fits; or else a piece that reads as a clause."""
    some = "|".join(re.sub(" ", f"[ {_MARK}]", s) for s in sorted(SENTENCES.values(), key=len, reverse=True))
    return f"(?<={_MARK})(?:{some}|[^{_MARK}]*(?:{CLAUSE})[^{_MARK}]*)(?={_MARK})"


def sentence_chain(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order, and ``OTHER`` for unknown clauses (array<string>); null and texts without any: empty."""
    cut = F.regexp_replace(F.regexp_replace(text, _END, "$1" + _MARK), _LINE, _MARK + "$1")
    known = F.create_map(*(F.lit(x) for name, sentence in SENTENCES.items() for x in (sentence, name)))
    plain = F.regexp_replace(F.lower(F.concat(F.lit(_MARK), cut, F.lit(_MARK))), f"[^a-z0-9{_MARK}]+", " ")
    pieces = F.regexp_replace(plain, f" ?{_MARK}[ {_MARK}]*", _MARK)
    gap = f"[ {_MARK}]"
    for before, after, words in NAMES:
        pieces = F.regexp_replace(pieces, f"({before.replace(' ', gap)})(?:[a-z0-9]+{gap}){{1,{NAME_WORDS}}}?({after.replace(' ', gap)})", f"$1{words}$2")
    found = F.transform(F.regexp_extract_all(pieces, F.lit(_known_pattern()), F.lit(0)), lambda s: F.coalesce(F.try_element_at(known, F.translate(s, _MARK, " ")), F.lit(OTHER)))
    none = F.array().cast("array<string>")
    return F.when(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ").rlike(CUES), found).otherwise(none)


def licences(ids: Column) -> Column:
    """Licences whose rules the identifiers match, in alphabetical order, each once (array<string>); ``WEAK`` only alone."""
    chain = F.concat(F.lit(","), F.array_join(ids, ","), F.lit(","))
    hits = F.array(*(F.when(F.contains(chain, F.lit("," + ",".join(rule) + ",")), F.lit(name)) for name, rule in RULES))
    found = F.array_sort(F.array_distinct(F.filter(hits, lambda h: h.isNotNull())))
    return F.when(F.size(found) > 1, F.array_remove(found, WEAK)).otherwise(found)


def scan_licences(docs: DataFrame, text: str = "text", ids: str = "licence_sentences", out: str = "licences") -> DataFrame:
    """``docs`` with the known sentences and the licences of each text; columns of those names are replaced.

    Null and empty texts have none; texts are read whole, rows are independent, so repeated rows have equal results.
    """
    return docs.withColumn(ids, sentence_chain(F.col(text))).withColumn(out, licences(F.col(ids))).withColumn(ids, F.array_remove(ids, OTHER))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    found = scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("licence_sentences").cast("long").alias("n_sentences"),
        F.array_join("licence_sentences", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licenses"),
    )


def _oracle() -> str:
    """The same cut; marks are doubled, so that pieces can be taken with the marks on either side."""
    sentences = ", ".join(f"('{s}', '{n}')" for n, s in SENTENCES.items())
    rules = ", ".join(f"('{n}', ',{','.join(r)},')" for n, r in RULES)
    gap = r"[ \x01]+"
    some = "|".join(s.replace(" ", gap) for s in sorted(SENTENCES.values(), key=len, reverse=True))
    named = "s"
    for before, after, words in NAMES:
        named = rf"regexp_replace({named}, '({before.replace(' ', gap)})(?:[a-z0-9]+{gap}){{1,{NAME_WORDS}}}?({after.replace(' ', gap)})', '\1{words}\2', 'g')"
    return rf"""
WITH known(sentence, id) AS (VALUES {sentences}), rules(licence, chain) AS (VALUES {rules}),
cut AS (SELECT doc_id, lower(chr(1) || regexp_replace(regexp_replace(text, '([.;:!?])[ \t\r\n]+', '\1' || chr(1), 'g'), '[ \t\r]*\n[ \t\r\n]*([^a-z \t\r\n])', chr(1) || '\1', 'g') || chr(1)) AS s FROM documents WHERE text IS NOT NULL),
plain AS (SELECT doc_id, regexp_replace(regexp_replace(s, '[^a-z0-9\x01]+', ' ', 'g'), ' ?\x01[ \x01]*', chr(1) || chr(1), 'g') AS s FROM cut),
cued AS (SELECT doc_id FROM documents WHERE regexp_matches(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), '{CUES}')),
found AS (SELECT doc_id, regexp_extract_all({named}, '\x01(?:{some}|[^\x01]*(?:{CLAUSE})[^\x01]*)\x01') AS hits FROM plain SEMI JOIN cued USING (doc_id)),
one AS (SELECT doc_id, unnest(hits) AS hit, unnest(range(len(hits))) AS pos FROM found),
named_ids AS (SELECT doc_id, pos, coalesce(id, '{OTHER}') AS id FROM one LEFT JOIN known ON trim(regexp_replace(hit, '[ \x01]+', ' ', 'g')) = sentence),
chained AS (SELECT doc_id, count(*) FILTER (id <> '{OTHER}') AS n, coalesce(string_agg(id, ',' ORDER BY pos) FILTER (id <> '{OTHER}'), '') AS ids, string_agg(id, ',' ORDER BY pos) AS chain FROM named_ids GROUP BY doc_id),
hit AS (SELECT DISTINCT doc_id, licence FROM chained JOIN rules ON contains(',' || chained.chain || ',', rules.chain)),
named AS (SELECT doc_id, string_agg(licence, ',' ORDER BY licence) AS licenses FROM hit h
          WHERE licence <> '{WEAK}' OR NOT EXISTS (SELECT 1 FROM hit o WHERE o.doc_id = h.doc_id AND o.licence <> '{WEAK}') GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(licenses, '') AS licenses
FROM documents d LEFT JOIN chained USING (doc_id) LEFT JOIN named USING (doc_id)
"""


QUERIES = {"op4_license_scan": op4_license_scan}
ORACLE = {"op4_license_scan": _oracle()}
