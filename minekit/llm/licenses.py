"""Licence scan: digests of canonical texts, looked up among those of known licences.

Canonical form: notices of copyright are removed, A-Z lower-cased, equivalent spellings unified, all runs of
other characters than a-z and 0-9 become one blank. A notice is a line of at most 200 more characters that begins with
``copyright`` or its sign and goes on with a year, a placeholder, or the sign and a name, or a paragraph of one line
that begins with ``Copyright`` and a name; ``All rights reserved`` on the next line belongs to it. A sentence of the licence that
happens to be wrapped before the word is none, so the form does not depend on line breaks. Texts with the same canonical form have the
same SHA-256, so whole texts meet the known licences in one hash join. A notice is a single line
that is the whole of a known text.

Cases: null texts and texts without a canonical word have no digest and no licence. Repeated rows are all
reported. Known texts that become empty are left out; if several have one canonical form, the smallest
id stands for it. Columns beyond ``doc_id`` and ``text`` are ignored.

Known licences: the texts below and those in the folder ``license_texts`` (a file per id), each as it stands, on one line, with and
without its title, and without what follows the end of its terms; notices are phrases built from ``NAMES`` and ``PHRASES``.
"""

from __future__ import annotations

import json
import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: equivalent spellings, and texts of licences and their usual notices
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("whilst", "while"),
    ("favour", "favor"),
    ("https:", "http:"),
    ("(c)", "copyright"),
)
_SIGN = r"(?:\(c\)|©|&copy;)"
_GAP = r"[ \t,:.]*"
_DATED = r"(?:(?:19|20)[0-9]{2}|[<\[{])"  # a year, or the placeholder of one
_REST = r"[^\n]{0,200}(?:\n[^A-Za-z0-9\n]*all rights reserved[^A-Za-z0-9\n]*)?$"
_WORDS = r"(?:holder|owner|notice|licen[sc]e|law|treat|act\b|interest|statement|permission|and\b|or\b)"
NOTICES = (
    rf"(?im)^[^A-Za-z0-9\n]*(?:copyright{_GAP}(?:{_SIGN}{_GAP})?{_DATED}|{_SIGN}{_GAP}(?:copyright{_GAP})?{_DATED}"
    rf"|copyright{_GAP}{_SIGN}{_GAP}(?!{_WORDS})[^\s]|{_SIGN}{_GAP}copyright{_GAP}(?!{_WORDS})[^\s]|©{_GAP}(?!{_WORDS})[^\s]){_REST}",
    rf"(?m)(?:\A|(?<=\n[ \t\r]{{0,9}}\n))[^A-Za-z0-9\n]*Copyright (?:by )?(?!(?i:{_WORDS}))[A-Z][^\n]{{0,200}}"
    r"(?=\s*\z|\n[ \t\r]*\n|\n[^A-Za-z0-9\n]*(?i:all rights reserved)[^A-Za-z0-9\n]*$)(?:\n[^A-Za-z0-9\n]*(?i:all rights reserved)[^A-Za-z0-9\n]*$)?",
)
# the SQL keeps its own, coarser pattern: any line that begins with the word
COPYRIGHT_LINE = r"(?im)^[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*$"
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT notice": "Released under the MIT License.",
}
# title lines that whole texts may have or lack
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "Apache-2.0": ("Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/",),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "BSD License"),
    "BSL-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003",),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT"),
    "Unlicense": ("The Unlicense", "Unlicense"),
    "Zlib": ("zlib License", "The zlib License"),
}
_BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is
furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the
following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source
language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR
ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING
FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

"""
# names of licences in notices; a name stands alone, with "the", and with "License" behind it
NAMES = {
    "0BSD": ("BSD Zero Clause", "0BSD"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPL-3.0", "AGPLv3"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache-2.0"),
    "BSD-2-Clause": ("BSD 2-Clause", "2-Clause BSD", "Simplified BSD"),
    "BSD-3-Clause": ("BSD 3-Clause", "3-Clause BSD", "New BSD"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL-1.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"),
    **{
        f"CC-{kind}-{v}": (f"CC {kind} {v}", f"Creative Commons {long} {v}", f"Creative Commons {long} {v} International", f"a Creative Commons {long} {v} International")
        for kind, long in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for v in ("3.0", "4.0")
    },
    "EPL-2.0": ("Eclipse Public License 2.0", "EPL-2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GPL-2.0", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GPL-3.0", "GPLv3"),
    "ISC": ("ISC",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPL-2.1", "LGPLv2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPL-3.0", "LGPLv3"),
    "MIT": ("MIT", "MIT License (MIT)"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL-2.0", "MPL 2.0"),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib",),
}
PHRASES = (
    "Licensed under", "Released under", "Distributed under", "Available under", "This work is licensed under", "This software is licensed under",
    "This project is licensed under", "This code is licensed under", "License:", "SPDX-License-Identifier:",
)


def _forms(name: str, text: str) -> list[str]:
    """A whole text as it stands and in the forms in which it is handed on."""
    titles = [t for t in TITLES.get(name, ())]
    out = [text]
    end = re.search(r"(?m)^.*END OF TERMS AND CONDITIONS.*$", text)
    if end:
        out += [text[: end.start()], text[: end.end()]]
    for title in titles:
        if re.sub(r"\s+", " ", text).strip().startswith(re.sub(r"\s+", " ", title)):  # also without it
            out += [re.sub(r"\s*" + r"\s+".join(map(re.escape, title.split())), "", x, count=1) for x in list(out)]
    if name.startswith("BSD"):
        out += [re.sub(r"(?m)^\d\. ", "", x) for x in list(out)]
        out += [x.replace("COPYRIGHT HOLDER OR CONTRIBUTORS", "COPYRIGHT OWNER OR CONTRIBUTORS") for x in list(out)]
    out += [f"{t}\n\n{x}" for t in titles for x in list(out)]
    return out + [" ".join(x.split()) for x in out]


def known_texts() -> dict[str, list[str]]:
    """All known texts by id: whole licences in their forms, and notices."""
    whole = {k: v for k, v in KNOWN.items() if not k.endswith(" notice")} | {"BSL-1.0": _BOOST}
    whole["BSD-3-Clause"] = whole["BSD-2-Clause"].replace("THIS SOFTWARE IS PROVIDED", _BSD_3 + "THIS SOFTWARE IS PROVIDED")
    for file in resources.files(__package__).joinpath("license_texts").iterdir():
        if file.name.endswith(".txt"):
            whole[file.name[:-4]] = file.read_text("utf-8")
    out = {name: _forms(name, text) for name, text in whole.items()}
    for name, text in KNOWN.items():
        if name.endswith(" notice"):
            out[name] = [text]
    for name, names in NAMES.items():
        called = [f"{the}{x}{end}" for x in (*names, name) for the in ("", "the ") for end in ("", " License")]
        out.setdefault(f"{name} notice", []).extend(f"{p} {x}" for p in PHRASES for x in called)
    return out


def _lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _marked(lowered: Column) -> Column:
    """Whether a lower-cased text can hold a notice of copyright at all."""
    marks = [F.contains(lowered, F.lit(m)) for m in ("copyright", "(c)", "©", "&copy;")]
    return marks[0] | marks[1] | marks[2] | marks[3]


def _plain(lowered: Column) -> Column:
    for spelling, same in SPELLINGS:
        lowered = F.replace(lowered, F.lit(spelling), F.lit(same))
    return F.trim(F.regexp_replace(lowered, "[^a-z0-9]+", " "))


def canonical(text: Column) -> Column:
    """The canonical form of a text; empty if nothing is left, null for null."""
    for notice in NOTICES:
        text = F.regexp_replace(text, notice, "")
    return _plain(_lowered(text))


def beginnings(firsts: list[str]) -> str:
    """What a line without notices begins with, before spellings are unified, if its form begins with one of ``firsts``."""
    out = set(firsts)
    for first in firsts:
        for spelling, same in SPELLINGS:
            lead = re.match("[a-z0-9]*", spelling)[0]
            # a spelling may also run over the end of the first word, or make two words of it
            out |= {first[:i] + lead for i in range(len(first) + 1) if lead and same.startswith(first[i : i + len(same)])}
    return "|".join(sorted(x for x in out if x))


def known_digests(spark: SparkSession, known: dict[str, str | list[str]]) -> DataFrame:
    """``digest, license, form_length, first_word`` of known texts."""
    texts = [(k, x) for k, v in known.items() for x in ([v] if isinstance(v, str) else v)]
    rows = spark.createDataFrame(texts, "license string, text string")
    forms = rows.select("license", canonical(F.col("text")).alias("form")).where("form <> ''")
    return forms.groupBy(F.sha2("form", 256).alias("digest")).agg(
        F.min("license").alias("license"), F.first(F.length("form")).alias("form_length"),
        F.first(F.substring_index("form", " ", 1)).alias("first_word"),
    )


def license_scan(docs: DataFrame, known: dict[str, str | list[str]] | None = None) -> DataFrame:
    """``doc_id, digest, license, notices`` of every row; ``notices`` joins the ids of the known lines, sorted, by commas.

    ``known``: a text or texts by id; by default all of ``known_texts()``.
    """
    spark = docs.sparkSession
    listed = known_digests(spark, known_texts() if known is None else known).collect()  # as many rows as known texts
    digests = spark.createDataFrame([(r.digest, r.license) for r in listed], "digest string, license string")
    lengths = sorted({r.form_length for r in listed}) or [0]
    firsts = sorted({r.first_word for r in listed}) or [""]
    names = F.from_json(F.lit(json.dumps({r.digest: r.license for r in listed})), "map<string,string>")  # one literal

    # lines that cannot begin a known form, and texts without such lines, are not brought to their form
    begins = rf"^[^a-z0-9\n]*(?:{beginnings(firsts)})"
    low = docs.select("doc_id", "text", _lowered(F.col("text")).alias("low"))
    low = low.select("*", _marked(F.col("low")).alias("marked"))
    lines = F.filter(F.split("text", "\n"), lambda x: _marked(_lowered(x)) | F.rlike(_lowered(x), F.lit(begins)))
    forms = F.filter(F.transform(lines, canonical), lambda x: F.length(x).isin(lengths) & F.substring_index(x, " ", 1).isin(firsts))
    found = F.filter(F.transform(forms, lambda x: F.element_at(names, F.sha2(x, 256))), lambda x: x.isNotNull())
    notices = F.when(
        F.col("marked") | F.rlike(F.col("low"), F.lit("(?m)" + begins)), F.array_join(F.array_sort(F.array_distinct(found)), ",")
    )
    form = F.when(F.col("marked"), canonical(F.col("text"))).otherwise(_plain(F.col("low")))
    rows = low.select(
        "doc_id",
        F.sha2(F.nullif(form, F.lit("")), 256).alias("digest"),
        F.coalesce(notices, F.lit("")).alias("notices"),
    )
    return rows.join(F.broadcast(digests), "digest", "left").select(
        "doc_id", "digest", "license", "notices"
    )


def oracle(known: dict[str, str] = KNOWN) -> str:
    """The same over the table ``documents``, in SQL."""

    def form(x: str) -> str:
        plain = f"translate(regexp_replace({x}, '{COPYRIGHT_LINE}', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        for spelling, same in SPELLINGS:
            plain = f"replace({plain}, '{spelling}', '{same}')"
        return f"trim(regexp_replace({plain}, '[^a-z0-9]+', ' ', 'g'))"

    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in known.items())
    return f"""
WITH known AS (SELECT sha256({form('t')}) AS digest, min(id) AS license FROM (VALUES {values}) AS v(id, t) GROUP BY 1),
docs AS (SELECT doc_id, text, {form('text')} AS form FROM documents),
lines AS (
  SELECT doc_id, license FROM (
    SELECT doc_id, {form('line')} AS form FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  ) AS l JOIN known ON known.digest = sha256(l.form) WHERE l.form <> ''
),
notices AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS notices FROM (SELECT DISTINCT * FROM lines) GROUP BY 1)
SELECT d.doc_id, CASE WHEN form <> '' THEN sha256(form) END AS digest, k.license, coalesce(n.notices, '') AS notices
FROM docs d LEFT JOIN known k ON form <> '' AND k.digest = sha256(form) LEFT JOIN notices n ON n.doc_id = d.doc_id
"""
