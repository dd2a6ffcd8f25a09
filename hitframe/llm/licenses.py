"""Licence scan: canonical texts are looked up by digest among known licences."""

from __future__ import annotations

import re
from itertools import product
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Published licence texts and notices, with their SPDX identifiers.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
        FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO
        THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
        SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
        ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE
        OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
]

# Headings that these texts go by.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": [
        "BSD 3-Clause License",
        "The BSD 3-Clause License",
        'BSD 3-Clause "New" or "Revised" License',
    ],
    "Unlicense": ["The Unlicense", "Unlicense"],
}

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:"""
_BSD_CLAUSES = [
    """Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer.""",
    """Redistributions in binary form must reproduce the above copyright notice, this list of
    conditions and the following disclaimer in the documentation and/or other materials provided
    with the distribution.""",
    """Neither the name of {holder} nor the names of its contributors may be used to endorse or
    promote products derived from this software without specific prior written permission.""",
]
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
{owner} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
_ZERO_BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND"""

# Full texts, one file per SPDX identifier.
TEXTS = Path(__file__).with_name("license_texts")
_TERMS_END = "END OF TERMS AND CONDITIONS"

# Spellings that licence matching takes as equal, after lower-casing.
SPELLINGS = [
    (r"\blicence(s|d)?\b", "license$1"),
    (r"\b(sub) licen", "$1licen"),
    (r"\b(organ|author|util|recogn)is(e|ed|es|ing|ation)\b", "$1iz$2"),
    (r"\bversion ([0-9])|\bv([0-9])", "version $1$2"),
    (r"\bnon commercial\b", "noncommercial"),
    (r"\bnon infringement\b", "noninfringement"),
]

# Whole lines that name a holder and differ from copy to copy. A line of running text may
# begin with these words as well, so a sign, a year or a blank to fill in has to follow.
_HOLDER = (
    r"(?m)^[ \t]*(copyright[ \t:]*(\(c\)|©|&copy;|[0-9]{4}|[<\[{])"
    r"|(\(c\)|©)[ \t]*(copyright\b|[0-9]{4}|[<\[{])|all rights reserved[. \t]*$).*$"
)
_PUNCTUATION = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, one blank for punctuation, one spelling."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _HOLDER, "")
    out = F.regexp_replace(out, _PUNCTUATION, " ")
    for pattern, spelling in SPELLINGS:
        out = F.regexp_replace(out, pattern, spelling)
    return F.trim(out)


def known_licenses(spark: SparkSession) -> DataFrame:
    """``(license, text)`` of the notices and full texts, with and without their headings."""
    return spark.createDataFrame(_known_rows(), "license string, text string")


def _known_rows() -> list[tuple[str, str]]:
    return [*NOTICES, *_short_texts(), *_full_texts()]


def _short_texts() -> list[tuple[str, str]]:
    """Texts of a few paragraphs, as published and under each of their headings."""
    bodies = [(name, text) for name, text in NOTICES if "THE SOFTWARE IS PROVIDED" in text]
    isc = dict(bodies)["ISC"]
    bodies.append(("0BSD", _ZERO_BSD + isc.split('"AS IS" AND')[1]))
    forms = product(
        [2, 3],
        [True, False],
        ["HOLDER", "OWNER"],
        ["the copyright holder", "the copyright holders", "copyright holder", "the University"],
    )
    for count, numbered, owner, holder in forms:
        clauses = [f"{n}. {c}" if numbered else c for n, c in enumerate(_BSD_CLAUSES[:count], 1)]
        text = "\n".join([_BSD_HEAD, *clauses, _BSD_TAIL]).format(holder=holder, owner=owner)
        bodies.append((f"BSD-{count}-Clause", text))
    return [
        (name, text)
        for name, body in dict.fromkeys(bodies)
        for text in [body, *[f"{title}\n{body}" for title in TITLES[name]]]
    ]


def _full_texts() -> list[tuple[str, str]]:
    """Long texts with and without the heading above and the instructions below the terms."""
    out = []
    for path in sorted(TEXTS.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        forms = [text]
        if _TERMS_END in text:
            terms = text.split(_TERMS_END)[0]
            forms += [terms + _TERMS_END, terms]
        if path.stem in TITLES:  # without a heading of its own
            out += [(path.stem, text), *[(path.stem, f"{title}\n{text}") for title in TITLES[path.stem]]]
            continue
        for form in forms:
            # the heading is what stands before the first empty line
            _, _, body = form.lstrip().partition("\n\n")
            out += [(path.stem, form), (path.stem, body)]
    return out


def license_scan(
    docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, n_notices, licenses, whole_text)``: one row per id.

    Both sides are put in canonical form, and the whole canonical text is looked up
    by its SHA-256. Texts looked up are that of the document (``whole_text`` is its
    licence) and that of each of its lines, as a notice often closes a document
    (``n_notices`` and ``licenses``, sorted). Texts with nothing left in canonical
    form match nothing. If two licences have one canonical text the first in order
    is reported. The known texts are broadcast if Spark measures them as small, and
    else joined by a shuffle that may split a frequent notice.

    Null and empty texts have no notice. Rows that repeat an id are one document with
    the lines of all; rows without an id likewise. Other columns are not read.
    """
    listed = (
        known.select("license", canonical(F.col("text")).alias("_canonical"))
        .where("_canonical != ''")
        .groupBy(F.sha2("_canonical", 256).alias("_digest"))
        .agg(F.min("license").alias("license"))
    )
    # the document comes first, its lines after it
    said = F.coalesce(F.col(text), F.lit(""))
    units = docs.select(
        F.col(key).alias("_id"),
        F.posexplode(F.concat(F.array(said), F.split(said, "\n", -1))).alias("_at", "_unit"),
    ).select(
        "_id", (F.col("_at") == 0).alias("whole"), F.sha2(canonical(F.col("_unit")), 256).alias("_digest")
    )
    found = units.join(listed, "_digest", "left")
    notice = F.col("license").isNotNull() & ~F.col("whole")
    return (
        found.groupBy("_id")
        .agg(
            F.count(F.when(notice, True)).alias("n_notices"),
            F.array_join(F.sort_array(F.collect_set(F.when(notice, F.col("license")))), ",").alias("licenses"),
            F.min(F.when(F.col("whole"), F.col("license"))).alias("whole_text"),
        )
        .withColumnRenamed("_id", key)
    )


def oracle_sql() -> str:
    """The same scan of ``documents`` in SQL, with the same texts and rules."""

    def form(column: str) -> str:
        out = f"regexp_replace(lower(coalesce({column}, '')), '{_HOLDER}', '', 'g')"
        out = f"regexp_replace({out}, '{_PUNCTUATION}', ' ', 'g')"
        for pattern, spelling in SPELLINGS:
            target = re.sub(r"\$(\d)", r"\\\1", spelling)
            out = f"regexp_replace({out}, '{pattern}', '{target}', 'g')"
        return f"trim({out})"

    values = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in dict.fromkeys(_known_rows()))
    return f"""
        WITH known AS (
          SELECT canonical, min(license) AS license
          FROM (SELECT license, {form("text")} AS canonical FROM (VALUES {values}) v(license, text))
          GROUP BY canonical),
        units AS (
          SELECT doc_id, false AS whole, {form("line")} AS canonical
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
          UNION ALL SELECT doc_id, true, {form("text")} FROM documents)
        SELECT doc_id, count(license) FILTER (NOT whole) AS n_notices,
               coalesce(string_agg(DISTINCT license, ',' ORDER BY license) FILTER (NOT whole), '') AS licenses,
               min(license) FILTER (whole) AS whole_text
        FROM units LEFT JOIN known USING (canonical) GROUP BY doc_id
    """
