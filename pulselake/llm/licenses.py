"""License scans: canonical digests of entire texts, joined to known digests.

A unit of text is brought to canonical form: lower case, copyright
statements dropped, runs of punctuation and white space as one space, equivalent spellings
as one. Its digest is hash-joined to the digests of known licences, so a unit
matches only as a whole. Units are the entire document and each of its lines,
since notices are single lines of longer documents.

The known texts are a constant of this module (or a caller's table of fixed
size), which bounds the broadcast.

Defined results: null and empty texts match nothing and have no lines; units
that are empty in canonical form match nothing. Rows are told apart by id and
text digest, so repeated rows get the same result each, with or without an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts and notices of public licences.
TEXTS = {
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
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}
# One-line notices; {name} and {id} are filled in below.
NOTICES = (
    "{name}", "{name} License", "The {name} License", "License: {name}", "SPDX-License-Identifier: {id}",
    "Released under the {name} License", "Licensed under the {name} License", "Licensed under {name}", "Licensed under the {name}",
    "This work is licensed under the {name}", "This project is licensed under the {name} License",
    "This software is licensed under the {name} License", "Distributed under the {name} License",
)
# Licence ids and the names that notices use for them.
NAMES = {
    "MIT": ("MIT",),
    "ISC": ("ISC",),
    "BSD-2-Clause": ("BSD 2-Clause", "Simplified BSD"),
    "BSD-3-Clause": ("BSD 3-Clause", "New BSD"),
    "Apache-2.0": ("Apache", "Apache 2.0", "Apache License, Version 2.0", "Apache License 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GPL v2", "GPL-2.0", "GNU GPL v2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GPL v3", "GPL-3.0", "GNU GPL v3"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL v3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL v3", "AGPL-3.0"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0", "CC0 1.0"),
}
CC_PARTS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")
# Equivalent spellings, as the canonical form writes them.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "licencing": "licensing", "sublicence": "sublicense",
    "acknowledgement": "acknowledgment", "analogue": "analog", "authorised": "authorized", "behaviour": "behavior",
    "favour": "favor", "fulfil": "fulfill", "judgement": "judgment", "organisation": "organization", "recognised": "recognized",
    "whilst": "while", "noncommercial": "non commercial", "non infringement": "noninfringement", "per cent": "percent",
}
_REDISTRIBUTION = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:
{0}Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
{1}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_ENDORSEMENT = """{2}Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""
_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_NUMBERED, _PLAIN = ("1. ", "2. ", "3. "), ("", "", "")
# More entire texts and headers.
MORE_TEXTS = [
    *(("BSD-2-Clause", (_REDISTRIBUTION + _DISCLAIMER).format(*n)) for n in (_NUMBERED, _PLAIN)),
    *(("BSD-3-Clause", (_REDISTRIBUTION + _ENDORSEMENT + _DISCLAIMER).format(*n)) for n in (_NUMBERED, _PLAIN)),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    *(("Apache-2.0", f"""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at {scheme}://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""") for scheme in ("http", "https")),
]
MORE_TEXTS.append(("Unlicense", MORE_TEXTS[4][1] + "\nFor more information, please refer to <https://unlicense.org>"))
MORE_TEXTS.append(("Unlicense", MORE_TEXTS[4][1] + "\nFor more information, please refer to <http://unlicense.org>"))
# Title lines above entire texts.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
# More names in notices.
MORE_NAMES = {"Zlib": ("zlib", "zlib/libpng")}
PUNCTUATION = r"[^\p{L}\p{N}\n]+"
#: A copyright statement on a line of its own: the word, then a year or an owner. Running text goes on with other words, wherever it is wrapped.
_RUNNING = r"(?:holders?|owners?|notices?|interests?|laws?|licenses?|statements?|and|or|is|in|to|of|for)\b"
STATEMENT_LINE = rf"(?m)^ ?(?:(?:c ?)?(?:(?:copyright|copr) (?!{_RUNNING})[^\s].*|c [0-9]{{4}}\b.*)|all rights reserved ?)$"
_OWNED = r"copyright|copr|c [0-9]{4}|all rights reserved"
_VARIANTS = rf"\b(?:{'|'.join(SPELLINGS)})\b"


def known_texts() -> list[tuple[str, str]]:
    """``(licence id, text)`` of the first texts, and of notices."""
    names = {k: list(v) for k, v in NAMES.items()}
    for part in CC_PARTS:
        for version in CC_VERSIONS:
            names[f"CC-{part}-{version}"] = [f"CC {part} {version}", f"Creative Commons {part} {version}"]
    notices = [(k, n.format(name=name, id=k)) for k, v in names.items() for name in v for n in NOTICES]
    return list(TEXTS.items()) + notices


def all_texts() -> list[tuple[str, str]]:
    """``(licence id, text)`` of all texts, with and without a title line, and notices."""
    whole = [*TEXTS.items(), *MORE_TEXTS]
    titled = [(k, f"{title}\n{text}") for k, text in whole for title in TITLES.get(k, ())]
    notices = [(k, n.format(name=name, id=k)) for k, v in MORE_NAMES.items() for name in v for n in NOTICES]
    return known_texts() + MORE_TEXTS + titled + notices


def canonical_lines(rows: DataFrame, column: str) -> DataFrame:
    """Bring a text column to canonical form, but for spellings, with its line breaks kept.

    Each form is a column of its own, so that it is computed once; the costly
    replacements run only where their pattern occurs.
    """
    plain = F.regexp_replace(F.lower(F.replace(column, F.lit("©"), F.lit("(c) "))), PUNCTUATION, " ")
    rows = rows.withColumn(column, plain)
    return rows.withColumn(column, F.when(F.rlike(column, F.lit(_OWNED)), F.regexp_replace(column, STATEMENT_LINE, "")).otherwise(F.col(column)))


def digests(rows: DataFrame, column: str) -> DataFrame:
    """Replace units of ``canonical_lines`` by the digest of their canonical form; drop empty ones."""
    rows = rows.withColumn(column, F.trim(F.regexp_replace(column, r"[ \n]+", " "))).where(F.col(column) != "")
    spelled = F.col(column)
    for variant, chosen in SPELLINGS.items():
        spelled = F.regexp_replace(spelled, rf"\b{variant}\b", chosen)
    return rows.withColumn(column, F.md5(F.when(F.rlike(column, F.lit(_VARIANTS)), spelled).otherwise(F.col(column))))


def known_digests(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """``(license, digest)``, one row per digest."""
    given = spark.createDataFrame(all_texts() if texts is None else texts, "license string, text string")
    known = digests(canonical_lines(given, "text"), "text").withColumnRenamed("text", "digest")
    return known.groupBy("digest").agg(F.min("license").alias("license"))


def scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", texts: list[tuple[str, str]] | None = None
) -> DataFrame:
    """Per row: doc_id, n_lines, whole_license, n_license_lines, licenses, matches.

    ``matches`` is an array of (line, license), the entire document being line
    -1; ``licenses`` the distinct ids in order, joined by commas.
    """
    text = F.col(text_column)
    rows = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    known = F.broadcast(known_digests(docs.sparkSession, texts))
    units = canonical_lines(rows.where("text <> ''").withColumn("text_digest", F.md5("text")), "text")
    # The entire text is line -1; a text of one line is that line only once.
    lines = F.split("text", "\n")
    parts = F.concat(F.array("text"), F.when(F.size(lines) > 1, lines).otherwise(F.array().cast("array<string>")))
    parts = units.select("doc_id", "text_digest", F.posexplode(parts).alias("line", "digest")).withColumn("line", F.col("line") - 1)
    found = digests(parts, "digest").join(known, "digest").groupBy("doc_id", "text_digest").agg(
        F.sort_array(F.collect_set(F.struct("line", "license"))).alias("matches")
    )
    counted = rows.select(
        "doc_id", F.md5("text").alias("text_digest"),
        F.when(F.coalesce(F.col("text"), F.lit("")) == "", F.lit(0)).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
    ).alias("r")
    joined = counted.join(found.alias("f"), F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & F.col("r.text_digest").eqNullSafe(F.col("f.text_digest")), "left")
    kind = "array<struct<line:int,license:string>>"
    matches = F.coalesce(F.col("matches"), F.array().cast(kind))
    single_lines = F.filter(matches, lambda m: m["line"] >= 0)
    return joined.select(
        F.col("r.doc_id").alias("doc_id"), "n_lines",
        F.get(F.filter(matches, lambda m: m["line"] < 0), F.lit(0))["license"].alias("whole_license"),
        F.size(single_lines).cast("bigint").alias("n_license_lines"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["license"]))), ",").alias("licenses"),
        matches.alias("matches"),
    )
