"""Licence detection by digests of canonical texts.

Every line is put into canonical form once: lower case, copyright statements dropped, spellings that mean the
same made one, punctuation and white space closed up.  A text and its paragraphs are its lines joined, so
line breaks do not matter.  Where the length is that of a known licence text, the digest is joined with
those of the known texts, made by the very same expressions.

Native expressions.  Defined results: null, empty and licence-less texts give no rows.  Every
unit (``text``, ``paragraph``, ``line``) that is equal to a known text gives a row; a text of
one line has no other units.  ``part`` numbers lines from 0, and paragraphs, which are runs of lines that
are not blank.  A copyright statement is a line that begins with the word, the sign or (c) and goes on with a sign, a year
or a holder after "by"; other lines that begin with the word are part of the text.  Rows are handled one by one,
so repeated rows repeat; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Public licence notices, and short statements of a licence.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
    "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
    "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
    "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
    'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
    "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
    "specific language governing permissions and limitations under the License."
)
_MPL_NOTICE = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
_BSD_3RD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GPL_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later "
    "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
    "details. You should have received a copy of the GNU General Public License along with this program."
)
_GPL_LINK = " If not, see <http://www.gnu.org/licenses/>."
#: Whole texts, which may stand below one of these titles.
TITLED = (
    ("BSD-2-Clause", _BSD_2 + _BSD_DISCLAIMER, ("BSD 2-Clause License", "The 2-Clause BSD License")),
    ("BSD-3-Clause", _BSD_2 + _BSD_3RD + _BSD_DISCLAIMER, ("BSD 3-Clause License", "The 3-Clause BSD License")),
    ("ISC", _ISC_GRANT, ("ISC License", "The ISC License")),
    ("MIT", _MIT_GRANT, ("MIT License", "The MIT License", "The MIT License (MIT)")),
)
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", _APACHE_NOTICE),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", _MPL_NOTICE),
    *((f"GPL-{v}.0-or-later", _GPL_NOTICE.format(v) + link) for v in (2, 3) for link in ("", _GPL_LINK)),
    *((name, body) for name, body, _ in TITLED),
    *((name, f"{title} {body}") for name, body, titles in TITLED for title in titles),
)
#: Spellings that mean the same, as whole words after lower-casing.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("ver", "version"), ("v", "version"),
    ("https", "http"),
)

#: One line that states a copyright, or what goes with it, after the marks of a comment.
COPYRIGHT_LINE = (
    r"(?i)^\s*[#*/;-]*\s*(?:(?:copyright|\(c\)|©)[\s:]*(?:(?:\(c\)|©|copyright)[\s:]*)*(?:\[?(?:19|20)[0-9]{2}|\[?yyyy|by\s)"
    r"|(?:copyright\s*(?:\(c\)|©)|©|\(c\)\s*copyright)\s|all rights reserved\.?\s*$).*$"
)
#: Stands for a line that is not blank but has no words, so that it does not end a paragraph.
_WORDLESS = "\x01"


def canonical_line(line: Column) -> Column:
    """One line in canonical form; empty for a copyright statement."""
    text = F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))
    usual_form = text
    for spelling, usual in SPELLINGS:
        usual_form = F.regexp_replace(usual_form, rf"\b{spelling}\b", usual)
    unusual = text.rlike(r"\b(?:" + "|".join(spelling for spelling, _ in SPELLINGS) + r")\b")
    stated = line.rlike(r"(?i)copyright|©|\(c\)|all rights reserved") & line.rlike(COPYRIGHT_LINE)
    return F.when(stated, "").when(unusual, usual_form).otherwise(text)


def _closed_up(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, f"[\n{_WORDLESS} ]+", " "))


def _units(text: Column) -> list[Column]:
    """The canonical lines, paragraphs and whole of a text; a text of one line or paragraph has none of that kind."""
    raw = F.split(text, "\n")
    lines = F.transform(raw, lambda line: canonical_line(line))
    marked = F.zip_with(
        raw, lines, lambda r, c: F.when(F.trim(F.translate(r, "\t\r\x0b\x0c", "    ")) == "", "").when(c == "", _WORDLESS).otherwise(c)
    )
    return [lines, F.array_join(marked, "\n")]


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, license, length): as many rows as there are known texts; the length is that of the canonical text."""
    rows = spark.createDataFrame(list(KNOWN), "license string, text string")
    whole = rows.select("license", canonical_line(F.col("text")).alias("canonical"))
    return whole.select(F.sha2("canonical", 256).alias("digest"), "license", F.length("canonical").alias("length")).distinct()


def find_licenses(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, unit, part (its number in the text, from 0) and license of each unit equal to a known text.

    ``known`` has digest, license and length, as ``known_digests`` gives them; the driver sees the different lengths.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    lengths = [r["length"] for r in known.select("length").distinct().collect()]
    lines, marked = _units(F.col("text"))
    formed = docs.where(F.col("text").isNotNull()).select("doc_id", lines.alias("lines"), marked.alias("marked"))
    paragraphs = F.filter(F.split("marked", "\n\n+"), lambda p: p != "")
    unit = lambda kind, parts: F.transform(
        parts, lambda p, i: F.struct(F.lit(kind).alias("unit"), i.cast("bigint").alias("part"), p.alias("content"))
    )
    none = F.array().cast("array<struct<unit:string,part:bigint,content:string>>")
    closed = F.transform(paragraphs, lambda p: _closed_up(p))
    units = formed.select(
        "doc_id",
        F.explode(
            F.filter(
                F.concat(
                    unit("text", F.array(_closed_up(F.col("marked")))),
                    F.when(F.size(paragraphs) > 1, unit("paragraph", closed)).otherwise(none),
                    F.when(F.size("lines") > 1, unit("line", F.col("lines"))).otherwise(none),
                ),
                lambda u: F.length(u["content"]).isin(lengths),
            )
        ).alias("u"),
    )
    digests = units.select("doc_id", "u.unit", "u.part", F.sha2(F.col("u.content"), 256).alias("digest"))
    return digests.join(known.select("digest", "license"), "digest").select("doc_id", "unit", "part", "license")
