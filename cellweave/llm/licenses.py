"""License scans by canonical digest, in DataFrame operations alone.

Whole texts, and their single lines, are brought to a canonical form (case, punctuation, copyright lines,
equivalent spellings) whose digest is joined to the digests of known licence texts and notices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import read_table, text_of

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

#: Public licence texts and the usual notices that refer to a licence.
KNOWN: tuple[tuple[str, str], ...] = (
    ("MIT", _MIT),
    ("MIT", "The MIT License\n" + _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n" + _ISC),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("Unlicense", _UNLICENSE),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n" + _ZLIB),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
)
#: Spellings that count as equal, the second one standing for both.
SPELLINGS: tuple[tuple[str, str], ...] = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("analyse", "analyze"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("noninfringement", "non infringement"),
    ("organisation", "organization"),
    ("recognise", "recognize"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("https", "http"),
    ("v 2 0", "version 2 0"),
)
#: Every known text holds one of these in whatever spelling; a text without them isn't brought to canonical form.
ANCHOR = "(?i)licen[cs]e|permission|redistribution|unencumbered"
COPYRIGHT_LINE = r"(?m)^[^\S\n]*[*#/;-]*[^\S\n]*(?:copyright|\(c\)|©|all rights reserved).*$"


def canonical(text: Column) -> Column:
    """Lower case without copyright lines; other characters than letters and digits become single spaces; one spelling."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(out)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``digest, license, n_chars``: a row per known canonical form; their number is that of ``known`` at most."""
    rows = spark.createDataFrame(list(known), "license string, text string").select("license", canonical(F.col("text")).alias("text"))
    return rows.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("license").alias("license"), F.max(F.length("text")).alias("n_chars"))


def license_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """``doc_id, unit, license``: a row for each whole text (unit -1) and each line (its position) that is a known text.

    The known digests (each of a text that holds an ``ANCHOR``) are a fixed list and are broadcast; the documents
    aren't shuffled. Forms longer than any known
    one get no digest. A null text counts as empty and matches nothing; a null id stays null; repeated rows match
    each; an empty table gives no rows.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    longest = known.agg(F.max("n_chars").alias("n")).first()["n"] or 0
    # The inner array of one form makes Spark compute the form once, however often the lambda uses it.
    digest = lambda text: F.transform(F.array(canonical(text)), lambda form: F.when((F.length(form) > 0) & (F.length(form) <= longest), F.sha2(form, 256)))[0]
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).where(F.rlike("text", F.lit(ANCHOR)))
    lines = F.transform(F.split("text", "\n"), lambda line, k: F.struct(k.alias("unit"), digest(line).alias("digest")))
    units = slim.select("doc_id", F.explode(F.array_append(lines, F.struct(F.lit(-1).alias("unit"), digest(F.col("text")).alias("digest")))).alias("x"))
    return units.select("doc_id", "x.*").join(F.broadcast(known.select("digest", "license")), "digest").select("doc_id", "unit", "license")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(read_table(spark, sf_dir, "documents"))


def _sql_canonical(text: str) -> str:
    line = COPYRIGHT_LINE.replace("'", "''")
    out = f"' ' || trim(regexp_replace(regexp_replace(lower({text}), '{line}', '', 'g'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
    for old, new in SPELLINGS:
        out = f"replace({out}, ' {old} ', ' {new} ')"
    return f"trim({out})"


def op2_sql() -> str:
    quoted = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)
    return f"""
    WITH known AS (SELECT min(license) AS license, form FROM (SELECT license, {_sql_canonical("text")} AS form FROM (VALUES {quoted}) AS k(license, text)) GROUP BY form),
    texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    parts AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM texts),
    units AS (SELECT doc_id, -1 AS unit, text FROM texts
              UNION ALL SELECT doc_id, unnest(range(len(lines))) AS unit, unnest(lines) AS text FROM parts),
    forms AS (SELECT doc_id, unit, {_sql_canonical("text")} AS form FROM units)
    SELECT doc_id, CAST(unit AS INTEGER) AS unit, license FROM forms JOIN known USING (form) WHERE form <> ''"""
