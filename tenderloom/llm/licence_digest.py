"""License scans by canonical digest lookup.

A text is brought to a canonical form: lower case, copyright lines dropped, equivalent spellings
made equal, punctuation and white space reduced to single spaces. The digest of the whole
canonical text is joined with the digests of known licences and notices. Texts here are whole
documents and, since files quote a notice on a line of its own, their single lines; nothing
shorter than a line is compared, so a mention of a licence in running text is none.

The known texts go through the same expressions as the documents. Their table is one row per
text in this module, a few dozen at most, so it is broadcast; the documents are not shuffled.

Defined cases: null, empty and blank texts, and texts of copyright lines only, match nothing;
repeated lines of a document count as often as they occur, repeated rows are scanned alike, and an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: spellings that count as equal, first one becomes the second
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licensor's", "licensors"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("centre", "center"), ("copyright holders", "copyright holder"), ("copyright owner", "copyright holder"), ("favour", "favor"),
    ("fulfil", "fulfill"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("modelling", "modeling"), ("noncommercial", "non-commercial"), ("organisation", "organization"), ("programme", "program"),
    ("recognise", "recognize"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("per cent", "percent"),
    ("sub-license", "sublicense"), ("sub license", "sublicense"), ("http://", "https://"),
)

# fixed values: public notices and short public licences
_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
    "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
            "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
            "whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this "
            "permission notice shall be included in all copies or substantial portions of the Software.\n\n" + _WARRANTY),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                   "the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by "
                   "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
                   "governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n"
             + _ISC_WARRANTY),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def canonical(text: Column) -> Column:
    """The canonical form of a text; empty where nothing is left."""
    # copyright lines are recognised before punctuation goes
    lines = F.filter(F.split(F.lower(text), "\n"), lambda l: ~l.rlike(
        r"^[\s#*/;%-]*(?:copyright\b|\(c\)|©).*(?:\d{4}|holder|owner|author|<|\(c\)|©)|^[\s#*/;%-]*all rights reserved\.?\s*$"))
    words = F.regexp_replace(F.array_join(lines, " "), r"\s+", " ")      # spellings may be broken over lines
    pattern = r"\b(?:" + "|".join(a.replace("-", r"\-") for a, _ in sorted(SPELLINGS, key=lambda p: -len(p[0])) if "/" not in a) + r")\b"
    spelt = words
    # most texts hold none of the spellings: one test spares them all replacements
    for a, b in SPELLINGS:
        spelt = F.replace(spelt, F.lit(a), F.lit(b)) if "/" in a else F.regexp_replace(spelt, rf"\b{a}\b", b)
    chosen = F.when(words.rlike(pattern) | words.contains("http://"), spelt).otherwise(words)
    return F.trim(F.regexp_replace(chosen, r"[^\p{L}\p{N}]+", " "))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, license) of the known texts."""
    quoted = ", ".join("('{}', '{}')".format(name, text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")) for name, text in known)
    table = spark.sql(f"SELECT * FROM VALUES {quoted} AS t(license, text)")
    return table.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license").distinct()


def scan_licences(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", known=KNOWN) -> DataFrame:
    """A row per match: doc_id, line (0 for the whole text, else its number from 1), license, digest."""
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("_text")).where("_text IS NOT NULL")
    lines = F.split("_text", "\n")
    # a text of one line is its own whole
    units = own.select("doc_id", F.posexplode(F.when(F.size(lines) > 1, F.concat(F.array("_text"), lines)).otherwise(F.array("_text"))).alias("line", "_unit"))
    digests = units.select("doc_id", F.col("line").cast("long").alias("line"), canonical(F.col("_unit")).alias("_canonical")) \
        .where("_canonical != ''").select("doc_id", "line", F.sha2("_canonical", 256).alias("digest"))
    return digests.join(F.broadcast(known_digests(docs.sparkSession, known)), "digest").select("doc_id", "line", "license", "digest")
