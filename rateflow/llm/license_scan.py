"""License scans: entire texts against digests of known licences.

Texts are brought to a canonical form (case, punctuation, copyright lines, equal
spellings) and digested; the digest is looked up by a hash join with those of the
known texts. The unit is an entire text: that of a document, and that of each
line, where notices stand alone. DataFrame functions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.license_texts import short_spellings, whole_texts

# Public licence texts and notices, by SPDX identifier.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
    " software and associated documentation files (the \"Software\"), to deal in the Software"
    " without restriction, including without limitation the rights to use, copy, modify, merge,"
    " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons"
    " to whom the Software is furnished to do so"
)
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,"
    " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
    " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE"
    " FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
    " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
    " DEALINGS IN THE SOFTWARE."
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY"
    " EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF"
    " MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE"
    " COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,"
    " EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF"
    " SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)"
    " HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR"
    " TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS"
    " SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are"
    " permitted provided that the following conditions are met:"
    " 1. Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer."
    " 2. Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials"
    " provided with the distribution."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with"
    " or without fee is hereby granted"
)
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR"
    " DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF"
    " MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,"
    " DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF"
    " USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS"
    " ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_NOTICES = (
    ("MIT", "MIT License\n" + _MIT_GRANT + ", subject to the following conditions: The above"
     " copyright notice and this permission notice shall be included in all copies or substantial"
     " portions of the Software. " + _MIT_WARRANTY),
    ("MIT", _MIT_GRANT + ", subject to the following conditions: The above copyright notice and"
     " this permission notice shall be included in all copies or substantial portions of the"
     " Software. " + _MIT_WARRANTY),
    ("MIT-0", "MIT No Attribution\n" + _MIT_GRANT + ". " + _MIT_WARRANTY),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice"
     " appear in all copies. " + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD_CONDITIONS + " " + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_CONDITIONS + " 3. Neither the name of the copyright holder nor the names"
     " of its contributors may be used to endorse or promote products derived from this software"
     " without specific prior written permission. " + _BSD_WARRANTY),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not"
     " use this file except in compliance with the License. You may obtain a copy of the License at"
     " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in"
     " writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
     " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for"
     " the specific language governing permissions and limitations under the License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
)
_MIT_CONDITIONS = (
    ", subject to the following conditions: The above copyright notice and this permission"
    " notice shall be included in all copies or substantial portions of the Software. "
)
_NEITHER = (
    " may be used to endorse or promote products derived from this software without specific"
    " prior written permission. "
)
_SHORT = (
    ("MIT", _MIT_GRANT + _MIT_CONDITIONS + _MIT_WARRANTY),
    ("MIT-0", _MIT_GRANT + ". " + _MIT_WARRANTY),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice"
     " appear in all copies. " + _ISC_WARRANTY),
    ("ISC", _ISC_GRANT.replace("and/or", "and") + ", provided that the above copyright notice and"
     " this permission notice appear in all copies. " + _ISC_WARRANTY),
    ("0BSD", _ISC_GRANT + ". " + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD_CONDITIONS + " " + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_CONDITIONS + " 3. Neither the name of the copyright holder nor the names"
     " of its contributors" + _NEITHER + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_CONDITIONS + " 3. Neither the name of the University nor the names of its"
     " contributors" + _NEITHER + _BSD_WARRANTY.replace("COPYRIGHT HOLDERS AND", "REGENTS AND")
     .replace("COPYRIGHT HOLDER OR", "REGENTS OR")),
)
#: Notices, then whole texts in all their spellings.
KNOWN_TEXTS = (
    *_NOTICES,
    *((name, spelled) for name, text in _SHORT for spelled in short_spellings(name, text)),
    *whole_texts(),
)

# Lines left out, and spellings brought to one form in turn (on
# lower-case text whose other signs are single spaces).
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©)[^\n]*$"
SIGNS = r"[^a-z0-9\n]+"
EQUIVALENT = (
    (r"\blicence", "license"),
    (r"\blicenc", "licens"),
    (r"\bsub license", "sublicense"),
    (r"\bnon commercial", "noncommercial"),
    (r"\bcopyright owner", "copyright holder"),
    (r"\bcreative commons attribution\b", "cc by"),
    (r"\bv(?:ersion)? ?([0-9])", "version $1"),
)


def _spelled(text: Column) -> Column:
    for pattern, instead in EQUIVALENT:
        text = F.regexp_replace(text, pattern, instead)
    return text


def canonical_lines(text: Column) -> Column:
    """The text in canonical form, its lines still apart."""
    plain = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    return _spelled(F.regexp_replace(plain, SIGNS, " "))


def canonical_text(lines: Column) -> Column:
    """The canonical form of an entire text, from that of its lines.

    Spellings that span lines are brought to one form too.
    """
    return F.trim(_spelled(F.regexp_replace(lines, r"[ \n]+", " ")))


def known_licenses(spark: SparkSession, texts=KNOWN_TEXTS) -> DataFrame:
    """``(digest, license, length)`` of the known texts: no more rows than texts."""
    given = spark.createDataFrame(list(texts), "license STRING, text STRING")
    form = canonical_text(canonical_lines(F.col("text")))
    return (
        given.select("license", form.alias("form"))
        .groupBy(F.sha2("form", 256).alias("digest"))
        .agg(F.min("license").alias("license"), F.min(F.length("form")).alias("length"))
    )


def scan(spark: SparkSession, docs: DataFrame, texts=KNOWN_TEXTS) -> DataFrame:
    """``(doc_id, n_rows, digest, license, n_notices, notices)`` of each text.

    ``license`` is that of the entire text, ``notices`` the different licences of
    entire lines, in order, and ``n_notices`` the number of such lines. A null
    text counts as empty, which is no licence. Rows alike in doc_id and canonical
    text are one row, with their number in ``n_rows`` and the notices of their
    different lines. Other columns are not read.
    """
    known = known_licenses(spark, texts)
    # Bounded by the number of known texts; a line of another length is no match.
    lengths = sorted(r["length"] for r in known.select("length").distinct().collect())
    lines = F.transform(F.split("form", "\n"), lambda x: F.trim(x))
    forms = docs.select(
        "doc_id", canonical_lines(F.coalesce("text", F.lit(""))).alias("form")
    ).select(
        "doc_id",
        F.sha2(canonical_text(F.col("form")), 256).alias("digest"),
        F.transform(
            F.filter(lines, lambda x: F.length(x).isin(lengths)), lambda x: F.sha2(x, 256)
        ).alias("lines"),
    )
    rows = forms.groupBy("doc_id", "digest").agg(
        F.count(F.lit(1)).alias("n_rows"), F.collect_set("lines").alias("lines")
    )
    line = known.select(F.col("digest").alias("line"), F.col("license").alias("notice"))
    return (
        rows.select("doc_id", "digest", "n_rows", F.explode_outer(F.flatten("lines")).alias("line"))
        .join(F.broadcast(line), "line", "left")
        .groupBy("doc_id", "digest")
        .agg(
            F.max("n_rows").alias("n_rows"),
            F.count("notice").alias("n_notices"),
            F.array_join(F.array_sort(F.collect_set("notice")), ",").alias("notices"),
        )
        .join(F.broadcast(known.select("digest", "license")), "digest", "left")
        .select("doc_id", "n_rows", "digest", "license", "n_notices", "notices")
    )
