"""Licences by canonical digest: entire texts, and entire lines, joined to known digests.

A text is brought to a canonical form - ASCII letters lower-cased, copyright lines dropped,
ASCII and typographic punctuation and white space to single spaces, equivalent spellings to
one - and its SHA-256 is looked up among the digests of known licence texts and notices, which
pass through the same expression, and of long texts, of which only the digests are held
(``license_digests``).  The known table is fixed and small; it is the build side of a hash join.

Defined results: null and empty texts, and lines without letters, match nothing; repeated rows
give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text
from .license_digests import DIGESTS

PUNCTUATION = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words that follow "copyright" inside licence texts, wherever a line is broken; other words are a holder's name.
_NO_NAME = ("and|are|as|assignment|disclaimer|doctrines?|dedication|exceptions?|have|has|holders?|holding|if|in|interests?|is|laws?|legislation|like|"
            "licen[cs]e[ds]?|licensor|licensable|notices?|of|on|or|owners?|ownership|permission|permits|protection|resulting|rights?|resides|statements?|"
            "status|terms?|that|the|treaty|under|which|with|works?|your")
#: A line with a copyright sign or the word before a year, a sign or a name; with "all rights reserved" below it, if more follows.
HOLDER_LINE = (r"(?m)^[^a-z0-9\n(©]*(?:copyright\b(?=[^a-z0-9\n]*(?:\(c\)|©|[0-9]{4}|<|\[|\{|(?!(?:" + _NO_NAME + r")\b)[a-z]))"
               r"|\(c\)(?=[^a-z0-9\n]*(?:[0-9]{4}|copyright\b))|©)[^\n]*$"
               r"(?:\n[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*$(?=\n[^a-z0-9]*[a-z0-9]))?")
#: ``PUNCTUATION`` and typographic quotes, dashes, bullets and spaces.
ANY_PUNCTUATION = PUNCTUATION[:-2] + r"\u0080-\u00A0\u00AB\u00B7\u00BB\u1680\u2000-\u206F\u3000]+"
#: Characters without width, which go.
_NO_WIDTH = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (pattern, replacement), applied in order to the words of a text.  Fixed values.
SPELLINGS = [
    (r"\blicence", "license"),
    (r"\bcopyright owner", "copyright holder"),
    (r"\bsub license", "sublicense"),
    (r"\bnon commercial", "noncommercial"),
    (r"\b(v|ver) ?([0-9])", "version $2"),
    (r"\bgnu gpl\b", "gnu general public license"),
    (r"\bwhilst\b", "while"),
    (r"\bfavour", "favor"),
]

_DISCLAIMER = (
    " are disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special,"
    " exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data,"
    " or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort"
    " (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage.")
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions"
    " are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in"
    " the documentation and/or other materials provided with the distribution.")
_BSD_TAIL = (
    " This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not"
    " limited to, the implied warranties of merchantability and fitness for a particular purpose" + _DISCLAIMER)
_MIT_BODY = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    " (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,"
    " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
    " subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or"
    " substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT"
    " NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
    " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING"
    " FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_BODY = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{}."
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES"
    " OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY"
    " DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,"
    " ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")

#: (licence, text or notice).  Fixed values.
KNOWN = [
    ("MIT", _MIT_BODY), ("MIT", "MIT License " + _MIT_BODY), ("MIT", "The MIT License (MIT) " + _MIT_BODY),
    ("ISC", _ISC_BODY.format(", provided that the above copyright notice and this permission notice appear in all copies")),
    ("ISC", "ISC License " + _ISC_BODY.format(", provided that the above copyright notice and this permission notice appear in all copies")),
    ("0BSD", _ISC_BODY.format("")), ("0BSD", "BSD Zero Clause License " + _ISC_BODY.format("")),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License " + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
     " products derived from this software without specific prior written permission." + _BSD_TAIL),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU GPL v3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"), ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Released under CC0 1.0."),
    ("all-rights-reserved", "All rights reserved."),
]


_BSD_3 = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote" \
         " products derived from this software without specific prior written permission."
_ISC = _ISC_BODY.format(", provided that the above copyright notice and this permission notice appear in all copies")
#: Further titles and unnumbered clauses of the texts in ``KNOWN``.
FORMS = [
    ("MIT", "The MIT License " + _MIT_BODY), ("ISC", "The ISC License " + _ISC), ("ISC", "ISC License (ISC) " + _ISC),
    ("0BSD", "Zero-Clause BSD " + _ISC_BODY.format("")),
    *[("BSD-2-Clause", title + form) for title in ("", "BSD 2-Clause License ", "The 2-Clause BSD License ", "Simplified BSD License ")
      for form in (_BSD_HEAD + _BSD_TAIL, (_BSD_HEAD + _BSD_TAIL).replace("1. ", "").replace("2. ", ""))],
    *[("BSD-3-Clause", title + form) for title in ("", "BSD 3-Clause License ", "The 3-Clause BSD License ", "New BSD License ")
      for form in (_BSD_HEAD + _BSD_3 + _BSD_TAIL, (_BSD_HEAD + _BSD_3 + _BSD_TAIL).replace("1. ", "").replace("2. ", "").replace("3. ", ""))],
]


def canonical(text: Column) -> Column:
    c = F.regexp_replace(F.translate(text, _UPPER + _NO_WIDTH, _UPPER.lower()), HOLDER_LINE, "")
    c = F.regexp_replace(c, ANY_PUNCTUATION, " ")
    for pattern, replacement in SPELLINGS:
        c = F.regexp_replace(c, pattern, replacement)
    return F.trim(c)


#: Every known text has one of these in a word of its canonical form, so it stands in any text that matches.
MARKERS = ("licen", "permission", "redistribution", "rights", "cc0")


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form; null for texts without a marker, which match nothing known."""
    low = F.lower(text)
    marked = F.contains(low, F.lit(MARKERS[0]))
    for m in MARKERS[1:]:
        marked = marked | F.contains(low, F.lit(m))
    return F.when(marked, F.sha2(canonical(text), 256))


def known_digests(spark) -> DataFrame:
    texts = spark.createDataFrame(KNOWN + FORMS, "license string, text string").select(digest(F.col("text")).alias("k_digest"), F.col("license").alias("k_license"))
    return texts.unionByName(spark.createDataFrame(DIGESTS, "k_license string, k_digest string")).distinct()


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, license, whole_text (the entire text is it), n_lines (entire lines that are) per match."""
    units = _units(docs)
    known = known_digests(docs.sparkSession)
    return (
        units.join(F.broadcast(known), F.col("digest") == F.col("k_digest"))
        .groupBy("row_id", "doc_id", F.col("k_license").alias("license"))
        .agg(F.max("whole").alias("whole_text"), F.sum(F.when(F.col("whole"), 0).otherwise(1)).alias("n_lines"))
        .select("doc_id", "license", "whole_text", F.col("n_lines").cast("long").alias("n_lines"))
    )


def _units(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, digest, whole) of every whole text and every line that has a marker.

    The digests are taken inside the array, before it is spread: a filter that the join adds
    then tests them and doesn't take them again.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", whole_text().alias("text"))
    units = F.concat(F.array(F.struct(F.col("text").alias("t"), F.lit(True).alias("whole"))),
                     F.transform(F.split("text", "\n", -1), lambda x: F.struct(x.alias("t"), F.lit(False).alias("whole"))))
    digests = F.filter(F.transform(units, lambda u: F.struct(digest(u["t"]).alias("digest"), u["whole"].alias("whole"))),
                       lambda u: u["digest"].isNotNull())
    return rows.select("row_id", "doc_id", F.explode(digests).alias("u")).select("row_id", "doc_id", "u.digest", "u.whole")
