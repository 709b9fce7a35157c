"""License scans by canonical digest.

A whole text is normalised (copyright lines out, letters A-Z small, punctuation and white space to single spaces,
equivalent spellings to one) and its SHA-256 is looked up among the digests of known licence texts. All of it is SQL
expressions; the catalogue has one row a licence and is broadcast only when it is counted to be small.

Null text is the empty text; its digest is that of no words and matches no licence. Repeated rows are looked up each.
A digest that several licences share yields the least licence id. ``canonical_sha256``, ``n_canonical_words`` and
``license_id`` win over input columns of those names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that starts, after comment signs, with a copyright notice.
COPYRIGHT_LINE = r"(^|\n)[ \t#*/;.-]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
#: ASCII and typographic punctuation, white space and control characters.
PUNCTUATION = r"[\x00-\x2f\x3a-\x60\x7b-\x7f“”‘’–—•·«»\x{a0}]+"

# Spellings that licence matching guidelines hold to be equal.
EQUIVALENT_WORDS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "wilfull",
}
EQUIVALENT_PHRASES = (("copyright owner", "copyright holder"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("per cent", "percent"), ("http", "https"))

# Public licence texts and customary notices.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_DISCLAIMER = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
    "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
    "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution.\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission.\n"
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this "
    "software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
    "to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this "
    "software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n\n2. Altered source versions must be plainly marked as "
    "such, and must not be misrepresented as being the original software.\n\n3. This notice may not be removed or altered from any source distribution."
)
_BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "
    "\"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to "
    "whom the Software is furnished to do so, all subject to the following:\n\nThe copyright notices in the Software and this entire statement, including the above license "
    "grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless "
    "such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", "
    "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND "
    "NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either "
    "in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author "
    "or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and "
    "to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
    "under copyright law.\n\n" + _AS_IS.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS") + "\n\nFor more information, please refer to <https://unlicense.org/>"
)
_APACHE_NOTICE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License "
    "at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
    "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations "
    "under the License."
)
_GPL_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation, "
    "either version 3 of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
    "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details.\n\nYou should have received a copy "
    "of the GNU {0}General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
)
_MPL_NOTICE = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
    "https://mozilla.org/MPL/2.0/."
)
KNOWN_TEXTS = (
    ("MIT", f"{_MIT_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{_AS_IS}"),
    ("MIT", f"MIT License\n\nCopyright (c) <year> <copyright holders>\n\n{_MIT_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{_AS_IS}"),
    ("MIT-0", f"{_MIT_GRANT}.\n\n{_AS_IS}"),
    ("ISC", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_DISCLAIMER}"),
    ("0BSD", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n{_ISC_DISCLAIMER}"),
    ("BSD-2-Clause", _BSD_CONDITIONS + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_CONDITIONS + _BSD_THIRD + _BSD_DISCLAIMER),
    ("Zlib", _ZLIB),
    ("BSL-1.0", f"Boost Software License - Version 1.0 - August 17th, 2003\n\n{_BOOST}"),
    ("BSL-1.0", _BOOST),
    ("Unlicense", _UNLICENSE),
    ("Apache-2.0", _APACHE_NOTICE),
    ("GPL-3.0-or-later", _GPL_NOTICE.format("")),
    ("AGPL-3.0-or-later", _GPL_NOTICE.format("Affero ")),
    ("LGPL-3.0-or-later", _GPL_NOTICE.format("Lesser ")),
    ("MPL-2.0", _MPL_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)


def canonical(text: Column) -> Column:
    """The normal form: words with single spaces."""
    small = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    body = F.regexp_replace(small, COPYRIGHT_LINE, "$1")
    found = F.filter(F.split(F.regexp_replace(body, PUNCTUATION, " "), " "), lambda w: w != "")
    same = F.create_map(*[F.lit(x) for pair in EQUIVALENT_WORDS.items() for x in pair])
    # every word stands between spaces of its own, so that phrases match whole words only
    joined = F.concat(F.lit(" "), F.array_join(F.transform(found, lambda w: F.coalesce(F.try_element_at(same, w), w)), "  "), F.lit(" "))
    for old, new in EQUIVALENT_PHRASES:
        joined = F.replace(joined, F.lit(_spaced(old)), F.lit(_spaced(new)))
    return F.trim(F.replace(joined, F.lit("  "), F.lit(" ")))


def _spaced(phrase: str) -> str:
    return " " + phrase.replace(" ", "  ") + " "


def other_spelling(text: str) -> str:
    """The same licence as others write it: a copyright line, capitals, other spellings, other punctuation and line ends."""
    swapped = {new: old for old, new in EQUIVALENT_WORDS.items() if new != "while"}
    words = [" ".join(swapped.get(w.lower(), w) for w in line.split(" ")) for line in text.replace("copyright holder ", "copyright owner ").replace("\"", "``").split("\n")]
    return "Copyright (c) 1999 Somebody\n * " + " -\r\n * ".join(words).upper()


def catalogue(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN_TEXTS) -> DataFrame:
    """(license_id, text) of the licences that ship with this module."""
    return spark.createDataFrame(list(known), "license_id string, text string")


def scan(docs: DataFrame, known: DataFrame, text: str = "text", broadcast_rows: int = 100_000) -> DataFrame:
    """docs with the digest of the whole text and the licence it is, if any. known: (license_id, text)."""
    made = ("canonical_sha256", "n_canonical_words", "license_id")
    row, body = "__row__", "__canonical__"
    digests = known.where(F.col("text").isNotNull()).select(F.sha2(canonical(F.col("text")), 256).alias("canonical_sha256"), "license_id").where(F.col("canonical_sha256") != F.sha2(F.lit(""), 256))
    digests = digests.groupBy("canonical_sha256").agg(F.min("license_id").alias("license_id"))
    n = known.count()
    rows = docs.select(F.struct(*[docs[x] for x in docs.columns]).alias(row), canonical(docs[text]).alias(body))
    rows = rows.select(row, F.sha2(body, 256).alias("canonical_sha256"), F.when(F.col(body) == "", 0).otherwise(F.size(F.split(body, " "))).cast("bigint").alias("n_canonical_words"))
    found = rows.join(F.broadcast(digests) if n <= broadcast_rows else digests, "canonical_sha256", "left")
    return found.select(*[F.col(row)[x].alias(x) for x in docs.columns if x not in made], *made)


def canonical_sql(text: str) -> str:
    """The same normal form in DuckDB's SQL."""
    q = lambda x: "'" + x.replace("'", "''") + "'"
    small = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    body = f"regexp_replace({small}, {q(COPYRIGHT_LINE)}, '\\1', 'g')"
    found = f"list_filter(string_split(regexp_replace({body}, {q(PUNCTUATION)}, ' ', 'g'), ' '), lambda w: w <> '')"
    same = f"map([{', '.join(map(q, EQUIVALENT_WORDS))}], [{', '.join(map(q, EQUIVALENT_WORDS.values()))}])"
    joined = f"' ' || array_to_string(list_transform({found}, lambda w: coalesce({same}[w], w)), '  ') || ' '"
    for old, new in EQUIVALENT_PHRASES:
        joined = f"replace({joined}, {q(_spaced(old))}, {q(_spaced(new))})"
    return f"trim(replace({joined}, '  ', ' '))"
