"""License scans by canonical digest lookup, in DataFrame functions only.

Whole texts are compared: both the known texts and the scanned ones are brought to
one form (lower case, no copyright lines, no list markers, one spelling of words the
matching guidelines call equivalent, words only) and joined on its SHA-256. Scanned are
every document as a whole, every line of it as a text of its own, since notices
stand on lines of other documents, and passages: a known text of at least
``PASSAGE_WORDS`` words is found anywhere in a document, however its lines are
wrapped or commented. Where a passage may stand follows from the first and last words
of the known text and its length; the digest of what stands there decides.

Known texts are a parameter: short ones as texts, long ones as measures of their
form (``measures`` gives them for any text). Their number bounds the join's small side.

Nulls: a null or empty text, or one without words, matches nothing; a null doc_id
is an id like any other. Repeated rows give repeated results. A digest known under
several names has the first in order. An empty table gives no rows. Texts of any length
are scanned whole; a row holds its text, its lines and the passages found. Extra columns
are ignored. A spelling in two words that a line break parts counts to the first line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words that license matching guidelines treat as the same.
SPELLINGS = (("licence", "license"), ("sub license", "sublicense"), ("sublicence", "sublicense"), ("non commercial", "noncommercial"),
             ("organisation", "organization"), ("organisational", "organizational"), ("favour", "favor"), ("honour", "honor"),
             ("fulfil", "fulfill"), ("whilst", "while"), ("merchantibility", "merchantability"), ("per cent", "percent"), ("acknowledgement", "acknowledgment"),
             ("judgement", "judgment"), ("cancelled", "canceled"), ("programme", "program"))

# The conditions and the disclaimer that two licenses share.
BSD_TERMS = (
    'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are '
    'met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. '
    'Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the '
    'documentation and/or other materials provided with the distribution. ')
BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
    'TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR '
    'CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, '
    'PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF '
    'LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS '
    'SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.')

# Licenses by SPDX identifier, with texts that state them.
KNOWN = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files '
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        'publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, '
        'subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or '
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        'BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE '
        'AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, '
        'ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    "ISC": (
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that '
        'the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS '
        'ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE '
        'AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA '
        'OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR '
        'PERFORMANCE OF THIS SOFTWARE.',),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "This project is licensed under the Apache License 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You '
        'may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in '
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        'either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    "GPL-3.0-only": ("This work is licensed under the GNU General Public License, version 3.",),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.", "Released under the BSD 2-Clause License.",
        BSD_TERMS + BSD_DISCLAIMER),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License.",
        BSD_TERMS + 'Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived '
        'from this software without specific prior written permission. ' + BSD_DISCLAIMER),
    "0BSD": (
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS '
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY '
        'AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER '
        'RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN '
        'CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be "
        "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. This notice may not be removed or altered from any source distribution.",),
    "Unlicense": (
        'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or '
        'distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any '
        'means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in '
        'the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and '
        'successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software '
        'under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        'WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, '
        'DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR '
        'THE USE OR OTHER DEALINGS IN THE SOFTWARE.',),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}

# Titles that may precede a text of the license.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License", "The ISC License"), "0BSD": ("BSD Zero Clause License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License"), "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License"),
    "Zlib": ("zlib License", "The zlib License"), "Unlicense": ("The Unlicense",),
}

# The forms of long licenses as ``measures`` gives them: first words, last words, length, digest.
LONG: dict[str, tuple[tuple[str, str, int, str], ...]] = {
    "Apache-2.0": (
        ("apache license version 2 0 january 2004 http www apache org licenses",
         "license for the specific language governing permissions and limitations under the license", 9856,
         "f86c45fc72b043272de5d765793567a95363a0016be29aaee3c6a6d8b0ca5532"),
        ("apache license version 2 0 january 2004 http www apache org licenses",
         "contributor by reason of your accepting any such warranty or additional liability", 8812,
         "9666d051921bc497595d01b3c5b73b1f06842a6aa072b0221619c1e6d78d99e7"),
        ("apache license version 2 0 january 2004 http www apache org licenses",
         "accepting any such warranty or additional liability end of terms and conditions", 8840,
         "95ebafaabf80c10ce0c02d6506b3c942348da0561e2d2af910f930ef055bc343"),
    ),
    "CC0-1.0": (
        ("creative commons legal code cc0 1 0 universal creative commons corporation is",
         "or obligation with respect to this cc0 or use of the work", 6672,
         "51c4bf27767d074bdefc84db7420b4c55e27827dac6d8de3ef0d37b2042fb6fa"),
    ),
    "GPL-2.0-only": (
        ("gnu general public license version 2 june 1991 51 franklin street fifth",
         "do use the gnu lesser general public license instead of this license", 17074,
         "2e8e378a3d24393c0f3fd1439ffbe84e750886c09715e622426a6a0e54fa1bee"),
        ("gnu general public license version 2 june 1991 51 franklin street fifth",
         "or other party has been advised of the possibility of such damages", 14412,
         "724499132592c4e4c95c8d0a0a79e0045822f797839536a7338312694e3341bc"),
        ("gnu general public license version 2 june 1991 51 franklin street fifth",
         "advised of the possibility of such damages end of terms and conditions", 14440,
         "80edaf5771a2ca5e7df6a5c023beb15391e60cf1bbae81a82600bb184fecef39"),
    ),
    "GPL-3.0-only": (
        ("gnu general public license version 3 29 june 2007 everyone is permitted",
         "first please read https www gnu org licenses why not lgpl html", 33331,
         "1d853c80efe5ceb4de7b2f36ad97f5659946947afc9c6c75fa3fa50e20368ef2"),
        ("gnu general public license version 3 29 june 2007 everyone is permitted",
         "liability accompanies a copy of the program in return for a fee", 30862,
         "a7d16b580457c566303df373fd362c5bfbfbc013734bed4e4cf732a569a5598e"),
        ("gnu general public license version 3 29 june 2007 everyone is permitted",
         "the program in return for a fee end of terms and conditions", 30890,
         "8c24ccf35998bd73317aa0801f6e6cbd865514baf55f246a48a8e890d1abc3d1"),
    ),
    "LGPL-2.1-only": (
        ("gnu lesser general public license version 2 1 february 1999 51 franklin",
         "ty coon president of vice that s all there is to it", 25154,
         "f2755dc4b609b314faab32d30ca6d0466b60adc931cece2ea4f0b61f483bfc98"),
        ("gnu lesser general public license version 2 1 february 1999 51 franklin",
         "or other party has been advised of the possibility of such damages", 23274,
         "70a277553f5f0e974016dfc6aed9adda07c554792c5f1f3d75acb63053de3f89"),
        ("gnu lesser general public license version 2 1 february 1999 51 franklin",
         "advised of the possibility of such damages end of terms and conditions", 23302,
         "303c35384a2d8ff561e8480f4d8bc87bd79ea2d92d62ba0b24d22e2c1f88f1e3"),
    ),
    "LGPL-3.0-only": (
        ("gnu lesser general public license version 3 29 june 2007 everyone is",
         "is permanent authorization for you to choose that version for the library", 7064,
         "cb8c0f424bdd5c42a0b18285893829d988e9fb9a00d0cd604a59ebe8da7eeb45"),
    ),
    "MPL-2.0": (
        ("mozilla public license version 2 0 definitions 1 1 contributor means each",
         "secondary licenses as defined by the mozilla public license v 2 0", 14298,
         "8dce888cb942d93cebeb8e0fea8afac43e084f54254ac4d9b99cfde68a62468b"),
    ),
}

PASSAGE_WORDS = 25  # known texts of so many words or more are found inside documents
EDGE_WORDS = 12  # first and last words of a known text that tell where it may stand

# A line that names the holder, or the marker of a list item. Prose that wraps before "copyright holders" is neither.
DROPPED = (r"(^|\n)[ \t/*#;-]*(copyright[ \t]*(\(c\)|©|:|[\[<{]|by )[^\n]*|copyright[^\n]*[0-9]{4}[^\n]*|\(c\)[^\n]*[0-9]{4}[^\n]*|©[^\n]*"
           r"|all rights reserved\.?[ \t]*|\(?([0-9]{1,2}|[a-z])[.)][ \t]+)")
UNITS = "array<struct<scope:string,line_no:int,digest:string>>"
NO_WORD = r"[^\p{L}\p{N}\n]+"


def _replacements() -> list[tuple[str, str]]:
    """What is replaced where every word stands between two spaces of its own."""
    found = []
    for old, new in SPELLINGS:
        first, _, second = old.partition(" ")
        found += [(f" {first}  {second} ", f" {new} "), (f" {first} \n {second} ", f" {new} \n ")] if second else [(f" {old} ", f" {new} ")]
    return found


def canonical_lines(text: Column) -> Column:
    """The form that is compared, line by line: words in lower case, each with a space before and after it."""
    plain = F.regexp_replace(F.lower(text), DROPPED, "$1")
    wide = F.replace(F.regexp_replace(plain, NO_WORD, F.lit("  ")), F.lit("\n"), F.lit(" \n "))
    return reduce(lambda t, s: F.replace(t, F.lit(s[0]), F.lit(s[1])), _replacements(), F.concat(F.lit(" "), wide, F.lit(" ")))


def words_of(canonical: Column) -> Column:
    """A canonical text whose lines count as one, with single spaces between its words."""
    return F.trim(F.regexp_replace(canonical, r"[ \n]+", " "))


def digest(words: Column) -> Column:
    """Null where there is no word."""
    return F.when(words != "", F.sha2(words.cast("binary"), 256))


def known_texts(spark: SparkSession, known: dict[str, tuple[str, ...]], titles: dict[str, tuple[str, ...]]) -> DataFrame:
    """``license, words, body``: the form of each known text, alone and under each title; ``body`` if it stands alone."""
    rows = [(name, t, True) for name, texts in known.items() for t in texts]
    rows += [(name, f"{title}\n{t}", False) for name, texts in known.items() for t in texts for title in titles.get(name, ())]
    texts = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(t).alias("text"), F.lit(body).alias("body")) for name, t, body in rows])
    return spark.range(1).select(F.inline(texts)).select("license", words_of(canonical_lines(F.col("text"))).alias("words"), "body")


def measures(texts: DataFrame) -> DataFrame:
    """``license, first, last, length, digest`` of the ``words`` of texts that may stand inside documents."""
    words = F.split("words", " ")
    return texts.filter(F.size(words) >= PASSAGE_WORDS).select(
        "license", F.array_join(F.slice(words, 1, EDGE_WORDS), " ").alias("first"), F.array_join(F.slice(words, -EDGE_WORDS, EDGE_WORDS), " ").alias("last"),
        F.length("words").alias("length"), digest(F.col("words")).alias("digest"))


def passages(words: Column, first: str, last: str, length: int) -> Column:
    """Digests of the stretches of so many characters that begin and end with the given words."""
    between = length - len(first) - len(last)
    pattern = rf"(?= ({first}.{{{between}}}{last}) )"
    found = F.regexp_extract_all(F.concat(F.lit(" "), words, F.lit(" ")), F.lit(pattern), F.lit(1))
    return F.when(F.contains(words, F.lit(first)), F.transform(found, digest)).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, known: dict[str, tuple[str, ...]] = KNOWN, titles: dict[str, tuple[str, ...]] = TITLES,
         long: dict[str, tuple[tuple[str, str, int, str], ...]] = LONG) -> DataFrame:
    """``doc_id, scope, line_no, license``: documents (scope text), lines (from 0; else -1) and passages that are a known text.

    A passage has a row for each place where it stands, also where it is the whole document.
    """
    spark = docs.sparkSession
    texts = known_texts(spark, known, titles)
    # The known texts are a parameter; their measures become expressions of the scan.
    inside = {(m["first"], m["last"], m["length"]): m for m in measures(texts.filter("body")).collect()}
    stretches = {*inside, *(m[:3] for ms in long.values() for m in ms)}
    given = [F.struct(F.lit(name).alias("license"), F.lit(m[3]).alias("digest")) for name, ms in long.items() for m in ms]
    every = texts.select("license", digest(F.col("words")).alias("digest"))
    if given:
        every = every.unionByName(spark.range(1).select(F.inline(F.array(*given))))
    digests = every.groupBy("digest").agg(F.min("license").alias("license"))

    unit = lambda scope, line, value: F.struct(F.lit(scope).alias("scope"), line.alias("line_no"), value.alias("digest"))
    forms = docs.select(F.col("doc_id").cast("long").alias("doc_id"), canonical_lines(F.col("text")).alias("form"))
    forms = forms.select("doc_id", "form", words_of(F.col("form")).alias("words"))
    lines = F.transform(F.split("form", "\n", -1), lambda l, i: unit("line", i, digest(words_of(l))))
    found = F.flatten(F.array(F.array().cast("array<string>"), *[passages(F.col("words"), *s) for s in sorted(stretches)]))
    units = F.concat(F.array(unit("text", F.lit(-1), digest(F.col("words")))), F.when(F.contains("form", F.lit("\n")), lines).otherwise(F.array().cast(UNITS)),
                     F.transform(found, lambda d: unit("passage", F.lit(-1), d)))
    return forms.select("doc_id", F.inline(units)).filter("digest IS NOT NULL").join(digests, "digest").select("doc_id", "scope", "line_no", "license")


def _sql_form(text: str) -> str:
    wide = f"replace(regexp_replace(regexp_replace(lower({text}), '{DROPPED}', '\\1', 'g'), '{NO_WORD}', '  ', 'g'), chr(10), ' ' || chr(10) || ' ')"
    return reduce(lambda t, s: f"replace({t}, '{s[0]}', '{s[1]}')", _replacements(), f"(' ' || {wide} || ' ')")


def _sql_words(form: str) -> str:
    return f"trim(regexp_replace({form}, '[ \\n]+', ' ', 'g'))"


def _sql_values(rows: list[tuple]) -> str:
    return ", ".join("({})".format(", ".join(str(v) if isinstance(v, int) else "'{}'".format(v.replace("'", "''")) for v in r)) for r in rows)


_TEXTS = [(name, t, 1) for name, texts in KNOWN.items() for t in texts] + [
    (name, f"{title}\n{t}", 0) for name, texts in KNOWN.items() for t in texts for title in TITLES.get(name, ())]
_LONG = [(name, first, length, value) for name, ms in LONG.items() for first, _, length, value in ms]
# Passages are found here by cutting the text at the first words of each known text.
SCAN_SQL = f"""
WITH texts AS (SELECT license, {_sql_words(_sql_form('text'))} AS words, body FROM (VALUES {_sql_values(_TEXTS)}) AS k(license, text, body)),
given AS (SELECT * FROM (VALUES {_sql_values(_LONG)}) AS g(license, opening, length, digest)),
known AS (SELECT digest, min(license) AS license FROM (SELECT license, sha256(words) AS digest FROM texts UNION ALL SELECT license, digest FROM given) GROUP BY 1),
inside AS (SELECT DISTINCT array_to_string(string_split(words, ' ')[1:{EDGE_WORDS}], ' ') AS opening, length(words) AS length, sha256(words) AS digest
           FROM texts WHERE body = 1 AND len(string_split(words, ' ')) >= {PASSAGE_WORDS} UNION SELECT opening, length, digest FROM given),
forms AS (SELECT row_number() OVER () AS r, doc_id, {_sql_form('text')} AS form FROM documents),
flat AS (SELECT r, doc_id, {_sql_words('form')} AS words FROM forms),
lines AS (SELECT doc_id, unnest(string_split(form, chr(10))) AS line, generate_subscripts(string_split(form, chr(10)), 1) - 1 AS line_no,
          len(string_split(form, chr(10))) AS n FROM forms),
cut AS (SELECT r, doc_id, words, opening, unnest(string_split(' ' || words, ' ' || opening)) AS piece,
        generate_subscripts(string_split(' ' || words, ' ' || opening), 1) AS i
        FROM flat JOIN (SELECT DISTINCT opening FROM inside) ON contains(words, opening)),
starts AS (SELECT doc_id, words, opening, i, sum(length(piece)) OVER (PARTITION BY r, opening ORDER BY i) + (i - 1) * (length(opening) + 1) + 1 AS start,
           max(i) OVER (PARTITION BY r, opening) AS last_i FROM cut),
units AS (SELECT doc_id, 'text' AS scope, -1 AS line_no, sha256(words) AS digest FROM flat WHERE words <> ''
          UNION ALL SELECT doc_id, 'line', CAST(line_no AS INTEGER), sha256(nullif({_sql_words('line')}, '')) FROM lines WHERE n > 1
          UNION ALL SELECT doc_id, 'passage', -1, inside.digest FROM starts JOIN inside USING (opening)
          WHERE i < last_i AND sha256(substring(words, CAST(start AS BIGINT), length)) = inside.digest
          AND substring(words || ' ', CAST(start AS BIGINT) + length, 1) = ' ')
SELECT doc_id, scope, line_no, license FROM units JOIN known USING (digest)"""
