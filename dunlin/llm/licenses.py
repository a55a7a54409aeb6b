"""Licence scan by canonical digest, with built-in functions only.

A text is brought to a canonical form (copyright lines dropped, lower case,
everything but letters and digits a separator, equivalent spellings made one)
and its digest is looked up among those of known licence texts and notices.
Entire texts are compared, and every line as an entire notice; nothing is
matched in part.  The known table is the caller's own, or the constant of this
module and the full texts in the folder ``license_texts``, each as it is, with
and without its usual title lines, and without what follows its terms.  It is
broadcast only if its counted size is small.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dunlin.llm.common import text_of

#: Spellings held equivalent, second form kept.
SPELLINGS = [
    ("acknowledgment", "acknowledgement"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisations", "capitalizations"), ("catalogue", "catalog"),
    ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgment", "judgement"), ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"),
    ("licences", "licenses"), ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"),
    ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("sub license", "sublicense"), ("sub licence", "sublicense"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("noncommercial", "non commercial"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("https", "http"),
]

#: Lines that only name the holder of a copyright.
COPYRIGHT_LINE = r"(?im)^[^\p{L}\p{N}\n]*(?:copyright[ \t]*(?:\([cC]\)|©|:|,|[0-9]{4}|<|\[)|\([cC]\)[ \t]*(?:copyright|[0-9]{4})|©|all rights reserved)[^\n]*$"

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_ISC_TAIL = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

#: Licence texts and one-line notices by identifier.
KNOWN = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
""" + _BSD_TAIL),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
""" + _ISC_TAIL),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
""" + _ISC_TAIL),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.
"""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]

#: Full texts, one file per licence; its name is the identifier.
TEXTS = Path(__file__).resolve().parent / "license_texts"

#: Lines that usually stand above a text that has no title of its own.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License", "MIT"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "Modified BSD License", "BSD License", "BSD-3-Clause"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "ISC"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "0BSD", "0BSD License"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "Zlib"],
    "Unlicense": ["The Unlicense", "Unlicense", "Unlicense License"],
}

#: How many lines with words at the head of a file are its title, and what closes its terms.
TITLE_LINES = {"Apache-2.0": 3, "CC-BY-SA-4.0": 1, "CC0-1.0": 2, "GPL-2.0-only": 2, "GPL-3.0-only": 2, "LGPL-2.1-only": 2, "LGPL-3.0-only": 2, "MPL-2.0": 1}
TERMS_END = "END OF TERMS AND CONDITIONS"

#: Known digests that may be shipped whole to every executor (about 10 MB).
SHIPPED_DIGESTS = 100_000


def canonical(text: Column) -> Column:
    """Words in one spelling, one space between; equal for texts that differ only in what does not matter."""
    bare = F.regexp_replace(text, COPYRIGHT_LINE, "")
    # Two spaces between words, so that neighbours never share one.
    out = F.concat(F.lit(" "), F.regexp_replace(F.lower(bare), r"[^\p{L}\p{N}]+", "  "), F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(f" {old.replace(' ', '  ')} "), F.lit(f" {new.replace(' ', '  ')} "))
    return F.replace(F.trim(out), F.lit("  "), F.lit(" "))


def known_texts() -> list[tuple[str, str]]:
    """:data:`KNOWN` and the files of :data:`TEXTS` in all forms that count as the entire licence."""
    forms = list(KNOWN)
    whole = [(name, text) for name, text in KNOWN if "\n" in text]
    for path in sorted(TEXTS.glob("*.txt")):
        name, text = path.stem, path.read_text(encoding="utf-8")
        ends = [text]
        if TERMS_END in text:
            terms = text[:text.index(TERMS_END)]
            ends += [terms, terms + TERMS_END]
        for end in ends:
            lines = end.lstrip().split("\n")
            worded = [i for i, line in enumerate(lines) if any(map(str.isalnum, line))]
            whole += [(name, end), (name, "\n".join(lines[worded[TITLE_LINES.get(name, 0)]:]))]
    return forms + [(name, form) for name, text in whole for form in (text, *(f"{title}\n\n{text}" for title in TITLES.get(name, [])))]


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``license_id, digest`` of the given texts, or of :func:`known_texts`; one row per digest."""
    frame = spark.createDataFrame(known_texts() if known is None else known, "license_id string, text string")
    return frame.groupBy(F.sha2(canonical(F.col("text")), 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan_licenses(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_digest, license_id, notices, n_notices`` per document.

    ``license_id`` is that of the entire text, or null; ``notices`` are the
    distinct ids, sorted and comma-joined, of the lines that are entire known
    texts, ``n_notices`` their number with repeats.  Null texts are empty; a text
    without letters and digits has the digest of the empty one and matches
    nothing.  Rows that share an id are reported together: the smallest digest
    and licence, and the notices of all.  Other columns of ``docs`` are ignored.
    """
    source = text_of(docs, doc_id, text).withColumn("text", F.coalesce("text", F.lit("")))
    units = source.select("doc_id", F.posexplode(F.concat(F.array("text"), F.split("text", "\n"))).alias("place", "unit"))
    # No filter on the canonical form: it would be worked out twice.  Empty units match nothing below.
    digested = units.select("doc_id", "place", F.sha2(canonical(F.col("unit")), 256).alias("digest"))
    table = known.select(F.col("digest"), F.col("license_id").alias("found")).where(F.col("digest") != F.sha2(F.lit(""), 256))
    if table.count() <= SHIPPED_DIGESTS:
        table = F.broadcast(table)
    met = digested.join(table, "digest", "left").where("place = 0 OR found IS NOT NULL")
    notice = F.when(F.col("place") > 0, F.col("found"))
    whole = F.col("place") == 0
    return met.groupBy("doc_id").agg(
        F.min(F.when(whole, F.col("digest"))).alias("text_digest"), F.min(F.when(whole, F.col("found"))).alias("license_id"),
        F.array_join(F.array_sort(F.collect_set(notice)), ",").alias("notices"), F.count(notice).alias("n_notices"))
