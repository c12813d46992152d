"""Licence scan by canonical digests.

A text and the known licences are brought to one canonical form: ASCII letters
in lower case, copyright lines gone, punctuation and white space as single
spaces, equivalent spellings as one. SHA-256 digests of entire texts are then
hash-joined to the digests of the known licences. The texts looked up are the
whole document and, for notices, each whole line of it.

Known are the short texts and notices of ``KNOWN`` and the whole licence texts
of ``license_texts/`` (one file an id) in the forms they are handed on in:
``whole_texts``.

Native: expressions and one equi-join; texts are canonicalised once and only
digests are joined. The known side is a table of its own, small enough for
Spark to broadcast by its known size, or joined by shuffle where it isn't.

Defined results
* null or empty text, or one with nothing left: no match;
* a document or line equal to several known ids' texts matches each;
* repeated rows: matches of rows with one doc_id are counted together;
* an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from functools import cache
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ids_and_text

#: Equivalent spellings (fixed values): the first form becomes the second.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("authoris", "authoriz"), ("organis", "organiz"), ("recognis", "recogniz"), ("utilis", "utiliz"),
    ("initialis", "initializ"), ("customis", "customiz"), ("realis", "realiz"), ("favour", "favor"),
    ("behaviour", "behavior"), ("cancelled", "canceled"), ("labelled", "labeled"), ("fulfilment", "fulfillment"),
    ("judgement", "judgment"), ("non commercial", "noncommercial"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("whilst", "while"), ("merchantibility", "merchantability"),
    ("https", "http"),
)
_PUNCTUATION = ("[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F\\x{00A0}\\x{00AB}\\x{00BB}\\x{2010}-\\x{2015}"
                "\\x{2018}-\\x{201F}\\x{2022}\\x{3000}]+")
_COPYRIGHT = "\n[ \t\r>*#/;.-]*(?:copyright[ \t]*(?:\\(c\\)|©|[0-9]|by |holder:|owner:)|\\(c\\)[ \t]|©|all rights reserved)[^\n]*"

_NO_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE.")
_PERFORMANCE = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution.")
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.")
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:")
_MIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.")

#: Short licence texts and notices (fixed values): id, text.
KNOWN = (
    ("MIT", f"MIT License\n{_MIT}\n{_MIT_NOTICE}\n{_NO_WARRANTY}"),
    ("MIT", f"{_MIT}\n{_MIT_NOTICE}\n{_NO_WARRANTY}"),
    ("MIT-0", f"MIT No Attribution\n{_MIT.replace(', subject to the following conditions:', '.')}\n{_NO_WARRANTY}"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            f"copies.\n{_PERFORMANCE}"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
             f"is hereby granted.\n{_PERFORMANCE}"),
    ("BSD-2-Clause", f"{_BSD}\n{_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD}\n{_BSD_THIRD}\n{_BSD_END}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)
#: Addresses (fixed values) that copies of one GNU licence differ in.
_ADDRESS = re.compile(r"51 Franklin St(?:reet)?, Fifth Floor, Boston,? MA +02110-1301 +USA")
ADDRESSES = (
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "675 Mass Ave, Cambridge, MA 02139, USA", "<https://fsf.org/>")
_TERMS_END = re.compile(r"^[ \t]*END OF TERMS AND CONDITIONS[ \t]*$", re.M)
_TEMPLATE = "Copyright [yyyy] [name of copyright owner]"


@cache
def whole_texts() -> tuple[tuple[str, str], ...]:
    """(id, text) of the whole licences: as published, with another address of
    the publisher, with the copyright line filled in (canonically: gone), and
    each of these up to the end of the terms, without the instructions."""
    found = {}
    for file in sorted(files(__package__).joinpath("license_texts").iterdir(), key=lambda f: f.name):
        if not file.name.endswith(".txt"):
            continue
        text = file.read_text("utf-8")
        forms = [text, text.replace(_TEMPLATE, "")]
        if _ADDRESS.search(text):
            forms += [_ADDRESS.sub(a, text) for a in ADDRESSES]
        if end := _TERMS_END.search(text):
            forms += [_TERMS_END.split(f)[0] + end[0] for f in forms]
        found |= {(file.name.removesuffix(".txt"), f): None for f in forms}
    return tuple(found)


def canonical_lines(text: Column) -> Column:
    """The canonical form with the line breaks still in place."""
    c = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    c = F.regexp_replace(F.concat(F.lit("\n"), c), _COPYRIGHT, "")
    c = F.regexp_replace(c, _PUNCTUATION, " ")
    for a, b in SPELLINGS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def units(df: DataFrame, text: Column, *keep: str) -> DataFrame:
    """(keep..., scope, digest): one row for the whole text and one for each
    line, of what has anything left."""
    squeeze = lambda c: F.trim(F.regexp_replace(c, " +", " "))
    df = df.select(*keep, canonical_lines(text).alias("form"))
    whole = F.struct(F.lit("text").alias("scope"), squeeze(F.translate("form", "\n", " ")).alias("unit"))
    lines = F.transform(F.split("form", "\n"), lambda x: F.struct(F.lit("line").alias("scope"), squeeze(x).alias("unit")))
    return (df.select(*keep, F.explode(F.concat(F.array(whole), lines)).alias("u")).where("u.unit <> ''")
            .select(*keep, F.col("u.scope").alias("scope"), F.sha2("u.unit", 256).alias("digest")))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """(license_id, digest) of whole licence texts and notices; all that are
    known by default."""
    known = (*KNOWN, *whole_texts()) if known is None else known
    ids, bodies = zip(*known) if known else ((), ())
    # a local relation: its size is known to the planner
    texts = spark.createDataFrame(pa.table({"license_id": pa.array(ids, pa.string()), "body": pa.array(bodies, pa.string())}))
    return units(texts, F.col("body"), "license_id").where("scope = 'text'").select("license_id", "digest").distinct()


def scan(docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, scope, license_id, n_matches): scope 'text' where the whole
    document is the licence, 'line' for the number of its lines that are."""
    known = known_digests(docs.sparkSession) if known is None else known.select("license_id", "digest").distinct()
    found = units(ids_and_text(docs, doc_id, text), F.col("text"), "doc_id").join(known, "digest")
    return found.groupBy("doc_id", "scope", "license_id").agg(F.count("*").alias("n_matches"))
