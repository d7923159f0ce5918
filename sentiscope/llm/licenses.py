"""Operator 6: licence scan by canonical digest lookup.

A unit of text - the whole document, each of its lines that may speak of a licence, and
each paragraph of a document that may - is brought to a canonical form: lower case,
copyright lines dropped, equivalent spellings made one, everything but letters and digits
one space.  Its SHA-256 is joined with the digests of known licence texts, file headers and
notices, made by the same expression.  A known text of several paragraphs is found as one
unit, or as that many paragraphs in a row at any place of the document; paragraphs end at
lines without letters or digits, so comment marks do no harm.  What lies inside a longer
known text is part of that one and not reported.

The full texts are the files of ``license_texts``, by SPDX identifier; :data:`KNOWN` holds
the notices and headers, and :func:`known_digests` takes any other table.  The known rows
(about a thousand) are broadcast; no text is shuffled, only units' digests.  Every
known entry contains one of :data:`MARKS`, so the documents and lines that are hashed miss none.

Defined results: a null or empty text has no licence; every row gets one result, also
repeated ones; an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentiscope.llm.common import text_or_empty

# Notices by SPDX identifier.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "MIT License\nCopyright (c) <year> <holder>\nPermission is hereby granted, free of charge, to any person "
            "obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission "
            "notice shall be included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED "
            "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
            "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
            "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
)
APACHE = ("{0} you may not use this file except in compliance with the License. You may obtain a copy of the License at",
          "http://www.apache.org/licenses/LICENSE-2.0",
          "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
          "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
          "specific language governing permissions and limitations under the License.")
APACHE_STARTS = (
    "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file "
    "distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You "
    "under the Apache License, Version 2.0 (the \"License\");")
GNU = (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.0", "Library ", "2"), ("LGPL-2.1", "Lesser ", "2.1"),
       ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3"))
GNU_REST = ("This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
            "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1}General Public License for more details.",
            "You should have received a copy of the GNU {1}General Public License along with this {0}. If not, see "
            "<https://www.gnu.org/licenses/>.")
MPL = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
       "distributed with this file, You can obtain one at {0}://mozilla.org/MPL/2.0/.")
END = "END OF TERMS AND CONDITIONS"


def _headers() -> list[tuple[str, str]]:
    """The usual file headers; the first paragraph decides, with or without what follows in the same paragraph."""
    found = [("MPL-2.0", MPL.format("http"))]
    for start in APACHE_STARTS:
        parts = [APACHE[0].format(start), *APACHE[1:]]
        found += [("Apache-2.0", " ".join(parts[:n])) for n in (1, 2, 3)]
    for spdx, name, version in GNU:
        for what in ("program", "library", "file", "software"):
            grant = (f"This {what} is free software; you can redistribute it and/or modify it under the terms of the "
                     f"GNU {name}General Public License as published by the Free Software Foundation")
            rest = [part.format(what, name) for part in GNU_REST]
            for suffix, terms in (("or-later", f"; either version {version} of the License, or (at your option) any later version."),
                                  ("only", f"; version {version} of the License."), ("only", f"; version {version}.")):
                found += [(f"{spdx}-{suffix}", " ".join([grant + terms, *rest[:n]])) for n in (0, 1, 2)]
            found.append((f"{spdx}-only", grant.replace(" as published", f" version {version} as published") + "."))
    return found


def _full_texts() -> list[tuple[str, str]]:
    """The files' texts, and GNU and Apache texts also without the advice after their terms."""
    found = []
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = file.read_text(encoding="utf-8")
        found.append((file.stem, text))
        if END in text:
            found += [(file.stem, text[: text.index(END)]), (file.stem, text[: text.index(END) + len(END)])]
    return found


HEADINGS = {"MIT": "MIT License", "ISC": "ISC License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License",
            "0BSD": "BSD Zero Clause License", "Zlib": "zlib License"}


def known_texts() -> list[tuple[str, str]]:
    """All known entries: ``SPDX identifier, text``."""
    full = _full_texts()
    titled = [(spdx, f"{title}\n\n{text}") for spdx, text in full for title in [HEADINGS.get(spdx, "")]
              + ["The " + HEADINGS.get(spdx, "")] if spdx in HEADINGS]
    return [*KNOWN, *_headers(), *full, *titled]


MARKS = "licen[cs]|permission|redistribut"
BROADCAST_ROWS = 100_000
# A paragraph ends at a line without letters or digits.
BREAK = "\\n(?:[^\\p{L}\\p{N}\\n]*\\n)+"
# Fixed values: (spelling, canonical spelling), whole words after lower-casing.
SPELLINGS = (("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("organisation", "organization"),
             ("favour", "favor"), ("https", "http"), ("merchantibility", "merchantability"), ("non infringement", "noninfringement"), ("v", "version"))


def canonical(text: Column) -> Column:
    lowered = F.regexp_replace(F.lower(text), "(?m)^[^a-z0-9\\n]*(?:copyright|\\(c\\)|©)[^\\n]*$", "")
    plain = F.concat(F.lit(" "), F.regexp_replace(lowered, "[^\\p{L}\\p{N}]+", " "), F.lit(" "))
    for spelling, one in SPELLINGS:
        plain = F.regexp_replace(plain, f" {spelling}(?= )", f" {one}")
    return F.trim(plain)


def paragraphs(text: Column) -> Column:
    """Digests of the paragraphs in order, without those that have no canonical text."""
    forms = F.transform(F.split(F.regexp_replace(text, "\\r\\n?", "\n"), BREAK), canonical)
    return F.transform(F.filter(forms, lambda form: form != ""), lambda form: F.sha2(form, 256))


def known_digests(spark, known=None) -> DataFrame:
    """One row per distinct canonical text and, if it has several, per paragraph: ``digest, license, entry, at, n, marked``.

    ``marked``: the entry's canonical text has one of ``MARKS``, so every copy of it has.
    """
    rows = spark.createDataFrame(list(known_texts() if known is None else known), "license string, t string")
    form = canonical(F.col("t"))
    rows = rows.select("license", F.sha2(form, 256).alias("entry"), paragraphs(F.col("t")).alias("p"), form.rlike(MARKS).alias("marked"))
    rows = rows.groupBy("entry", "p", "marked").agg(F.min("license").alias("license"))
    single = rows.groupBy("entry", "marked").agg(F.min("license").alias("license")).select(
        F.col("entry").alias("digest"), "license", "entry", F.lit(0).alias("at"), F.lit(1).alias("n"), "marked")
    several = rows.where(F.size("p") > 1).select(F.posexplode("p").alias("at", "digest"), "license", F.size("p").alias("n"),
                                                 F.concat_ws("/", "entry", F.size("p")).alias("entry"), "marked")
    several = several.select("digest", "license", "entry", "at", "n", "marked")
    return single.unionByName(several)


def find_licenses(docs: DataFrame, known: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, licenses`` (sorted ids), ``n_lines`` with one, ``whole`` text is one.

    Texts and lines without any of ``MARKS`` are left out only if every known entry is ``marked``; an entry without
    a mark (or a table that does not tell) has all texts and lines looked up.  The table is broadcast up to ``BROADCAST_ROWS``.
    """
    size = known.select(F.col("marked") if "marked" in known.columns else F.lit(False).alias("marked")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_and("marked"), F.lit(True)).alias("all")).first()
    table = F.broadcast(known) if size["n"] <= BROADCAST_ROWS else known
    marks = MARKS if size["all"] else "[\\p{L}\\p{N}]"
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                        text_or_empty(text_col).alias("t"))
    marked = F.filter(F.split("t", "\n"), lambda line: line.rlike(f"(?i){marks}"))
    # place: -2 the whole text, -1 a line, else the paragraph's number
    units = F.concat(
        F.array(F.struct(F.lit(-2).alias("place"), F.sha2(canonical(F.col("t")), 256).alias("digest"))),
        F.transform(marked, lambda line: F.struct(F.lit(-1).alias("place"), F.sha2(canonical(line), 256).alias("digest"))),
        F.transform(paragraphs(F.col("t")), lambda digest, i: F.struct(i.alias("place"), digest.alias("digest"))))
    texts = texts.withColumn("units", F.when(F.col("t").rlike(f"(?i){marks}"), units))
    units = texts.select("row", "doc_id", F.explode_outer("units").alias("unit")).select("row", "doc_id", "unit.place", "unit.digest")
    hits = units.join(table, "digest", "left")
    usable = F.col("license").isNotNull() & ((F.col("n") == 1) | (F.col("place") >= 0))
    run = F.when(usable, F.struct("entry", "license", "n", F.when(F.col("place") >= 0, F.col("place") - F.col("at")).otherwise(
        F.col("place")).alias("start")))
    found = hits.groupBy("row", run.alias("run")).agg(F.any_value("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_units"),
                                                       F.size(F.collect_set("at")).alias("parts"))
    # a text of several paragraphs needs them all; a lone line is a paragraph or in one, and is counted as a line
    complete = F.col("run").isNotNull() & (F.col("parts") == F.col("run.n"))
    line, whole = F.col("run.start") == -1, F.col("run.start") == -2
    by_doc = found.groupBy("row").agg(
        F.any_value("doc_id").alias("doc_id"), F.collect_list(F.when(complete, F.col("run"))).alias("runs"),
        F.coalesce(F.sum(F.when(complete & line, F.col("n_units"))), F.lit(0)).alias("n_lines"),
        F.coalesce(F.bool_or(complete & whole), F.lit(False)).alias("whole"))

    def inside(part, run):
        return (part["start"] >= 0) & (run["n"] > part["n"]) & (run["start"] <= part["start"]) & (
            run["start"] + run["n"] >= part["start"] + part["n"])

    longest = F.filter("runs", lambda part: ~F.exists("long", lambda run: inside(part, run)))
    entire = F.filter("runs", lambda part: part["start"] == -2)
    ids = F.transform(F.when(F.col("whole"), entire).otherwise(longest), lambda part: part["license"])
    by_doc = by_doc.withColumn("long", F.filter("runs", lambda part: part["n"] > 1))
    return by_doc.select("doc_id", F.array_join(F.array_sort(F.array_distinct(ids)), ",").alias("licenses"), "n_lines", "whole")
