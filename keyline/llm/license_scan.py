"""Licence scan by canonical digests (DataFrame functions only).

A text's canonical form has A-Z lower-cased, copyright lines left out, punctuation and
line breaks as single spaces, and one spelling of words and phrases that licence matching
treats as equal. Documents join the table of known licences on the digest of the whole
canonical text. Each line by itself is a text too (a notice such as "Released under the
MIT License."), looked up under the same digests. The table of known licences is broadcast
behind a check of its size; documents are never shuffled.

The SQL (``ORACLE``) knows the notices and the texts of ``TEXTS`` only and drops every line
that begins with "copyright"; it agrees where documents have no whole text in other words
and no such line that is not a notice, as in the test tables.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyline.llm.common import table

MAX_LICENSES = 10_000  # rows of the table of known digests

# Licence ids and names.
NAMES = [
    ("Apache-2.0", ["Apache License, Version 2.0", "Apache License 2.0"]),
    ("BSD-2-Clause", ["BSD 2-Clause License", "Simplified BSD License"]),
    ("BSD-3-Clause", ["BSD 3-Clause License", "New BSD License"]),
    ("CC-BY-4.0", ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"]),
    ("CC-BY-NC-4.0", ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"]),
    ("CC-BY-SA-4.0", ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"]),
    ("CC0-1.0", ["CC0 1.0", "CC0 1.0 Universal"]),
    ("GPL-2.0", ["GNU General Public License, version 2", "GPL v2"]),
    ("GPL-3.0", ["GNU General Public License, version 3", "GPL v3"]),
    ("ISC", ["ISC License"]),
    ("LGPL-2.1", ["GNU Lesser General Public License, version 2.1"]),
    ("LGPL-3.0", ["GNU Lesser General Public License, version 3"]),
    ("MIT", ["MIT License"]),
    ("MPL-2.0", ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"]),
    ("Unlicense", ["Unlicense"]),
]
FORMS = ["{name}", "Licensed under {name}.", "Released under {name}.", "Distributed under {name}.", "This work is licensed under {name}.", "This project is licensed under {name}."]

# Whole licence texts.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
# Other whole texts are in the folder "licenses"; these are the ones that the SQL knows.
TEXTS = [("MIT", "MIT License\n\n" + MIT), ("MIT", MIT), ("ISC", "ISC License\n\n" + ISC), ("ISC", ISC)]

# Spellings that count as one.
WORDS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "catalogue": "catalog", "categorise": "categorize", "centre": "center", "emphasised": "emphasized",
    "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "https": "http", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license", "licenced": "licensed",
    "licences": "licenses", "maximise": "maximize", "modelled": "modeled", "optimise": "optimize", "organisation": "organization",
    "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "wilfull",
}
PHRASES = [("sub license", "sublicense"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("non commercial", "noncommercial"), ("the mit license", "mit license"), ("under the", "under")]
# Words that follow "copyright" or "(c)" in the body of a licence, not in a notice.
BODY_WORDS = (
    "a|all|also|an|and|any|applies|are|as|at|disclaimers?|do|does|doctrines?|each|for|from|get|has|have|holders?|if|in|include|includes|including|infringements?|interests?|"
    "is|it|laws?|licen[sc]es?|licen[sc]ed|lines?|may|more|must|no|not|notices?|of|on|or|our|owners?|ownership|patents?|permissions?|protection|resulting|rights?|shall|"
    "similar|statements?|such|than|that|the (?:licen[sc]ed|library|program|software|work)|then|this|those|to|treaty|treaties|under|when|where|which|with|you|your"
)
BODY_LINE = rf"""^[ \t]*[*#/;-]*[ \t]*(?:portions )?(?:copyright[a-z]+|(?:copyright|\(c\))[ \t"',;:.)/-]*(?:$|(?:{BODY_WORDS})\b))"""
# Notices that licence texts hold themselves; they go wherever lines break.
OWN_NOTICE = (
    r"copyright\s+\(c\)\s+[0-9][0-9,\s-]*\s+free\s+software\s+foundation,\s+inc\.(?:[,\s]*(?:<https?://fsf\.org/?>|[0-9]+\s+(?:franklin|temple|mass)[a-z0-9 ,.\s-]{0,80}?\busa\b))?"
    r"|copyright\s+\(c\)\s+[0-9,\s-]*the\s+regents\s+of\s+the\s+university\s+of\s+california\.?(?:\s+all\s+rights\s+reserved\.?)?"
    r"|copyright\s+\(c\)\s+<?year>?\s+<?(?:name\s+of\s+author|owner)>?|copyright\s+\[yyyy\]\s+\[name\s+of\s+copyright\s+owner\]"
)
COPYRIGHT_LINE = r"^[ \t]*[*#/;-]*[ \t]*(portions )?(copyright|\(c\)|©)"
RIGHTS_LINE = r"^[ \t]*[*#/;-]*[ \t]*all rights reserved[. \t]*$"
PUNCTUATION = r"[\x00-\x2f\x3a-\x60\x7b-\x7f‘’“”–—…«»·•]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _phrases(text: Column) -> Column:
    """``text`` (single spaces) with one form of each phrase."""
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for a, b in PHRASES:
        text = F.replace(text, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(text)


def _canonical_line(line: Column) -> Column:
    """Canonical form of a lower-cased line; empty for a copyright line."""
    words = F.filter(F.split(F.regexp_replace(line, PUNCTUATION, " "), " "), lambda w: w != "")
    spelled = F.create_map(*[F.lit(x) for kv in WORDS.items() for x in kv])
    same = F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(spelled, w), w)), " ")
    return F.when((line.rlike(COPYRIGHT_LINE) & ~line.rlike(BODY_LINE)) | line.rlike(RIGHTS_LINE), F.lit("")).otherwise(_phrases(same))


def canonical_lines(text: Column) -> Column:
    """Canonical forms of the lines that are not empty."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    # Few texts have a notice to cut out; a search of bytes spares the others the pattern.
    cut = F.when(lowered.contains("copyright"), F.regexp_replace(lowered, OWN_NOTICE, " ")).otherwise(lowered)
    lines = F.split(F.regexp_replace(cut, "\r", "\n"), "\n")
    return F.filter(F.transform(lines, _canonical_line), lambda x: x != "")


def whole_digest(lines: Column) -> Column:
    """Digest of a whole text from its canonical lines; null for an empty one."""
    return F.when(F.size(lines) > 0, F.sha2(_phrases(F.array_join(lines, " ")), 256))


def whole_texts() -> list[tuple[str, str]]:
    """``(license_id, text)`` of every whole text, with and without title, preface and
    appendix, in its own lines, with a line a paragraph, and in one line."""
    texts = list(TEXTS)
    names = dict(NAMES)
    for file in sorted(resources.files("keyline.llm").joinpath("licenses").iterdir(), key=lambda f: f.name):
        spdx = next(i for i in names if file.name.startswith(i + "."))
        text = file.read_text(encoding="utf-8")
        forms = [text]
        if spdx.startswith("BSD"):
            forms.append(re.sub(r"(?m)^[123]\. ", "* ", text))
            forms += [f"{names[spdx][0]}\n\n{t}" for t in forms]
        if spdx == "Unlicense":
            forms.append(f"The Unlicense\n\n{text}")
        if spdx == "CC0-1.0":
            forms.append(text.partition("Creative Commons Legal Code")[2])
        if spdx == "CC-BY-SA-4.0":
            forms.append(f"Creative Commons {text}")
        if "END OF TERMS AND CONDITIONS" in text:
            body = text.partition("END OF TERMS AND CONDITIONS")[0]
            forms += [body, body + "END OF TERMS AND CONDITIONS"]
        texts += [(spdx, t) for t in forms]
    out = []
    for spdx, text in texts:
        paragraphs = [" ".join(p.split()) for p in re.split(r"\n\s*\n", text)]
        out += [(spdx, text), (spdx, "\n\n".join(paragraphs)), (spdx, " ".join(paragraphs))]
    return list(dict.fromkeys(out))


def known_licenses(spark: SparkSession, licenses: DataFrame | None = None) -> DataFrame:
    """``digest, license_id`` of a table ``license_id, text``; by default of the whole
    texts, their names in every form, and SPDX tags. Of ids with one digest the least stays."""
    if licenses is None:
        rows = whole_texts()
        for spdx, names in NAMES:
            rows += [(spdx, f.format(name=n)) for n in names for f in FORMS] + [(spdx, f"SPDX-License-Identifier: {spdx}")]
        licenses = spark.createDataFrame(rows, "license_id string, text string")
    digested = licenses.select("license_id", whole_digest(canonical_lines(F.col("text"))).alias("digest")).filter("digest is not null")
    return digested.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan_licenses(docs: DataFrame, licenses: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, license_id, notices, n_notices`` for every row of ``docs``.

    ``license_id`` is the licence that the whole text is, or null; ``notices`` the ids of
    the licences that its lines are, distinct, sorted and joined by commas; ``n_notices``
    the number of such lines. Null and empty texts, and texts of copyright lines alone,
    have a null digest, no licence and no notices. A line is a copyright line if a holder, a
    year or a sign follows the word, not if it is a licence's own sentence. Texts of any length are normalised
    whole. Rows are independent, so repeated rows and null ids need no rule; an empty table
    gives an empty result; other columns are ignored.
    """
    known = known_licenses(docs.sparkSession, licenses)
    pairs = known.limit(MAX_LICENSES + 1).collect()
    if len(pairs) > MAX_LICENSES:
        raise ValueError(f"over {MAX_LICENSES} known digests; they would not be broadcast")
    lines = docs.select(F.col(f"`{id_col}`").alias("doc_id"), canonical_lines(F.col(f"`{text_col}`")).alias("lines"))
    digested = lines.select("doc_id", whole_digest(F.col("lines")).alias("digest"), F.transform("lines", lambda x: F.sha2(x, 256)).alias("line_digests"))
    # The bounded table of digests as one literal map, for the lines.
    table_of = F.create_map(*[F.lit(x) for r in sorted(pairs) for x in (r["digest"], r["license_id"])]) if pairs else F.lit(None).cast("map<string,string>")
    found = F.filter(F.transform("line_digests", lambda d: F.try_element_at(table_of, d)), lambda x: x.isNotNull())
    joined = digested.join(F.broadcast(known), "digest", "left")
    return joined.select(
        "doc_id", "digest", "license_id", F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("notices"), F.size(found).cast("long").alias("n_notices")
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _oracle() -> str:
    rows = list(TEXTS)
    for spdx, names in NAMES:
        rows += [(spdx, f.format(name=n)) for n in names for f in FORMS] + [(spdx, f"SPDX-License-Identifier: {spdx}")]
    values = ", ".join(f"({_sql(i)}, {_sql(t)})" for i, t in rows)
    spelled = "MAP {" + ", ".join(f"{_sql(a)}: {_sql(b)}" for a, b in WORDS.items()) + "}"

    def phrases(x: str) -> str:
        x = f"(' ' || {x} || ' ')"
        for a, b in PHRASES:
            x = f"replace({x}, ' {a} ', ' {b} ')"
        return f"trim({x}, ' ')"

    words = f"list_filter(string_split(regexp_replace(line, '{PUNCTUATION}', ' ', 'g'), ' '), lambda w: w <> '')"
    same = f"array_to_string(list_transform({words}, lambda w: coalesce({spelled}[w], w)), ' ')"
    line = f"CASE WHEN regexp_matches(line, '{COPYRIGHT_LINE}') OR regexp_matches(line, '{RIGHTS_LINE}') THEN '' ELSE {phrases(same)} END"
    lines = f"""list_filter(list_transform(string_split(replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), chr(13), chr(10)), chr(10)),
        lambda line: {line}), lambda x: x <> '')"""
    whole = f"CASE WHEN len(lines) > 0 THEN sha256({phrases("array_to_string(lines, ' ')")}) END"
    return f"""
WITH known AS (
  SELECT digest, min(license_id) AS license_id
  FROM (SELECT license_id, {whole} AS digest FROM (SELECT license_id, {lines} AS lines FROM (VALUES {values}) AS v(license_id, text)))
  WHERE digest IS NOT NULL GROUP BY digest),
d AS (SELECT row_number() OVER () AS row, doc_id, lines, {whole} AS digest FROM (SELECT doc_id, {lines} AS lines FROM documents)),
n AS (
  SELECT row, count(*) AS n_notices, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
  FROM (SELECT row, sha256(unnest(lines)) AS line_digest FROM d) JOIN known ON digest = line_digest GROUP BY row)
SELECT doc_id, d.digest, k.license_id, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
FROM d LEFT JOIN known k ON k.digest = d.digest LEFT JOIN n ON n.row = d.row"""


ORACLE = _oracle()
