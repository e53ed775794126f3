"""Licences of files: TF-IDF cosine of notices, headers and licence texts to templates and licence tags, then
inheritance from the nearest ancestor directory.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import derive
from vigil.session import written_table

LEAST = 0.6  # cosine from which a notice counts
CLOSE = 0.9  # cosine from which a window counts, which holds no more terms than its template
BROADCAST_WEIGHTS = 100_000  # template terms, some 60 bytes each; more are shuffled

# Well-known notices, a passage each.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("reserved", "All rights reserved."),
)
# Passages that windows of terms are compared with. A number in them must stand in the window, so
# the clauses of the BSD licences, which are bulleted as often as numbered, have none.
_LATER = ("you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the "
          "Free Software Foundation, either version {1} of the License, or (at your option) any later version.")
_ONLY = ("you can redistribute it and/or modify it under the terms of the GNU {0}General Public License version {1} as "
         "published by the Free Software Foundation")
_WORK = "licensed under the GNU {0}General Public License, version {1}"
_GNU = (("AGPL-3.0", "Affero ", "3"), ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.0", "Library ", "2"),
        ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"))
_DISCLAIMED = (
    "IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
    "EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, "
    "OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
    "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")
_NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
          "products derived from this software without specific prior written permission. ")
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
    "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
    "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
    "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
HEADERS = (
    *(t for t in TEMPLATES if t[0] != "BSD-3-Clause"),  # the other BSD licences open with the same passage
    *((name, form.format(kind, version)) for form in (_LATER, _ONLY, _WORK) for name, kind, version in _GNU),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", _CLAUSES + "THIS SOFTWARE " + _DISCLAIMED),
    ("BSD-3-Clause", _CLAUSES + _NAMES + "THIS SOFTWARE " + _DISCLAIMED),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
                "and accompanying documentation covered by this license"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", _MIT),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
RESERVED = "reserved"  # grants nothing, so any licence of the same file goes before it
# A line without one of these words is no notice; the names of licence files.
NOTICE = "(?i)licen[cs]e|copyright|rights reserved|permission|redistribut"
LICENSE_FILE = "(?i)^(licen[cs]e|copying|unlicense)([.-].*)?$"
TERM = "[a-z0-9]+(?:[.+-][a-z0-9]+)*"
# Of windows: terms are parts of identifiers, and these words place a passage in a text.
PART = "[a-z0-9]+"
ANCHOR = "license|copyright|reserved|permission|redistribut"
TAG = r"(?i)SPDX-Licen[cs]e-Identifier:[ \t(]*([A-Z0-9][A-Z0-9.+-]*)"


def terms(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{TERM}', 0)"


def parts(text: str) -> str:
    return f"regexp_extract_all(replace(lower({text}), 'licence', 'license'), '{PART}', 0)"


def _listed(known: DataFrame) -> str:
    """The terms of passages as an SQL array."""
    words = sorted(r["term"] for r in known.select("term").distinct().collect())  # of the templates only
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")" if words else "CAST(array() AS array<string>)"


def _weights(known: DataFrame, scanned: DataFrame, seen: str, total: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(weights of the terms of each passage, idf of each term); document frequencies by the lists in ``seen``."""
    idf = scanned.select(F.explode(seen).alias("term")).groupBy("term").agg(F.count("*").alias("df")).selectExpr(
        "term", f"ln({1 + total}D / (1 + df)) + 1 AS idf")
    weights = written_table(known.sparkSession, known.join(idf, "term", "left").selectExpr(
        "passage", "license", "term", f"tf * coalesce(idf, ln({1 + total}D) + 1) AS weight",
        f"coalesce(idf, ln({1 + total}D) + 1) AS idf"), name)
    lengths = weights.groupBy("passage").agg(F.sum(F.expr("weight * weight")).alias("template_square"))
    by_term, by_word = weights.join(lengths, "passage"), weights.select("term", "idf").distinct()
    if weights.count() <= BROADCAST_WEIGHTS:
        by_term, by_word = F.broadcast(by_term), F.broadcast(by_word)
    return by_term, by_word


def _scores(units: DataFrame, by_term: DataFrame, by_word: DataFrame, least: float) -> DataFrame:
    """(columns of units, license, score): cosines of sorted terms (column notice) to all passages, or to
    the one that units name. Equal units are scored once."""
    unit = units.columns
    counted = units.distinct().select(*unit, F.explode(F.split("notice", " ")).alias("term")).groupBy(
        *unit, "term").agg(F.count("*").alias("tf"))
    weighed = counted.join(by_word, "term", "left").selectExpr(*unit, "term", "tf * coalesce(idf, 1D) AS own")
    squares = weighed.groupBy(*unit).agg(F.sum(F.expr("own * own")).alias("square"))
    return weighed.join(by_term, ["term", *[c for c in unit if c == "passage"]]).groupBy(
        *dict.fromkeys([*unit, "passage"]), "license", "template_square").agg(
        F.sum(F.expr("own * weight")).alias("dot")).join(squares, unit).selectExpr(
        *unit, "license", "round(dot / sqrt(square * template_square), 6) AS score").where(f"score >= {least}")


def _windows(scanned: DataFrame, headers: DataFrame) -> DataFrame:
    """(row, passage, notice): for each notice word of a text and each passage with that word, the terms around it
    that stand where the passage has its own, sorted. All numbers of the passage are among them.

    A notice word becomes a row with its neighbourhood, as far as the longest passage reaches, and meets the passages by an
    equi-join on the word: the work grows with the notice words of a text, not with their square.
    """
    anchors = written_table(scanned.sparkSession, headers.select(
        "passage", F.size("parts").alias("n"), F.expr("filter(parts, t -> t RLIKE '[0-9]')").alias("numbers"),
        F.posexplode("parts").alias("at", "term")).where(f"term RLIKE '{ANCHOR}'"), "anchors")
    count, back, ahead = anchors.agg(F.count("*"), F.coalesce(F.max("at"), F.lit(0)), F.coalesce(F.max(F.expr("n - at")), F.lit(1))).first()
    places = scanned.select("row", "parts", F.posexplode("parts").alias("i", "term")).where(f"term RLIKE '{ANCHOR}'").selectExpr(
        "row", "term", "i", f"slice(parts, greatest(i - {back}, 0) + 1, least(i, {back}) + {ahead}) AS near")
    met = places.join(F.broadcast(anchors) if count <= BROADCAST_WEIGHTS else anchors, "term")
    cut = derive(met, {"words": f"slice(near, greatest(i - at, 0) - greatest(i - {back}, 0) + 1, n + least(i - at, 0))"})
    return cut.where("size(array_except(numbers, words)) = 0").selectExpr(
        "row", "passage", "array_join(array_sort(words), ' ') AS notice").distinct()


def licensed(files: DataFrame, templates: DataFrame, path: str = "path", text: str = "text",
             keep: tuple[str, ...] = (), least: float = LEAST, headers: DataFrame | None = None,
             close: float = CLOSE) -> DataFrame:
    """The licence of every file: ``keep``, path, own_license, own_score, inherited_license, inherited_from, license.

    ``templates`` and ``headers`` (without it the templates) have license and text. A file's own licence is that
    with the largest TF-IDF cosine, a reservation of all rights last:

    - of a line with a word of NOTICE to a template, ``least`` or more;
    - of a window to a passage of ``headers``, which may be a whole licence text, ``close`` or more. Windows run over
      line breaks and signs, have as many terms as the passage, and lie so that a word of ANCHOR is where the passage has
      it. All numbers of the passage must be among them, as they tell versions apart;
    - an SPDX tag counts as 1: a licence known here, whatever is said of later versions, else the identifier as it
      is. Of an expression it is the first identifier.

    Document frequencies are counted over all files; a word that no template has weighs 1. Files named like LICENSE give
    their directory its licence (the best score, then the first name). A file inherits from its
    directory or the nearest ancestor that has one; license is its own, else the inherited one.

    One row per input row, repeated ones too. A null text has no notice, a null path is a file
    without directory; nothing is inherited without licence files; no templates give no
    licences but those of tags; other columns are not looked at; an empty table gives an empty result.
    """
    spark = files.sparkSession
    known = templates.where("license IS NOT NULL AND text IS NOT NULL").select("license", "text").distinct().select(
        F.expr("xxhash64(license, text)").alias("passage"), "license", F.explode(F.expr(terms("text"))).alias("term"))
    known = written_table(spark, known.groupBy("passage", "license", "term").agg(F.count("*").alias("tf")), "templates")
    headers = written_table(spark, (templates if headers is None else headers).where(
        "license IS NOT NULL AND text IS NOT NULL").select("license", "text").distinct().select(
        F.expr("xxhash64(license, text)").alias("passage"), "license", F.expr(parts("text")).alias("parts")), "headers")
    passages = headers.select("passage", "license", F.explode("parts").alias("term")).groupBy(
        "passage", "license", "term").agg(F.count("*").alias("tf"))
    rows = files.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(c) for c in keep] or [F.lit(0)]).alias("kept"),
                        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    noticed = f"CASE WHEN text RLIKE '{NOTICE}' THEN {{}} ELSE array() END".format
    scanned = written_table(spark, derive(rows, {
        "dir": "regexp_replace(path, '/?[^/]*$', '')", "name": "regexp_extract(path, '[^/]*$', 0)",
        "notices": noticed(f"filter(split(text, '\\n'), l -> l RLIKE '{NOTICE}')"),
        "parts": noticed(parts("text")), "tags": noticed(f"regexp_extract_all(text, r'{TAG}', 1)"),
        "seen": f"array_intersect({terms('text')}, {_listed(known)})",
        "seen_parts": f"array_intersect({parts('text')}, {_listed(passages)})"}).drop("text"), "scanned")
    total = scanned.count()
    notices = scanned.select("row", F.explode(F.array_distinct("notices")).alias("notice"))
    notices = written_table(spark, notices.selectExpr("row", f"array_join(array_sort({terms('notice')}), ' ') AS notice"), "notices")
    windows = written_table(spark, _windows(scanned, headers), "windows")
    best = "min(struct({} AS late, -score AS s, license)) AS b".format(f"license = '{RESERVED}'")
    of_lines = _scores(notices.select("notice"), *_weights(known, scanned, "seen", total, "weights"), least)
    of_windows = _scores(windows.select("passage", "notice"), *_weights(
        passages, scanned, "seen_parts", total, "passage-weights"), close)
    names = known.select("license").union(headers.select("license")).distinct().selectExpr("lower(license) AS id", "license AS name")
    tags = scanned.select("row", F.explode("tags").alias("tag")).selectExpr(
        "row", r"regexp_replace(tag, r'(?i)(-only|-or-later|[+])?[.]*$', '') AS tag").where(
        "upper(tag) NOT IN ('NONE', 'NOASSERTION', '')").withColumn("id", F.lower("tag")).join(names, "id", "left")
    scored = notices.join(of_lines.groupBy("notice").agg(F.expr(best)), "notice").select("row", "b").union(
        windows.join(of_windows.groupBy("passage", "notice").agg(F.expr(best)), ["passage", "notice"]).select("row", "b")).union(
        tags.selectExpr("row", "struct(false AS late, -1D AS s, coalesce(name, tag) AS license) AS b"))
    own = scored.groupBy("row").agg(F.expr("min(b)").alias("b")).selectExpr(
        "row", "b.license AS own_license", "-b.s AS own_score")
    held = written_table(spark, scanned.drop("notices", "parts", "tags", "seen", "seen_parts").join(
        own, "row", "left"), "own-licences")
    granted = held.where(f"name RLIKE '{LICENSE_FILE}' AND own_license IS NOT NULL").groupBy("dir").agg(
        F.expr("min(struct(-own_score AS s, own_license))").alias("g")).selectExpr(
        "dir AS inherited_from", "g.own_license AS inherited_license")
    ancestors = held.select("dir").distinct().withColumn("parts", F.expr(
        "CASE WHEN dir = '' THEN CAST(array() AS array<string>) ELSE split(dir, '/') END")).select(
        "dir", F.explode(F.expr("transform(sequence(0, size(parts)), n -> array_join(slice(parts, 1, n), '/'))")).alias(
            "inherited_from"))
    nearest = ancestors.join(granted, "inherited_from").groupBy("dir").agg(F.expr(
        "max(struct(length(inherited_from) AS depth, inherited_from, inherited_license))").alias("n")).selectExpr(
        "dir", "n.inherited_from", "n.inherited_license")
    return held.join(nearest, "dir", "left").selectExpr(
        *([f"kept.`{c}` AS `{c}`" for c in keep]), "path", "own_license", "own_score", "inherited_license", "inherited_from",
        "coalesce(own_license, inherited_license) AS license")


def files_of(documents: DataFrame) -> DataFrame:
    """Documents as files: doc_id, path, text. Every fifth is the licence file of one of three levels of directories."""
    top = "concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none'))"
    deep = f"concat_ws('/', {top}, concat('b', pmod(coalesce(doc_id, 0), 7)), concat('c', pmod(coalesce(doc_id, 0), 11)))"
    return documents.selectExpr("doc_id", f"""CASE WHEN doc_id % 5 = 0 THEN concat_ws('/', CASE doc_id % 3
        WHEN 0 THEN {top} WHEN 1 THEN concat_ws('/', {top}, concat('b', pmod(doc_id, 7))) ELSE {deep} END, 'LICENSE.txt')
        ELSE concat_ws('/', {deep}, concat('file-', coalesce(doc_id, 0), '.txt')) END AS path""", "text")


_VALUES = ", ".join("({}, '{}', '{}')".format(i, a, b) for i, (a, b) in enumerate(TEMPLATES))
ORACLE = rf"""
WITH f AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
    coalesce(source, 'none') || '/' || coalesce(lang, 'none') AS top, 'b' || (coalesce(doc_id, 0) % 7) AS b, 'c' || (coalesce(doc_id, 0) % 11) AS c
    FROM documents),
p AS (SELECT row, doc_id, text, CASE WHEN doc_id % 5 = 0 THEN CASE doc_id % 3 WHEN 0 THEN top WHEN 1 THEN top || '/' || b
      ELSE top || '/' || b || '/' || c END ELSE top || '/' || b || '/' || c END AS dir,
      CASE WHEN doc_id % 5 = 0 THEN 'LICENSE.txt' ELSE 'file-' || coalesce(doc_id, 0) || '.txt' END AS name FROM f),
t(passage, license, words) AS (VALUES {_VALUES}),
k AS (SELECT passage, license, term, count(*) AS tf FROM (SELECT passage, license, unnest(regexp_extract_all(lower(words), '{TERM}')) AS term FROM t) GROUP BY ALL),
d AS (SELECT term, count(DISTINCT row) AS df FROM (SELECT row, unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM p)
      WHERE term IN (SELECT term FROM k) GROUP BY term),
i AS (SELECT DISTINCT k.term, ln((1 + (SELECT count(*) FROM p))::DOUBLE / (1 + coalesce(df, 0))) + 1 AS idf FROM k LEFT JOIN d USING (term)),
w AS (SELECT passage, license, term, tf * idf AS weight, idf FROM k JOIN i USING (term)),
q AS (SELECT passage, sum(weight * weight) AS template_square FROM w GROUP BY passage),
l AS (SELECT DISTINCT row, notice FROM (SELECT row, unnest(string_split(text, chr(10))) AS notice FROM p) WHERE regexp_matches(notice, '{NOTICE}')),
n AS (SELECT row, notice, term, count(*) AS tf FROM (SELECT row, notice, unnest(regexp_extract_all(lower(notice), '{TERM}')) AS term FROM l) GROUP BY ALL),
m AS (SELECT row, notice, n.term, tf * coalesce(idf, 1) AS own FROM n LEFT JOIN i USING (term)),
s AS (SELECT row, notice, sum(own * own) AS square FROM m GROUP BY ALL),
x AS (SELECT row, license, round(dot / sqrt(square * template_square), 6) AS score FROM (
      SELECT row, notice, passage, license, sum(own * weight) AS dot FROM m JOIN w USING (term) GROUP BY ALL) JOIN s USING (row, notice) JOIN q USING (passage)),
o AS (SELECT row, license AS own_license, score AS own_score FROM x WHERE score >= {LEAST}
      QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, license) = 1),
h AS (SELECT p.row, doc_id, dir, name, own_license, own_score FROM p LEFT JOIN o USING (row)),
g AS (SELECT dir AS gdir, own_license AS granted FROM h WHERE name = 'LICENSE.txt' AND own_license IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY dir ORDER BY own_score DESC, own_license) = 1),
a AS (SELECT row, gdir, granted FROM h JOIN g ON dir = gdir OR starts_with(dir, gdir || '/')
      QUALIFY row_number() OVER (PARTITION BY row ORDER BY length(gdir) DESC) = 1)
SELECT doc_id, dir || '/' || name AS path, own_license, own_score, granted AS inherited_license, gdir AS inherited_from,
       coalesce(own_license, granted) AS license FROM h LEFT JOIN a USING (row)
"""
