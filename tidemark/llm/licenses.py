"""Licence scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance from directories.

A text's lines, its blocks of lines (a header that is wrapped or boxed in comment signs), the sentences of those blocks (a
notice inside longer prose), and a licence file as a whole are compared with templates, short notices and full licences,
by the cosine of TF-IDF vectors; the best one above the threshold is the text's own licence. A file that is named like a
licence file speaks for its directory, and a file without a licence of its own takes that of the nearest directory above
it that has one, by a join on paths. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: The parts that licences share word for word.
_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_GNU = "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} General Public License as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version. {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} General Public License for more details. You should have received a copy of the GNU {1} General Public License along with {0}. If not, see https://www.gnu.org/licenses/."

#: What each notice, header or licence says.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("ISC", "Released under the ISC License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", 'MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", "ISC License. Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _WARRANTY),
    ("BSD-2-Clause", "BSD 2-Clause License. " + _BSD + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License. " + _BSD + _BSD_3 + _BSD_END),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("GPL-3.0", _GNU.format("This program", "", "3")),
    ("LGPL-3.0", _GNU.format("This library", "Lesser", "3")),
    ("AGPL-3.0", _GNU.format("This program", "Affero", "3")),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)([.-][a-z0-9.-]+)?$"
THRESHOLD = 0.8


def terms(text: Column) -> Column:
    """Lower-cased runs of ASCII letters and digits."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def weights(docs: DataFrame, text: str, templates: list[tuple[str, str]]) -> tuple[dict[str, float], float]:
    """Inverse document frequencies of the templates' terms over all docs, and that of a term of no document.

    The templates bound the first; a term outside them counts as one that no document has.
    """
    words = sorted({t for _, x in templates for t in "".join(c if c.isascii() and c.isalnum() else " " for c in x.lower()).split()})
    known = F.array(*[F.lit(w) for w in words])
    n = docs.count()
    found = docs.select(F.explode(F.array_intersect(terms(F.coalesce(F.col(text), F.lit(""))), known)).alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()
    idf = lambda df: math.log((1 + n) / (1 + df)) + 1
    return {w: idf(0) for w in words} | {r.t: idf(r.df) for r in found}, idf(0)


def _must_have(idf: dict[str, float], templates: list[dict[str, int]], threshold: float) -> list[str]:
    """Terms of which a line must have one to reach the threshold: without them what it can share with any template is,
    by Cauchy and Schwarz, below it. The commonest terms are left out first."""
    left = sorted(idf, key=lambda t: (-idf[t], t))
    while left:
        common_ = set(idf) - set(left[:-1])
        if any(sum((n * idf[t]) ** 2 for t, n in v.items() if t in common_) >= threshold**2 * sum((n * idf[t]) ** 2 for t, n in v.items()) for v in templates):
            break
        left.pop()
    return left


def units(text: Column, whole: Column) -> Column:
    """What of a text is compared: its lines, its blocks of lines, the blocks' sentences, and all of it where `whole` holds."""
    blocks = F.split(text, r"\n[^A-Za-z0-9\n]*\n")
    sentences = F.flatten(F.transform(blocks, lambda b: F.split(b, r"[.!?]\s+")))
    return F.array_distinct(F.concat(F.split(text, "\n"), blocks, sentences, F.when(whole, F.array(text)).otherwise(F.array().cast("array<string>"))))


def notices(docs: DataFrame, text: str = "text", templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, keep: tuple[str, ...] = ("path",)) -> DataFrame:
    """(row, keep..., own): every row of docs under a number of its own, with the (licence, cosine) of the best match of any
    template and any of its units, null without one; of equal ones the earlier template's.
    """
    templates = TEMPLATES if templates is None else templates
    spark = docs.sparkSession
    idf, unknown = weights(docs, text, templates)
    bags = []
    for _, x in templates:
        bag: dict[str, int] = {}
        for t in "".join(c if c.isascii() and c.isalnum() else " " for c in x.lower()).split():
            bag[t] = bag.get(t, 0) + 1
        bags.append(bag)
    rows = [(k, templates[k][0], t, n * idf[t] / sum((m * idf[u]) ** 2 for u, m in bag.items()) ** 0.5) for k, bag in enumerate(bags) for t, n in bag.items()]
    table = spark.createDataFrame(rows, "template int, licence string, term string, weight double")
    worth = spark.createDataFrame(sorted(idf.items()), "term string, worth double")
    need = F.array(*[F.lit(t) for t in _must_have(idf, bags, threshold)])
    whole = F.col("path").rlike(LICENCE_FILE) if "path" in keep else F.lit(False)
    some = F.filter(units(F.coalesce(F.col(text), F.lit("")), F.coalesce(whole, F.lit(False))), lambda u: F.arrays_overlap(terms(u), need))
    numbered = common.stored(docs.select(F.monotonically_increasing_id().alias("row"), *keep, F.when(F.arrays_overlap(terms(F.coalesce(F.col(text), F.lit(""))), need), some).alias("units")), "units")
    counted = numbered.select("row", F.posexplode("units").alias("no", "unit")).select("row", "no", F.explode(terms(F.col("unit"))).alias("term")).groupBy("row", "no", "term").agg(F.count("*").alias("n"))
    # terms that no template has count one by one
    counted = common.stored(counted.join(F.broadcast(worth), "term", "left"), "counted")
    square = F.when(F.col("worth").isNull(), F.col("n") * F.lit(unknown) * F.lit(unknown)).otherwise(F.pow(F.col("n") * F.col("worth"), F.lit(2)))
    norms = counted.groupBy("row", "no").agg(F.sqrt(F.sum(square)).alias("norm"))
    dots = counted.filter("worth IS NOT NULL").join(F.broadcast(table), "term").groupBy("row", "no", "template", "licence").agg(F.sum(F.col("n") * F.col("worth") * F.col("weight")).alias("dot"))
    cosine = F.round(F.col("dot") / F.col("norm"), 6)
    best = dots.join(norms, ["row", "no"]).withColumn("cosine", cosine).filter(F.col("cosine") >= threshold).groupBy("row").agg(F.max_by(F.struct("licence", "cosine"), F.struct("cosine", -F.col("template"))).alias("own"))
    return numbered.drop("units").join(best, "row", "left")


def _parent(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^(.*)/", 1)


def scan(df: DataFrame, path: str = "path", text: str = "text", id: str = "doc_id", templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(id, path, licence, cosine, origin, from_path), one row per row of df.

    origin is `header` if a part of the text itself matches (the best one; ties: the earlier template), `directory` if
    the licence is inherited, else `none`. A licence file is one whose name LICENCE_FILE matches; it speaks for its
    directory and all below, the nearest first; of several in one directory the smallest path with a licence counts.
    from_path names it. Null texts are empty, null paths empty (the topmost directory). Every row
    is judged by its own text, also where rows share id and path; repeated rows are kept. Other
    columns are not looked at. An empty table gives an empty result.
    """
    docs = df.select(F.col(id).alias("id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.col(text).cast("string").alias("text"))
    rows = common.stored(notices(docs, "text", templates, threshold, ("id", "path")).withColumn("at", _parent(F.col("path"))), "notices")
    files = rows.filter(F.col("own").isNotNull() & F.col("path").rlike(LICENCE_FILE)).groupBy(F.col("at").alias("dir")).agg(F.min_by(F.struct(F.col("own.licence").alias("licence"), F.col("own.cosine").alias("cosine"), F.col("path").alias("file")), F.struct("path", -F.col("own.cosine"), F.col("own.licence"))).alias("file"))
    dirs = rows.filter("own IS NULL").select("at").distinct()
    parts = F.split("at", "/")
    above = F.when(F.col("at") == "", F.array(F.lit(""))).otherwise(F.concat(F.transform(F.sequence(F.size(parts), F.lit(1)), lambda n: F.array_join(F.slice(parts, 1, n), "/")), F.array(F.lit(""))))
    nearest = dirs.select("at", F.posexplode(above).alias("up", "dir")).join(files, "dir").groupBy("at").agg(F.min_by("file", "up").alias("inherited"))
    told = common.salted(rows, nearest, "at", "row")
    return told.select(
        "id",
        "path",
        F.coalesce("own.licence", "inherited.licence").alias("licence"),
        F.coalesce("own.cosine", "inherited.cosine").alias("cosine"),
        F.when(F.col("own").isNotNull(), "header").when(F.col("inherited").isNotNull(), "directory").otherwise("none").alias("origin"),
        F.when(F.col("own").isNull(), F.col("inherited.file")).alias("from_path"),
    )


#: The path that a document gets: source/LICENSE for some ids, else a directory of a hundred and one of a thousand ids.
PATH = """
concat(coalesce(source, 'none'), '/', CASE WHEN doc_id % 1000 = 0 THEN 'LICENSE' ELSE concat(
  'd', cast(floor(doc_id / 1000) AS BIGINT), '/e', cast(floor(doc_id / 100) AS BIGINT), '/',
  CASE WHEN doc_id % 10 = 0 THEN concat('LICENSE.', translate(cast(doc_id AS STRING), '0123456789', 'abcdefghij')) ELSE concat(cast(doc_id AS STRING), '.txt') END) END)
"""


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; they have no paths, so each gets one from its source and id, some named as licence files."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.expr(PATH).alias("path"))
    return scan(docs).withColumnRenamed("id", "doc_id")


def _sql() -> str:
    bag = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda w: w <> '')"
    values = ", ".join("({}, '{}', '{}')".format(k, n, x.replace("'", "''")) for k, (n, x) in enumerate(TEMPLATES))
    return f"""
WITH docs AS (SELECT doc_id, {PATH} AS path, coalesce(text, '') AS text FROM documents),
template(k, licence, txt) AS (VALUES {values}),
tt AS (SELECT k, licence, t, count(*) AS n FROM (SELECT k, licence, unnest({bag.format('txt')}) AS t FROM template) x GROUP BY ALL),
seen AS (SELECT t, count(*) AS df FROM (SELECT unnest(list_distinct({bag.format('text')})) AS t FROM docs) x GROUP BY t),
idf AS (SELECT v.t, ln((1.0 + (SELECT count(*) FROM docs)) / (1.0 + coalesce(df, 0))) + 1 AS w FROM (SELECT DISTINCT t FROM tt) v LEFT JOIN seen USING (t)),
weight AS (SELECT k, licence, t, n * w / sqrt(sum((n * w) * (n * w)) OVER (PARTITION BY k)) AS x FROM tt JOIN idf USING (t)),
block AS (SELECT doc_id, path, unnest(string_split_regex(text, '\\n[^A-Za-z0-9\\n]*\\n')) AS unit FROM docs),
unit AS (SELECT doc_id, path, unnest(string_split(text, chr(10))) AS unit FROM docs UNION SELECT doc_id, path, unit FROM block
  UNION SELECT doc_id, path, unnest(string_split_regex(unit, '[.!?]\\s+')) FROM block UNION SELECT doc_id, path, text FROM docs WHERE regexp_matches(path, '{LICENCE_FILE}')),
word AS (SELECT doc_id, path, unit, t, count(*) AS n FROM (SELECT doc_id, path, unit, unnest({bag.format('unit')}) AS t FROM unit) x GROUP BY ALL),
norm AS (SELECT doc_id, unit, sqrt(sum(CASE WHEN w IS NULL THEN n * pow(ln(1.0 + (SELECT count(*) FROM docs)) + 1, 2) ELSE pow(n * w, 2) END)) AS norm FROM word LEFT JOIN idf USING (t) GROUP BY ALL),
dot AS (SELECT doc_id, path, unit, k, licence, sum(n * w * x) AS dot FROM word JOIN idf USING (t) JOIN weight USING (t) GROUP BY ALL),
hit AS (SELECT doc_id, path, k, licence, round(dot / norm, 6) AS cosine FROM dot JOIN norm USING (doc_id, unit) WHERE round(dot / norm, 6) >= {THRESHOLD}),
own AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, k) AS r FROM hit) x WHERE r = 1),
file AS (SELECT * FROM (SELECT *, regexp_extract(path, '^(.*)/', 1) AS dir, row_number() OVER (PARTITION BY regexp_extract(path, '^(.*)/', 1) ORDER BY path) AS f FROM own WHERE regexp_matches(path, '{LICENCE_FILE}')) x WHERE f = 1),
dirs AS (SELECT DISTINCT regexp_extract(path, '^(.*)/', 1) AS place FROM docs),
nearest AS (SELECT * FROM (SELECT place, licence, cosine, path AS file, row_number() OVER (PARTITION BY place ORDER BY length(dir) DESC) AS r FROM dirs JOIN file ON dir = place OR dir = '' OR starts_with(place, dir || '/')) x WHERE r = 1)
SELECT d.doc_id, d.path, coalesce(o.licence, n.licence) AS licence, coalesce(o.cosine, n.cosine) AS cosine,
  CASE WHEN o.doc_id IS NOT NULL THEN 'header' WHEN n.place IS NOT NULL THEN 'directory' ELSE 'none' END AS origin, CASE WHEN o.doc_id IS NULL THEN n.file END AS from_path
FROM docs d LEFT JOIN own o USING (doc_id) LEFT JOIN nearest n ON n.place = regexp_extract(d.path, '^(.*)/', 1)
"""


OP6_SQL = _sql()
