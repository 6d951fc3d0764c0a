"""License scan: MinHash bands over overlapping windows, then exact containment.

Templates are split into word shingles (five words; a shorter text is one
shingle).  A template of ``n`` shingles belongs to the size class ``S``, the
least power of two from ``n`` up.  A document is cut, for each class in use,
into windows of ``2 S`` shingles every ``S`` shingles, so any run of ``S``
shingles lies whole in some window.  Window and template meet when one of
``BANDS`` one-row MinHash bands agrees; a window that holds three quarters of
a template has a Jaccard similarity of at least 0.17 with it, so the chance
to miss it is at most ``(1 - 0.17) ** 64 < 1e-5`` for each window, and nearly
nil for a whole copy.  Then the share of the template's distinct shingles
found in the window is computed exactly and kept from ``CONTAINMENT`` up.

Texts without any template's words (the longest of each shingle) are set aside
first.  Windows with fewer template shingles of any kind than the smallest template
of the class needs cannot reach the containment; they get no signature.

Everything is DataFrame functions.  The band table of the templates has
``templates * BANDS`` rows; it is broadcast when ``MAX_TEMPLATES`` bounds it
and joined by shuffle otherwise.

Besides notices and single lines, ``WHOLE`` has the whole texts of the short licenses,
reported as ``...-text``; a whole text also holds its notice, so both are reported.

Cases: null and empty texts, and texts of fewer words than five unless a
template is as short, match nothing; repeated ids are reported once; a null
id is reported as null; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE, CONTAINMENT, BANDS, MAX_TEMPLATES = 5, 0.75, 64, 2000
SPLIT = "[^a-z0-9]+"

# Wording of common license notices.
TEMPLATES = (
    ("MIT-line", "Released under the MIT License."),
    ("MIT-line", "This project is licensed under the MIT License."),
    ("Apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0-line", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("CC-BY-NC-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0-line", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0-line", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0-line", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0-line", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0-line", "Licensed under CC BY-NC-ND 4.0."),
    *((f"CC-BY-{short}-4.0-line", f"This work is licensed under a Creative Commons Attribution-{name} 4.0 International License.")
      for short, name in (("SA", "ShareAlike"), ("ND", "NoDerivatives"), ("NC", "NonCommercial"),
                          ("NC-SA", "NonCommercial-ShareAlike"), ("NC-ND", "NonCommercial-NoDerivatives"))),
    ("CC0-1.0", "has waived all copyright and related or neighboring rights to"),
    ("LGPL-line", "licensed under the GNU Lesser General Public License"),
    ("AGPL-line", "licensed under the GNU Affero General Public License"),
    ("MPL-2.0-line", "licensed under the Mozilla Public License, version 2.0"),
    ("BSD-3-Clause-line", "licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause-line", "licensed under the BSD 2-Clause License"),
    ("ISC-line", "licensed under the ISC License"),
    # Only the wording that tells them from the GPL-3.0 notice.
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by"),
    ("AGPL", "under the terms of the GNU Affero General Public License as published by"),
    ("GPL-2.0", "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                  "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                  "purpose, commercial or non-commercial, and by any means."),
    ("BSD-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                   "disclaimer."),
    ("BSD-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                   "following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission."),
    ("BSD-disclaimer", "This software is provided by the copyright holders and contributors \"as is\" and any express or implied "
                       "warranties, including, but not limited to, the implied warranties of merchantability and fitness for a "
                       "particular purpose are disclaimed."),
)

# Whole texts of short licenses, without title and copyright line.
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
          "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE")
_BSD_TERMS = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
              "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
              "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
              "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
              "with the distribution. ")
_BSD_DISCLAIMER = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
                   "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
                   "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
                   "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
                   "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
                   "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
                   "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
WHOLE = (
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                 "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                 "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
                 "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                 "the Software. " + _AS_IS + " AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
                 "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
                 "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-text", _BSD_TERMS + _BSD_DISCLAIMER),
    ("ISC-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
                 "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
                 "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
                 "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
                 "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
                 "PERFORMANCE OF THIS SOFTWARE."),
    ("Zlib-text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
                  "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
                  "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
                  "to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim "
                  "that you wrote the original software. If you use this software in a product, an acknowledgment in the product "
                  "documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as "
                  "such, and must not be misrepresented as being the original software. 3. This notice may not be removed or "
                  "altered from any source distribution."),
    ("BSL-1.0-text", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
                     "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
                     "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
                     "permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright "
                     "notices in the Software and this entire statement, including the above license grant, this restriction and "
                     "the following disclaimer, must be included in all copies of the Software, in whole or in part, and all "
                     "derivative works of the Software, unless such copies or derivative works are solely in the form of "
                     "machine-executable object code generated by a source language processor. " + _AS_IS + ", TITLE AND "
                     "NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR "
                     "ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
                     "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Unlicense-text", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                       "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                       "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
                       "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
                       "software to the public domain. We make this dedication for the benefit of the public at large and to the "
                       "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
                       "perpetuity of all present and future rights to this software under copyright law. " + _AS_IS +
                       " AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
                       "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
                       "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
)
TEMPLATES += WHOLE


def _words(text):
    """Words of a text column: runs of a-z and 0-9 after lower-casing."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPLIT), "")


def _hashed(df: DataFrame, words: str, out: str, k: int = SHINGLE) -> DataFrame:
    """Replace the array column ``words`` by ``out``, the shingle hashes in order."""
    n = F.size(words)
    ids = F.transform(words, lambda w: F.xxhash64(w))
    df = df.withColumn("_ids", F.when(n > 0, ids).otherwise(F.array().cast("array<long>")))
    df = df.select(*[c for c in df.columns if c not in (words, "_ids")], F.explode(F.array("_ids")).alias("_ids"))
    n, ids = F.size("_ids"), F.col("_ids")
    runs = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(ids, i + j) for j in range(k)]))
    short = F.when(n > 0, F.array(F.xxhash64(F.lit("short"), ids))).otherwise(F.array().cast("array<long>"))
    return df.withColumn(out, F.when(n >= k, runs).otherwise(short)).drop("_ids")


def template_table(spark: SparkSession, templates=TEMPLATES, k: int = SHINGLE) -> DataFrame:
    """``license, template, shingles (distinct), step``: one row per template."""
    rows = spark.createDataFrame([(a, i, b) for i, (a, b) in enumerate(templates)], "license string, template int, text string")
    hashed = _hashed(rows.withColumn("words", _words(F.col("text"))).drop("text"), "words", "_h", k)
    distinct = F.array_distinct("_h")
    step = F.pow(F.lit(2), F.ceil(F.log2(F.size("shingles")))).cast("int")
    return hashed.withColumn("shingles", distinct).where(F.size("shingles") > 0).withColumn("step", step).drop("_h")


def anchor_words(templates, k: int = SHINGLE) -> list[str]:
    """The longest word of every shingle: a text that holds none of them holds no shingle."""
    found = set()
    for _, text in templates:
        words = [w for w in re.split(SPLIT, text.lower()) if w]
        for i in range(max(1, len(words) - k + 1)):
            if words:
                found.add(max(words[i: i + k], key=lambda w: (len(w), w)))
    return sorted(found)


def _bands(shingle_array, bands: int):
    seeds = F.sequence(F.lit(0), F.lit(bands - 1))
    return F.transform(seeds, lambda b: F.struct(
        b.alias("band"), F.array_min(F.transform(shingle_array, lambda x: F.xxhash64(x, b))).alias("value")))


def scan(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT, bands: int = BANDS,
         k: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, license, containment, first_shingle`` per document and license found."""
    spark = docs.sparkSession
    table = template_table(spark, templates, k)
    small = len(templates) <= MAX_TEMPLATES
    # All of these are bounded by the template list itself.
    parts = table.select("step", F.size("shingles").alias("n"), "shingles").collect()
    classes: dict[int, int] = {}
    for r in parts:
        classes[r.step] = min(classes.get(r.step, r.n), r.n)
    vocabulary = F.array(*[F.lit(h) for h in sorted({h for r in parts for h in r.shingles})])
    anchors = F.array(*[F.lit(w) for w in anchor_words(templates, k)])

    # The words go through a generator, so they are split once, whatever reads them.
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.explode(F.array(_words(F.col(text)))).alias("_words"))
    rows = rows.where(F.arrays_overlap("_words", anchors))
    rows = _hashed(rows, "_words", "_h", k).withColumn("_common", F.array_intersect("_h", vocabulary))
    rows = rows.where(F.size("_common") > 0)
    hits = F.filter(F.transform("_h", lambda x, i: F.when(F.array_contains("_common", x), i)), lambda i: i.isNotNull())
    rows = rows.select("doc_id", "_h", F.explode(F.array(hits)).alias("_hits"))

    def windows(step: int, least: int):
        """Windows of a class that hold enough template shingles, as structs."""
        need = math.ceil(containment * least - 1e-9)
        starts = F.array_distinct(F.flatten(F.transform("_hits", lambda i: F.array(
            F.floor(i / step), F.floor(i / step) - 1))))
        enough = F.filter(starts, lambda j: (j >= 0) & (F.size(F.filter(
            "_hits", lambda i: (i >= j * step) & (i < (j + 2) * step))) >= need))
        return F.transform(enough, lambda j: F.struct(
            F.lit(step).alias("step"), j.alias("window"),
            F.slice("_h", (j * step + 1).cast("int"), F.lit(2 * step)).alias("shingles")))

    cut = F.flatten(F.array(*[windows(s, n) for s, n in sorted(classes.items())]))
    rows = rows.select("doc_id", F.explode(cut).alias("w"))
    rows = rows.select("doc_id", F.col("w.step").alias("step"), F.col("w.window").alias("window"),
                       F.col("w.shingles").alias("shingles"))
    signed = rows.select("doc_id", "step", "window", "shingles", F.explode(_bands(F.col("shingles"), bands)).alias("b"))
    signed = signed.select("doc_id", "step", "window", "shingles", F.col("b.band").alias("band"), F.col("b.value").alias("value"))
    goal = table.select("license", F.col("step").alias("_step"), F.col("shingles").alias("_template"),
                        F.explode(_bands(F.col("shingles"), bands)).alias("b"))
    goal = goal.select("license", "_step", "_template", F.col("b.band").alias("_band"), F.col("b.value").alias("_value"))
    goal = F.broadcast(goal) if small else goal
    met = signed.join(goal, (F.col("value") == F.col("_value")) & (F.col("band") == F.col("_band")) & (F.col("step") == F.col("_step")))
    found = F.size(F.array_intersect("_template", "shingles")) / F.size("_template")
    kept = met.withColumn("_c", found).where(F.col("_c") >= containment)
    best = kept.groupBy("doc_id", "license").agg(
        F.round(F.max("_c"), 6).alias("containment"), F.min(F.col("window") * F.col("step")).alias("first_shingle"))
    return best.select("doc_id", "license", "containment", F.col("first_shingle").cast("long").alias("first_shingle"))


def _oracle(templates=TEMPLATES, containment: float = CONTAINMENT, k: int = SHINGLE) -> str:
    """All windows of all documents against all templates, shingles as lists of words."""
    values = ", ".join("('{}', {}, '{}')".format(a, i, b.replace("'", "''")) for i, (a, b) in enumerate(templates))
    words = "list_filter(regexp_split_to_array(lower(coalesce({}, '')), '[^a-z0-9]+'), lambda w: w <> '')"
    cut = (f"CASE WHEN len(w) >= {k} THEN list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' ')) "
           "WHEN len(w) > 0 THEN ['short ' || array_to_string(w, ' ')] ELSE [] END")
    return f"""
WITH tt AS (SELECT * FROM (VALUES {values}) v(license, template, txt)),
tw AS (SELECT license, template, {words.format('txt')} AS w FROM tt),
ts AS (SELECT DISTINCT license, template, unnest({cut}) AS s FROM tw),
tn AS (SELECT license, template, count(*) AS n, pow(2, ceil(log2(count(*))))::BIGINT AS step FROM ts GROUP BY ALL),
dw AS (SELECT doc_id, {words.format('text')} AS w FROM documents),
dl AS (SELECT row_number() OVER () AS r, doc_id, {cut} AS l FROM dw),
ds AS (SELECT r, doc_id, unnest(l) AS s, unnest(range(0, len(l))) AS i FROM dl),
hit AS (SELECT r, doc_id, license, template, n, step, s, i FROM ds JOIN ts USING (s) JOIN tn USING (license, template)),
win AS (SELECT *, i // step AS j FROM hit UNION ALL SELECT *, i // step - 1 AS j FROM hit WHERE i >= step),
c AS (SELECT r, doc_id, license, template, step, j, count(DISTINCT s) / max(n) AS c FROM win GROUP BY ALL)
SELECT doc_id, license, round(max(c), 6) AS containment, min(j * step)::BIGINT AS first_shingle
FROM c WHERE c >= {containment} GROUP BY doc_id, license
"""


ORACLE = _oracle()
