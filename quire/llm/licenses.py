"""License scans by diagonal voting, in DataFrame functions only.

All word 4-grams of all texts are joined by hash to the positions of whole licence texts, and all 2-grams to
those of phrases and notices. Matches vote for the diagonal (text position minus template position), votes are
counted by diagonal, neighbouring diagonals (words put in or left out) are merged, and spans that cover enough
of their template are kept.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import once, table

#: Phrases of the contract with their labels. Every word must stand in place.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Opening or key sentences of public licences with their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: Whole texts of short public licences and the notices of long ones, with their labels.
WHOLE = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
        in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
        and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in
        all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
        OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of
        source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT
        HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
        ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT
        NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
        DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an
        acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as
        being the original software. 3. This notice may not be removed or altered from any source distribution.""",
    "boost-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the
        "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the
        Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
        the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are
        solely in the form of machine-executable object code generated by a source language processor.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in
        source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this
        software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs
        and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License
        along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
    "cc0-1.0": """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is
        distributed without any warranty. You should have received a copy of the CC0 Public Domain Dedication along with this software.""",
}
#: Words of a gram of phrases and notices, and of whole texts.
SHORT, LONG = 2, 4
#: Share of a template's grams that must be found, and the most words put in or left out between diagonals.
COVERAGE, SHIFT = 0.8, 2
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def templates() -> list[tuple[int, str, bool, int, int, int, list[str]]]:
    """(template, label, base, k, grams, place, words) of every gram of the constants above."""
    out = []
    kept = [(label, SHORT, phrase in PHRASES, phrase) for phrase, label in [*PHRASES.items(), *NOTICES.items()]]
    kept += [(label, LONG, False, text) for label, text in WHOLE.items()]
    for t, (label, k, base, text) in enumerate(kept):
        words = re.findall("[a-z0-9]+", text.lower())
        out += [(t, label, base, k, len(words) - k + 1, at, words[at : at + k]) for at in range(len(words) - k + 1)]
    return out


def template_grams(spark: SparkSession, k: int) -> DataFrame:
    """k-grams of the templates; as many rows as the constants above have words, whatever the input."""
    rows = [(t, label, base, k, n, at, *words) for t, label, base, size, n, at, words in templates() if size == k]
    names = [f"t{i}" for i in range(k)]
    grams = spark.createDataFrame(rows, f"template int, label string, base boolean, k int, grams int, at int, {', '.join(f'{n} string' for n in names)}")
    return grams.withColumn("hash", F.xxhash64(*names))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``spans`` lists verified spans (label, first word, words, coverage). A null text counts as empty: no
    words, no labels, score 0. Repeated rows and null keys keep a row each. Only matches and one row a
    document reach a shuffle. A gram counts where its words are equal, not merely their hashes.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = once(rows, F.array_remove(F.split("text", BETWEEN), "").alias("words")).drop("text")
    # A word with letters beyond ASCII matches no template; lower() touches nothing else in the others.
    plain = lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w))

    def met(k: int) -> DataFrame:
        """Matches of k-grams, and for the shortest grams a first row of every text, whether it matches or not."""
        shifted = [F.slice("words", i + 1, F.greatest(F.size("words"), F.lit(1))).alias(f"w{i}") for i in range(k)]
        every = F.posexplode_outer(F.arrays_zip(*shifted)).alias("pos", "gram")
        grams = rows.select("row", "doc_id", F.size("words").cast("bigint").alias("n_words"), every)
        grams = grams.withColumns({f"w{i}": plain(F.col(f"gram.w{i}")) for i in range(k)}).withColumn("hash", F.xxhash64(*[f"w{i}" for i in range(k)]))
        known = template_grams(docs.sparkSession, k)
        equal = grams.hash == known.hash
        for i in range(k):
            equal &= grams[f"w{i}"] == known[f"t{i}"]
        found = grams.join(F.broadcast(known), equal, "left" if k == SHORT else "inner")
        if k == SHORT:
            found = found.where(F.col("template").isNotNull() | (F.coalesce(F.col("pos"), F.lit(0)) == 0))
        return found.select("row", "doc_id", "n_words", "template", "label", "base", "k", "grams", "at", "pos")

    hits = met(SHORT).union(met(LONG))

    diagonals = (
        hits.groupBy("row", "doc_id", "n_words", "template", "label", "base", "k", "grams", (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(F.collect_set("at").alias("ats"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > SHIFT).cast("int"), F.lit(1))
    bands = diagonals.withColumn("apart", apart).withColumn("band", F.sum("apart").over(order))
    # A diagonal stands for itself, and for its part in the band of its neighbours.
    alone = F.size("ats") / F.col("grams")
    merged = (
        bands.groupBy("row", "doc_id", "n_words", "template", "label", "base", "k", "grams", "band")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("ats"))).alias("all_ats"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.collect_list(F.when(F.size("ats") == F.col("grams"), F.col("diagonal"))).alias("exact"),
            F.max(F.struct(alone.alias("coverage"), (-F.col("lo")).alias("lo"), F.col("hi"))).alias("best"),
        )
    )
    together = F.size("all_ats") / F.col("grams")
    close = (F.col("hi") - F.col("lo") + 1) <= F.col("grams") * 1.5
    span = F.when(close & (together >= F.col("best.coverage")), F.struct(together.alias("coverage"), F.col("lo"), (F.col("hi") - F.col("lo") + F.col("k")).alias("n")))
    span = F.coalesce(span, F.struct(F.col("best.coverage"), (-F.col("best.lo")).alias("lo"), (F.col("best.hi") + F.col("best.lo") + F.col("k")).alias("n")))
    merged = merged.withColumn("span", span)
    sound = F.when(F.col("base"), F.size("exact") > 0).otherwise(F.col("span.coverage") >= COVERAGE)
    starts = F.when(F.col("base"), F.col("exact"))
    listed = F.when(sound, F.struct("label", F.col("span.lo").cast("bigint").alias("first_word"), F.col("span.n").cast("bigint").alias("n_words"), F.round("span.coverage", 4).alias("coverage")))
    out = merged.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.coalesce(F.sum(F.size(starts).cast("bigint") * F.col("base").cast("bigint")), F.lit(0)).alias("n_base"),
        F.min(F.array_min(starts)).cast("bigint").alias("first_word"),
        F.max(F.array_max(starts)).cast("bigint").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(sound & F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(sound, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(sound, F.least(F.lit(1.0), F.round("span.coverage", 4)))), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(listed)).alias("spans"),
    )
    return out.drop("row")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, notices and texts in all documents."""
    return scan(table(spark, sf_dir, "documents")).drop("spans")


def _oracle() -> str:
    values = []
    for t, label, base, k, n, at, words in templates():
        named = [f"'{w}'" for w in words] + ["null"] * (LONG - k)
        values.append(f"({t}, '{label}', {base}, {k}, {n}, {at}, {', '.join(named)})")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with t(template, label, base, k, grams, pos, t1, t2, t3, t4) as (values {', '.join(values)}),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from documents),
g as (select doc_id, p - 1 as p, ws[p] as a, ws[p + 1] as b, ws[p + 2] as c, ws[p + 3] as d from (select doc_id, ws, unnest(range(1, len(ws))) as p from d)),
hit as (select doc_id, template, label, base, grams, t.pos as tpos, g.p, g.p - t.pos as diagonal from g join t on k = 2 and a = t1 and b = t2
  union all select doc_id, template, label, base, grams, t.pos, g.p, g.p - t.pos from g join t on k = 4 and a = t1 and b = t2 and c = t3 and d = t4),
diag as (select doc_id, template, label, base, grams, diagonal, count(*) as n, min(p) as lo, max(p) as hi from hit group by all),
flag as (select *, case when diagonal - lag(diagonal) over (partition by doc_id, template order by diagonal) <= {SHIFT} then 0 else 1 end as apart from diag),
band as (select *, sum(apart) over (partition by doc_id, template order by diagonal) as band from flag),
votes as (select b.doc_id, b.template, b.band, count(distinct tpos) as n_all from hit h join band b using (doc_id, template, diagonal) group by all),
merged as (select doc_id, template, label, base, grams, band, min(lo) as lo, max(hi) as hi, max(n / grams) as best,
  count(*) filter (n = grams) as n_exact, min(diagonal) filter (n = grams) as first_exact, max(diagonal) filter (n = grams) as last_exact
  from band group by all),
spans as (select *, case when hi - lo + 1 <= grams * 1.5 then greatest(n_all / grams, best) else best end as coverage from merged join votes using (doc_id, template, band)),
sound as (select *, case when base then n_exact > 0 else coverage >= {COVERAGE} end as sound from spans),
per as (select doc_id, sum(n_exact) filter (base)::bigint as n_base, min(first_exact) filter (base)::bigint as first_word, max(last_exact) filter (base)::bigint as last_word,
  string_agg(distinct label, ',' order by label) filter (base and sound) as base_labels, string_agg(distinct label, ',' order by label) filter (sound) as labels,
  max(least(1.0, round(coverage::double, 4))) filter (sound) as score from sound group by doc_id)
select doc_id, len(ws)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from d left join per using (doc_id)"""


QUERIES = {"op10_license_scan": op10_license_scan}
ORACLES = {"op10_license_scan": _oracle()}
