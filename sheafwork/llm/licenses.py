"""License scans over overlapping word windows; DataFrame functions only.

Texts are lower-cased and cut into words (runs of letters and digits). A template of n words is sought in windows of
2n words, one every n/2, so that every passage of up to 1.5n words lies whole in a window. MinHash bands (one row a
band) of a window's shingles of five words retrieve templates with an equal band; ``bands_for`` sets their number so
that a window which holds 0.8 of a template's shingles is missed with a chance below ``MISS``. Retrieved windows are
then verified: the exact part of the template's shingles that the window contains must be ``CONTAINMENT`` or more.

Work is saved without loss by anchors: words of a template such that the shingles without them make up less than
0.8 of it. Texts and windows without an anchor of any template can't hold it and are left out first.

Defined cases: null and empty texts match nothing; templates of fewer than five words have one shingle, the whole
sequence; a null doc_id keeps its matches; rows that repeat a doc_id are counted together; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE, CONTAINMENT, MISS = 5, 0.8, 1e-6
# Licence notices and whole licence texts by their SPDX ids.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
    # Whole licence texts and whole file headers.
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def shingles_of(words: list[str], size: int = SHINGLE) -> list[str]:
    size = min(size, len(words))
    return sorted({" ".join(words[k : k + size]) for k in range(len(words) - size + 1)})


def bands_for(template_shingles: int, window_shingles: int, containment: float = CONTAINMENT, miss: float = MISS) -> int:
    """Bands of one row so that the least similarity of a window that must be found is missed with a chance below ``miss``."""
    shared = math.ceil(containment * template_shingles)
    similarity = shared / (window_shingles + template_shingles - shared)
    return 1 if similarity >= 1 else math.ceil(math.log(miss) / math.log(1 - similarity))


def anchors_of(words: list[str], common: dict[str, int], containment: float = CONTAINMENT) -> list[str]:
    """Words so that the shingles without any of them make up less than ``containment``; long ones, which are rare, first."""
    left, chosen, total = shingles_of(words), [], len(shingles_of(words))
    while len(left) >= containment * total:
        having = {w: [s for s in left if w in s.split(" ")] for w in set(words)}
        having = {w: s for w, s in having.items() if s}
        tier = {w: -min(len(w), 8) // 2 for w in having}
        best = min(having, key=lambda w: (tier[w], len(left) - len(having[w]) >= containment * total, common[w], -len(having[w]), -len(w), w))
        chosen.append(best)
        left = [s for s in left if s not in having[best]]
    return chosen


def prepared(templates=TEMPLATES) -> list[dict]:
    spelt = [words_of(t) for _, t in templates]
    common = {w: sum(w in s for s in spelt) for s in spelt for w in s}
    out = []
    for number, ((license_id, _), words) in enumerate(zip(templates, spelt, strict=True)):
        size, own = min(SHINGLE, len(words)), shingles_of(words)
        window, step = 2 * len(words), -(-len(words) // 2)
        out.append({"template": number, "license": license_id, "size": size, "shingles": own, "window": window, "step": step, "anchors": anchors_of(words, common), "bands": bands_for(len(own), window - size + 1)})
    return out


def _signature(shingles: Column, bands: Column) -> Column:
    hashed = F.transform(shingles, lambda s: F.xxhash64(s))
    return F.transform(F.sequence(F.lit(0), bands - 1), lambda b: F.array_min(F.transform(hashed, lambda h: F.xxhash64(h, b))))


def _places(words: Column, wanted: list[str]) -> Column:
    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(wanted))


def _around(window: int, step: int):
    """Numbers of the windows that hold a place."""
    return lambda p: F.sequence(F.greatest(F.lit(0), F.floor((p - window) / step).cast("int") + 1), F.floor(p / step).cast("int"))


def _window(words: Column, shape: int, window: int, step: int):
    return lambda q: F.struct(F.lit(shape).alias("shape"), F.slice(words, q * step + 1, F.lit(window)).alias("words"))


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, template (its number), license, containment of every document that holds a template, best window each."""
    own = prepared(templates)
    spark = docs.sparkSession
    lower = F.lower(F.col("text").cast("string"))
    anchors = sorted({a for t in own for a in t["anchors"]})
    held = F.lit(False)
    for a in anchors:
        held = held | lower.contains(a)
    words = docs.where(held).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.split(F.trim(F.regexp_replace(lower, r"[^\p{L}\p{N}]+", " ")), " ").alias("w"))
    # Templates of one shape share their windows.
    shapes: dict[tuple, list[dict]] = {}
    for t in own:
        shapes.setdefault((t["size"], t["window"], t["step"]), []).append(t)
    w, starts = F.col("w"), []
    for k, ((_, window, step), group) in enumerate(shapes.items()):
        mine = sorted({a for t in group for a in t["anchors"]})
        begins = F.array_distinct(F.flatten(F.transform(_places(w, mine), _around(window, step))))
        starts.append(F.transform(begins, _window(w, k, window, step)))
    # Only a text's windows go through the explosion, not the text.
    windows = words.select("doc_id", F.explode(F.concat(*starts)).alias("x")).select("doc_id", "x.shape", "x.words")
    size = F.element_at(F.array(*[F.lit(s) for s, _, _ in shapes]), F.col("shape") + 1)
    bands = F.element_at(F.array(*[F.lit(max(t["bands"] for t in g)) for g in shapes.values()]), F.col("shape") + 1)
    spelt = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - size + 1)), lambda i: F.concat_ws(" ", F.slice("words", i, size))))
    windows = windows.select("doc_id", "shape", spelt.alias("s")).withColumn("bands", _signature(F.col("s"), bands))
    # One row a template, so the broadcast is as small as the table above.
    rows = [(k, t["template"], t["license"], t["shingles"]) for k, g in enumerate(shapes.values()) for t in g]
    table = spark.createDataFrame(rows, "shape int, template int, license string, ts array<string>").withColumn("tb", _signature(F.col("ts"), bands))
    equal = F.exists(F.zip_with("bands", "tb", lambda a, b: a == b), lambda x: x)
    found = windows.join(F.broadcast(table), "shape").where(equal)
    part = F.size(F.array_intersect("s", "ts")) / F.size("ts")
    return found.withColumn("containment", part).where(F.col("containment") >= CONTAINMENT).groupBy("doc_id", "template", "license").agg(F.max("containment").alias("containment"))


def oracle(templates=TEMPLATES) -> str:
    """The same by exact containment in every window, without bands and anchors, as DuckDB SQL."""
    rows = ", ".join(f"({t['template']}, '{t['license']}', {t['size']}, {t['window']}, {t['step']}, {len(t['shingles'])}, '{s}')" for t in prepared(templates) for s in t["shingles"])
    return f"""
WITH t(template, license, size, win, step, n, shingle) AS (VALUES {rows}),
w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
s AS (
  SELECT doc_id, p, k, list_aggregate(w[p + 1 : p + k], 'string_agg', ' ') AS shingle, len(w) AS total
  FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS p FROM w, (SELECT DISTINCT size AS k FROM t) sizes WHERE len(w) >= k)
),
m AS (
  SELECT s.doc_id, t.template, t.license, t.n, t.shingle, unnest(range(greatest(0, (s.p + t.size - t.win + t.step - 1) // t.step), s.p // t.step + 1)) AS q
  FROM s JOIN t ON t.size = s.k AND t.shingle = s.shingle
),
c AS (SELECT doc_id, template, license, q, count(DISTINCT shingle) / any_value(n) AS containment FROM m GROUP BY doc_id, template, license, q)
SELECT doc_id, CAST(template AS INTEGER) AS template, license, max(containment) AS containment FROM c GROUP BY doc_id, template, license HAVING max(containment) >= {CONTAINMENT}
"""
