"""License scans: texts and lines compared to licence templates by Dice coefficient over word bigrams."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import common

THRESHOLD = 0.8
#: Templates are broadcast; a longer list than this is refused.
MOST_TEMPLATES = 2000
NO_WORD = "[^\\p{L}\\p{N}]+"

_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(name: str, version: str, kind: str = "free software") -> str:
    return (
        f"This program is {kind}: you can redistribute it and/or modify it under the terms of the {name} as published by the "
        f"Free Software Foundation, either version {version} of the License, or (at your option) any later version. This "
        f"program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        f"warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. You should have "
        f"received a copy of the {name} along with this program. If not, see <https://www.gnu.org/licenses/>."
    )


#: Fixed values: (licence, template) pairs, published licence texts, headers and one-line notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. " + _WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
            "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
            "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written permission. " + _BSD_TAIL),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
             "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
             "to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim "
             "that you wrote the original software. If you use this software in a product, an acknowledgment in the product "
             "documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as "
             "such, and must not be misrepresented as being the original software. 3. This notice may not be removed or "
             "altered from any source distribution."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("GPL-2.0-or-later", _gnu("GNU General Public License", "2")),
    ("GPL-3.0-or-later", _gnu("GNU General Public License", "3")),
    ("LGPL-3.0-or-later", _gnu("GNU Lesser General Public License", "3")),
    ("AGPL-3.0-or-later", _gnu("GNU Affero General Public License", "3")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)


def template_bigrams(text: str) -> Counter:
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return Counter(" ".join(x) for x in zip(words, words[1:]))


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """The sizes that a text may have to reach ``threshold`` with a template of ``n`` bigrams."""
    return math.ceil(n * threshold / (2 - threshold) - 1e-9), math.floor(n * (2 - threshold) / threshold + 1e-9)


def anchors(bag: Counter, threshold: float) -> list[str]:
    """Bigrams of which every text that reaches ``threshold`` has at least one.

    Such a text shares at least the lower size bound, so it misses less than any set of the template's bigrams that
    holds one more than may be missing. Long bigrams go first, as they are rarer.
    """
    n = sum(bag.values())
    missing = n - size_bounds(n, threshold)[0]
    chosen, held = [], 0
    for bigram in sorted(bag, key=lambda x: (-len(x), x)):
        if held > missing:
            break
        chosen.append(bigram)
        held += bag[bigram]
    return chosen


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), NO_WORD), lambda x: x != "")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """The best template of every line, and of every whole text, that reaches the Dice coefficient ``threshold``.

    Returns ``key``, ``line`` (from 1; 0 for a whole text of several lines), ``template`` (index), ``license``,
    ``n_bigrams``, ``n_shared`` and ``dice``. Bigrams are counted with their repeats, so the number of words gives the
    size, and the size bounds of the templates prune before any bigram is made. Of templates that fit equally well the
    first one counts. Null and empty texts and texts of one word have no bigrams and no rows. Rows with equal or null keys are
    scanned each, and those that are equal in key and text once; a null key stays null.
    """
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"at most {MOST_TEMPLATES} templates, as they are broadcast")
    spark = docs.sparkSession
    bags = [template_bigrams(x) for _, x in templates]
    sizes = [sum(x.values()) for x in bags]
    bounds = [size_bounds(n, threshold) for n in sizes]
    least, most = min(a for a, _ in bounds), max(b for _, b in bounds)
    rows = [
        (anchor, number, name, sizes[number], *bounds[number], [{"b": b, "n": n} for b, n in bags[number].items()])
        for number, (name, _) in enumerate(templates)
        for anchor in anchors(bags[number], threshold)
    ]
    table = spark.createDataFrame(rows, "anchor string, template int, license string, size int, lo int, hi int, bag array<struct<b:string,n:int>>")

    by_line = F.transform(F.split(docs[text], "\n"), lambda x, i: F.struct((i + 1).alias("line"), words(x).alias("words")))
    own = F.struct(F.xxhash64(docs[text]).alias("a"), F.xxhash64(F.lit(1), docs[text]).alias("b"))  # tells rows of one key apart
    lines = docs.select(docs[key].alias("k"), own.alias("own"), by_line.alias("lines"))
    total = F.aggregate("lines", F.lit(0), lambda n, x: n + F.size(x["words"]))
    held = F.size(F.filter("lines", lambda x: F.size(x["words"]) > 0))
    whole = F.struct(F.lit(0).alias("line"), F.flatten(F.transform("lines", lambda x: x["words"])).alias("words"))
    fits = (held > 1) & total.between(least + 1, most + 1)
    lines = lines.withColumn("lines", F.when(fits, F.concat("lines", F.array(whole))).otherwise(F.col("lines")))
    # explode_outer: explode would have Spark filter on the array first and so make it twice.
    units = lines.select("k", "own", F.explode_outer("lines").alias("u")).select("k", "own", "u.line", "u.words", (F.size("u.words") - 1).alias("n"))
    units = units.filter(F.col("n").between(least, most))
    units = units.withColumn("bigrams", F.zip_with(F.expr("slice(words, 1, greatest(n, 0))"), F.expr("slice(words, 2, greatest(n, 0))"), lambda a, b: F.concat_ws(" ", a, b)))
    single = units.select("k", "own", "line", "n", "bigrams", F.explode_outer("bigrams").alias("anchor"))
    found = single.join(F.broadcast(table), "anchor").filter("n BETWEEN lo AND hi")
    shared = F.aggregate("bag", F.lit(0), lambda s, t: s + F.least(t["n"], F.size(F.filter("bigrams", lambda b: b == t["b"]))))
    found = found.withColumn("shared", shared).withColumn("dice", 2.0 * F.col("shared") / (F.col("n") + F.col("size")))
    found = found.filter(F.col("dice") >= threshold)
    best = found.groupBy("k", "own", "line", "n").agg(F.min(F.struct((-F.col("dice")).alias("d"), "template", "license", "shared")).alias("m"))
    best = best.groupBy("k", "own", "line").agg(F.min(F.struct("m.d", "m.template", "m.license", "m.shared", "n")).alias("m"))
    return best.select(
        F.col("k").alias(key), "line", "m.template", "m.license", F.col("m.n").alias("n_bigrams"), F.col("m.shared").alias("n_shared"),
        (-F.col("m.d")).alias("dice"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return scan(common.table(spark, folder, "documents"))


def _sql() -> str:
    quoted = ", ".join(f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(TEMPLATES))
    split = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
    grams = "SELECT {0}, ws[i] || ' ' || ws[i + 1] AS b, count(*) AS n FROM (SELECT *, unnest(range(1, len(ws))) AS i FROM {1}) GROUP BY ALL"
    return f"""
WITH t AS (SELECT template, license, {split.format('body')} AS ws FROM (VALUES {quoted}) v(template, license, body)),
x AS (SELECT row_number() OVER () AS row, doc_id, text FROM (SELECT DISTINCT doc_id, text FROM documents)),
l AS (SELECT row, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM x),
lw AS (SELECT row, line, {split.format('s')} AS ws FROM l),
w AS (SELECT row, 0 AS line, {split.format('text')} AS ws FROM x
      WHERE row IN (SELECT row FROM lw WHERE len(ws) > 0 GROUP BY row HAVING count(*) > 1)),
u AS (SELECT * FROM lw UNION ALL SELECT * FROM w),
ug AS ({grams.format('row, line', 'u')}), tg AS ({grams.format('template', 't')}),
o AS (SELECT row, line, template, sum(least(ug.n, tg.n)) AS shared FROM ug JOIN tg USING (b) GROUP BY ALL),
d AS (SELECT o.*, license, len(u.ws) - 1 AS n, 2.0::DOUBLE * shared / (len(u.ws) + len(t.ws) - 2) AS dice
      FROM o JOIN u USING (row, line) JOIN t USING (template)),
r AS (SELECT *, row_number() OVER (PARTITION BY row, line ORDER BY dice DESC, template) AS k FROM d WHERE dice >= {THRESHOLD})
SELECT doc_id, line, template, license, n AS n_bigrams, shared AS n_shared, dice FROM r JOIN x USING (row) WHERE k = 1"""


SQL = _sql()
