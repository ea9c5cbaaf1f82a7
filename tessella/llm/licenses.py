"""License scans: MinHash bands over overlapping windows, then exact shingle containment. DataFrame functions only."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, text_key

# The notices to look for, by name.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "mit-line": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "bsd-3-clause-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "lgpl-3.0-notice": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "agpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "epl-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}

WORD = "[\\p{L}\\p{N}]+"
#: Bands of one MinHash row each: a window of similarity s to a template is missed with probability
#: (1-s)^BANDS. A window that holds 4 in 5 of a template's shingles has s of 0.5 at least: 2 in 10^5.
BANDS = 16
#: Shingles of a text that a row holds windows of; such rows for each task.
BLOCK, BLOCKS_A_TASK = 4096, 256


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def anchor_words(words: list[str], shingle: int, threshold: float) -> set[str]:
    """Words of which every text that holds ``threshold`` of the template's shingles has one at least.

    Such a text lacks fewer shingles than the anchors' shingles are, so it has one of those, and with
    it an anchor. Longer words come first, as texts without a notice seldom have them.
    """
    shingles = list(dict.fromkeys(tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)))
    spare = len(shingles) - -(-threshold * len(shingles) // 1)
    chosen: set[str] = set()
    covered: set[tuple[str, ...]] = set()
    for w in sorted(set(words), key=lambda w: (-len(w), w)):
        own = {s for s in shingles if w in s}
        if own - covered:
            chosen.add(w)
            covered |= own
        if len(covered) > spare:
            return chosen
    raise ValueError(f"templates need {shingle} words at least")


def _shingles(words: Column, shingle: int) -> Column:
    """Hashes of an array's word shingles, empty if it has fewer words."""
    count = F.size(words) - shingle + 1
    starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(words, i, shingle), " ")))


def _bands(shingles: Column) -> Column:
    """The least of each band's hash over the shingles."""

    def least(band: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(F.lit(band), h)))

    return F.array(*(F.struct(F.lit(b).alias("band"), least(b).alias("least")) for b in range(BANDS)))


def _template_table(spark: SparkSession, templates: dict[str, str], shingle: int) -> DataFrame:
    """``(license, total, own, bands)``: one row per template, made in the JVM."""
    rows = F.array(*(F.struct(F.lit(n).alias("license"), F.lit(" ".join(template_words(t))).alias("text")) for n, t in templates.items()))
    table = spark.range(1).select(F.explode(rows).alias("t")).select("t.license", F.array_distinct(_shingles(F.split("t.text", " "), shingle)).alias("own"))
    return table.select("license", F.size("own").alias("total"), "own", _bands(F.col("own")).alias("bands"))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id>, text_key, license, containment, word)``: the templates that stand in each text.

    Words are runs of letters and digits, lower-cased. A template of n shingles is sought in windows
    of n shingles that start every n/8 (at least every) words; windows that share a band's least hash
    with it are candidates, and a candidate counts if the window, widened by a step on either side,
    contains ``threshold`` of the template's distinct shingles, exactly compared. Windows without an
    anchor word cannot reach the threshold and are not made: a text's windows lie about its anchor
    words. One row per text and template, with the highest containment and the first word (from 0)
    of the first such window. Texts without a match, null and empty ones among them, give no row;
    rows that repeat both id and text count as one document; null ids are kept.
    """
    templates = TEMPLATES if templates is None else templates
    words = {n: template_words(t) for n, t in templates.items()}
    anchors = sorted(set().union(*(anchor_words(w, shingle, threshold) for w in words.values())))
    sizes = sorted({len({tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)}) for w in words.values()})
    # The gate: a text with no anchor as a whole word has no match. A plain search for parts of
    # anchors comes before the pattern; the array makes the lower-cased text once.
    pattern = f"(?<![\\p{{L}}\\p{{N}}])(?:{'|'.join(map(re.escape, anchors))})(?![\\p{{L}}\\p{{N}}])"
    parts = _shortest_parts(anchors)
    low = F.lower(F.col(text_col))
    gate = F.exists(F.array(low), lambda t: reduce(Column.__or__, (t.contains(a) for a in parts)) & t.rlike(pattern))
    found = docs.filter(gate).select(F.col(id_col).alias("_id"), text_key(text_col).alias("_key"), F.regexp_extract_all(low, F.lit(WORD), 0).alias("words"))
    # Written, as the optimizer would else put these arrays' definitions into filters it derives from
    # explode, and compute them again for each element.
    found = materialize(found, "words")
    found = found.select("_id", "_key", _shingles(F.col("words"), shingle).alias("sh"), F.filter(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0))), lambda i: F.get(F.col("words"), i).isin(anchors)).alias("at"))
    found = materialize(found, "shingles")
    # Blocks of a text's shingles, each with what windows that start in it may reach, so that a row and
    # a task's work are bounded however long a text is. Blocks far from anchors hold no window.
    steps = {n: max(1, n // 8) for n in sizes}
    back, ahead = max(steps.values(), default=1), max((n + steps[n] for n in sizes), default=1)

    def block_of(b: Column) -> Column:
        low, high = b * BLOCK, (b + 1) * BLOCK
        base = F.greatest(low - back, F.lit(0))
        near = F.filter("at", lambda p: (p >= low) & (p < high + ahead + shingle))
        return F.struct(low.alias("low"), high.alias("high"), base.alias("base"), near.alias("at"), F.slice("sh", base + 1, high + ahead - base).alias("sh"))

    last = F.greatest(F.size("sh") - 1, F.lit(0))
    blocks = F.transform(F.sequence(F.lit(0), F.floor(last / BLOCK).cast("int")), block_of)
    found = found.select("_id", "_key", last.alias("last"), F.explode(F.filter(blocks, lambda b: F.size(b["at"]) > 0)).alias("b")).select("_id", "_key", "last", "b.*")
    found = materialize(found, "blocks")
    # What follows costs far more than reading: a task for each few blocks.
    found = found.repartition(max(1, -(-found.count() // BLOCKS_A_TASK)))

    def windows_of(n: int) -> Column:
        """Windows [s, s+n) of shingles that hold a shingle with an anchor, s a multiple of the step, in the block."""
        step = steps[n]
        whole = F.col("last")
        about = F.transform("at", lambda p: F.sequence(F.floor(F.least(F.greatest(p - (n + shingle - 2), F.lit(0)), whole) / step).cast("int"), F.floor(F.least(p, whole) / step).cast("int")))
        starts = F.filter(F.array_distinct(F.flatten(about)), lambda k: (k * step >= F.col("low")) & (k * step < F.col("high")))
        return F.transform(starts, lambda k: F.struct(F.lit(n).alias("n"), (k * step).alias("start"), F.slice("sh", k * step - F.col("base") + 1, F.lit(n)).alias("window"), F.slice("sh", F.greatest(k * step - step, F.lit(0)) - F.col("base") + 1, F.lit(n + 2 * step)).alias("wide")))

    windows = found.select("_id", "_key", F.explode(F.concat(*map(windows_of, sizes))).alias("w"))
    windows = windows.select("_id", "_key", "w.n", "w.start", "w.wide", F.explode(_bands(F.col("w.window"))).alias("b"))
    table = _template_table(docs.sparkSession, templates, shingle)
    # The templates: a row for each and each band, a number the caller's templates set.
    keys = F.broadcast(table.select("license", F.col("total").alias("n"), F.explode("bands").alias("b")).groupBy("n", "b.band", "b.least").agg(F.collect_set("license").alias("licenses")))
    hits = windows.join(keys, (F.col("b.band") == keys["band"]) & (F.col("b.least") == keys["least"]) & (windows["n"] == keys["n"]))
    hits = hits.select("_id", "_key", "start", "wide", F.explode("licenses").alias("license"))
    own = F.broadcast(table.select("license", "total", "own"))
    judged = hits.join(own, "license").withColumn("containment", F.size(F.array_intersect("wide", "own")) / F.col("total"))
    best = judged.filter(F.col("containment") >= threshold).groupBy("_id", "_key", "license").agg(F.max(F.struct(F.col("containment"), (-F.col("start")).alias("minus"))).alias("best"))
    return best.select(F.col("_id").alias(id_col), F.col("_key").alias("text_key"), "license", F.col("best.containment").alias("containment"), (-F.col("best.minus")).alias("word"))


def _shortest_parts(anchors: list[str]) -> list[str]:
    """The anchors that contain no other: a plain search for them goes before the pattern."""
    return [a for a in anchors if not any(b != a and b in a for b in anchors)]
