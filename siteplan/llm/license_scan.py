"""License scans: MinHash bands over overlapping text windows, verified by shingle containment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, whole_text, words
from .shingles import WIDTH, positions_of, shingle_hashes

#: Notices by licence (fixed values: the wording licences ask for, or people commonly use).
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files, to deal in the Software without restriction",
    "MIT-body": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
    "in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
    "either express or implied. See the License for the specific language governing permissions and limitations under "
    "the License.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
    "option) any later version.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
    "(at your option) any later version.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "(at your option) any later version.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
    "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "EPL-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse "
    "Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Zlib-grant": "This software is provided 'as-is', without any express or implied warranty. In no event will the "
    "authors be held liable for any damages arising from the use of this software.",
    "BSL-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
    "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for "
    "any purpose, commercial or non-commercial, and by any means.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring "
    "rights to this work.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
    "International License.",
    "BSD-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "BSD-disclaimer": 'This software is provided by the copyright holders and contributors "as is" and any express or '
    "implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a "
    "particular purpose are disclaimed.",
}
MAX_TEMPLATES = 1000
#: A window is up to four times its template and holds it whole, so their Jaccard similarity
#: is 0.2 or more at containment 0.8; with one row in each of 48 bands they share a band
#: value with probability 1 - 0.8 ** 48 > 0.9999.
BANDS = 48


def license_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return words(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def band_values(hashes: Column) -> Column:
    """Per band the least hash of the shingles."""

    def at(band: int) -> Column:
        least = F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band))))
        return F.struct(F.lit(band).alias("band"), least.alias("value"))

    return F.array(*[at(b) for b in range(BANDS)])


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license_id, license_hs, n, step): distinct shingles and the step of the windows that hold them."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"{len(templates)} templates; at most {MAX_TEMPLATES}")
    given = spark.createDataFrame(sorted(templates.items()), "license_id string, notice string")
    hashes = given.select("license_id", F.array_distinct(shingle_hashes(license_words(F.col("notice")))).alias("license_hs"))
    sized = hashes.filter(F.size("license_hs") > 0).withColumn("n", F.size("license_hs"))
    return sized.withColumn("step", F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("int"))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, license_id, containment, start): licences named in documents.

    Text and templates are lower-cased runs of letters and digits, in shingles of five words.
    For templates of n shingles windows take 2 * step positions, every step positions, where
    step is the power of two from n on. A licence is found where a window holds percent / 100
    or more of the template's distinct shingles. The best window per document and licence is
    given (ties: the first); start is the position of its first word. Licences whose wording
    differs by a word or two, as versions do, may both be found; containment tells them apart.

    Null and empty texts and templates of fewer than five words match nothing; repeated
    documents give one row per distinct text; an empty table gives no row; other columns are
    not read. Only windows with at least one template shingle are looked at, as others hold
    none. What is broadcast is bounded: BANDS short rows for each of at most MAX_TEMPLATES
    templates, and their shingles up to BROADCAST_SHINGLES rows; beyond they are shuffled.
    """
    spark = docs.sparkSession
    known = stored(template_table(spark, TEMPLATES if templates is None else templates), "templates")
    shingles = known.select("step", F.explode("license_hs").alias("h")).distinct()
    texts = docs.select("doc_id", F.xxhash64(whole_text()).alias("text_hash"), "text")
    words_of = license_words(whole_text())
    hits = positions_of(texts, words_of, shingles, shingles.count())
    turn = F.floor(F.col("pos") / F.col("step")).cast("int")
    places = hits.select("doc_id", "text_hash", "step", F.explode(F.array(turn, turn - 1)).alias("turn")).filter("turn >= 0")
    per_doc = stored(
        places.groupBy(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash")).agg(
            F.collect_set(F.struct("step", "turn")).alias("places")
        ),
        "license-places",
    )
    held = texts.join(per_doc, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash")))
    held = held.select("doc_id", "text_hash", "places", shingle_hashes(words_of).alias("hs"))
    held = held.select("doc_id", "text_hash", "hs", F.explode("places").alias("p"))
    start = F.col("p.turn") * F.col("p.step")
    windows = held.select(
        "doc_id", "text_hash", F.col("p.step").alias("step"), start.alias("start"),
        F.slice("hs", start + 1, F.col("p.step") * 2).alias("window"),
    ).distinct()
    bands = known.select("license_id", "step", F.explode(band_values(F.col("license_hs"))).alias("at"))
    bands = bands.select("license_id", "step", "at.band", "at.value")
    near = windows.select("*", F.explode(band_values(F.col("window"))).alias("at")).select("*", "at.band", "at.value").drop("at")
    near = near.join(F.broadcast(bands), ["step", "band", "value"])
    near = near.join(known.select("license_id", "license_hs", "n"), "license_id")
    near = near.select("doc_id", "text_hash", "start", "license_id", "n", F.size(F.array_intersect("window", "license_hs")).alias("common"))
    found = near.filter(F.col("common") * 100 >= F.col("n") * percent)
    best = F.max(F.struct((F.col("common") / F.col("n")).alias("containment"), (-F.col("start")).alias("before"))).alias("best")
    return found.groupBy("doc_id", "text_hash", "license_id").agg(best).select(
        "doc_id", "text_hash", "license_id", "best.containment", (-F.col("best.before")).cast("long").alias("start")
    )


def oracle(docs: str = "documents", templates: dict[str, str] | None = None, percent: int = 80) -> str:
    """(doc_id, license_id, containment, start) in SQL: every window against every template."""
    values = ", ".join(
        f"('{i}', '{t.replace(chr(39), chr(39) * 2)}')" for i, t in sorted((TEMPLATES if templates is None else templates).items())
    )
    tokens = lambda c: (
        f"list_filter(regexp_split_to_array(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
    )
    parts = " || ' ' || ".join(f"w[p + {k}]" for k in range(1, WIDTH + 1))
    shingled = lambda i, source: (
        f"SELECT {i}, p, {parts} AS s FROM (SELECT {i}, w, unnest(range(0, len(w) - {WIDTH - 1})) AS p FROM ({source}) a) b"
    )
    return f"""
    WITH notices AS (
      SELECT DISTINCT license_id, s FROM ({shingled('license_id', f"SELECT license_id, {tokens('notice')} AS w FROM (VALUES {values}) v(license_id, notice)")}) c),
    sized AS (SELECT license_id, count(*) AS n, CAST(pow(2, ceil(log2(count(*)))) AS BIGINT) AS step FROM notices GROUP BY 1),
    hits AS (
      SELECT d.doc_id, z.license_id, z.n, z.step, d.p, d.s
      FROM ({shingled('doc_id', f"SELECT doc_id, {tokens('text')} AS w FROM {docs}")}) d
      JOIN notices t ON t.s = d.s JOIN sized z ON z.license_id = t.license_id),
    held AS (
      SELECT doc_id, license_id, n, (p // step - back) * step AS start, s
      FROM (SELECT *, unnest([0, 1]) AS back FROM hits) b WHERE p // step - back >= 0),
    counted AS (SELECT doc_id, license_id, n, start, count(DISTINCT s) AS common FROM held GROUP BY ALL)
    SELECT doc_id, license_id, max(common / n) AS containment,
           CAST(arg_min(start, row(-(common / n), start)) AS BIGINT) AS start
    FROM counted WHERE 100 * common >= {percent} * n GROUP BY doc_id, license_id"""
