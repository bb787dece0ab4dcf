"""License scan: TF-IDF cosine to templates, then inheritance from the nearest licensed directory.

Every line of a file is a unit, and so are every block of lines between blank ones (a wrapped header) and the whole text of a file
with a licence file's name. A unit's words are compared with each template's by the cosine of their TF-IDF weights. Words and numbers that
tell licences apart veto: a licence needs some of them and bears none of others'. A unit whose best licence isn't ahead of the second by a margin, or
whose likely ones are all vetoed, is ambiguous. A file's licence is its best unit's, if that reaches the threshold. A file without one takes that of the
nearest directory above it, its own first, in which a licence file has one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, stored, words_of

# Notices as they stand in source files, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal Public Domain Dedication"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)
# The Creative Commons 4.0 licences' parts, short and in words.
CREATIVE_COMMONS = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
TEMPLATES = tuple((f"CC-{short}-4.0", text.format(words=words, short=short.replace("-", " ", 1))) for short, words in CREATIVE_COMMONS for text in ("This work is licensed under a Creative Commons {words} 4.0 International License.", "Creative Commons {words} 4.0 International", "Licensed under CC {short} 4.0.")) + TEMPLATES
_GNU, _CC = ("lesser", "library", "lgpl", "affero", "agpl"), {"NC": ("noncommercial", "nc"), "SA": ("sharealike", "sa"), "ND": ("noderivatives", "noderivs", "nd")}
#: By licence: sets of words of each of which a unit must have one, and words that it must not have. Fixed values.
RULES = {
    "GPL-2.0": ((("gpl", "general", "gplv2"), ("2", "v2", "gplv2")), (*_GNU, "3", "v3")),
    "GPL-3.0": ((("gpl", "general", "gplv3"), ("3", "v3", "gplv3")), (*_GNU, "2", "v2")),
    "AGPL-3.0": ((("affero", "agpl", "agplv3"), ("3", "v3", "agplv3")), ("lesser", "lgpl")),
    "LGPL-2.1": ((("lesser", "lgpl"), ("2", "v2")), ("affero", "agpl", "3", "v3")),
    "LGPL-3.0": ((("lesser", "lgpl", "lgplv3"), ("3", "v3", "lgplv3")), ("affero", "agpl", "2", "v2")),
    "BSD-2-Clause": ((), ("endorse", "neither", "style", "3")),
    "BSD-3-Clause": ((("endorse", "neither", "style", "3"),), ("2",)),
    "Apache-2.0": ((("2", "v2", "apache2"),), ()),
    "MPL-2.0": ((("mozilla", "mpl"), ("2", "v2")), ()),
    "EPL-2.0": ((("eclipse", "epl"), ("2", "v2")), ()),
    "CC0-1.0": ((("cc0",),), ()),
    **{f"CC-{short}-4.0": ((("4", "v4"), ("by", "attribution"), *[w for c, w in _CC.items() if c in short.split("-")]), tuple(x for c, w in _CC.items() if c not in short.split("-") for x in w)) for short, _ in CREATIVE_COMMONS},
}
#: How far the best licence of a unit must be ahead of the second.
MARGIN = 0.02
#: What parts blocks of lines.
BLANK_LINES = "(?:\n *){2,}"
# Words that say nothing of a licence.
STOP = ("a", "and", "any", "as", "be", "can", "either", "found", "in", "is", "it", "may", "not", "of", "or", "person", "that", "the", "this", "to", "under", "use", "with", "without", "work", "you", "you're")
LICENCE_FILES = ("license", "licence", "copying", "notice", "unlicense")
SEPARATORS = r"[^0-9A-Za-z\x80-\x{10FFFF}]+"
THRESHOLD = 0.6


def _template_words() -> list[tuple[str, str, dict[str, int]]]:
    import re

    out = []
    for i, (name, text) in enumerate(TEMPLATES):
        counts: dict[str, int] = {}
        for w in re.split(r"[^0-9a-z]+", text.lower()):
            if w and w not in STOP:
                counts[w] = counts.get(w, 0) + 1
        out.append((f"{i:02d}", name, counts))
    return out


def _unit(text: Column, known: list[str]) -> Column:
    """Counts of known words, and how many distinct others the unit has."""

    def of(w: Column) -> Column:
        own = F.filter(w, lambda x: x.isin(known))
        other = F.size(F.array_distinct(F.filter(w, lambda x: ~x.isin(known))))
        return F.struct(let(own, lambda o: F.transform(F.array_distinct(o), lambda t: F.struct(t.alias("term"), F.size(F.filter(o, lambda y: y == t)).alias("tf")))).alias("terms"), other.alias("others"))

    return let(F.filter(words_of(ascii_lower(text), SEPARATORS), lambda x: ~x.isin(list(STOP))), of)


def fitting(words: Column) -> Column:
    """The licences whose words a unit has, and that it has no word against."""
    def has(some: tuple[str, ...]) -> Column:
        return F.arrays_overlap(words, F.array(*[F.lit(w) for w in some]))

    out = []
    for name in sorted({n for n, _ in TEMPLATES}):
        needs, against = RULES.get(name, ((), ()))
        fits = F.lit(True)
        for some in needs:
            fits = fits & has(some)
        out.append(F.when(fits & ~has(against) if against else fits, F.lit(name)))
    return F.array_compact(F.array(*out))


def scan(files: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """key, path, license, score, how (own, inherited, none), source for each row of files(key, path, text).

    idf(t) = ln((N + 1) / (df + 1)) + 1 over all units of the table; a word that no template has counts
    as df = 0. Words are runs of letters and digits, A-Z lower-cased, without stop words. score is the best cosine,
    rounded to six places; of equal ones the first template wins, and license is `ambiguous` where RULES or the margin leave none. source is the licence file inherited from: in a
    directory the best, of equal ones the first path. Null or empty texts have no units; a null path inherits
    nothing. Repeated rows are judged alike; texts of any length are read whole; other columns are ignored, whatever their names; an empty table gives none.
    """
    spark = files.sparkSession
    templates = _template_words()
    known = sorted({w for _, _, c in templates for w in c} | {w for needs, against in RULES.values() for some in (*needs, against) for w in some})
    base = F.lower(F.regexp_extract("path", r"([^/.]*)[^/]*$", 1))
    rows = files.select("key", "path", F.xxhash64("key", "path", "text").alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(base.isin(*LICENCE_FILES), F.lit(False)).alias("is_file"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.trim(x)) > 0)
    blocks = F.filter(F.split("text", BLANK_LINES, -1), lambda x: F.contains(F.btrim(x, F.lit("\n")), F.lit("\n")))
    units = F.concat(lines, blocks, F.when(F.col("is_file"), F.array("text")).otherwise(F.array().cast("array<string>")))
    # a cosine is at most the known words' share of a norm in which all of them are as rare as can be: what stays below the threshold even so is only counted
    def likely(x: Column) -> Column:
        known = F.aggregate(x["u"]["terms"], F.lit(0), lambda n, t: n + t["tf"] * t["tf"])
        return known >= (threshold - 1e-6) ** 2 * (known + x["u"]["others"])

    def parted(all_units: Column) -> Column:
        return F.struct(F.filter(all_units, likely).alias("units"), F.flatten(F.transform(F.filter(all_units, lambda x: ~likely(x)), lambda x: x["u"]["terms"]["term"])).alias("heard"))

    held = let(units, lambda u: F.struct(F.size(u).alias("n"), let(F.filter(F.transform(u, lambda x, i: F.struct(i.alias("i"), _unit(x, known).alias("u"))), lambda s: F.size(s["u"]["terms"]) > 0), parted).alias("p")))
    rows = stored(rows.select("key", "path", "id", "is_file", held.alias("h")).select("key", "path", "id", "is_file", "h.n", "h.p.units", "h.p.heard"), "units")
    n_units = rows.agg(F.sum("n")).first()[0] or 0
    unit = rows.select("id", F.explode("units").alias("s")).distinct().select("id", "s.i", "s.u.others", "s.u.terms")
    term = unit.select("id", "i", "others", F.explode("terms").alias("t")).select("id", "i", "others", "t.term", "t.tf")
    terms = F.concat("heard", F.flatten(F.transform("units", lambda x: x["u"]["terms"]["term"])))
    counted = rows.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    df = dict(counted.collect())  # a row for each word of the templates at most

    def idf(w: str) -> float:
        return math.log((n_units + 1) / (df.get(w, 0) + 1)) + 1

    weights = []
    for no, name, counts in templates:
        norm = math.sqrt(sum((n * idf(w)) ** 2 for w, n in counts.items()))
        weights += [(no, name, w, n * idf(w) / norm) for w, n in counts.items()]
    weight = F.broadcast(spark.createDataFrame(weights, "no string, license string, term string, weight double"))  # the fixed templates' words
    rarity = F.broadcast(spark.createDataFrame([(w, idf(w)) for w in known], "term string, idf double"))
    term = term.join(rarity, "term").withColumn("x", F.col("tf") * F.col("idf"))
    norms = term.groupBy("id", "i", "others").agg(F.sqrt(F.sum(F.col("x") * F.col("x")) + F.col("others") * F.lit(idf("") ** 2)).alias("norm"))
    dots = term.join(weight, "term").groupBy("id", "i", "no", "license").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    scored = dots.join(norms.drop("others"), ["id", "i"]).select("id", "i", "no", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= threshold)
    # the few units with a score at all are looked at again for words that veto
    scored = scored.join(unit.select("id", "i", fitting(F.col("terms.term")).alias("fits")), ["id", "i"]).withColumn("fits", F.array_contains("fits", F.col("license")))
    each = scored.groupBy("id", "i", "license", "fits").agg(F.max("score").alias("score"), F.min_by("no", F.struct(-F.col("score"), "no")).alias("no"))
    one = each.groupBy("id", "i").agg(F.max("score").alias("most"), F.min_by("no", F.struct(-F.col("score"), "no")).alias("first"), F.max(F.when(F.col("fits"), F.col("score"))).alias("top"), F.min_by(F.struct("license", "no"), F.when(F.col("fits"), F.struct(-F.col("score"), "no"))).alias("w"))
    second = each.where("fits").join(one.select("id", "i", F.col("w.license").alias("winner")), ["id", "i"]).where("license <> winner").groupBy("id", "i").agg(F.max("score").alias("next"))
    clear = F.col("top").isNotNull() & (F.col("next").isNull() | (F.col("top") - F.col("next") >= margin))
    best = one.join(second, ["id", "i"], "left").select("id", F.when(clear, F.col("w.license")).otherwise("ambiguous").alias("license"), F.when(F.col("top").isNull(), F.col("most")).otherwise(F.col("top")).alias("score"), F.coalesce("w.no", "first").alias("no"))
    best = best.groupBy("id").agg(F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), "no", "license")).alias("b")).select("id", "b.license", "b.score")
    own = stored(rows.drop("n", "units", "heard").join(best, "id", "left"), "licensed")

    folder = F.regexp_extract("path", r"^(.*/)?[^/]*$", 1)
    given = own.where("is_file and license is not null").select(folder.alias("dir"), "license", "score", "path").groupBy("dir").agg(F.min_by(F.struct("license", "score", "path"), F.struct(-F.col("score"), "path")).alias("g"))
    lacking = own.where("license is null and path is not null").select(folder.alias("of")).distinct()
    parts = F.split("of", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.struct(i.alias("depth"), F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.when(i > 0, "/").otherwise("")).alias("dir")))
    reached = lacking.select("of", F.explode(above).alias("a")).select(F.col("of").alias("at"), "a.depth", "a.dir").join(given, "dir")
    reached = reached.groupBy("at").agg(F.max_by("g", "depth").alias("g"))
    out = own.withColumn("of", F.when(F.col("license").isNull(), folder)).join(reached, F.col("of") == F.col("at"), "left")
    how = F.when(F.col("license").isNotNull(), "own").when(F.col("g").isNotNull(), "inherited").otherwise("none")
    return out.select("key", "path", F.coalesce("license", "g.license").alias("license"), F.coalesce("score", "g.score").alias("score"), how.alias("how"), F.when(F.col("license").isNull(), F.col("g.path")).alias("source"))


def op1_license_scan(spark, sf_dir):
    """The licence of every document.

    The table has no paths. A document stands at source/thousand/hundred/doc_id.txt, and the first of a
    hundred that speaks of a license is its directory's LICENSE.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    folder = [F.coalesce("source", F.lit("")).alias("_source"), F.expr("doc_id div 100").alias("_hundred")]
    first = docs.where(F.contains(F.lower("text"), F.lit("license"))).groupBy(*folder).agg(F.min("doc_id").alias("_first"))
    docs = docs.select("*", *folder).join(first, ["_source", "_hundred"], "left")
    name = F.when(F.col("doc_id") == F.col("_first"), F.lit("LICENSE")).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.expr("cast(doc_id div 1000 as string)"), F.expr("cast(doc_id div 100 as string)"), name)
    return scan(docs.select(F.col("doc_id").alias("key"), path.alias("path"), "text")).withColumnRenamed("key", "doc_id")
