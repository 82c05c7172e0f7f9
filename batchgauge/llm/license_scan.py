"""Licences of files: by text, else from the nearest directory above. DataFrame functions only.

The lines, paragraphs and comments of a file that speak of a licence (its headers), and the whole
text of a licence file, are compared with licence templates by the cosine of sparse TF-IDF vectors:
their words are joined with the words of the templates and the products are summed. A template
counts only if the words that tell its licence from its relatives agree (name, version, variant:
`MARKS`), and a line that denies a licence (`DENIED`) has none. The best template at or above `least` is the file's own licence. A licence file speaks
for its directory: every file without a licence of its own takes that of the nearest directory
above it that has one.

The templates are notices, standard headers, SPDX tags, the short licences in full, and the titles
and first words of the long ones (Apache, GNU, Mozilla, Creative Commons): these are found by their
title paragraph. Licences without a template are none.

Only words of candidate lines are exploded. Sums are made per line before anything is
compared across lines. Directories are made distinct before they look up, so a directory with a third
of all files is one row there; the directories that carry a licence are broadcast when their
counted size allows, else joined by path.

Defined results: null or empty text has no licence of its own. Of equal cosines the template
first by name counts. A null path is a file without directories; a licence file in no directory
speaks for all. Rows that repeat a path are separate files; of several licence files in one
directory the one with the highest cosine counts, then the first name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from batchgauge.llm.common import small, stored

LEAST = 0.5
#: What speaks of a licence: the word itself and its like, or a licence's name (with its version).
CUES = (
    r"(?i)licen[cs]|copyright|spdx|permission is hereby|public domain|redistribution|creative commons|unencumbered"
    r"|\b(?:[al]?gpl|apache|mozilla|mpl|bsd|cc0|cc[ -]by)(?:[ -]?v?\d|\b)"
)
#: A unit that says so is under no licence by it.
DENIED = (
    r"(?i)\b(?:not|never|nor|isn't|aren't|no longer)\s+(?:be\s+|been\s+|being\s+|yet\s+)?"
    r"(?:licen[cs]ed|released|distributed|available|covered|published|offered|under)\b"
)
WORD = r"[^a-z0-9.]+"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)[^/]*$"

COMMENT = r"(?m)((?:^[ \t]*(?:#|//|/?\*|;|--|%|<!--|\").*(?:\r?\n|\z))+)"
BLANK = r"\n(?:[ \t\r*#/;%!<>\"-]*\n)+"

_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. "
)
_WARRANTY = (
    "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, "
    "including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. "
    "In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or "
    "consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; "
    "or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort "
    "(including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so, subject to the following conditions: "
)
_MIT_END = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties "
    "of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be "
    "liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in "
    "connection with the software or the use or other dealings in the software."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies. "
)
_ISC_END = (
    "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied "
    "warranties of merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or "
    "consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, "
    "negligence or other tortious action, arising out of or in connection with the use or performance of this software."
)


def _gnu(name: str, short: str, version: str, dated: str) -> tuple[str, ...]:
    return (
        f"Licensed under the GNU {name}, version {version}.", f"This work is licensed under the GNU {name}, version {version}.",
        f"Licensed under the {short} {version}.0.", f"{short}v{version} license", f"Distributed under the terms of the {short}v{version}.",
        f"Released under the {short}v{version}, see COPYING.", f"GNU {name} Version {version}, {dated}",
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
        f"the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
        f"SPDX-License-Identifier: {short}-{version}.0-only", f"SPDX-License-Identifier: {short}-{version}.0-or-later",
    )


def _cc(kind: str, short: str) -> tuple[str, ...]:
    return (
        f"Licensed under the Creative Commons {kind} 4.0 International License.", f"Licensed under {short} 4.0.",
        f"This work is licensed under a Creative Commons {kind} 4.0 International License.", f"Creative Commons {kind} 4.0 International Public License",
        f"SPDX-License-Identifier: {short.replace(' ', '-')}-4.0",
    )


# How public licences are named in notices and headers, and how they begin.
TEMPLATES = {
    "AGPL-3.0": _gnu("Affero General Public License", "AGPL", "3", "19 November 2007"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", "Apache License 2.0", "SPDX-License-Identifier: Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "BSD-2-Clause": (_GRANT + _WARRANTY, "Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"),
    "BSD-3-Clause": (_GRANT + _NAMES + _WARRANTY, "Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"),
    "CC-BY-4.0": _cc("Attribution", "CC BY"),
    "CC-BY-NC-4.0": _cc("Attribution-NonCommercial", "CC BY-NC"),
    "CC-BY-SA-4.0": _cc("Attribution-ShareAlike", "CC BY-SA"),
    "CC0-1.0": (
        "Licensed under CC0 1.0.", "Creative Commons CC0 1.0 Universal", "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work "
        "to the public domain worldwide under the CC0 1.0 Universal license.",
    ),
    "GPL-2.0": _gnu("General Public License", "GPL", "2", "June 1991"),
    "GPL-3.0": _gnu("General Public License", "GPL", "3", "29 June 2007"),
    "ISC": (_ISC + _ISC_END, _ISC, "Released under the ISC License.", "SPDX-License-Identifier: ISC"),
    "LGPL-2.1": tuple(x.replace("1.0", "1") for x in _gnu("Lesser General Public License", "LGPL", "2.1", "February 1999")),
    "LGPL-3.0": _gnu("Lesser General Public License", "LGPL", "3", "29 June 2007"),
    "MIT": (
        _MIT + _MIT_END, _MIT, "Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "Mozilla Public License Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.", "SPDX-License-Identifier: MPL-2.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.", "SPDX-License-Identifier: Unlicense",
    ),
}
_THREE, _TWO = "3 3.0 v3 v3.0 gplv3 lgplv3 agplv3", "2 2.0 v2 v2.0 gplv2"
_CC = ["cc commons", "by attribution", "4.0 4"]
#: licence -> (groups of words of each of which one must be there, words that must not be there)
MARKS = {
    "AGPL-3.0": (["affero agpl agplv3", _THREE], ""),
    "Apache-2.0": (["apache", "2.0 2 v2 v2.0"], ""),
    "BSD-2-Clause": (["bsd redistributions", "2", "2 clause binary"], "3 4 endorse advertising"),
    "BSD-3-Clause": (["bsd redistributions", "3 endorse"], "advertising"),
    "CC-BY-4.0": (_CC, "nc noncommercial sa sharealike nd noderivatives noderivs"),
    "CC-BY-NC-4.0": ([*_CC, "nc noncommercial"], "sa sharealike nd noderivatives noderivs"),
    "CC-BY-SA-4.0": ([*_CC, "sa sharealike"], "nc noncommercial nd noderivatives noderivs"),
    "CC0-1.0": (["cc0", "1.0 1 universal"], ""),
    "GPL-2.0": (["general gpl gplv2", _TWO], "lesser library affero lgpl agpl"),
    "GPL-3.0": (["general gpl gplv3", _THREE], "lesser library affero lgpl agpl lgplv3 agplv3"),
    "ISC": (["isc fee"], "charge"),
    "LGPL-2.1": (["lesser lgpl lgplv2.1", "2.1 v2.1 lgplv2.1"], ""),
    "LGPL-3.0": (["lesser lgpl lgplv3", _THREE], ""),
    "MIT": (["mit charge"], "fee"),
    "MPL-2.0": (["mozilla mpl", "2.0 v2.0 2"], ""),
    "Unlicense": (["unencumbered unlicense"], ""),
}


def terms(text: Column) -> Column:
    """The lower-cased words, full stops at their ends taken off."""
    found = F.transform(F.split(F.lower(text), WORD), lambda w: F.regexp_replace(w, r"^\.+|\.+$", ""))
    return F.filter(found, lambda w: w != "")


def template_weights(spark: SparkSession, counts: DataFrame, total: int, templates: dict[str, str | tuple[str, ...]]) -> DataFrame:
    """(term, licence, notice, weight): unit TF-IDF vectors of the templates. counts: (term, n) over all candidate lines."""
    notices = [(k, i, x) for k, v in sorted(templates.items()) for i, x in enumerate([v] if isinstance(v, str) else v)]
    rows = spark.createDataFrame(notices, "licence string, notice int, said string")
    tf = rows.select("licence", "notice", F.explode(terms(F.col("said"))).alias("term")).groupBy("licence", "notice", "term").agg(F.count("*").alias("tf"))
    weighed = tf.join(counts, "term", "left").withColumn("w", F.col("tf") * _idf(total))
    return weighed.withColumn("norm", F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("licence", "notice")))).select(
        "term", "licence", "notice", (F.col("w") / F.col("norm")).alias("weight")
    )


def _agrees(words: Column) -> Column:
    """Whether the words that tell a licence from its relatives are among a unit's; a licence without marks always agrees."""
    out = F.lit(True)
    for licence, (needs, bars) in MARKS.items():
        has = [F.arrays_overlap(words, F.array(*map(F.lit, group.split()))) for group in needs]
        if bars:
            has.append(~F.arrays_overlap(words, F.array(*map(F.lit, bars.split()))))
        fits = has[0]
        for one in has[1:]:
            fits = fits & one
        out = F.when(F.col("licence") == licence, fits).otherwise(out)
    return out


def _idf(total: int) -> Column:
    return F.ln((F.lit(1.0) + F.lit(total)) / (F.lit(1.0) + F.coalesce("n", F.lit(0)))) + F.lit(1.0)


def own_licences(files: DataFrame, templates: dict[str, str | tuple[str, ...]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(file, licence, cosine) of the files whose headers or whole text match a template. files: file, path, text."""
    spark = files.sparkSession
    whole = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    parts = F.concat(F.split("text", "\n"), F.split("text", BLANK), F.regexp_extract_all("text", F.lit(COMMENT), 1))
    lines = F.array_distinct(F.filter(parts, lambda x: x.rlike(CUES) & ~x.rlike(DENIED)))
    units = F.when(whole, F.concat(lines, F.array("text"))).otherwise(lines)
    spoken = files.filter(F.col("text").rlike(CUES) | (whole & F.col("text").isNotNull())).select("file", F.posexplode(units).alias("line", "said"))
    vectors = stored(
        spoken.select("file", "line", F.explode(terms(F.col("said"))).alias("term"))
        .groupBy("file", "line", "term").agg(F.count("*").alias("tf")), "licence-lines",
    )
    counts = vectors.groupBy("term").agg(F.count("*").alias("n"))
    total = vectors.select("file", "line").distinct().count()
    known = stored(template_weights(spark, counts, total, templates), "licence-templates")
    idf = stored(counts, "licence-terms")
    weighed = vectors.join(small(idf, 64), "term").withColumn("w", F.col("tf") * _idf(total))
    norms = weighed.groupBy("file", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    marks = sorted({w for needs, bars in MARKS.values() for group in (*needs, bars) for w in group.split()})
    telling = vectors.filter(F.col("term").isin(marks)).groupBy("file", "line").agg(F.collect_set("term").alias("words"))
    dots = (
        weighed.join(small(known, 128), "term").groupBy("file", "line", "licence", "notice")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
        .groupBy("file", "line", "licence").agg(F.max("dot").alias("dot"))
    )
    cosine = (
        dots.join(norms, ["file", "line"]).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6))
        .join(telling, ["file", "line"], "left").filter(_agrees(F.coalesce("words", F.array().cast("array<string>"))))
    )
    best = cosine.filter(F.col("cosine") >= least).groupBy("file").agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b")
    )
    return best.select("file", "b.licence", (-F.col("b.c")).alias("cosine"))


def parents(path: Column) -> Column:
    """The directories above a path, nearest first; the last is the root, an empty path."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    )


def licensed(files: DataFrame, templates: dict[str, str | tuple[str, ...]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(file, path, licence, cosine, origin, licence_dir) per file: origin is own, inherited or none. file is a unique key."""
    base = files.select("file", F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    own = stored(own_licences(base, templates, least), "licences")
    folder = F.coalesce(F.get(parents(F.col("path")), F.lit(0)), F.lit(""))
    named = base.filter(F.col("path").rlike(LICENCE_FILE)).select("file", folder.alias("above"))
    carriers = stored(
        named.join(own, "file").groupBy("above")
        .agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"))
        .select("above", F.col("b.licence").alias("dir_licence"), (-F.col("b.c")).alias("dir_cosine")), "licence-dirs",
    )
    # each directory looks up once, however many files it has
    folders = base.select(folder.alias("folder")).distinct()
    ladder = folders.select("folder", F.posexplode(F.concat(F.array("folder"), parents(F.col("folder")))).alias("steps", "above"))
    nearest = (
        ladder.join(small(carriers, 256), "above").groupBy("folder")
        .agg(F.min(F.struct("steps", "above", "dir_licence", "dir_cosine")).alias("n"))
        .select("folder", F.col("n.above").alias("licence_dir"), F.col("n.dir_licence").alias("dir_licence"), F.col("n.dir_cosine").alias("dir_cosine"))
    )
    nearest = stored(nearest, "licence-folders")
    out = (
        base.select("file", "path", folder.alias("folder")).join(small(own, 96), "file", "left")
        .join(small(nearest, 256), "folder", "left")
    )
    origin = F.when(F.col("licence").isNotNull(), "own").when(F.col("dir_licence").isNotNull(), "inherited").otherwise("none")
    return out.select(
        "file", "path", F.coalesce("licence", "dir_licence").alias("licence"), F.coalesce("cosine", "dir_cosine").alias("cosine"),
        origin.alias("origin"), F.when(F.col("licence").isNull(), F.col("licence_dir")).alias("licence_dir"),
    )
