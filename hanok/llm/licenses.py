"""Licences of files: sparse TF-IDF cosine to templates, then inheritance from the nearest directory above.

Every line of a file, and every stretch of as many words as a template has, is a vector of its words' weights, and its cosine with a
template's vector says whether it states that licence. SPDX tags state the licences they name, or the expression of them. A licence file passes its licence to the files
of its directory and of those below that state none themselves.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hanok.llm.shared import as_texts, map_batches, written

MIN_COSINE = 0.6
MIN_STRETCH = 0.8  # cosine of a stretch of words amid others
COMMON = 4096  # words, the commonest, whose weights every task has; those of others are joined
_FLUSH = 200_000  # words that a task counts before it hands them on
# How files state their licence: the usual sentences of headers and of licence files' first lines.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("proprietary", "All rights reserved."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
)
_WORD = re.compile(r"[^\W_]+")
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t(]*([A-Za-z0-9][A-Za-z0-9.+-]*(?:[ \t()]+(?:AND|OR|WITH)[ \t(]+[A-Za-z0-9][A-Za-z0-9.+-]*)*)")
# Licences that a tag may name, without -only and -or-later, and exceptions behind WITH.
SPDX_NAMES = frozenset(
    "0BSD AFL-3.0 AGPL-1.0 AGPL-3.0 Apache-1.0 Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0 BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause "
    "BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-3.0 "
    "CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 "
    "EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.1 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-3.0 HPND IJG Intel IPL-1.0 ISC LGPL-2.0 LGPL-2.1 LGPL-3.0 LPPL-1.3c "
    "MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.0 OFL-1.1 OpenSSL OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL "
    "Python-2.0 QPL-1.0 Ruby Sleepycat SSPL-1.0 Unicode-3.0 Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1 "
    "Autoconf-exception-3.0 Classpath-exception-2.0 GCC-exception-3.1 Linux-syscall-note LLVM-exception OpenSSL-exception".split()
)


def words(line: str) -> list[str]:
    return _WORD.findall(line.lower())


def tagged(text: str) -> list[str]:
    """Licences that SPDX tags in ``text`` state, expressions as they are but without brackets; a tag with an unknown name states none."""
    found = []
    for m in _SPDX.finditer(text):
        parts = [re.sub(r"(-only|-or-later|[.+-])$", "", x) for x in m[1].replace("(", " ").replace(")", " ").split()]
        names = [x if x in SPDX_NAMES else re.sub(r"[.-]+$", "", x) for x in parts[::2]]
        if all(x in SPDX_NAMES or x.startswith("LicenseRef-") for x in names):
            found.append(" ".join(x for pair in zip(names, [*parts[1::2], ""]) for x in pair).strip())
    return found


class Weights:
    """Template vectors, from how many of the lines have each word of ``counts``; any other word is in ``most`` lines at most."""

    def __init__(self, lines: int, counts: dict[str, int], most: int):
        self.lines = lines
        self.least = math.log((1 + lines) / (1 + most)) + 1
        self.idf = {w: math.log((1 + lines) / (1 + n)) + 1 for w, n in counts.items()}
        self.templates = []
        for name, text in TEMPLATES:
            found = words(text)
            vector = {w: n * self.idf[w] for w, n in Counter(found).items()}
            size = math.sqrt(sum(v * v for v in vector.values()))
            self.templates.append((name, vector, size, len(found)))
        self.anchors = {bar: [self._anchors(t, bar) for t in self.templates] for bar in (MIN_COSINE, MIN_STRETCH)}
        self.seek = frozenset().union(*self.anchors[MIN_COSINE])

    @staticmethod
    def _anchors(template: tuple, bar: float) -> frozenset[str]:
        """Words without any of which no cosine reaches ``bar``: all but the lightest."""
        _, vector, size, _ = template
        light, anchors = 0.0, set(vector)
        for w, v in sorted(vector.items(), key=lambda x: (x[1], x[0])):
            light += v * v
            if light >= (bar * size) ** 2 * (1 - 1e-9):
                break
            anchors.discard(w)
        return frozenset(anchors)

    def _score(self, found: list[str], templates: list[tuple], bar: float, exact: list, open_: dict) -> None:
        """Adds (cosine, name) to ``exact`` where all weights are known, else what the cosine needs to ``open_`` if it can reach ``bar``."""
        counts = Counter(found)
        known = {w: n * self.idf[w] for w, n in counts.items() if w in self.idf}
        other = tuple(sorted((w, n) for w, n in counts.items() if w not in self.idf))
        square = sum(v * v for v in known.values())
        norm = math.sqrt(square + sum((n * self.least) ** 2 for _, n in other))
        for name, vector, size, _ in templates:
            dot = sum(v * vector[w] for w, v in known.items() if w in vector) / size
            if dot >= bar * norm:
                if other:
                    open_[name, dot, square, bar, other] = dot / norm
                else:
                    exact.append((dot / norm, name))

    def judge(self, text: str) -> tuple[tuple[float, str] | None, list[tuple]]:
        """The nearest licence as (cosine, name), of equals the first by name, and what may be nearer by words whose weights are not here."""
        exact, open_ = [(1.0, name) for name in tagged(text)], {}
        lines = [words(line) for line in text.split("\n")]
        found = [w for line in lines for w in line]
        if not self.seek.isdisjoint(found):
            for line in lines:
                near = [t for t, a in zip(self.templates, self.anchors[MIN_COSINE]) if not a.isdisjoint(line)] if not self.seek.isdisjoint(line) else []
                if near:
                    self._score(line, near, MIN_COSINE, exact, open_)
            at = {}
            for i, w in enumerate(found):
                if w in self.seek:
                    at.setdefault(w, []).append(i)
            for t, a in zip(self.templates, self.anchors[MIN_STRETCH]):
                present = sum(v * v for w, v in t[1].items() if w not in self.seek or w in at)
                if present >= (MIN_STRETCH * t[2]) ** 2 * (1 - 1e-9):
                    last = max(len(found) - t[3], 0)
                    for i in sorted({i for w in a for p in at.get(w, ()) for i in range(max(p - t[3] + 1, 0), min(p, last) + 1)}):
                        held = sum(t[1][w] ** 2 for w in {*found[i : i + t[3]]} if w in t[1])
                        if held >= (MIN_STRETCH * t[2]) ** 2 * (1 - 1e-9):
                            self._score(found[i : i + t[3]], [t], MIN_STRETCH, exact, open_)
        best = min(exact, key=lambda x: (-x[0], x[1]), default=None)
        return best, [k for k, most in open_.items() if best is None or most >= best[0]]


def _vocabulary() -> set[str]:
    return {w for _, text in TEMPLATES for w in words(text)}


def frequencies(files: DataFrame) -> DataFrame:
    """(word, n): in how many lines of all files each word is; without a word, how many lines there are."""

    def batch_of(counts):
        return pa.RecordBatch.from_arrays([pa.array([*counts], pa.string()), pa.array([*counts.values()], pa.int64())], names=["word", "n"])

    def run(batches):
        counts = Counter()
        for batch in batches:
            for x in as_texts(batch.column(0)):
                for line in x.split("\n"):
                    counts[None] += 1
                    counts.update(set(words(line)))
                    if len(counts) > _FLUSH:
                        yield batch_of(counts)
                        counts = Counter()
        yield batch_of(counts)

    return files.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def weights(counts: DataFrame) -> Weights:
    """Weights with the words of the templates and the commonest others, which alone reach the driver."""
    common = counts.where("word IS NOT NULL").orderBy(F.desc("n"), "word").limit(COMMON).collect()
    given = dict(counts.where(F.col("word").isNull() | F.col("word").isin(sorted(_vocabulary()))).collect())
    lines = given.pop(None, 0)
    return Weights(lines, dict.fromkeys(_vocabulary(), 0) | given | {w: n for w, n in common}, common[-1][1] if common else 0)


def stated(files: DataFrame) -> DataFrame:
    """(path, doc_id, licence, cosine): the best stated licence of each file, nulls where it states none."""
    counts = written(frequencies(files), "licence_words")
    shared = files.sparkSession.sparkContext.broadcast(weights(counts))
    maybe = pa.list_(pa.struct([("licence", pa.string()), ("dot", pa.float64()), ("square", pa.float64()), ("bar", pa.float64()), ("words", pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())])))]))

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.judge(x) for x in as_texts(batch.column(2))]
        best = [f[0] or (None, None) for f in found]
        open_ = [[dict(licence=k[0], dot=k[1], square=k[2], bar=k[3], words=[dict(word=w, times=n) for w, n in k[4]]) for k in f[1]] for f in found]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([b[1] for b in best], pa.string()), pa.array([b[0] for b in best], pa.float64()), pa.array(open_, maybe)],
            names=["path", "doc_id", "licence", "cosine", "maybe"],
        )

    kind = "array<struct<licence: string, dot: double, square: double, bar: double, words: array<struct<word: string, times: long>>>>"
    found = map_batches(files.select("path", "doc_id", "text"), f"path string, doc_id {dict(files.dtypes)['doc_id']}, licence string, cosine double, maybe {kind}", rows)
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "licence_lines")
    # The weights of rare words, only for the few lines that may state a licence.
    asked = found.where(F.size("maybe") > 0).select("row", F.posexplode("maybe").alias("at", "m")).select("row", "at", "m.*")
    asked = asked.select("row", "at", "licence", "dot", "square", "bar", F.explode("words").alias("w")).select("*", "w.word", "w.times").drop("w")
    idf = counts.where("word IS NOT NULL").select("word", (F.log(F.lit(1.0 + shared.value.lines) / (F.col("n") + 1)) + 1).alias("idf"))
    asked = asked.join(idf, "word").groupBy("row", "at", "licence", "dot", "square", "bar").agg(F.sum(F.pow(F.col("times") * F.col("idf"), 2)).alias("more"))
    asked = asked.withColumn("apart", -F.col("dot") / F.sqrt(F.col("square") + F.col("more"))).where(-F.col("apart") >= F.col("bar"))
    nearest = asked.groupBy("row").agg(F.min(F.struct("apart", "licence")).alias("near"))
    own = F.when(F.col("licence").isNotNull(), F.struct((-F.col("cosine")).alias("apart"), "licence"))
    merged = found.drop("maybe").join(nearest, "row", "left").withColumn("best", F.least(own, "near"))
    return merged.select("path", "doc_id", F.col("best.licence").alias("licence"), (-F.col("best.apart")).alias("cosine"))


def directory(path: Column) -> Column:
    """What stands before the last ``/``; empty for a file at the top."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), "")


def licences(files: DataFrame, licence_names: str = r"(?i)(^|/)(licen[sc]e|copying)[^/]*$") -> DataFrame:
    """One row per file of ``files`` (path, doc_id, text): path, doc_id, licence, cosine, origin, source_dir.

    ``origin`` is ``own`` (a line states it), ``inherited`` (the nearest directory at or above the file has a licence file that states
    it) or ``none``. Of several licence files in a directory the one with the highest cosine counts, then the first licence by name.
    Null and empty texts state nothing; a null path is in no directory and inherits nothing. Repeated rows stay repeated. Texts of any
    length are read whole.

    Directories meet, not files: every distinct directory looks at those above it, as many as its path has parts, and files then take
    their directory's finding.
    """
    found = written(stated(files).withColumn("dir", directory(F.col("path"))), "licences")
    given = found.where(F.col("path").rlike(licence_names) & F.col("licence").isNotNull()).groupBy("dir").agg(
        F.min(F.struct((-F.col("cosine")).alias("apart"), "licence")).alias("best")
    )
    given = given.select(F.col("dir").alias("above"), F.col("best.licence").alias("dir_licence"))
    dirs = found.where("dir IS NOT NULL AND licence IS NULL").select("dir").distinct()
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("above"))
    nearest = above.distinct().join(given, "above").groupBy("dir").agg(F.max(F.struct(F.length("above").alias("depth"), "above", "dir_licence")).alias("near"))
    nearest = nearest.select("dir", F.col("near.above").alias("above"), F.col("near.dir_licence").alias("dir_licence"))
    merged = found.join(nearest, "dir", "left")
    own = F.col("licence").isNotNull()
    return merged.select(
        "path",
        "doc_id",
        F.coalesce("licence", "dir_licence").alias("licence"),
        F.round("cosine", 9).alias("cosine"),
        F.when(own, "own").when(F.col("dir_licence").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(own, F.lit(None)).otherwise(F.col("above")).alias("source_dir"),
    )


def documents_as_files(docs: DataFrame) -> DataFrame:
    """``documents`` laid out as a tree: ``source/<thousands>/<fifties>/<doc_id>.txt``; the first twenty ids of each fifty are licence
    files (``LICENSE-<doc_id>``)."""
    number = F.col("doc_id").cast("string")
    leaf = F.when(F.pmod("doc_id", F.lit(50)) < 20, F.concat(F.lit("LICENSE-"), number)).otherwise(F.concat(number, F.lit(".txt")))
    folder = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.floor(F.col("doc_id") / 1000).cast("string"), F.floor(F.col("doc_id") / 50).cast("string"))
    return docs.select(F.concat(folder, F.lit("/"), leaf).alias("path"), "doc_id", "text")
