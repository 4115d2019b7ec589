"""Licence scans: TF-IDF cosine to templates, then inheritance from the nearest directory.

Licences are known by short notices, by the usual headers of source files and by
their whole texts. Every line, paragraph and sentence of a file is compared with
notices and headers, its header block and the whole file with texts as well, as
sparse vectors of words weighted by TF-IDF. Where the whole file is a licence's
text that counts first, then such a header block, then the best of the others. The most similar
template does not depend on the weights of words that no template has, so tasks
first find it with the least weight for those, drop parts that stay below the
limit even so, and the rest get their words' true weights by a join. A file that
is a licence text, or consists of licence lines, is a licence file and speaks
for its directory; a file without a finding of its own inherits from the nearest
directory above it that has one, by joins on paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from importlib import resources

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.text import whole
from cartwright.runtime import materialize

# fixed values: what the licences are recognised by
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def _gnu(name: str, version: str, noun: str, ending: str) -> tuple[str, str]:
    """First paragraph of the usual header of a GNU licence, and the whole header."""
    first = (
        f"This {noun} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by "
        f"the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
    )
    return first, (
        f"{first} This {noun} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        f"implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. "
        f"You should have received a copy of the {name} along with this {noun}{ending}"
    )


_SEE = ". If not, see <https://www.gnu.org/licenses/>."
_WRITE = "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
_APACHE = "you may not use this file except in compliance with the License."
_APACHE_REST = (
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
    'agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
    "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
    "limitations under the License."
)
_MPL = "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
_CC = (
    'By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this '
    'Creative Commons {0} 4.0 International Public License ("Public License").'
)
# fixed values: the usual headers of files under these licences, whole and by their telling sentences
HEADERS = {
    "Apache-2.0": (
        f'Licensed under the Apache License, Version 2.0 (the "License"); {_APACHE}',
        f'Licensed under the Apache License, Version 2.0 (the "License"); {_APACHE} {_APACHE_REST}',
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file "
        "distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You "
        f'under the Apache License, Version 2.0 (the "License"); {_APACHE} {_APACHE_REST}',
        _APACHE,
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "GPL-3.0": _gnu("GNU General Public License", "3", "program", _SEE),
    "GPL-2.0": _gnu("GNU General Public License", "2", "program", _WRITE),
    "LGPL-3.0": _gnu("GNU Lesser General Public License", "3", "library", _SEE),
    "LGPL-2.1": _gnu("GNU Lesser General Public License", "2.1", "library", _WRITE),
    "MPL-2.0": (_MPL, f"{TEMPLATES['MPL-2.0']} {_MPL}"),
    "CC-BY-4.0": (_CC.format("Attribution"),),
    "CC-BY-NC-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        _CC.format("Attribution-NonCommercial"),
    ),
}
MIN_COSINE = 0.7
#: A file is a licence file if at least this share of its words stands in licence lines.
FILE_SHARE = 0.5
#: Words that a task counts before it sends the counts on.
COUNTED_WORDS = 300_000
#: Of a part: the whole file or its header block against whole licences; then, against notices and headers,
#: the whole file, one line, or several lines or a piece of one.
WHOLE_TEXT, HEADER_TEXT, WHOLE, LINE, BLOCK = range(5)
PARTS = "array<struct<kind int, name string, dot double, known double, n int, words array<struct<w string, n int>>>>"

_WORD = re.compile(r"\w+(?:\.\d+)*")
_MARK = re.compile(r"\s*(?://+|/?\*+/?|#+|--+|;+|%+|<!--|\"{3}|'{3})\s?")
_CLOSED = {"/*": "*/", "<!--": "-->", '"""': '"""', "'''": "'''"}
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def license_texts() -> list[tuple[str, str]]:
    """(name, text) of the whole licences kept beside this module."""
    folder = resources.files("cartwright.llm") / "license_texts"
    return sorted((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in folder.iterdir() if f.name.endswith(".txt"))


def notices() -> list[tuple[str, str]]:
    """(name, text) of all notices, headers and SPDX lines."""
    headers = [(name, text) for name, texts in HEADERS.items() for text in texts]
    tags = [(name, f"SPDX-License-Identifier: {name}") for name in sorted({*TEMPLATES, *(n for n, _ in license_texts())})]
    return [*TEMPLATES.items(), *headers, *tags]


def header_block(lines: list[str]) -> list[str]:
    """The comment that a file starts with, else its first paragraph."""
    at = 1 if lines and lines[0].startswith("#!") else 0
    while at < len(lines) and not lines[at].strip():
        at += 1
    if at == len(lines):
        return []
    first = lines[at].lstrip()
    end = at
    for opening, closing in _CLOSED.items():
        if first.startswith(opening):
            while end < len(lines) and closing not in (lines[end] if end > at else first[len(opening) :]):
                end += 1
            return lines[at : end + 1]
    marked = _MARK.match(first) is not None
    while end < len(lines) and (_MARK.match(lines[end]) if marked else lines[end].strip()):
        end += 1
    return lines[at:end]


def parts_of(text: str) -> Iterator[tuple[int, str]]:
    """(kind, text) of all parts of a file, in the order of their kinds where they are equal."""
    lines = text.split("\n")
    header = "\n".join(header_block(lines))
    yield from ((WHOLE_TEXT, text), (HEADER_TEXT, header), (WHOLE, text), (BLOCK, header))
    block: list[str] = []
    for line in [*lines, ""]:
        bare = _MARK.sub("", line, count=1).strip()
        if bare:
            yield LINE, line
            block.append(bare)
            continue
        if len(block) > 1:
            yield BLOCK, " ".join(block)
        sentences = _SENTENCE.split(" ".join(block))
        if len(sentences) > 1:
            yield from ((BLOCK, sentence) for sentence in sentences)
        block = []


def terms(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def parents(path: Column) -> Column:
    """All directories above a path, nearest first; the root is the empty string."""
    parts = F.split(path, "/")
    above = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.transform(F.sequence(F.size(above), F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(above, 1, n), "/"))


def word_files(files: DataFrame) -> DataFrame:
    """(w, n_files): in how many files each word occurs, summed inside tasks first."""

    def table(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["w", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(set(terms(text.as_py())))
                if len(seen) > COUNTED_WORDS:
                    yield table(seen)
                    seen.clear()
        yield table(seen)

    counted = files.select(whole().alias("text")).mapInArrow(count, "w string, n long")
    return counted.groupBy("w").agg(F.sum("n").alias("n_files"))


class Scanner:
    """Cosines of lines with the templates.

    A line's coordinates are its words. One that no template has counts in the
    line's length only, and the most similar template does not depend on it.
    ``templates`` are texts by licence, or (licence, text) pairs. An SPDX line
    names one licence: it is similar to a line with all of its words only.
    """

    def __init__(
        self, templates: dict[str, str] | list[tuple[str, str]], n_files: int, counts: dict[str, int], min_cosine: float = MIN_COSINE
    ):
        pairs = sorted(templates.items() if isinstance(templates, dict) else templates)
        self.names = [name for name, _ in pairs]
        self.n_files, self.counts, self.least = n_files, counts, min_cosine - 1e-9
        self.idf = {w: self.weight(w) for _, t in pairs for w in terms(t)}
        self.columns = {w: i for i, w in enumerate(sorted(self.idf))}
        rows = []
        self.exact = {i: frozenset(terms(t)) for i, (_, t) in enumerate(pairs) if t.startswith("SPDX-")}
        for _, template in pairs:
            row = np.zeros(len(self.columns))
            for w, n in Counter(terms(template)).items():
                row[self.columns[w]] = n * self.idf[w]
            rows.append(row / (np.linalg.norm(row) or 1))
        self.templates = np.array(rows)
        self.needed = self._needed()

    def weight(self, word: str) -> float:
        return math.log((1 + self.n_files) / (1 + self.counts.get(word, 0))) + 1

    def _needed(self) -> frozenset[str]:
        """Words of which a similar line has one at least: the other words of a template make no cosine of that size."""
        words, needed = sorted(self.columns), set()
        for row in self.templates:
            order = np.argsort(row)
            alone = np.cumsum(row[order] ** 2) >= max(self.least, 0) ** 2
            needed.update(words[i] for i in order[alone] if row[i] > 0)
        return frozenset(needed)

    def measure(self, counts: Counter) -> tuple[int, float, float]:
        """Most similar template (the first by name among equals), product with it, and squared length of the known words."""
        row = np.zeros(len(self.columns))
        for w, n in counts.items():
            i = self.columns.get(w)
            if i is not None:
                row[i] = n * self.idf[w]
        products = self.templates @ row
        for i, words in self.exact.items():
            if not words <= counts.keys():
                products[i] = 0
        i = int(np.argmax(products))
        return i, float(products[i]), float(row @ row)

    def part(self, kind: int, words: list[str]) -> tuple | None:
        """A row of ``PARTS`` for words that may be similar enough: no word weighs less than 1."""
        if self.needed.isdisjoint(words):
            return None
        counts = Counter(words)
        i, dot, known = self.measure(counts)
        others = [(w, n) for w, n in counts.items() if w not in self.columns]
        if dot < self.least * math.sqrt(known + sum(n * n for _, n in others)):
            return None
        return kind, self.names[i], dot, known, len(words), others

    def best(self, line: str) -> tuple[str | None, float, int]:
        """Most similar template, cosine, and the number of words, all words weighted by this scanner's counts."""
        counts = Counter(terms(line))
        i, dot, known = self.measure(counts)
        if not known:
            return None, 0.0, sum(counts.values())
        rest = sum((n * self.weight(w)) ** 2 for w, n in counts.items() if w not in self.columns)
        return self.names[i], dot / math.sqrt(known + rest), sum(counts.values())


def own_licenses(
    files: DataFrame,
    templates: dict[str, str] | list[tuple[str, str]],
    min_cosine: float,
    texts: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """(file_id, path, found, similarity, license_file): the finding in each file's own text, over all of its parts.

    ``templates`` are compared with all parts, ``texts`` with header blocks and whole files.
    """
    texts = texts or []
    templates = list(templates.items()) if isinstance(templates, dict) else templates
    vocabulary = sorted({w for _, t in [*templates, *texts] for w in terms(t)})
    counted = materialize(word_files(files), "word-files")
    n_files = files.count()
    counts = {r["w"]: r["n_files"] for r in counted.filter(F.col("w").isin(vocabulary)).collect()}
    short = Scanner(templates, n_files, counts, min_cosine)
    long = Scanner(texts, n_files, counts, min_cosine)
    needed = short.needed | long.needed

    @F.pandas_udf(f"total int, parts {PARTS}")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                words = terms(text)
                parts = []
                if not needed.isdisjoint(words):
                    parts = [(long if kind < WHOLE else short).part(kind, terms(part)) for kind, part in parts_of(text)]
                rows.append((len(words), [p for p in parts if p]))
            yield pd.DataFrame(rows, columns=["total", "parts"])

    scanned = files.select(F.monotonically_increasing_id().alias("row"), "file_id", "path", scan(whole()).alias("own"))
    scanned = materialize(scanned.select("row", "file_id", "path", "own.*"), "licence-parts")
    parts = scanned.select("row", F.posexplode("parts").alias("at", "part"))
    others = parts.select("row", "at", F.inline("part.words"))
    # Few lines are left, and so few words as a rule; Spark picks the join.
    known = materialize(counted.join(others.select("w").distinct(), "w", "left_semi"), "licence-words")
    weight = F.col("n") * (F.log(F.lit(1.0 + n_files) / (1 + F.coalesce("n_files", F.lit(0)))) + 1)
    rest = others.join(known, "w", "left").groupBy("row", "at").agg(F.sum(weight * weight).alias("rest"))
    # Rounded, so that equal texts in different lines are equally similar.
    cosine = F.round(F.col("part.dot") / F.sqrt(F.col("part.known") + F.coalesce("rest", F.lit(0.0))), 12)
    rank = F.least(F.col("part.kind"), F.lit(WHOLE)).alias("rank")
    similar = (
        parts.join(rest, ["row", "at"], "left").withColumn("cosine", cosine).filter(F.col("cosine") >= min_cosine)
        .groupBy("row").agg(
            F.min(F.struct(rank, (-F.col("cosine")).alias("o"), "at", F.col("part.name").alias("name"))).alias("best"),
            F.sum(F.when(F.col("part.kind") == LINE, F.col("part.n"))).alias("inside"),
            F.bool_or(F.col("part.kind").isin(WHOLE_TEXT, WHOLE)).alias("is_text"),
        )
    )
    return scanned.join(similar, "row", "left").select(
        "file_id",
        "path",
        F.col("best.name").alias("found"),
        F.coalesce(-F.col("best.o"), F.lit(0.0)).alias("similarity"),
        (
            F.coalesce("is_text", F.lit(False)) | F.coalesce(F.col("inside") >= FILE_SHARE * F.col("total"), F.lit(False))
        ).alias("license_file"),
    )


def scan_licenses(files: DataFrame, *, templates: dict[str, str] | None = None, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(file_id, path, license, similarity, origin, directory) for every row of ``files`` (file_id, path, text).

    ``origin`` is ``own`` for a finding in the file's text, ``inherited`` for
    one taken from the licence file of the nearest directory above (which
    ``directory`` names; empty for the root), else ``none``. Among licence
    files of one directory the most similar counts, then the first licence by
    name. A null path has no directories. Each directory is looked up once,
    however many files it holds.
    """
    if templates is None:
        found = own_licenses(files, notices(), min_cosine, license_texts())
    else:
        found = own_licenses(files, templates, min_cosine)
    own = materialize(found, "licences")
    where = own.withColumn("folder", F.element_at(parents(F.col("path")), 1))
    speaking = (
        where.filter("license_file AND folder IS NOT NULL")
        .groupBy(F.col("folder").alias("directory"))
        .agg(F.min(F.struct((-F.col("similarity")).alias("o"), F.col("found").alias("license"))).alias("best"))
        .select("directory", F.col("best.license").alias("dir_license"), (-F.col("best.o")).alias("dir_similarity"))
    )
    # A folder's ancestors are the parents of a name inside it; the distance orders them.
    folders = where.filter("folder IS NOT NULL").select(F.col("folder").alias("child")).distinct()
    inside = F.when(F.col("child") == "", "x").otherwise(F.concat("child", F.lit("/x")))
    nearest = (
        folders.select("child", F.posexplode(parents(inside)).alias("up", "ancestor"))
        .join(speaking, F.col("ancestor") == F.col("directory"))
        .groupBy("child")
        .agg(F.min(F.struct("up", "directory", "dir_license", "dir_similarity")).alias("from"))
    )
    joined = where.join(nearest, F.col("folder") == F.col("child"), "left")
    has_own = F.col("found").isNotNull()
    inherits = F.col("from").isNotNull()
    return joined.select(
        "file_id",
        "path",
        F.coalesce("found", "from.dir_license").alias("license"),
        F.when(has_own, F.col("similarity")).otherwise(F.col("from.dir_similarity")).alias("similarity"),
        F.when(has_own, "own").when(inherits, "inherited").otherwise("none").alias("origin"),
        F.when(~has_own, F.col("from.directory")).alias("directory"),
    )
