"""License scans: TF-IDF similarity to templates, and inheritance from the nearest ancestor directory.

The lines of a file and the file as a whole are compared with each template by the cosine of sparse TF-IDF vectors over
words. Where neither states a licence, an SPDX tag does, or a window of lines that resembles a template or a standard
notice, or the file as a whole if it resembles a licence text. A cosine is at most the length of the part of the template's
unit vector whose words the file holds: files, lines and windows that fall short of the least cosine by that bound, as nearly all
do, are passed over.
Weights come from the templates and from how many documents of the whole corpus hold each template word. The best line
or the file as a whole states the file's own licence if its cosine reaches ``least``. A directory's licence is that
of its licence file; a file without one of its own inherits it from the nearest directory above that has one: its
ancestors are exploded and joined by path with the directories' licences.

Files of a directory look its licence up by a join on the directory; directories with a thousandth of the files or more, at
most a thousand of them, are joined by broadcast.

Defined results: a null or empty text states no licence; a file that states none has the similarity 0; a null path has no directory and inherits nothing; ties between
templates go to the smaller name; repeated paths keep one row each; an empty table gives no row; clashing column
names are left as they are, as results carry the key columns only.
"""

from __future__ import annotations

import math
import pkgutil
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentloom.session import stage

# Public licence headers and the identifiers they stand for.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}
LEAST = 0.75
#: A directory is hot when it has this share of all files; so there are at most as many hot ones as its inverse.
HOT_SHARE = 1 / 1000

_GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} Public License as published by "
    "the Free Software Foundation, either version {n} of the License, or (at your option) any later version."
)
_GNU_REST = (
    " This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} Public License for more details. You should have received a "
    "copy of the GNU {name} Public License along with this {what}. If not, see https://www.gnu.org/licenses/."
)
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
    "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
)
_APACHE_REST = (
    " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
    "and limitations under the License."
)
# Standard notices at the head of files; what follows ``|`` tells those of one licence apart.
NOTICES = {
    "Apache-2.0|first": _APACHE,
    "Apache-2.0|whole": _APACHE + _APACHE_REST,
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MIT": "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
    "MIT|short": "Licensed under the MIT License. See LICENSE in the project root for license information.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
    "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
} | {
    f"{key}|{part}": text.format(what=what, name=name, n=n)
    for key, what, name, n in (
        ("GPL-2.0", "program", "General", "2"), ("GPL-3.0", "program", "General", "3"),
        ("LGPL-2.1", "library", "Lesser General", "2.1"), ("LGPL-3.0", "library", "Lesser General", "3"),
    )
    for part, text in (("first", _GNU), ("whole", _GNU + _GNU_REST))
}
#: Licence files whose texts are in the folder ``licenses``.
BODIES = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0")
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*\(*([A-Za-z0-9][\w.+-]*(?:\)*[ \t]+(?:AND|OR|WITH)[ \t]+\(*[A-Za-z0-9][\w.+-]*)*)")


def license_texts(names: tuple[str, ...] = BODIES) -> dict[str, str]:
    return {n: pkgutil.get_data("sentloom.llm", f"licenses/{n}.txt").decode() for n in names}

WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Templates:
    """Unit TF-IDF vectors of templates under given document frequencies."""

    def __init__(self, templates: dict[str, str], held: dict[str, int], total: int, least: float = LEAST):
        self.idf = {w: math.log((1 + total) / (1 + held.get(w, 0))) + 1 for t in templates.values() for w in words_of(t)}
        self.rare = math.log(1 + total) + 1
        self.vectors = {}
        for name in sorted(templates):
            v = {w: n * self.idf[w] for w, n in Counter(words_of(templates[name])).items()}
            size = math.sqrt(sum(x * x for x in v.values()))
            self.vectors[name] = {w: x / size for w, x in v.items()} if size else {}
        self.least = least
        #: Of each word the templates that hold it, with their squared weights.
        self.parts: dict[str, list[tuple[str, float]]] = {}
        for name, v in self.vectors.items():
            for w, x in v.items():
                self.parts.setdefault(w, []).append((name, x * x))
        # Without its heaviest words, what is left of a template is shorter than the least cosine.
        self.marks = set()
        for v in self.vectors.values():
            left = 1.0
            for w in sorted(v, key=lambda w: (-v[w], w)):
                if left < least * least - 1e-9:
                    break
                self.marks.add(w)
                left -= v[w] * v[w]

    def reaches(self, words: set[str]) -> bool:
        """Whether a text of these words, or of some of them, can reach the least cosine with a template."""
        if self.marks.isdisjoint(words):
            return False
        held: dict[str, float] = {}
        for w in words:
            for name, square in self.parts.get(w, ()):
                held[name] = held.get(name, 0.0) + square
        return max(held.values(), default=0.0) >= self.least * self.least - 1e-9

    def best(self, text: str) -> tuple[str | None, float]:
        counts = Counter(words_of(text))
        # Words outside the templates weigh as much as the rarest word.
        v = {w: n * self.idf.get(w, self.rare) for w, n in counts.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        best: tuple[str | None, float] = (None, 0.0)
        for name, t in self.vectors.items():
            dot = sum(x * v[w] for w, x in t.items() if w in v)
            if size and dot / size > best[1] + 1e-12:
                best = (name, dot / size)
        return best


def fit_templates(files: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> Templates:
    """Counts, over all rows of ``files(text)``, of the rows that hold each template word."""
    wanted = {w for t in templates.values() for w in words_of(t)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                found[""] += 1
                found.update(wanted.intersection(words_of(text.as_py() or "")))
        yield pa.record_batch({"word": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})

    rows = files.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    held = {r["word"]: r["n"] for r in rows.collect()}  # as many rows as the templates have words
    total = held.pop("", 0)
    return Templates(templates, held, total, least)


class Texts:
    """Standard notices and whole licence texts, each with document frequencies among themselves."""

    def __init__(self, notices: dict[str, str], bodies: dict[str, str], least: float = LEAST):
        self.least = least
        self.notices, self.bodies = (
            Templates(t, Counter(w for x in t.values() for w in set(words_of(x))), len(t), least) for t in (notices, bodies)
        )
        #: Words of the longest window: what is longer than twice the longest notice has other text for the most part.
        self.most = 2 * max((len(words_of(t)) for t in notices.values()), default=0)

    def windows(self, text: str, models: list[Templates]) -> tuple[str | None, float, str]:
        """The best of all runs of lines without a blank line between that can reach the least score, the first of equal ones."""
        best, at = (None, 0.0), ""
        run: list[tuple[str, list[str]]] = []
        marks = set().union(*(m.marks for m in models))
        for line in [*text.split("\n"), ""]:
            words = words_of(line)
            if words or re.search(r"[^\w\s]", line):
                # A comment's empty lines are part of it.
                run.append((line, words))
                continue
            hits = [bool(marks.intersection(w)) for _, w in run]
            if any(hits):
                for i in range(len(run)):
                    if not run[i][1]:
                        continue
                    n, held = 0, False
                    counts: Counter = Counter()
                    # Of each model, the squared weights of all words and of those that templates have: their ratio bounds the cosine.
                    size, inside = [0.0] * len(models), [0.0] * len(models)
                    for j in range(i, len(run)):
                        n += len(run[j][1])
                        if n > self.most:
                            break
                        held |= hits[j]
                        for w in run[j][1]:
                            for x, m in enumerate(models):
                                weight = m.idf.get(w)
                                square = (weight or m.rare) ** 2 * (2 * counts[w] + 1)
                                size[x] += square
                                inside[x] += square if weight else 0.0
                            counts[w] += 1
                        # A window that ends without words of its own equals a shorter one.
                        if held and run[j][1]:
                            for x, m in enumerate(models):
                                if inside[x] >= (self.least**2 - 1e-9) * size[x]:
                                    window = "\n".join(t for t, _ in run[i : j + 1])
                                    found = m.best(window)
                                    if found[1] > best[1] + 1e-12:
                                        best, at = found, window
            run = []
        return *best, at

    def best(self, text: str, words: set[str], lines: Templates) -> tuple[str | None, float, str]:
        """What states a licence beyond single lines: tags, windows of lines, the text as a licence file."""
        tag = SPDX.search(text)
        if tag:
            # The whole line of the tag.
            a, b = text.rfind("\n", 0, tag.start()) + 1, text.find("\n", tag.end())
            return re.sub(r"(?<=\d)-(?:only|or-later)\b", "", tag[1]), 1.0, text[a : b if b >= 0 else len(text)]
        models = [m for m in (lines, self.notices) if m.reaches(words)]
        name, score, at = self.windows(text, models) if models else (None, 0.0, "")
        if self.bodies.reaches(words):
            found = self.bodies.best(text)
            if found[1] > score + 1e-12:
                name, score, at = *found, text
        return name and name.split("|")[0], score, at


def state_of(text: str, model: Templates, texts: Texts, least: float) -> tuple[str | None, float, float]:
    """The licence that a text states, its similarity, and the share of the text's words in what states it."""
    if not text:
        return None, 0.0, 0.0
    words = set(words_of(text))
    best, line_of = (None, 0.0), ""
    if model.reaches(words):
        for line in text.split("\n"):
            if model.reaches(set(words_of(line))):
                found = model.best(line)
                if found[1] > best[1]:
                    best, line_of = found, line
        if best[1] < least:
            found = model.best(text)
            if found[1] > best[1]:
                best, line_of = found, text
    if best[1] < least:
        *found, where = texts.best(text, words, model)
        if found[1] > best[1]:
            best, line_of = tuple(found), where
    if best[1] < least:
        return None, 0.0, 0.0
    return best[0], best[1], len(words_of(line_of)) / max(len(words_of(text)), 1)


def stated_licenses(files: DataFrame, model: Templates, *, least: float = LEAST, texts: Texts | None = None) -> DataFrame:
    """``path, own, similarity, covers`` of every row of ``files(path, text)``.

    ``covers`` is the share of the file's words in the lines that state the licence.
    """
    texts = texts or Texts(NOTICES, license_texts(), least)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [state_of(t.as_py() or "", model, texts, least) for t in batch["text"]]
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.record_batch(
                [*(batch[c] for c in kept), *(pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.float64())))],
                names=[*kept, "own", "similarity", "covers"],
            )

    columns = files.select("doc_id", F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    kind = dict(columns.dtypes)["doc_id"]
    return columns.mapInArrow(read, f"doc_id {kind}, path string, own string, similarity double, covers double")


def scan_licenses(
    files: DataFrame, *, templates: dict[str, str] = TEMPLATES, least: float = LEAST, license_file: str = r"(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$", whole: float = 0.5
) -> DataFrame:
    """``doc_id, path, own, similarity, license, inherited_from`` of every row of ``files(doc_id, path, text)``.

    A licence file is one that states a licence and is named like one, or whose words are the statement for the most
    part (``whole``). Several in a directory: the smallest path.
    """
    stated = stage(stated_licenses(files, fit_templates(files, templates, least), least=least), "licenses")
    parts = F.split("path", "/")
    directory = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/")
    is_file = F.col("path").rlike(license_file) | (F.col("covers") >= whole)
    of_directory = (
        stated.filter(F.col("own").isNotNull() & F.col("path").isNotNull() & is_file)
        .groupBy(directory.alias("directory"))
        .agg(F.min_by("own", F.struct("path", "own")).alias("given"))
    )
    stated = stated.withColumn("from", F.when(F.col("own").isNull(), directory))
    # Each directory of files without a licence of their own looks up once, however many files it has.
    asking = stated.filter(F.col("from").isNotNull()).groupBy("from").agg(F.count("*").alias("files"))
    above = F.transform(F.sequence(F.lit(0), F.size(F.split("from", "/"))), lambda n: F.array_join(F.slice(F.split("from", "/"), 1, n), "/"))
    nearest = stage(
        asking.select("from", "files", F.posexplode(F.array_distinct(above)).alias("depth", "directory"))
        .join(of_directory, "directory", "left")
        .groupBy("from")
        .agg(F.first("files").alias("files"), F.max_by(F.struct("directory", "given"), F.when(F.col("given").isNotNull(), F.col("depth"))).alias("near")),
        "nearest-licenses",
    )
    is_hot = F.col("files") >= HOT_SHARE * stated.count()
    hot = F.broadcast(nearest.filter(is_hot).select("from", "near"))
    common = stated.join(hot, "from")
    others = stated.join(hot.select("from"), "from", "left_anti").filter(F.col("from").isNotNull()).join(nearest.filter(~is_hot).select("from", "near"), "from")
    alone = stated.filter(F.col("from").isNull())
    columns = ["doc_id", "path", "own", "similarity"]
    found = common.unionByName(others).select(
        *columns, F.coalesce("own", "near.given").alias("license"), F.when(F.col("own").isNull(), F.col("near.directory")).alias("inherited_from")
    )
    return found.unionByName(alone.select(*columns, F.col("own").alias("license"), F.lit(None).cast("string").alias("inherited_from")))
