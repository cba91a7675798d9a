"""License scans with DataFrame functions only.

The lines of every file (stretches of as many lines as a template has) and
whole licence files are compared with templates by the cosine of sparse TF-IDF
vectors. Document frequencies of the templates' words come from all texts; any
other word weighs as if one text held it. A stretch can only reach the
threshold if it holds one of a template's heaviest words, so only such
stretches are vectorised. Files without a licence of their own inherit the one
of the nearest directory above them that holds a licence file.

Notices, licence texts and SPDX tags are looked for apart from lines: a stretch
has as many words as the notice, so comment marks and line ends do not matter.
Its vector has the weight of each distinct word. No stretch reaches the threshold
without one of the notice's rarest words, so only the surroundings of these words
are looked at, and of them only those that hold enough other words of the notice. There every
offset is judged: a word counts in the stretches in which it stands first, so sums that run
over the offsets give the products and lengths of all stretches in one pass.

The templates are a parameter; directories are reduced to
distinct ones before they are joined, and only file names, no texts, are
shuffled for it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from importlib import resources

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.shared import materialise, require_columns, require_text
from foldwise.operators.lookup import Lookup, attach, fit_lookup

#: fixed values: short forms of well-known licences
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("Proprietary", "All rights reserved."),
)
_GNU = ("This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License "
        "as published by the Free Software Foundation; either version {2} of the License, or (at your option) any later version. ")
_GNU_END = ("This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
            "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1}General Public License for more details.")
#: fixed values: notices at the head of files, found anywhere in a text
NOTICES = (
    *TEMPLATES,
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
     "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
     "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
     "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
     "limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    *((name, part.format(what, kind, version)) for name, what, kind, version in (
        ("AGPL-3.0", "program", "Affero ", "3"), ("GPL-2.0", "program", "", "2"), ("GPL-3.0", "program", "", "3"),
        ("LGPL-2.1", "library", "Lesser ", "2.1"), ("LGPL-3.0", "library", "Lesser ", "3")) for part in (_GNU, _GNU + _GNU_END)),
)
#: fixed values: headings, which have a line of their own
TITLES = (
    ("Apache-2.0", "Apache License Version 2.0"), ("Apache-2.0", "Apache License 2.0"), ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"), ("GPL-2.0", "GNU General Public License Version 2"),
    ("GPL-3.0", "GNU General Public License Version 3"), ("ISC", "ISC License"), ("MIT", "MIT License"), ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
SPDX = (r"(?i)SPDX-License-Identifier:[ \t]*(\(?[a-z0-9][a-z0-9.+-]*\)?"
        r"(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(?[a-z0-9][a-z0-9.+-]*\)?)*)")
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|unlicense|notice)([.-][^/]*)?$"
#: tables of template words up to this size are broadcast
BROADCAST_WORDS = 100_000
BODY_WORDS = 50
#: squared weights are added up as whole numbers of this fraction, so that their order does not matter
UNIT = 10 ** 9


def licence_texts() -> list[tuple[str, str]]:
    """Names and wordings of whole licences."""
    files = resources.files("foldwise.llm").joinpath("licence_texts").iterdir()
    return sorted((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in files if f.name.endswith(".txt"))


def words(text: Column) -> Column:
    """Lower-case words of a-z and 0-9."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), "")


def _counts(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    word = ""
    for c in text.lower() + " ":
        if "a" <= c <= "z" or "0" <= c <= "9":
            word += c
        elif word:
            out[word] = out.get(word, 0) + 1
            word = ""
    return out


def inverse_frequencies(df: DataFrame, text: str, vocabulary: Sequence[str]) -> tuple[dict[str, float], float]:
    """ln((1 + n) / (1 + texts with the word)) + 1 of each word, and the weight of any other word."""
    known = F.filter(words(F.col(text)), lambda w: w.isin(list(vocabulary)))
    held = df.select(F.explode(F.array_append(F.array_distinct(known), "")).alias("w"))
    counts = {r["w"]: r["count"] for r in held.groupBy("w").count().collect()}  # a row per template word
    n = counts.pop("", 0)
    return ({w: math.log((1 + n) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}, math.log((1 + n) / 2) + 1)


def _heavy_words(weights: dict[str, float], threshold: float) -> list[str]:
    """The heaviest words of a template: without one of them no text reaches the threshold."""
    left = total = sum(w * w for w in weights.values())
    out = []
    for word in sorted(weights, key=lambda w: (-weights[w], w)):
        if left < threshold * threshold * total * (1 - 1e-9):
            break
        out.append(word)
        left -= weights[word] ** 2
    return out


def scan_licences(
    df: DataFrame, path: str = "path", text: str = "text", licence_file: Column | None = None,
    templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = 0.8,
    notices: Sequence[tuple[str, str]] | None = None, notice_threshold: float = 0.8,
) -> DataFrame:
    """Add ``licence``, ``licence_score``, ``licence_origin`` and ``licence_dir`` to every file.

    ``licence_origin`` is 'own' for a file with a matching stretch (or, for
    licence files, whole text), 'inherited' for one with a licence file in a
    directory above it, else null like the other columns. ``licence_file`` tells
    licence files apart, by default by their names. The best match has the
    highest cosine (to six digits), then the smallest template name; of several
    licence files in a directory the best match counts, then the smallest path.

    ``notices`` (by default, with the default templates: ``NOTICES``, ``TITLES``
    and ``licence_texts()``, with SPDX tags) are compared with stretches of as
    many words anywhere in the text. What is found in ``BODY_WORDS`` words or more
    and SPDX tags, whose expression is the licence, come before matching lines.

    A null path has no directory; null and empty texts match nothing. Repeated
    rows are kept and get the same result. Without templates nothing matches.
    Columns with the names of outputs are replaced.
    """
    require_text(df, path, text)
    require_columns(df, [path, text])
    outputs = ["licence", "licence_score", "licence_origin", "licence_dir"]
    vectors = [(name, body, _counts(body)) for name, body in templates]
    vectors = [v for v in vectors if v[2]]
    known = notices is None and templates is TEMPLATES
    wordings = [(name, body, False) for name, body in (NOTICES if known else notices or ())]
    if known:
        wordings += [(name, body, False) for name, body in licence_texts()] + [(name, body, True) for name, body in TITLES]
    wordings = [w for w in wordings if _counts(w[1])]
    is_file = F.coalesce(F.col(path).rlike(LICENCE_FILE) if licence_file is None else licence_file, F.lit(False))
    rest = [c for c in df.columns if c not in outputs]
    marked = df.select(*[F.col(f"`{c}`") for c in rest], is_file.alias("__is_file"), F.xxhash64(text).alias("__hash"))
    rows = marked.withColumn("__dir", F.when(F.instr(path, "/") > 0, F.regexp_extract(path, "^(.*)/[^/]*$", 1)).otherwise(
        F.when(F.col(path).isNotNull(), F.lit(""))))
    if not vectors and not wordings:
        return df.select(*rest, *[F.lit(None).cast(t).alias(c) for c, t in zip(
            outputs, ("string", "double", "string", "string"))])
    vocabulary = sorted({w for _, _, c in vectors for w in c} | {w for _, body, _ in wordings for w in _counts(body)})
    idf, other = inverse_frequencies(marked, text, vocabulary)
    best = _matches(marked, path, text, vectors, threshold, idf, other) if vectors else None
    if wordings:
        more = _notices(marked, path, text, wordings, notice_threshold, idf, other, known)
        both = more.withColumn("line", F.lit(False))
        if best is not None:
            both = both.unionByName(best.withColumns({"body": F.lit(False), "line": F.lit(True)}))
        # a licence that a line matches keeps the score of the line
        lined = F.max(F.when(F.col("line"), F.col("licence"))).over(Window.partitionBy("path", "hash"))
        both = both.withColumn("lined", lined).filter(F.col("line") | F.col("body") | ~F.col("licence").eqNullSafe(F.col("lined")))
        first = Window.partitionBy("path", "hash").orderBy(F.desc("body"), F.desc("score"), F.asc("licence"))
        best = both.withColumn("n", F.row_number().over(first)).filter(F.col("n") == 1).drop("n", "body", "line", "lined")
    best = materialise(best)
    own = best.select(F.col("path").alias("__p"), F.col("hash").alias("__h"), F.col("licence").alias("__own"),
                      F.col("score").alias("__score"))
    found = rows.drop(text).join(own, F.col(path).eqNullSafe(F.col("__p")) & (F.col("__hash") == F.col("__h")), "left").drop("__p", "__h")
    joined = attach(found, _inherited(found, path), on=["__dir"])
    result = joined.select(
        *[F.col(f"`{c}`") for c in rest if c != text], F.col("__hash"),
        F.coalesce("__own", "__from").alias("licence"),
        F.when(F.col("__own").isNotNull(), F.col("__score")).otherwise(F.col("__from_score")).alias("licence_score"),
        F.when(F.col("__own").isNotNull(), "own").when(F.col("__from").isNotNull(), "inherited").alias("licence_origin"),
        F.when(F.col("__own").isNull(), F.col("__from_dir")).alias("licence_dir"))
    return result.drop("__hash")


def _stretch(n: int):
    """The n lines from a place on; transform() would take a second argument for the index."""
    return lambda i: F.struct(F.lit(n).alias("lines"), F.array_join(F.slice("lines", i, n), "\n").alias("unit"))


def _least_shared(weights: Sequence[float], threshold: float) -> int:
    """How many distinct words of a notice a text must hold at least to reach the threshold."""
    left, n = threshold * threshold * sum(w * w for w in weights) * (1 - 1e-9), 0
    for w in sorted(weights, reverse=True):
        if left <= 0:
            break
        left, n = left - w * w, n + 1
    return n


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_WORDS else table


def _notices(
    rows: DataFrame, path: str, text: str, wordings, threshold: float, idf: dict[str, float], other: float, tags: bool,
) -> DataFrame:
    """(path, hash, licence, score, body) of the best stretches that match a notice, and of SPDX tags."""
    spark = rows.sparkSession
    names, own, norms, least, sizes, titles, anchors = [], [], [], [], [], [], {}
    for i, (name, body, title) in enumerate(wordings):
        weights = {w: idf[w] for w in _counts(body)}
        names.append(name)
        own.append(sorted(weights))
        norms.append(math.sqrt(sum(w * w for w in weights.values())))
        least.append(_least_shared(list(weights.values()), threshold))
        sizes.append(sum(_counts(body).values()))
        titles.append(title)
        for word in _heavy_words(weights, threshold):
            anchors.setdefault(word, []).append(i)
    rare = sorted(anchors)
    in_lines = sorted(w for w, found in anchors.items() if any(titles[i] for i in found))

    def fact(values: list, kind: str, i: Column) -> Column:
        return F.lit(values).cast(f"array<{kind}>")[i]

    owners = F.create_map(*[x for w in rare for x in (F.lit(w), F.lit(anchors[w]).cast("array<int>"))])
    lists = F.array(*[F.split(F.lit(" ".join(o)), " ") for o in own])

    def holds(part: Column, i: Column) -> Column:
        """Whether enough words of a notice are there for the threshold."""
        return F.size(F.array_intersect(lists[i], part)) >= fact(least, "int", i)

    tag = F.regexp_extract(text, SPDX, 1) if tags else F.lit("")
    held = rows.select(F.col(path).alias("path"), F.col("__hash").alias("hash"), F.col("__is_file").alias("is_file"),
                       F.col(text).alias("text"), words(F.col(text)).alias("words"), tag.alias("tag"))
    place = F.filter(F.transform("words", lambda w, at: F.struct(F.when(w.isin(rare), w).alias("word"), at.alias("at"))),
                     lambda p: p.word.isNotNull())
    near = held.select("*", place.alias("places")).filter(F.size("places") > 0)
    # a stretch with a place in the b-th piece of as many words as the notice lies in the words around that piece
    spots = F.array_distinct(F.flatten(F.transform("places", lambda p: F.transform(owners[p.word], lambda i: F.struct(
        i.alias("i"), F.floor(p.at / fact(sizes, "int", i)).cast("int").alias("piece"))))))
    near = near.select("*", spots.alias("spots"))

    def around(spot: Column) -> Column:
        size = fact(sizes, "int", spot.i)
        first = F.greatest((spot.piece - 1) * size + 1, F.lit(0))
        return F.struct(spot.i.alias("i"), spot.piece.alias("at"), size.alias("size"), F.slice(
            "words", first + 1, (spot.piece + 2) * size - 1 - first).alias("part"))

    stretches = F.transform(F.filter("spots", lambda x: ~fact(titles, "boolean", x.i)), around)
    wholes = F.transform(F.array_distinct(F.transform("spots", lambda x: x.i)), lambda i: F.struct(
        i.alias("i"), F.lit(-1).alias("at"), F.size("words").alias("size"), F.col("words").alias("part")))
    headings = F.filter("spots", lambda x: fact(titles, "boolean", x.i))
    lines = F.filter(F.transform(F.split("text", "\r?\n"), words), lambda line: F.exists(line, lambda w: w.isin(in_lines)))
    lined = F.flatten(F.transform(F.array_distinct(F.transform(headings, lambda x: x.i)), lambda i: F.transform(
        "lines", lambda line, at: F.struct(i.alias("i"), (-2 - at).alias("at"), F.size(line).alias("size"), line.alias("part")))))
    near = near.select("*", F.when(F.size(headings) > 0, lines).otherwise(F.slice(F.array("words"), 1, 0)).alias("lines"))
    units = F.concat(stretches, F.when(F.col("is_file"), wholes).otherwise(F.slice(wholes, 1, 0)), lined)
    found = near.select("path", "hash", F.explode(F.filter(units, lambda u: holds(u.part, u.i))).alias("u")).select("path", "hash", "u.*")
    # numbered once and written, so that the numbers stay
    found = materialise(found.dropDuplicates(["path", "hash", "i", "at"]).withColumn("uid", F.monotonically_increasing_id()))
    facts = [(i, names[i], norms[i], sizes[i] >= BODY_WORDS) for i in range(len(names))]
    facts = _small(spark.createDataFrame(facts, "i int, licence string, norm double, body boolean"), len(facts))
    best = _best_stretches(found, own, idf, other).join(facts, "i")
    score = F.round(F.sqrt(F.col("square") / UNIT) / F.col("norm"), 6)
    scored = best.select("path", "hash", "licence", score.alias("score"), "body").filter(F.col("score") >= threshold)
    tagged = held.filter(F.col("tag") != "").select(
        "path", "hash", F.col("tag").alias("licence"), F.lit(1.0).alias("score"), F.lit(True).alias("body")).distinct()
    return scored.unionByName(tagged)


def _best_stretches(units: DataFrame, own: Sequence[Sequence[str]], idf: dict[str, float], other: float) -> DataFrame:
    """(path, hash, i, square): per unit the greatest dot * dot / length2 over its stretches of ``size`` words.

    A word adds to the stretches in which it stands first: those that begin behind its place before and hold its place. Where they begin
    and end its weight is added and taken off again, and sums that run over the offsets give all stretches.
    """
    spark = units.sparkSession
    squares = _small(spark.createDataFrame([(w, round(x * x * UNIT)) for w, x in idf.items()], "word string, known bigint"), len(idf))
    pairs = [(w, i) for i, o in enumerate(own) for w in o]
    shared = _small(spark.createDataFrame(pairs, "word string, i int").withColumn("mine", F.lit(True)), len(pairs))
    word = units.select("uid", "i", F.least("size", F.size("part")).alias("size"), F.size("part").alias("m"), F.posexplode("part").alias("at", "word"))
    before = F.coalesce(F.lag("at").over(Window.partitionBy("uid", "word").orderBy("at")), F.lit(-1))
    first = word.withColumns({
        "from": F.greatest(before + 1, F.col("at") - F.col("size") + 1, F.lit(0)), "to": F.least(F.col("at"), F.col("m") - F.col("size"))})
    first = first.filter(F.col("from") <= F.col("to")).join(squares, "word", "left").join(shared, ["word", "i"], "left")
    x = F.coalesce("known", F.lit(round(other * other * UNIT)).cast("bigint"))
    change = F.explode(F.array(F.struct(F.col("from").alias("s"), x.alias("x")), F.struct((F.col("to") + 1).alias("s"), (-x).alias("x"))))
    steps = first.select("uid", "mine", change.alias("c")).groupBy("uid", F.col("c.s").alias("s")).agg(
        F.sum("c.x").alias("length2"), F.sum(F.when(F.col("mine"), F.col("c.x")).otherwise(0)).alias("dot"))
    upto = Window.partitionBy("uid").orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = steps.select("uid", F.sum("length2").over(upto).alias("length2"), F.sum("dot").over(upto).alias("dot"))
    square = F.try_divide(F.col("dot").cast("double") * F.col("dot").cast("double"), F.col("length2").cast("double"))
    best = sums.groupBy("uid").agg(F.max(square).alias("square"))
    return units.select("uid", "path", "hash", "i").join(best, "uid")


def _matches(
    rows: DataFrame, path: str, text: str, vectors, threshold: float, idf: dict[str, float], other: float,
) -> DataFrame:
    """The best template of each (path, text hash) that has one."""
    spark = rows.sparkSession
    vocabulary = sorted({w for _, _, c in vectors for w in c})
    weights = [(name, {w: n * idf[w] for w, n in counts.items()}, body.strip().count("\n") + 1) for name, body, counts in vectors]
    heavy = sorted({w for _, own, _ in weights for w in _heavy_words(own, threshold)})
    pattern = "(?i)(^|[^a-zA-Z0-9])(" + "|".join(heavy) + ")($|[^a-zA-Z0-9])"
    near = rows.filter(F.col(text).rlike(pattern)).dropDuplicates([path, "__hash"])
    lines = F.split(F.col(text), "\r?\n")
    units = []
    for n in sorted({n for _, _, n in weights}):
        last = F.greatest(F.size("lines") - n + 1, F.lit(1))
        units.append(F.transform(F.sequence(F.lit(1), last), _stretch(n)))
    whole = F.array(F.struct(F.lit(0).alias("lines"), F.col(text).alias("unit")))
    every = F.concat(*units, F.when(F.col("__is_file"), whole).otherwise(F.slice(whole, 1, 0)))
    cut = near.withColumn("lines", lines).select(
        F.col(path).alias("path"), F.col("__hash").alias("hash"), F.explode(every).alias("u")).filter(F.col("u.unit").rlike(pattern))
    # numbered once and written, so that the numbers stay
    held = materialise(cut.select("path", "hash", F.col("u.lines").alias("lines"), words(F.col("u.unit")).alias("words"),
                                  F.monotonically_increasing_id().alias("uid")))
    table = F.broadcast(spark.createDataFrame(
        [(w, name, float(v), n) for name, own, n in weights for w, v in own.items()],
        "word string, licence string, weight double, of_lines int"))
    norms = {name: math.sqrt(sum(v * v for v in own.values())) for name, own, _ in weights}
    factor = F.create_map(*[x for w in vocabulary for x in (F.lit(w), F.lit(idf[w]))])
    counted = held.select("uid", "lines", F.explode("words").alias("word")).groupBy("uid", "lines", "word").agg(
        F.count(F.lit(1)).alias("n")).withColumn("x", F.col("n") * F.coalesce(factor[F.col("word")], F.lit(other)))
    counted = materialise(counted)
    length = counted.groupBy("uid").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    dots = counted.join(table, "word").filter((F.col("lines") == 0) | (F.col("lines") == F.col("of_lines"))).groupBy(
        "uid", "licence").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    norm = F.create_map(*[x for name, v in norms.items() for x in (F.lit(name), F.lit(v))])[F.col("licence")]
    scored = dots.join(length, "uid").select("uid", "licence", F.round(F.col("dot") / (F.col("length") * norm), 6).alias("score"))
    good = scored.filter(F.col("score") >= threshold).join(held.select("uid", "path", "hash"), "uid")
    first = Window.partitionBy("path", "hash").orderBy(F.desc("score"), F.asc("licence"))
    return good.withColumn("n", F.row_number().over(first)).filter(F.col("n") == 1).select("path", "hash", "licence", "score")


def _inherited(found: DataFrame, path: str) -> Lookup:
    """For each directory with files the licence of the nearest directory at or above it.

    The table has a row per directory and knows how many files each holds, so
    that a directory with many of them does not gather in one task.
    """
    light = materialise(found.filter(F.col("__dir").isNotNull()).select(path, "__dir", "__is_file", "__own", "__score"))
    first = Window.partitionBy("__dir").orderBy(F.desc("__score"), F.asc(path), F.asc("__own"))
    holders = light.filter(F.col("__is_file") & F.col("__own").isNotNull()).withColumn(
        "n", F.row_number().over(first)).filter(F.col("n") == 1)
    holders = materialise(holders.select(F.col("__dir").alias("__from_dir"), F.col("__own").alias("__from"), F.col("__score").alias("__from_score")))
    dirs = light.groupBy("__dir").agg(F.count(F.lit(1)).alias("__files"))
    parts = F.split("__dir", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(
        i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("up")))
    # a directory and all above it, the root ('') included
    ways = dirs.select("__dir", "__files", F.inline(F.when(F.col("__dir") == "", F.slice(up, 1, 1)).otherwise(up)))
    met = ways.join(holders, F.col("up") == F.col("__from_dir"))
    nearest = met.groupBy("__dir").agg(
        F.max_by(F.struct("__from", "__from_score", "__from_dir"), "depth").alias("f"), F.max("__files").alias("__files"))
    return fit_lookup(nearest.select("__dir", "f.*", "__files"), ["__dir"], ["__from", "__from_score", "__from_dir"], rows="__files")
