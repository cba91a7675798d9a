import math
import random
import re

import pytest
from pyspark.sql import functions as F

from foldwise.llm import licenses

MIT, APACHE = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."


def scan(spark, rows, **options):
    frame = spark.createDataFrame(rows, "path string, text string").withColumns({c: F.lit("x") for c in ("uid", "licence", "word", "lines")})
    return {r.path: r for r in licenses.scan_licences(frame, **options).collect()}


def test_own_and_inherited(spark):
    got = scan(spark, [
        ("LICENSE", MIT), ("a.py", "x = 1"), ("lib/b.py", f"# {APACHE}\ncode"), ("lib/c/LICENSE.txt", APACHE), ("lib/c/d/e.py", "y"),
        ("lib/f.py", None), ("lib/g.py", ""), (None, MIT), ("lib/c/far.py", "All rights kept by them"), ("/abs/h.py", "z")])
    assert (got["a.py"].licence, got["a.py"].licence_origin, got["a.py"].licence_dir) == ("MIT", "inherited", "")
    assert got["lib/b.py"].licence == "Apache-2.0" and got["lib/b.py"].licence_origin == "own" and got["lib/b.py"].licence_score == 1.0
    assert got["lib/c/d/e.py"].licence == "Apache-2.0" and got["lib/c/d/e.py"].licence_dir == "lib/c"
    assert got["lib/f.py"].licence == got["lib/g.py"].licence == "MIT" and got["lib/f.py"].licence_dir == ""
    assert got["lib/c/far.py"].licence == "Apache-2.0" and got["lib/c/far.py"].licence_origin == "inherited"
    assert got[None].licence == "MIT" and got[None].licence_origin == "own"


def test_ties_repeats_and_empty_tables(spark):
    rows = [("d/LICENSE", MIT), ("d/COPYING", APACHE), ("d/x", "-"), ("d/x", "-"), ("e/y", f"{MIT}\n{APACHE}")]
    frame = spark.createDataFrame(rows, "path string, text string")
    found = licenses.scan_licences(frame).collect()
    assert [r.licence for r in found if r.path == "d/x"] == ["Apache-2.0"] * 2  # equal scores: the smaller path
    assert [r.licence for r in found if r.path == "e/y"] == ["Apache-2.0"]
    assert licenses.scan_licences(frame.limit(0)).count() == 0
    assert {r.licence for r in licenses.scan_licences(frame, templates=[("none", " , ")]).collect()} == {None}


def test_templates_of_several_lines(spark):
    body = "Use it as you like\nbut keep this notice\nand blame nobody"
    got = scan(spark, [("a", f"start\n{body}\nend"), ("b", body.replace("\n", " ")), ("c", "but keep this notice")],
               templates=[("Own", body), ("MIT", MIT)])
    assert got["a"].licence == "Own" and got["a"].licence_score == 1.0
    assert got["b"].licence == "Own" and got["c"].licence is None  # a text of fewer lines is one stretch


def test_scores_against_a_plain_computation(spark):
    rows = [(f"p{i}", t) for i, t in enumerate((
        MIT, "released under mit license", f"{MIT} really", "the mit", APACHE + " and more words here now", "license " * 30, "nothing of it"))]
    got = scan(spark, rows, threshold=0.3)
    counts = [licenses._counts(t) for _, t in rows]
    vocabulary = {w for _, t in licenses.TEMPLATES for w in licenses._counts(t)}
    n = len(rows)
    idf = {w: math.log((1 + n) / (1 + sum(w in c for c in counts))) + 1 for w in vocabulary}
    other = math.log((1 + n) / 2) + 1

    def vector(c):
        return {w: k * idf.get(w, other) for w, k in c.items()}

    for (path, _), c in zip(rows, counts):
        best = (0.0, None)
        for name, body in licenses.TEMPLATES:
            u, t = vector(c), vector(licenses._counts(body))
            dot = sum(x * t.get(w, 0) for w, x in u.items())
            cosine = round(dot / math.sqrt(sum(x * x for x in u.values()) * sum(x * x for x in t.values())), 6)
            best = max(best, (cosine, name), key=lambda b: b[0])
        assert got[path].licence == (best[1] if best[0] >= 0.3 else None)
        assert got[path].licence is None or abs(got[path].licence_score - best[0]) < 1e-6


def test_notices_texts_and_tags(spark):
    texts = dict(licenses.licence_texts())
    bsd = dict(licenses.TEMPLATES)["BSD-3-Clause"].split()
    comment = "\n".join(f" * {line}" for line in texts["MIT"].splitlines())
    cases = {
        "mit": (f"/*\n * Copyright (c) 2020 Some Body. All rights reserved.\n{comment}\n */\nint main() {{ return 0; }}\n" * 2, "MIT"),
        "wrapped": (f"# {' '.join(bsd[:9])}\n# {' '.join(bsd[9:])}\nimport os\n" + "x = 1\n" * 50, "BSD-3-Clause"),
        "within": ("# Copyright 2019 The Authors. Licensed under the Apache License, Version 2.0. More of it\ny = 2", "Apache-2.0"),
        "tag": ("// SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note\nvoid f();", "GPL-2.0-only WITH Linux-syscall-note"),
        "either": ("# SPDX-License-Identifier: (MIT OR Apache-2.0)\nz", "(MIT OR Apache-2.0)"),
        "title": ("MIT License\n\nCopyright (c) 2021 Any One", "MIT"),
        "prose": ("The MIT course told us that a license of the library may be granted to any person.\n" * 40, None),
        "lines": ("All rights reserved.\n" + texts["BSD-2-Clause"], "BSD-2-Clause"),
        "moved": ("x " * 7 + texts["GPL-3.0"], "GPL-3.0"),
        **{name: (body, name) for name, body in texts.items()}}
    got = scan(spark, [(f"{name}/f", text) for name, (text, _) in cases.items()] + [(f"n{i}/g", f"plain words {i}") for i in range(60)])
    found = {name: got[f"{name}/f"].licence for name in cases}
    assert found == {name: want for name, (_, want) in cases.items()}
    assert all(got[f"n{i}/g"].licence is None for i in range(60))


def plain_best(text, body, idf, other):
    """The best cosine of the sets of words of all stretches of a text, at every offset."""
    def listed(t):
        return [w for w in re.split("[^a-z0-9]+", t.lower()) if w]

    have, own = listed(text), set(listed(body))
    size, best = min(len(listed(body)), len(have)), 0.0
    norm = math.sqrt(sum(idf[w] ** 2 for w in own))
    for s in range(len(have) - size + 1 if have else 0):
        part = set(have[s:s + size])
        length = math.sqrt(sum(idf.get(w, other) ** 2 for w in part))
        best = max(best, sum(idf[w] ** 2 for w in part & own) / (length * norm))
    return round(best, 6)


def test_notices_equal_a_plain_cosine_over_all_offsets(spark):
    """Notices whole, wrapped, cut short, with words put in and changed, next to prose and to each other."""
    rng = random.Random(6)
    notices = [("One", "You may copy and modify this software freely if you keep this notice in all copies"),
               ("Two", "No warranty of any kind is given with this software"), ("Three", "Keep it")]
    prose = "the of this software and in a with any some other words here given notice".split()
    texts = []
    for i in range(80):
        parts = [" ".join(rng.choice(prose) for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 2)):
            listed = rng.choice(notices)[1].split()
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(listed))
                listed[at:at + rng.randint(0, 1)] = [rng.choice(prose)] * rng.randint(0, 2)
            parts += ["\n# ".join(listed), " ".join(rng.choice(prose) for _ in range(rng.randint(0, 12)))]
        texts.append("\n".join(parts))
    texts += ["", notices[0][1] * 3, "keep"]
    frame = spark.createDataFrame([(f"d{i}/f", t) for i, t in enumerate(texts)] + [("d3/f", texts[3])], "path string, text string")
    got = {r.path: r for r in licenses.scan_licences(frame, templates=(), notices=notices, notice_threshold=0.6).collect()}
    vocabulary = sorted({w for _, body in notices for w in licenses._counts(body)})
    idf, other = licenses.inverse_frequencies(frame, "text", vocabulary)
    found = 0
    for i, text in enumerate(texts):
        best = max(((plain_best(text, body, idf, other), name) for name, body in notices), key=lambda b: (b[0], [-ord(c) for c in b[1]]))
        row = got[f"d{i}/f"]
        assert (row.licence, row.licence_score) == ((best[1], best[0]) if best[0] >= 0.6 else (None, None)), (i, text)
        found += row.licence is not None
    assert 30 < found < len(texts)
    shuffled = pytest.MonkeyPatch()
    shuffled.setattr(licenses, "BROADCAST_WORDS", 0)
    again = licenses.scan_licences(frame, templates=(), notices=notices, notice_threshold=0.6).collect()
    shuffled.undo()
    assert {r.path: r for r in again} == got
