"""License scans against plain Python with the same rules."""

import random
import re
import re._parser as parser
from dataclasses import replace

from tidebar.llm import licenses
from tidebar.llm.licenses import BASE, GATE, rules, scan
from tidebar.llm.queries import op4_license_scan

SF = "/root/testdata/sf0.001"
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def expected(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = WORDS.findall(low)
    starts, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += found
        labels |= {label} if found else set()
    line = f" {' '.join(words)} "
    hits = [
        (m.start(), m.end(), r)
        for r in rules()
        if r.keyword in line
        for m in re.finditer(r.pattern, line)
    ]
    kept = [
        (a, b, r)
        for a, b, r in hits
        if not any(
            c <= a and b <= d and (o.priority < r.priority or o.priority == r.priority and d - c > b - a)
            for c, d, o in hits
        )
    ]
    score = 1.0 if starts else max((r.score for _, _, r in kept), default=0.0)
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(labels)), ",".join(sorted(labels | {r.label for _, _, r in kept})), score,
    )


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:] == expected(texts[r.doc_id]), texts[r.doc_id]


CASES = [
    None, "", " .,;", "Released under the MIT License.", "under the MIT license under the mit license",
    "CC BY-NC 4.0", "cc by nc cc by nc", "Licensed under CC BY-NC-SA 4.0", "Apache License, Version 2.0", "apache license version 2",
    "Licensed under the Apache License, Version 2.0.", "licensed under the GNU General Public License, version 3.",
    "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: MIT", "this is placed in the public domain", "mit der Lizenz",
    "Ünder the MIT License é", "under the KMIT license", "xunder the mit license", "1under the mit license1",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "the BSD-3-Clause license", "BSD license", "All Rights Reserved",
]


def test_cases(spark):
    texts = dict(enumerate(CASES))
    texts[99] = "word " * 60_000 + "under the MIT license" + " word" * 60_000 + " CC BY NC"
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in texts.items()], "doc_id int, text string, labels string, rules int")
    check(scan(df).collect(), texts)
    assert scan(df.limit(0)).collect() == []
    twice = df.where("doc_id = 3")
    assert len(scan(twice.union(twice)).collect()) == 2


def test_random_mixtures(spark):
    rng = random.Random(4)
    parts = "under the mit license apache version 2 0 cc by nc sa licensed gnu general public 3 bsd clause spdx identifier . , x".split()
    texts = {i: " ".join(rng.choices(parts, k=rng.randrange(1, 40))) for i in range(300)}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    check(scan(df).collect(), texts)


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check(op4_license_scan(spark, SF).collect(), texts)


def alternatives(parsed):
    """Texts that a parsed expression matches; each alternative of each part is in one at least."""
    parts = []
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            parts.append([chr(arg)])
        elif name == "NOT_LITERAL":
            parts.append(["w"])
        elif name == "IN":
            parts.append([chr(a) if str(o) == "LITERAL" else chr(a[0]) if str(o) == "RANGE" else "x" for o, a in arg])
        elif name == "MAX_REPEAT":
            parts.append([""] * (arg[0] == 0) + alternatives(arg[2]))
        elif name == "SUBPATTERN":
            parts.append(alternatives(arg[3]))
        elif name == "BRANCH":
            parts.append([t for branch in arg[1] for t in alternatives(branch)])
        else:
            assert name in ("ASSERT", "ASSERT_NOT")
    most = max(map(len, parts), default=1)
    return ["".join(p[i % len(p)] for p in parts) for i in range(most)]


def test_keywords_lose_no_hit(spark, monkeypatch):
    every = rules()
    texts = dict(enumerate(sorted({t for r in every for t in alternatives(parser.parse(r.pattern))})))
    texts |= {-1: "licensed under the Expat license", -2: "Licenced under", -3: "terms of the GNU Library General Public Licence"}
    assert all(r.keyword in t for r in every for t in alternatives(parser.parse(r.pattern)))
    monkeypatch.setitem(globals(), "rules", lambda: [replace(r, keyword="") for r in every])
    rows = scan(spark.createDataFrame(list(texts.items()), "doc_id int, text string").repartition(8)).collect()
    check(rows, texts)
    labels = {r.doc_id: r.labels.split(",") for r in rows}
    assert "mit" in labels[-1] and labels[-2] == ["other"] and "lgpl" in labels[-3]


def test_sentences_exceptions_choices_and_refusals(spark):
    texts = {
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0": "apache-2",
        "Neither the name may be used to endorse or promote products derived from this software without specific prior written permission.": "bsd-3",
        "published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version": "gpl-3-or-later",
        "GPL-2.0-or-later WITH Classpath-exception-2.0": "classpath-exception,gpl-2-or-later",
        "Dual-licensed: MIT OR Apache-2.0": "dual",
        "https://creativecommons.org/licenses/by-nc-sa/4.0/": "cc-by-nc-sa",
        "It is not licensed under the GNU General Public License, version 3.": "not-licensed",
        "It is not released under the MIT license but licensed under the Apache License, Version 2.0": "apache-2,not-licensed",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.": "zlib",
        "limits and permits": "",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = scan(df).collect()
    check(rows, dict(enumerate(texts)))
    got = {list(texts)[r.doc_id]: set(r.labels.split(",")) for r in rows}
    for text, labels in texts.items():
        assert set(labels.split(",")) <= got[text], (text, got[text])
    assert not got["It is not licensed under the GNU General Public License, version 3."] & {"gpl", "gpl-3"}
    assert got["limits and permits"] == {""}


def test_every_rule_passes_the_gate(spark):
    lines = sorted({t for r in rules() for t in alternatives(parser.parse(r.pattern))})
    df = spark.createDataFrame([(t,) for t in lines], "t string")
    assert [r.t for r in df.where(~df.t.rlike(GATE)).collect()] == []


ODD = [
    None, None, "", " ", "\t\r\n \x0b\x00\x7f-_", "a", " a", "a ", "_a_", "a--b", "-a\x00b\x1fc\x7fd\x80e", "é É ß İ K", "Ünder THE mit LICENSE",
    "under the MIT license", "under the mit license", "CC -- BY\n\n-- NC", "xcc by nc", "cc by ncs", "ccby nc", "sublicense misunderstand",
    "under the mit licenseé", "—under the mit license", "under the mit license", "UNDER_THE__MIT LICENSE_", "noderivK cc by nc nd",
    "creativecommons.org/publicdomain/zero/1.0", "😀 licensed under 😀 the MIT license", "a\n" * 500 + "all rights reserved",
]


def test_odd_texts_and_ids(spark):
    rows = [(i if i else None, t) for i, t in enumerate(ODD)] + [(None, "x y"), (3, "x y"), (3, "x y")]
    got = scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    want = sorted(repr((i, *expected(t))) for i, t in rows)
    assert sorted(repr(tuple(r)) for r in got) == want


def test_words_are_counted_on_the_line_that_rules_read(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id int, text string").repartition(2)
    plan = scan(df)._jdf.queryExecution().optimizedPlan().toString()
    used = [name for name in re.findall(r"(\w+)\((?:coalesce\()?text#", plan) if name.startswith(("regexp", "rlike", "translate"))]
    assert used == ["regexp_replace"] and "RLIKE(text#" not in plan and "text#" in plan


def test_found_keywords_admit_the_rules_of_all_that_occur(spark):
    every = rules()
    rng = random.Random(6)
    words = sorted({w for r in every for w in r.keyword.split()}) + ["xmit", "redistributionsx", "cc0x", "licensed", "é", "a"]
    lines = [f" {' '.join(rng.choices(words, k=rng.randrange(0, 30)))} " for _ in range(300)]
    lines += [" not licensed under not licenced under licensed ", " redistributions redistribution ", " ", " cc0 cc "]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    found = df.selectExpr("line", f"regexp_extract_all(line, r'{licenses._keywords(every)}', 1) AS found").collect()
    for line, names in found:
        admitted = {r.keyword for r in every if any(n.startswith(r.keyword) for n in names)}
        assert admitted == {r.keyword for r in every if f" {r.keyword}" in line}


def test_what_a_rule_needs_is_in_all_its_hits():
    for r in rules():
        for text in alternatives(parser.parse(r.pattern)):
            assert f" {r.keyword}" in f" {text}" and f" {r.also}" in f" {text} "
