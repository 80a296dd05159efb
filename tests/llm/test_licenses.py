import random
import re

import pytest

from wordloom.llm import licenses
from wordloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_base(text):
    words = WORD.findall((text or "").encode().lower().decode())
    places = []
    for phrase, label in licenses.BASE_PHRASES.items():
        size = len(phrase.split())
        places += [(i, label) for i in range(len(words) - size + 1) if words[i : i + size] == phrase.split()]
    places.sort()
    ends = (places[0][0], places[-1][0]) if places else (None, None)
    return len(words), len(places), *ends, ",".join(sorted({x for _, x in places}))


def test_rules():
    rules = licenses.signature_rules()
    assert len(rules) > 300 and [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)
    assert all(r.keywords for r in rules) and len({r[1] for r in licenses.STATEMENTS}) == len(licenses.STATEMENTS) > 190


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Released under the MIT License.", "mit"),
        ("Licensed under the Apache License, Version 2.0.", "apache-2"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
        ("under the terms of the Mozilla Public License 2.0", "mpl-2.0"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
        ("dual licensed under MIT; also the Unlicense license", "mit,unlicense"),
        ("All rights reserved.", "all-rights-reserved"),
        ("the license plate of a car under the bridge", ""),
        ("ruby and php", ""),
        ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache-2"),
        ("// Use of this source code is governed by a BSD-style license", "bsd"),
        ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY", "gpl"),
        ("either version 3 of the License, or (at your option) any later version", "gpl"),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "gpl-2,gpl-classpath"),
        ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa"),
        ("Ce logiciel est régi par la licence CeCILL", "cecill"),
        ("The Software shall be used for Good, not Evil.", "json"),
        ("No part of this publication may be reproduced in any form", "proprietary"),
        ("Unauthorised copying of this file, via any medium, is strictly prohibited", "proprietary"),
        ("found in the LICENSE file in the root directory of this source tree", "see-license"),
        ("we hope that the government will build a new package", ""),
        ("", ""),
    ],
)
def test_labels(text, labels):
    _, base, found = licenses.Scanner().scan(text)
    assert ",".join(sorted({x for _, x in base} | {r.label for *_, r in found})) == labels


def test_containment_by_brute_force():
    scanner = licenses.Scanner()
    chance = random.Random(2)
    words = "under the terms of gnu general public license version 2 0 lesser mit licensed released spdx identifier cc by nc sa reserved all rights".split()
    for _ in range(300):
        line = (" " + " ".join(chance.choice(words) for _ in range(30)) + " ").encode()
        every = []
        for number, rule in enumerate(scanner.rules):
            for m in rule.pattern.finditer(line):
                if any(b" " + k + b" " in line for k in rule.keywords):
                    first = line.count(b" ", 0, m.start())
                    every.append((first, first + m.group().count(b" "), number))
        def beaten(d):
            return any(
                o != d and o[0] <= d[0] and o[1] >= d[1]
                and (scanner.rules[o[2]].priority > scanner.rules[d[2]].priority
                     or (scanner.rules[o[2]].priority == scanner.rules[d[2]].priority and ((o[0], o[1]) != (d[0], d[1]) or o[2] < d[2])))
                for o in every
            )
        want = {(a, b, scanner.rules[n].label) for a, b, n in every if not beaten((a, b, n))}
        got = {(a, b, r.label) for a, b, r in scanner.detections(line)}
        if any(mark in line for mark in scanner.likely):
            assert got == want


def test_rows(spark, odd_texts):
    texts = [*odd_texts, "x under the MIT license, cc-by.nc", "CC by NC cc BY nc", "UNDER THE MIT LICENSE", "under the mit licenses", "Under\nthe 中 MIT license"] + ["cc by nc " * 3000]
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(df.repartition(3)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_query(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op9_licenses"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(docs[r["doc_id"]])
