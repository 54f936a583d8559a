"""Licence scans against a plain version: every rule on every text, containment by comparing all pairs."""

import re

import pytest

from plateworks.llm import license_rules, license_scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [
    None,
    "",
    "?! --",
    "Released under the MIT License.",
    "MIT\nLicense, under the mit license; UNDER THE MIT-LICENSE (under the mit licenses not)",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Licensed under CC BY-NC 4.0. and CC-BY-NC-SA 3.0, cc by ncx",
    "This work is licensed under the GNU General Public License, version 3.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or later",
    "// SPDX-License-Identifier: LGPL-2.1-or-later\n// SPDX-License-Identifier: (MIT OR BSD-3-Clause)",
    "Ich komme mit Lizenz und permit license; submit licenses; mitlicense",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated docs",
    "All rights reserved. Confidential and proprietary. Ünder the MIT license für Ä",
    "Distributed under the Foo Bar License. See the LICENSE file",
    "under the MIT license " * 3000,
    "GNU GPL v3 or GPLv2 or lgpl 2.1; Apache 2 license; BSD 3-clause license",
    "x" * 30000 + " cc by nc",
]


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    base = [(i, label) for p, label in license_scan.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    line, found = " " + " ".join(words) + " ", []
    kinds = list(license_rules.KINDS)
    for rank, rule in enumerate(license_rules.rules()):
        for m in re.finditer(rule.pattern.pattern.decode(), line):
            found.append((kinds.index(rule.kind), rank, line[: m.start() - 1].count(" "), line[: m.end()].count(" "), rule.label))
    better = lambda a, b: (a[0], a[2] - a[3], a[2], a[1]) < (b[0], b[2] - b[3], b[2], b[1])
    if len(found) < 3000:  # an interval inside a suppressed one is inside the one that suppressed that
        found = [x for x in found if not any(y[2] <= x[2] and x[3] <= y[3] and better(y, x) for y in found)]
    at = [i for i, _ in base]
    score = max([0.9] * bool(base) + [license_rules.KINDS[kinds[x[0]]] for x in found], default=0.0)
    labels = {label for _, label in base}
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {x[4] for x in found})), score


def test_equals_plain_version(spark):
    rows = [(k if k % 5 else None, t, "x") for k, t in enumerate(TEXTS)] + [(3, TEXTS[3], "y")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, labels string")).drop("detections").collect()
    want = [(d, *plain(t)) for d, t, _ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_plain_version_on_whole_table(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = license_scan.op12_license_scan(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((d.doc_id, *plain(d.text))) for d in documents)


@pytest.mark.parametrize("text,labels", [
    ("Licensed under the Apache License, Version 2.0", {"apache-2"}),
    ("licensed under the GNU General Public License, version 3.", {"gpl-3"}),
    ("GNU Lesser General Public License v2.1", {"lgpl-2.1"}),
    ("GNU Affero General Public License, version 3", {"agpl-3"}),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", {"cc-by-nc-sa"}),
    ("SPDX-License-Identifier: BSD-3-Clause", {"bsd-3"}),
    ("The committee met under the old oak and published by hand", set()),
])
def test_labels(text, labels):
    assert {x.label for x in license_scan.scan_text(text.encode())[2]} == labels


def test_every_rule_holds_its_keywords_and_can_match():
    """A text spelled from each pattern matches it, and the prefilter lets it through."""
    ordered, prefilter = license_scan._ordered()
    assert len(ordered) > 300
    for rank, rule in enumerate(ordered):
        words = rule.pattern.pattern.decode()[len("(?<= )(?:") : -len(")(?= )")]
        for empty in (False, True):
            spelled = words
            while (m := re.search(r"\(\?:([^()]*)\)(\?|\{\d+,\d+\})?", spelled)):
                part = m[1].split("|")[0]
                spelled = spelled[: m.start()] + ("" if m[2] and empty else part) + spelled[m.end() :]
            spelled = re.sub(r"\[\^ \]\+", "word", spelled)
            spelled = re.sub(r"\[(?:\^)?(.)[^\]]*\](\?)?", r"\1", spelled)
            spelled = re.sub(r"(.)\?", "" if empty else r"\1", spelled)
            line = f" {spelled} "
            assert rule.pattern.search(line.encode()), (words, spelled)
            assert rank in prefilter(line), (words, spelled)


def test_suppression_by_containment():
    F = license_scan.Found
    big, inside, equal, crossing = F(9, 0, 10, "a", "name"), F(1, 2, 5, "b", "name"), F(12, 0, 10, "c", "name"), F(3, 8, 12, "d", "name")
    higher = F(0, 2, 4, "e", "tag")
    assert license_scan.unsuppressed([inside, equal, big, crossing]) == [big, crossing]
    assert license_scan.unsuppressed([big, higher, inside]) == [big, higher]
