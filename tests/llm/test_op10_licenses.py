from __future__ import annotations

import re

import pytest

from tallybrook.llm import op10_licenses as lic
from tallybrook.llm.queries import op10_license_rules
from tests.llm.helpers import docs, no_docs, odd_docs, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in lic.BASE_PHRASES:
        parts = phrase.split()
        own = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += own
        labels |= {label} if own else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_every_document(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    rows = op10_license_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:6] == brute(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


TEXTS = [
    ("Licensed under the Apache License, Version 2.0 (the License)", "apache", 0.95),
    ("MIT-License mit license MIT  License", "mit", 0.6),
    ("the GNU Lesser General Public License v2.1 or later", "gpl,lgpl", 0.9),
    ("This is not a licence for mit licenses", "", 0.0),
    ("SPDX-License-Identifier: MPL 2.0", "mpl", 1.0),
    ("released into the public domain. All rights reserved", "proprietary,public-domain", 0.9),
    ("BSD 3-Clause License", "bsd-3", 0.6),
    ("the unlicense; gpl v3 or later", "gpl,unlicense", 0.8),
    ("mit licenſe mit lIcense", "mit", 0.6),
]


def test_labels(spark):
    rows = {r["doc_id"]: r for r in lic.detect(docs(spark, [t for t, _, _ in TEXTS])).collect()}
    for i, (text, labels, score) in enumerate(TEXTS):
        assert (rows[i]["labels"], rows[i]["score"]) == (labels, pytest.approx(score)), text
        assert (rows[i]["n_words"], rows[i]["n_base"], rows[i]["first_word"], rows[i]["last_word"],
                rows[i]["base_labels"]) == brute(text)


def test_contained_detections_are_suppressed(spark):
    text = "licensed under the terms of the apache license 2.0 and bsd license"
    [row] = lic.detect(docs(spark, [text])).collect()
    assert [(d["start"], d["end"], d["label"]) for d in row["detections"]] == [(0, 10, "apache"), (11, 13, "bsd")]


def test_priority_decides_between_equal_intervals(spark):
    rules = (lic.Rule("low", "licen", "some license", 1, 0.5), lic.Rule("high", "licen", "some licen[cs]e", 2, 0.4))
    [row] = lic.detect(docs(spark, ["some license"]), rules=rules).collect()
    assert (row["labels"], row["score"]) == ("high", 0.4)


def test_rules_hold_their_keyword_and_a_gate():
    rules = lic.default_rules()
    assert len(rules) > 200
    for rule in rules:
        re.compile(rule.pattern)
        sample = rule.pattern.replace("[cs]", "c")
        assert rule.keyword in sample or rule.keyword in rule.label, rule
        assert any(gate in sample for gate in lic.GATES), rule


def detections(text, rules):
    """All matches of all rules, then suppression, by hand."""
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    norm = f" {' '.join(words)} "
    order = sorted(range(len(rules)), key=lambda i: (-rules[i].priority, i))
    found = []
    for rank, i in enumerate(order):
        for m in re.finditer(f"(?<= )(?:{rules[i].pattern})(?= )", norm):
            start = norm[: m.start()].count(" ") - 1
            found.append((start, start + m[0].count(" ") + 1, rank, rules[i].label, rules[i].score))
    kept, reach = [], -1
    for d in sorted(found, key=lambda d: (d[0], -d[1], d[2])):
        if d[1] > reach:
            kept.append(d)
            reach = d[1]
    return kept


# Bodies and notices without the license's name, or with more than it.
NOTICES = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that", "bsd"),
    ("Neither the name of the Example Works Ltd. nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission.", "bsd-3"),
    ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED', "disclaimer"),
    ("you may not use this file except in compliance with the License.", "apache"),
    ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
     "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.", "disclaimer,gpl"),
    ("You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
     "the Free Software Foundation; either version 2.1", "gpl,lgpl"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("The origin of this software must not be misrepresented; you must not claim that you wrote the original software.", "zlib"),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license", "boost"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "mpl"),
    ("see http://creativecommons.org/licenses/by-nc-sa/4.0/ for all", "cc-by-nc-sa"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
]


def test_bodies_without_a_name(spark):
    rows = {r["doc_id"]: r for r in lic.detect(docs(spark, [t for t, _ in NOTICES])).collect()}
    for i, (text, labels) in enumerate(NOTICES):
        assert rows[i]["labels"] == labels, text
        assert rows[i]["score"] > 0


def test_detections_and_suppression_by_hand(spark, sf_dir):
    texts = [r["text"] for r in table(spark, sf_dir, "documents").select("text").collect()]
    texts = [t for t in texts if t and re.search("licen|copyright|permission", t, re.I)][:150]
    texts += [t for t, _, _ in TEXTS] + [t for t, _ in NOTICES] + [" ".join(t for t, _ in NOTICES)]
    rules = lic.default_rules()
    got = {r["doc_id"]: r for r in lic.detect(docs(spark, texts)).collect()}
    for i, text in enumerate(texts):
        want = detections(text, rules)
        assert [tuple(d) for d in got[i]["detections"]] == want
        base = set(filter(None, brute(text)[4].split(",")))
        assert got[i]["labels"] == ",".join(sorted({d[3] for d in want} | base))


def test_odd_documents(spark):
    rows = lic.detect(odd_docs(spark)).collect()
    assert len(rows) == odd_docs(spark).count()
    assert all(r["labels"] == "" and r["score"] == 0 and r["first_word"] is None for r in rows)
    assert {r["doc_id"]: r["n_words"] for r in rows}[0] == 0
    assert lic.detect(no_docs(spark)).collect() == []
    [long] = lic.detect(docs(spark, ["mit license " * 3000])).collect()
    assert (long["n_base"], long["first_word"], long["last_word"]) == (3000, 0, 5998)
