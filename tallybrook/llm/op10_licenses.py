"""License detection by ordered signature rules, in DataFrame functions only.

Rules are regexes over the text's words. A rule runs only on texts that hold its keyword.
Of detections, one that lies inside another is suppressed; of equal intervals the rule of
higher priority, then the earlier one, stays. Every row is worked on by itself: no shuffle.
"""

from __future__ import annotations

import functools
import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """``pattern`` matches whole lower-case words with single spaces between them."""

    label: str
    keyword: str
    pattern: str
    priority: int
    score: float


# Phrases that must be found wherever their words stand consecutively.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
# A text is looked at only if it holds one of these (every rule's pattern holds one).
GATES = (
    "licen", "spdx", "public domain", "rights reserved", "copyleft", "gpl",
    "permi", "redistribut", "warrant", "copyright", "software", "publicdomain", "mpl", "this stuff",
)

# Per label a keyword, the names of the license, and its versions if any.
# In names "l" stands for license or licence. Words are split at dots and hyphens.
FAMILIES: dict[str, tuple[str, tuple[str, ...], tuple[str, ...]]] = {
    "mit": ("mit", ("mit l", "mit x11 l", "mit style l"), ()),
    "expat": ("expat", ("expat l",), ()),
    "x11": ("x11", ("x11 l", "x consortium l"), ()),
    "apache": ("apache", ("apache l", "apache software l", "apache public l"), ("1 0", "1 1", "2 0", "2")),
    "gpl": ("public", ("general public l", "gnu general public l", "gnu public l"), ("1", "2", "3", "2 0", "3 0")),
    "gpl-short": ("gpl", ("gnu gpl", "gpl l", "gplv2", "gplv3"), ("2", "3")),
    "lgpl": ("lesser", ("lesser general public l", "gnu lesser general public l"), ("2 1", "3", "3 0")),
    "lgpl-library": ("library", ("library general public l", "gnu library general public l"), ("2", "2 0")),
    "agpl": ("affero", ("affero general public l", "gnu affero general public l"), ("1", "3", "3 0")),
    "gfdl": ("documentation", ("free documentation l", "gnu free documentation l"), ("1 1", "1 2", "1 3")),
    "bsd": ("bsd", ("bsd l", "bsd style l", "berkeley l"), ()),
    "bsd-2": ("clause", ("bsd 2 clause l", "2 clause bsd l", "two clause bsd l", "simplified bsd l"), ()),
    "bsd-3": ("clause", ("bsd 3 clause l", "3 clause bsd l", "three clause bsd l", "new bsd l"), ()),
    "bsd-4": ("clause", ("bsd 4 clause l", "4 clause bsd l", "original bsd l"), ()),
    "mpl": ("mozilla", ("mozilla public l",), ("1 0", "1 1", "2 0")),
    "isc": ("isc", ("isc l", "internet systems consortium l"), ()),
    "epl": ("eclipse", ("eclipse public l",), ("1 0", "2 0")),
    "edl": ("eclipse", ("eclipse distribution l",), ("1 0",)),
    "eupl": ("european", ("european union public l", "european union public licence"), ("1 1", "1 2")),
    "cddl": ("common", ("common development and distribution l",), ("1 0", "1 1")),
    "cpl": ("common", ("common public l",), ("1 0",)),
    "cpal": ("common", ("common public attribution l",), ("1 0",)),
    "boost": ("boost", ("boost software l", "boost l"), ("1 0",)),
    "zlib": ("zlib", ("zlib l", "zlib libpng l"), ()),
    "libpng": ("libpng", ("libpng l", "png reference library l"), ("2",)),
    "unlicense": ("unlicense", ("unlicense", "the unlicense"), ()),
    "wtfpl": ("wtfpl", ("wtfpl l", "wtfpl public l"), ("2",)),
    "artistic": ("artistic", ("artistic l", "perl artistic l", "clarified artistic l"), ("1 0", "2 0")),
    "python": ("python", ("python l", "python software foundation l"), ("2",)),
    "php": ("php", ("php l",), ("3 0", "3 01")),
    "ruby": ("ruby", ("ruby l",), ()),
    "openssl": ("openssl", ("openssl l", "ssleay l", "openssl ssleay l"), ()),
    "ofl": ("font", ("open font l", "sil open font l"), ("1 0", "1 1")),
    "osl": ("open", ("open software l",), ("1 0", "2 0", "3 0")),
    "afl": ("academic", ("academic free l",), ("2 1", "3 0")),
    "ecl": ("educational", ("educational community l",), ("1 0", "2 0")),
    "ncsa": ("ncsa", ("ncsa l", "university of illinois ncsa open source l"), ()),
    "ms-pl": ("microsoft", ("microsoft public l",), ()),
    "ms-rl": ("microsoft", ("microsoft reciprocal l",), ()),
    "apsl": ("apple", ("apple public source l",), ("1 0", "2 0")),
    "cc-by": ("attribution", ("creative commons attribution l", "creative commons attribution international l"),
              ("2 0", "2 5", "3 0", "4 0")),
    "cc-by-sa": ("share", ("creative commons attribution share alike l",
                           "creative commons attribution sharealike l"), ("2 0", "2 5", "3 0", "4 0")),
    "cc-by-nc": ("noncommercial", ("creative commons attribution noncommercial l",), ("2 0", "3 0", "4 0")),
    "cc-by-nd": ("noderiv", ("creative commons attribution noderivs l",
                             "creative commons attribution noderivatives l"), ("2 0", "3 0", "4 0")),
    "odbl": ("database", ("open database l",), ("1 0",)),
    "odc-by": ("open", ("open data commons attribution l",), ("1 0",)),
    "vim": ("vim", ("vim l",), ()),
    "curl": ("curl", ("curl l",), ()),
    "sleepycat": ("sleepycat", ("sleepycat l",), ()),
    "postgresql": ("postgresql", ("postgresql l",), ()),
    "qpl": ("qt", ("q public l", "qt public l"), ("1 0",)),
    "ibm-public": ("ibm", ("ibm public l",), ("1 0",)),
    "sspl": ("server", ("server side public l",), ("1",)),
    "busl": ("business", ("business source l",), ("1 1",)),
    "elastic": ("elastic", ("elastic l",), ("2 0",)),
}
# Rules that no family makes.
OTHERS = (
    Rule("public-domain", "public domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", 3, 0.9),
    Rule("public-domain", "public domain", "(?:is|are) in the public domain", 2, 0.8),
    Rule("cc0", "licen", "cc0 1 0 (?:universal )?licen[cs]e", 3, 0.95),
    Rule("cc0", "public domain", "creative commons public domain dedication", 3, 0.95),
    Rule("proprietary", "rights reserved", "all rights reserved", 1, 0.4),
    Rule("proprietary", "licen", "proprietary licen[cs]e", 2, 0.7),
    Rule("commercial", "licen", "commercial licen[cs]e", 1, 0.5),
    Rule("copyleft", "copyleft", "copyleft licen[cs]e", 1, 0.4),
    Rule("gpl", "gpl", "gpl (?:v|version )?[123](?: 0)?(?: or later)?", 2, 0.8),
    Rule("lgpl", "lgpl", "lgpl(?: (?:v|version )?[23](?: [01])?)?(?: or later)?", 2, 0.8),
    Rule("agpl", "agpl", "agpl(?: (?:v|version )?3(?: 0)?)?(?: or later)?", 2, 0.8),
    Rule("dual", "licen", "dual licen[cs]ed? under", 1, 0.3),
)

# Sentences by which the body or the notice of a license is known where its name
# does not stand. (label, keyword, pattern, score), as words of a text without punctuation.
BODIES = (
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 1.0),
    ("mit", "sublicense", "without (?:limitation|restriction)(?: including without limitation)? the rights to use copy modify merge publish distribute sublicense and or sell copies", 0.95),
    ("mit", "permission notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 0.95),
    ("x11", "advertising", "except as contained in this notice the names? of (?:[^ ]+ ){1,12}shall not be used in advertising or otherwise to promote the sale use or other dealings in this software", 0.95),
    ("json", "good not evil", "the software shall be used for good not evil", 1.0),
    ("boost", "organization obtaining", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", 1.0),
    ("isc", "with or without fee", "permission to use copy modify (?:and )?(?:or )?distribute this software for any purpose with or without fee is hereby granted", 0.95),
    ("isc", "disclaims all warranties", "the software is provided as is and the author disclaims all warranties with regard to this software", 0.9),
    ("curl", "with or without fee", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", 0.95),
    ("hpnd", "its documentation", "permission to use copy modify and distribute this software and its documentation for any purpose", 0.9),
    ("postgresql", "written agreement", "without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph", 0.95),
    ("bsd", "binary forms", "redistribution and use in source and binary forms with or without modification are permitted", 0.9),
    ("bsd", "retain the above copyright", "redistributions of source code must retain the above copyright notice", 0.85),
    ("bsd-2", "binary form", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer", 0.85),
    ("bsd-3", "endorse or promote", "neither the names? of (?:[^ ]+ ){1,12}n?or the names of (?:its|their) contributors may be used to endorse or promote products derived from this software", 0.95),
    ("bsd-4", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 0.95),
    ("bsd", "express or implied warranties", "this software is provided by the (?:copyright holders?|authors?|regents)(?: and contributors)? as is and any express or implied warranties", 0.8),
    ("apache", "except in compliance", "you may not use this file except in compliance with the license", 0.95),
    ("apache", "as is basis", "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind", 0.95),
    ("apache", "contributor license agreements", "licensed to the apache software foundation asf under one or more contributor license agreements", 1.0),
    ("apache", "royalty free", "grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated in this section patent) license", 0.9),
    ("apache", "apache software foundation", "this product includes software developed (?:by|at) the apache software foundation", 0.8),
    ("gpl", "redistribute it", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", 1.0),
    ("lgpl", "redistribute it", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license as published by the free software foundation", 1.0),
    ("agpl", "redistribute it", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", 1.0),
    ("gpl", "hope that it will be useful", "this program is distributed in the hope that it will be useful but without any warranty", 0.8),
    ("lgpl", "hope that it will be useful", "this library is distributed in the hope that it will be useful but without any warranty", 0.8),
    ("gpl", "received a copy", "you should have received a copy of the gnu general public license along with", 0.95),
    ("lgpl", "received a copy", "you should have received a copy of the gnu (?:lesser|library) general public license along with", 0.95),
    ("agpl", "received a copy", "you should have received a copy of the gnu affero general public license along with", 0.95),
    ("gpl", "at your option", "either version [123](?: 0)? of the license or at your option any later version", 0.7),
    ("gpl", "verbatim copies", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", 0.7),
    ("gpl", "work that you distribute", "you must cause any work that you distribute or publish that in whole or in part contains or is derived from the program or any part thereof to be licensed as a whole", 0.85),
    ("gfdl", "free documentation", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 1.0),
    ("gfdl", "invariant sections", "with no invariant sections no front cover texts and no back cover texts a copy of the license", 0.9),
    ("mpl", "source code form", "this source code form is subject to the terms of the mozilla public license", 1.0),
    ("mpl", "mpl was not distributed", "if a copy of the mpl was not distributed with this file you can obtain one at", 0.95),
    ("mpl", "secondary licenses", "this source code form is incompatible with secondary licenses", 0.9),
    ("zlib", "without any express", "this software is provided as is without any express or implied warranty", 0.9),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", 1.0),
    ("zlib", "plainly marked", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", 0.95),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 1.0),
    ("unlicense", "anyone is free", "anyone is free to copy modify publish use compile sell or distribute this software", 0.95),
    ("cc0", "neighboring rights", "waive[sd]? all (?:of (?:his|her|their|its) )?copyright and related or neighboring rights", 0.9),
    ("cc0", "publicdomain", "creativecommons org publicdomain zero 1 0", 0.95),
    ("cc-by", "creativecommons", "creativecommons org licenses by [1-4] [05]", 0.95),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa [1-4] [05]", 0.95),
    ("cc-by-nc", "creativecommons", "creativecommons org licenses by nc [1-4] [05]", 0.95),
    ("cc-by-nd", "creativecommons", "creativecommons org licenses by nd [1-4] [05]", 0.95),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licenses by nc sa [1-4] [05]", 0.95),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nc nd [1-4] [05]", 0.95),
    ("cc", "creative commons", "(?:this|the) work is licensed under (?:a|the) creative commons", 0.7),
    ("wtfpl", "do what the", "do what the [^ ]+ you want to public licen[cs]e", 0.9),
    ("beerware", "whatever you want", "as long as you retain this notice you can do whatever you want with this stuff", 1.0),
    ("artistic", "artistic control", "the copyright holder maintains some semblance of artistic control over the development of the package", 1.0),
    ("ofl", "reserved font name", "no modified version of the font software may use the reserved font name", 0.95),
    ("ofl", "font software", "permission is hereby granted free of charge to any person obtaining a copy of the font software", 1.0),
    ("epl", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public license", 1.0),
    ("openssl", "openssl project", "this product includes software developed by the openssl project", 0.95),
    ("openssl", "eric young", "this product includes cryptographic software written by eric young", 0.95),
    ("python", "psf hereby", "psf hereby grants licensee a nonexclusive royalty free world wide license", 0.95),
    ("ncsa", "deal with the software", "to deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies", 0.95),
    ("ms-pl", "each contributor grants", "each contributor grants you a non exclusive worldwide royalty free copyright license to reproduce its contribution", 0.9),
    ("sspl", "third parties as a service", "if you make the functionality of the program or a modified version available to third parties as a service you must make the service source code available via network download to everyone at no charge under the terms of this license", 0.95),
    ("busl", "licensed work", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work", 1.0),
    ("disclaimer", "without warranty", "the software is provided as is without warranty of any kind express or implied", 0.5),
    ("disclaimer", "merchantability", "(?:implied )?warrant(?:y|ies) of merchantability(?: and)?(?: or)? fitness for a particular purpose", 0.4),
    ("disclaimer", "in no event", "in no event shall the (?:authors? or )?copyright (?:holders?|owners?)(?: or contributors)? be liable for any", 0.4),
    ("proprietary", "confidential", "this software (?:is|contains) (?:the )?(?:confidential and proprietary|proprietary and confidential)", 0.8),
    ("proprietary", "without the prior", "no part of this (?:software|program|publication) may be (?:[^ ]+ ){1,20}?without the prior written permission", 0.8),
)

_GRANTS = (
    "(?:is |are )?(?:dual )?licen[cs]ed under (?:the )?(?:terms of (?:the )?)?",
    "(?:is |are )?(?:released|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?",
    "(?:subject to|permitted under|governed by|redistributed under) (?:the )?(?:terms of (?:the )?)?",
)


@functools.cache
def default_rules() -> tuple[Rule, ...]:
    """For each license: its name alone, with a version, and in the usual grants; and all others as they stand."""
    rules = []
    for label, (keyword, names, versions) in FAMILIES.items():
        label = label.split("-short")[0].split("-library")[0]
        name = "(?:" + "|".join(n.replace(" l", " licen[cs]e") if n.endswith(" l") else n for n in names) + ")"
        gated = [Rule(label, keyword, name, 1, 0.6)]
        version = f"(?: (?:v|version )?(?:{'|'.join(versions)}))" if versions else ""
        if version:
            gated.append(Rule(label, keyword, name + version, 2, 0.8))
            gated.append(Rule(label, keyword, f"{name}{version} (?:or|and) (?:any )?later(?: version)?", 3, 0.9))
        gated += [Rule(label, keyword, f"{g}{name}{version and version + '?'}", 4, 0.95) for g in _GRANTS]
        identifier = label.replace("-", " ")
        gated.append(Rule(label, "spdx", f"spdx licen[cs]e identifier {identifier}(?: [0-9]+)*", 5, 1.0))
        rules += gated
    bodies = [Rule(label, keyword, pattern, 6, score) for label, keyword, pattern, score in BODIES]
    return (*rules, *OTHERS, *bodies)


_RULE_TYPE = "array<struct<rank:int,label:string,keyword:string,pattern:string,score:double>>"
_OPEN, _CLOSE = "\x01", "\x02"


def _rules_literal(rules: tuple[Rule, ...]) -> Column:
    """All rules, highest priority first, as a constant."""
    order = sorted(range(len(rules)), key=lambda i: (-rules[i].priority, i))
    rows = [
        {"rank": rank, "label": rules[i].label, "keyword": rules[i].keyword,
         "pattern": f"(?<= )(?:{rules[i].pattern})(?= )", "score": rules[i].score}
        for rank, i in enumerate(order)
    ]
    return F.from_json(F.lit(json.dumps(rows)), _RULE_TYPE)


def _starts(phrase: str, words: Column) -> Column:
    parts = phrase.split()
    def here(i):
        tests = [F.get(words, i + k) == part for k, part in enumerate(parts)]
        return functools.reduce(Column.__and__, tests)
    places = F.sequence(F.lit(0), F.size(words) - F.lit(1))
    return F.filter(places, here)


def _marked(norm: Column, rule: Column) -> Column:
    """The intervals [start, end) of words that a rule matches."""
    words = F.split(
        F.regexp_replace(norm, rule["pattern"], F.lit(f"{_OPEN}$0{_CLOSE}")), F.lit(" ")
    )
    # norm starts with a space, so word 0 comes second
    places = F.transform(words, lambda w, i: F.struct(w.alias("w"), (i - 1).alias("i")))
    starts = F.filter(places, lambda p: F.startswith(p["w"], F.lit(_OPEN)))
    ends = F.filter(places, lambda p: F.endswith(p["w"], F.lit(_CLOSE)))
    return F.zip_with(starts, ends, lambda s, e: F.struct(
        s["i"].alias("start"), (e["i"] + 1).alias("end"), rule["rank"].alias("rank"),
        rule["label"].alias("label"), rule["score"].alias("score"),
    ))


def detect(
    docs: DataFrame, *, keep=("doc_id",), text: str = "text", rules: tuple[Rule, ...] | None = None
) -> DataFrame:
    """The ``keep`` columns, n_words, the places of the base phrases, and ``detections``.

    ``detections`` holds struct(start, end, rank, label, score) by start, suppression
    applied, in words from 0. ``labels`` adds the base labels to theirs; ``score`` is the
    best of a detection, 0 without any. A null or empty text has no words and no labels;
    repeated rows stay, other columns are not looked at. ``rules`` need keywords in lower
    case and patterns that hold one of ``GATES``.
    """
    rules = default_rules() if rules is None else rules
    kept = [docs[f"`{c}`"].alias(f"_k{i}") for i, c in enumerate(keep)]
    # words are runs of ASCII letters and digits and of all characters beyond ASCII
    norm = F.regexp_replace(
        F.concat(F.lit(" "), F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")), F.lit(" ")),
        r"[\x00-\x2F\x3A-\x60\x7B-\x7F&&[^A-Z]]+", " ",
    )
    found = docs.select(*kept, norm.alias("_norm"))
    spaces = F.length("_norm") - F.length(F.replace("_norm", F.lit(" "), F.lit("")))
    gate = F.col("_norm").rlike("(?i)" + "|".join(GATES))
    lower = F.translate("_norm", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = found.select(
        *[f"_k{i}" for i in range(len(keep))],
        (spaces - 1).cast("long").alias("_n"),
        F.when(gate, lower).alias("_norm"),
    )
    norm = F.col("_norm")
    present = F.filter(_rules_literal(rules), lambda r: F.contains(norm, r["keyword"]) & F.rlike(norm, r["pattern"]))
    base_present = functools.reduce(Column.__or__, [F.contains(norm, F.lit(f" {p} ")) for p, _ in BASE_PHRASES])
    found = found.withColumns({
        "_words": F.when(base_present, F.split(F.substring("_norm", 2, 2**31 - 1), F.lit(" "))),
        "_spans": F.when(norm.isNotNull(), F.flatten(F.transform(present, lambda r: _marked(norm, r)))),
    })
    none = F.array().cast("array<int>")
    found = found.withColumns({
        f"_base{b}": F.coalesce(_starts(phrase, F.col("_words")), none)
        for b, (phrase, _) in enumerate(BASE_PHRASES)
    })
    detection = "struct<start:int,end:int,rank:int,label:string,score:double>"
    kept_spans = F.aggregate(
        F.array_sort(F.col("_spans"), _before),
        F.struct(F.lit(-1).alias("reach"), F.array().cast(f"array<{detection}>").alias("kept")),
        lambda acc, s: F.when(s["end"] > acc["reach"], F.struct(
            s["end"].alias("reach"), F.concat(acc["kept"], F.array(s)).alias("kept"))).otherwise(acc),
        lambda acc: acc["kept"],
    )
    places = F.concat(*[f"_base{b}" for b in range(len(BASE_PHRASES))])
    base_labels = F.array_sort(F.array_compact(F.array(*[
        F.when(F.size(f"_base{b}") > 0, F.lit(label)) for b, (_, label) in enumerate(BASE_PHRASES)
    ])))
    found = found.withColumns({
        "_kept": F.coalesce(kept_spans, F.array().cast(f"array<{detection}>")),
        "_places": places, "_base": base_labels,
    })
    labels = F.array_sort(F.array_union(F.transform("_kept", lambda s: s["label"]), "_base"))
    best = F.aggregate("_kept", F.lit(0.0), lambda a, s: F.greatest(a, s["score"]))
    return found.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_n").alias("n_words"),
        F.size("_places").cast("long").alias("n_base"),
        F.array_min("_places").cast("long").alias("first_word"),
        F.array_max("_places").cast("long").alias("last_word"),
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        best.alias("score"),
        F.col("_kept").alias("detections"),
    )


def _before(a: Column, b: Column) -> Column:
    """Earlier start, then later end, then higher priority comes first."""
    less = (
        (a["start"] < b["start"])
        | ((a["start"] == b["start"]) & (a["end"] > b["end"]))
        | ((a["start"] == b["start"]) & (a["end"] == b["end"]) & (a["rank"] < b["rank"]))
    )
    same = (a["start"] == b["start"]) & (a["end"] == b["end"]) & (a["rank"] == b["rank"])
    return F.when(less, -1).when(same, 0).otherwise(1)
