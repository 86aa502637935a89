"""License texts and notices, found by ordered signature rules, in DataFrame functions only.

A text becomes its words, one space between them. A rule has an expression over words, a keyword
that the text must contain before the expression is tried, a priority and a confidence. Rules
come from families (name, spellings, versions) and from general notices, in order. Of overlapping
detections, one that lies inside another of at least its priority is dropped; of two with the same
words and priority, the one whose rule comes first stays.

Rules are rows of an array literal, so the plan has the same size for any number of them, and a
text without any keyword costs one scan.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import full_text
from tripledger.llm.spans import sums_before
from tripledger.llm.urlfilter import LOWER, UPPER

BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"
# Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# (label, spellings of the name, spellings of versions)
FAMILIES = [
    ("gpl", ["gnu general public license", "gnu gpl", "gpl"], ["1", "2", "3", "2 0", "3 0"]),
    ("lgpl", ["gnu lesser general public license", "gnu library general public license", "gnu lgpl",
              "lgpl"], ["2", "2 1", "3", "3 0"]),
    ("agpl", ["gnu affero general public license", "affero general public license", "agpl"], ["1", "3", "3 0"]),
    ("gfdl", ["gnu free documentation license", "gfdl"], ["1 1", "1 2", "1 3"]),
    ("apache", ["apache software license", "apache license", "asl"], ["1 0", "1 1", "2", "2 0"]),
    ("mit", ["mit license", "mit expat license", "expat license", "x11 license"], []),
    ("bsd", ["bsd license", "berkeley software distribution license", "modified bsd license",
             "simplified bsd license", "revised bsd license"], []),
    ("mpl", ["mozilla public license", "mpl"], ["1 0", "1 1", "2", "2 0"]),
    ("epl", ["eclipse public license", "epl"], ["1 0", "2 0"]),
    ("eupl", ["european union public licence", "european union public license", "eupl"], ["1 0", "1 1", "1 2"]),
    ("cddl", ["common development and distribution license", "cddl"], ["1 0", "1 1"]),
    ("cpl", ["common public license"], ["1 0"]),
    ("artistic", ["artistic license"], ["1 0", "2 0"]),
    ("isc", ["isc license"], []),
    ("zlib", ["zlib license", "zlib libpng license"], []),
    ("boost", ["boost software license"], ["1 0"]),
    ("unlicense", ["the unlicense", "unlicense"], []),
    ("wtfpl", ["wtfpl", "do what the fuck you want to public license"], ["2"]),
    ("psf", ["python software foundation license", "psf license"], ["2"]),
    ("php", ["php license"], ["3 0", "3 01"]),
    ("ms-pl", ["microsoft public license"], []),
    ("ms-rl", ["microsoft reciprocal license"], []),
    ("ofl", ["sil open font license", "open font license"], ["1 0", "1 1"]),
    ("odbl", ["open database license", "odbl"], ["1 0"]),
    ("odc-by", ["open data commons attribution license"], ["1 0"]),
    ("pddl", ["public domain dedication and license", "pddl"], ["1 0"]),
    ("ogl", ["open government licence", "open government license"], ["1 0", "2 0", "3 0"]),
    ("osl", ["open software license"], ["1 0", "2 0", "2 1", "3 0"]),
    ("afl", ["academic free license"], ["2 0", "2 1", "3 0"]),
    ("ncsa", ["university of illinois ncsa open source license", "ncsa open source license"], []),
    ("openssl", ["openssl license"], []),
    ("ruby", ["ruby license"], []),
    ("vim", ["vim license"], []),
    ("upl", ["universal permissive license"], ["1 0"]),
    ("sspl", ["server side public license", "sspl"], ["1"]),
    ("busl", ["business source license", "busl"], ["1 0", "1 1"]),
    ("elastic", ["elastic license"], ["2 0"]),
    ("cecill", ["cecill license", "cecill"], ["1", "2", "2 1"]),
    ("rail", ["responsible ai license", "openrail license", "openrail m license"], []),
    ("cc0", ["cc0", "creative commons zero"], ["1 0"]),
]
# Creative Commons: what follows "cc" or "creative commons", in code and in words.
COMMONS = {
    "by-nc-sa": ["by nc sa", "attribution noncommercial sharealike", "attribution non commercial share alike"],
    "by-nc-nd": ["by nc nd", "attribution noncommercial noderivatives", "attribution non commercial no derivatives"],
    "by-nc": ["by nc", "attribution noncommercial", "attribution non commercial"],
    "by-sa": ["by sa", "attribution sharealike", "attribution share alike"],
    "by-nd": ["by nd", "attribution noderivatives", "attribution no derivatives"],
    "by": ["by", "attribution"],
}
# Notices of no family: (label, expression over words, keyword, priority, confidence).
NOTICES = [
    ("reserved", "all rights reserved", "rights reserved", 0, 0.8),
    ("reserved", "some rights reserved", "rights reserved", 0, 0.5),
    ("reserved", "alle rechte vorbehalten", "alle rechte vorbehalten", 0, 0.8),
    ("reserved", "tous droits réservés", "tous droits", 0, 0.8),
    ("reserved", "todos los derechos reservados", "los derechos", 0, 0.8),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", "public domain", 1, 0.8),
    ("copyright", "copyright (?:c )?(?:[0-9]{4} )*[0-9]{4}", "copyright", 0, 0.5),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "hereby granted", 2, 0.95),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
     "without fee", 2, 0.95),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "source and binary forms", 2, 0.95),
    ("zlib", "this software is provided as is without any express or implied warranty", "provided as is", 1, 0.6),
    ("apache", "you may not use this file except in compliance with the license", "compliance with the license", 2, 0.9),
    ("gpl", "this program is free software you can redistribute it and or modify it", "free software you can", 2, 0.9),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 2, 0.95),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies",
     "this permission notice", 2, 0.9),
    ("mit-0", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files the software to deal in the software without restriction including without "
     "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the "
     "software and to permit persons to whom the software is furnished to do so the software is provided",
     "hereby granted", 2, 0.95),
    ("bsd-3", "neither the name of (?:[^ ]+ ){1,12}may be used to endorse or promote products", "neither the name", 2, 0.95),
    ("bsd-4", "all advertising materials mentioning features or use of this software must", "advertising materials", 2, 0.95),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistributions of source", 2, 0.9),
    ("gpl", "the gnu general public license is a free copyleft license for software", "free copyleft license", 2, 0.95),
    ("gpl", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu "
     "general public license", "see the gnu general", 2, 0.9),
    ("lgpl", "this library is free software you can redistribute it and or modify it", "library is free software", 2, 0.9),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is "
     "distributed on an as is basis", "unless required by applicable law", 2, 0.9),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "source code form", 2, 0.95),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license",
     "accompanying materials", 2, 0.95),
    ("boost", "boost software license version 1 0 august 17th 2003", "boost software license", 2, 0.95),
    ("isc", "the software is provided as is and the author disclaims all warranties", "disclaims all warranties", 2, 0.9),
    ("zlib", "altered source versions must be plainly marked as such", "altered source versions", 2, 0.95),
    ("wtfpl", "you just do what the fuck you want to", "what the fuck", 2, 0.9),
    ("cc0", "to the extent possible under law (?:[^ ]+ ){1,12}has waived all copyright", "waived all copyright", 2, 0.95),
    ("cc", "this work is licensed under a creative commons", "creative commons", 1, 0.8),
    ("proprietary", "(?:proprietary and confidential|unauthorized (?:copying|reproduction|distribution) of this)",
     "proprietary and confidential|unauthorized ", 1, 0.7),
]
GRANT = "(?:licensed|released|distributed|available|published|provided) under (?:the |a |an )?(?:terms of (?:the )?)?"


def rules() -> list[tuple[str, str, list[str], int, float]]:
    """(label, expression, keywords, priority, confidence) in order; made from the tables above.
    What an expression matches holds one of its keywords, a space standing for a word's end."""
    found = []

    def add(label, name, keys, priority, confidence):
        found.append((label, f"(?<= )(?:{name})(?= )", keys.split("|"), priority, confidence))

    for label, names, versions in FAMILIES:
        for name in names:
            sure, key = " " in name, name if " " in name else f" {name} "
            for v in versions:
                full = f"{label}-{v.replace(' ', '.')}"
                add(full, f"{GRANT}{name}(?: license)? (?:version |v)?{v}", key, 2, 0.95)
                add(full, f"{name} (?:version |v)?{v}", key, 1, 0.9 if sure else 0.6)
            add(label, f"{GRANT}{name}", key, 2 if sure else 1, 0.9)
            if sure:
                add(label, name, key, 0, 0.7)
        add(label, f"spdx license identifier {label.replace('-', ' ')}(?: [0-9]+)*", SPDX, 2, 1.0)
    for part, names in COMMONS.items():
        for name in names:
            for lead, key in (("cc", " cc "), ("creative commons", "creative commons")):
                body = f"{lead} {name}(?: (?:license|licence|international|unported))*"
                add(f"cc-{part}", f"{GRANT}{body}(?: [1-4] [0-9])?", key, 2, 0.95)
                add(f"cc-{part}", f"{body} [1-4] [0-9]", key, 1, 0.9)
                if (lead, name) != ("cc", "by"):
                    add(f"cc-{part}", body, key, 0, 0.7)
        add(f"cc-{part}", f"spdx license identifier cc {names[0]}(?: [1-4] [0-9])?", SPDX, 2, 1.0)
    for label, name, keys, priority, confidence in NOTICES:
        add(label, name, keys, priority, confidence)
    return found


SPDX = "spdx license identifier"
# One of these is in every keyword and every base phrase, so a text without them has nothing.
HINTS = ["licen", "reserved", " cc", "creative commons", "public domain", "copyright", "rechte vorbehalten",
         "tous droits", "los derechos", "hereby granted", "without fee", "source and binary", "provided as is",
         "free software you can", "unencumbered", "proprietary and", "unauthorized ", " gpl ", " lgpl ", " agpl ",
         " gfdl ", " asl ", " mpl ", " epl ", " eupl ", " cddl ", " wtfpl ", "want to public", " odbl ", " pddl ",
         " sspl ", " busl ", " cecill ", "this permission notice", "neither the name", "advertising materials",
         "redistributions of source", "see the gnu general", "library is free software",
         "unless required by applicable law", "source code form", "accompanying materials",
         "disclaims all warranties", "altered source versions", "what the fuck"]


FOUND = ("array<struct<start:bigint,minus_end:bigint,minus_priority:int,rule:int,label:string,"
         "confidence:double>>")


def as_words(text: Column) -> Column:
    """The words with a space before and after each; A-Z keep their case."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, BREAKS, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _starts(matches: Column, pieces: Column) -> Column:
    """Index of each match's first word: a piece of words between spaces has one word less."""
    before = F.transform(F.slice(pieces, 1, F.size(matches)), lambda p: (_spaces(p) - 1).cast("long"))
    own = F.transform(matches, lambda m: (_spaces(m) + 1).cast("long"))
    both = F.zip_with(before, own, lambda b, o: b + o)
    return F.zip_with(sums_before(both), before, lambda s, b: s + b)


def _keys() -> list[str]:
    return list(dict.fromkeys(k for rule in rules() for k in rule[2]))


def _detections(words: Column, present: Column) -> Column:
    """``present`` must be a column that is computed already: the rules ask for it one by one."""
    names = ("label", "pattern", "keys", "priority", "confidence")
    listed = [dict(zip(names, rule), number=k) for k, rule in enumerate(rules())]
    table = F.from_json(F.lit(json.dumps(listed)), (
        "array<struct<number:int,label:string,pattern:string,keys:array<string>,priority:int,confidence:double>>"))
    tried = F.when(F.size(present) > 0, F.filter(table, lambda r: F.arrays_overlap(r["keys"], present))).otherwise(
        F.slice(table, 1, 0))

    # A lambda's variable is computed once, an expression each time it is named: so each rule's
    # matches become a variable before they are asked for.
    matched = F.filter(F.transform(tried, lambda r: F.struct(
        r.alias("rule"), F.regexp_extract_all(words, r["pattern"], F.lit(0)).alias("matches"))),
        lambda x: F.size(x["matches"]) > 0)
    cut = F.transform(matched, lambda x: F.struct(
        x["rule"].alias("rule"), x["matches"].alias("matches"),
        F.call_function("split", words, x["rule"]["pattern"], F.lit(-1)).alias("pieces")))
    started = F.transform(cut, lambda x: F.struct(
        x["rule"].alias("rule"), x["matches"].alias("matches"), _starts(x["matches"], x["pieces"]).alias("starts")))
    return F.flatten(F.transform(started, lambda x: F.zip_with(x["starts"], x["matches"], lambda s, m: F.struct(
        s.alias("start"), (-(s + _spaces(m) + 1)).alias("minus_end"),
        (-x["rule"]["priority"]).alias("minus_priority"), x["rule"]["number"].alias("rule"),
        x["rule"]["label"].alias("label"),
        x["rule"]["confidence"].alias("confidence")))))


def _uncovered(found: Column) -> Column:
    """Drop what lies inside a detection of at least its priority. In order of start, longest,
    highest and earliest rule first, a detection stays if it ends beyond the furthest end of those
    priorities so far."""
    none = F.lit(-1).cast("bigint")
    start = F.struct(F.array().cast(FOUND).alias("kept"), F.array(none, none, none).alias("reach"))

    def step(acc: Column, d: Column) -> Column:
        end, priority = -d["minus_end"], -d["minus_priority"]
        covered = F.get(acc["reach"], priority) >= end
        return F.struct(
            F.when(covered, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(d))).alias("kept"),
            F.transform(acc["reach"], lambda r, i: F.when(
                i <= priority, F.greatest(r, end)).otherwise(r)).alias("reach"))
    return F.aggregate(F.array_sort(found.cast(FOUND)), start, step, lambda acc: acc["kept"])


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``detections`` (start and end in words, label, confidence), ``labels`` and
    ``score``, the highest confidence (a base phrase has 0.8), 0 without a label.

    Null and empty texts have no words and no labels; repeated rows are repeated. Whole texts are
    read. An empty table gives no rows.
    """
    pattern = "(?i)(?<= )(?:" + "|".join(PHRASES) + ")(?= )"
    words, low = F.col("words"), F.col("low")
    rows = docs.select("doc_id", as_words(full_text()).alias("words"))
    rows = rows.withColumn("n_words", F.when(words == "  ", 0).otherwise(_spaces(words) - 1).cast("long"))
    hinted = F.lit(False)
    for hint in HINTS:
        hinted = hinted | F.contains(F.col("any"), F.lit(hint))
    rows = rows.withColumn("any", F.lower(words)).withColumn(
        "low", F.when(hinted, F.translate(words, UPPER, LOWER))).drop("any")
    rows = rows.withColumn("base", F.regexp_extract_all(low, F.lit(pattern), F.lit(0)))
    rows = rows.withColumn("base", F.coalesce("base", F.array().cast("array<string>"))).withColumn(
        "pieces", F.when(F.size("base") > 0, F.split(low, pattern, -1)))
    rows = rows.withColumn("present", F.when(low.isNotNull(), F.filter(
        F.array(*map(F.lit, _keys())), lambda k: F.contains(low, k))))
    rows = rows.withColumn("found", F.when(F.size("present") > 0, _uncovered(_detections(low, F.col("present")))))
    labels = F.array_sort(F.array_distinct(F.transform(F.col("base"), lambda b: F.element_at(
        F.create_map(*[F.lit(x) for pair in PHRASES.items() for x in pair]), b))))
    last = F.col("n_words") - _spaces(F.element_at("pieces", -1)) - _spaces(F.element_at("base", -1))
    found = F.coalesce("found", F.array().cast(FOUND))
    rows = rows.withColumn("base_labels", labels).withColumn("found", found)
    sure = F.transform("found", lambda d: d["confidence"])
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.when(F.size("base") > 0, (_spaces(F.get("pieces", F.lit(0))) - 1).cast("long")).alias("first_word"),
        F.when(F.size("base") > 0, last.cast("long")).alias("last_word"), "base_labels",
        F.transform("found", lambda d: F.struct(
            d["start"].alias("start"), (-d["minus_end"]).alias("end"), d["label"].alias("label"),
            d["confidence"].alias("confidence"))).alias("detections"),
        F.array_sort(F.array_union("base_labels", F.transform("found", lambda d: d["label"]))).alias("labels"),
        F.greatest(F.coalesce(F.array_max(sure), F.lit(0.0)),
                   F.when(F.size("base") > 0, 0.8).otherwise(0.0)).alias("score"))
