"""License scan by ordered signature rules (operator 7).

Texts become lower-case words joined by single spaces.  A rule is a regex over whole
words with a keyword, a fragment that starts a word: only the rules whose keyword the text
holds are run.  The rules
combine license names with grant phrases and versions; their order is their priority.  A
detection that lies within another one of a higher-priority rule is suppressed, so
"licensed under the GNU General Public License version 3" is one detection, not four.
Places of the base phrases are always counted and keep their labels.

Everything is DataFrame functions in one projection without a shuffle.

Defined cases: null and empty texts have no words, places or labels and score 0; repeated
rows are treated alike; ties of equal intervals go to the earlier rule; a text of any
length is scanned whole; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, running_totals

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# label, keyword, name as words, versions ("2 0" is written 2.0).  Licenses whose names hold another's come first.
NAMES = [
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e", ["1 0", "3 0", "3"]),
    ("agpl", "agpl", r"(?:gnu )?agpl", ["1 0", "3 0", "3"]),
    ("lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", ["2 0", "2 1", "3 0", "3"]),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", ["2 0", "2 1", "3 0", "3"]),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e", ["1 1", "1 2", "1 3"]),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e", ["1 0", "2 0", "3 0", "2", "3"]),
    ("gpl", "gpl", r"(?:gnu )?gpl", ["1 0", "2 0", "3 0", "2", "3"]),
    ("apache", "apache", r"apache(?: software)?(?: licen[sc]e)", ["1 0", "1 1", "2 0", "2"]),
    ("mit", "mit licen", r"mit licen[sc]e", []),
    ("mit", "expat", r"expat licen[sc]e", []),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd)(?: licen[sc]e)?", []),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?", []),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?", []),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e", []),
    ("mpl", "mozilla public", r"mozilla public licen[sc]e", ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse public", r"eclipse public licen[sc]e", ["1 0", "2 0"]),
    ("cddl", "common development", r"common development and distribution licen[sc]e", ["1 0", "1 1"]),
    ("cpl", "common public", r"common public licen[sc]e", ["1 0"]),
    ("eupl", "european union", r"european union public licen[sc]e", ["1 0", "1 1", "1 2"]),
    ("cc-by-nc-nd", "cc by", r"cc by nc nd", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-sa", "cc by", r"cc by nc sa", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", "cc by", r"cc by nc", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", "cc by", r"cc by nd", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "cc by", r"cc by sa", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by", "cc by", r"cc by", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?", ["2 0", "3 0", "4 0"]),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution non ?commercial share ?alike", ["2 0", "3 0", "4 0"]),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial", ["2 0", "3 0", "4 0"]),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?deriv(?:ative)?s?", ["2 0", "3 0", "4 0"]),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike", ["2 0", "3 0", "4 0"]),
    ("cc-by", "creative commons", r"creative commons attribution", ["2 0", "3 0", "4 0"]),
    ("cc0", "cc0", r"cc0", ["1 0"]),
    ("cc0", "creative commons", r"creative commons (?:zero|public domain dedication)", ["1 0"]),
    ("creative-commons", "creative commons", r"creative commons(?: licen[sc]e)?", []),
    ("unlicense", "unlicense", r"unlicense", []),
    ("public-domain", "public domain", r"public domain", []),
    ("isc", "isc licen", r"isc licen[sc]e", []),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e", []),
    ("boost", "boost software", r"boost software licen[sc]e", ["1 0"]),
    ("artistic", "artistic licen", r"artistic licen[sc]e", ["1 0", "2 0"]),
    ("psf", "python software", r"python software foundation licen[sc]e", ["2"]),
    ("ofl", "open font", r"(?:sil )?open font licen[sc]e", ["1 0", "1 1"]),
    ("ms-pl", "microsoft public", r"microsoft public licen[sc]e", []),
    ("odbl", "open database", r"open database licen[sc]e", ["1 0"]),
    ("wtfpl", "wtfpl", r"wtfpl", []),
    ("reserved", "all rights", r"all rights reserved", []),
    ("proprietary", "proprietary", r"proprietary(?: and confidential)?", []),
    ("copyright", "copyright", r"copyright(?: c)?(?: [12][0-9]{3}){1,60}", []),
]
# phrases of license texts and notices: label, keyword, phrase as words; all come before the names
BODIES = [
    ("mit", "permission is hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "the above copyright", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("bsd-4-clause", "all advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("bsd-3-clause", "neither the", r"neither the names? of (?:the )?(?:[^ ]+ ){1,12}nor the names of (?:its|their|any) contributors"),
    ("bsd", "redistribution and", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd", "redistributions", r"redistributions (?:of source code|in binary form) must (?:retain|reproduce) the above copyright notice"),
    ("isc", "permission to use", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee"),
    ("apache-2.0", "you may not", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache-2.0", "unless required", r"unless required by applicable law or agreed to in writing software distributed under the licen[sc]e"),
    ("gpl", "this program", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    ("lgpl", "this library", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e"),
    ("mpl-2.0", "this source", r"this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0"),
    ("boost-1.0", "permission is hereby", r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("zlib", "this software is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "this is free", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "you just", r"you just do what the fuck you want to"),
    ("warranty-disclaimer", "as is", r"as is without warrant(?:y|ies)(?: or conditions)? of any kind"),
]
# license identifiers as a tag writes them, longer ones before those they begin with
SPDX = ["0bsd", "agpl 3 0 only", "agpl 3 0 or later", "agpl 3 0", "apache 1 1", "apache 2 0", "artistic 2 0", "bsd 2 clause", "bsd 3 clause", "bsd 4 clause",
        "bsl 1 0", "cc by 4 0", "cc by sa 4 0", "cc by nc 4 0", "cc0 1 0", "cddl 1 0", "epl 1 0", "epl 2 0", "eupl 1 2", "gpl 2 0 only", "gpl 2 0 or later",
        "gpl 2 0", "gpl 3 0 only", "gpl 3 0 or later", "gpl 3 0", "isc", "lgpl 2 1 only", "lgpl 2 1 or later", "lgpl 2 1", "lgpl 3 0 only", "lgpl 3 0 or later",
        "lgpl 3 0", "mit 0", "mit", "mpl 1 1", "mpl 2 0", "ms pl", "ofl 1 1", "postgresql", "python 2 0", "unlicense", "wtfpl", "zlib"]
# phrase before a name, and the confidence of a rule with it; the strongest first
GRANTS = [
    (r"(?:is |are )?licen[sc]ed(?: to you)? under (?:the )?(?:terms of )?(?:the )?", 0.98),
    (r"(?:released|distributed|available|provided|published|covered) under (?:the )?(?:terms of )?(?:the )?", 0.95),
    (r"(?:subject to|in accordance with|according to|governed by) (?:the )?(?:terms of )?(?:the )?", 0.9),
    ("", 0.6),
]
VERSION_GAP = r"(?: as published by the free software foundation)?(?: either)?(?: version| v)? "
MAX_WORDS = 64  # no rule matches more


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    confidence: float
    base: bool = False


def rules() -> list[Rule]:
    """All rules by priority: identifier tags, phrases of license texts, then names: versions before none, then
    the strength of the grant, then the names' order."""
    ends = lambda p: rf"(?<= ){p}(?= )"
    out = [Rule("spdx-" + name.replace(" ", "-"), "spdx", ends(f"spdx licen[sc]e identifier {name}"), 1.0) for name in SPDX]
    out += [Rule(label, keyword, ends(phrase), 0.95) for label, keyword, phrase in BODIES]
    for versioned in (True, False):
        for grant, confidence in GRANTS:
            for label, keyword, name, versions in NAMES:
                for v in versions if versioned else [None]:
                    tail = VERSION_GAP + v + "(?: (?:or )?(?:any )?later(?: version)?)?" if v else ""
                    out.append(Rule(f"{label}-{v.replace(' ', '.')}" if v else label, keyword, ends(grant + name + tail),
                                    min(confidence + 0.02 * bool(v), 1.0)))
    return out


def _base_rules() -> list[Rule]:
    return [Rule(label, phrase, rf"(?<= ){phrase}(?= )", 0.6, True) for phrase, label in BASE.items()]


def _by_keyword(listed: list[Rule]) -> Column:
    """Map from keyword to its rules."""
    found: dict[str, list[Column]] = {}
    for i, r in enumerate(listed):
        found.setdefault(r.keyword, []).append(F.struct(
            F.lit(i).alias("rank"), F.lit(r.label).alias("label"), F.lit(r.pattern).alias("pattern"),
            F.lit(r.confidence).alias("confidence")))
    return F.create_map(*[x for k, v in found.items() for x in (F.lit(k), F.array(*v))])


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.translate(c, " ", ""))


def _detections(words: Column, listed: list[Rule]) -> Column:
    """Array of (start, rank, end, label, confidence) in words, of all rules whose keyword occurs."""
    known = F.array(*[F.lit(k) for k in dict.fromkeys(r.keyword for r in listed)])
    present = F.filter(known, lambda k: F.contains(words, F.concat(F.lit(" "), k)))
    run = F.flatten(F.transform(present, lambda k: F.element_at(_by_keyword(listed), k)))

    def places(r: Column) -> Column:
        cut = F.struct(F.split(words, r["pattern"], -1).alias("p"),
                       F.regexp_extract_all(words, r["pattern"], F.lit(0)).alias("h"))

        def spans(x: Column) -> Column:
            # spaces before a match tell how many words stand before it
            gaps = F.transform(F.slice(x["p"], F.lit(1), F.size(x["h"])), _spaces)
            inside = F.transform(x["h"], _spaces)
            before = running_totals(F.zip_with(gaps, inside, lambda a, b: a + b))
            return F.transform(F.arrays_zip(before.alias("b"), gaps.alias("g"), inside.alias("i")), lambda y: F.struct(
                (y["b"] + y["g"] - 1).alias("start"), r["rank"].alias("rank"), (y["b"] + y["g"] + y["i"]).alias("end"),
                r["label"].alias("label"), r["confidence"].alias("confidence")))

        return let(cut, lambda x: F.when(F.size(x["h"]) > 0, spans(x)).otherwise(F.array().cast(KIND)))

    return F.array_sort(F.flatten(F.transform(run, places)))


KIND = "array<struct<start:int,rank:int,end:int,label:string,confidence:double>>"
_BLOCK = 256


def _unsuppressed(found: Column) -> Column:
    """Detections not within one of a rule of higher priority.  A block of neighbours (by start) is held
    against the detections that start at most ``MAX_WORDS`` before it, the only ones that can reach it."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _BLOCK).cast("int"))

    def block(k: Column) -> Column:
        own = F.slice(found, k * _BLOCK + 1, F.lit(_BLOCK))
        near = let(own, lambda o: F.struct(o.alias("own"), F.filter(found, lambda e: (
            e["start"] >= F.get(o, F.lit(0))["start"] - MAX_WORDS) & (e["start"] <= F.element_at(o, -1)["start"])).alias("near")))
        return let(near, lambda n: F.filter(n["own"], lambda d: ~F.exists(n["near"], lambda e: (
            e["rank"] < d["rank"]) & (e["start"] <= d["start"]) & (d["end"] <= e["end"]))))

    return F.when(F.size(found) > 0, F.flatten(F.transform(blocks, block))).otherwise(found)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: word count, base places, labels, score and ``detections``."""
    text = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = F.trim(F.regexp_replace(text, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    df = docs.select("doc_id", F.concat(F.lit(" "), cut, F.lit(" ")).alias("words"))
    df = df.withColumn("n_words", F.when(F.length("words") > 2, _spaces(F.col("words")) - 1).otherwise(0).cast("long"))
    words = F.col("words")
    keywords = sorted({r.keyword for r in rules()} | {r.keyword for r in _base_rules()})
    gate = words.rlike(" (?:" + "|".join(keywords) + ")")  # any keyword at all
    none = F.array().cast(KIND)
    df = df.select("doc_id", "n_words", F.when(gate, _detections(words, _base_rules())).otherwise(none).alias("base"),
                   F.when(gate, _detections(words, rules())).otherwise(none).alias("found"))
    df = df.withColumn("detections", _unsuppressed(F.col("found")))
    labels = lambda c: F.transform(c, lambda d: d["label"])
    listed = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    starts = F.transform("base", lambda d: d["start"].cast("long"))
    return df.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        listed(labels("base")).alias("base_labels"),
        listed(F.concat(labels("base"), labels("detections"))).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)).alias("score"), "detections")
