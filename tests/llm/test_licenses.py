import random
import re

from nightledger.llm import licenses
from nightledger.llm.common import alnum_words

from .conftest import ODD

RULES = licenses.rules()


def by_hand(text):
    words = [w.decode() for w in alnum_words((text or "").encode())]
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split(" ")
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    line, found = " " + " ".join(words) + " ", []
    for rank, r in enumerate(RULES):
        for m in re.finditer(r.pattern, line):
            start = line[:m.start()].count(" ") - 1
            found.append((start, rank, start + m[0].count(" ") + 1, r.label, r.confidence))
    kept = sorted(d for d in found if not any(e[1] < d[1] and e[0] <= d[0] and d[2] <= e[2] for e in found))
    all_labels = sorted(labels | {d[3] for d in kept})
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
            ",".join(all_labels), max((d[4] for d in kept), default=0.0), [(d[0], d[1], d[2]) for d in kept])


def got(r):
    return (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"],
            [(d["start"], d["rank"], d["end"]) for d in r["detections"]])


def check(docs):
    rows = sorted((repr(r["doc_id"]), got(r)) for r in licenses.scan(docs).collect())
    assert [repr(x) for x in rows] == [repr(x) for x in sorted((repr(r["doc_id"]), by_hand(r["text"])) for r in docs.collect())]


def test_hundreds_of_rules_with_their_keywords():
    assert len(RULES) > 300
    assert max(len(r.pattern) for r in RULES) < 400


def test_small_tables_match_brute_force(small_docs):
    check(small_docs)


def test_random_phrases_match_brute_force(make_docs):
    rng = random.Random(8)
    parts = ["cc by", "CC-BY-NC 4.0", "general public license", "GNU", "version 3", "or later", "licensed under the", "MIT License",
             "Apache License, Version 2.0", "all rights reserved", "All rights", "copyright (c) 2019 2020", "cc", "by", "lesser",
             "affero general public licence v3.0", "BSD 3-Clause", "é", "x9", "distributed under the terms of the", "public domain"]
    check(make_docs([(i, " ".join(rng.choices(parts, k=rng.randrange(20)))) for i in range(200)]))


def test_containment_leaves_one_detection(make_docs):
    r = licenses.scan(make_docs([(1, "This work is licensed under the GNU General Public License, version 3.")])).first()
    assert r["labels"] == "gpl,gpl-3" and len(r["detections"]) == 1 and r["score"] == 1.0


def test_license_texts_and_tags(make_docs):
    texts = ["// SPDX-License-Identifier: GPL-2.0-or-later", "# SPDX-License-Identifier: MIT",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
             "Redistribution and use in source and binary forms, with or without modification, are permitted. Neither the name of the "
             "copyright holder nor the names of its contributors may be used", "you may not use this file except in compliance with the License.",
             "the software is provided \"as is\", without warranty of any kind", "permission is granted"]
    docs = make_docs(list(enumerate(texts)))
    check(docs)
    labels = {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()}
    assert labels == {0: "spdx-gpl-2.0-or-later".replace(".", "-"), 1: "spdx-mit", 2: "mit", 3: "bsd,bsd-3-clause", 4: "apache-2.0",
                      5: "warranty-disclaimer", 6: ""}


def test_many_places_in_one_document(make_docs):
    check(make_docs([(1, "cc by 4.0 and " * 400)]))


def test_no_python_on_the_main_path(small_docs):
    assert not re.search("Python|Pandas|Arrow|Exchange", licenses.scan(small_docs)._jdf.queryExecution().executedPlan().toString())


def test_odd_rows_and_empty_table(odd_docs, no_docs):
    check(odd_docs)
    assert licenses.scan(odd_docs).count() == len(ODD)
    assert licenses.scan(no_docs).count() == 0
