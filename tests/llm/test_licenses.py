import re

from aerolith.llm import licenses as L

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    t = (text or "").translate(LOW)
    words = WORD.findall(t)
    held = set(words) | ({"©"} if "©" in t else set())
    base = sorted((i, label) for phrase, label in L.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    found = sorted((m.start(), -m.end(), r.priority, k, r.label) for k, r in enumerate(L.rules()) if set(r.keywords) & held for m in re.finditer(r.regex, t))
    kept = [s for k, s in enumerate(found) if not any(o[1] <= s[1] and o[2] <= s[2] for o in found[:k])]
    return len(words), base, [(a, -e, p, k, label) for a, e, p, k, label in kept]


TEXTS = [
    None,
    "",
    "   \n",
    "Licensed under the GNU General Public License, version 3. All  rights--reserved. CC\nBY",
    "This is licensed under the Apache License, Version 2.0 and the MIT License; cc by cc by cc  by-nc 4.0",
    "SPDX-License-Identifier: MIT OR Apache-2.0. Copyright (c) 2001-2005 X. © 2020",
    "é😀 general public\tlicense ÀLL RIGHTS reserved all rights reserved",
    "https://creativecommons.org/licenses/by-sa/4.0/ and http://www.apache.org/licenses/LICENSE-2.0",
    "permission is hereby granted, free of charge; redistribution and use in source and binary forms",
    "gplv3 gpl v2 lgpl mit license mozilla public license 2.0 creative commons attribution-noncommercial 4.0 international",
    "summit license permit license",
    "released into the public\ndomain. Permission is\n hereby granted, free\tof charge, to any person obtaining a copy of this software. all  rights\nreserved",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU\nGeneral Public\nLicense, version 2. You may not use this file except in compliance with the License.",
    "Alle Rechte vorbehalten. Tous droits réservés. The Software shall be used for Good, not Evil. Neither the name of X nor of Y may be used to endorse or promote products",
    "word " * 30_000 + "released under the MIT License",
    "mit license " * 400,
    "© 2020 cc by " * 3000,
]


def test_rules():
    rules = L.rules()
    assert len(rules) >= 200
    assert len(L.TEXTS) >= 90 and all(re.compile(r.regex) for r in rules)
    assert all(k == "©" or WORD.fullmatch(k) for r in rules for k in r.keywords)
    assert all(0 <= r.priority <= 3 and 0 < r.confidence <= 1 for r in rules)


def test_against_brute_force(docs, with_clashes):
    df = with_clashes(docs(*[(k, t) for k, t in enumerate(TEXTS)], (None, TEXTS[3]), (1, "")))
    for r in L.scan(df).collect():
        if r.doc_id is None:
            continue
        n, base, found = brute(TEXTS[r.doc_id])
        assert r.n_words == n and [tuple(x) for x in r.base] == base, r.doc_id
        assert [(x.start, x.end, x.priority, x.rule, x.label) for x in r.found] == found, r.doc_id


def test_containment_and_priority(docs):
    (row,) = L.scan(docs((1, TEXTS[3]))).collect()
    labels = {x.label for x in row.found}
    assert "gpl-3.0" in labels and not any(x.start > 9 and x.end < 56 for x in row.found)


def test_wrapped_phrases_are_found(docs):
    found = {r.doc_id: {x.label for x in r.found} for r in L.scan(docs(*[(k, t) for k, t in enumerate(TEXTS) if t and "\n" in t])).collect()}
    assert {"public-domain", "mit", "reserved"} <= found[11] and {"gpl", "gpl-2.0", "apache-2.0"} <= found[12]


def test_query_columns(spark, docs, tmp_path):
    docs(*[(k, t) for k, t in enumerate(TEXTS)]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in L.op3_licenses(spark, str(tmp_path)).collect()}
    assert len(rows) == len(TEXTS)
    r = rows[4]
    assert (r.n_base, r.base_labels, r.first_word) == (3, "cc-by", brute(TEXTS[4])[1][0][0]) and "apache-2.0" in r.labels.split(",") and "mit" in r.labels.split(",")
    assert (rows[0].n_words, rows[0].first_word, rows[0].labels, rows[0].score) == (0, None, "", 0.0)
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert rows[10].labels == ""


def test_native_and_empty(spark, docs):
    assert L.scan(docs()).count() == 0
    assert "Python" not in L.op3_licenses(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
