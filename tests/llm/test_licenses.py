import random
import re

import pytest

from quire.llm import licenses
from tests.llm.data import documents, empty, texts


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text):
    words = words_of(text)
    starts, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    norm = " " + " ".join(words) + " "
    found = []
    for family in dict.fromkeys(r[3] for r in licenses.rules()):
        own = [(label, p, regex) for label, p, regex, f in licenses.rules() if f == family]
        for m in re.finditer("(?<= )(?:" + "|".join(r[2] for r in own) + ")(?= )", norm):
            label, p = next((label, p) for label, p, regex in own if re.fullmatch(regex, m.group()))
            found.append((m.start(), m.end(), p, label))
    found.sort(key=lambda d: (d[0], -d[1], -d[2], d[3]))
    kept = [d for i, d in enumerate(found) if not any(o[0] <= d[0] and o[1] >= d[1] and o[2] >= d[2] for o in found[:i])]
    score = max((d[2] for d in kept), default=0) / licenses.LEVELS
    every = labels | {d[3] for d in kept}
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(every)), score


CASES = [
    "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0.",
    "CC-BY",
    "cc by",
    "xcc by ccx by cc byx",
    "mit License\nMIT\tLICENSE mit-license",
    "Released under the MIT License. Released under the GNU Lesser General Public License v2.1 or later",
    "gnu gnu general public license license",
    "GNU GENERAL\x00PUBLIC--LICENSE",
    "apacheé license apache lİcense apache ſ license apaché license",
    "Copyright (c) 2020 Some One. All rights reserved. SPDX-License-Identifier: MIT",
    "the mit license " * 300,
    "public domain, Creative Commons Attribution ShareAlike 4 0, CC0",
    "You may redistribute it under the Mozilla Public License 2.0, see the BSD license for details",
    "unlicense The Unlicense unlicensed",
    "Kcc by K cc by",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software)",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3",
    "Redistribution and use in source and binary forms, with or without modification, are permitted. Neither the name of the X nor the names of its contributors may be used to endorse or promote products",
    "SPDX-License-Identifier: CC-BY-NC-SA-4.0 SPDX-License-Identifier: GPL-2.0-only SPDX-License-Identifier: Foo-1",
    "This is free and unencumbered software released into the public domain. Reproduction is prohibited; commercial use is not allowed.",
    "This work is licensed under a Creative Commons Attribution 4.0 International License; see the BSD 3-Clause License, version 2",
]


def matches_of(rng, tree):
    """A random text that a parsed regex matches."""
    out = []
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            out.append(chr(arg))
        elif name == "NOT_LITERAL":
            out.append("q")
        elif name == "IN":
            kind, value = rng.choice([x for x in arg if str(x[0]) != "NEGATE"])
            negated = any(str(x[0]) == "NEGATE" for x in arg)
            out.append("q" if negated else chr(value) if str(kind) == "LITERAL" else chr(rng.randint(*value)))
        elif name == "MAX_REPEAT":
            low, high, inner = arg
            out += [matches_of(rng, inner) for _ in range(rng.randint(low, min(int(high), low + 3)))]
        elif name == "BRANCH":
            out.append(matches_of(rng, rng.choice(arg[1])))
        elif name == "SUBPATTERN":
            out.append(matches_of(rng, arg[3]))
        else:
            raise AssertionError(name)
    return "".join(out)


def test_hundreds_of_rules_behind_keywords_and_gates():
    """Any text that a rule matches has one of its family's keywords and a gate."""
    from re import _parser

    rng = random.Random(1)
    table, keys = licenses.rules(), licenses.keywords()
    assert len({r[2] for r in table}) > 250 and {p for _, p, _, _ in table} == {1, 2, 3, 4}
    assert all(len(k) >= 3 for ks in keys.values() for k in ks)
    words = licenses.GATE_WORDS.replace(r"\x{80}-\x{10FFFF}", "\x80-\U0010ffff")
    for _, _, regex, family in table:
        tree = _parser.parse(regex)
        for _ in range(30):
            text = matches_of(rng, tree)
            assert re.fullmatch(regex, text), (regex, text)
            assert any(k in text for k in keys[family]), (family, text)
            assert any(g in text for g in licenses.GATES) or re.search(words, text), text


@pytest.mark.parametrize("seed", [1, 2])
def test_scan_by_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [c for c in CASES if len(c) < 200]
    rows = list(enumerate([*CASES, *texts(30), *(" ".join(rng.choice(pool + ["word", "of the", "x."]) for _ in range(rng.randint(1, 30))) for _ in range(60))]))
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        assert got[i] == brute(t), t


def test_odd_rows(spark):
    rows, docs = documents(spark)
    assert licenses.scan(docs).count() == len(rows)
    assert licenses.scan(empty(spark)).collect() == []
