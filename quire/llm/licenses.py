"""License scans: ordered signature rules behind a keyword prefilter. DataFrame functions only.

Texts without any gate word are done after a few substring searches. The others are brought to lower-case
words with one space between them. There, a family of rules reads the text only if one of its keywords
occurs, and then once, as one alternation of its regexes; the first rule that fits a match names it. Every
match is an interval with its rule's priority. An interval inside another of at least its priority is suppressed.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places of these words in a row are the base detections, whatever the rules say.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Version numbers as words, and "or later".
VERSION = r"(?:(?: version| v)? [0-9](?: [0-9]){0,2}| v[0-9](?: [0-9]){0,2})?"
LATER = r"(?: or (?:at your option )?(?:any |a )?(?:later|newer|greater|above)(?: version)?)?"
#: How a text says that it is under a license; a name follows.
GRANT = (
    r"(?:(?:licen[cs]ed|released|distributed|published|available|provided|covered|governed|redistributed|shared|used|copied|modified)"
    r"(?: (?:to you|by the authors?|only))? (?:under|by|with)|subject to|under|see|read|in compliance with|accordance with|copy of|(?:falls|is) under)"
    r"(?: (?:the|a|an|this))?(?: (?:terms|conditions|terms and conditions)(?: and conditions)? of)?(?: (?:the|a|an))?"
)
#: Family of rules: the keywords, any of which each of its matches has, and (label, name) of its licenses, narrower ones first.
NAMES = {
    "gnu": (["general public licen", "gnu gpl", "gplv", "lgpl", "agpl", "gnu public"], [
        ("agpl", r"(?:gnu )?affero general public licen[cs]e(?: agpl)?"), ("agpl", r"(?:gnu )?agpl(?:v[0-9])?"),
        ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[cs]e(?: lgpl)?"), ("lgpl", r"(?:gnu )?lgpl(?:v[0-9])?"),
        ("gpl", r"(?:gnu )?general public licen[cs]e(?: gpl)?"), ("gpl", r"gnu (?:gpl|public licen[cs]e)"), ("gpl", r"gplv[0-9]"),
    ]),
    "fdl": (["free documentation licen"], [("gfdl", r"(?:gnu )?free documentation licen[cs]e")]),
    "apache": (["apache"], [("apache", r"apache (?:software |public )?licen[cs]e"), ("apache", r"apache 2(?: 0)? licen[cs]e")]),
    "mit": (["mit licen", "mit style", "expat licen", "x11 licen", "mit x11"], [("mit", r"mit(?: x11| style| expat)? licen[cs]e"), ("mit", r"(?:expat|x11) licen[cs]e")]),
    "bsd": (["bsd"], [
        ("0bsd", r"(?:0 clause bsd|zero clause bsd|bsd (?:0|zero) clause)(?: licen[cs]e)?"),
        ("bsd-2-clause", r"(?:(?:2|two) clause|simplified|freebsd) bsd licen[cs]e"), ("bsd-2-clause", r"bsd (?:2|two) clause(?: licen[cs]e)?"),
        ("bsd-3-clause", r"(?:(?:3|three) clause|new|modified|revised) bsd licen[cs]e"), ("bsd-3-clause", r"bsd (?:3|three) clause(?: licen[cs]e)?"),
        ("bsd-4-clause", r"(?:(?:4|four) clause|original) bsd licen[cs]e"), ("bsd", r"bsd(?: style| type| like)? licen[cs]e"),
    ]),
    "cc": (["creative commons", "cc by", "cc licen", "cc attribution", "cc zero", "cc0"], [
        ("cc0", r"(?:cc0|cc zero|creative commons zero)(?: licen[cs]e| public domain dedication)?"),
        ("cc-by-nc-sa", r"(?:cc|creative commons)(?: licen[cs]e)? (?:by|attribution) (?:nc|non ?commercial) (?:sa|share ?alike)"),
        ("cc-by-nc-nd", r"(?:cc|creative commons)(?: licen[cs]e)? (?:by|attribution) (?:nc|non ?commercial) (?:nd|no ?deriv(?:ative)?s)"),
        ("cc-by-nc", r"(?:cc|creative commons)(?: licen[cs]e)? (?:by|attribution) (?:nc|non ?commercial)"),
        ("cc-by-sa", r"(?:cc|creative commons)(?: licen[cs]e)? (?:by|attribution) (?:sa|share ?alike)"),
        ("cc-by-nd", r"(?:cc|creative commons)(?: licen[cs]e)? (?:by|attribution) (?:nd|no ?deriv(?:ative)?s)"),
        ("cc-by", r"(?:cc|creative commons)(?: licen[cs]e)? (?:by|attribution)"), ("cc", r"creative commons(?: licen[cs]e)?"),
    ]),
    "mpl": (["mozilla public licen", "mpl licen"], [("mpl", r"mozilla public licen[cs]e(?: mpl)?"), ("mpl", r"mpl licen[cs]e")]),
    "epl": (["eclipse"], [("epl", r"eclipse public licen[cs]e"), ("edl", r"eclipse distribution licen[cs]e")]),
    "eupl": (["european union public licen", "eupl"], [("eupl", r"european union public licen[cs]e"), ("eupl", r"eupl")]),
    "cddl": (["common development and distribution", "common public licen"], [("cddl", r"common development and distribution licen[cs]e"), ("cpl", r"common public licen[cs]e")]),
    "isc": (["isc licen", "internet systems consortium"], [("isc", r"(?:isc|internet systems consortium) licen[cs]e")]),
    "zlib": (["zlib", "libpng"], [("zlib", r"zlib(?: libpng)? licen[cs]e"), ("libpng", r"libpng licen[cs]e")]),
    "boost": (["boost software"], [("boost", r"boost software licen[cs]e")]),
    "artistic": (["artistic licen"], [("artistic", r"(?:perl |clarified )?artistic licen[cs]e")]),
    "unlicense": (["unlicen"], [("unlicense", r"(?:the )?unlicen[cs]e")]),
    "ofl": (["open font"], [("ofl", r"(?:sil )?open font licen[cs]e")]),
    "python": (["python software", "python licen"], [("python", r"python(?: software foundation)? licen[cs]e")]),
    "postgresql": (["postgresql licen"], [("postgresql", r"postgresql licen[cs]e")]),
    "data": (["open database", "open data commons", "community data"], [("odbl", r"(?:open data commons )?open database licen[cs]e"), ("odc-by", r"open data commons attribution licen[cs]e"), ("pddl", r"open data commons public domain dedication(?: and licen[cs]e)?"), ("cdla", r"community data licen[cs]e agreement")]),
    "ms": (["microsoft"], [("ms-pl", r"microsoft public licen[cs]e"), ("ms-rl", r"microsoft reciprocal licen[cs]e")]),
    "afl": (["academic free", "open software licen"], [("afl", r"academic free licen[cs]e"), ("osl", r"open software licen[cs]e")]),
    "wtfpl": (["wtfpl"], [("wtfpl", r"wtfpl(?: licen[cs]e)?")]),
    "crown": (["open government licen", "open government data licen"], [("ogl", r"open government(?: data)? licen[cs]e")]),
    "free-art": (["free art licen", "licence art libre"], [("free-art", r"free art licen[cs]e"), ("free-art", r"licence art libre")]),
}
#: Passages of license texts and notices: (label, priority, family, regex). A family's keywords are in PASSAGE_KEYS.
PASSAGES = [
    ("agpl", 4, "gnu", r"this program is free software you can redistribute it and or modify it under the terms of the (?:gnu )?affero general public licen[cs]e"),
    ("agpl", 4, "gnu", r"you should have received a copy of the gnu affero general public licen[cs]e(?: along with this program)?"),
    ("lgpl", 4, "gnu", r"this library is free software you can redistribute it and or modify it under the terms of the (?:gnu )?(?:lesser|library) general public licen[cs]e"),
    ("lgpl", 4, "gnu", r"you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e(?: along with this (?:library|program))?"),
    ("lgpl", 3, "gnu", r"see the gnu (?:lesser|library) general public licen[cs]e for more details"),
    ("gpl", 4, "gnu", r"this (?:program|library|software|file) is free software(?: you can redistribute it and or modify it)?(?: under the terms of the (?:gnu )?general public licen[cs]e)?"),
    ("gpl", 4, "gnu", r"as published by the free software foundation(?: either)?(?: version [0-9](?: [0-9])?(?: of the licen[cs]e)?)?(?: or at your option any later version)?"),
    ("gpl", 4, "gnu", r"you should have received a copy of the gnu general public licen[cs]e(?: along with this (?:program|software|file))?"),
    ("gpl", 3, "gnu", r"see the gnu general public licen[cs]e for more details"),
    ("gpl", 3, "gnu", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document"),
    ("0bsd", 4, "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("postgresql", 4, "permission", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("mit", 4, "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", 3, "permission", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicen[cs]e and or sell copies"),
    ("mit", 3, "permission", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("boost", 4, "permission", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("isc", 4, "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?: provided that the above copyright notice and this permission notice appear in all copies)?"),
    ("hpnd", 4, "permission", r"permission to use copy modify and distribute this software and its documentation for any purpose(?: and without fee)? is hereby granted"),
    ("zlib", 3, "permission", r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("zlib", 2, "permission", r"the origin of this software must not be misrepresented"),
    ("no-redistribution", 3, "permission", r"(?:may not|must not|cannot) be (?:reproduced|copied|used|distributed) (?:[^ ]+ ){0,6}without (?:the )?(?:prior )?(?:express )?(?:written )?permission"),
    ("gfdl", 4, "fdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
    ("gfdl", 3, "fdl", r"with no invariant sections(?: no front cover texts)?(?: and no back cover texts)?"),
    ("apache", 4, "apache", r"licen[cs]ed under the apache licen[cs]e version 2 0 the licen[cs]e"),
    ("apache", 4, "grant", r"you may not use this file except in compliance with the licen[cs]e"),
    ("apache", 4, "grant", r"you may obtain a copy of the licen[cs]e at(?: http(?:s)? www apache org licenses license 2 0)?"),
    ("apache", 3, "grant", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis"),
    ("apache", 3, "grant", r"see the licen[cs]e for the specific language governing permissions and limitations under the licen[cs]e"),
    ("apache", 3, "grant", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) licen[cs]e"),
    ("mit", 2, "warranty", r"the software is provided as is without warranty of any kind express or implied"),
    ("mit", 2, "warranty", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("isc", 2, "warranty", r"the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("bsd", 4, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?"),
    ("bsd", 3, "redistribution", r"redistributions of source code must retain the above copyright notice(?: this list of conditions and the following disclaimer)?"),
    ("bsd", 3, "redistribution", r"redistributions in binary form must reproduce the above copyright notice(?: this list of conditions and the following disclaimer in the documentation and or other materials)?"),
    ("bsd-3-clause", 4, "redistribution", r"neither the name of (?:the )?(?:[^ ]+ ){1,8}nor the names of (?:its|the) contributors may be used to endorse or promote products"),
    ("bsd-4-clause", 4, "redistribution", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", 2, "warranty", r"this software is provided by the (?:copyright holders|regents|authors?)(?: and contributors)? as is and any express or implied warranties"),
    ("zlib", 4, "warranty", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages"),
    ("mpl", 4, "mpl", r"this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?2 0"),
    ("mpl", 4, "mpl", r"the contents of this file are subject to the mozilla public licen[cs]e(?: version [0-9] [0-9])?"),
    ("mpl", 3, "grant", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("cddl", 4, "cddl", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("epl", 4, "epl", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e"),
    ("edl", 4, "epl", r"this program and the accompanying materials are made available under the terms of the eclipse distribution licen[cs]e"),
    ("eupl", 4, "eupl", r"licen[cs]ed under the eupl(?: version [0-9] [0-9]| v ?[0-9] [0-9])?"),
    ("artistic", 3, "artistic", r"this (?:library|program|module) is free software you (?:can|may) redistribute it and or modify it under the same terms as perl itself"),
    ("unlicense", 4, "domain", r"this is free and unencumbered software released into the public domain"),
    ("cc0", 4, "domain", r"to the extent possible under law (?:[^ ]+ ){1,10}has waived all copyright and related or neighboring rights"),
    ("cc0", 4, "domain", r"dedicate(?:d|s)? (?:[^ ]+ ){0,6}to the public domain(?: worldwide)?"),
    ("public-domain", 3, "domain", r"(?:released|placed|released into|is|are) (?:in|into|in to|to)? ?the public domain"),
    ("public-domain", 1, "domain", r"public domain"),
    ("wtfpl", 4, "wtfpl", r"do what the f[^ ]{3} you want to public licen[cs]e"),
    ("ofl", 4, "ofl", r"this font software is licen[cs]ed under the sil open font licen[cs]e(?: version 1 1)?"),
    ("beerware", 4, "beer", r"(?:the )?beer ?ware licen[cs]e(?: revision 42)?"),
    ("cc", 3, "cc", r"this (?:work|article|text|page|content|image|document) is licen[cs]ed under a creative commons(?: (?:attribution|public)(?: [^ ]+){0,3})? licen[cs]e"),
    ("cc-by", 4, "cc", r"this is an open access article distributed under the terms of the creative commons attribution licen[cs]e"),
    ("cc-by-sa", 3, "cc", r"text is available under the creative commons attribution share ?alike licen[cs]e(?: additional terms may apply)?"),
    ("odbl", 4, "data", r"(?:this database|[^ ]+ data) is (?:made )?available under the open database licen[cs]e"),
    ("ogl", 4, "crown", r"contains public sector information licen[cs]ed under the open government licen[cs]e"),
    ("crown-copyright", 2, "copyright", r"crown copyright(?: and database rights?)?(?: [0-9]{4})?"),
    ("copyright", 1, "copyright", r"copyright (?:c )?[0-9]{4}"),
    ("copyright", 1, "copyright", r"copyright (?:c )?(?:by|held by|of) [^ ]+"),
    ("all-rights-reserved", 2, "reserved", r"(?:copyright (?:c )?(?:[0-9]{4} )?(?:[^ ]+ ){0,6})?all rights (?:are )?reserved"),
    ("some-rights-reserved", 2, "reserved", r"some rights reserved"),
    ("no-redistribution", 3, "reserved", r"no part of this (?:publication|book|work|document|article|site) may be reproduced"),
    ("no-redistribution", 3, "reserved", r"(?:reproduction|redistribution|copying)(?: or (?:reproduction|redistribution|copying))? (?:is|are) (?:strictly )?(?:prohibited|forbidden)"),
    ("proprietary", 3, "confidential", r"(?:proprietary and confidential|confidential and proprietary)(?: information)?"),
    ("proprietary", 3, "confidential", r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("non-commercial", 2, "commercial", r"(?:for )?non ?commercial (?:use|purposes) only"),
    ("non-commercial", 2, "commercial", r"(?:commercial use|use for commercial purposes) (?:is )?(?:not (?:allowed|permitted)|prohibited|forbidden)"),
    ("patent-grant", 2, "patent", r"(?:grants?|granted) (?:[^ ]+ ){0,12}patent licen[cs]e"),
    ("spdx", 1, "spdx", r"spdx licen[cs]e identifier [^ ]+"),
]
#: Keywords of the passages' families that have no names.
PASSAGE_KEYS = {
    "grant": ["the license", "the licence", "copy of the mpl", "contributor hereby grants"], "permission": ["permission", "misrepresented", "to deal in the software"], "warranty": ["warrant", "be liable"],
    "redistribution": ["redistribution", "to endorse or promote", "advertising materials"], "domain": ["public domain", "has waived all copyright"],
    "beer": ["beer ware", "beerware"], "copyright": ["copyright"], "reserved": ["rights reserved", "rights are reserved", "no part of this", "prohibited", "forbidden"],
    "confidential": ["proprietary", "unauthorized copying"], "commercial": ["commercial"], "patent": ["patent licen"], "spdx": ["spdx"],
}
#: More keywords of families that have names, for their passages.
MORE_KEYS = {"gnu": ["free software", "verbatim copies of this licen"], "fdl": ["invariant sections"], "artistic": ["as perl itself"], "wtfpl": ["you want to public licen"]}
#: SPDX identifiers as words after `spdx license identifier`, and the label that each stands for.
SPDX = {
    "agpl 3 0": "agpl", "lgpl 2 0": "lgpl", "lgpl 2 1": "lgpl", "lgpl 3 0": "lgpl", "gpl 2 0": "gpl", "gpl 3 0": "gpl", "gfdl 1 3": "gfdl", "apache 2 0": "apache", "mit 0": "mit-0", "mit": "mit",
    "bsd 2 clause": "bsd-2-clause", "bsd 3 clause": "bsd-3-clause", "bsd 4 clause": "bsd-4-clause", "0bsd": "0bsd", "isc": "isc", "zlib": "zlib", "bsl 1 0": "boost", "mpl 2 0": "mpl", "mpl 1 1": "mpl",
    "epl 1 0": "epl", "epl 2 0": "epl", "eupl 1 2": "eupl", "cddl 1 0": "cddl", "unlicense": "unlicense", "cc0 1 0": "cc0", "cc by nc sa 4 0": "cc-by-nc-sa", "cc by nc nd 4 0": "cc-by-nc-nd",
    "cc by nc 4 0": "cc-by-nc", "cc by sa 4 0": "cc-by-sa", "cc by nd 4 0": "cc-by-nd", "cc by 4 0": "cc-by", "ofl 1 1": "ofl", "artistic 2 0": "artistic", "psf 2 0": "python", "postgresql": "postgresql",
    "odbl 1 0": "odbl", "pddl 1 0": "pddl", "cdla permissive 2 0": "cdla", "ms pl": "ms-pl", "ms rl": "ms-rl", "afl 3 0": "afl", "osl 3 0": "osl", "wtfpl": "wtfpl", "json": "json", "hpnd": "hpnd",
}
LEVELS = 4
#: Every rule's and base phrase's texts have one of these, before any change but lower case.
GATES = ["licen", "gpl", "copyright", "spdx", "domain", "reserved", "commons", "cc0", "permission", "permitted", "redistribution", "warrant", "commercial", "prohibited", "forbidden", "proprietary", "free software", "eupl", "wtfpl", "invariant", "advertising", "endorse", "misrepresent", "reproduced"]
#: Or one of these as a word.
SHORT = ["gnu", "cc", "mpl", "bsd"]
GATE_WORDS = rf"(?<![0-9a-z\x{{80}}-\x{{10FFFF}}])(?:{'|'.join(SHORT)})(?![0-9a-z\x{{80}}-\x{{10FFFF}}])"
OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word of a text whose A-Z are not lower-cased yet; as a positive class, which Java matches far faster.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]++"


SUBJECT = r"(?:this|the) (?:work|software|file|program|document|text|project|code|package|library|article|page) (?:is|are|was|has been|may be|can be) (?:dual )?"


def rules() -> list[tuple[str, int, str, str]]:
    """(label, priority, regex, family), in the order in which a family tries them: narrower ones first at each priority."""
    out = [(label, p, f"{lead}{name}{VERSION}{LATER}", family) for p, lead in ((4, f"{SUBJECT}{GRANT} "), (3, f"{GRANT} "), (2, "")) for family, (_, names) in NAMES.items() for label, name in names]
    out += [(label, p, regex, family) for label, p, family, regex in PASSAGES]
    out += [(label, 4, f"spdx licen[cs]e identifier {name}(?: only| or later)?", "spdx") for name, label in SPDX.items()]
    return sorted(out, key=lambda r: -r[1])


def keywords() -> dict[str, list[str]]:
    """Family -> texts of which each match of its rules has one."""
    named = {family: [*keys, *MORE_KEYS.get(family, [])] for family, (keys, _) in NAMES.items()}
    return named | PASSAGE_KEYS


def families(table: list[tuple[str, int, str, str]], keys: dict[str, list[str]]) -> list[dict]:
    """{keys, regex, kinds}: a family's rules as one alternation, which reads a text once, and [{label, p, regex}], of
    which the first that fits a whole match names it."""
    out = []
    for family in dict.fromkeys(r[3] for r in table):
        own = [r for r in table if r[3] == family]
        kinds: list[dict] = []
        for label, p, regex, _ in own:
            if kinds and (kinds[-1]["label"], kinds[-1]["p"]) == (label, p):
                kinds[-1]["regex"] = f"{kinds[-1]['regex'][:-2]}|{regex})$"
            else:
                kinds.append({"label": label, "p": p, "regex": f"^(?:{regex})$"})
        out.append({"keys": keys[family], "regex": f"(?<= )(?:{'|'.join(r[2] for r in own)})(?= )", "kinds": kinds})
    return out


def gated(low: Column, gates: list[str] = GATES) -> Column:
    some = lambda words: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
    return some(gates) | (some(SHORT) & low.rlike(GATE_WORDS))


def spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def spans_of(norm: Column, regex: Column) -> Column:
    """[(a, b, text)] of all matches in order; one pass, which puts marks around them that no text has."""
    pieces = F.split(F.regexp_replace(norm, regex, F.lit("\x01$0\x02")), "[\x01\x02]", -1)
    matches = F.filter(pieces, lambda x, i: i % 2 == 1)
    between = F.slice(F.filter(pieces, lambda x, i: i % 2 == 0), 1, F.size(matches))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int,text:string>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + F.length(x["between"])
        b = a + F.length(x["text"])
        return F.struct(b.alias("at"), F.array_append(acc["spans"], F.struct(a.alias("a"), b.alias("b"), x["text"].alias("text"))).alias("spans"))

    return F.aggregate(F.zip_with(between, matches, lambda p, m: F.struct(p.alias("between"), m.alias("text"))), start, step, lambda acc: acc["spans"])


def detections(norm: Column, table: list[dict]) -> Column:
    """[(a, -b, -priority, label)] of all families' matches, sorted: what contains an interval stands before it."""
    # one literal, which the optimizer folds; an expression for each of hundreds of rules takes seconds to plan
    rows = F.from_json(F.lit(json.dumps(table)), "array<struct<keys:array<string>,regex:string,kinds:array<struct<label:string,p:int,regex:string>>>>")
    live = F.filter(rows, lambda f: F.exists(f["keys"], lambda k: F.contains(norm, k)))

    def named(f: Column):
        def one(s: Column) -> Column:
            kind = F.get(F.filter(f["kinds"], lambda k: F.rlike(s["text"], k["regex"])), 0)
            return F.struct(s["a"].alias("a"), (-s["b"]).alias("nb"), (-kind["p"]).alias("np"), kind["label"].alias("label"))

        return F.transform(spans_of(norm, f["regex"]), one)

    return F.array_sort(F.flatten(F.transform(live, named)))


def resolved(found: Column) -> Column:
    """(labels, best): the labels of intervals that are inside no other of at least their priority, and the best priority."""
    ends = [f"e{p}" for p in range(1, LEVELS + 1)]
    start = F.struct(*(F.lit(0).alias(e) for e in ends), F.array().cast("array<string>").alias("labels"), F.lit(0).alias("best"))

    def step(acc: Column, d: Column) -> Column:
        b, p = -d["nb"], -d["np"]
        reach = reduce(lambda rest, i: F.when(p == i, acc[f"e{i}"]).otherwise(rest), range(1, LEVELS), acc[f"e{LEVELS}"])
        stands = b > reach
        labels = F.when(stands & ~F.array_contains(acc["labels"], d["label"]), F.array_append(acc["labels"], d["label"])).otherwise(acc["labels"])
        return F.struct(*(F.when(p >= i + 1, F.greatest(acc[e], b)).otherwise(acc[e]).alias(e) for i, e in enumerate(ends)), labels.alias("labels"), F.when(stands, F.greatest(acc["best"], p)).otherwise(acc["best"]).alias("best"))

    return F.aggregate(found, start, step, lambda acc: F.struct(acc["labels"].alias("labels"), acc["best"].alias("best")))


def scan(docs: DataFrame, base: dict[str, str] = BASE, table: list[dict] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score for every row.

    labels has the base labels and those that the rules leave; score is the best priority left as a share
    of the highest. Null and empty texts have no words, labels or places. Repeated rows are scanned alike;
    an empty table gives no rows; other columns are not read. lower() changes other letters than A-Z too,
    none of which turns into a letter of a phrase.
    """
    table = families(rules(), keywords()) if table is None else table
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), F.lower(text).alias("_low"))
    norm = F.when(gated(F.col("_low")), F.concat(F.lit(" "), F.trim(F.regexp_replace("_low", OTHER, " ")), F.lit(" ")))
    rows = rows.select("doc_id", "n_words", norm.alias("_norm"))
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"), F.lit(None).cast("string").alias("label"))
    places = []
    for phrase, label in sorted(base.items()):
        pieces = F.split("_norm", F.lit(f"(?<= ){phrase}(?= )"), -1)
        last = F.length("_norm") - F.length(F.element_at(pieces, -1)) - len(phrase)
        some = F.struct((F.size(pieces) - 1).cast("long").alias("n"), (spaces(pieces[0]) - 1).cast("long").alias("first"), (spaces(F.substring(F.col("_norm"), F.lit(1), last)) - 1).cast("long").alias("last"), F.lit(label).alias("label"))
        places.append(F.when(F.contains("_norm", F.lit(f" {phrase} ")), some).otherwise(nothing))
    rows = rows.withColumn("_base", F.array(*places)).withColumn("_found", F.when(F.col("_norm").isNotNull(), resolved(detections(F.col("_norm"), table))))
    base_labels = F.array_sort(F.array_distinct(F.array_compact(F.transform("_base", lambda x: x["label"]))))
    n_base = F.aggregate("_base", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    labels = F.array_sort(F.array_union(base_labels, F.coalesce(F.col("_found.labels"), F.array().cast("array<string>"))))
    return rows.select("doc_id", "n_words", n_base.alias("n_base"), F.array_min(F.transform("_base", lambda x: x["first"])).alias("first_word"), F.array_max(F.transform("_base", lambda x: x["last"])).alias("last_word"), F.array_join(base_labels, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), (F.coalesce(F.col("_found.best"), F.lit(0)) / F.lit(float(LEVELS))).alias("score"))
