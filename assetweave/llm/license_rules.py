"""Signature rules for op 3, over words joined by single blanks (lower case, no punctuation).

A rule is a regular expression that begins with its keyword, the first word of
every match; it is only tried where that word stands. Rules are ordered; priority
1 names a licence and its version, 2 a licence, 3 a family or a mere mention.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: words that a rule can look at
REACH = 24

#: confidence by priority
CONFIDENCE = {1: 1.0, 2: 0.8, 3: 0.5}

#: fixed values: label, priority, names as regular expressions over words
NAMES: list[tuple[str, int, list[str]]] = [
    ("agpl-3.0", 1, [
        r"agpl (?:v(?:ersion )?)?3(?: 0)?(?: only| or later)?",
        r"agplv3(?: 0)?",
        r"affero general public license (?:version |v ?)?3",
        r"gnu affero general public license (?:version |v ?)?3",
    ]),
    ("agpl", 2, [r"agpl", r"affero general public license", r"gnu affero general public license"]),
    ("lgpl-2.1", 1, [
        r"lgpl (?:v(?:ersion )?)?2 1(?: only| or later)?",
        r"lgplv2 1",
        r"lesser general public license (?:version |v ?)?2 1",
        r"gnu lesser general public license (?:version |v ?)?2 1",
    ]),
    ("lgpl-3.0", 1, [
        r"lgpl (?:v(?:ersion )?)?3(?: 0)?(?: only| or later)?",
        r"lgplv3(?: 0)?",
        r"lesser general public license (?:version |v ?)?3",
        r"gnu lesser general public license (?:version |v ?)?3",
    ]),
    ("lgpl-2.0", 1, [
        r"lgpl (?:v(?:ersion )?)?2 0(?: only| or later)?",
        r"library general public license (?:version |v ?)?2",
        r"gnu library general public license (?:version |v ?)?2",
    ]),
    ("lgpl", 2, [
        r"lgpl",
        r"lesser general public license",
        r"gnu lesser general public license",
        r"gnu library general public license",
    ]),
    ("gpl-2.0", 1, [
        r"gpl (?:v(?:ersion )?)?2(?: 0)?(?: only| or later)?",
        r"gplv2(?: 0)?",
        r"general public license (?:version |v ?)?2",
        r"gnu general public license (?:version |v ?)?2",
        r"gnu gpl (?:version |v ?)?2",
    ]),
    ("gpl-3.0", 1, [
        r"gpl (?:v(?:ersion )?)?3(?: 0)?(?: only| or later)?",
        r"gplv3(?: 0)?",
        r"general public license (?:version |v ?)?3",
        r"gnu general public license (?:version |v ?)?3",
        r"gnu gpl (?:version |v ?)?3",
    ]),
    ("gpl", 2, [r"gpl", r"gnu gpl", r"general public license", r"gnu general public license", r"gnu public license"]),
    ("gfdl", 2, [r"gfdl", r"free documentation license", r"gnu free documentation license"]),
    ("apache-2.0", 1, [
        r"apache license (?:version |v ?)?2(?: 0)?",
        r"apache software license (?:version |v ?)?2(?: 0)?",
        r"apache (?:v)?2(?: 0)?(?: license)?",
        r"asl 2 0",
        r"apache licence (?:version |v ?)?2(?: 0)?",
    ]),
    ("apache-1.1", 1, [r"apache (?:software )?license (?:version |v ?)?1 1", r"apache 1 1"]),
    ("apache-1.0", 1, [r"apache (?:software )?license (?:version |v ?)?1 0", r"apache 1 0"]),
    ("apache", 2, [r"apache license", r"apache licence", r"apache software license", r"apache public license"]),
    ("mit-0", 1, [r"mit 0", r"mit no attribution(?: license)?", r"mit zero(?: license)?"]),
    ("mit", 2, [
        r"mit licen[cs]e",
        r"mit x11 licen[cs]e",
        r"mit style licen[cs]e",
        r"mit expat licen[cs]e",
        r"expat licen[cs]e",
        r"x11 licen[cs]e",
        r"massachusetts institute of technology licen[cs]e",
        r"mit licensed",
    ]),
    ("bsd-4-clause", 1, [r"bsd 4 clause(?: licen[cs]e)?", r"4 clause bsd(?: licen[cs]e)?", r"original bsd licen[cs]e"]),
    ("bsd-3-clause", 1, [
        r"bsd 3 clause(?: licen[cs]e)?",
        r"3 clause bsd(?: licen[cs]e)?",
        r"new bsd licen[cs]e",
        r"modified bsd licen[cs]e",
        r"revised bsd licen[cs]e",
        r"three clause bsd(?: licen[cs]e)?",
    ]),
    ("bsd-2-clause", 1, [
        r"bsd 2 clause(?: licen[cs]e)?",
        r"2 clause bsd(?: licen[cs]e)?",
        r"simplified bsd licen[cs]e",
        r"freebsd licen[cs]e",
        r"two clause bsd(?: licen[cs]e)?",
    ]),
    ("0bsd", 1, [r"0bsd", r"bsd zero clause(?: licen[cs]e)?", r"zero clause bsd(?: licen[cs]e)?"]),
    ("bsd", 2, [r"bsd licen[cs]e", r"bsd style licen[cs]e", r"bsd licensed", r"berkeley software distribution licen[cs]e"]),
    ("isc", 2, [r"isc licen[cs]e", r"internet systems consortium licen[cs]e"]),
    ("mpl-2.0", 1, [r"mpl (?:v(?:ersion )?)?2(?: 0)?", r"mozilla public license (?:version |v ?)?2(?: 0)?", r"mplv2"]),
    ("mpl-1.1", 1, [r"mpl (?:v(?:ersion )?)?1 1", r"mozilla public license (?:version |v ?)?1 1"]),
    ("mpl", 2, [r"mozilla public license", r"mpl licen[cs]e"]),
    ("epl-2.0", 1, [r"epl 2 0", r"eclipse public license (?:version |v ?)?2(?: 0)?"]),
    ("epl-1.0", 1, [r"epl 1 0", r"eclipse public license (?:version |v ?)?1 0"]),
    ("epl", 2, [r"eclipse public license", r"epl licen[cs]e"]),
    ("edl", 2, [r"eclipse distribution license"]),
    ("cddl-1.1", 1, [r"cddl 1 1", r"common development and distribution license (?:version |v ?)?1 1"]),
    ("cddl-1.0", 1, [r"cddl 1 0", r"common development and distribution license (?:version |v ?)?1 0"]),
    ("cddl", 2, [r"cddl", r"common development and distribution license"]),
    ("cpl-1.0", 1, [r"cpl 1 0", r"common public license (?:version |v ?)?1 0"]),
    ("cpl", 2, [r"common public license"]),
    ("eupl-1.2", 1, [r"eupl (?:version |v ?)?1 2", r"european union public licen[cs]e (?:version |v ?)?1 2"]),
    ("eupl", 2, [r"eupl", r"european union public licen[cs]e"]),
    ("osl-3.0", 1, [r"osl 3 0", r"open software license (?:version |v ?)?3(?: 0)?"]),
    ("osl", 2, [r"open software license"]),
    ("afl-3.0", 1, [r"afl 3 0", r"academic free license (?:version |v ?)?3(?: 0)?"]),
    ("afl", 2, [r"academic free license"]),
    ("artistic-2.0", 1, [r"artistic license (?:version |v ?)?2(?: 0)?", r"artistic 2 0"]),
    ("artistic-1.0", 1, [r"artistic license (?:version |v ?)?1 0", r"artistic 1 0"]),
    ("artistic", 2, [r"artistic licen[cs]e", r"perl artistic licen[cs]e"]),
    ("bsl-1.0", 1, [r"boost software license (?:version |v ?)?1 0", r"bsl 1 0"]),
    ("bsl", 2, [r"boost software license", r"boost license"]),
    ("busl-1.1", 1, [r"busl 1 1", r"business source license (?:version |v ?)?1 1"]),
    ("busl", 2, [r"business source license"]),
    ("sspl", 2, [r"sspl", r"server side public license"]),
    ("elastic-2.0", 1, [r"elastic license (?:version |v ?)?2(?: 0)?"]),
    ("elastic", 2, [r"elastic license"]),
    ("commons-clause", 2, [r"commons clause(?: license condition)?"]),
    ("cc0-1.0", 1, [r"cc0 (?:version |v ?)?1 0(?: universal)?", r"cc0 1 0"]),
    ("cc0", 2, [r"cc0", r"creative commons zero", r"creative commons cc0"]),
    ("cc-by-nc-nd", 1, [
        r"cc by nc nd(?: \d 0)?",
        r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: \d 0)?",
    ]),
    ("cc-by-nc-sa", 1, [
        r"cc by nc sa(?: \d 0)?",
        r"creative commons attribution non ?commercial share ?alike(?: \d 0)?",
    ]),
    ("cc-by-nc", 1, [r"cc by nc(?: \d 0)?", r"creative commons attribution non ?commercial(?: \d 0)?"]),
    ("cc-by-nd", 1, [r"cc by nd(?: \d 0)?", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: \d 0)?"]),
    ("cc-by-sa", 1, [r"cc by sa(?: \d 0)?", r"creative commons attribution share ?alike(?: \d 0)?"]),
    ("cc-by", 1, [r"cc by(?: \d 0)?", r"creative commons attribution(?: \d 0)?(?: international| unported)?"]),
    ("cc", 3, [r"creative commons licen[cs]e", r"creative commons"]),
    ("unlicense", 2, [r"unlicense", r"the unlicense"]),
    ("wtfpl", 2, [r"wtfpl", r"do what the fuck you want to public license"]),
    ("zlib", 2, [r"zlib licen[cs]e", r"zlib libpng licen[cs]e"]),
    ("libpng", 2, [r"libpng licen[cs]e"]),
    ("openssl", 2, [r"openssl licen[cs]e"]),
    ("python-2.0", 1, [r"python license (?:version |v ?)?2(?: 0)?", r"python software foundation license (?:version |v ?)?2"]),
    ("python", 2, [r"psf licen[cs]e", r"python software foundation licen[cs]e"]),
    ("php-3.01", 1, [r"php license (?:version |v ?)?3 01"]),
    ("php", 2, [r"php licen[cs]e"]),
    ("ruby", 2, [r"ruby licen[cs]e", r"ruby s licen[cs]e"]),
    ("postgresql", 2, [r"postgresql licen[cs]e"]),
    ("ofl-1.1", 1, [r"ofl 1 1", r"sil open font license (?:version |v ?)?1 1", r"open font license (?:version |v ?)?1 1"]),
    ("ofl", 2, [r"sil open font license", r"open font license"]),
    ("odbl", 2, [r"odbl", r"open database license", r"open data commons open database license"]),
    ("odc-by", 2, [r"odc by", r"open data commons attribution license"]),
    ("pddl", 2, [r"pddl", r"public domain dedication and license"]),
    ("ms-pl", 2, [r"ms pl", r"microsoft public license"]),
    ("ms-rl", 2, [r"ms rl", r"microsoft reciprocal license"]),
    ("ncsa", 2, [r"ncsa licen[cs]e", r"university of illinois ncsa open source license"]),
    ("upl-1.0", 1, [r"universal permissive license(?: (?:version |v ?)?1 0)?", r"upl 1 0"]),
    ("unicode", 2, [r"unicode license(?: agreement)?"]),
    ("w3c", 2, [r"w3c licen[cs]e", r"w3c software (?:notice and )?license"]),
    ("vim", 2, [r"vim licen[cs]e"]),
    ("json", 2, [r"json licen[cs]e"]),
    ("ijg", 2, [r"ijg licen[cs]e", r"independent jpeg group licen[cs]e"]),
    ("curl", 2, [r"curl licen[cs]e"]),
    ("beerware", 2, [r"beerware licen[cs]e", r"beer ware licen[cs]e"]),
    ("ecl-2.0", 1, [r"educational community license (?:version |v ?)?2(?: 0)?", r"ecl 2 0"]),
    ("cecill", 2, [r"cecill(?: b| c)?(?: licen[cs]e)?"]),
    ("bigscience-rail", 2, [r"bigscience (?:open )?rail(?: m)?(?: license)?"]),
    ("openrail", 2, [r"openrail(?: m)?(?: license)?", r"creativeml open ?rail(?: m)?"]),
    ("llama", 2, [r"llama \d community license(?: agreement)?"]),
    ("public-domain", 3, [r"public domain"]),
    ("proprietary", 3, [r"all rights reserved", r"proprietary and confidential", r"confidential and proprietary"]),
]

#: fixed values: SPDX identifiers that no name of their label matches; too short or too common to stand alone, they only
#: count after the SPDX tag or an opening
IDENTIFIERS: dict[str, list[str]] = {
    "mit": [r"mit"],
    "isc": [r"isc"],
    "mpl": [r"mpl \d \d"],
    "osl": [r"osl \d \d"],
    "afl": [r"afl \d \d"],
    "elastic-2.0": [r"elastic 2 0"],
    "zlib": [r"zlib"],
    "libpng": [r"libpng(?: 2 0)?"],
    "openssl": [r"openssl"],
    "python-2.0": [r"python 2 0", r"psf 2 0"],
    "php-3.01": [r"php 3 01"],
    "php": [r"php 3 0"],
    "ruby": [r"ruby"],
    "postgresql": [r"postgresql"],
    "ofl": [r"ofl 1 0"],
    "ncsa": [r"ncsa"],
    "unicode": [r"unicode (?:3 0|dfs 201[56]|tou)"],
    "w3c": [r"w3c(?: 20150513| 19980720)?"],
    "vim": [r"vim"],
    "json": [r"json"],
    "ijg": [r"ijg"],
    "curl": [r"curl"],
    "beerware": [r"beerware"],
}

#: fixed values: openings before a name, which raise it to priority 1
OPENINGS = [
    r"licensed under",
    r"released under",
    r"distributed under",
    r"available under",
    r"published under",
    r"provided under",
    r"covered by",
    r"governed by",
    r"subject to",
]
_TERMS = r"(?: the| a| an)?(?: terms(?: and conditions)? of)?(?: the)?"

#: fixed values: label, priority, phrases of licence texts
TEXTS: list[tuple[str, int, str]] = [
    ("mit", 1, r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 2, r"the above copyright notice and this permission notice shall be included in all copies"),
    ("isc", 1, r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee"),
    ("bsd", 1, r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 2, r"redistributions of source code must retain the above copyright notice"),
    ("bsd", 2, r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", 2, r"neither the name of .{1,60}? nor the names of (?:its|the) contributors may be used"),
    ("bsd-4-clause", 2, r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", 1, r"you may not use this file except in compliance with the license"),
    ("apache-2.0", 2, r"you may obtain a copy of the license at http(?:s)? www apache org licenses license 2 0"),
    ("apache-2.0", 2, r"unless required by applicable law or agreed to in writing software distributed under the license"),
    ("gpl", 1, r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public"),
    ("gpl", 2, r"you should have received a copy of the gnu general public license"),
    ("lgpl", 2, r"you should have received a copy of the gnu lesser general public license"),
    ("agpl", 2, r"you should have received a copy of the gnu affero general public license"),
    ("mpl-2.0", 1, r"this source code form is subject to the terms of the mozilla public license"),
    ("epl", 2, r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", 2, r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("bsl-1.0", 1, r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("zlib", 1, r"this software is provided as is without any express or implied warranty in no event will the authors be held"),
    ("zlib", 2, r"altered source versions must be plainly marked as such"),
    ("unlicense", 1, r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", 1, r"you just do what the fuck you want to"),
    ("ofl", 2, r"this font software is licensed under the sil open font license"),
    ("cc-by", 2, r"this work is licensed under a creative commons attribution"),
    ("public-domain", 2, r"dedicated to the public domain"),
    ("public-domain", 2, r"released into the public domain"),
    ("proprietary", 2, r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("warranty-disclaimer", 3, r"the software is provided as is without warranty of any kind"),
    ("warranty-disclaimer", 3, r"this software is provided by the copyright holders and contributors as is"),
    ("spdx", 3, r"spdx license identifier"),
    ("license-mention", 3, r"see the license file"),
    ("license-mention", 3, r"see license (?:file|txt|md)"),
    ("license-mention", 3, r"license file for"),
    ("copyright", 3, r"copyright (?:c )?(?:19|20)\d\d"),
]

#: fixed values: words of which every match holds one; texts without any are not looked at
GATE = (
    "license licence licensed unlicense spdx copyright copying permission redistribution redistributions redistribute "
    "contributors advertising warranty altered unencumbered fuck domain rights proprietary commons artistic apache mit "
    "bsd 0bsd gpl gplv2 gplv3 lgpl lgplv2 lgplv3 agpl agplv3 gfdl asl mpl mplv2 epl cddl cpl eupl osl afl bsl busl sspl "
    "cc cc0 wtfpl ofl odbl odc pddl ms upl ecl cecill rail openrail creativeml "
    "isc elastic zlib libpng openssl python psf php ruby postgresql ncsa unicode w3c vim json ijg curl beerware"
).split()


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    priority: int
    keyword: str
    pattern: str  # to be tried on words that each end with a blank


def keyword_of(words: str) -> str:
    """The plain word that every match begins with; what follows it begins with a blank, be it optional or not."""
    found = re.match(r"([a-z0-9]+)(?: |$|(?:\(\?:(?: [^()|]*\|)* [^()|]*\)\?)+(?: |$))", words)
    if not found:
        raise ValueError(f"a rule must begin with a plain word: {words}")
    return found[1]


def rules() -> list[Rule]:
    out: list[Rule] = []

    def add(label: str, priority: int, words: str) -> None:
        out.append(Rule(len(out), label, priority, keyword_of(words), f"^{words} "))

    for label, priority, text in TEXTS:
        add(label, priority, text)
    for label, priority, names in NAMES:
        every = "|".join([*names, *IDENTIFIERS.get(label, [])])
        if priority < 3:
            add(label, 1, rf"spdx license identifier (?:{every})")
            for opening in OPENINGS:
                add(label, 1, rf"{opening}{_TERMS} (?:{every})")
    for label, priority, names in NAMES:
        for name in names:
            add(label, priority, name)
    return out
