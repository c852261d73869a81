"""Signatures of licences, written for words in lower case with one blank
between them (``apache license version 2 0``).

``KNOWN`` lists a licence's label, the words of its SPDX tag, a pattern for its
names, and patterns for sentences that only its text has. Rules are made from
them in a fixed order: tags, grants, names, sentences.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    """A detection by ``pattern`` counts for ``label``; it is looked for in
    texts that hold one of the words of ``keyword``: each match has at least one
    of them as a word. Lower ``priority`` is stronger."""

    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float


# label, keywords of the names (one for each alternative), SPDX words, names, sentences (keyword, pattern)
KNOWN = [
    ("mit", "mit expat", "mit", r"mit (?:expat )?licen[cs]e|expat licen[cs]e", [
        ("permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
        ("noninfringement", r"merchantability fitness for a particular purpose and noninfringement"),
    ]),
    ("mit-0", "attribution", "mit 0", r"mit no attribution(?: licen[cs]e)?", []),
    ("apache-2.0", "apache", "apache 2 0", r"apache (?:software )?licen[cs]e(?: version)? (?:v )?v?2(?: 0)?|apache 2 0(?: licen[cs]e)?|apl? ?2 0 apache", [
        ("compliance", r"you may not use this file except in compliance with the license"),
        ("apache", r"www apache org licenses license 2 0"),
    ]),
    ("apache-1.1", "apache", "apache 1 1", r"apache (?:software )?licen[cs]e(?: version)? 1 1", [
        ("apache", r"products derived from this software may not be called apache"),
    ]),
    ("apache-1.0", "apache", "apache 1 0", r"apache (?:software )?licen[cs]e(?: version)? 1 0", []),
    ("bsd-2-clause", "bsd", "bsd 2 clause", r"(?:simplified|freebsd|2 clause|two clause) bsd licen[cs]e|bsd (?:2|two) clause(?: licen[cs]e)?", [
        ("redistributions", r"redistributions in binary form must reproduce the above copyright notice"),
    ]),
    ("bsd-3-clause", "bsd", "bsd 3 clause", r"(?:new|revised|modified|3 clause|three clause) bsd licen[cs]e|bsd (?:3|three) clause(?: licen[cs]e)?", [
        ("endorse", r"may be used to endorse or promote products derived from this software without"),
    ]),
    ("bsd-4-clause", "bsd", "bsd 4 clause", r"(?:original|old|4 clause|four clause) bsd licen[cs]e|bsd (?:4|four) clause(?: licen[cs]e)?", [
        ("advertising", r"all advertising materials mentioning features or use of this software must display"),
    ]),
    ("0bsd", "0bsd zero", "0bsd", r"0bsd licen[cs]e|zero clause bsd(?: licen[cs]e)?", []),
    ("gpl-1.0", "general gpl gpl1 gplv1", "gpl 1 0", r"general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 1|gpl ?v?1(?: 0)?", []),
    ("gpl-2.0", "general gpl", "gpl 2 0", r"general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version|v) ?2|gnu gpl v?(?:version )?2(?: 0)?", [
        ("franklin", r"51 franklin (?:street|st) fifth floor boston ma"),
        ("option", r"either version 2 of the license or at your option any later version"),
    ]),
    ("gpl-3.0", "general gpl", "gpl 3 0", r"general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version|v) ?3|gnu gpl v?(?:version )?3(?: 0)?", [
        ("option", r"either version 3 of the license or at your option any later version"),
    ]),
    ("lgpl-2.0", "library", "lgpl 2 0", r"(?:gnu )?library general public licen[cs]e(?: version 2(?: 0)?)?", []),
    ("lgpl-2.1", "lesser lgpl", "lgpl 2 1", r"(?:gnu )?lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 2 1|lgpl v?2 1", []),
    ("lgpl-3.0", "lesser lgpl", "lgpl 3 0", r"(?:gnu )?lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 3(?: 0)?|lgpl v?3(?: 0)?", []),
    ("lgpl", "lesser", "lgpl", r"(?:gnu )?lesser general public licen[cs]e", []),
    ("agpl-1.0", "affero", "agpl 1 0", r"affero general public licen[cs]e version 1", []),
    ("agpl-3.0", "affero agpl", "agpl 3 0", r"(?:gnu )?affero general public licen[cs]e(?: version 3(?: 0)?)?|agpl v?3(?: 0)?", [
        ("interacting", r"all users interacting with it remotely through a computer network"),
    ]),
    ("gfdl-1.1", "documentation", "gfdl 1 1", r"(?:gnu )?free documentation licen[cs]e version 1 1", []),
    ("gfdl-1.2", "documentation", "gfdl 1 2", r"(?:gnu )?free documentation licen[cs]e version 1 2", []),
    ("gfdl-1.3", "documentation", "gfdl 1 3", r"(?:gnu )?free documentation licen[cs]e version 1 3", [
        ("invariant", r"with no invariant sections no front cover texts and no back cover texts"),
    ]),
    ("mpl-1.0", "mozilla", "mpl 1 0", r"mozilla public licen[cs]e(?: version)? (?:v )?1 0", []),
    ("mpl-1.1", "mozilla", "mpl 1 1", r"mozilla public licen[cs]e(?: version)? (?:v )?1 1", []),
    ("mpl-2.0", "mozilla", "mpl 2 0", r"mozilla public licen[cs]e(?: version)? (?:v )?v?2(?: 0)?", [
        ("mozilla", r"this source code form is subject to the terms of the mozilla public license"),
    ]),
    ("epl-1.0", "eclipse", "epl 1 0", r"eclipse public licen[cs]e(?: version)? (?:v )?1(?: 0)?", []),
    ("epl-2.0", "eclipse", "epl 2 0", r"eclipse public licen[cs]e(?: version)? (?:v )?2(?: 0)?", []),
    ("edl-1.0", "eclipse", "edl 1 0", r"eclipse distribution licen[cs]e(?: version)?(?: v? ?1 0)?", []),
    ("cddl-1.0", "cddl development", "cddl 1 0", r"common development and distribution licen[cs]e(?: version 1 0)?|cddl 1 0", []),
    ("cddl-1.1", "cddl development", "cddl 1 1", r"common development and distribution licen[cs]e version 1 1|cddl 1 1", []),
    ("cpl-1.0", "common", "cpl 1 0", r"common public licen[cs]e(?: version 1 0)?", []),
    ("ipl-1.0", "ibm", "ipl 1 0", r"ibm public licen[cs]e(?: version 1 0)?", []),
    ("isc", "isc", "isc", r"isc licen[cs]e", [
        ("fee", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ]),
    ("zlib", "zlib", "zlib", r"zlib licen[cs]e", [
        ("misrepresented", r"the origin of this software must not be misrepresented"),
    ]),
    ("libpng", "libpng", "libpng", r"libpng licen[cs]e", []),
    ("boost-1.0", "boost", "bsl 1 0", r"boost software licen[cs]e(?: version 1 0)?", []),
    ("unlicense", "unlicense", "unlicense", r"the unlicense", [
        ("unencumbered", r"this is free and unencumbered software released into the public domain"),
    ]),
    ("wtfpl", "wtfpl fuck", "wtfpl", r"do what the fuck you want to public licen[cs]e|wtfpl", []),
    ("artistic-1.0", "artistic", "artistic 1 0", r"artistic licen[cs]e 1 0|the artistic licen[cs]e", []),
    ("artistic-2.0", "artistic", "artistic 2 0", r"artistic licen[cs]e(?: version)? 2(?: 0)?", []),
    ("perl", "perl", "perl", r"same terms as perl(?: itself)?", []),
    ("psf-2.0", "python psf", "psf 2 0", r"python software foundation licen[cs]e(?: version 2)?|psf licen[cs]e", []),
    ("php-3.01", "php", "php 3 01", r"php licen[cs]e(?: version 3 01)?", []),
    ("ruby", "ruby", "ruby", r"ruby licen[cs]e", []),
    ("postgresql", "postgresql", "postgresql", r"postgresql licen[cs]e", []),
    ("openssl", "openssl", "openssl", r"openssl licen[cs]e", [
        ("openssl", r"this product includes software developed by the openssl project"),
    ]),
    ("curl", "curl", "curl", r"curl licen[cs]e", []),
    ("x11", "x11", "x11", r"x11 licen[cs]e", []),
    ("ncsa", "ncsa", "ncsa", r"university of illinois ncsa open source licen[cs]e|ncsa licen[cs]e", []),
    ("ms-pl", "microsoft", "ms pl", r"microsoft public licen[cs]e", []),
    ("ms-rl", "microsoft", "ms rl", r"microsoft reciprocal licen[cs]e", []),
    ("eupl-1.1", "european", "eupl 1 1", r"european union public licen[cs]e(?: version)? (?:v )?1 1", []),
    ("eupl-1.2", "european", "eupl 1 2", r"european union public licen[cs]e(?: version)? (?:v )?1 2", []),
    ("osl-3.0", "open", "osl 3 0", r"open software licen[cs]e(?: version)? (?:v )?3(?: 0)?", []),
    ("afl-3.0", "academic", "afl 3 0", r"academic free licen[cs]e(?: version)? (?:v )?3(?: 0)?", []),
    ("ecl-2.0", "educational", "ecl 2 0", r"educational community licen[cs]e(?: version)?(?: 2 0)?", []),
    ("ofl-1.1", "sil", "ofl 1 1", r"sil open font licen[cs]e(?: version)?(?: 1 1)?", [
        ("font", r"the font software may be modified altered or added to"),
    ]),
    ("bsl-1.1", "business", "busl 1 1", r"business source licen[cs]e(?: version)?(?: 1 1)?", []),
    ("sspl-1.0", "server", "sspl 1 0", r"server side public licen[cs]e(?: version 1)?", []),
    ("elastic-2.0", "elastic", "elastic 2 0", r"elastic licen[cs]e(?: version)?(?: 2 0)?", []),
    ("commons-clause", "commons", "commons clause", r"commons clause(?: licen[cs]e)?(?: condition)?", []),
    ("cc0-1.0", "cc0 zero", "cc0 1 0", r"cc0(?: 1 0)?(?: universal)?|creative commons zero", [
        ("waived", r"waived all copyright and related or neighboring rights"),
    ]),
    ("cc-by-2.0", "cc creative", "cc by 2 0", r"cc by 2 0|creative commons attribution 2 0(?: generic)?", []),
    ("cc-by-2.5", "cc creative", "cc by 2 5", r"cc by 2 5|creative commons attribution 2 5(?: generic)?", []),
    ("cc-by-3.0", "cc creative", "cc by 3 0", r"cc by 3 0|creative commons attribution 3 0(?: unported)?", []),
    ("cc-by-4.0", "cc creative", "cc by 4 0", r"cc by 4 0|creative commons attribution 4 0(?: international)?", []),
    ("cc-by-sa-2.0", "cc", "cc by sa 2 0", r"cc by sa 2 0", []),
    ("cc-by-sa-2.5", "cc", "cc by sa 2 5", r"cc by sa 2 5", []),
    ("cc-by-sa-3.0", "cc", "cc by sa 3 0", r"cc by sa 3 0", []),
    ("cc-by-sa-4.0", "cc", "cc by sa 4 0", r"cc by sa 4 0", []),
    ("cc-by-nc-2.0", "cc", "cc by nc 2 0", r"cc by nc 2 0", []),
    ("cc-by-nc-3.0", "cc", "cc by nc 3 0", r"cc by nc 3 0", []),
    ("cc-by-nc-4.0", "cc", "cc by nc 4 0", r"cc by nc 4 0", []),
    ("cc-by-nd-3.0", "cc", "cc by nd 3 0", r"cc by nd 3 0", []),
    ("cc-by-nd-4.0", "cc", "cc by nd 4 0", r"cc by nd 4 0", []),
    ("cc-by-nc-sa-3.0", "cc", "cc by nc sa 3 0", r"cc by nc sa 3 0", []),
    ("cc-by-nc-sa-4.0", "cc", "cc by nc sa 4 0", r"cc by nc sa 4 0", []),
    ("cc-by-nc-nd-3.0", "cc", "cc by nc nd 3 0", r"cc by nc nd 3 0", []),
    ("cc-by-nc-nd-4.0", "cc", "cc by nc nd 4 0", r"cc by nc nd 4 0", []),
    ("odbl-1.0", "database", "odbl 1 0", r"open (?:data commons open )?database licen[cs]e(?: version)?(?: v? ?1 0)?", []),
    ("odc-by-1.0", "commons", "odc by 1 0", r"open data commons attribution licen[cs]e", []),
    ("pddl-1.0", "pddl dedication", "pddl 1 0", r"public domain dedication and licen[cs]e|pddl", []),
    ("public-domain", "domain", "public domain", r"(?:is|are|placed|released|dedicated)(?: in| into| to)? the public domain", []),
    ("cecill-2.1", "cecill", "cecill 2 1", r"cecill(?: free software)?(?: licen[cs]e)?(?: agreement)?(?: version)?(?: 2 1)?", []),
    ("llama-community", "llama", "llama community", r"llama (?:2 |3 )?community licen[cs]e(?: agreement)?", []),
    ("openrail-m", "rail openrail", "openrail m", r"(?:creativeml |bigscience )?open ?rail m(?: licen[cs]e)?", []),
    ("proprietary", "proprietary", "licenseref proprietary", r"proprietary and confidential|proprietary licen[cs]e", [
        ("unauthorized", r"unauthorized copying of this file via any medium is strictly prohibited"),
    ]),
    ("cc-by", "cc creative", "cc by", r"cc by|creative commons attribution", []),
    ("bsd", "bsd", "bsd", r"bsd(?: style)? licen[cs]e", []),
    ("gpl", "general", "gpl", r"(?:gnu )?general public licen[cs]e", []),
    ("apache", "apache", "apache", r"apache licen[cs]e", []),
    ("reserved", "reserved", "licenseref all rights reserved", r"all rights reserved", []),
]

_GRANT = (
    r"(?:licen[cs]ed|released|distributed|available|published|provided|offered|redistribute it and or modify it)"
    r" under (?:the )?(?:terms of )?(?:the )?(?:gnu )?"
)


def rules() -> list[Rule]:
    """All rules, strongest first."""
    tags = [Rule(x[0], "spdx", rf"spdx license identifier {x[2]}", 0, 1.0) for x in KNOWN]
    grants = [Rule(x[0], x[1], rf"{_GRANT}(?:{x[3]})", 1, 0.95) for x in KNOWN]
    sentences = [Rule(x[0], k, p, 1, 0.9) for x in KNOWN for k, p in x[4]]
    names = [Rule(x[0], x[1], x[3], 2, 0.7) for x in KNOWN]
    return tags + grants + sentences + names
