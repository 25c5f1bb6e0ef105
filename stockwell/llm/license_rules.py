"""Licence signature rules: one regular expression each, over normalised words.

A rule is tried only on texts that hold one of its keywords. Patterns are written for text
of lower-case words with one space between them, so "GPL-3.0" reads "gpl 3 0".
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    #: Every text that the pattern fits holds one of these strings.
    keywords: tuple[str, ...]
    pattern: str
    #: Detections of a lower or equal priority inside one of this rule go.
    priority: int
    score: float
    base: bool = False


#: The base phrases and their labels.
BASE_PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

_V = r"(?:v |version |ver )?"
#: Licence families: label, keywords of its names, and the names.
FAMILIES = [
    ("gpl-1.0", "gnu gpl", rf"gnu general public licen[cs]e {_V}1(?: 0)?|gpl {_V}1(?: 0)?"),
    ("gpl-2.0", "gnu gpl", rf"gnu general public licen[cs]e {_V}2(?: 0)?|gpl(?:v2| {_V}2(?: 0)?)"),
    ("gpl-3.0", "gnu gpl", rf"gnu general public licen[cs]e {_V}3(?: 0)?|gpl(?:v3| {_V}3(?: 0)?)"),
    ("lgpl-2.0", "gnu lgpl", rf"gnu library general public licen[cs]e {_V}2(?: 0)?|lgpl {_V}2(?: 0)?"),
    ("lgpl-2.1", "gnu lgpl", rf"gnu lesser general public licen[cs]e {_V}2 1|lgpl(?:v2| {_V}2) 1"),
    ("lgpl-3.0", "gnu lgpl", rf"gnu lesser general public licen[cs]e {_V}3(?: 0)?|lgpl(?:v3| {_V}3(?: 0)?)"),
    ("agpl-3.0", "gnu agpl", rf"gnu affero general public licen[cs]e {_V}3(?: 0)?|agpl(?:v3| {_V}3(?: 0)?)"),
    ("gfdl-1.3", "gnu gfdl", rf"gnu free documentation licen[cs]e {_V}1 3|gfdl {_V}1 3"),
    ("apache-1.1", "apache", rf"apache (?:software )?licen[cs]e {_V}1 1|apache 1 1"),
    ("apache-2.0", "apache", rf"apache (?:software )?licen[cs]e {_V}2(?: 0)?|apache 2(?: 0)?"),
    ("mit", "mit", r"mit licen[cs]e|mit x11 licen[cs]e|expat licen[cs]e mit"),
    ("mit-0", "mit", r"mit no attribution|mit 0"),
    ("bsd-2-clause", "bsd", r"bsd 2 clause|2 clause bsd|simplified bsd|freebsd licen[cs]e bsd"),
    ("bsd-3-clause", "bsd", r"bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd"),
    ("bsd-4-clause", "bsd", r"bsd 4 clause|4 clause bsd|original bsd"),
    ("0bsd", "0bsd", r"0bsd|0bsd zero clause"),
    ("isc", "isc", r"isc licen[cs]e|isc"),
    ("mpl-1.1", "mozilla mpl", rf"mozilla public licen[cs]e {_V}1 1|mpl {_V}1 1"),
    ("mpl-2.0", "mozilla mpl", rf"mozilla public licen[cs]e {_V}2(?: 0)?|mpl {_V}2(?: 0)?"),
    ("epl-1.0", "eclipse epl", rf"eclipse public licen[cs]e {_V}1 0|epl {_V}1 0"),
    ("epl-2.0", "eclipse epl", rf"eclipse public licen[cs]e {_V}2 0|epl {_V}2 0"),
    ("cddl-1.0", "development cddl", rf"common development and distribution licen[cs]e {_V}1 0|cddl {_V}1 0"),
    ("eupl-1.2", "european eupl", rf"european union public licen[cs]e {_V}1 2|eupl {_V}1 2"),
    ("artistic-1.0", "artistic", rf"artistic licen[cs]e {_V}1 0|artistic 1 0"),
    ("artistic-2.0", "artistic", rf"artistic licen[cs]e {_V}2 0|artistic 2 0"),
    ("zlib", "zlib", r"zlib(?: libpng)?(?: licen[cs]e)?"),
    ("bsl-1.0", "boost", rf"boost software licen[cs]e {_V}1 0|boost software licen[cs]e"),
    ("unlicense", "unlicense", r"the unlicense|unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e|microsoft ms pl"),
    ("ofl-1.1", "open", rf"sil open font licen[cs]e(?: {_V}1 1)?|open font licen[cs]e"),
    ("odbl-1.0", "open", r"open database licen[cs]e(?: v?1 0)?|open data commons open database"),
    ("psf-2.0", "python", r"python software foundation licen[cs]e(?: 2)?|python licen[cs]e"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
]
#: Creative Commons: parts of the name, the words for them, and versions.
CC_PARTS = [
    ("by", "by", "attribution"),
    ("by-sa", "by sa", "attribution share ?alike"),
    ("by-nc", "by nc", "attribution non ?commercial"),
    ("by-nd", "by nd", "attribution no ?deriv(?:ative|ativ|s)?e?s?"),
    ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative|ativ|s)?e?s?"),
]
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
#: How a licence is stated: form, words around the name, priority and certainty.
FORMS = [
    ("name", "(?:{})", 20, 0.7),
    ("tag", "spdx licen[cs]e identifier (?:{})", 60, 1.0),
    ("grant", "(?:licen[cs]ed|released|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?(?:{})(?: licen[cs]e)?", 50, 0.95),
    ("subject", "(?:subject to|governed by|covered by) (?:the )?(?:terms of )?(?:the )?(?:{})(?: licen[cs]e)?", 40, 0.9),
    ("field", "licen[cs]e (?:is )?(?:the )?(?:{})", 30, 0.85),
]
#: Statements that name no licence of the families above.
OTHERS = [
    ("all-rights-reserved", "proprietary", "rights", "all rights reserved", 30, 0.8),
    ("public-domain", "public-domain", "domain", "(?:dedicated|released|placed|put) (?:in|to|into) the public domain", 40, 0.9),
    ("public-domain-notice", "public-domain", "domain", "public domain", 10, 0.5),
    ("bsd-redistribution", "bsd", "redistribution", "redistribution and use in source and binary forms with or without modification", 50, 0.9),
    ("bsd-endorsement", "bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software", 50, 0.9),
    ("mit-permission", "mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 50, 0.95),
    ("isc-permission", "isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 50, 0.95),
    ("copyright-holder", "copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", 10, 0.4),
]
#: Strings of which every rule needs one at the start of a word; other texts are not looked at further.
ANCHORS = [
    "licen", "unlicen", "gpl", "lgpl", "agpl", "apache", "cc by", "cc0", "mit no attribution", "mit 0", "bsd", "spdx",
    "mpl", "epl", "cddl", "eupl", "gfdl", "artistic", "zlib", "wtfpl", "0bsd", "isc ", "public domain", "copyright",
    "all rights reserved", "redistribution", "permission", "endorse", "creative commons", "clause bsd", "simplified bsd",
    "open data commons", "ms pl", "released under", "distributed under", "available under", "provided under",
]


def build_rules() -> list[Rule]:
    """All rules in order; equal priorities fall to the earlier one."""
    rules = [
        Rule(f"base-{label}", label, (phrase,), phrase, 10, 0.5, base=True)
        for phrase, label in BASE_PHRASES
    ]
    families = list(FAMILIES)
    for part, short, words in CC_PARTS:
        for version in CC_VERSIONS:
            label = f"cc-{part}-{version.replace(' ', '.')}"
            long = rf"creative commons {words}(?: international| unported)? (?:licen[cs]e )?{_V}{version}"
            families.append((label, "cc creative", rf"cc {short} {_V}{version}|{long}"))
    for label, keywords, names in families:
        for form, around, priority, score in FORMS:
            rules.append(Rule(f"{label}-{form}", label, tuple(keywords.split()), around.replace("{}", names), priority, score))
    rules += [Rule(name, label, (keyword,), *rest) for name, label, keyword, *rest in OTHERS]
    return rules


RULES = build_rules()
