"""The signature rules of the licence scan, built from licence names and the ways a notice can name them.

A rule is (id, label, priority, keyword, pattern). Patterns run over a text's lower-case words joined by single spaces.
Every match of a pattern holds the rule's keyword at the start of a word: ways to name a licence that share no word are
rules of their own.
Priority 1 (a machine-readable tag) outranks 2 (a notice), 3 (a name with the word licence) and 4 (a bare mention).
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    id: str
    label: str
    priority: int
    keyword: str
    pattern: str


_V2 = r"(?:version |v ?)?2(?: 0)?"
_GPL = r"(?:gnu )?gpl(?: version| v)? ?"
# Label, words that name the licence, its keyword.
NAMES = [
    ("mit", r"mit", "mit"),
    ("mit", r"expat", "expat"),
    ("mit", r"x11", "x11"),
    ("apache-2", rf"apache(?: software)?(?: license| licence)? {_V2}", "apache"),
    ("apache-1.1", r"apache(?: software)?(?: license| licence)? (?:version |v ?)?1 1", "apache"),
    ("bsd-2", r"(?:2 clause|simplified|freebsd) bsd|bsd 2(?: clause)?", "bsd"),
    ("bsd-3", r"(?:3 clause|new|modified|revised) bsd|bsd 3(?: clause)?", "bsd"),
    ("bsd-4", r"(?:4 clause|original) bsd|bsd 4(?: clause)?", "bsd"),
    ("0bsd", r"(?:zero clause bsd|0 clause bsd)", "bsd"),
    ("0bsd", r"0bsd", "0bsd"),
    ("gpl-1", r"(?:gnu )?general public license(?: version| v)? ?1(?: 0)?", "general public"),
    ("gpl-1", _GPL + r"1(?: 0)?", "gpl"),
    ("gpl-2", r"(?:gnu )?general public licen[cs]e(?: version| v)? ?2(?: 0)?", "general public"),
    ("gpl-2", _GPL + r"2(?: 0)?", "gpl"),
    ("gpl-3", r"(?:gnu )?general public licen[cs]e(?: version| v)? ?3(?: 0)?", "general public"),
    ("gpl-3", _GPL + r"3(?: 0)?", "gpl"),
    ("gpl-2", r"gpl ?v? ?2(?: 0)?", "gpl"),
    ("gpl-3", r"gpl ?v? ?3(?: 0)?", "gpl"),
    ("lgpl-2", r"(?:gnu )?(?:library|lesser) general public licen[cs]e(?: version| v)? ?2(?: 0)?", "general public"),
    ("lgpl-2.1", r"(?:gnu )?lesser general public licen[cs]e(?: version| v)? ?2 1", "general public"),
    ("lgpl-3", r"(?:gnu )?lesser general public licen[cs]e(?: version| v)? ?3(?: 0)?", "general public"),
    ("lgpl-2.1", r"lgpl ?v? ?2 1", "lgpl"),
    ("lgpl-3", r"lgpl ?v? ?3(?: 0)?", "lgpl"),
    ("agpl-3", r"(?:gnu )?affero general public licen[cs]e(?: version| v)? ?3(?: 0)?", "affero"),
    ("agpl-3", r"agpl ?v? ?3(?: 0)?", "agpl"),
    ("mpl-1.1", r"mozilla public licen[cs]e(?: version| v)? ?1 1", "mozilla"),
    ("mpl-2", r"mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?", "mozilla"),
    ("epl-1", r"eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?", "eclipse"),
    ("epl-2", r"eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?", "eclipse"),
    ("cddl-1", r"common development and distribution licen[cs]e(?: version| v)?(?: 1(?: 0)?)?", "common development"),
    ("eupl", r"european union public licen[cs]e", "european union"),
    ("isc", r"isc", "isc"),
    ("zlib", r"zlib", "zlib"),
    ("bsl-1", r"boost software licen[cs]e(?: version)? 1(?: 0)?", "boost"),
    ("artistic-2", r"artistic licen[cs]e(?: version)? 2(?: 0)?", "artistic"),
    ("artistic-1", r"artistic licen[cs]e(?: version)? 1(?: 0)?", "artistic"),
    ("unlicense", r"unlicense", "unlicense"),
    ("wtfpl", r"do what the fuck you want to public licen[cs]e", "do what the"),
    ("wtfpl", r"wtfpl", "wtfpl"),
    ("ofl-1.1", r"sil open font licen[cs]e(?: version)?(?: 1 1)?", "open font"),
    ("ncsa", r"university of illinois ncsa open source licen[cs]e", "ncsa"),
    ("python-2", r"python software foundation licen[cs]e(?: version 2)?", "python software"),
    ("postgresql", r"postgresql", "postgresql"),
    ("ms-pl", r"microsoft public licen[cs]e", "microsoft"),
    ("ms-rl", r"microsoft reciprocal licen[cs]e", "microsoft"),
    ("osl-3", r"open software licen[cs]e(?: version| v)? ?3(?: 0)?", "open software"),
    ("afl-3", r"academic free licen[cs]e(?: version| v)? ?3(?: 0)?", "academic free"),
    ("qpl-1", r"q public licen[cs]e", "q public"),
    ("cpl-1", r"common public licen[cs]e(?: version)?(?: 1(?: 0)?)?", "common public"),
    ("odbl-1", r"open database licen[cs]e", "open database"),
    ("odc-by", r"open data commons attribution licen[cs]e", "open data commons"),
    ("gfdl", r"gnu free documentation licen[cs]e", "free documentation"),
    ("ruby", r"ruby", "ruby"),
    ("php-3", r"php licen[cs]e(?: version)? 3(?: 0| 01)?", "php"),
    ("vim", r"vim", "vim"),
    ("openssl", r"openssl", "openssl"),
    ("sspl-1", r"server side public licen[cs]e", "server side"),
    ("busl-1.1", r"business source licen[cs]e(?: 1 1)?", "business source"),
    ("elastic-2", r"elastic licen[cs]e(?: 2(?: 0)?)?", "elastic"),
]
# The creative commons family, its short words and long name.
COMMONS = [
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative)?s"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
]
# Phrases that speak of rights without a licence's name.
HINTS = [
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", r"(?:is|are) in the public domain"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "without permission", r"(?:may not|no part of this \w+ may) be (?:copied|reproduced)[a-z ]{0,60} without permission"),
    ("permissive", "permission is hereby granted", r"permission is hereby granted free of charge"),
    ("permissive", "redistribution and use", r"redistribution and use in source and binary forms"),
    ("permissive", "without warranty", r"provided as is without warranty"),
    ("copyleft", "free software", r"this program is free software"),
]
_LICENCE = r"licen[cs]e"
_WAYS = [
    ("tag", 1, "spdx", r"spdx {licence} identifier {name}(?: only| or later)?"),
    ("notice", 2, "under", r"under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{name}(?: {licence})?"),
    ("grant", 2, "licen", r"(?:is |are |dual )?licensed (?:as|with|by) (?:the )?{name}(?: {licence})?"),
    ("covered", 2, "covered", r"covered by (?:the )?{name}(?: {licence})?"),
    ("header", 2, "licen", r"{licence} (?:is |type )?{name}"),
    ("name", 3, "licen", r"(?:the )?{name} {licence}"),
]


def rules() -> list[Rule]:
    """Every rule, in order: earlier rules win between equals."""
    found = []
    for n, (label, name, keyword) in enumerate(NAMES):
        for way, priority, _, pattern in _WAYS:
            body = pattern.replace("{licence}", _LICENCE).replace("{name}", f"(?:{name})")
            found.append(Rule(f"{way}-{label}-{n}", label, priority, keyword, body))
        # A name that says licence itself, or is short for one that does, is a mention even without the word after it.
        if "licen" in name or name.startswith(_GPL) or name == "wtfpl":
            found.append(Rule(f"mention-{label}-{n}", label, 3, keyword, f"(?:{name})"))
    for label, short, long in COMMONS:
        found.append(Rule(f"tag-{label}", label, 1, "spdx", rf"spdx {_LICENCE} identifier cc {short}(?: [1-4] [0-9])?"))
        found.append(Rule(f"short-{label}", label, 2, "cc", rf"cc {short}(?: [1-4] [0-9])?"))
        found.append(Rule(f"long-{label}", label, 2, "creative commons", rf"creative commons {long}(?: [1-4] [0-9])?(?: international)?"))
        found.append(Rule(f"under-{label}", label, 2, "under", rf"under (?:a |the )?creative commons {long}(?: [1-4] [0-9])?(?: international)?(?: {_LICENCE})?"))
    found += [Rule(f"hint-{label}-{n}", label, 4, keyword, body) for n, (label, keyword, body) in enumerate(HINTS)]
    return sorted(found, key=lambda r: r.priority)
