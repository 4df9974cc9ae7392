"""Signature rules for licences: what their texts, names and tags look like, in order of priority.

A rule is a regular expression over words (lower case, single spaces), a keyword
that every match of it contains, a priority (0 first), a label and a score.  The
forms below are applied to the names of each licence, which makes several
hundred rules; a rule without a label only suppresses what lies inside its match.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    number: int
    keyword: str
    # Whether every match also holds the word license or licence.
    licence: bool
    pattern: str
    priority: int
    label: str | None
    score: float
    base: bool


# Phrases whose places are counted, and the labels they always give.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
BASE_SCORE = 0.6

# Label, keyword, words of the name (an expression that contains the keyword), SPDX words.
NAMED = [
    ("mit", "mit", "(?:the )?mit (?:x11 |style )?licen[cs]e", "mit"),
    ("mit", "expat", "expat licen[cs]e", None),
    ("mit-0", "mit", "mit (?:no attribution|0)(?: licen[cs]e)?", "mit 0"),
    ("x11", "x11", "(?:mit )?x11 licen[cs]e", "x11"),
    ("apache-1.0", "apache", "apache (?:software )?licen[cs]e (?:version |v)?1 0", "apache 1 0"),
    ("apache-1.1", "apache", "apache (?:software )?licen[cs]e (?:version |v)?1 1", "apache 1 1"),
    ("apache-2.0", "apache", "apache (?:software )?licen[cs]e (?:version |v)?2(?: 0)?", "apache 2 0"),
    ("apache-2.0", "apache", "apache (?:version |v)?2(?: 0)? licen[cs]e", None),
    ("asl-2.0", "asl", "asl (?:version |v)?2(?: 0)?", None),
    ("bsd-0-clause", "bsd", "(?:zero|0) clause bsd(?: licen[cs]e)?", "0bsd"),
    ("bsd-1-clause", "bsd", "(?:one|1) clause bsd(?: licen[cs]e)?", "bsd 1 clause"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|bsd simplified|(?:two|2) clause bsd|bsd (?:two|2) clause)(?: licen[cs]e)?", "bsd 2 clause"),
    ("bsd-2-clause", "freebsd", "freebsd licen[cs]e", None),
    ("bsd-3-clause", "bsd", "(?:(?:new|modified|revised) bsd|bsd (?:new|revised)|(?:three|3) clause bsd|bsd (?:three|3) clause)(?: licen[cs]e)?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd original|(?:four|4) clause bsd|bsd (?:four|4) clause)(?: licen[cs]e)?", "bsd 4 clause"),
    ("bsd", "bsd", "bsd (?:style )?licen[cs]e", None),
    ("isc", "isc", "isc licen[cs]e", "isc"),
    ("mpl-1.0", "mozilla", "mozilla public licen[cs]e (?:version |v)?1 0", "mpl 1 0"),
    ("mpl-1.1", "mozilla", "mozilla public licen[cs]e (?:version |v)?1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla", "mozilla public licen[cs]e (?:version |v)?2(?: 0)?", "mpl 2 0"),
    ("mpl-2.0", "mpl", "mpl (?:version |v)?2(?: 0)?", None),
    ("mpl", "mozilla", "mozilla public licen[cs]e", None),
    ("epl-1.0", "eclipse", "eclipse public licen[cs]e (?:version |v)?1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "eclipse", "eclipse public licen[cs]e (?:version |v)?2(?: 0)?", "epl 2 0"),
    ("epl", "eclipse", "eclipse public licen[cs]e", None),
    ("edl-1.0", "eclipse", "eclipse distribution licen[cs]e(?: (?:version |v)?1(?: 0)?)?", None),
    ("cddl-1.0", "cddl", "cddl (?:version |v)?1 0", "cddl 1 0"),
    ("cddl-1.1", "cddl", "cddl (?:version |v)?1 1", "cddl 1 1"),
    ("cddl", "distribution", "common development and distribution licen[cs]e", None),
    ("cpl-1.0", "common", "common public licen[cs]e(?: (?:version |v)?1(?: 0)?)?", "cpl 1 0"),
    ("boost-1.0", "boost", "boost software licen[cs]e(?: (?:version |v)?1(?: 0)?)?", "bsl 1 0"),
    ("bsl-1.1", "business", "business source licen[cs]e(?: (?:version |v)?1(?: 1)?)?", "busl 1 1"),
    ("artistic-1.0", "artistic", "artistic licen[cs]e (?:version |v)?1(?: 0)?", "artistic 1 0"),
    ("artistic-2.0", "artistic", "artistic licen[cs]e (?:version |v)?2(?: 0)?", "artistic 2 0"),
    ("artistic", "artistic", "artistic licen[cs]e", None),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e", "zlib"),
    ("libpng", "libpng", "libpng licen[cs]e(?: (?:version |v)?2)?", "libpng"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl(?: (?:version |v)?2)?", "wtfpl"),
    ("wtfpl", "fuck", "do what the fuck you want to public licen[cs]e", None),
    ("beerware", "beer", "beer ware licen[cs]e", "beerware"),
    ("beerware", "beerware", "beerware licen[cs]e", None),
    ("python-2.0", "python", "python (?:software foundation )?licen[cs]e(?: (?:version |v)?2(?: 0)?)?", "python 2 0"),
    ("psf-2.0", "psf", "psf licen[cs]e(?: (?:version |v)?2(?: 0)?)?", "psf 2 0"),
    ("ruby", "ruby", "ruby licen[cs]e", "ruby"),
    ("php-3.01", "php", "php licen[cs]e(?: (?:version |v)?3(?: 01?)?)?", "php 3 01"),
    ("postgresql", "postgresql", "postgresql licen[cs]e", "postgresql"),
    ("openssl", "openssl", "openssl licen[cs]e", "openssl"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa (?:open source )?licen[cs]e", "ncsa"),
    ("w3c", "w3c", "w3c (?:software (?:notice and )?)?licen[cs]e", "w3c"),
    ("eupl-1.1", "eupl", "eupl (?:version |v)?1 1", "eupl 1 1"),
    ("eupl-1.2", "eupl", "eupl (?:version |v)?1 2", "eupl 1 2"),
    ("eupl", "union", "european union public licen[cs]e", None),
    ("cecill-2.1", "cecill", "cecill(?: licen[cs]e)? (?:version |v)?2 1", "cecill 2 1"),
    ("cecill-b", "cecill", "cecill b(?: licen[cs]e)?", "cecill b"),
    ("cecill-c", "cecill", "cecill c(?: licen[cs]e)?", "cecill c"),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[cs]e", "ms rl"),
    ("osl-3.0", "open", "open software licen[cs]e(?: (?:version |v)?3(?: 0)?)?", "osl 3 0"),
    ("afl-3.0", "academic", "academic free licen[cs]e(?: (?:version |v)?3(?: 0)?)?", "afl 3 0"),
    ("ofl-1.1", "font", "(?:sil )?open font licen[cs]e(?: (?:version |v)?1(?: 1)?)?", "ofl 1 1"),
    ("ofl-1.1", "ofl", "ofl (?:version |v)?1 1", None),
    ("odbl-1.0", "database", "open database licen[cs]e(?: (?:version |v)?1(?: 0)?)?", "odbl 1 0"),
    ("odc-by-1.0", "attribution", "open data commons attribution licen[cs]e", "odc by 1 0"),
    ("pddl-1.0", "dedication", "public domain dedication and licen[cs]e", "pddl 1 0"),
    ("sspl-1.0", "server", "server side public licen[cs]e(?: (?:version |v)?1)?", "sspl 1 0"),
    ("elastic-2.0", "elastic", "elastic licen[cs]e(?: (?:version |v)?2(?: 0)?)?", "elastic 2 0"),
    ("upl-1.0", "universal", "universal permissive licen[cs]e(?: (?:version |v)?1(?: 0)?)?", "upl 1 0"),
    ("vim", "vim", "vim licen[cs]e", "vim"),
    ("curl", "curl", "curl licen[cs]e", "curl"),
    ("ijg", "jpeg", "independent jpeg group licen[cs]e", "ijg"),
    ("ftl", "freetype", "freetype (?:project )?licen[cs]e", "ftl"),
    ("tcl", "tcl", "tcl tk licen[cs]e", "tcl"),
    ("blueoak-1.0.0", "oak", "blue oak model licen[cs]e(?: 1 0 0)?", "blueoak 1 0 0"),
    ("mulanpsl-2.0", "mulan", "mulan (?:psl|permissive software licen[cs]e)(?: (?:version |v)?2)?", "mulanpsl 2 0"),
    ("openrail-m", "rail", "(?:creativeml |bigscience )?open rail m(?: licen[cs]e)?", None),
    ("openrail-m", "openrail", "(?:creativeml |bigscience )?openrail m(?: licen[cs]e)?", None),
    ("cc0-1.0", "cc0", "cc0(?: (?:version )?1 0)?(?: universal)?", "cc0 1 0"),
    ("cc0-1.0", "zero", "creative commons zero(?: (?:v)?1 0)?", None),
]

# GNU licences: short form and label, keyword, words of the name, versions.
GNU = [
    ("gpl", "general", "general public licen[cs]e", ("1", "2", "3")),
    ("lgpl", "general", "(?:lesser|library) general public licen[cs]e", ("2", "2.1", "3")),
    ("agpl", "affero", "affero general public licen[cs]e", ("1", "3")),
    ("gfdl", "documentation", "free documentation licen[cs]e", ("1.1", "1.2", "1.3")),
]
LATER = "or (?:at your option )?(?:any )?(?:later|newer|higher)(?: version)?"
# Creative Commons: parts of the name, and versions.
COMMONS_PARTS = {
    "by": "attribution",
    "by-sa": "attribution share(?: )?alike",
    "by-nc": "attribution non(?: )?commercial",
    "by-nd": "attribution no(?: )?derivatives",
    "by-nc-sa": "attribution non(?: )?commercial share(?: )?alike",
    "by-nc-nd": "attribution non(?: )?commercial no(?: )?derivatives",
}
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Places where the words name no licence of a text.
OTHER = [
    ("license", "(?:driver|drivers|driver s|driving|fishing|hunting|marriage|liquor|pilot|pilots|medical) license"),
    ("licence", "(?:driving|fishing|marriage|television|tv|pilot s) licence"),
    ("license", "license (?:plate|plates|number|fee|key|keys|server)"),
    ("mit", "mit (?:press|media lab|students?|professors?)"),
    ("apache", "apache (?:tribe|helicopters?|county|nation)"),
]
# Texts of licences that do not name them.
TEXTS = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy", 1.0),
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 1.0),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", 1.0),
    ("bsd-3-clause", "endorse", "neither the name of .{1,80}? may be used to endorse or promote products", 1.0),
    ("zlib", "warranty", "this software is provided as is without any express or implied warranty", 0.9),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 1.0),
    ("public-domain", "domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", 0.9),
    ("boost-1.0", "executable", "machine executable object code generated by a source language processor", 0.9),
    ("all-rights-reserved", "reserved", "all rights reserved", 0.3),
    ("proprietary", "proprietary", "proprietary and confidential", 0.5),
]
GRANT = "(?:licen[cs]ed|released|distributed|available|provided|published|covered|redistributed|used) (?:under|by|with) (?:the )?(?:terms of )?(?:the )?(?:gnu )?"
DENIAL = "(?:not|never|no longer) " + GRANT


def _names() -> list[tuple[str, str, str, str | None]]:
    names = list(NAMED)
    for short, keyword, name, versions in GNU:
        for v in versions:
            said, full = (v.replace(".", " "), v) if "." in v else (f"{v}(?: 0)?", f"{v}.0")
            version = f"(?:version |v)?{said}"
            forms = (keyword, f"(?:gnu )?{name} {version}"), (short, f"(?:gnu )?{short} {version}"), (f"{short}v{v[0]}", f"{short}v{said}")
            for word, form in forms:
                names.append((f"{short}-{full}", word, form, None))
                names.append((f"{short}-{full}-or-later", word, f"{form} {LATER}", None))
            for suffix in ("only", "or later"):
                tag = f"{short} {full.replace('.', ' ')} {suffix}"
                names.append((f"{short}-{full}-{suffix.replace(' ', '-')}", short, tag, tag))
        names.append((short, keyword, f"(?:gnu )?{name}", None))
    for kind, words in COMMONS_PARTS.items():
        for v in COMMONS_VERSIONS:
            said = v.replace(".", " ")
            label = f"cc-{kind}-{v}"
            short = f"cc {kind.replace('-', ' ')} {said}"
            names.append((label, "cc", f"{short}(?: (?:international|unported|generic))?", short))
            names.append((label, "commons", f"creative commons {words} {said}(?: (?:international|unported|generic))?(?: licen[cs]e)?", None))
            names.append((label, "creativecommons", f"creativecommons org licenses {kind.replace('-', ' ')} {said}", None))
    return names


# Parts of an expression that a match may lack.
_OPTIONAL = re.compile(r"\(\?:(?:[^()]|\([^()]*\))*\)\?")


def _surely_licence(pattern: str) -> bool:
    return re.search(r"\blicen(?:\[cs\]|c|s)e\b", _OPTIONAL.sub("", pattern)) is not None


def rules() -> list[Rule]:
    """All rules, by priority: denials and other meanings, tags, texts, grants, names; base phrases last."""
    out: list[tuple] = [(keyword, False, p, 0, None, 0.0, False) for keyword, p in OTHER]
    for label, keyword, name, tag in _names():
        sure = _surely_licence(name)
        out.append((keyword, sure, DENIAL + name, 0, None, 0.0, False))
        if tag:
            out.append(("spdx", True, f"spdx license identifier {tag}", 1, label, 1.0, False))
        out.append((keyword, sure, GRANT + name, 3, label, 0.95, False))
        out.append((keyword, sure, name, 4, label, 0.8, False))
    out += [(keyword, False, p, 2, label, score, False) for label, keyword, p, score in TEXTS]
    out += [("license", True, p, 5, label, BASE_SCORE, True) for p, label in BASE.items()]
    out.sort(key=lambda r: r[3])
    return [Rule(i, *r) for i, r in enumerate(out)]


def spaced(pattern: str) -> str:
    """The expression over texts in which every word has a blank of its own on either side."""
    return " " + pattern.replace(" ", "  ") + " "
