"""The ordered signature rules of the licence scan: names and forms written by hand, combined by version."""

from __future__ import annotations

import re
from dataclasses import dataclass

GAP = r"[\s,;:.()\"'*/#-]+"

# Phrases of the base scan, their words and labels.
BASE = {
    ("gnu", "general", "public", "license"): "gpl",
    ("apache", "license"): "apache",
    ("cc", "by"): "cc-by",
    ("mit", "license"): "mit",
}

# Label, a word that every notice holds, the name in running text, and the versions in use.
FAMILIES = [
    ("gpl", "gnu", "gnu general public licen[cs]e", ["1", "2", "3"]),
    ("lgpl", "gnu", "gnu (?:lesser|library) general public licen[cs]e", ["2", "2.1", "3"]),
    ("agpl", "gnu", "gnu affero general public licen[cs]e", ["3"]),
    ("gfdl", "gnu", "gnu free documentation licen[cs]e", ["1.1", "1.2", "1.3"]),
    ("gpl", "gpl", "(?:gnu )?gpl", ["1", "2", "3"]),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", ["2", "2.1", "3"]),
    ("agpl", "agpl", "(?:gnu )?agpl", ["3"]),
    ("apache", "apache", "apache (?:software )?licen[cs]e", ["1", "1.1", "2"]),
    ("mpl", "mozilla", "mozilla public licen[cs]e", ["1", "1.1", "2"]),
    ("epl", "eclipse", "eclipse public licen[cs]e", ["1", "2"]),
    ("edl", "eclipse", "eclipse distribution licen[cs]e", ["1"]),
    ("cddl", "distribution", "common development and distribution licen[cs]e", ["1", "1.1"]),
    ("cpl", "common", "common public licen[cs]e", ["1"]),
    ("eupl", "european", "european union public licen[cs]e", ["1", "1.1", "1.2"]),
    ("artistic", "artistic", "(?:the )?(?:clarified )?artistic licen[cs]e", ["1", "2"]),
    ("afl", "academic", "academic free licen[cs]e", ["2.1", "3"]),
    ("osl", "open", "open software licen[cs]e", ["1", "2", "3"]),
    ("ofl", "font", "sil open font licen[cs]e", ["1", "1.1"]),
    ("bsl", "boost", "boost software licen[cs]e", ["1"]),
    ("busl", "business", "business source licen[cs]e", ["1.1"]),
    ("php", "php", "php licen[cs]e", ["3", "3.01"]),
    ("psf", "python", "python(?: software foundation)? licen[cs]e", ["2"]),
    ("ruby", "ruby", "ruby licen[cs]e", []),
    ("zpl", "zope", "zope public licen[cs]e", ["2", "2.1"]),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e", []),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[cs]e", []),
    ("odbl", "database", "open (?:data commons )?(?:open )?database licen[cs]e", ["1"]),
    ("odc-by", "commons", "open data commons attribution licen[cs]e", ["1"]),
    ("pddl", "domain", "public domain dedication and licen[cs]e", ["1"]),
    ("cc0", "cc0", "cc0", ["1"]),
    ("unlicense", "unlicense", "(?:the )?unlicense", []),
    ("wtfpl", "wtfpl", "wtfpl", ["2"]),
    ("mit", "mit", "(?:the )?mit(?:/x11| expat)? licen[cs]e", []),
    ("isc", "isc", "(?:the )?isc licen[cs]e", []),
    ("zlib", "zlib", "(?:the )?zlib(?:/libpng)? licen[cs]e", []),
    ("bsd-2-clause", "bsd", "(?:(?:simplified|freebsd|2-clause|two-clause) bsd licen[cs]e|bsd 2-clause)", []),
    ("bsd-3-clause", "bsd", "(?:(?:new|modified|revised|3-clause|three-clause) bsd licen[cs]e|bsd 3-clause)", []),
    ("bsd-4-clause", "bsd", "(?:(?:original|4-clause|four-clause) bsd licen[cs]e|bsd 4-clause)", []),
    ("bsd", "bsd", "(?:the )?bsd licen[cs]e", []),
    ("openssl", "openssl", "openssl licen[cs]e", []),
    ("ncsa", "ncsa", "(?:university of illinois/)?ncsa (?:open source )?licen[cs]e", []),
    ("upl", "universal", "universal permissive licen[cs]e", ["1"]),
    ("json", "json", "json licen[cs]e", []),
    ("vim", "vim", "vim licen[cs]e", []),
    ("postgresql", "postgresql", "postgresql licen[cs]e", []),
]

# The elements of the attribution licences and the versions in use.
ATTRIBUTION = {
    "cc-by": "attribution",
    "cc-by-sa": "attribution[ -]share ?alike",
    "cc-by-nd": "attribution[ -]no ?deriv(?:ative)?s?",
    "cc-by-nc": "attribution[ -]non ?commercial",
    "cc-by-nc-sa": "attribution[ -]non ?commercial[ -]share ?alike",
    "cc-by-nc-nd": "attribution[ -]non ?commercial[ -]no ?deriv(?:ative)?s?",
}
ATTRIBUTION_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

# Sentences of licence texts and notices, with the word that gates them.
SENTENCES = [
    ("mit", "hereby", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("isc", "permission", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such"),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    ("wtfpl", "fuck", r"do what the fuck you want to public licen[cs]e"),
    ("gpl", "redistribute", r"you can redistribute it and/or modify it under the terms of the gnu general public"),
    ("apache", "apache", r"licensed to the apache software foundation"),
    ("mpl", "mozilla", r"this source code form is subject to the terms of the mozilla public"),
    ("public-domain", "domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
    ("proprietary", "reserved", r"all rights reserved"),
    ("proprietary", "confidential", r"proprietary and confidential"),
    ("copyright", "copyright", r"copyright (?:\(c\)|©)? ?(?:19|20)\d\d"),
]


@dataclass(frozen=True)
class Rule:
    """A rule runs on texts that hold its keyword, which every match of the rule holds as well. Of overlapping detections the higher priority counts."""

    name: str
    label: str
    keyword: str
    priority: int
    confidence: float
    pattern: re.Pattern


def _blank(name: str) -> str:
    """A name as a pattern whose words may be parted by any white space."""
    return name.replace(" ", r"\s+")


def _version(version: str) -> str:
    body = re.escape(version) + (r"(?:\.0)?" if "." not in version else "")
    return rf"(?:{GAP}|\s*)(?:v\.?|ver\.?|version)?\s*{body}(?![\d.]*\d)"


def build() -> list[Rule]:
    """All rules, in order of priority: exact tags first, then versioned names in a grant, versioned names,
    names in a grant, names alone, sentences."""
    found: list[tuple] = []
    grant = r"(?:licen[cs]ed|released|distributed|available|published)\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?"
    for label, keyword, name, versions in FAMILIES:
        body = _blank(name)
        for version in versions:
            full = f"{label}-{version if '.' in version else version + '.0'}"
            tag = re.escape(label) + "-" + re.escape(version) + r"(?:\.0)?(?:-only|-or-later|\+)?"
            found.append((1, 1.0, full, "spdx", rf"spdx-license-identifier:\s*{tag}(?![\w.])"))
            found.append((2, 0.98, full, keyword, grant + body + _version(version)))
            found.append((3, 0.95, full, keyword, rf"(?<!\w){body}{_version(version)}"))
        found.append((1, 1.0, label, "spdx", rf"spdx-license-identifier:\s*{re.escape(label)}(?![\w.-])"))
        found.append((4, 0.9, label, keyword, grant + body + r"(?!\w)"))
        found.append((5, 0.7, label, keyword, rf"(?<!\w){body}(?!\w)"))
    for label, name in ATTRIBUTION.items():
        short = label.replace("-", "[ -]")
        for version in ATTRIBUTION_VERSIONS:
            full, at = f"{label}-{version}", re.escape(version)
            found.append((1, 1.0, full, "spdx", rf"spdx-license-identifier:\s*{re.escape(label)}-{at}(?![\w.])"))
            found.append((2, 0.98, full, "creativecommons", rf"creativecommons\.org/licenses/{label[3:]}/{at}"))
            found.append((3, 0.95, full, "cc", rf"(?<!\w){short}[ -]?v?{at}(?![\d.]*\d)"))
            found.append((3, 0.95, full, "creative", rf"creative\s+commons\s+{_blank(name)}\s+(?:\w+\s+)?{at}(?![\d.]*\d)"))
        found.append((4, 0.9, label, "creative", rf"creative\s+commons\s+{_blank(name)}(?![ -]?\w*(?:share|deriv|comm))"))
        found.append((5, 0.7, label, "cc", rf"(?<!\w){short}(?![\w-])"))
    for label, keyword, sentence in SENTENCES:
        found.append((6, 0.6, label, keyword, _blank(sentence)))
    rules = []
    for k, (priority, confidence, label, keyword, pattern) in enumerate(sorted(found, key=lambda f: f[0])):
        rules.append(Rule(f"r{k:03d}-{label}", label, keyword, priority, confidence, re.compile(pattern)))
    return rules
