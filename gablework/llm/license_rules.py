"""Signature rules for licences, in order of priority.

A text is matched in normal form: lower case, words separated by one blank, so a rule is
written with plain blanks. Rules are the product of a table of licences and a table of
ways to mention one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str  # Java regular expression over the normal form, from word to word
    gate: str  # a literal every match contains
    priority: int  # higher wins over what it covers
    confidence: float


# Label, name as a pattern, a literal in it, further names that stand on their own (else "").
LICENCES = (
    ("apache-2.0", r"apache (?:software )?licen[sc]e(?: version)?(?: 2(?: 0)?)", "apache", "asl 2 0"),
    ("apache-1.1", r"apache (?:software )?licen[sc]e(?: version)? 1 1", "apache", ""),
    ("apache-1.0", r"apache (?:software )?licen[sc]e(?: version)? 1 0", "apache", ""),
    ("apache", r"apache (?:software )?licen[sc]e", "apache", ""),
    ("mit", r"(?:mit|x11|expat)(?: x11)? licen[sc]e", "licen", ""),
    ("mit-0", r"mit no attribution(?: licen[sc]e)?", "no attribution", ""),
    ("isc", r"isc licen[sc]e", "isc licen", ""),
    ("bsd-3-clause", r"(?:3|three) clause bsd(?: licen[sc]e)?|bsd 3 clause(?: licen[sc]e)?|(?:new|modified|revised) bsd licen[sc]e", "bsd", ""),
    ("bsd-2-clause", r"(?:2|two) clause bsd(?: licen[sc]e)?|bsd 2 clause(?: licen[sc]e)?|(?:simplified|freebsd) bsd? ?licen[sc]e", "bsd", ""),
    ("bsd-4-clause", r"(?:4|four) clause bsd(?: licen[sc]e)?|bsd 4 clause(?: licen[sc]e)?|original bsd licen[sc]e", "bsd", ""),
    ("0bsd", r"zero clause bsd(?: licen[sc]e)?|0bsd", "bsd", ""),
    ("bsd", r"bsd(?: style)? licen[sc]e", "bsd", ""),
    ("agpl-3.0", r"(?:gnu )?affero general public licen[sc]e(?: agpl)?(?: version| v)? ?3(?: 0)?", "affero", "agpl ?v?3(?: 0)?"),
    ("agpl-1.0", r"affero general public licen[sc]e(?: version| v)? 1(?: 0)?", "affero", ""),
    ("agpl", r"(?:gnu )?affero general public licen[sc]e", "affero", "agpl"),
    ("lgpl-3.0", r"(?:gnu )?lesser general public licen[sc]e(?: lgpl)?(?: version| v)? ?3(?: 0)?", "lesser general", "lgpl ?v?3(?: 0)?"),
    ("lgpl-2.1", r"(?:gnu )?lesser general public licen[sc]e(?: lgpl)?(?: version| v)? ?2 1", "lesser general", "lgpl ?v?2 1"),
    ("lgpl-2.0", r"(?:gnu )?library general public licen[sc]e(?: version| v)? ?2(?: 0)?", "library general", "lgpl ?v?2 0"),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", "general public", "lgpl"),
    ("gpl-3.0", r"(?:gnu )?general public licen[sc]e(?: gpl)?(?: version| v)? ?3(?: 0)?", "general public", "gpl ?v?3(?: 0)?"),
    ("gpl-2.0", r"(?:gnu )?general public licen[sc]e(?: gpl)?(?: version| v)? ?2(?: 0)?", "general public", "gpl ?v?2(?: 0)?"),
    ("gpl-1.0", r"(?:gnu )?general public licen[sc]e(?: gpl)?(?: version| v)? ?1(?: 0)?", "general public", "gpl ?v?1(?: 0)?"),
    ("gpl", r"gnu general public licen[sc]e|gnu public licen[sc]e|gnu gpl", "gnu", ""),
    ("gfdl-1.3", r"gnu free documentation licen[sc]e(?: version)? 1 3", "free documentation", "gfdl 1 3"),
    ("gfdl-1.2", r"gnu free documentation licen[sc]e(?: version)? 1 2", "free documentation", "gfdl 1 2"),
    ("gfdl", r"gnu free documentation licen[sc]e", "free documentation", "gfdl"),
    ("mpl-2.0", r"mozilla public licen[sc]e(?: version| v)? ?2(?: 0)?", "mozilla public", "mpl 2 0"),
    ("mpl-1.1", r"mozilla public licen[sc]e(?: version| v)? ?1 1", "mozilla public", "mpl 1 1"),
    ("mpl", r"mozilla public licen[sc]e", "mozilla public", ""),
    ("epl-2.0", r"eclipse public licen[sc]e(?: version| v)? ?2(?: 0)?", "eclipse public", "epl 2 0"),
    ("epl-1.0", r"eclipse public licen[sc]e(?: version| v)? ?1(?: 0)?", "eclipse public", "epl 1 0"),
    ("epl", r"eclipse public licen[sc]e", "eclipse public", ""),
    ("cddl-1.0", r"common development and distribution licen[sc]e", "common development", "cddl(?: 1 0)?"),
    ("cpl-1.0", r"common public licen[sc]e", "common public", ""),
    ("eupl-1.2", r"european union public licen[sc]e", "european union public", "eupl(?: v?1 2)?"),
    ("ms-pl", r"microsoft public licen[sc]e", "microsoft public", ""),
    ("ms-rl", r"microsoft reciprocal licen[sc]e", "microsoft reciprocal", ""),
    ("artistic-2.0", r"artistic licen[sc]e 2 0", "artistic", ""),
    ("artistic-1.0", r"artistic licen[sc]e", "artistic", ""),
    ("python-2.0", r"python software foundation licen[sc]e|psf licen[sc]e", "licen", ""),
    ("php-3.01", r"php licen[sc]e", "php licen", ""),
    ("zlib", r"zlib(?: libpng)? licen[sc]e", "zlib", ""),
    ("bsl-1.0", r"boost software licen[sc]e", "boost software", ""),
    ("busl-1.1", r"business source licen[sc]e", "business source", ""),
    ("unlicense", r"the unlicen[sc]e", "unlicen", ""),
    ("wtfpl", r"do what the \S+ you want to public licen[sc]e", "you want to public", "wtfpl"),
    ("ofl-1.1", r"sil open font licen[sc]e|open font licen[sc]e", "open font", ""),
    ("odbl-1.0", r"open database licen[sc]e", "open database", "odbl"),
    ("odc-by-1.0", r"open data commons attribution licen[sc]e", "open data commons", ""),
    ("pddl-1.0", r"public domain dedication and licen[sc]e", "public domain dedication", "pddl"),
    ("ncsa", r"university of illinois(?: ncsa)? open source licen[sc]e", "illinois", ""),
    ("openssl", r"openssl licen[sc]e", "openssl", ""),
    ("upl-1.0", r"universal permissive licen[sc]e", "universal permissive", ""),
    ("afl-3.0", r"academic free licen[sc]e", "academic free", ""),
    ("osl-3.0", r"open software licen[sc]e", "open software", ""),
    ("postgresql", r"postgresql licen[sc]e", "postgresql", ""),
    ("w3c", r"w3c software(?: notice)?(?: and)? licen[sc]e", "w3c software", ""),
    ("ruby", r"ruby licen[sc]e", "ruby licen", ""),
    ("vim", r"vim licen[sc]e", "vim licen", ""),
    ("cecill-2.1", r"cecill(?: free software)?(?: licen[sc]e)?(?: agreement)?", "cecill", ""),
    ("sspl-1.0", r"server side public licen[sc]e", "server side public", "sspl"),
    ("elastic-2.0", r"elastic licen[sc]e", "elastic licen", ""),
)

# Ways to mention a licence: name, prefix, suffix, priority above the bare name, confidence.
MENTIONS = (
    ("grant", r"(?:re)?(?:licen[sc]ed|distributed|released|published|available|offered|provided) under (?:the )?(?:terms of )?(?:the )?", "", 30, 1.0),
    ("subject", r"(?:subject to|governed by|covered by|in accordance with|compliance with) (?:the )?(?:terms of )?(?:the )?", "", 20, 0.95),
    ("header", r"licen[sc]e(?: is)? (?:the )?", "", 15, 0.85),
    ("name", "", "", 0, 0.7),
)

# Element sets of the public deeds, most specific first, and versions in use.
CC_ELEMENTS = (
    ("cc-by-nc-sa", r"by nc sa|attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", r"by nc nd|attribution non ?commercial no ?deriv(?:ative)?s?"),
    ("cc-by-nc", r"by nc|attribution non ?commercial"),
    ("cc-by-sa", r"by sa|attribution share ?alike"),
    ("cc-by-nd", r"by nd|attribution no ?deriv(?:ative)?s?"),
    ("cc-by", r"by|attribution"),
)
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0", "")

# Notices that are no named licence.
NOTICES = (
    ("cc0-1.0", r"cc0(?: 1 0)?", "cc0", 60, 0.95),
    ("cc0-1.0", r"(?:cc|creative commons) zero", " zero", 60, 0.95),
    ("reserved", r"all rights reserved", "rights reserved", 50, 1.0),
    ("reserved", r"some rights reserved", "rights reserved", 50, 0.8),
    ("public-domain", r"(?:in|into|to) the public domain", "public domain", 50, 0.9),
    ("public-domain", r"(?:dedicated to|released into) the public domain", "public domain", 55, 0.95),
    ("public-domain", r"no copyright", "no copyright", 55, 0.8),
    ("copyright", r"copyright (?:c )?(?:19|20)\d\d", "copyright", 10, 0.6),
    ("copyright", r"copyright (?:c )?by", "copyright", 10, 0.5),
    ("proprietary", r"proprietary and confidential", "proprietary and", 50, 0.9),
    ("proprietary", r"no part of this (?:publication|work|document) may be reproduced", "may be reproduced", 50, 0.9),
    ("proprietary", r"unauthori[sz]ed (?:copying|use|reproduction|distribution)", "unauthori", 40, 0.7),
)


def spdx_words(label: str) -> str:
    """A label as its words stand in normal form: ``apache-2.0`` is ``apache 2 0``."""
    return label.replace("-", " ").replace(".", " ")


def build_rules() -> tuple[Rule, ...]:
    rules: list[Rule] = []
    for label, name, gate, short in LICENCES:
        for _, prefix, suffix, above, confidence in MENTIONS:
            rules.append(Rule(label, f"{prefix}(?:{name}){suffix}", gate, 100 + above, confidence))
        rules.append(Rule(label, f"spdx licen[sc]e identifier {spdx_words(label)}(?: only| or later)?", "spdx", 150, 1.0))
        if short:
            word = re.match("[a-z]+", short).group()
            rules.append(Rule(label, f"(?:under|licen[sc]e|licen[sc]ed|the) (?:the )?(?:{short})", word, 90, 0.6))
    for elements, pattern in CC_ELEMENTS:
        for version in CC_VERSIONS:
            label = f"{elements}-{version}" if version else elements
            tail = f" {spdx_words(version)}" if version else ""
            for family, gate in (("cc", "cc by"), ("creative commons", "creative commons")):
                named = f"{family} (?:{pattern})(?: licen[sc]e)?(?: version| v)?{tail}(?: international| unported| generic)?"
                rules.append(Rule(label, named, gate, 110, 0.8))
                rules.append(Rule(label, f"licen[sc]ed under (?:a |the )?{named}", gate, 140, 1.0))
            rules.append(Rule(label, f"creativecommons org licenses {elements[3:].replace('-', ' ')}{tail}", "creativecommons", 145, 1.0))
    rules += [Rule(label, pattern, gate, 100 + above, confidence) for label, pattern, gate, above, confidence in NOTICES]
    return tuple(rules)


RULES = build_rules()

# Every text with a match contains one of these once lowered; a first, cheaper filter.
LITERALS = (
    "licens", "licenc", "copyright", "reserved", "domain", "cc", "creative", "gpl", "bsd", "attribution",
    "asl", "gfdl", "mpl", "epl", "cddl", "eupl", "wtfpl", "odbl", "pddl", "sspl", "cecill",
    "proprietary", "reproduced", "unauthori",
)

# Every match of every rule contains one of these, whatever stands between words; tested.
PREFILTER = (
    r"licen[sc]e", r"licen[sc]ed", r"copyright", r"rights[SEP]reserved", r"public[SEP]domain", r"cc[SEP]by", r"cc0", r"creative[SEP]commons", r"creativecommons", r"cc[SEP]zero",
    r"gpl", r"bsd", r"mit[SEP]no[SEP]attribution", r"(?:under|the)[SEP](?:the[SEP])?(?:asl|gfdl|mpl|epl|cddl|eupl|wtfpl|odbl|pddl|sspl)", r"cecill",
    r"proprietary[SEP]and", r"be[SEP]reproduced", r"unauthori[sz]ed",
)
