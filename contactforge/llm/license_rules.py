"""The ordered signature rules of the license scan.

A rule is a line ``label | priority | weight | pattern``. Patterns are regular expressions over a text's words, lower
case, one space between them; ``@`` stands before the rule's keyword (``@(a|b)`` gives two). A rule runs only around
places where its keyword stands, within ``REACH`` words on either side. Later lines give way to earlier ones that are
otherwise equal. Priorities: 4 a machine-readable tag, 3 a statement or notice, 2 a name, 1 a hint.

The syntax is what the regular expressions of Java and RE2 share.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

#: Words before and after a keyword that a rule may look at; every pattern below is shorter.
REACH = 24

#: The base phrases and their labels; they lead the order.
BASE = """
cc-by | 1 | 0.5 | @cc by
gpl | 1 | 0.6 | general public @license
reserved | 1 | 0.4 | all rights @reserved
"""

#: Written by hand, one signature a line.
WRITTEN = """
mit | 3 | 0.95 | permission is hereby @granted free of charge to any person obtaining a copy of this software
mit | 3 | 0.9 | (released|licensed|distributed|available|published|provided) under (the )?(terms of )?(the )?mit @license
mit | 3 | 0.85 | the above @copyright notice and this permission notice shall be included in all copies
mit | 2 | 0.8 | (the )?mit @(license|licence)
mit | 2 | 0.7 | @licensed under (the )?mit
mit | 2 | 0.8 | (expat|x11) @license
mit-0 | 3 | 0.9 | mit no attribution @license
apache-2.0 | 3 | 0.95 | @licensed under the apache license version 2 0
apache-2.0 | 3 | 0.95 | you may not use this file except in compliance with the @license
apache-2.0 | 3 | 0.9 | apache @license (version |v)?2( 0)?
apache-2.0 | 3 | 0.9 | apache org @licenses license 2 0
apache-2.0 | 2 | 0.7 | @apache 2( 0)?( license)?
apache-1.1 | 3 | 0.9 | apache (software )?@license (version |v)?1 1
apache-1.0 | 3 | 0.9 | apache (software )?@license (version |v)?1 0
apache | 2 | 0.7 | apache (software )?@license
bsd-3-clause | 3 | 0.95 | neither the name of (the )?[^ ]+( [^ ]+){0,4} nor the names of its contributors may be used to @endorse
bsd-3-clause | 3 | 0.9 | bsd 3 clause @license
bsd-3-clause | 3 | 0.9 | 3 clause bsd @license
bsd-3-clause | 2 | 0.8 | (new|modified|revised) bsd @license
bsd-2-clause | 3 | 0.9 | bsd 2 clause @license
bsd-2-clause | 3 | 0.9 | 2 clause bsd @license
bsd-2-clause | 2 | 0.8 | (simplified|freebsd) (bsd )?@license
bsd-4-clause | 3 | 0.9 | all advertising materials mentioning features or use of this software must display the following @acknowledgement
bsd-4-clause | 2 | 0.8 | original bsd @license
bsd | 3 | 0.8 | @redistribution and use in source and binary forms with or without modification are permitted
bsd | 3 | 0.7 | redistributions of source code must retain the above @copyright notice
bsd | 2 | 0.7 | bsd (style )?@license
0bsd | 2 | 0.8 | zero clause bsd @license
isc | 3 | 0.95 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby @granted
isc | 2 | 0.8 | isc @license
zlib | 3 | 0.9 | this software is provided as is without any express or implied @warranty in no event
zlib | 2 | 0.8 | zlib( libpng)? @license
boost-1.0 | 3 | 0.9 | boost software @license( version)? 1 0
boost | 2 | 0.7 | boost (software )?@license
unlicense | 3 | 0.95 | this is free and unencumbered software released into the public @domain
unlicense | 2 | 0.8 | the @unlicense
wtfpl | 3 | 0.9 | do what the fuck you want to public @license
wtfpl | 2 | 0.8 | @wtfpl
cc0-1.0 | 3 | 0.9 | cc0 1 0( universal)?( public)?( domain)? @dedication
cc0-1.0 | 3 | 0.9 | @creativecommons org publicdomain zero 1 0
cc0-1.0 | 2 | 0.8 | @cc0( 1 0)?
public-domain | 3 | 0.8 | (released|dedicated|placed) (in|into|to) the public @domain
public-domain | 2 | 0.6 | public @domain
public-domain-mark | 3 | 0.8 | @creativecommons org publicdomain mark 1 0
creative-commons | 2 | 0.6 | creative @commons( license)?
creative-commons | 1 | 0.5 | creativecommons org @licenses
cc-by | 2 | 0.7 | creative commons @attribution
mpl-2.0 | 3 | 0.95 | this source code form is subject to the terms of the mozilla public @license v 2 0
mpl-2.0 | 3 | 0.9 | mozilla public @license (version |v )?2( 0)?
mpl-1.1 | 3 | 0.9 | mozilla public @license (version |v )?1 1
mpl | 2 | 0.7 | mozilla public @license
mpl | 1 | 0.5 | @mpl( 2 0)?
epl-2.0 | 3 | 0.9 | eclipse public @license (version |v )?2( 0)?
epl-1.0 | 3 | 0.9 | eclipse public @license (version |v )?1( 0)?
epl | 2 | 0.7 | eclipse public @license
eupl | 2 | 0.8 | european union public @(license|licence)
cddl | 2 | 0.8 | common development and distribution @license
cpl-1.0 | 2 | 0.8 | common public @license
osl-3.0 | 3 | 0.9 | open software @license (version )?3 0
afl-3.0 | 3 | 0.9 | academic free @license (version )?3 0
artistic-2.0 | 3 | 0.9 | artistic @license (version )?2 0
artistic | 2 | 0.7 | artistic @license
python-2.0 | 2 | 0.8 | python (software foundation )?@license( version 2)?
php-3.01 | 3 | 0.9 | php @license version 3 01
php | 2 | 0.7 | php @license
postgresql | 2 | 0.8 | postgresql @license
ruby | 2 | 0.7 | ruby @license
openssl | 2 | 0.8 | openssl @license
w3c | 2 | 0.8 | w3c software (notice and )?@license
ofl-1.1 | 3 | 0.9 | sil open font @license( version)? 1 1
ofl | 2 | 0.7 | (sil )?open font @license
odbl-1.0 | 3 | 0.9 | open database @license
odc-by | 2 | 0.8 | open data commons attribution @license
pddl | 2 | 0.8 | open data commons public domain dedication and @license
gfdl | 3 | 0.9 | gnu free documentation @license
gpl-2.0 | 3 | 0.9 | @gplv2
gpl-3.0 | 3 | 0.9 | @gplv3
gpl-2.0-or-later | 3 | 0.95 | either version 2 of the @license or at your option any later version
gpl-3.0-or-later | 3 | 0.95 | either version 3 of the @license or at your option any later version
gpl | 2 | 0.7 | gnu general public @license
gpl | 2 | 0.7 | gnu @gpl
gpl | 1 | 0.5 | @gpl
lgpl | 2 | 0.8 | (gnu )?(lesser|library) general public @license
lgpl | 1 | 0.6 | @lgpl
agpl | 2 | 0.8 | (gnu )?affero general public @license
agpl | 1 | 0.6 | @agpl
sspl | 2 | 0.8 | server side public @license
bsl-1.1 | 2 | 0.8 | business source @license( 1 1)?
elastic-2.0 | 2 | 0.8 | elastic @license 2 0
polyform | 2 | 0.7 | polyform [a-z]+ @license
commons-clause | 2 | 0.7 | commons clause @license
ms-pl | 2 | 0.8 | microsoft public @license
ms-rl | 2 | 0.8 | microsoft reciprocal @license
unicode | 2 | 0.8 | unicode @license
openrail | 2 | 0.8 | (creativeml )?open ?rail( m)? @license
llama | 2 | 0.7 | llama [0-9]+( [0-9]+)? community @license
gemma | 2 | 0.6 | @gemma terms of use
proprietary | 3 | 0.8 | proprietary and @confidential
proprietary | 2 | 0.6 | @proprietary (license|licence|software)
proprietary | 3 | 0.7 | unauthorized (copying|reproduction|use|distribution)( [^ ]+){0,8} (is )?strictly @prohibited
proprietary | 3 | 0.7 | may not be (reproduced|copied|distributed)( [^ ]+){0,8} without( [^ ]+){0,4} (written )?@permission
proprietary | 2 | 0.7 | end user @license agreement
proprietary | 1 | 0.5 | @eula
reserved | 2 | 0.6 | no rights @reserved
reserved | 2 | 0.6 | some rights @reserved
reserved | 2 | 0.6 | alle rechte @vorbehalten
reserved | 2 | 0.6 | todos los derechos @reservados
reserved | 2 | 0.6 | todos os direitos @reservados
reserved | 2 | 0.6 | tous droits @réservés
reserved | 2 | 0.6 | tutti i diritti @riservati
reserved | 2 | 0.5 | alle rechten @voorbehouden
copyright | 2 | 0.5 | @copyright (c )?(19|20)[0-9][0-9]( (19|20)[0-9][0-9])?
copyright | 2 | 0.5 | (c|copr) @copyright (19|20)[0-9][0-9]
copyright | 1 | 0.3 | @copyright (c|by|notice|holders?)
copyright | 1 | 0.3 | @copyrighted (by|material|works?)
licence-text | 1 | 0.3 | @licensed under
licence-text | 1 | 0.3 | (released|distributed|available|published) under( [^ ]+){1,4} @(license|licence)
licence-text | 1 | 0.3 | @licencia (mit|apache|gpl|bsd)
licence-text | 1 | 0.3 | @lizenziert unter
"""

#: Identifiers of machine-readable tags, as they are written.
TAGS = """
MIT MIT-0 Apache-1.1 Apache-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause 0BSD ISC Zlib BSL-1.0 Unlicense WTFPL CC0-1.0
GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later
LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2
CDDL-1.0 Artistic-2.0 AFL-3.0 OSL-3.0 PostgreSQL OFL-1.1 ODbL-1.0 Python-2.0 PHP-3.01 Unicode-3.0
""".split()

COMMONS = {"by": "attribution", "by sa": "attribution share ?alike", "by nc": "attribution non ?commercial", "by nd": "attribution no ?deriv(ative)?s",
           "by nc sa": "attribution non ?commercial share ?alike", "by nc nd": "attribution non ?commercial no ?deriv(ative)?s"}
COMMONS_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
GNU = {"gpl": ("general public", ["1.0", "2.0", "3.0"]), "lgpl": ("(lesser|library) general public", ["2.0", "2.1", "3.0"]), "agpl": ("affero general public", ["1.0", "3.0"])}


def built() -> list[str]:
    """The families: tags, Creative Commons by kind and version, GNU by kind and version; narrower ones first."""
    lines = []
    for tag in sorted(TAGS, key=lambda t: (-len(t), t)):
        lines.append(f"{tag.lower()} | 4 | 0.99 | spdx license @identifier {re.sub('[-.]', ' ', tag.lower())}")
    for kind, name in sorted(COMMONS.items(), key=lambda x: (-len(x[0]), x[0])):
        label = f"cc-{kind.replace(' ', '-')}"
        for version in COMMONS_VERSIONS:
            number = version.replace(".", " ")
            lines.append(f"{label}-{version} | 3 | 0.9 | @cc {kind} {number}")
            lines.append(f"{label}-{version} | 3 | 0.9 | creative commons @attribution{name.removeprefix('attribution')} {number}")
            lines.append(f"{label}-{version} | 4 | 0.95 | creativecommons org @licenses {kind} {number}")
        lines.append(f"{label} | 2 | 0.7 | @cc {kind}")
        lines.append(f"{label} | 2 | 0.7 | creative commons @attribution{name.removeprefix('attribution')}")
    for label, (name, versions) in GNU.items():
        for version in versions:
            number = version.removesuffix(".0").replace(".", " ")
            exact = f"{number}( 0)?" if version.endswith(".0") else number
            lines.append(f"{label}-{version} | 3 | 0.9 | (gnu )?{name} @license( as published by the free software foundation)?( either)?( version| v)? {exact}")
            lines.append(f"{label}-{version} | 3 | 0.9 | @{label} (version |v )?{exact}")
            lines.append(f"{label}-{version} | 3 | 0.85 | version {exact} of the (gnu )?{name} @license")
    return lines


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    priority: int
    weight: float
    keywords: tuple[str, ...]
    need: str  # a word that stands in every match besides the keyword; empty if there is none
    pattern: str  # over a window in which MARK stands before the keyword
    base: bool


MARK = "\x01"


def parsed(line: str, order: int, base: bool) -> Rule:
    label, priority, weight, pattern = (x.strip() for x in line.split(" | "))
    word = re.search(r"@(\(([^)]*)\)|[^ ()]+)", pattern)
    keywords = tuple((word[2] or word[1]).split("|"))
    flat = pattern[: word.start()] + " " + pattern[word.end() :]
    while re.search(r"\([^()]*\)(\?|\{[^}]*\})?", flat):  # words inside brackets need not be there
        flat = re.sub(r"[^ ]*\([^()]*\)(\?|\{[^}]*\})?[^ ]*", " ", flat)
    plain = [w for w in flat.split() if re.fullmatch(r"\w+", w)]
    return Rule(order, label, int(priority), float(weight), keywords, max(plain, key=len, default=""), f" {pattern.replace('@', MARK)} ", base)


def rules() -> list[Rule]:
    """All rules in their order, base phrases first."""
    base = BASE.strip().splitlines()
    return [parsed(line, i, i < len(base)) for i, line in enumerate(base + WRITTEN.strip().splitlines() + built())]
