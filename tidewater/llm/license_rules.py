"""Signature rules of the licence scan, as text.

A rule is (id, label, priority, score, keyword, pattern).  The keyword is a
literal without which the pattern cannot match, in the text's lower case with
runs of white space and hyphens as one blank; patterns are read without regard
to ASCII case, and a blank in them is any white space.  Priorities, highest
first: 5 a machine-readable tag, 4 the words of a grant or a licence text, 3 an
address, 2 "licensed under" a name, 1 a bare name.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    id: str
    label: str
    priority: int
    score: float
    keyword: str
    pattern: str


#: label | keyword | name pattern | address pattern
_LICENCES = r"""
mit | mit | (?:the )?mit(?: |/x11 |-style )?licen[cs]e | opensource\.org/licenses/mit\b
mit-0 | mit | mit(?: no attribution|-0) licen[cs]e | opensource\.org/licenses/mit-0
isc | isc | isc licen[cs]e | opensource\.org/licenses/isc
x11 | x11 | x11 licen[cs]e | spdx\.org/licenses/x11
apache-1.1 | apache | apache(?: software)? licen[cs]e,? (?:version )?1\.1 | apache\.org/licenses/license-1\.1
apache-2.0 | apache | apache(?: software)? licen[cs]e,? (?:version |v ?)?2(?:\.0)? | apache\.org/licenses/license-2\.0
apache | apache | apache(?: software)? licen[cs]e | apache\.org/licenses/?(?![a-z])
bsd-1-clause | bsd | (?:bsd[- ]1[- ]clause|one[- ]clause bsd) | opensource\.org/licenses/bsd-1-clause
bsd-2-clause | bsd | (?:bsd[- ]2[- ]clause|two[- ]clause bsd|simplified bsd|freebsd licen[cs]e) | opensource\.org/licenses/bsd-2-clause
bsd-3-clause | bsd | (?:bsd[- ]3[- ]clause|three[- ]clause bsd|new bsd|modified bsd|revised bsd) | opensource\.org/licenses/bsd-3-clause
bsd-4-clause | bsd | (?:bsd[- ]4[- ]clause|four[- ]clause bsd|original bsd) | spdx\.org/licenses/bsd-4-clause
bsd-0-clause | bsd | (?:bsd zero[- ]clause|zero[- ]clause bsd|0bsd) | opensource\.org/licenses/0bsd
bsd | bsd | bsd(?:-style)? licen[cs]e | opensource\.org/licenses/bsd-license
gpl-1.0 | general public | (?:gnu )?general public licen[cs]e,? (?:version |v)1(?:\.0)? | gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0
gpl-2.0 | general public | (?:gnu )?general public licen[cs]e,? (?:version |v)2(?:\.0)? | gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0
gpl-3.0 | general public | (?:gnu )?general public licen[cs]e,? (?:version |v)3(?:\.0)? | gnu\.org/licenses/gpl-3\.0
gpl-2.0-short | gpl | \bgpl(?:[- ]?v?|,? version )2(?:\.0)?\b | gnu\.org/licenses/gpl-?2
gpl-3.0-short | gpl | \bgpl(?:[- ]?v?|,? version )3(?:\.0)?\b | gnu\.org/licenses/gpl-?3
gpl | general public | (?:gnu )?general public licen[cs]e | gnu\.org/(?:copyleft|licenses)/gpl\.
lgpl-2.0 | library general public | (?:gnu )?library general public licen[cs]e,? (?:version |v)2(?:\.0)? | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.0
lgpl-2.1 | lesser general public | (?:gnu )?lesser general public licen[cs]e,? (?:version |v)2\.1 | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1
lgpl-3.0 | lesser general public | (?:gnu )?lesser general public licen[cs]e,? (?:version |v)3(?:\.0)? | gnu\.org/licenses/lgpl-3\.0
lgpl | lesser general public | (?:gnu )?lesser general public licen[cs]e | gnu\.org/(?:copyleft|licenses)/lgpl\.
agpl-1.0 | affero | affero general public licen[cs]e,? (?:version |v)1 | spdx\.org/licenses/agpl-1\.0
agpl-3.0 | affero | (?:gnu )?affero general public licen[cs]e,? (?:version |v)3(?:\.0)? | gnu\.org/licenses/agpl-3\.0
agpl | affero | (?:gnu )?affero general public licen[cs]e | gnu\.org/licenses/agpl\.
gfdl-1.1 | free documentation | (?:gnu )?free documentation licen[cs]e,? (?:version |v)1\.1 | gnu\.org/licenses/(?:old-licenses/)?fdl-1\.1
gfdl-1.2 | free documentation | (?:gnu )?free documentation licen[cs]e,? (?:version |v)1\.2 | gnu\.org/licenses/(?:old-licenses/)?fdl-1\.2
gfdl-1.3 | free documentation | (?:gnu )?free documentation licen[cs]e,? (?:version |v)1\.3 | gnu\.org/licenses/fdl-1\.3
gfdl | free documentation | (?:gnu )?free documentation licen[cs]e | gnu\.org/(?:copyleft|licenses)/fdl\.
mpl-1.0 | mozilla | mozilla public licen[cs]e,? (?:version |v ?)?1\.0 | mozilla\.org/mpl/mpl-1\.0
mpl-1.1 | mozilla | mozilla public licen[cs]e,? (?:version |v ?)?1\.1 | mozilla\.org/mpl/(?:mpl-)?1\.1
mpl-2.0 | mozilla | mozilla public licen[cs]e,? (?:version |v\.? ?)?2(?:\.0)? | mozilla\.org/(?:en-us/)?mpl/2\.0
mpl | mozilla | mozilla public licen[cs]e | mozilla\.org/(?:en-us/)?mpl/?(?![0-9a-z])
epl-1.0 | eclipse | eclipse public licen[cs]e,?(?: -)? (?:version |v ?)?1\.0 | eclipse\.org/legal/epl-v10
epl-2.0 | eclipse | eclipse public licen[cs]e,?(?: -)? (?:version |v ?)?2\.0 | eclipse\.org/legal/epl-(?:v20|2\.0)
epl | eclipse | eclipse public licen[cs]e | eclipse\.org/legal/epl/?(?![-a-z0-9])
edl-1.0 | eclipse | eclipse distribution licen[cs]e | eclipse\.org/org/documents/edl
cddl-1.0 | common development | common development and distribution licen[cs]e,? (?:\(cddl\),? )?(?:version |v)?1\.0 | opensource\.org/licenses/cddl1
cddl-1.1 | common development | common development and distribution licen[cs]e,? (?:\(cddl\),? )?(?:version |v)?1\.1 | glassfish\.java\.net/public/cddl
cpl-1.0 | common public | common public licen[cs]e | opensource\.org/licenses/cpl1
ipl-1.0 | ibm public | ibm public licen[cs]e | opensource\.org/licenses/ibmpl
cpal-1.0 | common public attribution | common public attribution licen[cs]e | opensource\.org/licenses/cpal
eupl-1.1 | european union public | european union public licen[cs]e,? (?:\(eupl\),? )?(?:version |v ?\.? ?)?1\.1 | spdx\.org/licenses/eupl-1\.1
eupl-1.2 | european union public | european union public licen[cs]e,? (?:\(eupl\),? )?(?:version |v ?\.? ?)?1\.2 | spdx\.org/licenses/eupl-1\.2
eupl | european union public | european union public licen[cs]e | joinup\.ec\.europa\.eu/(?:software/page|collection)/eupl
artistic-1.0 | artistic | artistic licen[cs]e,? (?:version )?1(?:\.0)? | opensource\.org/licenses/artistic-license-1
artistic-2.0 | artistic | artistic licen[cs]e,? (?:version )?2(?:\.0)? | opensource\.org/licenses/artistic-license-2
artistic | artistic | artistic licen[cs]e | perlfoundation\.org/artistic
zlib | zlib | zlib(?:/libpng)? licen[cs]e | opensource\.org/licenses/zlib
libpng | libpng | libpng licen[cs]e | libpng\.org/pub/png/src/libpng-license
bsl-1.0 | boost | boost software licen[cs]e | boost\.org/license_1_0
busl-1.1 | business source | business source licen[cs]e | mariadb\.com/bsl11
wtfpl | licen | do what the fuck you want to public licen[cs]e | wtfpl\.net
unlicense | unlicense | (?:the unlicense\b|unlicense licen[cs]e) | unlicense\.org
cc0-1.0 | cc0 | cc0(?:[- ]1\.0)?(?: universal)? | creativecommons\.org/publicdomain/zero/1\.0
cc-pdm | public domain | public domain mark | creativecommons\.org/publicdomain/mark
cc-by-1.0 | cc by | cc[- ]by[- ]1\.0 | creativecommons\.org/licenses/by/1\.0
cc-by-2.0 | cc by | cc[- ]by[- ]2\.0 | creativecommons\.org/licenses/by/2\.0
cc-by-2.5 | cc by | cc[- ]by[- ]2\.5 | creativecommons\.org/licenses/by/2\.5
cc-by-3.0 | cc by | cc[- ]by[- ]3\.0 | creativecommons\.org/licenses/by/3\.0
cc-by-4.0 | cc by | cc[- ]by[- ]4\.0 | creativecommons\.org/licenses/by/4\.0
cc-by-sa-2.0 | cc by | cc[- ]by[- ]sa[- ]2\.0 | creativecommons\.org/licenses/by-sa/2\.0
cc-by-sa-3.0 | cc by | cc[- ]by[- ]sa[- ]3\.0 | creativecommons\.org/licenses/by-sa/3\.0
cc-by-sa-4.0 | cc by | cc[- ]by[- ]sa[- ]4\.0 | creativecommons\.org/licenses/by-sa/4\.0
cc-by-sa | cc by | cc[- ]by[- ]sa\b | creativecommons\.org/licenses/by-sa\b
cc-by-nd-3.0 | cc by | cc[- ]by[- ]nd[- ]3\.0 | creativecommons\.org/licenses/by-nd/3\.0
cc-by-nd-4.0 | cc by | cc[- ]by[- ]nd[- ]4\.0 | creativecommons\.org/licenses/by-nd/4\.0
cc-by-nd | cc by | cc[- ]by[- ]nd\b | creativecommons\.org/licenses/by-nd\b
cc-by-nc-3.0 | cc by | cc[- ]by[- ]nc[- ]3\.0 | creativecommons\.org/licenses/by-nc/3\.0
cc-by-nc-4.0 | cc by | cc[- ]by[- ]nc[- ]4\.0 | creativecommons\.org/licenses/by-nc/4\.0
cc-by-nc | cc by | cc[- ]by[- ]nc\b | creativecommons\.org/licenses/by-nc\b
cc-by-nc-sa-3.0 | cc by | cc[- ]by[- ]nc[- ]sa[- ]3\.0 | creativecommons\.org/licenses/by-nc-sa/3\.0
cc-by-nc-sa-4.0 | cc by | cc[- ]by[- ]nc[- ]sa[- ]4\.0 | creativecommons\.org/licenses/by-nc-sa/4\.0
cc-by-nc-sa | cc by | cc[- ]by[- ]nc[- ]sa\b | creativecommons\.org/licenses/by-nc-sa\b
cc-by-nc-nd-3.0 | cc by | cc[- ]by[- ]nc[- ]nd[- ]3\.0 | creativecommons\.org/licenses/by-nc-nd/3\.0
cc-by-nc-nd-4.0 | cc by | cc[- ]by[- ]nc[- ]nd[- ]4\.0 | creativecommons\.org/licenses/by-nc-nd/4\.0
cc-by-nc-nd | cc by | cc[- ]by[- ]nc[- ]nd\b | creativecommons\.org/licenses/by-nc-nd\b
odbl-1.0 | database licen | open (?:data commons )?open database licen[cs]e|open database licen[cs]e | opendatacommons\.org/licenses/odbl
odc-by-1.0 | open data commons attribution | open data commons attribution licen[cs]e | opendatacommons\.org/licenses/by
pddl-1.0 | public domain dedication | public domain dedication (?:and|&) licen[cs]e | opendatacommons\.org/licenses/pddl
ofl-1.1 | open font | (?:sil )?open font licen[cs]e | scripts\.sil\.org/ofl
psf-2.0 | python | python software foundation licen[cs]e | docs\.python\.org/[0-9./a-z]*license
php-3.01 | php | php licen[cs]e,? (?:version |v)?3\.01 | php\.net/license/3_01
ruby | ruby | ruby licen[cs]e | ruby-lang\.org/[a-z/]*license
postgresql | postgresql | postgresql licen[cs]e | opensource\.org/licenses/postgresql
openssl | openssl | openssl licen[cs]e | openssl\.org/source/license
ms-pl | microsoft public | microsoft public licen[cs]e | opensource\.org/licenses/ms-pl
ms-rl | microsoft reciprocal | microsoft reciprocal licen[cs]e | opensource\.org/licenses/ms-rl
osl-3.0 | open software | open software licen[cs]e,? (?:version |v\.? ?)?3\.0 | opensource\.org/licenses/osl-3
afl-3.0 | academic free | academic free licen[cs]e,? (?:version |v\.? ?)?3\.0 | opensource\.org/licenses/afl-3
ecl-2.0 | educational community | educational community licen[cs]e | opensource\.org/licenses/ecl2
ncsa | ncsa | (?:university of illinois/)?ncsa open source licen[cs]e | opensource\.org/licenses/ncsa
upl-1.0 | universal permissive | universal permissive licen[cs]e | opensource\.org/licenses/upl
w3c | w3c | w3c (?:software|document) (?:notice and )?licen[cs]e | w3\.org/consortium/legal
qpl-1.0 | q public | q public licen[cs]e | opensource\.org/licenses/qpl
lppl-1.3 | latex project | latex project public licen[cs]e | latex-project\.org/lppl
sspl-1.0 | server side public | server side public licen[cs]e | mongodb\.com/licensing/server-side-public
elastic-2.0 | elastic | elastic licen[cs]e,? (?:version |v)?2(?:\.0)? | elastic\.co/licensing/elastic-license
polyform-nc-1.0 | polyform | polyform noncommercial licen[cs]e | polyformproject\.org/licenses/noncommercial
blueoak-1.0 | blue oak | blue oak model licen[cs]e | blueoakcouncil\.org/license
vim | vim | vim licen[cs]e | vimdoc\.sourceforge\.net/htmldoc/uganda
beerware | licen | beer-?ware licen[cs]e | spdx\.org/licenses/beerware
openrail | licen | (?:bigscience |creativeml )?open ?rail(?:-m|\+\+)?(?:-m)? licen[cs]e | bigscience\.huggingface\.co/blog
llama-community | llama | llama (?:2 |3 |3\.1 )?community licen[cs]e | ai\.meta\.com/llama/license
"""

#: label | score | keyword | pattern of a grant or of a licence's own words
_TEXTS = r"""
mit | 0.95 | permission is hereby granted | permission is hereby granted,? free of charge,? to any person obtaining a copy
mit | 0.85 | substantial portions | shall be included in all copies or substantial portions of the software
mit-0 | 0.8 | without restriction | to deal in the software without restriction
isc | 0.95 | permission to use, copy, modify | permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose
bsd | 0.9 | redistribution and use | redistribution and use in source and binary forms,? with or without modification,? are permitted
bsd-2-clause | 0.8 | redistributions | redistributions in binary form must reproduce the above copyright notice
bsd-3-clause | 0.95 | endorse or promote | neither the name of .{1,80} nor the names of its contributors may be used to endorse or promote
bsd-4-clause | 0.95 | advertising materials | all advertising materials mentioning features or use of this software must display
apache-2.0 | 0.95 | you may not use this file | you may not use this file except in compliance with the licen[cs]e
apache-2.0 | 0.85 | terms and conditions for use | terms and conditions for use, reproduction,? and distribution
gpl | 0.9 | free software foundation | as published by the free software foundation
gpl | 0.9 | you can redistribute it | you can redistribute it and/or modify it under the terms of the gnu
gpl-or-later | 0.95 | any later version | (?:version [0-9.]+ of the licen[cs]e, )?or \(at your option\) any later version
gpl | 0.8 | received a copy of the gnu | you should have received a copy of the gnu general public licen[cs]e
lgpl | 0.9 | gnu lesser | under the terms of the gnu lesser general public
lgpl | 0.9 | gnu library | under the terms of the gnu library general public
agpl | 0.9 | gnu affero | under the terms of the gnu affero general public
gfdl | 0.9 | invariant sections | with no invariant sections,? (?:with )?no front-cover texts
mpl-2.0 | 0.95 | this source code form | this source code form is subject to the terms of the mozilla public licen[cs]e
mpl-1.1 | 0.9 | contents of this file | the contents of this file are subject to the mozilla public licen[cs]e
epl | 0.9 | eclipse public | made available under the terms of the eclipse public licen[cs]e
cddl-1.0 | 0.9 | common development | subject to the terms of the common development and distribution
zlib | 0.95 | provided 'as is' | this software is provided 'as-is', without any express or implied
zlib | 0.9 | altered source versions | altered source versions must be plainly marked as such
bsl-1.0 | 0.95 | boost software | distributed under the boost software licen[cs]e
wtfpl | 0.95 | you just do what the | you just do what the fuck you want to
unlicense | 0.95 | unencumbered software | this is free and unencumbered software released into the public domain
cc0-1.0 | 0.9 | waived all copyright | (?:has|have) waived all copyright and related
cc0-1.0 | 0.85 | cc0 | to the extent possible under law.{0,120}cc0
public-domain | 0.8 | public domain | (?:is|are|was|been) (?:hereby )?(?:released|placed|dedicated|put) (?:in|into|to) the public domain
public-domain | 0.6 | public domain | (?:this|the) (?:work|file|text|book) is in the public domain
public-domain | 0.7 | no copyright | no (?:known )?copyright (?:restrictions?|is claimed)
cc-by | 0.85 | creative commons attribution | creative commons attribution(?: licen[cs]e)?(?: [0-9.]+)?(?: (?:international|unported|generic))?
cc-by-sa | 0.9 | creative commons attribution | creative commons attribution[- ]share-?alike
cc-by-nc | 0.9 | creative commons attribution | creative commons attribution[- ]non-?commercial
cc-by-nc-sa | 0.95 | creative commons attribution | creative commons attribution[- ]non-?commercial[- ]share-?alike
cc-by-nd | 0.9 | creative commons attribution | creative commons attribution[- ]no-?deriv(?:ative)?s
cc-by-nc-nd | 0.95 | creative commons attribution | creative commons attribution[- ]non-?commercial[- ]no-?deriv(?:ative)?s
creative-commons | 0.6 | creative commons | (?:under|with) a creative commons licen[cs]e
ofl-1.1 | 0.9 | reserved font name | reserved font name
postgresql | 0.9 | without a written agreement | permission to use, copy, modify, and distribute .{1,80} without a written agreement is hereby granted
ms-eula | 0.85 | microsoft software license | microsoft software licen[cs]e terms
proprietary | 0.8 | proprietary and confidential | proprietary and confidential
proprietary | 0.8 | unauthorized copying | unauthorized (?:copying|reproduction|distribution) of this (?:file|document|software|work)
proprietary | 0.75 | no part of this | no part of this (?:publication|book|document|work) may be reproduced
proprietary | 0.7 | permission | (?:may not be|not to be) (?:reproduced|copied|distributed|redistributed) without (?:prior |written |express )*permission
proprietary | 0.7 | end user | end[- ]user licen[cs]e agreement
proprietary | 0.7 | commercial licen | requires? a commercial licen[cs]e
proprietary | 0.7 | trade secret | contains? (?:confidential information and )?trade secrets?
non-commercial | 0.7 | commercial use | (?:for )?non-?commercial use only
non-commercial | 0.6 | commercial use | not for commercial use
research-only | 0.7 | for research | for research (?:purposes|use) only
no-derivatives | 0.6 | derivative | no derivative works?(?: are)? (?:allowed|permitted)
attribution | 0.5 | attribution | (?:attribution is required|must give appropriate credit|with attribution required)
copyright | 0.5 | copyright | copyright (?:\(c\)|\x{A9})? ?(?:19|20)[0-9]{2}
copyright | 0.45 | (c) | \(c\) (?:19|20)[0-9]{2}
copyright | 0.4 | copyright | copyright(?:ed)? (?:by|held by|of)
reserved | 0.6 | rights reserved | (?:all|some|no) rights reserved
reserved | 0.6 | droits r | tous droits r\x{E9}serv\x{E9}s
reserved | 0.6 | derechos reservados | todos los derechos reservados
reserved | 0.6 | rechte vorbehalten | alle rechte vorbehalten
licence-notice | 0.4 | licen | see (?:the )?licen[cs]e(?:\.txt|\.md)? (?:file )?for (?:details|more information|the full)
dual-licence | 0.6 | dual licen | dual[- ]licen[cs]ed under
terms | 0.4 | terms of | (?:subject to|under) (?:the )?terms of (?:use|service)
"""


def _table(text: str) -> list[list[str]]:
    return [[cell.strip() for cell in line.split(" | ")] for line in text.strip().splitlines()]


def _literal(pattern: str) -> str:
    """The fixed text a pattern begins with, as a keyword."""
    fixed = re.match(r"(?:\\[./]|[a-z0-9/_-](?![?*{]))*", pattern)[0].replace("\\", "")
    return fixed.replace("-", " ")


def _pattern(text: str) -> str:
    return text.replace("[- ]", r"[-\s]").replace(" ", r"\s+")


def _rules() -> list[Rule]:
    out = []
    for label, keyword, name, address in _table(_LICENCES):
        shown = label.removesuffix("-short")
        tag = shown.replace(".", r"\.")
        out.append(Rule(f"tag:{label}", shown, 5, 1.0, "spdx license identifier",
                        rf"spdx-license-identifier:\s{{0,4}}\(?{tag}(?:-only|-or-later|\+)?(?![-.\w])"))
        out.append(Rule(f"url:{label}", shown, 3, 0.9, _literal(address), address))
        out.append(Rule(f"under:{label}", shown, 2, 0.85, keyword, _pattern(
            rf"(?:licen[cs]ed|released|distributed|available|published) under (?:an? |the )?(?:terms of (?:an? |the )?)?(?:{name})")))
        out.append(Rule(f"name:{label}", shown, 1, 0.6, keyword, _pattern(rf"\b(?:{name})")))
    for i, (label, score, keyword, pattern) in enumerate(_table(_TEXTS)):
        out.append(Rule(f"text:{i}:{label}", label, 4, float(score), keyword, _pattern(pattern)))
    return out


RULES = _rules()
KEYWORDS = sorted({r.keyword for r in RULES})


def gates() -> list[str]:
    """Literals one of which stands in every match of any rule.

    The names of the licences hold "licen", but for those listed by keyword.
    """
    own = {"bsd", "gpl", "cc by", "cc0", "public domain"}
    out = {"licen"}
    for rule in RULES:
        named = rule.id.startswith(("under:", "name:"))
        if not named or rule.keyword in own:
            out.add(rule.keyword)
    return sorted(k for k in out if not any(g != k and g in k for g in out))
