"""The signature rules of the license scan, written over normalised text: words of lower-case letters,
digits and characters beyond ASCII, one blank between two ("Apache-2.0" reads "apache 2 0").

A rule is a label, a keyword that every match contains, a regular expression, a priority (0 is the
strongest) and a confidence. Names of licenses are written once and stand alone (NAME), in a notice and
in a machine-readable tag; sentences of license texts, addresses and general statements are rules of
their own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    kind: str
    priority: int
    confidence: float


# Phrases that every scan reports, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# kind: (priority, confidence)
KINDS = {"text": (0, 0.95), "tag": (0, 1.0), "url": (1, 0.9), "notice": (1, 0.9), "name": (2, 0.6), "statement": (3, 0.3), "phrase": (3, 0.4)}

LIC = "licen[cs]e"
V = "(?:v ?|version )?"

# label | keyword | the license's name
NAMES = r"""
apache-1.0 | apache | apache(?: software)? LIC V1 0
apache-1.1 | apache | apache(?: software)? LIC V1 1
apache-2.0 | apache | (?:apache(?: software)? LIC V2(?: 0)?|apache V2 0|apache 2 LIC)
apache | apache | apache(?: software)? LIC
mit | mit lic | mit LIC
mit | expat | expat LIC
mit-0 | mit no | mit no attribution
mit-0 | mit 0 | mit 0 LIC
bsd-2-clause | bsd | (?:simplified bsd|2 clause bsd|two clause bsd|bsd 2 clause|freebsd)(?: LIC)?
bsd-3-clause | bsd | (?:new bsd|modified bsd|revised bsd|3 clause bsd|three clause bsd|bsd 3 clause)(?: LIC)?
bsd-4-clause | bsd | (?:original bsd|4 clause bsd|four clause bsd|bsd 4 clause)(?: LIC)?
0bsd | 0bsd | 0bsd(?: LIC)?
0bsd | bsd | (?:zero clause bsd|bsd zero clause|bsd 0 clause)(?: LIC)?
bsd | bsd | (?:bsd|berkeley software distribution bsd) (?:style )?LIC
isc | isc lic | isc LIC
isc | internet systems | internet systems consortium LIC
gpl-1.0 | general public | (?:gnu )?general public LIC (?:as published [^ ]{1,20} the free software foundation )?V1(?: 0)?
gpl-2.0 | general public | (?:gnu )?general public LIC V2(?: 0)?
gpl-2.0-or-later | general public | (?:gnu )?general public LIC V2(?: 0)? or (?:any )?later
gpl-3.0 | general public | (?:gnu )?general public LIC V3(?: 0)?
gpl-3.0-or-later | general public | (?:gnu )?general public LIC V3(?: 0)? or (?:any )?later
gpl-2.0 | gpl | (?:gnu )?gpl ?V2(?: 0)?
gpl-2.0 | gplv2 | gplv2(?: 0)?
gpl-3.0 | gpl | (?:gnu )?gpl ?V3(?: 0)?
gpl-3.0 | gplv3 | gplv3(?: 0)?
gpl | gnu gpl | gnu gpl
gpl | gnu general | gnu general public LIC
lgpl-2.0 | library general | (?:gnu )?library general public LIC V2(?: 0)?
lgpl-2.1 | lesser general | (?:gnu )?lesser general public LIC V2 1
lgpl-2.1-or-later | lesser general | (?:gnu )?lesser general public LIC V2 1 or (?:any )?later
lgpl-3.0 | lesser general | (?:gnu )?lesser general public LIC V3(?: 0)?
lgpl-3.0-or-later | lesser general | (?:gnu )?lesser general public LIC V3(?: 0)? or (?:any )?later
lgpl-2.1 | lgpl | (?:gnu )?lgpl ?V2 1
lgpl-3.0 | lgpl | (?:gnu )?lgpl ?V3(?: 0)?
lgpl | lesser general | (?:gnu )?lesser general public LIC
lgpl | library general | (?:gnu )?library general public LIC
lgpl | gnu lgpl | gnu lgpl
agpl-3.0 | affero general | (?:gnu )?affero general public LIC V3(?: 0)?
agpl-3.0-or-later | affero general | (?:gnu )?affero general public LIC V3(?: 0)? or (?:any )?later
agpl-1.0 | affero general | affero general public LIC V1(?: 0)?
agpl | affero general | (?:gnu )?affero general public LIC
agpl-3.0 | agpl | (?:gnu )?agpl ?V3(?: 0)?
agpl-3.0 | agplv3 | agplv3
gfdl-1.1 | free documentation | (?:gnu )?free documentation LIC V1 1
gfdl-1.2 | free documentation | (?:gnu )?free documentation LIC V1 2
gfdl-1.3 | free documentation | (?:gnu )?free documentation LIC V1 3
gfdl | free documentation | (?:gnu )?free documentation LIC
mpl-1.0 | mozilla public | mozilla public LIC V1 0
mpl-1.1 | mozilla public | mozilla public LIC V1 1
mpl-2.0 | mozilla public | mozilla public LIC V2(?: 0)?
mpl | mozilla public | mozilla public LIC
mpl-2.0 | mpl 2 | mpl 2 0
epl-1.0 | eclipse public | eclipse public LIC V1(?: 0)?
epl-2.0 | eclipse public | eclipse public LIC V2(?: 0)?
epl | eclipse public | eclipse public LIC
edl-1.0 | eclipse distribution | eclipse distribution LIC(?: V1(?: 0)?)?
cpl-1.0 | common public lic | common public LIC(?: V1(?: 0)?)?
ipl-1.0 | ibm public | ibm public LIC(?: V1(?: 0)?)?
cddl-1.0 | common development | common development and distribution LIC(?: V1(?: 0)?)?
cddl-1.1 | common development | common development and distribution LIC V1 1
cddl-1.0 | cddl | cddl(?: V1 0)?
eupl-1.1 | european union public | european union public LIC V1 1
eupl-1.2 | european union public | european union public LIC V1 2
eupl | european union public | european union public LIC
cecill-2.1 | cecill | cecill (?:free software LIC )?V2 1
cecill-b | cecill | cecill b(?: LIC)?
cecill-c | cecill | cecill c(?: LIC)?
artistic-1.0 | artistic lic | artistic LIC V1(?: 0)?
artistic-2.0 | artistic lic | artistic LIC V2(?: 0)?
artistic | artistic lic | (?:perl )?artistic LIC
zlib | zlib lic | zlib LIC
zlib | zlib libpng | zlib libpng LIC
libpng | libpng lic | libpng LIC
bsl-1.0 | boost software | boost software LIC(?: V1(?: 0)?)?
busl-1.1 | business source | business source LIC(?: V1(?: 1)?)?
sspl-1.0 | server side public | server side public LIC(?: V1)?
elastic-2.0 | elastic lic | elastic LIC(?: V2(?: 0)?)?
unlicense | unlicense | (?:the )?unlicense
wtfpl | wtfpl | wtfpl
wtfpl | do what the | do what the [^ ]{1,10} you want to public LIC
beerware | beerware | beerware(?: LIC)?
beerware | beer ware | beer ware LIC
psf-2.0 | python software foundation | python software foundation LIC(?: V2)?
python | python lic | python LIC
php-3.01 | php lic | php LIC V3 01
php-3.0 | php lic | php LIC(?: V3(?: 0)?)?
ruby | ruby lic | ruby LIC
openssl | openssl lic | openssl LIC
ssleay | ssleay | (?:original )?ssleay LIC
openldap-2.8 | openldap | openldap public LIC(?: V2 8)?
postgresql | postgresql lic | postgresql LIC
vim | vim lic | vim LIC
w3c | w3c software | w3c software(?: notice)?(?: and)?(?: document)? LIC
x11 | x11 lic | x11 LIC
ncsa | ncsa | (?:university of illinois )?ncsa open source LIC
ofl-1.0 | sil open font | sil open font LIC V1 0
ofl-1.1 | sil open font | sil open font LIC(?: V1 1)?
ubuntu-font-1.0 | ubuntu font | ubuntu font LIC(?: V1 0)?
bitstream-vera | bitstream vera | bitstream vera LIC
afl-2.1 | academic free | academic free LIC V2 1
afl-3.0 | academic free | academic free LIC(?: V3(?: 0)?)?
osl-3.0 | open software lic | open software LIC(?: V3(?: 0)?)?
ecl-2.0 | educational community | educational community LIC(?: V2(?: 0)?)?
apsl-2.0 | apple public source | apple public source LIC(?: V2(?: 0)?)?
ms-pl | microsoft public | microsoft public LIC
ms-rl | microsoft reciprocal | microsoft reciprocal LIC
npl-1.1 | netscape public | netscape public LIC(?: V1 1)?
qpl-1.0 | q public | q public LIC(?: V1 0)?
lppl-1.3c | latex project | latex project public LIC(?: V1 3c?)?
rpl-1.5 | reciprocal public | reciprocal public LIC(?: V1 5)?
sleepycat | sleepycat | sleepycat LIC
upl-1.0 | universal permissive | universal permissive LIC(?: V1 0)?
mulan-psl-2.0 | mulan | mulan permissive software LIC(?: V2)?
hippocratic-2.1 | hippocratic | hippocratic LIC(?: V2 1)?
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc-by-1.0 | attribution 1 0 | (?:creative commons )?attribution 1 0(?: generic)?
cc-by-2.0 | attribution 2 0 | (?:creative commons )?attribution 2 0(?: generic)?
cc-by-2.5 | attribution 2 5 | (?:creative commons )?attribution 2 5(?: generic)?
cc-by-3.0 | attribution 3 0 | (?:creative commons )?attribution 3 0(?: unported)?
cc-by-4.0 | attribution 4 0 | (?:creative commons )?attribution 4 0(?: international)?
cc-by-2.0 | cc by | cc by 2 0
cc-by-2.5 | cc by | cc by 2 5
cc-by-3.0 | cc by | cc by 3 0
cc-by-4.0 | cc by | cc by 4 0
cc-by-sa | cc by | cc by sa
cc-by-sa-2.0 | cc by | cc by sa 2 0
cc-by-sa-3.0 | cc by | cc by sa 3 0
cc-by-sa-4.0 | cc by | cc by sa 4 0
cc-by-nc | cc by | cc by nc
cc-by-nc-2.0 | cc by | cc by nc 2 0
cc-by-nc-3.0 | cc by | cc by nc 3 0
cc-by-nc-4.0 | cc by | cc by nc 4 0
cc-by-nd | cc by | cc by nd
cc-by-nd-3.0 | cc by | cc by nd 3 0
cc-by-nd-4.0 | cc by | cc by nd 4 0
cc-by-nc-sa | cc by | cc by nc sa
cc-by-nc-sa-3.0 | cc by | cc by nc sa 3 0
cc-by-nc-sa-4.0 | cc by | cc by nc sa 4 0
cc-by-nc-nd | cc by | cc by nc nd
cc-by-nc-nd-3.0 | cc by | cc by nc nd 3 0
cc-by-nc-nd-4.0 | cc by | cc by nc nd 4 0
cc-by-sa-3.0 | sharealike | (?:creative commons )?attribution sharealike 3 0(?: unported)?
cc-by-sa-4.0 | sharealike | (?:creative commons )?attribution sharealike 4 0(?: international)?
cc-by-nc-3.0 | noncommercial | (?:creative commons )?attribution noncommercial 3 0(?: unported)?
cc-by-nc-4.0 | noncommercial | (?:creative commons )?attribution noncommercial 4 0(?: international)?
cc-by-nd-4.0 | noderivatives | (?:creative commons )?attribution noderivatives 4 0(?: international)?
cc-by-nd-3.0 | noderivs | (?:creative commons )?attribution noderivs 3 0(?: unported)?
cc-by-nc-sa-4.0 | noncommercial sharealike | (?:creative commons )?attribution noncommercial sharealike 4 0(?: international)?
cc-by-nc-sa-3.0 | noncommercial sharealike | (?:creative commons )?attribution noncommercial sharealike 3 0(?: unported)?
cc-by-nc-nd-4.0 | noncommercial noderivatives | (?:creative commons )?attribution noncommercial noderivatives 4 0(?: international)?
cc-by-nc-nd-3.0 | noncommercial noderivs | (?:creative commons )?attribution noncommercial noderivs 3 0(?: unported)?
creative-commons | creative commons lic | creative commons LIC
odbl-1.0 | open database | (?:odc )?open database LIC(?: V1 0)?
odc-by-1.0 | open data commons attribution | open data commons attribution LIC(?: V1 0)?
pddl-1.0 | public domain dedication | (?:odc )?public domain dedication and LIC(?: V1 0)?
ogl-uk-2.0 | open government | open government LIC V2(?: 0)?
ogl-uk-3.0 | open government | open government LIC V3(?: 0)?
ogl | open government | open government LIC
cdla-permissive-2.0 | community data | community data LIC agreement permissive(?: V2 0)?
cdla-sharing-1.0 | community data | community data LIC agreement sharing(?: V1 0)?
openrail | openrail | (?:creativeml |bigscience )?openrail(?: m)?(?: LIC)?
etalab-2.0 | etalab | etalab(?: open)? LIC(?: V2 0)?
"""

# label | keyword | a sentence or title of the license's text
TEXTS = r"""
mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | the above copyright notice and this permission | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | the software is provided as is without warranty | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
isc | permission to use copy modify and | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | permission to use copy modify and | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted
bsd | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted
bsd | redistributions of source code | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | redistributions in binary form | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause | endorse or promote | neither the name of (?:[^ ]{1,20} ){1,8}nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledg[e]?ment
apache-2.0 | you may not use this file except | you may not use this file except in compliance with the license
apache-2.0 | distributed on an as is basis | software distributed under the license is distributed on an as is basis without warranties or conditions of any kind
apache-2.0 | apache license version 2 0 january | apache license version 2 0 january 2004
apache-2.0 | terms and conditions for use | terms and conditions for use reproduction and distribution
gpl | free software you can | this program is free software you can redistribute it and or modify it
gpl | without even the implied | without any warranty without even the implied warranty of merchantability or fitness for a particular purpose
gpl | should have received a copy | you should have received a copy of the gnu general public license
lgpl | should have received a copy | you should have received a copy of the gnu lesser general public license
agpl | should have received a copy | you should have received a copy of the gnu affero general public license
gpl-2.0 | gnu general public license version 2 | gnu general public license version 2 june 1991
gpl-3.0 | gnu general public license version 3 | gnu general public license version 3 29 june 2007
lgpl-2.1 | lesser general public license version 2 1 | gnu lesser general public license version 2 1 february 1999
lgpl-3.0 | lesser general public license version 3 | gnu lesser general public license version 3 29 june 2007
agpl-3.0 | affero general public license version 3 | gnu affero general public license version 3 19 november 2007
gfdl | permission is granted to copy | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2.0 | source code form is subject | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | contents of this file are subject | the contents of this file are subject to the mozilla public license version 1 1
cddl-1.0 | contents of this file are subject | the contents of this file are subject to the terms of the common development and distribution license
epl-2.0 | accompanying materials are made | this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
epl-1.0 | accompanying materials are made | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
zlib | origin of this software | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | altered source versions | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
bsl-1.0 | boost software license version 1 0 17 | boost software license version 1 0 17th august 2003
unlicense | unencumbered software released | this is free and unencumbered software released into the public domain
wtfpl | you just do what | you just do what the [^ ]{1,10} you want to
beerware | buy me a beer | you can buy me a beer in return
artistic-2.0 | this license establishes the terms | this license establishes the terms under which a given free software package may be copied modified distributed
psf-2.0 | psf is making python | psf is making python available to licensee on an as is basis
openssl | for use in the openssl | this product includes software developed by the openssl project for use in the openssl toolkit
ofl-1.1 | this font software is licensed | this font software is licensed under the sil open font license version 1 1
cc0-1.0 | waived all copyright | has waived all copyright and related or neighboring rights
cc-by-4.0 | attribution 4 0 international public | creative commons attribution 4 0 international public license
cc-by-sa-4.0 | sharealike 4 0 international public | creative commons attribution sharealike 4 0 international public license
cc-by-nc-4.0 | noncommercial 4 0 international public | creative commons attribution noncommercial 4 0 international public license
ncsa | deal with the software | to deal with the software without restriction
odbl-1.0 | database is made available | this [^ ]{1,30} ?database is made available under the open database license
ms-pl | microsoft public license ms pl | microsoft public license ms pl this license governs use of the accompanying software
upl-1.0 | larger works | larger works as defined below
sspl-1.0 | server side public license version 1 | server side public license version 1 october 16 2018
busl-1.1 | licensor hereby grants you | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use
hippocratic-2.1 | human rights principles | complies with the human rights principles
x11 | x consortium shall not | the name of the x consortium shall not be used in advertising
w3c | w3c software notice | w3c software notice and license
"""

# label | keyword | an address, as words
URLS = r"""
apache-2.0 | apache org licenses | apache org licenses license 2 0
apache-1.1 | apache org licenses | apache org licenses license 1 1
mit | opensource org licenses | opensource org licenses mit(?: license)?
bsd-2-clause | opensource org licenses | opensource org licenses bsd 2 clause
bsd-3-clause | opensource org licenses | opensource org licenses bsd 3 clause
isc | opensource org licenses | opensource org licenses isc
apache-2.0 | opensource org licenses | opensource org licenses apache 2 0
mpl-2.0 | opensource org licenses | opensource org licenses mpl 2 0
gpl-3.0 | gnu org licenses | gnu org licenses gpl 3 0
gpl-2.0 | gnu org licenses | gnu org licenses (?:old licenses )?gpl 2 0
lgpl-3.0 | gnu org licenses | gnu org licenses lgpl 3 0
lgpl-2.1 | gnu org licenses | gnu org licenses (?:old licenses )?lgpl 2 1
agpl-3.0 | gnu org licenses | gnu org licenses agpl 3 0
gfdl-1.3 | gnu org licenses | gnu org licenses fdl 1 3
gpl | gnu org licenses | gnu org licenses
mpl-2.0 | mozilla org mpl | mozilla org mpl 2 0
mpl-2.0 | mozilla org en us mpl | mozilla org en us mpl 2 0
epl-2.0 | eclipse org legal | eclipse org legal epl 2 0
epl-1.0 | eclipse org legal | eclipse org legal epl v10
bsl-1.0 | boost org license | boost org license 1 0
cc0-1.0 | creativecommons org | creativecommons org publicdomain zero 1 0
cc-by-2.0 | creativecommons org | creativecommons org licenses by 2 0
cc-by-3.0 | creativecommons org | creativecommons org licenses by 3 0
cc-by-4.0 | creativecommons org | creativecommons org licenses by 4 0
cc-by-sa-3.0 | creativecommons org | creativecommons org licenses by sa 3 0
cc-by-sa-4.0 | creativecommons org | creativecommons org licenses by sa 4 0
cc-by-nc-3.0 | creativecommons org | creativecommons org licenses by nc 3 0
cc-by-nc-4.0 | creativecommons org | creativecommons org licenses by nc 4 0
cc-by-nd-4.0 | creativecommons org | creativecommons org licenses by nd 4 0
cc-by-nc-sa-3.0 | creativecommons org | creativecommons org licenses by nc sa 3 0
cc-by-nc-sa-4.0 | creativecommons org | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | creativecommons org | creativecommons org licenses by nc nd 4 0
unlicense | unlicense org | unlicense org
wtfpl | wtfpl net | wtfpl net
ofl-1.1 | scripts sil org | scripts sil org ofl
odbl-1.0 | opendatacommons org | opendatacommons org licenses odbl
pddl-1.0 | opendatacommons org | opendatacommons org licenses pddl
ogl-uk-3.0 | nationalarchives gov uk | nationalarchives gov uk doc open government licence version 3
"""

# label | keyword | what is said without a license's name
STATEMENTS = r"""
copyright | copyright | copyright(?: c| ©)?(?: (?:19|20)[0-9][0-9]){1,3}
copyright | copyright | copyright by [^ ]{1,30}
reserved | some rights reserved | some rights reserved
reserved | tous droits | tous droits réservés
reserved | alle rechte | alle rechte vorbehalten
reserved | todos los derechos | todos los derechos reservados
public-domain | public domain | (?:in|into|to) the public domain
public-domain | public domain | public domain (?:work|software|dedication)
proprietary | proprietary | proprietary and confidential
proprietary | unauthorized copying | unauthorized copying of this (?:file|document|software) (?:via any medium )?is strictly prohibited
proprietary | prior written | without(?: the)? prior written (?:permission|consent)
proprietary | may not be reproduced | may not be reproduced (?:[^ ]{1,20} ){0,6}without permission
non-commercial | commercial use | (?:for )?non commercial use only
non-commercial | noncommercial use | noncommercial use only
commercial | commercial lic | commercial LIC
eula | end user lic | end user LIC agreement
shareware | shareware | this is shareware
license-reference | see the lic | see the LIC(?: file)?(?: for details)?
license-reference | the full lic | the full LIC text
license-reference | lic | subject to the following LIC terms
license-reference | terms of the lic | terms of the LIC agreement
warranty-disclaimer | without warranty | without warranty of any kind
warranty-disclaimer | no warranty | there is no warranty
"""

NOTICE = "(?:licen[cs]ed|released|distributed|redistributed|available|provided|published|offered|covered|governed|shared) under (?:the )?(?:terms of )?(?:the )?"
TAG = "spdx licen[cs]e identifier (?:(?:[^ ]{1,24} ){1,6}(?:or|and) ){0,2}"


def _rows(table: str):
    for line in table.strip().splitlines():
        label, keyword, pattern = (part.strip() for part in line.split(" | ", 2))
        yield label, keyword, pattern.replace("LIC", LIC).replace("V1", V + "1").replace("V2", V + "2").replace("V3", V + "3")


def _rule(label: str, keyword: str, pattern: str, kind: str) -> Rule:
    """A rule's interval is its group `at`, where it has one, else the match.
    Rules run over UTF-8 bytes read as Latin-1, so characters beyond ASCII are written as their bytes."""
    keyword, pattern = (x.encode().decode("latin-1") for x in (keyword, pattern))
    return Rule(label, keyword, rf"(?<![^ ])(?:{pattern})(?![^ ])", kind, *KINDS[kind])


def _rules() -> tuple[Rule, ...]:
    out = [_rule(label, phrase, phrase, "phrase") for phrase, label in PHRASES]
    for kind, rows in (("text", TEXTS), ("url", URLS), ("statement", STATEMENTS)):
        out += [_rule(*row, kind) for row in _rows(rows)]
    for label, keyword, pattern in _rows(NAMES):
        out.append(_rule(label, keyword, f"{NOTICE}(?:{pattern})", "notice"))
        out.append(_rule(label, keyword, pattern, "name"))
    for label in dict.fromkeys(label for label, _, _ in _rows(NAMES)):
        words = " ".join(re.findall("[a-z0-9]+", label))
        out.append(_rule(label, "spdx", f"{TAG}(?P<at>{words}(?: only)?)", "tag"))
    return tuple(out)


RULES = _rules()
