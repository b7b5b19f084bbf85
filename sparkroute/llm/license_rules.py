"""Signatures of licences: regular expressions over lower-case words with one space between them.

A line is a rule: label, tier, keywords, expression. Words of every text that the expression
matches begin with the keywords, which are looked for first. Tiers: 3 a tag, an address or wording of the licence itself; 2 a notice or a name with
its version; 1 a bare name. ``LIC`` stands for both spellings of licence, ``VER`` for an optional word
before a number, ``BY`` for how notices begin.
"""

from __future__ import annotations

import re

PARTS = {
    "LIC": "licen[cs]e",
    "VER": "(?:version |ver |v ?)?",
    "BY": "(?:licen[cs]ed|released|distributed|available|published|provided|covered) (?:only |solely )?under (?:the )?(?:terms of )?(?:the )?",
    "TAG": "spdx licen[cs]e identifier",
}

RULES = """
apache-2.0 | 3 | spdx | TAG apache 2 0
apache-2.0 | 3 | apache | (?:www )?apache org licenses LIC 2 0(?: txt| html)?
apache-2.0 | 3 | apache | apache LIC VER2(?: 0)? january 2004
apache-2.0 | 2 | apache | BY(?:apache software foundation )?apache LIC VER2(?: 0)?
apache-2.0 | 2 | apache | apache (?:software )?LIC VER2(?: 0)?
apache-2.0 | 2 | apache | apache VER2 0
apache-2.0 | 2 | asl2 | asl2(?: 0)?
apache-1.1 | 3 | spdx | TAG apache 1 1
apache-1.1 | 2 | apache | apache (?:software )?LIC VER1 1
apache-1.0 | 2 | apache | apache (?:software )?LIC VER1 0
apache | 1 | apache | apache (?:software )?LIC
mit | 3 | spdx | TAG mit
mit | 3 | opensource | opensource org licenses mit(?: LIC)?(?: php)?
mit | 3 | choosealicense | choosealicense com licenses mit
mit | 3 | charge | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 2 | mit licen | BY(?:mit|expat) LIC
mit | 2 | mit licen | mit LIC(?: mit)?
mit | 2 | expat | expat LIC
mit | 2 | mit licen | LIC mit
mit | 2 | mit licen | dual licensed under (?:the )?mit
mit-0 | 3 | spdx | TAG mit 0
mit-0 | 2 | attribution | mit no attribution
x11 | 3 | spdx | TAG x11
x11 | 2 | x11 | x11 LIC
bsd-2-clause | 3 | spdx | TAG bsd 2 clause
bsd-2-clause | 3 | opensource | opensource org licenses bsd 2 clause
bsd-2-clause | 2 | bsd | bsd 2 clause(?: LIC)?
bsd-2-clause | 2 | simplified | simplified bsd(?: LIC)?
bsd-2-clause | 2 | freebsd | freebsd LIC
bsd-2-clause | 2 | bsd | (?:2|two) clause bsd(?: LIC)?
bsd-3-clause | 3 | spdx | TAG bsd 3 clause
bsd-3-clause | 3 | opensource | opensource org licenses bsd 3 clause
bsd-3-clause | 3 | endorse | neither the name of [^ ]+(?: [^ ]+){0,12} may be used to endorse or promote products
bsd-3-clause | 2 | bsd | bsd 3 clause(?: LIC)?
bsd-3-clause | 2 | bsd | (?:new|modified|revised) bsd(?: LIC)?
bsd-3-clause | 2 | bsd | (?:3|three) clause bsd(?: LIC)?
bsd-4-clause | 3 | spdx | TAG bsd 4 clause
bsd-4-clause | 3 | advertising | all advertising materials mentioning features or use of this software must display
bsd-4-clause | 2 | bsd | (?:original|old|4 clause|four clause) bsd(?: LIC)?
bsd-4-clause | 2 | bsd | bsd 4 clause(?: LIC)?
0bsd | 3 | spdx | TAG 0bsd
0bsd | 2 | 0bsd | 0bsd(?: LIC)?
0bsd | 2 | zero | zero clause bsd
bsd | 3 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd | 2 | bsd | BYbsd(?: style)? LIC
bsd | 1 | bsd | bsd (?:style )?LIC
isc | 3 | spdx | TAG isc
isc | 3 | purpose | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee
isc | 2 | isc licen | isc LIC
gpl-2.0 | 3 | spdx | TAG gpl 2 0(?: only)?
gpl-2.0-or-later | 3 | spdx | TAG gpl 2 0 (?:or later|plus)
gpl-2.0 | 3 | gnu | gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?
gpl-2.0-or-later | 3 | option | general public LIC as published by the free software foundation either version 2 of the LIC or at your option any later version
gpl-2.0 | 2 | general | (?:gnu )?general public LIC VER2(?: 0)?
gpl-2.0 | 2 | gpl | gpl VER2(?: 0)?(?: only)?
gpl-2.0 | 2 | gplv2 | gplv2(?: 0)?
gpl-2.0-or-later | 2 | gpl | gpl VER2(?: 0)? or (?:any )?later
gpl-3.0 | 3 | spdx | TAG gpl 3 0(?: only)?
gpl-3.0-or-later | 3 | spdx | TAG gpl 3 0 (?:or later|plus)
gpl-3.0 | 3 | gnu | gnu org licenses gpl 3 0(?: en)?(?: html| txt)?
gpl-3.0 | 3 | general | gnu general public LIC version 3 29 june 2007
gpl-3.0-or-later | 3 | option | general public LIC as published by the free software foundation either version 3 of the LIC or at your option any later version
gpl-3.0 | 2 | general | (?:gnu )?general public LIC VER3(?: 0)?
gpl-3.0 | 2 | gpl | gpl VER3(?: 0)?(?: only)?
gpl-3.0 | 2 | gplv3 | gplv3(?: 0)?
gpl-3.0-or-later | 2 | gpl | gpl VER3(?: 0)? or (?:any )?later
gpl-1.0 | 2 | general | (?:gnu )?general public LIC VER1(?: 0)?
gpl | 3 | gnu | gnu org (?:copyleft|licenses) gpl(?: html| txt)?
gpl | 2 | gnu | BYgnu (?:general public LIC|gpl)
gpl | 1 | general | (?:gnu )?general public LIC
gpl | 1 | gpl | gnu gpl
gpl | 1 | gpl | gpl LIC
lgpl-2.1 | 3 | spdx | TAG lgpl 2 1(?: only| or later)?
lgpl-2.1 | 3 | gnu | gnu org licenses (?:old licenses )?lgpl 2 1(?: en)?(?: html| txt)?
lgpl-2.1 | 2 | lesser | (?:gnu )?lesser general public LIC VER2 1
lgpl-2.1 | 2 | lgpl | lgpl VER2 1
lgpl-2.1 | 2 | lgplv2 | lgplv2 1
lgpl-2.0 | 3 | spdx | TAG lgpl 2 0(?: only| or later)?
lgpl-2.0 | 2 | library | (?:gnu )?library general public LIC(?: VER2(?: 0)?)?
lgpl-3.0 | 3 | spdx | TAG lgpl 3 0(?: only| or later)?
lgpl-3.0 | 3 | gnu | gnu org licenses lgpl 3 0(?: en)?(?: html| txt)?
lgpl-3.0 | 2 | lesser | (?:gnu )?lesser general public LIC VER3(?: 0)?
lgpl-3.0 | 2 | lgpl | lgpl VER3(?: 0)?
lgpl-3.0 | 2 | lgplv3 | lgplv3(?: 0)?
lgpl | 2 | lesser | BY(?:gnu )?lesser general public LIC
lgpl | 1 | lesser | (?:gnu )?lesser general public LIC
lgpl | 1 | lgpl | (?:gnu )?lgpl(?: LIC)?
agpl-3.0 | 3 | spdx | TAG agpl 3 0(?: only| or later)?
agpl-3.0 | 3 | gnu | gnu org licenses agpl(?: 3 0)?(?: en)?(?: html| txt)?
agpl-3.0 | 2 | affero | (?:gnu )?affero general public LIC VER3(?: 0)?
agpl-3.0 | 2 | agpl | agpl VER3(?: 0)?
agpl-3.0 | 2 | agplv3 | agplv3(?: 0)?
agpl-1.0 | 2 | affero | affero general public LIC VER1(?: 0)?
agpl | 1 | affero | (?:gnu )?affero (?:general public LIC|gpl)
agpl | 1 | agpl | agpl(?: LIC)?
gfdl-1.3 | 3 | spdx | TAG gfdl 1 3(?: only| or later)?
gfdl-1.3 | 2 | documentation | (?:gnu )?free documentation LIC VER1 3
gfdl-1.2 | 3 | spdx | TAG gfdl 1 2(?: only| or later)?
gfdl-1.2 | 2 | documentation | (?:gnu )?free documentation LIC VER1 2
gfdl-1.1 | 2 | documentation | (?:gnu )?free documentation LIC VER1 1
gfdl | 2 | documentation | BYgnu free documentation LIC
gfdl | 1 | documentation | (?:gnu )?free documentation LIC
gfdl | 1 | gfdl | (?:gnu )?gfdl
mpl-2.0 | 3 | spdx | TAG mpl 2 0
mpl-2.0 | 3 | mozilla | mozilla org mpl 2 0
mpl-2.0 | 3 | mozilla | this source code form is subject to the terms of the mozilla public LIC v 2 0
mpl-2.0 | 2 | mozilla | mozilla public LIC VER2(?: 0)?
mpl-2.0 | 2 | mpl | mpl VER2(?: 0)?
mpl-1.1 | 3 | spdx | TAG mpl 1 1
mpl-1.1 | 3 | mozilla | mozilla org mpl mpl 1 1(?: html| txt)?
mpl-1.1 | 2 | mozilla | mozilla public LIC VER1 1
mpl-1.1 | 2 | mpl | mpl VER1 1
mpl-1.0 | 2 | mozilla | mozilla public LIC VER1 0
mpl | 1 | mozilla | mozilla public LIC
epl-2.0 | 3 | spdx | TAG epl 2 0
epl-2.0 | 3 | eclipse | eclipse org legal epl (?:v20|2 0)(?: html)?
epl-2.0 | 2 | eclipse | eclipse public LIC VER2(?: 0)?
epl-1.0 | 3 | spdx | TAG epl 1 0
epl-1.0 | 3 | eclipse | eclipse org legal epl v10(?: html)?
epl-1.0 | 2 | eclipse | eclipse public LIC VER1(?: 0)?
epl | 1 | eclipse | eclipse public LIC
edl-1.0 | 2 | eclipse | eclipse distribution LIC(?: VER1(?: 0)?)?
cddl-1.1 | 3 | spdx | TAG cddl 1 1
cddl-1.1 | 2 | distribution | common development and distribution LIC(?: cddl)? VER1 1
cddl-1.0 | 3 | spdx | TAG cddl 1 0
cddl-1.0 | 2 | distribution | common development and distribution LIC(?: cddl)? VER1 0
cddl | 1 | distribution | common development and distribution LIC
cddl | 1 | cddl | cddl(?: LIC)?
cpl-1.0 | 2 | common | common public LIC(?: VER1(?: 0)?)?
ipl-1.0 | 2 | ibm | ibm public LIC(?: VER1(?: 0)?)?
artistic-2.0 | 3 | spdx | TAG artistic 2 0
artistic-2.0 | 2 | artistic | artistic LIC VER2(?: 0)?
artistic-1.0 | 3 | spdx | TAG artistic 1 0
artistic-1.0 | 2 | artistic | artistic LIC VER1(?: 0)?
artistic | 1 | artistic | artistic LIC
perl | 2 | perl | same terms as perl(?: itself)?
bsl-1.0 | 3 | spdx | TAG bsl 1 0
bsl-1.0 | 3 | boost | boost org LIC 1 0(?: txt)?
bsl-1.0 | 2 | boost | boost software LIC(?: VER1(?: 0)?)?
busl-1.1 | 3 | spdx | TAG busl 1 1
busl-1.1 | 2 | business | business source LIC(?: VER1 1)?
sspl-1.0 | 3 | spdx | TAG sspl 1 0
sspl-1.0 | 2 | server | server side public LIC(?: VER1)?
elastic-2.0 | 3 | spdx | TAG elastic 2 0
elastic-2.0 | 2 | elastic | elastic LIC VER2(?: 0)?
zlib | 3 | spdx | TAG zlib
zlib | 3 | origin | the origin of this software must not be misrepresented
zlib | 2 | zlib | zlib(?: libpng)? LIC
libpng | 2 | libpng | libpng LIC
unlicense | 3 | spdx | TAG unlicense
unlicense | 3 | unencumbered | this is free and unencumbered software released into the public domain
unlicense | 3 | unlicense | (?:http |https )?unlicense org
unlicense | 2 | unlicense | (?:the )?unlicense
wtfpl | 3 | spdx | TAG wtfpl
wtfpl | 2 | wtfpl | wtfpl(?: VER2)?
wtfpl | 2 | fuck | do what the fuck you want to public LIC
beerware | 2 | beer | beer ?ware LIC
psf-2.0 | 3 | spdx | TAG (?:psf|python) 2 0
psf-2.0 | 2 | python | python software foundation LIC(?: VER2)?
php-3.01 | 3 | spdx | TAG php 3 01
php-3.01 | 2 | php | php LIC VER3 01
php-3.0 | 2 | php | php LIC VER3 0
ruby | 2 | ruby | ruby LIC
openssl | 2 | openssl | openssl LIC
w3c | 2 | w3c | w3c (?:software )?(?:notice and )?LIC
icu | 2 | icu | icu LIC
unicode | 2 | unicode | unicode (?:data files and software )?LIC
ncsa | 3 | spdx | TAG ncsa
ncsa | 2 | ncsa | ncsa (?:open source )?LIC
postgresql | 2 | postgresql | postgresql LIC
ms-pl | 3 | spdx | TAG ms pl
ms-pl | 2 | microsoft | microsoft public LIC
ms-rl | 2 | microsoft | microsoft reciprocal LIC
eupl-1.2 | 3 | spdx | TAG eupl 1 2
eupl-1.2 | 2 | european | european union public LIC VER1 2
eupl-1.1 | 2 | european | european union public LIC VER1 1
eupl | 1 | european | european union public LIC
eupl | 1 | eupl | eupl(?: LIC)?
cecill-2.1 | 2 | cecill | cecill(?: free software LIC)?(?: agreement)? VER2 1
cecill | 1 | cecill | cecill(?: LIC)?
osl-3.0 | 3 | spdx | TAG osl 3 0
osl-3.0 | 2 | open | open software LIC VER3(?: 0)?
afl-3.0 | 2 | academic | academic free LIC VER3(?: 0)?
afl-2.1 | 2 | academic | academic free LIC VER2 1
afl | 1 | academic | academic free LIC
ofl-1.1 | 3 | spdx | TAG ofl 1 1
ofl-1.1 | 3 | scripts | scripts sil org ofl
ofl-1.1 | 2 | sil | sil open font LIC(?: VER1 1)?
upl-1.0 | 2 | universal | universal permissive LIC(?: VER1(?: 0)?)?
vim | 2 | vim | vim LIC
qpl-1.0 | 2 | public | q public LIC
sleepycat | 2 | sleepycat | sleepycat LIC
blueoak-1.0.0 | 2 | oak | blue oak model LIC
hippocratic | 2 | hippocratic | hippocratic LIC
json | 3 | evil | the software shall be used for good not evil
odbl-1.0 | 3 | spdx | TAG odbl 1 0
odbl-1.0 | 3 | opendatacommons | opendatacommons org licenses odbl(?: 1 0)?
odbl-1.0 | 2 | database | open (?:data commons open )?database LIC(?: odbl)?(?: VER1 0)?
odc-by-1.0 | 3 | opendatacommons | opendatacommons org licenses by(?: 1 0)?
odc-by-1.0 | 2 | attribution | open data commons attribution LIC
pddl-1.0 | 2 | dedication | (?:open data commons )?public domain dedication and LIC
ogl-uk-3.0 | 2 | government | open government LIC VER3(?: 0)?
ogl-uk | 1 | government | open government LIC
cc0-1.0 | 3 | spdx | TAG cc0 1 0
cc0-1.0 | 3 | creativecommons | creativecommons org publicdomain zero 1 0
cc0-1.0 | 2 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 2 | zero | (?:creative commons|cc) zero(?: VER1 0)?
cc-by-nc-nd-4.0 | 3 | creativecommons | creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-3.0 | 3 | creativecommons | creativecommons org licenses by nc nd 3 0
cc-by-nc-sa-4.0 | 3 | creativecommons | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0 | 3 | creativecommons | creativecommons org licenses by nc sa 3 0
cc-by-nc-4.0 | 3 | creativecommons | creativecommons org licenses by nc 4 0
cc-by-nc-3.0 | 3 | creativecommons | creativecommons org licenses by nc 3 0
cc-by-nd-4.0 | 3 | creativecommons | creativecommons org licenses by nd 4 0
cc-by-sa-4.0 | 3 | creativecommons | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | 3 | creativecommons | creativecommons org licenses by sa 3 0
cc-by-4.0 | 3 | creativecommons | creativecommons org licenses by 4 0
cc-by-3.0 | 3 | creativecommons | creativecommons org licenses by 3 0
cc-by-nc-nd-4.0 | 2 | cc | cc by nc nd(?: VER4(?: 0)?)
cc-by-nc-sa-4.0 | 2 | cc | cc by nc sa(?: VER4(?: 0)?)
cc-by-nc-4.0 | 2 | cc | cc by nc(?: VER4(?: 0)?)
cc-by-nc-3.0 | 2 | cc | cc by nc(?: VER3(?: 0)?)
cc-by-nd-4.0 | 2 | cc | cc by nd(?: VER4(?: 0)?)
cc-by-sa-4.0 | 2 | cc | cc by sa(?: VER4(?: 0)?)
cc-by-sa-3.0 | 2 | cc | cc by sa(?: VER3(?: 0)?)
cc-by-4.0 | 2 | cc | cc by(?: VER4(?: 0)?)
cc-by-3.0 | 2 | cc | cc by(?: VER3(?: 0)?)
cc-by-2.0 | 2 | cc | cc by(?: VER2(?: 0)?)
cc-by-nc-nd-4.0 | 2 | commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)? 4 0(?: international)?(?: LIC)?
cc-by-nc-sa-4.0 | 2 | commons | creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: LIC)?
cc-by-nc-4.0 | 2 | commons | creative commons attribution non ?commercial 4 0(?: international)?(?: LIC)?
cc-by-nd-4.0 | 2 | commons | creative commons attribution no ?deriv(?:ative)?s? 4 0(?: international)?(?: LIC)?
cc-by-sa-4.0 | 2 | commons | creative commons attribution share ?alike 4 0(?: international)?(?: LIC)?
cc-by-sa-3.0 | 2 | commons | creative commons attribution share ?alike 3 0(?: unported)?(?: LIC)?
cc-by-4.0 | 2 | commons | creative commons attribution 4 0(?: international)?(?: LIC)?
cc-by-3.0 | 2 | commons | creative commons attribution 3 0(?: unported)?(?: LIC)?
cc-by-nc-nd | 1 | cc | cc by nc nd
cc-by-nc-sa | 1 | cc | cc by nc sa
cc-by-nc | 1 | cc | cc by nc
cc-by-nd | 1 | cc | cc by nd
cc-by-sa | 1 | cc | cc by sa
cc-by | 1 | cc | cc by
cc-by-nc-sa | 1 | commons | creative commons attribution non ?commercial share ?alike
cc-by-nc | 1 | commons | creative commons attribution non ?commercial
cc-by-sa | 1 | commons | creative commons attribution share ?alike
cc-by | 1 | commons | creative commons attribution(?: LIC)?
creative-commons | 1 | commons | creative commons(?: LIC)?
public-domain | 2 | domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 1 | domain | public domain
commercial | 2 | commercial | commercial LIC(?: agreement)?
commercial | 2 | eula | end user LIC agreement eula
commercial | 1 | user | end user LIC agreement
proprietary | 2 | proprietary | proprietary and confidential
proprietary | 2 | unauthorized | unauthorized (?:copying|reproduction|distribution|use)(?: [^ ]+){0,8} (?:is )?(?:strictly )?prohibited
proprietary | 1 | proprietary | proprietary (?:software|LIC|information)
non-commercial | 2 | noncommercial | for noncommercial (?:use|purposes) only
non-commercial | 2 | commercial | for non commercial (?:use|purposes) only
non-commercial | 2 | research | for research(?: and [^ ]+)? (?:use|purposes) only
non-commercial | 2 | academic | for academic(?: and [^ ]+)? (?:use|purposes) only
reserved | 2 | reserved | (?:c |copyright )?(?:19|20)[0-9]{2}(?: [^ ]+){1,6} all rights reserved
reserved | 1 | reserved | all rights reserved
reserved | 1 | reserved | some rights reserved
"""


def compiled() -> list[tuple[str, int, list[bytes], re.Pattern]]:
    """(label, tier, keywords, expression) of every rule, the expression between word borders."""
    out = []
    for line in RULES.strip().splitlines():
        label, tier, keywords, expression = [part.strip() for part in line.split(" | ")]
        for name, part in PARTS.items():
            expression = expression.replace(name, part)
        out.append((label, int(tier), [f" {k}".encode() for k in keywords.split()], re.compile(rf"(?<![^ ])(?:{expression})(?![^ ])".encode())))
    return out
