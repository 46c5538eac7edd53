"""Signature rules for licence texts, written over words of a lower-cased text.

A pattern is words with one space between; ``RULES`` has them as regular expressions over
the scanner's spaced text. ``?`` groups, alternatives and counted gaps are allowed, look-around
isn't, so that every engine reads them alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# label | keyword, which every reading of the name holds | name of the licence | its short identifiers, - for those of another line
FAMILIES = """
gpl-1.0 | gnu | gnu general public license (?:version |v ?)?1(?: 0)? | gpl 1 0(?: only| or later)?, gplv1
gpl-2.0 | gnu | gnu general public license (?:version |v ?)?2(?: 0)? | gpl 2 0(?: only| or later)?, gplv2
gpl-3.0 | gnu | gnu general public license (?:version |v ?)?3(?: 0)? | gpl 3 0(?: only| or later)?, gplv3
lgpl-2.0 | gnu | gnu library general public license(?: (?:version |v ?)?2(?: 0)?)? | lgpl 2 0(?: only| or later)?, lgplv2
lgpl-2.1 | gnu | gnu lesser general public license (?:version |v ?)?2 1 | lgpl 2 1(?: only| or later)?
lgpl-3.0 | gnu | gnu lesser general public license (?:version |v ?)?3(?: 0)? | lgpl 3 0(?: only| or later)?, lgplv3
agpl-3.0 | affero | gnu affero general public license(?: (?:version |v ?)?3(?: 0)?)? | agpl 3 0(?: only| or later)?, agplv3
gfdl-1.1 | gnu | gnu free documentation license (?:version |v ?)?1 1 | gfdl 1 1(?: only| or later)?
gfdl-1.2 | gnu | gnu free documentation license (?:version |v ?)?1 2 | gfdl 1 2(?: only| or later)?
gfdl-1.3 | gnu | gnu free documentation license (?:version |v ?)?1 3 | gfdl 1 3(?: only| or later)?
apache-1.0 | apache | apache (?:software )?license (?:version |v ?)?1 0 | apache 1 0
apache-1.1 | apache | apache (?:software )?license (?:version |v ?)?1 1 | apache 1 1
apache-2.0 | apache | apache (?:software )?license (?:version |v ?)?2(?: 0)? | apache 2 0
mit | mit | (?:the )?mit license | mit
mit | expat | (?:the )?expat license | -
mit-0 | mit | mit no attribution(?: license)? | mit 0
x11 | x11 | x11 license | x11
bsd-2-clause | bsd | (?:bsd 2 clause|2 clause bsd|simplified bsd)(?: simplified)? license | bsd 2 clause
bsd-2-clause | freebsd | freebsd(?: simplified)? license | -
bsd-3-clause | bsd | (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: new or revised)? license | bsd 3 clause
bsd-4-clause | bsd | (?:bsd 4 clause|4 clause bsd|original bsd)(?: original or old)? license | bsd 4 clause
bsd-0-clause | bsd | (?:zero clause bsd|bsd zero clause)(?: license)? | 0bsd
bsd-0-clause | 0bsd | 0bsd(?: license)? | -
isc | isc | isc license | isc
mpl-1.0 | mozilla | mozilla public license (?:version |v ?)?1 0 | mpl 1 0
mpl-1.1 | mozilla | mozilla public license (?:version |v ?)?1 1 | mpl 1 1
mpl-2.0 | mozilla | mozilla public license (?:version |v ?)?2(?: 0)? | mpl 2 0
epl-1.0 | eclipse | eclipse public license (?:version |v ?)?1(?: 0)? | epl 1 0
epl-2.0 | eclipse | eclipse public license (?:version |v ?)?2(?: 0)? | epl 2 0
cddl-1.0 | common | common development and distribution license(?: (?:version |v ?)?1 0)? | cddl 1 0
cddl-1.1 | common | common development and distribution license (?:version |v ?)?1 1 | cddl 1 1
cpl-1.0 | common | common public license(?: (?:version |v ?)?1 0)? | cpl 1 0
eupl-1.1 | european | european union public licen[cs]e (?:version |v ?)?1 1 | eupl 1 1
eupl-1.2 | european | european union public licen[cs]e (?:version |v ?)?1 2 | eupl 1 2
artistic-1.0 | artistic | artistic license (?:version |v ?)?1 0 | artistic 1 0
artistic-2.0 | artistic | artistic license (?:version |v ?)?2(?: 0)? | artistic 2 0
bsl-1.0 | boost | boost software license(?: (?:version |v ?)?1 0)? | bsl 1 0
busl-1.1 | business | business source license(?: (?:version |v ?)?1 1)? | busl 1 1
zlib | zlib | zlib(?: libpng)? license | zlib
unlicense | unlicense | (?:the )?unlicense | unlicense
wtfpl | wtfpl | wtfpl(?: (?:version |v ?)?2)? | wtfpl
python-2.0 | python | python software foundation license(?: (?:version |v ?)?2)? | python 2 0, psf 2 0
php-3.01 | php | php license(?: (?:version |v ?)?3 01)? | php 3 01
ruby | ruby | ruby license | ruby
postgresql | postgresql | postgresql licen[cs]e | postgresql
openssl | openssl | openssl license | openssl
ncsa | illinois | university of illinois(?: ncsa)? open source license | ncsa
ofl-1.1 | sil | sil open font license(?: (?:version |v ?)?1 1)? | ofl 1 1
lppl-1.3 | latex | latex project public license(?: (?:version |v ?)?1 3[abc]?)? | lppl 1 3[abc]?
ms-pl | microsoft | microsoft public license | ms pl
ms-rl | microsoft | microsoft reciprocal license | ms rl
osl-3.0 | open | open software license(?: (?:version |v ?)?3 0)? | osl 3 0
afl-3.0 | academic | academic free license(?: (?:version |v ?)?3 0)? | afl 3 0
ecl-2.0 | educational | educational community license(?: (?:version |v ?)?2 0)? | ecl 2 0
upl-1.0 | universal | universal permissive license(?: (?:version |v ?)?1 0)? | upl 1 0
sspl-1.0 | server | server side public license(?: (?:version |v ?)?1)? | sspl 1 0
elastic-2.0 | elastic | elastic license(?: (?:version |v ?)?2(?: 0)?)? | elastic 2 0
polyform-nc-1.0 | polyform | polyform noncommercial license(?: (?:version |v ?)?1 0 0)? | polyform noncommercial 1 0 0
mulan-psl-2.0 | mulan | mulan permissive software license(?: (?:version |v ?)?2)? | mulanpsl 2 0
blueoak-1.0 | blue | blue oak model license(?: (?:version |v ?)?1 0 0)? | blueoak 1 0 0
openrail | open | (?:creativeml )?open rail(?: ?m)? license | openrail
odbl-1.0 | open | open database license(?: (?:version |v ?)?1 0)? | odbl 1 0
odc-by-1.0 | open | open data commons attribution license(?: (?:version |v ?)?1 0)? | odc by 1 0
pddl-1.0 | public | public domain dedication and license(?: (?:version |v ?)?1 0)? | pddl 1 0
ogl-uk-3.0 | open | open government licen[cs]e(?: (?:version |v ?)?3 0)? | ogl uk 3 0
cdla-permissive | community | community data license agreement permissive(?: (?:version |v ?)?[12] 0)? | cdla permissive [12] 0
cdla-sharing | community | community data license agreement sharing(?: (?:version |v ?)?1 0)? | cdla sharing 1 0
cc0-1.0 | cc0 | cc0(?: (?:1 0|universal|public domain dedication))* | cc0 1 0
cc-by-1.0 | cc | cc by 1 0 | cc by 1 0
cc-by-2.0 | cc | cc by 2 0 | cc by 2 0
cc-by-2.5 | cc | cc by 2 5 | cc by 2 5
cc-by-3.0 | cc | cc by 3 0 | cc by 3 0
cc-by-4.0 | cc | cc by 4 0 | cc by 4 0
cc-by-sa | cc | cc by sa(?: [1234] [05])? | cc by sa [1234] [05]
cc-by-nd | cc | cc by nd(?: [1234] [05])? | cc by nd [1234] [05]
cc-by-nc | cc | cc by nc(?: [1234] [05])? | cc by nc [1234] [05]
cc-by-nc-sa | cc | cc by nc sa(?: [1234] [05])? | cc by nc sa [1234] [05]
cc-by-nc-nd | cc | cc by nc nd(?: [1234] [05])? | cc by nc nd [1234] [05]
"""

# label | priority | keyword | pattern: sentences and addresses that stand in the licences or point to them
PHRASES = """
mit | 3 | granted | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 3 | software | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
isc | 3 | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd-2-clause | 2 | redistributions | redistributions of source code must retain the above copyright notice
bsd-2-clause | 2 | redistributions | redistributions in binary form must reproduce the above copyright notice
bsd-3-clause | 3 | endorse | neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | 3 | advertising | all advertising materials mentioning features or use of this software must display the following acknowledgement
apache-2.0 | 3 | compliance | you may not use this file except in compliance with the license
apache-2.0 | 3 | apache | (?:www )?apache org licenses license 2 0(?: txt| html)?
apache-1.1 | 3 | apache | this product includes software developed by the apache software foundation
gpl | 2 | redistribute | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl-2.0 | 3 | version | (?:either )?version 2 of the license or at your option any later version
gpl-3.0 | 3 | version | (?:either )?version 3 of the license or at your option any later version
gpl | 1 | gnu | (?:www )?gnu org licenses gpl(?: html| txt)?
gpl-2.0 | 3 | gnu | gnu org licenses old licenses gpl 2 0(?: html| txt)?
gpl-3.0 | 3 | gnu | gnu org licenses gpl 3 0(?: html| txt)?
lgpl | 2 | redistribute | this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license
lgpl | 1 | gnu | gnu lesser general public license
agpl-3.0 | 3 | gnu | gnu org licenses agpl 3 0(?: html| txt)?
gfdl | 1 | gnu | gnu free documentation license
mpl-2.0 | 3 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | 3 | mozilla | mozilla org mpl 2 0
mpl | 1 | mozilla | mozilla public license
epl-2.0 | 3 | eclipse | eclipse org legal epl (?:2 0|v20)(?: html)?
epl | 1 | eclipse | eclipse public license
bsl-1.0 | 3 | boost | boost org license 1 0 txt
artistic | 1 | artistic | artistic license
bsd | 1 | bsd | bsd(?: style)? license
eupl | 1 | european | european union public licen[cs]e
unlicense | 3 | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | 3 | public | do what the fuck you want to public license
zlib | 3 | warranty | this software is provided as is without any express or implied warranty in no event will the authors be held liable
ofl-1.1 | 3 | sil | scripts sil org ofl
cc-by | 2 | creative | creative commons attribution(?: (?:international|unported|generic))?(?: licen[cs]e)?
cc-by-1.0 | 3 | creative | creative commons attribution 1 0(?: generic)?(?: licen[cs]e)?
cc-by-2.0 | 3 | creative | creative commons attribution 2 0(?: generic)?(?: licen[cs]e)?
cc-by-2.5 | 3 | creative | creative commons attribution 2 5(?: generic)?(?: licen[cs]e)?
cc-by-3.0 | 3 | creative | creative commons attribution 3 0(?: unported)?(?: licen[cs]e)?
cc-by-4.0 | 3 | creative | creative commons attribution 4 0(?: international)?(?: public)?(?: licen[cs]e)?
cc-by-sa | 3 | creative | creative commons attribution share ?alike(?: [1234] [05])?(?: (?:international|unported|generic))?(?: licen[cs]e)?
cc-by-nd | 3 | creative | creative commons attribution no ?deriv(?:ative)?s(?: [1234] [05])?(?: (?:international|unported|generic))?(?: licen[cs]e)?
cc-by-nc | 3 | creative | creative commons attribution non ?commercial(?: [1234] [05])?(?: (?:international|unported|generic))?(?: licen[cs]e)?
cc-by-nc-sa | 3 | creative | creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: (?:international|unported|generic))?(?: licen[cs]e)?
cc-by-nc-nd | 3 | creative | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] [05])?(?: (?:international|unported|generic))?(?: licen[cs]e)?
cc-by-1.0 | 3 | creativecommons | creativecommons org licenses by 1 0
cc-by-2.0 | 3 | creativecommons | creativecommons org licenses by 2 0
cc-by-2.5 | 3 | creativecommons | creativecommons org licenses by 2 5
cc-by-3.0 | 3 | creativecommons | creativecommons org licenses by 3 0
cc-by-4.0 | 3 | creativecommons | creativecommons org licenses by 4 0
cc-by-sa | 3 | creativecommons | creativecommons org licenses by sa(?: [1234] [05])?
cc-by-nd | 3 | creativecommons | creativecommons org licenses by nd(?: [1234] [05])?
cc-by-nc | 3 | creativecommons | creativecommons org licenses by nc(?: [1234] [05])?
cc-by-nc-sa | 3 | creativecommons | creativecommons org licenses by nc sa(?: [1234] [05])?
cc-by-nc-nd | 3 | creativecommons | creativecommons org licenses by nc nd(?: [1234] [05])?
cc0-1.0 | 3 | creativecommons | creativecommons org publicdomain zero 1 0
public-domain | 1 | public | (?:dedicated|released|placed) (?:to|into|in) the public domain
mit | 3 | opensource | opensource org licenses mit(?: license)?(?: php| html)?
bsd-2-clause | 3 | opensource | opensource org licenses bsd 2 clause
bsd-3-clause | 3 | opensource | opensource org licenses bsd 3 clause
apache-2.0 | 3 | opensource | opensource org licenses apache 2 0
all-rights-reserved | 1 | reserved | all rights reserved
proprietary | 2 | proprietary | (?:proprietary and confidential|confidential and proprietary)
no-redistribution | 2 | redistribution | redistribution (?:of this (?:work|text|software) )?is (?:strictly )?(?:prohibited|not permitted)
"""

#: Base phrases and their labels.
BASE = """
gpl | license | gnu general public license
apache | license | apache license
cc-by | cc | cc by
mit | license | mit license
"""

NOTICE = "(?:released|licen[cs]ed|distributed|available|provided|published|shared|covered) (?:under|by) (?:the )?(?:terms of )?(?:the )?{}"
TAG = "spdx license identifier {}"
TAIL = "{} licen[cs]e text"


@dataclass(frozen=True)
class Rule:
    """``regex`` runs over text whose words each have a space on both sides.

    ``gate`` is a piece of text without which neither keyword nor regex can match.
    """

    number: int
    label: str
    keyword: str
    regex: str
    priority: int
    base: bool

    @property
    def gate(self) -> str:
        plain = self.regex
        while (shorter := re.sub(r"\(\?:[^()]*\)[?*]", "", plain)) != plain:  # what may be absent
            plain = shorter
        return "licen" if "licen" in re.sub(r"\(\?:[^()]*\|[^()]*\)", "", plain) else self.keyword.strip()


def _cells(line: str, count: int) -> list[str]:
    """Cells between bars that stand alone; bars inside a pattern have no space around them."""
    return [c.strip() for c in line.split(" | ", count - 1)]


def _spaced(pattern: str) -> str:
    """A pattern over words as one over spaced words: every space between words is two."""
    return " " + pattern.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?") + " "


def build() -> list[Rule]:
    """All rules in order: base, licence names in four forms, phrases."""
    made: list[tuple[str, str, str, int, bool]] = []
    for line in BASE.strip().splitlines():
        label, keyword, phrase = _cells(line, 3)
        made.append((label, keyword, phrase, 1, True))
    for line in FAMILIES.strip().splitlines():
        label, keyword, name, short = _cells(line, 4)
        made.append((label, keyword, name, 2, False))
        made.append((label, keyword, NOTICE.format(f"(?:{name})"), 3, False))
        made.append((label, keyword, TAIL.format(f"(?:{name})"), 3, False))
        if short != "-":
            tags = "|".join(f"(?:{t})" for t in short.split(", "))
            made.append((label, "spdx", TAG.format(f"(?:{tags})"), 3, False))
    for line in PHRASES.strip().splitlines():
        label, priority, keyword, pattern = _cells(line, 4)
        made.append((label, keyword, pattern, int(priority), False))
    return [Rule(i, label, f" {k} ", _spaced(p), rank, base) for i, (label, k, p, rank, base) in enumerate(made)]


RULES = build()
