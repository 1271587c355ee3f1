"""Signature rules for license notices, most specific first within a family.

A line is ``keywords | label | weight | pattern``. Patterns run over lower-cased words with one space
between (so "GPL-3.0" reads "gpl 3 0"); a rule is tried only near one of its keywords, so whatever a pattern
matches must hold one of them as a whole word (tests/llm tries every alternative). GAP stands for up to eight words, LIC for license or its spellings. The weight is how sure the rule alone makes us.
"""

RULES_TEXT = r"""
apache | apache-2.0 | 0.98 | licensed under the apache license version 2 0
apache | apache-2.0 | 0.95 | (?:the )?apache (?:software )?LIC (?:version |v )?2(?: 0)?
apache | apache-2.0 | 0.95 | apache 2 0 LIC
apache | apache-2.0 | 0.95 | spdx license identifier apache 2 0
apache | apache-2.0 | 0.9 | www apache org licenses license 2 0
apache | apache-2.0 | 0.85 | asl 2 0 apache
apache | apache-2.0 | 0.8 | apache (?:v ?)?2(?: 0)?
asf | apache-2.0 | 0.8 | licensed to the apache software foundation asf under one or more
apache2 | apache-2.0 | 0.85 | apache2 LIC
apache | apache-1.1 | 0.95 | (?:the )?apache (?:software )?LIC (?:version |v )?1 1
apache | apache-1.1 | 0.95 | spdx license identifier apache 1 1
apache | apache-1.0 | 0.95 | (?:the )?apache (?:software )?LIC (?:version |v )?1 0
apache | apache-1.0 | 0.95 | spdx license identifier apache 1 0
apache | apache | 0.7 | (?:the )?apache (?:software )?LIC
mit | mit | 0.98 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?mit LIC
mit | mit | 0.95 | under the terms of the mit LIC
mit | mit | 0.95 | spdx license identifier mit
mit | mit | 0.9 | opensource org licenses mit(?: license)?
mit | mit | 0.9 | (?:the )?mit LIC(?: mit)?
mit | mit | 0.85 | mit style LIC
mit | mit | 0.8 | licen[sc]e mit
mit | mit | 0.8 | mit licensed
mit | mit-0 | 0.95 | (?:spdx license identifier )?mit 0 LIC
mit | mit-0 | 0.95 | mit no attribution
expat | mit | 0.9 | (?:the )?expat LIC
hereby | mit | 0.9 | permission is hereby granted free of charge to any person obtaining a copy GAP?
software | mit | 0.9 | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
x11 | x11 | 0.95 | spdx license identifier x11
x11 | x11 | 0.9 | (?:the )?x11 LIC
x11 | x11 | 0.85 | mit x11 LIC
bsd | bsd-3-clause-clear | 0.95 | (?:the )?(?:bsd 3 clause clear|clear bsd) LIC
bsd | bsd-3-clause-clear | 0.95 | spdx license identifier bsd 3 clause clear
bsd | bsd-4-clause | 0.95 | spdx license identifier bsd 4 clause
bsd | bsd-4-clause | 0.92 | (?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd) LIC
bsd | bsd-3-clause | 0.95 | spdx license identifier bsd 3 clause
bsd | bsd-3-clause | 0.92 | (?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd) LIC
bsd | bsd-3-clause | 0.85 | bsd 3 clause
bsd | bsd-2-clause | 0.95 | spdx license identifier bsd 2 clause
bsd freebsd | bsd-2-clause | 0.92 | (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd) LIC
bsd | bsd-2-clause | 0.85 | bsd 2 clause
0bsd | 0bsd | 0.95 | (?:spdx license identifier )?0bsd(?: LIC)?
bsd | 0bsd | 0.92 | (?:bsd zero clause|zero clause bsd|bsd 0 clause) LIC
bsd | bsd | 0.8 | (?:licensed |released |distributed )?under (?:the |a )?(?:terms of the )?bsd LIC
bsd | bsd | 0.75 | (?:the |a )?bsd(?: style)? LIC
bsd | bsd | 0.75 | bsd licensed
redistributions | bsd | 0.85 | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
redistributions | bsd | 0.85 | redistributions in binary form must reproduce the above copyright notice
redistribution | bsd | 0.85 | redistribution and use in source and binary forms with or without modification are permitted
endorse | bsd-3-clause | 0.85 | may be used to endorse or promote products derived from this software
affero | agpl-3.0-or-later | 0.97 | gnu affero general public LIC (?:version |v )?3(?: 0)? or (?:any later|\(?at your option\)? any later|later)
affero | agpl-3.0-only | 0.97 | gnu affero general public LIC (?:version |v )?3(?: 0)? only
affero | agpl-3.0 | 0.95 | (?:the )?(?:gnu )?affero (?:general public|gpl) LIC?(?: (?:version|v) ?3(?: 0)?)?
agpl | agpl-3.0-or-later | 0.95 | spdx license identifier agpl 3 0 or later
agpl | agpl-3.0-only | 0.95 | spdx license identifier agpl 3 0 only
agpl agpl3 agplv agplversion | agpl-3.0 | 0.93 | (?:gnu )?agpl ?(?:version |v )?3(?: 0)?
agplv3 | agpl-3.0 | 0.93 | (?:gnu )?agplv3(?: LIC)?
agpl | agpl | 0.8 | (?:gnu |the )?agpl LIC
affero | agpl-1.0 | 0.93 | affero general public LIC (?:version |v )?1(?: 0)?
lesser | lgpl-2.1-or-later | 0.97 | gnu lesser general public LIC GAP(?:version |v )?2 1 (?:of the license )?or (?:at your option )?any later version
lesser | lgpl-3.0-or-later | 0.97 | gnu lesser general public LIC GAP(?:version |v )?3(?: 0)? (?:of the license )?or (?:at your option )?any later version
lesser | lgpl-2.1 | 0.95 | (?:the )?(?:gnu )?lesser general public LIC (?:version |v )?2 1
lesser | lgpl-3.0 | 0.95 | (?:the )?(?:gnu )?lesser general public LIC (?:version |v )?3(?: 0)?
lesser | lgpl | 0.85 | (?:the )?(?:gnu )?lesser general public LIC
library | lgpl-2.0 | 0.95 | (?:the )?(?:gnu )?library general public LIC(?: (?:version |v )?2(?: 0)?)?
lgpl | lgpl-2.1-or-later | 0.95 | spdx license identifier lgpl 2 1 or later
lgpl | lgpl-2.1-only | 0.95 | spdx license identifier lgpl 2 1 only
lgpl | lgpl-3.0-or-later | 0.95 | spdx license identifier lgpl 3 0 or later
lgpl | lgpl-3.0-only | 0.95 | spdx license identifier lgpl 3 0 only
lgpl lgpl2 lgplv lgplversion | lgpl-2.1 | 0.92 | (?:gnu )?lgpl ?(?:version |v )?2 1
lgpl lgpl3 lgplv lgplversion | lgpl-3.0 | 0.92 | (?:gnu )?lgpl ?(?:version |v )?3(?: 0)?
lgpl lgpl2 lgplv lgplversion | lgpl-2.0 | 0.92 | (?:gnu )?lgpl ?(?:version |v )?2 0
lgplv3 | lgpl-3.0 | 0.92 | (?:gnu )?lgplv3(?: LIC)?
lgplv2 | lgpl-2.1 | 0.9 | (?:gnu )?lgplv2(?: 1)?(?: LIC)?
lgpl | lgpl | 0.8 | (?:gnu |the )?lgpl LIC
gnu | gpl-3.0-or-later | 0.97 | gnu general public LIC (?:version |v )?3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
gnu | gpl-3.0-or-later | 0.97 | gnu general public LIC GAPversion 3 of the license or at your option any later version
gnu | gpl-3.0-only | 0.97 | gnu general public LIC (?:version |v )?3(?: 0)? only
gnu | gpl-3.0 | 0.95 | (?:the )?gnu general public LIC (?:version |v )?3(?: 0)?
gnu | gpl-2.0-or-later | 0.97 | gnu general public LIC (?:version |v )?2(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
gnu | gpl-2.0-or-later | 0.97 | gnu general public LIC GAPversion 2 of the license or at your option any later version
gnu | gpl-2.0-only | 0.97 | gnu general public LIC (?:version |v )?2(?: 0)? only
gnu | gpl-2.0 | 0.95 | (?:the )?gnu general public LIC (?:version |v )?2(?: 0)?
gnu | gpl-1.0 | 0.95 | (?:the )?gnu general public LIC (?:version |v )?1(?: 0)?
gnu | gpl | 0.85 | (?:the )?gnu general public LIC
gpl | gpl-3.0-or-later | 0.95 | spdx license identifier gpl 3 0 or later
gpl | gpl-3.0-only | 0.95 | spdx license identifier gpl 3 0 only
gpl gpl3 gplv gplversion | gpl-3.0 | 0.92 | (?:gnu )?gpl ?(?:version |v )?3(?: 0)?
gpl | gpl-2.0-or-later | 0.95 | spdx license identifier gpl 2 0 or later
gpl | gpl-2.0-only | 0.95 | spdx license identifier gpl 2 0 only
gpl gpl2 gplv gplversion | gpl-2.0 | 0.92 | (?:gnu )?gpl ?(?:version |v )?2(?: 0)?
gplv3 | gpl-3.0 | 0.92 | (?:gnu )?gplv3(?: LIC)?
gplv2 | gpl-2.0 | 0.92 | (?:gnu )?gplv2(?: LIC)?
classpath | gpl-2.0-classpath | 0.93 | gpl ?(?:version |v )?2(?: 0)? with classpath exception
classpath | gpl-2.0-classpath | 0.9 | gnu classpath exception
gpl | gpl | 0.8 | (?:the |gnu )?gpl LIC
gpl | gpl | 0.75 | (?:licensed|released|distributed) under (?:the )?(?:terms of the )?gpl
gnu | gpl | 0.8 | see the gnu general public LIC for more details
gnu | gfdl-1.3 | 0.95 | gnu free documentation LIC (?:version |v )?1 3
gnu | gfdl-1.2 | 0.95 | gnu free documentation LIC (?:version |v )?1 2
gnu | gfdl-1.1 | 0.95 | gnu free documentation LIC (?:version |v )?1 1
gnu | gfdl | 0.9 | (?:the )?gnu free documentation LIC
gfdl | gfdl | 0.85 | (?:gnu )?gfdl(?: 1 [123])?
mozilla | mpl-2.0 | 0.95 | (?:the )?mozilla public LIC (?:version |v )?2(?: 0)?
mozilla | mpl-1.1 | 0.95 | (?:the )?mozilla public LIC (?:version |v )?1 1
mozilla | mpl-1.0 | 0.95 | (?:the )?mozilla public LIC (?:version |v )?1 0
mozilla | mpl | 0.85 | (?:the )?mozilla public LIC
mpl mpl2 mplv mplversion | mpl-2.0 | 0.93 | (?:spdx license identifier )?mpl ?(?:version |v )?2(?: 0)?
mpl mpl1 mplv mplversion | mpl-1.1 | 0.93 | (?:spdx license identifier )?mpl ?(?:version |v )?1 1
mpl | mpl-2.0 | 0.9 | mozilla org mpl 2 0
eclipse | epl-2.0 | 0.95 | (?:the )?eclipse public LIC (?:version |v )?2(?: 0)?
eclipse | epl-1.0 | 0.95 | (?:the )?eclipse public LIC (?:version |v )?1(?: 0)?
eclipse | epl | 0.85 | (?:the )?eclipse public LIC
eclipse | edl-1.0 | 0.93 | (?:the )?eclipse distribution LIC(?: (?:version |v )?1(?: 0)?)?
epl epl2 eplv eplversion | epl-2.0 | 0.92 | (?:spdx license identifier )?epl ?(?:version |v )?2(?: 0)?
epl epl1 eplv eplversion | epl-1.0 | 0.92 | (?:spdx license identifier )?epl ?(?:version |v )?1(?: 0)?
cddl cddl1 cddlv cddlversion | cddl-1.1 | 0.93 | (?:spdx license identifier )?cddl ?(?:version |v )?1 1
cddl cddl1 cddlv cddlversion | cddl-1.0 | 0.93 | (?:spdx license identifier )?cddl ?(?:version |v )?1(?: 0)?
distribution | cddl-1.1 | 0.95 | common development and distribution LIC (?:version |v )?1 1
distribution | cddl-1.0 | 0.95 | common development and distribution LIC(?: (?:version |v )?1(?: 0)?)?
common | cpl-1.0 | 0.93 | (?:the )?common public LIC(?: (?:version |v )?1(?: 0)?)?
attribution | cpal-1.0 | 0.93 | common public attribution LIC(?: (?:version |v )?1(?: 0)?)?
ibm | ipl-1.0 | 0.93 | ibm public LIC(?: (?:version |v )?1(?: 0)?)?
creative | cc-by-nc-nd-4.0 | 0.97 | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)? 4 0(?: international)?
creative | cc-by-nc-nd-3.0 | 0.97 | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)? 3 0(?: unported)?
creative | cc-by-nc-nd | 0.93 | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?
creative | cc-by-nc-sa-4.0 | 0.97 | creative commons attribution non ?commercial share ?alike 4 0(?: international)?
creative | cc-by-nc-sa-3.0 | 0.97 | creative commons attribution non ?commercial share ?alike 3 0(?: unported)?
creative | cc-by-nc-sa | 0.93 | creative commons attribution non ?commercial share ?alike
creative | cc-by-nc-4.0 | 0.96 | creative commons attribution non ?commercial 4 0(?: international)?
creative | cc-by-nc-3.0 | 0.96 | creative commons attribution non ?commercial 3 0(?: unported)?
creative | cc-by-nc | 0.92 | creative commons attribution non ?commercial
creative | cc-by-nd-4.0 | 0.96 | creative commons attribution no ?deriv(?:ative)?s?(?: works)? 4 0(?: international)?
creative | cc-by-nd-3.0 | 0.96 | creative commons attribution no ?deriv(?:ative)?s?(?: works)? 3 0(?: unported)?
creative | cc-by-nd | 0.92 | creative commons attribution no ?deriv(?:ative)?s?(?: works)?
creative | cc-by-sa-4.0 | 0.96 | creative commons attribution share ?alike 4 0(?: international)?
creative | cc-by-sa-3.0 | 0.96 | creative commons attribution share ?alike 3 0(?: unported)?
creative | cc-by-sa-2.5 | 0.96 | creative commons attribution share ?alike 2 5(?: generic)?
creative | cc-by-sa | 0.92 | creative commons attribution share ?alike
creative | cc-by-4.0 | 0.95 | creative commons attribution 4 0(?: international)?
creative | cc-by-3.0 | 0.95 | creative commons attribution 3 0(?: unported)?
creative | cc-by-2.5 | 0.95 | creative commons attribution 2 5(?: generic)?
creative | cc-by-2.0 | 0.95 | creative commons attribution 2 0(?: generic)?
creative | cc-by | 0.9 | creative commons attribution(?: LIC)?
creative | cc0-1.0 | 0.95 | creative commons (?:cc0|zero)(?: (?:version |v )?1 0)?(?: universal)?
creative | cc | 0.7 | (?:a |the )?creative commons LIC
cc | cc-by-nc-nd-4.0 | 0.95 | cc by nc nd 4 0
cc | cc-by-nc-nd-3.0 | 0.95 | cc by nc nd 3 0
cc | cc-by-nc-nd-2.5 | 0.95 | cc by nc nd 2 5
cc | cc-by-nc-nd | 0.9 | cc by nc nd
cc | cc-by-nc-sa-4.0 | 0.95 | cc by nc sa 4 0
cc | cc-by-nc-sa-3.0 | 0.95 | cc by nc sa 3 0
cc | cc-by-nc-sa-2.5 | 0.95 | cc by nc sa 2 5
cc | cc-by-nc-sa-2.0 | 0.95 | cc by nc sa 2 0
cc | cc-by-nc-sa | 0.9 | cc by nc sa
cc | cc-by-nc-4.0 | 0.95 | (?:licensed under )?cc by nc 4 0
cc | cc-by-nc-3.0 | 0.95 | (?:licensed under )?cc by nc 3 0
cc | cc-by-nc-2.5 | 0.95 | (?:licensed under )?cc by nc 2 5
cc | cc-by-nc-2.0 | 0.95 | (?:licensed under )?cc by nc 2 0
cc | cc-by-nc | 0.9 | cc by nc
cc | cc-by-nd-4.0 | 0.95 | cc by nd 4 0
cc | cc-by-nd-3.0 | 0.95 | cc by nd 3 0
cc | cc-by-nd | 0.9 | cc by nd
cc | cc-by-sa-4.0 | 0.95 | cc by sa 4 0
cc | cc-by-sa-3.0 | 0.95 | cc by sa 3 0
cc | cc-by-sa-2.5 | 0.95 | cc by sa 2 5
cc | cc-by-sa-2.0 | 0.95 | cc by sa 2 0
cc | cc-by-sa | 0.9 | cc by sa
cc | cc-by-4.0 | 0.93 | cc by 4 0
cc | cc-by-3.0 | 0.93 | cc by 3 0
cc | cc-by-2.5 | 0.93 | cc by 2 5
cc | cc-by-2.0 | 0.93 | cc by 2 0
cc | cc-by | 0.8 | (?:licensed under|license) (?:a )?cc by
cc0 | cc0-1.0 | 0.95 | (?:spdx license identifier )?cc0(?: 1 0)?(?: universal)?
creativecommons | cc0-1.0 | 0.93 | creativecommons org publicdomain zero 1 0
creativecommons | cc-by-nc-nd | 0.93 | creativecommons org licenses by nc nd(?: [1-4] [05])?
creativecommons | cc-by-nc-sa | 0.93 | creativecommons org licenses by nc sa(?: [1-4] [05])?
creativecommons | cc-by-nc | 0.92 | creativecommons org licenses by nc(?: [1-4] [05])?
creativecommons | cc-by-nd | 0.92 | creativecommons org licenses by nd(?: [1-4] [05])?
creativecommons | cc-by-sa | 0.92 | creativecommons org licenses by sa(?: [1-4] [05])?
creativecommons | cc-by | 0.9 | creativecommons org licenses by(?: [1-4] [05])?
isc | isc | 0.95 | spdx license identifier isc
isc | isc | 0.92 | (?:the )?isc LIC
fee | isc | 0.9 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
zlib | zlib | 0.95 | (?:spdx license identifier zlib|(?:the )?zlib(?: libpng)? LIC)
libpng | libpng | 0.92 | (?:the )?libpng LIC
boost | bsl-1.0 | 0.95 | (?:the )?boost software LIC(?: (?:version |v )?1 0)?
bsl | bsl-1.0 | 0.9 | spdx license identifier bsl 1 0
unlicense | unlicense | 0.95 | (?:spdx license identifier |the )?unlicense
unencumbered | unlicense | 0.93 | this is free and unencumbered software released into the public domain
wtfpl | wtfpl | 0.95 | (?:the )?wtfpl(?: LIC)?(?: version 2)?
fuck | wtfpl | 0.95 | do what the fuck you want to public LIC
artistic | artistic-2.0 | 0.95 | (?:the )?artistic LIC (?:version |v )?2(?: 0)?
artistic | artistic-1.0 | 0.93 | (?:the )?artistic LIC(?: (?:version |v )?1(?: 0)?)?
perl | artistic-perl | 0.88 | under the same terms as perl itself
python | psf-2.0 | 0.93 | python software foundation LIC(?: (?:version |v )?2(?: 0)?)?
psf | psf-2.0 | 0.9 | (?:the )?psf LIC(?: (?:version |v )?2(?: 0)?)?
openssl | openssl | 0.92 | (?:the )?openssl LIC
ssleay | openssl | 0.9 | (?:the )?(?:original )?ssleay LIC
font | ofl-1.1 | 0.95 | sil open font LIC(?: (?:version |v )?1 1)?
ofl | ofl-1.1 | 0.92 | (?:spdx license identifier )?ofl 1 1
eupl eupl1 euplv euplversion | eupl-1.2 | 0.93 | eupl ?(?:version |v )?1 2
eupl eupl1 euplv euplversion | eupl-1.1 | 0.93 | eupl ?(?:version |v )?1 1
european | eupl | 0.92 | european union public LIC(?: (?:version |v )?1 [12])?
microsoft | ms-pl | 0.93 | microsoft public LIC
microsoft | ms-rl | 0.93 | microsoft reciprocal LIC
ms | ms-pl | 0.88 | (?:spdx license identifier )?ms pl
ms | ms-rl | 0.88 | (?:spdx license identifier )?ms rl
open | osl-3.0 | 0.93 | open software LIC (?:version |v )?3 0
osl | osl-3.0 | 0.9 | spdx license identifier osl 3 0
academic | afl-3.0 | 0.93 | academic free LIC(?: (?:version |v )?3 0)?
afl | afl-3.0 | 0.9 | spdx license identifier afl 3 0
apple | apsl-2.0 | 0.93 | apple public source LIC(?: (?:version |v )?2 0)?
unicode | unicode-dfs | 0.9 | unicode LIC agreement(?: data files and software)?
unicode | unicode-3.0 | 0.9 | unicode LIC v3
w3c | w3c | 0.92 | w3c software (?:notice )?(?:and )?(?:document )?LIC
ncsa | ncsa | 0.92 | (?:university of illinois )?ncsa(?: open source)? LIC
postgresql | postgresql | 0.92 | (?:the )?postgresql LIC
php | php-3.01 | 0.93 | (?:the )?php LIC (?:version |v )?3 01
php | php | 0.85 | (?:the )?php LIC
ruby | ruby | 0.88 | (?:the )?ruby LIC
zope | zpl-2.1 | 0.92 | zope public LIC(?: (?:version |v )?2 1)?
vim | vim | 0.88 | (?:the )?vim LIC
sleepycat | sleepycat | 0.92 | (?:the )?sleepycat LIC
qt q | qpl-1.0 | 0.9 | (?:the )?(?:q|qt) public LIC(?: (?:version |v )?1 0)?
json | json | 0.88 | (?:the )?json LIC
evil | json | 0.93 | the software shall be used for good not evil
curl | curl | 0.88 | (?:the )?curl LIC
jpeg | ijg | 0.9 | independent jpeg group(?: s)? LIC
freetype | ftl | 0.9 | (?:the )?freetype (?:project )?LIC
database | odbl-1.0 | 0.93 | open database LIC(?: (?:version |v )?1 0)?
odbl | odbl-1.0 | 0.9 | odbl(?: (?:version |v )?1 0)?
odc | odc-by-1.0 | 0.9 | odc by(?: (?:version |v )?1 0)?
commons | odc-by-1.0 | 0.93 | open data commons attribution LIC
commons | pddl-1.0 | 0.93 | open data commons public domain dedication(?: and LIC)?
pddl | pddl-1.0 | 0.88 | pddl(?: 1 0)?
cecill | cecill-2.1 | 0.93 | cecill (?:free software )?(?:LIC )?(?:agreement )?(?:version |v )?2 1
cecill | cecill-b | 0.9 | cecill b
cecill | cecill-c | 0.9 | cecill c
cecill | cecill | 0.85 | cecill(?: LIC)?
beer | beerware | 0.92 | the beer ware LIC
beerware | beerware | 0.9 | (?:the )?beerware(?: LIC)?
oak | blueoak-1.0 | 0.92 | blue oak model LIC(?: 1 0 0)?
hpnd | hpnd | 0.88 | (?:spdx license identifier )?hpnd
historical | hpnd | 0.92 | historical permission notice and disclaimer
business | busl-1.1 | 0.93 | business source LIC(?: (?:version |v )?1 1)?
busl | busl-1.1 | 0.9 | busl 1 1
sspl | sspl-1.0 | 0.92 | sspl(?: (?:version |v )?1(?: 0)?)?
server | sspl-1.0 | 0.93 | server side public LIC(?: (?:version |v )?1)?
elastic | elastic-2.0 | 0.92 | elastic LIC(?: (?:version |v )?2 0)?
clause | commons-clause | 0.92 | commons clause LIC condition(?: v ?1 0)?
mulan | mulanpsl-2.0 | 0.92 | mulan (?:psl|permissive software LIC)(?: (?:version |v )?2)?
llama | llama-community | 0.88 | llama (?:2|3|3 1|3 2) community LIC
rail | openrail | 0.88 | (?:creativeml )?open rail m?(?: LIC)?
openrail | openrail | 0.88 | (?:creativeml |bigscience )?openrail(?: m)?(?: LIC)?
government | us-gov-pd | 0.85 | works? of the (?:united states|u s|us) government
domain | public-domain | 0.9 | (?:released|placed|dedicated) (?:in|into|to) the public domain
domain | public-domain | 0.85 | this work is in the public domain
domain | public-domain | 0.7 | public domain
rights | all-rights-reserved | 0.9 | copyright GAPall rights reserved
rights | all-rights-reserved | 0.8 | all rights reserved
reservados | all-rights-reserved | 0.85 | todos los derechos reservados
vorbehalten | all-rights-reserved | 0.85 | alle rechte vorbehalten
droits | all-rights-reserved | 0.85 | tous droits réservés
proprietary | proprietary | 0.85 | proprietary and confidential
proprietary | proprietary | 0.8 | (?:this is )?proprietary software
permission | proprietary | 0.85 | (?:may not|must not) be (?:reproduced|copied|distributed) without (?:the )?(?:prior )?(?:written )?permission
unauthorized | proprietary | 0.85 | unauthorized (?:copying|use|distribution|reproduction) (?:of this file )?(?:is )?(?:strictly )?prohibited
noncommercial | non-commercial | 0.7 | (?:for )?noncommercial use only
commercial | non-commercial | 0.7 | (?:for )?non commercial use only
commercial | commercial | 0.75 | (?:a )?commercial LIC (?:is )?(?:required|available)
copyright | copyright-notice | 0.5 | copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?
copyrighted | copyright-notice | 0.5 | copyrighted (?:material|work)
"""

GAP = r"(?:\S+ ){0,8}"
LIC = r"licen[sc]es?"


def gates() -> list[tuple[str, ...]]:
    """The keywords of each rule."""
    return [tuple(line.split(" | ", 1)[0].split()) for line in RULES_TEXT.strip().splitlines()]


def rules() -> list[tuple[str, str, float, str]]:
    """(first keyword, label, weight, pattern) in order of priority."""
    out = []
    for line, (keyword, *_) in zip(RULES_TEXT.strip().splitlines(), gates(), strict=True):
        _, label, weight, pattern = (x.strip() for x in line.split(" | ", 3))
        pattern = pattern.replace("GAP?", r"(?:\S+ ?){0,8}").replace("GAP", GAP).replace("LIC", LIC)
        out.append((keyword, label, float(weight), rf"(?<!\S)(?:{pattern})(?!\S)"))
    return out
