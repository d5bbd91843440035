"""Signature rules for licences, written for texts reduced to lower-case words with single spaces.

A line is ``label priority keyword: pattern``. The keyword is a word that every
match contains as a word, so a text without it skips the rule. Priority 1 is a notice or
grant, 2 a name with its version or an identifier, 3 a bare name, 4 a hint.
"""

from __future__ import annotations

WEIGHTS = {1: 1.0, 2: 0.9, 3: 0.6, 4: 0.3}

SIGNATURES = r"""
mit 1 mit: (?:released|licensed|distributed|available|provided|published) under (?:the )?(?:terms of the )?mit licen[cs]e
mit 1 permission: permission is hereby granted free of charge to any person obtaining a copy of this software
mit 1 noninfringement: merchantability fitness for a particular purpose and noninfringement in no event shall the authors
mit 2 mit: spdx license identifier mit
mit 2 opensource: opensource org licen[cs]es mit(?: license)?(?: php| html)?
mit 3 mit: (?:the )?mit (?:expat )?licen[cs]e
mit 3 mit: licen[cs]e mit
mit 3 expat: expat licen[cs]e
mit-0 2 mit: mit 0(?: license)?
mit-0 2 mit: mit no attribution
x11 3 x11: x11 licen[cs]e
x11 2 spdx: spdx license identifier x11
apache-2 1 apache: (?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?apache licen[cs]e version 2(?: 0)?
apache-2 1 compliance: you may not use this file except in compliance with the license .{0,120}apache org licenses license 2 0
apache-2 2 apache: apache licen[cs]e version 2(?: 0)?
apache-2 2 apache: apache (?:software )?licen[cs]e v?2(?: 0)?
apache-2 2 apache: apache 2 0(?: licen[cs]ed?)?
apache-2 2 apache: spdx license identifier apache 2 0
apache-2 2 apache: apache org licenses license 2 0(?: txt| html)?
apache-2 3 asl: asl 2 0
apache-1.1 2 apache: apache (?:software )?licen[cs]e (?:version |v)?1 1
apache-1.0 2 apache: apache (?:software )?licen[cs]e (?:version |v)?1 0
apache 3 apache: apache (?:software )?licen[cs]e
apache 4 asf: licensed to the asf under one or more contributor license agreements
bsd 1 redistributions: redistributions of source code must retain the above copyright notice
bsd 1 redistribution: redistribution and use in source and binary forms with or without modification are permitted
bsd-3 1 endorse: neither the name of .{1,100} may be used to endorse or promote products
bsd-3 2 bsd: bsd 3 clause(?: licen[cs]e)?
bsd-3 2 bsd: (?:3|three) clause bsd(?: licen[cs]e)?
bsd-3 2 bsd: (?:new|modified|revised) bsd licen[cs]e
bsd-3 2 bsd: opensource org licen[cs]es bsd 3 clause
bsd-2 2 bsd: bsd 2 clause(?: licen[cs]e)?
bsd-2 2 bsd: (?:2|two) clause bsd(?: licen[cs]e)?
bsd-2 2 bsd: (?:simplified|freebsd) bsd licen[cs]e
bsd-2 3 freebsd: freebsd licen[cs]e
bsd-2 2 bsd: opensource org licen[cs]es bsd 2 clause
bsd-4 1 advertising: all advertising materials mentioning features or use of this software must display
bsd-4 2 bsd: bsd 4 clause(?: licen[cs]e)?
bsd-4 2 bsd: (?:original|old) bsd licen[cs]e
bsd-0 2 0bsd: 0bsd
bsd-0 2 bsd: (?:zero|0) clause bsd
bsd 1 bsd: (?:released|licensed|distributed) under (?:the |a )?(?:terms of the )?bsd(?: style)? licen[cs]e
bsd 3 bsd: bsd (?:style )?licen[cs]e
isc 1 permission: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc 1 isc: (?:released|licensed|distributed) under (?:the )?(?:terms of the )?isc licen[cs]e
isc 2 isc: spdx license identifier isc
isc 3 isc: isc licen[cs]e
zlib 1 provided: this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib 2 zlib: spdx license identifier zlib
zlib 3 zlib: zlib(?: libpng)? licen[cs]e
libpng 3 libpng: libpng licen[cs]e(?: version 2)?
gpl-3 1 gnu: gnu general public licen[cs]e .{0,60}either version 3 (?:of the license )?or(?: at your option)? any later version
gpl-3 1 gnu: (?:released|licensed|distributed) under (?:the )?(?:terms of the )?gnu general public licen[cs]e (?:version |v)3
gpl-3 2 gnu: gnu general public licen[cs]e (?:version |v)?3(?: 0)?
gpl-3 2 gpl: (?:gnu )?gpl (?:version |v)?3(?: 0)?(?: only| or later)?
gpl-3 2 gplv3: (?:gnu )?gplv3
gpl-3 2 gpl3: (?:gnu )?gpl3
gpl-3 2 gpl: gnu org licen[cs]es gpl 3 0
gpl-2 1 gnu: gnu general public licen[cs]e .{0,60}either version 2 (?:of the license )?or(?: at your option)? any later version
gpl-2 1 gnu: (?:released|licensed|distributed) under (?:the )?(?:terms of the )?gnu general public licen[cs]e (?:version |v)2
gpl-2 2 gnu: gnu general public licen[cs]e (?:version |v)?2(?: 0)?
gpl-2 2 gpl: (?:gnu )?gpl (?:version |v)?2(?: 0)?(?: only| or later)?
gpl-2 2 gplv2: (?:gnu )?gplv2
gpl-2 2 gpl2: (?:gnu )?gpl2
gpl-2 2 gpl: gnu org licen[cs]es (?:old licenses )?gpl 2 0
gpl-1 2 gnu: gnu general public licen[cs]e (?:version |v)?1(?: 0)?
gpl 1 gnu: you should have received a copy of the gnu general public license
gpl 1 gnu: redistribute it and or modify it under the terms of the gnu general public license
gpl 3 gnu: gnu general public licen[cs]e
gpl 3 gpl: (?:gnu )?gpl licen[cs]ed?
gpl 3 gpl: under (?:the )?(?:gnu )?gpl
gpl 4 copyleft: copyleft licen[cs]e
gpl-classpath 2 classpath: classpath exception(?: 2 0)?
lgpl-3 2 gnu: gnu (?:lesser|library) general public licen[cs]e (?:version |v)?3(?: 0)?
lgpl-3 2 lgpl: (?:gnu )?lgpl (?:version |v)?3(?: 0)?(?: only| or later)?
lgpl-3 2 lgplv3: lgplv3
lgpl-2.1 2 gnu: gnu (?:lesser|library) general public licen[cs]e (?:version |v)?2 1
lgpl-2.1 2 lgpl: (?:gnu )?lgpl (?:version |v)?2 1(?: only| or later)?
lgpl-2.1 2 lgplv2: lgplv2 1
lgpl-2 2 gnu: gnu (?:lesser|library) general public licen[cs]e (?:version |v)?2(?: 0)?
lgpl-2 2 lgplv2: lgplv2
lgpl 1 gnu: under the terms of the gnu (?:lesser|library) general public license
lgpl 3 gnu: gnu (?:lesser|library) general public licen[cs]e
lgpl 3 lgpl: lgpl licen[cs]ed?
lgpl 3 lgpl: under (?:the )?(?:gnu )?lgpl
agpl-3 1 affero: under the terms of the gnu affero general public license .{0,60}version 3
agpl-3 2 affero: (?:gnu )?affero general public licen[cs]e (?:version |v)?3(?: 0)?
agpl-3 2 agpl: (?:gnu )?agpl (?:version |v)?3(?: 0)?(?: only| or later)?
agpl-3 2 agplv3: agplv3
agpl-1 2 affero: affero general public licen[cs]e (?:version |v)?1(?: 0)?
agpl 3 affero: (?:gnu )?affero general public licen[cs]e
agpl 3 agpl: agpl licen[cs]ed?
gfdl-1.3 2 documentation: gnu free documentation licen[cs]e (?:version |v)?1 3
gfdl-1.2 2 documentation: gnu free documentation licen[cs]e (?:version |v)?1 2
gfdl-1.1 2 documentation: gnu free documentation licen[cs]e (?:version |v)?1 1
gfdl 3 documentation: gnu free documentation licen[cs]e
gfdl 3 gfdl: gfdl
gfdl 4 invariant: no invariant sections no front cover texts
mpl-2 1 mozilla: this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2 2 mozilla: mozilla public licen[cs]e (?:version |v )?v?2(?: 0)?
mpl-2 2 mpl: mpl (?:version |v)?2(?: 0)?
mpl-2 2 mozilla: mozilla org mpl 2 0
mpl-1.1 2 mozilla: mozilla public licen[cs]e (?:version |v )?v?1 1
mpl-1.1 2 mpl: mpl (?:version |v)?1 1
mpl-1.0 2 mozilla: mozilla public licen[cs]e (?:version |v )?v?1 0
mpl 3 mozilla: mozilla public licen[cs]e
mpl 3 mpl: mpl licen[cs]ed?
npl 3 netscape: netscape public licen[cs]e
epl-2 2 eclipse: eclipse public licen[cs]e (?:version |v )?v?2(?: 0)?
epl-2 2 epl: epl (?:version |v)?2(?: 0)?
epl-1 2 eclipse: eclipse public licen[cs]e (?:version |v )?v?1(?: 0)?
epl-1 2 epl: epl (?:version |v)?1(?: 0)?
epl 3 eclipse: eclipse public licen[cs]e
edl-1 3 eclipse: eclipse distribution licen[cs]e(?: (?:version |v )?v?1(?: 0)?)?
cpl-1 3 common: common public licen[cs]e(?: (?:version |v)?1(?: 0)?)?
ipl-1 3 ibm: ibm public licen[cs]e(?: (?:version |v)?1(?: 0)?)?
cddl-1.1 2 cddl: cddl (?:version |v)?1 1
cddl-1.0 2 cddl: cddl (?:version |v)?1 0
cddl 3 development: common development and distribution licen[cs]e
cddl 3 cddl: cddl licen[cs]ed?
eupl-1.2 2 eupl: eupl (?:version |v)?1 2
eupl-1.1 2 eupl: eupl (?:version |v)?1 1
eupl 3 european: european union public licen[cs]e
artistic-2 2 artistic: artistic licen[cs]e (?:version |v)?2(?: 0)?
artistic-1 2 artistic: artistic licen[cs]e (?:version |v)?1(?: 0)?
artistic 3 artistic: artistic licen[cs]e
perl 3 perl: under the same terms as perl(?: itself)?
boost-1 1 boost: distributed under the boost software license version 1 0
boost-1 2 boost: boost software licen[cs]e(?: (?:version |v)?1(?: 0)?)?
boost-1 2 bsl: bsl 1 0
busl-1.1 2 business: business source licen[cs]e(?: (?:version |v)?1 1)?
busl-1.1 2 busl: busl 1 1
unlicense 1 unencumbered: this is free and unencumbered software released into the public domain
unlicense 2 unlicense: unlicense org
unlicense 3 unlicense: (?:the )?unlicense
wtfpl 2 wtfpl: wtfpl(?: version 2)?
wtfpl 2 fuck: do what the fuck you want to public license
cc0 1 commons: dedicated to the public domain .{0,60}creative commons
cc0 2 cc0: cc0(?: 1 0)?(?: universal)?
cc0 2 creativecommons: creativecommons org publicdomain zero 1 0
cc0 2 commons: creative commons zero
cc-pdm 2 creativecommons: creativecommons org publicdomain mark 1 0
cc-by 1 commons: (?:released|licensed|available|distributed) under (?:the |a )?creative commons attribution(?: \d 0)?(?: international| unported)? licen[cs]e
cc-by-4 2 cc: cc by 4 0
cc-by-3 2 cc: cc by 3 0
cc-by-2.5 2 cc: cc by 2 5
cc-by-2 2 cc: cc by 2 0
cc-by-4 2 commons: creative commons attribution 4 0(?: international)?
cc-by-3 2 commons: creative commons attribution 3 0(?: unported)?
cc-by 2 creativecommons: creativecommons org licen[cs]es by
cc-by 3 cc: cc by licen[cs]ed?
cc-by 3 commons: creative commons attribution(?: licen[cs]e)?
cc-by-sa-4 2 cc: cc by sa 4 0
cc-by-sa-3 2 cc: cc by sa 3 0
cc-by-sa-2 2 cc: cc by sa 2(?: 0| 5)
cc-by-sa 2 creativecommons: creativecommons org licen[cs]es by sa
cc-by-sa 2 commons: creative commons attribution share ?alike(?: \d 0)?
cc-by-sa 3 cc: cc by sa
cc-by-nd 2 creativecommons: creativecommons org licen[cs]es by nd
cc-by-nd 2 commons: creative commons attribution no ?derivat(?:ive|e)s?(?: works)?
cc-by-nd 3 cc: cc by nd
cc-by-nc-4 2 cc: cc by nc 4 0
cc-by-nc 2 creativecommons: creativecommons org licen[cs]es by nc
cc-by-nc 2 commons: creative commons attribution non ?commercial(?: \d 0)?
cc-by-nc 3 cc: cc by nc
cc-by-nc-sa 2 creativecommons: creativecommons org licen[cs]es by nc sa
cc-by-nc-sa 2 commons: creative commons attribution non ?commercial share ?alike(?: \d 0)?
cc-by-nc-sa 2 cc: cc by nc sa(?: \d 0)?
cc-by-nc-nd 2 creativecommons: creativecommons org licen[cs]es by nc nd
cc-by-nc-nd 2 commons: creative commons attribution non ?commercial no ?derivat(?:ive|e)s?(?: works)?(?: \d 0)?
cc-by-nc-nd 2 cc: cc by nc nd(?: \d 0)?
cc-sampling 2 commons: creative commons sampling plus
cc 4 commons: creative commons
cc 4 commons: some rights reserved creative commons
odbl-1 2 odbl: odbl(?: 1 0)?
odbl-1 2 database: open database licen[cs]e(?: (?:version |v)?1 0)?
odc-by-1 2 odc: odc by(?: 1 0)?
odc-by-1 2 commons: open data commons attribution licen[cs]e
pddl-1 2 pddl: pddl(?: 1 0)?
pddl-1 2 dedication: public domain dedication and licen[cs]e
cdla-permissive 2 cdla: cdla permissive(?: [12] 0)?
cdla-sharing 2 cdla: cdla sharing(?: 1 0)?
ogl-uk-3 2 government: open government licen[cs]e (?:version |v)?3(?: 0)?
ogl-uk 3 government: open government licen[cs]e
etalab-2 2 etalab: etalab (?:version |v)?2 0
etalab-2 2 ouverte: licence ouverte (?:version |v)?2 0
etalab 3 ouverte: licence ouverte
dl-de-by-2 2 dl: dl de by 2 0
dl-de-zero-2 2 dl: dl de zero 2 0
public-domain 1 domain: (?:released|dedicated|placed) (?:in)?to the public domain
public-domain 2 domain: (?:is|are) in the public domain
public-domain 3 domain: public domain
public-domain 2 gemeinfrei: gemeinfrei
public-domain 2 domaine: domaine public
public-domain 2 dominio: dominio p[uú]blico
ofl-1.1 2 font: sil open font licen[cs]e(?: (?:version |v)?1 1)?
ofl-1.1 2 ofl: ofl 1 1
ofl 3 font: open font licen[cs]e
ufl-1 3 ubuntu: ubuntu font licen[cs]e(?: 1 0)?
python-2 2 python: python software foundation licen[cs]e(?: version 2)?
python-2 2 psf: psf (?:licen[cs]e|2 0)
python 3 python: python licen[cs]e
php-3 2 php: php licen[cs]e (?:version |v)?3(?: 0[01]?)?
php 3 php: php licen[cs]e
ruby 3 ruby: ruby licen[cs]e
ruby 3 ruby: under the same terms as ruby
lua 3 lua: lua licen[cs]e
tcl 3 tcl: tcl(?: tk)? licen[cs]e
vim 3 vim: vim licen[cs]e
openssl 2 openssl: openssl licen[cs]e
openssl 1 openssl: this product includes software developed by the openssl project
curl 3 curl: curl licen[cs]e
postgresql 3 postgresql: postgresql licen[cs]e
icu 3 icu: icu licen[cs]e
unicode 3 unicode: unicode(?: inc)? licen[cs]e(?: agreement)?
w3c 2 w3c: w3c software (?:notice and )?(?:document )?licen[cs]e
w3c 3 w3c: w3c licen[cs]e
ms-pl 2 microsoft: microsoft public licen[cs]e
ms-pl 3 ms: ms pl
ms-rl 2 microsoft: microsoft reciprocal licen[cs]e
ms-rl 3 ms: ms rl
upl-1 2 universal: universal permissive licen[cs]e(?: (?:version |v)?1 0)?
upl-1 2 upl: upl 1 0
ncsa 3 ncsa: (?:university of illinois )?ncsa(?: open source)? licen[cs]e
afl-3 2 academic: academic free licen[cs]e (?:version |v)?3(?: 0)?
afl 3 academic: academic free licen[cs]e
osl-3 2 osl: osl 3 0
osl 3 open: open software licen[cs]e(?: (?:version |v)?\d(?: 0)?)?
qpl-1 3 qpl: qpl 1 0
qpl-1 3 public: q public licen[cs]e
sleepycat 3 sleepycat: sleepycat licen[cs]e
watcom-1 3 watcom: sybase open watcom public licen[cs]e
apsl-2 3 apple: apple public source licen[cs]e(?: (?:version |v)?2(?: 0)?)?
intel 3 intel: intel open source licen[cs]e
nasa-1.3 3 nasa: nasa open source agreement(?: 1 3)?
cecill-2.1 2 cecill: cecill (?:version |v)?2 1
cecill-b 2 cecill: cecill b
cecill-c 2 cecill: cecill c
cecill 3 cecill: cecill(?: licen[cs]e)?
mulan-2 2 mulan: mulan (?:psl|permissive software licen[cs]e)(?: (?:version |v)?2)?
blueoak-1 2 oak: blue oak model licen[cs]e(?: 1 0 0)?
hippocratic 3 hippocratic: hippocratic licen[cs]e(?: \d(?: \d)?)?
elastic-2 2 elastic: elastic licen[cs]e (?:version |v)?2(?: 0)?
elastic 3 elastic: elastic licen[cs]e
sspl-1 2 sspl: sspl(?: (?:version |v)?1(?: 0)?)?
sspl-1 2 server: server side public licen[cs]e(?: (?:version |v)?1(?: 0)?)?
commons-clause 2 clause: commons clause(?: licen[cs]e condition)?(?: (?:version |v)?1 0)?
polyform-nc 2 polyform: polyform noncommercial licen[cs]e(?: 1 0 0)?
polyform-shield 2 polyform: polyform shield licen[cs]e(?: 1 0 0)?
rail 2 rail: (?:creativeml |bigscience |bigcode )?open rail(?: [ms])?
rail 2 openrail: (?:creativeml |bigscience |bigcode )?openrail(?: [ms])?
rail 3 responsible: responsible ai licen[cs]e
beerware 2 beer: beer ware licen[cs]e
beerware 2 beerware: beerware(?: licen[cs]e)?
json 1 evil: shall be used for good not evil
json 3 json: json licen[cs]e
fair 3 fair: fair licen[cs]e
naumen 3 naumen: naumen public licen[cs]e
zpl-2 3 zope: zope public licen[cs]e(?: (?:version |v)?2(?: [01])?)?
imagemagick 3 imagemagick: imagemagick licen[cs]e
freetype 3 freetype: freetype (?:project )?licen[cs]e
ijg 1 jpeg: this software is based in part on the work of the independent jpeg group
latex-1.3 2 lppl: lppl (?:version |v)?1 3[abc]?
latex 3 latex: latex project public licen[cs]e(?: (?:version |v)?1 \d[abc]?)?
gutenberg 1 ebook: this ebook is for the use of anyone anywhere at no cost and with almost no restrictions
gutenberg 3 gutenberg: project gutenberg licen[cs]e
proprietary 1 confidential: confidential and proprietary
proprietary 1 proprietary: proprietary and confidential
proprietary 1 unauthorized: unauthorized (?:copying|reproduction|distribution|use) .{0,80}(?:strictly )?prohibited
proprietary 1 unauthorised: unauthorised (?:copying|reproduction|distribution|use) .{0,80}(?:strictly )?prohibited
proprietary 2 permission: (?:copying|reproduction|redistribution) .{0,60}without (?:prior |express )?(?:written )?permission .{0,30}prohibited
proprietary 3 proprietary: proprietary licen[cs]e
proprietary 3 eula: end user licen[cs]e agreement eula
proprietary 3 agreement: end user licen[cs]e agreement
all-rights-reserved 2 reserved: all rights reserved
all-rights-reserved 2 reservados: todos los derechos reservados
all-rights-reserved 2 réservés: tous droits réservés
all-rights-reserved 2 vorbehalten: alle rechte vorbehalten
some-rights-reserved 3 reserved: some rights reserved
copyright 4 copyright: copyright(?: c)? (?:19|20)\d\d(?: (?:19|20)\d\d)*
permissive 4 source: open source licen[cs]e
noncommercial 3 commercial: (?:for )?non commercial use only
noncommercial 3 noncommercial: (?:for )?noncommercial use only
research-only 3 research: (?:for )?research (?:use|purposes) only
academic-only 3 academic: (?:for )?academic (?:use|purposes) only
dual 4 dual: dual licen[cs]ed
other 4 licensed: licensed under (?:the |a )?[^ ]+(?: [^ ]+)? licen[cs]e
other 4 license: license identifier [^ ]+
"""


def rules() -> list[tuple[int, str, int, str, str]]:
    """``(number, label, priority, keyword, pattern)`` in order; patterns match between spaces."""
    found = []
    for number, line in enumerate(SIGNATURES.strip().split("\n")):
        head, _, pattern = line.partition(": ")
        label, priority, keyword = head.split(" ")
        found.append((number, label, int(priority), keyword, f"(?<= ){pattern}(?= )"))
    return found
