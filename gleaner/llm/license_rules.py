"""Signature rules of licence statements, written by hand, one a line: label | priority | keyword | pattern.

A pattern is matched against the words of a text: lower-case ASCII letters, digits and non-ASCII characters, joined by
single spaces ("Version 2.0" reads "version 2 0"). It begins and ends at word edges and has no open-ended gap. The
keyword is a word that every match holds; a text without it is never matched. ``{v}`` stands for an optional "version",
``{lic}`` for either spelling, ``{gap}`` for at most six words. ``\\1`` in a label is what the pattern's group matched.

Priorities: 3 a passage of a licence's own text, 2 a notice with a version or the full name, 1 a name, 0 a bare mention.
"""

from __future__ import annotations

import re
from typing import NamedTuple

MACROS = {"{v}": " (?:version |ver |v ?)?", "{lic}": "licen[cs]es?", "{gap}": "(?: [^ ]+){0,6}"}
# The share of certainty that a kept detection of each priority adds.
WEIGHTS = {0: 0.3, 1: 0.5, 2: 0.8, 3: 0.95}

_RULES = r"""
mit | 3 | hereby | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 3 | copies | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | 2 | mit | (?:released|licensed|distributed|available|published|provided|made available) under the(?: terms of the)? mit {lic}
mit | 2 | mit | spdx {lic} identifier mit
mit | 2 | mit | the mit {lic} mit
mit | 2 | mit | {lic} mit
mit | 1 | mit | mit {lic}
mit-0 | 2 | mit | mit no attribution(?: {lic})?
mit-0 | 2 | mit | (?:spdx {lic} identifier )?mit 0
mit-modern-variant | 2 | mit | mit {lic} modern variant
x11 | 2 | x11 | (?:the )?x11 {lic}
x11 | 3 | consortium | except as contained in this notice the name of the x consortium shall not be used
expat | 2 | expat | (?:the )?expat {lic}
isc | 3 | purpose | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
isc | 2 | isc | (?:released|licensed|distributed) under the isc {lic}
isc | 2 | isc | spdx {lic} identifier isc
isc | 1 | isc | isc {lic}
0bsd | 2 | 0bsd | (?:spdx {lic} identifier )?0bsd
0bsd | 2 | clause | (?:zero|0) clause bsd(?: {lic})?
bsd-1-clause | 2 | clause | bsd (?:1|one) clause(?: {lic})?
bsd-2-clause | 2 | clause | (?:bsd (?:2|two) clause|(?:2|two) clause bsd)(?: {lic})?
bsd-2-clause | 2 | simplified | simplified bsd {lic}
bsd-2-clause | 2 | freebsd | freebsd {lic}
bsd-3-clause | 2 | clause | (?:bsd (?:3|three) clause|(?:3|three) clause bsd)(?: {lic})?
bsd-3-clause | 2 | revised | (?:new or )?revised bsd {lic}
bsd-3-clause | 3 | endorse | neither the name of{gap} nor the names of (?:its|his|their) contributors may be used to endorse or promote products
bsd-4-clause | 2 | clause | (?:bsd (?:4|four) clause|(?:4|four) clause bsd)(?: {lic})?
bsd-4-clause | 3 | acknowledgement | all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-4-clause | 2 | original | original bsd {lic}
bsd-protection | 2 | protection | bsd protection {lic}
bsd | 3 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd | 3 | redistributions | redistributions (?:of source code|in binary form) must (?:retain|reproduce) the above copyright notice
bsd | 1 | bsd | bsd(?: style)? {lic}
apache-2.0 | 2 | apache | (?:licensed|released|distributed|available) under the apache {lic}{v}2(?: 0)?
apache-2.0 | 2 | apache | apache {lic}{v}2(?: 0)?
apache-2.0 | 2 | apache | apache(?: software)?(?: foundation)?(?: {lic})? 2 0
apache-2.0 | 2 | apache | spdx {lic} identifier apache 2 0
apache-2.0 | 2 | asl | asl 2 0
apache-2.0 | 3 | compliance | you may not use this file except in compliance with the {lic}
apache-2.0 | 3 | www | you may obtain a copy of the {lic} at https? www apache org {lic} {lic} 2 0
apache-2.0 | 3 | perpetual | perpetual worldwide non exclusive no charge royalty free irrevocable copyright {lic}
apache-1.1 | 2 | apache | apache(?: software)? {lic}{v}1 1
apache-1.0 | 2 | apache | apache(?: software)? {lic}{v}1 0
apache-llvm-exception | 2 | llvm | apache(?: {lic})?{v}2 0 with llvm exceptions?
apache | 1 | apache | apache(?: software)? {lic}
gpl-1.0 | 2 | gnu | gnu general public {lic}{v}1(?: 0)?
gpl-2.0 | 2 | gnu | gnu general public {lic}{v}2(?: 0)?
gpl-2.0 | 2 | gplv2 | gplv2(?: 0)?
gpl-2.0 | 2 | gpl | gpl{v}2(?: 0)?(?: only)?
gpl-2.0 | 2 | spdx | spdx {lic} identifier gpl 2 0(?: only)?
gpl-2.0-or-later | 2 | gnu | gnu general public {lic}{gap} either version 2 of the {lic} or(?: at your option)? any later version
gpl-2.0-or-later | 2 | gpl | gpl 2 0 or later
gpl-2.0-or-later | 2 | gplv2 | gplv2 or later
gpl-2.0-classpath | 2 | classpath | gpl{gap} with(?: the)? classpath exception
gpl-3.0 | 2 | gnu | gnu general public {lic}{v}3(?: 0)?
gpl-3.0 | 2 | gplv3 | gplv3(?: 0)?
gpl-3.0 | 2 | gpl | gpl{v}3(?: 0)?(?: only)?
gpl-3.0 | 2 | spdx | spdx {lic} identifier gpl 3 0(?: only)?
gpl-3.0-or-later | 2 | gnu | gnu general public {lic}{gap} either version 3 of the {lic} or(?: at your option)? any later version
gpl-3.0-or-later | 2 | gpl | gpl 3 0 or later
gpl-3.0-or-later | 2 | gplv3 | gplv3 or later
gpl-3.0-gcc-exception | 2 | gcc | gcc runtime library exception
gnu-gpl | 1 | gnu | gnu general public {lic}
gnu-gpl | 1 | gnu | gnu gpl
gnu-gpl | 3 | redistribute | you can redistribute it and or modify it under the terms of the gnu general public {lic}
gnu-gpl | 3 | merchantability | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu
gnu-gpl | 3 | along | you should have received a copy of the gnu general public {lic} along with this (?:program|software)
lgpl-2.0 | 2 | library | gnu library general public {lic}{v}2(?: 0)?
lgpl-2.1 | 2 | lesser | (?:gnu )?lesser general public {lic}{v}2 1
lgpl-2.1 | 2 | lgpl | lgpl{v}2 1(?: only| or later)?
lgpl-2.1 | 2 | lgplv2 | lgplv2 1
lgpl-3.0 | 2 | lesser | (?:gnu )?lesser general public {lic}{v}3(?: 0)?
lgpl-3.0 | 2 | lgpl | lgpl{v}3(?: 0)?(?: only| or later)?
lgpl-3.0 | 2 | lgplv3 | lgplv3
lgpl | 1 | lesser | (?:gnu )?lesser general public {lic}
lgpl | 1 | library | gnu library general public {lic}
lgpl | 1 | lgpl | (?:gnu )?lgpl
agpl-3.0 | 2 | affero | (?:gnu )?affero general public {lic}{v}3(?: 0)?
agpl-3.0 | 2 | agpl | agpl{v}3(?: 0)?(?: only| or later)?
agpl-3.0 | 2 | agplv3 | agplv3
agpl-1.0 | 2 | affero | affero general public {lic}{v}1(?: 0)?
agpl | 1 | affero | (?:gnu )?affero general public {lic}
gfdl-\1.\2 | 2 | documentation | (?:gnu )?free documentation {lic}{v}(1) ([123])
gfdl | 1 | documentation | gnu free documentation {lic}
gfdl | 1 | gfdl | gfdl
gnu-all-permissive | 3 | preserved | copying and distribution of this file with or without modification are permitted in any medium without royalty provided the copyright notice and this notice are preserved
mpl-\1.\2 | 2 | mozilla | mozilla public {lic}{v}([12]) ([01])
mpl-\1.\2 | 2 | mpl | mpl{v}([12]) ([01])
mpl-2.0 | 3 | mpl | this source code form is subject to the terms of the mozilla public {lic}{gap} if a copy of the mpl was not distributed
mpl | 1 | mozilla | mozilla public {lic}
npl-1.1 | 2 | netscape | netscape public {lic}(?:{v}1 [01])?
epl-\1.0 | 2 | eclipse | eclipse public {lic}{v}([12])(?: 0)?
epl-\1.0 | 2 | epl | epl{v}([12])(?: 0)?
epl | 1 | eclipse | eclipse public {lic}
edl-1.0 | 2 | eclipse | eclipse distribution {lic}(?:{v}1 0)?
cddl-1.\1 | 2 | cddl | cddl{v}1 ([01])
cddl | 2 | distribution | common development and distribution {lic}(?:{v}1 [01])?
cpl-1.0 | 2 | common | common public {lic}(?:{v}1 0)?
cpal-1.0 | 2 | attribution | common public attribution {lic}(?:{v}1 0)?
ipl-1.0 | 2 | ibm | ibm public {lic}(?:{v}1 0)?
apsl-\1.\2 | 2 | apple | apple public source {lic}{v}([12]) ([012])
apsl | 1 | apple | apple public source {lic}
artistic-\1.0 | 2 | artistic | artistic {lic}{v}([12])(?: 0)?
artistic | 1 | artistic | (?:perl )?artistic {lic}
clarified-artistic | 2 | clarified | clarified artistic {lic}
perl | 2 | perl | under the same terms as perl(?: itself)?
ruby | 2 | ruby | (?:the )?ruby {lic}
python-2.0 | 2 | python | python(?: software foundation)? {lic}(?:{v}2(?: 0)?)?
psf-2.0 | 2 | psf | psf {lic}(?: agreement)?(?:{v}2)?
php-3.0\1 | 2 | php | php {lic}{v}3 0(1?)
php | 1 | php | php {lic}
zend-2.0 | 2 | zend | zend(?: engine)? {lic}(?:{v}2 0)?
zlib | 2 | zlib | (?:the )?zlib(?: libpng)? {lic}
zlib | 3 | misrepresented | the origin of this software must not be misrepresented
zlib | 3 | altered | altered source versions must be plainly marked as such
libpng | 2 | libpng | libpng {lic}(?:{v}2)?
libpng | 2 | png | png reference library {lic}(?:{v}2)?
boost-1.0 | 2 | boost | boost software {lic}(?:{v}1 0)?
boost-1.0 | 2 | bsl | bsl 1 0
openssl | 2 | openssl | openssl {lic}
openssl | 3 | toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
ssleay | 2 | ssleay | (?:original )?ssleay {lic}
curl | 2 | curl | curl {lic}
vim | 2 | vim | vim {lic}
ncsa | 2 | illinois | university of illinois(?: ncsa)? open source {lic}
ncsa | 2 | ncsa | ncsa(?: open source)? {lic}
ms-pl | 2 | microsoft | microsoft public {lic}
ms-pl | 2 | ms | ms pl
ms-rl | 2 | microsoft | microsoft reciprocal {lic}
ms-lpl | 2 | microsoft | microsoft limited public {lic}
eupl-1.\1 | 2 | eupl | eupl{v}1 ([012])
eupl | 2 | european | european union public {lic}(?:{v}1 [012])?
cecill-\1 | 2 | cecill | cecill (b|c)(?: {lic})?
cecill-2.\1 | 2 | cecill | cecill{v}2 ([01])
cecill | 1 | cecill | cecill(?: {lic})?
etalab-2.0 | 2 | etalab | etalab(?: open {lic})?{v}2 0
etalab-2.0 | 2 | ouverte | licence ouverte{v}2 0
ogl-\1.0 | 2 | government | open government {lic}{v}([123])(?: 0)?
ogl | 1 | government | open government {lic}
osl-\1.\2 | 2 | osl | osl{v}([123]) ([01])
osl-3.0 | 2 | open | open software {lic}{v}3 0
afl-\1.\2 | 2 | academic | academic free {lic}{v}([123]) ([012])
afl | 1 | academic | academic free {lic}
ecl-2.0 | 2 | educational | educational community {lic}(?:{v}2 0)?
upl-1.0 | 2 | universal | universal permissive {lic}(?:{v}1 0)?
unlicense | 2 | unlicense | (?:the )?unlicense
unlicense | 3 | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | 2 | wtfpl | wtfpl(?:{v}2)?
wtfpl | 2 | want | do what the f[^ ]* you want to public {lic}
beerware | 2 | beerware | beerware(?: {lic})?
beerware | 3 | beer | you can buy me a beer in return
json | 3 | evil | the software shall be used for good not evil
json | 2 | json | json {lic}
postgresql | 2 | postgresql | postgresql {lic}
sleepycat | 2 | sleepycat | sleepycat {lic}
w3c | 2 | w3c | w3c software(?: notice)?(?: and)?(?: document)? {lic}
unicode-dfs | 2 | unicode | unicode {lic}(?: agreement)?(?: data files and software)?
icu | 2 | icu | icu {lic}
ofl-1.\1 | 2 | sil | sil open font {lic}{v}1 ([01])
ofl-1.\1 | 2 | ofl | ofl{v}1 ([01])
ofl | 1 | font | open font {lic}
lppl-1.3c | 2 | lppl | lppl{v}1 3 ?c
lppl | 2 | latex | latex project public {lic}(?:{v}1 [0-3] ?[ac]?)?
qpl-1.0 | 2 | qpl | qpl(?:{v}1 0)?
qpl-1.0 | 2 | public | q public {lic}(?:{v}1 0)?
ftl | 2 | freetype | freetype(?: project)? {lic}
ijg | 2 | ijg | ijg {lic}
ijg | 3 | jpeg | this software is based in part on the work of the independent jpeg group
tcl | 2 | tcl | tcl(?: tk)? {lic}
imagemagick | 2 | imagemagick | imagemagick {lic}
hpnd | 2 | hpnd | hpnd
hpnd | 2 | historical | historical permission notice and disclaimer
naist-2003 | 2 | naist | naist {lic}
mulan-psl-\1.0 | 2 | mulan | mulan(?: permissive software {lic}| psl){v}([12])(?: 0)?
blueoak-1.0.0 | 2 | blue | blue oak model {lic}(?:{v}1 0 0)?
parity-7.0 | 2 | parity | parity public {lic}(?:{v}7 0)?
polyform-\1 | 2 | polyform | polyform (noncommercial|shield|strict|perimeter)(?: {lic})?
sspl-1.0 | 2 | sspl | sspl(?:{v}1(?: 0)?)?
sspl-1.0 | 2 | server | server side public {lic}(?:{v}1(?: 0)?)?
busl-1.1 | 2 | business | business source {lic}(?:{v}1 1)?
elastic-2.0 | 2 | elastic | elastic {lic}{v}2(?: 0)?
commons-clause | 2 | commons | commons clause(?: {lic})?(?: condition)?
confluent-1.0 | 2 | confluent | confluent community {lic}(?:{v}1 0)?
prosperity-3.0 | 2 | prosperity | prosperity public {lic}
hippocratic | 2 | hippocratic | hippocratic {lic}
openrail-m | 2 | openrail | (?:creativeml |bigscience )?openrail(?: m)?(?: {lic})?
llama-community | 2 | llama | llama (?:[234] )?(?:[0-9] )?community {lic}
odbl-1.0 | 2 | odbl | odbl(?:{v}1 0)?
odbl-1.0 | 2 | database | open database {lic}(?:{v}1 0)?
odc-by-1.0 | 2 | commons | open data commons attribution {lic}(?:{v}1 0)?
pddl-1.0 | 2 | pddl | pddl(?:{v}1 0)?
pddl-1.0 | 2 | dedication | public domain dedication and {lic}
cdla-permissive-\1.0 | 2 | cdla | cdla permissive{v}([12])(?: 0)?
cdla-sharing-1.0 | 2 | cdla | cdla sharing(?:{v}1 0)?
cc0-1.0 | 2 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 2 | zero | creative commons zero(?:{v}1 0)?
cc0-1.0 | 3 | waive | waive all copyright and related or neighboring rights
cc-by-\1.\2 | 2 | cc | cc by{v}([1-4]) ([05])
cc-by-sa-\1.\2 | 2 | cc | cc by sa{v}([1-4]) ([05])
cc-by-sa | 1 | cc | cc by sa
cc-by-nc-\1.\2 | 2 | cc | cc by nc{v}([1-4]) ([05])
cc-by-nc | 1 | cc | cc by nc
cc-by-nd-\1.\2 | 2 | cc | cc by nd{v}([1-4]) ([05])
cc-by-nd | 1 | cc | cc by nd
cc-by-nc-sa-\1.\2 | 2 | cc | cc by nc sa{v}([1-4]) ([05])
cc-by-nc-sa | 1 | cc | cc by nc sa
cc-by-nc-nd-\1.\2 | 2 | cc | cc by nc nd{v}([1-4]) ([05])
cc-by-nc-nd | 1 | cc | cc by nc nd
cc-by-\1.\2 | 2 | attribution | creative commons attribution{v}([1-4]) ([05])(?: international| unported| generic)?(?: {lic})?
cc-by-sa-\1.\2 | 2 | sharealike | creative commons attribution sharealike{v}([1-4]) ([05])(?: international| unported| generic)?(?: {lic})?
cc-by-sa | 1 | alike | creative commons attribution share alike(?: {lic})?
cc-by-nc-\1.\2 | 2 | noncommercial | creative commons attribution noncommercial{v}([1-4]) ([05])(?: international| unported| generic)?(?: {lic})?
cc-by-nd-\1.\2 | 2 | noderivatives | creative commons attribution noderivatives{v}([1-4]) ([05])(?: international| unported| generic)?(?: {lic})?
cc-by-nc-sa-\1.\2 | 2 | sharealike | creative commons attribution noncommercial sharealike{v}([1-4]) ([05])(?: international| unported| generic)?(?: {lic})?
cc-by-nc-nd-\1.\2 | 2 | noderivatives | creative commons attribution noncommercial noderivatives{v}([1-4]) ([05])(?: international| unported| generic)?(?: {lic})?
creative-commons | 3 | creativecommons | https? creativecommons org {lic} [^ ]+(?: [^ ]+){0,3} [1-4] [05]
creative-commons | 1 | creative | creative commons(?: {lic})?
public-domain | 2 | domain | (?:released|placed|dedicated|put) (?:in|into|to) the public domain
public-domain | 1 | domain | (?:is|are) (?:in the )?public domain
fair-use | 1 | fair | fair (?:use|dealing) (?:notice|doctrine|exception)
copyright | 1 | copyright | copyright(?: c)? (?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
copyright-holder | 1 | contributors | copyright holders? (?:and|or) contributors
all-rights-reserved | 2 | reserved | copyright{gap} all rights reserved
all-rights-reserved | 1 | reserved | all rights reserved worldwide
some-rights-reserved | 1 | reserved | some rights reserved
no-rights-reserved | 1 | reserved | no rights reserved
no-redistribution | 2 | redistributed | (?:may|must|can) ?not be (?:copied|reproduced|published|broadcast|rewritten){gap} redistributed
no-reproduction | 2 | reproduced | no part of this (?:publication|book|work|document|website) may be reproduced
no-reproduction | 2 | written | without the(?: prior)? written (?:permission|consent) of the (?:publisher|author|copyright holder|owner)
no-commercial-use | 1 | commercial | (?:for|only for) (?:personal )?non commercial (?:use|purposes)(?: only)?
no-commercial-use | 2 | commercial | commercial use is (?:prohibited|forbidden|not permitted|not allowed)
no-ai-training | 2 | training | (?:may|must|shall) not be used (?:for|in)(?: the)?{gap} training(?: of)? (?:ai|artificial|machine|language|generative)
text-mining-reserved | 2 | mining | text and data mining{gap} (?:reserved|prohibited|not permitted)
proprietary | 2 | proprietary | (?:confidential and proprietary|proprietary and confidential)
proprietary | 1 | proprietary | proprietary (?:software|{lic}|information)
trade-secret | 1 | secrets | trade secrets of
unpublished | 2 | unpublished | unpublished(?: work)?{gap} rights reserved under the copyright laws?
internal-use | 1 | internal | for internal use only
eula | 2 | eula | (?:this )?eula
eula | 2 | agreement | end user {lic} agreement
terms-of-use | 1 | terms | terms of (?:use|service) (?:apply|and conditions)
warranty-disclaimer | 3 | warranty | (?:the|this) software is provided as is without warranty of any kind(?: express or implied)?
warranty-disclaimer | 3 | warranties | any express or implied warranties including but not limited to the implied warranties of merchantability
warranty-disclaimer | 1 | warranties | without warranties or conditions of any kind
liability-disclaimer | 3 | liable | in no event shall the(?: authors?| copyright holders?| regents| contributors?| or){1,5} be liable for any
spdx-other | 1 | spdx | spdx {lic} identifier [^ ]+
dual-licensed | 2 | dual | dual licen[cs]ed(?: under)?
dual-licensed | 2 | dually | dually licen[cs]ed(?: under)?
dual-licensed | 1 | dual | (?:available under a )?dual licen[cs]ing
"""


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: bytes
    pattern: re.Pattern
    base: bool


def rule(label: str, priority: int, keyword: str, pattern: str, base: bool = False) -> Rule:
    for name, text in MACROS.items():
        pattern = pattern.replace(name, text)
    return Rule(label, priority, keyword.encode(), re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode()), base)


def phrase(words: str, label: str) -> Rule:
    """A rule of the lowest priority for a phrase, whose every place is told whatever else covers it."""
    return rule(label, 0, max(words.split(), key=len), re.escape(words).replace(r"\ ", " "), True)


def rules() -> list[Rule]:
    """All rules in their order, which settles detections of one place and priority."""
    return [rule(a, int(b), c, d) for a, b, c, d in (line.split(" | ", 3) for line in _RULES.strip().split("\n"))]
