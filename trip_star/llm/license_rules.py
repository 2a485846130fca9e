"""Hand-written license signatures: ``label | priority | keyword | regex`` per line.

They run on the lower-cased words of a text joined by single spaces (so
``Apache-2.0`` reads ``apache 2 0``). A rule is only tried if the text holds its
keyword. Full texts have priority 90 and up, notices 70 to 89, titles with a
version 50 to 69, titles without one 30 to 49, loose hints below."""

RULES = r"""
apache-1.0 | 60 | apache | apache (?:software )?license (?:version |v )?1 0
apache-1.1 | 60 | apache | apache (?:software )?license (?:version |v )?1 1
apache-2.0 | 62 | apache | apache (?:software )?license (?:version |v )?2(?: 0)?
apache-2.0 | 80 | apache | licensed under the apache license version 2 0
apache-2.0 | 82 | apache | www apache org licenses license 2 0
apache-2.0 | 84 | apache | licensed to the apache software foundation asf under one or more contributor license agreements
apache-2.0 | 92 | apache | apache license version 2 0 january 2004
apache-1.1 | 90 | apache | this product includes software developed by the apache (?:software foundation|group)
apache | 40 | apache | (?:the )?apache license
mit | 45 | mit | (?:the )?mit license
mit | 72 | mit | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?mit(?: x11)? license
mit | 74 | mit | opensource org licenses mit
mit | 95 | permission | permission is hereby granted free of charge to any person obtaining a copy of this software
mit-0 | 65 | mit | mit no attribution
x11 | 60 | x11 | x11 license
x11 | 91 | consortium | except as contained in this notice the name of the x consortium shall not be used
mit-cmu | 60 | cmu | cmu license
mit-modern-variant | 50 | modern | mit license modern variant
bsd-2-clause | 62 | bsd | (?:simplified|2 clause|two clause|freebsd) bsd(?: license)?
bsd-2-clause | 63 | bsd | bsd 2 clause(?: simplified)?(?: license)?
bsd-2-clause | 90 | redistribution | redistribution and use in source and binary forms with or without modification are permitted(?: (?:\S+ ){0,60}?this software is provided by (?:\S+ ){1,40}?as is)?
bsd-3-clause | 62 | bsd | (?:modified|new|revised|3 clause|three clause) bsd(?: license)?
bsd-3-clause | 63 | bsd | bsd 3 clause(?: new or revised)?(?: license)?
bsd-3-clause | 93 | neither | neither the name of (?:\S+ ){1,12}nor the names of (?:its|his|their) contributors may be used(?: (?:\S+ ){0,60}?this software is provided by (?:\S+ ){1,40}?as is)?
bsd-3-clause | 95 | neither | redistribution and use in source and binary forms with or without modification are permitted (?:\S+ ){1,150}?neither the name of (?:\S+ ){1,12}nor the names of (?:its|his|their) contributors may be used(?: (?:\S+ ){0,60}?this software is provided by (?:\S+ ){1,40}?as is)?
bsd-4-clause | 62 | bsd | (?:original|4 clause|four clause) bsd(?: license)?
bsd-4-clause | 63 | bsd | bsd 4 clause(?: original or old)?(?: license)?
bsd-4-clause | 94 | advertising | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-4-clause | 96 | advertising | redistribution and use in source and binary forms with or without modification are permitted (?:\S+ ){1,150}?all advertising materials mentioning features or use of this software must display the following acknowledge?ment(?: (?:\S+ ){1,80}?neither the name of (?:\S+ ){1,12}nor the names of (?:its|his|their) contributors may be used)?(?: (?:\S+ ){0,60}?this software is provided by (?:\S+ ){1,40}?as is)?
bsd-4-clause-uc | 92 | regents | this product includes software developed by the university of california berkeley
0bsd | 62 | bsd | (?:zero clause bsd|bsd zero clause|0bsd)(?: license)?
bsd-3-clause-clear | 60 | bsd | (?:bsd 3 clause clear|clear bsd) license
bsd-protection | 60 | protection | bsd protection license
bsd | 35 | bsd | (?:the )?bsd(?: style)? license
isc | 50 | isc | (?:the )?isc license
isc | 92 | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
gpl-1.0 | 60 | general | gnu general public license (?:version |v )1(?: 0)?
gpl-2.0 | 62 | general | gnu general public license (?:version |v )2(?: 0)?
gpl-3.0 | 62 | general | gnu general public license (?:version |v )3(?: 0)?
gpl-2.0 | 58 | gpl | (?:gnu )?gpl ?(?:version )?v?2(?: 0)?(?: only)?
gpl-3.0 | 58 | gpl | (?:gnu )?gpl ?(?:version )?v?3(?: 0)?(?: only)?
gpl-2.0-or-later | 70 | gpl | (?:gnu )?gpl (?:version |v)?2(?: 0)? or (?:any )?later
gpl-3.0-or-later | 70 | gpl | (?:gnu )?gpl (?:version |v)?3(?: 0)? or (?:any )?later
gpl-2.0-or-later | 86 | general | gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3.0-or-later | 86 | general | gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2.0-only | 84 | general | gnu general public license version 2 (?:only )?as published by the free software foundation
gpl-2.0 | 94 | general | gnu general public license version 2 june 1991
gpl-3.0 | 94 | general | gnu general public license version 3 29 june 2007
gpl-1.0 | 94 | general | gnu general public license version 1 february 1989
gpl | 45 | general | gnu general public license
gpl | 30 | gpl | gnu gpl
lgpl-2.0 | 62 | library | gnu library general public license (?:version |v )?2(?: 0)?
lgpl-2.1 | 62 | lesser | gnu lesser general public license (?:version |v )?2 1
lgpl-3.0 | 62 | lesser | gnu lesser general public license (?:version |v )?3(?: 0)?
lgpl-2.1 | 58 | lgpl | lgpl ?(?:version )?v?2 1
lgpl-3.0 | 58 | lgpl | lgpl ?(?:version )?v?3(?: 0)?
lgpl-2.1-or-later | 86 | lesser | gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-3.0-or-later | 86 | lesser | gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
lgpl-2.0-or-later | 86 | library | gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version
lgpl-2.1 | 94 | lesser | gnu lesser general public license version 2 1 february 1999
lgpl | 46 | lesser | gnu lesser general public license
lgpl | 46 | library | gnu library general public license
agpl-1.0 | 60 | affero | affero general public license (?:version |v )?1(?: 0)?
agpl-3.0 | 64 | affero | (?:gnu )?affero general public license (?:version |v )?3(?: 0)?
agpl-3.0 | 58 | agpl | agpl ?(?:version )?v?3(?: 0)?
agpl-3.0-or-later | 87 | affero | gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl-3.0 | 94 | affero | gnu affero general public license version 3 19 november 2007
agpl | 46 | affero | (?:gnu )?affero general public license
gfdl-1.1 | 62 | documentation | gnu free documentation license (?:version |v )?1 1
gfdl-1.2 | 62 | documentation | gnu free documentation license (?:version |v )?1 2
gfdl-1.3 | 62 | documentation | gnu free documentation license (?:version |v )?1 3
gfdl | 45 | documentation | gnu free documentation license
classpath-exception-2.0 | 75 | classpath | (?:gnu )?classpath exception
classpath-exception-2.0 | 90 | linking | linking this library statically or dynamically with other modules is making a combined work
gcc-exception-3.1 | 72 | gcc | gcc runtime library exception
bison-exception-2.2 | 90 | bison | as a special exception you may create a larger work that contains part or all of the bison parser skeleton
autoconf-exception-2.0 | 90 | autoconf | if you distribute this file as part of a program that contains a configuration script generated by autoconf
font-exception-2.0 | 88 | font | as a special exception if you create a document which uses this font
llvm-exception | 72 | llvm | (?:apache license v?2 0 with )?llvm exceptions?
linux-syscall-note | 85 | kernel | this copyright does not cover user programs that use kernel services by normal system calls
mpl-1.0 | 62 | mozilla | mozilla public license (?:version |v )?1 0
mpl-1.1 | 62 | mozilla | mozilla public license (?:version |v )?1 1
mpl-2.0 | 62 | mozilla | mozilla public license (?:version |v )?2 0
mpl-2.0 | 86 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | 86 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
mpl | 45 | mozilla | mozilla public license
epl-1.0 | 62 | eclipse | eclipse public license (?:version |v )?1 0
epl-2.0 | 62 | eclipse | eclipse public license (?:version |v )?2 0
epl | 45 | eclipse | eclipse public license
edl-1.0 | 60 | eclipse | eclipse distribution license(?: (?:version |v )?1 0)?
cddl-1.0 | 62 | distribution | common development and distribution license (?:cddl )?(?:version |v )?1 0
cddl-1.1 | 62 | distribution | common development and distribution license (?:cddl )?(?:version |v )?1 1
cddl | 45 | distribution | common development and distribution license
cpl-1.0 | 60 | common | common public license(?: (?:version |v )?1 0)?
cpal-1.0 | 60 | attribution | common public attribution license(?: (?:version |v )?1 0)?
ipl-1.0 | 60 | ibm | ibm public license(?: (?:version |v )?1 0)?
eupl-1.0 | 62 | european | european union public licen[cs]e (?:v |version )?1 0
eupl-1.1 | 62 | european | european union public licen[cs]e (?:v |version )?1 1
eupl-1.2 | 62 | european | european union public licen[cs]e (?:v |version )?1 2
eupl-1.2 | 58 | eupl | eupl v?1 2
osl-1.0 | 60 | open | open software license (?:version |v )?1 0
osl-2.0 | 60 | open | open software license (?:version |v )?2 0
osl-2.1 | 60 | open | open software license (?:version |v )?2 1
osl-3.0 | 60 | open | open software license (?:version |v )?3 0
afl-1.1 | 60 | academic | academic free license (?:version |v )?1 1
afl-1.2 | 60 | academic | academic free license (?:version |v )?1 2
afl-2.0 | 60 | academic | academic free license (?:version |v )?2 0
afl-2.1 | 60 | academic | academic free license (?:version |v )?2 1
afl-3.0 | 60 | academic | academic free license (?:version |v )?3 0
apsl-1.0 | 60 | apple | apple public source license (?:version |v )?1 0
apsl-2.0 | 60 | apple | apple public source license (?:version |v )?2 0
artistic-1.0 | 60 | artistic | artistic license (?:version |v )?1 0
artistic-2.0 | 60 | artistic | artistic license (?:version |v )?2 0
artistic-1.0-perl | 72 | perl | (?:under the )?same terms as perl(?: itself)?
artistic | 35 | artistic | (?:the )?artistic license
zlib | 55 | zlib | (?:the )?zlib(?: libpng)? license
zlib | 92 | altered | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
libpng | 55 | libpng | (?:png reference library|libpng) license(?: version 2)?
bsl-1.0 | 62 | boost | boost software license(?: (?:version |v )?1 0)?
bsl-1.0 | 84 | boost | distributed under the boost software license version 1 0
busl-1.1 | 62 | business | business source license (?:version |v )?1 1
busl | 45 | business | business source license
unlicense | 55 | unlicense | (?:the )?unlicense
unlicense | 94 | encumbered | this is free and unencumbered software released into the public domain
wtfpl | 60 | fuck | do what the fuck you want to public license
wtfpl | 55 | wtfpl | wtfpl
cc0-1.0 | 60 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 62 | creative | creative commons (?:cc0|zero)(?: (?:v|version )?1 0)?(?: universal)?
cc0-1.0 | 80 | publicdomain | creativecommons org publicdomain zero 1 0
cc-by-1.0 | 62 | cc | cc by 1 0
cc-by-2.0 | 62 | cc | cc by 2 0
cc-by-2.5 | 62 | cc | cc by 2 5
cc-by-3.0 | 62 | cc | cc by 3 0
cc-by-4.0 | 62 | cc | cc by 4 0
cc-by-sa-2.0 | 64 | cc | cc by sa 2 0
cc-by-sa-2.5 | 64 | cc | cc by sa 2 5
cc-by-sa-3.0 | 64 | cc | cc by sa 3 0
cc-by-sa-4.0 | 64 | cc | cc by sa 4 0
cc-by-nd-3.0 | 64 | cc | cc by nd 3 0
cc-by-nd-4.0 | 64 | cc | cc by nd 4 0
cc-by-nc-2.0 | 64 | cc | cc by nc 2 0
cc-by-nc-3.0 | 64 | cc | cc by nc 3 0
cc-by-nc-4.0 | 64 | cc | cc by nc 4 0
cc-by-nc-sa-2.0 | 66 | cc | cc by nc sa 2 0
cc-by-nc-sa-3.0 | 66 | cc | cc by nc sa 3 0
cc-by-nc-sa-4.0 | 66 | cc | cc by nc sa 4 0
cc-by-nc-nd-3.0 | 66 | cc | cc by nc nd 3 0
cc-by-nc-nd-4.0 | 66 | cc | cc by nc nd 4 0
cc-by | 40 | cc | cc by
cc-by-sa | 42 | cc | cc by sa
cc-by-nc | 42 | cc | cc by nc
cc-by-nd | 42 | cc | cc by nd
cc-by-nc-sa | 44 | cc | cc by nc sa
cc-by-nc-nd | 44 | cc | cc by nc nd
cc-by-3.0 | 68 | creative | creative commons attribution 3 0(?: unported)?
cc-by-4.0 | 68 | creative | creative commons attribution 4 0(?: international)?
cc-by-sa-3.0 | 69 | creative | creative commons attribution share ?alike 3 0(?: unported)?
cc-by-sa-4.0 | 69 | creative | creative commons attribution share ?alike 4 0(?: international)?
cc-by-nc-3.0 | 69 | creative | creative commons attribution non ?commercial 3 0(?: unported)?
cc-by-nc-4.0 | 69 | creative | creative commons attribution non ?commercial 4 0(?: international)?
cc-by-nd-4.0 | 69 | creative | creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?
cc-by-nc-sa-4.0 | 70 | creative | creative commons attribution non ?commercial share ?alike 4 0(?: international)?
cc-by-nc-nd-4.0 | 70 | creative | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?
cc-by | 48 | creative | creative commons attribution(?: license)?
cc-by-sa | 49 | creative | creative commons attribution share ?alike(?: license)?
cc-by-nc | 49 | creative | creative commons attribution non ?commercial(?: license)?
cc-by-4.0 | 80 | creativecommons | creativecommons org licenses by 4 0
cc-by-3.0 | 80 | creativecommons | creativecommons org licenses by 3 0
cc-by-sa-3.0 | 80 | creativecommons | creativecommons org licenses by sa 3 0
cc-by-sa-4.0 | 80 | creativecommons | creativecommons org licenses by sa 4 0
cc-by-nc-4.0 | 80 | creativecommons | creativecommons org licenses by nc 4 0
cc-by-nc-sa-4.0 | 80 | creativecommons | creativecommons org licenses by nc sa 4 0
cc-by-nd-4.0 | 80 | creativecommons | creativecommons org licenses by nd 4 0
cc-by-nc-nd-4.0 | 80 | creativecommons | creativecommons org licenses by nc nd 4 0
ofl-1.0 | 62 | font | (?:sil )?open font license (?:version |v )?1 0
ofl-1.1 | 62 | font | (?:sil )?open font license (?:version |v )?1 1
ofl | 45 | font | (?:sil )?open font license
odbl-1.0 | 60 | database | open (?:data commons open )?database license(?: odbl)?(?: v?1 0)?
odc-by-1.0 | 60 | commons | open data commons attribution license(?: v?1 0)?
pddl-1.0 | 60 | dedication | (?:open data commons )?public domain dedication (?:and )?license(?: v?1 0)?
openssl | 55 | openssl | (?:the )?openssl(?: project)? license
openssl | 92 | openssl | this product includes software developed by the openssl project
ssleay | 90 | eric | this product includes cryptographic software written by eric young
php-3.0 | 60 | php | php license (?:version |v )?3 0
php-3.01 | 62 | php | php license (?:version |v )?3 01
psf-2.0 | 58 | python | python software foundation license(?: (?:version |v )?2)?
python-2.0 | 60 | python | python license (?:version |v )?2 0
cnri-python | 60 | cnri | cnri (?:open source )?(?:license|python)
ruby | 45 | ruby | (?:the )?ruby license
vim | 45 | vim | vim license
postgresql | 50 | postgresql | (?:the )?postgresql licen[cs]e
ncsa | 58 | ncsa | (?:university of illinois )?ncsa open source license
beerware | 55 | beer | (?:the )?beer ?ware license
ms-pl | 60 | microsoft | microsoft public license
ms-rl | 60 | microsoft | microsoft reciprocal license
ms-lpl | 60 | microsoft | microsoft limited public license
qpl-1.0 | 60 | public | q public license(?: (?:version |v )?1 0)?
lppl-1.0 | 60 | latex | latex project public license (?:version |v )?1 0
lppl-1.2 | 60 | latex | latex project public license (?:version |v )?1 2
lppl-1.3c | 60 | latex | latex project public license (?:version |v )?1 3c?
lppl | 45 | latex | latex project public license
sissl | 58 | sun | sun industry standards source license
spl-1.0 | 58 | sun | sun public license(?: (?:version |v )?1 0)?
sleepycat | 55 | sleepycat | (?:the )?sleepycat license
w3c | 58 | w3c | w3c (?:software )?(?:notice and )?(?:document )?license
xfree86-1.1 | 58 | xfree86 | xfree86 license(?: (?:version |v )?1 1)?
zend-2.0 | 58 | zend | zend (?:engine )?license(?: (?:version |v )?2 0)?
zpl-2.0 | 60 | zope | zope public license (?:version |v )?2 0
zpl-2.1 | 60 | zope | zope public license (?:version |v )?2 1
zpl | 45 | zope | zope public license
ftl | 58 | freetype | freetype (?:project )?license
ijg | 60 | jpeg | independent jpeg group(?: s software)?(?: license)?
icu | 50 | icu | icu license
unicode-dfs | 58 | unicode | unicode (?:data files and software )?license(?: agreement)?
json | 50 | json | json license
json | 88 | evil | the software shall be used for good not evil
curl | 45 | curl | curl license
bzip2-1.0.6 | 58 | bzip2 | bzip2 (?:and libbzip2 )?license
intel | 50 | intel | intel open source license
nasa-1.3 | 60 | nasa | nasa open source agreement(?: (?:version |v )?1 3)?
nosl | 50 | netizen | netizen open source license
npl-1.0 | 60 | netscape | netscape public license (?:version |v )?1 0
npl-1.1 | 60 | netscape | netscape public license (?:version |v )?1 1
rpl-1.1 | 60 | reciprocal | reciprocal public license (?:version |v )?1 1
rpl-1.5 | 60 | reciprocal | reciprocal public license (?:version |v )?1 5
rpsl-1.0 | 60 | realnetworks | realnetworks public source license(?: v?1 0)?
sgi-b-2.0 | 60 | sgi | sgi free software license b(?: (?:version |v )?2 0)?
simpl-2.0 | 58 | simple | simple public license(?: (?:version |v )?2 0)?
upl-1.0 | 60 | universal | universal permissive license(?: (?:version |v )?1 0)?
vsl-1.0 | 58 | vovida | vovida software license(?: (?:version |v )?1 0)?
watcom-1.0 | 60 | sybase | sybase open watcom public license(?: (?:version |v )?1 0)?
sspl-1.0 | 62 | server | server side public license(?: (?:version |v )?1)?
elastic-2.0 | 60 | elastic | elastic license(?: (?:version |v )?2 0)?
commons-clause | 62 | clause | commons clause(?: license condition)?(?: v1 0)?
cecill-1.0 | 58 | cecill | cecill (?:version |v )?1 0
cecill-2.0 | 58 | cecill | cecill (?:version |v )?2 0
cecill-2.1 | 58 | cecill | cecill (?:version |v )?2 1
cecill-b | 58 | cecill | cecill b(?: license)?
cecill-c | 58 | cecill | cecill c(?: license)?
mulanpsl-2.0 | 60 | mulan | mulan (?:permissive software license|psl) ?(?:version |v)?2?
ecl-2.0 | 60 | educational | educational community license(?: (?:version |v )?2 0)?
efl-2.0 | 58 | eiffel | eiffel forum license(?: (?:version |v )?2)?
entessa | 50 | entessa | entessa public license
eudatagrid | 50 | datagrid | eu datagrid software license
fair | 50 | fair | fair license
frameworx-1.0 | 50 | frameworx | frameworx (?:open )?license(?: 1 0)?
hpnd | 58 | historical | historical permission notice and disclaimer
liliq-p-1.1 | 55 | liliq | (?:licence libre du qu\S+bec )?liliq p(?: 1 1)?
lpl-1.02 | 60 | lucent | lucent public license (?:version |v )?1 02
miros | 50 | miros | (?:the )?miros licen[cs]e
motosoto | 50 | motosoto | motosoto open source license
multics | 50 | multics | multics license
naumen | 50 | naumen | naumen public license
ngpl | 50 | nethack | nethack general public license
nokia | 50 | nokia | nokia open source license
ntp | 45 | ntp | ntp license
oclc-2.0 | 55 | oclc | oclc research public license(?: 2 0)?
ogtsl | 55 | group | open group test suite license
blueoak-1.0.0 | 58 | blue | blue oak model license(?: 1 0 0)?
hippocratic-2.1 | 58 | hippocratic | hippocratic license(?: (?:version |v )?2 1)?
polyform-noncommercial-1.0.0 | 60 | polyform | polyform noncommercial license(?: 1 0 0)?
polyform-small-business-1.0.0 | 60 | polyform | polyform small business license(?: 1 0 0)?
cal-1.0 | 58 | cryptographic | cryptographic autonomy license(?: (?:version |v )?1 0)?
cern-ohl-p-2.0 | 60 | cern | cern open hardware licen[cs]e version 2 permissive
cern-ohl-s-2.0 | 60 | cern | cern open hardware licen[cs]e version 2 strongly reciprocal
cern-ohl-w-2.0 | 60 | cern | cern open hardware licen[cs]e version 2 weakly reciprocal
tapr-ohl-1.0 | 58 | tapr | tapr open hardware license(?: v?1 0)?
ogl-uk-3.0 | 58 | government | open government licen[cs]e (?:version |v ?)3 0
ogl-uk | 45 | government | open government licen[cs]e
etalab-2.0 | 55 | ouverte | licence ouverte(?: open licence)?(?: (?:version |v ?)2 0)?
ecos-2.0 | 50 | ecos | ecos license(?: (?:version |v )?2 0)?
erlpl-1.1 | 55 | erlang | erlang public license(?: (?:version |v )?1 1)?
condor-1.1 | 50 | condor | condor public license(?: (?:version |v )?1 1)?
catosl-1.1 | 50 | associates | computer associates trusted open source license(?: 1 1)?
public-domain | 35 | domain | (?<!not )(?<!never )(?<!nor )(?<!isn t )(?:in|into|to) the public domain
public-domain | 38 | domain | (?<!not )(?<!never )(?<!nor )dedicated to the public domain
proprietary | 40 | proprietary | proprietary and confidential
proprietary | 30 | rights | all rights reserved(?! (?:\S+ ){0,15}?(?:redistribution and use|permission is hereby|permission to use|licensed under|this program is|this file is))
proprietary | 36 | permission | (?:may not be )?reproduced without (?:prior )?(?:written )?permission
warranty-disclaimer | 15 | warranty | without warranty of any kind
""".strip()
