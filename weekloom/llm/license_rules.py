"""Signature rules of licences: ordered, hand-written patterns with their keywords.

A line is ``label ; keyword ; pattern``. Patterns are matched against text with A-Z lowered
and stand between word borders. A space is a gap of 1 to 32 bytes without letters and
digits, so that punctuation, line ends and comment marks do not matter; ``~`` is the same
gap or nothing. A group ``v`` fills the ``*`` of a label with a version. The keyword is part
of every match of its pattern; a pattern is tried only where its keyword occurs.

Kinds go from the strongest to the weakest; within a kind an earlier line goes first.
"""

from __future__ import annotations

#: Kind -> (priority, strength of the evidence).
KINDS = {
    "identifier": (6, 1.0),
    "text": (5, 0.95),
    "notice": (4, 0.9),
    "url": (3, 0.85),
    "name": (2, 0.7),
    "mention": (1, 0.4),
    "base": (0, 0.5),
}

#: The contract's phrases. Fixed values.
BASE = """
gpl ; gnu ; gnu general public license
apache ; apache ; apache license
cc-by ; cc by ; cc by
mit ; mit ; mit license
"""

#: Identifiers that a tag may name; their patterns follow from them.
TAGGED = """
0bsd afl-3.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 apache-2.0
apsl-2.0 artistic-1.0 artistic-2.0 beerware blueoak-1.0.0 bsd-2-clause bsd-3-clause
bsd-4-clause bsl-1.0 busl-1.1 bzip2-1.0.6 cc-by-2.0 cc-by-3.0 cc-by-4.0 cc-by-nc-3.0
cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0
cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cecill-b cecill-c cpl-1.0 curl ecl-2.0
elastic-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 ftl gfdl-1.2-or-later gfdl-1.3-or-later
gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only
gpl-3.0-or-later hpnd icu ijg ipl-1.0 isc json lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only
lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later libpng-2.0 lppl-1.3c mit mit-0
mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa odbl-1.0 ofl-1.1 openssl osl-3.0 pddl-1.0
php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 rpl-1.5 ruby sleepycat sspl-1.0 tcl
unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1
"""

TEXT = """
mit ; hereby granted ; permission is hereby granted free of charge to any person obtaining a copy of this software
mit ; noninfringement ; the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
mit ; substantial portions ; the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit-0 ; sublicense ; to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
x11 ; x consortium ; except as contained in this notice the name of the x consortium shall not be used
isc ; disclaims ; permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice.{0,80}appear in all copies.{0,40}the software is provided as is and (?:the author|isc|[a-z]{2,20}) disclaims
0bsd ; hereby granted ; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd-2-clause ; redistribution ; redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3-clause ; endorse ; neither the names? of .{1,120}may be used to endorse or promote products derived from this software without specific prior written permission
bsd-3-clause ; endorse ; the names? of .{1,120}may not be used to endorse or promote products derived from this software without
bsd-4-clause ; advertising ; all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-source-code ; retain ; redistributions of source code must retain the above copyright notice this condition and the following disclaimer
apache-2.0 ; reproduction ; terms and conditions for use reproduction and distribution
apache-2.0 ; irrevocable ; each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
apache-2.0 ; as is basis ; unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-1.1 ; apache ; this product includes software developed by the apache software foundation
apache-1.0 ; apache ; this product includes software developed by the apache group for use in the apache http server project
gpl-2.0 ; preamble ; preamble the licenses for most software are designed to take away your freedom to share and change it
gpl-2.0 ; verbatim ; you may copy and distribute verbatim copies of the program s source code as you receive it
gpl-3.0 ; definitions ; terms and conditions 0 definitions this license refers to version 3 of the gnu general public license
gpl-3.0 ; propagate ; to propagate a work means to do anything with it that without permission would make you directly or secondarily liable
gpl-3.0 ; convey ; you may convey verbatim copies of the program s source code as you receive it
gpl ; hope that it ; this program is distributed in the hope that it will be useful but without any warranty
lgpl ; hope that it ; this library is distributed in the hope that it will be useful but without any warranty
lgpl-2.1 ; uses the library ; a work that uses the library in isolation is not a derivative work of the library
lgpl-3.0 ; combined work ; a combined work is a work produced by combining or linking an application with the library
agpl-3.0 ; computer network ; if you modify the program your modified version must prominently offer all users interacting with it remotely through a computer network
mpl-2.0 ; incompatible ; this source code form is incompatible with secondary licenses
mpl-2.0 ; covered software ; covered software is provided under this license on an as is basis
mpl-1.1 ; netscape ; the initial developer of the original code is netscape
epl ; accompanying program ; the accompanying program is provided under the terms of this eclipse public license
cpl-1.0 ; accompanying program ; the accompanying program is provided under the terms of this common public license
cddl-1.0 ; covered software ; covered software means a the original software or b modifications
eupl ; eupl ; the work is provided under the terms of this licence.{0,40}eupl
osl-3.0 ; open software ; licensed under the open software license version 3 0
ofl-1.1 ; reserved font ; reserved font name refers to any names specified as such after the copyright statement
ofl-1.1 ; bundled ; the fonts? .{0,60}may be bundled redistributed and or sold with any software
zlib ; altered ; altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib ; misrepresented ; the origin of this software must not be misrepresented you must not claim that you wrote the original software
libpng-2.0 ; png ; the png reference library is supplied as is
bsl-1.0 ; machine executable ; unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor
unlicense ; unencumbered ; this is free and unencumbered software released into the public domain
unlicense ; detriment ; we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors
wtfpl ; fuck ; you just do what the fuck you want to
beerware ; beer ; if we meet some day and you think this stuff is worth it you can buy me a beer
json ; evil ; the software shall be used for good not evil
openssl ; openssl ; this product includes software developed by the openssl project for use in the openssl toolkit
ssleay ; cryptographic ; this product includes cryptographic software written by eric young
python-2.0 ; python ; this license agreement is between the python software foundation
python-2.0 ; beopen ; beopen python open source license agreement
postgresql ; california ; in no event shall the university of california be liable to any party for direct indirect special incidental
ncsa ; deal with the software ; to deal with the software without restriction including without limitation
artistic-1.0 ; copyright holder ; the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains
artistic-2.0 ; software package ; this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed
php-3.01 ; php ; this product includes php software freely available from
ftl ; freetype ; portions of this software are copyright .{0,40}the freetype project
ijg ; jpeg ; this software is based in part on the work of the independent jpeg group
curl ; curl ; permission to use copy modify and distribute this software for any purpose with or without fee.{0,200}curl
vim ; vim ; there are no restrictions on distributing unmodified copies of vim
tcl ; scriptics ; this software is copyrighted by the regents of the university of california sun microsystems inc scriptics corporation
sleepycat ; accompanied ; redistributions in any form must be accompanied by information on how to obtain complete source code for the db software
qpl-1.0 ; non exclusive rights ; you are granted the non exclusive rights set forth in this license provided you agree to and comply with any and all conditions
ms-pl ; source code form ; if you distribute any portion of the software in source code form you may do so only under this license by including a complete copy of this license
lppl-1.3c ; latex ; this work may be distributed and or modified under the conditions of the latex project public license
cc0-1.0 ; affirmer ; affirmer hereby overtly fully permanently irrevocably and unconditionally waives
cc-by-4.0 ; licensed rights ; by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution 4 0
cc-by-nc-4.0 ; noncommercial ; noncommercial means not primarily intended for or directed towards commercial advantage or monetary compensation
cc-by-nd-4.0 ; adapted ; you do not have permission under this public license to share adapted material
cc-by-sa-4.0 ; adapter ; the adapter s license you apply must be a creative commons license with the same license elements
odbl-1.0 ; database license ; this database license is between the licensor and you
gfdl-1.3 ; free documentation ; permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3
gfdl-1.2 ; free documentation ; permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 2
gfdl ; invariant ; with no invariant sections no front cover texts and no back cover texts
sspl-1.0 ; as a service ; if you make the functionality of the program or a modified version available to third parties as a service
elastic-2.0 ; hosted or managed ; you may not provide the software to third parties as a hosted or managed service
busl-1.1 ; production use ; the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
mulanpsl-2.0 ; mulan ; you can use this software according to the terms and conditions of the mulan psl v2
commons-clause ; right to sell ; the grant of rights under the license will not include and the license does not grant to you the right to sell the software
unicode-dfs-2016 ; unicode ; permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
hpnd ; representations ; makes no representations about the suitability of this software for any purpose it is provided as is without express or implied warranty
blessing ; blessing ; the author disclaims copyright to this source code in place of a legal notice here is a blessing
openrail ; restrictions as referenced ; use based restrictions as referenced in
llama ; llama ; llama [234](?: [0-9])? is licensed under the llama [234](?: [0-9])? community license
"""

NOTICE = """
apache-2.0 ; apache ; (?:licensed|released|distributed|available) under (?:the )?apache license version 2 0
apache-2.0 ; apache ; (?:licensed|released|distributed|available) under (?:the )?apache(?: license)? 2 0
apache-2.0 ; apache ; (?:licensed|released|distributed|available) under (?:the )?apache(?: license)? v2(?: 0)?
apache-1.1 ; apache ; (?:licensed|released|distributed|available) under (?:the )?apache(?: software)? license version 1 1
mit ; mit ; (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?mit licen[cs]e
mit ; mit ; this (?:project|software|work|file|code|package|library) is (?:licensed )?under (?:the )?mit licen[cs]e
mit ; expat ; (?:licensed|released|distributed) under (?:the )?(?:terms of the )?expat licen[cs]e
gpl-3.0-or-later ; general public ; gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2.0-or-later ; general public ; gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3.0-only ; general public ; gnu general public license version 3 as published by the free software foundation
gpl-2.0-only ; general public ; gnu general public license version 2 as published by the free software foundation
gpl-* ; general public ; (?:licensed|released|distributed|available|redistribute it and or modify it) under (?:the )?(?:terms of the )?gnu general public licen[cs]e v(?:ersion )?(?P<v>[123](?: 0)?)
gpl-* ; gpl ; (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?gpl~v?~(?P<v>[123](?: 0)?)
lgpl-2.1-or-later ; lesser general public ; gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-3.0-or-later ; lesser general public ; gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
lgpl-2.0-or-later ; library general public ; gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version
lgpl-* ; lesser general public ; (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?gnu lesser general public licen[cs]e v(?:ersion )?(?P<v>[23](?: [01])?)
lgpl-* ; lgpl ; (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?lgpl~v?~(?P<v>[23](?: [01])?)
agpl-3.0-or-later ; affero general public ; gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl-* ; affero general public ; (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?affero general public licen[cs]e v(?:ersion )?(?P<v>[13](?: 0)?)
agpl-* ; agpl ; (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?agpl~v?~(?P<v>[13](?: 0)?)
mpl-2.0 ; mozilla ; this source code form is subject to the terms of the mozilla public license v(?:ersion)? 2 0
mpl-1.1 ; mozilla ; the contents of this file are subject to the mozilla public license version 1 1
mpl-1.0 ; mozilla ; the contents of this file are subject to the mozilla public license version 1 0
npl-1.1 ; netscape ; the contents of this file are subject to the netscape public license version 1 1
epl-2.0 ; eclipse ; made available under the terms of the eclipse public license(?: v(?:ersion)?)? 2 0
epl-1.0 ; eclipse ; made available under the terms of the eclipse public license(?: v(?:ersion)?)? 1 0
cpl-1.0 ; common public ; made available under the terms of the common public license v(?:ersion)? ?1 0
cddl-1.0 ; common development ; the contents of this file are subject to the terms of the common development and distribution license
eupl-* ; eupl ; licen[cs]ed under the eupl v(?:ersion )?(?P<v>1 [12])
bsd-3-clause ; bsd ; (?:licensed|released|distributed|available) under (?:the )?(?:3 clause|three clause|new|modified|revised) bsd licen[cs]e
bsd-2-clause ; bsd ; (?:licensed|released|distributed|available) under (?:the )?(?:2 clause|two clause|simplified|freebsd) bsd licen[cs]e
bsd ; bsd ; (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?bsd(?: style)? licen[cs]e
bsd ; bsd ; use of this source code is governed by a bsd style license
isc ; isc ; (?:licensed|released|distributed|available) under (?:the )?isc licen[cs]e
zlib ; zlib ; (?:licensed|released|distributed|available) under (?:the )?zlib(?: libpng)? licen[cs]e
bsl-1.0 ; boost ; distributed under the boost software license version 1 0
artistic-* ; artistic ; (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?artistic licen[cs]e(?: version)? (?P<v>[12] 0)
perl ; perl ; you can redistribute it and or modify it under the same terms as perl
ruby ; ruby ; (?:licensed|released|distributed|available) under (?:the )?(?:same terms as ruby|ruby licen[cs]e)
psf-2.0 ; python ; (?:licensed|released|distributed|available) under (?:the )?python software foundation licen[cs]e
psf-2.0 ; psf ; (?:licensed|released|distributed|available) under (?:the )?psf licen[cs]e
php-3.01 ; php ; this source file is subject to version 3 01 of the php license
zpl-2.1 ; zope ; this software is subject to the provisions of the zope public license version 2 1
ofl-1.1 ; font software ; this font software is licensed under the sil open font license version 1 1
cc-by-nc-nd-* ; cc by nc nd ; licen[cs]ed under (?:a |the )?cc by nc nd (?P<v>[1-4](?: [05])?)
cc-by-nc-sa-* ; cc by nc sa ; licen[cs]ed under (?:a |the )?cc by nc sa (?P<v>[1-4](?: [05])?)
cc-by-nc-* ; cc by nc ; licen[cs]ed under (?:a |the )?cc by nc (?P<v>[1-4](?: [05])?)
cc-by-nd-* ; cc by nd ; licen[cs]ed under (?:a |the )?cc by nd (?P<v>[1-4](?: [05])?)
cc-by-sa-* ; cc by sa ; licen[cs]ed under (?:a |the )?cc by sa (?P<v>[1-4](?: [05])?)
cc-by-* ; cc by ; licen[cs]ed under (?:a |the )?cc by (?P<v>[1-4](?: [05])?)
cc-by-nc-nd-* ; creative commons ; licen[cs]ed under (?:a |the )?creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)? (?P<v>[1-4] [05])
cc-by-nc-sa-* ; creative commons ; licen[cs]ed under (?:a |the )?creative commons attribution non ?commercial share ?alike (?P<v>[1-4] [05])
cc-by-nc-* ; creative commons ; licen[cs]ed under (?:a |the )?creative commons attribution non ?commercial (?P<v>[1-4] [05])
cc-by-nd-* ; creative commons ; licen[cs]ed under (?:a |the )?creative commons attribution no ?deriv(?:ative)?s?(?: works)? (?P<v>[1-4] [05])
cc-by-sa-* ; creative commons ; licen[cs]ed under (?:a |the )?creative commons attribution share ?alike (?P<v>[1-4] [05])
cc-by-* ; creative commons ; licen[cs]ed under (?:a |the )?creative commons attribution (?P<v>[1-4] [05])
cc0-1.0 ; cc0 ; (?:released|dedicated|available|licensed) (?:under|to the public domain (?:under|with|via)) (?:the )?cc0
public-domain ; public domain ; (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain ; public domain ; (?:this (?:work|file|code|text|software) is|is hereby) in the public domain
unlicense ; unlicense ; (?:licensed|released|distributed|available) under (?:the )?unlicense
wtfpl ; wtfpl ; (?:licensed|released|distributed|available) under (?:the )?wtfpl
odbl-1.0 ; database license ; made available under the open database license
odc-by-1.0 ; attribution ; made available under the open data commons attribution license
pddl-1.0 ; dedication and ; made available under the public domain dedication and license
gfdl-* ; free documentation ; (?:licensed|released|available|distributed) under (?:the )?(?:terms of the )?gnu free documentation licen[cs]e(?: version)? (?P<v>1 [123])
busl-1.1 ; business source ; (?:licensed|released|available) under (?:the )?business source license(?: 1 1)?
sspl-1.0 ; server side ; (?:licensed|released|available) under (?:the )?server side public license
elastic-2.0 ; elastic ; (?:licensed|released|available) under (?:the )?elastic license(?: v?2(?: 0)?)?
ms-pl ; microsoft public ; (?:licensed|released|available) under (?:the )?microsoft public license
llama ; llama ; (?:licensed|released|available) under (?:the )?llama(?: [234](?: [0-9])?)? community license
gemma ; gemma ; gemma is provided under and subject to the gemma terms of use
openrail-m ; rail ; (?:licensed|released|available) under (?:the |a )?(?:creativeml |bigcode |bigscience )?open~rail m
proprietary ; proprietary ; (?:confidential and proprietary|proprietary and confidential)
proprietary ; unauthori ; unauthori[sz]ed copying of this (?:file|software|work|document) via any medium is strictly prohibited
all-rights-reserved ; rights reserved ; copyright .{1,80}all rights reserved
"""

URL = """
apache-2.0 ; apache ; apache org licenses license 2 0
apache-1.1 ; apache ; apache org licenses license 1 1
mit ; mit ; opensource org licenses? mit(?: license)?
mit ; mit ; choosealicense com licenses mit
gpl-* ; gpl ; gnu org (?:licenses|copyleft)(?: old licenses)? gpl (?P<v>[123] 0)
gpl ; gpl ; gnu org (?:licenses|copyleft) gpl html
lgpl-* ; lgpl ; gnu org (?:licenses|copyleft)(?: old licenses)? lgpl (?P<v>[23] [01])
agpl-* ; agpl ; gnu org licenses agpl (?P<v>3 0)
gfdl-* ; fdl ; gnu org licenses(?: old licenses)? fdl (?P<v>1 [123])
mpl-* ; mpl ; mozilla org mpl (?P<v>[12] [01])
mpl-* ; mpl ; mozilla org (?:en us )?mpl mpl (?P<v>1 [01])
epl-* ; epl ; eclipse org (?:legal|org documents) epl (?:v )?v?(?P<v>[12]0|[12] 0)
bsl-1.0 ; boost ; boost org license 1 0 txt
bsd-3-clause ; bsd ; opensource org licenses? bsd 3 clause
bsd-2-clause ; bsd ; opensource org licenses? bsd 2 clause
isc ; isc ; opensource org licenses? isc
zlib ; zlib ; opensource org licenses? zlib
artistic-2.0 ; artistic ; opensource org licenses? artistic(?: license)? 2 0
unlicense ; unlicense ; unlicense org
wtfpl ; wtfpl ; wtfpl net
ofl-1.1 ; ofl ; scripts sil org ofl
cc-by-nc-nd-* ; creativecommons ; creativecommons org licenses by nc nd (?P<v>[1-4] [05])
cc-by-nc-sa-* ; creativecommons ; creativecommons org licenses by nc sa (?P<v>[1-4] [05])
cc-by-nc-* ; creativecommons ; creativecommons org licenses by nc (?P<v>[1-4] [05])
cc-by-nd-* ; creativecommons ; creativecommons org licenses by nd (?P<v>[1-4] [05])
cc-by-sa-* ; creativecommons ; creativecommons org licenses by sa (?P<v>[1-4] [05])
cc-by-* ; creativecommons ; creativecommons org licenses by (?P<v>[1-4] [05])
cc0-1.0 ; creativecommons ; creativecommons org publicdomain zero 1 0
public-domain ; creativecommons ; creativecommons org publicdomain mark 1 0
odbl-1.0 ; opendatacommons ; opendatacommons org licenses odbl
odc-by-1.0 ; opendatacommons ; opendatacommons org licenses by
pddl-1.0 ; opendatacommons ; opendatacommons org licenses pddl
sspl-1.0 ; mongodb ; mongodb com licensing server side public license
elastic-2.0 ; elastic ; elastic co licensing elastic license
busl-1.1 ; mariadb ; mariadb com bsl11
php-3.01 ; php ; php net license 3 01
python-2.0 ; python ; docs python org (?:3 )?license
w3c ; w3 ; w3 org consortium legal.{0,20}copyright software
eupl ; eupl ; joinup ec europa eu.{0,40}eupl
cecill ; cecill ; cecill info licences
mulanpsl-2.0 ; mulanpsl ; license coscl org cn mulanpsl2
blueoak-1.0.0 ; blueoak ; blueoakcouncil org license 1 0 0
"""

NAME = """
apache-2.0 ; apache ; apache(?: software)?(?: license)?(?: version| v)? 2(?: 0)?
apache-2.0 ; apache ; apache(?: license)? v2(?: 0)?
apache-2.0 ; asl ; asl 2 0
apache-1.1 ; apache ; apache(?: software)? license(?: version)? 1 1
apache-1.0 ; apache ; apache(?: software)? license(?: version)? 1 0
mit-0 ; mit ; mit no attribution(?: license)?
mit ; mit ; the mit licen[cs]e(?: mit)?
mit ; mit ; mit x11 licen[cs]e
mit ; expat ; expat licen[cs]e
x11 ; x11 ; x11 licen[cs]e
gpl-* ; general public ; gnu general public licen[cs]e gpl v(?:ersion )?(?P<v>[123](?: 0)?)
gpl-* ; general public ; gnu general public licen[cs]e(?: version| v)? (?P<v>[123](?: 0)?)
gpl-* ; general public ; gnu general public licen[cs]e v(?P<v>[123](?: 0)?)
gpl-* ; gpl ; gpl~(?:v|version )?~(?P<v>[123](?: 0)?)(?: only)?
gpl-2.0-or-later ; gpl ; gpl~v?~2(?: 0)?(?:[+]| or later)
gpl-3.0-or-later ; gpl ; gpl~v?~3(?: 0)?(?:[+]| or later)
lgpl-* ; lesser general public ; gnu lesser general public licen[cs]e(?: version| v)? (?P<v>[23](?: [01])?)
lgpl-* ; lesser general public ; gnu lesser general public licen[cs]e v(?P<v>[23](?: [01])?)
lgpl-2.0 ; library general public ; gnu library general public licen[cs]e(?: version)?(?: 2(?: 0)?)?
lgpl-* ; lgpl ; lgpl~(?:v|version )?~(?P<v>[23](?: [01])?)
agpl-* ; affero general public ; (?:gnu )?affero general public licen[cs]e(?: version| v)? (?P<v>[13](?: 0)?)
agpl-* ; affero general public ; (?:gnu )?affero general public licen[cs]e v(?P<v>[13](?: 0)?)
agpl-* ; agpl ; agpl~(?:v|version )?~(?P<v>[13](?: 0)?)
gfdl-* ; free documentation ; gnu free documentation licen[cs]e(?: version| v)? (?P<v>1 [123])
mpl-* ; mozilla ; mozilla public licen[cs]e(?: version| v)? (?P<v>[12](?: [01])?)
mpl-* ; mpl ; mpl~(?:v|version )?~(?P<v>[12] [01])
epl-* ; eclipse ; eclipse public licen[cs]e(?: version| v)? (?P<v>[12](?: 0)?)
epl-* ; epl ; epl~(?:v|version )?~(?P<v>[12] 0)
cddl-* ; common development ; common development and distribution licen[cs]e(?: cddl)?(?: version| v)? (?P<v>1 [01])
cddl-* ; cddl ; cddl~(?:v|version )?~(?P<v>1 [01])
cpl-1.0 ; common public ; common public licen[cs]e(?: version| v)? 1 0
ipl-1.0 ; ibm public ; ibm public licen[cs]e(?: version| v)? 1 0
eupl-* ; european union ; european union public licen[cs]e(?: version| v)? (?P<v>1 [012])
osl-* ; open software ; open software licen[cs]e(?: version| v)? (?P<v>[123] [01])
afl-* ; academic free ; academic free licen[cs]e(?: version| v)? (?P<v>[123] [01])
apsl-* ; apple public ; apple public source licen[cs]e(?: version| v)? (?P<v>[12] [012])
ecl-* ; educational community ; educational community licen[cs]e(?: version| v)? (?P<v>[12] 0)
bsd-4-clause ; bsd ; (?:4 clause|four clause|original|old) bsd licen[cs]e
bsd-3-clause ; bsd ; (?:3 clause|three clause|new|modified|revised) bsd licen[cs]e
bsd-2-clause ; bsd ; (?:2 clause|two clause|simplified|freebsd) bsd licen[cs]e
bsd-3-clause ; bsd ; bsd 3 clause(?: licen[cs]e)?
bsd-2-clause ; bsd ; bsd 2 clause(?: licen[cs]e)?
0bsd ; bsd ; (?:zero clause bsd|bsd zero clause|0bsd) licen[cs]e
isc ; isc ; isc licen[cs]e
zlib ; zlib ; zlib(?: libpng)? licen[cs]e
libpng-2.0 ; libpng ; libpng licen[cs]e
bsl-1.0 ; boost ; boost software licen[cs]e(?: version| v)?(?: 1 0)?
ncsa ; ncsa ; (?:university of illinois )?ncsa open source licen[cs]e
artistic-* ; artistic ; artistic licen[cs]e(?: version| v)? (?P<v>[12] 0)
psf-2.0 ; python ; python software foundation licen[cs]e
php-3.01 ; php ; php licen[cs]e(?: version)? 3 01
zpl-* ; zope ; zope public licen[cs]e(?: version)? (?P<v>[12] [01])
postgresql ; postgresql ; postgresql licen[cs]e
openssl ; openssl ; openssl licen[cs]e
unlicense ; unlicense ; the unlicense
wtfpl ; fuck ; do what the fuck you want to public licen[cs]e
beerware ; beer ; beer ware licen[cs]e
ofl-* ; open font ; (?:sil )?open font licen[cs]e(?: version| v)? (?P<v>1 [01])
lppl-* ; latex ; latex project public licen[cs]e(?: version| v)? (?P<v>1 [0-3])
cecill ; cecill ; cecill(?: [bc])? (?:free software )?licen[cs]e
qpl-1.0 ; q public ; q public licen[cs]e(?: version| v)?(?: 1 0)?
rpl-1.5 ; reciprocal public ; reciprocal public licen[cs]e(?: version)?(?: 1 5)?
ms-rl ; microsoft reciprocal ; microsoft reciprocal licen[cs]e
ms-pl ; microsoft public ; microsoft public licen[cs]e
upl-1.0 ; universal permissive ; universal permissive licen[cs]e
blueoak-1.0.0 ; blue oak ; blue oak model licen[cs]e
mulanpsl-2.0 ; mulan ; mulan permissive software licen[cs]e(?: v2)?
sleepycat ; sleepycat ; sleepycat licen[cs]e
sspl-1.0 ; server side ; server side public licen[cs]e
busl-1.1 ; business source ; business source licen[cs]e
commons-clause ; commons clause ; commons clause(?: licen[cs]e| condition)
cc0-1.0 ; cc0 ; cc0(?: 1 0)?(?: universal)?
cc-by-nc-nd-* ; cc by nc nd ; cc by nc nd (?P<v>[1-4](?: [05])?)
cc-by-nc-sa-* ; cc by nc sa ; cc by nc sa (?P<v>[1-4](?: [05])?)
cc-by-nc-* ; cc by nc ; cc by nc (?P<v>[1-4](?: [05])?)
cc-by-nd-* ; cc by nd ; cc by nd (?P<v>[1-4](?: [05])?)
cc-by-sa-* ; cc by sa ; cc by sa (?P<v>[1-4](?: [05])?)
cc-by-* ; cc by ; cc by (?P<v>[1-4](?: [05])?)
cc-by-nc-nd-* ; creative commons ; creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: licen[cs]e)? (?P<v>[1-4] [05])
cc-by-nc-sa-* ; creative commons ; creative commons attribution non ?commercial share ?alike(?: licen[cs]e)? (?P<v>[1-4] [05])
cc-by-nc-* ; creative commons ; creative commons attribution non ?commercial(?: licen[cs]e)? (?P<v>[1-4] [05])
cc-by-nd-* ; creative commons ; creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: licen[cs]e)? (?P<v>[1-4] [05])
cc-by-sa-* ; creative commons ; creative commons attribution share ?alike(?: licen[cs]e)? (?P<v>[1-4] [05])
cc-by-* ; creative commons ; creative commons attribution(?: licen[cs]e)? (?P<v>[1-4] [05])
odbl-1.0 ; open database ; open database licen[cs]e(?: odbl)?
odc-by-1.0 ; open data commons ; open data commons attribution licen[cs]e
pddl-1.0 ; dedication and ; public domain dedication and licen[cs]e
openrail-m ; openrail ; (?:creativeml |bigcode )?openrail m
openrail ; bigscience ; bigscience rail licen[cs]e
llama ; llama ; llama(?: [234](?: [0-9])?)? community licen[cs]e
gemma ; gemma ; gemma terms of use
elastic-2.0 ; elastic ; elastic licen[cs]e(?: v?2(?: 0)?)?
"""

MENTION = """
gpl ; general public ; gnu general public licen[cs]e
lgpl ; lesser general public ; (?:gnu )?lesser general public licen[cs]e
agpl ; affero general public ; (?:gnu )?affero general public licen[cs]e
gfdl ; free documentation ; (?:gnu )?free documentation licen[cs]e
gpl ; gpl ; (?:gnu )?gpl(?: licen[cs]ed?)?
lgpl ; lgpl ; (?:gnu )?lgpl(?: licen[cs]ed?)?
agpl ; agpl ; (?:gnu )?agpl(?: licen[cs]ed?)?
apache ; apache ; apache(?: software)? licen[cs]ed?
bsd ; bsd ; bsd(?: style)? licen[cs]ed?
mit ; mit ; mit licen[cs]ed?
mpl ; mozilla ; mozilla public licen[cs]e
epl ; eclipse ; eclipse public licen[cs]e
cddl ; cddl ; cddl
artistic ; artistic ; artistic licen[cs]e
ofl ; open font ; (?:sil )?open font licen[cs]e
cc ; creative commons ; creative commons(?: licen[cs]ed?)?
cc-by-nc-nd ; cc by nc nd ; cc by nc nd
cc-by-nc-sa ; cc by nc sa ; cc by nc sa
cc-by-nc ; cc by nc ; cc by nc
cc-by-nd ; cc by nd ; cc by nd
cc-by-sa ; cc by sa ; cc by sa
public-domain ; public domain ; public domain
all-rights-reserved ; rights reserved ; all rights reserved
"""

TABLES = {"text": TEXT, "notice": NOTICE, "url": URL, "name": NAME, "mention": MENTION, "base": BASE}
