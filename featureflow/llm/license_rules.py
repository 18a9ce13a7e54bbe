"""Ordered signature rules for licences: one hand-written pattern a line.

    kind  label  keywords  pattern

Patterns are Python regular expressions over a text's words: A-Z lower-cased,
runs of ASCII letters, digits and non-ASCII characters, joined by one space
("Apache-2.0" reads "apache 2 0").  They match whole words.  A rule is only
tried on texts that hold one of its keywords (separated by commas).  Kinds are
in order of priority; within a kind, earlier lines come first.
"""

from __future__ import annotations

import re
from typing import NamedTuple

# kind -> weight of a detection in the score; the order is the priority
KINDS = {
    "text": 0.95,      # wording of the licence itself
    "notice": 0.9,     # the recommended notice
    "tag": 0.9,        # machine-readable identifier
    "url": 0.85,       # address of the licence
    "title": 0.8,      # full name with version
    "name": 0.6,       # full name without version
    "base": 0.5,       # the phrases every scan counts
    "hint": 0.25,      # wording that only suggests a licence or a reservation
}

_TABLE = r"""
text    mit              granted           permission is hereby granted free of charge to any person obtaining a copy of this software
text    mit              merchantability   the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
text    mit              substantial       (?:the )?above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
text    mit-0            sublicense        to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
text    isc              purpose           permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
text    0bsd             purpose           permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
text    bsd-2-clause     redistributions   redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution
text    bsd-3-clause     endorse           neither the name of (?:[^ ]+ ){1,12}?nor the names of (?:its|their) contributors may be used to endorse or promote products
text    bsd-4-clause     advertising       all advertising materials mentioning features or use of this software must display the following acknowledg[e]?ment
text    bsd              redistribution    redistribution and use in source and binary forms with or without modification are permitted
text    bsd-source-code  redistributions   redistributions of source code must retain the above copyright notice this list of conditions
text    apache-2.0       contributor       subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
text    apache-2.0       apache            apache license version 2 0 january 2004 (?:https? www apache org licenses )?terms and conditions for use reproduction and distribution
text    apache-1.1       apache            this product includes software developed by the apache software foundation
text    gpl-2.0          gnu               gnu general public license version 2 june 1991
text    gpl-3.0          gnu               gnu general public license version 3 29 june 2007
text    lgpl-2.1         lesser            gnu lesser general public license version 2 1 february 1999
text    lgpl-2.0         library           gnu library general public license version 2 june 1991
text    lgpl-3.0         lesser            gnu lesser general public license version 3 29 june 2007
text    agpl-3.0         affero            gnu affero general public license version 3 19 november 2007
text    gpl-1.0          february          gnu general public license version 1 february 1989
text    gpl              freedom           the licenses for most software are designed to take away your freedom to share and change it
text    gpl              copyleft          the gnu general public license is a free copyleft license for software and other kinds of works
text    mpl-2.0          mozilla           mozilla public license version 2 0 1 definitions
text    mpl-1.1          mozilla           mozilla public license version 1 1 1 definitions
text    epl-1.0          eclipse           the accompanying program is provided under the terms of this eclipse public license
text    cddl-1.0         cddl              common development and distribution license cddl version 1 0
text    cpl-1.0          accompanying      the accompanying program is provided under the terms of this common public license
text    artistic-1.0     copied            the intent of this document is to state the conditions under which a package may be copied
text    artistic-2.0     copied            this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed
text    zlib             misrepresented    the origin of this software must not be misrepresented you must not claim that you wrote the original software
text    zlib             altered           altered source versions must be plainly marked as such and must not be misrepresented as being the original software
text    libpng           libpng            libpng versions? (?:[0-9]+ ){1,4}(?:[^ ]+ ){0,6}are copyright
text    bsl-1.0          boost             boost software license version 1 0 august 17th 2003
text    bsl-1.0          accompanying      permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
text    unlicense        unencumbered      this is free and unencumbered software released into the public domain
text    wtfpl            fuck              you just do what the fuck you want to
text    cc0-1.0          waives            affirmer hereby overtly fully permanently irrevocably and unconditionally waives
text    cc0-1.0          deed              the person who associated a work with this deed has dedicated the work to the public domain
text    cc-by            remix             you are free to share copy and redistribute the material in any medium or format (?:for any purpose even commercially )?(?:to )?(?:adapt )?remix
text    cc-by            appropriate       you must give appropriate credit provide a link to the license and indicate if changes were made
text    cc-by-nc         purposes          you may not use the material for commercial purposes
text    cc-by-nd         remix             if you remix transform or build upon the material you may not distribute the modified material
text    cc-by-sa         remix             if you remix transform or build upon the material you must distribute your contributions under the same license as the original
text    ofl-1.1          font              sil open font license version 1 1 26 february 2007
text    ofl-1.1          typefaces         the font software may be sold as part of a larger software package but no copy of one or more of the font software typefaces may be sold by itself
text    gfdl-1.3         documentation     gnu free documentation license version 1 3 3 november 2008
text    gfdl-1.2         documentation     gnu free documentation license version 1 2 november 2002
text    python-2.0       python            python software foundation license version 2
text    psf-2.0          psf               this license agreement is between the python software foundation psf and the individual or organization
text    openssl          openssl           this product includes software developed by the openssl project for use in the openssl toolkit
text    ssleay           cryptographic     this product includes cryptographic software written by eric young
text    ncsa             illinois          university of illinois ncsa open source license
text    x11              consortium        except as contained in this notice the name of the x consortium shall not be used in advertising
text    hpnd             publicity         not be used in advertising or publicity pertaining to distribution of the software without specific(?: written)? prior permission
text    postgresql       granted           permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
text    ms-pl            microsoft         microsoft public license ms pl this license governs use of the accompanying software
text    ms-rl            reciprocal        microsoft reciprocal license ms rl this license governs use of the accompanying software
text    eupl-1.2         eupl              european union public licen[cs]e v 1 2 eupl
text    eupl-1.1         eupl              european union public licen[cs]e v 1 1 eupl
text    afl-3.0          academic          licensed under the academic free license version 3 0
text    osl-3.0          software          licensed under the open software license version 3 0
text    rpl-1.5          reciprocal        reciprocal public license 1 5 rpl1 5
text    qpl-1.0          q                 the q public license version 1 0
text    ipl-1.0          ibm               the accompanying program is provided under the terms of this ibm public license
text    sleepycat        redistributions   redistributions in any form must be accompanied by information on how to obtain complete source code
text    vim              vim               there are no restrictions on distributing unmodified copies of vim
text    beerware         beer              if we meet some day and you think this stuff is worth it you can buy me a beer in return
text    json             evil              the software shall be used for good not evil
text    elastic-2.0      hosted            you may not provide the software to third parties as a hosted or managed service
text    sspl-1.0         server            server side public license version 1 october 16 2018
text    bsl-1.1          licensor          the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
text    commons-clause   sell              the license does not grant to you the right to sell the software
text    polyform-nc      noncommercial     any noncommercial purpose is a permitted purpose
text    odbl-1.0         database          open database license odbl (?:is )?(?:a )?license agreement intended to allow users to freely share modify and use this database
text    pddl-1.0         dedication        the open data commons public domain dedication (?:and )?licen[cs]e is a document intended to allow you to freely share
text    openrail         restrictions      use based restrictions as referenced in paragraph 5 must be included as an enforceable provision
text    llama            llama             llama (?:[0-9]+ ){0,2}community license agreement
text    gemma            gemma             gemma is provided under and subject to the gemma terms of use
text    unicode          unicode           unicode inc license agreement data files and software
text    w3c              w3c               w3c software (?:and document )?notice and license
text    icu              icu               icu license icu 1 8 1 and later
text    curl             curl              curl and libcurl are licensed under
text    info-zip         zip               this is version (?:[0-9]+ ){1,4}(?:[^ ]+ ){0,4}of the info zip license
text    intel            intel             intel simplified software license
notice  gpl-2.0+         redistribute      redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
notice  gpl-3.0+         redistribute      redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
notice  gpl-2.0          redistribute      redistribute it and or modify it under the terms of the gnu general public license (?:version 2 )?as published by the free software foundation (?:version 2 of the license|version 2)
notice  gpl              redistribute      redistribute it and or modify it under the terms of the gnu general public license
notice  lgpl-2.1+        lesser            under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
notice  lgpl-3.0+        lesser            under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
notice  lgpl-2.0+        library           under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version
notice  lgpl             lesser            under the terms of the gnu lesser general public license
notice  agpl-3.0+        affero            under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
notice  agpl             affero            under the terms of the gnu affero general public license
notice  apache-2.0       apache            licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
notice  apache-2.0       apache            licensed (?:to [^ ]+ )?under (?:the )?apache license version 2(?: 0)?
notice  apache-2.0       asf               licensed to the apache software foundation asf under one or more contributor license agreements
notice  mit              mit               (?:licensed|released|distributed|available) under the (?:terms of the )?mit license
notice  bsd              bsd               (?:licensed|released|distributed|available) under (?:the|a) (?:terms of the )?bsd (?:style )?license
notice  bsd-3-clause     bsd               (?:licensed|released|distributed|available) under the (?:3 clause|new|modified|revised) bsd license
notice  bsd-2-clause     bsd               (?:licensed|released|distributed|available) under the (?:2 clause|simplified|freebsd) bsd license
notice  bsd              bsd               use of this source code is governed by a bsd style license that can be found in the license file
notice  mit              mit               use of this source code is governed by an mit style license
notice  mpl-2.0          mozilla           this source code form is subject to the terms of the mozilla public license v 2 0
notice  mpl-1.1          mozilla           the contents of this file are subject to the mozilla public license version 1 1
notice  mpl-1.0          mozilla           the contents of this file are subject to the mozilla public license version 1 0
notice  npl-1.1          netscape          the contents of this file are subject to the netscape public license version 1 1
notice  epl-2.0          eclipse           made available under the terms of the eclipse public license (?:v )?2 0
notice  epl-1.0          eclipse           made available under the terms of the eclipse public license (?:v )?1 0
notice  cddl-1.0         distribution      subject to the terms of the common development and distribution license
notice  bsl-1.0          boost             distributed under the boost software license version 1 0
notice  artistic-perl    perl              under the same terms as perl itself
notice  zlib             zlib              (?:licensed|released|distributed) under the zlib license
notice  isc              isc               (?:licensed|released|distributed) under the isc license
notice  unlicense        unlicense         (?:licensed|released|dedicated) (?:to the public domain )?under the unlicense
notice  cc0-1.0          waived            has waived all copyright and related or neighboring rights
notice  cc-by-4.0        attribution       licensed under (?:a |the )?creative commons attribution 4 0(?: international)?(?: license)?
notice  cc-by-3.0        attribution       licensed under (?:a |the )?creative commons attribution 3 0(?: unported)?(?: license)?
notice  cc-by-sa-4.0     creative          licensed under (?:a |the )?creative commons attribution share ?alike 4 0(?: international)?(?: license)?
notice  cc-by-sa-3.0     creative          licensed under (?:a |the )?creative commons attribution share ?alike 3 0(?: unported)?(?: license)?
notice  cc-by-nc-4.0     creative          licensed under (?:a |the )?creative commons attribution non ?commercial 4 0(?: international)?(?: license)?
notice  cc-by-nc-sa-4.0  creative          licensed under (?:a |the )?creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: license)?
notice  cc-by-nc-nd-4.0  creative          licensed under (?:a |the )?creative commons attribution non ?commercial no ?deriv(?:atives|s) 4 0(?: international)?(?: license)?
notice  cc-by-nd-4.0     creative          licensed under (?:a |the )?creative commons attribution no ?deriv(?:atives|s) 4 0(?: international)?(?: license)?
notice  cc-by            creative          this work is licensed under (?:a |the )?creative commons attribution
notice  cc-by            cc                (?:licensed|released|available|published) under (?:a )?cc by
notice  ofl-1.1          sil               this font software is licensed under the sil open font license version 1 1
notice  gfdl             documentation     under the terms of the gnu free documentation license
notice  public-domain    domain            (?:this (?:file|work|code|software) is|released|placed|dedicated) (?:in|into|to) the public domain
notice  public-domain    disclaims         the author (?:hereby )?disclaims copyright to this source code
notice  wtfpl            fuck              under the terms of the do what the fuck you want to public license
notice  proprietary      proprietary       proprietary and confidential unauthori[sz]ed copying of this file
notice  proprietary      prohibited        unauthori[sz]ed copying of this file via any medium is strictly prohibited
notice  rights-reserved  reserved          copyright (?:c )?(?:[^ ]+ ){1,10}?all rights reserved
notice  eula             eula              by installing copying or otherwise using the software you agree to be bound by the terms of this eula
notice  llama            llama             licensed under the llama (?:[0-9]+ ){0,2}community license
notice  openrail         openrail,rail     licensed under the (?:[^ ]+ ){0,3}open ?rail(?: [ms])? license
notice  odbl-1.0         database          made available under the open database license
notice  eupl             eupl              licensed under the eupl
notice  ms-pl            microsoft         subject to the microsoft public license
notice  sspl-1.0         server            under the terms of the server side public license
notice  elastic-2.0      elastic           licensed under the elastic license 2 0
notice  bsl-1.1          business          use of this software is governed by the business source license
tag     mit              spdx              spdx license identifier mit
tag     mit-0            spdx              spdx license identifier mit 0
tag     apache-2.0       spdx              spdx license identifier apache 2 0
tag     apache-1.1       spdx              spdx license identifier apache 1 1
tag     gpl-2.0-only     spdx              spdx license identifier gpl 2 0(?: only)?
tag     gpl-2.0+         spdx              spdx license identifier gpl 2 0 or later
tag     gpl-3.0-only     spdx              spdx license identifier gpl 3 0(?: only)?
tag     gpl-3.0+         spdx              spdx license identifier gpl 3 0 or later
tag     lgpl-2.0+        spdx              spdx license identifier lgpl 2 0(?: or later)?
tag     lgpl-2.1-only    spdx              spdx license identifier lgpl 2 1(?: only)?
tag     lgpl-2.1+        spdx              spdx license identifier lgpl 2 1 or later
tag     lgpl-3.0-only    spdx              spdx license identifier lgpl 3 0(?: only)?
tag     lgpl-3.0+        spdx              spdx license identifier lgpl 3 0 or later
tag     agpl-3.0-only    spdx              spdx license identifier agpl 3 0(?: only)?
tag     agpl-3.0+        spdx              spdx license identifier agpl 3 0 or later
tag     bsd-2-clause     spdx              spdx license identifier bsd 2 clause
tag     bsd-3-clause     spdx              spdx license identifier bsd 3 clause
tag     bsd-4-clause     spdx              spdx license identifier bsd 4 clause
tag     0bsd             spdx              spdx license identifier 0bsd
tag     isc              spdx              spdx license identifier isc
tag     zlib             spdx              spdx license identifier zlib
tag     mpl-2.0          spdx              spdx license identifier mpl 2 0
tag     mpl-1.1          spdx              spdx license identifier mpl 1 1
tag     epl-1.0          spdx              spdx license identifier epl 1 0
tag     epl-2.0          spdx              spdx license identifier epl 2 0
tag     cddl-1.0         spdx              spdx license identifier cddl 1 0
tag     cddl-1.1         spdx              spdx license identifier cddl 1 1
tag     bsl-1.0          spdx              spdx license identifier bsl 1 0
tag     busl-1.1         spdx              spdx license identifier busl 1 1
tag     unlicense        spdx              spdx license identifier unlicense
tag     wtfpl            spdx              spdx license identifier wtfpl
tag     cc0-1.0          spdx              spdx license identifier cc0 1 0
tag     cc-by-3.0        spdx              spdx license identifier cc by 3 0
tag     cc-by-4.0        spdx              spdx license identifier cc by 4 0
tag     cc-by-sa-3.0     spdx              spdx license identifier cc by sa 3 0
tag     cc-by-sa-4.0     spdx              spdx license identifier cc by sa 4 0
tag     cc-by-nc-4.0     spdx              spdx license identifier cc by nc 4 0
tag     cc-by-nc-sa-4.0  spdx              spdx license identifier cc by nc sa 4 0
tag     cc-by-nd-4.0     spdx              spdx license identifier cc by nd 4 0
tag     ofl-1.1          spdx              spdx license identifier ofl 1 1
tag     artistic-2.0     spdx              spdx license identifier artistic 2 0
tag     python-2.0       spdx              spdx license identifier (?:python|psf) 2 0
tag     postgresql       spdx              spdx license identifier postgresql
tag     openssl          spdx              spdx license identifier openssl
tag     ncsa             spdx              spdx license identifier ncsa
tag     x11              spdx              spdx license identifier x11
tag     hpnd             spdx              spdx license identifier hpnd
tag     eupl-1.2         spdx              spdx license identifier eupl 1 2
tag     ms-pl            spdx              spdx license identifier ms pl
tag     sspl-1.0         spdx              spdx license identifier sspl 1 0
tag     elastic-2.0      spdx              spdx license identifier elastic 2 0
tag     odbl-1.0         spdx              spdx license identifier odbl 1 0
tag     gfdl-1.3         spdx              spdx license identifier gfdl 1 3(?: only| or later)?
tag     other-spdx       spdx              spdx license identifier [^ ]+
tag     apache-2.0       osi               license osi approved apache software license
tag     mit              osi               license osi approved mit license
tag     bsd              osi               license osi approved bsd license
tag     gpl-3.0          osi               license osi approved gnu general public license v3 gplv3
tag     gpl-2.0          osi               license osi approved gnu general public license v2 gplv2
tag     lgpl-3.0         osi               license osi approved gnu lesser general public license v3 lgplv3
tag     mpl-2.0          osi               license osi approved mozilla public license 2 0 mpl 2 0
tag     isc              osi               license osi approved isc license iscl
url     apache-2.0       apache            (?:https? )?(?:www )?apache org licenses license 2 0(?: txt| html)?
url     mit              opensource        (?:https? )?(?:www )?opensource org licen[cs]es? mit(?: license)?(?: php| html)?
url     bsd-3-clause     opensource        (?:https? )?(?:www )?opensource org licen[cs]es? bsd 3 clause
url     bsd-2-clause     opensource        (?:https? )?(?:www )?opensource org licen[cs]es? bsd 2 clause
url     apache-2.0       opensource        (?:https? )?(?:www )?opensource org licen[cs]es? apache 2 0
url     isc              opensource        (?:https? )?(?:www )?opensource org licen[cs]es? isc
url     gpl              gnu               (?:https? )?(?:www )?gnu org (?:copyleft|licenses) gpl(?: [0-9]+ 0)?(?: html| txt)?
url     lgpl             gnu               (?:https? )?(?:www )?gnu org (?:copyleft|licenses) (?:old licenses )?lgpl(?: [0-9] [0-9])?(?: html| txt)?
url     agpl-3.0         gnu               (?:https? )?(?:www )?gnu org licenses agpl(?: 3 0)?(?: html| txt)?
url     gpl-2.0          gnu               (?:https? )?(?:www )?gnu org licenses old licenses gpl 2 0(?: html| txt)?
url     gfdl             gnu               (?:https? )?(?:www )?gnu org licenses fdl(?: 1 [23])?(?: html| txt)?
url     mpl-2.0          mozilla           (?:https? )?(?:www )?mozilla org mpl 2 0
url     mpl-1.1          mozilla           (?:https? )?(?:www )?mozilla org mpl mpl 1 1(?: html| txt)?
url     epl-2.0          eclipse           (?:https? )?(?:www )?eclipse org legal epl (?:2 0|v20)(?: html)?
url     epl-1.0          eclipse           (?:https? )?(?:www )?eclipse org legal epl v10(?: html)?
url     bsl-1.0          boost             (?:https? )?(?:www )?boost org license 1 0(?: txt)?
url     unlicense        unlicense         (?:https? )?unlicense org
url     cc-by-4.0        creativecommons   creativecommons org licenses by 4 0
url     cc-by-3.0        creativecommons   creativecommons org licenses by 3 0(?: us)?
url     cc-by-2.0        creativecommons   creativecommons org licenses by 2 [05]
url     cc-by-sa-4.0     creativecommons   creativecommons org licenses by sa 4 0
url     cc-by-sa-3.0     creativecommons   creativecommons org licenses by sa 3 0
url     cc-by-nc-4.0     creativecommons   creativecommons org licenses by nc 4 0
url     cc-by-nc-sa-4.0  creativecommons   creativecommons org licenses by nc sa 4 0
url     cc-by-nc-nd-4.0  creativecommons   creativecommons org licenses by nc nd 4 0
url     cc-by-nd-4.0     creativecommons   creativecommons org licenses by nd 4 0
url     cc0-1.0          creativecommons   creativecommons org publicdomain zero 1 0
url     public-domain    creativecommons   creativecommons org publicdomain mark 1 0
url     ofl-1.1          sil               scripts sil org ofl
url     wtfpl            wtfpl             (?:https? )?(?:www )?wtfpl net
url     eupl             joinup            joinup ec europa eu (?:[^ ]+ ){0,4}eupl
url     odbl-1.0         opendatacommons   opendatacommons org licenses odbl(?: 1 0)?
url     pddl-1.0         opendatacommons   opendatacommons org licenses pddl(?: 1 0)?
url     artistic         perlfoundation    perlfoundation org artistic license (?:1|2) 0
title   apache-2.0       apache            apache (?:software )?license (?:version |v )?2(?: 0)?
title   apache-2.0       apache,apache2    apache ?2(?: 0)?(?: licensed?)?
title   apache-1.1       apache            apache (?:software )?license (?:version |v )?1 1
title   gpl-3.0          gnu               gnu general public license (?:version |v )?3(?: 0)?
title   gpl-2.0          gnu               gnu general public license (?:version |v )?2(?: 0)?
title   gpl-3.0          gpl,gplv,gplv3,gpl3 gpl ?(?:v ?)?3(?: 0)?
title   gpl-2.0          gpl,gplv,gplv2,gpl2 gpl ?(?:v ?)?2(?: 0)?
title   lgpl-3.0         lesser            gnu lesser general public license (?:version |v )?3(?: 0)?
title   lgpl-2.1         lesser            gnu lesser general public license (?:version |v )?2 1
title   lgpl-3.0         lgpl,lgplv,lgplv3,lgpl3 lgpl ?(?:v ?)?3(?: 0)?
title   lgpl-2.1         lgpl,lgplv,lgplv2,lgpl2 lgpl ?(?:v ?)?2 1
title   agpl-3.0         affero            gnu affero general public license (?:version |v )?3(?: 0)?
title   agpl-3.0         agpl,agplv,agplv3,agpl3 agpl ?(?:v ?)?3(?: 0)?
title   mpl-2.0          mozilla           mozilla public license (?:version |v )?2(?: 0)?
title   mpl-2.0          mpl               mpl (?:v )?2 0
title   epl-2.0          eclipse           eclipse public license (?:version |v )?2(?: 0)?
title   epl-1.0          eclipse           eclipse public license (?:version |v )?1(?: 0)?
title   bsd-3-clause     bsd               (?:3|three) clause bsd(?: license)?
title   bsd-2-clause     bsd               (?:2|two) clause bsd(?: license)?
title   bsd-3-clause     bsd               bsd 3 clause(?: license)?
title   bsd-2-clause     bsd               bsd 2 clause(?: license)?
title   bsd-3-clause     bsd               (?:new|modified|revised) bsd license
title   bsd-2-clause     bsd               (?:simplified|freebsd) bsd license
title   bsd-4-clause     bsd               (?:original|old) bsd license
title   cc-by-4.0        cc                cc by (?:v )?4(?: 0)?
title   cc-by-3.0        cc                cc by (?:v )?3(?: 0)?
title   cc-by-2.0        cc                cc by (?:v )?2(?: [05])?
title   cc-by-sa-4.0     cc                cc by sa (?:v )?4(?: 0)?
title   cc-by-sa-3.0     cc                cc by sa (?:v )?3(?: 0)?
title   cc-by-sa         cc                cc by sa
title   cc-by-nc         cc                cc by nc(?: 4 0| 3 0| 2 [05])?
title   cc-by-nd         cc                cc by nd(?: 4 0| 3 0| 2 [05])?
title   cc-by-nc-sa      cc                cc by nc sa(?: 4 0| 3 0| 2 [05])?
title   cc-by-nc-nd      cc                cc by nc nd(?: 4 0| 3 0| 2 [05])?
title   cc0-1.0          cc0               cc0(?: 1 0)?(?: universal)?
title   cc-by-4.0        attribution       creative commons attribution 4 0(?: international)?
title   cc-by-3.0        attribution       creative commons attribution 3 0(?: unported)?
title   cc-by-sa         creative          creative commons attribution share ?alike(?: [234] [05])?
title   cc-by-nc         creative          creative commons attribution non ?commercial(?: [234] [05])?
title   cc-by-nd         creative          creative commons attribution no ?deriv(?:atives|s)(?: [234] [05])?
title   ofl-1.1          sil               sil open font license(?: version)?(?: 1 1)?
title   python-2.0       psf               psf license(?: version 2)?
title   bsl-1.1          business          business source license 1 1
title   sspl-1.0         sspl              sspl(?: v?1(?: 0)?)?
title   artistic-2.0     artistic          artistic license 2 0
name    lgpl             lesser            (?:gnu )?lesser general public license
name    lgpl             library           gnu library general public license
name    agpl             affero            (?:gnu )?affero general public license
name    gpl              gpl               (?:gnu )?gpl(?: license[d]?)?
name    lgpl             lgpl              (?:gnu )?lgpl(?: license[d]?)?
name    agpl             agpl              (?:gnu )?agpl(?: license[d]?)?
name    apache           apache            apache software license
name    mit              mit,expat         (?:mit licen[cs]e[d]?|mit expat|expat license|x11 mit)
name    bsd              bsd               (?:the )?bsd (?:style )?license[d]?
name    mpl              mozilla           mozilla public license
name    epl              eclipse           eclipse public license
name    cddl             cddl,development  (?:common development and distribution license|cddl)
name    isc              isc               isc license
name    zlib             zlib              zlib (?:libpng )?license
name    bsl-1.0          boost             boost software license
name    unlicense        unlicense         the unlicense
name    wtfpl            wtfpl             wtfpl
name    artistic         artistic          (?:perl )?artistic license
name    eupl             eupl,union        (?:european union public licen[cs]e|eupl)
name    ofl              font              open font license
name    gfdl             documentation,gfdl (?:gnu free documentation license|gfdl)
name    odbl             odbl,database     (?:open database license|odbl)
name    cc-by            attribution       creative commons attribution(?: license)?
name    cc               creative          creative commons(?: license)?
name    ncsa             ncsa              ncsa (?:open source )?license
name    postgresql       postgresql        postgresql license
name    python           python            python software foundation license
name    openrail         openrail,rail     open ?rail(?: [ms]| license)
name    llama            llama             llama community license
name    public-domain    domain            public domain (?:dedication|work)
base    gpl              gnu               gnu general public license
base    apache           apache            apache license
base    cc-by            cc                cc by
base    mit              mit               mit license
hint    rights-reserved  reserved          all rights reserved
hint    public-domain    domain            (?:in|into|to) the public domain
hint    open-source      license           (?:an )?open source license
hint    permissive       permissive        permissive (?:free )?(?:software )?license
hint    copyleft         copyleft          (?:strong |weak )?copyleft(?: license)?
hint    eula             agreement         end user license agreement
hint    terms            terms             (?:subject to|under) the terms (?:and conditions )?of (?:the|this) license
hint    licence-file     license           see (?:the )?(?:accompanying )?license (?:file|txt|md)(?: for (?:details|more))?
hint    copyright        copyright         copyright (?:c )?(?:19[0-9]{2}|20[0-9]{2})(?: (?:19[0-9]{2}|20[0-9]{2}))?
"""


class Rule(NamedTuple):
    """One signature: a smaller ``priority`` wins, then a smaller ``order``."""
    order: int
    kind: str
    priority: int
    label: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern


def parse(table: str) -> list[Rule]:
    """Rules of a table in the form described above."""
    names, rules = list(KINDS), []
    for line in table.strip().splitlines():
        kind, label, keywords, pattern = line.split(None, 3)
        rules.append(Rule(len(rules), kind, names.index(kind), label, tuple(keywords.encode().split(b",")),
                          re.compile(b"(?<![^ ])(?:%s)(?![^ ])" % pattern.strip().encode())))
    return rules


def default_rules() -> list[Rule]:
    return parse(_TABLE)
