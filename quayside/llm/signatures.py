"""License signatures written by hand: phrases that stand in a license's text or in the notices it asks for.

Expressions are over lower-case words with one blank between; the keyword is a part that every match contains.  The
more exact of two phrases has the higher priority: a license's own title or header before a clause it shares.
"""

# fixed values: label, sureness, priority, and (keyword, expression) pairs; expressions quote the licenses' own words
SIGNATURES = (
    ("mit", 0.97, 92, (
        ("hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
        ("deal in the software", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish"),
        ("merge publish", "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
        ("substantial portions", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    )),
    ("mit", 0.9, 84, (
        ("mit license", "the mit license mit"),
        ("mit license", "(?:this (?:project|software|library|package|module|code) is )?(?:licensed|released|distributed) under the (?:terms of the )?mit license"),
        ("expat license", "(?:the )?expat license"),
        ("opensource org licenses mit", "opensource org licenses mit(?: license)?(?: php| html)?"),
    )),
    ("mit-0", 0.97, 93, (
        ("mit no attribution", "mit no attribution"),
        ("mit 0", "spdx license identifier mit 0"),
    )),
    ("x11", 0.9, 83, (
        ("x consortium", "except as contained in this notice the name of the x consortium shall not be used in advertising"),
        ("x11 license", "(?:the )?x11 license"),
    )),
    ("bsd", 0.96, 92, (
        ("redistribution", "redistribution and use in source and binary forms with or without modification are permitted provided that"),
        ("redistributions of source code", "redistributions of source code must retain the above copyright notice this list of conditions"),
        ("redistributions in binary form", "redistributions in binary form must reproduce the above copyright notice this list of conditions"),
        ("express or implied warranties", "this software is provided by the (?:copyright holders and contributors|author|regents and contributors) as is and any express or implied warranties"),
        ("procurement of substitute", "procurement of substitute goods or services loss of use data or profits or business interruption"),
    )),
    ("bsd", 0.88, 72, (
        ("bsd style", "(?:use of this source code is )?governed by a bsd style license"),
        ("bsd license", "(?:the )?(?:new|simplified|modified|revised|original) bsd license"),
        ("bsd license", "(?:licensed|released|distributed) under the bsd license"),
    )),
    ("bsd-3", 0.95, 91, (
        ("endorse or promote", "neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products"),
        ("endorse or promote", "names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
        ("bsd 3 clause", "bsd 3 clause (?:new or revised|clear) license"),
        ("opensource org licenses bsd 3", "opensource org licenses bsd 3 clause"),
    )),
    ("bsd-2", 0.95, 91, (
        ("official policies", "views and conclusions contained in the software and documentation are those of the authors and should not be interpreted as representing official policies"),
        ("bsd 2 clause", "bsd 2 clause simplified license"),
        ("opensource org licenses bsd 2", "opensource org licenses bsd 2 clause"),
        ("freebsd license", "(?:the )?freebsd license"),
    )),
    ("bsd-4", 0.96, 93, (
        ("advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
        ("california berkeley", "this product includes software developed by the university of california berkeley and its contributors"),
        ("bsd 4 clause", "bsd 4 clause(?: original or old)?(?: license)?"),
    )),
    ("bsd-0", 0.95, 93, (
        ("0bsd", "(?:the )?0bsd license"),
        ("zero clause", "(?:bsd zero clause|zero clause bsd) license"),
    )),
    ("isc", 0.95, 91, (
        ("permission to use", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
        ("author disclaims all warranties", "the software is provided as is and the author disclaims all warranties with regard to this software"),
        ("tortious action", "negligence or other tortious action arising out of or in connection with the use or performance of this software"),
        ("internet systems consortium", "internet systems consortium license"),
    )),
    ("apache-2", 0.98, 94, (
        ("apache license version 2 0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
        ("www apache org licenses license 2 0", "(?:https? )?www apache org licenses license 2 0"),
        ("distributed on an as is basis", "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
        ("perpetual worldwide", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
        ("perpetual worldwide", "hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable except as stated in this section patent license"),
        ("apache license 2 0", "apache license 2 0"),
        ("opensource org licenses apache 2", "opensource org licenses apache 2 0"),
    )),
    ("apache-1.1", 0.95, 92, (
        ("apache software foundation", "this product includes software developed by the apache software foundation"),
        ("products derived from this software may not be called apache", "products derived from this software may not be called apache nor may apache appear in their name"),
    )),
    ("apache-1", 0.95, 92, (("apache group", "this product includes software developed by the apache group for use in the apache http server project"),)),
    ("gpl", 0.96, 90, (
        ("free software you can redistribute", "this (?:program|file|library|code|software) is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
        ("gnu general public license", "you should have received a copy of the gnu general public license along with this (?:program|software|file|package)"),
        ("gnu general public license", "see the gnu general public license for more details"),
        ("www gnu org licenses gpl", "(?:https? )?www gnu org licenses gpl(?: html| txt)?"),
        ("guarantee your freedom to share", "the gnu general public license is intended to guarantee your freedom to share and change"),
        ("www gnu org copyleft gpl", "www gnu org copyleft gpl html"),
    )),
    ("gpl-2", 0.97, 93, (
        ("gnu general public license", "gnu general public license as published by the free software foundation (?:either )?version 2"),
        ("gnu general public license version 2", "gnu general public license version 2 june 1991"),
        ("www gnu org licenses old licenses gpl 2", "www gnu org licenses old licenses gpl 2 0"),
        ("gpl 2 0", "(?:gpl 2 0 only|gpl 2 0 or later)"),
        ("59 temple place", "free software foundation inc 59 temple place suite 330 boston ma"),
        ("51 franklin st", "free software foundation inc 51 franklin st(?:reet)? fifth floor boston ma"),
    )),
    ("gpl-3", 0.97, 93, (
        ("gnu general public license", "gnu general public license as published by the free software foundation (?:either )?version 3"),
        ("gnu general public license version 3", "gnu general public license version 3 29 june 2007"),
        ("opensource org licenses gpl 3", "opensource org licenses gpl 3 0"),
        ("gpl 3 0", "(?:gpl 3 0 only|gpl 3 0 or later)"),
    )),
    ("gpl-1", 0.95, 92, (("gnu general public license version 1", "gnu general public license version 1 february 1989"),)),
    ("gpl-exception", 0.9, 88, (
        ("classpath exception", "(?:gpl 2 0 )?(?:with )?(?:the )?classpath exception"),
        ("special exception", "as a special exception the copyright holders (?:of this library )?give (?:you )?permission to link this (?:library|program|code) with independent modules"),
        ("gcc runtime library exception", "gcc runtime library exception"),
        ("linux syscall note", "linux syscall note"),
        ("autoconf exception", "autoconf (?:configure script )?exception"),
        ("bison exception", "bison exception"),
        ("font exception", "gpl font exception"),
    )),
    ("lgpl", 0.96, 91, (
        ("gnu lesser general public license", "redistribute it and or modify it under the terms of the gnu lesser general public license"),
        ("gnu lesser general public license", "you should have received a copy of the gnu lesser general public license along with this"),
        ("gnu lesser general public license", "see the gnu lesser general public license for more details"),
        ("www gnu org licenses lgpl", "www gnu org licenses lgpl(?: html| txt)?"),
        ("a work that uses the library", "a program that contains no derivative of any portion of the library but is designed to work with the library .{0,90}?a work that uses the library"),
    )),
    ("lgpl-2.1", 0.97, 93, (
        ("version 2 1 february 1999", "gnu lesser general public license version 2 1 february 1999"),
        ("gnu lesser general public license", "gnu lesser general public license as published by the free software foundation (?:either )?version 2 1"),
        ("opensource org licenses lgpl 2 1", "opensource org licenses lgpl 2 1"),
    )),
    ("lgpl-2", 0.97, 93, (
        ("gnu library general public license", "gnu library general public license version 2 june 1991"),
        ("gnu library general public license", "gnu library general public license as published by the free software foundation (?:either )?version 2"),
    )),
    ("lgpl-3", 0.97, 93, (
        ("gnu lesser general public license", "gnu lesser general public license as published by the free software foundation (?:either )?version 3"),
        ("gnu lesser general public license version 3", "gnu lesser general public license version 3 29 june 2007"),
    )),
    ("agpl-3", 0.97, 93, (
        ("gnu affero general public license", "gnu affero general public license as published by the free software foundation (?:either )?version 3"),
        ("gnu affero general public license version 3", "gnu affero general public license version 3 19 november 2007"),
        ("remote network interaction", "remote network interaction use with the gnu general public license"),
        ("www gnu org licenses agpl", "www gnu org licenses agpl(?: 3 0)?(?: html| txt)?"),
    )),
    ("agpl", 0.95, 90, (
        ("gnu affero general public license", "redistribute it and or modify it under the terms of the gnu affero general public license"),
        ("gnu affero general public license", "you should have received a copy of the gnu affero general public license along with this"),
    )),
    ("fdl", 0.96, 91, (
        ("gnu free documentation license", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
        ("no invariant sections", "with no invariant sections no front cover texts and no back cover texts"),
        ("www gnu org", "www gnu org (?:licenses|copyleft) fdl(?: html)?"),
    )),
    ("mpl-2", 0.98, 94, (
        ("mozilla public license v 2 0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
        ("mozilla org mpl 2 0", "(?:if a copy of the mpl was not distributed with this file you can obtain one at )?(?:https? )?mozilla org mpl 2 0"),
        ("incompatible with secondary licenses", "this source code form is incompatible with secondary licenses as defined by the mozilla public license"),
        ("covered software is provided", "covered software is provided under this license on an as is basis without warranty of any kind"),
    )),
    ("mpl-1.1", 0.97, 93, (
        ("mozilla public license version 1 1", "the contents of this file are subject to the mozilla public license version 1 1"),
        ("www mozilla org mpl", "you may obtain a copy of the license at (?:https? )?www mozilla org mpl"),
        ("mpl 1 1 gpl 2 0 lgpl 2 1", "version mpl 1 1 gpl 2 0 lgpl 2 1"),
    )),
    ("mpl-1", 0.96, 92, (("mozilla public license version 1 0", "subject to the mozilla public license version 1 0"),)),
    ("npl", 0.95, 91, (("netscape public license", "(?:subject to the )?netscape public license(?: version 1 [01])?"),)),
    ("epl-1", 0.97, 93, (
        ("eclipse public license v1 0", "(?:made available under the terms of the )?eclipse public license v1 0"),
        ("www eclipse org legal epl v10", "www eclipse org legal epl v10(?: html)?"),
    )),
    ("epl-2", 0.97, 93, (
        ("eclipse public license 2 0", "(?:made available under the terms of the )?eclipse public license 2 0"),
        ("www eclipse org legal epl 2 0", "www eclipse org legal epl 2 0"),
        ("secondary licenses when", "made available under the following secondary licenses when the conditions for such availability set forth in the eclipse public license"),
    )),
    ("edl", 0.95, 91, (("eclipse distribution license", "eclipse distribution license v ?1 0"),)),
    ("cddl-1", 0.96, 92, (
        ("common development and distribution license", "the contents of this file are subject to the terms of the common development and distribution license"),
        ("usr src opensolaris license", "you can obtain a copy of the license at usr src opensolaris license"),
        ("cddl header start", "cddl header start"),
    )),
    ("cpl-1", 0.95, 91, (
        ("common public license", "common public license version 1 0"),
        ("this common public license", "the accompanying program is provided under the terms of this common public license"),
    )),
    ("ipl-1", 0.95, 91, (("ibm public license", "ibm public license version 1 0"),)),
    ("eupl-1.2", 0.96, 92, (
        ("licensed under the eupl", "licensed under the eupl version 1 2(?: only| or later)?"),
        ("european union public licence v 1 2", "european union public licence v 1 2"),
    )),
    ("eupl-1.1", 0.96, 92, (("eupl version 1 1", "licensed under the eupl version 1 1(?: only)?"),)),
    ("cecill", 0.95, 91, (
        ("cecill", "this software is governed by the cecill(?: [bc])? license"),
        ("cecill", "cecill free software license agreement"),
        ("www cecill info", "www cecill info"),
    )),
    ("artistic-1", 0.94, 90, (("the clarified artistic license", "the clarified artistic license"), ("copyright holder maintains some semblance", "copyright holder maintains some semblance of artistic control over the development of the package"))),
    ("artistic-2", 0.96, 92, (
        ("artistic license 2 0", "(?:the )?artistic license 2 0"),
        ("artistic license", "redistribute it and or modify it under the terms of the (?:the )?artistic license"),
    )),
    ("perl", 0.93, 89, (
        ("same terms as perl itself", "redistribute it and or modify it under the same terms as (?:the )?perl(?: 5)?(?: programming language system)? itself"),
        ("same terms as perl itself", "under the same terms as perl itself"),
    )),
    ("zlib", 0.97, 92, (
        ("express or implied warranty", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
        ("origin of this software", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
        ("altered source versions", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    )),
    ("boost-1", 0.98, 94, (
        ("boost software license version 1 0", "(?:distributed under the )?boost software license version 1 0"),
        ("www boost org license 1 0", "www boost org license 1 0 txt"),
        ("machine executable object code", "solely in the form of machine executable object code generated by a source language processor"),
    )),
    ("unlicense", 0.97, 93, (
        ("free and unencumbered", "this is free and unencumbered software released into the public domain"),
        ("unlicense org", "(?:for more information please refer to )?(?:https? )?unlicense org"),
        ("dedicate any and all copyright interest", "dedicate any and all copyright interest in the software to the public domain"),
        ("detriment of our heirs", "to the detriment of our heirs and successors"),
    )),
    ("wtfpl-2", 0.97, 93, (
        ("what the fuck you want to", "you just do what the fuck you want to"),
        ("do what the fuck you want to public license", "do what the fuck you want to public license version 2"),
        ("www wtfpl net", "www wtfpl net"),
    )),
    ("cc0", 0.97, 93, (
        ("cc0 1 0 universal", "cc0 1 0 universal"),
        ("creativecommons org publicdomain zero", "creativecommons org publicdomain zero 1 0"),
        ("dedicated the work", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights"),
        ("waived all copyright", "waived all copyright and related or neighboring rights"),
    )),
    ("public-domain", 0.9, 86, (
        ("public domain", "this (?:file|work|code|software|program) (?:is|has been) (?:hereby )?(?:placed|put|released|dedicated) (?:in|into|to) the public domain"),
        ("creativecommons org publicdomain mark", "creativecommons org publicdomain mark 1 0"),
        ("work of the united states government", "this is a work of the united states government and is not subject to copyright protection"),
        ("no rights reserved", "no rights reserved(?: public domain)?"),
        ("public domain dedication", "public domain dedication(?: and license)?"),
    )),
    ("cc-by", 0.95, 90, (
        ("creativecommons org licenses by", "creativecommons org licenses by (?!sa|nd|nc)"),
        ("give appropriate credit", "you must give appropriate credit provide a link to the license and indicate if changes were made"),
        ("creative commons attribution", "licensed under (?:a|the) creative commons attribution (?:international )?(?:license|\\d)"),
    )),
    ("cc-by-sa", 0.96, 91, (
        ("creativecommons org licenses by sa", "creativecommons org licenses by sa(?: \\d \\d)?"),
        ("creative commons attribution share alike", "creative commons attribution share alike"),
        ("distribute your contributions under the same license", "you must distribute your contributions under the same license as the original"),
    )),
    ("cc-by-nc", 0.96, 91, (
        ("creativecommons org licenses by nc", "creativecommons org licenses by nc (?!sa|nd)"),
        ("creative commons attribution non commercial", "creative commons attribution non commercial (?!share|no)"),
        ("for commercial purposes", "you may not use the material for commercial purposes"),
    )),
    ("cc-by-nc-sa", 0.97, 92, (
        ("creativecommons org licenses by nc sa", "creativecommons org licenses by nc sa(?: \\d \\d)?"),
        ("non commercial share alike", "creative commons attribution non commercial share ?alike"),
    )),
    ("cc-by-nc-nd", 0.97, 92, (
        ("creativecommons org licenses by nc nd", "creativecommons org licenses by nc nd(?: \\d \\d)?"),
        ("non commercial no deriv", "creative commons attribution non commercial no deriv(?:s|atives|ative works)"),
    )),
    ("cc-by-nd", 0.96, 91, (
        ("creativecommons org licenses by nd", "creativecommons org licenses by nd(?: \\d \\d)?"),
        ("may not distribute the modified material", "if you remix transform or build upon the material you may not distribute the modified material"),
    )),
    ("odbl-1", 0.96, 92, (
        ("opendatacommons org licenses odbl", "opendatacommons org licenses odbl(?: 1 0)?"),
        ("open database license", "made available under the open database license"),
        ("database contents license", "any rights in individual contents of the database are licensed under the database contents license"),
    )),
    ("odc-by", 0.96, 92, (("opendatacommons org licenses by", "opendatacommons org licenses by(?: 1 0)?"), ("open data commons attribution license", "open data commons attribution license"))),
    ("pddl", 0.96, 92, (("opendatacommons org licenses pddl", "opendatacommons org licenses pddl(?: 1 0)?"),)),
    ("ogl", 0.95, 91, (("open government licence", "(?:contains public sector information licensed under the )?open government licence(?: v ?[123] 0)?"),)),
    ("ofl-1.1", 0.97, 93, (
        ("sil open font license", "this font software is licensed under the sil open font license version 1 1"),
        ("scripts sil org ofl", "scripts sil org ofl"),
        ("reserved font name", "with reserved font name"),
    )),
    ("psf-2", 0.96, 92, (
        ("python software foundation license", "python software foundation license version 2"),
        ("psf hereby grants", "psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce"),
    )),
    ("php-3", 0.96, 92, (
        ("php license", "(?:subject to )?version 3 0(?: ?1)? of the php license"),
        ("www php net license", "www php net license 3 0(?: ?1)? txt"),
        ("this product includes php software", "this product includes php software freely available from"),
    )),
    ("ruby", 0.93, 89, (("ruby license", "under the (?:same )?(?:terms of the )?ruby(?: s)? license"), ("same terms as ruby", "redistribute it and or modify it under the same terms as ruby"))),
    ("postgresql", 0.96, 92, (("postgresql license", "(?:the )?postgresql license"), ("permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"))),
    ("openssl", 0.96, 92, (
        ("openssl project for use in the openssl toolkit", "this product includes software developed by the openssl project for use in the openssl toolkit"),
        ("eric young", "this product includes cryptographic software written by eric young"),
        ("openssl license", "(?:dual )?openssl(?: ssleay)? license"),
    )),
    ("curl", 0.94, 90, (("curl license", "(?:the )?curl license"),)),
    ("ncsa", 0.95, 91, (("university of illinois", "university of illinois ncsa open source license"),)),
    ("ms-pl", 0.95, 91, (("microsoft public license", "microsoft public license ms pl"), ("opensource org licenses ms pl", "opensource org licenses ms pl"))),
    ("ms-rl", 0.95, 91, (("microsoft reciprocal license", "microsoft reciprocal license(?: ms rl)?"),)),
    ("afl-3", 0.95, 91, (("academic free license", "(?:licensed under the )?academic free license version 3 0"),)),
    ("osl-3", 0.95, 91, (("open software license", "licensed under the open software license version 3 0"),)),
    ("qpl-1", 0.95, 91, (("q public license", "(?:the )?q public license version 1 0"),)),
    ("sleepycat", 0.95, 91, (("sleepycat license", "sleepycat license"), ("the db software", "information on how to obtain complete source code for the db software and any accompanying software"))),
    ("vim", 0.94, 90, (("help uganda", "see help uganda(?: for more information)?"), ("vim license", "(?:distributed under the )?vim license"))),
    ("w3c", 0.95, 91, (("w3c software", "w3c software (?:notice and|and document) (?:license|notice and license)"), ("www w3 org consortium legal", "www w3 org consortium legal"))),
    ("unicode", 0.95, 91, (("unicode", "unicode (?:inc )?license agreement data files and software"), ("www unicode org", "www unicode org (?:copyright|terms of use) html"))),
    ("ijg", 0.94, 90, (("independent jpeg group", "this software is based in part on the work of the independent jpeg group"),)),
    ("libpng", 0.95, 91, (("license", "(?:png reference library|libpng) license(?: version 2)?"), ("contributing authors and group 42", "the contributing authors and group 42 inc disclaim all warranties"))),
    ("ftl", 0.95, 91, (("freetype", "(?:the )?freetype (?:project )?license"), ("freetype project", "portions of this software are copyright .{0,24}?the freetype project"))),
    ("bzip2", 0.94, 90, (("bzip2", "bzip2 and libbzip2 license"),)),
    ("beerware", 0.95, 91, (("beer ware license", "(?:the )?beer ware license"), ("buy me a beer", "if we meet some day and you think this stuff is worth it you can buy me a beer in return"))),
    ("json", 0.95, 93, (("used for good not evil", "the software shall be used for good not evil"),)),
    ("hpnd", 0.93, 88, (("permission to use copy modify and distribute", "permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted"), ("historical permission notice", "historical permission notice and disclaimer"))),
    ("upl-1", 0.95, 91, (("universal permissive license", "universal permissive license (?:v|version) ?1 0"), ("oss oracle com licenses upl", "oss oracle com licenses upl"))),
    ("blueoak", 0.95, 91, (("blue oak model license", "blue oak model license(?: 1 0 0)?"),)),
    ("mulan", 0.95, 91, (("mulan", "mulan (?:psl|permissive software license)(?: v ?2)?"),)),
    ("zpl-2.1", 0.95, 91, (("zope public license", "zope public license zpl version 2 1"),)),
    ("nposl", 0.94, 90, (("non profit open software license", "non profit open software license"),)),
    ("sspl-1", 0.96, 93, (("server side public license", "server side public license(?: version 1| v ?1)?"),)),
    ("busl-1.1", 0.96, 93, (("business source license", "business source license 1 1"), ("change license", "on the change date .{0,120}?the licensor hereby grants you rights under the terms of the change license"), ("additional use grant", "additional use grant"))),
    ("elastic-2", 0.96, 93, (("elastic license", "elastic license 2 0"), ("hosted or managed service", "you may not provide the software to third parties as a hosted or managed service"))),
    ("commons-clause", 0.95, 93, (("commons clause", "commons clause license condition v1 0"), ("right to sell the software", "the grant of rights under the license will not include and the license does not grant to you the right to sell the software"))),
    ("polyform", 0.95, 92, (("polyform", "polyform (?:noncommercial|small business|strict|shield|perimeter) license"),)),
    ("rail", 0.95, 92, (("responsible ai license", "(?:bigscience |creativeml )?(?:open )?responsible ai license"), ("use based restrictions", "use based restrictions as referenced in paragraph"), ("openrail", "(?:creativeml|bigscience|bigcode) openrail(?: m| ?\\+\\+)?"))),
    ("llama", 0.95, 92, (("llama", "llama (?:2|3|3 1|3 2|3 3) community license agreement"),)),
    ("freeware", 0.85, 60, (("freeware", "this (?:software|program) is freeware"),)),
    ("shareware", 0.85, 60, (("shareware", "this (?:software|program) is shareware"),)),
    ("non-commercial", 0.85, 62, (("non commercial", "for (?:personal and )?non ?commercial (?:use|purposes) only"), ("noncommercial", "for noncommercial (?:use|purposes) only"))),
    ("research-only", 0.85, 62, (("research purposes only", "for (?:academic |non ?commercial )?research purposes only"), ("academic use only", "for academic use only"))),
    ("evaluation-only", 0.85, 62, (("evaluation purposes only", "for (?:internal )?evaluation purposes only"),)),
    ("proprietary", 0.85, 64, (
        ("proprietary", "(?:this (?:file|document|software) (?:is|contains) )?(?:confidential and proprietary|proprietary and confidential)(?: information)?"),
        ("is strictly prohibited", "unauthorized (?:copying|use|reproduction|distribution) of this (?:file|software|document|work|material)(?: via any medium)? is strictly prohibited"),
        ("trade secret", "contains trade secrets? (?:and|or) (?:confidential|proprietary) information"),
        ("end user license agreement", "end user license agreement"),
        ("without the prior written", "without the (?:express )?prior written (?:permission|consent) of the (?:publisher|author|copyright (?:holder|owner))"),
        ("reverse engineer", "you may not reverse engineer decompile or disassemble"),
        ("may not be", "may not be (?:copied|reproduced|distributed|republished) .{0,40}?without (?:prior )?(?:written )?permission"),
    )),
    ("no-derivatives", 0.85, 63, (
        ("may be reproduced", "no part of this (?:work|book|publication|document|report) may be reproduced"),
        ("stored in a retrieval system", "reproduced stored in a retrieval system or transmitted in any form or by any means"),
        ("may not be", "may not be (?:altered|modified) (?:or|and) redistributed"),
    )),
    ("warranty-disclaimer", 0.6, 22, (
        ("without warranty of any kind", "(?:is )?provided as is without warranty of any kind"),
        ("merchantability", "(?:implied )?warrant(?:y|ies) of merchantability (?:and|or)?(?: of)? ?fitness for a particular purpose"),
        ("in no event shall", "in no event shall the (?:authors?|copyright holders?|contributors) .{0,40}?be liable"),
    )),
)
