"""Signatures of licenses and notices, written by hand: bodies, headers, links, tags, references, names.

A signature is a pattern over lower-case words with single spaces between them: line breaks, comment
marks and punctuation are taken out of the text first (runs of up to twelve characters). Links are
matched in the text as it is.
"""

from __future__ import annotations

#: priorities: what is more specific wins over what it contains
BODY, HEADER, LINK, TAG, REFERENCE, NAME, NOTICE = 90, 80, 70, 60, 50, 30, 20

_V = r"(?: (?:version|ver|v))? ?"
_LATER = r"(?: or(?: (?:at your option|later|any later version))+)?"

SIGNATURES: tuple[tuple[str, int, str], ...] = (
    # permissive bodies
    ("mit", BODY, r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", BODY, r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-0", BODY, r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("x11", BODY, r"except as contained in this notice the names? of (?:the )?x consortium shall not be used in advertising"),
    ("x11", BODY, r"except as contained in this notice the names? of the (?:above )?(?:copyright holders?|authors?) shall not be used in advertising"),
    ("icu", BODY, r"provided that the above copyright notices? and this permission notice appear in all copies of the software and that both the above copyright notices? and this permission notice appear in supporting documentation"),
    ("isc", BODY, r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", BODY, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("hpnd", BODY, r"permission to use copy modify and distribute this software and its documentation for any purpose(?: and)? without fee is hereby granted"),
    ("ntp", BODY, r"permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted"),
    ("bsd", BODY, r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", BODY, r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", BODY, r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"),
    ("bsd-3-clause", BODY, r"neither the names? of [\w .,&'()-]{1,120}?(?:nor the names of (?:its|their|other) contributors )?may be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", BODY, r"the names? of [\w .,&'()-]{1,80}?may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", BODY, r"all advertising materials mentioning features or use of this software must display the following acknowledgements?"),
    ("bsd-patent", BODY, r"each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("bsd-clear", BODY, r"no express or implied licenses to any party s patent rights are granted by this license"),
    ("beerware", BODY, r"as long as you retain this notice you can do whatever you want with this stuff if we meet some day"),
    ("zlib", BODY, r"this software is provided as is without any express or implied warranty in no event will the authors? be held liable for any damages"),
    ("zlib", BODY, r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", BODY, r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("boost-1.0", BODY, r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", BODY, r"this is free and unencumbered software released into the public domain"),
    ("unlicense", BODY, r"anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary"),
    ("wtfpl", BODY, r"you just do what the fuck you want to"),
    ("curl", BODY, r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement of third party rights"),
    ("postgresql", BODY, r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("python-2.0", BODY, r"this license agreement is between the python software foundation psf and the individual or organization"),
    ("python-2.0", BODY, r"psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test perform"),
    ("openssl", BODY, r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", BODY, r"this product includes cryptographic software written by eric young"),
    ("openldap-2.8", BODY, r"redistributions in source form must retain copyright statements and notices redistributions in binary form must reproduce applicable copyright statements"),
    ("vim", BODY, r"there are no restrictions on distributing unmodified copies of vim except that they must include this license text"),
    ("imagemagick", BODY, r"before we get to the text of the license lets just review what the license says in simple terms"),
    ("libpng", BODY, r"the png reference library is supplied as is the (?:contributing authors|png reference library authors) and group 42"),
    ("ijg", BODY, r"this software is based in part on the work of the independent jpeg group"),
    ("freetype", BODY, r"portions of this software are copyright [\w ,()-]{0,40}?the freetype project"),
    ("unicode", BODY, r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("w3c", BODY, r"permission to copy modify and distribute this (?:software|work)(?: and its documentation)? with or without modification for any purpose and without fee or royalty is hereby granted"),
    ("w3c", BODY, r"notice of any changes or modifications (?:to the w3c files including the date changes were made|through a copyright statement on the new code or document)"),
    ("afl", BODY, r"licensed under the academic free license version \d"),
    ("ncsa", BODY, r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction"),
    ("eupl", BODY, r"the european union public licen[cs]e the eupl applies to the work"),
    ("blessing", BODY, r"may you do good and not evil may you find forgiveness for yourself and forgive others"),
    ("json", BODY, r"the software shall be used for good not evil"),
    ("fair", BODY, r"usage of the works is permitted provided that this instrument is retained with the works"),
    ("artistic", BODY, r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2.0", BODY, r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("ofl-1.1", BODY, r"the font software may be modified altered or added to and in particular the designs of glyphs"),
    ("ofl-1.1", BODY, r"permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("ofl-1.1", BODY, r"neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    ("bitstream-vera", BODY, r"permission is hereby granted free of charge to any person obtaining a copy of the fonts accompanying this license"),
    # apache, mozilla, eclipse and kin: bodies and headers
    ("apache-2.0", HEADER, r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2.0", HEADER, r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2.0", BODY, r"terms and conditions for use reproduction and distribution 1 definitions"),
    ("apache-2.0", BODY, r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", BODY, r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:except as stated in this section )?(?:copyright|patent) license"),
    ("apache-1.1", BODY, r"the end user documentation included with the redistribution if any must include the following acknowledge?ment this product includes software developed by the apache software foundation"),
    ("apache-1.1", BODY, r"products derived from this software may not be called apache nor may apache appear in their name"),
    ("mpl-2.0", HEADER, r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", HEADER, r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", HEADER, r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.0", HEADER, r"the contents of this file are subject to the mozilla public license version 1 0"),
    ("mpl", BODY, r"this source code form is incompatible with secondary licenses as defined by the mozilla public license"),
    ("npl", HEADER, r"the contents of this file are subject to the netscape public license"),
    ("epl-1.0", HEADER, r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", HEADER, r"this program and the accompanying materials are made available under the terms of the eclipse public license(?: v)? 2 0"),
    ("epl", BODY, r"the accompanying program is provided under the terms of this eclipse public license"),
    ("edl-1.0", HEADER, r"eclipse distribution license v ?1 0 which (?:accompanies this distribution|is available at)"),
    ("cpl-1.0", BODY, r"the accompanying program is provided under the terms of this common public license"),
    ("ipl-1.0", BODY, r"the accompanying program is provided under the terms of this ibm public license"),
    ("cddl", HEADER, r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cddl", HEADER, r"you can obtain a copy of the license at usr src opensolaris license or"),
    ("apsl", HEADER, r"this file contains original code and or modifications of original code as defined in and that are subject to the apple public source license"),
    ("lppl", HEADER, r"this work may be distributed and or modified under the conditions of the latex project public license"),
    ("lppl", HEADER, r"this work has the lppl maintenance status"),
    ("ms-pl", BODY, r"this license governs use of the accompanying software if you use the software you accept this license"),
    ("osl-3.0", HEADER, r"licensed under the open software license version 3 0"),
    ("qpl", BODY, r"this license applies to any software containing a notice placed by the copyright holder saying that it may be distributed under the terms of the q public license"),
    ("sleepycat", BODY, r"redistributions in any form must be accompanied by information on how to obtain complete source code for the (?:db )?software"),
    ("php-3.01", BODY, r"products derived from this software may not be called php nor may php appear in their name"),
    ("zpl", BODY, r"this software is subject to the provisions of the zope public license"),
    ("erlang", HEADER, r"the contents of this file are subject to the erlang public license"),
    ("cecill", BODY, r"this software is governed by the cecill(?: [bc])? license under french law and abiding by the rules of distribution of free software"),
    ("cecill", BODY, r"ce logiciel est regi par la licence cecill"),
    ("mulan-psl", HEADER, r"you can use this software according to the terms and conditions of the mulan psl"),
    ("upl-1.0", BODY, r"the universal permissive license upl version 1 0 subject to the condition set forth below"),
    # the gnu family
    ("gnu-gpl", HEADER, r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gnu-gpl", HEADER, r"(?:this file is part of|is free software) [\w .-]{0,60}?you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gnu-gpl-2.0", HEADER, r"under the terms of the gnu general public license as published by the free software foundation(?: either)? version 2"),
    ("gnu-gpl-3.0", HEADER, r"under the terms of the gnu general public license as published by the free software foundation(?: either)? version 3"),
    ("gnu-gpl", HEADER, r"you should have received a copy of the gnu general public license along with"),
    ("gnu-gpl", BODY, r"the licenses for most software (?:and other practical works )?are designed to take away your freedom to share and change (?:it|the works)"),
    ("gnu-gpl", BODY, r"the gnu general public license is (?:intended to guarantee your freedom to share and change|a free copyleft license for software)"),
    ("gnu-gpl-2.0", BODY, r"gnu general public license version 2 june 1991"),
    ("gnu-gpl-3.0", BODY, r"gnu general public license version 3 29 june 2007"),
    ("gnu-gpl-1.0", BODY, r"gnu general public license version 1 february 1989"),
    ("gnu-lgpl", HEADER, r"under the terms of the gnu (?:lesser|library) general public license"),
    ("gnu-lgpl-2.0", HEADER, r"gnu library general public license as published by the free software foundation(?: either)? version 2"),
    ("gnu-lgpl-2.1", HEADER, r"gnu lesser general public license as published by the free software foundation(?: either)? version 2 1"),
    ("gnu-lgpl-3.0", HEADER, r"gnu lesser general public license as published by the free software foundation(?: either)? version 3"),
    ("gnu-lgpl", HEADER, r"you should have received a copy of the gnu (?:lesser|library) general public license"),
    ("gnu-lgpl-2.1", BODY, r"gnu lesser general public license version 2 1 february 1999"),
    ("gnu-lgpl-2.0", BODY, r"gnu library general public license version 2 june 1991"),
    ("gnu-lgpl-3.0", BODY, r"gnu lesser general public license version 3 29 june 2007"),
    ("gnu-agpl", HEADER, r"under the terms of the gnu affero general public license"),
    ("gnu-agpl-3.0", HEADER, r"gnu affero general public license as published by the free software foundation(?: either)? version 3"),
    ("gnu-agpl-3.0", HEADER, r"gnu affero general public license as published by the free software foundation either version 3"),
    ("gnu-agpl", HEADER, r"you should have received a copy of the gnu affero general public license"),
    ("gnu-agpl-3.0", BODY, r"gnu affero general public license version 3 19 november 2007"),
    ("gnu-fdl", HEADER, r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gnu-fdl", BODY, r"with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts"),
    ("gcc-exception", BODY, r"under section 7 of gpl version 3 you are granted additional permissions described in the gcc runtime library exception"),
    ("classpath-exception", BODY, r"linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("bison-exception", BODY, r"as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("autoconf-exception", BODY, r"as a special exception (?:to the gnu general public license )?(?:if you distribute this file as part of a program that contains a configuration script generated by autoconf|the free software foundation gives unlimited permission)"),
    ("openssl-exception", BODY, r"in addition as a special exception [\w ,]{1,80}?permission to link the code of (?:this program|portions of this program) with (?:the )?openssl"),
    ("fsf-all-permissive", BODY, r"copying and distribution of this file with or without modification are permitted in any medium without royalty provided the copyright notice and this notice are preserved"),
    ("fsf-unlimited", BODY, r"this file is free software the free software foundation gives unlimited permission to copy and or distribute it"),
    # creative commons and data
    ("cc0-1.0", BODY, r"creative commons legal code cc0 1 0 universal"),
    ("cc0-1.0", HEADER, r"to the extent possible under law [\w .,-]{1,80}?(?:has|have) waived all copyright and related or neighboring rights"),
    ("cc-attribution", BODY, r"you are free to share copy and redistribute the material in any medium or format adapt remix transform and build upon the material"),
    ("cc-attribution", BODY, r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-sa", BODY, r"if you remix transform or build upon the material you must distribute your contributions under the same license as the original"),
    ("cc-by-nc", BODY, r"you may not use the material for commercial purposes"),
    ("cc-by-nd", BODY, r"if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc-attribution", BODY, r"the work as defined below is provided under the terms of this creative commons public license"),
    ("cc-by-sa", HEADER, r"(?:text|content|this (?:work|article|page|image)) is (?:available|licensed) under (?:the |a )?creative commons attribution share ?alike"),
    ("cc-by-nc-nd", HEADER, r"under (?:the |a )?creative commons attribution non ?commercial no ?deriv(?:ative)?s?"),
    ("cc-by-nc-sa", HEADER, r"under (?:the |a )?creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", HEADER, r"under (?:the |a )?creative commons attribution non ?commercial"),
    ("cc-by-nd", HEADER, r"under (?:the |a )?creative commons attribution no ?deriv(?:ative)?s?"),
    ("cc-attribution", HEADER, r"under (?:the |a )?creative commons attribution(?: \d \d)?(?: (?:international|unported|generic))? licen[cs]e"),
    ("cc", NAME, r"some rights reserved"),
    ("odbl-1.0", HEADER, r"this [\w ]{1,60}?is made available under the open database licen[cs]e"),
    ("odbl-1.0", HEADER, r"any rights in individual contents of the database are licensed under the database contents licen[cs]e"),
    ("odc-by-1.0", HEADER, r"is made available under the open data commons attribution licen[cs]e"),
    ("pddl-1.0", HEADER, r"is made available under the public domain dedication and licen[cs]e"),
    ("dl-de-by-2.0", NAME, r"datenlizenz deutschland namensnennung"),
    ("etalab", NAME, r"licence ouverte(?: open licence)?"),
    ("ogl-3.0", HEADER, r"contains public sector information licensed under the open government licen[cs]e"),
    ("ogl", NAME, r"open government licen[cs]e"),
    ("cdla", NAME, r"community data license agreement"),
    ("public-domain", HEADER, r"this (?:work|file|software|code|image|document) (?:is|has been) (?:placed |released )?(?:in|into) the public domain"),
    ("public-domain", HEADER, r"(?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", HEADER, r"is in the public domain in the united states"),
    ("us-government", HEADER, r"work of the (?:united states|u s) (?:federal )?government"),
    ("gutenberg", HEADER, r"this ebook is for the use of anyone anywhere (?:in the united states and most other parts of the world )?at no cost and with almost no restrictions whatsoever"),
    ("gutenberg", HEADER, r"the full project gutenberg license"),
    # model and source-available licenses
    ("openrail", BODY, r"use based restrictions as referenced in paragraph 5"),
    ("openrail", NAME, r"(?:big ?science|creativeml|big ?code) open ?rail(?: (?:m|\+\+))?"),
    ("llama-community", HEADER, r"llama \d(?: \d)? community license agreement"),
    ("gemma", HEADER, r"gemma is provided under and subject to the gemma terms of use"),
    ("bsl-1.1", BODY, r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("bsl-1.1", HEADER, r"use of this software is governed by the business source license"),
    ("sspl-1.0", HEADER, r"under the terms of the server side public license version 1"),
    ("elastic-2.0", BODY, r"you may not provide the software to third parties as a hosted or managed service"),
    ("elastic-2.0", HEADER, r"licensed under the elastic license 2 0"),
    ("commons-clause", BODY, r"the license does not grant to you and you may not exercise the right to sell the software"),
    ("polyform", BODY, r"(?:the licensor grants you a copyright license for the software to do everything you might do with the software that would otherwise infringe|any noncommercial purpose is a permitted purpose)"),
    ("confluent", HEADER, r"licensed under the confluent community license"),
    ("timescale", HEADER, r"licensed under the timescale license"),
    # commercial terms and rights notices
    ("commercial", BODY, r"this software is (?:the )?(?:confidential and )?proprietary (?:information|property) of"),
    ("commercial", BODY, r"you shall not disclose such confidential information and shall use it only in accordance with the terms of the license agreement"),
    ("commercial", BODY, r"unauthori[sz]ed (?:copying|use|reproduction|distribution) of this (?:file|software|material|document)[\w ,]{0,40}?is strictly prohibited"),
    ("commercial", BODY, r"by (?:installing|downloading|using|accessing) (?:or otherwise using )?(?:this|the) software you agree to be bound by"),
    ("commercial", BODY, r"you may not (?:reverse engineer|decompile|disassemble)"),
    ("commercial", HEADER, r"proprietary and confidential"),
    ("commercial", HEADER, r"commercial licen[cs]e agreement"),
    ("commercial", HEADER, r"end user licen[cs]e agreement"),
    ("commercial", NAME, r"for internal use only"),
    ("non-commercial", HEADER, r"for (?:personal and )?non ?commercial use only"),
    ("non-commercial", HEADER, r"(?:free|licensed) for non ?commercial (?:use|purposes)"),
    ("evaluation", HEADER, r"for evaluation purposes only"),
    ("shareware", NAME, r"this (?:program|software) is shareware"),
    ("freeware", NAME, r"this (?:program|software) is freeware"),
    ("no-redistribution", HEADER, r"no part of this (?:publication|book|work|document) may be reproduced"),
    ("no-redistribution", HEADER, r"may not be (?:reproduced|republished|redistributed|rewritten)[\w ,]{0,60}?without (?:the )?(?:express |prior |written )*(?:permission|consent)"),
    ("no-redistribution", HEADER, r"(?:reproduction|republication|redistribution) (?:in whole or in part )?without (?:written )?permission is prohibited"),
    ("press", HEADER, r"this material may not be published broadcast rewritten or redistributed"),
    ("syndicated", HEADER, r"this article (?:was originally published|originally appeared|is republished)[\w ,]{0,60}?under a creative commons licen[cs]e"),
    ("open-access", HEADER, r"this is an open access article distributed under the terms of the creative commons"),
    ("open-access", HEADER, r"which permits unrestricted use distribution and reproduction in any medium provided the original (?:work|author)"),
    ("all-rights", NAME, r"all rights are reserved"),
    ("tous-droits", NAME, r"tous droits reserves|tous droits r.serv.s"),
    ("alle-rechte", NAME, r"alle rechte vorbehalten"),
    ("derechos", NAME, r"todos los derechos reservados"),
    ("diritti", NAME, r"tutti i diritti riservati"),
    ("direitos", NAME, r"todos os direitos reservados"),
    ("permission", NOTICE, r"(?:used|reprinted|reproduced) (?:by|with)(?: kind)? permission"),
    ("fair-use", NOTICE, r"fair use (?:notice|disclaimer|doctrine)"),
    ("as-is", NOTICE, r"provided as is without (?:any )?warranty"),
    ("as-is", NOTICE, r"without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("no-liability", NOTICE, r"in no event shall (?:the )?(?:authors?|copyright holders?|contributors?|regents)[\w ]{0,60}?be liable"),
    ("copyright", NOTICE, r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?"),
    ("trademark", NOTICE, r"(?:is a|are) (?:registered )?trademarks? of"),
    ("patent", NOTICE, r"(?:patents? pending|protected by (?:one or more )?(?:u s )?patents?)"),
    ("dmca", NOTICE, r"digital millennium copyright act"),
    ("see-license", NOTICE, "|".join(rf"see (?:the )?(?:accompanying |enclosed |included )?{form.format(w)}" for w in ("license", "licence", "copying") for form in ("file {}", "{} (?:txt|md)", "{}(?: file| for| in the)"))),
    ("dual", REFERENCE, r"dual licen[cs]ed|licensed under either of"),
    ("mit", REFERENCE, r"licen[cs]ed(?: under)?(?: the)? (?:mit|expat)(?: licen[cs]e)?(?: and| or)? apache|apache(?: licen[cs]e)?(?: version)? 2(?: 0)? (?:and|or) mit"),
    ("apache-2.0", REFERENCE, r"mit(?: licen[cs]e)?(?: and| or)?(?: the)? apache(?: licen[cs]e)?(?: version| v)? ?2(?: 0)?"),
    ("apache-2.0", REFERENCE, r"licen[cs]ed(?: under)?(?: the)? apache(?: licen[cs]e)?(?: version| v)? ?2(?: 0)?(?= (?:and |or )?mit)"),
    # links
    ("apache-2.0", LINK, r"apache\.org/licenses/license-2\.0"),
    ("apache-1.1", LINK, r"apache\.org/licenses/license-1\.1"),
    ("gnu-gpl", LINK, r"gnu\.org/(?:licenses|copyleft)/gpl(?:\.html|\.txt|/)?"),
    ("gnu-gpl-2.0", LINK, r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gnu-gpl-3.0", LINK, r"gnu\.org/licenses/gpl-3\.0"),
    ("gnu-lgpl", LINK, r"gnu\.org/(?:licenses|copyleft)/lgpl"),
    ("gnu-lgpl-2.1", LINK, r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("gnu-lgpl-3.0", LINK, r"gnu\.org/licenses/lgpl-3\.0"),
    ("gnu-agpl-3.0", LINK, r"gnu\.org/licenses/agpl-3\.0"),
    ("gnu-fdl", LINK, r"gnu\.org/(?:licenses|copyleft)/fdl"),
    ("mpl-2.0", LINK, r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("mpl-1.1", LINK, r"mozilla\.org/mpl/mpl-1\.1"),
    ("epl-1.0", LINK, r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", LINK, r"eclipse\.org/legal/epl-(?:2\.0|v20)"),
    ("mit", LINK, r"opensource\.org/licenses?/mit"),
    ("bsd-2-clause", LINK, r"opensource\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", LINK, r"opensource\.org/licenses?/bsd-3-clause"),
    ("isc", LINK, r"opensource\.org/licenses?/isc"),
    ("osl-3.0", LINK, r"opensource\.org/licenses?/osl-3\.0"),
    ("boost-1.0", LINK, r"boost\.org/license_1_0"),
    ("unlicense", LINK, r"unlicense\.org"),
    ("wtfpl", LINK, r"wtfpl\.net"),
    ("ofl-1.1", LINK, r"scripts\.sil\.org/ofl"),
    ("python-2.0", LINK, r"python\.org/(?:psf/license|download/releases/[\d.]+/license)"),
    ("php-3.01", LINK, r"php\.net/license/3_01"),
    ("zpl", LINK, r"zope\.org/resources/zpl"),
    ("cddl", LINK, r"opensolaris\.org/os/licensing"),
    ("eupl", LINK, r"(?:joinup\.ec\.europa\.eu|ec\.europa\.eu)/[\w/-]{0,60}eupl"),
    ("odbl-1.0", LINK, r"opendatacommons\.org/licenses/odbl"),
    ("odc-by-1.0", LINK, r"opendatacommons\.org/licenses/by"),
    ("pddl-1.0", LINK, r"opendatacommons\.org/licenses/pddl"),
    ("cc0-1.0", LINK, r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("public-domain", LINK, r"creativecommons\.org/publicdomain/mark/1\.0"),
    *((f"{stem}-{v}", LINK, rf"creativecommons\.org/licenses/{part}/{v[0]}\.{v[2]}") for stem, part in (("cc-attribution", "by"), ("cc-by-sa", "by-sa"), ("cc-by-nc", "by-nc"), ("cc-by-nd", "by-nd"), ("cc-by-nc-sa", "by-nc-sa"), ("cc-by-nc-nd", "by-nc-nd")) for v in ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("ogl", LINK, r"nationalarchives\.gov\.uk/doc/open-government-licence"),
    ("etalab", LINK, r"etalab\.gouv\.fr/licence-ouverte"),
    ("dl-de-by-2.0", LINK, r"govdata\.de/dl-de/by-2-0"),
    ("gutenberg", LINK, r"gutenberg\.(?:org|net)/license"),
    ("json", LINK, r"json\.org/license"),
    ("bsl-1.1", LINK, r"mariadb\.com/bsl11"),
    ("elastic-2.0", LINK, r"elastic\.co/licensing/elastic-license"),
    ("spdx", LINK, r"spdx\.org/licenses/[\w.+-]+"),
    # references without the usual phrasing
    ("gnu-gpl", REFERENCE, rf"under (?:the )?(?:gnu )?gpl{_V}(?:v?\d)?{_LATER}"),
    ("mit", REFERENCE, r"(?:mit|x11|expat)(?: style)? licensed"),
    ("bsd", REFERENCE, r"bsd(?: style)? licensed"),
    ("apache", REFERENCE, r"(?:apache|asl) ?2(?: 0)? licensed"),
    ("creative-commons", REFERENCE, r"under (?:a|the) creative commons licen[cs]e"),
    ("creative-commons", NAME, r"creative commons"),
    ("open-source", NAME, r"open source licen[cs]es?"),
    ("copyleft", NAME, r"copyleft licen[cs]e"),
    ("perl", REFERENCE, r"under the same terms as perl itself"),
    ("ruby", REFERENCE, r"under the (?:same )?terms (?:as|of) ruby"),
)

#: identifiers of a tag line and the labels that they stand for
IDENTIFIERS: dict[str, str] = {
    "mit": "mit", "mit-0": "mit-0", "isc": "isc", "x11": "x11", "0bsd": "0bsd", "bsd-2-clause": "bsd-2-clause", "bsd-3-clause": "bsd-3-clause", "bsd-4-clause": "bsd-4-clause", "bsl-1.0": "boost-1.0", "zlib": "zlib",
    "apache-1.0": "apache-1.0", "apache-1.1": "apache-1.1", "apache-2.0": "apache-2.0", "mpl-1.0": "mpl-1.0", "mpl-1.1": "mpl-1.1", "mpl-2.0": "mpl-2.0", "epl-1.0": "epl-1.0", "epl-2.0": "epl-2.0",
    "gpl-1.0": "gnu-gpl-1.0", "gpl-2.0": "gnu-gpl-2.0", "gpl-3.0": "gnu-gpl-3.0", "lgpl-2.0": "gnu-lgpl-2.0", "lgpl-2.1": "gnu-lgpl-2.1", "lgpl-3.0": "gnu-lgpl-3.0", "agpl-1.0": "gnu-agpl-1.0", "agpl-3.0": "gnu-agpl-3.0",
    "gfdl-1.1": "gnu-fdl-1.1", "gfdl-1.2": "gnu-fdl-1.2", "gfdl-1.3": "gnu-fdl-1.3", "cddl-1.0": "cddl-1.0", "cddl-1.1": "cddl-1.1", "cpl-1.0": "cpl-1.0", "ipl-1.0": "ipl-1.0", "eupl-1.1": "eupl-1.1", "eupl-1.2": "eupl-1.2",
    "artistic-1.0": "artistic-1.0", "artistic-2.0": "artistic-2.0", "python-2.0": "python-2.0", "psf-2.0": "python-2.0", "php-3.0": "php-3.0", "php-3.01": "php-3.01", "postgresql": "postgresql", "ncsa": "ncsa", "openssl": "openssl",
    "ofl-1.0": "ofl-1.0", "ofl-1.1": "ofl-1.1", "unlicense": "unlicense", "wtfpl": "wtfpl", "ms-pl": "ms-pl", "ms-rl": "ms-rl", "osl-3.0": "osl-3.0", "afl-3.0": "afl-3.0", "lppl-1.3c": "lppl", "vim": "vim", "zpl-2.1": "zpl",
    "cc0-1.0": "cc0-1.0", "cc-by-3.0": "cc-attribution-3.0", "cc-by-4.0": "cc-attribution-4.0", "cc-by-sa-3.0": "cc-by-sa-3.0", "cc-by-sa-4.0": "cc-by-sa-4.0", "cc-by-nc-4.0": "cc-by-nc-4.0", "cc-by-nd-4.0": "cc-by-nd-4.0",
    "cc-by-nc-sa-4.0": "cc-by-nc-sa-4.0", "cc-by-nc-nd-4.0": "cc-by-nc-nd-4.0", "odbl-1.0": "odbl-1.0", "pddl-1.0": "pddl-1.0", "odc-by-1.0": "odc-by-1.0", "busl-1.1": "bsl-1.1", "sspl-1.0": "sspl-1.0", "elastic-2.0": "elastic-2.0",
    "blueoak-1.0.0": "blueoak-1.0.0", "upl-1.0": "upl-1.0", "hpnd": "hpnd", "json": "json", "beerware": "beerware", "ijg": "ijg", "w3c": "w3c", "curl": "curl", "cecill-2.1": "cecill", "mulanpsl-2.0": "mulan-psl",
}
