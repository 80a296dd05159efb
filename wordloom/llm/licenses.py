"""License statements by ordered signature rules.

A rule is a pattern over the words of a text, with a priority and keywords that must occur first. About two hundred are
written out from notices, headers and references; others are the licenses' names in the phrases that state a license.
Detections are spans of words: one that lies within another goes if the other's priority is higher, or equal and the span
longer; of equal spans and priorities the rule that is listed first stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.words import slices

# The words a base phrase consists of, and its label.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Label, name as it is written in words (a pattern), and words of which every text that fits has one.
NAMES = (
    ("mit", r"mit|expat", "mit expat"),
    ("apache-1.1", r"apache(?: software)? 1 1|apache(?: software)? version 1 1", "apache"),
    ("apache-2", r"apache(?: software)?(?: license)?(?: version)? 2(?: 0)?|asl 2(?: 0)?", "apache asl"),
    ("gpl-2", r"(?:gnu )?(?:gpl|general public license)(?: version)? ?(?:v ?)?2(?: 0)?|gplv2", "gpl gnu gpl2 gplv gplv2 general"),
    ("gpl-3", r"(?:gnu )?(?:gpl|general public license)(?: version)? ?(?:v ?)?3(?: 0)?|gplv3", "gpl gnu gpl3 gplv gplv3 general"),
    ("gpl", r"gnu gpl|gpl|gnu general public", "gpl gnu"),
    ("lgpl-2.1", r"(?:gnu )?(?:lgpl|lesser general public license)(?: version)? ?(?:v ?)?2 1|lgplv2 1", "lgpl lesser lgpl2 lgplv lgplv2"),
    ("lgpl-3", r"(?:gnu )?(?:lgpl|lesser general public license)(?: version)? ?(?:v ?)?3(?: 0)?|lgplv3", "lgpl lesser lgpl3 lgplv lgplv3"),
    ("lgpl", r"gnu lgpl|lgpl|(?:gnu )?lesser general public|(?:gnu )?library general public", "lgpl lesser library"),
    ("agpl-3", r"(?:gnu )?(?:agpl|affero general public license)(?: version)? ?(?:v ?)?3(?: 0)?|agplv3", "agpl affero agpl3 agplv agplv3"),
    ("agpl", r"gnu agpl|agpl|(?:gnu )?affero general public", "agpl affero"),
    ("gfdl", r"gfdl|(?:gnu )?free documentation", "gfdl documentation"),
    ("bsd-2-clause", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)", "bsd freebsd"),
    ("bsd-3-clause", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|modified bsd|new bsd|revised bsd)", "bsd"),
    ("bsd-4-clause", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)", "bsd"),
    ("bsd", r"bsd(?: style)?", "bsd"),
    ("isc", r"isc", "isc"),
    ("zlib", r"zlib(?: libpng)?", "zlib"),
    ("bsl-1.0", r"boost(?: software)?(?: license)?(?: version)?(?: 1 0)?", "boost"),
    ("mpl-1.1", r"(?:mpl|mozilla public(?: license)?)(?: version)? 1 1", "mpl mozilla"),
    ("mpl-2.0", r"(?:mpl|mozilla public(?: license)?)(?: version)? 2(?: 0)?", "mpl mozilla"),
    ("mpl", r"mpl|mozilla public", "mpl mozilla"),
    ("epl-1.0", r"(?:epl|eclipse public(?: license)?)(?: version)? ?(?:v ?)?1(?: 0)?", "epl eclipse epl1 eplv eplv1"),
    ("epl-2.0", r"(?:epl|eclipse public(?: license)?)(?: version)? ?(?:v ?)?2(?: 0)?", "epl eclipse epl2 eplv eplv2"),
    ("cddl", r"cddl|common development and distribution", "cddl distribution"),
    ("cpl-1.0", r"common public", "common"),
    ("artistic-2.0", r"artistic(?: license)?(?: version)? 2(?: 0)?", "artistic"),
    ("artistic", r"artistic", "artistic"),
    ("afl", r"academic free", "academic"),
    ("osl-3.0", r"open software", "software"),
    ("unlicense", r"unlicense", "unlicense"),
    ("wtfpl", r"wtfpl|do what the fuck you want to(?: public)?", "wtfpl fuck"),
    ("cc0", r"cc0(?: 1 0)?|cc zero|creative commons zero", "cc0 zero"),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)(?: \d 0)?", "nd noderivs derivs noderivatives derivatives"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: \d 0)?", "sa sharealike alike"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)(?: \d 0)?", "nc noncommercial commercial"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)(?: \d 0)?", "nd noderivs derivs noderivatives derivatives"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)(?: \d 0)?", "sa sharealike alike"),
    ("cc-by", r"(?:cc by|creative commons attribution)(?: \d 0)?", "cc creative"),
    ("ofl-1.1", r"(?:sil )?open font|ofl 1 1", "font ofl"),
    ("psf", r"python software foundation|psf", "python psf"),
    ("php", r"php", "php"),
    ("ruby", r"ruby", "ruby"),
    ("postgresql", r"postgresql", "postgresql"),
    ("eupl", r"eupl|european union public", "eupl european"),
    ("ms-pl", r"ms pl|microsoft public", "pl microsoft"),
    ("openssl", r"openssl", "openssl"),
    ("x11", r"x11", "x11"),
    ("ncsa", r"ncsa|university of illinois", "ncsa illinois"),
    ("proprietary", r"proprietary|commercial", "proprietary commercial"),
)

# Name of the phrase, pattern around a license's name, priority, certainty.
PHRASES = (
    ("spdx", r"spdx license identifier {name}(?: only| or later)?", 9, 1.0),
    ("licensed-under", r"(?:licensed|licenced|dual licensed) (?:to you )?under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[cs]e)?", 8, 0.95),
    ("released-under", r"(?:released|distributed|published|available|provided|made available) under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[cs]e)?", 8, 0.95),
    ("terms", r"(?:under|subject to|according to) (?:the )?(?:terms|conditions|terms and conditions) of (?:the )?{name}(?: licen[cs]e)?", 7, 0.9),
    ("under", r"under (?:the |an? )?{name} licen[cs]e", 6, 0.85),
    ("license-is", r"licen[cs]e (?:is )?(?:the )?{name}", 5, 0.7),
    ("covered", r"(?:covered|governed) by (?:the )?{name}(?: licen[cs]e)?", 5, 0.8),
    ("name-license", r"{name} licen[cs]e(?: agreement)?", 3, 0.6),
)

# Statements in fixed words: label, pattern, keywords, priority, certainty.
STATEMENTS = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby", 10, 1.0),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose", "permission", 10, 1.0),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution", 10, 1.0),
    ("zlib", r"this software is provided as is without any express or implied warranty", "warranty", 6, 0.6),
    ("gpl", r"this program is free software you can redistribute it and or modify it", "redistribute", 10, 0.95),
    ("gpl", r"gnu general public license", "gnu", 4, 0.8),
    ("gpl-2", r"gnu general public license version 2(?: 0)?", "gnu", 8, 0.95),
    ("gpl-3", r"gnu general public license version 3(?: 0)?", "gnu", 8, 0.95),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", 10, 1.0),
    ("public-domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain|is in the public domain", "domain", 7, 0.9),
    ("cc0", r"to the extent possible under law .{0,60}waived all copyright", "extent", 8, 0.9),
    ("all-rights-reserved", r"all rights (?:are )?reserved", "reserved", 2, 0.5),
    ("copyright-notice", r"copyright (?:c )?(?:19|20)\d\d", "copyright", 1, 0.3),
    ("permissive", r"may be freely (?:copied|used|distributed)", "freely", 4, 0.5),
    ("non-commercial", r"(?:for )?non ?commercial use only|not for commercial use", "commercial noncommercial", 4, 0.7),
    # Permissive notices, clause by clause.
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "permission", 9, 0.95),
    ("mit", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish", "restriction", 9, 0.95),
    ("mit", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", "merchantability", 7, 0.8),
    ("mit", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", "liable", 6, 0.7),
    ("mit", r"mit style licen[cs]e", "mit", 4, 0.7),
    ("mit-0", r"mit no attribution|spdx license identifier mit 0", "mit", 10, 0.95),
    ("x11", r"except as contained in this notice the names? of .{1,60} shall not be used in advertising", "advertising", 9, 0.95),
    ("isc", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", "hereby", 10, 1.0),
    ("isc", r"the software is provided as is and the author disclaims all warranties with regard to this software", "disclaims", 9, 0.9),
    ("0bsd", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", "hereby", 11, 1.0),
    ("0bsd", r"(?:zero clause|0 clause) bsd|bsd zero clause|spdx license identifier 0bsd", "bsd 0bsd", 9, 0.95),
    ("bsd", r"redistributions of source code must retain the above copyright notice this list of conditions", "redistributions", 9, 0.9),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice this list of conditions", "redistributions", 9, 0.9),
    ("bsd", r"use of this source code is governed by a bsd style licen[cs]e", "bsd", 10, 1.0),
    ("bsd-3-clause", r"neither the names? of .{1,80} nor the names of (?:its|their) contributors may be used to endorse or promote products", "endorse", 10, 1.0),
    ("bsd-3-clause", r"the name of the author may not be used to endorse or promote products derived from this software", "endorse", 10, 0.95),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising", 11, 1.0),
    ("bsd-source-code", r"redistributions of source code must retain the above copyright notice and the following disclaimer unmodified", "redistributions", 10, 0.9),
    ("bsd-patent", r"bsd (?:2 clause )?plus patent|spdx license identifier bsd 2 clause patent", "patent", 10, 0.95),
    ("bsd-3-clause-clear", r"no express or implied licenses to any party s patent rights are granted by this license", "patent", 10, 0.95),
    ("zlib", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "misrepresented", 10, 1.0),
    ("zlib", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", "misrepresented", 10, 1.0),
    ("libpng", r"this copyright notice may not be removed or altered from any source or altered source distribution", "altered", 8, 0.8),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "accompanying", 10, 1.0),
    ("bsl-1.0", r"distributed under the boost software license", "boost", 9, 0.95),
    ("bsl-1.0", r"license 1 0 txt or copy at http www boost org", "boost", 9, 0.95),
    ("ncsa", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files .{0,80}deal with the software without restriction", "hereby", 11, 0.95),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "hereby", 11, 1.0),
    ("hpnd", r"permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted provided that the above copyright notice appear", "hereby", 10, 0.95),
    ("ntp", r"permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted provided", "hereby", 10, 0.9),
    ("curl", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice", "hereby", 11, 0.95),
    ("bzip2", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment", "misrepresented", 11, 0.9),
    ("beerware", r"beer ware license|you can buy me a beer in return", "beer", 10, 1.0),
    ("wtfpl", r"you just do what the fuck you want to", "fuck", 10, 1.0),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software", "compile", 10, 1.0),
    ("fair", r"usage of the works is permitted provided that this instrument is retained with the works", "instrument", 10, 1.0),
    ("json", r"the software shall be used for good not evil", "evil", 10, 1.0),
    ("blessing", r"may you do good and not evil|may you find forgiveness for yourself and forgive others", "evil forgiveness", 10, 1.0),
    ("fsfap", r"copying and distribution of this file with or without modification are permitted in any medium without royalty", "royalty", 10, 1.0),
    ("fsful", r"this (?:configure script|file) is free software the free software foundation gives unlimited permission to copy", "unlimited", 10, 0.95),
    ("latex2e", r"permission is granted to make and distribute verbatim copies of this manual provided the copyright notice", "verbatim", 10, 0.9),
    ("icu", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the data files", "hereby", 11, 0.8),
    ("unicode", r"unicode inc license agreement|unicode data files and software", "unicode", 9, 0.9),
    ("tcl", r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation", "hereby", 10, 1.0),
    ("vim", r"there are no restrictions on distributing unmodified copies of vim", "vim", 10, 1.0),
    ("python-2.0", r"psf hereby grants licensee a nonexclusive royalty free world wide license", "psf", 10, 1.0),
    ("cnri-python", r"cnri hereby grants licensee a nonexclusive royalty free world wide license", "cnri", 10, 1.0),
    ("php", r"this product includes php software freely available from", "php", 10, 0.95),
    ("php", r"this source file is subject to version 3 0?1? ?of the php license", "php", 10, 1.0),
    ("zend-2.0", r"subject to version 2 00 of the zend license", "zend", 10, 1.0),
    ("openssl", r"this product includes software developed by the openssl project", "openssl", 10, 1.0),
    ("ssleay", r"this product includes cryptographic software written by eric young", "cryptographic", 10, 1.0),
    ("ijg", r"this software is based in part on the work of the independent jpeg group", "jpeg", 10, 1.0),
    ("ftl", r"portions of this software are copyright .{0,30}the freetype project", "freetype", 10, 0.95),
    ("xnet", r"this agreement shall be governed in all respects by the laws of the state of california and by the laws of the united states", "california", 5, 0.4),
    ("w3c", r"w3c software (?:notice and|and document) license", "w3c", 10, 0.95),
    ("w3c", r"permission to copy modify and distribute this work with or without modification for any purpose and without fee or royalty is hereby granted", "royalty", 10, 0.95),
    ("artistic", r"you may redistribute it and or modify it under the same terms as perl itself", "perl", 10, 1.0),
    ("artistic", r"this (?:library|program|module) is free software you (?:can|may) redistribute it and or modify it under the (?:same )?terms (?:of|as) (?:perl|the perl artistic)", "perl", 11, 1.0),
    ("artistic", r"the intent of this document is to state the conditions under which a package may be copied", "package", 10, 1.0),
    ("ruby", r"you can redistribute it and or modify it under either the terms of the gpl .{0,20}or the conditions below", "redistribute", 11, 0.95),
    ("ruby", r"distributed under the same terms as ruby", "ruby", 10, 0.95),
    # Apache and its kin.
    ("apache-2", r"you may not use this file except in compliance with the license", "compliance", 10, 0.95),
    ("apache-2", r"you may obtain a copy of the license at http(?:s)? www apache org licenses license 2 0", "apache", 11, 1.0),
    ("apache-2", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "basis", 9, 0.95),
    ("apache-2", r"licensed to the apache software foundation asf under one or more contributor license agreements", "asf", 10, 1.0),
    ("apache-2", r"see the license for the specific language governing permissions and limitations under the license", "governing", 8, 0.85),
    ("apache-2", r"licenses license 2 0(?: txt| html)?", "licenses", 6, 0.7),
    ("apache-2", r"spdx license identifier apache 2 0 (?:or|and|with) [a-z0-9 ]{1,40}", "spdx", 11, 1.0),
    ("apache-1.1", r"this product includes software developed by the apache software foundation", "apache", 9, 0.9),
    ("apache-1.0", r"this product includes software developed by the apache group", "apache", 10, 0.95),
    ("ecl-2.0", r"educational community license(?: version)?(?: 2 0)?", "educational", 10, 0.95),
    ("llvm-exception", r"apache license v2 0 with llvm exceptions|apache 2 0 with llvm exception", "llvm", 11, 1.0),
    ("elastic-2.0", r"elastic license(?: v| version )?2(?: 0)?", "elastic", 10, 0.95),
    ("sspl-1.0", r"server side public license", "server", 10, 1.0),
    ("busl-1.1", r"business source license(?: 1 1)?", "business", 10, 1.0),
    ("busl-1.1", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", "licensor", 11, 1.0),
    ("commons-clause", r"commons clause license condition|the license does not grant to you the right to sell the software", "clause sell", 10, 0.95),
    ("polyform", r"polyform (?:noncommercial|small business|shield|strict|internal use|perimeter|free trial) license", "polyform", 10, 1.0),
    ("prosperity", r"prosperity public license", "prosperity", 10, 1.0),
    ("parity", r"parity public license", "parity", 10, 1.0),
    ("hippocratic", r"hippocratic license", "hippocratic", 10, 1.0),
    ("blueoak-1.0.0", r"blue oak model license", "oak", 10, 1.0),
    ("upl-1.0", r"universal permissive license", "permissive", 10, 1.0),
    ("mulanpsl-2.0", r"mulan (?:permissive software license|psl)", "mulan", 10, 1.0),
    # The GNU family.
    ("gpl", r"this program is distributed in the hope that it will be useful but without any warranty", "hope", 9, 0.9),
    ("gpl", r"you should have received a copy of the gnu general public license along with this program", "gnu", 9, 0.95),
    ("gpl", r"either version \d(?: 0)? of the license or at your option any later version", "option", 8, 0.85),
    ("gpl-2", r"under the terms of the gnu general public license as published by the free software foundation either version 2 of the license", "gnu", 11, 1.0),
    ("gpl-3", r"under the terms of the gnu general public license as published by the free software foundation either version 3 of the license", "gnu", 11, 1.0),
    ("gpl-2", r"under the terms of the gnu general public license version 2 as published by the free software foundation", "gnu", 11, 1.0),
    ("gpl-3", r"gnu general public license as published by the free software foundation version 3", "gnu", 11, 1.0),
    ("gpl-2", r"gpl 2 0(?: or later| only)|gpl2 or later|gplv2 or later", "gpl gpl2 gplv2", 9, 0.95),
    ("gpl-3", r"gpl 3 0(?: or later| only)|gpl3 or later|gplv3 or later", "gpl gpl3 gplv3", 9, 0.95),
    ("gpl-2", r"spdx license identifier gpl 2 0(?: or later| only)?(?: with [a-z0-9 ]{1,40})?", "spdx", 10, 1.0),
    ("gpl-classpath", r"as a special exception the copyright holders of this library give you permission to link this library with independent modules", "exception", 11, 1.0),
    ("gpl-classpath", r"gpl 2 0 with classpath exception|classpath exception 2 0", "classpath", 11, 1.0),
    ("gpl-gcc", r"gcc runtime library exception", "gcc", 11, 1.0),
    ("gpl-bison", r"as a special exception you may create a larger work that contains part or all of the bison parser skeleton", "bison", 11, 1.0),
    ("gpl-autoconf", r"as a special exception to the gnu general public license if you distribute this file as part of a program that contains a configuration script", "exception", 11, 1.0),
    ("gpl-linking", r"as a special exception .{0,60}permission to link the code of (?:this program|portions of this program) with the openssl library", "openssl", 11, 1.0),
    ("gpl", r"module license gpl|module license dual [a-z]{2,8} gpl", "gpl", 9, 0.9),
    ("gpl", r"free software foundation inc (?:59 temple place|51 franklin st(?:reet)?|675 mass ave)", "foundation", 5, 0.7),
    ("gpl", r"gnu org licenses gpl(?: [23] 0)?(?: html| txt)?", "gpl", 7, 0.8),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lesser", 11, 1.0),
    ("lgpl-2", r"under the terms of the gnu library general public license as published by the free software foundation either version 2", "library", 11, 1.0),
    ("lgpl-2.1", r"gnu lesser general public license as published by the free software foundation either version 2 1", "lesser", 11, 1.0),
    ("lgpl-3", r"gnu lesser general public license as published by the free software foundation either version 3", "lesser", 11, 1.0),
    ("lgpl", r"you should have received a copy of the gnu lesser general public license along with this library", "lesser", 10, 0.95),
    ("lgpl", r"gnu org licenses lgpl(?: [23] [01])?(?: html| txt)?", "lgpl", 7, 0.8),
    ("agpl-3", r"gnu affero general public license as published by the free software foundation either version 3", "affero", 11, 1.0),
    ("agpl", r"if your software can interact with users remotely through a computer network you should also make sure", "remotely", 9, 0.9),
    ("agpl", r"you should have received a copy of the gnu affero general public license", "affero", 10, 0.95),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "documentation", 11, 1.0),
    ("gfdl", r"with no invariant sections no front cover texts and no back cover texts", "invariant", 10, 0.95),
    # Weak copyleft.
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla", 11, 1.0),
    ("mpl-2.0", r"if a copy of the mpl was not distributed with this file you can obtain one at", "mpl", 11, 1.0),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1", "mozilla", 11, 1.0),
    ("mpl-1.0", r"the contents of this file are subject to the mozilla public license version 1 0", "mozilla", 11, 1.0),
    ("mpl-tri", r"alternatively the contents of this file may be used under the terms of either the gnu general public license", "alternatively", 10, 0.95),
    ("mpl-2.0", r"incompatible with secondary licenses as defined by the mozilla public license", "mozilla", 11, 1.0),
    ("npl-1.1", r"netscape public license", "netscape", 10, 1.0),
    ("epl-1.0", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", "eclipse", 11, 1.0),
    ("epl-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "eclipse", 11, 1.0),
    ("epl-2.0", r"spdx license identifier epl 2 0(?: or [a-z0-9 ]{1,40})?", "epl", 10, 1.0),
    ("edl-1.0", r"eclipse distribution license v(?: )?1 0", "eclipse", 11, 1.0),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution license", "development", 11, 1.0),
    ("cddl", r"cddl header start|cddl header end", "cddl", 10, 0.95),
    ("cpl-1.0", r"made available under the terms of the common public license v1 0", "common", 11, 1.0),
    ("ipl-1.0", r"ibm public license(?: version)?(?: 1 0)?", "ibm", 10, 1.0),
    ("apsl", r"apple public source license(?: version)?(?: [12] [012])?", "apple", 10, 1.0),
    ("cpal-1.0", r"common public attribution license", "attribution", 10, 1.0),
    ("eupl-1.2", r"licensed under the eupl(?: version)? (?:v)?1 [12]|european union public licence v 1 [12]", "eupl european", 11, 1.0),
    ("cecill", r"this software is governed by the cecill(?: b| c)? license under french law", "cecill", 11, 1.0),
    ("cecill", r"ce logiciel est régi par la licence cecill", "cecill", 11, 1.0),
    ("qpl-1.0", r"q public license", "q", 8, 0.8),
    ("sleepycat", r"sleepycat license|sleepycat public license", "sleepycat", 10, 1.0),
    ("rpl-1.5", r"reciprocal public license", "reciprocal", 10, 1.0),
    ("ms-rl", r"microsoft reciprocal license|spdx license identifier ms rl", "microsoft rl", 10, 1.0),
    ("ms-pl", r"microsoft public license ms pl", "microsoft", 10, 1.0),
    ("ms-eula", r"microsoft software license terms", "microsoft", 9, 0.9),
    ("sgi-b-2.0", r"sgi free software license b", "sgi", 10, 1.0),
    ("sun-bcl", r"sun microsystems inc binary code license agreement", "sun", 10, 1.0),
    ("oracle-otn", r"oracle technology network license agreement", "oracle", 10, 1.0),
    ("lppl", r"latex project public license", "latex", 10, 1.0),
    ("lppl", r"this work may be distributed and or modified under the conditions of the latex project public license", "latex", 11, 1.0),
    ("osl-3.0", r"licensed under the open software license version 3 0", "software", 11, 1.0),
    ("afl-3.0", r"licensed under the academic free license version 3 0", "academic", 11, 1.0),
    ("odbl-1.0", r"open database licen[cs]e", "database", 10, 1.0),
    ("odc-by", r"open data commons attribution licen[cs]e", "commons", 10, 1.0),
    ("pddl", r"public domain dedication and licen[cs]e", "dedication", 10, 1.0),
    ("cdla-permissive", r"community data license agreement permissive", "community", 10, 1.0),
    ("cdla-sharing", r"community data license agreement sharing", "community", 10, 1.0),
    ("ogl-uk", r"open government licen[cs]e(?: v ?[123](?: 0)?)?", "government", 10, 1.0),
    # Content.
    ("cc-by", r"creativecommons org licenses by(?: [1234] [05])", "creativecommons", 9, 1.0),
    ("cc-by-sa", r"creativecommons org licenses by sa(?: [1234] [05])", "creativecommons", 10, 1.0),
    ("cc-by-nd", r"creativecommons org licenses by nd(?: [1234] [05])", "creativecommons", 10, 1.0),
    ("cc-by-nc", r"creativecommons org licenses by nc(?: [1234] [05])", "creativecommons", 10, 1.0),
    ("cc-by-nc-sa", r"creativecommons org licenses by nc sa(?: [1234] [05])", "creativecommons", 11, 1.0),
    ("cc-by-nc-nd", r"creativecommons org licenses by nc nd(?: [1234] [05])", "creativecommons", 11, 1.0),
    ("cc0", r"creativecommons org publicdomain zero 1 0|cc0 1 0 universal", "creativecommons cc0", 10, 1.0),
    ("cc-pdm", r"creativecommons org publicdomain mark 1 0", "creativecommons", 10, 1.0),
    ("cc0", r"the person who associated a work with this deed has dedicated the work to the public domain", "deed", 11, 1.0),
    ("cc-by-sa", r"text is available under the creative commons attribution share ?alike licen[cs]e", "creative", 11, 1.0),
    ("cc-unspecified", r"some rights reserved", "reserved", 4, 0.5),
    ("ofl-1.1", r"this font software is licensed under the sil open font license", "font", 11, 1.0),
    ("ofl-1.1", r"with reserved font names?", "font", 8, 0.9),
    ("bitstream-vera", r"bitstream vera (?:fonts copyright|is a trademark of bitstream)", "bitstream", 10, 1.0),
    ("ubuntu-font", r"ubuntu font licen[cs]e", "ubuntu", 10, 1.0),
    ("gutenberg", r"project gutenberg license included with this e ?book", "gutenberg", 10, 1.0),
    # Restrictions and references.
    ("proprietary", r"this (?:software|document) is the confidential and proprietary information of", "confidential", 10, 1.0),
    ("proprietary", r"unauthori[sz]ed copying of this file via any medium is strictly prohibited", "prohibited", 10, 1.0),
    ("proprietary", r"no part of this (?:publication|work|document) may be reproduced (?:or transmitted |stored |distributed )?in any form", "reproduced", 9, 0.9),
    ("proprietary", r"by (?:installing|using|downloading) (?:this|the) software you agree to be bound by the terms", "bound", 8, 0.8),
    ("proprietary", r"end user licen[cs]e agreement", "user", 7, 0.8),
    ("non-commercial", r"for (?:academic|research|educational|personal) (?:use|purposes) only", "academic research educational personal", 5, 0.7),
    ("no-derivatives", r"you may not (?:alter transform or build upon|modify or create derivative works of) this work", "alter derivative", 8, 0.85),
    ("share-alike", r"if you (?:alter transform or build upon|remix transform or build upon) (?:this work|the material) you (?:may|must) distribute", "build", 8, 0.85),
    ("see-license", r"see (?:the )?(?:accompanying )?(?:license|licence|copying|copyright)(?: txt| md)? file(?: in the project root| for (?:details|more information|copying permission|terms))?", "license licence copying copyright", 3, 0.5),
    ("see-license", r"(?:license|licence) information (?:can be found|is available) in the", "information", 3, 0.5),
    ("see-license", r"found in the license file in the root directory of this source tree", "root", 4, 0.6),
    ("public-domain", r"(?:the authors? disclaims? copyright to this source code|no copyright is claimed|not subject to copyright protection)", "copyright", 8, 0.9),
    ("public-domain", r"this work (?:is|was) (?:a work of the united states government|prepared by an officer or employee of the united states government)", "government", 9, 0.95),
)

_BREAK = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(128)) + bytes(range(128, 256))
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in _BREAK)
# Every text that a phrase fits has one of these.
_LIKELY = (b" licen", b" spdx ", b" dual licensed ", b" under ", b" covered by ", b" governed by ", b" subject to ", b" according to ")


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    keywords: tuple[bytes, ...]
    priority: int
    certainty: float


def signature_rules() -> list[Rule]:
    """All rules, the highest priority first, otherwise in the order of the tables."""

    def rule(label: str, pattern: str, words: str, priority: int, certainty: float) -> Rule:
        found = re.compile(rf" (?:{pattern})(?= )".encode())
        return Rule(label, found, tuple(w.encode() for w in words.split()), priority, certainty)

    made = [rule(*statement) for statement in STATEMENTS]
    for label, name, words in NAMES:
        for _, phrase, priority, certainty in PHRASES:
            made.append(rule(label, phrase.replace("{name}", f"(?:{name})"), words, priority, certainty))
    return sorted(made, key=lambda r: -r.priority)


class Scanner:
    """Base places and kept detections in the words of one text."""

    def __init__(self, rules: list[Rule] | None = None):
        self.rules = signature_rules() if rules is None else rules
        self.base = [(f" {phrase} ".encode(), label) for phrase, label in BASE_PHRASES.items()]
        self.keywords = sorted({k for r in self.rules for k in r.keywords})
        alone = {w for _, _, words, _, _ in STATEMENTS for w in words.split()}
        self.likely = (*_LIKELY, *(f" {w} ".encode() for w in sorted(alone)))

    def words(self, text: str) -> list[bytes]:
        """``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased."""
        return text.encode().translate(_FOLD).split(b" ")

    def base_places(self, line: bytes) -> list[tuple[int, str]]:
        """Word number and label of every place of a base phrase; ``line`` is the words between spaces."""
        out = []
        for phrase, label in self.base:
            at = line.find(phrase)
            while at >= 0:
                out.append((line.count(b" ", 0, at), label))
                at = line.find(phrase, at + 1)
        return sorted(out)

    def detections(self, line: bytes) -> list[tuple[int, int, Rule]]:
        """``(first word, word after the last, rule)`` of what the rules find and containment leaves."""
        if not any(mark in line for mark in self.likely):
            return []
        there = {k for k in self.keywords if b" " + k + b" " in line}
        found = []
        for number, rule in enumerate(self.rules):
            if there.isdisjoint(rule.keywords):
                continue
            for match in rule.pattern.finditer(line):
                first = line.count(b" ", 0, match.start())
                found.append((first, -(first + match.group().count(b" ")), number))
        # What contains a span comes before it in this order, and of equal spans the higher priority does.
        out, reach = [], {}
        for first, end, number in sorted(found):
            rule = self.rules[number]
            if max((e for p, e in reach.items() if p >= rule.priority), default=-1) < -end:
                out.append((first, -end, rule))
            reach[rule.priority] = max(-end, reach.get(rule.priority, -1))
        return out

    def scan(self, text: str) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, Rule]]]:
        words = [w for w in self.words(text) if w]
        line = b" " + b" ".join(words) + b" "
        return len(words), self.base_places(line), self.detections(line)


def scan_licenses(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words, n_base, first_word, last_word, base_labels, labels, score, detections``.

    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word`` are the word numbers where the first and
    the last of them start (NULL without one). ``labels`` has the base labels and those of the kept detections,
    distinct, sorted and joined by commas; ``score`` is the highest certainty (1 for a base phrase, 0 for
    nothing); ``detections`` holds ``(first, last, label)`` with the words' numbers, the end exclusive.

    NULL and empty texts have no words, labels '' and score 0. Texts are scanned whole, repeated rows each
    for itself; other columns are returned, those with the names of new ones are replaced.
    """
    span = T.StructType([T.StructField(n, t) for n, t in (("first", T.LongType()), ("last", T.LongType()), ("label", T.StringType()))])
    added = T.StructType(
        [
            *(T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")),
            *(T.StructField(n, T.StringType()) for n in ("base_labels", "labels")),
            T.StructField("score", T.DoubleType()),
            T.StructField("detections", T.ArrayType(span)),
        ]
    )
    kept = [c for c in df.columns if c not in added.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        kinds.append(pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string())])))
        for batch in batches:
            for part in slices(batch, text):
                rows = []
                for value in part.column(text).to_pylist():
                    n, base, found = scanner.scan(value or "")
                    labels = {label for _, label in base}
                    every = labels | {r.label for *_, r in found}
                    score = 1.0 if base else max((r.certainty for *_, r in found), default=0.0)
                    ends = (base[0][0], base[-1][0]) if base else (None, None)
                    spans = [{"first": a, "last": b, "label": r.label} for a, b, r in found]
                    rows.append((n, len(base), *ends, ",".join(sorted(labels)), ",".join(sorted(every)), score, spans))
                arrays = [part.column(c) for c in kept] + [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *added.names])

    return df.mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), *added.fields]))
