"""Signatures of licences, as ordered rules over normalised words.

Rules see a text as its words in lower case, one blank before, between and after them, so
``GPL-3.0`` is `` gpl 3 0 `` and line ends and punctuation do not matter. A rule has
keywords, all of which any match holds, a regular expression over whole words, a label, and
a kind. Kinds are in order of priority; rules of a kind are in the order they are written.
"""

from __future__ import annotations

import re
from typing import NamedTuple

#: Kinds in order of priority, and how sure a match of the kind is.
KINDS = {"tag": 1.0, "text": 0.95, "grant": 0.9, "header": 0.8, "name": 0.6, "hint": 0.3}

# Fixed values: (label, keyword, published identifier as words) of licence tags.
TAGS = [
    ("mit-0", " mit ", "mit 0"), ("mit", " mit ", "mit"), ("x11", " x11 ", "x11"), ("isc", " isc ", "isc"), ("zlib", " zlib ", "zlib"),
    ("apache-1", "apache", "apache 1 [01]"), ("apache-2", "apache", "apache 2 0"),
    ("gpl-1", " gpl ", "gpl 1 0(?: only| or later)?"), ("gpl-2", " gpl ", "gpl 2 0(?: only| or later)?"), ("gpl-3", " gpl ", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2", " lgpl ", "lgpl 2 0(?: only| or later)?"), ("lgpl-2.1", " lgpl ", "lgpl 2 1(?: only| or later)?"), ("lgpl-3", " lgpl ", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3", " agpl ", "agpl 3 0(?: only| or later)?"), ("fdl", " gfdl ", "gfdl 1 [123](?: only| or later)?"),
    ("0bsd", " 0bsd ", "0bsd"), ("bsd-2", " bsd ", "bsd 2 clause"), ("bsd-3", " bsd ", "bsd 3 clause"), ("bsd-4", " bsd ", "bsd 4 clause"),
    ("mpl-1.1", " mpl ", "mpl 1 1"), ("mpl-2", " mpl ", "mpl 2 0"), ("epl-1", " epl ", "epl 1 0"), ("epl-2", " epl ", "epl 2 0"), ("eupl", " eupl ", "eupl 1 [12]"),
    ("cddl", " cddl ", "cddl 1 [01]"), ("cecill", " cecill ", "cecill(?: b| c)?(?: [12] [01])?"), ("boost", " bsl ", "bsl 1 0"), ("artistic-1", " artistic ", "artistic 1 0"), ("artistic-2", " artistic ", "artistic 2 0"),
    ("cc0", " cc0 ", "cc0 1 0"), ("cc-by-nc-sa", " cc ", "cc by nc sa [1-4] [05]"), ("cc-by-nc-nd", " cc ", "cc by nc nd [1-4] [05]"), ("cc-by-nc", " cc ", "cc by nc [1-4] [05]"),
    ("cc-by-sa", " cc ", "cc by sa [1-4] [05]"), ("cc-by-nd", " cc ", "cc by nd [1-4] [05]"), ("cc-by", " cc ", "cc by [1-4] [05]"),
    ("unlicense", " unlicense ", "unlicense"), ("wtfpl", " wtfpl ", "wtfpl"), ("python", " psf ", "psf 2 0"), ("php", " php ", "php 3 01?"), ("ruby", " ruby ", "ruby"),
    ("postgresql", " postgresql ", "postgresql"), ("openssl", " openssl ", "openssl"), ("ofl", " ofl ", "ofl 1 [01]"), ("ms-pl", " ms ", "ms pl"), ("ms-rl", " ms ", "ms rl"),
    ("ncsa", " ncsa ", "ncsa"), ("odbl", " odbl ", "odbl 1 0"), ("odc-by", " odc ", "odc by 1 0"), ("pddl", " pddl ", "pddl 1 0"), ("vim", " vim ", "vim"), ("w3c", " w3c ", "w3c"),
    ("zpl", " zpl ", "zpl 2 [01]"), ("json", " json ", "json"), ("beerware", " beerware ", "beerware"), ("business-source", " busl ", "busl 1 1"), ("sspl", " sspl ", "sspl 1 0"),
    ("elastic", " elastic ", "elastic 2 0"), ("curl", " curl ", "curl"), ("libpng", " libpng ", "libpng(?: 2 0)?"), ("afl", " afl ", "afl 3 0"), ("osl", " osl ", "osl 3 0"), ("apsl", " apsl ", "apsl 2 0"),
    ("cpl", " cpl ", "cpl 1 0"), ("ipl", " ipl ", "ipl 1 0"), ("lppl", " lppl ", "lppl 1 3[ac]"), ("qpl", " qpl ", "qpl 1 0"), ("sleepycat", " sleepycat ", "sleepycat"), ("upl", " upl ", "upl 1 0"),
    ("unicode", " unicode ", "unicode dfs 201[56]"), ("nasa", " nasa ", "nasa 1 3"), ("etalab", " etalab ", "etalab 2 0"), ("polyform", " polyform ", "polyform (?:noncommercial|small business) 1 0 0"),
]

# Fixed values: (label, keyword, name as a pattern over words) of licences as texts call them.
NAMES = [
    ("mit-0", " mit ", "mit no attribution(?: licen[sc]e)?"),
    ("mit", " mit ", "(?:mit licen[sc]e|licen[sc]e mit)"),
    ("mit", " expat ", "expat licen[sc]e"),
    ("x11", " x11 ", "x11 licen[sc]e"),
    ("isc", " isc ", "isc licen[sc]e"),
    ("zlib", " zlib ", "zlib(?: libpng)? licen[sc]e"),
    ("libpng", " libpng ", "libpng licen[sc]e"),
    ("apache-1", "apache", "apache (?:software )?licen[sc]e (?:version |v ?)?1(?: [01])?"),
    ("apache-2", "apache", "apache (?:software )?licen[sc]e (?:version |v ?)?2(?: 0)?"),
    ("apache-2", "apache", "apache ?2(?: 0)?(?: licen[sc]e)?"),
    ("apache", "apache", "apache (?:software )?licen[sc]e"),
    ("agpl-3", "affero", "(?:gnu )?affero general public licen[sc]e (?:agpl )?(?:as published by the free software foundation )?(?:either )?(?:version |v ?)?3(?: 0)?"),
    ("agpl-3", " agpl", "(?:gnu )?agpl(?: ?v| version )? ?3(?: 0)?"),
    ("agpl", "affero", "(?:gnu )?affero general public licen[sc]e"),
    ("lgpl-2.1", "general public", "(?:gnu )?lesser general public licen[sc]e (?:lgpl )?(?:as published by the free software foundation )?(?:either )?(?:version |v ?)?2 1"),
    ("lgpl-2.1", " lgpl", "(?:gnu )?lgpl(?: ?v| version )? ?2 1"),
    ("lgpl-2", "general public", "(?:gnu )?library general public licen[sc]e (?:lgpl )?(?:version |v ?)?2(?: 0)?"),
    ("lgpl-3", "general public", "(?:gnu )?lesser general public licen[sc]e (?:lgpl )?(?:as published by the free software foundation )?(?:either )?(?:version |v ?)?3(?: 0)?"),
    ("lgpl-3", " lgpl", "(?:gnu )?lgpl(?: ?v| version )? ?3(?: 0)?"),
    ("lgpl", "general public", "(?:gnu )?(?:lesser|library) general public licen[sc]e"),
    ("gpl-1", "general public", "(?:gnu )?general public licen[sc]e (?:gpl )?(?:version |v ?)?1(?: 0)?"),
    ("gpl-2", "general public", "(?:gnu )?general public licen[sc]e (?:gpl )?(?:as published by the free software foundation )?(?:either )?(?:version |v ?)?2(?: 0)?"),
    ("gpl-2", " gpl", "(?:gnu )?gpl(?: ?v| version )? ?2(?: 0)?"),
    ("gpl-3", "general public", "(?:gnu )?general public licen[sc]e (?:gpl )?(?:as published by the free software foundation )?(?:either )?(?:version |v ?)?3(?: 0)?"),
    ("gpl-3", " gpl", "(?:gnu )?gpl(?: ?v| version )? ?3(?: 0)?"),
    ("gpl", "general public", "(?:gnu )?general public licen[sc]e"),
    ("gpl", " gpl", "(?:gnu )?gpl"),
    ("fdl", "free documentation", "(?:gnu )?free documentation licen[sc]e(?: (?:version |v ?)?1 [123])?"),
    ("0bsd", " bsd ", "(?:zero|0) clause bsd licen[sc]e"),
    ("bsd-2", " bsd ", "(?:simplified|freebsd|(?:2|two) clause) bsd licen[sc]e"),
    ("bsd-2", " bsd ", "bsd (?:2|two) clause(?: licen[sc]e)?"),
    ("bsd-3", " bsd ", "(?:new|revised|modified|(?:3|three) clause) bsd licen[sc]e"),
    ("bsd-3", " bsd ", "bsd (?:3|three) clause(?: licen[sc]e)?"),
    ("bsd-4", " bsd ", "(?:original|old|(?:4|four) clause) bsd licen[sc]e"),
    ("bsd", " bsd ", "bsd(?: style)? licen[sc]e"),
    ("mpl-1.1", "mozilla", "mozilla public licen[sc]e (?:mpl )?(?:version |v ?)?1 1"),
    ("mpl-2", "mozilla", "mozilla public licen[sc]e (?:mpl )?(?:version |v ?)?2(?: 0)?"),
    ("mpl", "mozilla", "mozilla public licen[sc]e"),
    ("epl-1", "eclipse", "eclipse public licen[sc]e (?:epl )?(?:version |v ?)?1(?: 0)?"),
    ("epl-2", "eclipse", "eclipse public licen[sc]e (?:epl )?(?:version |v ?)?2(?: 0)?"),
    ("epl", "eclipse", "eclipse public licen[sc]e"),
    ("eupl", "european union", "european union public licen[sc]e"),
    ("cddl", "common development", "common development and distribution licen[sc]e"),
    ("cecill", " cecill ", "cecill(?: b| c)? licen[sc]e"),
    ("boost", " boost ", "boost software licen[sc]e"),
    ("artistic-2", " artistic ", "artistic licen[sc]e (?:version |v ?)?2(?: 0)?"),
    ("artistic-1", " artistic ", "artistic licen[sc]e (?:version |v ?)?1(?: 0)?"),
    ("artistic", " artistic ", "artistic licen[sc]e"),
    ("cc0", " cc0 ", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-sa", " cc ", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", " cc ", "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc", " cc ", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-sa", " cc ", "cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", " cc ", "cc by nd(?: [1-4] [05])?"),
    ("cc-by", " cc ", "cc by [1-4] [05]"),
    ("cc-by-nc-sa", "creative commons", "creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: [^ ]+)? licen[sc]e"),
    ("cc-by-nc-nd", "creative commons", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?:works)?(?: [1-4] [05])?(?: [^ ]+)? licen[sc]e"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: [1-4] [05])?(?: [^ ]+)? licen[sc]e"),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: [1-4] [05])?(?: [^ ]+)? licen[sc]e"),
    ("cc-by-nd", "creative commons", "creative commons attribution no ?deriv(?:ative)?s?(?:works)?(?: [1-4] [05])?(?: [^ ]+)? licen[sc]e"),
    ("cc-by", "creative commons", "creative commons attribution(?: [1-4] [05])?(?: [^ ]+)? licen[sc]e"),
    ("cc0", "creative commons", "creative commons zero"),
    ("cc", "creative commons", "creative commons licen[sc]e"),
    ("unlicense", " unlicense ", "the unlicense"),
    ("wtfpl", " wtfpl ", "wtfpl"),
    ("wtfpl", "what the", "do what the [^ ]+ you want to public licen[sc]e"),
    ("python", " python ", "python software foundation licen[sc]e"),
    ("php", " php ", "php licen[sc]e"),
    ("ruby", " ruby ", "ruby licen[sc]e"),
    ("postgresql", " postgresql ", "postgresql licen[sc]e"),
    ("openssl", " openssl ", "openssl licen[sc]e"),
    ("ofl", "open font", "(?:sil )?open font licen[sc]e"),
    ("ms-pl", "microsoft", "microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[sc]e"),
    ("ncsa", " ncsa ", "(?:university of illinois )?ncsa open source licen[sc]e"),
    ("odbl", "open database", "open database licen[sc]e"),
    ("odc-by", "open data commons", "open data commons attribution licen[sc]e"),
    ("pddl", "open data commons", "open data commons public domain dedication(?: and licen[sc]e)?"),
    ("openrail", "openrail", "(?:[^ ]+ )?openrail(?: ?m)?(?: licen[sc]e)?"),
    ("vim", " vim ", "vim licen[sc]e"),
    ("w3c", " w3c ", "w3c software (?:notice and )?licen[sc]e"),
    ("zpl", " zope ", "zope public licen[sc]e"),
    ("json", " json ", "json licen[sc]e"),
    ("beerware", "beer", "beer ?ware licen[sc]e"),
    ("business-source", "business source", "business source licen[sc]e"),
    ("sspl", "server side", "server side public licen[sc]e"),
    ("elastic", " elastic ", "elastic licen[sc]e"),
    ("commons-clause", "commons clause", "commons clause"),
    ("polyform", "polyform", "polyform (?:noncommercial|small business|shield|strict|perimeter) licen[sc]e"),
    ("afl", " academic ", "academic free licen[sc]e"),
    ("osl", "open software", "open software licen[sc]e"),
    ("apsl", " apple ", "apple public source licen[sc]e"),
    ("cpl", "common public", "common public licen[sc]e"),
    ("ipl", " ibm ", "ibm public licen[sc]e"),
    ("lppl", " latex ", "latex project public licen[sc]e"),
    ("qpl", "public", "q public licen[sc]e"),
    ("sleepycat", "sleepycat", "sleepycat licen[sc]e"),
    ("upl", "universal", "universal permissive licen[sc]e"),
    ("unicode", " unicode ", "unicode licen[sc]e(?: agreement)?"),
    ("nasa", " nasa ", "nasa open source agreement"),
    ("etalab", "etalab", "etalab open licen[sc]e"),
    ("curl", " curl ", "curl licen[sc]e"),
]

# Fixed values: (label, keywords, wording as a pattern over words) from licence texts and their notices.
TEXTS = [
    ("boost", ("hereby granted",), "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("mit", ("hereby granted",), "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", ("substantial portions",), "permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", ("hereby granted",), "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", ("source and binary",), "redistribution and use in source and binary forms with or without modification are permitted provided that"),
    ("bsd-3", ("endorse",), "neither the name of [^ ]+(?: [^ ]+){0,12} nor the names of (?:its|their) contributors may be used to endorse"),
    ("bsd-4", ("advertising materials",), "all advertising materials mentioning features or use of this software must display"),
    ("apache-2", ("except in compliance",), "you may not use this file except in compliance with the licen[sc]e"),
    ("apache-2", ("unless required",), "unless required by applicable law or agreed to in writing software distributed under the licen[sc]e"),
    ("agpl-3", ("affero", "either version 3"), "under the terms of the gnu affero general public licen[sc]e as published by the free software foundation either version 3 of the licen[sc]e"),
    ("lgpl-3", ("lesser", "either version 3"), "under the terms of the gnu lesser general public licen[sc]e as published by the free software foundation either version 3 of the licen[sc]e"),
    ("lgpl-2.1", ("lesser", "either version 2"), "under the terms of the gnu lesser general public licen[sc]e as published by the free software foundation either version 2 1 of the licen[sc]e"),
    ("gpl-3", ("general public", "either version 3"), "under the terms of the gnu general public licen[sc]e as published by the free software foundation either version 3 of the licen[sc]e"),
    ("gpl-2", ("general public", "either version 2"), "under the terms of the gnu general public licen[sc]e as published by the free software foundation either version 2 of the licen[sc]e"),
    ("gpl", ("free software",), "this program is free software you can redistribute it and or modify it"),
    ("lgpl", ("free software",), "this library is free software you can redistribute it and or modify it"),
    ("fdl", ("invariant sections",), "with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-2", ("source code form",), "this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0"),
    ("mpl-1.1", ("mozilla",), "the contents of this file are subject to the mozilla public licen[sc]e version 1 1"),
    ("zlib", ("held liable",), "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", ("unencumbered",), "this is free and unencumbered software released into the public domain"),
    ("wtfpl", ("you want to",), "you just do what the [^ ]+ you want to"),
    ("cc0", ("waived",), "to the extent possible under law [^ ]+(?: [^ ]+){0,12} (?:has|have) waived all copyright"),
    ("ofl", ("font software",), "this font software is licensed under the sil open font licen[sc]e"),
    ("epl", ("eclipse",), "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e"),
    ("cddl", ("common development",), "the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    ("json", ("not evil",), "the software shall be used for good not evil"),
    ("beerware", ("beer",), "if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("openssl", ("openssl",), "this product includes software developed by the openssl project"),
    ("python", ("python",), "psf is making python available to licensee on an as is basis"),
    ("postgresql", ("without a written agreement",), "without fee and without a written agreement is hereby granted"),
    ("artistic", ("standard version",), "give (?:away )?verbatim copies of the source form of the standard version"),
    ("public-domain", ("public domain",), "(?:placed|released|dedicated|donated) (?:in|into|to) the public domain"),
    ("proprietary", ("proprietary",), "(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", ("strictly prohibited",), "unauthori[sz]ed (?:copying|use|reproduction|distribution)(?: [^ ]+){0,12} is strictly prohibited"),
    ("proprietary", ("prior written",), "may (?:not )?be (?:reproduced|copied|distributed|transmitted)(?: [^ ]+){0,24} without (?:the )?prior written (?:permission|consent)"),
]

# Weak signs that name no licence.
HINTS = [
    ("all-rights-reserved", ("all rights reserved",), "all rights reserved"),
    ("unnamed", ("licensed under",), "licensed under the [^ ]+(?: [^ ]+){0,4} licen[sc]e"),
    ("unnamed", ("license",), "see (?:the )?(?:accompanying )?license (?:file|txt|md)"),
    ("unnamed", ("dual",), "dual licen[sc]ed"),
    ("unnamed", ("terms",), "subject to (?:the )?(?:following )?licen[sc]e terms"),
]

_GRANT = "(?:licen[sc]ed|released|distributed|redistributed|available|published|provided|offered|shared|covered)(?: [^ ]+)? (?:under|by) (?:the )?(?:terms (?:and conditions )?of )?(?:the |an |a )?"
_HEADER = "licen[sc]es? (?:is |are |type )?(?:the )?"


class Rule(NamedTuple):
    label: str
    kind: str
    keywords: tuple[str, ...]
    pattern: re.Pattern[bytes]


def _rule(label: str, kind: str, keywords: tuple[str, ...], words: str) -> Rule:
    return Rule(label, kind, keywords, re.compile(f"(?<= )(?:{words})(?= )".encode()))


def rules() -> list[Rule]:
    """All rules in order of priority."""
    by_kind = {
        "tag": [_rule(label, "tag", ("spdx", key), f"spdx licen[sc]e identifier {words}") for label, key, words in TAGS],
        "text": [_rule(label, "text", keys, words) for label, keys, words in TEXTS],
        "grant": [_rule(label, "grant", (key,), _GRANT + words) for label, key, words in NAMES],
        "header": [_rule(label, "header", (key,), _HEADER + words) for label, key, words in NAMES],
        "name": [_rule(label, "name", (key,), words) for label, key, words in NAMES],
        "hint": [_rule(label, "hint", keys, words) for label, keys, words in HINTS],
    }
    return [rule for kind in KINDS for rule in by_kind[kind]]
