"""Signature rules of the license scan, in the order in which they count.

Patterns run over a text whose words are parted by single spaces, so they consist of words, spaces and groups. A rule
only runs where one of its keywords, whole words too, stands. Three rules are made of each license: its tag, its grant
and its name; notices and whole sentences have rules of their own.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    pattern: str
    keywords: tuple[str, ...]
    #: 1 to 4: tags and whole notices, grants, names, mere mentions. A smaller number wins.
    priority: int
    #: Places of base rules are reported even where another rule covers them.
    base: bool = False


# Phrases and labels that are always reported.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_VERSION = "(?: version| v)?"
_GNU = "(?:the )?(?:gnu )?"
_CC = "(?:cc|creative commons)"
_LICENSE = "licen[cs]e"

# label: (keywords, tag after "spdx license identifier", name). A name is tried as a whole, the longest first.
LICENSES: dict[str, tuple[str, str, str]] = {
    "apache-1.0": ("apache", "apache 1 0", f"apache(?: software)? {_LICENSE}{_VERSION} 1 0"),
    "apache-1.1": ("apache", "apache 1 1", f"apache(?: software)? {_LICENSE}{_VERSION} 1 1"),
    "apache-2.0": ("apache|asl 2 0", "apache 2 0", f"apache(?: software)?(?: {_LICENSE})?{_VERSION} 2(?: 0)?(?: {_LICENSE})?|asl 2 0"),
    "apache": ("apache license|apache licence|apache software", "apache", f"apache(?: software)? {_LICENSE}"),
    "mit": ("mit license|mit licence|mit licensed|mit expat|mit x11|expat license|expat licence", "mit", f"(?:mit|expat|mit expat|mit x11) {_LICENSE}|mit licensed"),
    "mit-0": ("mit 0|mit no attribution", "mit 0", f"mit(?: 0| no attribution)(?: {_LICENSE})?"),
    "x11": ("x11|mit x", "x11", f"x11 {_LICENSE}|mit x(?: consortium)? {_LICENSE}"),
    "bsd-0-clause": ("0bsd|zero clause|0 clause", "0bsd", f"0bsd|(?:bsd )?(?:zero|0) clause(?: bsd)?(?: {_LICENSE})?"),
    "bsd-2-clause": ("bsd|freebsd", "bsd 2 clause", f"(?:2|two) clause bsd(?: {_LICENSE})?|bsd (?:2|two) clause(?: {_LICENSE})?|(?:simplified|freebsd) bsd {_LICENSE}|freebsd {_LICENSE}"),
    "bsd-3-clause": ("bsd", "bsd 3 clause", f"(?:3|three) clause bsd(?: {_LICENSE})?|bsd (?:3|three) clause(?: {_LICENSE})?|(?:new|revised|modified) bsd {_LICENSE}"),
    "bsd-4-clause": ("bsd", "bsd 4 clause", f"(?:4|four) clause bsd(?: {_LICENSE})?|bsd (?:4|four) clause(?: {_LICENSE})?|(?:original|old) bsd {_LICENSE}"),
    "bsd": ("bsd", "bsd", f"bsd(?: style| type)? {_LICENSE}"),
    "isc": ("isc", "isc", f"isc {_LICENSE}"),
    "zlib": ("zlib", "zlib", f"zlib(?: libpng)? {_LICENSE}"),
    "libpng": ("libpng|png reference library", "libpng(?: 2 0)?", f"(?:lib)?png reference library {_LICENSE}|libpng {_LICENSE}"),
    "gpl-1.0": ("gpl|general public", "gpl 1 0(?: only| or later)?", f"{_GNU}(?:gpl|general public {_LICENSE}){_VERSION} 1(?: 0)?"),
    "gpl-2.0": ("gpl|gplv2|gpl2|general public", "gpl 2 0(?: only| or later)?", f"{_GNU}(?:gpl|general public {_LICENSE}){_VERSION} 2(?: 0)?(?: only| or(?: any)? later(?: version)?)?|gplv?2"),
    "gpl-3.0": ("gpl|gplv3|gpl3|general public", "gpl 3 0(?: only| or later)?", f"{_GNU}(?:gpl|general public {_LICENSE}){_VERSION} 3(?: 0)?(?: only| or(?: any)? later(?: version)?)?|gplv?3"),
    "gpl": ("gpl|general public", "gpl", f"{_GNU}(?:gpl|general public {_LICENSE})"),
    "lgpl-2.0": ("lgpl|library general public|lesser general public", "lgpl 2 0(?: only| or later)?", f"{_GNU}(?:lgpl|l(?:ibrary|esser) general public {_LICENSE}){_VERSION} 2(?: 0)?"),
    "lgpl-2.1": ("lgpl|lgplv2 1|lesser general public", "lgpl 2 1(?: only| or later)?", f"{_GNU}(?:lgpl|lesser general public {_LICENSE}){_VERSION} 2 1(?: only| or(?: any)? later(?: version)?)?|lgplv2 1"),
    "lgpl-3.0": ("lgpl|lgplv3|lesser general public", "lgpl 3 0(?: only| or later)?", f"{_GNU}(?:lgpl|lesser general public {_LICENSE}){_VERSION} 3(?: 0)?(?: only| or(?: any)? later(?: version)?)?|lgplv3"),
    "lgpl": ("lgpl|lesser general public|library general public", "lgpl", f"{_GNU}(?:lgpl|l(?:esser|ibrary) general public {_LICENSE})"),
    "agpl-3.0": ("agpl|agplv3|affero general public", "agpl 3 0(?: only| or later)?", f"{_GNU}(?:agpl|affero general public {_LICENSE}){_VERSION} 3(?: 0)?(?: only| or(?: any)? later(?: version)?)?|agplv3"),
    "agpl": ("agpl|affero general public", "agpl", f"{_GNU}(?:agpl|affero general public {_LICENSE})"),
    "gfdl-1.3": ("gfdl|free documentation", "gfdl 1 3(?: only| or later)?", f"{_GNU}(?:gfdl|free documentation {_LICENSE}){_VERSION} 1 3"),
    "gfdl": ("gfdl|free documentation", "gfdl", f"{_GNU}(?:gfdl|free documentation {_LICENSE})"),
    "mpl-1.1": ("mpl|mozilla public", "mpl 1 1", f"(?:mpl|mozilla public {_LICENSE}){_VERSION} 1 1"),
    "mpl-2.0": ("mpl|mozilla public", "mpl 2 0", f"(?:mpl|mozilla public {_LICENSE}){_VERSION} 2(?: 0)?"),
    "mpl": ("mozilla public", "mpl", f"mozilla public {_LICENSE}"),
    "epl-1.0": ("epl|eclipse public", "epl 1 0", f"(?:epl|eclipse public {_LICENSE}){_VERSION} 1 0"),
    "epl-2.0": ("epl|eclipse public", "epl 2 0", f"(?:epl|eclipse public {_LICENSE}){_VERSION} 2 0"),
    "epl": ("eclipse public", "epl", f"eclipse public {_LICENSE}"),
    "edl-1.0": ("eclipse distribution", "edl 1 0", f"eclipse distribution {_LICENSE}(?:{_VERSION} 1 0)?"),
    "cddl-1.0": ("cddl|common development and distribution", "cddl 1 0", f"(?:cddl|common development and distribution {_LICENSE}){_VERSION} 1 0"),
    "cddl": ("cddl|common development and distribution", "cddl", f"cddl|common development and distribution {_LICENSE}"),
    "cpl-1.0": ("common public", "cpl 1 0", f"common public {_LICENSE}(?:{_VERSION} 1 0)?"),
    "ipl-1.0": ("ibm public", "ipl 1 0", f"ibm public {_LICENSE}(?:{_VERSION} 1 0)?"),
    "eupl-1.2": ("eupl|european union public", "eupl 1 2", f"(?:eupl|european union public {_LICENSE})(?:{_VERSION} 1 2)?"),
    "osl-3.0": ("open software", "osl 3 0", f"open software {_LICENSE}(?:{_VERSION} 3 0)?"),
    "afl-3.0": ("academic free", "afl 3 0", f"academic free {_LICENSE}(?:{_VERSION} 3 0)?"),
    "artistic-1.0": ("artistic license|artistic licence|artistic 1 0", "artistic 1 0(?: perl)?", f"artistic {_LICENSE}{_VERSION} 1 0"),
    "artistic-2.0": ("artistic", "artistic 2 0", f"artistic(?: {_LICENSE})?{_VERSION} 2 0"),
    "artistic": ("artistic license|artistic licence", "artistic", f"artistic {_LICENSE}"),
    "bsl-1.0": ("boost|bsl 1 0", "bsl 1 0", f"boost software {_LICENSE}(?:{_VERSION} 1 0)?|bsl 1 0"),
    "busl-1.1": ("business source|busl", "busl 1 1", f"business source {_LICENSE}(?:{_VERSION} 1 1)?|busl 1 1"),
    "ms-pl": ("ms pl|microsoft public", "ms pl", f"ms pl|microsoft public {_LICENSE}"),
    "ms-rl": ("ms rl|microsoft reciprocal", "ms rl", f"ms rl|microsoft reciprocal {_LICENSE}"),
    "psf-2.0": ("python software foundation|psf license|psf licence|psf 2 0", "(?:psf|python) 2 0", f"(?:python software foundation|psf) {_LICENSE}(?:{_VERSION} 2(?: 0)?)?"),
    "php-3.01": ("php license|php licence", "php 3 01", f"php {_LICENSE}(?:{_VERSION} 3 01)?"),
    "ruby": ("ruby license|ruby licence|ruby s license|ruby s licence", "ruby", f"ruby(?: s)? {_LICENSE}"),
    "openssl": ("openssl", "openssl", f"openssl {_LICENSE}"),
    "w3c": ("w3c", "w3c", f"w3c(?: software)?(?: notice and)? {_LICENSE}"),
    "unlicense": ("unlicense", "unlicense", "unlicense"),
    "wtfpl": ("wtfpl", "wtfpl", "wtfpl"),
    "upl-1.0": ("universal permissive|upl 1 0", "upl 1 0", f"universal permissive {_LICENSE}(?:{_VERSION} 1 0)?|upl 1 0"),
    "ncsa": ("ncsa", "ncsa", f"(?:university of illinois )?ncsa(?: open source)? {_LICENSE}"),
    "postgresql": ("postgresql", "postgresql", f"postgresql {_LICENSE}"),
    "ofl-1.1": ("sil open font|open font|ofl 1 1", "ofl 1 1", f"(?:sil )?open font {_LICENSE}(?:{_VERSION} 1 1)?|ofl 1 1"),
    "lppl-1.3c": ("lppl|latex project public", "lppl 1 3c", f"(?:lppl|latex project public {_LICENSE})(?:{_VERSION} 1 3c?)?"),
    "json": ("json license|json licence", "json", f"json {_LICENSE}"),
    "beerware": ("beerware|beer ware", "beerware", f"beer ?ware(?: {_LICENSE})?"),
    "blueoak-1.0.0": ("blue oak model|blueoak 1 0 0", "blueoak 1 0 0", f"blue oak model {_LICENSE}(?:{_VERSION} 1 0 0)?"),
    "mulan-psl-2.0": ("mulan", "mulanpsl 2 0", f"mulan(?: permissive software)? {_LICENSE}(?:{_VERSION} 2(?: 0)?)?"),
    "sspl-1.0": ("sspl|server side public", "sspl 1 0", f"(?:sspl|server side public {_LICENSE})(?:{_VERSION} 1(?: 0)?)?"),
    "elastic-2.0": ("elastic license|elastic licence", "elastic 2 0", f"elastic {_LICENSE}(?:{_VERSION} 2 0)?"),
    "odbl-1.0": ("odbl|open database", "odbl 1 0", f"odbl|open(?: data commons open)? database {_LICENSE}(?:{_VERSION} 1 0)?"),
    "odc-by-1.0": ("odc by|open data commons attribution", "odc by 1 0", f"odc by|open data commons attribution {_LICENSE}(?:{_VERSION} 1 0)?"),
    "pddl-1.0": ("pddl|public domain dedication and", "pddl 1 0", f"(?:open data commons )?public domain dedication and {_LICENSE}"),
    "cc0-1.0": ("cc0|cc zero|creative commons zero", "cc0 1 0", f"cc0(?: 1 0)?(?: universal)?|{_CC} zero(?: {_LICENSE})?"),
    "cc-by-nc-nd": ("cc by|cc attribution|creative commons", "cc by nc nd [1-4] [05]", f"{_CC} (?:by|attribution) (?:nc|non ?commercial) (?:nd|no ?derivatives|no ?derivs)(?: [1-4] [05])?"),
    "cc-by-nc-sa": ("cc by|cc attribution|creative commons", "cc by nc sa [1-4] [05]", f"{_CC} (?:by|attribution) (?:nc|non ?commercial) (?:sa|share ?alike)(?: [1-4] [05])?"),
    "cc-by-nc": ("cc by|cc attribution|creative commons", "cc by nc [1-4] [05]", f"{_CC} (?:by|attribution) (?:nc|non ?commercial)(?: [1-4] [05])?"),
    "cc-by-nd": ("cc by|cc attribution|creative commons", "cc by nd [1-4] [05]", f"{_CC} (?:by|attribution) (?:nd|no ?derivatives|no ?derivs)(?: [1-4] [05])?"),
    "cc-by-sa": ("cc by|cc attribution|creative commons", "cc by sa [1-4] [05]", f"{_CC} (?:by|attribution) (?:sa|share ?alike)(?: [1-4] [05])?"),
    "cc-by-4.0": ("cc by|cc attribution|creative commons", "cc by 4 0", f"{_CC} (?:by|attribution){_VERSION} 4 0(?: international)?"),
    "cc-by-3.0": ("cc by|cc attribution|creative commons", "cc by 3 0", f"{_CC} (?:by|attribution){_VERSION} 3 0(?: unported)?"),
    "cc-by-2.0": ("cc by|cc attribution|creative commons", "cc by 2 [05]", f"{_CC} (?:by|attribution){_VERSION} 2 [05](?: generic)?"),
}

# label: (keywords, pattern, priority): whole notices, and words that merely hint at terms.
NOTICES: list[tuple[str, str, str, int]] = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy(?: of this software and associated documentation files)?", 1),
    ("mit", "substantial portions of the software", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 1),
    ("isc", "permission to use copy modify", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", 1),
    ("bsd", "redistribution and use in source", "redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?", 1),
    ("bsd-3-clause", "endorse or promote products", "neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse or promote products", 1),
    ("bsd-4-clause", "all advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 1),
    ("apache-2.0", "apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", 1),
    ("apache-2.0", "apache org", "(?:https? )?(?:www )?apache org licenses license 2 0", 1),
    ("gpl", "free software you can redistribute", "this (?:program|library|file) is free software you can redistribute it and or modify it under the terms of the gnu(?: lesser| library| affero)? general public license", 1),
    ("gpl-2.0", "general public", "general public license as published by the free software foundation (?:either )?version 2(?: of the license)?", 1),
    ("gpl-3.0", "general public", "general public license as published by the free software foundation (?:either )?version 3(?: of the license)?", 1),
    ("lgpl", "lesser general public", "terms of the gnu lesser general public license as published by the free software foundation", 1),
    ("agpl", "affero general public", "terms of the gnu affero general public license as published by the free software foundation", 1),
    ("mpl-2.0", "mozilla public", "this source code form is subject to the terms of the mozilla public license v 2 0", 1),
    ("epl-2.0", "eclipse public", "made available under the terms of the eclipse public license 2 0", 1),
    ("epl-1.0", "eclipse public", "made available under the terms of the eclipse public license v1 0", 1),
    ("bsl-1.0", "boost software", "distributed under the boost software license version 1 0 see accompanying file", 1),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", 1),
    ("unlicense", "released into the public domain", "this is free and unencumbered software released into the public domain", 1),
    ("public-domain", "public domain", "(?:dedicated to|placed in|released (?:in)?to|in) the public domain", 2),
    ("public-domain", "public domain", "public domain (?:work|software|dedication)", 3),
    ("wtfpl", "do what the fuck you want", "do what the fuck you want to(?: public license)?", 1),
    ("beerware", "buy me a beer", "you can buy me a beer in return", 1),
    ("cc0-1.0", "waived all copyright", "(?:has|have) waived all copyright and related(?: or neighboring)? rights", 1),
    ("cc-by-sa", "creativecommons org", "creativecommons org licenses by sa [1-4] [05]", 1),
    ("cc-by-nc-sa", "creativecommons org", "creativecommons org licenses by nc sa [1-4] [05]", 1),
    ("cc-by-nc-nd", "creativecommons org", "creativecommons org licenses by nc nd [1-4] [05]", 1),
    ("cc-by-nc", "creativecommons org", "creativecommons org licenses by nc [1-4] [05]", 1),
    ("cc-by-nd", "creativecommons org", "creativecommons org licenses by nd [1-4] [05]", 1),
    ("cc-by-4.0", "creativecommons org", "creativecommons org licenses by 4 0", 1),
    ("cc-by-3.0", "creativecommons org", "creativecommons org licenses by 3 0", 1),
    ("cc0-1.0", "creativecommons org", "creativecommons org publicdomain zero 1 0", 1),
    ("cc", "creative commons", f"(?:under )?(?:a |the )?creative commons {_LICENSE}", 3),
    ("cc", "creative commons", "creative commons", 4),
    ("cc-by", "creative commons attribution", f"creative commons attribution(?: {_LICENSE})?", 3),
    ("no-warranty", "as is", "(?:provided|distributed|supplied) as is(?: basis)? without (?:any )?(?:warranty|warranties)(?: of any kind)?", 2),
    ("no-warranty", "warranty", "without (?:any )?warranty(?: of any kind)?(?: express or implied)?", 3),
    ("no-warranty", "without warranties", "without warranties or conditions of any kind", 3),
    ("proprietary", "confidential and proprietary|proprietary and confidential", "(?:confidential and proprietary|proprietary and confidential)(?: information)?", 2),
    ("proprietary", "unauthorized copying", "unauthorized copying of this (?:file|software|document)(?: via any medium)? is strictly prohibited", 1),
    ("proprietary", "proprietary license|proprietary licence", f"proprietary {_LICENSE}", 3),
    ("non-commercial", "commercial use|noncommercial use", "for (?:personal |private )?(?:and )?non ?commercial use(?: only)?", 2),
    ("non-commercial", "personal use only", "for personal use only", 2),
    ("no-redistribution", "may not be reproduced", "may not be reproduced(?: or| distributed| copied| transmitted| republished| in whole| in part){0,8}(?: without (?:the )?(?:prior )?(?:written )?permission)?", 2),
    ("no-redistribution", "do not distribute|not for redistribution|not for distribution", "do not distribute|not for (?:re)?distribution", 2),
    ("reserved", "all rights reserved", "copyright(?: c)?(?: (?:19|20)[0-9]{2}){1,4}(?: [^ ]+){1,6} all rights reserved", 1),
    ("reserved", "some rights reserved", "some rights reserved", 3),
    ("reserved", "rights reserved worldwide", "(?:all )?rights reserved worldwide", 2),
    ("eula", "end user license agreement|end user licence agreement", f"end user {_LICENSE} agreement", 2),
    ("copyright", "copyright", "copyright(?: c)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?", 3),
    ("copyright", "copyright notice|copyright holder|copyright holders", "copyright (?:notice|holders?)", 4),
    ("license-file", "license file|license txt|license md|licence file|licence txt|licence md", f"(?:see|read) (?:the )?(?:accompanying )?{_LICENSE}(?: file| txt| md)(?: for (?:more )?details)?", 4),
    ("dual-license", "dual licensed|dual license|dual licence|dual licensing", "dual licens(?:ed|e|ing)", 3),
    ("open-source", "open source license|open source licence|open source licenses|open source licences", f"open source {_LICENSE}s?", 4),
]

TAG = "spdx license identifier"
GRANT = (
    "(?:(?:dual )?licensed|released|distributed|available|published|provided|covered|governed|offered|issued|shared|redistributable|free)"
    " (?:under|by)(?: an?)?(?: the)?(?: (?:terms(?: and conditions)?|conditions) of)?(?: the)? "
)


def all_rules() -> list[Rule]:
    """The rules in order: base ones last, as any other may cover them."""
    tags, grants, names = [], [], []
    for label, (keywords, tag, name) in LICENSES.items():
        words = tuple(keywords.split("|"))
        tags.append(Rule(label, f"{TAG} {tag}", (TAG,), 1))
        grants.append(Rule(label, f"{GRANT}(?:{name})", words, 2))
        names.append(Rule(label, name, words, 3))
    notices = [Rule(label, pattern, tuple(keywords.split("|")), priority) for label, keywords, pattern, priority in NOTICES]
    base = [Rule(label, phrase, (phrase,), 4, True) for phrase, label in BASE.items()]
    return [*tags, *notices, *grants, *names, *base]
