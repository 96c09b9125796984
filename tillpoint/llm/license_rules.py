"""Signature rules of the license scan.

A rule is matched on a text's words, lower case, with one blank between (so "2.0" is "2 0" and
"MPL-2.0" is "mpl 2 0").  ``keywords`` are words of which every match holds at least one, one for each
alternative ("rail|openrail" in the lists below), or with a star the beginnings of words.
Rules are ordered: class first (see ``CLASSES``), then their place in this list.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    kind: str  # a key of CLASSES
    keywords: tuple[str, ...]
    pattern: str


# Priority (smaller wins) and confidence of the classes of rules.
CLASSES = {"base": (0, 0.9), "tag": (1, 1.0), "text": (2, 0.95), "notice": (3, 0.9),
           "url": (3, 0.85), "name": (4, 0.6), "generic": (5, 0.3)}

_V = r"(?:(?:version|v|ver) ?)?"
_LIC = r"licen[sc]e"
# label, keywords, name as it stands in prose, SPDX tags (words)
LICENSES = [
    ("mit", "mit|expat", rf"(?:mit|expat)(?: x11)? {_LIC}", "mit"),
    ("mit-0", "mit", rf"mit(?: 0| no attribution) {_LIC}", "mit 0"),
    ("apache-2", "apache", rf"apache(?: software)? {_LIC}s? {_V}2(?: 0)?", "apache 2 0"),
    ("apache-1-1", "apache", rf"apache(?: software)? {_LIC} {_V}1 1", "apache 1 1"),
    ("apache-1", "apache", rf"apache(?: software)? {_LIC} {_V}1 0", "apache 1 0"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?", "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?", "cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?", "cc by nd(?: [1-4] [05])?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?", "cc by(?: [1-4] [05])?"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("gpl-3", "gnu", rf"gnu general public {_LIC} {_V}3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl-2", "gnu", rf"gnu general public {_LIC} {_V}2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-1", "gnu", rf"gnu general public {_LIC} {_V}1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-3", "gpl*", rf"gpl ?{_V}3(?: 0)?", "gpl 3"),
    ("gpl-2", "gpl*", rf"gpl ?{_V}2(?: 0)?", "gpl 2"),
    ("lgpl-3", "gnu", rf"gnu (?:lesser|library) general public {_LIC} {_V}3(?: 0)?",
     "lgpl 3 0(?: only| or later)?"),
    ("lgpl-2-1", "gnu", rf"gnu (?:lesser|library) general public {_LIC} {_V}2 1",
     "lgpl 2 1(?: only| or later)?"),
    ("lgpl-2", "gnu", rf"gnu (?:lesser|library) general public {_LIC} {_V}2(?: 0)?",
     "lgpl 2 0(?: only| or later)?"),
    ("agpl-3", "gnu", rf"gnu affero general public {_LIC}(?: {_V}3(?: 0)?)?",
     "agpl 3 0(?: only| or later)?"),
    ("agpl-1", "affero", rf"affero general public {_LIC} {_V}1(?: 0)?", "agpl 1 0"),
    ("gfdl", "gnu", rf"gnu free documentation {_LIC}(?: {_V}1 [123])?", "gfdl 1 [123]"),
    ("bsd-2-clause", "bsd", rf"(?:simplified|freebsd|2 clause) bsd {_LIC}|bsd 2 clause(?: {_LIC})?",
     "bsd 2 clause"),
    ("bsd-3-clause", "bsd",
     rf"(?:new|modified|revised|3 clause) bsd {_LIC}|bsd 3 clause(?: {_LIC})?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", rf"(?:original|old|4 clause) bsd {_LIC}|bsd 4 clause(?: {_LIC})?",
     "bsd 4 clause"),
    ("0bsd", "bsd", rf"zero clause bsd(?: {_LIC})?|bsd zero clause {_LIC}", "0bsd"),
    ("mpl-2", "mozilla", rf"mozilla public {_LIC} {_V}2(?: 0)?", "mpl 2 0"),
    ("mpl-1-1", "mozilla", rf"mozilla public {_LIC} {_V}1 1", "mpl 1 1"),
    ("mpl-1", "mozilla", rf"mozilla public {_LIC} {_V}1 0", "mpl 1 0"),
    ("epl-2", "eclipse", rf"eclipse public {_LIC} {_V}2(?: 0)?", "epl 2 0"),
    ("epl-1", "eclipse", rf"eclipse public {_LIC} {_V}1(?: 0)?", "epl 1 0"),
    ("edl-1", "eclipse", rf"eclipse distribution {_LIC}(?: {_V}1(?: 0)?)?", "edl 1 0"),
    ("cddl-1", "cddl", rf"cddl(?: {_LIC})?(?: {_V}1 [01])?", "cddl 1 [01]"),
    ("cddl-1", "common", rf"common development and distribution {_LIC}(?: {_V}1 [01])?", "cddl 1"),
    ("cpl-1", "common", rf"common public {_LIC}(?: {_V}1(?: 0)?)?", "cpl 1 0"),
    ("isc", "isc", rf"isc {_LIC}", "isc"),
    ("zlib", "zlib", rf"zlib(?: libpng)? {_LIC}", "zlib"),
    ("libpng", "libpng", rf"libpng {_LIC}(?: {_V}2)?", "libpng(?: 2 0)?"),
    ("bsl-1", "boost", rf"boost software {_LIC}(?: {_V}1(?: 0)?)?", "bsl 1 0"),
    ("busl-1-1", "business", rf"business source {_LIC}(?: {_V}1 1)?", "busl 1 1"),
    ("unlicense", "unlicense", r"(?:the )?unlicense(?: license)?", "unlicense"),
    ("wtfpl", "wtfpl", rf"wtfpl(?: {_LIC})?(?: {_V}2)?", "wtfpl"),
    ("artistic-2", "artistic", rf"artistic {_LIC} {_V}2(?: 0)?", "artistic 2 0"),
    ("artistic-1", "artistic", rf"artistic {_LIC}(?: {_V}1(?: 0)?)?", "artistic 1 0(?: perl)?"),
    ("perl", "perl", rf"same terms as perl(?: itself| 5)?|perl {_LIC}", "perl"),
    ("python-2", "python|psf", rf"python software foundation {_LIC}(?: {_V}2)?|psf {_LIC}",
     "(?:psf|python) 2 0"),
    ("php-3", "php", rf"php {_LIC}(?: {_V}3 ?0?1?)?", "php 3 01?"),
    ("ruby", "ruby", rf"ruby {_LIC}", "ruby"),
    ("postgresql", "postgresql", rf"postgresql {_LIC}", "postgresql"),
    ("openssl", "openssl", rf"openssl {_LIC}", "openssl"),
    ("ofl-1-1", "open", rf"(?:sil )?open font {_LIC}(?: {_V}1 1)?", "ofl 1 1"),
    ("odbl-1", "open", rf"open (?:data commons open )?database {_LIC}(?: {_V}1(?: 0)?)?", "odbl 1 0"),
    ("odc-by", "open", rf"open data commons attribution {_LIC}(?: {_V}1(?: 0)?)?", "odc by 1 0"),
    ("pddl-1", "public", rf"public domain dedication and {_LIC}(?: {_V}1(?: 0)?)?", "pddl 1 0"),
    ("osl-3", "open", rf"open software {_LIC}(?: {_V}3(?: 0)?)?", "osl 3 0"),
    ("afl-3", "academic", rf"academic free {_LIC}(?: {_V}3(?: 0)?)?", "afl 3 0"),
    ("ecl-2", "educational", rf"educational community {_LIC}(?: {_V}2(?: 0)?)?", "ecl 2 0"),
    ("eupl-1-2", "european", rf"european union public {_LIC}(?: {_V}1 [12])?", "eupl 1 [12]"),
    ("ms-pl", "microsoft", rf"microsoft public {_LIC}", "ms pl"),
    ("ms-rl", "microsoft", rf"microsoft reciprocal {_LIC}", "ms rl"),
    ("ncsa", "illinois", rf"university of illinois (?:ncsa )?open source {_LIC}", "ncsa"),
    ("ncsa", "ncsa", rf"ncsa (?:open source )?{_LIC}", "uoi ncsa"),
    ("upl-1", "universal", rf"universal permissive {_LIC}(?: {_V}1(?: 0)?)?", "upl 1 0"),
    ("vim", "vim", rf"vim {_LIC}", "vim"),
    ("w3c", "w3c", rf"w3c(?: software)?(?: notice and)? {_LIC}", "w3c"),
    ("x11", "x11", rf"x11 {_LIC}", "x11"),
    ("zpl-2-1", "zope", rf"zope public {_LIC}(?: {_V}2 [01])?", "zpl 2 1"),
    ("qpl-1", "q", rf"q public {_LIC}(?: {_V}1(?: 0)?)?", "qpl 1 0"),
    ("sleepycat", "sleepycat", rf"sleepycat {_LIC}", "sleepycat"),
    ("sspl-1", "server", rf"server side public {_LIC}(?: {_V}1)?", "sspl 1 0"),
    ("elastic-2", "elastic", rf"elastic {_LIC}(?: {_V}2(?: 0)?)?", "elastic 2 0"),
    ("rail", "rail|openrail|responsible|openresponsible",
     rf"(?:open ?)?(?:rail|responsible ai) {_LIC}", "openrail"),
    ("json", "json", rf"json {_LIC}", "json"),
    ("icu", "icu", rf"icu {_LIC}", "icu"),
    ("unicode", "unicode", rf"unicode {_LIC}(?: agreement| v3)?", "unicode (?:dfs 2016|3 0)"),
    ("bsd-source-code", "source", rf"source code bsd {_LIC}", "bsd source code"),
    ("beerware", "beerware|beer", rf"beerware(?: {_LIC})?|beer ware {_LIC}", "beerware"),
    ("mulan-2", "mulan", rf"mulan (?:psl|permissive software {_LIC})(?: {_V}2)?", "mulanpsl 2 0"),
    ("cecill-2-1", "cecill", rf"cecill(?: free software)?(?: {_LIC})?(?: agreement)?(?: {_V}2 1)?",
     "cecill 2 1"),
    ("lppl-1-3", "latex", rf"latex project public {_LIC}(?: {_V}1 3[ac]?)?", "lppl 1 3[ac]"),
    ("ogl-uk-3", "government", rf"open government {_LIC}(?: {_V}[123](?: 0)?)?", "ogl uk [123] 0"),
    ("nasa-1-3", "nasa", rf"nasa open source agreement(?: {_V}1 3)?", "nasa 1 3"),
    ("intel", "intel", rf"intel open source {_LIC}", "intel"),
    ("ipl-1", "ibm", rf"ibm public {_LIC}(?: {_V}1(?: 0)?)?", "ipl 1 0"),
]

# Acronyms that need no word beside them, with a version: "LGPLv3", "MPL 2.0", "EUPL-1.2".
SHORT = [
    ("lgpl-3", "lgpl", "3(?: 0)?"), ("lgpl-2-1", "lgpl", "2 1"), ("lgpl-2", "lgpl", "2(?: 0)?"),
    ("agpl-3", "agpl", "3(?: 0)?"), ("agpl-1", "agpl", "1(?: 0)?"), ("gpl-1", "gpl", "1(?: 0)?"),
    ("gfdl", "gfdl", "1 [123]"), ("mpl-2", "mpl", "2(?: 0)?"), ("mpl-1-1", "mpl", "1 1"),
    ("mpl-1", "mpl", "1 0"), ("epl-2", "epl", "2(?: 0)?"), ("epl-1", "epl", "1(?: 0)?"),
    ("eupl-1-2", "eupl", "1 [12]"), ("cddl-1", "cddl", "1 [01]"), ("sspl-1", "sspl", "1(?: 0)?"),
    ("busl-1-1", "busl", "1 1"), ("odbl-1", "odbl", "1(?: 0)?"), ("pddl-1", "pddl", "1(?: 0)?"),
    ("lppl-1-3", "lppl", "1 3[ac]?"),
]

# Phrases of the licenses' own texts.
TEXTS = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "software", "the software is provided as is without warranty of any kind express or implied"),
    ("isc", "permission", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("zlib", "altered", "altered source versions must be plainly marked as such"),
    ("bsl-1", "obtaining", "obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "fuck", "you just do what the fuck you want to"),
    ("apache-2", "compliance", "you may not use this file except in compliance with the license"),
    ("gpl", "gnu", rf"terms of the gnu general public {_LIC} as published by the free software foundation"),
    ("gpl-3", "gnu", rf"gnu general public {_LIC} as published by the free software foundation either version 3"),
    ("gpl-2", "gnu", rf"gnu general public {_LIC} as published by the free software foundation either version 2"),
    ("lgpl", "lesser", rf"terms of the gnu lesser general public {_LIC}"),
    ("agpl-3", "affero", rf"terms of the gnu affero general public {_LIC}"),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license"),
    ("ofl-1-1", "font", "this font software is licensed under the sil open font license"),
    ("public-domain", "domain", "(?:released|placed|dedicated)(?: in| into| to) the public domain"),
    ("public-domain", "domain", "(?:is|are) in the public domain"),
    ("cc0", "waived", "has waived all copyright and related or neighboring rights"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("proprietary", "unauthorized", "unauthorized (?:copying|use|reproduction|distribution) of this (?:file|software|document|material)"),
    ("proprietary", "reserved", "copyright (?:c )?(?:[0-9]{4} )?[^ ]+(?: [^ ]+){0,5} all rights reserved"),
    ("noncommercial", "commercial|noncommercial", "for non ?commercial (?:use|purposes) only"),
    ("noncommercial", "commercial", "not for commercial use"),
    ("research", "research", "for research (?:use|purposes) only"),
    ("freeware", "freeware", rf"freeware {_LIC}"),
]

# Names of the Creative Commons licenses in full, and web addresses.
_CC = r"creative commons attribution"
_CCV = r"(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: license)?"
FULL = [
    ("cc-by-nc-sa", rf"{_CC} non ?commercial share ?alike{_CCV}"),
    ("cc-by-nc-nd", rf"{_CC} non ?commercial no ?deriv(?:ative)?s?{_CCV}"),
    ("cc-by-nc", rf"{_CC} non ?commercial{_CCV}"),
    ("cc-by-sa", rf"{_CC} share ?alike{_CCV}"),
    ("cc-by-nd", rf"{_CC} no ?deriv(?:ative)?s?{_CCV}"),
    ("cc-by", rf"{_CC}{_CCV}"),
    ("cc0", r"creative commons zero(?: [1] 0)?"),
]
URLS = [
    ("mit", "opensource", "opensource org licen[sc]es mit"),
    ("apache-2", "apache", "apache org licenses license 2 0"),
    ("gpl-3", "gnu", "gnu org licenses gpl 3 0"),
    ("gpl-2", "gnu", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl", "gnu", "gnu org licenses gpl"),
    ("lgpl-3", "gnu", "gnu org licenses lgpl 3 0"),
    ("lgpl", "gnu", "gnu org licenses lgpl"),
    ("agpl-3", "gnu", "gnu org licenses agpl(?: 3 0)?"),
    ("gfdl", "gnu", "gnu org licenses fdl"),
    ("mpl-2", "mozilla", "mozilla org mpl 2 0"),
    ("mpl-1-1", "mozilla", "mozilla org mpl mpl 1 1"),
    ("epl-2", "eclipse", "eclipse org legal epl 2 0"),
    ("epl-1", "eclipse", "eclipse org legal epl v10"),
    ("bsd-3-clause", "opensource", "opensource org licen[sc]es bsd 3 clause"),
    ("bsd-2-clause", "opensource", "opensource org licen[sc]es bsd 2 clause"),
    ("isc", "opensource", "opensource org licen[sc]es isc"),
    ("bsl-1", "boost", "boost org license 1 0 txt"),
    ("unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "wtfpl", "wtfpl net"),
    ("ofl-1-1", "sil", "scripts sil org ofl"),
    ("odbl-1", "opendatacommons", "opendatacommons org licenses odbl"),
    ("eupl-1-2", "eupl", "eupl v1 2"),
    *[(f"cc-{x.replace(' ', '-')}", "creativecommons", f"creativecommons org licenses {x} [1-4] [05]")
      for x in ("by nc sa", "by nc nd", "by nc", "by sa", "by nd", "by")],
    ("cc0", "creativecommons", "creativecommons org publicdomain zero 1 0"),
    ("public-domain", "creativecommons", "creativecommons org publicdomain mark 1 0"),
]
GENERIC = [
    ("gpl", "gnu", rf"gnu general public {_LIC}"), ("gpl", "gpl", r"gpl"),
    ("lgpl", "gnu", rf"gnu (?:lesser|library) general public {_LIC}"), ("lgpl", "lgpl", r"lgpl"),
    ("bsd", "bsd", "bsd licen[sc]ed"),
    ("agpl", "agpl", r"agpl"), ("bsd", "bsd", rf"bsd(?: style)? {_LIC}"),
    ("apache", "apache", rf"apache(?: software)? {_LIC}"),
    ("mpl", "mozilla", rf"mozilla public {_LIC}"), ("epl", "eclipse", rf"eclipse public {_LIC}"),
    ("creative-commons", "creative", rf"creative commons(?: {_LIC})?"),
    ("public-domain", "domain", r"public domain"),
    ("copyleft", "copyleft", r"copyleft"), ("proprietary", "reserved", r"all rights reserved"),
]
_UNDER = (r"(?:licensed|released|distributed|available|published|provided|covered|governed|shared"
          r"|redistributed|relicensed|dual licensed|offered|issued)(?: to you)? (?:under|by|with) "
          r"(?:the )?(?:(?:terms|conditions)(?: and conditions)? of )?(?:the )?(?:a )?")
# Before a bare SPDX tag, which may be an everyday word.
_UNDER_TAG = r"(?:licen[sc]ed|relicensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?"


def _first_words(tag: str) -> str:
    """The words a tag can begin with."""
    if tag.startswith("(?:"):
        return tag[3:tag.index(")")]
    return tag.replace("(", " ").split(" ")[0]


# The phrases that every scan must report.
BASE = [("mit", "mit", "under the mit license"), ("apache-2", "apache", "apache license version 2"),
        ("cc-by-nc", "cc", "cc by nc")]


def rules() -> list[Rule]:
    out = [(label, "base", k, p) for label, k, p in BASE]
    out += [(label, "tag", "spdx", f"spdx license identifier (?:{tag})")
            for label, _, _, tag in LICENSES]
    out += [(label, "text", k, p) for label, k, p in TEXTS]
    out += [(label, "notice", k, f"{_UNDER}(?:{name})") for label, k, name, _ in LICENSES]
    out += [(label, "notice", "creative", f"{_UNDER}(?:{name})") for label, name in FULL]
    out += [(label, "notice", _first_words(tag), f"{_UNDER_TAG}(?:{tag})")
            for label, _, _, tag in LICENSES]
    out += [(label, "url", k, p) for label, k, p in URLS]
    out += [(label, "name", k, name) for label, k, name, _ in LICENSES]
    out += [(label, "name", "creative", name) for label, name in FULL]
    out += [(label, "name", f"{name}*", f"{name} ?{_V}{version}(?: only| or later)?")
            for label, name, version in SHORT]
    out += [(label, "name", _first_words(tag), f"(?:{tag}) licen[sc]ed") for label, _, _, tag in LICENSES]
    out += [(label, "generic", k, p) for label, k, p in GENERIC]
    return [Rule(label, kind, tuple(k.split("|")), p) for label, kind, k, p in out]
