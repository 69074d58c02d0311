"""License signatures, in order: the earlier of two equal rules wins.

A signature is written over words. Each word is a small regular expression;
``(x)?`` is a word that may be missing and ``~n`` stands for up to ``n``
words of any kind. A rule has a label, a priority (0 a bare mention, 1 a
name, 2 an address, 3 a grant, 4 a tag or license text), a confidence and a
keyword: words that stand in every text that the signature can match.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    confidence: float
    keyword: str
    words: str


#: label: words of the tag, words of the name (its keyword first), words of the address or "".
LICENSES = {
    "mit": ("mit", "mit", "mit licen[sc]e", "opensource org licenses mit"),
    "mit-0": ("mit 0", "mit", "mit no attribution (licen[sc]e)?", "opensource org licenses mit 0"),
    "apache-1.1": ("apache 1 1", "apache", "apache (software)? licen[sc]e (version|v)? 1 1", "apache org licenses license 1 1"),
    "apache-2.0": ("apache 2 0", "apache", "apache (software)? licen[sc]e (version|v)? v?2 (0)?", "apache org licenses license 2 0"),
    "bsd-2-clause": ("bsd 2 clause", "bsd", "(simplified|freebsd)? (2|two)? (clause)? bsd (2|two) clause (licen[sc]e)?", "opensource org licenses bsd 2 clause"),
    "bsd-3-clause": ("bsd 3 clause", "bsd", "(new|revised|modified|3|three) (clause)? bsd (licen[sc]e)?", "opensource org licenses bsd 3 clause"),
    "bsd-4-clause": ("bsd 4 clause", "bsd", "(original|old|4|four) (clause)? bsd (licen[sc]e)?", "spdx org licenses bsd 4 clause"),
    "0bsd": ("0bsd", "bsd", "(zero|0) clause bsd (licen[sc]e)?", "opensource org licenses 0bsd"),
    "gpl-1.0": ("gpl 1 0 (only|or)? (later)?", "general  public  licen", "gnu general public licen[sc]e (version|v)? v?1 (0)?", "gnu org licenses old licenses gpl 1 0"),
    "gpl-2.0": ("gpl 2 0 (only|or)? (later)?", "general  public  licen", "(gnu)? general public licen[sc]e (version|v)? v?2 (0)?", "gnu org licenses old licenses gpl 2 0"),
    "gpl-3.0": ("gpl 3 0 (only|or)? (later)?", "general  public  licen", "(gnu)? general public licen[sc]e (version|v)? v?3 (0)?", "gnu org licenses gpl (3)? (0)?"),
    "lgpl-2.0": ("lgpl 2 0 (only|or)? (later)?", "library  general  public", "(gnu)? library general public licen[sc]e (version|v)? v?2 (0)?", "gnu org licenses old licenses lgpl 2 0"),
    "lgpl-2.1": ("lgpl 2 1 (only|or)? (later)?", "lesser  general  public", "(gnu)? lesser general public licen[sc]e (version|v)? v?2 1", "gnu org licenses old licenses lgpl 2 1"),
    "lgpl-3.0": ("lgpl 3 0 (only|or)? (later)?", "lesser  general  public", "(gnu)? lesser general public licen[sc]e (version|v)? v?3 (0)?", "gnu org licenses lgpl (3)? (0)?"),
    "agpl-3.0": ("agpl 3 0 (only|or)? (later)?", "affero", "(gnu)? affero general public licen[sc]e (version|v)? (v?3)? (0)?", "gnu org licenses agpl (3)? (0)?"),
    "gfdl-1.1": ("gfdl 1 1 (only|or)? (later)?", "free  documentation", "(gnu)? free documentation licen[sc]e (version|v)? v?1 1", "gnu org licenses old licenses fdl 1 1"),
    "gfdl-1.2": ("gfdl 1 2 (only|or)? (later)?", "free  documentation", "(gnu)? free documentation licen[sc]e (version|v)? v?1 2", "gnu org licenses old licenses fdl 1 2"),
    "gfdl-1.3": ("gfdl 1 3 (only|or)? (later)?", "free  documentation", "(gnu)? free documentation licen[sc]e (version|v)? v?1 3", "gnu org licenses fdl 1 3"),
    "mpl-1.1": ("mpl 1 1", "mozilla", "mozilla public licen[sc]e (version|v)? v?1 1", "mozilla org mpl (mpl)? 1 1"),
    "mpl-2.0": ("mpl 2 0", "mozilla", "mozilla public licen[sc]e (version|v)? v?2 (0)?", "mozilla org mpl 2 0"),
    "epl-1.0": ("epl 1 0", "eclipse", "eclipse public licen[sc]e (version|v)? v?1 (0)?", "eclipse org legal epl v10"),
    "epl-2.0": ("epl 2 0", "eclipse", "eclipse public licen[sc]e (version|v)? v?2 (0)?", "eclipse org legal epl (v20|2) (0)?"),
    "cddl-1.0": ("cddl 1 0", "common  development  and  distribution", "common development and distribution licen[sc]e (version|v)? v?1 0", "opensource org licenses cddl1"),
    "cddl-1.1": ("cddl 1 1", "common  development  and  distribution", "common development and distribution licen[sc]e (version|v)? v?1 1", "spdx org licenses cddl 1 1"),
    "eupl-1.2": ("eupl 1 2", "european  union  public", "european union public licen[sc]e (version|v)? (v?1)? (2)?", "joinup ec europa eu ~3 eupl"),
    "isc": ("isc", "isc", "isc licen[sc]e", "opensource org licenses isc"),
    "zlib": ("zlib", "zlib", "zlib (libpng)? licen[sc]e", "zlib net zlib license"),
    "bsl-1.0": ("bsl 1 0", "boost", "boost software licen[sc]e (version|v)? (1)? (0)?", "boost org license 1 0"),
    "unlicense": ("unlicense", "unlicense", "(the)? unlicense", "unlicense org"),
    "wtfpl": ("wtfpl", "wtfpl", "wtfpl (version|v)? (2)?", "wtfpl net"),
    "artistic-1.0": ("artistic 1 0", "artistic", "artistic licen[sc]e (version|v)? 1 0", "opensource org licenses artistic 1 0"),
    "artistic-2.0": ("artistic 2 0", "artistic", "artistic licen[sc]e (version|v)? 2 (0)?", "opensource org licenses artistic 2 0"),
    "psf-2.0": ("(psf|python) 2 0", "python", "python (software)? (foundation)? licen[sc]e", "python org ~2 license"),
    "postgresql": ("postgresql", "postgresql", "postgresql licen[sc]e", "opensource org licenses postgresql"),
    "ofl-1.1": ("ofl 1 1", "open  font", "(sil)? open font licen[sc]e (version|v)? (1)? (1)?", "scripts sil org ofl"),
    "odbl-1.0": ("odbl 1 0", "database", "open (data)? (commons)? (open)? database licen[sc]e", "opendatacommons org licenses odbl"),
    "odc-by-1.0": ("odc by 1 0", "open  data  commons", "open data commons attribution licen[sc]e", "opendatacommons org licenses by"),
    "pddl-1.0": ("pddl 1 0", "public  domain  dedication", "(open)? (data)? (commons)? public domain dedication and licen[sc]e", "opendatacommons org licenses pddl"),
    "cc0-1.0": ("cc0 1 0", "cc0", "cc0 (1)? (0)? (universal)?", "creativecommons org publicdomain zero"),
    "cc-by": ("cc by [1-4] [05]", "cc  by", "cc by [1-4] [05]", "creativecommons org licenses by"),
    "cc-by-sa": ("cc by sa [1-4] [05]", "cc  by  sa", "cc by sa ([1-4])? ([05])?", "creativecommons org licenses by sa"),
    "cc-by-nd": ("cc by nd [1-4] [05]", "cc  by  nd", "cc by nd ([1-4])? ([05])?", "creativecommons org licenses by nd"),
    "cc-by-nc": ("cc by nc [1-4] [05]", "cc  by  nc", "cc by nc ([1-4])? ([05])?", "creativecommons org licenses by nc"),
    "cc-by-nc-sa": ("cc by nc sa [1-4] [05]", "cc  by  nc  sa", "cc by nc sa ([1-4])? ([05])?", "creativecommons org licenses by nc sa"),
    "cc-by-nc-nd": ("cc by nc nd [1-4] [05]", "cc  by  nc  nd", "cc by nc nd ([1-4])? ([05])?", "creativecommons org licenses by nc nd"),
    "openrail": ("(creativeml)? openrail (m)?", "openrail", "(creativeml)? (bigscience)? openrail (m|rail)? (licen[sc]e)?", "bigscience huggingface co ~2 license"),
}

GRANT = "(licen[sc]ed|released|distributed|available|published|provided|shared|covered) under (the)? (terms)? (and)? (conditions)? (of)? (the)?"

#: Signatures of license texts, notices and families without a version.
TEXTS = [
    Rule("mit", 4, 0.95, "permission  is  hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Rule("mit", 4, 0.9, "above  copyright  notice", "the above copyright notice and this permission notice shall be included in all copies"),
    Rule("mit", 3, 0.7, "as  is", "the software is provided as is without warranty of any kind express or implied"),
    Rule("bsd", 4, 0.9, "redistribution  and  use", "redistribution and use in source and binary forms with or without modification are permitted"),
    Rule("bsd", 3, 0.8, "redistributions  of  source", "redistributions of source code must retain the above copyright notice"),
    Rule("bsd", 3, 0.8, "redistributions  in  binary", "redistributions in binary form must reproduce the above copyright notice"),
    Rule("bsd-3-clause", 4, 0.9, "neither  the  name", "neither the name of ~8 nor the names of its contributors may be used to endorse or promote"),
    Rule("bsd-4-clause", 4, 0.9, "advertising  materials", "all advertising materials mentioning features or use of this software must display"),
    Rule("bsd", 0, 0.5, "bsd", "bsd (style)? licen[sc]e"),
    Rule("apache-2.0", 4, 0.95, "in  compliance  with", "you may not use this file except in compliance with the license"),
    Rule("apache-2.0", 3, 0.8, "as  is", "distributed on an as is basis without warranties or conditions of any kind"),
    Rule("apache", 0, 0.5, "apache", "apache (public|software)? licen[sc]e"),
    Rule("gpl", 4, 0.9, "free  software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    Rule("gpl", 3, 0.8, "useful", "this program is distributed in the hope that it will be useful but without any warranty"),
    Rule("gpl", 3, 0.8, "received  a  copy", "you should have received a copy of the gnu ~2 public licen[sc]e"),
    Rule("gpl", 2, 0.8, "any  later  version", "either version [1-3] ~4 or at your option any later version"),
    Rule("gpl", 1, 0.7, "gpl", "gnu gpl (v[123]|version)? ([123])?"),
    Rule("gpl-2.0", 1, 0.8, "gplv2", "gplv2 (only)?"),
    Rule("gpl-3.0", 1, 0.8, "gplv3", "gplv3 (only)?"),
    Rule("lgpl", 1, 0.7, "lgpl", "(gnu)? lgpl(?:v[23])?"),
    Rule("lgpl", 1, 0.7, "lesser  general  public", "(gnu)? lesser general public licen[sc]e"),
    Rule("agpl-3.0", 1, 0.8, "agpl", "(gnu)? agpl(?:v3)?"),
    Rule("gfdl", 1, 0.7, "free  documentation", "(gnu)? free documentation licen[sc]e"),
    Rule("gfdl", 4, 0.9, "invariant  sections", "with no invariant sections no front cover texts and no back cover texts"),
    Rule("mpl-2.0", 4, 0.95, "mozilla", "this source code form is subject to the terms of the mozilla public licen[sc]e"),
    Rule("mpl", 0, 0.5, "mozilla", "mozilla public licen[sc]e"),
    Rule("epl", 0, 0.5, "eclipse", "eclipse public licen[sc]e"),
    Rule("cddl", 0, 0.5, "common  development  and  distribution", "common development and distribution licen[sc]e"),
    Rule("isc", 4, 0.9, "permission  to  use", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Rule("zlib", 4, 0.9, "origin  of  this  software", "the origin of this software must not be misrepresented"),
    Rule("bsl-1.0", 4, 0.9, "machine  executable", "solely in the form of machine executable object code generated by a source language processor"),
    Rule("unlicense", 4, 0.95, "unencumbered", "this is free and unencumbered software released into the public domain"),
    Rule("wtfpl", 4, 0.9, "public  license", "do what the (fuck|f) ~1 (you)? want to public license"),
    Rule("public-domain", 3, 0.8, "public  domain", "(released|placed|dedicated) (in)? (into)? (to)? the public domain"),
    Rule("public-domain", 0, 0.5, "public  domain", "(is|are) (in)? (the)? public domain"),
    Rule("cc0-1.0", 4, 0.9, "waived", "has waived all copyright and related or neighboring rights"),
    Rule("cc-by", 1, 0.7, "creative  commons", "creative commons attribution ([1-4])? ([05])? (international|unported|generic)?"),
    Rule("cc-by-sa", 1, 0.8, "creative  commons", "creative commons attribution share ?alike"),
    Rule("cc-by-sa", 1, 0.8, "sharealike", "creative commons attribution sharealike ([1-4])? ([05])?"),
    Rule("cc-by-nc", 1, 0.8, "noncommercial", "creative commons attribution noncommercial ([1-4])? ([05])?"),
    Rule("cc-by-nc", 1, 0.8, "non  commercial", "creative commons attribution non commercial ([1-4])? ([05])?"),
    Rule("cc-by-nc-sa", 1, 0.85, "sharealike", "creative commons attribution (noncommercial|non) (commercial)? sharealike ([1-4])? ([05])?"),
    Rule("cc-by-nd", 1, 0.8, "noderiv", "creative commons attribution noderiv(?:s|atives) ([1-4])? ([05])?"),
    Rule("cc-by-nc-nd", 1, 0.85, "noderiv", "creative commons attribution (noncommercial|non) (commercial)? noderiv(?:s|atives)"),
    Rule("creative-commons", 0, 0.5, "creative  commons", "creative commons (licen[sc]e)?"),
    Rule("reserved", 3, 0.7, "copyright", "copyright ~6 all rights reserved"),
    Rule("copyright", 1, 0.4, "copyright", "copyright (c)? (?:19|20)[0-9][0-9] ((?:19|20)[0-9][0-9])?"),
    Rule("proprietary", 3, 0.8, "proprietary", "proprietary and confidential"),
    Rule("proprietary", 3, 0.8, "unauthorized", "unauthorized (copying|use|reproduction|distribution) ~6 is (strictly)? prohibited"),
    Rule("proprietary", 2, 0.7, "reproduced", "no part of this ~4 may be reproduced"),
    Rule("proprietary", 2, 0.7, "without", "without (the)? (prior|express|written) (written)? (permission|consent)"),
    Rule("non-commercial", 2, 0.6, "use  only", "(for)? (personal)? (and)? (non|noncommercial) (commercial)? use only"),
    Rule("end-user", 2, 0.6, "end  user", "end user licen[sc]e agreement"),
    Rule("business-source", 1, 0.7, "business  source", "business source licen[sc]e (version|v)? (1)? ([01])?"),
    Rule("sspl", 1, 0.8, "server  side  public", "server side public licen[sc]e (version|v)? (1)?"),
    Rule("elastic-2.0", 1, 0.8, "elastic", "elastic licen[sc]e (version|v)? (2)? (0)?"),
    Rule("commons-clause", 1, 0.8, "commons  clause", "commons clause (licen[sc]e)? (condition)?"),
]


def rules() -> list[Rule]:
    """All rules in order: texts, then tags, addresses, grants and names of each license."""
    named = []
    for label, (tag, keyword, name, address) in LICENSES.items():
        named.append(Rule(label, 4, 1.0, "spdx", f"spdx licen[sc]e identifier {tag}"))
        named.append(Rule(label, 3, 0.95, keyword, f"{GRANT} {name}"))
        if address:
            named.append(Rule(label, 2, 0.9, address.split()[0], address))
        named.append(Rule(label, 1, 0.8, keyword, name))
    return TEXTS + named


def pattern(words: str) -> str:
    """A signature as a regular expression over words that have a space on either side."""
    parts = []
    for word in words.split(" "):
        if word.startswith("~"):
            parts.append(f"(?: [^ ]+ ){{0,{word[1:]}}}")
        elif word.startswith("(") and word.endswith(")?"):
            parts.append(f"(?: (?:{word[1:-2]}) )?")
        elif word.startswith("(") and word.endswith(")") and not word.startswith("(?"):
            parts.append(f" (?:{word[1:-1]}) ")
        else:
            parts.append(f" {word} ")
    return "".join(parts)
