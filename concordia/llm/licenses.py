"""License scans: sentence-rule recognition.

Sentences are normalised (lower case, letters and digits, single spaces) and mapped to the
identifiers of known licence sentences; the document's identifier sequence is then matched
against ordered licence rules. All of it is column expressions.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plain(sentence: str) -> str:
    """A sentence as it is compared: lower case, letters and digits, single spaces."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


#: Known sentences, normalised, by identifier. Fixed values.
SENTENCES = {
    "mit-ref": "released under the mit license",
    "mit-ref2": "licensed under the mit license",
    "apache2-ref": "licensed under the apache license version 2 0",
    "apache2-unless": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    "gpl3-ref": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "ccbync4-ref": "licensed under cc by nc 4 0",
    "grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind",
    "bsd-source": "redistributions of source code must retain the above copyright notice",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice",
}
#: Licences in the order in which they are tried: the sentences that must occur in this order, others between them allowed
#: (but not between two in one string); and licences that a rule gives way to. Fixed values.
RULES = [
    ("MIT", ["grant", "notice", "as-is"]),
    ("MIT", ["mit-ref"]),
    ("MIT", ["mit-ref2"]),
    ("Apache-2.0", ["apache2-ref", "apache2-unless"]),
    ("Apache-2.0", ["apache2-ref"]),
    ("Apache-2.0", ["apache2-terms", "apache2-grant"]),
    ("GPL-3.0", ["gpl3-ref"]),
    ("GPL-3.0", ["gpl3-head", "gnu-verbatim"]),
    ("GPL-2.0", ["gpl2-head", "gnu-verbatim"]),
    ("LGPL-3.0", ["lgpl3-head", "gnu-verbatim"]),
    ("LGPL-2.1", ["lgpl21-head", "gnu-verbatim"]),
    ("AGPL-3.0", ["agpl3-head", "gnu-verbatim"]),
    ("GPL-3.0-or-later", ["gpl-free v3-later"]),
    ("GPL-2.0-or-later", ["gpl-free v2-later"]),
    ("GPL-3.0-only", ["gpl-free v3-only"]),
    ("GPL-2.0-only", ["gpl-free v2-only"]),
    ("GPL", ["gpl-free"], ["GPL-3.0-or-later", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-2.0-only"]),
    ("LGPL-3.0-or-later", ["lgpl-free v3-later"]),
    ("LGPL-2.1-or-later", ["lgpl-free v21-later"]),
    ("LGPL", ["lgpl-free"], ["LGPL-3.0-or-later", "LGPL-2.1-or-later"]),
    ("AGPL-3.0-or-later", ["agpl-free v3-later"]),
    ("CC-BY-NC-4.0", ["ccbync4-ref"]),
    ("BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-source", "bsd-binary", "bsd-as-is"], ["BSD-3-Clause"]),
    ("BSD", ["bsd-source", "bsd-binary"], ["BSD-3-Clause", "BSD-2-Clause"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("ISC", ["isc-grant"]),
    ("0BSD", ["0bsd-grant", "isc-as-is"]),
    ("BSL-1.0", ["boost-head"]),
    ("BSL-1.0", ["boost-ref"]),
    ("BSL-1.0", ["boost-grant"]),
    ("Zlib", ["zlib-as-is", "zlib-grant"]),
    ("Zlib", ["zlib-grant", "zlib-origin"]),
    ("EPL-2.0", ["epl2-head"]),
    ("EPL-2.0", ["epl2-ref"]),
    ("EPL-1.0", ["epl1-head"]),
    ("EPL-1.0", ["epl1-ref"]),
    ("MPL-2.0", ["mpl2-form", "mpl2-copy"]),
    ("MPL-2.0", ["mpl2-head", "mpl2-contributor"]),
    ("Unlicense", ["unlicense"]),
    ("CC0-1.0", ["cc0-dedicated"]),
    ("CC0-1.0", ["cc0-head"]),
]
#: Creative Commons licences by the words of their names; the versions that are published. Fixed values.
CREATIVE_COMMONS = {
    "Attribution": "CC-BY", "Attribution-ShareAlike": "CC-BY-SA", "Attribution-NonCommercial": "CC-BY-NC", "Attribution-NoDerivatives": "CC-BY-ND", "Attribution-NoDerivs": "CC-BY-ND",
    "Attribution-NonCommercial-ShareAlike": "CC-BY-NC-SA", "Attribution-NonCommercial-NoDerivatives": "CC-BY-NC-ND", "Attribution-NonCommercial-NoDerivs": "CC-BY-NC-ND",
}
CC_VERSIONS = {"4.0": "4.0 International", "3.0": "3.0 Unported", "2.5": "2.5 Generic", "2.0": "2.0 Generic"}
RULES += [(f"{c}-{v}", [f"{c}-{v}".lower() + "-ref"]) for c in dict.fromkeys(CREATIVE_COMMONS.values()) for v in CC_VERSIONS]
#: Names that a tag of one line may give, alone or with `OR` between two. Fixed values.
TAGS = [
    "MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "GPL-2.0",
    "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "0BSD", "MPL-2.0", "Unlicense", "CC0-1.0", "BSL-1.0", "Zlib", "EPL-1.0", "EPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0",
]
RULES += [(name, [f"spdx-{name.lower()}"]) for name in TAGS]
_TAG = "SPDX-License-Identifier: "
#: Sentences of published licence texts and notices, with the identifiers for which each stands. Fixed values.
TEXTS = {
    "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software": "mit-liable",
    "you may not use this file except in compliance with the License": "apache2-comply",
    "You may obtain a copy of the License at": "apache2-copy",
    "See the License for the specific language governing permissions and limitations under the License": "apache2-see",
    '"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document': "apache2-terms",
    "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form": "apache2-grant",
    **{f"This software is provided by {who} \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-as-is" for who in ("the copyright holders and contributors", "the copyright holder and contributors", "the regents and contributors", "the author", "the author and contributors", "the authors and contributors")},
    **{f"In no event shall {who} be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services": "bsd-liable" for who in ("the copyright holder or contributors", "the copyright holders or contributors", "the copyright owner or contributors", "the regents or contributors", "the author", "the author or contributors")},
    **{f"Neither the name of {who} nor the names of {its} contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse" for who in ("the copyright holder", "the copyright holders", "the copyright owner", "the University", "the author", "the organization", "the project", "the company", "the <organization>", "the <ORGANIZATION>") for its in ("its", "their", "his")},
    **{f"Permission to use, copy, modify, and{mid} distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies": "isc-grant" for mid in ("", "/or")},
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    **{f'The software is provided "as is" and {who} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness': "isc-as-is" for who in ("the author", "ISC", "Internet Systems Consortium")},
    **{f"In no event shall {who} be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software": "isc-liable" for who in ("the author", "ISC")},
    **{_TAG + name: f"spdx-{name.lower()}" for name in TAGS},
    **{f"{_TAG}{a} OR {b}": f"spdx-{a.lower()} spdx-{b.lower()}" for a in TAGS for b in ("MIT", "Apache-2.0", "BSD-3-Clause", "BSD-2-Clause") if a != b},
    "Boost Software License - Version 1.0 - August 17th, 2003": "boost-head",
    **{f"{lead}under the Boost Software License, Version 1.0": "boost-ref" for lead in ("Distributed ", "Licensed ", "This file is distributed ")},
    'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:': "boost-grant",
    "This software is provided 'as-is', without any express or implied warranty": "zlib-as-is",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:": "zlib-grant",
    "The origin of this software must not be misrepresented": "zlib-origin",
    "Eclipse Public License - v 2.0": "epl2-head",
    "Eclipse Public License - v 1.0": "epl1-head",
    **{f"This program and the accompanying materials are made available under the terms of the Eclipse Public License {v} which {more}": f"epl{v.strip("v ")[0]}-ref" for v in ("2.0", "v2.0", "v 2.0", "1.0", "v1.0", "v 1.0") for more in ("accompanies this distribution", "is available at")},
    **{f"This program and the accompanying materials are made available under the terms of the Eclipse Public License {v} which accompanies this distribution, and is available at {at}": "epl2-ref" if "2" in v else "epl1-ref" for v in ("2.0", "v2.0", "1.0", "v1.0") for at in ("https://www.eclipse.org/legal/epl-2.0", "http://www.eclipse.org/legal/epl-v10.html") if (at[-2:] == ".0") == ("2" in v)},
    **{f"This program and the accompanying materials are made available under the terms of the Eclipse Public License {v} which is available at {at}": "epl2-ref" for v in ("2.0", "v2.0", "v. 2.0") for at in ("https://www.eclipse.org/legal/epl-2.0", "http://www.eclipse.org/legal/epl-2.0", "https://www.eclipse.org/legal/epl-v20.html")},
    "GNU General Public License Version 3, 29 June 2007": "gpl3-head",
    "GNU General Public License Version 2, June 1991": "gpl2-head",
    "GNU Lesser General Public License Version 3, 29 June 2007": "lgpl3-head",
    "GNU Lesser General Public License Version 2.1, February 1999": "lgpl21-head",
    "GNU Affero General Public License Version 3, 19 November 2007": "agpl3-head",
    "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed": "gnu-verbatim",
    "either version 2 of the License, or (at your option) any later version": "v2-later",
    "either version 2.1 of the License, or (at your option) any later version": "v21-later",
    "either version 3 of the License, or (at your option) any later version": "v3-later",
    **{f"This {what} is distributed in the hope that it will be useful, but without any warranty": "gnu-useful" for what in ("program", "library", "file", "software")},
    **{f"without even the implied warranty of merchantability or fitness for a particular purpose{more}": "gnu-no-warranty" for more in ("",)},
    "This Source Code Form is subject to the terms of the Mozilla Public License, v": "mpl2-form",
    **{f"If a copy of the MPL was not distributed with this file, You can obtain one at {at}mozilla.org/MPL/2.0": "mpl2-copy" for at in ("http://", "https://", "http://www.", "https://www.")},
    "Mozilla Public License Version 2.0": "mpl2-head",
    '"Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software': "mpl2-contributor",
    "This is free and unencumbered software released into the public domain": "unlicense",
    **{f"To the extent possible under law, {who} dedicated all copyright and related and neighboring rights to this {what} to the public domain worldwide": "cc0-dedicated" for who in ("the author(s) have", "the author has") for what in ("software", "work")},
    "CC0 1.0 Universal": "cc0-head",
    **{f"{lead} {a} Creative Commons {name} {full} License": f"{c}-{v}".lower() + "-ref" for lead in ("This work is licensed under", "Licensed under", "This document is licensed under") for a in ("a", "the") for name, c in CREATIVE_COMMONS.items() for v, full in CC_VERSIONS.items()},
    **{f"Licensed under {c.replace('CC-', 'CC ')} {v}": f"{c}-{v}".lower() + "-ref" for c in CREATIVE_COMMONS.values() for v in CC_VERSIONS if (c, v) != ("CC-BY-NC", "4.0")},
}
_MIT_GRANT = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"
_MIT_NOTICE = "the above copyright notice and this permission notice {}shall be included in all copies or substantial portions of the software"
_MIT_AS_IS = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose {}"
_BSD_LEAD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
_BSD_SOURCE = "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
_BSD_BINARY = "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_APACHE = "under the apache license version 2 0 the license"
_APACHE_UNLESS = "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"
_APACHE_COPY = "you may obtain a copy of the license at {} www apache org licenses license 2 0 "
_FREE = ["", *(f"this {what} is free software " for what in ("program", "file", "software", "library")), "it is free software "]
_GNU = {"gpl-free": "general public license", "lgpl-free": "lesser general public license", "agpl-free": "affero general public license"}
_TERMS = "you can redistribute it and or modify it under the terms of the gnu {}{} as published by the free software foundation"
_VERSIONS = {"v2-later": ("2", True), "v21-later": ("2 1", True), "v3-later": ("3", True), "v2-only": ("2", False), "v3-only": ("3", False)}
_GPL_ALL = {
    **{_TERMS.format(name, ""): free for free, name in _GNU.items()},
    **{f"{_TERMS.format(name, '')} {lead}version {v}{of}{' or at your option any later version' * later}": f"{free} {i}" for free, name in _GNU.items() for i, (v, later) in _VERSIONS.items() for lead in ("either ", "") for of in (" of the license", "")},
    **{_TERMS.format(name, f" version {v}"): f"{free} {i}" for free, name in _GNU.items() for i, (v, later) in _VERSIONS.items() if not later},
}
#: Published sentences in full, with their common variants, each with the identifiers for which it stands. Fixed values.
PUBLISHED = {
    _MIT_GRANT: "grant",
    **{_MIT_NOTICE.format(m): "notice" for m in ("", "including the next paragraph ")},
    **{f"{_MIT_GRANT} {_MIT_NOTICE.format(m)}": "grant notice" for m in ("", "including the next paragraph ")},
    **{_MIT_AS_IS.format(m): "as-is" for m in ("and noninfringement", "and non infringement", "noninfringement", "and noninfringement of third party rights")},
    **{f"this {w} is {by} under the mit license{m}": "mit-ref2" for w in ("project", "software", "work", "code", "file") for by in ("licensed", "released") for m in ("", " see the license file for details", " see the license md file for details")},
    f"licensed {_APACHE}": "apache2-ref",
    f"the asf licenses this file to you {_APACHE}": "apache2-ref",
    _APACHE_UNLESS: "apache2-unless",
    **{_APACHE_COPY.format(m) + _APACHE_UNLESS: "apache2-copy apache2-unless" for m in ("http", "https")},
    **{lead + g: ids for lead in _FREE for g, ids in _GPL_ALL.items()},
    **{lead + _BSD_SOURCE: "bsd-source" for lead in ("", _BSD_LEAD)},
    **{b: "bsd-binary" for b in (_BSD_BINARY, f"and {_BSD_BINARY}")},
    f"{_BSD_LEAD}{_BSD_SOURCE} {_BSD_BINARY}": "bsd-source bsd-binary",
    **{plain(s): ids for s, ids in TEXTS.items()},
}
#: Words that lead a line of a comment in some languages; signs that do so are dropped in any case.
LEADERS = r"(?m)^[^\S\n]*(?:dnl|rem)[^\S\n]+"
#: Sentences end at . ! ? ; before white space or the end, and at blank lines. A single line feed may end one or lie within it.
BOUNDS = r"[.!?;]+(?:\s+|$)|\n[^\S\n]*\n\s*"


def _any_of(sentences: list[list[str]], between: str) -> str:
    """A pattern of the sentences (lists of words), the longest that fits first; common beginnings are tried once."""
    after: dict[str, list[list[str]]] = {}
    for s in sentences:
        after.setdefault(s[0], []).append(s[1:])
    parts = []
    for word, rest in sorted(after.items()):
        more = [r for r in rest if r]
        part = between + _any_of(more, between) if more else ""
        parts.append(word + (f"(?:{part})?" if more and len(more) < len(rest) else part))
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def triggers(known: Iterable[str]) -> list[str]:
    """A few words of which every known sentence holds one, so a text without any of them holds no known sentence.

    Long words only, where a sentence has one, as they are rarer; by turns the one that the most of the other sentences have."""
    left = [{w for w in s.split(" ") if len(w) >= 7} or {max(s.split(" "), key=len)} for s in known]
    out = []
    while left:
        count = Counter(w for words in left for w in words)
        out.append(max(sorted(count), key=count.get))
        left = [words for words in left if not any(out[-1] in w for w in words)]
    return out


def sentence_ids(text: Column, sentences: dict[str, str] = SENTENCES, published: dict[str, str] = PUBLISHED) -> Column:
    """The identifiers of a text's known sentences, in order; none if it is null or empty. Any length of text is searched whole.

    The normalised text has B for the end of a sentence and L for a single line feed (lower case leaves no others). Known
    sentences are found between any two of these, with L inside as lines are wrapped; of those at one place, the longest."""
    known = published | {v: k for k, v in sentences.items()}
    small = F.lower(F.coalesce(text, F.lit("")))
    marked = F.regexp_replace(F.regexp_replace(F.regexp_replace(small, LEADERS, " "), BOUNDS, " B "), "\n", " L ")
    line = F.concat(F.lit("B "), F.trim(F.regexp_replace(marked, "[^a-z0-9BL]+", " ")), F.lit(" B"))
    found = F.regexp_extract_all(line, F.lit(f"[BL] ({_any_of([s.split(' ') for s in known], ' (?:L )*+')})(?= [BL])"), F.lit(1))
    ids = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    found = F.flatten(F.transform(found, lambda s: F.split(F.try_element_at(ids, F.regexp_replace(s, "(?: L)+", "")), " ")))
    some = reduce(lambda a, b: a | b, (small.contains(w) for w in triggers(known)))
    return F.when(some, found).otherwise(F.array().cast("array<string>"))  # the large pattern meets few texts


def rule_pattern(ids: list[str]) -> str:
    return " " + r"(?:\S+ )*".join(f"{i} " for i in ids)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[str, str] = SENTENCES, rules: list[tuple] = RULES, published: dict[str, str] = PUBLISHED) -> DataFrame:
    """One row per input row: id, sentence_ids, licenses (distinct, in the rules' order) and license, the first or null.

    A null or empty text has none. Of known sentences that begin at one place the longest counts; of rules that fire the
    first gives `license`. Repeated rows are scanned one by one; other columns are not read. An empty table gives an
    empty result."""
    found = docs.select(F.col(id_col), sentence_ids(F.col(text_col), sentences, published).alias("sentence_ids"))
    line = F.concat(F.lit(" "), F.array_join("sentence_ids", " "), F.lit(" "))
    fired = [F.when(line.rlike(rule_pattern(ids)), F.lit(name)) for name, ids, *_ in rules]
    some = F.array_distinct(F.array_compact(F.array(*fired)))
    found = found.withColumn("licenses", F.when(F.size("sentence_ids") > 0, some).otherwise(F.array().cast("array<string>")))
    for name, _, *unless in rules:
        if unless:
            yields = F.arrays_overlap("licenses", F.array(*map(F.lit, unless[0])))
            found = found.withColumn("licenses", F.when(yields, F.array_remove("licenses", name)).otherwise(F.col("licenses")))
    return found.withColumn("license", F.try_element_at("licenses", F.lit(1)))
