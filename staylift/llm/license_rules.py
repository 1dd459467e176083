"""Licences by sentence rules: known sentences become identifiers, and ordered rules read their sequence."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

# Normalised sentences of published licence texts and notices, by identifier. <version>, <who> and <kind>
# stand for a version number, a name and a Creative Commons kind.
SENTENCES = {
    "apache-reference": [
        "licensed under the apache license version <version>", "released under the apache license version <version>",
        "this work is licensed under the apache license version <version>", "distributed under the apache license version <version>",
    ],
    "apache-grant": [
        "licensed under the apache license version <version> the license you may not use this file except in compliance with the license",
        "licensed to the apache software foundation asf under one or more contributor license agreements",
    ],
    "apache-copy": [
        "you may obtain a copy of the license at http www apache org licenses license <version>",
        "you may obtain a copy of the license at https www apache org licenses license <version>",
    ],
    "apache-basis": [
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"
        " without warranties or conditions of any kind either express or implied",
    ],
    "license-see": ["see the license for the specific language governing permissions and limitations under the license"],
    "mit-reference": ["released under the mit license", "licensed under the mit license", "this work is licensed under the mit license", "distributed under the mit license"],
    "mit-grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the"
        " software to deal in the software without restriction including without limitation the rights to use copy modify merge publish"
        " distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject"
        " to the following conditions",
    ],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "mit-as-is": [
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of"
        " merchantability fitness for a particular purpose and noninfringement",
    ],
    "mit-liability": [
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of"
        " contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ],
    "gpl-reference": [
        "this work is licensed under the gnu general public license version <version>", "licensed under the gnu general public license version <version>",
        "released under the gnu general public license version <version>", "distributed under the gnu general public license version <version>",
    ],
    "gpl-grant-later": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as"
        " published by the free software foundation either version <version> of the license or at your option any later version",
    ],
    "gpl-grant-only": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version"
        " <version> as published by the free software foundation",
    ],
    "lgpl-grant-later": [
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as"
        " published by the free software foundation either version <version> of the license or at your option any later version",
    ],
    "gpl-warranty": [
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of"
        " merchantability or fitness for a particular purpose",
        "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of"
        " merchantability or fitness for a particular purpose",
    ],
    "agpl-reference": [
        "this work is licensed under the gnu affero general public license version <version>",
        "licensed under the gnu affero general public license version <version>",
        "released under the gnu affero general public license version <version>",
        "distributed under the gnu affero general public license version <version>",
    ],
    "agpl-grant-later": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as"
        " published by the free software foundation either version <version> of the license or at your option any later version",
    ],
    "agpl-grant-only": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"
        " version <version> as published by the free software foundation",
    ],
    "gpl-see": [
        "see the gnu general public license for more details", "see the gnu lesser general public license for more details",
        "see the gnu affero general public license for more details",
    ],
    "gpl-received": [
        "you should have received a copy of the gnu affero general public license along with this program",
        "you should have received a copy of the gnu general public license along with this program",
        "you should have received a copy of the gnu lesser general public license along with this library",
    ],
    "bsd-reference": ["released under the bsd license", "licensed under the bsd license"],
    "bsd-grant": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions"
        " are met",
    ],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the"
        " documentation and or other materials provided with the distribution",
    ],
    "bsd-name": [
        "neither the name of <who> nor the names of its contributors may be used to endorse or promote products derived from this software"
        " without specific prior written permission",
    ],
    "bsd-as-is": [
        "this software is provided by <who> as is and any express or implied warranties including but not limited to the implied warranties of"
        " merchantability and fitness for a particular purpose are disclaimed",
    ],
    "mpl-grant": ["this source code form is subject to the terms of the mozilla public license v <version>"],
    "mpl-copy": ["if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl <version>"],
    "isc-grant": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that"
        " the above copyright notice and this permission notice appear in all copies",
    ],
    "cc-reference": [
        "licensed under cc <kind> <version>", "this work is licensed under cc <kind> <version>", "released under cc <kind> <version>",
        "licensed under a creative commons <kind> <version> international license",
        "this work is licensed under a creative commons <kind> <version> international license",
    ],
    "epl-grant": [
        "this program and the accompanying materials are made available under the terms of the eclipse public license v <version>",
        "this program and the accompanying materials are made available under the terms of the eclipse public license v <version> which"
        " accompanies this distribution",
        "this program and the accompanying materials are made available under the terms of the eclipse public license <version> which is"
        " available at https www eclipse org legal epl <version>",
    ],
    "zlib-as-is": ["this software is provided as is without any express or implied warranty"],
    "zlib-liability": ["in no event will the authors be held liable for any damages arising from the use of this software"],
    "zlib-grant": [
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and"
        " redistribute it freely subject to the following restrictions",
    ],
    "zlib-origin": ["the origin of this software must not be misrepresented"],
    "bsl-reference": [
        "distributed under the boost software license version <version>", "licensed under the boost software license version <version>",
        "released under the boost software license version <version>",
    ],
    "bsl-grant": [
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying"
        " documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to"
        " prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to"
        " the following",
    ],
    "cc0-reference": [
        "licensed under cc0 <version>", "licensed under cc0 <version> universal", "this work is licensed under cc0 <version>",
        "released under cc0 <version>", "released under cc0 <version> universal",
    ],
    "cc0-waiver": ["to the extent possible under law <who> has waived all copyright and related or neighboring rights to this work"],
    # How the licences' own full texts begin.
    "apache-2-title": ["apache license version 2 0 january 2004"],
    "gpl-2-title": ["gnu general public license version 2 june 1991"],
    "gpl-3-title": ["gnu general public license version 3 29 june 2007"],
    "lgpl-2-title": ["gnu lesser general public license version 2 1 february 1999"],
    "lgpl-3-title": ["gnu lesser general public license version 3 29 june 2007"],
    "agpl-3-title": ["gnu affero general public license version 3 19 november 2007"],
    "mpl-2-title": ["mozilla public license version 2 0"],
    "epl-1-title": ["eclipse public license v 1 0"],
    "epl-2-title": ["eclipse public license v 2 0"],
    "bsl-1-title": ["boost software license version 1 0 august 17th 2003"],
    "cc0-title": ["cc0 1 0 universal"],
    "unlicense-grant": ["this is free and unencumbered software released into the public domain"],
    "public-domain": ["this work is in the public domain", "released into the public domain"],
    "copyright": ["copyright <who>", "copyright c <who>", "c copyright <who>"],
    "all-rights": ["all rights reserved"],
}

# Rules in order. At each place of the sequence the first rule whose identifiers follow there names the
# licence; ? marks an identifier that may be missing. Copyright lines between them do not matter.
RULES = [
    ("Apache-{0}", ["apache-grant", "apache-copy?", "apache-basis?", "license-see?"]),
    ("Apache-{0}", ["apache-reference", "apache-copy?", "apache-basis?", "license-see?"]),
    ("GPL-{0}-or-later", ["gpl-grant-later", "gpl-warranty?", "gpl-see?", "gpl-received?"]),
    ("GPL-{0}-only", ["gpl-grant-only", "gpl-warranty?", "gpl-see?", "gpl-received?"]),
    ("GPL-{0}-only", ["gpl-reference", "gpl-warranty?", "gpl-see?", "gpl-received?"]),
    ("LGPL-{0}-or-later", ["lgpl-grant-later", "gpl-warranty?", "gpl-see?", "gpl-received?"]),
    ("AGPL-{0}-or-later", ["agpl-grant-later", "gpl-warranty?", "gpl-see?", "gpl-received?"]),
    ("AGPL-{0}-only", ["agpl-grant-only", "gpl-warranty?", "gpl-see?", "gpl-received?"]),
    ("AGPL-{0}-only", ["agpl-reference", "gpl-warranty?", "gpl-see?", "gpl-received?"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is?", "mit-liability?"]),
    ("MIT", ["mit-reference"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-as-is?"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is?"]),
    ("BSD", ["bsd-reference"]),
    ("MPL-{0}", ["mpl-grant", "mpl-copy?"]),
    ("ISC", ["isc-grant", "mit-as-is?"]),
    ("CC-{0}", ["cc-reference"]),
    ("EPL-{0}", ["epl-grant"]),
    ("Zlib", ["zlib-as-is?", "zlib-liability?", "zlib-grant", "zlib-origin?"]),
    ("BSL-1.0", ["bsl-1-title?", "bsl-grant"]),
    ("BSL-1.0", ["bsl-1-title"]),
    ("BSL-{0}", ["bsl-reference"]),
    ("CC0-1.0", ["cc0-title"]),
    ("CC0-1.0", ["cc0-waiver"]),
    ("CC0-{0}", ["cc0-reference"]),
    ("Apache-2.0", ["apache-2-title"]),
    ("GPL-2.0", ["gpl-2-title"]),
    ("GPL-3.0", ["gpl-3-title"]),
    ("LGPL-2.1", ["lgpl-2-title"]),
    ("LGPL-3.0", ["lgpl-3-title"]),
    ("AGPL-3.0", ["agpl-3-title"]),
    ("MPL-2.0", ["mpl-2-title"]),
    ("EPL-1.0", ["epl-1-title"]),
    ("EPL-2.0", ["epl-2-title"]),
    ("Unlicense", ["unlicense-grant"]),
    ("Public-Domain", ["public-domain"]),
    ("Proprietary", ["all-rights"]),
]

#: Parts of words one of which every known sentence holds; texts and sentences without any are not looked at further.
#: Each lies within a word, so that line ends and signs between words do not hide it.
TRIGGERS = ("licen", "copyright", "permission", "redistribution", "software", "warrant", "domain", "liab", "mozilla", "mpl", "reserved", "released", "misrepresented", "cc0")

_GAPS = {"<version>": r"(\d{1,2}(?: \d{1,2})?)", "<kind>": r"((?:by|nc|nd|sa|zero|attribution|noncommercial|sharealike|noderivatives|noderivs)(?: (?:by|nc|nd|sa|attribution|noncommercial|sharealike|noderivatives|noderivs))*)", "<who>": r"(?:\S+ ){0,30}?\S+"}
_SHORT = {"attribution": "BY", "noncommercial": "NC", "sharealike": "SA", "noderivatives": "ND", "noderivs": "ND"}


def normalised(sentence: str) -> str:
    """Words of letters and digits, lower case, one spelling of license."""
    return " ".join(re.findall(r"[^\W_]+", sentence.lower())).replace("licence", "license")


def _compiled() -> tuple[dict[str, str], list[tuple[re.Pattern, str]], int]:
    exact, gapped, longest = {}, [], 0
    for name, known in SENTENCES.items():
        for sentence in known:
            longest = max(longest, len(sentence.split()) + 30 * sentence.count("<who>") + 8 * sentence.count("<"))
            if "<" not in sentence:
                exact[sentence] = name
                continue
            pattern = re.escape(sentence).replace(r"\<", "<").replace(r"\>", ">").replace(r"\ ", " ")
            for gap, piece in _GAPS.items():
                pattern = pattern.replace(gap, piece)
            gapped.append((re.compile(pattern), name))
    return exact, gapped, longest


EXACT, GAPPED, LONGEST = _compiled()
#: How known sentences begin: two words, or one where a gap follows.
HEADS = {tuple(w for w in s.split()[:2] if "<" not in w) for known in SENTENCES.values() for s in known}


def identified(sentence: str) -> tuple[str, str] | None:
    """Identifier and detail (version or kind) of a normalised sentence."""
    if sentence in EXACT:
        return EXACT[sentence], ""
    for pattern, name in GAPPED:
        found = pattern.fullmatch(sentence)
        if found:
            parts = [_SHORT.get(w, w.upper()) for w in " ".join(found.groups()).split()]
            if name == "cc-reference":
                kind = "-".join(x for x in parts if not x.isdigit())
                return name, f"{kind}-{'.'.join(x for x in parts if x.isdigit())}"
            return name, ".".join([*parts, "0"][:2]) if found.groups() else ""
    return None


@dataclass(frozen=True)
class Sentence:
    """A known sentence in a text."""

    name: str
    detail: str
    start: int
    end: int


# A sentence ends at a run of signs before white space, one of them a stop, or at a blank line. A run is entered at its
# beginning alone and never given back, so that it is read once however long it is.
_END = re.compile(r"(?<![^\w\s])[^\w\s]++(?=\s|$)|\n[^\S\n]*+\n")
_STOPS = re.compile(r"[.;:?\n]")
_LINE = re.compile(r"[^\n]+")


def _stretches(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    for stop in _END.finditer(text):
        if not _STOPS.search(stop[0]):
            continue
        yield at, stop.end()
        at = stop.end()
    yield at, len(text)


def _triggered(text: str) -> bool:
    low = text.lower()
    return any(t in low for t in TRIGGERS)


def sentences(text: str) -> list[Sentence]:
    """Known sentences in order.

    A sentence may run over line ends and over stops within it (as in a version), and may stand on a line of its own after
    one without a stop: runs of whole lines, over up to three stretches between stops, are looked up, the longest first.
    A run must begin like a known sentence and be no longer than the longest, so that work follows the length of the text.
    """
    stretches = list(_stretches(text))
    told = [_triggered(text[a:b]) for a, b in stretches]
    lines: list[tuple[int, int, int, list[str]]] = []
    for k, (a, b) in enumerate(stretches):
        if any(told[max(0, k - 2) : k + 3]):
            lines += [(k, m.start(), m.end(), normalised(m[0]).split()) for m in _LINE.finditer(text, a, b)]
    lines = [line for line in lines if line[3]]
    found: list[Sentence] = []
    at = 0
    while at < len(lines):
        hit, words = None, []
        for end in range(at, len(lines)):
            words = words + lines[end][3]
            if len(words) > LONGEST or lines[end][0] > lines[at][0] + 2 or len(words) > 1 and not HEADS & {(words[0],), (words[0], words[1])}:
                break
            known = identified(" ".join(words))
            # A copyright notice says whose it is to the end of its line, not beyond.
            if known and (end == at or known[0] != "copyright"):
                hit = (end, known)
        if hit:
            end, (name, detail) = hit
            found.append(Sentence(name, detail, lines[at][1], lines[end][2]))
            at = end + 1
        else:
            at += 1
    return found


def licences(known: list[Sentence]) -> list[tuple[str, int, int]]:
    """Licence, start and end of each place where a rule matches, rules tried in order at every place."""
    line = [s for s in known if s.name != "copyright"]
    out, at = [], 0
    while at < len(line):
        for name, rule in RULES:
            here, detail = at, None
            for want in rule:
                if here < len(line) and line[here].name == want.rstrip("?"):
                    detail = line[here].detail if detail is None else detail
                    here += 1
                elif not want.endswith("?"):
                    here = at
                    break
            if here > at:
                out.append((name.format(detail), line[at].start, line[here - 1].end))
                at = here
                break
        else:
            at += 1
    return out


def recognised(docs: DataFrame) -> DataFrame:
    """Every document with what its text says: doc_id, sentences (name, detail, start, end), licences (name, start, end).

    Both lists are in the order of the text, places in characters. A null or empty text has none; rows that repeat are
    answered alike. Sentences that are known but fit no rule stay in the first list alone. Other columns are not read.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = [("start", pa.int64()), ("end", pa.int64())]
        sentence_type = pa.list_(pa.struct([("name", pa.string()), ("detail", pa.string()), *places]))
        licence_type = pa.list_(pa.struct([("name", pa.string()), *places]))
        for batch in batches:
            known = [sentences(t) if t and _triggered(t) else [] for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], pa.array([[vars(s) for s in own] for own in known], sentence_type),
                    pa.array([[{"name": n, "start": a, "end": b} for n, a, b in licences(own)] for own in known], licence_type),
                ],
                ["doc_id", "sentences", "licences"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {kind}, sentences ARRAY<STRUCT<name STRING, detail STRING, start LONG, end LONG>>, licences ARRAY<STRUCT<name STRING, start LONG, end LONG>>"
    )
