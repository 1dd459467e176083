from __future__ import annotations

import itertools
import random
import re
import time
from collections import Counter

import pytest

from staylift.llm import license_rules as l
from staylift.llm.queries import QUERIES, documents

APACHE = """# Copyright 2020 The Authors
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
GPL = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
 * warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
"""
MPL = 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.'


def names(text: str) -> list[str]:
    return [x for x, _, _ in l.licences(l.sentences(text))]


@pytest.mark.parametrize(("text", "expected"), [
    (APACHE, ["Apache-2.0"]), (GPL, ["GPL-3.0-or-later"]), (MPL, ["MPL-2.0"]), (APACHE + GPL, ["Apache-2.0", "GPL-3.0-or-later"]),
    ("heading without a stop\nReleased under the MIT License.\nmore", ["MIT"]), ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0-only"]),
    ("LICENSED!! UNDER!! THE!! APACHE!! LICENSE,!! VERSION!! 2.0.!!", ["Apache-2.0"]), ("Released%%% under*** the&&& MIT%%% Licence.###", ["MIT"]),
    ("Released | under | the | MIT | License.", ["MIT"]), ("All rights reserved.", ["Proprietary"]),
    ("He was released under the MIT license agreement of his father.", []), ("", []), ("software " * 3000, []),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
    ("Released under\nthe MIT\nLicense.\nCopyright (c) 2020 Some One\nAll rights reserved.", ["MIT", "Proprietary"]),
])
def test_texts(text, expected):
    assert names(text) == expected


def test_bsd_rules_are_ordered():
    def said(name):
        return l.SENTENCES[name][0].replace("<who>", "the holder") + ". "

    three = "".join(map(said, ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-as-is"]))
    assert names(three) == ["BSD-3-Clause"] and names(three.replace(said("bsd-name"), "")) == ["BSD-2-Clause"]
    assert names(said("bsd-binary") + said("bsd-grant")) == []
    assert names(said("mit-grant") + "unknown words here. " + said("mit-notice") + said("mit-as-is")) == ["MIT"]


def test_every_known_sentence_is_recognised_and_triggers():
    for name, known in l.SENTENCES.items():
        for sentence in known:
            text = sentence.replace("<version>", "2.0").replace("<who>", "some one").replace("<kind>", "by-sa")
            assert [s.name for s in l.sentences(f"before that.\n{text.upper()}.\nafter")] == [name], sentence
            assert l._triggered(text)
    assert {n.rstrip("?") for _, rule in l.RULES for n in rule} <= set(l.SENTENCES)


def test_every_known_sentence_is_recognised_wrapped_and_with_signs(spark):
    wraps = ["\n", "\r\n", "\n# ", " \n * ", "\n// "]
    signs = ["  ", "\t", "\u00a0", "-", " - ", "_", " | ", "!! "]
    texts, expected = [], []
    for name, known in l.SENTENCES.items():
        for sentence in known:
            words = sentence.replace("<version>", "2").replace("<who>", "some one").replace("<kind>", "by").split()
            forms = [sign.join(words) for sign in signs]
            # A copyright notice says whose it is to the end of its line, so only the others may run over lines.
            if name != "copyright":
                forms += [" ".join(words[:i]) + wrap + " ".join(words[i:]) for i in range(1, len(words)) for wrap in wraps]
                forms += [wrap.join(words) for wrap in wraps]
            texts += [f"{form.capitalize()}." for form in forms]
            expected += [name] * len(forms)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    got = {r.doc_id: [s.name for s in r.sentences] for r in l.recognised(docs).collect()}
    assert [(t, got[i]) for i, t in enumerate(texts) if got[i] != [expected[i]]] == []


def test_triggers_lie_within_words():
    assert all(l.normalised(t) == t and " " not in t for t in l.TRIGGERS)
    assert names("# This work is in the public\n# domain.") == names("This work is in the public-domain.") == ["Public-Domain"]


def test_spans_and_long_texts():
    text = "word\n" * 50_000 + APACHE + "word. " * 50_000 + "Released under the MIT License."
    (a, s, e), (b, s2, e2) = l.licences(l.sentences(text))
    assert (a, b) == ("Apache-2.0", "MIT") and text[s:e].lstrip("# ").startswith("Licensed") and text[s2:e2].strip() == "Released under the MIT License."


def test_real_documents_as_brute_force(spark):
    """Licence lines are searched as word sequences between line ends or stops."""
    known = {
        "MIT": "released under the mit license", "Apache-2.0": "licensed under the apache license version 2 0",
        "GPL-3.0-only": "this work is licensed under the gnu general public license version 3", "CC-BY-NC-4.0": "licensed under cc by nc 4 0", "Proprietary": "all rights reserved",
    }
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: Counter(r.licences.split()) for r in QUERIES["op9_license_rules"](spark, sf).collect()}
    texts = documents(spark, sf).select("doc_id", "text").collect()
    assert len(got) == len(texts) and sum(map(bool, got.values())) > 20
    for doc_id, text in texts:
        lines = [" ".join(re.findall(r"[a-z0-9]+", x)) for x in re.split(r"\n|[.;:?]\W*(?:\s|$)", text.lower())]
        assert got[doc_id] == Counter(n for x in lines for n, s in known.items() if x == s), doc_id


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, MPL, None), (3, GPL, "y"), (3, GPL, "y")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, sentences STRING")
    got = l.recognised(docs).collect()
    assert sorted((r.doc_id or 0, [x.name for x in r.licences]) for r in got) == [
        (0, ["MPL-2.0"]), (1, []), (2, []), (3, ["GPL-3.0-or-later"]), (3, ["GPL-3.0-or-later"]),
    ]
    assert l.recognised(docs.limit(0)).collect() == []


@pytest.mark.parametrize(("text", "expected"), [
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 The Foundation\n", ["GPL-3.0"]),
    ("GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007\n\nmore", ["AGPL-3.0"]),
    ("Apache License\nVersion 2.0, January 2004\nhttp://www.example.org/", ["Apache-2.0"]),
    ("Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted, free of charge, to any person or organization", ["BSL-1.0"]),
    ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising"
     " from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to"
     " alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you", ["Zlib"]),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies it", []),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 which accompanies this distribution.", ["EPL-2.0"]),
    ("To the extent possible under law, Some One has waived all copyright and related or neighboring rights to this work.", ["CC0-1.0"]),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by"
     " the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", ["AGPL-3.0-or-later"]),
])
def test_more_licences(text, expected):
    assert names(text) == expected


def test_sequences_of_all_sentences_as_brute_force():
    """Known sentences in any order between others: their identifiers in that order, and the rules found by plain search."""
    r = random.Random(4)
    known = [(n, x) for n, group in l.SENTENCES.items() for x in group if n != "copyright"]
    for _ in range(60):
        picked = [r.choice(known) for _ in range(r.randrange(1, 25))]
        text, expected = "", []
        for name, sentence in picked:
            if r.random() < 0.4:
                text += f"Other words {r.randrange(9)} stand here. "
            filled = sentence.replace("<version>", r.choice(["2.0", "3", "1.1"])).replace("<who>", "some one").replace("<kind>", "by-sa")
            words = filled.split()
            text += r.choice([" ", "\n", " \n# "]).join(words) + r.choice([". ", ";\n", ".\n\n"])
            expected.append(name)
        found = l.sentences(text)
        assert [s.name for s in found] == expected, text
        rest, told = expected, []
        while rest:
            for title, rule in l.RULES:
                own = [w.rstrip("?") for w in rule]
                fits = [k for k in itertools.product(*[(True, False) if w.endswith("?") else (True,) for w in rule])]
                taken = max((sum(k) for k in fits if any(k) and rest[: sum(k)] == [w for w, on in zip(own, k) if on]), default=0)
                if taken:
                    told.append(title.split("{")[0])
                    rest = rest[taken:]
                    break
            else:
                rest = rest[1:]
        assert [n[: len(t)] for (n, _, _), t in zip(l.licences(found), told, strict=True)] == told


@pytest.mark.parametrize("long", ["." * 200_000, ".!" * 100_000 + "x", "copyright" + "." * 200_000 + "x", " " * 200_000, "\n" * 200_000, "\n " * 100_000, "%" * 200_000,
                                  "copyright " + ". x" * 66_000, "copyright " * 20_000, "licensed under " * 14_000, "c " * 100_000 + "licensed"])
def test_long_runs_take_linear_time(long):
    began = time.perf_counter()
    l.sentences(long + " licensed")
    assert time.perf_counter() - began < 2
