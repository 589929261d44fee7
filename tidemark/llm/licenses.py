"""License scans: ordered signature rules behind a keyword prefilter.

A text is read as its words (runs of letters, digits and non-ASCII characters,
A-Z folded) joined by single blanks. Rules are regexes over that line. The keywords of a
rule are derived from its regex: strings of which any match holds one. One automaton finds all
keywords in a pass, and only rules of which one is there run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytewords import ALNUM_FOLDED, words
from tidemark.llm.common import blocks, id_text
from tidemark.llm.regexes import one_of

BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    pattern: str

    @property
    def keywords(self) -> frozenset[str]:
        """Of these any match holds at least one."""
        found = one_of(self.pattern)
        if not found or not all(k.strip() for k in found):
            raise ValueError(f"no keyword in {self.pattern!r}")
        return found


#: label: names as they stand in running text (regex over words), SPDX ids, words of a web address.
FAMILIES: dict[str, tuple[str, str, str]] = {
    "mit": (r"(?:the )?mit(?: expat)?", r"mit", r"opensource org licenses mit"),
    "apache": (r"apache(?: software)?", r"apache [12] [01]", r"apache org licenses"),
    "gpl": (r"(?:gnu )?(?:general public|gpl)(?: v?[123](?: 0)?)?", r"gpl [123] 0(?: only| or later)?", r"gnu org licenses gpl"),
    "lgpl": (r"(?:gnu )?(?:lesser|library) general public|lgpl(?: v?[23](?: [01])?)?", r"lgpl [23] [01](?: only| or later)?", r"gnu org licenses lgpl"),
    "agpl": (r"(?:gnu )?affero general public|agpl(?: v?3(?: 0)?)?", r"agpl [13] 0(?: only| or later)?", r"gnu org licenses agpl"),
    "fdl": (r"(?:gnu )?free documentation", r"gfdl 1 [123](?: only| or later)?", r"gnu org licenses fdl"),
    "bsd-2": (r"(?:simplified|freebsd|2 clause) bsd|bsd 2 clause", r"bsd 2 clause(?: patent)?", r"opensource org licenses bsd 2 clause"),
    "bsd-3": (r"(?:new|modified|revised|3 clause) bsd|bsd 3 clause", r"bsd 3 clause(?: clear)?", r"opensource org licenses bsd 3 clause"),
    "bsd": (r"(?:original |berkeley )?bsd", r"bsd 4 clause|0bsd", r"opensource org licenses bsd"),
    "isc": (r"isc", r"isc", r"opensource org licenses isc"),
    "mpl": (r"mozilla public", r"mpl [12] [01]", r"mozilla org mpl"),
    "epl": (r"eclipse public", r"epl [12] 0", r"eclipse org legal epl"),
    "edl": (r"eclipse distribution", r"edl 1 0", r"eclipse org org documents edl"),
    "cddl": (r"common development and distribution", r"cddl 1 [01]", r"opensource org licenses cddl"),
    "cpl": (r"common public", r"cpl 1 0", r"opensource org licenses cpl"),
    "eupl": (r"european union public", r"eupl 1 [012]", r"joinup ec europa eu"),
    "artistic": (r"(?:perl )?artistic", r"artistic [12] 0", r"opensource org licenses artistic"),
    "zlib": (r"zlib(?: libpng)?", r"zlib", r"opensource org licenses zlib"),
    "boost": (r"boost software", r"bsl 1 0", r"boost org license"),
    "unlicense": (r"(?:the )?unlicense", r"unlicense", r"unlicense org"),
    "wtfpl": (r"do what the fuck you want to public", r"wtfpl", r"wtfpl net"),
    "cc0": (r"(?:creative commons )?(?:cc0|cc zero)(?: 1 0)?(?: universal)?", r"cc0 1 0", r"creativecommons org publicdomain zero"),
    "cc-by": (r"(?:creative commons attribution|cc by)(?: [1234] [05])?", r"cc by [1234] [05]", r"creativecommons org licenses by [1234]"),
    "cc-by-sa": (r"creative commons attribution share ?alike|cc by sa(?: [1234] [05])?", r"cc by sa [1234] [05]", r"creativecommons org licenses by sa"),
    "cc-by-nc": (r"creative commons attribution non ?commercial|cc by nc(?: [1234] [05])?", r"cc by nc [1234] [05]", r"creativecommons org licenses by nc [1234]"),
    "cc-by-nd": (r"creative commons attribution no ?deriv(?:ative)?s|cc by nd(?: [1234] [05])?", r"cc by nd [1234] [05]", r"creativecommons org licenses by nd"),
    "cc-by-nc-sa": (r"creative commons attribution non ?commercial share ?alike|cc by nc sa(?: [1234] [05])?", r"cc by nc sa [1234] [05]", r"creativecommons org licenses by nc sa"),
    "cc-by-nc-nd": (r"creative commons attribution non ?commercial no ?deriv(?:ative)?s|cc by nc nd(?: [1234] [05])?", r"cc by nc nd [1234] [05]", r"creativecommons org licenses by nc nd"),
    "odbl": (r"open (?:database|data commons open database)", r"odbl 1 0", r"opendatacommons org licenses odbl"),
    "odc-by": (r"open data commons attribution", r"odc by 1 0", r"opendatacommons org licenses by"),
    "ofl": (r"(?:sil )?open font", r"ofl 1 [01]", r"scripts sil org ofl"),
    "psf": (r"python software foundation|psf", r"psf 2 0|python 2 0", r"python org psf license"),
    "php": (r"php", r"php 3 01?", r"php net license"),
    "ruby": (r"ruby", r"ruby", r"ruby lang org en about license"),
    "w3c": (r"w3c(?: software)?", r"w3c", r"w3 org consortium legal"),
    "openssl": (r"openssl", r"openssl", r"openssl org source license"),
    "ms-pl": (r"microsoft public", r"ms pl", r"opensource org licenses ms pl"),
    "ms-rl": (r"microsoft reciprocal", r"ms rl", r"opensource org licenses ms rl"),
    "osl": (r"open software", r"osl 3 0", r"opensource org licenses osl"),
    "afl": (r"academic free", r"afl 3 0", r"opensource org licenses afl"),
    "ncsa": (r"university of illinois|ncsa", r"ncsa", r"opensource org licenses ncsa"),
    "postgresql": (r"postgresql", r"postgresql", r"postgresql org about licen[cs]e"),
    "busl": (r"business source", r"busl 1 1", r"mariadb com bsl"),
    "sspl": (r"server side public", r"sspl 1 0", r"mongodb com licensing server side"),
}

#: Sentences of the licences themselves, and notices: label, priority, pattern.
SENTENCES = (
    ("mit", 90, r"permission is hereby granted free of charge to any person obtaining a copy .{0,160}?without restriction"),
    ("isc", 90, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("apache", 90, r"terms and conditions for use reproduction and distribution"),
    ("apache", 85, r"you may not use this file except in compliance with the license"),
    ("gpl", 90, r"is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", 91, r"is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", 91, r"is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", 85, r"without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("bsd", 85, r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", 88, r"neither the names? of .{1,80}? may be used to endorse or promote products derived from this software"),
    ("mpl", 90, r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", 90, r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("zlib", 90, r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("boost", 90, r"distributed under the boost software license version 1 0"),
    ("unlicense", 90, r"this is free and unencumbered software released into the public domain"),
    ("public-domain", 60, r"(?:in|into|to) the public domain"),
    ("proprietary", 50, r"all rights reserved"),
    ("proprietary", 55, r"confidential and proprietary|proprietary and confidential"),
    ("copyright", 30, r"copyright (?:c )?(?:19|20)[0-9]{2}"),
)


#: More sentences, written out: bodies, headers, exceptions, dual licences, notices. label, priority, pattern.
NOTICES = (
    # bodies
    ("mit", 88, r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", 80, r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("mit-0", 92, r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction .{0,120}?to permit persons to whom the software is furnished to do so the software is provided"),
    ("x11", 86, r"except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("isc", 82, r"the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("bsd", 80, r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 80, r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 78, r"this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("bsd", 78, r"this software is provided by the regents and contributors as is"),
    ("bsd-4", 89, r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd-3-clear", 89, r"no express or implied licenses to any party s patent rights are granted by this license"),
    ("apache", 84, r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache", 86, r"grant of patent license subject to the terms and conditions of this license each contributor hereby grants"),
    ("apache", 83, r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-1.1", 87, r"this product includes software developed by the apache software foundation http www apache org"),
    ("gpl", 88, r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl", 86, r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", 84, r"you should have received a copy of the gnu general public license along with"),
    ("lgpl", 86, r"you should have received a copy of the gnu lesser general public license along with"),
    ("lgpl", 86, r"you should have received a copy of the gnu library general public license along with"),
    ("agpl", 86, r"you should have received a copy of the gnu affero general public license along with"),
    ("agpl", 87, r"remote network interaction use with the gnu general public license"),
    ("gpl-or-later", 92, r"either version [123](?: 0)? of the license or at your option any later version"),
    ("gpl-only", 90, r"gnu general public license version 2 as published by the free software foundation(?! either)"),
    ("fdl", 88, r"with no invariant sections no front cover texts and no back cover texts"),
    ("mpl", 88, r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", 89, r"the contents of this file are subject to the mozilla public license version 1 1 the license you may not use this file except in compliance"),
    ("mpl", 84, r"this source code form is incompatible with secondary licenses as defined by the mozilla public license"),
    ("cddl", 88, r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("epl", 88, r"any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement"),
    ("artistic", 88, r"(?:you can|may) redistribute it and or modify it under the same terms as perl itself"),
    ("zlib", 86, r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("libpng", 89, r"(?:this code is released under the libpng license|libpng versions 1 [0-9] [0-9]{1,2} .{0,120}?are copyright)"),
    ("boost", 88, r"copies or derivative works are solely in the form of machine executable object code generated by a source language processor"),
    ("unlicense", 88, r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", 88, r"you just do what the fuck you want to"),
    ("beerware", 88, r"if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("cc0", 88, r"(?:has|have) waived all copyright and related or neighboring rights to"),
    ("cc-by", 84, r"this work is licensed under (?:a|the) creative commons attribution [1234] [05] (?:international|unported|generic)"),
    ("cc-by-sa", 85, r"this work is licensed under (?:a|the) creative commons attribution share ?alike [1234] [05] (?:international|unported|generic)"),
    ("cc-by-nc", 85, r"this work is licensed under (?:a|the) creative commons attribution non ?commercial [1234] [05] (?:international|unported|generic)"),
    ("ofl", 88, r"this font software is licensed under the sil open font license version 1 1"),
    ("psf", 88, r"psf is making python available to licensee on an as is basis|python software foundation license version [12]"),
    ("openssl", 88, r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("curl", 88, r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("hpnd", 84, r"be used in advertising or publicity pertaining to distribution of the software without (?:specific )?written prior permission"),
    ("ncsa", 88, r"neither the names of .{1,120}? nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("unicode", 88, r"obtaining a copy of the unicode data files and any associated documentation"),
    ("ijg", 88, r"this software is based in part on the work of the independent jpeg group"),
    ("json", 90, r"the software shall be used for good not evil"),
    ("sspl", 88, r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("busl", 88, r"effective on the change date or the fourth anniversary of the first publicly available distribution"),
    ("elastic", 88, r"you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", 90, r"the grant of rights under the license will not include and the license does not grant to you the right to sell the software"),
    # exceptions
    ("classpath-exception", 93, r"as a special exception the copyright holders of this library give you permission to link this library with independent modules"),
    ("autoconf-exception", 93, r"as a special exception the (?:free software foundation|respective autoconf macro s copyright owner) gives unlimited permission to copy distribute and modify"),
    ("bison-exception", 93, r"as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("openssl-exception", 93, r"as a special exception .{0,80}?give permission to link the code of .{0,80}?with the openssl library"),
    ("runtime-exception", 93, r"gcc runtime library exception version 3 1"),
    ("llvm-exception", 93, r"(?:apache license v?2 0|apache 2 0) with llvm exceptions?"),
    ("font-exception", 93, r"as a special exception if you create a document which uses this font and embed this font"),
    # dual licences and choices
    ("dual", 94, r"dual licensed under (?:the )?.{1,60}? (?:and|or) (?:the )?.{1,60}? licen[cs]es?"),
    ("dual", 94, r"licensed under either of .{1,160}? at your option"),
    ("dual", 94, r"alternatively (?:the contents of this file|this software|you) may be (?:used|distributed) under the terms of (?:either )?the gnu (?:lesser )?general public license"),
    ("dual", 92, r"distributed under a disjunctive (?:dual|tri) licen[cs]e"),
    # notices
    ("proprietary", 70, r"(?:this file contains|is the) (?:proprietary|confidential) (?:and trade secret )?information"),
    ("proprietary", 70, r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", 70, r"no part of this (?:publication|document|book|work|software) may be reproduced"),
    ("proprietary", 68, r"for internal use only"),
    ("evaluation", 70, r"for evaluation purposes only"),
    ("non-commercial", 72, r"for (?:personal and )?non ?commercial use only"),
    ("freeware", 66, r"(?:is|as) freeware"),
    ("shareware", 66, r"(?:is|as) shareware"),
    ("see-license", 40, r"see (?:the )?(?:accompanying |included )?(?:licen[cs]e|copying|notice)(?: txt| md| rst)? (?:file|for (?:more )?(?:details|information|terms))"),
    ("see-license", 38, r"found in the licen[cs]e file in the root directory of this source tree"),
    ("permission", 45, r"(?:re)?(?:printed|produced|used) (?:with|by) permission"),
    ("copyleft", 35, r"copyleft"),
    ("no-warranty", 33, r"provided as is without warrant(?:y|ies) of any kind"),
    ("trademark", 32, r"(?:is|are) (?:a )?registered trademarks? of"),
    ("copyright", 31, r"portions copyright(?: c| by)?"),
)


def rules() -> list[Rule]:
    """Every rule, highest priority first: sentences and notices one by one; for each family its tag, address, grant and names."""
    out = [Rule(label, p, pattern) for label, p, pattern in (*SENTENCES, *NOTICES)]
    for label, (name, tag, address) in FAMILIES.items():
        out += [
            Rule(label, 95, rf"spdx license identifier (?:{tag})"),
            Rule(label, 80, address),
            Rule(label, 75, rf"(?:licen[cs]ed|released|distributed|available|provided|published) under (?:the )?(?:terms of the )?(?:{name})(?: licen[cs]e)?"),
            Rule(label, 65, rf"licen[cs]e (?:is |type |name )?(?:the )?(?:{name})"),
            Rule(label, 60, rf"(?:{name}) licen[cs]e"),
        ]
    return sorted(out, key=lambda r: -r.priority)


_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def compiled(rule: Rule) -> re.Pattern[str]:
    """The rule between whole words."""
    return re.compile(rf"(?<![^ ])(?:{rule.pattern})(?![^ ])")


class Scanner:
    """Keyword automaton and compiled rules; made once in each Python worker."""

    def __init__(self, given: list[Rule]):
        self.rules = [(r, compiled(r)) for r in given]
        self.base = [(label, re.compile(rf"(?<![^ ])(?={phrase}(?![^ ]))")) for phrase, label in BASE]
        needs = [r.keywords for r in given]
        keys = sorted(set().union(*needs) | {"license"})
        self.number = {k: i for i, k in enumerate(keys)}
        self.needs = [frozenset(self.number[k] for k in own) for own in needs]
        #: any text that a rule can match holds one of these; they are searched first, over bytes
        self.roots = self._roots(keys)
        self.machine = ahocorasick.Automaton()
        for k, i in self.number.items():
            self.machine.add_word(k, i)
        self.machine.make_automaton()

    @staticmethod
    def _roots(keys: list[str]) -> list[bytes]:
        """Longest words of the keywords, one for each keyword, without those that hold another."""
        longest = {max(k.split(), key=len) for k in keys}
        least = {w for w in longest if not any(v != w and v in w for v in longest)}
        return sorted(w.encode() for w in least)

    def detect(self, body: bytes) -> tuple[list[tuple[int, str]], list[tuple[int, int, str, int]]]:
        """Base places (word, label), and detections (first word, one past the last, label, priority) left after suppression."""
        folded = body.translate(_FOLD)
        if not any(r in folded for r in self.roots):
            return [], []
        line = b" ".join(folded.split()).decode("utf-8", "replace")  # bytes: wide blanks are word characters
        there = {i for _, i in self.machine.iter(line)}
        blanks = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 32)

        def word(at: int) -> int:
            return int(np.searchsorted(blanks, at))

        base = []
        if self.number["license"] in there:
            for label, pattern in self.base:
                base += [(word(m.start()), label) for m in pattern.finditer(line)]
        found = []
        for (rule, pattern), needs in zip(self.rules, self.needs, strict=True):
            if not needs.isdisjoint(there):
                found += [(word(m.start()), word(m.end()) + 1, rule.label, rule.priority) for m in pattern.finditer(line)]
        return sorted(base), sorted(uncovered(found))


def uncovered(found: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """Detections not inside another of higher priority (or of equal priority and longer; of equals the first label)."""
    place = {a: i for i, a in enumerate(sorted({d[0] for d in found}), 1)}
    furthest = [0] * (len(place) + 1)  # a binary indexed tree: the largest end among the starts up to a place
    kept = []
    for d in sorted(found, key=lambda d: (-d[3], d[0] - d[1], d[0], d[2])):
        i, reach = place[d[0]], 0
        while i:
            reach, i = max(reach, furthest[i]), i - (i & -i)
        if reach >= d[1]:
            continue
        kept.append(d)
        i = place[d[0]]
        while i < len(furthest):
            furthest[i], i = max(furthest[i], d[1]), i + (i & -i)
    return kept


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64()), ("label", pa.string()), ("priority", pa.int32())]))
_BASE = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
SCHEMA = "doc_id long, n_words long, base array<struct<word: long, label: string>>, spans array<struct<first: long, past: long, label: string, priority: int>>"


def scan_licenses(docs: DataFrame, given: list[Rule] | None = None) -> DataFrame:
    """Licence phrases and detections of every whole text: doc_id, n_words, base, spans (words from 0, ends exclusive).

    A null text counts as empty; rows with equal or null ids each give a row of their own; other columns
    of docs are not looked at.
    """
    given = rules() if given is None else given

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given)
        for batch in batches:
            ids, bodies = batch.column(0), batch.column(1)
            counts = [words(buf, at, ALNUM_FOLDED, hashed=False).counts for _, _, buf, at in blocks(bodies)]
            base, spans = [], []
            for body in bodies:
                b, s = scanner.detect(body.as_py())
                base.append([{"word": w, "label": x} for w, x in b])
                spans.append([{"first": a, "past": z, "label": x, "priority": p} for a, z, x, p in s])
            n = np.concatenate(counts) if counts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(base, _BASE), pa.array(spans, _SPANS)], ["doc_id", "n_words", "base", "spans"])

    return id_text(docs).mapInArrow(scan, SCHEMA)


def license_report(scanned: DataFrame) -> DataFrame:
    """The digest of scan_licenses: base counts and labels, all labels, and a score (highest priority / 100).

    A row for each row of `scanned`; texts without detections have empty labels, null places and score 0. No rows: no rows.
    """
    base = F.array_sort(F.array_distinct(F.col("base.label")))
    every = F.array_sort(F.array_union(F.col("base.label"), F.col("spans.label")))
    best = F.greatest(F.coalesce(F.array_max("spans.priority"), F.lit(0)), F.when(F.size("base") > 0, 60).otherwise(0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        (best / F.lit(100.0)).alias("score"),
    )
