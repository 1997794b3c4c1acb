"""License scans by ordered signature rules.

Texts are brought to a normal form (words of letters, digits and non-ASCII
characters in lower case, one blank between), so that a rule is a short
regular expression over words.  A rule is tried only where its keyword
occurs.  Rules have a priority; of overlapping detections the one with the
better priority (then the longer, then the earlier) stays, and those whose
interval it contains go.  Four plain phrases are the base: every place where
their words stand consecutively counts, and their labels always stay.

A document is a unit of work of its own: one pass, no shuffle.
"""
from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, map_arrow, text_slices

#: base phrases and their labels (fixed by the query's contract)
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Names as words in normal form: label, keyword that every wording of the name has, the name's pattern.
NAMES = [
    ("gpl", "gnu", r"gnu (?:general public|gpl)"), ("gpl", "gpl", r"gpl ?v?[123]?"),
    ("lgpl", "lesser", r"gnu lesser general public"), ("lgpl", "library", r"gnu library general public"),
    ("lgpl", "lgpl", r"lgpl ?v?[23]?"), ("agpl", "affero", r"(?:gnu )?affero general public"),
    ("agpl", "agpl", r"agpl ?v?3?"), ("gfdl", "documentation", r"gnu free documentation"),
    ("apache", "apache", r"apache(?: software)?"), ("mit", "mit", r"(?:the )?mit"), ("mit", "x11", r"x11"),
    ("mit", "expat", r"expat"), ("bsd", "bsd", r"(?:new |modified |simplified |revised )?bsd(?: [234] clause)?"),
    ("isc", "isc", r"isc"), ("mpl", "mozilla", r"mozilla public"), ("epl", "eclipse", r"eclipse public"),
    ("edl", "eclipse", r"eclipse distribution"), ("cddl", "distribution", r"common development and distribution"),
    ("cpl", "common", r"common public"), ("ipl", "ibm", r"ibm public"), ("artistic", "artistic", r"(?:perl )?artistic"),
    ("zlib", "zlib", r"zlib(?: libpng)?"), ("libpng", "libpng", r"libpng"), ("boost", "boost", r"boost software"),
    ("unlicense", "unlicense", r"unlicense"), ("wtfpl", "wtfpl", r"wtfpl"), ("cc0", "cc0", r"cc0(?: 1 0)?"),
    ("cc-by-sa", "sharealike", r"(?:creative commons )?attribution sharealike"), ("cc-by-nc", "noncommercial", r"(?:creative commons )?attribution noncommercial"),
    ("cc-by-nd", "noderivatives", r"(?:creative commons )?attribution noderivatives"), ("cc-by", "attribution", r"creative commons attribution"),
    ("ofl", "font", r"(?:sil )?open font"), ("psf", "python", r"python software foundation"), ("php", "php", r"php"),
    ("ruby", "ruby", r"ruby"), ("postgresql", "postgresql", r"postgresql"), ("openssl", "openssl", r"openssl"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?"), ("eupl", "european", r"european union public"),
    ("cecill", "cecill", r"cecill"), ("mulan", "mulan", r"mulan psl"), ("ms-pl", "microsoft", r"microsoft public"),
    ("ms-rl", "microsoft", r"microsoft reciprocal"), ("osl", "open", r"open software"), ("afl", "academic", r"academic free"),
    ("qpl", "public", r"q public"), ("zpl", "zope", r"zope public"), ("w3c", "w3c", r"w3c software"),
    ("sleepycat", "sleepycat", r"sleepycat"), ("vim", "vim", r"vim"), ("curl", "curl", r"curl"), ("json", "json", r"json"),
    ("beerware", "beer", r"beer ?ware"), ("bsl", "business", r"business source"), ("sspl", "server", r"server side public"),
    ("elastic", "elastic", r"elastic"), ("odbl", "database", r"open database"), ("upl", "universal", r"universal permissive"),
]

# Ways to speak of a license: priority (less is better), weight, prefix and suffix around the name.
FORMS = [
    (1, 1.0, r"spdx license identifier ", r""),
    (2, 0.9, r"(?:licensed|released|distributed|available|covered|published) under (?:the )?(?:terms (?:of|and conditions of) (?:the )?)?",
     r"(?: licen[cs]e)?(?: as published by(?: \w+){1,4})?(?: (?:version|v) ?\d(?: \d)?)?"),
    (3, 0.8, r"", r" licen[cs]e (?:version|v) ?\d(?: \d)?"),
    (4, 0.7, r"(?:under|see|of|read) the ", r" licen[cs]e"),
    (5, 0.5, r"", r" licen[cs]e"),
]

# Wordings of their own: priority, weight, label, keyword, pattern.
TEXTS = [
    (1, 1.0, "mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    (1, 1.0, "isc", "permission", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee"),
    (1, 1.0, "bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    (1, 1.0, "gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    (1, 1.0, "lgpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    (1, 1.0, "agpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    (1, 1.0, "apache", "apache", r"you may not use this file except in compliance with the license(?: you may obtain a copy of the license at)?(?: http)? ?(?:www )?apache"),
    (1, 1.0, "apache", "apache", r"apache org licenses license 2 0"),
    (1, 1.0, "gpl", "gnu", r"gnu org licenses(?: old licenses)? gpl"), (1, 1.0, "lgpl", "gnu", r"gnu org licenses lgpl"),
    (1, 1.0, "agpl", "gnu", r"gnu org licenses agpl"), (1, 1.0, "mpl", "mozilla", r"mozilla org mpl"),
    (1, 1.0, "mit", "opensource", r"opensource org licenses mit"), (1, 1.0, "bsd", "opensource", r"opensource org licenses bsd"),
    (1, 1.0, "cc-by", "creativecommons", r"creativecommons org licenses by \d"),
    (1, 1.0, "cc-by-sa", "creativecommons", r"creativecommons org licenses by sa"),
    (1, 1.0, "cc-by-nc", "creativecommons", r"creativecommons org licenses by nc"),
    (1, 1.0, "cc-by-nd", "creativecommons", r"creativecommons org licenses by nd"),
    (1, 1.0, "cc0", "creativecommons", r"creativecommons org publicdomain zero"),
    (2, 0.9, "cc-by-nc-sa", "cc", r"cc by nc sa(?: \d \d)?"), (2, 0.9, "cc-by-nc-nd", "cc", r"cc by nc nd(?: \d \d)?"),
    (3, 0.9, "cc-by-nc", "cc", r"cc by nc(?: \d \d)?"), (3, 0.9, "cc-by-sa", "cc", r"cc by sa(?: \d \d)?"),
    (3, 0.9, "cc-by-nd", "cc", r"cc by nd(?: \d \d)?"), (4, 0.8, "cc-by", "cc", r"cc by(?: \d \d)?"),
    (2, 0.9, "unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    (3, 0.6, "public-domain", "domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    (3, 0.6, "proprietary", "reserved", r"all rights reserved"),
    (3, 0.8, "proprietary", "confidential", r"proprietary and confidential"),
    (2, 0.9, "bsd", "neither", r"neither the name of(?: \w+){1,8} nor the names of its contributors"),
    (2, 0.9, "zlib", "warranty", r"provided as is without any express or implied warranty in no event will the authors be held liable"),
    (2, 0.9, "wtfpl", "fuck", r"do what the fuck you want to public license"),
    (2, 0.9, "boost", "boost", r"boost org license 1 0"),
    # --- sentences of the license texts themselves
    (1, 1.0, "mit", "sublicense", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"),
    (1, 0.9, "mit", "copyright", r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions"),
    (2, 0.7, "mit", "liable", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    (2, 0.7, "mit", "merchantability", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    (1, 1.0, "bsd", "redistributions", r"redistributions of source code must retain the above copyright notice"),
    (1, 1.0, "bsd", "redistributions", r"redistributions in binary form must reproduce the above copyright notice"),
    (1, 1.0, "bsd-4", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    (2, 0.8, "bsd", "copyright", r"this software is provided by the (?:copyright holders|regents|authors?)(?: and contributors)? as is and any express or implied warranties"),
    (2, 0.8, "bsd", "endorse", r"may(?: not)? be used to endorse or promote products derived from this software"),
    (1, 1.0, "isc", "permission", r"provided that the above copyright notice and this permission notice appear in all copies"),
    (2, 0.8, "isc", "disclaims", r"the author disclaims all warranties with regard to this software"),
    (1, 1.0, "0bsd", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?= the software)"),
    (1, 1.0, "zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    (1, 1.0, "zlib", "altered", r"altered source versions must be plainly marked as such"),
    (1, 1.0, "boost", "machine", r"solely in the form of machine executable object code generated by a source language processor"),
    (1, 1.0, "gpl", "freedom", r"is intended to guarantee your freedom to share and change"),
    (1, 1.0, "gpl", "merchantability", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    (1, 1.0, "lgpl", "merchantability", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser general public license"),
    (1, 1.0, "agpl", "merchantability", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu affero general public license"),
    (2, 0.9, "gpl", "received", r"you should have received a copy of the gnu general public license"),
    (2, 0.9, "lgpl", "received", r"you should have received a copy of the gnu (?:lesser|library) general public license"),
    (2, 0.9, "agpl", "received", r"you should have received a copy of the gnu affero general public license"),
    (2, 0.8, "gpl", "foundation", r"published by the free software foundation either version \d"),
    (2, 0.9, "gpl", "exception", r"as a special exception(?: \w+){0,12} gnu general public license"),
    (2, 0.9, "gpl", "classpath", r"gnu general public license(?: \w+){0,6} classpath exception"),
    (1, 1.0, "gfdl", "invariant", r"with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts"),
    (1, 1.0, "apache", "contributor", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    (2, 0.8, "apache", "distributed", r"distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    (2, 0.9, "apache", "apache", r"this product includes software developed by the apache (?:software foundation|group)"),
    (1, 1.0, "mpl", "mozilla", r"this source code form is subject to the terms of the mozilla public license"),
    (2, 0.9, "mpl", "mpl", r"if a copy of the mpl was not distributed with this file"),
    (2, 0.9, "mpl", "mpl", r"mpl ?v?(?:1 1|2 0)"),
    (1, 1.0, "epl", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    (2, 0.9, "epl", "epl", r"epl ?v?(?:1 0|2 0)"),
    (2, 0.9, "epl", "eclipse", r"eclipse org legal epl"),
    (2, 0.9, "edl", "eclipse", r"eclipse org org documents edl"),
    (1, 1.0, "cddl", "cddl", r"you may not use this file except in compliance with the(?: \w+){0,8} cddl"),
    (2, 0.9, "cddl", "cddl", r"cddl ?v?1 [01]"),
    (1, 1.0, "eupl", "eupl", r"licensed under the eupl"),
    (2, 0.9, "eupl", "eupl", r"eupl ?v?1 [0-2]"),
    (1, 1.0, "artistic", "artistic", r"this(?: \w+){1,4} is free software you can redistribute it and or modify it under the(?: terms of the)? artistic license"),
    (2, 0.9, "perl", "perl", r"under the same terms as perl itself"),
    (1, 1.0, "ofl", "font", r"this font software is licensed under the sil open font license"),
    (2, 0.9, "ofl", "ofl", r"(?:sil )?ofl ?1 1"),
    (2, 0.9, "ofl", "reserved", r"with reserved font names?"),
    (1, 1.0, "unlicense", "anyone", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    (1, 1.0, "wtfpl", "everyone", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    (2, 0.7, "gpl", "everyone", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    (1, 1.0, "beerware", "beer", r"you can buy me a beer in return"),
    (1, 1.0, "cc0", "cc0", r"has waived all copyright and related or neighboring rights(?: to(?: \w+){1,6})?(?= .{0,80}cc0)"),
    (2, 0.9, "cc0", "cc0", r"cc0 1 0 universal"),
    (2, 0.9, "cc0", "dedication", r"public domain dedication"),
    (1, 1.0, "cc-by", "commons", r"creative commons attribution \d 0(?: international| unported| generic)?"),
    (1, 1.0, "cc-by-sa", "commons", r"creative commons attribution share ?alike \d 0(?: international| unported| generic)?"),
    (1, 1.0, "cc-by-nc", "commons", r"creative commons attribution non ?commercial \d 0(?: international| unported| generic)?"),
    (1, 1.0, "cc-by-nc-sa", "commons", r"creative commons attribution non ?commercial share ?alike(?: \d 0)?(?: international| unported| generic)?"),
    (1, 1.0, "cc-by-nc-nd", "commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: \d 0)?(?: international| unported| generic)?"),
    (1, 1.0, "cc-by-nd", "commons", r"creative commons attribution no ?deriv(?:ative)?s(?: \d 0)?(?: international| unported| generic)?"),
    (2, 0.8, "cc-by", "adapt", r"you are free to(?: \w+){0,6} adapt(?: \w+){0,20} as long as you give appropriate credit"),
    (2, 0.8, "cc-by", "credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    (2, 0.9, "cc-by-nc", "commercial", r"you may not use the material for commercial purposes"),
    (2, 0.9, "cc-by-nd", "remix", r"if you remix transform or build upon the material you may not distribute the modified material"),
    (2, 0.9, "cc-by-sa", "remix", r"if you remix transform or build upon the material you must distribute your contributions under the same license"),
    (1, 1.0, "odbl", "opendatacommons", r"opendatacommons org licenses odbl"),
    (1, 1.0, "odc-by", "opendatacommons", r"opendatacommons org licenses by"),
    (1, 1.0, "pddl", "opendatacommons", r"opendatacommons org licenses pddl"),
    (1, 1.0, "cdla", "data", r"community data license agreement(?: permissive| sharing)?"),
    (1, 1.0, "ogl", "government", r"open government licen[cs]e(?: v ?\d(?: 0)?)?"),
    (1, 1.0, "psf", "python", r"this license agreement is between the python software foundation"),
    (1, 1.0, "php", "php", r"this (?:source file|software) is subject to(?: version \d(?: \d+)? of)? the php license"),
    (2, 0.9, "php", "php", r"this product includes php software freely available from"),
    (1, 1.0, "openssl", "openssl", r"this product includes software developed by the openssl project"),
    (1, 1.0, "ssleay", "eric", r"this product includes cryptographic software written by eric young"),
    (1, 1.0, "postgresql", "postgresql", r"postgresql database management system(?: \w+){0,20} permission to use copy modify and distribute this software"),
    (1, 1.0, "ncsa", "illinois", r"university of illinois(?: \w+){0,6} open source license"),
    (1, 1.0, "w3c", "w3c", r"this work is being provided by the copyright holders under the following license(?: .{0,60})? w3c"),
    (1, 1.0, "vim", "vim", r"there are no restrictions on distributing unmodified copies of vim"),
    (1, 1.0, "json", "evil", r"the software shall be used for good not evil"),
    (1, 1.0, "curl", "stenberg", r"copyright c(?: \d+){1,3} daniel stenberg"),
    (1, 1.0, "ms-pl", "microsoft", r"this license governs use of the accompanying software(?= .{0,200}microsoft public)"),
    (1, 1.0, "sspl", "sspl", r"sspl ?v?1?"),
    (1, 1.0, "sspl", "server", r"server side public license"),
    (1, 1.0, "bsl", "change", r"on the change date(?: \w+){0,12} change license"),
    (1, 1.0, "bsl", "busl", r"busl ?1 1"),
    (1, 1.0, "elastic", "hosted", r"you may not provide the software to third parties as a hosted or managed service"),
    (1, 1.0, "commons-clause", "commons", r"commons clause license condition"),
    (1, 1.0, "polyform", "polyform", r"polyform (?:noncommercial|shield|strict|small business|perimeter) license"),
    (1, 1.0, "openrail", "openrail", r"(?:creativeml |bigscience |bigcode )?openrail(?: [ms])?"),
    (1, 1.0, "cecill", "cecill", r"under french law and abiding by the rules of distribution of free software(?= .{0,300}cecill)"),
    (1, 1.0, "mulan", "mulan", r"you can use this software according to the terms and conditions of the mulan psl"),
    (1, 1.0, "upl", "universal", r"the universal permissive license upl"),
    (1, 1.0, "hpnd", "hpnd", r"historical permission notice and disclaimer(?= .{0,40}hpnd)"),
    (1, 1.0, "osl", "osl", r"osl ?3 0"), (1, 1.0, "afl", "afl", r"afl ?(?:2 1|3 0)"),
    (1, 1.0, "ecl", "educational", r"educational community license(?: version 2 0)?"),
    (1, 1.0, "naist", "nara", r"nara institute of science and technology(?: \w+){0,10} permission to use copy"),
    (1, 1.0, "unicode", "unicode", r"unicode (?:license agreement data files and software|data files or unicode software)"),
    (1, 1.0, "tcl", "terms", r"the following terms apply to all files associated with the software unless explicitly disclaimed in individual files"),
    (1, 1.0, "ijg", "jpeg", r"this software is based in part on the work of the independent jpeg group"),
    (1, 1.0, "freetype", "freetype", r"portions of this software are copyright(?: c)?(?: \w+){0,3} the freetype project"),
    (2, 0.6, "public-domain", "domain", r"this (?:file|work|code|software|program|document)(?: \w+){0,3} (?:is )?in the public domain"),
    (2, 0.6, "public-domain", "domain", r"no copyright is claimed(?: \w+){0,12} public domain"),
    (3, 0.8, "proprietary", "confidential", r"this (?:document|file|software|code) contains confidential(?: and proprietary)? information"),
    (3, 0.8, "proprietary", "prohibited", r"unauthori[sz]ed (?:copying|reproduction|distribution|use)(?: \w+){0,10} (?:is )?strictly prohibited"),
    (3, 0.7, "proprietary", "permission", r"(?:may not|no part(?: \w+){1,4} may) be (?:reproduced|copied|distributed)(?: \w+){0,14} without(?: the)?(?: prior)?(?: express)?(?: written)? permission"),
    (3, 0.8, "proprietary", "end", r"end user licen[cs]e agreement"),
    (3, 0.7, "proprietary", "internal", r"for internal use only"),
    (3, 0.7, "proprietary", "trade", r"contains trade secrets(?: \w+){0,8} property of"),
    (4, 0.6, "non-commercial", "commercial", r"for non ?commercial (?:use|purposes) only"),
    (4, 0.6, "academic", "research", r"for (?:academic|research)(?: and (?:academic|research|educational))? (?:use|purposes) only"),
    (5, 0.4, "unknown", "license", r"licen[cs]ed under (?:the )?\w+"),
    (5, 0.4, "unknown", "licence", r"licenced under (?:the )?\w+"),  # the same without any "license" in the text
]


@dataclass(frozen=True)
class Rule:
    priority: int
    weight: float
    label: str
    keyword: bytes
    pattern: re.Pattern


def rules() -> list[Rule]:
    """All rules in order: every form of every name, and the wordings of their own."""
    out = [Rule(p, w, label, k.encode(), re.compile(rf"(?<= ){text}(?= )".encode())) for p, w, label, k, text in TEXTS]
    for priority, weight, before, after in FORMS:
        out += [Rule(priority, weight, label, k.encode(), re.compile(rf"(?<= ){before}{name}{after}(?= )".encode()))
                for label, k, name in NAMES]
    return sorted(out, key=lambda r: r.priority)


class Scanner:
    def __init__(self, order: list[Rule] | None = None):
        self.rules = rules() if order is None else order
        self.keywords = sorted({r.keyword for r in self.rules})
        self.phrases = [(f" {p} ".encode(), label) for p, label in BASE.items()]

    def detect(self, text: bytes) -> list[tuple[int, int, str, float]]:
        """Detections (start, end, label, weight) in a padded text in normal form
        that are left after suppression, by start; "unknown" gives way to any
        other label it overlaps with."""
        there = {k for k in self.keywords if k in text}
        found = [(r.priority, m.start() - m.end(), m.start(), m.end(), r.label, r.weight)
                 for r in self.rules if r.keyword in there for m in r.pattern.finditer(text)]
        kept: list[tuple[int, int, str, float]] = []
        starts, ends = [], []  # of the kept ones that no other kept one contains; both ascend
        for _, _, start, end, label, weight in sorted(found):
            at = bisect.bisect_right(starts, start)
            if at and ends[at - 1] >= end:
                continue
            kept.append((start, end, label, weight))
            first = bisect.bisect_left(starts, start)
            last = bisect.bisect_right(ends, end, first)
            starts[first:last], ends[first:last] = [start], [end]
        known = sorted(x[:2] for x in kept if x[2] != "unknown")
        begins, reach = [a for a, _ in known], list(itertools.accumulate((b for _, b in known), max))

        def overlapped(start: int, end: int) -> bool:
            before = bisect.bisect_left(begins, end)
            return before > 0 and reach[before - 1] > start

        return sorted(x for x in kept if x[2] != "unknown" or not overlapped(x[0], x[1]))

    def scan(self, text: bytes):
        """n_words, places of base phrases (first word, label), detections, score."""
        words = alnum_words(text)
        low = text.lower()
        if not any(k in low for k in self.keywords) and not any(all(w in low for w in p.split()) for p, _ in self.phrases):
            return len(words), [], [], 0.0
        normal = b" " + b" ".join(words) + b" "
        places = []
        for phrase, label in self.phrases:
            at, last, word = normal.find(phrase), 0, 0
            while at >= 0:
                word += normal.count(b" ", last, at)  # blanks since the last place
                places.append((word, label))
                last, at = at, normal.find(phrase, at + 1)
        detections = self.detect(normal)
        score = max([0.7 if places else 0.0, *(w for *_, w in detections)])
        return len(words), sorted(places), detections, score


SCHEMA = ("doc_id long, n_words long, places array<struct<word:long,label:string>>, "
          "detections array<struct<start:long,end:long,label:string,weight:double>>, score double")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, places of base phrases (number of
    the first word), detections (places in the text's normal form, padded by a
    blank), score (the best weight, 0 without any).

    Null and empty texts have no words; repeated rows get a row each; other
    columns are not read; an empty table gives no rows.  A very long text is one
    task's work, in proportion to its length and n log n for its n detections.
    """
    place = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("weight", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch, texts in text_slices(batches, 1):
            rows = [scanner.scan(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([r[0] for r in rows], pa.int64()),
                pa.array([[{"word": w, "label": x} for w, x in r[1]] for r in rows], place),
                pa.array([[dict(zip(("start", "end", "label", "weight"), x)) for x in r[2]] for r in rows], span),
                pa.array([r[3] for r in rows], pa.float64())], names=["doc_id", "n_words", "places", "detections", "score"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SCHEMA)
