"""License scanning with ordered signature rules.

Each rule is a regex with a priority and a gate: words that must all occur in the text before the regex
is tried at all. There are rules for what full texts and notices say, and rules for names: the product of
hand-written name signatures and hand-written ways of stating a license. Comment marks at the beginnings of
lines are passed over, and any white space counts as one space. Detections that lie within a detection of a
higher rank (priority, then length, then place, then rule order) are suppressed, so "GNU Lesser General
Public License" is not also reported as the GPL named inside it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_rows
from .secrets import _arrow_type

#: Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Between a name and its version, and after the version.
V, LATER = r",?[ -]?(?:version[ -]?|v\.? ?)?", r"(?:\+| or later|-or-later|-only)?"

#: Label, regex of the name, words of which one must occur. Texts are in lower case when these are tried.
NAMES = (
    ("mit", r"(?:the )?mit", "mit"),
    ("mit-0", r"mit[ -](?:no attribution|0)", "mit"),
    ("apache-2.0", rf"(?:the )?apache(?: software)?(?: license)?{V}2(?:\.0)?", "apache"),
    ("apache-1.1", rf"(?:the )?apache(?: software)?(?: license)?{V}1\.1", "apache"),
    ("apache", r"(?:the )?apache(?: software)?", "apache"),
    ("gpl-2.0", rf"(?:the )?(?:gnu )?(?:general public license|gpl){V}2(?:\.0)?{LATER}", "gpl|general"),
    ("gpl-3.0", rf"(?:the )?(?:gnu )?(?:general public license|gpl){V}3(?:\.0)?{LATER}", "gpl|general"),
    ("gpl", r"(?:the )?gnu (?:general public|gpl)", "gnu"),
    ("lgpl-2.1", rf"(?:the )?(?:gnu )?(?:lesser general public license|lgpl){V}2\.1{LATER}", "lgpl|lesser"),
    ("lgpl-3.0", rf"(?:the )?(?:gnu )?(?:lesser general public license|lgpl){V}3(?:\.0)?{LATER}", "lgpl|lesser"),
    ("lgpl", r"(?:the )?(?:gnu )?(?:lesser|library) general public|lgpl", "lgpl|general"),
    ("agpl-3.0", rf"(?:the )?(?:gnu )?(?:affero general public license|agpl){V}3(?:\.0)?{LATER}", "agpl|affero"),
    ("agpl", r"(?:the )?(?:gnu )?affero general public|agpl", "agpl|affero"),
    ("bsd-2-clause", r"(?:the )?(?:simplified bsd|freebsd|bsd[ -]2[ -]clause|2[ -]clause bsd)", "bsd"),
    ("bsd-3-clause", r"(?:the )?(?:new bsd|modified bsd|revised bsd|bsd[ -]3[ -]clause|3[ -]clause bsd)", "bsd"),
    ("bsd-4-clause", r"(?:the )?(?:original bsd|bsd[ -]4[ -]clause|4[ -]clause bsd)", "bsd"),
    ("bsd-0-clause", r"(?:the )?(?:0bsd|zero[ -]clause bsd)", "bsd"),
    ("bsd", r"(?:the )?bsd(?:-style)?", "bsd"),
    ("isc", r"(?:the )?isc", "isc"),
    ("mpl-1.1", rf"(?:the )?(?:mozilla public license|mpl){V}1\.1", "mpl|mozilla"),
    ("mpl-2.0", rf"(?:the )?(?:mozilla public license|mpl){V}2(?:\.0)?", "mpl|mozilla"),
    ("mpl", r"(?:the )?mozilla public", "mozilla"),
    ("epl-1.0", rf"(?:the )?(?:eclipse public license|epl){V}1(?:\.0)?", "epl|eclipse"),
    ("epl-2.0", rf"(?:the )?(?:eclipse public license|epl){V}2(?:\.0)?", "epl|eclipse"),
    ("eupl", r"(?:the )?(?:european union public|eupl)", "eupl|european"),
    ("cddl", r"(?:the )?(?:common development and distribution|cddl)", "cddl|common"),
    ("cpl-1.0", r"(?:the )?common public", "common"),
    ("artistic-2.0", rf"(?:the )?artistic(?: license)?{V}2(?:\.0)?", "artistic"),
    ("artistic", r"(?:the )?(?:perl )?artistic", "artistic"),
    ("zlib", r"(?:the )?zlib(?:/libpng)?", "zlib"),
    ("boost", r"(?:the )?(?:boost software|bsl-1\.0)", "boost|bsl"),
    ("unlicense", r"(?:the )?unlicense", "unlicense"),
    ("wtfpl", r"(?:the )?(?:wtfpl|do what the f\w+ you want to public)", "wtfpl|do what"),
    ("postgresql", r"(?:the )?postgresql", "postgresql"),
    ("python-2.0", r"(?:the )?(?:python software foundation|psf)", "psf|python"),
    ("ruby", r"(?:the )?ruby", "ruby"),
    ("php-3.01", r"(?:the )?php", "php"),
    ("openssl", r"(?:the )?openssl", "openssl"),
    ("ofl-1.1", r"(?:the )?(?:(?:sil )?open font|ofl-1\.1)", "font|ofl"),
    ("odbl", r"(?:the )?(?:open database|odbl)", "odbl|database"),
    ("cc0-1.0", r"(?:cc0|cc[ -]zero|creative commons zero)(?:[ -]1\.0)?", "cc|creative"),
    ("cc-by-nc-nd", r"(?:cc[ -]by[ -]nc[ -]nd|creative commons attribution[ -]non-?commercial[ -]no-?deriv\w+)(?:[ -]?[1-4]\.0)?", "cc|creative"),
    ("cc-by-nc-sa", r"(?:cc[ -]by[ -]nc[ -]sa|creative commons attribution[ -]non-?commercial[ -]share-?alike)(?:[ -]?[1-4]\.0)?", "cc|creative"),
    ("cc-by-nc", r"(?:cc[ -]by[ -]nc|creative commons attribution[ -]non-?commercial)(?:[ -]?[1-4]\.0)?", "cc|creative"),
    ("cc-by-nd", r"(?:cc[ -]by[ -]nd|creative commons attribution[ -]no-?deriv\w+)(?:[ -]?[1-4]\.0)?", "cc|creative"),
    ("cc-by-sa", r"(?:cc[ -]by[ -]sa|creative commons attribution[ -]share-?alike)(?:[ -]?[1-4]\.0)?", "cc|creative"),
    ("cc-by", r"(?:cc[ -]by|creative commons attribution)(?:[ -]?[1-4]\.0)?", "cc|creative"),
    ("proprietary", r"(?:a |the )?(?:proprietary|commercial)", "proprietary|commercial"),
)

#: Way of stating, regex around NAME, gate, priority.
FORMS = (
    ("tag", r"spdx-license-identifier: ?\(*NAME\b", "spdx", 100),
    ("further", r"(?<=spdx-license-identifier: ?[a-z0-9.+() -]{1,120} (?:or|and|with) \(*)NAME\b", "spdx", 99),
    ("grant", r"licen[cs]ed (?:to you )?under (?:either )?(?:of )?(?:the )?(?:terms of )?(?:the )?NAME\b(?: licen[cs]e)?", "under", 90),
    ("choice", r"(?<=licen[cs]ed (?:to you )?under [^.;:]{1,80} (?:or|and) (?:the )?)NAME\b(?: licen[cs]e)?", "under", 89),
    ("release", r"(?:released|distributed|published|available|provided|shared) under (?:the )?(?:terms of )?(?:the )?NAME\b(?: licen[cs]e)?", "under", 85),
    ("field", r"\blicen[cs]e ?[:=] ?[\"']?NAME\b(?: licen[cs]e)?", "licen", 80),
    ("covered", r"(?:subject to|governed by|covered by|according to) (?:the )?(?:terms of )?(?:the )?NAME\b(?: licen[cs]e)?", " to | by ", 75),
    ("see", r"see (?:the )?NAME licen[cs]e", "see ", 70),
    ("name", r"\bNAME licen[cs]e\b", "licen", 60),
)

#: Signatures of full texts, notices and links: label, regex, gate, priority.
SINGLE = (
    ("all-rights-reserved", r"all rights reserved", "rights", 40),
    ("public-domain", r"(?:dedicated to|placed in(?:to)?|released (?:in)?to|in) the public domain", "public domain", 55),
    ("copyright", r"(?:copyright|\(c\)|©) (?:\(c\) |© )?(?:19|20)\d\d", "copyright|(c)|©", 20),
    ("no-warranty", r"without warranty of any kind|without warranties or conditions of any kind", "without warrant", 30),
    ("mit", r"permission is hereby granted, free of charge, to any person obtaining a copy", "hereby granted", 95),
    ("boost", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy", "hereby granted", 95),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", "this permission notice", 94),
    ("mit", r"opensource\.org/licenses?/mit", "opensource.org", 92),
    ("bsd", r"redistribution and use in source and binary forms", "redistribution and use", 95),
    ("bsd-3-clause", r"neither the name of [^.]{1,120} (?:nor|may) [^.]{0,120}be used to endorse or promote products", "endorse or promote", 96),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "advertising materials", 96),
    ("bsd-3-clause", r"opensource\.org/licenses?/bsd-3-clause", "opensource.org", 92),
    ("bsd-2-clause", r"opensource\.org/licenses?/bsd-2-clause", "opensource.org", 92),
    ("isc", r"permission to use, copy, modify, and/or distribute this software for any purpose", "permission to use", 95),
    ("isc", r"permission to use, copy, modify, and distribute this software for any purpose", "permission to use", 94),
    ("ntp", r"permission to use, copy, modify, and distribute this software and its documentation for any purpose", "permission to use", 95),
    ("apache-2.0", r"apache\.org/licenses/license-2\.0", "apache.org", 92),
    ("apache-2.0", r"you may not use this file except in compliance with the license", "except in compliance", 88),
    ("apache-1.1", r"this product includes software developed by the apache (?:software foundation|group)", "product includes", 90),
    ("gpl", r"gnu\.org/licenses/(?:old-licenses/)?gpl", "gnu.org", 92),
    ("lgpl", r"gnu\.org/licenses/(?:old-licenses/)?lgpl", "gnu.org", 92),
    ("agpl", r"gnu\.org/licenses/agpl", "gnu.org", 92),
    ("gpl", r"this program is free software[:;] you can redistribute it and/or modify", "free software", 90),
    ("lgpl", r"this library is free software[:;] you can redistribute it and/or modify", "free software", 91),
    ("gpl", r"you should have received a copy of the gnu general public license", "have received a copy", 91),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public license", "have received a copy", 91),
    ("agpl", r"you should have received a copy of the gnu affero general public license", "have received a copy", 91),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this license document", "verbatim copies", 80),
    ("gcc-exception", r"gcc runtime library exception", "runtime library exception", 93),
    ("classpath-exception", r"linking this library statically or dynamically with other modules", "statically or dynamically", 93),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license", "source code form", 96),
    ("mpl-2.0", r"mozilla\.org/(?:en-us/)?mpl/2\.0", "mozilla.org", 92),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1\.1", "contents of this file", 96),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution license", "contents of this file", 96),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public license", "accompanying materials", 96),
    ("epl", r"eclipse\.org/legal/epl", "eclipse.org", 92),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", 96),
    ("unlicense", r"unlicense\.org", "unlicense.org", 92),
    ("zlib", r"this software is provided ['\"‘’]as-is['\"‘’], without any express or implied warranty", "as-is", 95),
    ("zlib", r"the origin of this software must not be misrepresented", "misrepresented", 95),
    ("boost", r"boost\.org/license_1_0", "boost.org", 92),
    ("wtfpl", r"you just do what the f\w+ you want to", "you just do what", 95),
    ("beerware", r"the beer-ware license", "beer-ware", 95),
    ("json", r"the software shall be used for good, not evil", "not evil", 97),
    ("artistic", r"the intent of this document is to state the conditions under which a package may be copied", "intent of this document", 95),
    ("python-2.0", r"psf license agreement for python", "psf license agreement", 95),
    ("postgresql", r"in no event shall the university of california be liable to any party", "university of california", 95),
    ("openssl", r"this product includes software developed by the openssl project", "product includes", 95),
    ("php-3.01", r"this product includes php software", "product includes", 95),
    ("ofl-1.1", r"this font software is licensed under the sil open font license", "font software", 96),
    ("ms-pl", r"microsoft public license", "microsoft", 85),
    ("ms-rl", r"microsoft reciprocal license", "microsoft", 85),
    ("busl-1.1", r"business source license", "business source", 85),
    ("sspl-1.0", r"server side public license", "server side public", 85),
    ("elastic-2.0", r"elastic license (?:version )?2\.0", "elastic license", 85),
    ("cc0-1.0", r"the person who associated a work with this deed has dedicated the work to the public domain", "this deed", 96),
    ("cc", r"creativecommons\.org/(?:licenses|publicdomain)/[a-z-]+", "creativecommons.org", 92),
    ("cc", r"this work is licensed under a creative commons", "creative commons", 86),
    ("odbl", r"opendatacommons\.org/licenses/odbl", "opendatacommons", 92),
    ("proprietary", r"this software is (?:the )?(?:confidential|proprietary)(?: and (?:confidential|proprietary))?", "this software is", 90),
    ("proprietary", r"unauthorized (?:copying|use|reproduction)[^.]{0,80} strictly prohibited", "strictly prohibited", 88),
)


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    pattern: regex.Pattern
    gate: tuple[tuple[str, ...], ...]
    priority: int


def _gates(*texts: str) -> tuple[tuple[str, ...], ...]:
    """Of each tuple one word must occur."""
    return tuple(tuple(t.split("|")) for t in texts)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, in their fixed order: each form with each name, then the signatures without a name."""
    out: list[Rule] = []
    for _, form, gate, priority in FORMS:
        for label, name, word in NAMES:
            out.append(Rule(len(out), label, regex.compile(form.replace("NAME", f"(?:{name})")), _gates(gate, word), priority))
    for label, pattern, gate, priority in SINGLE:
        out.append(Rule(len(out), label, regex.compile(pattern), _gates(gate), priority))
    return tuple(out)


#: Comment marks that begin a line, with the white space around them.
COMMENT = re.compile(r"(?m)^[ \t]*(?:/\*+|\*+/?|//+!?|#+|--+|;+|%+|<!--|>+)[ \t]")

#: A-Z to a-z; what is no word character to a space; all else stays. Bytes of non-ASCII characters are word characters.
WORD_BYTES = bytes(i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else i + 32 if 0x41 <= i <= 0x5A else 0x20 for i in range(256))
LOWER = {i: i + 32 for i in range(0x41, 0x5B)}


@dataclass(frozen=True)
class Detection:
    start: int
    end: int
    label: str
    priority: int
    order: int


def normalised(text: str) -> tuple[str, str]:
    """The text in lower case with comment marks blanked, of the same length; and that with single spaces."""
    low = text.translate(LOWER)
    if "\n" in low:
        low = COMMENT.sub(lambda m: " " * len(m[0]), low)
    return low, " ".join(low.split())


def matches(line: str) -> list[Detection]:
    """What the rules find in a normalised text, a rule being tried only if its gates are in the text."""
    present: dict[str, bool] = {}

    def is_in(word: str) -> bool:
        if word not in present:
            present[word] = word in line
        return present[word]

    return [Detection(m.start(), m.end(), r.label, r.priority, r.order) for r in rules() if all(any(map(is_in, g)) for g in r.gate) for m in r.pattern.finditer(line)]


def unsuppressed(found: list[Detection]) -> list[Detection]:
    """Those that do not lie within one of a higher rank, by place.

    What lies within a suppressed detection also lies within the one that suppresses it, so any detection of a higher
    rank counts. A sweep by start keeps, in a tree over ranks, the furthest end of those that began so far.
    """
    ranked = sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.start, d.order))
    furthest = [-1] * (len(ranked) + 1)

    def add(rank: int, end: int) -> None:
        i = rank + 1
        while i < len(furthest):
            furthest[i] = max(furthest[i], end)
            i += i & -i

    def before(rank: int) -> int:
        i, out = rank, -1
        while i:
            out = max(out, furthest[i])
            i -= i & -i
        return out

    kept, by_start = [], sorted(range(len(ranked)), key=lambda r: ranked[r].start)
    at = 0
    while at < len(by_start):
        to = at
        while to < len(by_start) and ranked[by_start[to]].start == ranked[by_start[at]].start:
            add(by_start[to], ranked[by_start[to]].end)
            to += 1
        kept += [ranked[r] for r in by_start[at:to] if before(r) < ranked[r].end]
        at = to
    return sorted(kept, key=lambda d: (d.start, d.end, d.order))


def detect(text: str) -> list[Detection]:
    """Detections of the rules in a text, by place (code points of the text), without the suppressed ones."""
    low, line = normalised(text)
    found = unsuppressed(matches(line))
    if not found:
        return []
    # where each word begins in the text and in the line
    source = np.array([m.start() for m in re.finditer(r"\S+", low)])
    placed = [m.start() for m in re.finditer(r"\S+", line)]

    def back(i: int) -> int:
        w = bisect_left(placed, i + 1) - 1
        return int(source[w]) + i - placed[w]

    return [Detection(back(d.start), back(d.end - 1) + 1, d.label, d.priority, d.order) for d in found]


def base_places(text: str) -> tuple[int, list[tuple[int, str]]]:
    """(number of words, (word index, label) of every base phrase)."""
    words = text.encode("utf-8", "replace").translate(WORD_BYTES).split()
    places: list[tuple[int, str]] = []
    if b"license" in words:
        for phrase, label in BASE:
            parts = phrase.encode().split()
            n = len(parts)
            places += [(i - n + 1, label) for i, w in enumerate(words) if w == b"license" and i >= n - 1 and words[i - n + 1 : i + 1] == parts]
    return len(words), sorted(places)


def scan(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float, list[Detection]]:
    text = text or ""
    n_words, places = base_places(text)
    found = detect(text)
    base = sorted({label for _, label in places})
    labels = sorted({*base, *(d.label for d in found)})
    score = max([d.priority / 100 for d in found] + [0.6] * bool(base), default=0.0)
    return n_words, len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(base), ",".join(labels), score, found


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, words, places of base phrases, first and last of them, labels, score, detections.

    Null and empty texts have no words, no places (null first and last), empty labels and score 0.
    Repeated rows are each answered; other columns are not read.
    """

    def rows(ids: list, texts: list) -> list:
        found = [scan(t) for t in texts]
        return [ids, *[[f[k] for f in found] for k in range(7)], [[{"start": d.start, "end": d.end, "label": d.label} for d in f[7]] for f in found]]

    span = pa.struct([pa.field("start", pa.int64()), pa.field("end", pa.int64()), pa.field("label", pa.string())])
    fields = [pa.field("doc_id", _arrow_type(docs, id_col)), *(pa.field(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")), pa.field("base_labels", pa.string()), pa.field("labels", pa.string()), pa.field("score", pa.float64()), pa.field("detections", pa.list_(span))]
    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), rows, fields, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<start:bigint,end:bigint,label:string>>")
