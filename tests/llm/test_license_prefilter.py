"""detect() against all rules run without prefilter and gates."""

import random
import re

import pytest

from matchloom.llm import licenses


def slow(found):
    """Suppression by comparing each detection with each kept one."""
    kept = []
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.start, d.order)):
        if not any(k.start <= d.start and d.end <= k.end for k in kept):
            kept.append(d)
    return sorted(kept, key=lambda d: (d.start, d.end, d.order))


def ungated(text):
    line = licenses.normalised(text)[1]
    return [(d.label, d.end - d.start) for d in slow([licenses.Detection(m.start(), m.end(), r.label, r.priority, r.order) for r in licenses.rules() for m in r.pattern.finditer(line)])]


def gated(text):
    """The detections of detect(), measured in the normalised text."""
    out = []
    for d in licenses.detect(text):
        part = " ".join(licenses.normalised(text)[0][d.start : d.end].split())
        out.append((d.label, len(part)))
    return out


@pytest.mark.parametrize("text", ["distributed under\nthe GPL v3", "all rights\nreserved", "placed in the public\ndomain", "under the Creative Commons Zero license", "License: Creative Commons Zero 1.0", "governed\tby the MIT License"])
def test_line_breaks_and_cc0(text):
    assert gated(text) == ungated(text) != []


def test_random_forms():
    r = random.Random(5)
    names = [n for n in ("MIT", "GNU GPL v3", "Apache 2.0", "CC0", "Creative Commons Zero", "CC BY-SA 4.0", "Mozilla Public", "the Unlicense", "Boost Software", "WTFPL", "PSF", "ODbL", "proprietary", "Open Database", "LGPL 2.1")]
    forms = ["SPDX-License-Identifier: {}", "licensed under the terms of the {}", "released under {}", "license: {}", "subject to the {}", "see the {} license", "{} license", "copyright 2020 {}", "all rights reserved {}", "in the public domain {}"]
    for _ in range(300):
        text = " and ".join(r.choice(forms).format(r.choice(names)) for _ in range(2))
        text = "".join(r.choice(" \n\t") if c == " " else c for c in text)
        assert gated(text) == ungated(text), text


def test_each_gate_is_in_its_name():
    """Whatever an alternative of a name matches holds one of the name's gates."""
    for label, text in (("cc0-1.0", "creative commons zero"), ("cc0-1.0", "cc zero"), ("cc0-1.0", "cc0"), ("gpl-3.0", "gnu gpl-3.0"), ("boost", "bsl-1.0"), ("python-2.0", "psf")):
        gates = [g for n, _, g in licenses.NAMES if n == label]
        assert all(any(x in text for x in g.split("|")) for g in gates)


@pytest.mark.parametrize(
    "text, labels",
    [
        ("SPDX-License-Identifier: Apache-2.0", {"apache-2.0"}),
        ("SPDX-License-Identifier: GPL-3.0-or-later", {"gpl-3.0"}),
        ("SPDX-License-Identifier: MPL-2.0", {"mpl-2.0"}),
        ("SPDX-License-Identifier: AGPL-3.0-only", {"agpl-3.0"}),
        ("SPDX-License-Identifier: LGPL-2.1-or-later", {"lgpl-2.1"}),
        ("SPDX-License-Identifier: MIT OR Apache-2.0", {"mit", "apache-2.0"}),
        ("SPDX-License-Identifier: (MIT AND BSD-3-Clause)", {"mit", "bsd-3-clause"}),
        ("Licensed under either of the Apache License, Version 2.0 or the MIT license", {"apache-2.0", "mit"}),
        ("Released\nunder\nthe MIT terms", {"mit"}),
        ("# Permission is hereby granted, free of\n# charge, to any person obtaining a copy", {"mit"}),
        ("/*\n * Redistribution and use in source\n * and binary forms\n */", {"bsd"}),
        ("// This program is free software: you can\n// redistribute it and/or modify it", {"gpl"}),
        ("a sentence about ruby and php and the commercial world", set()),
    ],
)
def test_forms(text, labels):
    assert {d.label for d in licenses.detect(text)} == labels


def test_suppression_against_brute_force():
    r = random.Random(8)
    for _ in range(300):
        found = [licenses.Detection(a, a + r.randint(1, 12), "x", r.randint(1, 4) * 10, k) for k in range(r.randint(0, 40)) for a in [r.randint(0, 30)]]
        assert licenses.unsuppressed(found) == slow(found)
    many = " ".join(["licensed under the mit license"] * 20_000)
    assert len(licenses.detect(many)) == 20_000


def test_places_are_those_of_the_text():
    text = "x\n  # licensed   under\n  #\tthe  MIT License."
    (d,) = licenses.detect(text)
    assert text[d.start : d.end].startswith("licensed   under") and text[d.start : d.end].endswith("MIT License")
