"""Licence texts with the optional parts of their signatures, and wrapped as they stand in files."""

from __future__ import annotations

import re
from itertools import product

from martlet.llm import license_rules


def variants(parsed):
    """Texts that a parsed regular expression matches: each alternative, and each optional part absent and once."""
    out = [""]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            more = [chr(value)]
        elif name == "IN":
            literals = [chr(v) for k, v in value if str(k) == "LITERAL"] + [chr(v[0]) for k, v in value if str(k) == "RANGE"]
            more = literals or ([" "] if "SPACE" in str(value) and "NOT" not in str(value) else ["x"])
        elif name == "ANY":
            more = ["x"]
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = value
            more = [x * n for n in {least, max(least, min(1, most))} for x in (variants(inner) if n else [""])]
        elif name == "BRANCH":
            more = [x for v in value[1] for x in variants(v)]
        elif name == "SUBPATTERN":
            more = variants(value[3])
        else:  # borders and looking ahead
            more = [""]
        out = [a + b for a, b in product(out, more)]
    return out


def test_optional_parts_pass_the_gates():
    for _, label, _, _, keyword, pattern in license_rules.build_signatures():
        for text in variants(re._parser.parse(pattern)):
            # optional parts may leave two spaces, or a border where none is
            text = re.sub(" +", " ", text)
            if m := re.search(pattern, text):
                enclosed = f" {m[0]} "
                assert keyword in enclosed and re.search(license_rules.GATE_PATTERN, enclosed), (label, text)


def labels(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: (set(r.labels.split(",")), r.n_detections, r.score) for r in license_rules.scan(docs).collect()}


def test_usual_wordings(spark):
    got = labels(spark, "It may not be reproduced without prior written permission.", "Weights under Open RAIL-M.", "no permit")
    assert got == {0: ({"proprietary"}, 1, 0.5), 1: ({"openrail"}, 1, 0.9), 2: ({""}, 0, 0.0)}


NOTICES = {
    "bsd-3-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    "gpl-2.0": "either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": "either version 3 of the License, or (at your option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "isc": "Permission to use, copy, modify, and distribute this software for any purpose",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "all-rights-reserved": "All rights reserved",
    "cc-by-sa": "CC BY SA 4.0",
}


def test_wrapped_notices(spark):
    breaks = [" ", "\n", "\r\n    ", "  ", "\u00a0", "\t\u2028"]
    texts = [notice.replace(" ", b) for notice in NOTICES.values() for b in breaks]
    # wrapped at one place after the other
    texts += [" ".join(w[:i]) + "\n  " + " ".join(w[i:]) for w in map(str.split, NOTICES.values()) for i in range(1, len(w))]
    wanted = [label for label in NOTICES for _ in breaks] + [label for label, n in NOTICES.items() for _ in n.split()[1:]]
    got = labels(spark, *texts)
    plain = {label: got[i * len(breaks)] for i, label in enumerate(NOTICES)}
    for i, label in enumerate(wanted):
        found, n, score = got[i]
        assert label in found and (n, score) == plain[label][1:], (texts[i], got[i], plain[label])


def test_patterns_agree_on_any_and_on_folded_texts():
    for _, label, _, _, _, pattern in license_rules.build_signatures():
        one = license_rules._on_folded(pattern)
        for text in variants(re._parser.parse(pattern))[:500]:
            text = re.sub(" +", " ", text)
            wide = text.replace(" ", "\n  ")
            # the other way round needs folded texts: on others the parts of a run may match different spaces
            assert len(re.findall(one, text)) <= len(re.findall(pattern, wide)), (label, text)
