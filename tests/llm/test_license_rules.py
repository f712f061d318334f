"""Every license rule against a plain-Python scan that uses neither gates nor anchors' lookups."""

import random
import re

from driftline.llm import license_scan as ls
from test_native import ALNUM_WORD, LOWER, frame


def brute_detections(text):
    """(rule, first, last, kept) of a text: every rule's regex at every place of its anchor, then suppression."""
    words = ALNUM_WORD.findall((text or "").translate(LOWER))
    found = set()
    for rule, anchor, keyword, regex, label, priority, weight in ls.signature_rules():
        for at, w in enumerate(words):
            lo, hi = max(0, at - ls.REACH), at + 1 + ls.REACH
            if w != anchor or keyword not in words[lo:at] + words[at + 1:hi]:
                continue
            ctx = " ".join(words[lo:at] + [f"<{anchor}>"] + words[at + 1:hi])
            m = re.search(regex, ctx)
            if m and m[0]:
                first = lo + ctx[:m.start()].count(" ")
                found.add((rule, label, priority, weight, first, first + m[0].count(" ") + 1))
    out = set()
    for r in found:
        inside = any((o[4], -o[5], o[2], o[0]) < (r[4], -r[5], r[2], r[0]) and o[2] <= r[2] and o[5] >= r[5] for o in found)
        out.add((*r, r[2] == 0 or not inside))
    return out


# A text for each hand-written signature: optional parts left out or taken, first alternatives, counted gaps filled.
def example(regex, rng):
    def walk(items):
        out = ""
        for op, arg in items:
            op = str(op)
            if op == "LITERAL":
                out += chr(arg)
            elif op == "IN":
                kind, v = arg[0]
                out += chr(v[0] if str(kind) == "RANGE" else v)
            elif op == "SUBPATTERN":
                out += walk(arg[-1])
            elif op == "BRANCH":
                out += walk(rng.choice(arg[1]))
            elif op == "ANY":
                out += "z"
            elif op == "MAX_REPEAT":
                lo, hi, inner = arg
                n = lo if hi - lo > 1 else rng.randint(lo, hi)
                out += "".join(walk(inner) for _ in range(n))
            else:
                raise AssertionError(op)
        return out
    return walk(re._parser.parse(regex)).strip()


def texts():
    rng = random.Random(8)
    out = []
    for anchor, keywords, regex, *_ in ls.SIGNATURES:
        for _ in range(3):
            body = example(regex, rng).replace("@", anchor)
            near = rng.choice(keywords.split())
            if near not in body.split():
                body = f"{near} {body}"
            out.append(f"{'x ' * rng.randint(0, 20)}{body}{' y' * rng.randint(0, 20)}")
    pool = list(out)
    out += [" ".join(rng.choice(pool) for _ in range(rng.randint(2, 6))) for _ in range(40)]
    out += ["SPDX-License-Identifier: Apache-2.0 OR MIT", "SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
            "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, to deal in the Software without restriction",
            "Redistribution and use in source and binary forms, with or without modification, are permitted", "", None, "license " * 40, "mit " * 30, "gpl 2 " * 20]
    return list(enumerate(out))


def test_all_rules_equal_a_plain_scan(spark):
    pairs = texts()
    got = {}
    for r in ls.detections(frame(spark, pairs)).collect():
        got.setdefault(r.doc_id, set()).add((r.rule, r.label, r.priority, r.weight, r["first"], r["last"], r.kept))
    want = {i: brute_detections(t) for i, t in pairs}
    for i, t in pairs:
        assert got.get(i, set()) == want[i], t
    whole = {r.doc_id: r for r in ls.scan_licenses(frame(spark, pairs)).collect()}
    for i, t in pairs:
        kept = [d for d in want[i] if d[-1]]
        assert whole[i].labels == ",".join(sorted({d[1] for d in kept})) and whole[i].score == max((d[3] for d in kept), default=0.0)


def test_every_signature_fires():
    rules = {(a, k, label) for _, a, k, _, label, *_ in ls.signature_rules()}
    fired = set()
    for _, t in texts():
        fired |= {d[1] for d in brute_detections(t)}
    assert {label for *_, label, _, _ in ls.SIGNATURES} <= fired and len(rules) > 500


def test_gate_lets_every_anchor_pass():
    anchors = sorted({a for _, a, *_ in ls.signature_rules()})
    gate = re.compile(r"(?<![a-z0-9])" + ls.any_of(anchors))
    assert all(gate.search(f"some {a} text") and gate.match(a) for a in anchors)
    assert not gate.search("xyzzy plugh unlicensable") and re.fullmatch(ls.any_of(["a", "ab", "b"]), "b")
