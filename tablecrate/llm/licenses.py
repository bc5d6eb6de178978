"""License scans: ordered signature rules behind a keyword prefilter.

A text is lower-cased (A-Z), cut into words of digits, letters and non-ASCII characters, and
joined by single spaces. A rule (a regular expression over that form, with a label and a
priority) is only tried where all its keywords stand among the words, and its version with or
without a "v" before. Detections are then
taken by priority, longer ones first; one that lies inside a detection already taken is
dropped. The three base phrases are reported whatever covers them.

Null text counts as empty: no words, no detections, score 0. Repeated rows give equal
results; overlapping detections of equal rank resolve by start, then label.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tablecrate.llm.arrow import with_computed

# The phrases whose places are all counted.
BASE = {b"mit license": "mit", b"apache license": "apache", b"general public license": "gpl"}

# Label stem, names in words, versions ("" for none).
LICENSES = (
    ("mit", ("mit", "expat"), ("",)),
    ("apache", ("apache", "apache software"), ("1 0", "1 1", "2 0", "2", "")),
    ("gpl", ("gnu general public", "general public", "gnu gpl", "gpl"), ("1", "2", "3", "2 0", "3 0", "")),
    ("lgpl", ("gnu lesser general public", "lesser general public", "gnu library general public", "lgpl"), ("2", "2 1", "3", "3 0", "")),
    ("agpl", ("gnu affero general public", "affero general public", "agpl"), ("3", "3 0", "")),
    ("gfdl", ("gnu free documentation", "gfdl"), ("1 1", "1 2", "1 3", "")),
    ("bsd", ("bsd", "berkeley software distribution", "revised bsd", "new bsd", "simplified bsd"), ("",)),
    ("mpl", ("mozilla public", "mpl"), ("1 0", "1 1", "2 0", "")),
    ("epl", ("eclipse public", "epl"), ("1 0", "2 0", "")),
    ("cddl", ("common development and distribution", "cddl"), ("1 0", "1 1", "")),
    ("cpl", ("common public",), ("1 0", "")),
    ("eupl", ("european union public", "eupl"), ("1 1", "1 2", "")),
    ("artistic", ("artistic", "perl artistic"), ("1 0", "2 0", "")),
    ("bsl", ("boost software",), ("1 0", "")),
    ("isc", ("isc", "internet systems consortium"), ("",)),
    ("zlib", ("zlib", "zlib libpng"), ("",)),
    ("unlicense", ("unlicense",), ("",)),
    ("wtfpl", ("wtfpl", "do what the fuck you want to public"), ("2", "")),
    ("psf", ("python software foundation", "psf"), ("2", "")),
    ("php", ("php",), ("3 0", "3 01", "")),
    ("ruby", ("ruby",), ("",)),
    ("openssl", ("openssl",), ("",)),
    ("ofl", ("sil open font", "open font", "ofl"), ("1 0", "1 1", "")),
    ("ms-pl", ("microsoft public", "ms pl"), ("",)),
    ("ms-rl", ("microsoft reciprocal", "ms rl"), ("",)),
    ("afl", ("academic free", "afl"), ("2 1", "3 0", "")),
    ("osl", ("open software", "osl"), ("2 1", "3 0", "")),
    ("ncsa", ("university of illinois ncsa open source", "ncsa"), ("",)),
    ("upl", ("universal permissive",), ("1 0", "")),
    ("qpl", ("q public",), ("1 0", "")),
    ("cecill", ("cecill",), ("1", "2", "2 1", "")),
    ("wxwindows", ("wxwindows library",), ("3 1", "")),
    ("vim", ("vim",), ("",)),
    ("tcl", ("tcl tk", "tcl"), ("",)),
    ("w3c", ("w3c software", "w3c"), ("",)),
    ("x11", ("x11", "x consortium"), ("",)),
    ("postgresql", ("postgresql",), ("",)),
    ("bittorrent", ("bittorrent open source",), ("1 0", "1 1", "")),
    ("sleepycat", ("sleepycat",), ("",)),
    ("odbl", ("open database", "odbl"), ("1 0", "")),
    ("elastic", ("elastic",), ("2 0", "")),
    ("sspl", ("server side public", "sspl"), ("1", "")),
    ("busl", ("business source", "busl"), ("1 1", "")),
    ("cc-by", ("creative commons attribution",), ("2 0", "2 5", "3 0", "4 0", "")),
    ("cc-by-sa", ("creative commons attribution sharealike", "creative commons attribution share alike"), ("2 0", "2 5", "3 0", "4 0", "")),
    ("cc-by-nc", ("creative commons attribution noncommercial", "creative commons attribution non commercial"), ("2 0", "3 0", "4 0", "")),
    ("cc-by-nd", ("creative commons attribution noderivs", "creative commons attribution noderivatives", "creative commons attribution no derivatives"), ("3 0", "4 0", "")),
    ("cc0", ("creative commons zero", "cc0"), ("1 0", "")),
)

# How a name is met, with its priority and weight. {n} is a name, {v} a version.
PHRASES = (
    ("notice", r"(?:re)?(?:licensed|released|distributed|available|covered) under (?:the )?(?:terms of )?(?:the )?{n}(?: public)?(?: licen[cs]e)?{v}", 40, 0.95),
    ("subject", r"(?:subject to|governed by|see) the (?:terms of the )?{n} licen[cs]e{v}", 35, 0.9),
    ("named", r"{n} licen[cs]e{v}", 20, 0.7),
    ("spdx", r"spdx license identifier {n}{v}", 60, 1.0),
)

# Sentences of license texts: label, words, priority, weight.
TEXTS = (
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy", 50, 1.0),
    ("mit-text", "the above copyright notice and this permission notice shall be included in all copies", 50, 0.9),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted", 50, 1.0),
    ("bsd-3-clause", "neither the name of .{1,80}? nor the names of its contributors may be used to endorse", 55, 1.0),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee", 50, 1.0),
    ("apache-2.0", "you may not use this file except in compliance with the license", 45, 0.8),
    ("apache-2.0", "www apache org licenses license 2 0", 60, 1.0),
    ("apache-1.1", "this product includes software developed by the apache software foundation", 50, 0.9),
    ("gpl-text", "this program is free software you can redistribute it and or modify it under the terms", 50, 0.95),
    ("gpl-text", "free software foundation either version [123] of the license or at your option any later version", 50, 0.95),
    ("gpl-or-later", "either version (?:1|2|3) of the license or at your option any later version", 48, 0.9),
    ("lgpl-text", "this library is free software you can redistribute it and or modify it under the terms", 50, 0.95),
    ("gpl-url", "www gnu org (?:licenses|copyleft) gpl", 60, 0.95),
    ("lgpl-url", "www gnu org (?:licenses|copyleft) (?:lgpl|lesser)", 60, 0.95),
    ("agpl-url", "www gnu org licenses agpl", 60, 0.95),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license", 60, 1.0),
    ("mpl-url", "mozilla org mpl 2 0", 60, 1.0),
    ("epl-1.0", "www eclipse org legal epl v10", 60, 1.0),
    ("epl-2.0", "www eclipse org legal epl (?:v20|2 0)", 60, 1.0),
    ("zlib-text", "this software is provided as is without any express or implied warranty in no event will the authors", 50, 0.95),
    ("unlicense-text", "this is free and unencumbered software released into the public domain", 60, 1.0),
    ("public-domain", "(?:placed|released|dedicated) (?:in|into|to) the public domain", 30, 0.7),
    ("cc-url", "creativecommons org licenses by(?: nc)?(?: nd| sa)? [1234] 0", 60, 1.0),
    ("cc0-url", "creativecommons org publicdomain zero 1 0", 60, 1.0),
    ("bsl-text", "permission is hereby granted free of charge to any person or organization obtaining a copy", 55, 1.0),
    ("ofl-text", "this font software is licensed under the sil open font license", 60, 1.0),
    ("proprietary", "all rights reserved", 5, 0.3),
    ("proprietary", "unauthorized (?:copying|use|reproduction|distribution) .{0,60}?(?:is )?(?:strictly )?prohibited", 15, 0.6),
    ("proprietary", "proprietary and confidential", 10, 0.6),
    ("opensource-url", "opensource org licenses", 30, 0.6),
)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    keywords: frozenset[bytes]
    priority: int
    weight: float
    either: frozenset[bytes] = frozenset()  # the first word of a version: one of these


def _keywords(words: str) -> frozenset[bytes]:
    """The words that every match must hold; `*` stands for any."""
    return frozenset(w.encode() for w in words.split() if w != "*")


def _rule(label: str, pattern: str, keywords: str, priority: int, weight: float, either: str = "") -> Rule:
    compiled = re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode())
    return Rule(label, compiled, _keywords(keywords), priority, weight, _keywords(either))


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules: every license name in every phrase and version, then the sentences. A
    longer version outranks a shorter one, and any version none."""
    made = []
    for stem, names, versions in LICENSES:
        for version in versions:
            tail = rf",?(?: version| v)? v?{version}" if version else ""
            first, *rest = version.split() or [""]
            label = f"{stem}-{version.replace(' ', '.')}" if version else stem
            for kind, phrase, priority, weight in PHRASES:
                for name in names:
                    spdx = name.startswith("creative commons")
                    if kind == "spdx" and (spdx or name != names[0]):
                        continue
                    said = stem.replace("-", " ") if kind == "spdx" else name
                    held = "spdx" if kind == "spdx" else ""
                    made.append(
                        _rule(
                            label,
                            phrase.format(n=said, v=tail.replace(",?", "")),
                            f"{said} {' '.join(rest)} {held}",
                            priority + len(version.split()),
                            weight,
                            f"{first} v{first}" if first else "",
                        )
                    )
    optional = re.compile(r"\(.*?\)\??|\[.*?\]|\.\{.*?\}\??")
    made += [_rule(label, text, optional.sub(" * ", text), p, w) for label, text, p, w in TEXTS]
    return tuple(made)


@lru_cache(maxsize=1)
def _by_keyword() -> dict[bytes, list[Rule]]:
    """Each rule under its longest keyword, which is the rarest as a rule."""
    found = defaultdict(list)
    for rule in rules():
        found[max(rule.keywords, key=lambda w: (len(w), w))].append(rule)
    return dict(found)


# Bytes of words stay (A-Z in lower case); any other ASCII becomes a space.
_TABLE = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)
_BASE = re.compile(b"(?<![^ ])(?:" + b"|".join(BASE) + b")(?![^ ])")


def uncovered(found: Iterable[tuple[int, int, str, int, float]]) -> list[tuple[int, int, str, int, float]]:
    """(start, end, label, priority, weight): those not inside one of a higher rank."""
    taken, starts, ends = [], [], []  # starts and ends rise: intervals inside others are not kept
    for one in sorted(found, key=lambda d: (-d[3], d[0] - d[1], d[0], d[2])):
        start, end = one[:2]
        at = bisect_right(starts, start)
        if at and ends[at - 1] >= end:
            continue
        taken.append(one)
        first = at - 1 if at and starts[at - 1] == start else at
        last = bisect_right(ends, end)
        starts[first : max(first, last)], ends[first : max(first, last)] = [start], [end]
    return sorted(taken)


def scan(text: str | None) -> dict:
    """The words, base places and detections of one text; places are word numbers from 0."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
    present = set(words)
    keyed = _by_keyword()
    tried = [
        rule
        for word in present & keyed.keys()
        for rule in keyed[word]
        if rule.keywords <= present and (not rule.either or not rule.either.isdisjoint(present))
    ]
    out = {"n_words": len(words), "base": [], "found": []}
    if not tried and not present & {b"license"}:
        return out
    joined = b" ".join(words)
    ends, at = [], 0
    for word in words:
        at += len(word) + 1
        ends.append(at)
    place = lambda offset: bisect_right(ends, offset)
    out["base"] = [(place(m.start()), BASE[m.group()]) for m in _BASE.finditer(joined)]
    out["found"] = uncovered(
        (place(m.start()), place(m.end() - 1), rule.label, rule.priority, rule.weight)
        for rule in tried
        for m in rule.pattern.finditer(joined)
    )
    return out


SCHEMA = (
    "n_words long, base array<struct<word:long,label:string>>,"
    " found array<struct<first_word:long,last_word:long,label:string,priority:int,weight:double>>"
)


def license_scan(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`df` with `n_words`, the places of the base phrases, and the detections that stay."""
    base = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    found = pa.list_(
        pa.struct(
            [("first_word", pa.int64()), ("last_word", pa.int64()), ("label", pa.string()),
             ("priority", pa.int32()), ("weight", pa.float64())]
        )
    )

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = [scan(t) for t in batch.column(text).to_pylist()]
        as_dicts = lambda key, kind: pa.array(
            [[dict(zip(kind.value_type.names, one)) for one in r[key]] for r in rows], kind
        )
        return {
            "n_words": pa.array([r["n_words"] for r in rows], pa.int64()),
            "base": as_dicts("base", base),
            "found": as_dicts("found", found),
        }

    return with_computed(df, compute, SCHEMA, keep)
