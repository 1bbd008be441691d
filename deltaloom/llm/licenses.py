"""License detection by ordered signature rules.

A text is reduced to its lower-case words joined by single spaces. Rules are regular expressions over that form, made from the names and
short names of each license, the notices that introduce them, and sentences of the licenses themselves. A rule is tried only if its two
keywords occur in the text; they are derived from the pattern, so no match is without them. Detections carry the
priority of their notice; a detection whose interval lies within that of a better one (lower priority number, or the same priority and
longer, or equal and earlier in rule order) is suppressed, and so is never reported on its own.

The three base phrases are counted at all their places whether or not a longer detection covers them.

Defined results: null and empty texts have no words, no labels and score 0. Each input row gives one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from deltaloom.llm.text import PLAIN, octets

#: Base phrases and their labels (fixed values).
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Words after which a text names its license outright, with what may stand between.
_OF = r"(?:the )?(?:terms (?:and conditions )?of )?(?:an? |the |either (?:the )?)?(?:VERSION of the )?"
_LICENSED = r"(?:is |are |be )?(?:dual )?(?:re)?licensed under " + _OF
_RELEASED = r"(?:is |are |be )?(?:released|distributed|published|provided|offered|available|redistribute it|modify it) under " + _OF
_LICENSE = r"licen[cs]es?"

#: label: (names that need a notice, names that stand alone, names that stand alone with a version), alternatives divided by |
FAMILIES: dict[str, tuple[str, str, str]] = {
    "mit": ("mit|expat", "", ""),
    "apache": ("apache(?: software)?", "apache org licenses license", "apache|asl"),
    "gpl": ("(?:gnu )?general public", "gpl|gnu org licenses gpl", ""),
    "lgpl": ("(?:gnu )?lesser general public|(?:gnu )?library general public", "lgpl|gnu org licenses lgpl", ""),
    "agpl": ("(?:gnu )?affero general public", "agpl|gnu org licenses agpl", ""),
    "gfdl": ("(?:gnu )?free documentation", "gfdl|gnu org licenses fdl", "fdl"),
    "bsd": ("(?:new |modified |simplified |revised |original )?(?:[0-4] clause )?bsd(?: [0-4] clause)?", "bsd [0-4] clause|[0-4] clause bsd|0bsd", ""),
    "mpl": ("mozilla public", "", "mpl"),
    "epl": ("eclipse public", "", "epl"),
    "edl": ("eclipse distribution", "", "edl"),
    "cpl": ("common public", "", "cpl"),
    "cddl": ("common development and distribution", "cddl", ""),
    "isc": ("isc", "", ""),
    "zlib": ("zlib(?: libpng)?", "", ""),
    "bsl": ("boost software|boost", "", ""),
    "artistic": ("artistic", "", ""),
    "wtfpl": ("do what the [a-z]+ you want to public", "wtfpl", ""),
    "unlicense": ("unlicense", "the unlicense|unlicense org", ""),
    "psf": ("python software foundation|psf", "", ""),
    "php": ("php", "", ""),
    "ruby": ("ruby", "", ""),
    "openssl": ("openssl", "", ""),
    "postgresql": ("postgresql", "", ""),
    "eupl": ("european union public", "eupl", ""),
    "ecl": ("educational community", "", "ecl"),
    "afl": ("academic free", "", "afl"),
    "osl": ("open software", "", "osl"),
    "ofl": ("(?:sil )?open font", "sil ofl", "ofl"),
    "odbl": ("open database", "odbl", ""),
    "odc-by": ("open data commons attribution", "odc by", ""),
    "cc-by": ("(?:creative commons|cc) attribution(?! (?:non|share|no|sa|nc|nd))", "cc by(?! (?:nc|sa|nd))|creativecommons org licenses by(?! (?:nc|sa|nd))", ""),
    "cc-by-sa": ("(?:creative commons|cc) attribution share ?alike", "cc by sa|creativecommons org licenses by sa", ""),
    "cc-by-nc": ("(?:creative commons|cc) attribution non ?commercial(?! (?:share|no))", "cc by nc(?! (?:sa|nd))|creativecommons org licenses by nc(?! (?:sa|nd))", ""),
    "cc-by-nc-sa": ("(?:creative commons|cc) attribution non ?commercial share ?alike", "cc by nc sa|creativecommons org licenses by nc sa", ""),
    "cc-by-nc-nd": ("(?:creative commons|cc) attribution non ?commercial no ?deriv(?:ative)?s(?: works)?", "cc by nc nd|creativecommons org licenses by nc nd", ""),
    "cc-by-nd": ("(?:creative commons|cc) attribution no ?deriv(?:ative)?s(?: works)?", "cc by nd|creativecommons org licenses by nd", ""),
    "cc0": ("creative commons zero", "cc0|creativecommons org publicdomain zero", ""),
    "ms-pl": ("microsoft public", "ms pl", ""),
    "ms-rl": ("microsoft reciprocal", "ms rl", ""),
    "cecill": ("cecill(?: [bc])?", "cecill(?: [bc])?", ""),
    "upl": ("universal permissive", "", "upl"),
    "ncsa": ("(?:university of illinois )?ncsa(?: open source)?", "", ""),
    "mulan": ("mulan permissive software", "mulan ?psl", ""),
    "w3c": ("w3c(?: software)?", "", ""),
    "x11": ("x11", "", ""),
    "busl": ("business source", "", "busl"),
    "sspl": ("server side public", "sspl", ""),
    "elastic": ("elastic", "elv2", ""),
}

#: Identifiers that do not begin with the label.
IDS = {
    "bsd": "bsd [0-4] clause|bsd|0bsd", "psf": "psf|python", "mulan": "mulanpsl", "cecill": "cecill(?: [bc])?",
    "cc-by": "cc by(?! (?:nc|sa|nd))", "cc-by-nc": "cc by nc(?! (?:sa|nd))",
}

_NAMED = rf"NAME(?: VERSION)?FILL {_LICENSE}(?: VERSION)?"

#: notice: (priority, confidence, kinds of names, pattern; NAME, VERSION, FILL and ID are filled in). A group is what counts, if there is one.
NOTICES: dict[str, tuple[int, float, str, str]] = {
    "identifier": (0, 1.0, "id", r"spdx license identifier ID(?: VERSION)?(?: only| or later)?"),
    "operand": (0, 1.0, "id", r"spdx license identifier (?:[a-z0-9]+ ){1,6}?(?:or|and) (ID(?: VERSION)?(?: only| or later)?)"),
    "grant": (1, 1.0, "names alone", rf"{_LICENSED}NAME(?:FILL {_LICENSE})? ?VERSION(?:FILL {_LICENSE})?"),
    "grant_any": (2, 0.9, "names alone", rf"{_LICENSED}NAME(?:FILL {_LICENSE})?"),
    "grant_other": (2, 0.9, "names alone", rf"licensed under (?:[a-z0-9]+ ){{1,6}}?(?:or|and) (?:the )?(NAME(?: ?VERSION)?(?:FILL {_LICENSE})?)"),
    "release": (2, 0.9, "names", rf"{_RELEASED}{_NAMED}"),
    "release_short": (2, 0.9, "alone versioned", rf"{_RELEASED}NAMEV(?:FILL {_LICENSE})?"),
    "subject": (3, 0.8, "names", rf"subject to {_OF}{_NAMED}"),
    "copy": (3, 0.8, "names", rf"(?:you should have received |see |obtain )?a copy of (?:the )?{_NAMED}"),
    "versioned": (4, 0.8, "names", rf"NAME {_LICENSE},? VERSION|NAME VERSIONFILL {_LICENSE}"),
    "link": (4, 0.8, "id", r"(?:opensource org|spdx org) licen[cs]es? ID(?: VERSION)?"),
    "named": (5, 0.6, "names", rf"NAMEFILL {_LICENSE}"),
    "short": (5, 0.6, "alone versioned", rf"NAMEV(?:FILL {_LICENSE})?"),
}

#: Sentences of the licenses themselves.
BODIES: dict[str, tuple[str, ...]] = {
    "mit": (r"permission is hereby granted free of charge to any person obtaining a copy",),
    "apache": (r"you may not use this (?:file|work|software) except in compliance with the license",),
    "gpl": (r"under the terms of the gnu general public license", r"gnu general public license as published by the free software foundation"),
    "lgpl": (r"under the terms of the gnu (?:lesser|library) general public license",),
    "agpl": (r"under the terms of the gnu affero general public license",),
    "gfdl": (r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license",),
    "bsd": (r"redistribution and use in source and binary forms with or without modification",),
    "mpl": (r"this source code form is subject to the terms of the mozilla public license",),
    "isc": (r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee",),
    "zlib": (r"this software is provided as is without any express or implied warranty in no event will the authors be held liable",),
    "bsl": (r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation",),
    "wtfpl": (r"you just do what the [a-z]+ you want to",),
    "unlicense": (r"this is free and unencumbered software released into the public domain",),
    "postgresql": (r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement",),
    "php": (r"subject to version [0-9] [0-9]+ of the php license",),
    "cddl": (r"subject to the terms of the common development and distribution license",),
}

_VERSION = r"(?:(?:version|ver|v) ?)?[0-9]{1,2}(?: [0-9]{1,2}){0,2}"


def needed(pattern: str) -> str:
    """The longest literal that stands in every match of a pattern without alternatives outside its groups."""
    pattern = re.sub(r"\[[^\]]*\](?:\{[^}]*\}|[?*+])?", "\0", pattern)
    while (less := re.sub(r"\([^()]*\)(?:\{[^}]*\}|[?*+])?\??", "\0", pattern)) != pattern:
        pattern = less
    if "|" in pattern:
        raise ValueError(f"alternatives outside groups: {pattern}")
    return max(re.split("\0+", re.sub(r".\?", "\0", pattern)), key=len)


def _split(names: str) -> list[str]:
    """Alternatives outside groups."""
    out, depth = [""], 0
    for c in names:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return [n for n in out if n]


def rules() -> list[tuple[str, str, int, float, tuple[bytes, bytes], bytes]]:
    """All rules in order: label, notice, priority, confidence, keywords, pattern. Every match of a pattern holds both keywords."""
    made = []
    for notice, (priority, confidence, kinds, shapes) in NOTICES.items():
        for label, (names, alone, versioned) in FAMILIES.items():
            own = {"id": IDS.get(label, label.replace("-", " ")), "names": names, "alone": alone, "versioned": versioned}
            fill = r"(?: (?!or |and |licen)[a-z]+){0,3}" if label.startswith("cc") else r"(?: (?:public|software|open source|style))?"
            for kind in kinds.split():
                for name in _split(own[kind]):
                    for shape in _split(shapes):
                        told = "NAME ?VERSION" if kind == "versioned" else "NAME(?: ?VERSION)?"
                        pattern = shape.replace("NAMEV", told).replace("VERSION", _VERSION).replace("FILL", fill).replace("ID", "NAME")
                        made.append((label, notice, priority, confidence, (needed(pattern.replace("NAME", "()")), needed(name)), pattern.replace("NAME", name)))
    made += [(label, "body", 4, 0.8, (needed(body), needed(body)), body) for label, bodies in BODIES.items() for body in bodies]
    return [(label, notice, priority, confidence, (a.encode(), b.encode()), f"(?<= )(?:{pattern})(?= )".encode()) for label, notice, priority, confidence, (a, b), pattern in made]


@lru_cache(maxsize=1)
def _compiled():
    ordered = [(k, label, priority, confidence, need, re.compile(pattern)) for k, (label, _, priority, confidence, need, pattern) in enumerate(rules())]
    base = [(label, re.compile(f"(?<= ){phrase}(?= )".encode())) for phrase, label in BASE.items()]
    gates = sorted({max((need[0] or need[1]).split(), key=len) for _, _, _, _, need, _ in ordered})
    return ordered, base, gates


def suppress(found: list[tuple[int, int, int, int]]) -> list[int]:
    """Positions in ``found`` (start, end, priority, rule order) that no better detection contains.

    Best first, with the largest end seen for every start kept in a binary indexed tree: O(n log n) for any number of detections.
    """
    order = sorted(range(len(found)), key=lambda i: (found[i][2], found[i][0] - found[i][1], found[i][3], found[i][0]))
    starts = sorted({f[0] for f in found})
    rank = {s: i + 1 for i, s in enumerate(starts)}
    tree = [-1] * (len(starts) + 1)
    kept = []
    for i in order:
        start, end = found[i][:2]
        at, furthest = rank[start], -1
        while at > 0:
            furthest = max(furthest, tree[at])
            at -= at & -at
        if furthest >= end:
            continue
        kept.append(i)
        at = rank[start]
        while at < len(tree):
            tree[at] = max(tree[at], end)
            at += at & -at
    return sorted(kept)


def detect(raw: bytes) -> dict:
    """Detections of one text."""
    ordered, base, gates = _compiled()
    plain = raw.translate(PLAIN)
    inside = np.frombuffer(plain, np.uint8) != 0x20
    n_words = int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())
    out = {"n_words": n_words, "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "detections": []}
    if not any(g in plain for g in gates):
        return out
    text = b" " + re.sub(rb" +", b" ", plain).strip() + b" "
    first, last, labels = None, None, set()
    for label, pattern in base:
        places = [m.start() for m in pattern.finditer(text)]
        if places:
            labels.add(label)
            out["n_base"] += len(places)
            first = min(places[0], places[0] if first is None else first)
            last = max(places[-1], places[-1] if last is None else last)
    if first is not None:
        out["first_word"], out["last_word"] = text.count(b" ", 0, first) - 1, text.count(b" ", 0, last) - 1
    there: dict[bytes, bool] = {}
    found, of = [], []
    for k, label, priority, confidence, need, pattern in ordered:
        if all(there[w] if w in there else there.setdefault(w, w in text) for w in need):
            for m in pattern.finditer(text):
                found.append((*m.span(pattern.groups), priority, k))
                of.append((label, confidence))
    kept = [(found[i], of[i]) for i in suppress(found)]
    out["base_labels"] = ",".join(sorted(labels))
    out["labels"] = ",".join(sorted(labels | {label for _, (label, _) in kept}))
    out["score"] = max([c for _, (_, c) in kept] + [0.6 * bool(labels)])
    word_at = at = 0
    for (start, end, _, _), (label, _) in sorted(kept):
        word_at, at = word_at + text.count(b" ", at, start), start
        out["detections"].append({"label": label, "from_word": word_at - 1, "to_word": word_at + text.count(b" ", start, end)})
    return out


RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "detections array<struct<label: string, from_word: long, to_word: long>>"
)
_TYPE = pa.struct(
    [(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    + [("detections", pa.list_(pa.struct([("label", pa.string()), ("from_word", pa.int64()), ("to_word", pa.int64())])))]
)


def _detect_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([detect(x.as_py()) for x in batch], _TYPE)


def licenses(text: Column) -> Column:
    """Struct of what ``detect`` finds in a text. ``score`` is the confidence of the best remaining detection."""
    return F.arrow_udf(_detect_all, RESULT).asNondeterministic()(octets(text))
