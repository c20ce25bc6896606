"""License scan by ordered signature rules.

Hundreds of regexes are gated by a keyword automaton: a rule runs only on texts that hold one of
its keywords. Each rule has a label, a priority and a confidence. Where detections overlap, an
interval contained in another of at least the same priority is suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from sensorloom.llm.common import require, text_slices

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Phrases and labels of the contract.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# What stands between a name and its number: "License, Version 2", "License v3.0", "License - v 2.0".
VERSION = ",?(?: (?:- )?(?:version|v[.]?))? ?"
# Public license names: label, words of its name, short form in identifiers.
FAMILIES = (
    ("mit", "mit(?!-0| no attribution)", "mit"),
    ("mit-0", "(?:mit no attribution|mit-0)", "mit-0"),
    ("isc", "isc", "isc"),
    ("apache-1.1", f"apache (?:software )?license{VERSION}1[.]1", "apache-1[.]1"),
    ("apache-2", f"apache (?:software )?license{VERSION}2(?:[.]0)?", "apache-2[.]0"),
    ("bsd-2-clause", "(?:simplified|2-clause|two-clause) bsd", "bsd-2-clause"),
    ("bsd-3-clause", "(?:new|revised|3-clause|three-clause) bsd", "bsd-3-clause"),
    ("bsd-4-clause", "(?:original|4-clause|four-clause) bsd", "bsd-4-clause"),
    ("0bsd", "zero-clause bsd", "0bsd"),
    ("gpl-2.0", f"gnu general public license{VERSION}2(?:[.]0)?", "gpl-2[.]0"),
    ("gpl-3.0", f"gnu general public license{VERSION}3(?:[.]0)?", "gpl-3[.]0"),
    ("lgpl-2.1", f"gnu lesser general public license{VERSION}2[.]1", "lgpl-2[.]1"),
    ("lgpl-3.0", f"gnu lesser general public license{VERSION}3(?:[.]0)?", "lgpl-3[.]0"),
    ("agpl-3.0", f"gnu affero general public license{VERSION}3(?:[.]0)?", "agpl-3[.]0"),
    ("gfdl-1.3", f"gnu free documentation license{VERSION}1[.]3", "gfdl-1[.]3"),
    ("mpl-1.1", f"mozilla public license{VERSION}1[.]1", "mpl-1[.]1"),
    ("mpl-2.0", f"mozilla public license{VERSION}2(?:[.]0)?", "mpl-2[.]0"),
    ("epl-1.0", f"eclipse public license{VERSION}1[.]0", "epl-1[.]0"),
    ("epl-2.0", f"eclipse public license{VERSION}2[.]0", "epl-2[.]0"),
    ("cddl-1.0", "common development and distribution license", "cddl-1[.]0"),
    ("eupl-1.2", "european union public licence", "eupl-1[.]2"),
    ("artistic-2.0", f"artistic license{VERSION}2[.]0", "artistic-2[.]0"),
    ("zlib", "zlib", "zlib"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "do what the fuck you want to public license", "wtfpl"),
    ("bsl-1.0", "boost software license", "bsl-1[.]0"),
    ("psf-2.0", "python software foundation license", "psf-2[.]0"),
    ("postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl"),
    ("ncsa", "university of illinois/ncsa open source", "ncsa"),
    ("ofl-1.1", "sil open font license", "ofl-1[.]1"),
    ("odbl-1.0", "open database license", "odbl-1[.]0"),
    ("cc0-1.0", "creative commons zero", "cc0-1[.]0"),
    ("ms-pl", "microsoft public license", "ms-pl"),
    ("ms-rl", "microsoft reciprocal license", "ms-rl"),
    ("ijg", "independent jpeg group", "ijg"),
    ("libpng", "libpng", "libpng"),
    ("json", "json", "json"),
    ("x11", "x11", "x11"),
    ("zpl-2.1", "zope public license", "zpl-2[.]1"),
    ("bsl-1.1", "business source license", "busl-1[.]1"),
    ("sspl-1.0", "server side public license", "sspl-1[.]0"),
)
CREATIVE = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CREATIVE_NAMES = {
    "by": "attribution",
    "sa": "share[ -]?alike",
    "nd": "no[ -]?deriv(?:ative)?(?:s| works)",
    "nc": "non[ -]?commercial",
}

# Acronyms with a version: label, keyword, version. Without one they fit no label.
ACRONYMS = (
    ("gpl-2.0", "gpl", "2(?:[.]0)?"),
    ("gpl-3.0", "gpl", "3(?:[.]0)?"),
    ("lgpl-2.1", "lgpl", "2[.]1"),
    ("lgpl-3.0", "lgpl", "3(?:[.]0)?"),
    ("agpl-3.0", "agpl", "3(?:[.]0)?"),
    ("gfdl-1.3", "gfdl", "1[.]3"),
    ("mpl-1.1", "mpl", "1[.]1"),
    ("mpl-2.0", "mpl", "2(?:[.]0)?"),
    ("epl-1.0", "epl", "1[.]0"),
    ("epl-2.0", "epl", "2(?:[.]0)?"),
    ("cddl-1.0", "cddl", "1[.]0"),
    ("eupl-1.2", "eupl", "1[.]2"),
    ("ofl-1.1", "ofl", "1[.]1"),
    ("odbl-1.0", "odbl", "1[.]0"),
    ("zpl-2.1", "zpl", "2[.]1"),
    ("bsl-1.0", "bsl", "1[.]0"),
    ("bsl-1.1", "busl", "1[.]1"),
    ("bsl-1.1", "bsl", "1[.]1"),
    ("sspl-1.0", "sspl", "1(?:[.]0)?"),
    ("cc0-1.0", "cc0", "1[.]0"),
)
# The notices of the GNU licenses: label, name, version.
GNU_NOTICES = (
    ("gpl-2.0", "gnu general public license", "2(?:[.]0)?"),
    ("gpl-3.0", "gnu general public license", "3(?:[.]0)?"),
    ("lgpl-2.1", "gnu lesser general public license", "2[.]1"),
    ("lgpl-3.0", "gnu lesser general public license", "3(?:[.]0)?"),
    ("agpl-3.0", "gnu affero general public license", "3(?:[.]0)?"),
)
# Comment marks at the beginning of a line, and white space between two words: where it holds line
# ends, the marks of the lines that begin in it belong to it.
MARKS = r"(?:[#*;%>]+|//+|--+|(?:rem|dnl)(?=[ \t\r\n]))"
SPACE = rf"(?:[ \t\r]*(?:\n[ \t\r]*(?:{MARKS}[ \t\r]*)?)+|[ \t\r]+)"
LINE_MARKS = re.compile(rf"\n[ \t\r]*{MARKS}".encode())
# A version ends here: "2" is not a part of "2.1" or "2023".
VERSION_END = "(?![.]?[0-9])"

# How a license is named: pattern around the name, keyword, priority, confidence.
TITLE = r"{name} license(?:d)?\b"
WORDINGS = (
    (r"licensed under (?:the |a )?(?:terms of the )?{name}", "licensed under", 80, 0.95),
    (r"(?:released|distributed|available|provided) under (?:the |a )?(?:terms of the )?{name}", " under ", 75, 0.9),
    (r"under the terms of (?:the )?{name}", "terms of", 75, 0.9),
    (r"subject to (?:the )?(?:terms of the )?{name}", "subject to", 70, 0.85),
    (r"governed by (?:the )?{name}", "governed by", 70, 0.85),
    (TITLE, "license", 50, 0.7),
    (r"license: ?{name}", "license:", 60, 0.8),
)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern[bytes]
    keyword: bytes
    priority: int
    confidence: float


def _spaced(pattern: str) -> bytes:
    """Spaces of a pattern match any run of white space, with the comment marks of a new line, and
    '[ -]' any run of white space and hyphens; with a '?' behind them they may be missing. A match
    begins at a word boundary."""

    def run(match: re.Match[str]) -> str:
        if match[1] != " ":
            return r"[ \t\r\n-]" + ("*" if match[2] else "+")
        return SPACE + "?" if match[2] else SPACE

    return (r"\b" + re.sub(r"(\[ -\]| )(\?)?", run, pattern)).encode()


def build_rules() -> list[Rule]:
    """All rules, highest priority first. Every family has an identifier rule and a rule for each
    wording; the Creative Commons family has rules by name, by short form and by address."""
    rules = []

    def add(label: str, pattern: str, keyword: str, priority: int, confidence: float) -> None:
        rules.append(
            Rule(label, re.compile(_spaced(pattern)), keyword.encode(), priority, confidence)
        )

    for label, name, short in FAMILIES:
        # "mit" is not a part of "mitre".
        name += VERSION_END if VERSION in name else r"\b"
        add(
            label,
            rf"spdx-license-identifier: ?{short}(?:-only|-or-later)?\b",
            "spdx-license-identifier",
            100,
            1.0,
        )
        for pattern, keyword, priority, confidence in WORDINGS:
            own = "licence" if "licence" in name else "license"
            if pattern == TITLE and own in name:
                # The title holds the word already.
                add(label, name, own, priority, confidence)
            elif pattern == TITLE or short.replace("[.]", ".") in name:
                add(label, pattern.replace("{name}", name), keyword, priority, confidence)
            else:
                # The identifier may stand for the name.
                either = rf"(?:{name}|{short}(?:-only|-or-later)?\b{VERSION_END})"
                add(label, pattern.replace("{name}", either), keyword, priority, confidence)
    for label, short, version in ACRONYMS:
        add(label, rf"{short}[ -]?(?:version |v[.]? ?)?{version}{VERSION_END}", short, 60, 0.8)
    for label, name, version in GNU_NOTICES:
        notice = f"{name},? as published by the free software foundation[,;:]? (?:either )?version {version}{VERSION_END}"
        add(label, notice, "as published by", 90, 0.95)
    for parts in CREATIVE:
        label = f"cc-{parts}"
        name = r"[ -]".join(CREATIVE_NAMES[part] for part in parts.split("-"))
        end = r"\b(?![ -](?:sa|nd|nc)\b)"
        add(label, rf"spdx-license-identifier: ?cc-{parts}-[0-9][.][0-9]", "spdx-license-identifier", 100, 1.0)
        add(label, rf"creative commons {name}(?![ -](?:non|share|no))", "creative commons", 85, 0.95)
        add(label, rf"creativecommons[.]org/licenses/{parts}/", "creativecommons", 95, 1.0)
        add(label, "cc[ -]" + parts.replace("-", "[ -]") + end, "cc", 65, 0.8)
    for label, pattern, keyword in (
        ("mit", "permission is hereby granted, free of charge, to any person obtaining a copy", "permission is hereby"),
        ("isc", "permission to use, copy, modify, and(?:/or)? distribute this software for any purpose", "permission to use"),
        # The holder is as long as it likes, within the paragraph.
        (
            "bsd-3-clause",
            r"neither the name of (?:(?!neither the name of |\n\s*\n)(?s:.))+? nor the names of (?:its |the |their )?contributors",
            "neither the name",
        ),
        ("bsd-2-clause", "redistribution and use in source and binary forms, with or without modification", "redistribution and use"),
        ("gpl-3.0", "gnu[.]org/licenses/gpl-3", "gnu.org"),
        ("gpl-2.0", "gnu[.]org/licenses/gpl-2|gnu[.]org/licenses/old-licenses/gpl-2", "gnu.org"),
        ("lgpl-3.0", "gnu[.]org/licenses/lgpl-3", "gnu.org"),
        ("agpl-3.0", "gnu[.]org/licenses/agpl-3", "gnu.org"),
        ("apache-2", "apache[.]org/licenses/license-2[.]0", "apache.org"),
        ("mpl-2.0", "mozilla[.]org/mpl/2[.]0", "mozilla.org"),
        ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
        ("zlib", "this software is provided 'as-is', without any express or implied warranty", "as-is"),
        ("cc0-1.0", "creativecommons[.]org/publicdomain/zero/1[.]0", "creativecommons"),
        ("0bsd", "permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted[.]", "permission to use"),
        ("postgresql", "permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted", "permission to use"),
        ("bsl-1.0", "permission is hereby granted, free of charge, to any person or organization obtaining a copy", "permission is hereby"),
        ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies", "everyone is permitted"),
        ("openssl", "this product includes software developed by the openssl project", "openssl"),
        ("json", "the software shall be used for good, not evil", "not evil"),
        ("ijg", "based in part on the work of the independent jpeg group", "jpeg group"),
        ("x11", "the name of the x consortium shall not be used", "x consortium"),
        ("cc0-1.0", "creative commons zero", "creative commons"),
        ("mit-0", "mit no attribution", "no attribution"),
        ("eupl-1.2", "european union public license", "european union"),
        ("apache-2", f"apache[ -]?(?:version |v[.]? ?)?2(?:[.]0)? (?:software )?license|apache-2[.]0{VERSION_END}", "apache"),
        ("apache-1.1", f"apache[ -]?(?:version |v[.]? ?)?1[.]1 (?:software )?license|apache-1[.]1{VERSION_END}", "apache"),
        ("proprietary", "all rights reserved", "all rights"),
        ("public-domain", "(?:released into|in|dedicated to) the public domain", "public domain"),
    ):
        add(label, pattern, keyword, 90 if label not in ("proprietary", "public-domain") else 20, 0.9)
    return sorted(rules, key=lambda rule: -rule.priority)


@lru_cache(maxsize=1)
def _gate():
    import ahocorasick

    groups: dict[bytes, list[Rule]] = {}
    for rule in build_rules():
        groups.setdefault(rule.keyword, []).append(rule)
    automaton = ahocorasick.Automaton()
    for keyword, rules in groups.items():
        automaton.add_word(keyword.decode(), (keyword, rules))
    automaton.make_automaton()
    return automaton


def detections(lowered: bytes) -> list[tuple[int, int, Rule]]:
    """Non-suppressed detections in a lower-cased text: (start byte, end byte, rule) by start."""
    text = b" ".join(LINE_MARKS.sub(b"\n", lowered).split()).decode("latin-1")
    hit = {keyword: rules for _, (keyword, rules) in _gate().iter(text)}
    found = [
        (match.start(), match.end(), rule)
        for rules in hit.values()
        for rule in rules
        for match in rule.pattern.finditer(lowered)
    ]
    return suppress(found)


def suppress(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Drop each interval that lies within a kept one of at least its priority, and a wider one
    that holds a kept one of higher priority. Ties go to the wider, then to the label."""
    starts: list[int] = []
    kept: list[tuple[int, int, Rule]] = []
    order = sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[2].label, d[0]))
    for detection in order:
        start, end, _ = detection
        # No kept interval lies within another, so their ends are in the order of their starts.
        at = bisect_right(starts, start)
        if at and kept[at - 1][1] >= end:
            continue
        after = bisect_left(starts, start)
        if after < len(kept) and kept[after][1] <= end:
            continue
        starts.insert(at, start)
        kept.insert(at, detection)
    return kept


_BASE = {tuple(phrase.encode().split()): label for phrase, label in BASE_PHRASES.items()}
_BASE_GATE = [words[-1] for words in _BASE], re.compile(
    b"|".join(
        rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+".join(re.escape(word) for word in words)
        for words in _BASE
    )
)


def base_places(lowered: bytes) -> tuple[int, list[tuple[int, str]]]:
    """How many words the text has, and where the words of each phrase stand consecutively."""
    words = WORD.findall(lowered)
    if not _BASE_GATE[1].search(lowered):
        return len(words), []
    places = [
        (at, label)
        for phrase, label in _BASE.items()
        for at, word in enumerate(words)
        if word == phrase[0] and tuple(words[at : at + len(phrase)]) == phrase
    ]
    return len(words), sorted(places)


SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double, "
    "detections array<struct<start:bigint,end:bigint,label:string,priority:int>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            rows = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                lowered = (text or "").encode("utf-8", "surrogatepass").lower()
                n_words, places = base_places(lowered)
                found = detections(lowered)
                base = sorted({label for _, label in places})
                labels = sorted({*base, *(rule.label for _, _, rule in found)})
                score = max([rule.confidence for _, _, rule in found] + [0.9] * bool(places), default=0.0)
                rows.append(
                    {
                        "doc_id": doc_id,
                        "n_words": n_words,
                        "n_base": len(places),
                        "first_word": places[0][0] if places else None,
                        "last_word": places[-1][0] if places else None,
                        "base_labels": ",".join(base),
                        "labels": ",".join(labels),
                        "score": score,
                        "detections": [
                            {"start": a, "end": b, "label": rule.label, "priority": rule.priority}
                            for a, b, rule in found
                        ],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        (
            "detections",
            pa.list_(
                pa.struct(
                    [
                        ("start", pa.int64()),
                        ("end", pa.int64()),
                        ("label", pa.string()),
                        ("priority", pa.int32()),
                    ]
                )
            ),
        ),
    ]
)


def scan_licenses(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text; other columns are ignored): word count,
    the places of the base phrases, labels, the highest confidence and the detections that were
    not suppressed, in bytes of the lower-cased text.

    A null text is empty: no words, no labels, score 0. Repeated rows and null ids give a row each.
    Each row is worked on by itself, so nothing is shuffled.
    """
    return require(documents, ["doc_id", "text"]).mapInArrow(_scan, SCHEMA)
