import re

import pytest

from sensorloom.llm import licenses as L
from tests.llm.helpers import awkward, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

TEXTS = [
    (1, "Licensed under the Apache License, Version 2.0.\nUnder the MIT license!"),
    (2, "cc-by-nc CC BY-NC 4.0 cc by nc cc by nc"),
    (3, "SPDX-License-Identifier: GPL-3.0-or-later"),
    (4, "Permission is hereby granted, free of\n charge, to any person obtaining a copy"),
    (5, "under the mit licenses; beneath the mit license; apache license version 20"),
    (6, ("Licensed under CC BY-NC 4.0.\n" * 800)),
    (7, "licensed under the MIT license, see https://creativecommons.org/licenses/by-sa/4.0/"),
]


def base(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = []
    for phrase, label in L.BASE_PHRASES.items():
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return len(words), sorted(places)


def test_base_matches_brute_force(spark):
    texts = TEXTS + awkward()
    rows = L.scan_licenses(documents(spark, texts)).collect()
    got, expected = [], []
    for row in rows:
        got.append((row["doc_id"], row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]))
        assert 0 <= row["score"] <= 1
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
    for doc_id, text in texts:
        n, places = base(text)
        first, last = (places[0][0], places[-1][0]) if places else (None, None)
        expected.append((doc_id, n, len(places), first, last, ",".join(sorted({x for _, x in places}))))
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_rules_find_their_licenses(spark):
    labels = {r["doc_id"]: r["labels"].split(",") for r in L.scan_licenses(documents(spark, TEXTS)).collect()}
    assert "apache-2" in labels[1] and "mit" in labels[1]
    assert "gpl-3.0" in labels[3]
    assert labels[4] == ["mit"]
    assert "cc-by-nc" in labels[6]
    assert {"mit", "cc-by-sa"} <= set(labels[7])


def test_hundreds_of_rules_by_priority():
    rules = L.build_rules()
    assert len(rules) >= 200
    assert [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)


CREATIVE_TEXTS = {
    "by": ("Attribution", "by-nc"),
    "by-sa": ("Attribution-ShareAlike", "by-nc-sa"),
    "by-nd": ("Attribution-NoDerivatives", "by"),
    "by-nc": ("Attribution-NonCommercial", "by-nc-nd"),
    "by-nc-sa": ("Attribution-NonCommercial-ShareAlike", "by-nc"),
    "by-nc-nd": ("Attribution-NonCommercial-NoDerivs", "by-nc-sa"),
}
CREATIVE_FORMS = (
    ("SPDX-License-Identifier: CC-{short}-4.0", 100),
    ("Creative Commons {name} 4.0", 85),
    ("https://creativecommons.org/licenses/{short}/4.0/", 95),
    ("CC {short} 4.0", 65),
)


def creative_forms(parts):
    for form, priority in CREATIVE_FORMS:
        text = form.format(short=parts, name=CREATIVE_TEXTS[parts][0])
        yield priority, text
        if priority in (65, 85):
            head, _, end = text.rpartition(" ")
            yield priority, head.replace("-", " ") + " " + end
            yield priority, head.replace(" ", "\n ").replace("-", "\t-\r\n") + " " + end
    yield 65, f"(CC-{parts.upper()})"


@pytest.mark.parametrize("parts", CREATIVE_TEXTS)
def test_creative_commons_rules(parts):
    rules = [r for r in L.build_rules() if r.label == f"cc-{parts}"]
    assert len(rules) == len(CREATIVE_FORMS)
    for rule in rules:
        own = [text for priority, text in creative_forms(parts) if priority == rule.priority]
        other = [text for priority, text in creative_forms(CREATIVE_TEXTS[parts][1]) if priority == rule.priority]
        assert own and other
        assert all(rule.pattern.search(text.lower().encode()) for text in own), rule
        assert not any(rule.pattern.search(text.lower().encode()) for text in other), rule
    for _, text in creative_forms(parts):
        assert {r.label for *_, r in L.detections(text.lower().encode())} == {f"cc-{parts}"}, text


VERSIONED = {
    "apache-1.1": ("Apache Software License", "1.1", "2.0"),
    "apache-2": ("Apache License", "2.0", "1.1"),
    "gpl-2.0": ("GNU General Public License", "2", "3"),
    "gpl-3.0": ("GNU General Public License", "3.0", "2.0"),
    "lgpl-2.1": ("GNU Lesser General Public License", "2.1", "3"),
    "lgpl-3.0": ("GNU Lesser General Public License", "3", "2.1"),
    "agpl-3.0": ("GNU Affero General Public License", "3.0", "30"),
    "gfdl-1.3": ("GNU Free Documentation License", "1.3", "1.2"),
    "mpl-1.1": ("Mozilla Public License", "1.1", "2.0"),
    "mpl-2.0": ("Mozilla Public License", "2.0", "1.1"),
    "epl-1.0": ("Eclipse Public License", "1.0", "2.0"),
    "epl-2.0": ("Eclipse Public License", "2.0", "1.0"),
    "artistic-2.0": ("Artistic License", "2.0", "2.05"),
}


def labels_of(text):
    return {r.label for *_, r in L.detections(text.lower().encode())}


@pytest.mark.parametrize("label", VERSIONED)
def test_ways_to_write_a_version(label):
    name, own, other = VERSIONED[label]
    for way in (" v{}", " v {}", " {}", ", Version {}", ", version{}", " v. {}", " - v {}", ",\nversion\t{}"):
        text = "Licensed under the " + name + way
        assert labels_of(text.format(own) + ".") == {label}
        assert label not in labels_of(text.format(other))
        assert label not in labels_of(text.format(own + "7"))


def test_spaces_after_a_colon_are_optional():
    for text, label in (
        ("license:mit", "mit"),
        ("License: MIT", "mit"),
        ("SPDX-License-Identifier:MIT", "mit"),
        ("SPDX-License-Identifier:GPL-3.0-only", "gpl-3.0"),
        ("SPDX-License-Identifier:CC-BY-SA-4.0", "cc-by-sa"),
    ):
        assert labels_of(text) == {label}
    assert "mit" not in labels_of("license:mitre") | labels_of("SPDX-License-Identifier:ISC")


SAMPLES = {
    "mit": ("MIT", "MIT-0"),
    "mit-0": ("MIT No Attribution", "MIT"),
    "isc": ("ISC", "Zlib"),
    "apache-1.1": ("Apache Software License, Version 1.1", "Apache License, Version 2.0"),
    "apache-2": ("Apache License, Version 2.0", "Apache Software License, Version 1.1"),
    "bsd-2-clause": ("Simplified BSD", "3-Clause BSD"),
    "bsd-3-clause": ("3-clause BSD", "2-clause BSD"),
    "bsd-4-clause": ("Original BSD", "New BSD"),
    "0bsd": ("Zero-Clause BSD", "Two-Clause BSD"),
    "gpl-2.0": ("GNU General Public License v2.0", "GNU General Public License v3.0"),
    "gpl-3.0": ("GNU General Public License v3.0", "GNU Lesser General Public License v3.0"),
    "lgpl-2.1": ("GNU Lesser General Public License v2.1", "GNU General Public License v2.0"),
    "lgpl-3.0": ("GNU Lesser General Public License v3.0", "GNU Affero General Public License v3.0"),
    "agpl-3.0": ("GNU Affero General Public License v3.0", "GNU General Public License v3.0"),
    "gfdl-1.3": ("GNU Free Documentation License 1.3", "GNU Free Documentation License 1.2"),
    "mpl-1.1": ("Mozilla Public License 1.1", "Mozilla Public License 2.0"),
    "mpl-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License, v. 1.1"),
    "epl-1.0": ("Eclipse Public License - v 1.0", "Eclipse Public License - v 2.0"),
    "epl-2.0": ("Eclipse Public License - v 2.0", "Eclipse Public License - v 1.0"),
    "cddl-1.0": ("Common Development and Distribution License", "Eclipse Public License v1.0"),
    "eupl-1.2": ("European Union Public Licence", "Mozilla Public License 2.0"),
    "artistic-2.0": ("Artistic License 2.0", "Artistic License 1.0"),
    "zlib": ("zlib", "libpng"),
    "unlicense": ("Unlicense", "MIT"),
    "wtfpl": ("Do What The Fuck You Want To Public License", "Mozilla Public License 2.0"),
    "bsl-1.0": ("Boost Software License", "Business Source License"),
    "psf-2.0": ("Python Software Foundation License", "Boost Software License"),
    "postgresql": ("PostgreSQL", "OpenSSL"),
    "openssl": ("OpenSSL", "PostgreSQL"),
    "ncsa": ("University of Illinois/NCSA Open Source", "MIT"),
    "ofl-1.1": ("SIL Open Font License", "Open Database License"),
    "odbl-1.0": ("Open Database License", "SIL Open Font License"),
    "cc0-1.0": ("Creative Commons Zero", "Creative Commons Attribution"),
    "ms-pl": ("Microsoft Public License", "Microsoft Reciprocal License"),
    "ms-rl": ("Microsoft Reciprocal License", "Microsoft Public License"),
    "ijg": ("Independent JPEG Group", "libpng"),
    "libpng": ("libpng", "zlib"),
    "json": ("JSON", "MIT"),
    "x11": ("X11", "MIT"),
    "zpl-2.1": ("Zope Public License", "Mozilla Public License 2.0"),
    "bsl-1.1": ("Business Source License", "Boost Software License"),
    "sspl-1.0": ("Server Side Public License", "GNU Affero General Public License v3.0"),
}
WAYS = {
    "licensed under": "licensed under the terms of the {}",
    " under ": "released under the {}",
    "terms of": "under the terms of the {}",
    "subject to": "subject to the {}",
    "governed by": "governed by the {}",
    "license:": "License: {}",
}


@pytest.mark.parametrize("label", [label for label, _, _ in L.FAMILIES])
def test_template_rules(label):
    """Every rule of the template finds its own name and not that of a neighbour."""
    own, other = SAMPLES[label]
    rules = [r for r in L.build_rules() if r.label == label]
    for keyword, way in WAYS.items():
        rule = [r for r in rules if r.keyword.decode() == keyword]
        assert len(rule) == 1, keyword
        assert rule[0].pattern.search(way.format(own).lower().encode()), way
        assert not rule[0].pattern.search(way.format(other).lower().encode()), way
        assert label in labels_of(way.format(own)) and label not in labels_of(way.format(other))
    title = [r for r in rules if r.priority == 50]
    for text, found in ((own, True), (other, False)):
        text = text if "licen" in text.lower() and label != "unlicense" else text + " License"
        assert len(title) == 1 and bool(title[0].pattern.search(text.lower().encode())) == found
        assert (label in labels_of("The " + text)) == found
    short = [short for name, _, short in L.FAMILIES if name == label][0].replace("[.]", ".")
    assert labels_of("SPDX-License-Identifier: " + short) == {label}


HEADER = (
    "it under the terms of the GNU {}General Public License as published by\n"
    "the Free Software Foundation{} version {} of the License, or\n(at your option) any later version."
)


@pytest.mark.parametrize(
    "text, label",
    [
        ("licensed under GPLv3", "gpl-3.0"),
        ("License: GPL-3.0", "gpl-3.0"),
        ("GPL v2, see COPYING", "gpl-2.0"),
        ("LGPL 2.1", "lgpl-2.1"),
        ("LGPLv3+", "lgpl-3.0"),
        ("AGPL version 3", "agpl-3.0"),
        ("MPL 2.0", "mpl-2.0"),
        ("EUPL v1.2", "eupl-1.2"),
        ("BUSL-1.1", "bsl-1.1"),
        ("Apache 2.0 license", "apache-2"),
        ("Apache License, Version 2.0", "apache-2"),
        ("European Union Public Licence", "eupl-1.2"),
        (HEADER.format("", "; either", 3), "gpl-3.0"),
        (HEADER.format("", ";", 2), "gpl-2.0"),
        (HEADER.format("Lesser ", "; either", 2.1), "lgpl-2.1"),
        (HEADER.format("Affero ", ", either", 3), "agpl-3.0"),
        ("Neither the name of " + "The Very Long Holder, Inc. " * 40 + "nor\nthe names of its\ncontributors", "bsd-3-clause"),
        ("Neither the name of a\nholder nor the names of its contributors", "bsd-3-clause"),
        ("The Software shall be used for Good, not Evil.", "json"),
        ("Creative Commons Attribution-No Derivative Works 3.0", "cc-by-nd"),
        ("Creative Commons Attribution-Share Alike 3.0", "cc-by-sa"),
    ],
)
def test_headers_titles_and_acronyms(text, label):
    assert labels_of(text) == {label}


@pytest.mark.parametrize("label, short, version", L.ACRONYMS)
def test_acronym_rules(label, short, version):
    number = version.replace("[.]", ".").replace("(?:.0)?", ".0")
    for text in (f"{short}-{number}", f"{short} v{number}", f"({short.upper()} version {number})", f"{short}{number}."):
        assert labels_of(text) == {label}
    for text in (short, f"{short} {number}9", f"x{short} {number}", f"{short} 9"):
        assert labels_of(text) == set()


APACHE = """
{0} Licensed under the Apache
{0} License, Version 2.0 (the "License");
"""
PERMISSION = """
{0} Permission is hereby granted, free
{0}
{0}   of charge, to any person
{0} obtaining a copy
"""


@pytest.mark.parametrize("marks", ["#", "//", " *", "--", ";;", "%", ">", "rem", "dnl", "\t#", "\r\n///", ""])
def test_comment_marks_between_words(marks):
    assert labels_of(APACHE.format(marks)) == {"apache-2"}
    assert labels_of(PERMISSION.format(marks)) == {"mit"}


def test_marks_within_a_line_are_no_white_space():
    assert labels_of("released # under the # isc") == labels_of("released\nremover under the isc") == set()
    assert labels_of("permission is hereby\nrem granted, free of charge, to any person obtaining a copy") == {"mit"}


def test_long_white_space_is_read_once():
    for run in (" " * 50000, "\n" * 50000, "\n# " * 20000, " \n\t# \r\n" * 10000):
        assert labels_of("licensed" + run + "under" + run + "the isc") == {"isc"}
        assert labels_of("licensed under" + run + "the" + run + "zzz") == set()


@pytest.mark.parametrize("way", WAYS.values())
def test_identifiers_in_wordings(way):
    for text, label, other in (
        ("BSD-3-Clause", "bsd-3-clause", "BSD-2-Clause"),
        ("Apache-2.0", "apache-2", "Apache-1.1"),
        ("GPL-3.0-or-later", "gpl-3.0", "GPL-2.0-only"),
        ("MS-PL", "ms-pl", "MS-RL"),
        ("0BSD", "0bsd", "BSD-4-Clause"),
        ("MPL-2.0", "mpl-2.0", "MPL-2.05"),
        ("MIT", "mit", "MIT-0"),
    ):
        assert labels_of(way.format(text) + ".") == {label}
        assert label not in labels_of(way.format(other))


def test_one_name_for_a_license():
    assert {rule.label for rule in L.build_rules()} >= set(L.BASE_PHRASES.values())
    assert labels_of("European Union Public License 1.2") == labels_of("European Union Public Licence") == {"eupl-1.2"}


def test_clause_needs_its_own_holder():
    assert labels_of("neither the name of a\n \nb nor the names of its contributors") == set()
    text = "neither the name of x " * 3000
    assert labels_of(text) == set() and labels_of(text + "nor the names of its contributors") == {"bsd-3-clause"}


def test_short_forms_are_whole_words():
    for text in (b"cc bystander", b"acc by", b"cc by-sample"):
        assert "cc-by-sa" not in {r.label for *_, r in L.detections(text)}
    assert L.detections(b"cc bystander") == L.detections(b"acc by") == []


def test_suppression():
    rule = {p: L.Rule(f"r{p}", re.compile(b"x"), b"x", p, 0.5) for p in (10, 20, 30)}
    found = [(0, 10, rule[20]), (2, 5, rule[10]), (0, 30, rule[10]), (8, 14, rule[30]), (12, 13, rule[20])]
    assert [(a, b) for a, b, _ in L.suppress(found)] == [(0, 10), (8, 14)]
    assert L.suppress([(0, 4, rule[10]), (0, 4, rule[10])]) == [(0, 4, rule[10])]


def test_gate_never_hides_a_match():
    for rule in L.build_rules():
        assert rule.keyword.decode().strip().split(" ")[0].split("-")[0] in rule.pattern.pattern.decode().replace("[.]", ".").replace("\\", "")


def test_empty_table(spark):
    assert L.scan_licenses(documents(spark, [])).count() == 0
