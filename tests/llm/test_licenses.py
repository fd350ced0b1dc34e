import pytest

from dayfold.llm.licenses import BASE, PERMISSIVE, Scanner, complete_prefix, evaluate, scan_licenses, to_postfix

from .conftest import words


def brute(text):
    found, labels = [], set()
    own = words(text)
    for phrase, label in BASE.items():
        wanted = phrase.split()
        places = [n for n in range(len(own)) if own[n : n + len(wanted)] == wanted]
        found += places
        labels |= {label} if places else set()
    first, last = (min(found), max(found)) if found else (None, None)
    return len(own), len(found), first, last, ",".join(sorted(labels))


TEXTS = [
    "Under the MIT License. under-the-mit-license; under the mit licenses",
    "Licensed under the Apache License, Version 2.0. cc by nc CC-BY-NC",
    "under the mit license " * 3000,
    "CC BY É NC, cc by nc",
]


def test_base_phrases(spark, odd, odd_rows, documents):
    more = spark.createDataFrame([(100 + n, t) for n, t in enumerate(TEXTS)], "doc_id bigint, text string")
    docs = odd.select("doc_id", "text").union(more).union(documents.select("doc_id", "text"))
    got = [
        (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scan_licenses(docs).collect()
    ]
    assert sorted(got, key=str) == sorted([(r.doc_id, *brute(r.text)) for r in docs.collect()], key=str)


def test_base_labels_stay_among_labels(documents):
    for r in scan_licenses(documents).collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


@pytest.mark.parametrize(
    ("text", "whole", "usable"),
    [
        ("mit or gpl-3.0-only and isc", "(mit or (gpl-3.0-only and isc))", True),
        ("(mit or gpl-3.0-only) and gpl-2.0", "((mit or gpl-3.0-only) and gpl-2.0)", False),
        ("gpl-2.0-or-later with classpath-exception-2.0 or apache-2.0", "((gpl-2.0-or-later with classpath-exception-2.0) or apache-2.0)", True),
        ("mit and then some words", "mit", False),
        ("mit and commercial use license", "mit", False),
        ("mit or commercial use license", "mit", True),
        ("(mit and commercial use license) or isc", "mit", False),
        ("mit/apache-2.0", "(mit or apache-2.0)", True),
        ("(mit/x11) and isc", "((mit or x11) and isc)", True),
        ("gpl-2.0 with some of my words", "gpl-2.0", False),
        ("mit or", "mit", True),
        ("(mit", "mit", False),
        ("((mit", "mit", False),
        ("(", "", None),
        ("or mit", "", None),
        ("", "", None),
    ],
)
def test_expressions(text, whole, usable):
    tokens, binds = complete_prefix(text)
    found = evaluate(to_postfix(tokens), PERMISSIVE)
    assert found.text == whole
    assert usable is None or (found.allowed and not binds) == usable


@pytest.mark.parametrize(
    ("text", "whole", "labels", "usable"),
    [
        ("((GPL-2.0 WITH Linux-syscall-note) OR MIT)", "((gpl-2.0 with linux-syscall-note) or mit)", "gpl,mit", True),
        ("GPL-2.0 WITH Linux-syscall-note */", "(gpl-2.0 with linux-syscall-note)", "gpl", False),
        ("(MIT OR WTFPL)", "(mit or wtfpl)", "mit", True),
        ("(MIT AND Homegrown) OR ISC", "((mit and homegrown) or isc)", "isc,mit", True),
        ("MIT AND Homegrown", "(mit and homegrown)", "mit", False),
        ("MIT AND Commercial Use License", "mit", "mit", False),
        ("MIT/Apache-2.0", "(mit or apache-2.0)", "apache-2,mit", True),
        ("(MIT OR\n//   GPL-2.0-only)\nint x = (1);", "(mit or gpl-2.0-only)", "gpl,mit", True),
        ("(MIT AND (ISC\r\n * OR Zlib\r\n * )) */", "(mit and (isc or zlib))", "isc,mit,zlib", True),
        ("(MIT\n\nThis text (is prose): and more", "mit", "mit", False),
        ("MIT // and so on", "mit", "mit", False),
        ("MIT WITH Homegrown-note", "(mit with homegrown-note)", "mit", False),
        ("Apache-2.0 AND OpenSSL", "(apache-2.0 and openssl)", "apache-2", False),
        ("WTFPL", "wtfpl", "", False),
        ("LGPL-2.1+", "lgpl-2.1+", "lgpl", False),
        ("LGPL-3.0", "lgpl-3.0", "lgpl", False),
        ("AGPL-3.0", "agpl-3.0", "agpl", False),
        ("MPL-1.1", "mpl-1.1", "mpl", False),
        ("BSD-4-Clause", "bsd-4-clause", "bsd", True),
        ("BSD-3-Clause-No-Nuclear-License", "bsd-3-clause-no-nuclear-license", "", False),
        ("CC-BY-NC-SA-3.0 OR CC-BY-3.0", "(cc-by-nc-sa-3.0 or cc-by-3.0)", "cc-by,cc-by-nc", True),
    ],
)
def test_operands_of_the_public_lists_and_unknown_ones(text, whole, labels, usable):
    found = Scanner(BASE, {}, PERMISSIVE).scan(f"// SPDX-License-Identifier: {text}\n")
    assert (found[5], found[7], found[8]) == (labels, whole, usable)


def test_tags_and_notices():
    scan = Scanner(BASE, {"gnu general public license": "gpl"}, PERMISSIVE).scan
    assert scan("// SPDX-License-Identifier: MIT OR GPL-2.0-only\nx")[5:] == ("gpl,mit", 0.95, "(mit or gpl-2.0-only)", True)
    assert scan("the GNU General Public License")[5] == "gpl"
    assert scan("no licence at all")[5:] == ("", 0.0, "", None)


def test_empty_table(none):
    assert scan_licenses(none).collect() == []
