import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vcat.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def check(docs, texts):
    out = {r.doc_id: r for r in licenses.scan_licenses(docs([(i, t) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        assert (out[i].n_words, out[i].n_base, out[i].first_word, out[i].last_word, out[i].base_labels) == plain(t), t
        assert set(filter(None, out[i].base_labels.split(","))) <= set(out[i].labels.split(",")) or not out[i].base_labels
    return out


def test_places_of_base_phrases(docs):
    texts = [None, "", "...", "MIT License", "the MIT-license mit License.", "mit\0license", "mit xlicense", "emit license", "GNU General\nPublic  License, v2", "mit licenseé", "mit",
             "license", "Apache License mit license " * 3000, "x " * 200_000 + "mit license", "ÀB mit license"]
    check(docs, texts)


def test_texts_do_not_run_into_each_other(docs):
    check(docs, ["apache", "license mit", "license", "", "general public", "license"])


def test_tags_notices_and_scores(docs):
    out = check(docs, ["SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0\nx", "// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */",
                       "SPDX-License-Identifier: AND", "Licensed under CC BY-NC 4.0.", "nothing here", "SPDX-License-Identifier:"])
    assert [(out[i].labels, out[i].score) for i in range(6)] == [("apache-2.0,gpl-2.0-only,mit", 1.0), ("gpl-2.0-only", 0.4), ("invalid", 0.0), ("cc-by-nc-4.0", 0.2), ("", 0.0), ("invalid", 0.0)]


def test_only_identifiers_are_licences(docs):
    out = check(docs, ["License expression: see below", "An SPDX license identifier is a string", "SPDX-License-Identifier: GPL-2.0+ WITH nothing", "SPDX-License-Identifier: LGPL-2.1-or-later OR LicenseRef-own.1",
                       "Licensed under the MIT License. All rights reserved.", "All rights reserved.", "SPDX-License-Identifier: GPL-2.0-only WITH GCC-exception-3.1 AND ISC"])
    assert [(out[i].labels, out[i].score) for i in range(7)] == [("invalid", 0.0), ("invalid", 0.0), ("invalid", 0.0), ("lgpl-2.1-or-later,licenseref-own.1", 0.6), ("mit,reserved", 1.0), ("reserved", 0.0),
                                                                 ("gpl-2.0-only,isc", 0.4)]


@pytest.mark.parametrize(("text", "postfix"), [("a or b and c", "a b c and or"), ("(a or b) and c", "a b or c and"), ("a with x and b", "a x with b and"), ("a) and b", "a"), ("a b", "a")])
def test_shunting_yard(text, postfix):
    assert " ".join(licenses.to_postfix(text)) == postfix


@pytest.mark.parametrize("text", ["", "and", "(a", "a or", "or b"])
def test_not_an_expression(text):
    with pytest.raises(ValueError):
        licenses.to_postfix(text)


expressions = st.recursive(st.sampled_from(["mit", "gpl-2.0", "cc-by-nc-4.0"]).map(lambda x: (x, {x}, licenses.grade(x))),
                           lambda e: st.tuples(e, st.sampled_from(["or", "and"]), e).map(
                               lambda t: (f"({t[0][0]} {t[1]} {t[2][0]})", t[0][1] | t[2][1], (max if t[1] == "or" else min)(t[0][2], t[2][2]))), max_leaves=8)


@settings(max_examples=100, deadline=None)
@given(expressions)
def test_evaluation(e):
    assert licenses.evaluate(e[0]) == (e[1], e[2])


def test_empty_table(docs):
    assert licenses.scan_licenses(docs([])).count() == 0
