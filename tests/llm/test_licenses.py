"""Licence scans against plain loops and expressions worked out by hand."""

import re

import pytest

from plexus.llm import licenses as L
from plexus.llm.registry import op11_license_scans, table
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD


def plain(text):
    """The contract's base part, word by word."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    at, labels = [], set()
    for phrase, label in L.BASE.items():
        want = phrase.split()
        for k in range(len(words) - len(want) + 1):
            if words[k:k + len(want)] == want:
                at.append(k)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


TEXTS = ["Released under the MIT License.", "GNU/General\x00Public_LICENSE, CC-BY 4.0; cc\nby", "gnu general public licensed", "ümit license", "mit license " * 3000,
         "apache license mit license apache license", "cc by cc by-sa", "İmit license", "MIT License", "cc by\x7fmit\x60license"]


def test_base_places_equal_a_plain_scan(spark, docs):
    rows = ODD + [(100 + i, t) for i, t in enumerate(TEXTS)]
    got = L.digest(L.scan(docs(rows))).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(((i, *plain(t)) for i, t in rows), key=key)
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_empty_table_and_column_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, notices int")
    assert L.digest(L.scan(empty)).collect() == []
    own = spark.createDataFrame([("x", 7, "mit license")], "text string, n_words int, body string").withColumnRenamed("n_words", "key")
    assert L.digest(L.scan(own, "key", "body")).collect()[0][:3] == (7, 2, 1)


def test_notices_say_where_they_stand():
    phrases, tags = L.phrase_automaton(), L.tag_automaton()
    text = "é — Licensed under CC\n * BY-NC 4.0."
    _, notices, _ = L.scan_text(text, phrases, tags)
    assert [(n["label"], n["base"], text[n["start"]:n["end"]]) for n in notices] == [("cc-by", True, "CC\n * BY"), ("cc-by-nc", False, "CC\n * BY-NC")]


@pytest.mark.parametrize("tokens,order", [
    ("MIT", "MIT"), ("a or b and c", "a b c and or"), ("( a or b ) and c", "a b or c and"), ("a and b with x or c", "a b x with and c or"),
    ("a or b or c", "a b or c or"), ("( ( a ) )", "a")])
def test_shunting_yard(tokens, order):
    assert " ".join(L.postfix(tokens.split())) == order


@pytest.mark.parametrize("tokens", ["", "a b", "or", "a or", "( a", "a )", ") a (", "a ( b )", "a or and b", "( )"])
def test_no_expression(tokens):
    assert L.postfix(tokens.split()) is None


def test_values_of_expressions():
    value = lambda x: L.evaluate(L.postfix(x.split()))
    assert value("MIT or GPL-3.0-only") == (["gpl", "mit"], L.DUTIES["mit"])
    assert value("MIT and GPL-3.0-only") == (["gpl", "mit"], L.DUTIES["gpl"])
    assert value("GPL-2.0+ with Classpath-exception-2.0") == (["gpl"], L.DUTIES["gpl"] * L.EXCEPTION)
    assert value("( MIT or Apache-2.0 ) with x") is None and value("Some-Own-1.0") == (["some-own-1.0"], L.UNKNOWN)
    assert [L.label_of(x) for x in ("BSD-3-Clause", "CC-BY-SA-4.0", "CC-BY-4.0", "LGPL-2.1-or-later", "0BSD", "MITNFA", "CC0-1.0")] == [
        "bsd", "cc-by-sa", "cc-by", "lgpl", "bsd", "mitnfa", "cc0"]


def test_tags_and_joined_notices():
    phrases, tags = L.phrase_automaton(), L.tag_automaton()

    def found(text):
        return [(e["expression"], e["postfix"], e["valid"], e["labels"], text[e["start"]:e["end"]]) for e in L.scan_text(text, phrases, tags)[2]]

    assert found("/* é SPDX-License-Identifier: (MIT OR Apache-2.0) AND X-1 */ or") == [
        ("( MIT OR Apache-2.0 ) AND X-1", "MIT Apache-2.0 or X-1 and", True, ["apache", "mit", "x-1"], "License-Identifier: (MIT OR Apache-2.0) AND X-1")]
    assert found("license-identifier: MIT and\nBSD") == [("MIT", "MIT", True, ["mit"], "license-identifier: MIT")]
    assert found("License-Expression: (MIT or") == [("( MIT", "", False, ["mit"], "License-Expression: (MIT")]
    assert found("license-identifier:\nMIT") == []
    assert found("under the MIT License or the Apache License, version 2.0") == [
        ("mit or apache", "mit apache or", True, ["apache", "mit"], "MIT License or the Apache License")]
    assert found("the MIT License, and nobody knew of the Apache License") == []


def test_scores_of_documents(spark, docs):
    rows = [(1, "plain words"), (2, "mit license"), (3, "under the mit license or the apache license"), (4, "mit license. all rights reserved"),
            (5, "SPDX-License-Identifier: GPL-2.0-only")]
    got = {r.doc_id: (r.labels, r.score) for r in L.digest(L.scan(docs(rows))).collect()}
    assert got == {1: ("", 0.0), 2: ("mit", 0.1), 3: ("apache,mit", 0.1), 4: ("all-rights-reserved,mit", 1.0), 5: ("gpl", 0.8)}


def test_registered_query(spark):
    rows = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:6] for r in op11_license_scans(spark, SF_SMALL).collect()}
    assert got == {r.doc_id: plain(r.text) for r in rows} and any(x[1] for x in got.values())
