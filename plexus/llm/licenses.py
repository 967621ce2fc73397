"""Licence notices and identifier tags of whole texts.

One Aho-Corasick automaton over a text's words finds the notice phrases, a
second one over its characters the identifier tags.  What follows a tag, and
notices joined by "and", "or" or "with", are licence expressions; a
shunting-yard parser brings them into postfix order and evaluates them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm import common

# Base phrases and their labels (fixed values).
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Further notice phrases, by label.
NOTICES = {
    "agpl": ("gnu affero general public license", "affero general public license"),
    "all-rights-reserved": ("all rights reserved",),
    "apache": ("licensed under apache 2 0", "apache software license"),
    "artistic": ("artistic license",),
    "bsd": ("bsd license", "bsd 2 clause", "bsd 3 clause", "redistribution and use in source and binary forms"),
    "bsl": ("boost software license",),
    "cc-by": ("creative commons attribution",),
    "cc-by-nc": ("cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"),
    "cc-by-nd": ("cc by nd", "creative commons attribution noderivatives", "creative commons attribution noderivs"),
    "cc-by-sa": ("cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"),
    "cc0": ("cc0", "creative commons zero"),
    "epl": ("eclipse public license",),
    "gpl": ("gnu gpl", "gpl v2", "gpl v3", "gplv2", "gplv3"),
    "isc": ("isc license",),
    "lgpl": ("gnu lesser general public license", "gnu library general public license", "gnu lgpl"),
    "mit": ("permission is hereby granted free of charge to any person obtaining a copy",),
    "mpl": ("mozilla public license",),
    "ofl": ("sil open font license",),
    "public-domain": ("dedicated to the public domain", "in the public domain"),
    "unlicense": ("free and unencumbered software released into the public domain", "the unlicense"),
    "zlib": ("zlib license",),
}
# Tags that an expression follows.
TAGS = ("license-identifier:", "licence-identifier:", "license-expression:")  # the first ends the longer SPDX tag too
# How much a licence asks of those who use the work: 0 nothing, 1 everything.
DUTIES = {"agpl": 0.9, "all-rights-reserved": 1.0, "apache": 0.2, "artistic": 0.4, "bsd": 0.15, "bsl": 0.1, "cc-by": 0.2, "cc-by-nc": 0.7,
          "cc-by-nd": 0.7, "cc-by-sa": 0.5, "cc0": 0.0, "epl": 0.5, "gpl": 0.8, "isc": 0.1, "lgpl": 0.6, "mit": 0.1, "mpl": 0.5, "ofl": 0.3,
          "public-domain": 0.0, "unlicense": 0.0, "zlib": 0.1}
LONGEST_FIRST = sorted(DUTIES, key=len, reverse=True)
UNKNOWN = 0.5  # of an identifier that no label covers
EXCEPTION = 0.75  # an exception ("with") leaves so much of what the licence asks
BINDS = {"or": 1, "and": 2, "with": 3}
GAP = 8  # notices at most so many words apart may be operands of one expression
FILLERS = {"the", "a", "an", "this", "either", "version", "v", "license", "licence", "licenses", "under", "of", "terms", "later", "any", "international", "unported", "only"}

# Words as the base contract has them, on text with A-Z lowered or not.
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
TOKEN = re.compile(r"[^\S\r\n]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+_:-]*))")

FOUND = ("doc_id long, n_words long, notices array<struct<label:string,base:boolean,word:long,words:int,start:long,end:long>>, "
         "expressions array<struct<source:string,expression:string,postfix:string,valid:boolean,labels:array<string>,duty:double,start:long,end:long>>")

NOTICE = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64()), ("words", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
EXPRESSION = pa.list_(pa.struct([("source", pa.string()), ("expression", pa.string()), ("postfix", pa.string()), ("valid", pa.bool_()),
                                 ("labels", pa.list_(pa.string())), ("duty", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))


def phrase_automaton() -> ahocorasick.Automaton:
    """Phrases between single spaces; a phrase's value is its number of words
    and its (label, base) pairs."""
    values: dict[str, dict[str, bool]] = {}
    for phrase, label in BASE.items():
        values.setdefault(phrase, {})[label] = True
    for label, phrases in NOTICES.items():
        for phrase in phrases:
            values.setdefault(phrase, {}).setdefault(label, False)
    automaton = ahocorasick.Automaton()
    for phrase, labels in values.items():
        automaton.add_word(f" {phrase} ", (phrase.count(" ") + 1, sorted(labels.items())))
    automaton.make_automaton()
    return automaton


def tag_automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for tag in TAGS:
        automaton.add_word(tag, len(tag))
    automaton.make_automaton()
    return automaton


def label_of(identifier: str) -> str:
    """The label of a licence identifier: the longest label its name starts
    with (at a word's end, versions aside), else the name in lower case."""
    name = identifier.lower().rstrip("+").removeprefix("licenseref-")
    name = {"0bsd": "bsd", "cc-zero": "cc0"}.get(name, name)
    stem = re.sub(r"[._-]?v?[0-9][0-9.]*$", "", re.sub(r"-(only|or-later)$", "", name))
    for known in LONGEST_FIRST:
        if stem == known or name.startswith(known + "-"):
            return known
    return name


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: operands and operators (or < and < with, left to right)
    in postfix order; None if the tokens are no expression."""
    out: list[str] = []
    waiting: list[str] = []
    operand = True  # whether one must come next
    for token in tokens:
        word = token.lower()
        if token == "(":
            if not operand:
                return None
            waiting.append(token)
        elif token == ")":
            if operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif word in BINDS:
            if operand:
                return None
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand = True
        else:
            if not operand:
                return None
            out.append(token)
            operand = False
    if operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(order: list[str]) -> tuple[list[str], float] | None:
    """Labels and duty of a postfix expression: of "or" the lighter side may be
    chosen, "and" binds to the heavier, "with" takes an exception's name and
    lightens its licence.  None if "with" stands between anything else than a
    licence and a name."""
    stack: list[tuple[set[str], float, bool]] = []
    for token in order:
        if token not in BINDS:
            label = label_of(token)
            stack.append(({label}, DUTIES.get(label, UNKNOWN), True))
            continue
        (right, heavy, plain), (left, duty, first) = stack.pop(), stack.pop()
        if token == "with":
            if not (plain and first):
                return None
            stack.append((left, duty * EXCEPTION, False))
        else:
            left |= right
            stack.append((left, (min if token == "or" else max)(duty, heavy), False))
    labels, duty, _ = stack.pop()
    return sorted(labels), duty


def expression(tokens: list[str], source: str, start: int, end: int) -> dict:
    """The evaluated expression; one that can't be parsed still gives the
    labels of its identifiers and the heaviest of their duties."""
    order = postfix(tokens)
    value = evaluate(order) if order else None
    valid = value is not None
    if not valid:
        names = sorted({label_of(t) for t in tokens if t not in "()" and t.lower() not in BINDS})
        value = names, max((DUTIES.get(n, UNKNOWN) for n in names), default=0.0)
    return {"source": source, "expression": " ".join(tokens), "postfix": " ".join(order or ()), "valid": valid,
            "labels": value[0], "duty": value[1], "start": start, "end": end}


def tagged(text: str, raw: bytes, tags: ahocorasick.Automaton) -> list[dict]:
    """The expressions after identifier tags: tokens of the tag's line while
    they can go on an expression.  ``raw`` is the text in UTF-8."""
    found = []
    for last, size in tags.iter(raw.translate(LOWERED).decode("latin-1")):
        at = len(raw[:last + 1].decode())
        start, tokens, ends, depth = at - size, [], [], 0
        while (m := TOKEN.match(text, at)) is not None:
            token = m.group(1) or m.group(2)
            operand_next = not tokens or tokens[-1] == "(" or tokens[-1].lower() in BINDS
            goes_on = token == ")" or token.lower() in BINDS
            if operand_next == goes_on or (token == ")" and not depth):
                break
            depth += (token == "(") - (token == ")")
            tokens.append(token)
            ends.append(at := m.end())
        while tokens and (tokens[-1].lower() in BINDS or tokens[-1] == "("):  # "MIT and (see below)" is MIT
            tokens.pop()
        if any(t not in "()" for t in tokens):
            found.append(expression(tokens, "tag", start, ends[len(tokens) - 1]))
    return found


def joined(notices: list[dict], words: list[str]) -> list[dict]:
    """Expressions of neighbouring notices: the words between two of them are
    one operator among fillers and numbers."""
    outer: list[dict] = []
    for n in sorted(notices, key=lambda n: (n["word"], -n["words"])):
        if not outer or n["word"] >= outer[-1]["word"] + outer[-1]["words"]:
            outer.append(n)  # the longest of those that start first
    found, tokens, first = [], [], None
    for before, n in zip([None, *outer], [*outer, None], strict=True):
        operator = None
        if before and n and n["word"] - before["word"] - before["words"] <= GAP:
            between = words[before["word"] + before["words"]:n["word"]]
            operators = [w for k, w in enumerate(between) if w in BINDS and between[k + 1:k + 2] != ["later"]]
            if len(operators) == 1 and all(w in FILLERS or w in BINDS or w.isdigit() for w in between):
                operator = operators[0]
        if operator:
            tokens += [operator, n["label"]]
            continue
        if len(tokens) > 1:
            found.append(expression(tokens, "notice", first["start"], before["end"]))
        tokens, first = ([n["label"]], n) if n else ([], None)
    return found


def scan_text(text: str, phrases: ahocorasick.Automaton, tags: ahocorasick.Automaton) -> tuple[int, list[dict], list[dict]]:
    """Number of words, notices and expressions of one text; places in
    ``start`` and ``end`` are code points."""
    raw = text.encode()
    words = raw.translate(SPACED).split()
    line = b" " + b" ".join(words) + b" "
    hits = [(last, *value) for last, value in phrases.iter(line.decode("latin-1"))]  # a byte a character: places agree
    notices = []
    if hits:
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        spans = [m.span() for m in WORD.finditer(text)]
        for last, size, labels in hits:
            word = int(np.searchsorted(gaps, last)) - size
            notices += [{"label": label, "base": base, "word": word, "words": size, "start": spans[word][0], "end": spans[word + size - 1][1]}
                        for label, base in labels]
        notices.sort(key=lambda n: (n["word"], n["words"], n["label"]))
    decoded = [w.decode() for w in words] if len(notices) > 1 else []
    return len(words), notices, tagged(text, raw, tags) + joined(notices, decoded)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``notices`` (label, whether
    it is a base phrase, first word and number of words, place in code points)
    and ``expressions`` (of tags and of joined notices: tokens, postfix order,
    whether it parses, labels, duty, place).

    Null and empty texts have no words and nothing found; very long texts are
    scanned whole.  Repeated rows, null ids and other columns don't matter; an
    empty table gives no rows.  Each text is scanned alone: nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, tags = phrase_automaton(), tag_automaton()
        for batch in common.slices(batches, "text"):
            rows = [scan_text(t, phrases, tags) for t in common.texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], NOTICE), pa.array([r[2] for r in rows], EXPRESSION)],
                names=["doc_id", "n_words", "notices", "expressions"])

    return common.id_and_text(docs, id_col, text_col).mapInArrow(run, FOUND)


def digest(found: DataFrame) -> DataFrame:
    """The figures of ``scan``'s rows: ``n_base`` places of base phrases, their
    first and last word, ``base_labels`` and ``labels``, and ``score``: what the
    heaviest expression or notice asks of users (0 without any); a notice that
    is part of an expression counts with the expression."""
    base = F.filter("notices", lambda n: n["base"])
    labels = lambda of: F.array_join(F.array_sort(F.array_distinct(of)), ",")
    duty = F.create_map(*[F.lit(x) for pair in DUTIES.items() for x in pair])
    alone = F.filter("notices", lambda n: ~F.exists("expressions", lambda e: (e["start"] <= n["start"]) & (n["end"] <= e["end"])))
    heaviest = F.array_max(F.concat(F.transform(alone, lambda n: duty[n["label"]]), F.transform("expressions", lambda e: e["duty"]), F.array(F.lit(0.0))))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(F.transform(base, lambda n: n["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda n: n["word"])).alias("last_word"), labels(F.transform(base, lambda n: n["label"])).alias("base_labels"),
        labels(F.concat(F.transform("notices", lambda n: n["label"]), F.flatten(F.transform("expressions", lambda e: e["labels"])))).alias("labels"),
        heaviest.alias("score"))
