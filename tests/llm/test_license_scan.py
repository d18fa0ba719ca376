import itertools
import random
import re

import pytest

from tierforge.llm.license_scan import BASE_PHRASES, _GATE, op7_license_scan, scan_licenses, signature_rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute_base(text):
    words = words_of(text)
    hits = []
    for phrase, label in BASE_PHRASES:
        parts = phrase.split()
        hits += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), sorted(hits)


def brute_kept(text):
    joined = " " + " ".join(words_of(text)) + " "
    spans = []
    for no, rule in enumerate(signature_rules()):
        for m in re.finditer(rf" (?:{rule.pattern})(?= )", joined):
            start = joined[: m.start()].count(" ")
            spans.append((start, start + m[0].count(" "), rule.priority, no, rule))
    kept = []
    for s in spans:
        over = any(
            t is not s and t[0] <= s[0] and t[1] >= s[1]
            and (t[2] < s[2] or t[2] == s[2] and ((t[0], -t[1], t[3]) < (s[0], -s[1], s[3])))
            for t in spans
        )
        if s[4].base or not over:
            kept.append((s[0], s[1], s[4].label))
    return sorted(kept)


TEXTS = [
    None, "", "   ", "!!!", "mit license", "MIT License", "the MIT-License, mit license mit\nlicense",
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "GNU Affero General Public License v3 or the GNU General Public License version 2 or any later version",
    "Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: Apache-2.0", "éMIT license", "MIT\x00License",
    "summit license", "mit licensee", "All rights reserved. Copyright (c) 2020 X", "KK MIT license İ",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "x " * 5000 + "mit license " * 40 + "general public license",
]


def test_rules_are_many_and_gated():
    rules = signature_rules()
    assert len(rules) > 250
    for rule in rules:
        assert re.match(r"[a-z0-9]", rule.keyword)


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = "mit apache gpl license licence general public version 2 0 3 gnu the under licensed cc by sa nc 4 bsd x".split()
    texts = TEXTS + [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(60)]
    docs = spark.createDataFrame(
        [(i, t, "x", [1]) for i, t in enumerate(texts)], "doc_id long, text string, n_words string, detections array<int>"
    )
    for row in scan_licenses(docs).collect():
        text = texts[row.doc_id]
        n, base = brute_base(text)
        assert row.n_words == n
        assert sorted((d.start, d.label) for d in row.detections if d.base) == base
        assert sorted((d.start, d.end, d.label) for d in row.detections) == brute_kept(text), text


def test_gate_loses_no_match():
    for text in TEXTS:
        if brute_kept(text):
            assert re.search(_GATE, " " + " ".join(words_of(text)) + " "), text


def test_query_columns_and_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = op7_license_scan(spark, str(tmp_path))
    assert out.columns[:8] == [
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
    ]
    assert out.count() == 0
    spark.createDataFrame([(None, None), (1, "mit license")], "doc_id long, text string").write.parquet(str(tmp_path / "b/documents.parquet"))
    rows = {r.doc_id: r for r in op7_license_scan(spark, str(tmp_path / "b")).collect()}
    assert (rows[None].n_words, rows[None].n_base, rows[None].first_word, rows[None].labels) == (0, 0, None, "")
    assert (rows[1].first_word, rows[1].last_word, rows[1].base_labels) == (0, 0, "mit") and rows[1].score == pytest.approx(0.8)


def alternatives(items, all_of_them):
    """Texts that the parsed pattern matches: all, or as few as show each alternative once. Digits are 1."""

    def each(op, arg):
        if str(op) == "LITERAL":
            return [chr(arg)]
        if str(op) == "IN":
            return ["1" if str(o) == "CATEGORY" else chr(a) for o, a in arg]
        if str(op) == "BRANCH":
            return [text for branch in arg[1] for text in alternatives(branch, all_of_them)]
        if str(op) == "SUBPATTERN":
            return alternatives(arg[3], all_of_them)
        assert str(op) == "MAX_REPEAT", op
        return [""] * (arg[0] == 0) + alternatives(arg[2], all_of_them)

    parts = [each(op, arg) for op, arg in items]
    if all_of_them:
        return ["".join(chosen) for chosen in itertools.product(*parts)]
    most = max(map(len, parts), default=1)
    return ["".join(part[i % len(part)] for part in parts) for i in range(most)]


def test_every_alternative_has_a_keyword_and_passes_the_gate():
    for rule in signature_rules():
        for text in alternatives(re._parser.parse(rule.pattern), True):
            assert any(k in text for k in rule.keyword.split("|")), (rule.label, text)
            assert re.search(_GATE, f" {text} "), (rule.label, text)


def test_every_alternative_is_found(spark):
    texts = [text for rule in signature_rules() for text in alternatives(re._parser.parse(rule.pattern), False)]
    texts = sorted({*texts, "distributed on an as is basis without warranties or conditions of any kind either express or implied"})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    for row in scan_licenses(docs).collect():
        found = sorted((d.start, d.end, d.label) for d in row.detections)
        assert found and found == brute_kept(row.text), row.text


def test_very_many_detections(spark):
    text = "mit license x apache license " * 6000
    row = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    n, base = brute_base(text)
    assert row.n_words == n
    assert [(d.start, d.label) for d in row.detections if d.base] == base
