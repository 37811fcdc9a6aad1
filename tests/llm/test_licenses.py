import random
import re

import pytest
from pyspark.sql import functions as F

from plumbline.llm import licenses as li
from plumbline.llm.license_rules import PHRASES, RULES, Rule

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

SAMPLES = [
    ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
    ("Released under the MIT License.", {"mit"}),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0)", {"mit", "apache-2.0"}),
    ("SPDX-License-Identifier: GPL-2.0-or-later", {"gpl-2.0-or-later"}),
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl", "gpl-3.0"}),
    ("GNU Lesser General Public License v2.1 or any later version", {"gpl", "lgpl-2.1-or-later"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc-4.0"}),
    ("https://creativecommons.org/licenses/by-sa/4.0/", {"cc-by-sa-4.0"}),
    ("Copyright (c) 2019-2021 Someone. All rights reserved.", {"copyright", "reserved"}),
    ("Tous droits réservés", {"reserved"}),
    ("er kam mit der Bahn, mit Apache und Mozilla", set()),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", {"bsd"}),
    ("You may obtain http://www.apache.org/licenses/LICENSE-2.0 now", {"apache-2.0"}),
]


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_base(text):
    words, out = plain_words(text), []
    for phrase, label in PHRASES:
        p = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return words, sorted(out)


def plain_labels(text, rules):
    """Every rule over the whole text, every match against every other."""
    whole = " ".join(plain_words(text)).encode().decode("latin-1")
    every = [(*m.span("at" if "at" in m.groupdict() else 0), r.priority, i) for i, r in enumerate(rules) for m in re.finditer(r.pattern, whole)]
    stands = set()
    for s, e, p, i in every:
        beaten = any((p2, -(e2 - s2), i2) < (p, -(e - s), i) and s2 <= s and e <= e2 for s2, e2, p2, i2 in every)
        if not beaten or rules[i].kind == "phrase":
            stands.add(rules[i].label)
    return ",".join(sorted(stands))


def report(df):
    found = li.scan(df)
    cols = li.summary(F.col("_found"))
    rows = found.select("_row.doc_id", F.col("_n_words").alias("n_words"), *[c.alias(k) for k, c in cols.items()]).collect()
    return sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id))


def test_rules_are_hundreds_and_bounded():
    assert len(RULES) > 400
    for rule in RULES:
        assert re._parser.parse(rule.pattern).getwidth()[1] < li.REACH - 2, rule
        assert rule.keyword in rule.pattern or rule.kind == "tag" and rule.keyword in rule.pattern, rule


@pytest.mark.parametrize("text,labels", SAMPLES)
def test_known_notices(text, labels):
    found = li.Scanner(RULES).scan("Some words before. " + text + " And some after it.")["found"]
    assert {f["label"] for f in found if f["kept"] or f["kind"] == "phrase"} == labels


def test_spans_are_words():
    found = li.Scanner(RULES).scan("one two Released under the MIT License, so. Released under the MIT License")["found"]
    assert [(f["first_word"], f["end_word"], f["kind"]) for f in found if f["kept"]] == [(2, 7, "notice"), (8, 13, "notice")]


def test_against_every_rule_on_whole_texts(spark):
    rnd = random.Random(3)
    parts = [t for t, _ in SAMPLES] + [r.keyword for r in RULES[::9]] + ["cc by cc by nc", "GPL-2.0", "0", "é", "\n", "license", "ALL  RIGHTS\treserved", "x" * 700]
    texts = [" ".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(60)]
    texts += [None, "", " \n ", "All rights reserved", "Kall rights reserved", "cc-by", "cc by " * 500, " mit license"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r, text in zip(report(df), texts):
        words, base = plain_base(text)
        assert r.n_words == len(words) and r.n_base == len(base)
        assert (r.first_word, r.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({b for _, b in base}))
        assert r.labels == plain_labels(text, RULES)
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")


def test_priority_and_containment(spark):
    rules = (Rule("wide", "b", "a b c d", "name", 2, 0.5), Rule("strong", "b", "b c", "tag", 0, 1.0), Rule("inner", "c", "c", "name", 2, 0.5), Rule("tie", "b", "a b c d", "name", 2, 0.4))
    found = li.Scanner(rules).scan("a b c d")["found"]
    assert {f["label"]: f["kept"] for f in found} == {"wide": True, "strong": True, "inner": False, "tie": False}


def test_edges(spark):
    schema = "doc_id long, text string, _scan string, n_words int, _found int, _row int"
    rows = [(1, "MIT License", "x", 5, 6, 7), (1, "MIT License", "x", 5, 6, 7), (None, None, None, None, None, None)]
    found = li.scan(spark.createDataFrame(rows, schema))
    assert found.select("_row.*").columns == ["doc_id", "text", "_scan", "n_words", "_found", "_row"]
    assert sorted((r._row.n_words, len(r._found)) for r in found.where("_row.doc_id = 1").collect()) == [(5, 1), (5, 1)]
    assert [(r._n_words, r._found) for r in found.where("_row.doc_id is null").collect()] == [(0, [])]
    assert li.scan(spark.createDataFrame([], schema)).count() == 0


def test_query_on_all_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = li.op11_licenses(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words, base = plain_base(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.labels) == (len(words), len(base), plain_labels(texts[r.doc_id], RULES))
