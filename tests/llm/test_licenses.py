"""The license scan against a double loop over all detections."""

import random
import re

import brute
import pytest

from marketlake.llm import licenses
from marketlake.llm.queries import QUERIES

TEXTS = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "This is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
    "Foundation, either version 3 of the License, or (at your option) any later version.", "GNU General Public License, version 2 or any later version",
    "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: MIT", "released under the MIT license", "CC BY 4.0, cc by cc by", "CC-BY-NC-SA 3.0",
    "All rights reserved. all RIGHTS reserved all rights", "copyright 2020 all rights reserved", "LGPL v2.1 only", "GPLv3", "mit der Hand", "cc", "by cc",
    "Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "Creative Commons Attribution ShareAlike license 3.0", "general public license",
    "General Public License", "é all rights reserved", "allrights reserved", "permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "Mozilla Public License Version 2.0 or the Eclipse Public License 1.0", "", None, " \n.,", "a" * 100_000 + " cc by", "all rights reserved " * 3_000,
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("licenses"))
    rng = random.Random(7)
    words = [w for t in TEXTS if t and len(t) < 400 for w in re.findall(r"\S+", t)]
    texts = TEXTS + [" ".join(rng.choice([rng.choice(words), rng.choice(TEXTS[:20])]) for _ in range(12)) for _ in range(60)]
    rows = [(i, t, "en", "r", 1, "k", "l", 2) for i, t in enumerate(texts)] + [(None, "cc by", None, "r", 1, "k", "l", 2), (0, TEXTS[0], None, "r", 1, "k", "l", 2)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, row string, n_words int, keys string, line string, label int"
                          ).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path, rows


def test_labels_equal_a_double_loop(spark, folder):
    path, rows = folder
    rules = licenses.rules()
    want = sorted(str((r[0], *brute.licenses(r[1], rules, licenses.WEIGHTS))) for r in rows)
    assert sorted(str(tuple(r)) for r in QUERIES["op13_licenses"](spark, path).collect()) == want


def test_labels_of_known_texts(spark, folder):
    got = {r["doc_id"]: r["labels"] for r in QUERIES["op13_licenses"](spark, folder[0]).collect()}
    want = {3: "gpl-2.0-or-later", 4: "mit", 5: "mit", 7: "cc-by,cc-by-nc-sa-3.0", 8: "reserved", 9: "copyright,reserved", 10: "lgpl-2.1-only", 11: "gpl-3.0",
            12: "", 13: "", 14: ""}
    assert {i: got[i] for i in want} == want


def test_keywords_are_words_of_every_match():
    """The prefilter loses nothing: a rule's keyword is a whole word outside all options and choices of its expression."""
    for rule in licenses.rules():
        plain = rule.words
        while re.search(r"\([^()]*\)", plain):
            plain = re.sub(r"\([^()]*\)(\?|\{[^}]*\})?", "|", plain)
        either = rule.words if plain == "|" else plain
        assert re.search(rf"(?<![0-9a-z\[\]?]){rule.keyword}(?![0-9a-z\[\]?])", either), rule


def test_no_python_in_the_plan(spark, folder):
    plan = QUERIES["op13_licenses"](spark, folder[0])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)
