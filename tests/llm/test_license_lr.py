"""Licence lines planted in ordinary text: families, unknown licences, clean lines."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import license_lr as op
from tidemark.llm.frames import hashed_values
from tidemark.llm.queries import QUERIES

DOCS = "doc_id long, text string, family string, z string"


@pytest.fixture(scope="module")
def model(spark):
    return op.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_families_and_unknown(spark, model):
    cases = [(100 + i, f"{t} Ofthe tion and hely.", f) for i, (f, t) in enumerate((f, t) for f, ts in op.TEMPLATES.items() for t in ts)]
    rows = [(d, f"Thion er the.\n{t}\nAnd on.", "x", "y") for d, t, _ in cases]
    rows += [(1, "Clean text of the version we use.\nAnd more.", "", ""), (2, None, "", ""), (3, "", "", ""), (None, "a", "", ""),
             (4, "word " * 40000, "", ""), (5, "Licensed under the Foobar Software License, version 9.", "", ""),
             (6, "Released under the MIT License.\nx\nLicensed under CC BY-NC 4.0.", "", ""), (6, "x", "", "")]
    got = op.scan(spark.createDataFrame(rows, DOCS), model).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    hit = sum([(r.paragraph, r.family) for r in by[d]] == [(1, f)] for d, _, f in cases)
    assert hit >= 0.9 * len(cases)
    assert all(not r.confirmed or r.template_share >= op.TEMPLATE_SHARE for r in got)
    assert [r.family for r in by[1]] == [r.family for r in by[2]] == [r.family for r in by[3]] == [r.family for r in by[None]] == ["none"]
    assert [r.family for r in by[4]] == ["none"] and [r.family for r in by[5]] in (["unknown"], ["none"])
    assert sorted((r.paragraph, r.family) for r in by[6] if r.paragraph is not None) == [(0, "mit"), (2, "cc-by-nc")] and len(by[6]) == 3


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    notice = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0",
              "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "Licensed under CC BY-NC 4.0.": "cc-by-nc"}
    expected = {(d, i, notice[line]) for d, t in text.items() for i, line in enumerate(t.split("\n")) if line in notice}
    rows = QUERIES["op6_license_lr"](spark, sf).collect()
    got = {(r.doc_id, r.paragraph, r.family) for r in rows if r.paragraph is not None}
    assert expected and expected <= got and len(got - expected) <= 0.05 * len(expected)
    assert {r.doc_id for r in rows} == set(text)


GNU = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU {} Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version."""
#: Notices wrapped over lines as files carry them, and their families.
WRAPPED = [
    ("""Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell""", "mit"),
    ("""Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:""", "bsd"),
    ("""Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""", "isc"),
    ("""This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this""", "mpl-2.0"),
    (GNU.format("General", "3"), "gpl-3.0"),
    (GNU.format("General", "2"), "gpl-2.0"),
    (GNU.format("Lesser General", "2.1"), "lgpl"),
    (GNU.format("Affero General", "3"), "agpl-3.0"),
]


def test_wrapped_notices_and_siblings(spark, model):
    rows = [(i, f"Thion er the.\n\n \nOn and.\n\n{text}\n\nAnd on.", "x", "y") for i, (text, _) in enumerate(WRAPPED)]
    rows += [(100 + i, text.replace("\n", "\r\n"), "", "") for i, (text, _) in enumerate(WRAPPED)]
    got = {}
    for r in op.scan(spark.createDataFrame(rows, DOCS), model).where("confirmed").collect():
        got.setdefault(r.doc_id, []).append((r.paragraph, r.family))
    for i, (text, family) in enumerate(WRAPPED):
        lines = len(text.split("\n"))
        assert [f for _, f in got[i]] == [f for _, f in got[100 + i]] == [family]
        assert 5 <= got[i][0][0] < 5 + lines and got[100 + i][0][0] == got[i][0][0] - 5


def test_siblings_in_a_line(spark, model):
    cases = [("GNU Lesser General Public License version 2.1", "lgpl"),
             ("This work is licensed under the GNU General Public License, version 2.", "gpl-2.0"),
             ("Licensed under CC BY-SA 4.0.", "cc-by-sa"), ("Licensed under CC BY-NC-SA 4.0.", "unknown"),
             ("Licensed under the Eclipse Public License, version 2.0.", "unknown")]
    rows = [(i, t, "", "") for i, (t, _) in enumerate(cases)]
    got = {r.doc_id: r.family for r in op.scan(spark.createDataFrame(rows, DOCS), model).collect()}
    assert got == {i: f for i, (_, f) in enumerate(cases)}


def test_a_notice_must_not_cross_a_blank_line(spark, model):
    text = WRAPPED[1][0].replace("\n", "\n\n")
    got = op.scan(spark.createDataFrame([(1, text, "", "")], DOCS), model).collect()
    assert not any(r.confirmed for r in got)


def test_sample_of_repeated_values(spark):
    values = spark.range(40_000).selectExpr("case when id % 2 = 0 then 'one' else concat('v', id % 400) end as text")
    got = [r.text for r in hashed_values(values, 50).collect()]
    by_hash = values.distinct().orderBy(F.xxhash64("text"), "text").limit(50)
    assert got == [r.text for r in by_hash.collect()]
    assert hashed_values(values, 1000).count() == 201 and hashed_values(values.where("false"), 5).count() == 0


def test_sparse_and_calibrated(model):
    assert 10 < len(model.weights) < 250 and 0 < model.temperature < 10
    assert max(range(len(model.bias)), key=model.bias.__getitem__) == 0  # nothing known: none


def test_empty(spark):
    empty = spark.createDataFrame([], DOCS)
    assert op.scan(empty, op.fit(empty)).collect() == []
