import pytest
from oracle import duck

from waymark.llm.licenses import TEMPLATES, licenses, scan
from waymark.llm.queries import ORACLE_SQL

SCHEMA = "doc_id long, text string, row string, words int"


def told(spark, texts):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r for r in licenses(docs).collect()}


def test_phrases(spark):
    got = told(spark, ["All rights reserved. CC-BY; cc  by/CC\nBY all", "GENERAL public licenses, general public", None, "", "cc by cc by cc by", "all all rights reserved reserved"])
    assert [(got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels) for i in range(6)] == [
        (10, 4, 0, 7, "cc-by,reserved"), (5, 0, None, None, ""), (0, 0, None, None, ""), (0, 0, None, None, ""), (6, 3, 0, 4, "cc-by"), (5, 1, 1, 1, "reserved"),
    ]


def test_words_are_cut_by_ascii_alone(spark):
    got = told(spark, ["ALL rights reserved", "É All Rights\tReserved ümlaut", "all_rights`reserved", "𝒳 cc by"])
    assert [(got[i].n_words, got[i].n_base) for i in range(4)] == [(2, 0), (5, 1), (3, 1), (3, 1)]


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under the MIT License.", "mit"),
        ("It is released under the terms of the MIT License, see there", "mit"),
        ("Released under the BSD license", "bsd"),
        ("Licensed under the Artistic License, Version 2.0.", ""),
        ("Licensed under the Apache License, Version 2.0 (the License)", "apache"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
        ("under the terms that all have agreed on", ""),
        ("Permission is hereby granted, free of charge, to any person obtaining copies of this software and the associated documentation files to deal in the Software without any restriction", "mit"),
        ("Redistribution and use in source or binary forms, with or without modification, are permitted provided that all the following conditions are met:", "bsd"),
    ],
)
def test_wordings_with_words_put_in_and_taken_out(spark, text, labels):
    assert told(spark, ["some words before " + text + " and after"])[0].labels == labels


def test_copies_that_follow_each_other_stay_apart(spark):
    docs = spark.createDataFrame([(1, "released under the mit license " * 2_000, None, None)], SCHEMA)
    (row,) = scan(docs).collect()
    assert len(row.spans) == 2_000 and {s.words for s in row.spans} == {5} and row.n_words == 10_000


def test_every_template_is_found_whole(spark):
    got = told(spark, [t.text.upper() for t in TEMPLATES])
    assert all(t.label in got[i].labels.split(",") and got[i].score == 1.0 for i, t in enumerate(TEMPLATES))


def test_small_tables_against_sql(spark):
    rows = [(1, "All rights reserved, released under a MIT license", "x", 1), (1, "All rights reserved, released under a MIT license", "x", 1), (None, None, None, None), (2, "", "", 0), (3, "cc by nc 4 0 cc by sa licensed under cc by", "y", 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    con = duck("/root/testdata/sf0.001")
    con.sql("DROP VIEW documents")
    frame = docs.toArrow()
    con.register("documents", frame)
    columns = sorted(licenses(docs).columns)
    want = con.sql(ORACLE_SQL["op13_license"]).project(", ".join(columns)).fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in licenses(docs).collect()))) == sorted(map(repr, want))
    assert licenses(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = licenses(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))
