from waymark.llm.labelled import labelled_sample


def test_an_id_is_one_row_however_often_it_occurs(spark):
    rows = [(i, f"text {i}", "x") for i in range(400)] + [(7, "text 7", "y")] * 3_000 + [(7, "a text", "y"), (None, "gone", None), (8, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(7, 1), (7, 0), (9, None), (None, 1)] + [(8, 0)] * 5, "doc_id long, toxic int")
    got = labelled_sample(docs, labels, "toxic", 10**6).collect()
    assert sorted(r.doc_id for r in got) == list(range(400))
    assert {r.doc_id: r.text for r in got}[7] == "a text" and {r.doc_id: r.label for r in got}[7] == 1
    few = labelled_sample(docs, labels, "toxic", 10).collect()
    assert 0 < len(few) < 60 and len({r.doc_id for r in few}) == len(few)
    assert labelled_sample(docs, labels.limit(0), "toxic", 10).collect() == []
