import random

from waymark.llm.lines import dedup_lines

SCHEMA = "doc_id long, text string, row int, line string"


def edits(a, b):
    if abs(len(a) - len(b)) > 1:
        return 2
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(docs, min_words):
    """Texts after dedup, of (doc_id, text) in order of rows."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0, i))
    distinct, out = [], {}
    for i in order:
        if docs[i][1] is None:
            out[i] = None
            continue
        kept = []
        for line in docs[i][1].split("\n"):
            if not line.strip(" "):
                kept.append(line)
                continue
            words = line.split(" ")
            known = line in (x for x, _ in distinct)
            near = not known and len(words) >= min_words and any(len(w) >= min_words and edits(words, w) <= 1 for _, w in distinct)
            if not known:
                distinct.append((line, words))
                if not near:
                    kept.append(line)
        out[i] = "\n".join(kept)
    return [out[i] for i in range(len(docs))]


def test_brute_force(spark):
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(12)]
    pool = [" ".join(r.choices(vocabulary, k=r.choice([1, 3, 7, 8, 9, 16, 17, 18, 33]))) for _ in range(12)] + ["", "  ", "w1 " * 9, "w1 " * 10, "w1 " * 11]

    def line():
        words = r.choice(pool).split(" ")
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            i = r.randrange(len(words)) if words else 0
            words[i : i + 1] = r.choice([[], [r.choice(vocabulary)], [*words[i : i + 1], r.choice(vocabulary)]])
        return " ".join(words)

    docs = [(r.choice([None, *range(60)]), r.choice([None, "", *["\n".join(line() for _ in range(r.randrange(1, 7))) for _ in range(30)]])) for _ in range(60)]
    for min_words in (8, 1000):
        df = spark.createDataFrame([(d, t, i, "x") for i, (d, t) in enumerate(docs)], SCHEMA).coalesce(1)
        got = dedup_lines(df, min_words)
        assert got.columns == df.columns
        assert [x.text for x in sorted(got.collect(), key=lambda x: x.row)] == brute(docs, min_words)


def test_long_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(20_000))
    df = spark.createDataFrame([(1, text, 0, ""), (2, text.replace("w777 ", ""), 1, ""), (3, "same", 2, ""), (3, "same", 3, "")], SCHEMA).coalesce(1)
    assert [x.text for x in sorted(dedup_lines(df).collect(), key=lambda x: x.row)] == [text, "", "same", ""]
    assert dedup_lines(df.limit(0)).count() == 0


def test_plan_runs_no_python(spark):
    df = spark.createDataFrame([(1, "a", 0, "")], SCHEMA)
    plan = dedup_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "BroadcastNestedLoop" not in plan


def test_clashing_names(spark):
    names = ["row", "kept", "lines", "blank", "bucket", "_row", "_kept", "_lines", "_blank", "_bucket", "id", "at", "line", "n", "halves", "key", "place", "words"]
    df = spark.createDataFrame([(1, "a\nb\na", *range(len(names))), (2, "b\nc", *range(len(names)))], ["doc_id", "text", *names])
    got = dedup_lines(df)
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a\nb", *range(len(names))), (2, "c", *range(len(names)))]
