import random
import re
from collections import Counter

import numpy as np

from waymark.llm.common import table
from waymark.llm.decontaminate import with_matches
from waymark.llm.queries import op5_decontaminate

SF = "/root/testdata/sf0.001"


def bag(words):
    k = min(5, len(words))
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else Counter()


def brute(text, item):
    """Best similarity of an item-sized window."""
    words, own = re.findall(r"\w+", (text or "").lower()), re.findall(r"\w+", (item or "").lower())
    b, best = bag(own), 0.0
    for i in range(len(words) - len(own) + 1 if own else 0):
        a = bag(words[i : i + len(own)])
        if a & b:
            best = max(best, sum((a & b).values()) / sum((a | b).values()))
    return best


def pairs(df):
    return {(r.doc_id, m.item_id): m.similarity for r in df.collect() for m in r.matches}


def test_query_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    items = {r.item_id: r.text for r in table(spark, SF, "benchmark").collect()}
    want = {}
    for d, text in docs.items():
        grams = set(bag(re.findall(r"\w+", text.lower())))
        for i, item in items.items():
            if grams & set(bag(re.findall(r"\w+", item.lower()))) and (s := brute(text, item)) >= 0.8:
                want[d, i] = s
    got = {(r.doc_id, r.item_id): r.similarity for r in op5_decontaminate(spark, SF).collect()}
    assert got.keys() == want.keys() and want
    assert all(np.isclose(got[k], want[k]) for k in want)


def test_edited_passages(spark):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([3, 20, 45, 60])))) for i in range(30)]
    docs = []
    for k in range(120):
        words = r.choice(items)[1].split()
        for _ in range(k % 4):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        docs.append((k, " ".join([*r.choices(vocabulary, k=30), *words, *r.choices(vocabulary, k=30)]), k))
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    want = {(d, i): s for d, t, _ in docs for i, x in items if (s := brute(t, x)) >= 0.8}
    got = pairs(with_matches(df, spark.createDataFrame(items, "item_id long, text string")))
    assert got.keys() == want.keys()
    small = pairs(with_matches(df, spark.createDataFrame(items, "item_id long, text string"), block_chars=500))
    assert small == got


def test_texts_shorter_than_items(spark):
    """Clipped items alone in a text, some edited; the whole text is the window."""
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(r.choices(vocabulary, k=k))) for i, k in enumerate([3, 5, 6, 20, 45, 50, 50, 60, 200])]
    docs = []
    for _, text in items:
        words = text.split()
        for cut in (0, 1, 2, 5, 10, 11, len(words) // 5, len(words) // 2):
            for own in (words[cut:], words[: len(words) - cut], words[cut // 2 : len(words) - cut + cut // 2]):
                docs.append((len(docs), " ".join(own)))
                if len(own) > 20:
                    docs.append((len(docs), " ".join([*own[:7], "other", *own[8:]])))

    def best(text, item):
        a, b = bag(text.split()), bag(item.split())
        return max(brute(text, item), sum((a & b).values()) / sum((a | b).values()) if a and len(text.split()) < len(item.split()) else 0.0)

    want = {(d, i): s for d, t in docs for i, x in items if (s := best(t, x)) >= 0.8}
    df = with_matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = pairs(df)
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k]) for k in want)
    lengths = {d: len(t.split()) for d, t in docs}
    assert any(lengths[d] < len(items[i][1].split()) for d, i in want)
    assert all(m.n_words == min(lengths[r.doc_id], len(items[m.item_id][1].split())) for r in df.collect() for m in r.matches)


def test_edge_cases(spark):
    docs = spark.createDataFrame([(None, None, 1), (1, "", 1), (2, "one two three four five six", 1), (2, "one two three four five six", 1), (3, "two three", 1)], "doc_id long, text string, matches int")
    items = spark.createDataFrame([(7, "one two three four five six"), (None, "Two, three!"), (8, None), (9, ""), (10, "one two three four five six")], "item_id long, text string")
    got = with_matches(docs, items).collect()
    assert [[m.item_id for m in r.matches] for r in got] == [[], [], [7, 10, None], [7, 10, None], [None]]
    assert with_matches(docs.limit(0), items).count() == 0
    assert all(r.matches == [] for r in with_matches(docs, items.limit(0)).collect())


def test_blocks_of_items_follow_each_other(spark):
    """Many small blocks, each with a broadcast of its own, give what one gives."""
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    docs = docs.withColumn("_found", docs["doc_id"])
    chars = sum(len(r.text) for r in items.collect())
    one, many = with_matches(docs, items), with_matches(docs, items, block_chars=chars // 5)
    assert many.columns == one.columns and pairs(many) == pairs(one) != {}
    assert many.where("_found <> doc_id").count() == 0
