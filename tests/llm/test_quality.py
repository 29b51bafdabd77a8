import numpy as np
import xxhash

from waymark.llm import quality
from waymark.llm.common import fold, table
from waymark.llm.quality import dual_coordinate_descent, fit_quality, with_quality
from waymark.llm.queries import op8_quality

SF = "/root/testdata/sf0.01"


def test_dual_coordinate_descent_reaches_the_primal_optimum():
    random = np.random.default_rng(3)
    x = random.normal(size=(60, 4))
    y = np.where(x[:, 0] + 0.3 * random.normal(size=60) > 0, 1.0, -1.0)
    cost = np.ones(60)
    w = dual_coordinate_descent([np.arange(4)] * 60, list(x), y, 4, cost, epochs=300)

    def primal(v):
        return 0.5 * v @ v + np.maximum(0, 1 - y * (x @ v[:4] + v[4])).sum()

    best = primal(w)
    assert all(primal(w + 0.05 * random.normal(size=5)) >= best - 1e-6 for _ in range(300))


def test_query_by_brute_force(spark):
    """Every score from n-grams as tuples of words and of shapes, counted and weighted in plain dictionaries."""
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf, "labels").where(fold("doc_id", 5) != 0))
    known = {int(k): (float(r), float(w)) for k, r, w in zip(model.keys, model.ratio, model.weight)}
    mask, m = (1 << 64) - 1, [int(x) for x in quality._MIX]
    got = {r.doc_id: r for r in op8_quality(spark, sf).collect()}
    assert len(known) > 100 and len(got) == 200
    for r in docs.collect():
        tokens = (r.text or "").split()
        words = [xxhash.xxh3_64_intdigest("w" + t.lower().strip(".,!?;:")) for t in tokens]
        shapes = [xxhash.xxh3_64_intdigest("s" + quality._shape(t)) for t in tokens]
        shapes = [xxhash.xxh3_64_intdigest("same as before") if i and words[i] == words[i - 1] else s for i, s in enumerate(shapes)]
        pairs = [(a * m[0] + b * m[1]) & mask for a, b in zip(shapes, shapes[1:])]
        found = {*words, *shapes, *pairs, *((a * m[0] + b * m[1]) & mask for a, b in zip(words, words[1:])), *((p * m[2] + s) & mask for p, s in zip(pairs, shapes[2:]))}
        own = [known[k] for k in found if k in known]
        size = sum(x * x for x, _ in own) ** 0.5 or 1.0
        margin = sum(x * w for x, w in own) / size + model.bias
        want = 1 / (1 + np.exp(-(model.slope * margin + model.intercept)))
        assert abs(got[r.doc_id].score - want) < 1e-9 and got[r.doc_id].predicted == int(want >= 0.3)


def test_held_out(spark):
    rows = op8_quality(spark, SF).where("held_out").join(table(spark, SF, "labels"), "doc_id").select("predicted", "quality").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_edge_cases(spark):
    df = spark.createDataFrame([(None, None, 9.0), (1, "", 1.0), (2, "a b", 1.0), (2, "a b", 1.0), (3, "w " * 200_000, 1.0)], "doc_id long, text string, quality_score double")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    got = with_quality(df, fit_quality(df, labels)).collect()
    assert [r.quality_score for r in got] == [0.5] * 5
    both = with_quality(df, fit_quality(df, spark.createDataFrame([(2, 1), (3, 0)], "doc_id long, quality int")))
    assert all(0 <= r.quality_score <= 1 for r in both.collect())
    assert with_quality(df.limit(0), fit_quality(df.limit(0), labels)).count() == 0
