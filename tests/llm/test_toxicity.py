import math
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from waymark.llm.common import table
from waymark.llm.queries import op1_toxicity
from waymark.llm.toxicity import ToxicityModel, fit_toxicity, maximal_segments, with_toxicity

SF = "/root/testdata/sf0.01"


def brute(scores, low=0, high=None):
    """Maximal segments by definition: the best segment, then the same on either side of it."""
    high = len(scores) if high is None else high
    best = max(((sum(scores[a:b]), -(b - a), a, b) for a in range(low, high) for b in range(a + 1, high + 1)), default=(0, 0, 0, 0))
    if best[0] <= 0:
        return []
    _, _, a, b = best
    return [*brute(scores, low, a), (a, b), *brute(scores, b, high)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=14))
def test_segments_brute_force(scores):
    got = maximal_segments(np.array(scores, dtype=float))
    assert sorted(s for _, _, s in got) == sorted(sum(scores[a:b]) for a, b in brute(scores))
    assert all(s == sum(scores[a:b]) for a, b, s in got)


def brute_score(model, text):
    """The score by definition: segments of a plain recursion over runs that can't be joined, then the law and the logistic."""
    tokens = re.findall(r"\w+", (text or "").lower())
    scores = [model.words.get(t, model.stems.get(t[:4], model.drift) if len(t) > 4 else model.drift) for t in tokens]

    def segments(low, high):
        # the best segment (Kadane), then the same on either side of it
        stack, sums = [(low, high)], []
        while stack:
            low, high = stack.pop()
            best, here, start = (0.0, low, low), 0.0, low
            for i in range(low, high):
                if here <= 0:
                    here, start = 0.0, i
                here += scores[i]
                if here > best[0]:
                    best = (here, start, i + 1)
            if best[0] > 0:
                sums.append(best[0])
                stack += [(low, best[1]), (best[2], high)]
        return sums

    each = [model.decay * s - math.log(model.k * max(1, len(tokens))) for s in segments(0, len(scores))]
    strong = [x for x in each if x > 0]
    evidence = min(100.0, sum(strong)) if strong else max([min(0.0, -math.log(model.k * max(1, len(tokens)))), *each])
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, model.slope * evidence + model.intercept))))


def test_scores_by_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, "/root/testdata/sf0.001", "labels"))
    got = with_toxicity(docs, model).collect()
    assert model.slope > 0 and len(got) == 200
    for r in got:
        assert abs(r.toxicity.score - brute_score(model, r.text)) < 1e-6


def test_held_out(spark):
    rows = op1_toxicity(spark, SF).where("held_out").join(table(spark, SF, "labels"), "doc_id").select("score", "predicted", "toxic").collect()
    y = np.array([r.toxic for r in rows])
    p = np.array([r.predicted for r in rows])
    assert (p[y == 0] == 0).mean() > 0.97
    score = np.array([r.score for r in rows])
    assert (score[y == 1][:, None] > score[y == 0]).mean() > 0.8


def test_edge_cases(spark):
    model = ToxicityModel(words={"idiot": 6.0}, slope=1.0, intercept=0.0, k=0.001)
    df = spark.createDataFrame([(None, None, 1.0), (1, "", 2.0), (2, "you Idiot idiot!", 3.0), (2, "you Idiot idiot!", 3.0), (3, "fine " * 100_000, 1.0)], "doc_id long, text string, toxicity double")
    got = with_toxicity(df, model).orderBy("doc_id").collect()
    assert got[0].toxicity.score == got[1].toxicity.score
    assert got[2] == got[3] and [(s.start, s.end) for s in got[2].toxicity.spans] == [(4, 15)]
    assert got[4].toxicity.spans == [] and got[4].toxicity.score < got[2].toxicity.score
    assert with_toxicity(df.limit(0), model).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    assert with_toxicity(df, fit_toxicity(df, none)).where("toxicity.score > 0.01").count() == 0
