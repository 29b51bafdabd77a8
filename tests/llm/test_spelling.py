import random
import re
import zlib
from collections import Counter, defaultdict

from waymark.llm.queries import QUERIES
from waymark.llm.spelling import keys, near_words, prefix_and_pivots, spelling_variants, vocabulary

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, run string, n int"


def brute_words(rows, length=7, least=2):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= length:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= least}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def brute(words, ratio=10):
    lists = defaultdict(set)
    for w in words:  # words of one list may be near; equal variants hold all pairs
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            lists[v].add(w)
    about = defaultdict(set)
    for found in lists.values():
        for a in found:
            about[a] |= {b for b in found if near(a, b)}
    form = {}
    for w, n in words.items():
        best = min(about[w], key=lambda b: (-words[b], b), default=None)
        if best is not None and words[best] >= ratio * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(about[w]), words.get(form.get(w))) for w, n in words.items()}


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in QUERIES["op11_spelling"](spark, SF).collect()]
    want = brute(brute_words(rows))
    assert len(got) == len(want) and set(got) == want and any(r[4] for r in want)


def test_words_of_few_letters_repeats_and_chains(spark):
    random.seed(4)
    words = {"".join(random.choice("abé") for _ in range(random.randint(0, 7))): random.choice([1, 2, 30, 400, 5000]) for _ in range(700)}
    words |= {"aaaaaaaa": 1, "aaaaaaa": 10, "aaaaaaaaa": 100, "a": 7, "": 1, "ab": 70, "𝒳bcdefg": 2, "Ybcdefg": 90}
    found = spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    got = {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in found.collect()}
    assert got == brute(words)
    assert any(root not in (word, form) for word, form, root, *_ in got)


def test_no_pair_is_lost_when_the_order_is_anything():
    random.seed(9)
    order = [random.randint(0, 3) for _ in range(1 << 16)]

    def listed(word):
        text = f"\x01\x01{word}\x02\x02"
        prefix, pivots, last = prefix_and_pivots(text, order)
        assert len(pivots) == 2 and abs(pivots[0] - pivots[1]) >= 2 and set(pivots) <= set(prefix)
        return {k for p in pivots for k in keys(text, p)}, {k for p in prefix for k in keys(text, p)}, last

    for _ in range(20_000):
        a = "".join(random.choice("abcd") for _ in range(random.randint(1, 14)))
        i = random.randrange(len(a))
        b = random.choice([a[:i] + a[i + 1 :], a[:i] + random.choice("abcdx") + a[i:], a[:i] + random.choice("abcdx") + a[i + 1 :]])
        (pa, xa, ea), (pb, xb, eb) = listed(a), listed(b)
        assert (ea <= eb and pa & xb) or (eb <= ea and pb & xa), (a, b)


def test_nulls_empty_texts_and_further_columns(spark):
    long = "Wörterbuch wörterbuch " * 30_000
    rows = [(1, None, "x", 1), (None, "Letters letters LETTERS", "y", 2), (3, "", None, None), (4, long, "z", 3), (4, "lettersx letters", "z", 3), (4, "lettersx letters", "z", 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    words = vocabulary(docs)
    assert {r.word: r.n for r in words.collect()} == brute_words([r[:2] for r in rows])
    empty = spark.createDataFrame([], SCHEMA)
    assert spelling_variants(vocabulary(empty)).collect() == []
    assert near_words(spark.createDataFrame([("abc",)], "word string")).collect() == []
