"""Lexical search against a plain version."""

import math
import random
import re
from collections import Counter

from tickstone.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, rank int, score string, item string"
ITEMS = "item_id long, text string, doc_id string"


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k=10):
    texts = [(i, Counter(plain_terms(t))) for i, t in docs]
    texts = [(i, c) for i, c in texts if c]
    n_docs, n_terms = len(texts), sum(c.total() for _, c in texts)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_terms(text))
    df = Counter(t for _, c in texts for t in c)
    out = []
    for item, own in wanted.items():
        scores = []
        for i, c in texts:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scores.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


def tables(spark, docs, items):
    docs = spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in docs], DOCS).repartition(5)
    return docs, spark.createDataFrame([(i, t, "clash") for i, t in items], ITEMS)


def got(spark, docs, items, **options):
    return sorted((tuple(r) for r in search.search(*tables(spark, docs, items), **options).collect()), key=repr)


def test_search_equals_a_plain_version(spark):
    rnd = random.Random(11)
    words = ["the", "The", "cat's", "über", "Über", "ÜBER", "x1", "日本", "a", "a-b", "e f", "🙂", "zz", "q\x00r", *"bcdefgh"]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice([" ", ", ", "\n", "  "]) for _ in range(n))
    docs = [(i, text(rnd.randint(0, 30))) for i in range(150)]
    docs += [(None, text(8)), (None, "the cat"), (7, docs[7][1]), (8, docs[9][1]), (200, None), (201, ""), (202, "--"), (203, text(20_000))]
    items = [(i, text(rnd.randint(1, 6))) for i in range(20)] + [(3, "über zz"), (None, "cat b"), (30, None), (31, "nowhere"), (4, "c")]
    want = plain_search(docs, items)
    assert got(spark, docs, items) == want
    assert got(spark, docs, items, term_bytes=60) == want  # many shards
    assert got(spark, docs, items, k=1) == plain_search(docs, items, 1)


def test_equal_scores_go_by_id_and_repeated_rows_stay(spark):
    docs = [(i, "one two") for i in (9, 3, 3, 5)] + [(1, "other")]
    assert [(r, d) for _, r, d, _ in got(spark, docs, [(0, "two")], k=3)] == [(1, 3), (2, 3), (3, 5)]


def test_tasks_cut_what_they_hold(spark, monkeypatch):
    best = search.Best(2, 3)
    monkeypatch.setattr(search, "HELD", 10)
    rnd = random.Random(2)
    rows = [(rnd.randrange(3), rnd.randint(1, 9), doc) for doc in range(400)]
    for item, score, doc in rows:
        best.add(search.np.array([item]), search.np.array([score]), doc, False)
    kept = [(int(i), int(s), int(d)) for i, s, _, d in best.cut().T]
    assert kept == [r for item in range(3) for r in sorted((r for r in rows if r[0] == item), key=lambda r: (-r[1], r[2]))[:2]]


def test_search_without_rows(spark):
    assert got(spark, [], [(1, "a")]) == [] and got(spark, [(1, "a")], []) == []
    assert got(spark, [(1, None)], [(1, "a"), (2, None)]) == []
