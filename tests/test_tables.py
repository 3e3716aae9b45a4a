"""Joins, aggregates, top-k, partitioning, sentiment and filters on small frames."""

from datetime import date, datetime

import numpy as np
import pytest
from conftest import at, rows

from tickstone.functions import bloom
from tickstone.operators import aggregates, filters, joins, mentions, partitioning, sentiment, topk


def test_asof_join(spark):
    prices = spark.createDataFrame(
        [("A", at("2024-01-01 10:00"), 1.0), ("A", at("2024-01-03 10:00"), 2.0), ("B", at("2024-01-01"), 9.0)],
        "k string, ts timestamp_ntz, price double",
    )
    events = spark.createDataFrame(
        [("A", at("2024-01-01 09:00"), "before"), ("A", at("2024-01-01 10:00"), "same"),
         ("A", at("2024-01-02 23:00"), "later day"), ("A", at("2024-01-09"), "last"), ("C", at("2024-01-09"), "no key")],
        "k string, ts timestamp_ntz, name string",
    )
    want = [("last", 2.0), ("later day", 1.0), ("same", 1.0)]
    for parts in (None, 3):
        assert rows(joins.asof_join(events, prices, "k", "ts", "price", parts=parts), "name", "price") == want


def test_mention_grams_are_made_distinct_and_texts_lowered_once(spark):
    rng = np.random.default_rng(1)
    hashes, starts = rng.integers(0, 9, 500).astype(np.uint64) + np.uint64(1 << 63), np.array([0, 0, 100, 420])
    at = np.flatnonzero(hashes % np.uint64(2) == 0)
    got = mentions._distinct(hashes, at, starts)
    assert sorted(zip(*(x.tolist() for x in got), strict=True)) == sorted({(int(np.searchsorted(starts, i, side="right")) - 1, int(hashes[i])) for i in at})
    assert all(x.size == 0 for x in mentions._distinct(hashes, at[:0], starts))
    for texts in (["abab", "", "\U0010ffffé\0a"], ["", ""], ["x"], [""]):
        for n in (1, 2):
            codes, begin = mentions._codes(texts)
            every = mentions.gram_hashes(codes, n)
            short = mentions._short_grams(codes, begin, n)
            where = np.searchsorted(begin, np.arange(every.size), side="right") - 1
            assert sorted(zip(*(x.tolist() for x in short), strict=True)) == sorted(set(zip(where.tolist(), every.tolist(), strict=True)))
    posts = spark.createDataFrame([(1, "Buy AAPL", None)], "id bigint, title string, content string")
    found = joins.mention_join(posts, spark.createDataFrame([("aapl",)], "ticker string"), "id")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    tests = [line for line in plan.splitlines() if "contains(" in line.lower()]
    assert tests and not any("lower(title" in line or "coalesce(title" in line for line in tests)
    assert rows(found) == [(1, "Buy AAPL", None, "aapl")]


def test_mentions_by_every_way(spark):
    posts = spark.createDataFrame(
        [(1, "Buy aapl now", "and TSLA"), (2, "nothing", None), (3, "x", "brk.b rises"), (4, "TS", "LA"), (5, None, "é tsLa")],
        "id bigint, title string, content string",
    )
    words = spark.createDataFrame([("AAPL",), ("TSLA",), ("BRK.B",), ("x",), ("",), ("Verylongname",)], "ticker string")
    want = sorted([(1, "AAPL"), (1, "TSLA"), (3, "BRK.B"), (3, "x"), (5, "TSLA")], key=repr)
    assert rows(joins.mention_join(posts, words, "id"), "id", "ticker") == want
    long = words.where("length(ticker) > 3")
    assert rows(joins.mention_join(posts, long, "id"), "id", "ticker") == [w for w in want if len(w[1]) > 3]
    odd = spark.createDataFrame([(None, "aapl", ""), (7, "x", None), (7, "Tsla", "aapl")], "id int, title string, content string")
    many = words.union(spark.range(3000).selectExpr("concat('word', id)"))
    got = rows(joins.mention_join(odd, many.where("length(ticker) > 1"), "id"), "id", "ticker")
    assert got == sorted([(None, "AAPL"), (7, "AAPL"), (7, "TSLA")], key=repr)
    assert joins.mention_join(posts, words.limit(0), "id").isEmpty()


def test_mentions_with_null_and_repeated_keys(spark):
    posts = spark.createDataFrame(
        [(None, "Buy aapl", None, "s", "z"), (None, "tsla!", "x\0y", "s", "z"), (7, "aapl", "é", "s", "z"), (7, "aapl", "é", "s", "z"),
         (7, "TSLA", "", "t", "z"), (8, None, None, "t", "z"), (9, "a", "apl", "t", "z"), (10, "ÉÉ Straße " * 5000, "日本株", "t", "z")],
        "id int, title string, content string, source string, gram string",
    )
    words = ["AAPL", "aapl", "TSLA", "TSLA", None, "", "é", "É", "本株", "straße éé s", "nowhere", "x\0y", "a"]
    keywords = spark.createDataFrame([(w,) for w in words], "ticker string")
    want = []
    for post in posts.collect():
        texts = [(post.title or "").lower(), (post.content or "").lower()]
        want += [(*post, w) for w in {w for w in words if w} if any(w.lower() in t for t in texts)]
    assert rows(joins.mention_join(posts, keywords, "id")) == sorted(want, key=repr)
    assert len(want) == 24


def test_a_short_keyword_leaves_the_candidates_of_long_ones(spark, monkeypatch):
    """Candidates are pairs that meet on a gram, before the test in full."""
    met = []
    real = mentions.settled
    monkeypatch.setattr(mentions, "settled", lambda df: met.append(real(df)) or met[-1])
    posts = spark.range(300).selectExpr("id", "concat('post ', id, ' of Company', id % 50) as title", "'a b c' as content")
    long = spark.range(50).selectExpr("concat('company', id) as ticker")
    seen = []
    for words in (long, long.union(spark.range(1).selectExpr("'p'"))):
        met.clear()
        found = joins.mention_join(posts, words, "id").where("ticker <> 'p'").count()
        index = met[-1].where("ticker <> 'p'")
        seen.append((found, sorted(tuple(r) for r in index.collect())))
    assert seen[0] == seen[1] and len(seen[0][1]) == 50


def test_bloom_filters_find_what_they_hold(spark, monkeypatch):
    rng = bloom.np.random.default_rng(4)
    own, other = (rng.integers(-(2**63), 2**63, 3000) for _ in range(2))
    df = spark.createDataFrame([(int(h),) for h in own], "h long")
    few = bloom.Bloom.of(df, "h")
    monkeypatch.setattr(bloom, "FEW", 10)
    for built in (few, bloom.Bloom.of(df, "h")):
        assert built.has(own.view("uint64")).all() and built.has(other.view("uint64")).mean() < 0.05
    assert (built.words == few.words).all()
    full = bloom.Bloom.of(df, "h", most_bits=1 << 10)
    assert full.has(own.view("uint64")).all() and full.words.size == 16
    assert not bloom.Bloom.of(df.limit(0), "h").has(own.view("uint64")).any()


def test_keywords_are_filed_under_their_rarest_gram(spark, monkeypatch):
    met = []
    real = mentions.settled
    monkeypatch.setattr(mentions, "settled", lambda df: met.append(real(df)) or met[-1])
    posts = spark.createDataFrame([(i, "abcdefgh" + ("ij" if i == 3 else ""), "") for i in range(20)], "id int, title string, content string")
    words = spark.createDataFrame([("abcdefghij",), ("abcdefgh",), ("abcdefghx",)], "ticker string")
    assert rows(joins.mention_join(posts, words, "id"), "ticker", "id") == sorted([("abcdefghij", 3), *(("abcdefgh", i) for i in range(20))], key=repr)
    hashes = mentions.gram_hashes(mentions._codes(["abcdefghij"])[0], 8).view("int64")
    index = dict(tuple(r) for r in met[-1].collect())
    assert index.keys() == {"abcdefghij", "abcdefgh"} and index["abcdefgh"] == hashes[0] and index["abcdefghij"] in hashes[1:]


def test_committed_and_failed(spark):
    lines = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "id int, v string")
    done = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    assert rows(joins.committed_only(lines, done, "id"), "v") == [("a",), ("b",), ("d",)]
    payments = spark.createDataFrame([(1, "failed"), (1, "paid"), (2, "paid")], "id int, status string")
    assert rows(joins.drop_failed(lines, payments, "id"), "v") == [("c",), ("d",)]


def test_ranked_filters_prune_before_the_exchange(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as ts")
    for ranked in (topk.last_n(df, "k", "ts", 2), topk.latest_per_key(df, "k", "ts")):
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") == 2
    assert rows(topk.last_n(df, "k", "ts", 2), "k", "ts") == [(0, 96), (0, 99), (1, 94), (1, 97), (2, 95), (2, 98)]
    assert rows(topk.last_n(df, "k", "ts", 1, of=1), "ts") == [(97,)]
    assert topk.head(df, 5).count() == 5


def test_baseline_of_the_newest_rows(spark):
    df = spark.createDataFrame([("A", i, float(i)) for i in range(30)] + [("B", 1, 5.0)], "k string, ts int, p double")
    assert rows(topk.recent_baseline(df, "k", "ts", {"avg_p": "p"})) == [("A", 19.5), ("B", 5.0)]


def test_upsert_prefers_the_new_count(spark):
    old = spark.createDataFrame([("a", 5), ("b", 6)], "k string, cnt bigint")
    new = spark.createDataFrame([("b", 1), ("c", 2)], "k string, cnt bigint")
    assert rows(aggregates.merge_counts(old, new, ["k"])) == [("a", 5), ("b", 1), ("c", 2)]


def test_order_documents(spark):
    kind = "order_id string, products array<struct<product_id: string, price: bigint, quantity: int, amount: bigint>>"
    orders = spark.createDataFrame(
        [("o1", [("p1", 100, 2, 200), ("p2", 50, 1, 50)]), ("o1", [("p3", 1, 1, 1)]), ("o2", [])], kind
    )
    assert rows(aggregates.order_rollup(orders)) == [("o1", 3, 251), ("o2", 0, 0)]
    assert rows(aggregates.order_lines(orders), "order_id", "line", "product_id") == [
        ("o1", 1, "p1"), ("o1", 1, "p3"), ("o1", 2, "p2")
    ]


def test_partition_rules(spark):
    df = spark.createDataFrame([("KR-1",), ("US-1",), ("JP-1",), ("DE-1",), (None,)], "key string")
    got = dict(rows(partitioning.assign_partition(df, "key", 4, partitioning.REGION_RULES), "key", "partition"))
    assert (got["KR-1"], got["US-1"], got["JP-1"], got[None]) == (0, 1, 2, 0) and 0 <= got["DE-1"] < 4
    assert partitioning.co_locate(df, "key", 3).rdd.getNumPartitions() == 3


def test_sentiment_labels_and_alerts(spark):
    texts = spark.createDataFrame(
        [(1, "A", "Good good", "day"), (2, "B", "bad", None), (3, "C", "", ""), (4, "D", "meh", "meh")],
        "id int, ticker string, title string, content string",
    )
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -3.0)], "token string, valence double")
    scores = sentiment.sentiment(texts, lexicon, "id")
    got = {r.id: (round(r.sentiment_score, 4), r.sentiment_label) for r in scores.collect()}
    assert got == {1: (0.7184, "positive"), 2: (-0.6124, "negative"), 3: (0.0, "neutral"), 4: (0.0, "neutral")}
    results = sentiment.sentiment_results(texts, scores, "id", ["ticker", "title"])
    assert rows(sentiment.sentiment_alerts(results), "message") == [("A 매우 긍정적 뉴스: Good good",), ("B 매우 부정적 뉴스: bad",)]


def test_sentiment_limits(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.5,), (0.0,)], "sentiment_score double")
    labelled = df.withColumn("l", sentiment.label("sentiment_score"))
    assert rows(labelled, "l") == [("negative",), ("neutral",), ("positive",), ("positive",)]
    alerts = sentiment.sentiment_alerts(df.selectExpr("*", "'T' as ticker", "'t' as title"))
    assert alerts.isEmpty()


def test_filters(spark):
    df = spark.createDataFrame(
        [("a", at("2024-01-01 00:00")), ("b", at("2024-01-02 15:00")), ("c", at("2024-01-03 00:00"))],
        "k string, ts timestamp_ntz",
    )
    assert rows(filters.in_days(df, "ts", date(2024, 1, 2), date(2024, 1, 2)), "k") == [("b",)]
    assert rows(filters.in_range(df, "ts", None, datetime(2024, 1, 2)), "k") == [("a",)]
    assert rows(filters.in_keys(df, "k", "a, c"), "k") == [("a",), ("c",)]
    assert filters.in_keys(df, "k", []).count() == 3
    assert rows(filters.look_back(df, "ts", "1D"), "k") == [("b",), ("c",)]
    assert filters.look_back(df, "ts", "whatever").count() == 3
    assert rows(filters.look_back(df, "ts", "1D", at("2024-01-02 00:00")), "k") == [("a",), ("b",), ("c",)]
    with pytest.raises(ValueError):
        filters.require_rows(df.limit(0))


def test_range_filters_reach_the_scan(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([("a", at("2024-01-01"))], "k string, ts timestamp_ntz").write.parquet(path)
    for kept in (filters.in_days, filters.in_range):
        df = kept(spark.read.parquet(path), "ts", date(2024, 1, 1), date(2024, 1, 2))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(ts" in plan
