"""Operators on parts of keys against one plain pass over each key."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickstone.operators.sequence import _Steps, affine_scan, carry_forward, cooldown, ewma, in_parts, previous_value

BASE = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def data():
    """One key holds most rows; some rows share a time."""
    rng = random.Random(3)
    out = []
    for i in range(4000):
        key = rng.choice("aaab") if i % 7 else f"c{i % 50}"
        span = 3 * 86_400 if key != "b" else 20_000
        out.append((key, BASE + timedelta(seconds=rng.randint(0, span)), i, rng.random() * 100))
    return sorted(out)


@pytest.fixture(scope="module", params=[10_000, 7])
def frame(request, spark, data):
    """With the second batch size nearly every group is spread over several Arrow batches."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, request.param)
    # A computed key is not nullable, unlike one read from a table.
    rows = spark.createDataFrame(data, "k string, ts timestamp_ntz, id bigint, v double").repartition(5)
    yield rows if request.param > 7 else rows.selectExpr("coalesce(k, '') as k", "ts", "id", "v")
    spark.conf.unset(setting)


@pytest.mark.parametrize("wait, parts", [(300, 1), (300, 60), (40_000, 25)])
@pytest.mark.parametrize("at_limit", [True, False])
def test_cooldown(frame, data, wait, parts, at_limit):
    want, last = set(), {}
    for key, ts, i, _ in data:
        gap = (ts - last[key]).total_seconds() if key in last else None
        if gap is None or gap > wait or (at_limit and gap == wait):
            want.add((key, ts, i))
            last[key] = ts
    got = cooldown(frame, "k", "ts", "id", wait, at_limit, parts).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_cooldown_edges(spark):
    at = [0, 200, 299, 300, 301]
    rows = [("x", BASE + timedelta(seconds=s), s) for s in at]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id bigint")
    assert sorted(r.id for r in cooldown(df, "k", "ts", "id", 300).collect()) == [0, 300]
    assert sorted(r.id for r in cooldown(df, "k", "ts", "id", 300, at_limit=False).collect()) == [0, 301]
    assert cooldown(df.limit(0), "k", "ts", "id", 300).collect() == []
    with pytest.raises(ValueError):
        cooldown(df, "k", "ts", "id", 0)


@pytest.mark.parametrize("parts", [1, 40, "bounded"])
@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("seeds", [None, {"a": 5.0, "c1": 7.0}])
def test_ewma(spark, frame, data, parts, when, seeds):
    want, state = {}, {}
    for key, _, i, v in data:
        if key not in state:
            state[key] = (seeds or {}).get(key, v)
            want[i] = None if when == "before" else state[key]
        else:
            old = state[key]
            state[key] = 0.7 * old + 0.3 * v
            want[i] = old if when == "before" else state[key]
    seed_frame = spark.createDataFrame(list(seeds.items()), "k string, e double") if seeds else None
    how = {"bounded": True} if parts == "bounded" else {"parts": parts}
    averaged = ewma(frame, "k", "ts", ["id"], {"e": ("v", 0.7, 0.3)}, when, seed_frame, **how)
    got = {r.id: r.e for r in averaged.collect()}
    assert got == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("parts", [1, 70])
@pytest.mark.parametrize("include_current", [True, False])
def test_last_known_value(frame, data, parts, include_current):
    want, last = {}, {}
    for key, _, i, v in data:
        known = v if int(v) % 3 == 0 and key != "c4" else None
        if include_current and known is not None:
            last[key] = known
        want[i] = last.get(key)
        if known is not None:
            last[key] = known
    gaps = frame.withColumn("w", F.when((F.col("v").cast("int") % 3 == 0) & (F.col("k") != "c4"), F.col("v")))
    got = {r.id: r.p for r in carry_forward(gaps, "k", "ts", ["id"], "w", "p", include_current, parts).collect()}
    assert got == want


def test_previous_value_of_null_keys_and_other_types(spark):
    rows = [(None, BASE + timedelta(seconds=i), f"v{i}" if i != 3 else None, [i]) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v string, extra array<int>").repartition(3)
    got = {r.extra[0]: r.p for r in previous_value(df, "k", "ts", [], "v", "p", 6).collect()}
    assert got == {i: None if i == 0 else "v2" if i == 4 else f"v{i - 1}" for i in range(40)}


def test_one_key_is_dealt_evenly(spark):
    """However close the times of a key lie, no part holds more than about its share."""
    df = spark.range(20_000).selectExpr("'x' as k", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id / 1000) as ts", "id")
    sizes = [r["count"] for r in in_parts(df, "k", ["ts", "id"], 20).groupBy("_part").count().collect()]
    assert len(sizes) >= 18 and max(sizes) <= 3 * 1000


def test_step_functions_stay_small(spark):
    """Chains that can enter a stretch at many rows mostly leave it alike; only steps that differ are kept."""
    us = np.sort(np.random.default_rng(1).integers(0, 10_000_000, 5_000))
    wait = 50_000
    leaves = us.copy()
    for i in reversed(range(len(us))):
        nxt = np.searchsorted(us, us[i] + wait)
        leaves[i] = us[i] if nxt == len(us) else leaves[nxt]
    steps = _Steps(int(us[0]), us, leaves, wait)
    assert steps.reach.size <= 40
    kept = np.arange(-wait, int(us[0]))
    want = np.array([leaves[np.searchsorted(us, k + wait)] for k in kept])
    assert (steps.after(kept) == want).all()


def test_affine_scan_equals_a_loop():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 50, 1000):
        a, b = rng.choice([0.0, 0.7, 1.0, 0.999], n), rng.normal(size=n)
        y, want = 5.0, []
        for slope, shift in zip(a, b, strict=True):
            y = slope * y + shift
            want.append(y)
        assert affine_scan(a, b, 5.0) == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_average_of_a_difference(frame, data):
    want, state = {}, {}
    for key, _, i, v in data:
        fast, slow, signal = state.get(key, (v, v, None))
        fast, slow = 0.5 * fast + 0.5 * v, 0.9 * slow + 0.1 * v
        signal = fast - slow if signal is None else 0.8 * signal + 0.2 * (fast - slow)
        state[key] = fast, slow, signal
        want[i] = signal
    columns = {"f": ("v", 0.5, 0.5), "s": ("v", 0.9, 0.1), "d": (("f", "s"), 0.8, 0.2)}
    got = {r.id: r.d for r in ewma(frame, "k", "ts", ["id"], columns, bounded=True).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_large_ids_survive(spark):
    big = 2**60 + 1
    df = spark.createDataFrame(
        [("x", BASE, big, 1.0), ("x", BASE + timedelta(days=3), big + 2, 2.0)],
        "k string, ts timestamp_ntz, id bigint, v double",
    )
    assert sorted(r.id for r in cooldown(df, "k", "ts", "id", 300).collect()) == [big, big + 2]
    assert sorted(r.id for r in ewma(df, "k", "ts", ["id"], {"e": ("v", 0.7, 0.3)}).collect()) == [big, big + 2]
