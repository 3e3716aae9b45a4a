"""Collocations and quality rules against plain versions."""

import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from tickstone.llm import collocation, quality
from tickstone.llm.common import written

DOCS = "doc_id long, text string, lang string, source string, n int, rank string, score string, kept int, level string"


def docs_of(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, lang, s, 1, "clash", "clash", 7, "x") for i, t, lang, s in rows], DOCS).repartition(parts)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_collocations(rows, least=10, top=2000):
    counts, totals = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {}
    for (lang, words), a in counts.items():
        if len(words) == 1 or a < least:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        longer = [counts[lang, w] for (g, w) in counts if g == lang and len(w) == 3 and counts[g, w] >= least and words in (w[:2], w[1:])]
        if len(words) == 3 or not any(100 * n >= 50 * a for n in longer):
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, phrases in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(phrases)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in collocation.collocations(docs_of(spark, rows), **options).collect())


@pytest.fixture(scope="module")
def phrases():
    rnd = random.Random(12)
    words = ["New", "york", "city", "the", "a", "é", "日本", "über", "x-y", "hot", "dog", "it's", "Z", "🙂"]
    def text(n):
        out = []
        while len(out) < n:
            out += rnd.choice([["New", "York", "City"], ["hot", "dog"], ["a", "a", "a", "a"], [rnd.choice(words)], [rnd.choice(words)]])
        return "".join(w + rnd.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for w in out)
    rows = [(i, text(rnd.randint(0, 40)), rnd.choice(["en", "en", "de", None, "und"]), "s") for i in range(150)]
    return rows + [(None, "hot dog " * 3000, "en", "s"), (5, None, "en", "s"), (5, "", None, "s"), (6, " .,\n", "fr", "s"), rows[0], rows[0]]


@pytest.mark.parametrize("share", [0.0, 0.1, 1.0])
def test_collocations_equal_a_plain_version_whatever_was_sampled(spark, phrases, share):
    want = plain_collocations(phrases)
    assert len(want) > 25 and {w[0] for w in want} == {"en", "de", "und"}
    assert mined(spark, phrases, share=share) == want


def test_collocations_with_full_filters_and_few_ranks(spark, phrases, monkeypatch):
    monkeypatch.setattr(collocation, "SLICE", 2000)
    assert mined(spark, phrases, least=3, top=5) == plain_collocations(phrases, 3, 5)


def test_products_beyond_64_bits_stay_exact(spark):
    rows = [("en", 1, "a", 3_000_000_000_007), ("en", 1, "b", 3_000_000_000_011), ("en", 2, "a b", 2_999_999_999_999), ("en", 0, "", 10**13)]
    found = spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    got = [tuple(r) for r in collocation.ranked(found, 10).collect()]
    score = int(Fraction(1_000_000 * 2_999_999_999_999**2, 3_000_000_000_007 * 3_000_000_000_011))
    assert got == [("en", 1, "a b", 2_999_999_999_999, 3_000_000_000_007, 3_000_000_000_011, 10**13, score)]


def test_collocations_without_rows(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, None, "en", "s")]) == []


def plain_measures(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n = len(words)
    out = [n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)]
    return [*out, n < 50 or 100 * len(covered) > 50 * n, len(lines)]


def plain_rules(rows):
    measures = [plain_measures(t) for _, t, _, _ in rows]
    cut = lambda v: v >> max(v.bit_length() - 7, 0) << max(v.bit_length() - 7, 0)
    per_mille = lambda m: [x * 1000 // y if y else 0 for x, y in ((m[1], m[0]), (m[2], m[0]), (m[4], m[0]), (m[3], m[6]))]
    groups = {}
    for (_, _, lang, source), m in zip(rows, measures, strict=True):
        if not m[5]:
            for key in ((lang, source), (lang,), ()):
                groups.setdefault(key, []).append([cut(v) for v in per_mille(m)])
    out = []
    for (i, _, lang, source), m in zip(rows, measures, strict=True):
        rule = "base" if m[5] else None
        key = next((k for k in ((lang, source), (lang,), ()) if len(groups.get(k, [])) >= quality.ENOUGH), None)
        if rule is None and key is not None:
            for at, rate in enumerate(quality.RATES):
                values = sorted(g[at] for g in groups[key])
                q1, q3 = values[-(-len(values) // 4) - 1], values[-(-3 * len(values) // 4) - 1]
                reach = quality.REACH * max(q3 - q1, rate.spread)
                if not (q1 - reach if rate.low else -1) <= per_mille(m)[at] <= q3 + reach:
                    rule = rate.name
                    break
        out.append((i, *m[:6], rule is None, rule))
    return sorted(out, key=repr)


def texts_of_quality(rnd, n):
    words = ["the", "quick", "brün", "fox", "🙂", "日本語", "jumps", "over", "lazy", "dogs"]
    some = lambda k, more=(): "".join(rnd.choice([*words, *more]) + str(rnd.randint(0, 99)) + rnd.choice([" ", " ", "\n", "\t"]) for _ in range(k))
    for _ in range(n):
        yield rnd.choice([some(60), some(80), some(120), some(200), some(30), some(70, ["#$%&*" * 3] * 9), "a b c " * 40, some(60) + "x y z " * 5])
        yield some(70) + "same line here\n" * rnd.choice([0, 0, 0, 1, 12])


def judged(spark, rows):
    docs = quality.measured(docs_of(spark, rows))
    out = quality.judged(docs).select("doc_id", *quality.MEASURES, "kept", "rule")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_quality_rules_equal_a_plain_version(spark):
    rnd = random.Random(13)
    rows = [(i, t, rnd.choice(["en", "en", "en", "de", None]), rnd.choice(["a", "a", "a", None, "b", "tiny"])) for i, t in enumerate(texts_of_quality(rnd, 400))]
    rows += [(None, None, None, None), (1, "", "en", "a"), rows[3], rows[3], (2, "w " * 49, "en", "a"), (3, "a b\x0b c\x85\xa0d", "en", "z")]
    rows += [(9, " ".join(str(rnd.randint(0, 400)) for _ in range(60_000)), "en", "a"), (10, "x" * 200_000, "en", "a"), (11, "one two " * 20_000, "de", "b")]
    got = judged(spark, rows)
    assert got == plain_rules(rows)
    assert {r[-1] for r in got} >= {None, "base", "word_length"}


def test_small_tables_have_base_rules_only(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(50 + i)), "en", "a") for i in range(20)] + [(99, "short", "en", "a")]
    assert [(r[0], r[-2]) for r in judged(spark, rows)] == sorted(((r[0], r[0] != 99) for r in rows), key=repr)
    assert judged(spark, []) == []


def test_merged_sketches_equal_one_sketch(spark):
    rnd = random.Random(3)
    rows = [(i, t, "en", rnd.choice("abcdef")) for i, t in enumerate(texts_of_quality(rnd, 100))]
    one = [(i, t, "en", "all") for i, t, _, _ in rows]
    bins = lambda rows, level: sorted(tuple(r) for r in quality.sketches(written(quality.measured(docs_of(spark, rows)), "measured")).where(f"level = {level}").select("rate", "bin", "n").collect())
    assert bins(rows, 1) == bins(one, 2) == bins(one, 0)


def test_filter_keeps_columns(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(60)), "en", "a") for i in range(3)] + [(9, None, "en", "a")]
    out = quality.filtered(docs_of(spark, rows))
    assert out.columns == docs_of(spark, rows).columns and sorted(r["doc_id"] for r in out.collect()) == [0, 1, 2]
