"""Token counts, languages, toxicity and personal data against plain versions on small tables."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tickstone.llm import language, pii, tokens, toxicity
from tickstone.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_bytes string"


def table(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", "clash") for i, t in enumerate(texts)], DOCS)


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_tokens_of_odd_texts_equal_the_library():
    import public_tokenizers

    count, own = tokens.counter(public_tokenizers.path("word_bpe_49k.json")).count, tokenizer()
    rnd = random.Random(5)
    letters = [*map(chr, range(0x250)), *"  '''strevdlmİſKΣς日本🙂ﬁ́", "<|endoftext|>", "'re", "'LL", "<|startoftext|"]
    texts = ["", " ", "don't <|endoftext|> stop", *("".join(rnd.choices(letters, k=rnd.randint(1, 40))) for _ in range(5000))]
    assert [count(t) for t in texts] == [len(e.ids) for e in own.encode_batch(texts, add_special_tokens=False)]
    assert count(None) == 0


def test_whole_tokens_are_proved():
    import public_tokenizers

    counter, own = tokens.counter(public_tokenizers.path("word_bpe_49k.json")), tokenizer()
    some = random.Random(1).sample(sorted(counter.whole), 2000)
    assert all(len(own.encode(s, add_special_tokens=False).ids) == 1 for s in some)


def test_token_counts_keep_rows_and_replace_clashes(spark):
    texts = [None, "", "the cat", "the cat", "x" * 5000]
    got = {r["doc_id"]: r for r in tokens.token_counts(table(spark, texts), limit=2).collect()}
    assert [got[i]["n_bytes"] for i in range(5)] == [0, 0, 7, 7, 5000]
    assert [got[i]["n_tokens"] for i in (0, 1, 2, 3)] == [0, 0, 2, 2]
    assert [got[i]["over_limit"] for i in range(5)] == [False, False, False, False, True]
    assert tokens.token_counts(table(spark, [])).count() == 0


def test_token_query_equals_the_library(spark):
    own = tokenizer()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["op1_token_counts"](spark, SF).collect():
        assert r["n_tokens"] == len(own.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert r["over_limit"] == (r["n_tokens"] > 2048)


def plain_ranks(text, top):
    counts = {}
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram != " ":
                    counts[gram] = counts.get(gram, 0) + 1
    code = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:top]


def test_language_ranks_equal_a_plain_version():
    text = "Das ist, nun ja: das 12 Haus. The house_is here! Ünter"
    codes = language.ranked(language.grams(text), 40)
    names = ["".join(chr((int(c) >> s) & 0x1FFFFF) for s in (42, 21, 0) if (int(c) >> s) & 0x1FFFFF) for c in codes]
    assert names == plain_ranks(text, 40)


def test_language_without_letters_or_lessons(spark):
    docs = table(spark, [None, "", "12 --", "the thing", "the thing"])
    got = [tuple(r) for r in language.identify(docs, docs).orderBy("doc_id").select("lang_pred", "score").collect()]
    assert got[:3] == [("und", 0.0)] * 3 and got[3] == got[4] and got[3][0] == "en" and 0 <= got[3][1] <= 1
    assert {r["lang_pred"] for r in language.identify(docs, docs.limit(0)).collect()} == {"und"}
    assert language.identify(docs.limit(0), docs).count() == 0


def test_language_query_is_accurate_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    langs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op10_language_id"](spark, sf).join(langs, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def plain_segments(scores):
    """Maximal scoring subsequences by their recursive definition."""
    best = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=None)
    if best is None or best[0] <= 0:
        return []
    i, j = best[3:]
    return [*plain_segments(scores[:i]), (i, j - 1, best[0]), *[(a + j, b + j, s) for a, b, s in plain_segments(scores[j:])]]


def test_maximal_segments_equal_their_definition():
    rnd = random.Random(3)
    for _ in range(300):
        scores = [rnd.choice([-5, -3, -2, -1, 1, 2, 3, 4]) + rnd.random() for _ in range(rnd.randint(0, 12))]
        got = toxicity.maximal_segments([(i, i, s) for i, s in enumerate(scores)])
        want = plain_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def toxic_rows(spark):
    rnd = random.Random(7)
    words = [a + b for a in ("ka", "lo", "mi", "ru") for b in ("sa", "te", "no", "vi", "pe")]
    rows = []
    for i in range(400):
        text = rnd.choices(words, k=60)
        if toxic := i % 4 == 0:
            text[20:22] = ["grubworm", "grubworms"]
        rows.append((i, " ".join(text), toxic * 1))
    return spark.createDataFrame([*rows, (900, None, 1), (901, "x", None)], "doc_id long, text string, toxic int")


def test_toxic_passages_are_found(spark):
    train = toxic_rows(spark)
    model = toxicity.fit(train, prior=500.0)
    docs = spark.createDataFrame([(1, "kasa te GRUBWORM, grubworms lote"), (2, "kasa lote"), (3, ""), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert got[1] > 0.7 > got[2] == got[3] == got[4] >= 0
    found = toxicity.passages(docs, model).collect()
    assert [(r["doc_id"], r["passage"]) for r in found] == [(1, "GRUBWORM, grubworms")]
    assert found[0]["expected"] < 0.05


def test_every_significant_token_is_kept(spark):
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèñç"
    words = ["".join(w) for w in itertools.product(letters, repeat=3)]
    words, others = words[:24_000], words[24_000:]
    text, other = " ".join(words), " ".join(others)
    rows = [(i, text, 1) for i in range(60)] + [(i, text, 0) for i in range(60, 66)] + [(i, other, 0) for i in range(66, 126)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(8))
    assert all(model.weights.get(w, (0, 0))[1] > 0 for w in words)


def test_toxicity_without_lessons(spark):
    train = toxic_rows(spark)
    for rows in (train.limit(0), train.where("toxic = 1"), train.where("toxic = 0")):
        model = toxicity.fit(rows)
        assert [r["score"] for r in toxicity.score(train.limit(3), model).collect()] == [0.0] * 3


def test_toxicity_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op4_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    hits = sum(r["toxic"] and r["predicted"] for r in rows)
    assert hits >= 0.8 * sum(r["toxic"] for r in rows)
    assert hits >= 0.95 * sum(r["predicted"] for r in rows)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def odd_texts():
    rnd = random.Random(11)
    parts = ["a@b.c", "a@b.c_d@e.f", "x%y@mail-1.example.com.", "@", "1.2.3.4", "256.1.2.3.4", "1.2.3.4.5.6.7.8", "000255.01.2.3", "+1 (017) 555-7713",
             "+49", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "41111111111111114", "+4111111111111111", "  ", " ", "-", "é🙂", "9", ".", "\n", "(", "12 34"]
    return ["", *("".join(rnd.choices(parts, k=rnd.randint(1, 9))) for _ in range(600)), "1 " * 300, "a" * 3000 + "@b.de"]


def test_base_spans_equal_the_plain_patterns(spark):
    texts = odd_texts()
    found = pii.base_spans(table(spark, texts), "text").select("doc_id", pii.written_out(F.col("base")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in found} == {i: ",".join(plain_base(t)) for i, t in enumerate(texts)}


def test_personal_data_query_equals_the_plain_patterns(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["op6_pii"](spark, sf).collect():
        base = plain_base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert r["n_email"] == sum(s.startswith("email") for s in base) and r["n_card"] == sum(s.startswith("card") for s in base)
        assert set(base) <= set(filter(None, r["spans"].split(",")))


def test_supervision_adds_spans_and_keeps_base_ones(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    texts = [f'token = "{key[i:]}{key[:i]}" said a@b.de' for i in range(30)] + ["tel: 555-123-4567 or so", "anna [at] mail [dot] com", None]
    got = {r["doc_id"]: r["s"] for r in pii.find(table(spark, texts)).select("doc_id", pii.written_out(F.col("spans")).alias("s")).collect()}
    assert all(got[i] == "email:56:62,secret:9:49" for i in range(30))
    assert got[32] == "" and pii.find(table(spark, [])).count() == 0


def test_labelers_that_agree_are_trusted():
    counts = [("phone", "21221", 0, 50), ("phone", "12121", 0, 40), ("phone", "02202", 0, 60), ("phone", "22202", 0, 50)]
    known = pii.train(counts)
    assert known["phone|12121|0"] > 0.5 > known["phone|02202|0"]


def test_toxicity_workers_remember_few_words():
    model = toxicity.Model({"bad": (9.0, 2.0)})
    for i in range(120_000):
        assert model.values[f"w{i}"] is None
    assert len(model.values) <= 50_000 and model.values["bad"] == 2.0
