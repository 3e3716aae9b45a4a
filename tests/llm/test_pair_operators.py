"""Joins, searches, line dedup, mixing, chats and the pipeline against plain versions on small tables."""

import random
import re
import sys
import time
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickstone.llm import chat, common, containment, graph, jaccard, lines, mixing, topk
from tickstone.llm.common import n_words
from tickstone.llm.queries import QUERIES, SQL

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import connect, differences  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, item_id long, size string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), 1, "clash") for i, t in rows], DOCS)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None


def shingles(text, k, short=True):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words and short else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def plain_components(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    part = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                old, new = part[a], part[b]
                part = [new if p == old else p for p in part]
    least = {}
    for p, (i, _) in zip(part, sets, strict=True):
        least[p] = min((x for x in (least.get(p), i) if x is not None), default=None)
    return sorted((i, len(s), least[p]) for p, (i, s) in zip(part, sets, strict=True) if i is not None)


def copies(seed, n_base=12, n_copies=8):
    """Texts with near copies of all degrees, of 1 to 400 words."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for b in range(n_base):
        base = rnd.choices(vocabulary, k=rnd.choice([1, 3, 4, 6, 9, 15, 40, 120, 400]))
        for _ in range(n_copies):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, len(copy) // 30, len(copy) // 12])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                copy = copy + rnd.choices(vocabulary, k=rnd.randint(0, len(copy) // 8 + 1))
            texts.append(rnd.choice([" ", "  ", "\n"]).join(copy).upper() if b % 3 == 0 else " ".join(copy))
    return texts


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_jaccard_components_equal_brute_force(spark, k, percent):
    rows = [*enumerate(copies(k)), (500, None), (501, ""), (502, " \t"), (503, ""), (7, copies(k)[7])]
    got = jaccard.clusters(table(spark, rows), k=k, percent=percent)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == plain_components(rows, k, percent)


def test_jaccard_finds_links_of_a_group_without_a_centre(spark):
    rnd = random.Random(2)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(150):  # each loses two words of a base that is not there
        copy = list(base)
        for at in rnd.sample(range(150), rnd.choice([1, 2, 2, 3])):
            copy[at] = f"c{i}-{at}"
        rows.append((i, " ".join(copy)))
    got = jaccard.clusters(table(spark, rows), k=4, percent=85)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == plain_components(rows, 4, 85)


def test_jaccard_large_sets_equal_brute_force(spark):
    rnd, texts = random.Random(5), []
    for size in (510, 560, 1000, 1040, 1900, 2100, 3000):  # copies lie on both sides of powers of two
        base = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
        for changed in (0, 2, 40, 44, 48, 60, 90):
            copy = base[: size - rnd.randrange(size // 12)]
            for at in rnd.sample(range(len(copy)), changed * size // 2000):
                copy[at] = f"c{rnd.randrange(10**6)}"
            texts.append(" ".join(copy))
    rows = [*enumerate(texts)]
    got = jaccard.clusters(table(spark, rows), k=5, percent=80)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == plain_components(rows, 5, 80)


def test_jaccard_reads_no_large_sets_that_only_share_passages(spark, monkeypatch):
    rnd, read = random.Random(3), []
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    passages = [words(600) for _ in range(4)]
    texts = [words(2000) + (passages[i % 4] if i < 24 else words(rnd.randrange(400)) + passages[0][:60]) for i in range(40)]
    base = words(2500)  # the only links
    texts += [" ".join(base), " ".join(base[:-30])]
    rows = [(i, x if isinstance(x, str) else " ".join(x)) for i, x in enumerate(texts)]
    real = jaccard._sets

    def sets(docs, id_column, text, k, wanted):
        read.extend(r["doc_id"] for r in wanted.collect())
        return real(docs, id_column, text, k, wanted)

    monkeypatch.setattr(jaccard, "_sets", sets)
    got = jaccard.clusters(table(spark, rows), k=5, percent=80)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == plain_components(rows, 5, 80)
    assert sorted(read) == [40, 41]


def test_fine_parity_bits_fold():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 1500).astype(np.uint64))
    large, small = jaccard._parity(values, 2048), jaccard._parity(values, 1024)
    assert (large[:16] ^ large[16:] == small).all()


def test_blocks_of_similar_sets_meet_without_their_most_common_ones(spark):
    # sets 1 and 2 share keys 1 to 4 and must share three; 3 shares fewer than it must; keys 1 and 2 are common
    rows = [(key, sid, 7, 3) for sid in (1, 2) for key in (1, 2, 3, 4)] + [(key, 3, 7, 3) for key in (1, 2)]
    rows += [(key, sid, 8, 1) for sid in (4, 5, 6) for key in (1, 2)]
    live = spark.createDataFrame(rows, "key long, sid long, band int, share int")
    got = sorted(tuple(r) for r in jaccard._rarest(live).collect())
    assert got == [(1, 4), (1, 5), (1, 6), (2, 4), (2, 5), (2, 6), (3, 1), (3, 2), (4, 1), (4, 2)]


def test_written_leaves_no_shuffled_files(spark):
    def files():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files(), spark.conf.get(setting)
    got = common.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert sorted(r["count"] for r in got.collect()) == [142, 143, 143, 143, 143, 143, 143]
    for _ in range(100):  # Spark deletes them in another thread
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before
    assert spark.conf.get(setting) == was


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = table(spark, [(5, text), (3, text.upper()), (9, text + " x"), (None, text), (1, "other words stand in this one"), (2, ""), (4, None)])
    assert sorted(r["doc_id"] for r in jaccard.one_of_each(docs).collect()) == [1, 2, 3, 4]
    assert jaccard.one_of_each(docs).columns == docs.columns
    assert jaccard.one_of_each(docs.limit(0)).count() == 0


def test_components_of_long_paths(spark):
    rnd = random.Random(4)
    nodes = rnd.sample(range(10_000), 200)
    links = [*zip(nodes[:120], nodes[1:121], strict=True), *zip(nodes[130:], [*nodes[131:], nodes[130]], strict=True), (nodes[5], nodes[5])]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    first, second = min(nodes[:121]), min(nodes[130:])
    assert got == {**{n: first for n in nodes[:121]}, **{n: second for n in nodes[130:]}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_containment_equals_brute_force(spark):
    rnd = random.Random(6)
    vocabulary = [f"w{i}" for i in range(4000)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([3, 6, 9, 14, 30, 55])))) for i in range(40)]
    docs = []
    for i in range(60):
        words = rnd.choices(vocabulary, k=rnd.choice([10, 200, 5000]))
        item = WORD.findall(rnd.choice(items)[1])
        if i % 3:
            for _ in range(rnd.choice([0, 0, 1])):
                item[rnd.randrange(len(item))] = "other"
            at = rnd.randrange(len(words))
            words[at:at] = [w.upper() for w in item]
        docs.append((i, "\n".join(words)))
    docs += [(90, None), (91, ""), (None, docs[1][1]), docs[4]]
    items += [(50, None), (51, ""), (None, items[7][1])]
    want = set()
    for d, text in docs:
        for i, item in items:
            s = shingles(item, 5, short=False)
            if s and 100 * len(s & shingles(text, 5)) >= 80 * len(s):
                want.add((d, i, len(s), len(s & shingles(text, 5))))
    item_table = spark.createDataFrame(items, "item_id long, text string")
    got = containment.contained(table(spark, docs), item_table).select("doc_id", "item_id", "n_item", "n_shared")
    assert {tuple(r) for r in got.collect()} == want and len(want) > 15
    bad = {d for d, *_ in want}
    left = containment.decontaminate(table(spark, docs), item_table)
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted((d for d, _ in docs if d not in bad), key=repr)
    assert containment.contained(table(spark, docs), item_table.limit(0)).count() == 0
    assert containment.contained(table(spark, []), item_table).count() == 0


def test_containment_of_items_that_repeat_themselves(spark):
    rnd = random.Random(14)
    vocabulary = [f"w{i}" for i in range(4000)]
    items, docs = [], []
    for i in range(36):
        passage, times = rnd.choices(vocabulary, k=rnd.choice([10, 12, 24])), rnd.randint(15, 60)
        items.append((i, " ".join(passage * times)))
        words = rnd.choices(vocabulary, k=5000)
        if i % 3 == 2:  # the passage many times, other words between
            for _ in range(times):
                at = rnd.randrange(len(words))
                words[at:at] = passage * 2
        else:  # the whole item, or the passage twice
            at = rnd.randrange(len(words))
            words[at:at] = passage * (times if i % 3 else 2)
        docs.append((i, " ".join(words)))
    sets = {i: shingles(t, 5, short=False) for i, t in items}
    want = set()
    for d, text in docs:
        own = shingles(text, 5)
        want |= {(d, i, len(s), len(s & own)) for i, s in sets.items() if 100 * len(s & own) >= 80 * len(s)}
    got = containment.contained(table(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in got.select("doc_id", "item_id", "n_item", "n_shared").collect()} == want and len(want) >= 36


def plain_lines(rows, least):
    """Deleted lines by comparing all runs."""
    seqs = {(i, t): [(p, x) for p, x in enumerate(t.split("\n")) if WORD.search(x)] for i, t in rows if t is not None}
    order = sorted(seqs)
    gone = {d: set() for d in order}
    words = lambda run: sum(len(WORD.findall(x)) for _, x in run)
    runs = {}
    for d in order:
        for a in range(len(seqs[d])):
            for b in range(a + 1, len(seqs[d]) + 1):
                run = seqs[d][a:b]
                if words(run) >= least:
                    key = tuple(x for _, x in run)
                    if key in runs:
                        gone[d] |= {p for p, _ in run}
                    else:
                        runs[key] = (d, a)
    return {d: "\n".join(x for p, x in enumerate(d[1].split("\n")) if p not in gone[d]) for d in order}


def test_line_dedup_equals_comparing_all_runs(spark):
    rnd = random.Random(8)
    pool = [" ".join(rnd.choices("abcdefgh", k=rnd.choice([1, 2, 5, 9]))) for _ in range(14)] + ["", "  "]
    rows = [(i, "\n".join(rnd.choices(pool, k=rnd.randint(1, 14)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, rows[3][1]), (3, rows[3][1]), (53, "long " * 30), (54, "long " * 30)]
    got = lines.deduplicated(table(spark, rows), least=10)
    want = plain_lines(rows, 10)
    assert sorted((r["doc_id"], r["text"] or "") for r in got.collect()) == sorted((i, want.get((i, t), t) or "") for i, t in rows)
    assert lines.deduplicated(table(spark, [])).count() == 0


def test_mix_reaches_targets(spark):
    rnd = random.Random(9)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 60))) for i in range(900)] + [(None, "a b"), (7, "a b c"), (8, None)]
    docs = table(spark, rows).withColumn("source", F.expr("case when doc_id < 90 then 's0' when doc_id < 500 then 's1' when doc_id < 800 then null else 's2' end"))
    out = mixing.mixed(docs, n_words(F.col("text")))
    again = mixing.mixed(docs.repartition(7), n_words(F.col("text")))
    key = lambda df: sorted(map(repr, df.select("doc_id", "size", "taken").collect()))
    assert key(out) == key(again)
    got = out.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"), F.first("source_size").alias("s"), F.max("size").alias("m")).collect()
    assert sum(r["t"] for r in got) == pytest.approx(1.5 * sum(r["s"] for r in got))
    assert all(r["t"] <= 2 * r["s"] and abs(r["t"] - r["n"]) <= r["m"] for r in got)
    assert out.where("taken > 2 * size").isEmpty() and out.count() == len(rows)
    assert mixing.mixed(table(spark, []), n_words(F.col("text"))).count() == 0
    assert mixing.mixed(table(spark, [(1, None), (2, "")]), n_words(F.col("text"))).where("taken <> 0").isEmpty()


def test_mix_draws_as_many_equal_rows_as_fit(spark, tmp_path):
    rows = [(7, "a b c", "s0")] * 200 + [(None, "a b c d", "s1")] * 150 + [(i, "a b", "s1") for i in range(150)]
    rows += [(8, "a b c d e", "s2")] * 90 + [(9, "", "s2")] * 40 + [(9, None, "s2")] * 3 + [(8, "a", "s2")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = mixing.mixed(docs, n_words(F.col("text")))
    got = out.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"), F.max("size").alias("m"), F.count("*").alias("c")).collect()
    assert {r["source"]: r["c"] for r in got} == {"s0": 200, "s1": 300, "s2": 163}
    assert all(abs(r["t"] - r["n"]) <= r["m"] / 2 for r in got)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert differences(QUERIES["op9_source_mix"](spark, str(tmp_path)), con, SQL["op9_source_mix"]) is None


def test_reply_trees(spark):
    rows = [("c", 1, None, "user", "hi", 1.0), ("c", 2, 1, "assistant", "a", 0.0), ("c", 3, 1, "assistant", "b", 9.0), ("c", 4, 3, "user", "more", 2.0),
            ("c", 5, 99, "system", "lost parent", 0.5), ("x", 1, 2, "user", "circle", 1.0), ("x", 2, 1, "user", "circle", 1.0), (None, 1, None, None, None, None),
            ("c", 2, 1, "assistant", "a", 0.0)]
    messages = spark.createDataFrame(rows, "conv_id string, msg_id long, parent_id long, role string, text string, score double")
    got = chat.paths(messages, branches=None).orderBy("conv_id", "branch", "depth").collect()
    assert [(r["conv_id"], r["branch"], r["msg_id"]) for r in got] == [
        (None, 1, 1), ("c", 1, 1), ("c", 1, 3), ("c", 1, 4), ("c", 2, 1), ("c", 2, 2), ("c", 3, 5)]
    assert {r["leaf_id"] for r in chat.paths(messages).where("conv_id = 'c'").collect()} == {4}
    text = chat.conversations(messages).where("conv_id = 'c'").first()
    assert chat.parsed(text["formatted"]) == [("user", "hi"), ("assistant", "b"), ("user", "more")]
    assert [text["formatted"][s["start"] : s["end"]] for s in text["loss"]] == ["b"]
    assert chat.conversations(messages.limit(0)).count() == 0


def test_long_path_and_round_trip_of_control_strings(spark):
    rnd = random.Random(10)
    parts = [*chat.CONTROLS, "\\", "\\\\", " ", "x", "\n", "<", "[", "/", "🙂"]
    rows = [(1, i, rnd.choice(["user", "assistant", "tool [END]", None]), "".join(rnd.choices(parts, k=rnd.randint(0, 8)))) for i in range(70)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.conversations(chat.linear(frame), branches=None).first()
    assert chat.parsed(out["formatted"]) == [(r or "", t) for _, _, r, t in rows]
    loss = [chat.unescaped(out["formatted"][s["start"] : s["end"]]) for s in out["loss"]]
    assert loss == [t for _, _, r, t in rows if r == "assistant"]


def plain_top(vectors, queries, k):
    out = []
    for q, a in queries.items():
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), v) for v, b in vectors.items() if v != q and len(a) == len(b))
        out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rnd = random.Random(12)
    vectors = {i: [rnd.randint(-80, 80) for _ in range(8)] for i in range(600)}
    vectors |= {i: vectors[0] for i in range(600, 800)} | {i: [5] * 3 for i in range(800, 803)} | {900: [1]}
    rows = [(i, [x / 256 for x in v]) for i, v in vectors.items()]
    rows += [(1000, None), (1001, []), (1002, [None] * 8), (1003, [float("nan")] * 8), (1004, [float("inf")] * 8), (None, [0.1] * 8), rows[0]]
    table_ = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = topk.integers(table_)
    got = topk.top_k(whole, whole.where("vec_id % 50 = 0"), 5)
    assert sorted(tuple(r) for r in got.collect()) == plain_top(vectors, {i: v for i, v in vectors.items() if i % 50 == 0}, 5)
    empty = topk.integers(table_.limit(0))
    assert topk.top_k(empty, empty, 5).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if n < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        assert docs.join(before, "doc_id", "left_anti").isEmpty()
        if name == "line_dedup":
            want = plain_lines([(r["doc_id"], r["text"]) for r in before.collect()], 50)
            kept = {r["doc_id"]: r["text"] for r in docs.collect()}
            texts = {i: t for (i, old), t in want.items() if t == old or WORD.search(t)}
            assert kept == texts
        if name == "jaccard_join":
            parts = plain_components([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(i for i, n_, p in parts if i == p or not n_)
        if name == "decontamination":
            items = [shingles(r["text"], 5, short=False) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            clean = [r["doc_id"] for r in before.collect() if not any(s and 100 * len(s & shingles(r["text"], 5)) >= 80 * len(s) for s in items)]
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(clean)
    assert docs.where("copies < 1").isEmpty() and docs.count() > 100
