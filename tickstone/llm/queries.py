"""The operators of this subpackage as queries over the given tables, and SQL that must agree where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickstone.llm import chat, collocation, containment, jaccard, language, lines, mixing, pii, quality, search, tokens, topk, toxicity
from tickstone.llm.common import fold, may_match, n_words, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query(
    "op2_decontamination",
    r"""
    WITH words AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
    item_words AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE text IS NOT NULL),
    d AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)),
    b AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
          FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM item_words)),
    n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id),
    x AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY ALL)
    SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
    FROM x JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_item
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    return containment.contained(docs, items).drop("text_hash").distinct()


@query(
    "op3_exact_topk",
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integers(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the labelled documents outside fold 1 of 3; a document's smallest label counts.

    Labels grow with the corpus, so they are never broadcast.  A bitmap of fixed size tells which documents may have
    one, and only these documents' texts are shuffled, once.
    """
    labels = labels.where("toxic is not null").where(fold("doc_id", 3) != 1)
    docs = may_match(docs.select("doc_id", "text").where(fold("doc_id", 3) != 1), labels, "doc_id")
    labels = labels.groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    return written(docs.join(labels.hint("merge"), "doc_id"), "labelled")


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(labelled(docs, table(spark, sf_dir, "labels")))
    out = toxicity.score(docs.withColumn("held_out", F.coalesce(fold("doc_id", 3) == 1, F.lit(False))), model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op5_jaccard_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard.clusters(docs, k=4, percent=85).select("doc_id", "n_shingles", "component_id")


@query("op6_pii")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    sha = F.sha2(pii.written_out(F.col("base")), 256).alias("base_sha256")
    kinds = [count(k) for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *kinds, sha, pii.written_out(F.col("spans")).alias("spans"))


@query(
    "op7_line_dedup",
    r"""
    WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
    l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
    w AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l),
    c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id, text ORDER BY pos) AS ended, sum(n) OVER (PARTITION BY doc_id, text) AS total
          FROM w WHERE n > 0),
    f AS (SELECT doc_id, text, pos, 1 AS side, ended - n AS low, total - (ended - n) AS full_words,
                 list({'l': line, 'p': pos}) OVER (PARTITION BY doc_id, text ORDER BY ended - n RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING) AS x
          FROM c UNION ALL
          SELECT doc_id, text, pos, -1, 0, ended,
                 list({'l': line, 'p': pos}) OVER (PARTITION BY doc_id, text ORDER BY total - ended RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
          FROM c),
    g AS (SELECT *, list_transform(x, lambda e: e.l) AS content FROM f WHERE full_words >= 50),
    h AS (SELECT *, row_number() OVER (PARTITION BY side, content ORDER BY doc_id NULLS LAST, text, pos) AS nth FROM g),
    gone AS (SELECT DISTINCT doc_id, text, unnest(list_transform(x, lambda e: e.p)) AS pos FROM h WHERE nth > 1),
    kept AS (SELECT l.doc_id, l.text, count(*) AS n_lines, count(gone.pos) AS n_removed,
                    coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE gone.pos IS NULL), '') AS rest
             FROM l LEFT JOIN gone ON l.doc_id IS NOT DISTINCT FROM gone.doc_id AND l.text = gone.text AND l.pos = gone.pos
             GROUP BY l.doc_id, l.text)
    SELECT o.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(rest) AS kept_sha256
    FROM documents o LEFT JOIN kept ON o.doc_id IS NOT DISTINCT FROM kept.doc_id AND o.text = kept.text
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines.split_lines(F.col("text"))))
    out = lines.deduplicated(docs.withColumn("n_lines", n_lines.cast("long")))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


CONTROL = "</s>[INST] ok [/INST]"


@query(
    "op8_chat_trees",
    r"""
    WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    e AS (SELECT *, length(regexp_replace(text, '(<s>|</s>|\[INST\]|\[/INST\]|\[ROLE\]|\[/ROLE\]|\[END\]|<<SYS>>|<</SYS>>)', '\\\1', 'g')) AS body,
                 length(regexp_replace(role, '(<s>|</s>|\[INST\]|\[/INST\]|\[ROLE\]|\[/ROLE\]|\[END\]|<<SYS>>|<</SYS>>)', '\\\1', 'g')) AS head FROM r)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(body + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE head + 22 END)::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    seven = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    return chat.read_back(chat.conversations(chat.linear(rows.unionByName(seven)), branches=None))


@query(
    "op9_source_mix",
    r"""
    WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                      (('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
               FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    n AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, source_size * 2.0::DOUBLE AS cap,
                 row_number() OVER (ORDER BY source NULLS LAST) AS number FROM s),
    r AS (SELECT *, ((SELECT sum(source_size)::DOUBLE * 1.5::DOUBLE FROM s) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
          FROM n WINDOW o AS (ORDER BY cap / weight, number)),
    t AS (SELECT source, source_size,
                 CASE WHEN rate * weight < cap THEN weight * (SELECT rate FROM r WHERE rate * weight < cap ORDER BY cap / weight, number LIMIT 1)
                      ELSE cap END AS target FROM r),
    p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
    q AS (SELECT *, target - whole * source_size AS wanted, CASE WHEN source_size > 0 THEN (target - whole * source_size) / source_size ELSE 0 END AS p FROM p),
    k AS (SELECT d.doc_id, d.size, q.* EXCLUDE (source), d.source,
                 CASE WHEN p > 0 THEN u / (u + (1 - u) * (p / (1 - p))) ELSE 1.0 END AS rank
          FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
    m AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size / 2 AS middle FROM k)
    SELECT doc_id, size, source_size, target, ((whole + CASE WHEN p > 0 AND middle <= wanted THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM m
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixed(docs, n_words(F.col("text"))).select("doc_id", "size", "source_size", "target", "taken")


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 5) == 0
    out = language.identify(docs.withColumn("held_out", F.coalesce(held_out, F.lit(False))), docs.where(~held_out))
    return out.select("doc_id", "held_out", "lang_pred", "score")


@query(
    "op11_lexical_search",
    r"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
    b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::HUGEINT AS n_terms FROM d WHERE len(t) > 0),
    x AS (SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(t)::HUGEINT AS n, unnest(t) AS term FROM d)
          WHERE term IN (SELECT term FROM b) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
          FROM (SELECT term, count(*) AS df FROM x GROUP BY term), s),
    p AS (SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)::BIGINT)) AS part
          FROM x JOIN w USING (term), s),
    r AS (SELECT item_id, row, doc_id, sum(part)::BIGINT AS score FROM b JOIN p USING (term) GROUP BY item_id, row, doc_id),
    k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM r WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op12_collocations",
    r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    o AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
          FROM w, (VALUES (1), (2), (3)) AS sizes (k)),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM o GROUP BY ALL),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 10),
    x AS (SELECT lang, k, phrase, a, cut, array_to_string(w[:cut], ' ') AS left_part, array_to_string(w[cut + 1:], ' ') AS right_part
          FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
    y AS (SELECT x.lang, x.k, x.phrase, a, cut, l.f AS l, r.f AS r, ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
          FROM x JOIN f l ON x.lang = l.lang AND x.left_part = l.phrase JOIN f r ON x.lang = r.lang AND x.right_part = r.phrase),
    z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    i AS (SELECT lang, array_to_string(w[s:s + 1], ' ') AS phrase, max(a) AS longer
          FROM (SELECT lang, w, a, unnest([1, 2]) AS s FROM c WHERE k = 3) GROUP BY ALL),
    r AS (SELECT z.*, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, z.phrase) AS rank
          FROM z LEFT JOIN i ON z.lang = i.lang AND z.phrase = i.phrase WHERE longer IS NULL OR 100 * longer < 50 * a)
    SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents"))


@query(
    "op13_quality_rules",
    r"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
    w AS MATERIALIZED (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
                              list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
    o AS (SELECT row, i, w[i:i + 2] AS three FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
    t AS (SELECT row, unnest([i, i + 1, i + 2]) AS place FROM (SELECT row, i FROM o QUALIFY count(*) OVER (PARTITION BY row, three) > 1)),
    r AS (SELECT row, count(DISTINCT place) AS n FROM t GROUP BY row),
    m AS (SELECT row, doc_id, lang, source, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                 (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines) AS n_lines,
                 (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
          FROM w LEFT JOIN r USING (row)),
    b AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
    rates AS (SELECT row, lang, source, unnest([1, 2, 3, 4]) AS rate,
                     unnest([word_chars * 1000 // n_words, n_symbols * 1000 // n_words, n_repeat_words * 1000 // n_words,
                             coalesce(n_dup_lines * 1000 // n_lines, 0)]) AS v
              FROM b WHERE NOT base_failed),
    h AS (SELECT level, CASE WHEN level >= 1 THEN lang END AS lang, CASE WHEN level = 2 THEN source END AS source, rate,
                 (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) AS bin, count(*) AS n
          FROM rates, (VALUES (0), (1), (2)) AS levels (level) GROUP BY ALL),
    c AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY bin) AS so_far,
                 sum(n) OVER (PARTITION BY level, lang, source, rate) AS total FROM h),
    q AS (SELECT level, lang, source, rate, min(bin) FILTER (4 * so_far >= total) AS q1, min(bin) FILTER (4 * so_far >= 3 * total) AS q3
          FROM c WHERE total >= 100 GROUP BY ALL),
    f AS MATERIALIZED (SELECT level, lang, source, rate, q3 + 3 * greatest(q3 - q1, spread) AS high,
                              CASE WHEN rate = 1 THEN q1 - 3 * greatest(q3 - q1, spread) ELSE -1 END AS low
                       FROM q JOIN (VALUES (1, 500), (2, 30), (3, 100), (4, 150)) AS s (rate, spread) USING (rate)),
    x AS (SELECT row, min(rates.rate) AS first FROM rates
          LEFT JOIN f f2 ON f2.level = 2 AND f2.rate = rates.rate AND f2.lang IS NOT DISTINCT FROM rates.lang AND f2.source IS NOT DISTINCT FROM rates.source
          LEFT JOIN f f1 ON f1.level = 1 AND f1.rate = rates.rate AND f1.lang IS NOT DISTINCT FROM rates.lang
          LEFT JOIN f f0 ON f0.level = 0 AND f0.rate = rates.rate
          WHERE v > coalesce(f2.high, f1.high, f0.high) OR v < coalesce(f2.low, f1.low, f0.low) GROUP BY row)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND x.first IS NULL AS kept,
           CASE WHEN base_failed THEN 'base' ELSE ['word_length', 'symbols', 'repeated_words', 'repeated_lines'][x.first] END AS rule
    FROM b LEFT JOIN x USING (row)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality.measured(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")).drop("text")
    return quality.judged(docs).select("doc_id", *quality.MEASURES, "kept", "rule")
