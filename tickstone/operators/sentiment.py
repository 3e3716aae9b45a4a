"""Lexicon sentiment of texts, as joins and sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The published normalisation constant, the score of an extreme text, the alert texts.
ALPHA = 15.0
EXTREME = 0.5
VERY_POSITIVE, VERY_NEGATIVE = "매우 긍정적", "매우 부정적"
ALERT_TEXT = "%s %s 뉴스: %s"
WORD = r"[\p{L}\p{N}']+"
# The published effect of a negation, and the share of a degree word's effect one, two and three words later.
NEGATED = -0.74
DAMPED = (1.0, 0.95, 0.9)


def full_text(title: str = "title", content: str = "content") -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(content, F.lit("")))


def label(score: Column | str, positive: float = 0.05, negative: float = -0.05) -> Column:
    value = F.col(score) if isinstance(score, str) else score
    return F.when(value >= positive, "positive").when(value <= negative, "negative").otherwise("neutral")


def sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    key: str,
    text: Column | None = None,
    positive: float = 0.05,
    negative: float = -0.05,
    negations: Sequence[str] = (),
    degrees: Mapping[str, float] | None = None,
) -> DataFrame:
    """(key, sentiment_score, sentiment_label) per text.

    ``lexicon`` has ``token`` (lower case) and ``valence``.  Texts themselves are never shuffled, only
    their words where Spark does not broadcast the lexicon.

    Up to three words before a word change its valence: one of ``degrees`` moves it away from 0 (or, if negative, towards 0)
    by its number, less from further away; then one of ``negations`` turns it round.
    """
    words = F.regexp_extract_all(F.lower(text if text is not None else full_text()), F.lit(WORD), F.lit(0))
    plain = not negations and not degrees
    listed = df.select(key, words.alias("_words"))
    words = F.col("_words")
    if not plain:
        words = F.transform(words, lambda word, i: _in_context(F.col("_words"), word, i, negations, degrees or {}))
    tokens = listed.select(key, F.explode_outer(words).alias("token"))
    if not plain:
        tokens = tokens.select(key, "token.*")
    valued = tokens.join(lexicon.select("token", "valence"), "token", "left")
    valence = F.col("valence")
    if not plain:
        valence = valence + F.signum(valence) * F.col("degree")
        valence = F.when(F.col("negated"), valence * F.lit(NEGATED)).otherwise(valence)
    total = F.coalesce(F.sum(valence), F.lit(0)).cast("double")
    scored = valued.groupBy(key).agg((total / F.sqrt(total * total + F.lit(ALPHA))).alias("sentiment_score"))
    return scored.withColumn("sentiment_label", label("sentiment_score", positive, negative))


def _in_context(words: Column, word: Column, at: Column, negations: Sequence[str], degrees: Mapping[str, float]) -> Column:
    """A word with what the three words before it do to its valence.  The lists are short and become literals."""
    before = [F.get(words, at - back) for back in (1, 2, 3)]
    negated, degree = F.lit(False), F.lit(0.0)
    if negations:
        negated = reduce(lambda x, y: x | y, [F.coalesce(w.isin(list(negations)), F.lit(False)) for w in before])
    if degrees:
        known = F.create_map(*[F.lit(x) for pair in degrees.items() for x in (pair[0], float(pair[1]))])
        degree = sum((F.coalesce(F.try_element_at(known, w), F.lit(0.0)) * share for w, share in zip(before, DAMPED, strict=True)), degree)
    return F.struct(word.alias("token"), negated.alias("negated"), degree.alias("degree"))


def sentiment_results(df: DataFrame, scores: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Scores together with other columns of the texts."""
    return df.select(key, *columns).join(scores, key)


def sentiment_alerts(results: DataFrame) -> DataFrame:
    """Alerts for extreme scores; exactly +-0.5 is not extreme."""
    extreme = results.where(F.abs("sentiment_score") > EXTREME)
    mood = F.when(F.col("sentiment_score") > EXTREME, VERY_POSITIVE).otherwise(VERY_NEGATIVE)
    return extreme.withColumns(
        {
            "type": F.lit("sentiment_alert"),
            "message": F.format_string(ALERT_TEXT, F.col("ticker").cast("string"), mood, F.col("title")),
            "severity": F.lit("medium"),
        }
    )
