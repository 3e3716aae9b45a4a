"""Personal data by weak supervision, in DataFrame functions alone.

Base spans are those of fixed patterns and tests.  Beyond them, a wider pattern proposes candidate spans: spelled-out
addresses, numbers grouped like phone numbers, names after a title, and long keys.  Labelers vote on each candidate or
abstain: its form, gazetteers (domain endings, given names, words that are no name), and words before it that speak for or against.

Votes are counted per kind and vote pattern over all candidates.  Expectation-maximisation on these counts estimates
how reliable every labeler is and how likely each pattern is a hit; a logistic classifier of the votes and of the
span's shape is then fitted to those probabilities, and decides.  There are at most ``3 ** 5`` patterns, 3 shapes and 4
kinds, so only a bounded table of counts reaches the driver, whatever the input.

Candidates that touch a base span are dropped; base spans always stay.  NULL and empty texts have no spans.  Rows are
independent of each other except for the counts.  Further columns are kept, but for the text itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstone.llm.common import written

KINDS = ["email", "ip", "card", "phone", "name", "secret"]

# Patterns of the base spans.  Where a run of characters cannot match, its later parts cannot either, so each run is
# tried once and never given back; the matches are those of the plain patterns.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Candidates.
_SPELLED = r"(?<![A-Za-z0-9._-])[A-Za-z0-9][A-Za-z0-9._-]*+ ?[(\[] ?at ?[)\]] ?[A-Za-z0-9-]+(?: ?[(\[] ?dot ?[)\]] ?[A-Za-z]+|\.[A-Za-z]+)+"
_NUMBER = r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,5}\)?[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z.-])"
_NAME = r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.? [A-ZÄÖÜÉ][a-zà-ÿ]+(?: [A-ZÄÖÜÉ][a-zà-ÿ]+)?"
_SECRET = r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*[0-9])[A-Za-z0-9_/+-]{24,}+"
CANDIDATE = f"{_SPELLED}|{_NUMBER}|{_NAME}|{_SECRET}"

# Gazetteers and context words of the labelers.
ENDINGS = "com org net edu gov io de fr es uk info"
GIVEN = "anna maria peter thomas michael john mary james linda jean marie pierre carlos jose luis laura"
WORDS_FOR = {
    "email": "mail|e-mail|contact|write",
    "phone": "tel|phone|call|fon|fax|mobile|cell|telefon",
    "name": "name|by|from|dear|signed",
    "secret": "token|key|secret|password|passwd|auth|bearer",
}
WORDS_AGAINST = "version|isbn|order|page|chapter|figure|sha|commit|checksum|no|id"


def _found(text: Column, pattern: str) -> Column:
    """Matches in order, as (start, end, value, before): code points, and the text since the match before."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pieces = F.zip_with(matches, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g")))  # the last gap has no match
    kind = "array<struct<start:int,end:int,value:string,before:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def add(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["g"])
        end = begin + F.coalesce(F.length(p["m"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), p["m"].alias("value"), p["g"].alias("before"))
        out = F.when(p["m"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span)))
        return F.struct(end.alias("at"), out.alias("out"))

    return F.aggregate(pieces, start, add, lambda acc: acc["out"])


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,value:string,before:string>>")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _as_kind(spans: Column, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(F.lit(KINDS.index(kind)).alias("order"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")),
    )


def base_spans(docs: DataFrame, text: str, out: str = "base") -> DataFrame:
    """``docs`` with an array of (order, start, end, kind) of the base spans, in order."""
    t = F.coalesce(F.col(text), F.lit(""))
    some = docs.withColumn("_email", F.when(t.contains("@"), _found(t, EMAIL)).otherwise(_none()))
    has_digit = t.rlike("[0-9]")
    part = lambda p: F.regexp_replace(p, "^0+", "")
    small = lambda p: (F.length(part(p)) <= 3) & (F.lpad(part(p), 3, "0") <= "255")
    ips = F.filter(_found(t, IP), lambda s: F.forall(F.split(s["value"], r"\."), small))
    some = some.withColumn("_ip", F.when(has_digit, ips).otherwise(_none()))
    some = some.withColumn("_card", F.when(has_digit, F.filter(_found(t, CARD), lambda s: _luhn(s["value"]))).otherwise(_none()))
    phones = F.filter(_found(t, PHONE), lambda s: F.length(_digits(s["value"])).between(9, 15))
    some = some.withColumn("_phone", F.when(t.contains("+"), phones).otherwise(_none()))
    base = F.concat(_as_kind(F.col("_email"), "email"), _as_kind(F.col("_ip"), "ip"), _as_kind(F.col("_card"), "card"), _as_kind(F.col("_phone"), "phone"))
    return some.withColumn(out, base).drop("_email", "_ip", "_card", "_phone")


def _word(words: str) -> str:
    return rf"(?i)(?<![a-z])(?:{words})[^a-z]{{0,6}}$"


def candidates(docs: DataFrame, text: str, base: str = "base", out: str = "candidates") -> DataFrame:
    """``docs`` with an array of (start, end, kind, votes, shape); votes are five of 0 (no), 1 (hit), 2 (abstains)."""
    t = F.coalesce(F.col(text), F.lit(""))
    clear = lambda s: ~F.exists(F.col(base), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    found = docs.withColumn("_found", F.filter(_found(t, CANDIDATE), clear))
    vote = lambda yes, no: F.when(yes, "1").when(no, "0").otherwise("2")
    never = F.lit(False)

    def judged(s: Column) -> Column:
        value, before = s["value"], F.substring(s["before"], -40, 40)
        kind = F.when(value.rlike(r"[(\[] ?at"), "email").when(value.rlike(r"^\(?[0-9]{2,5}\)?[ ./-]"), "phone")
        kind = kind.when(value.rlike(f"^(?:{_NAME})$"), "name").otherwise("secret")
        digits = F.length(_digits(value))
        is_ = lambda k: kind == k
        ends = value.rlike(rf"(?i)(?:\.|[)\]] ?)(?:{ENDINGS.replace(' ', '|')})$")
        given = value.rlike(rf"(?i) (?:{GIVEN.replace(' ', '|')})(?: |$)")
        form = F.when(is_("email"), vote(value.rlike(r"^\S+ ?[(\[]at"), never)).when(is_("phone"), vote(digits.between(9, 11), digits < 8))
        form = form.when(is_("name"), vote(value.rlike(r" [A-Z]\S+ [A-Z]"), never))
        form = form.otherwise(vote(value.rlike("^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[A-Za-z0-9]{32,})$"), digits < 4))
        gazetteer = F.when(is_("email"), vote(ends, ~ends)).when(is_("name"), vote(given, never)).otherwise("2")
        cue = F.lit(False)
        for name, words in WORDS_FOR.items():
            cue = cue | (is_(name) & before.rlike(_word(words)))
        against = before.rlike(_word(WORDS_AGAINST))
        # what encloses it: an assignment or quotes speak for a key, a separator for a number
        placed = F.when(is_("secret"), vote(before.rlike(r"[=:]\s*[\"']?$"), before.rlike(r"/$")))
        placed = placed.when(is_("phone"), vote(before.rlike(r"[:(]\s*$"), before.rlike(r"[0-9$€]\s*$"))).otherwise("2")
        shape = F.when(F.length(value) < 16, 0).when(F.length(value) < 36, 1).otherwise(2)
        votes = F.concat(form, gazetteer, vote(cue, never), vote(never, against), placed)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), kind.alias("kind"), votes.alias("votes"), shape.alias("shape"))

    return found.withColumn(out, F.transform("_found", judged)).drop("_found")


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def train(counts: list[tuple[str, str, int, int]], rounds: int = 50) -> dict[str, float]:
    """Probability of a hit by ``kind|votes|shape``, from counts of (kind, votes, shape, n)."""
    out = {}
    for kind in sorted({c[0] for c in counts}):
        own = sorted((v, s, n) for k, v, s, n in counts if k == kind)
        n_votes = len(own[0][0])
        total = sum(n for *_, n in own)
        # a labeler's chance of each vote for hits and for others; it starts as better than chance
        right = [[0.7, 0.3] for _ in range(n_votes)]  # P(vote 1 | hit), P(vote 1 | other), of those that vote
        share, hit = 0.5, {}
        for _ in range(rounds):
            for votes, _, _ in own:
                a, b = math.log(share), math.log(1 - share)
                for j, v in enumerate(votes):
                    if v != "2":
                        a += math.log(right[j][0] if v == "1" else 1 - right[j][0])
                        b += math.log(right[j][1] if v == "1" else 1 - right[j][1])
                hit[votes] = _sigmoid(a - b)
            share = min(0.95, max(0.05, (sum(n * hit[v] for v, _, n in own) + 1) / (total + 2)))
            for j in range(n_votes):
                sums = [[1.4, 0.6], [0.6, 1.4]]  # a weak prior that labelers are better than chance: [hit, other][for, against]
                for votes, _, n in own:
                    if votes[j] != "2":
                        side = 0 if votes[j] == "1" else 1
                        sums[0][side] += n * hit[votes]
                        sums[1][side] += n * (1 - hit[votes])
                right[j] = [s[0] / sum(s) for s in sums]
        # the span classifier: votes as +1, 0, -1 and the shape, fitted to the probabilities
        rows = [([1.0, *[(v == "1") - (v == "0") for v in votes], *[float(shape == i) for i in (1, 2)]], hit[votes], n) for votes, shape, n in own]
        w = [0.0] * len(rows[0][0])
        scale = sum(n for *_, n in rows)
        for _ in range(2000):
            step = [-1e-3 * x for x in w]
            for x, y, n in rows:
                rest = n / scale * (y - _sigmoid(sum(a * b for a, b in zip(w, x, strict=True))))
                step = [s + rest * a for s, a in zip(step, x, strict=True)]
            w = [a + 2.0 * s for a, s in zip(w, step, strict=True)]
        for (votes, shape, _), (x, _, _) in zip(own, rows, strict=True):
            out[f"{kind}|{votes}|{shape}"] = _sigmoid(sum(a * b for a, b in zip(w, x, strict=True)))
    return out


def _name(c: Column) -> Column:
    return F.concat_ws("|", c["kind"], c["votes"], c["shape"].cast("string"))


def find(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without ``text`` but with ``base`` and ``spans``: arrays of (order, start, end, kind).

    ``spans`` has the base spans and those that the classifier adds.  Patterns run once: what they find is written to the
    shared folder, counted, and read again for the decision.
    """
    found = written(candidates(base_spans(docs.drop("base", "spans", "candidates"), text), text).drop(text), "candidates")
    counts = found.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes", "c.shape").agg(F.count("*").alias("n"))
    known = train([tuple(r) for r in counts.collect()])  # at most 4 x 3**5 x 3 rows
    hits = sorted(k for k, p in known.items() if p >= least)
    chosen = F.filter("candidates", lambda c: F.array_contains(F.array(*map(F.lit, hits)), _name(c)) if hits else F.lit(False))
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    added = F.transform(
        chosen, lambda c: F.struct(order[c["kind"]].alias("order"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))
    )
    return found.withColumn("spans", F.array_sort(F.concat("base", added))).drop("candidates")


def written_out(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
