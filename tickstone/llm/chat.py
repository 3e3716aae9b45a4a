"""Reply trees to training conversations.

Messages name their parent.  Iterative self-joins double the distance that every message looks up, so that after as
many rounds as the longest path has binary digits each knows its depth and the summed score of its path.  Messages
without a reply are leaves; their branches are ranked by mean score, ties by the leaf's id.  The chosen leaves then
walk the same jumps backwards, longest first, which names every message of a path exactly once.

A path becomes one text.  Each turn is marked, and control strings inside roles and texts get one backslash in
front, which ``parsed`` takes away again; a mark is never preceded by one, because a blank stands between.  ``loss``
holds the places of the assistant's texts.

NULL roles and texts are empty.  Rows of one conversation and id are one message (the smallest by parent, role, text
and score).  A parent that does not exist makes its children roots.  Messages on or below a circle of replies reach no
root and are part of no path.  Conversations without messages do not exist.  NULL conversation ids are one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickstone.llm.common import written

# The strings that steer this template or common ones.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[END]", "<<SYS>>", "<</SYS>>"]
_CONTROL = "(" + "|".join(re.escape(c) for c in CONTROLS) + ")"
_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) (?<!\\)\[/INST\]|<s> (?P<assistant>.*?) (?<!\\)</s>"
    r"|\[ROLE\] (?P<role>.*?) (?<!\\)\[/ROLE\] (?P<text>.*?) (?<!\\)\[END\]",
    re.DOTALL,
)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def unescaped(text: str) -> str:
    return re.sub(r"\\" + _CONTROL, r"\1", text)


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))


def paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """(conv_id, leaf_id, branch, score, msg_id, depth, role, text) of the ``branches`` best paths (None: all).

    ``messages`` has conv_id, msg_id, parent_id, role, text and score.
    """
    kept = messages.select("conv_id", "msg_id", "parent_id", "role", "text", F.coalesce("score", F.lit(0.0)).alias("score"))
    fields = F.struct("parent_id", "role", "text", "score")
    kept = kept.where("msg_id is not null").groupBy("conv_id", "msg_id").agg(F.min(fields).alias("m"))
    kept = written(kept.select("conv_id", "msg_id", "m.*"), "messages")
    slim = kept.select("conv_id", "msg_id", "parent_id", "score")
    up = slim.alias("c").join(slim.alias("p"), _same("c", "p") & F.expr("c.parent_id = p.msg_id"), "left")
    state = up.select("c.conv_id", "c.msg_id", F.col("p.msg_id").alias("up"), F.col("c.score").alias("total"), F.lit(1).cast("long").alias("steps"))
    first = state = written(state, "jumps")
    jumps, rooted = [state], state.where("up is null")
    most = slim.count()
    # a message that has reached its root is final; only the others look further up
    while not (open_ := state.where("up is not null")).isEmpty() and (1 << (len(jumps) - 1)) < most:
        joined = open_.alias("c").join(open_.unionByName(rooted).alias("p"), _same("c", "p") & F.expr("c.up = p.msg_id"), "left")
        state = joined.select(
            "c.conv_id",
            "c.msg_id",
            F.col("p.up").alias("up"),
            (F.col("c.total") + F.coalesce("p.total", F.lit(0.0))).alias("total"),
            (F.col("c.steps") + F.coalesce("p.steps", F.lit(0))).alias("steps"),
        )
        state = written(state, "jumps")
        jumps.append(state)
        rooted = rooted.unionByName(state.where("up is null"))  # others hang on a circle
    leaves = rooted.alias("c").join(first.alias("p"), _same("c", "p") & F.expr("c.msg_id = p.up"), "left_anti")
    order = Window.partitionBy("conv_id").orderBy(F.desc("mean"), "msg_id")
    leaves = leaves.withColumn("mean", F.col("total") / F.col("steps")).withColumn("branch", F.row_number().over(order))
    if branches is not None:
        leaves = leaves.where(F.col("branch") <= branches)
    walk = leaves.select("conv_id", F.col("msg_id").alias("leaf_id"), "branch", F.col("mean").alias("path_score"), "msg_id")
    for jump in reversed(jumps):
        step = jump.where("up is not null").select("conv_id", "msg_id", "up")
        more = walk.alias("c").join(step.alias("p"), _same("c", "p") & F.expr("c.msg_id = p.msg_id"))
        more = more.select("c.conv_id", "c.leaf_id", "c.branch", "c.path_score", F.col("p.up").alias("msg_id"))
        walk = written(walk.unionByName(more), "walk")
    depth = rooted.select("conv_id", "msg_id", F.col("steps").alias("depth"))
    walk = walk.alias("c").join(depth.alias("p"), _same("c", "p") & F.expr("c.msg_id = p.msg_id"))
    walk = walk.select("c.*", "p.depth")
    walk = walk.alias("c").join(kept.alias("p"), _same("c", "p") & F.expr("c.msg_id = p.msg_id"))
    empty = F.lit("")
    return walk.select(
        "c.conv_id",
        "c.leaf_id",
        "c.branch",
        F.col("c.path_score").alias("score"),
        "c.msg_id",
        "c.depth",
        F.coalesce("p.role", empty).alias("role"),
        F.coalesce("p.text", empty).alias("text"),
    )


def formatted(path_rows: DataFrame) -> DataFrame:
    """(conv_id, leaf_id, branch, score, formatted, loss): a row for each path; ``loss`` has (start, end) code points."""
    role, text = escaped(F.col("role")), escaped(F.col("text"))
    other = F.concat(F.lit("[ROLE] "), role, F.lit(" [/ROLE] "))
    opening = F.when(F.col("role") == "user", "[INST] ").when(F.col("role") == "assistant", "<s> ").otherwise(other)
    closing = F.when(F.col("role") == "user", " [/INST]").when(F.col("role") == "assistant", " </s>").otherwise(" [END]")
    turns = path_rows.withColumn("opening", opening).withColumn("body", text).withColumn("turn", F.concat("opening", "body", closing))
    order = Window.partitionBy("conv_id", "leaf_id").orderBy("depth")
    turns = turns.withColumn("start", F.sum(F.length("turn")).over(order) - F.length("turn") + F.length("opening"))
    span = F.when(F.col("role") == "assistant", F.struct(F.col("start").alias("start"), (F.col("start") + F.length("body")).alias("end")))
    rows = turns.select("conv_id", "leaf_id", "branch", "score", F.struct("depth", "turn", span.alias("span")).alias("t"))
    rows = rows.groupBy("conv_id", "leaf_id").agg(
        F.first("branch").alias("branch"), F.first("score").alias("score"), F.sort_array(F.collect_list("t")).alias("t")
    )
    spans = F.filter(F.col("t.span"), lambda s: s.isNotNull())
    return rows.select("conv_id", "leaf_id", "branch", "score", F.array_join("t.turn", "").alias("formatted"), spans.alias("loss"))


def conversations(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    return formatted(paths(messages, branches))


def linear(rows: DataFrame, id_column: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages of conversations without branches: each turn replies to the one before."""
    order = Window.partitionBy(id_column).orderBy(F.asc_nulls_first(turn), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    number = F.row_number().over(order).cast("long")
    out = rows.select(F.col(id_column).alias("conv_id"), number.alias("msg_id"), "role", "text")
    return out.select("conv_id", "msg_id", (F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def parsed(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted text as (role, text)."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        if m["user"] is not None:
            out.append(("user", unescaped(m["user"])))
        elif m["assistant"] is not None:
            out.append(("assistant", unescaped(m["assistant"])))
        else:
            out.append((unescaped(m["role"]), unescaped(m["text"])))
    return out


def read_back(rows: DataFrame) -> DataFrame:
    """Digests of formatted conversations, from ``formatted`` and ``loss`` alone."""
    kind = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    @F.pandas_udf(kind)
    def digests(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, losses in series:
            out = []
            for text, loss in zip(texts, losses, strict=True):
                turns = parsed(text)
                learned = [unescaped(text[s["start"] : s["end"]]) for s in loss]
                whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass"))
                part = hashlib.sha256("".join(learned).encode("utf-8", "surrogatepass"))
                out.append((len(turns), whole.hexdigest(), sum(map(len, learned)), part.hexdigest(), len(text)))
            yield pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return rows.withColumn("d", digests("formatted", "loss")).select("conv_id", "d.*")
