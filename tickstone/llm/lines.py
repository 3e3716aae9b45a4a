"""Repeated passages of whole lines, found by winnowing and deleted where they come again.

A document is its lines with at least one word, in order.  A run of consecutive lines with ``least`` words or more that
stands at an earlier place as well (in a document before, or before in the same document) is deleted at the later
place.  Documents are ordered by id (NULL last), then by a hash of their text.

* The window of a line holds the lines from it until ``least`` words are reached, once forward and once backward.  Its
  smallest line hash is its fingerprint.  Two equal runs of ``least`` words hold an equal window and so share a
  fingerprint: windows whose fingerprint is chosen at one place only cannot be repeated and are dropped.
* The places of equal windows are joined with the first of them.
* Matches extend both ways: each line of a repeated run lies in a forward window that begins or a backward window
  that ends in the run, so the union of its repeated windows is the longest common run.

Windows are compared by two hashes of their line hashes (96 bits).  A first place is a minimum and never a list of
occurrences, so a passage that a third of all documents share is one row per task before the exchange.

Lines without words are kept.  NULL and empty texts have no lines and are kept.  Rows of one id and one text are one
document and get one result, so they are not copies of each other; equal texts under different ids are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickstone.llm.common import n_words, written

LEAST = 50


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _lines(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(doc_id, th, pos, words, hash) of the lines with words, once for each document."""
    rows = docs.where(F.col(text).isNotNull())
    rows = rows.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    rows = rows.select("doc_id", "th", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    rows = rows.select("doc_id", "th", "pos", n_words(F.col("line")).alias("words"), F.xxhash64("line", F.lit(7)).alias("hash"))
    order = Window.partitionBy("doc_id", "th").orderBy("pos")
    rows = rows.where("words > 0").withColumn("again", F.lag("pos").over(order).eqNullSafe(F.col("pos")))
    return rows.where("not again").drop("again")


def _windows(lines: DataFrame, least: int) -> DataFrame:
    """(doc_id, th, pos, side, positions, mark, mark_pos, content, check) of all full windows.

    ``pos`` is the line a window starts from, ``mark`` its fingerprint and ``mark_pos`` where that stands.
    """
    document = Window.partitionBy("doc_id", "th")
    own = lines.withColumn("end", F.sum("words").over(document.orderBy("pos")))
    own = own.withColumn("rest", F.sum("words").over(document) - F.col("end"))
    own = own.withColumn("before", F.col("end") - F.col("words"))
    line = F.struct("hash", "pos")
    ahead = F.collect_list(line).over(document.orderBy("before").rangeBetween(Window.currentRow, least - 1))
    behind = F.collect_list(line).over(document.orderBy("rest").rangeBetween(Window.currentRow, least - 1))
    own = own.withColumn("ahead", F.when(F.col("rest") + F.col("words") >= least, ahead))
    own = own.withColumn("behind", F.when(F.col("end") >= least, behind))
    sides = [F.struct(F.lit(side).alias("side"), F.col(name).alias("lines")) for side, name in ((1, "ahead"), (-1, "behind"))]
    own = own.select("doc_id", "th", "pos", F.explode(F.array(*sides)).alias("w")).where("w.lines is not null")
    least_line = F.array_min("w.lines")
    return own.select(
        "doc_id",
        "th",
        "pos",
        F.col("w.side").alias("side"),
        F.col("w.lines.pos").alias("positions"),
        least_line["hash"].alias("mark"),
        least_line["pos"].alias("mark_pos"),
        F.xxhash64("w.lines.hash", "w.side").alias("content"),
        F.hash("w.lines.hash").alias("check"),
    )


def repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, th, positions): the lines to delete, of each document that has some; ``th`` is xxhash64 of its text."""
    found = written(_windows(_lines(docs, id_column, text), least), "windows")
    marks = found.select("mark", "doc_id", "th", "mark_pos").distinct()
    shared = marks.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th", "pos")
    live = found.join(shared, "mark", "left_semi").withColumn("place", place)
    firsts = live.groupBy("content", "check").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    later = live.join(firsts.where("n > 1"), ["content", "check"]).where("place > first")
    spans = later.select("doc_id", "th", F.explode("positions").alias("pos"))
    return spans.groupBy("doc_id", "th").agg(F.collect_set("pos").alias("positions"))


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST, removed: str = "n_removed"):
    """``docs`` with repeated runs deleted from ``text``, and how many lines went in ``removed``."""
    gone = repeats(docs, id_column, text, least)
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("th").alias("_gone_th"), F.col("positions").alias("_gone"))
    own = F.col(id_column).cast("long").eqNullSafe(F.col("_gone_id")) & (F.xxhash64(text) == F.col("_gone_th"))
    out = docs.join(gone, own & F.col(text).isNotNull(), "left")
    lines = split_lines(F.col(text))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    rest = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    out = out.withColumn(removed, F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long"))
    out = out.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(rest))
    return out.drop("_gone_id", "_gone_th", "_gone")
