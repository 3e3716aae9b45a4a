"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words.  A document is taken ``floor(target / source size)`` times for certain.
What is left of the target is drawn without repetition: with ``p`` the part of the source that is still wanted, each
document gets a random number u from its id and is ranked by ``(u / (1 - u)) / (p / (1 - p))``; documents are taken in
this order until the words wanted are reached (the last one if at least half of it fits), so the size is fixed
and only its members are random.

Running totals are not formed over whole sources.  Ranks fall into ``BINS`` bins; sums per source and bin show in
which bin the total is reached, and only that bin's documents are put in order.

A NULL or empty text has size 0 and is taken with the rest for nothing; a NULL source is a source of its own, the
last.  Rows of one id have one random number.  Rows of one id and size are equals: they are drawn alike, unless the total
is reached among them; then as many of them are drawn as fit, which ones depends on the order in which they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickstone.llm.common import written

BINS = 1 << 14


def uniform(id_column: str, seed: int) -> Column:
    """A number between 0 and 1 from the id, the same in every run."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sized: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Targets share ``share`` of all sizes by weight; none is above ``most`` times its source.  Taking sources in the order
    of that limit per weight, a source is at its limit if the common rate of all later ones would lift it there.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    number = F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1
    rows = sources.withColumn("number", number)
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")))
    rows = rows.withColumn("cap", F.col("source_size") * most)
    order = everything.orderBy(F.col("cap") / F.col("weight"), "number")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * share
    rate = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = rows.withColumn("rate", rate)
    rows = rows.withColumn("free", F.col("rate") * F.col("weight") < F.col("cap"))
    common = F.first(F.when(F.col("free"), F.col("rate")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    rows = rows.withColumn("common", common)
    target = F.when(F.col("free"), F.col("common") * F.col("weight")).otherwise(F.col("cap"))
    return rows.select("source", "source_size", target.alias("target"))


def mixed(
    docs: DataFrame,
    size: Column,
    id_column: str = "doc_id",
    source: str = "source",
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (words, repeats counted); such columns are replaced."""
    own = ["size", "source_size", "target", "copies", "taken"]
    docs = docs.drop(*own).withColumn("size", size)
    sized = docs.select(F.col(source).alias("source"), F.col("size"), uniform(id_column, seed).alias("u"), F.col(id_column).alias("doc_id"))
    sized = written(sized, "sizes")
    sources = written(targets(sized, weights, share, most), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = sources.withColumn("whole", F.floor(ratio))
    sources = sources.withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))
    sources = sources.withColumn("p", F.when(F.col("source_size") > 0, F.col("wanted") / F.col("source_size")).otherwise(0.0))
    odds = F.col("p") / (1 - F.col("p"))
    rank = F.when(F.col("p") > 0, F.col("u") / (F.col("u") + (1 - F.col("u")) * odds)).otherwise(1.0)
    plan = sources.select(F.col("source").alias("_source"), "source_size", "target", "whole", "wanted", "p")

    def ranked(rows: DataFrame) -> DataFrame:
        rows = rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn("rank", rank)
        return rows.withColumn("bin", F.least(F.floor(F.col("rank") * BINS), F.lit(BINS - 1)))

    bins = ranked(sized).groupBy("source", "bin").agg(F.sum("size").alias("n"), F.first("wanted").alias("wanted"))
    upto = Window.partitionBy("source").orderBy("bin")
    bins = bins.withColumn("reached", F.sum("n").over(upto))
    full = bins.where("reached > wanted").groupBy("source").agg(F.min(F.struct("bin", (F.col("reached") - F.col("n")).alias("before"))).alias("cut"))
    cuts = written(full.select(F.col("source").alias("_cut"), "cut.bin", "cut.before"), "cuts").withColumnRenamed("bin", "cut_bin")
    edge = ranked(sized).join(cuts, F.col("source").eqNullSafe(F.col("_cut")) & (F.col("bin") == F.col("cut_bin")))
    # in the bin where the total is reached; equal rows are one place
    edge = edge.groupBy("source", "rank", "doc_id", "size").agg(F.count("*").alias("equals"), F.first("before").alias("before"), F.first("wanted").alias("wanted"))
    order = Window.partitionBy("source").orderBy("rank", F.asc_nulls_last("doc_id"), "size")
    upto = F.sum(F.col("size") * F.col("equals")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    edge = edge.withColumn("start", F.col("before") + upto - F.col("size") * F.col("equals"))
    fits = lambda n: F.col("start") + n * F.col("size") - F.col("size") / 2 <= F.col("wanted")
    guess = F.floor((F.col("wanted") - F.col("start")) / F.greatest("size", F.lit(1)) + 0.5)  # may be one off by rounding
    fit = F.when(F.col("size") <= 0, F.when(fits(F.lit(1)), F.col("equals")).otherwise(0))
    fit = fit.when(fits(guess + 1), guess + 1).when(fits(guess), guess).otherwise(guess - 1)
    edge = edge.withColumn("fit", F.least(fit, "equals"))
    edge = edge.withColumn("place", F.struct("rank", F.col("doc_id").isNull().alias("last"), "doc_id", "size"))
    last = edge.where("fit > 0").groupBy("source").agg(F.max(F.struct("place", "fit", "equals")).alias("l"))
    last = last.select(F.col("source").alias("_last"), F.col("l.place").alias("last_place"), "l.fit", (F.col("l.fit") < F.col("l.equals")).alias("split"))
    last = written(last, "last")

    named = {c: f"_in_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(
        *[F.col(c).alias(n) for c, n in named.items()],
        F.col(source).alias("source"),
        F.col("size"),
        F.col(id_column).alias("doc_id"),
        uniform(id_column, seed).alias("u"),
    )
    inner = ranked(inner).join(cuts, F.col("source").eqNullSafe(F.col("_cut")), "left")
    inner = inner.join(last, F.col("source").eqNullSafe(F.col("_last")), "left")
    place = F.struct("rank", F.col("doc_id").isNull().alias("last"), "doc_id", "size")
    drawn = F.when(F.col("p") <= 0, 0).when(F.col("cut_bin").isNull() | (F.col("bin") < F.col("cut_bin")), 1)
    drawn = drawn.when((F.col("bin") == F.col("cut_bin")) & (place <= F.col("last_place")), 1).otherwise(0)
    if not last.where("split").isEmpty():
        # only some of the equal rows of the last place fit: these are numbered, by part of the table and in it
        among = F.coalesce(F.col("split") & (F.col("bin") == F.col("cut_bin")) & (place == F.col("last_place")), F.lit(False))
        equals = written(inner.where(among).withColumn("_row", F.monotonically_increasing_id()), "equals")
        equals = equals.withColumn("_part", F.shiftright("_row", 33))
        parts = equals.groupBy("source", "_part").agg(F.count("*").alias("n"))
        earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select(F.col("source").alias("_of"), F.col("_part").alias("_of_part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_earlier"))
        equals = equals.join(parts, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_of_part")))
        number = F.row_number().over(Window.partitionBy("source", "_part").orderBy("_row")) + F.col("_earlier")
        equals = equals.withColumn("_drawn", (number <= F.col("fit")).cast("int")).select(*inner.columns, "_drawn")
        inner = inner.where(~among).withColumn("_drawn", F.lit(None).cast("int")).unionByName(equals)
        drawn = F.when(F.col("_drawn").isNotNull(), F.col("_drawn")).otherwise(drawn)
    copies = F.col("whole") + F.coalesce(drawn, F.lit(0))
    out = inner.select(
        *[F.col(n).alias(c) for c, n in named.items() if c != "size"],
        F.col("size"),
        F.col("source_size"),
        F.col("target"),
        copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )
    return out
