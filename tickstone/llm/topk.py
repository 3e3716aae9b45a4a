"""Exact nearest vectors by inner product, with vector-approximation files.

Vectors become integers, ``floor(scale * x)``.  Candidates are cut into blocks; a block keeps, for each vector, one
byte per dimension: the cell of a grid between the block's smallest and largest value.  A query's product with the
grid's edges bounds its product with every vector of the block from below and above.

1. Blocks of queries meet blocks of approximations.  Each pair of blocks hands on the vectors whose upper bound reaches
   the block's k-th best lower bound.  Over all blocks of a query the same test is made again.
2. Exact vectors are read in order of their bounds: first the ``2 k`` most promising of each query, whose k-th best exact
   score is then certain to be reached; afterwards every other vector whose upper bound reaches it.  No bound, no
   count and no tie ends the search early, so the result is exact.

Of equal vectors only those with the ``k + 1`` smallest ids can be among the results (one of them may be the query), so
only these become candidates: a vector that a third of all rows share costs no more than others.

Vectors that are NULL, empty or hold a NULL or non-finite component take no part.  Vectors are compared with vectors of
their own length.  Rows of one id count once (the smallest vector); a NULL id takes no part.  Products must fit a
64-bit integer.  Fewer than ``k`` candidates give all of them; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickstone.llm.common import written

QUERY_BLOCK, BLOCK = 512, 4096
CELLS = 64


def integers(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    x = F.col(column)
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.where(F.col(id_column).isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(whole)
    v = F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long"))
    rows = rows.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _blocks(rows: DataFrame, size: int, n: int) -> DataFrame:
    """(dim, ids, values): at most ``size`` vectors of one length in a row."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}

        def out(dim: int) -> pd.DataFrame:
            rows = held.pop(dim)
            ids = np.array([i for i, _ in rows], dtype=np.int64)
            values = np.array([v for _, v in rows], dtype=np.int64)
            return pd.DataFrame({"dim": [dim], "ids": [ids.tobytes()], "values": [values.tobytes()]})

        for batch in batches:
            for i, v in zip(batch["vec_id"], batch["v"], strict=True):
                held.setdefault(len(v), []).append((i, v))
                if len(held[len(v)]) == size:
                    yield out(len(v))
        for dim in list(held):
            yield out(dim)

    return rows.repartition(max(1, -(-n // size))).mapInPandas(pack, "dim int, ids binary, values binary")


def _approximated(blocks: DataFrame) -> DataFrame:
    """Approximation file of each block: the grid's lower and upper cell edges, and a byte per vector and dimension."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for dim, ids, values in zip(batch["dim"], batch["ids"], batch["values"], strict=True):
                v = np.frombuffer(values, dtype=np.int64).reshape(-1, dim)
                low = v.min(axis=0)
                width = -(-(v.max(axis=0) - low + 1) // CELLS)
                cells = ((v - low) // width).astype(np.uint8)
                out.append((dim, ids, low.tobytes(), width.tobytes(), cells.tobytes()))
            yield pd.DataFrame(out, columns=["dim", "ids", "low", "width", "cells"])

    return blocks.mapInPandas(cut, "dim int, ids binary, low binary, width binary, cells binary")


def _kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """k-th largest of each row, the smallest if there are fewer."""
    k = min(k, values.shape[1])
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def _scan(pairs: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, low, high) of the pairs of each two blocks that the bounds leave over."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                q_ids = np.frombuffer(r.q_ids, dtype=np.int64)
                q = np.frombuffer(r.q_values, dtype=np.int64).reshape(-1, r.dim).astype(np.float64)
                ids = np.frombuffer(r.ids, dtype=np.int64)
                low, width = np.frombuffer(r.low, dtype=np.int64), np.frombuffer(r.width, dtype=np.int64)
                cells = np.frombuffer(r.cells, dtype=np.uint8).reshape(-1, r.dim).astype(np.int64)
                bottom = (low + cells * width).astype(np.float64)
                span = (width - 1).astype(np.float64)
                # the product with a cell's lower edge, and how much the cell's extent can add or take
                base = q @ bottom.T
                slack = 1e-12 * (np.abs(q) @ np.abs(bottom).max(axis=0) + np.abs(q) @ span)[:, None]  # of the arithmetic
                upper = base + (np.maximum(q, 0) @ span)[:, None] + slack
                lower = base + (np.minimum(q, 0) @ span)[:, None] - slack
                own = q_ids[:, None] == ids[None, :]
                least = _kth_largest(np.where(own, -np.inf, lower), k)
                i, j = np.nonzero((upper >= least[:, None]) & ~own)
                yield pd.DataFrame({"query_id": q_ids[i], "vec_id": ids[j], "low": lower[i, j], "high": upper[i, j]})

    return pairs.mapInPandas(scan, "query_id long, vec_id long, low double, high double")


def _exact(pairs: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query_id, vec_id, score) with the exact product."""
    rows = pairs.select("query_id", "vec_id").join(vectors, "vec_id")
    rows = rows.join(queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), "query_id")
    product = F.aggregate(F.zip_with("v", "q", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    return rows.select("query_id", "vec_id", product.alias("score"))


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) for integer vectors (vec_id, v); a query is not its own candidate."""
    vectors, queries = written(vectors, "vectors"), written(queries, "queries")
    same = Window.partitionBy("v").orderBy("vec_id")
    able = written(vectors.withColumn("same", F.row_number().over(same)).where(F.col("same") <= k + 1).drop("same"), "able")
    n, n_queries = able.count(), queries.count()
    left = _approximated(_blocks(able, BLOCK, n)).withColumn("block", F.monotonically_increasing_id())
    right = _blocks(queries, QUERY_BLOCK, n_queries).withColumn("q_block", F.monotonically_increasing_id())
    left, right = written(left, "blocks"), written(right, "query-blocks")
    # every block of queries meets every block of vectors of its length; each pair is a row of its own
    names = right.groupBy("dim").agg(F.collect_list("q_block").alias("q_blocks"))
    pairs = left.join(names, "dim").withColumn("q_block", F.explode("q_blocks")).drop("q_blocks")
    pairs = pairs.join(right.select("q_block", F.col("ids").alias("q_ids"), F.col("values").alias("q_values")), "q_block")
    left_over = written(_scan(pairs.repartition(F.col("block"), F.col("q_block")), k), "bounds")
    by_low = Window.partitionBy("query_id").orderBy(F.desc("low"), "vec_id")
    kth = left_over.withColumn("r", F.row_number().over(by_low)).where(F.col("r") <= k).groupBy("query_id").agg(F.min("low").alias("least"))
    open_ = written(left_over.join(kth, "query_id").where("high >= least").select("query_id", "vec_id", "high"), "open")
    by_high = Window.partitionBy("query_id").orderBy(F.desc("high"), "vec_id")
    first = open_.withColumn("r", F.row_number().over(by_high)).where(F.col("r") <= 2 * k)
    seen = written(_exact(first, queries, able), "seen")
    reached = _top(seen, k).groupBy("query_id").agg(F.min("score").alias("reached"), F.count("*").alias("n"))
    rest = open_.join(first.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_anti").join(reached, "query_id")
    rest = _exact(rest.where((F.col("high") >= F.col("reached")) | (F.col("n") < k)), queries, able)
    return _top(seen.unionByName(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
