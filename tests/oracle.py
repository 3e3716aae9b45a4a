"""Compare registered queries with their SQL on the test tables.

Run as a script for a report: ``python tests/oracle.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value, digits):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr((value if digits is None else round(value, digits)) + 0.0)
    return str(value)


def normalised(frame, digits: int | None = None) -> tuple[list[str], list[tuple]]:
    """Column names in order, and rows as sorted tuples of text."""
    names = sorted(frame.column_names)
    columns = [frame.column(n).to_pylist() for n in names]
    return names, sorted(tuple(_cell(v, digits) for v in row) for row in zip(*columns, strict=True))


def differences(spark_df, con, sql: str) -> str | None:
    """None if both give the same columns and exactly the same values, in any row order."""
    got_names, got = normalised(spark_df.toArrow())
    want_names, want = normalised(con.execute(sql).to_arrow_table())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else None


def main(argv: list[str]) -> None:
    from tickstone.plans import REGISTRY
    from tickstone.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:] or list(REGISTRY)
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false"}
    spark = build_session(master="local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in wanted:
        q = REGISTRY[name]
        started = time.time()
        try:
            df = q.run(spark, sf_dir)
            message = differences(df, con, q.sql) if q.sql else f"rows {df.count()}"
        except Exception as error:  # a report goes on after a failure
            message = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok ' if message is None else '?? '} {name} {time.time() - started:.2f}s {message or ''}", flush=True)


if __name__ == "__main__":
    main(sys.argv)
