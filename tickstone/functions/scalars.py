"""Column expressions.  All but ``initial_pandas`` stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def literal(value, kind: T.DataType) -> Column:
    """Constant of type ``kind``, so that comparing it leaves the column uncast and pushable.

    A datetime without a zone is taken as UTC, whatever the zone of the driver's machine.
    """
    if isinstance(value, datetime):
        value = (value.astimezone(UTC).replace(tzinfo=None) if value.tzinfo else value).isoformat(sep=" ")
    return F.lit(value).cast(kind)


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch, for TIMESTAMP and (read as UTC) TIMESTAMP_NTZ columns."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def safe_double(column: Column | str) -> Column:
    """DOUBLE value; NULL, NaN, the texts ``nan``/``none`` and unparsable text give 0."""
    value = _col(column).cast("string").try_cast("double")
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def safe_long(column: Column | str) -> Column:
    """BIGINT value; NULL and unparsable text give 0."""
    return F.coalesce(_col(column).try_cast("bigint"), F.lit(0).cast("bigint"))


def format_ts(column: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp (or ISO text) rendered with ``pattern``; NULL when it does not parse."""
    return F.date_format(F.try_to_timestamp(_col(column).cast("string")), pattern)


def render_details(column: Column | str, drop: Sequence[str] = ("type", "ticker", "timestamp")) -> Column:
    """JSON object as ``k: v, k: v`` without the ``drop`` keys; null reads ``None``; other text is passed through."""
    raw = _col(column)
    pairs = F.map_filter(F.from_json(raw, "map<string,string>"), lambda k, _: ~k.isin(*drop))
    rendered = F.transform(F.map_entries(pairs), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("None"))))
    return F.coalesce(F.array_join(rendered, ", "), raw)


def lookup(column: Column | str, table: Mapping[str, str], default: str) -> Column:
    """Fixed small lookup table with a default."""
    key = _col(column)
    out = F
    for match, value in table.items():
        out = out.when(key == match, F.lit(value))
    return out.otherwise(F.lit(default))


def signed_change(current: Column | str, previous: Column | str) -> Column:
    """Percent change; NULL when the previous value is NULL or 0."""
    before = _col(previous)
    return (_col(current) - before) / F.nullif(before, F.lit(0.0)) * 100


def stable_bucket(column: Column | str, buckets: int) -> Column:
    """Bucket 0..buckets-1 from an MD5 prefix: the same in every process and every SQL engine."""
    prefix = F.substring(F.md5(_col(column).cast("string")), 1, 8)
    return F.pmod(F.conv(prefix, 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def initial(column: Column | str) -> Column:
    """Upper-cased first letter; NULL for NULL and empty text."""
    text = _col(column)
    return F.when(F.length(text) > 0, F.upper(F.substring(text, 1, 1)))


@F.pandas_udf(T.StringType())
def initial_pandas(names: pd.Series) -> pd.Series:
    """:func:`initial` as an Arrow-batched UDF, the shape for logic without a built-in."""
    return names.str.slice(0, 1).str.upper().where(names.str.len() > 0)
