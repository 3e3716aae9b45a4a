from tickstone.functions.scalars import (
    format_ts,
    initial,
    initial_pandas,
    literal,
    lookup,
    micros,
    render_details,
    safe_double,
    safe_long,
    signed_change,
    stable_bucket,
)

__all__ = [
    "format_ts",
    "initial",
    "initial_pandas",
    "literal",
    "lookup",
    "micros",
    "render_details",
    "safe_double",
    "safe_long",
    "signed_change",
    "stable_bucket",
]
