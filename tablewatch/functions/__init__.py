"""Column expressions shared by the operators (all JVM-side built-ins)."""

from tablewatch.functions.exprs import (  # noqa: F401
    epoch_micros_to_ts,
    mean_k_smallest,
    quote_ident,
    rank_key,
    round_doubles,
    zscore_expr,
)
