"""Column-expression builders (pure Catalyst expressions, no UDFs)."""

from .expr import (  # noqa: F401
    blank, derived_key, has_whitespace, null_flag_count, recode_expr,
    segment_key, string_columns, try_pct,
)
