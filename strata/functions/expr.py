"""Reusable Column expressions.

All return ``pyspark.sql.Column`` built from JVM built-ins, so every operator
that uses them stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import Recode


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def has_whitespace(c: str | Column) -> Column:
    """Leading/trailing space; NULL input gives NULL (three-valued, not counted)."""
    c = F.col(c) if isinstance(c, str) else c
    return c != F.trim(c)


def blank(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c) == F.lit("")


def quote_ident(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def sql_str(v) -> str:
    """A SQL literal for a Python str / int / float / None."""
    if v is None:
        return "CAST(NULL AS STRING)"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def null_flag_count(cols) -> Column:
    """Number of NULL columns in a row (completeness score, lower is better)."""
    cols = list(cols)
    if not cols:
        return F.lit(0)
    return F.expr(" + ".join(f"CAST({quote_ident(c)} IS NULL AS INT)" for c in cols))


def recode_sql(c: str, rule: Recode) -> str:
    """The CASE expression (SQL text) of a :class:`Recode` for column ``c`` (first match wins).

    NULL never matches an ``IN`` / ``=`` test, so it falls through to the NULL
    branch (or to the ELSE value) exactly like a hand-written chain.
    """
    q = quote_ident(c)
    branches = []
    for target, sources in rule.mapping:
        test = (f"{q} IN ({', '.join(sql_str(v) for v in sources)})" if len(sources) > 1
                else f"{q} = {sql_str(sources[0])}")
        branches.append(f"WHEN {test} THEN {sql_str(target)}")
    if rule.handle_null:
        branches.append(f"WHEN {q} IS NULL THEN {sql_str(rule.null_default)}")
    if rule.handle_blank:
        branches.append(f"WHEN trim({q}) = '' THEN {sql_str(rule.blank_default)}")
    rest = f"trim({q})" if rule.otherwise == "trim" else q
    return f"CASE {' '.join(branches)} ELSE {rest} END" if branches else rest


def recode_expr(c: str, rule: Recode) -> Column:
    return F.expr(recode_sql(c, rule))


def derived_key(prefix: str, c: str | Column, start: int) -> Column:
    """``prefix || substring(c, start)`` to the end of the string; NULL-propagating."""
    if isinstance(c, str):
        return F.expr(f"concat({sql_str(prefix)}, substring({quote_ident(c)}, {int(start)}))")
    return F.concat(F.lit(prefix), F.substring(c, start, 2147483647))


def segment_key(c: str | Column, sep: str = "-", parts: int = 2, joiner: str = "_") -> Column:
    """First ``parts`` ``sep``-separated segments joined by ``joiner``; NULL when a segment is missing.

    ``c`` is a Column, a column name, or a qualified reference such as ``"sls.product_key"``; ``sep`` is
    plain text, whatever it means in a pattern."""
    if not sep:
        raise ValueError("the separator must not be empty")
    sep = "".join(f"\\{ch}" if ch in "\\.[]{}()<>*+-=!?^$|" else ch for ch in sep)
    if isinstance(c, str):
        ref = c if "." in c else quote_ident(c)
        pieces = [f"try_element_at(split({ref}, {sql_str(sep)}), {i})" for i in range(1, parts + 1)]
        return F.expr(f"concat({f', {sql_str(joiner)}, '.join(pieces)})")
    arr = F.split(c, sep)
    cols: list[Column] = []
    for i in range(1, parts + 1):
        if i > 1:
            cols.append(F.lit(joiner))
        cols.append(F.try_element_at(arr, F.lit(i)))
    return F.concat(*cols)


def try_pct(num: Column, den: Column, digits: int = 1) -> Column:
    """round(num / den * 100, digits); NULL when den is 0."""
    return F.round(F.try_divide(num.cast("double"), den.cast("double")) * F.lit(100.0), digits)

