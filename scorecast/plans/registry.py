"""Registry of named queries and their DuckDB oracle SQL, plus SQL helpers.

Oracle helpers produce DuckDB text that computes the same values as the
Spark operators; rounding uses the scale / round-half-even / unscale rule on
both sides so that both engines land on identical doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.numeric import round_half_even
from ..schema import CATEGORY_MAPS, STRIP_CHARS
from ..sources.standin import HABITS_SQL

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------------------
# Spark-side output rounding
# ---------------------------------------------------------------------------


def rnd(col, places: int = 6) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return round_half_even(c, places)


# ---------------------------------------------------------------------------
# DuckDB-side helpers
# ---------------------------------------------------------------------------

WITH_HABITS = "WITH habits AS (" + HABITS_SQL + ")"


def dr(expr: str, places: int = 6) -> str:
    return f"(round_even(({expr}) * 1e{places}, 0) / 1e{places} + 0e0)"


def d_strip(x: str) -> str:
    return f"trim({x}, {' || '.join(f'chr({ord(c)})' for c in STRIP_CHARS)})"


def d_title(x: str) -> str:
    """``str.title()``: runs of letters get a capital."""
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '\\p{{L}}+|[^\\p{{L}}]+'), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '')")


def d_round_python(x: str, places: int = 2) -> str:
    """Python's ``round``, by the exact product of ``round_python``."""
    s = f"1e{places}"
    high = f"(({x}) * 134217729e0 - (({x}) * 134217729e0 - ({x})))"
    product = f"(({x}) * {s})"
    error = f"(({high} * {s} - {product}) + (({x}) - {high}) * {s})"
    whole = f"floor({product})"
    part = f"({product} - {whole})"
    up = f"({part} > 0.5e0 OR ({part} = 0.5e0 AND ({error} > 0 OR ({error} = 0 AND {whole} % 2 <> 0))))"
    return f"((CASE WHEN {up} THEN {whole} + 1e0 ELSE {whole} END) / {s} + 0e0)"


def d_code(col: str, src: str | None = None) -> str:
    """Code lookup equal to title(strip(x)) -> map (levels are letters and blanks)."""
    src = src or col
    arms = " ".join(f"WHEN '{lvl.lower()}' THEN {code}" for lvl, code in CATEGORY_MAPS[col].items())
    return f"CAST(CASE lower({d_strip(src)}) {arms} END AS INTEGER)"


D_MODE_PARENT = ("(SELECT parental_education_level FROM habits WHERE parental_education_level IS NOT NULL "
                 "GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)")


def d_prepared(select_key: bool = True) -> str:
    """SELECT list of the prepared (imputed + encoded) habits table."""
    from ..schema import FEATURE_COLUMNS

    parts = ["student_id"] if select_key else []
    for c in FEATURE_COLUMNS:
        if c == "parental_education_level":
            parts.append(f"{d_code(c, f'coalesce(parental_education_level, {D_MODE_PARENT})')} AS {c}")
        elif c in CATEGORY_MAPS:
            parts.append(f"{d_code(c)} AS {c}")
        else:
            parts.append(c)
    parts.append("exam_score")
    return ", ".join(parts)


def dlit(x: float) -> str:
    """A DOUBLE literal (an exponent makes both engines parse it as double)."""
    s = repr(float(x))
    return s if ("e" in s or "n" in s) else s + "e0"


def d_linear(coef: dict[str, float], intercept: float) -> str:
    """Left-to-right sum, the same evaluation order as ``LinearModel``."""
    expr = dlit(intercept)
    for c, b in coef.items():
        expr = f"({expr} + {dlit(b)} * {c})"
    return expr


def d_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def d_fill(template: str, **parts) -> str:
    """A message template as DuckDB text: literal pieces quoted, ``{name}``
    either an SQL expression (``sql:`` prefix) or a plain value."""
    import re

    out = []
    for piece in re.split(r"(\{\w+\})", template):
        if piece.startswith("{") and piece.endswith("}"):
            v = str(parts[piece[1:-1]])
            out.append(v[4:] if v.startswith("sql:") else d_str(v))
        elif piece:
            out.append(d_str(piece))
    return "(" + " || ".join(out) + ")"


def d_hash(key: str, salt: str, hex_digits: int = 8) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '{salt}'), 1, {hex_digits})) AS BIGINT)"


def d_lerp(arr: str, n: str, p: float) -> str:
    """numpy 'linear' quantile from a sorted list ``arr`` of ``n`` values (1-based lists)."""
    h = f"(CAST({n} - 1 AS DOUBLE) * {p!r})"
    lo = f"CAST(floor({h}) AS BIGINT)"
    hi = f"CAST(ceil({h}) AS BIGINT)"
    t = f"({h} - floor({h}))"
    a = f"{arr}[{lo} + 1]"
    b = f"{arr}[{hi} + 1]"
    return f"(CASE WHEN {t} >= 0.5 THEN {b} - ({b} - {a}) * (1e0 - {t}) ELSE {a} + ({b} - {a}) * {t} END)"
