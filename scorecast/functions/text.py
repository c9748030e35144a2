"""Text cleaning and category-code expressions (all JVM-side)."""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import STRIP_CHARS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Remove white space at both ends, all that Python's ``str.strip()`` removes."""
    return F.btrim(_c(col), F.lit(STRIP_CHARS))


def title_case(col) -> Column:
    """Python's ``str.title()``: upper-case each letter that no letter precedes, lower the rest."""
    runs = F.regexp_extract_all(F.lower(_c(col)), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), "")


def fill(template: str, **parts) -> Column:
    """A message template as ``concat``: text pieces are literals, ``{name}``
    takes the given Column (or a literal for plain values)."""
    cols = []
    for piece in re.split(r"(\{\w+\})", template):
        if piece.startswith("{") and piece.endswith("}"):
            v = parts[piece[1:-1]]
            cols.append(v if isinstance(v, Column) else F.lit(str(v)))
        elif piece:
            cols.append(F.lit(piece))
    return F.concat(*cols)


def python_list(values) -> str:
    """Render names like a Python list: ['a', 'b']."""
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def clean_level(col) -> Column:
    """strip + title case, as applied to every categorical value before lookup."""
    return title_case(strip_ws(col))


def map_literal(mapping: dict[str, int]) -> Column:
    """A literal MAP<STRING, INT>; Catalyst folds it into the projection."""
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


def encode_level(col, mapping: dict[str, int]) -> Column:
    """Cleaned level -> code; unknown or null -> null."""
    return F.try_element_at(map_literal(mapping), clean_level(col)).cast("int")
