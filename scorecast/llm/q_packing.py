"""Query of the packing; its pieces are checked by an exact round trip in tests/llm."""

from __future__ import annotations

from ..session import table
from .packing import pack
from .registry import query


@query("op1_packing")
def op1(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents")).drop("ids")
