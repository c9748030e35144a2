"""Query of the document fingerprints; a plain Python signature checks them in tests/llm."""

from __future__ import annotations

from ..session import table
from .omh import fingerprints
from .registry import query


@query("op5_order_minhash")
def op5(spark, sf_dir):
    return fingerprints(table(spark, sf_dir, "documents"))
