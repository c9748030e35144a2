"""Query of the PII spans; base spans are checked against the plain patterns in tests/llm."""

from __future__ import annotations

from ..session import table
from .registry import query
from .sanitise import report


@query("op6_pii_sanitisation")
def op6(spark, sf_dir):
    return report(table(spark, sf_dir, "documents"))
