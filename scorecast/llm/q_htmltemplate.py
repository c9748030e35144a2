"""Query of the HTML extraction; planted pages check it in tests/llm."""

from __future__ import annotations

from ..session import table
from .htmltemplate import extract
from .registry import query


@query("op3_html_extraction")
def op3(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
