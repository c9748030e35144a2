"""Query of the url filter; rules, features and held-out accuracy are tested in tests/llm."""

from __future__ import annotations

from ..session import table
from .registry import query
from .urltrees import judged


@query("op11_url_trees")
def op11(spark, sf_dir):
    return judged(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "model_verdict", "score")
