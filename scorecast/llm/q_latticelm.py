"""Query of the LM scoring; brute force and held-out comparison are in tests/llm."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import table
from .latticelm import score
from .registry import query
from .shared import text_crc


@query("op8_lattice_lm")
def op8(spark, sf_dir):
    held = F.coalesce(F.pmod(text_crc(), F.lit(7)) == 2, F.lit(False))
    out = score(table(spark, sf_dir, "documents"), training=~held)
    return out.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
