"""Query of the language ID; held-out accuracy is tested in tests/llm."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import table
from .langid import fit, predict
from .registry import query
from .shared import text_crc


@query("op2_language_id")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(F.pmod(text_crc(), F.lit(4)) == 2, F.lit(False)))
    model = fit(docs.where("NOT held_out"), key=F.col("doc_id"))
    return predict(docs.select("doc_id", "held_out", "text"), model)
