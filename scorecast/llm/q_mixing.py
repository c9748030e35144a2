"""Query of the mixing; the rounding is tested for conservation, bounds and unbiasedness."""

from __future__ import annotations

from ..session import table
from .mixing import mix
from .registry import query


@query("op10_mixing")
def op10(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")
