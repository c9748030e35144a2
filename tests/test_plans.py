"""Plan checks: filters reach the Parquet scan and only needed columns are read."""

import contextlib
import io

import __spark_entry__ as entry
from scorecast.operators.monitor import side_columns
from scorecast.plans.q_monitor import LINEITEM_KS, lineitem_sides

from conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_ks_lineitem_pushes_filters_and_prunes_columns(spark):
    # the query reads each side once, in a job of its own: these are those jobs' plans
    plan = "\n".join(_plan(side_columns(side, LINEITEM_KS)) for side in lineitem_sides(spark, SF_SMALL))
    assert plan.count("Scan parquet") >= 2
    assert "EqualTo(l_linestatus,F)" in plan and "EqualTo(l_linestatus,O)" in plan
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line and "l_" in line]
    assert schemas and all("l_shipdate" not in s and "l_orderkey" not in s for s in schemas)


def test_score_requests_runs_generated_code(spark):
    """No part of the plan is too big to compile: without the fallback to interpretation the query still runs."""
    old = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert entry.queries()["score_requests"](spark, SF_SMALL).where("predicted_exam_score IS NOT NULL").count() > 0
        rows = entry.queries()["score_requests"](spark, SF_SMALL).collect()
    finally:
        spark.conf.set("spark.sql.codegen.fallback", old)
    assert rows


def test_standin_reads_only_needed_columns(spark):
    plan = _plan(entry.queries()["hash_split"](spark, SF_SMALL))
    orders = [line for line in plan.splitlines() if "ReadSchema" in line and "o_" in line]
    assert orders and all("o_orderdate" not in s for s in orders)
