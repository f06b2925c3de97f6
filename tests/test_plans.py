"""Plan shape: JVM-only expressions, no single-partition exchange, pushdown."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from quayside.operators.maintenance import written_tables
from quayside.plans.feed_standins import FEED_QUERIES
from quayside.plans.standins import QUERIES

SMALL = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted({**QUERIES, **FEED_QUERIES}))
def test_standin_plans_stay_in_jvm_and_distributed(spark, name):
    with written_tables() as tables:
        last = E.queries()[name](spark, SMALL)
    for df in [*tables, last]:      # what the query has written on its way, then the rest
        text = plan_text(df)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInArrow", "CartesianProduct"):
            assert bad not in text, (name, bad)
        assert "SinglePartition" not in text, name


def test_lookback_and_projection_reach_the_scan(spark):
    text = plan_text(E.queries()["trip_prep"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate,1999-08-02T00:00)" in text
    scan = [l for l in text.splitlines() if l.startswith("ReadSchema")][0]
    assert "o_totalprice" not in scan and "o_orderstatus" not in scan


def test_feed_plans_stay_in_jvm(spark):
    import domain_fixture as fx
    from quayside.plans import ams, dealer, ivr, vessel, vms
    from quayside.plans.dims import build_dims
    from quayside.plans.job import phone_serials

    src, dim_src = fx.sources(spark)
    dims = build_dims(src, dim_src)
    docids = src["document"].select("docid")
    serials = src["images"].select("serial_num").withColumnRenamed("serial_num", "serial")
    plans = [ams.build(fx.CTX, src["ams_trip"], dims, phone_serials(src["ivr_trip"])),
             dealer.build(fx.CTX, src["dealer_landing"], dims, docids, serials)[0],
             ivr.build(fx.CTX, src["ivr_trip"], src["ivr_report"], src["ivr_landing"], dims)[0],
             vms.build(fx.CTX, src["vms_end_hail"], src["vms_start_hail"], dims)[0],
             vessel.build(fx.CTX, src["document"], src["images"], src["catch"], dims, docids)]
    for df in plans:
        text = plan_text(df)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
            assert bad not in text
        assert "SinglePartition" not in text


def test_shuffled_lookup_exchanges_on_salted_key(spark):
    """The NULL-key salt must reach the shuffle, not just the join condition."""
    from pyspark.sql import functions as F
    from quayside.operators import dimension, lookup
    fact = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).alias("k"), "id")
    dim = dimension(spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), ["k"], ["v"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan_text(lookup(fact, dim, ["k"], ["v"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [l for l in text.splitlines() if "hashpartitioning(" in l]
    assert exchanges and all("_lk_lkey" in l or "_lk_rkey" in l or "k#" in l for l in exchanges)
    assert any("_lk_lkey" in l for l in exchanges) and any("_lk_rkey" in l for l in exchanges)


def test_lag_within_has_no_single_partition_window(spark):
    from pyspark.sql import functions as F
    from quayside.operators import lag_within
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("g"), "id", F.col("id").cast("string").alias("v"))
    text = plan_text(lag_within(df, "g", [F.col("id")], "v", "prev", F.floor(F.col("id") / 10)))
    assert "SinglePartition" not in text
    assert "hashpartitioning(g#" in text
