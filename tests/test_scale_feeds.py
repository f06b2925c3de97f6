"""Feeds of many copies: filters of large sets, periods in one shuffle, narrow searches."""

from pyspark.sql import functions as F

import domain_fixture as fx
from quayside.operators import bloom_filter, code_periods, may_contain
from quayside.operators.maintenance import written_tables
from quayside.plans import dealer
from quayside.plans.job import PROJECT_TARGETS, backfill_projects
from test_plans import plan_text
from test_scale_operators import dealer_inputs, validity_rows


def test_a_large_set_gets_a_coarser_filter(spark):
    """at 6 GB the sets of documents, images and keys are beyond a filter of full size."""
    keys = spark.range(0, 40_000, 2).select(F.col("id").alias("k"))
    bloom = bloom_filter(keys, "k", 20_000, max_bytes=32 << 10)
    assert bloom is not None and bloom.n_bytes == 32 << 10
    n = {(r.member, r.may): r["count"] for r in may_contain(spark.range(40_000).select(F.col("id").alias("k")), "k", bloom, "may").groupBy(
        (F.col("k") % 2 == 0).alias("member"), "may").count().collect()}
    assert n[True, True] == 20_000 and n[False, True] < 0.1 * 20_000
    assert bloom_filter(keys, "k", 20_000, max_bytes=8 << 10) is None     # under four bits a key


def test_validity_rows_are_shuffled_once(spark):
    """counted, grouped and cut into periods behind one exchange."""
    df = spark.createDataFrame([r for r in validity_rows() if r[0] != "hot"],
                               "permit string, itis string, f timestamp_ntz, t timestamp_ntz, code string")
    with written_tables() as tables:
        out = code_periods(df, ["permit", "itis"], "f", "t", {"code": "code"}, null_end_open=True)
    plans = [plan_text(t) for t in [*tables, out]]
    assert sum(line.startswith("(") and ") Exchange" in line for p in plans for line in p.splitlines()) == 1
    assert "WindowGroupLimit" in plans[0]          # a task sends a bounded number of a key's rows


def test_quarantine_alone_equals_the_quarantine_of_the_feed(spark):
    """only landings with an unusable serial are tested; no periods are built."""
    landings, dims, docids, serials = dealer_inputs(spark)
    landings = landings.unionByName(landings)
    with written_tables() as tables:
        alone = dealer.set_aside(fx.CTX, landings, dims, docids, serials)
    assert not any("since" in t.columns or "_g" in t.columns for t in tables)
    both = dealer.build(fx.CTX, landings, dims, docids, serials)[1]
    assert alone.columns == both.columns
    rows = sorted(map(str, alone.collect()))
    assert rows == sorted(map(str, both.collect())) and len(rows) == 2


def test_dealer_projects_are_searched_with_a_few_columns(spark):
    """the backfill reads numbered rows and gives back those it fills."""
    landings, dims, docids, serials = dealer_inputs(spark)
    keys = landings.select("docid", F.trim("vtrserno").alias("serial"), "nespp3").where("serial IS NOT NULL AND nespp3 IS NOT NULL")
    projects = keys.select("*", F.concat(F.lit("P"), "serial").alias("ivr_project"), F.lit("S").alias("sfd_project")).distinct()
    assert set(PROJECT_TARGETS.values()) <= set(projects.columns)
    widths = []

    def fill(rows):
        widths.append(len(rows.columns))
        return backfill_projects(rows, projects, "vtrserno", matched_only=True)
    filled = dealer.build(fx.CTX, landings, dims, docids, serials, fill)[0]
    plain = backfill_projects(dealer.build(fx.CTX, landings, dims, docids, serials)[0], projects, "vtrserno")
    assert widths == [6] and filled.columns == plain.columns
    rows = sorted(map(str, filled.collect()))
    assert rows == sorted(map(str, plain.collect())) and any("rsa_ivr_project_id='P" in r for r in rows)


def test_rows_that_no_report_matches_are_left_out(spark):
    """matched_only gives the matched rows of the whole backfill, NULL documents and serials included."""
    rows = spark.createDataFrame([(i, d, s, n, None, None) for i, (d, s, n) in enumerate(
        (d, s, n) for d in (1, 2, None) for s in ("10", " 10 ", "20", None, "") for n in ("001", "002", None))],
        "id int, docid int, serial_num string, nespp3 string, rsa_ivr_project_id string, rsa_sfd_project_id string")
    projects = spark.createDataFrame([(1, "10", "001", "P1", "S1"), (1, "10", "001", "P0", "S9"), (None, "20", "001", "P2", None), (2, "10", "002", None, "S3")],
                                     "docid int, serial string, nespp3 string, ivr_project string, sfd_project string")
    whole = {r.id: tuple(r) for r in backfill_projects(rows, projects, "serial_num").collect()}
    some = backfill_projects(rows, projects, "serial_num", matched_only=True)
    got = {r.id: tuple(r) for r in some.collect()}
    assert len(whole) == rows.count() and got == {i: r for i, r in whole.items() if r[4:] != (None, None)} and len(got) > 3
