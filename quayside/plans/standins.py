"""The engine's operators run on the driver's TPC-H-like tables.

The driver's tables hold no fishing data, so every operator of the feeds is
exercised on a stand-in: orders play trips and logbook documents, lineitem
plays dealer landings and catch lines, part plays the species reference,
supplier plays dealers, customer plays vessels/permits, nation plays states
and areas, events plays hails and phone reports.  Each function takes
``(spark, sf_dir)`` and returns a lazy DataFrame over the whole tables; the
matching DuckDB statements are in ``standin_sql.py``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.context import RunContext
from quayside.functions import (
    datetime_text, elapsed_days, fishing_year, fishing_year_by_calendar,
    first_candidate, id_col, key_part, lookback, match_key, midpoint, serial_number,
    strip_leading_zeros, to_id,
)
from quayside.functions.codes import (
    SKATE_ROLLUP, dealer_name_gate, dealer_type, decode, disposition, in_list,
    TRIP_ACTIVITY_TYPE, TRIP_CATEGORY,
)
from quayside.operators import (
    code_list, cut_by_range, dimension, fill_defaults, interval_lookup, lag_within, lookup,
    materialize, membership_flag, ordered_membership, purge, union_by_name, validity_flag,
)
from quayside.plans.job import backfill_projects, reported_projects
from quayside.sources import TableSet

# Stand-in run clocks: the order tables end in August 2001, the event
# stream in January 2024.
ORDERS_CTX = RunContext(run_seq=1, as_of=dt.datetime(2001, 8, 1))
EVENTS_CTX = RunContext(run_seq=1, as_of=dt.datetime(2024, 2, 1))

# Stand-in activity prefixes -> programs (order priorities play activity codes).
STANDIN_PROGRAMS = {"1-U": "SCALLOP", "2-H": "MONKFISH", "3-M": "MID-ATLANTIC", "4-N": "HERRING"}
# Stand-in plan -> fishing calendar (part types play management plans).
STANDIN_CALENDARS = [("STANDARD", "JAN TO DEC"), ("ECONOMY", "MAR TO FEB"), ("MEDIUM", "MAY TO APR"),
                     ("SMALL", "NOV TO OCT"), ("LARGE", "JUN TO MAY")]
# Stand-in for the 13 area-dependent species: 13 part sizes.
STANDIN_STOCK_SIZES = (1, 4, 7, 10, 13, 16, 19, 22, 25, 28, 31, 34, 37)
# Stand-in test permits (user ids as permits).
STANDIN_TEST_PERMITS = ("11", "55", "88")
# Bucket widths for the bucketed range joins: about one span long, so each
# span touches at most two buckets (the 60-day document spans; the one-year
# validity rows, whose two edge pieces then collapse per code).
MIDPOINT_BUCKET_DAYS = 61
CODE_LIST_BUCKET_DAYS = 365


def _t(spark: SparkSession, sf_dir: str) -> TableSet:
    return TableSet(spark, sf_dir)


def _line_keys() -> list:
    return ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


# --------------------------------------------------------------------------
# FLT-1, FLT-2, SCL-1, SCL-2, SCL-3, SCL-10 : trip preparation (AMS shape)
# --------------------------------------------------------------------------
def trip_prep(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = ORDERS_CTX
    o = _t(spark, sf_dir).orders
    code = F.col("o_orderpriority")
    positional = (F.substring(code, 3, 3) == F.lit("URG")) | (F.substring(code, 13, 1) == F.lit("I"))
    kept = o.where(lookback("o_orderdate", ctx.cutoff(730)) & positional)
    return kept.select(
        F.lit(ctx.run_seq).cast("bigint").alias("rtl_seq_no"),
        ctx.run_date_text().alias("date_downloaded"),
        F.lit("AMS").alias("source_data"),
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_custkey").alias("permit_nbr"),
        code.alias("activity_code"),
        decode(F.substring(code, 1, 3), STANDIN_PROGRAMS).alias("rsa_program"),
        F.col("o_orderdate").alias("date_land"),
        fishing_year("o_orderdate", 1).alias("fy_jan_dec"),
        fishing_year("o_orderdate", 3).alias("fy_mar_feb"),
        fishing_year("o_orderdate", 5).alias("fy_may_apr"),
        fishing_year("o_orderdate", 11).alias("fy_nov_oct"),
        datetime_text("o_orderdate").alias("date_time_land"),
    )


# --------------------------------------------------------------------------
# FLT-3, JON-5, AGG-1 : a row qualifies through any of three membership tests
# --------------------------------------------------------------------------
def qualify_or_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t.lineitem.where(lookback("l_shipdate", ORDERS_CTX.cutoff(730)))
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    promo = t.part.where(F.col("p_type") == "PROMO")
    li = membership_flag(li, "l_orderkey", urgent, "o_orderkey", "_in_urgent")
    li = membership_flag(li, "l_partkey", promo, "p_partkey", "_in_promo")
    keep = F.col("_in_urgent") | F.col("_in_promo") | (F.col("l_returnflag") == F.lit("R"))
    return li.where(keep).select(*_line_keys(), "l_returnflag", "l_shipdate")


# --------------------------------------------------------------------------
# JON-1, FLT-4 : header -> report (inner, by the not-equal filter) -> line (outer)
# --------------------------------------------------------------------------
def report_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    a = t.customer.select("c_custkey", "c_name")
    b = t.orders.where(F.col("o_orderstatus") != F.lit("P")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    ab = a.join(b, a.c_custkey == b.o_custkey, "inner")
    abc = ab.join(c, ab.o_orderkey == c.l_orderkey, "left")
    return abc.select("c_custkey", "c_name", "o_orderkey", "o_orderstatus", "o_orderdate",
                      "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


# --------------------------------------------------------------------------
# WIN-1, SRT-1 : previous project of the same permit (skew-safe LAG)
# --------------------------------------------------------------------------
def previous_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir).events
    base = e.select(
        "event_id",
        F.when(F.col("user_id") % 10 != 9, F.col("user_id").cast("string")).alias("permit"),
        F.when(F.col("event_id") % 13 != 0, F.col("event_id")).alias("landing_id"),
        "event_type", "ts",
    )
    lid = F.col("landing_id")
    order = [lid.asc_nulls_last(), F.col("ts").asc(), F.col("event_id").asc()]
    base = cut_by_range(base, "permit", order, "_cut")
    out = lag_within(base, "permit", order, "event_type", "previous_event_type", F.col("_cut"))
    return out.select("event_id", "permit", "landing_id", "event_type", "previous_event_type")


# --------------------------------------------------------------------------
# SET-1, SNK-2, PRJ-5 : two hail kinds appended by name
# --------------------------------------------------------------------------
def hail_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir).events
    end = e.where(F.col("event_type") == "purchase").select(
        F.lit("VMS END HAIL").alias("source_data"),
        F.col("event_id").alias("rsa_efp_hail_id"),
        F.col("user_id").cast("string").alias("vessel_permit_number"),
        F.col("ts").alias("time_sent"),
        F.upper(F.col("event_type")).alias("form_type"),
        F.col("value").alias("species_kept"),
        F.col("props").alias("activity_code"),
    )
    start = e.where(F.col("event_type") == "signup").select(
        F.lit("VMS_START").alias("source_data"),
        F.col("event_id").alias("rsa_efp_hail_id"),
        F.col("user_id").cast("string").alias("vessel_permit_number"),
        F.col("ts").alias("time_sent"),
        F.lit("SAIL").alias("form_type"),
    )
    return union_by_name(end, start)


# --------------------------------------------------------------------------
# TID-3..5, SCL-11, SCL-12 : trip id with provenance (phone / hail rule)
# --------------------------------------------------------------------------
def trip_id_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir).events
    base = e.select(
        "event_id", "user_id",
        F.when(F.col("user_id") % 3 == 0, id_col("user_id")).alias("docid"),
        F.expr("substr(props, 7, length(props) - 7)").alias("serial"),
    )
    value, label = first_candidate([
        (F.col("docid"), "DOCID"),
        (serial_number("serial", allow_zero=False), "VTRSERNO"),
        (id_col("event_id"), "RSA_TRIPID"),
    ])
    return base.select("event_id", "user_id", "docid", "serial",
                       value.alias("rtl_trip_id"), label.alias("rtl_trip_id_source"))


# --------------------------------------------------------------------------
# TID-2, SCL-12 : dealer trip id (serial 0 allowed; fallback beyond bigint)
# --------------------------------------------------------------------------
def dealer_trip_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir).lineitem
    base = li.select(
        *_line_keys(),
        F.when(F.col("l_orderkey") % 3 != 1, id_col("l_orderkey")).alias("docid"),
        F.when(F.col("l_linenumber") == 1, F.lit("0"))
         .when(F.col("l_linenumber") == 2, F.lit(" 77 "))
         .when(F.col("l_linenumber") == 3, F.lit("ABC"))
         .when(F.col("l_linenumber") == 4, F.lit(None).cast("string"))
         .when(F.col("l_linenumber") == 6, F.lit("12.5"))
         .otherwise(F.col("l_partkey").cast("string")).alias("serial"),
        (F.col("l_orderkey") + F.lit(12345678901234)).cast("string").alias("dealer_rpt_id"),
        F.when(F.col("l_suppkey") % 7 != 0, (F.col("l_suppkey") + F.lit(330000)).cast("string")).alias("permit"),
    )
    value, label = first_candidate([
        (F.col("docid"), "DOCID"),
        (serial_number("serial", allow_zero=True), "VTRSERNO"),
        (to_id(F.concat(key_part("dealer_rpt_id"), key_part("permit"))), "DEALER_RPT_ID-PERMIT"),
    ])
    return base.select(*_line_keys(), "docid", "serial",
                       value.alias("rtl_trip_id"), label.alias("rtl_trip_id_source"))


# --------------------------------------------------------------------------
# JON-8, SCL-5, AGG-3 : document whose span holds the trip midpoint
# --------------------------------------------------------------------------
def _midpoint_docs(t: TableSet) -> DataFrame:
    f = t.orders.where(F.col("o_orderstatus") == "F")
    return f.select(F.col("o_custkey").alias("permit"), F.col("o_orderdate").alias("date_sail"),
                    (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("date_land"),
                    F.col("o_orderkey").alias("docid"))


def midpoint_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t.lineitem.select(*_line_keys(), "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    rows = li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        *_line_keys(), "o_custkey", midpoint("o_orderdate", "l_shipdate").alias("mid"))
    rows = materialize(rows)   # the probes and the join back both read the joined rows
    found = interval_lookup(rows, _midpoint_docs(t), {"o_custkey": "permit"}, "mid",
                            "date_sail", "date_land", ["docid"], prefer=[F.col("docid")],
                            bucket_days=MIDPOINT_BUCKET_DAYS)
    out = lookup(rows, found, ["o_custkey", "mid"], ["docid"])
    return out.select(*_line_keys(), "o_custkey", "mid", "docid")


# --------------------------------------------------------------------------
# JON-10, AGG-2 : codes valid at an instant, rolled into a sorted list
# --------------------------------------------------------------------------
def valid_code_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    validity = t.orders.where(F.col("o_orderstatus") == "O").select(
        F.col("o_custkey").alias("permit"), F.col("o_orderdate").alias("valid_from"),
        (F.col("o_orderdate") + F.expr("INTERVAL 365 DAYS")).alias("valid_to"),
        F.col("o_orderpriority").alias("code"))
    lists = code_list(o, validity, {"o_custkey": "permit"}, "o_orderdate", "valid_from", "valid_to",
                      "code", "code_list", end_inclusive=False, bucket_days=CODE_LIST_BUCKET_DAYS,
                      empty="")
    return lookup(o, lists, ["o_custkey", "o_orderdate"], ["code_list"])


# --------------------------------------------------------------------------
# KEY-6/7, JON-4, FLT-8, SCL-6, SCL-8, SCL-9 : rolled-up 3-digit keys
# --------------------------------------------------------------------------
def rollup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t.lineitem.select(
        *_line_keys(),
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey")).alias("docid"),
        F.col("l_suppkey").cast("string").alias("permit"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber").cast("string")).alias("serial"),
        F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("species_itis"),
    )
    skates = t.part.where(F.col("p_type").startswith("PROMO"))
    li = membership_flag(li, "l_partkey", skates, "p_partkey", "_skate")
    itis3 = F.when(F.col("_skate"), F.lit(SKATE_ROLLUP)).otherwise(
        F.substring(strip_leading_zeros("species_itis"), 1, 3))
    return li.select(
        *_line_keys(),
        match_key(key_part("docid", 0), key_part("permit"), key_part(itis3)).alias("docid_permit_sppitis3_to_match"),
        match_key(key_part("serial", 0), key_part("permit"), key_part(itis3)).alias("vtr_permit_sppitis3_to_match"),
    )


# --------------------------------------------------------------------------
# SNK-8, SCL-7 : delete test permits (NULL permits stay); age in days
# --------------------------------------------------------------------------
def purge_and_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir).events.select(
        "event_id", F.when(F.col("user_id") % 10 != 9, F.col("user_id").cast("string")).alias("permit"), "ts")
    kept = purge(e, "permit", STANDIN_TEST_PERMITS)
    return kept.select("event_id", "permit", "ts",
                       elapsed_days(EVENTS_CTX.as_of, "ts").alias("trip_age_in_days"))


# --------------------------------------------------------------------------
# SCL-16, SCL-17, FLT-7 : dealer type and disposition of catch
# --------------------------------------------------------------------------
def _catch_lines(t: TableSet) -> DataFrame:
    return t.lineitem.select(
        *_line_keys(), "l_shipdate",
        F.when(F.col("l_suppkey") == 0, F.lit(None).cast("bigint"))
         .when(F.col("l_suppkey") == 99, F.lit(99998).cast("bigint"))
         .otherwise(F.col("l_suppkey")).alias("dealer_num"),
        F.when(F.col("l_linenumber") == 1, F.lit("NC")).otherwise(F.col("l_partkey").cast("string")).alias("species_id"),
    )


def disposition_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _catch_lines(_t(spark, sf_dir))
    return c.select(*_line_keys(), "dealer_num", "species_id",
                    dealer_type("dealer_num").alias("dealer_type"),
                    disposition("species_id", "dealer_num").alias("disposition_of_catch"))


# --------------------------------------------------------------------------
# JON-2, JON-3, FLT-6, SCL-21 : document x image x catch, semi-joined to a trip set
# --------------------------------------------------------------------------
def logbook_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    d = t.orders.where(lookback("o_orderdate", ORDERS_CTX.cutoff(730)) & F.col("o_custkey").isNotNull()) \
        .select("o_orderkey", "o_custkey", "o_orderdate")
    trip_set = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    d = d.join(trip_set, "o_orderkey", "left_semi")
    i = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    c = t.part.select("p_partkey", "p_retailprice")
    di = d.join(i, d.o_orderkey == i.l_orderkey, "inner")
    dic = di.join(c, di.l_partkey == c.p_partkey, "inner")
    return dic.select("o_orderkey", "o_custkey", "o_orderdate", "l_linenumber", "l_partkey",
                      F.col("l_quantity").alias("landed_pounds"),
                      (F.col("l_quantity") * F.col("p_retailprice")).alias("live_pounds"))


# --------------------------------------------------------------------------
# SET-2 : set difference with unlike tags (only de-duplicates)
# --------------------------------------------------------------------------
def trip_set_minus(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    docs = t.orders.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("docid"), F.lit("VESSEL").alias("source"))
    ams = t.lineitem.select(F.col("l_orderkey").alias("docid"), F.lit("AMS_RSA").alias("source"))
    return docs.subtract(ams)


# --------------------------------------------------------------------------
# SET-3, AGG-1 : bag union of a trip list and a distinct serial list
# --------------------------------------------------------------------------
def trip_docid_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    ams = t.orders.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("trip_id"), F.col("o_custkey").alias("docid"), F.lit(0).alias("vtrserno"))
    phone = t.lineitem.select(F.col("l_orderkey").alias("trip_id"), F.col("l_suppkey").alias("docid"),
                              F.col("l_linenumber").alias("vtrserno")).distinct()
    return ams.unionByName(phone)


# --------------------------------------------------------------------------
# JON-12 : trips never reported (anti join on non-NULL keys)
# --------------------------------------------------------------------------
def unreported_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    o = t.orders.where(F.col("o_orderkey").isNotNull()).select("o_orderkey", "o_custkey", "o_orderstatus")
    reported = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).where(F.col("o_orderkey").isNotNull())
    return o.join(reported, "o_orderkey", "left_anti")


# --------------------------------------------------------------------------
# KEY-1..5, N1 : match keys with NULL parts
# --------------------------------------------------------------------------
def match_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t.lineitem.select(*_line_keys())
    o = t.orders.select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        *_line_keys(),
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_orderkey")).alias("docid"),
        F.when(F.col("l_suppkey") % 7 != 0, F.col("l_suppkey")).alias("dnum"),
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey").cast("string")).alias("permit"),
        F.when(F.col("l_partkey") % 7 != 0, F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0")).alias("nespp3"),
        F.when(F.col("l_partkey") % 7 != 1, F.lpad(F.col("l_partkey").cast("string"), 8, "0")).alias("species_itis"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber").cast("string")).alias("vtrserno"),
    )
    itis = strip_leading_zeros("species_itis")
    return j.select(
        *_line_keys(),
        match_key(key_part("docid", 0), key_part("dnum", 0), key_part("permit"), key_part("nespp3")).alias("docid_dnum_permit_spp_to_match"),
        match_key(key_part("docid", 0), key_part("permit"), key_part("nespp3")).alias("docid_permit_spp_to_match"),
        match_key(key_part("docid", 0), key_part("permit"), key_part(itis)).alias("docid_permit_sppitis_to_match"),
        match_key(key_part("vtrserno", 0), key_part("permit"), key_part("nespp3")).alias("vtr_permit_spp_to_match"),
        match_key(key_part("vtrserno", 0), key_part("permit"), key_part(itis)).alias("vtr_permit_sppitis_to_match"),
    )


# --------------------------------------------------------------------------
# TID-1, SCL-22 : AMS trip id (midpoint document, phone serial, own id)
# --------------------------------------------------------------------------
def ams_trip_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    trips = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderpriority",
        F.col("o_orderdate").alias("date_sail"),
        F.expr("o_orderdate + make_dt_interval(CAST(o_orderkey % 10 AS INT))").alias("date_land"),
    ).withColumn("mid", midpoint("date_sail", "date_land"))
    found = interval_lookup(trips, _midpoint_docs(t), {"o_custkey": "permit"}, "mid", "date_sail",
                            "date_land", ["docid"], prefer=[F.col("docid")], bucket_days=MIDPOINT_BUCKET_DAYS)
    trips = lookup(trips, found, ["o_custkey", "mid"], ["docid"])
    serials = dimension(t.lineitem, ["l_orderkey"], ["l_partkey"])
    trips = lookup(trips, serials, {"o_orderkey": "l_orderkey"}, {"l_partkey": "phone_serial"})
    phone = F.when(F.col("o_orderpriority") == F.lit("2-HIGH"), id_col("phone_serial"))
    value, label = first_candidate([
        (id_col("docid"), "DOCID"),
        (phone, "VTRSERNO"),
        (id_col("o_orderkey"), F.concat(F.lit("AMS-TRIP_ID-"), F.coalesce(F.col("o_orderpriority"), F.lit("")))),
    ])
    return trips.select("o_orderkey", "o_custkey", "o_orderpriority", "docid",
                        value.alias("rtl_trip_id"), label.alias("rtl_trip_id_source"))


# --------------------------------------------------------------------------
# JON-6, SCL-19 : first of two ordered membership sets
# --------------------------------------------------------------------------
def jurisdiction(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    n = t.nation
    research = n.where(F.col("n_regionkey") == 1).select(F.col("n_nationkey").alias("permit"), F.lit("STATE").alias("state_fed")) \
        .unionByName(n.where(F.col("n_regionkey").isin(1, 2)).select(F.col("n_nationkey").alias("permit"), F.lit("FED").alias("state_fed")))
    c = t.customer.select("c_custkey", "c_nationkey")
    return ordered_membership(c, "c_nationkey", research, "permit", "state_fed",
                              [("STATE", "STATE"), ("FED", "FEDERAL")], "vessel_jurisdiction")


# --------------------------------------------------------------------------
# SCL-18, SCL-4, LKP-3, JON-7 : dealer name by (number, sale year), gated
# --------------------------------------------------------------------------
def dealer_name_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    c = _catch_lines(t).withColumn("sale_year", F.year("l_shipdate"))
    dealers = t.supplier.select("s_suppkey", (F.lit(1995) + F.col("s_suppkey") % 7).cast("int").alias("yr"), "s_name")
    dealers = dimension(dealers, ["s_suppkey", "yr"], ["s_name"])
    c = lookup(c, dealers, {"dealer_num": "s_suppkey", "sale_year": "yr"}, {"s_name": "_dealer"})
    return c.select(*_line_keys(), "dealer_num", "sale_year",
                    dealer_name_gate("species_id", "dealer_num", "_dealer").alias("dealer_name"))


# --------------------------------------------------------------------------
# SCL-20, LKP-30 : stock by (species, area) for listed species, else 'NA'
# --------------------------------------------------------------------------
def stock_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    p = t.part.select("p_partkey", "p_size", (F.col("p_partkey") % 5).alias("area"))
    stocks = dimension(t.nation.select((F.col("n_nationkey") + 1).alias("size"), "n_regionkey", "n_name"),
                       ["size", "n_regionkey"], ["n_name"])
    p = lookup(p, stocks, {"p_size": "size", "area": "n_regionkey"}, {"n_name": "_stock"}, small=True)
    return p.select("p_partkey", "p_size", "area",
                    F.when(in_list("p_size", STANDIN_STOCK_SIZES), F.col("_stock")).otherwise(F.lit("NA")).alias("stock_id"))


# --------------------------------------------------------------------------
# LKP-8, LKP-9, LKP-11 : plan -> calendar -> fishing year of the plan
# --------------------------------------------------------------------------
def plan_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    o = t.orders.select("o_orderkey", "o_orderdate")
    rows = li.join(o, li.l_orderkey == o.o_orderkey, "inner").drop("o_orderkey")
    plans = dimension(t.part.select("p_partkey", "p_type"), ["p_partkey"], ["p_type"])
    rows = lookup(rows, plans, {"l_partkey": "p_partkey"}, {"p_type": "fmm"})
    calendars = spark.createDataFrame(STANDIN_CALENDARS, "plan string, calendar string")
    rows = lookup(rows, calendars, {"fmm": "plan"}, {"calendar": "fishing_year_range"}, small=True)
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "fmm", "fishing_year_range",
                       fishing_year_by_calendar("o_orderdate", "fishing_year_range").alias("fmp_year"))


# --------------------------------------------------------------------------
# JON-9, LKP-23, LKP-24, SNK-5 : project validity on a day
# --------------------------------------------------------------------------
def project_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    numbers = dimension(t.customer.select("c_custkey", "c_name"), ["c_custkey"], ["c_name"])
    o = lookup(o, numbers, {"o_custkey": "c_custkey"}, {"c_name": "_project"})
    f = t.orders.where(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderdate")
    f = lookup(f, numbers, {"o_custkey": "c_custkey"}, {"c_name": "project"})
    # Two windows a project: the half year after its first and the one before
    # its last order, mostly with a gap between them.
    span = f.groupBy("project").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    half = F.expr("INTERVAL 182 DAYS")
    windows = span.select("project", F.explode(F.array(
        F.struct(F.col("lo").alias("f"), (F.col("lo") + half).alias("t")),
        F.struct((F.col("hi") - half).alias("f"), F.col("hi").alias("t")))).alias("w"))
    windows = windows.select("project", F.col("w.f").alias("valid_from"), F.col("w.t").alias("valid_to"))
    o = validity_flag(o, windows, {"_project": "project"}, F.col("o_orderdate"), "valid_from", "valid_to",
                      "project_status_valid")
    return o.select("o_orderkey", "o_custkey", "o_orderdate", "project_status_valid")


# --------------------------------------------------------------------------
# SNK-6, LKP-32, LKP-33 : guarded backfill from a 3-key lookup
# --------------------------------------------------------------------------
def project_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    nespp3 = F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0")
    rows = t.lineitem.select(
        *_line_keys(),
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey").cast("decimal(38,0)")).alias("docid"),
        F.when(F.col("l_linenumber") != 3, F.concat(_page_serial(), F.when(F.col("l_linenumber") == 2, F.lit("  ")).otherwise(F.lit(""))))
        .alias("vtrserno"),
        nespp3.alias("nespp3"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("P"), F.col("l_orderkey").cast("string"))).alias("rsa_ivr_project_id"),
        F.when(F.col("l_linenumber") % 3 == 0, F.col("l_orderkey")).alias("rsa_sfd_project_id"),
    )
    reports = t.lineitem.where(F.col("l_returnflag") == "R").select(
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_orderkey").cast("decimal(38,0)")).alias("docid"),
        F.concat(F.lit(" "), _page_serial()).alias("rsa_vtrnbr"), nespp3.alias("nespp3"),
        F.concat(F.lit("IVR-"), F.col("l_suppkey").cast("string")).alias("rsa_ivr_project_id"),
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_partkey")).alias("rsa_sfd_project_id"))
    out = backfill_projects(rows, reported_projects(reports), "vtrserno", label="matched_by")
    return out.select(*_line_keys(), "docid", "vtrserno", "rsa_ivr_project_id", "rsa_sfd_project_id", "matched_by")


def _page_serial():
    """A page serial that neighbouring orders share."""
    return (F.floor(F.col("l_orderkey") / 40) * 10 + F.col("l_linenumber")).cast("string")


# --------------------------------------------------------------------------
# SNK-3, SNK-4 : NULL flags filled after a left lookup
# --------------------------------------------------------------------------
def fill_defaults_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    flags = t.part.where((F.col("p_size") > 25) | (F.col("p_type") == "STANDARD")).select(
        "p_partkey",
        F.when(F.col("p_size") > 25, F.lit("Y")).alias("rsa_spp"),
        F.when(F.col("p_type") == "STANDARD", F.col("p_brand")).alias("rsa_program"))
    flags = dimension(flags, ["p_partkey"], ["rsa_spp", "rsa_program"])
    li = lookup(li, flags, {"l_partkey": "p_partkey"}, ["rsa_spp", "rsa_program"])
    return fill_defaults(li, {"rsa_spp": "N", "rsa_program": "UNKNOWN"})


# --------------------------------------------------------------------------
# SCL-14, SCL-15 : logbook code decodes
# --------------------------------------------------------------------------
def trip_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir).lineitem
    return li.select(*_line_keys(),
                     decode("l_linenumber", TRIP_CATEGORY).alias("tripcatg_desc"),
                     decode(F.col("l_linenumber") - 1, TRIP_ACTIVITY_TYPE).alias("trip_activity_type_desc"))


# --------------------------------------------------------------------------
# SRT-2, SRC-13 : distinct species/program reference, ordered
# --------------------------------------------------------------------------
def species_programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _t(spark, sf_dir).part
    return (p.where(F.col("p_size") > 25)
            .select(F.lit(1).alias("rsa_spp"), F.col("p_type").alias("nespp3"), F.col("p_brand").alias("rsa_program"))
            .distinct().orderBy("rsa_program", "nespp3"))


# --------------------------------------------------------------------------
# JON-11 : scalar name lookup (state name)
# --------------------------------------------------------------------------
def state_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    c = t.customer.select("c_custkey", "c_nationkey")
    names = dimension(t.nation.select("n_nationkey", "n_name"), ["n_nationkey"], ["n_name"])
    return lookup(c, names, {"c_nationkey": "n_nationkey"}, {"n_name": "state_name"}, small=True)


QUERIES = {
    "trip_prep": trip_prep,
    "qualify_or_exists": qualify_or_exists,
    "report_chain": report_chain,
    "previous_project": previous_project,
    "hail_union": hail_union,
    "trip_id_provenance": trip_id_provenance,
    "dealer_trip_id": dealer_trip_id,
    "midpoint_lookup": midpoint_lookup,
    "valid_code_list": valid_code_list,
    "rollup_key": rollup_key,
    "purge_and_age": purge_and_age,
    "disposition": disposition_q,
    "logbook_chain": logbook_chain,
    "trip_set_minus": trip_set_minus,
    "trip_docid_union": trip_docid_union,
    "unreported_trips": unreported_trips,
    "match_keys": match_keys,
    "ams_trip_id": ams_trip_id,
    "jurisdiction": jurisdiction,
    "dealer_name_gate": dealer_name_q,
    "stock_gate": stock_gate,
    "plan_year": plan_year,
    "project_validity": project_validity,
    "project_backfill": project_backfill,
    "fill_defaults": fill_defaults_q,
    "trip_categories": trip_categories,
    "species_programs": species_programs,
    "state_name_lookup": state_name_lookup,
}
