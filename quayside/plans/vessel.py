"""Vessel logbooks -> ``rsa_rtl_vessel`` (document x image x catch)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.context import RunContext
from quayside.functions import decode, id_col, in_list, key_part, match_key
from quayside.functions.codes import (
    SPECIES_FLAG_DEFAULT, STOCK_AREA_SPECIES, TRIP_ACTIVITY_TYPE, TRIP_CATEGORY, dealer_name_gate,
    dealer_type, disposition,
)
from quayside.operators import counted, fill_defaults, latest_at, lookup, materialize, only_possible, typed_nulls
from quayside.plans.common import (
    in_window, four_fishing_years, plan_year, run_stamp, skate_flag, species_attributes, text_dates,
    itis3, PROJECTS, with_projects,
)
from quayside.plans.dims import Dims
from quayside.sources.schemas import TARGET_COLUMNS

DOC_COLS = """docid vessel_id date_sail date_land tripcatg crew nanglers port1 port2 port3 state1 state2
    state3 datelnd2 datelnd3 operator_num operator_name date_signed fished vessel_permit_num origin
    trip_activity_type""".split()
IMG_COLS = """imgid date_received serial_num gearcode gearqty gearsize area depth lat_degree lat_minute
    lat_second lat_dir lon_degree lon_minute lon_second lon_dir ntows towhrs towmin mesh""".split()
CATCH_COLS = """catch_id species_id kept discarded dealer_num date_sold port_landed state_landed
    port_number""".split()


def chain(ctx: RunContext, documents: DataFrame, images: DataFrame, catches: DataFrame, trip_docids: DataFrame,
          dims: Dims | None = None) -> DataFrame:
    """Document x image x catch of the trip set in the window.

    Most selective first: the document window, the NOT NULL vessel and the
    trip-set semi join shrink the smallest table before the two big joins.
    Tables stored in buckets of their join keys (``sources.buckets``) are read
    as they lie.  With ``dims`` a document gets its vessel's name before it
    meets its images."""
    d = counted(in_window(documents, "date_land", ctx.cutoff_for("vessel")), "document.window")
    d = counted(d.where(F.col("vessel_id").isNotNull()), "document.vessel")
    d = counted(d.join(trip_docids.select("docid").where(F.col("docid").isNotNull()), "docid", "left_semi"), "document.trips")
    if dims is not None:
        d = lookup(d, dims.vessel_name, {"vessel_permit_num": "permit"}, ["vessel_name"], small=True, row_key=["docid"])
    # Images and catch of other documents stay on the scan.
    possible = in_window(documents, "date_land", ctx.cutoff_for("vessel")).where(F.col("vessel_id").isNotNull())
    i = only_possible(images.select(F.col("docid").alias("_i_docid"), *IMG_COLS), "_i_docid", possible, "docid")
    c = only_possible(catches.select(F.col("imgid").alias("_c_imgid"), *CATCH_COLS), "_c_imgid", i, "imgid")
    t = d.join(i, d.docid == i._i_docid, "inner").drop("_i_docid")
    return t.join(c, t.imgid == c._c_imgid, "inner").drop("_c_imgid")


def build(ctx: RunContext, documents: DataFrame, images: DataFrame, catches: DataFrame, dims: Dims,
          trip_docids: DataFrame, fill=None) -> DataFrame:
    """``fill`` fills the project ids of rows (``job.backfill_projects``); it gets only
    the columns it needs, so that whole rows are shuffled once, and may leave
    out rows that it has nothing for."""
    dims.prove_reference("species_code", "species_name", "species_itis", "species_plan", "plan_calendar",
                         "rsa_species", "program_target", "vessel_name", "stock_area", "conversion",
                         "dealer_year")
    t = counted(chain(ctx, documents, images, catches, trip_docids, dims), "vessel.joined")
    t = lookup(t, dims.species_code, ["species_id"], {"nespp3": "nespp3", "nespp4": "_nespp4"}, small=True)
    t = lookup(t, dims.species_name, {"_nespp4": "nespp4"}, {"common_name": "spp_common_name"}, small=True)
    t = species_attributes(t, dims, "nespp3", derive_program=True)
    t = skate_flag(t, dims, "nespp3", by="nespp3")
    t = lookup(t, dims.stock_area, ["nespp3", "area"], {"stock_id": "_stock"}, small=True)
    t = lookup(t, dims.conversion, ["species_id", "dealer_num"], {"factor": "_factor"}, small=True)
    # Written once, each row with a number: the code list, the dealer's name and
    # the projects are searched with a few columns each and joined back by it.
    t = materialize(t.withColumn("_row_id", F.monotonically_increasing_id()))
    n = latest_at(t.select("_row_id", "vessel_permit_num", "_itis", "date_land"), dims.permit_periods,
                  {"vessel_permit_num": "permit", "_itis": "itis"}, "date_land", {"category": "fmp_cat_code_list"})
    sold = t.where(F.col("dealer_num").isNotNull() & F.col("date_sold").isNotNull()).select(
        "_row_id", "dealer_num", F.year("date_sold").alias("_sale_year"))
    sold = lookup(sold, dims.dealer_year, {"dealer_num": "dealer_num", "_sale_year": "year"}, {"dealer_name": "_dealer"},
                  small=True, row_key=["_row_id"]).where(F.col("_dealer").isNotNull())
    found = n.select("_row_id", "fmp_cat_code_list").join(sold.select("_row_id", "_dealer"), "_row_id", "left")
    t = t.join(with_projects(found, t, "serial_num", fill), "_row_id").drop("_row_id")   # whole rows meet what was found once

    rows = t.select(
        *run_stamp(ctx, "vessel"),
        match_key(key_part("docid"), key_part("dealer_num", 0), key_part("vessel_permit_num"), key_part("nespp3"))
        .alias("docid_dnum_permit_spp_to_match"),
        *DOC_COLS[:5],
        decode("tripcatg", TRIP_CATEGORY).alias("tripcatg_desc"),
        *DOC_COLS[5:20], "vessel_name", *DOC_COLS[20:],
        decode("trip_activity_type", TRIP_ACTIVITY_TYPE).alias("trip_activity_type_desc"),
        *four_fishing_years("date_land"),
        *IMG_COLS,
        "catch_id", "species_id", "spp_common_name", *CATCH_COLS[2:],
        F.col("_rsa_spp").alias("rsa_spp"), F.col("_target").alias("rsa_project_spp"),
        F.col("_rsa_program").alias("rsa_program"), "nespp3",
        F.when(in_list("nespp3", STOCK_AREA_SPECIES), F.col("_stock")).otherwise(F.lit("NA")).alias("stock_id"),
        F.col("kept").alias("landed_pounds"),
        (F.col("kept") * F.col("_factor")).alias("live_pounds"),
        F.col("_fy_range").alias("fishing_year_range"),
        plan_year("date_land").alias("fmp_year"),
        F.col("_fmm").alias("fmm"),
        "fmp_cat_code_list",
        *typed_nulls({"fmp_mort_code_list": "string", "vessel_rpt_freq_list": "string", "fmp_mri_list": "string",
                      "fmp_mri_list_wo_hull": "string", "fishery_type": "string"}),
        dealer_type("dealer_num").alias("dealer_type"),
        disposition("species_id", "dealer_num").alias("disposition_of_catch"),
        F.col("dealer_num").alias("dealer_number"),
        dealer_name_gate("species_id", "dealer_num", "_dealer").alias("dealer_name"),
        F.col("docid").alias("source_level1_key_id"),
        F.col("imgid").alias("source_level2_key_id"),
        F.col("catch_id").alias("source_level3_key_id"),
        *text_dates(date_time_sail="date_sail", date_time_land="date_land"),
        match_key(key_part("docid"), key_part("vessel_permit_num"), key_part("nespp3")).alias("docid_permit_spp_to_match"),
        match_key(key_part("docid"), key_part("vessel_permit_num"), key_part("_itis")).alias("docid_permit_sppitis_to_match"),
        match_key(key_part("docid", 0), key_part("vessel_permit_num"), key_part(itis3(F.col("_itis"))))
        .alias("docid_permit_sppitis3_to_match"),
        id_col("docid").alias("rtl_trip_id"), F.lit("DOCID").alias("rtl_trip_id_source"),
        F.col("_itis").alias("species_itis"),
        *PROJECTS,
    )
    rows = fill_defaults(rows, {"rsa_spp": SPECIES_FLAG_DEFAULT})
    return rows.select(*TARGET_COLUMNS["rsa_rtl_vessel"])
