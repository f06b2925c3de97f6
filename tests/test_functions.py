"""Expression rules: NULL/blank handling, ids, dates, decodes."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from quayside.context import RunContext, ntz
from quayside.functions import (
    contains_digit, date_text, datetime_text, elapsed_days, first_candidate, fishing_year,
    fishing_year_by_calendar, key_part, lookback, match_key, midpoint, serial_number,
    strip_leading_zeros, to_id, blank_to_null,
)
from quayside.functions.codes import (
    dealer_name_gate, dealer_type, decode, disposition, program_from_activity, TRIP_CATEGORY,
)
from quayside.functions.ids import dirty_serial, to_id, unusable_serial


def one(spark, col, ddl="x string", rows=(("a",),)):
    return spark.createDataFrame(list(rows), ddl).select(col.alias("v")).collect()


def values(spark, col, ddl, rows):
    return [r.v for r in spark.createDataFrame(list(rows), ddl).select(col.alias("v")).collect()]


def test_match_key_null_parts_are_empty(spark):
    got = values(spark, match_key(key_part("d", 0), key_part("p"), key_part("s")),
                 "d bigint, p string, s string", [(None, None, None), (5, "P1", "081"), (None, "P", None)])
    assert got == ["0--", "5-P1-081", "0-P-"]


def test_contains_digit_is_not_posix_class(spark):
    got = values(spark, contains_digit("x"), "x string", [("12A4",), ("ABC",), ("digit",), (None,)])
    assert got == [True, False, False, None]


def test_to_id_trims_and_is_total(spark):
    got = values(spark, to_id("x"), "x string", [(" 77 ",), ("ABC",), ("12A4",), ("12345678901234330123",)])
    assert got == [D(77), None, None, D("12345678901234330123")]


def test_serial_rules(spark):
    rows = [("0",), (" 77 ",), ("ABC",), ("12A4",), (None,)]
    assert values(spark, serial_number("x", allow_zero=True), "x string", rows) == [D(0), D(77), None, None, None]
    assert values(spark, serial_number("x", allow_zero=False), "x string", rows) == [None, D(77), None, None, None]
    assert values(spark, dirty_serial("x"), "x string", rows) == [False, False, False, True, False]


def test_strip_leading_zeros(spark):
    got = values(spark, strip_leading_zeros("x"), "x string", [("00564123",), ("000",), (None,), ("120",)])
    assert got == ["564123", None, None, "120"]


def test_blank_is_null(spark):
    assert values(spark, blank_to_null("x"), "x string", [("",), ("a",)]) == [None, "a"]


def test_fishing_year_flips(spark):
    rows = [(dt.datetime(2024, 4, 30, 23, 59, 59),), (dt.datetime(2024, 5, 1),),
            (dt.datetime(2024, 10, 31),), (dt.datetime(2024, 11, 1),),
            (dt.datetime(2024, 2, 28),), (dt.datetime(2024, 3, 1),)]
    ddl = "d timestamp_ntz"
    assert values(spark, fishing_year("d", 5), ddl, rows) == [2023, 2024, 2024, 2024, 2023, 2023]
    assert values(spark, fishing_year("d", 11), ddl, rows) == [2023, 2023, 2023, 2024, 2023, 2023]
    assert values(spark, fishing_year("d", 3), ddl, rows) == [2024, 2024, 2024, 2024, 2023, 2024]
    assert values(spark, fishing_year("d", 1), ddl, rows) == [2024] * 6
    cal = values(spark, fishing_year_by_calendar("d", F.lit("MAY TO APR")), ddl, rows[:2])
    assert cal == [2023, 2024]
    assert values(spark, fishing_year_by_calendar("d", F.lit("NOPE")), ddl, rows[:1]) == [None]


def test_text_dates_upper_month(spark):
    rows = [(dt.datetime(2024, 2, 3, 13, 4, 5),)]
    assert values(spark, datetime_text("d"), "d timestamp_ntz", rows) == ["03-FEB-24 13:04:05"]
    assert values(spark, date_text("d"), "d timestamp_ntz", rows) == ["03-FEB-24"]


def test_lookback_inclusive_day(spark):
    ctx = RunContext(1, dt.datetime(2024, 6, 15, 12, 0))
    cut = ctx.cutoff(730)
    rows = [(cut,), (cut - dt.timedelta(seconds=1),)]
    assert values(spark, lookback("d", cut), "d timestamp_ntz", rows) == [True, False]


def test_midpoint_and_elapsed(spark):
    rows = [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 0, 0, 1))]
    assert values(spark, midpoint("a", "b"), "a timestamp_ntz, b timestamp_ntz", rows) == \
        [dt.datetime(2024, 1, 1, 12, 0, 0, 500000)]
    got = values(spark, elapsed_days(dt.datetime(2024, 1, 3), "a"), "a timestamp_ntz, b timestamp_ntz", rows)
    assert got == [2.0]


def test_elapsed_days_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = values(spark, elapsed_days(dt.datetime(2024, 3, 11), "a"), "a timestamp_ntz",
                     [(dt.datetime(2024, 3, 10),)])   # across a DST change
        assert got == [1.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_decodes(spark):
    assert values(spark, decode("c", TRIP_CATEGORY), "c int", [(1,), (4,), (9,), (None,)]) == \
        ["COMMERCIAL", "RSA", None, None]
    assert values(spark, program_from_activity("a"), "a string", [("SES-RSA",), ("HERx",), ("ZZZ",), (None,)]) == \
        ["SCALLOP", "HERRING", None, None]


def test_dealer_rules(spark):
    ddl = "s string, d bigint, n string"
    rows = [("0811", 3, "X"), ("NC", None, "X"), ("0811", None, "X"), ("0811", 99998, "X"), ("0811", 7, "X")]
    assert values(spark, dealer_type("d"), ddl, rows) == ["DEALER", "DEALER", "DEALER", "NON-DEALER", "NON-DEALER"]
    assert values(spark, disposition("s", "d"), ddl, rows) == \
        ["?", "NO CATCH REPORTED", "SOLD TO FEDERAL DEALER", "HOME CONSUMPTION", "LANDED FOR RESEARCH"]
    assert values(spark, dealer_name_gate("s", "d", "n"), ddl, rows) == ["X", "NA", "X", "NA", "NA"]


def test_first_candidate_labels_agree(spark):
    ddl = "a bigint, b bigint, c bigint"
    v, l = first_candidate([(F.col("a"), "A"), (F.col("b"), "B"), (F.col("c"), "C")])
    df = spark.createDataFrame([(1, 2, 3), (None, 2, 3), (None, None, 3), (None, None, None)], ddl)
    got = [(r[0], r[1]) for r in df.select(v, l).collect()]
    assert got == [(1, "A"), (2, "B"), (3, "C"), (None, "C")]


def test_ntz_literal_is_zone_free(spark):
    df = spark.range(1).select(ntz(dt.datetime(2024, 1, 2, 3, 4, 5)).alias("t"))
    assert df.schema["t"].dataType.typeName() == "timestamp_ntz"
    assert df.first().t == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_match_key_matches_dialect_model_on_random_rows(spark):
    import random
    rng = random.Random(17)

    def strip(x):
        if x is None:
            return None
        y = x.lstrip("0")
        return y or None                       # '' is NULL in the source dialect

    def model(docid, permit, itis):
        parts = ["0" if docid is None else str(docid), permit or "", strip(itis) or ""]
        return "-".join(parts)

    rows = [(rng.choice([None, 0, 7, 9001, 10 ** 20]), rng.choice([None, "410001", "0"]),
             rng.choice([None, "000", "00564123", "0", "120", ""])) for _ in range(300)]
    df = spark.createDataFrame([(None if d is None else D(d), p, i) for d, p, i in rows],
                               "docid decimal(38,0), permit string, itis string")
    got = df.select(match_key(key_part("docid", 0), key_part("permit"),
                              key_part(strip_leading_zeros("itis"))).alias("k")).collect()
    assert [r.k for r in got] == [model(*r) for r in rows]


def test_fractional_serials_are_no_ids(spark):
    rows = [("12.5",), ("0.4",), ("12.0",), (" 77 ",), ("5e-1",), ("x",), (None,)]
    assert [v and int(v) for v in values(spark, to_id("x"), "x string", rows)] == [None, None, 12, 77, None, None, None]


def test_a_document_excuses_a_dirty_serial(spark):
    rows = [("12A4", 9), ("12A4", None), ("12.5", None), ("ABC", None), (None, None), ("12", None)]
    got = values(spark, unusable_serial("d", "x"), "x string, d int", rows)
    assert got == [False, True, True, False, False, False]
