"""Bloom filters, heavy keys, disjoint periods, storage by year."""

import datetime as dt
import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import domain_fixture as fx
from quayside.operators import (
    bloom_filter, bloom_filters, code_periods, dimension, heavy_hitters, latest_at, latest_open, lookup, may_contain, membership_flag,
)
from quayside.operators import open_spans
from quayside.plans import dealer, job, vessel
from quayside.plans.common import in_window
from quayside.plans.dims import build_dims
from quayside.sources.buckets import JOIN_KEYS, is_bucketed, write_bucketed
from quayside.sources.schemas import SOURCES, struct
from quayside.sources.sinks import RunLog, read_published
from quayside.sources.tables import blanks_to_null, read_table, write_by_year, year_column
from test_plans import plan_text


# ---- Bloom filters

@pytest.mark.parametrize("kind", ["bigint", "string", "decimal(38,0)"])
def test_a_bloom_filter_loses_no_key_and_stops_most_strangers(spark, kind):
    keys = spark.range(0, 40_000, 2).select(F.col("id").cast(kind).alias("k"))
    bloom = bloom_filter(keys.unionByName(spark.createDataFrame([(None,)], f"k {kind}")), "k", 20_001)
    rows = spark.range(40_000).select("id", F.when(F.col("id") < 39_000, F.col("id")).cast(kind).alias("k"))
    got = may_contain(rows, "k", bloom, "may")
    assert got.columns == ["id", "k", "may"] and got.count() == 40_000
    n = {(r.member, r.may): r["count"] for r in got.groupBy(((F.col("id") % 2 == 0) & (F.col("id") < 39_000)).alias("member"), "may").count().collect()}
    assert n[True, True] == 19_500 and (True, False) not in n
    assert n[False, True] < 0.03 * 19_500                       # NULLs included: never members
    assert bloom.n_bytes <= 20_001 * 8 and bloom.words.count() * 1024 == bloom.n_words


def test_no_filter_beyond_the_size_bound_and_none_of_another_type(spark):
    keys = spark.range(100).select(F.col("id").alias("k"))
    assert bloom_filter(keys, "k", 10**9) is None
    assert bloom_filter(keys, "k", 5_000, max_bytes=4_000) is None
    assert may_contain(spark.range(3).select(F.col("id").alias("k")), "k", None, "may").where("may").count() == 3
    with pytest.raises(TypeError):
        may_contain(spark.createDataFrame([("a",)], "k string"), "k", bloom_filter(keys, "k", 100), "may")
    empty, full = bloom_filters([(keys.limit(0), "k"), (keys, "k")])
    assert not may_contain(keys, "k", empty, "may").where("may").count()
    assert may_contain(keys, "k", full, "may").where("may").count() == 100


def dealer_inputs(spark):
    src, dim_src = fx.sources(spark)
    dims = build_dims({k: blanks_to_null(v) for k, v in src.items()}, {k: blanks_to_null(v) for k, v in dim_src.items()})
    docids = src["document"].select("docid").distinct()
    serials = src["images"].select(F.trim("serial_num").alias("serial")).where("serial <> '0'").distinct()
    return blanks_to_null(src["dealer_landing"]), dims, docids, serials


def test_dealer_rows_are_equal_with_and_without_filters(spark):
    landings, dims, docids, serials = dealer_inputs(spark)
    landings = landings.unionByName(landings)                 # repeated rows stay repeated
    both = [dealer.build(fx.CTX, landings, dims, docids, serials, blooms=b) for b in (True, False)]
    for a, b in zip(*both):
        rows = sorted(map(str, a.collect()))
        assert rows == sorted(map(str, b.collect())) and rows and len(rows) % 2 == 0


def test_whole_landings_are_shuffled_once(spark):
    landings, dims, docids, serials = dealer_inputs(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan_text(dealer.build(fx.CTX, landings, dims, docids, serials)[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    blocks = [b for b in text.split("\n\n") if ") Exchange" in b.splitlines()[0] and "BroadcastExchange" not in b]
    assert sum("grade_desc" in b for b in blocks) == 1


# ---- heavy keys

def test_heavy_keys_are_found_and_spread(spark):
    n = 30_000
    fact = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"),
                                 F.when(F.col("id") % 4 == 0, F.lit("0")).otherwise(F.col("id").cast("string")).alias("s"))
    hot, texts = heavy_hitters(fact, ["k"], ["s"], tasks=16)
    assert 1 <= len(hot) <= 32 and 1 <= len(texts) <= 32
    dim = dimension(spark.range(n).select(F.col("id").cast("decimal(38,0)").alias("k"), (F.col("id") * 2).alias("v")), ["k"], ["v"])
    fact = fact.withColumn("k", F.col("k").cast("bigint"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")          # no automatic skew split
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        plain = lookup(fact, dim, ["k"], ["v"], row_key=["id"])
        split = lookup(fact, dim, ["k"], ["v"], row_key=["id"], hot=hot)
        assert split.exceptAll(plain).count() == plain.exceptAll(split).count() == 0 and split.count() == n

        def most(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most(plain) > n / 3 and most(split) < n / 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    flagged = membership_flag(fact, "s", spark.createDataFrame([("0",), ("1",), (None,)], "s string"), "s", "in", row_key=["id"], hot=texts)
    assert flagged.where("in").count() == fact.where("s IN ('0', '1')").count() and flagged.count() == n


def test_heavy_keys_of_odd_tables(spark):
    assert heavy_hitters(spark.createDataFrame([], "a int, b string"), ["a"], ["a", "b"]) == [[], []]
    assert heavy_hitters(spark.createDataFrame([(None,)] * 50, "a int"), ["a"]) == [[]]
    pair = spark.range(1000).select(F.lit("x").alias("a"), (F.col("id") % 2).alias("b"))
    assert len(heavy_hitters(pair, ["a", "b"])[0]) == 2


# ---- disjoint periods

def day(n, h=0):
    return dt.datetime(2000, 1, 1) + dt.timedelta(days=n, hours=h)


def validity_rows():
    rng = random.Random(6)
    rows = [("p1", "i", day(0), day(10), "A"), ("p1", "i", day(5), day(15), "B"), ("p1", "i", day(10), day(10), "C"),       # one instant
            ("p1", "i", day(20), None, "A"), ("p1", "i", day(20, 3), day(20, 9), "D"), ("p1", "i", day(30), day(25), "X"),  # turned round
            ("p1", "i", None, day(9), "X"), (None, "i", day(0), day(9), "X"), ("p1", "i", day(7), day(9), None),
            ("p2", "i", day(0), dt.datetime(9999, 12, 31), "Z"), ("p2", "i", day(0), day(3), "Z"), ("p2", "j", day(1), None, "Y")]
    for _ in range(300):       # a busy permit
        a = rng.randrange(400)
        rows.append(("hot", "i", day(a), rng.choice([None, day(a + rng.randrange(60), rng.randrange(24))]), rng.choice("ABCDEFG")))
    return rows


@pytest.mark.parametrize("null_end_open", [True, False])
def test_periods_equal_brute_force(spark, null_end_open):
    rows = validity_rows()
    df = spark.createDataFrame(rows, "permit string, itis string, f timestamp_ntz, t timestamp_ntz, code string")
    periods = code_periods(df, ["permit", "itis"], "f", "t", {"code": "code"}, null_end_open=null_end_open, bucket_days=30)
    assert periods.groupBy("permit", "itis", "since").count().where("count > 1").count() == 0
    us = dt.timedelta(microseconds=1)
    instants = {x + d for r in rows for x in r[2:4] if x and x.year < 9000 for d in (-us, 0 * us, us)} | {day(-5), day(100, 7), day(5000)}
    rng = random.Random(1)
    probes = [(i, p, s, at) for i, (p, s, at) in enumerate(
        (p, s, at) for p in ("p1", "p2", "none", None) for s in ("i", "j", None) for at in rng.sample(sorted(instants), 60))]
    probes += [(10_000 + i, "hot", "i", at) for i, at in enumerate(sorted(instants))] + [(20_000, "p1", "i", None)] * 2
    want = []
    for i, p, s, at in probes:
        held = {c for k, m, f, t, c in rows if at and k == p and m == s and p and s and f and c and f <= at and (t >= at if t else null_end_open)}
        want.append((i, ",".join(sorted(held)) or None))
    asked = spark.createDataFrame(probes, "id long, permit string, species string, at timestamp_ntz").repartition(3)
    got = latest_at(asked, periods, {"permit": "permit", "species": "itis"}, "at", {"code": "codes"})
    assert got.columns == ["id", "permit", "species", "at", "codes"]
    assert sorted((r.id, r.codes) for r in got.collect()) == sorted(want)
    assert latest_at(asked, periods.limit(0), {"permit": "permit", "species": "itis"}, "at", {"code": "codes"}).where("codes IS NULL").count() == len(probes)


def test_one_busy_key_is_searched_by_many_tasks(spark):
    periods = spark.range(4_000).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("since"), F.col("id").alias("v"))
    rows = spark.range(20_000).select("id", F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 720 + 5).cast("timestamp_ntz").alias("at"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # else so few rows are put into one task
    try:
        got = latest_at(rows, periods, {"k": "k"}, "at", {"v": "v"})
        assert got.where(F.col("v") == F.floor(F.col("id") / 5)).count() == 20_000
        assert got.groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# ---- the latest open span

def brute_latest_open(probes, spans):
    out = set()
    for k, t in probes:
        held = [(s, d) for g, s, e, d in spans if None not in (k, t, g, s, e) and g == k and s <= t <= e]
        if held:
            out.add((k, t, max(held)[1]))
    return sorted(out)


@pytest.mark.parametrize("fan", [16, 2])
def test_latest_open_span_equals_brute_force(spark, monkeypatch, fan):
    monkeypatch.setattr(open_spans, "_SHIFT", fan.bit_length() - 1)
    rng = random.Random(fan)
    spans = [(p, day(rng.randrange(60), rng.randrange(24)), None, i) for i, p in enumerate(rng.choices(["a", "b", "c"], k=60))]
    spans = [(p, s, s + dt.timedelta(hours=rng.choice([0, 1, 5, 30, 200])), i) for p, s, _, i in spans]
    # a busy permit: hundreds of short spans in one week, one that outlasts them all, one of the same start
    spans += [("hot", day(10) + dt.timedelta(minutes=7 * i), day(10) + dt.timedelta(minutes=7 * i + rng.choice([0, 3, 9, 400])), 1000 + i) for i in range(600)]
    spans += [("hot", day(9), day(40), 5000), ("hot", day(9), day(40), 5001), ("hot", day(12), day(11), 5002), ("hot", None, day(12), 5003),
              ("hot", day(9), None, 5004), (None, day(0), day(90), 5005), ("d", day(1), day(1), 5006)]
    probes = [(p, day(rng.randrange(60), rng.randrange(24))) for p in ("a", "b", "c", "d", "none", None) for _ in range(40)]
    probes += [("hot", day(10) + dt.timedelta(minutes=rng.randrange(-2000, 9000))) for _ in range(300)] + [("hot", None), ("d", day(1)), ("hot", day(40))]
    probes += [(p, s) for p, s, _, _ in spans[:20]] + [(p, e) for p, _, e, _ in spans[20:40]]
    s = spark.createDataFrame(spans, "permit string, f timestamp_ntz, t timestamp_ntz, docid long").repartition(3)
    p = spark.createDataFrame(probes, "vessel string, at timestamp_ntz").repartition(3)
    got = latest_open(p, s, {"vessel": "permit"}, "at", "f", "t", ["docid"])
    assert got.columns == ["vessel", "at", "docid"]
    assert sorted(map(tuple, got.collect())) == brute_latest_open(probes, spans)
    assert latest_open(p, s.limit(0), {"vessel": "permit"}, "at", "f", "t", ["docid"]).count() == 0


# ---- storage by year

def test_a_window_opens_its_own_years_only(spark, tmp_path):
    src, _ = fx.sources(spark)
    old = src["dealer_landing"]
    spread = old
    for y in range(2010, 2025):     # landings of many years, and one without a date
        spread = spread.unionByName(old.limit(1).withColumn("ddate", F.make_date(F.lit(y), F.lit(7), F.lit(1)).cast("timestamp_ntz")))
    spread = spread.unionByName(old.limit(1).withColumn("ddate", F.lit(None).cast("timestamp_ntz")))
    cutoff = fx.CTX.cutoff_for("dealer")
    edge = [cutoff - dt.timedelta(microseconds=1), cutoff, cutoff + dt.timedelta(days=1), dt.datetime(cutoff.year, 1, 1), dt.datetime(cutoff.year - 1, 12, 31, 23, 59, 59)]
    for t in edge:
        spread = spread.unionByName(old.limit(1).withColumn("ddate", F.lit(t.isoformat(" ")).cast("timestamp_ntz")))
    path = f"{tmp_path}/dealer_landing.parquet"
    write_by_year(spread, path, "ddate")
    stored = read_table(spark, str(tmp_path), "dealer_landing", struct(SOURCES["dealer_landing"]))
    kept = in_window(stored, "ddate", cutoff)
    assert kept.columns == old.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, spread.where(F.col("ddate") >= F.lit(cutoff.isoformat(" ")).cast("timestamp_ntz")).collect()))
    text = plan_text(kept)
    filters = [line for line in text.splitlines() if line.startswith("PartitionFilters")][0]
    assert year_column("ddate") in filters and str(cutoff.year) in filters
    assert "GreaterThanOrEqual(ddate" in text
    years = {f.split(f"{year_column('ddate')}=")[1].split("/")[0] for f in kept.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert years and all(int(y) >= cutoff.year for y in years)
    dims_in = dealer_inputs(spark)[1:]
    feed = plan_text(dealer.qualified(in_window(blanks_to_null(stored), "ddate", cutoff).withColumn("_serial_key", F.trim("vtrserno")), *dims_in))
    assert "PartitionFilters: [isnotnull(_ddate_year" in feed


# ---- storage by join key

def test_big_joins_read_buckets_as_they_lie(spark, tmp_path):
    src, dim_src = fx.sources(spark)
    src, dim_src = ({k: blanks_to_null(v) for k, v in x.items()} for x in (src, dim_src))
    docids = src["document"].select("docid").distinct()
    plain = vessel.build(fx.CTX, src["document"], src["images"], src["catch"], build_dims(src, dim_src), docids)
    stored = dict(src)
    for name in ("document", "images", "catch"):
        write_bucketed(src[name], f"{tmp_path}/{name}.parquet", JOIN_KEYS[name], 8)
        assert is_bucketed(spark, f"{tmp_path}/{name}.parquet")
        stored[name] = read_table(spark, str(tmp_path), name, struct(SOURCES[name]))     # another session's way in
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = vessel.chain(fx.CTX, stored["document"], stored["images"], stored["catch"], docids)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    assert sum("Bucketed: true" in x for x in lines) == 3
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    for i, line in enumerate(lines):      # what lies between each stored table and its join
        if "Bucketed: true" not in line:
            continue
        at, above = i, []
        while not above or "Join" not in above[-1]:
            at = max(j for j in range(at) if depth[j] < depth[at])
            above.append(lines[at])
        assert not any("Exchange" in x for x in above), above
    built = vessel.build(fx.CTX, stored["document"], stored["images"], stored["catch"], build_dims(stored, dim_src), docids)
    rows = [sorted(map(str, x.collect())) for x in (plain, built)]
    assert rows[0] == rows[1] and rows[0]


def test_feed_rows_are_equal_from_yearly_storage(spark, tmp_path):
    landings, dims, docids, serials = dealer_inputs(spark)
    write_by_year(landings, f"{tmp_path}/by_year", "ddate")
    stored = spark.read.parquet(f"{tmp_path}/by_year")
    rows = [sorted(map(str, dealer.build(fx.CTX, x, dims, docids, serials)[0].collect())) for x in (landings, stored)]
    assert rows[0] == rows[1] and rows[0]


def test_borders_that_repeat_make_one_period(spark):
    rows = [("k", day(0), day(4), c) for c in "ABCABC"]
    df = spark.createDataFrame(rows, "k string, f timestamp_ntz, t timestamp_ntz, code string")
    got = defaultdict(list)
    for r in code_periods(df, ["k"], "f", "t", {"code": "code"}).collect():
        got[r.since].append(r.code)
    assert dict(got) == {day(0): ["A,B,C"], day(4) + dt.timedelta(microseconds=1): [None]}


def test_a_second_run_by_year_in_the_same_warehouse(spark, tmp_path):
    """Targets stored by year hold the same rows and open the years asked for;
    support tables that did not change are not written again."""
    src, dims = fx.sources(spark)
    wh = str(tmp_path)
    plain = job.run(spark, fx.CTX, src, dims, wh)
    by_year = job.run(spark, fx.CTX, src, dims, wh, by_year=True)
    assert plain.counts == by_year.counts
    done = RunLog(spark, wh).read().where("status = 'SUCCESS'").orderBy("logged_at").collect()
    first, second = (json.loads(r.counts)["dimension_changes"] for r in done)
    assert any(c["new"] for c in first.values())
    for name, c in second.items():
        assert not any(c.values()) or name == "_dim_project_windows", name
        assert by_year.paths[name] == plain.paths[name] or name == "_dim_project_windows"
    assert read_published(spark, wh, "_dimension_conflicts").columns == ["dimension", "key", "value", "candidates", "rows", "picked"]
    since = dt.datetime(2024, 1, 1)
    for target, date in job.WINDOW_DATES.items():
        a, b = spark.read.parquet(plain.paths[target]), read_published(spark, wh, target)
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect())), target
        part = read_published(spark, wh, target, date=date, since=since)
        assert part.columns == a.columns and part.count() == a.where(F.col(date) >= F.lit("2024-01-01").cast("timestamp_ntz")).count()
        filters = [line for line in plan_text(part).splitlines() if line.startswith("PartitionFilters")][0]
        assert year_column(date) in filters


def test_periods_of_few_and_many_rows_agree_and_rows_travel_once(spark, monkeypatch):
    """quarantine_vms, feed_vms, feed_ivr: an ordinary key's rows meet in one shuffle, without buckets."""
    from quayside.operators import periods as module
    from quayside.operators.maintenance import written_tables
    df = spark.createDataFrame(validity_rows(), "permit string, itis string, f timestamp_ntz, t timestamp_ntz, code string")

    def rows(few):
        monkeypatch.setattr(module, "FEW", few)
        with written_tables() as tables:
            out = code_periods(df, ["permit", "itis"], "f", "t", {"code": "code"}, null_end_open=True, bucket_days=30)
        return out, len(tables), sorted(map(tuple, out.collect()), key=str)
    all_few, written, got = rows(1000)
    assert got == rows(0)[2] == rows(64)[2]
    plan = all_few._jdf.queryExecution().analyzed().toString()
    assert written == 2 and "_plvl" not in plan and "_lvl" not in plan


def test_latest_at_writes_no_rows_and_skips_periods_nobody_asks_for(spark):
    from quayside.operators.maintenance import written_tables
    periods = spark.range(4_000).select((F.col("id") % 400).cast("string").alias("k"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("since"), F.col("id").alias("v"))
    rows = spark.range(50).select("id", F.when(F.col("id") % 5 > 0, (F.col("id") % 4).cast("string")).alias("k"), F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("at"))
    with written_tables() as tables:
        got = latest_at(rows, periods, {"k": "k"}, "at", {"v": "v"})
    assert all("id" not in t.columns for t in tables)          # a filter's keys and words only
    want = {i: max((v for v in range(4_000) if v % 400 == i % 4 and v * 60 <= i * 3600), default=None) if i % 5 else None for i in range(50)}
    assert {r.id: r.v for r in got.collect()} == want


def test_only_possible_loses_no_row(spark):
    from quayside.operators import only_possible
    keys = spark.range(0, 200, 7).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    got = {r.id for r in only_possible(spark.range(5_000), "id", keys, "k").collect()}
    assert {i for i in range(0, 200, 7) if i % 2 == 0} <= got and len(got) < 500
    assert only_possible(spark.range(10), "id", keys.select(F.col("k").cast("string").alias("k")), "k").count() == 10


def test_feeds_shuffle_whole_rows_once(spark):
    """F1, F4 to F7: what a feed searches for, it searches with a few columns."""
    from quayside.operators.maintenance import written_tables
    from quayside.plans import dealer, ivr
    from quayside.plans.job import backfill_projects, reported_projects
    src, dim_src = fx.sources(spark)
    src, dim_src = ({k: blanks_to_null(v) for k, v in x.items()} for x in (src, dim_src))
    dims = build_dims(src, dim_src)
    docids = src["document"].select("docid").distinct()
    with written_tables() as tables:
        reports = ivr.build(fx.CTX, src["ivr_trip"], src["ivr_report"], src["ivr_landing"], dims)[0]
    assert all(len(t.columns) < 12 for t in tables if "_cut" in t.columns) and any("_cut" in t.columns for t in tables)
    with written_tables() as tables:
        dealer.build(fx.CTX, src["dealer_landing"], dims, docids, src["images"].select(F.col("serial_num").alias("serial")).distinct())
    assert sum(t.columns == ["_bl_chunk", "_bl_bits"] for t in tables) >= 3
    projects, widths = reported_projects(reports), []

    def fill(rows):
        widths.append(len(rows.columns))
        return backfill_projects(rows, projects, "serial_num")
    args = (fx.CTX, src["document"], src["images"], src["catch"], dims, docids)
    filled, plain = vessel.build(*args, fill), backfill_projects(vessel.build(*args), projects, "serial_num")
    assert widths[0] < 12 and filled.columns == plain.columns
    assert sorted(map(str, filled.collect())) == sorted(map(str, plain.collect()))
