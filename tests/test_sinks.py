"""Staged publish and run log (SNK-1, SNK-9)."""

import datetime as dt
import os

import pytest

import domain_fixture as fx
from quayside.plans import job
from quayside.sources import sinks
from quayside.sources.files import Files
from quayside.sources.sinks import RunLog, Stage, clean, pinned, read_pointer, read_published

DAY = dt.timedelta(days=1)


def later(days):
    return dt.datetime.now(dt.timezone.utc) + days * DAY


def published(spark, wh, seq, **rows):
    s = Stage(spark, wh, seq)
    for table, n in rows.items():
        s.write(table, spark.range(n))
    s.publish()
    return s


def folders(wh):
    return sorted(str(p.relative_to(wh)) for p in wh.glob("_staging/*/*"))


def test_second_publish_repoints_tables(spark, tmp_path):
    wh = str(tmp_path)
    s1 = Stage(spark, wh, 1)
    s1.write("a", spark.range(3))
    s1.write("b", spark.range(5))
    s1.publish()
    s2 = Stage(spark, wh, 2)
    s2.write("a", spark.range(7))
    s2.publish()
    assert read_published(spark, wh, "a").count() == 7      # new run
    assert read_published(spark, wh, "b").count() == 5      # untouched table keeps its last run
    assert sorted((r.table, r.run_seq) for r in read_pointer(spark, wh).collect()) == [("a", 2), ("b", 1)]
    assert s2.counts == {"a": 7}


def test_failed_run_is_logged_reraised_and_not_published(spark, tmp_path):
    src, dims = fx.sources(spark)
    del src["catch"]                                       # the vessel feed cannot run
    with pytest.raises(KeyError):
        job.run(spark, fx.CTX, src, dims, str(tmp_path))
    log = RunLog(spark, str(tmp_path)).read().orderBy("logged_at").collect()
    assert [r.status for r in log] == ["START", "FAILED"]
    assert read_pointer(spark, str(tmp_path)) is None      # nothing half-published


def test_a_run_id_can_run_again(spark, tmp_path):
    wh = str(tmp_path)
    first = Stage(spark, wh, 7)
    first.write("a", spark.range(3))
    first.publish()
    reader = read_published(spark, wh, "a")
    again = Stage(spark, wh, 7)
    again.write("a", spark.range(9))
    assert reader.count() == 3 and read_published(spark, wh, "a").count() == 3    # not published yet
    again.publish()
    assert reader.count() == 3 and read_published(spark, wh, "a").count() == 9


def test_the_newest_publish_counts_not_the_highest_run(spark, tmp_path):
    wh = str(tmp_path)
    for seq, n in ((5, 5), (2, 2)):
        s = Stage(spark, wh, seq)
        s.write("a", spark.range(n))
        s.publish()
    assert read_published(spark, wh, "a").count() == 2


def test_other_read_errors_are_not_taken_for_nothing_published(spark, tmp_path):
    (tmp_path / "_published" / "publish=1").mkdir(parents=True)
    (tmp_path / "_published" / "publish=1" / "part-0.parquet").write_text("no parquet")
    (tmp_path / "_published" / "publish=1" / "_SUCCESS").write_text("")     # a finished publish
    with pytest.raises(Exception, match="(?i)parquet|footer|FAILED_READ"):
        Stage(spark, str(tmp_path), 1).publish() or read_pointer(spark, str(tmp_path)).count()


@pytest.mark.parametrize("died", ["before a row", "while writing", "before its mark"])
def test_a_publish_that_died_blocks_nobody(spark, tmp_path, monkeypatch, died):
    wh = str(tmp_path)
    published(spark, wh, 1, a=3)
    dead = Stage(spark, wh, 2)
    dead.write("a", spark.range(99))
    if died == "before its mark":
        monkeypatch.setattr(Files, "exists", lambda self, path, real=Files.exists: not path.endswith("_SUCCESS") and real(self, path))
        monkeypatch.setattr(Files, "claim", lambda self, path, real=Files.claim: real(self, path) if not path.endswith("_SUCCESS") else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            dead.publish()
        monkeypatch.undo()
        os.remove(tmp_path / "_published" / "publish=2" / "_SUCCESS")
    else:
        (tmp_path / "_published" / "publish=2" / "_temporary" / "0").mkdir(parents=True)
        if died == "while writing":
            (tmp_path / "_published" / "publish=2" / "part-0.parquet").write_text("PAR1 cut off")
    assert read_published(spark, wh, "a").count() == 3            # the dead one is not seen
    published(spark, wh, 3, b=4)
    published(spark, wh, 4, a=5)
    assert read_published(spark, wh, "a").count() == 5 and read_published(spark, wh, "b").count() == 4
    assert sorted(os.listdir(tmp_path / "_published")) == [f"publish={n}" for n in (1, 2, 3, 4)]


def test_two_publishers_do_not_undo_each_other(spark, tmp_path, monkeypatch):
    wh = str(tmp_path)
    published(spark, wh, 1, a=1, b=1)
    first, second = Stage(spark, wh, 2), Stage(spark, wh, 3)
    first.write("a", spark.range(2))
    second.write("b", spark.range(3))
    real = Files.claim

    def late(self, path):   # the other one takes the number in between
        monkeypatch.setattr(Files, "claim", real)
        first.publish()
        return real(self, path)
    monkeypatch.setattr(Files, "claim", late)
    second.publish()
    assert (first.published, second.published) == (2, 3)
    assert read_published(spark, wh, "a").count() == 2 and read_published(spark, wh, "b").count() == 3


def test_clean_deletes_only_what_is_old_and_unnamed(spark, tmp_path):
    wh = str(tmp_path)
    s1 = published(spark, wh, 1, a=1, b=1)
    s2 = published(spark, wh, 2, a=2)             # b is still read from run 1
    failed = Stage(spark, wh, 2)
    failed.write("a", spark.range(9))             # never published
    (tmp_path / "_published" / "publish=3" / "_temporary").mkdir(parents=True)
    assert clean(spark, wh, DAY) == []            # nothing is old yet
    gone = clean(spark, wh, DAY, now=later(2))
    assert [g for g in gone if "_staging" in g] == [f"{wh}/_staging/run=2/attempt={failed.attempt}"]
    assert read_published(spark, wh, "a").count() == 2 and read_published(spark, wh, "b").count() == 1
    s3 = published(spark, wh, 3, b=3)             # now nothing of run 1 is current
    clean(spark, wh, DAY, now=later(2))
    assert folders(tmp_path) == sorted(f"_staging/run={s.run_seq}/attempt={s.attempt}" for s in (s2, s3))
    assert read_published(spark, wh, "a").count() == 2 and read_published(spark, wh, "b").count() == 3
    assert not (tmp_path / "_published" / "publish=1").exists() and not s1.paths["a"] in [r.path for r in read_pointer(spark, wh).collect()]
    assert published(spark, wh, 4, a=4) and read_published(spark, wh, "a").count() == 4
    assert clean(spark, str(tmp_path / "nowhere")) == []


def test_clean_keeps_what_was_replaced_lately_and_what_a_reader_holds(spark, tmp_path):
    wh = str(tmp_path)
    s1 = published(spark, wh, 1, a=1)
    os.utime(tmp_path / "_published" / "publish=1" / "_SUCCESS", (0, 0))
    with pinned(spark, wh, lasts=10 * DAY) as tables:
        published(spark, wh, 2, a=2)
        assert clean(spark, wh, DAY) == []                       # replaced a moment ago
        clean(spark, wh, DAY, now=later(2))                      # old, but pinned
        assert tables["a"].count() == 1
        assert f"_staging/run=1/attempt={s1.attempt}" in folders(tmp_path)
        clean(spark, wh, DAY, now=later(20))                     # a dead reader's pin runs out
        assert f"_staging/run=1/attempt={s1.attempt}" not in folders(tmp_path)
    assert os.listdir(tmp_path / "_readers") == [] or all(n.endswith(".crc") for n in os.listdir(tmp_path / "_readers"))


def test_a_cleaned_attempt_cannot_be_published(spark, tmp_path):
    wh = str(tmp_path)
    s = Stage(spark, wh, 1)
    s.write("a", spark.range(1))
    assert len(clean(spark, wh, DAY, now=later(2))) >= 1
    with pytest.raises(FileNotFoundError, match="a"):
        s.publish()
    assert sinks.read_pointer(spark, wh) is None


def test_support_tables_are_refreshed_by_difference(spark, tmp_path):
    wh = str(tmp_path)
    rows = [(1, "a", None), (2, "b", 5), (3, None, 7)]

    def refresh(seq, rows):
        s = Stage(spark, wh, seq)
        got = s.write_changes("_dim_x", spark.createDataFrame(rows, "k int, v string, n int"), ["k"])
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(rows, key=repr)
        s.publish()
        return s

    first = refresh(1, rows)
    assert first.changes == {"_dim_x": {"new": 3, "changed": 0, "gone": 0}}
    same = refresh(2, rows[::-1])
    assert same.changes == {"_dim_x": {"new": 0, "changed": 0, "gone": 0}} and same.paths == first.paths    # not written again
    other = refresh(3, [(1, "a", 1), (2, "b", 5), (4, "d", 4), (5, "e", 5)])
    assert other.changes == {"_dim_x": {"new": 2, "changed": 1, "gone": 1}} and other.paths != first.paths
    assert refresh(4, []).changes == {"_dim_x": {"new": 0, "changed": 0, "gone": 4}}
    clean(spark, wh, DAY, now=later(2))
    assert read_published(spark, wh, "_dim_x").count() == 0
    retyped = Stage(spark, wh, 5)
    retyped.write_changes("_dim_x", spark.createDataFrame([(1, 2)], "k int, v int"), ["k"])
    assert retyped.changes["_dim_x"] == {"new": 1, "changed": 0, "gone": 0}


def test_a_kept_table_survives_the_cleaning_of_later_runs(spark, tmp_path):
    wh = str(tmp_path)
    for seq in (1, 2, 3):
        s = Stage(spark, wh, seq)
        s.write("a", spark.range(seq))
        s.write_changes("_dim_x", spark.createDataFrame([(1, "a")], "k int, v string"), ["k"])
        s.publish()
        clean(spark, wh, DAY, now=later(2))
    assert read_published(spark, wh, "_dim_x").count() == 1 and read_published(spark, wh, "a").count() == 3
