"""Keyed lake table: two-path equality and the edge cases of key/precombine merge."""

import functools

import pytest
from pyspark.sql import functions as F

from rivulet.operators.lake import LakeTable, apply_changes_anti, latest_per_key
from rivulet.session import work_path
from rivulet.sources import fixtures

SCHEMA = "uuid string, partitionpath string, ts long, fare double, note string"


def _table(spark, kind="cow", merge="commit"):
    return LakeTable(spark, work_path(spark, "t"), key="uuid", precombine="ts",
                     partition="partitionpath", kind=kind, merge=merge, tiebreak=("note",))


def _rows(df, cols=("uuid", "partitionpath", "ts", "fare", "note")):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("kind", ["cow", "mor"])
def test_insert_upsert_snapshot(spark, kind):
    t = _table(spark, kind)
    t.write(spark.createDataFrame([("a", "p1", 1, 10.0, "x"), ("b", "p1", 1, 20.0, "x"),
                                   ("c", "p2", 1, 30.0, "x")], SCHEMA), commit="20240101000000")
    t.write(spark.createDataFrame([("a", "p1", 0, 11.0, "y"), ("d", "p2", 1, 40.0, "y")], SCHEMA),
            commit="20240102000000")
    snap = _rows(t.snapshot())
    # latest commit wins even with a smaller precombine value
    assert snap == [("a", "p1", 0, 11.0, "y"), ("b", "p1", 1, 20.0, "x"),
                    ("c", "p2", 1, 30.0, "x"), ("d", "p2", 1, 40.0, "y")]
    assert t.count() == 4


def test_precombine_within_commit_and_ties(spark):
    t = _table(spark, "mor")
    t.write(spark.createDataFrame([("a", "p", 1, 1.0, "x"), ("a", "p", 3, 3.0, "x"),
                                   ("a", "p", 3, 4.0, "z"), ("a", "p", 2, 2.0, "x")], SCHEMA),
            commit="20240101000000")
    # greatest precombine; tie broken by the declared tie-break column
    assert _rows(t.snapshot()) == [("a", "p", 3, 4.0, "z")]
    assert t.log().count() == 1


def test_precombine_merge_ignores_late_data(spark):
    t = _table(spark, "mor", merge="precombine")
    t.write(spark.createDataFrame([("a", "p", 5, 5.0, "new")], SCHEMA), commit="20240101000000")
    t.write(spark.createDataFrame([("a", "p", 4, 4.0, "late")], SCHEMA), commit="20240102000000")
    assert _rows(t.snapshot()) == [("a", "p", 5, 5.0, "new")]


@pytest.mark.parametrize("kind", ["cow", "mor"])
def test_delete_reinsert_and_absent_key(spark, kind):
    t = _table(spark, kind)
    t.write(spark.createDataFrame([("a", "p", 1, 1.0, "x"), ("b", "p", 1, 2.0, "x")], SCHEMA),
            commit="20240101000000")
    t.delete(spark.createDataFrame([("a", "p"), ("zz", "p")], "uuid string, partitionpath string"),
             commit="20240102000000")
    assert _rows(t.snapshot(), ("uuid",)) == [("b",)]
    t.write(spark.createDataFrame([("a", "p", 0, 9.0, "back")], SCHEMA), commit="20240103000000")
    assert _rows(t.snapshot(), ("uuid", "note")) == [("a", "back"), ("b", "x")]
    # as-of and incremental see the history
    assert _rows(t.as_of("2024-01-01 00:00:00"), ("uuid",)) == [("a",), ("b",)]
    assert _rows(t.as_of("20240102000000"), ("uuid",)) == [("b",)]
    assert _rows(t.incremental("20240102000000"), ("uuid",)) == [("a",)]


def test_whole_partition_deleted_cow(spark):
    t = _table(spark, "cow")
    t.write(spark.createDataFrame([("a", "p", 1, 1.0, "x"), ("b", "q", 1, 2.0, "x")], SCHEMA),
            commit="20240101000000")
    t.delete(spark.createDataFrame([("a", "p")], "uuid string, partitionpath string"), commit="20240102000000")
    assert _rows(t.snapshot(), ("uuid",)) == [("b",)]


def test_replayed_write_replaces_itself_only(spark):
    t = _table(spark, "mor")
    batch = spark.createDataFrame([("a", "p", 1, 1.0, "x"), ("b", "q", 1, 2.0, "x")], SCHEMA)
    other = spark.createDataFrame([("c", "p", 1, 3.0, "x")], SCHEMA)
    t.write(batch, commit="20240101000000", write_id="s-7")
    t.write(other, commit="20240101000000", write_id="other-7")
    t.write(batch, commit="20240101000000", write_id="s-7")
    assert t.log().count() == 3


@pytest.mark.parametrize("kind", ["cow", "mor"])
def test_two_writes_to_one_commit_add_up(spark, kind):
    t = _table(spark, kind)
    for key in "ab":
        t.write(spark.createDataFrame([(key, "p", 1, 1.0, "x")], SCHEMA), commit="20240101000000")
    assert _rows(t.snapshot(), ("uuid",)) == _rows(t.as_of("20240101000000"), ("uuid",)) == [("a",), ("b",)]


@pytest.mark.parametrize("kind", ["cow", "mor"])
def test_an_older_commit_written_later_is_seen(spark, kind):
    t = _table(spark, kind)
    t.write(spark.createDataFrame([("a", "p", 1, 1.0, "new")], SCHEMA), commit="20240105000000")
    t.write(spark.createDataFrame([("a", "p", 1, 1.0, "old"), ("b", "p", 1, 1.0, "old")], SCHEMA), commit="20240103000000")
    t.write(spark.createDataFrame([("c", "p", 1, 1.0, "old")], SCHEMA), commit="20240104000000")
    assert _rows(t.snapshot(), ("uuid", "note")) == [("a", "new"), ("b", "old"), ("c", "old")]


@pytest.mark.parametrize("kind", ["cow", "mor"])
def test_delete_under_precombine(spark, kind):
    t = _table(spark, kind, merge="precombine")
    rows = [(k, "p", 5, 1.0, "x") for k in "abcd"]
    t.write(spark.createDataFrame(rows, SCHEMA), commit="20240101000000")
    ids = "uuid string, partitionpath string"
    t.delete(spark.createDataFrame([("a", "p"), ("d", "p")], ids), commit="20240102000000")
    t.delete(spark.createDataFrame([("b", "p", 6), ("c", "p", 4)], f"{ids}, ts long"), commit="20240102000000")
    # without a value: beats all commits before it; with one: only smaller values
    assert _rows(t.snapshot(), ("uuid",)) == [("c",)]
    t.write(spark.createDataFrame([("d", "p", 1, 1.0, "back")], SCHEMA), commit="20240103000000")
    t.write(spark.createDataFrame([("a", "p", 99, 1.0, "late"), ("d", "p", 99, 1.0, "late")], SCHEMA), commit="20240101120000")
    assert _rows(t.snapshot(), ("uuid", "note")) == [("c", "x"), ("d", "back")]
    assert _rows(t.as_of("20240101120000"), ("uuid",)) == [("a",), ("b",), ("c",), ("d",)]


def test_instants_of_any_spelling(spark):
    t = _table(spark, "mor")
    t.write(spark.createDataFrame([("a", "p", 1, 1.0, "x")], SCHEMA), commit="20240105000000000")
    t.write(spark.createDataFrame([("b", "p", 1, 1.0, "x")], SCHEMA), commit="2024-01-05 00:00:00.5")
    clock = t.write(spark.createDataFrame([("c", "p", 1, 1.0, "x")], SCHEMA))
    assert len(clock) == 17
    for same in ("20240105000000", "20240105000000000", "2024-01-05 00:00:00", "2024-01-05", "2024-01-05T00:00:00.000"):
        assert _rows(t.as_of(same), ("uuid",)) == [("a",)]  # inclusive
        assert _rows(t.incremental(same), ("uuid",)) == [("b",), ("c",)]  # exclusive
    assert _rows(t.as_of("20240105000000500"), ("uuid",)) == [("a",), ("b",)]
    assert _rows(t.incremental("2024-01-05 00:00:00.5", clock), ("uuid",)) == [("c",)]
    for bad in ("202401050000005", "2024", "yesterday", ""):
        with pytest.raises(ValueError):
            t.as_of(bad)
    feed = spark.createDataFrame([("d", "p", 1, 1.0, "x", "2024")], SCHEMA + ", c string")
    with pytest.raises(Exception, match="not an instant"):
        t.write(feed, commit_col="c")


class _Stop(Exception):
    pass


def _stopping(table, monkeypatch, where):
    """The table's next write stops before ``where``, or half through the refresh."""
    def stop(*_, **__):
        raise _Stop
    monkeypatch.setattr(table, where, stop)


@pytest.mark.parametrize("kind", ["cow", "mor"])
def test_write_interrupted_before_its_log(spark, monkeypatch, kind):
    t = _table(spark, kind)
    t.write(spark.createDataFrame([("a", "p", 1, 1.0, "x")], SCHEMA), commit="20240101000000")
    t.write(spark.createDataFrame([("a", "p", 1, 1.0, "y")], SCHEMA), commit="20240102000000")
    real = t._append

    def half(rows, write_id, one):
        real(rows.where("uuid = 'b'"), write_id, one)
        raise _Stop

    monkeypatch.setattr(t, "_append", half)
    with pytest.raises(_Stop):
        t.write(spark.createDataFrame([("b", "p", 1, 1.0, "z"), ("c", "p", 1, 1.0, "z")], SCHEMA), commit="20240103000000")
    monkeypatch.undo()
    assert _rows(t.snapshot(), ("uuid", "note")) == _rows(t.as_of("20240201000000"), ("uuid", "note")) == [("a", "y")]
    t.write(spark.createDataFrame([("d", "p", 1, 1.0, "w")], SCHEMA), commit="20240104000000")
    assert _rows(t.snapshot(), ("uuid", "note")) == [("a", "y"), ("d", "w")]


def test_refresh_interrupted_after_the_log(spark, monkeypatch):
    t = _table(spark, "cow")
    t.write(spark.createDataFrame([("a", "p", 1, 1.0, "x"), ("b", "q", 1, 1.0, "x")], SCHEMA), commit="20240101000000")
    t.write(spark.createDataFrame([("a", "p", 1, 1.0, "y")], SCHEMA), commit="20240102000000")
    _stopping(t, monkeypatch, "_refresh_current")
    with pytest.raises(_Stop):
        t.write(spark.createDataFrame([("c", "q", 1, 1.0, "z")], SCHEMA), commit="20240103000000")
    monkeypatch.undo()
    want = [("a", "y"), ("b", "x"), ("c", "z")]
    assert _rows(t.snapshot(), ("uuid", "note")) == want
    t.write(spark.createDataFrame([("d", "p", 1, 1.0, "w")], SCHEMA), commit="20240104000000")  # another partition
    assert not t._pending()
    assert _rows(t.snapshot(), ("uuid", "note")) == _rows(t.as_of("20240201000000"), ("uuid", "note")) == [*want, ("d", "w")]


def test_failed_overwrite_leaves_the_old_table(spark, monkeypatch):
    t = _table(spark, "cow")
    t.write(spark.createDataFrame([("a", "p", 1, 1.0, "x")], SCHEMA), commit="20240101000000")
    t.tiebreak = ()
    other = spark.createDataFrame([("a", "p", 1, 7)], "uuid string, partitionpath string, ts long, seats int")
    monkeypatch.setattr(LakeTable, "_append", lambda *_: (_ for _ in ()).throw(_Stop()))
    with pytest.raises(_Stop):
        t.overwrite(other, commit="20240102000000")
    monkeypatch.undo()
    assert _rows(t.snapshot()) == [("a", "p", 1, 1.0, "x")]
    t.overwrite(other, commit="20240102000000")
    assert _rows(t.snapshot(), ("uuid", "seats")) == [("a", 7)] and "note" not in t.snapshot().columns


def test_overwrite_resets_history(spark):
    t = _table(spark, "cow")
    t.write(spark.createDataFrame([("a", "p", 1, 1.0, "x")], SCHEMA), commit="20240101000000")
    t.overwrite(spark.createDataFrame([("b", "p", 1, 1.0, "x")], SCHEMA), commit="20240102000000")
    assert _rows(t.snapshot(), ("uuid",)) == [("b",)]
    assert [r[0] for r in t.commits().collect()] == ["20240102000000000"]


def test_empty_table_reads(spark):
    t = _table(spark, "mor")
    t.write(spark.createDataFrame([], SCHEMA), commit="20240101000000")
    assert t.snapshot().count() == 0
    assert t.as_of("20240101000000").count() == 0


def test_three_paths_agree_on_trip_log(spark, sf_small):
    """log reduction == left_anti + union == a sequential fold over commits."""
    log = fixtures.trip_log(spark, sf_small)
    t = LakeTable(spark, work_path(spark, "trips"), key="uuid", precombine="ts",
                  partition="partitionpath", kind="mor", tiebreak=("event_id",))
    t.write(log, commit_col="commit_time", delete_col="is_delete")
    by_reduce = _rows(t.snapshot(), ("uuid", "event_id"))

    # sequential fold on the driver over the (small) fixture
    state = {}
    for r in sorted(log.collect(), key=lambda r: (r["commit_time"], r["ts"], r["event_id"])):
        if r["is_delete"]:
            state.pop((r["partitionpath"], r["uuid"]), None)
        else:
            state[(r["partitionpath"], r["uuid"])] = r["event_id"]
    by_fold = sorted((k[1], v) for k, v in state.items())
    assert by_reduce == by_fold

    # left_anti + union, commit by commit, on upserts only (no deletes)
    ups = log.where(~F.col("is_delete"))
    commits = sorted(r[0] for r in ups.select("commit_time").distinct().collect())
    batches = [latest_per_key(ups.where(F.col("commit_time") == c), ["uuid"], ["ts", "event_id"]) for c in commits]
    merged = functools.reduce(lambda acc, b: apply_changes_anti(acc, b, ["uuid"]), batches)
    t2 = LakeTable(spark, work_path(spark, "trips2"), key="uuid", precombine="ts",
                   partition="partitionpath", kind="cow", tiebreak=("event_id",))
    t2.write(ups.drop("is_delete"), commit_col="commit_time")
    assert _rows(merged, ("uuid", "event_id")) == _rows(t2.snapshot(), ("uuid", "event_id"))
    # as-of at the last commit == snapshot; incremental from before the first == snapshot
    last = t2.commits(1).first()[0]
    assert _rows(t2.as_of(last), ("uuid", "event_id")) == _rows(t2.snapshot(), ("uuid", "event_id"))
    assert _rows(t2.incremental("19700101000000"), ("uuid", "event_id")) == _rows(t2.snapshot(), ("uuid", "event_id"))


def test_as_of_prunes_commit_directories(spark, sf_small):
    t = LakeTable(spark, work_path(spark, "trips"), key="uuid", precombine="ts",
                  partition="partitionpath", kind="mor", tiebreak=("event_id",))
    t.write(fixtures.trip_log(spark, sf_small), commit_col="commit_time", delete_col="is_delete")
    plan = t.as_of("20240115000000")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_commit_time" in plan and "20240115000000" in plan


def test_begin_instant_is_oldest_of_newest(spark):
    t = _table(spark, "mor")
    assert t.write(spark.createDataFrame([], SCHEMA), commit="20240101000000") and t.begin_instant(3) is None
    for day in range(1, 6):
        rows = [("a", "p", day, 1.0, "x"), (f"k{day}", "p", day, 1.0, "x")]
        t.write(spark.createDataFrame(rows[: 1 if day == 4 else 2], SCHEMA), commit=f"2024010{day}000000")
    # no row of the snapshot is from the fourth: its only key was written again
    assert [r[0][:8] for r in t.commits(3).collect()] == ["20240105", "20240103", "20240102"]
    assert t.begin_instant(3) == "20240102000000000"
    # exclusive begin: the begin commit's own rows are left out
    assert _rows(t.incremental(t.begin_instant(3)), ("uuid", "ts")) == [("a", 5), ("k3", 3), ("k5", 5)]


def test_hot_key_holding_a_third_of_rows(spark, sf_small):
    """One key with a third of all rows: same answer as the fold, and the plan
    reduces it per task before the shuffle (no whole group in one task)."""
    log = fixtures.trip_log(spark, sf_small).withColumn(
        "uuid", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("uuid"))
    ).withColumn("partitionpath", F.when(F.col("uuid") == "hot", F.lit("h")).otherwise(F.col("partitionpath")))
    t = LakeTable(spark, work_path(spark, "hot"), key="uuid", precombine="ts",
                  partition="partitionpath", kind="mor", tiebreak=("event_id",))
    t.write(log, commit_col="commit_time", delete_col="is_delete")
    snap = t.snapshot()
    plan = snap._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    state = {}
    for r in sorted(log.collect(), key=lambda r: (r["commit_time"], r["ts"], r["event_id"])):
        if r["is_delete"]:
            state.pop((r["partitionpath"], r["uuid"]), None)
        else:
            state[(r["partitionpath"], r["uuid"])] = r["event_id"]
    assert _rows(snap, ("uuid", "event_id")) == sorted((k[1], v) for k, v in state.items())


def test_ride_store_keeps_one_version_per_order_and_day(spark, sf_small):
    from rivulet.operators import rides
    from rivulet.sources.delimited import write_delimited

    src = write_delimited(fixtures.rides(spark, sf_small), work_path(spark, "tsv"))
    table = rides.store_rides(spark, src, work_path(spark, "rides"))
    snap = table.snapshot()
    assert snap.count() == snap.select("partitionpath", "order_id").distinct().count()
    assert rides.report_input(table).columns == list(rides.REPORT_COLUMNS)
    assert len([c for c in snap.columns if not c.startswith("_")]) == 23


def test_ride_file_columns_are_found_by_name(spark, sf_small):
    from rivulet.sources.delimited import RIDE_FILE_SCHEMA, read_delimited, write_delimited

    rides = fixtures.rides(spark, sf_small)
    turned = rides.select("day", *reversed(rides.columns[:-1]), F.lit("more").alias("unknown"))
    got = read_delimited(spark, write_delimited(turned, work_path(spark, "tsv")))
    assert got.schema == RIDE_FILE_SCHEMA
    assert got.exceptAll(rides).count() == 0 and got.count() == rides.count()
    lacking = write_delimited(rides.drop("city_id"), work_path(spark, "tsv"))
    with pytest.raises(ValueError, match="city_id"):
        read_delimited(spark, lacking)
    inferred = read_delimited(spark, write_delimited(turned, work_path(spark, "tsv")), infer=True)
    assert dict(inferred.dtypes)["pre_total_fee"] == "double" and dict(inferred.dtypes)["departure_time"] == "timestamp"


def test_null_key_fails_the_write(spark):
    t = _table(spark, "mor")
    with pytest.raises(Exception, match="NULL record key"):
        t.write(spark.createDataFrame([(None, "p", 1, 1.0, "x")], SCHEMA), commit="20240101000000")


def test_default_tiebreak_is_deterministic(spark):
    t = LakeTable(spark, work_path(spark, "tb"), key="uuid", precombine="ts", partition="partitionpath", kind="mor")
    rows = [("a", "p", 1, 1.0, "x"), ("a", "p", 1, 3.0, "a"), ("a", "p", 1, 2.0, "z")]
    t.write(spark.createDataFrame(rows, SCHEMA), commit="20240101000000")
    # equal commit and precombine: the greatest remaining columns (fare first) win
    assert _rows(t.snapshot()) == [("a", "p", 1, 3.0, "a")]


def test_null_partition_goes_to_default_and_merges(spark):
    t = _table(spark, "cow")
    t.write(spark.createDataFrame([("a", None, 1, 1.0, "x"), ("b", None, 1, 2.0, "x"), ("c", "", 1, 3.0, "x")],
                                  SCHEMA), commit="20240101000000")
    t.write(spark.createDataFrame([("a", None, 2, 9.0, "y")], SCHEMA), commit="20240102000000")
    got = sorted(map(tuple, t.snapshot().select("uuid", "_partition_path", "fare").collect()))
    assert got == [("a", "default", 9.0), ("b", "default", 2.0), ("c", "default", 3.0)]


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_copy_on_write_plan(spark):
    """One scan of current/ and no reduction for a commit newer than all before;
    nothing is shuffled by the commit."""
    t = _table(spark, "cow")
    for day in (1, 2, 3):
        t.write(spark.createDataFrame([(f"k{day}", "p", 1, 1.0, "x"), ("a", "q", day, 1.0, "x")], SCHEMA), commit=f"2024010{day}000000")
    batch = t.log().where(F.col("_commit_time") == "20240103000000000")
    newer, any_order = t._merged(batch, "20240104000000000", t._applied()), t._merged(batch, None, t._applied())
    for df in (newer, any_order):
        plan = _executed(df)
        assert len({x for x in plan.split("FileScan")[1:] if "/current" in x.split("ReadSchema")[0]}) == 1
    assert "Window" not in _executed(newer) and "Window" in _executed(any_order)


def test_key_and_partition_filters_reach_the_scan(spark):
    for kind in ("cow", "mor"):
        t = _table(spark, kind)
        for day in (1, 2):
            t.write(spark.createDataFrame([("a", "p", 1, 1.0, "x"), ("b", "q", day, 1.0, "x")], SCHEMA), commit=f"2024010{day}000000")
        found = t.snapshot(partitions=["q"], keys=["b"])
        assert _rows(found, ("uuid", "ts")) == [("b", 2)]
        plan = _executed(found)
        pushed = plan.split("PushedFilters: [")[1].split("]")[0]
        assert "_record_key" in pushed
        assert "_partition_path" in pushed or "_partition_path" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("kind", ["cow", "mor"])
def test_partition_restricted_reads(spark, sf_small, kind):
    t = LakeTable(spark, work_path(spark, "pr"), key="uuid", precombine="ts",
                  partition="partitionpath", kind=kind, tiebreak=("event_id",))
    t.write(fixtures.trip_log(spark, sf_small), commit_col="commit_time", delete_col="is_delete")
    cols = ("uuid", "event_id", "_commit_time")
    whole = t.snapshot().where(F.col("partitionpath") == "1")
    part = t.snapshot(partitions=["1"])
    assert _rows(part, cols) == _rows(whole, cols)
    assert _rows(t.as_of("20240115000000", partitions=[1]), cols) == _rows(
        t.as_of("20240115000000").where(F.col("partitionpath") == "1"), cols)
    if kind == "cow":
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(_partition_path" in plan
