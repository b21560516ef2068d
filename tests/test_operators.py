"""Operators against brute force on small data."""

import datetime as dt
import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gaugeworks.functions.cleaning import round2
from gaugeworks.operators import incremental, mode
from gaugeworks.operators.bank import window_bank
from gaugeworks.operators.dedup import keep_first
from gaugeworks.operators.frames import Frame, forward_frames
from gaugeworks.operators.joins import _heavy_keys, _placed, full_outer, not_in
from gaugeworks.operators.marts import mart, mart_from_bank
from gaugeworks.operators.mode import forward_mode
from gaugeworks.operators.nested import canonical_json, malformed_documents, parse_documents, subdocument
from gaugeworks.sources import documents, tables
from gaugeworks.streaming import ingest
from gaugeworks.streaming.ingest import ingest_available

INTERVALS = ["10 seconds", "90 minutes", "1 hour", "3 hours", "1 day", "1 week", "1 month", "2 months"]


@pytest.fixture(scope="module")
def readings(spark):
    """Three stations, one of them NULL and one with most rows, around the ends of several months."""
    pick = random.Random(5)
    rows = []
    for day in [dt.datetime(2024, 1, d) for d in (1, 28, 29, 30, 31)] + [dt.datetime(2024, m, d) for m in (2, 3, 4) for d in (1, 27, 28, 29, 30) if (m, d) != (2, 30)]:
        for _ in range(14):
            station = pick.choice(["hot", "hot", "hot", "b", None])
            minute = pick.choice([0, 10, 59, pick.randrange(1440)])
            value = pick.choice([None, round(pick.uniform(0, 100), 2), 7.0])
            rows.append((len(rows), station, day + dt.timedelta(minutes=minute), value, pick.randrange(4)))
    return spark.createDataFrame(rows, "id int, station string, ts timestamp_ntz, v double, k int").cache()


def brute_force(spark, df, intervals, column, keyed=True):
    df.createOrReplaceTempView("readings")
    same = "a.station <=> b.station AND" if keyed else ""
    parts = [
        f"""SELECT '{i}' AS frame, a.id, avg(b.{column}) AS avg, sum(b.{column}) AS sum, max(b.{column}) AS max,
            mode(b.{column}, true) AS mode FROM readings a JOIN readings b
            ON {same} b.ts BETWEEN a.ts AND a.ts + INTERVAL {i} GROUP BY a.id"""
        for i in intervals
    ]
    rows = spark.sql(" UNION ALL ".join(parts)).select("frame", "id", *[round2(f).alias(f) for f in ("avg", "sum", "max", "mode")])
    return {(r.frame, r.id): (r.avg, r.sum, r.max, r.mode) for r in rows.collect()}


@pytest.mark.parametrize("base", [None, "day", "hour", "minute"])
@pytest.mark.parametrize("column", ["v", "k"])
def test_forward_frames(spark, readings, base, column):
    wanted_frames = [Frame(f"{f}|{i}", f, column, i) for i in INTERVALS for f in ("avg", "sum", "max")]
    found = forward_frames(readings, wanted_frames, "ts", ["station"], base).collect()
    wanted = brute_force(spark, readings, INTERVALS, column)
    assert len(found) == readings.count()
    for row in found:
        for i in INTERVALS:
            assert tuple(row[f"{f}|{i}"] for f in ("avg", "sum", "max")) == wanted[i, row.id][:3], (i, row)


def test_forward_frames_without_key(spark, readings):
    wanted_frames = [Frame(f"{f}|1 month", f, "v", "1 month") for f in ("avg", "sum", "max")]
    wanted = brute_force(spark, readings, ["1 month"], "v", keyed=False)
    for row in forward_frames(readings, wanted_frames, "ts", [], "hour").collect():
        assert tuple(row[f"{f}|1 month"] for f in ("avg", "sum", "max")) == wanted["1 month", row.id][:3]


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("interval", ["1 hour", "1 day", "1 month"])
def test_forward_mode(spark, readings, keyed, interval):
    wanted = brute_force(spark, readings, [interval], "k", keyed)
    found = forward_mode(readings, "k", "ts", interval, "m", ["station"] if keyed else []).collect()
    assert len(found) == readings.count()
    assert all(r.m == wanted[interval, r.id][3] for r in found)


def grid(spark, days):
    """Two stations every ten minutes with gaps on boundaries and NULLs."""
    values = ("air_temperature", "air_pressure", "relative_humidity", "wind_speed", "peak_gust_speed", "precipitation", "sunshine_duration_10Min")
    rows = spark.range(days * 144 * 2).selectExpr(
        "concat('C0', id % 2) AS station_id",
        "TIMESTAMP_NTZ'2024-01-28 00:00:00' + make_dt_interval(0, 0, CAST(id div 2 AS INT) * 10) AS measure_at",
        "concat('name ', id % 2) AS station_name",
        "'class' AS station_type",
        *[f"CASE WHEN pmod(hash(id, {i}), 4) > 0 THEN pmod(hash({i}, id), 1000) / 10D END AS {v}" for i, v in enumerate(values)],
    )
    return rows.where("pmod(hash(station_id, measure_at), 11) > 0")


def test_marts_agree(spark):
    measured = grid(spark, 6).cache()
    bank = window_bank(measured, base="hour").cache()
    for grain in ("hour", "day", "week", "month"):
        direct, selected = mart(measured, grain), mart_from_bank(bank, grain)
        assert sorted(direct.columns) == sorted(selected.columns) and len(direct.columns) == 17
        selected = selected.select(direct.columns)
        assert direct.exceptAll(selected).isEmpty() and selected.exceptAll(direct).isEmpty()
    assert mart(measured, "hour").count() > 200


def test_bank_of_new_rows_equals_filtered_bank(spark):
    measured = grid(spark, 3)
    mark = "measure_at > TIMESTAMP_NTZ'2024-01-29 07:30:00'"
    after, before = window_bank(measured, base="day").where(mark), window_bank(measured.where(mark), base="day")
    assert after.exceptAll(before).isEmpty() and before.exceptAll(after).isEmpty()


def test_full_outer_and_not_in(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, x string")
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (None, 40)], "k int, y int")
    found = full_outer(left, right, "k").select("l.x", "r.y")
    wanted = left.join(right, "k", "full_outer").select("x", "y")
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    left.createOrReplaceTempView("lefts")
    for keys in ("SELECT 1 AS k", "SELECT 1 AS k UNION ALL SELECT NULL", "SELECT 1 AS k WHERE false"):
        wanted = spark.sql(f"SELECT * FROM lefts WHERE k NOT IN ({keys})").collect()
        assert sorted(map(str, not_in(left, "k", spark.sql(keys), "k").collect())) == sorted(map(str, wanted))


@pytest.mark.parametrize("hot_left,hot_right", [(300, 2), (2, 300), (60, 60), (300, 0), (0, 300)])
def test_full_outer_spreads_a_heavy_key(spark, hot_left, hot_right):
    """A key with most of a side's rows is dealt to several tasks; every row pairs, or stays alone, as in one join."""
    left = spark.createDataFrame([(7, f"l{i}") for i in range(hot_left)] + [(i, "x") for i in range(100, 350)] + [(None, "n")], "k int, x string")
    right = spark.createDataFrame([(7, i) for i in range(hot_right)] + [(i, i) for i in range(200, 450)] + [(None, 1)], "k int, y int")
    found = full_outer(left, right, "k", spread=8)
    assert sorted(map(str, found.collect())) == sorted(map(str, full_outer(left, right, "k").collect()))
    placed = _placed(left.selectExpr("k", "struct(x) AS l"), "l", "k", _heavy_keys(left, "k"), _heavy_keys(right, "k"), True, 8)
    places = {r[-1] for r in placed.where("k = 7").collect()}
    assert len(places) == (0 if not hot_left else 8)


def test_canonical_json(spark):
    """Equal numbers are spelled alike in any nesting; strings that look like numbers stay."""
    spellings = {
        "1": ["1", "1.0", "1e0", "0.1e1", "10E-1"],
        "12500000000": ["12500000000", "1.25e10", "125E8"],
        "-0.00000015": ["-1.5e-7", "-0.00000015", "-0.00000015000"],
        "1234.5": ["1234.5", "1.2345e3", "1234.50"],
        "0": ["0", "0.0", "0e0", "-0"],
        "1" + "0" * 300: ["1e300"],
    }
    wrap = '{"b":[{"n":%s,"t":"1.0 \\\\\\" 2.0E5"},%s],"a":"x\\\\","c 1.0":{}}'
    for plain, texts in spellings.items():
        frame = spark.createDataFrame([(wrap % (t, t),) for t in texts], "value string")
        (found,) = {r[0] for r in parse_documents(frame).select(canonical_json("doc")).collect()}
        assert f'"n":{plain},' in found and '2.0E5"' in found and '"c 1.0":{}' in found
        assert json.loads(found, parse_int=float) == json.loads(wrap % (texts[0], texts[0]), parse_int=float)
        parts = parse_documents(frame).select(subdocument("doc", "b").alias("b")).distinct()
        assert parts.count() == 1


def test_malformed_documents_are_counted_and_kept_aside(spark):
    frame = spark.createDataFrame([(1, '{"k":1}'), (2, '{"k":'), (3, None), (4, "")], "id int, value string")
    seen = Observation()
    docs = parse_documents(frame, lenient=True, observation=seen)
    assert docs.where("doc IS NOT NULL").count() == 1
    assert seen.get == {"documents": 4, "malformed": 2}
    assert sorted(r.id for r in malformed_documents(frame).collect()) == [2, 4]


def test_plans(spark, readings):
    """One shuffle of the rows per slice pass; copies of a key are thinned out before the shuffle."""

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    hourly = plan(forward_frames(readings, [Frame("s", "sum", "v", "1 hour")], "ts", ["station"], "hour"))
    assert hourly.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in plan(keep_first(readings, ["station", "ts"], ["id"]))
    two = full_outer(readings, readings.select("station", "k"), "station").select("l.station", "r.k")
    joined = plan(full_outer(two, readings.select("station", "v"), "station"))
    assert joined.count("Join ") <= 4  # one for each link
    assert "BroadcastNestedLoopJoin" not in plan(not_in(readings, "station", readings, "station"))


def test_bank_sorts_twice_a_pass_and_sums_slices_of_the_given_rows(spark, readings):
    """No pass is repeated under the sums of whole slices, and the running aggregates of all roles share a sort."""
    frames = [Frame(f"{f}|{i}", f, "v", i) for i in ("1 hour", "1 day", "1 month") for f in ("avg", "max")]
    bank = forward_frames(readings, frames, "ts", ["station"])
    plan = bank._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2  # rows under their roles, once a pass
    assert plan.count("Window [") == 5  # closing states and heads of two passes, and the sums of days


def test_round2_equals_the_decimal_rule_and_spares_decimals(spark):
    odd = [0.0, -0.0, -0.004, 1.005, 2.675, -1.125, 0.0049995, 9999999.995, 1e7, -3e31, 1e32, 1e300, float("inf"), float("nan"), None]
    odd += [(n + 0.5) / 100 + d for n in range(-3000, 3000, 7) for d in (-1.1e-6, -6e-7, -4e-7, 0.0, 4e-7, 6e-7, 1.1e-6)]
    values = spark.createDataFrame([(v,) for v in odd], "x double")
    decimals = F.expr("coalesce(CAST(round(TRY_CAST(x AS DECIMAL(38, 6)), 2) AS DOUBLE), x)")
    assert values.where(~round2("x").eqNullSafe(decimals)).isEmpty()
    assert round2("x")._jc.toString().startswith("CASE WHEN")


def test_mark_reaches_the_scan(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(readings, path)
    stored = tables.read(spark, path)
    plan = incremental.past_mark(stored, stored.where("k = 1"), "ts")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,ScalarSubquery" in plan


def test_versions_survive_a_failed_write(spark, tmp_path):
    root = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, x string")
    incremental.delete_insert(old, root, "k")
    incremental.delete_insert(spark.createDataFrame([(2, "new"), (3, "c")], "k int, x string"), root, "k")
    failing = old.withColumn("x", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        incremental.delete_insert(failing, root, "k")
    rows = {(r.k, r.x) for r in tables.read(spark, root).collect()}
    assert rows == {(1, "a"), (2, "new"), (3, "c"), (None, "n")}


def test_raw_load_takes_each_file_once(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    landing.mkdir()
    (landing / "not taken.txt").write_text("x")
    documents.raw_load(spark, str(landing), raw, "*.json")
    assert tables.read(spark, raw).columns == ["filename", "raw_data"] and tables.read(spark, raw).isEmpty()
    runs = (["first one.json"], ["second.json", "[3]{a,b}*.json", "3.json", "100%20?.json"], ["third.json"])
    for names in runs:
        for name in names:
            (landing / name).write_text(f'{{"a":\n "{name}"}}')
        for _ in range(2):
            documents.raw_load(spark, str(landing), raw, "*.json", at_once=3)
    rows = tables.read(spark, raw).collect()
    assert len({r.filename for r in rows}) == 6
    assert sorted(r.raw_data for r in rows) == sorted(f'{{"a":\n "{name}"}}' for names in runs for name in names)


def test_round2_is_decimal_rounding(spark):
    values = spark.range(200_000).select(((F.col("id") - 100_000) / 1000.0).alias("x")).union(
        spark.range(100_000).select(((F.rand(3) - 0.5) * F.pow(F.lit(10.0), F.col("id") % 9)).alias("x"))
    )
    ties = spark.range(200_000).select((F.concat(F.col("id") % 1000, F.lit("."), F.lpad(F.col("id") % 100, 2, "0"), F.lit("49995"))).cast("double").alias("x"))
    values = values.union(ties)
    wanted = F.expr("CAST(round(CAST(x AS DECIMAL(18, 6)), 2) AS DOUBLE)")
    assert values.where(round2("x") != wanted).isEmpty()


def test_stream_takes_whole_documents_once(spark, tmp_path):
    landing, raw, checkpoint = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    landing.mkdir()
    for name in ("a.json", "b.json", "old.json"):
        (landing / name).write_text('{"a":\n 1}')
        if name == "old.json":
            os.utime(landing / name, (1.6e9, 1.6e9))
        for _ in range(2):
            ingest_available(spark, str(landing), raw, checkpoint)
    rows = tables.read(spark, raw).collect()
    assert len(rows) == 3 and {r.raw_data for r in rows} == {'{"a":\n 1}'}


def test_folders_are_listed_in_few_tasks(spark, tmp_path):
    """Each task of a listing answers the driver; there are no more of them than a few a core, and the setting is put back."""
    landing, key = tmp_path / "landing", "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    for i in range(120):
        (landing / f"d={i}").mkdir(parents=True)
        (landing / f"d={i}" / "a.json").write_text("{}")
    before = spark.conf.get(key)
    tracker = spark.sparkContext.statusTracker()
    earlier = max(tracker.getJobIdsForGroup(), default=-1)
    assert documents.list_files(spark, str(landing)).count() == documents.scan_documents(spark, str(landing)).count() == 120
    ingest_available(spark, str(landing), str(tmp_path / "raw"), str(tmp_path / "checkpoint"))
    assert tables.read(spark, str(tmp_path / "raw")).count() == 120
    jobs = [j for j in tracker.getJobIdsForGroup() if j > earlier]
    stages = [tracker.getStageInfo(s) for j in jobs for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(key) == before


def test_frames_start_no_job_and_agree_for_every_base(spark):
    """Wall clock of a zoned column, also where the clock goes back."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.sql("SELECT 1 AS station, timestamp_seconds(1699075800 + 4500 * id + 31536000 - 86400 * 2 + 86400) AS ts, 1.0D AS v FROM range(2)")
        spark.sparkContext.setJobGroup("frames", "building")
        built = [forward_frames(rows, [Frame("s", "sum", "v", "1 hour")], "ts", ["station"], base) for base in ("day", "hour", "minute")]
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("frames")
        assert len({str(sorted(r.s for r in b.collect())) for b in built}) == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_mode_with_nan_null_and_ties(spark):
    at = lambda h: dt.datetime(2024, 1, 5, h)
    nan = float("nan")
    given = [(at(0), nan), (at(0), nan), (at(2), 1.0), (at(2), 1.0), (at(2), nan), (at(3), None), (at(4), 2.0), (at(4), nan)]
    rows = spark.createDataFrame(given, "ts timestamp_ntz, v double")
    found = {r.ts.hour: r.m for r in forward_mode(rows, "v", "ts", "1 hour", "m").collect()}
    assert str(found[0]) == "nan" and found[2] == 1.0 and found[3] == 2.0 and found[4] == 2.0


def test_target_without_marker_and_stream_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "k int, ts timestamp_ntz")
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    incremental.append_past_mark(rows, path, "ts")
    assert spark.read.parquet(path).count() == 1
    (tmp_path / "t" / "_spark_metadata").mkdir()
    with pytest.raises(ValueError, match="stream"):
        tables.read(spark, path)


def test_failing_refresh_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1,), (2,)], "k int")
    incremental.full_refresh(old, path)
    with pytest.raises(Exception, match="lost"):
        incremental.full_refresh(old.select(F.raise_error(F.lit("lost")).cast("int").alias("k")), path)
    assert sorted(r.k for r in tables.read(spark, path).collect()) == [1, 2]


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental.delete_insert(spark.range(1000).selectExpr("id AS k", "0 AS x"), path, "k")
    before = {f["path"] for f in tables.state(spark, path)["folders"]}
    incremental.delete_insert(spark.createDataFrame([(5, 1), (6, 1), (None, 2)], "k bigint, x int"), path, "k")
    after = tables.state(spark, path)["folders"]
    assert len({f["path"] for f in after} - before) <= 3 and len(after) <= 65
    rows = {(r.k, r.x) for r in tables.read(spark, path).collect()}
    assert rows == {(k, int(k in (5, 6))) for k in range(1000)} | {(None, 2)}
    incremental.delete_insert(spark.createDataFrame([], "k bigint, x int"), path, "k")
    assert tables.read(spark, path).count() == 1001


def test_replaced_then_bucketed_then_appended(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    tables.append(rows, path)
    tables.overwrite(tables.read(spark, path).unionByName(rows.selectExpr("k + 2 AS k", "x")), path)  # reads what it replaces
    incremental.delete_insert(spark.createDataFrame([(3, "c")], "k int, x string"), path, "k")
    tables.append(spark.createDataFrame([(3, "again")], "k int, x string"), path)
    incremental.delete_insert(spark.createDataFrame([(1, "z")], "k int, x string"), path, "k")
    assert sorted((r.k, r.x) for r in tables.read(spark, path).collect()) == [(1, "z"), (2, "b"), (3, "again"), (3, "c"), (4, "b")]


@pytest.mark.parametrize("change", ["overwrite", "append", "replace_keys"])
def test_a_job_that_dies_at_any_call_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, change):
    """Stops before each call that writes, renames or deletes, one run after another."""
    old, new = [spark.createDataFrame(rows, "k int, x string") for rows in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")])]
    wanted = {"overwrite": [(2, "c"), (3, "d")], "append": [(1, "a"), (2, "b"), (2, "c"), (3, "d")], "replace_keys": [(1, "a"), (2, "c"), (3, "d")]}
    args = (new, "k") if change == "replace_keys" else (new,)
    contents = lambda path: sorted((r.k, r.x) for r in tables.read(spark, path).collect())
    real, seen = tables.filesystem, []
    for allowed in range(40):
        path = str(tmp_path / f"t{allowed}")
        tables.overwrite(old, path)
        calls = iter(range(allowed))

        class Failing:
            def __init__(self, fs):
                self.fs = fs

            def __getattr__(self, name):
                if name in ("create", "rename", "delete"):
                    next(calls)  # StopIteration is the end of the job
                return getattr(self.fs, name)

        monkeypatch.setattr(tables, "filesystem", lambda s, p: (Failing(real(s, p)[0]), real(s, p)[1]))
        try:
            getattr(tables, change)(args[0], path, *args[1:])
            done = True
        except StopIteration:
            done = False
        monkeypatch.setattr(tables, "filesystem", real)
        seen.append(contents(path))
        assert seen[-1] in ([(1, "a"), (2, "b")], wanted[change])
        if done:
            break
        getattr(tables, change)(args[0], path, *args[1:])  # the next run carries on
    assert done and seen[0] == [(1, "a"), (2, "b")] and seen[-1] == wanted[change] and len(seen) > 2


def test_second_writer_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1,)], "k int")
    tables.overwrite(rows, path)
    now = tables.state(spark, path)
    tables.append(rows, path)
    with pytest.raises(RuntimeError, match="another writer"):
        tables.commit(spark, path, {**now, "number": now["number"] + 1}, now)


def test_repeated_batch_adds_nothing_and_batches_read_their_own_names(spark, tmp_path):
    raw = str(tmp_path / "raw")
    batch = lambda *names: spark.createDataFrame([(n, "{}") for n in names], "filename string, raw_data string")
    ingest.take(batch("2024-01-01/a", "2024-01-01/b"), 0, raw, "s")
    ingest.take(batch("2024-01-02/a"), 1, raw, "s")
    ingest.take(batch("2024-01-02/a"), 1, raw, "s")
    ingest.take(batch("2024-01-02/a", "2024-01-03/a"), 0, raw, "other")
    assert sorted(r.filename for r in tables.read(spark, raw).collect()) == ["2024-01-01/a", "2024-01-01/b", "2024-01-02/a", "2024-01-03/a"]
    near = tables.read_between(spark, raw, "filename", "2024-01-02/a", "2024-01-02/z")
    assert len({f.rsplit("/", 1)[0] for f in near.inputFiles()}) == 1 and near.count() == 1


def test_raw_load_scans_new_folders_whole_and_skips_closed_ones(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")

    def put(*names):
        for name in names:
            (landing / name).parent.mkdir(parents=True, exist_ok=True)
            (landing / name).write_text(name)

    def loaded():
        rows = [r.raw_data for r in tables.read(spark, raw).collect()]
        assert len(rows) == len(set(rows))
        return set(rows)

    put("d1/a.json", "d1/b.json", "d2/a.json", "d2/sub/c.json", "d2/no.txt")
    documents.raw_load(spark, str(landing), raw, "*.json")
    assert loaded() == {"d1/a.json", "d1/b.json", "d2/a.json", "d2/sub/c.json"}
    put("d2/sub/d.json", "d3/a.json", "d3/sub/x/y.json", "d1/late.json", "top.json", "d4/sub/z.json")
    documents.raw_load(spark, str(landing), raw, "*.json", since="d2")
    assert "d1/late.json" not in loaded() and "top.json" in loaded() and len(loaded()) == 9
    put("d4/a.json")
    documents.raw_load(spark, str(landing), raw, "*.json")
    assert loaded() >= {"d1/late.json", "d4/a.json"} and len(loaded()) == 11
    documents.raw_load(spark, str(landing), raw, "*.json")
    assert len(loaded()) == 11


def test_best_cover_against_brute_force():
    rng = np.random.default_rng(4)
    for places in (1, 2, 7, 64, 100):
        low = rng.integers(0, places, 60)
        high = np.minimum(low + rng.integers(1, places + 1, 60), places)
        rank = rng.integers(0, 1000, 60)
        wanted = [max([int(r) for a, b, r in zip(low, high, rank) if a <= p < b], default=-1) for p in range(places)]
        assert mode.best_cover(low, high, rank, places).tolist() == wanted
    assert mode.best_cover(*[np.zeros(0, "i8")] * 3, 3).tolist() == [-1] * 3


@pytest.mark.parametrize("stretch", [1, 50, 1 << 17])
def test_mode_in_stretches_against_brute_force(spark, monkeypatch, stretch):
    """One key holds most rows, many of them at one instant; stretches end inside slices."""
    pick = random.Random(6)
    base = dt.datetime(2024, 1, 5)
    given = [("a", base + dt.timedelta(seconds=pick.choice([0, 0, pick.randrange(20000)])), pick.choice([None, float("nan"), *map(float, range(6))])) for _ in range(400)]
    given += [(None, base + dt.timedelta(minutes=i), float(i % 3)) for i in range(50)] + [("b", None, 1.0), ("b", base, None)]
    rows = spark.createDataFrame(given, "k string, ts timestamp_ntz, v double")
    # the function is shipped to workers, so the length of a stretch travels with it
    sweep = mode._sweep

    def short(group):
        inner = sweep(group)

        def answers(batches):
            from gaugeworks.operators import mode as here

            here.STRETCH = stretch
            yield from inner(part.iloc[i : i + 7] for part in batches for i in range(0, len(part), 7))

        return answers

    monkeypatch.setattr(mode, "_sweep", short)
    found = [tuple(r) for r in forward_mode(rows, "v", "ts", "1 hour", "m", ["k"]).collect()]

    def wanted(k, ts):
        counts = {}
        for k2, t2, v in given:
            if k2 == k and v is not None and (t2 == ts if ts is None or t2 is None else ts <= t2 <= ts + dt.timedelta(hours=1)):
                key = (True, 0.0) if v != v else (False, v)
                counts[key] = counts.get(key, 0) + 1
        best = min(counts, key=lambda key: (-counts[key], key), default=None)
        return None if best is None else "nan" if best[0] else best[1]

    assert len(found) == len(given)
    for k, ts, _, m in found:
        assert (str(m) if m is not None and m != m else m) == wanted(k, ts)
