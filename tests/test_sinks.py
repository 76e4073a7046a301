import datetime
import os

import pytest
from fixtures import make_catalog, make_report, report_row
from pyspark.sql import functions as F

from tilewright import PlanParams, TableSpec, analyze, build_catalog
from tilewright.operators import assign_slices, column_stats, range_boundaries
from tilewright.plans import (
    analyze_databases, dump_result, load_rules, profile_tables, read_report, read_rules, read_slice, sinks,
    update_report, write_report, write_rules, write_slices,
)
from tilewright.session import local_frame
from tilewright.sources.catalog import UNBOUNDED


def test_report_is_replaced(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(make_report(spark, report_row(1, "old", 1)), path=path)
    write_report(make_report(spark, report_row(1, "new", 1)), path=path)
    assert [r.TableName for r in spark.read.parquet(path).collect()] == ["new"]
    spark.sql("DROP TABLE IF EXISTS load_report")
    for name in ("old", "new"):
        write_report(make_report(spark, report_row(1, name, 1)), table="load_report")
    assert [r.TableName for r in spark.table("load_report").collect()] == ["new"]


def test_rules_as_text_and_json(spark, tmp_path):
    report = make_report(spark, report_row(1, "b", 5), report_row(2, "a", 5), report_row(3, "p", 5, parts=2))
    c = make_catalog(spark, tables=[(1, 1, "a", 0)])
    rules = load_rules(report, c, {})
    write_rules(rules, str(tmp_path / "text"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "text")).collect()]
    wanted = [r.rule_json for r in rules.orderBy("case_id", "rn").collect()]
    assert sorted(lines) == sorted(wanted) and len(lines) == 3
    write_rules(rules, str(tmp_path / "json"), as_json=True)
    assert spark.read.json(str(tmp_path / "json")).where("case_id = 3").first().TableName == "p"


def test_dump(spark, tmp_path):
    now = datetime.datetime(2024, 5, 6, 7, 8, 9)
    report = make_report(spark, report_row(1, "a", 5))
    path = dump_result(report, str(tmp_path), "shop", now)
    assert os.path.basename(path) == "shop-2024-05-06T070809"
    assert spark.read.json(path).first().TableName == "a"
    assert dump_result(report.where("ID > 1"), str(tmp_path), "none", now) is None
    assert os.listdir(tmp_path) == [os.path.basename(path)]


def test_slices(spark, tmp_path):
    df = spark.range(100).select(F.col("id").alias("k"))
    path = str(tmp_path / "slices")
    write_slices(assign_slices(df, "k", range_boundaries(df, "k", 4)), path)
    counts = spark.read.parquet(path).groupBy("slice").count().collect()
    assert sorted(tuple(r) for r in counts) == [(i, 25) for i in range(1, 5)]


def test_analyze(spark):
    frames = {
        "notes": local_frame(spark, [(i, "x" * (i * 100)) for i in range(30)], "id int, body string"),
        "big": spark.range(50).select(F.col("id").alias("k")),
        "load_report": local_frame(spark, [(1,)], "id int"),
    }
    specs = {"notes": TableSpec(key=["id"], lengths={"body": UNBOUNDED}), "big": TableSpec(key=["k"])}
    c = build_catalog(spark, frames, specs)
    tables = {f"main.{t}": df for t, df in frames.items()}
    done = analyze(spark, c, tables, PlanParams(row_limit=40, lob_limit_kb=1))
    assert [r.TableName for r in done.final.collect()] == ["big", "notes"]
    assert {(r.case_id, r.TableName) for r in done.rules.collect()} == {
        (1, "load_report"), (2, "big"), (4, "notes"), (6, "notes"),
    }
    # Reading the result does not scan the user tables again.
    plan = done.final._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 2


def test_one_database_fails(spark, tmp_path):
    def shop():
        frames = {"t": local_frame(spark, [(1,)], "id int")}
        return build_catalog(spark, frames), {f"main.{t}": df for t, df in frames.items()}

    def closed():
        raise ConnectionError("closed")

    def empty():
        return make_catalog(spark), {}

    outcome = analyze_databases(spark, {"closed": closed, "shop": shop, "empty": empty}, str(tmp_path))
    assert isinstance(outcome["closed"], ConnectionError) and outcome["empty"] is None
    assert spark.read.json(outcome["shop"]).first().TableName == "t"


def test_two_byte_types(spark):
    frames = {"t": local_frame(spark, [("x" * 700, "x" * 700)], "narrow string, wide string")}
    unbounded = {"narrow": UNBOUNDED, "wide": UNBOUNDED}
    specs = {"t": TableSpec(lengths=unbounded, type_names={"wide": "nvarchar"})}
    profile = profile_tables(spark, build_catalog(spark, frames, specs), {"main.t": frames["t"]})
    assert {r.LOBColName: r.CountLess1KAndNulls for r in profile.collect()} == {"narrow": 1, "wide": 0}


def test_slice_files_do_not_multiply(spark, tmp_path):
    """Few files a slice however many tasks read the table."""
    path = str(tmp_path / "slices")
    df = spark.range(4_000, numPartitions=40).select(F.col("id").alias("k"))
    write_slices(assign_slices(df, "k", range_boundaries(df, "k", 4)), path)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert 4 <= len(files) <= 8


def test_exact_statistics_shuffle_no_values(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(0.0, "long " * 99, [1, None]), (-0.0, "long " * 99, [1]), (None, None, None), (2.0, "", [None])]
    local_frame(spark, rows, "x double, body string, items array<int>").write.parquet(path)
    stats = column_stats(spark.read.parquet(path), "t", exact_distinct=True)
    assert "Expand" not in stats._jdf.queryExecution().executedPlan().toString()
    assert {r.column_name: (r.null_count, r.distinct_count) for r in stats.collect()} == {
        "x": (1, 2), "body": (1, 2), "items": (1, 3),
    }


def failing(report):
    """A report whose second partition fails while the first is being written."""
    bad = F.when(F.col("ID") > 1, F.raise_error(F.lit("lost"))).otherwise(F.col("TableName"))
    return report.repartitionByRange(2, "ID").withColumn("TableName", bad)


def test_failed_write_leaves_the_old_report(spark, tmp_path):
    path, old = str(tmp_path / "report"), make_report(spark, report_row(1, "old", 1))
    new = make_report(spark, report_row(1, "new", 1), report_row(2, "new", 1))
    spark.sql("DROP TABLE IF EXISTS kept_report")
    write_report(old, path=path)
    write_report(old, table="kept_report")
    for target in ({"path": path}, {"table": "kept_report"}):
        with pytest.raises(Exception, match="lost"):
            write_report(failing(new), **target)
    assert [r.TableName for r in read_report(spark, path).collect()] == ["old"]
    assert [r.TableName for r in spark.table("kept_report").collect()] == ["old"]
    assert os.listdir(tmp_path) == ["report"]


def test_incomplete_write_is_noticed(spark, tmp_path, monkeypatch):
    path, report = str(tmp_path / "report"), make_report(spark, report_row(1, "old", 1))
    write_report(report, path=path)
    real = sinks.write_counted
    monkeypatch.setattr(sinks, "write_counted", lambda *a, **k: real(*a, **k) + 1)
    with pytest.raises(OSError, match="1 of 2 report rows"):
        write_report(make_report(spark, report_row(1, "new", 1)), path=path)
    assert [r.TableName for r in read_report(spark, path).collect()] == ["old"]


def test_failed_swap_brings_the_old_report_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "report")
    write_report(make_report(spark, report_row(1, "old", 1)), path=path)
    real = sinks.Folder.rename

    def rename(self, target):
        if ".staged-" in self.path:
            raise OSError("no rename")
        real(self, target)

    monkeypatch.setattr(sinks.Folder, "rename", rename)
    with pytest.raises(OSError, match="no rename"):
        write_report(make_report(spark, report_row(1, "new", 1)), path=path)
    assert [r.TableName for r in read_report(spark, path).collect()] == ["old"]


def test_readers_keep_what_they_began(spark):
    """A table that is replaced still serves a reader that has planned on the old files."""
    spark.sql("DROP TABLE IF EXISTS read_report")
    write_report(make_report(spark, report_row(1, "old", 1)), table="read_report")
    reader = spark.table("read_report")
    reader._jdf.queryExecution().executedPlan()
    write_report(make_report(spark, report_row(1, "new", 1)), table="read_report")
    assert [r.TableName for r in reader.collect()] == ["old"]
    assert [r.TableName for r in spark.table("read_report").collect()] == ["new"]
    write_report(make_report(spark, report_row(3, "other", 1)).withColumn("more", F.lit(1)), table="read_report")
    assert spark.table("read_report").first().more == 1
    write_report(make_report(spark, report_row(5, "parts", 1)), table="read_report", parts=3)
    assert spark.table("read_report").first().report_part == 2


RULES = "ID int, case_id int, rule_json string"


def stored_in_parts(spark, path, count=40):
    rows = [report_row(i, f"t{i}", 5) for i in range(1, count + 1)]
    write_report(make_report(spark, *rows), path=path, parts=8)


def states(spark, path):
    return {r.ID: (r.TableName, r.Type is not None, r.Table_JSON) for r in read_report(spark, path).collect()}


def test_only_changed_parts_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "report")
    stored_in_parts(spark, path)
    before = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    rules = local_frame(spark, [(3, 1, "r3"), (11, 1, "r11"), (4, 3, "r4")], RULES)
    assert update_report(spark, path, rules) == [3, 4]
    after = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    assert len(before.items() & after.items()) == 6
    found = states(spark, path)
    assert len(found) == 40 and {i for i, s in found.items() if s[1]} == {3, 4, 11} and found[11][2] == "r11"
    assert update_report(spark, path, rules) == []
    assert not os.path.exists(path + ".update")


@pytest.mark.parametrize("complete", [True, False])
def test_interrupted_update_is_put_through(spark, tmp_path, monkeypatch, complete):
    """It stopped when the new rows were complete, or while they were being written, with old parts gone."""
    path = str(tmp_path / "report")
    stored_in_parts(spark, path)
    rules = local_frame(spark, [(i, 1, f"r{i}") for i in range(1, 41)], RULES)
    with monkeypatch.context() as m:
        m.setattr(sinks, "_replace_parts", lambda *_: (_ for _ in ()).throw(ConnectionError("lost")))
        with pytest.raises(ConnectionError):
            update_report(spark, path, rules)
    if complete:
        for part in (2, 5):  # the replacement had deleted these
            for name in os.listdir(f"{path}/report_part={part}"):
                os.remove(f"{path}/report_part={part}/{name}")
    else:
        os.remove(f"{path}.update/_SUCCESS")
    update_report(spark, path, rules)
    found = states(spark, path)
    assert len(found) == 40 and all(s == (f"t{i}", True, f"r{i}") for i, s in found.items())
    assert not os.path.exists(path + ".update")


def jobs_of(spark, run):
    spark.sparkContext.setJobGroup("counted", "")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    result = run()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, jobs


def test_dump_runs_once(spark, tmp_path):
    """One job, with rows or without, and none that looks for rows first."""
    some = spark.range(1000).withColumn("twice", F.col("id") * 2)
    path, jobs = jobs_of(spark, lambda: dump_result(some, str(tmp_path), "some"))
    assert jobs == 1 and spark.read.json(path).count() == 1000
    path, jobs = jobs_of(spark, lambda: dump_result(some.where(F.rand() > 1), str(tmp_path), "none"))
    assert path is None and jobs == 1 and len(os.listdir(tmp_path)) == 1
    assert dump_result(some.limit(0), str(tmp_path), "known") is None


def test_rules_keep_their_order_over_files(spark, tmp_path):
    rows = [(c, n, None if n % 7 == 0 else f"{c}-{n:04}" + "x" * 50) for n in range(400) for c in (3, 1, 2)]
    rules = local_frame(spark, rows, "case_id int, rn int, rule_json string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        write_rules(rules, str(tmp_path / "text"))
        lines = read_rules(spark, str(tmp_path / "text")).orderBy("line").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len([f for f in os.listdir(tmp_path / "text") if f.startswith("part")]) > 2
    wanted = [j for _, _, j in sorted(rows, key=lambda r: r[:2]) if j]
    assert [r.rule_json for r in lines] == wanted and [r.line for r in lines] == list(range(1, len(wanted) + 1))


def test_one_slice_is_one_folder(spark, tmp_path):
    path = str(tmp_path / "slices")
    df = spark.range(1000).select(F.col("id").alias("k"))
    write_slices(assign_slices(df, "k", range_boundaries(df, "k", 5)), path)
    one = read_slice(spark, path, 2)
    plan = one._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(slice" in plan.toString()
    assert one.agg(F.min("k"), F.max("k"), F.count("k")).first() == (200, 399, 200)
    files = {f.split("slice=")[1][0] for f in one.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert files == {"2"}


def test_hot_slice_is_split_into_files(spark, tmp_path):
    path, setting = str(tmp_path / "slices"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    hot = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("v")
    )
    spark.conf.set(setting, "300k")
    try:
        write_slices(assign_slices(hot, "k", range_boundaries(hot, "k", 10)), path)
    finally:
        spark.conf.unset(setting)
    sizes = {d.split("slice=")[1]: [os.path.getsize(os.path.join(d, f)) for f in fs if f.endswith(".parquet")]
             for d, _, fs in os.walk(path) if "slice=" in d}
    largest = max(sizes.values(), key=sum)
    assert len(largest) > 4 and max(largest) < sum(largest) / 3
