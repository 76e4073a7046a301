"""Where results go: the report table, the rule list, result dumps and load slices."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, Window as W, functions as F

from tilewright.functions.columns import quoted
from tilewright.plans.rules import apply_rules
from tilewright.session import Folder, shared_folder

REPORT_PART = "report_part"  # the column that a report written in parts is partitioned by


def write_counted(df: DataFrame, path: str, kind: str = "parquet", partition_by: str | None = None) -> int:
    """Write to a folder that must not exist; returns the rows, as the write itself counted them."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(kind)
    (writer.partitionBy(partition_by) if partition_by else writer).save(path)
    return seen.get.get("rows", 0)  # a plan that is known to be empty counts nothing


def write_report(
    report: DataFrame, table: str | None = None, path: str | None = None, parts: int | None = None
) -> None:
    """Replace the stored report, as a table of the session catalog or as Parquet files.

    The new report is written aside and counted again before it takes the old one's place, so
    readers see one or the other whole, and a write that fails leaves the old one as it was. A
    table is pointed at the new files, in one step of the catalog unless its columns change;
    the old files go when the session ends. A folder is renamed. With ``parts`` the report is
    divided by id into so many partitions, which ``update_report`` can rewrite one by one.
    """
    spark = report.sparkSession
    if parts:
        report = report.withColumn(REPORT_PART, F.pmod("ID", F.lit(parts)))
    place = path.rstrip("/") if path else f"{shared_folder(spark).rstrip('/')}/{table}"
    staged = Folder(spark, f"{place}.staged-{uuid.uuid4().hex}")
    try:
        rows = write_counted(report, staged.path, partition_by=REPORT_PART if parts else None)
        held = spark.read.schema(report.schema).parquet(staged.path).count()
        if held != rows:
            raise OSError(f"{held} of {rows} report rows are in {staged.path}")
    except Exception:
        staged.delete()
        raise
    if table:
        _point_table(spark, table, report, staged, parts is not None)
    else:
        _swap(staged, Folder(spark, place))


def _swap(staged: Folder, target: Folder) -> None:
    old = Folder(target.spark, f"{target.path}.old-{uuid.uuid4().hex}") if target.exists() else None
    if old:
        target.rename(old.path)
    try:
        staged.rename(target.path)
    except Exception:
        if old:
            old.rename(target.path)
        raise
    if old:
        old.delete()


def _point_table(spark: SparkSession, table: str, report: DataFrame, files: Folder, parted: bool) -> None:
    name = ".".join(map(quoted, table.split(".")))
    location = files.path.replace("'", "\\'")
    if spark.catalog.tableExists(table):
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
        old = next(r["data_type"] for r in described if r["col_name"] == "Location")
        same = {f.name: f.dataType for f in spark.table(name).schema} == {f.name: f.dataType for f in report.schema}
        if same:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
            Folder(spark, old).delete_on_exit()
        else:
            spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in report.schema)
        by = f" PARTITIONED BY ({REPORT_PART})" if parted else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION '{location}'")
    if parted:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(table)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A report from its folder, whether it was written in parts or not."""
    return spark.read.parquet(path).drop(REPORT_PART)


def update_report(spark: SparkSession, path: str, rules: DataFrame) -> list[int]:
    """Write rule text and case label to the stored report; returns the parts that were rewritten.

    The report must have been written in parts. Only parts with a row that changes are
    rewritten. Their new rows are complete in a folder beside the report before any old part
    is replaced, and the next call puts an interrupted replacement through before anything
    else, so it may fail at any point and be run again.
    """
    path = path.rstrip("/")
    staged = Folder(spark, f"{path}.update")
    if staged.exists():
        if Folder(spark, f"{staged.path}/_SUCCESS").exists():
            _replace_parts(spark, staged, path)
        else:
            staged.delete()
    stored = spark.read.parquet(path)
    kept = {f"_{c}": F.col(c) for c in ("Type", "Table_JSON")}
    updated = apply_rules(stored.withColumns(kept), rules)
    same = F.col("Type").eqNullSafe(F.col("_Type")) & F.col("Table_JSON").eqNullSafe(F.col("_Table_JSON"))
    parts = sorted(r[0] for r in updated.where(~same).select(REPORT_PART).distinct().collect())
    if parts:
        changed = updated.where(F.col(REPORT_PART).isin(parts)).select(*stored.columns)
        changed.write.partitionBy(REPORT_PART).parquet(staged.path)
        _replace_parts(spark, staged, path)
    return parts


def _replace_parts(spark: SparkSession, staged: Folder, path: str) -> None:
    writer = spark.read.parquet(staged.path).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(REPORT_PART).parquet(path)
    staged.delete()


def write_rules(rules: DataFrame, path: str, as_json: bool = False) -> None:
    """The rules as text, one rule or pair per line in case and number order, or as JSON rows.

    Files are in order as well as the lines in them: tasks take ranges of the order, and the
    rules of a pair are one line.
    """
    order = ["case_id", "rn"]
    ordered = rules.where(F.lit(as_json) | F.col("rule_json").isNotNull())
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order)
    if as_json:
        ordered.write.mode("overwrite").json(path)
    else:
        ordered.select("rule_json").write.mode("overwrite").text(path)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a rule list with their numbers from 1, over all files in order: line, rule_json."""
    lines = spark.read.text(path).select(
        F.col("value").alias("rule_json"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),  # ascending within a block
    )
    number = F.row_number().over(W.orderBy("file", "block", "row"))
    return lines.select(number.alias("line"), "rule_json")


def dump_result(
    result: DataFrame, folder: str, name: str, now: datetime | None = None
) -> str | None:
    """Write result rows as JSON lines to a time-stamped folder; nothing if there are none.

    The plan runs once: the write counts its rows, and a folder without any goes again. It has a
    name that readers pass over until then.
    """
    stamp = (now or datetime.now()).strftime("%Y-%m-%dT%H%M%S")
    folder = folder.rstrip("/")
    staged = Folder(result.sparkSession, f"{folder}/_{name}-{stamp}-{uuid.uuid4().hex}")
    if write_counted(result, staged.path, "json") == 0:
        staged.delete()
        return None
    path = f"{folder}/{name}-{stamp}"
    staged.rename(path)
    return path


def write_slices(sliced: DataFrame, path: str) -> None:
    """One folder per slice, in files of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.

    Rows are clustered by slice first, so that a task writes few files; adaptive execution
    splits a slice that is too large for one task, as with a hot key, and joins small ones.
    """
    sliced.hint("rebalance", F.col("slice")).write.mode("overwrite").partitionBy("slice").parquet(path)


def read_slice(spark: SparkSession, path: str, slice_number: int) -> DataFrame:
    """The rows of one slice; the scan lists its folder only."""
    return spark.read.parquet(path).where(F.col("slice") == slice_number)
