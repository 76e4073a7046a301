"""The registered queries: every operator on the given tables.

Names of databases and schemas, the loaded copies that are compared, and the
catalog are all derived by Spark from those tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.functions import byte_length, size_class, tile_count
from tilewright.operators import (
    assign_slices,
    column_stats,
    compare_buckets,
    compare_rows,
    compare_tables,
    dedup_profile,
    distinct_counts,
    final_report,
    leading_key_column,
    lob_columns,
    lob_split,
    name_search,
    partition_info,
    range_boundaries,
    rollup_by_table,
    sequence_positions,
    slice_balance,
    table_report,
    user_databases,
    user_pg_databases,
    user_schemas,
)
from tilewright.operators.lob import lob_profiles
from tilewright.params import PlanParams
from tilewright.plans import (
    apply_rules,
    analyze,
    case1_plain,
    case2_ranges,
    case3_partitions,
    case4_lob_ranges,
    case5_lob_partitions,
    case6_lob_plain,
    dump_result,
    load_rules,
    profile_tables,
    read_report,
    read_rules,
    read_slice,
    update_report,
    write_report,
    write_rules,
    write_slices,
)
from tilewright.operators.report import REPORT
from tilewright.session import local_frame, materialize, scratch, union_all
from tilewright.sources import Catalog, TableSpec, build_catalog
from tilewright.sources.catalog import UNBOUNDED, session_catalog, session_databases

TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem "
    "nation orders pages part region supplier"
).split()

KEYS = {
    "benchmark": "item_id",
    "conversations": "conv_id",
    "customer": "c_custkey",
    "documents": "doc_id",
    "embeddings": "vec_id",
    "events": "event_id",
    "lineitem": "l_orderkey",
    "nation": "n_nationkey",
    "orders": "o_orderkey",
    "pages": "page_id",
    "part": "p_partkey",
    "region": "r_regionkey",
    "supplier": "s_suppkey",
}
UNBOUNDED_COLUMNS = {
    "benchmark": ["text"],
    "conversations": ["text"],
    "documents": ["text"],
    "events": ["props"],
    "pages": ["url", "html"],
}

# Limits at which the test tables reach all six cases.
FEW_ROWS = PlanParams(row_limit=10_000, lob_limit_kb=4)
FEWER_ROWS = PlanParams(row_limit=100, lob_limit_kb=4)

SCHEMA = "main"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(
    spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES
) -> dict[str, DataFrame]:
    names = list(names)
    with ThreadPoolExecutor(8) as pool:  # file schemas are read at the same time
        return dict(zip(names, pool.map(lambda name: table(spark, sf_dir, name), names)))


def by_full_name(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {f"{SCHEMA}.{t}": df for t, df in frames.items()}


def specs(frames: dict[str, DataFrame]) -> dict[str, TableSpec]:
    """Keys, partitions and declared string lengths of the test tables."""
    parted = {"events": F.to_date("ts"), "documents": F.col("lang")}
    found = {}
    for t, df in frames.items():
        lengths = {}
        for name, dtype in df.dtypes:
            if dtype == "string":
                lengths[name] = UNBOUNDED if name in UNBOUNDED_COLUMNS.get(t, ()) else 64
        if t == "documents":
            lengths["source"] = 16
        found[t] = TableSpec(
            key=(KEYS[t],) if t in KEYS else (),
            partition_by=parted.get(t),
            lengths=lengths,
            type_names={"source": "text"} if t == "documents" else {},
        )
    return found


def catalog_of(spark: SparkSession, frames: dict[str, DataFrame]) -> Catalog:
    """The test tables' catalog, with entries that every report has to leave out."""
    real = build_catalog(spark, frames, specs(frames), schema=SCHEMA)
    lineitem_id = 1001 + TABLES.index("lineitem")

    def plus(df: DataFrame, *rows: tuple) -> DataFrame:
        return df.unionByName(local_frame(spark, rows, df.schema))

    return Catalog(
        columns=real.columns,
        tables=plus(real.tables, (200, 1, "system_object", 0), (901, 1, "dtproperties", 0), (902, 1, "shipped", 1)),
        schemas=real.schemas,
        types=real.types,
        indexes=plus(real.indexes, (200, 1, 1), (901, 1, 1), (902, 1, 1), (lineitem_id, 2, 0)),
        partitions=plus(
            real.partitions, (200, 1, 1, 10), (901, 1, 1, 10), (902, 1, 1, 10), (lineitem_id, 2, 1, 10)
        ),
        index_columns=real.index_columns,
    )


class Bed:
    """Tables, catalog and report of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: PlanParams = FEW_ROWS):
        self.spark, self.params = spark, params
        self.frames = load(spark, sf_dir)
        self.tables = by_full_name(self.frames)
        self.catalog = catalog_of(spark, self.frames)

    def report(self) -> DataFrame:
        profile = profile_tables(self.spark, self.catalog, self.tables)
        return table_report(self.catalog, profile)

    def stored_report(self) -> DataFrame:
        return materialize(self.report(), "report")


def q_lob_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = load(spark, sf_dir)
    c = build_catalog(spark, frames, specs(frames), schema=SCHEMA)
    return lob_columns(c.columns, c.tables, c.schemas, c.types)


def q_lob_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    bed = Bed(spark, sf_dir)
    return profile_tables(spark, bed.catalog, bed.tables)


def q_lob_profile_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = load(spark, sf_dir)
    c = build_catalog(spark, frames, specs(frames), schema=SCHEMA)
    found = lob_columns(c.columns, c.tables, c.schemas, c.types).collect()
    lobs = [(r.object_id, r.schema, r.table, r.column) for r in found] * 2
    return dedup_profile(lob_profiles(spark, lobs, by_full_name(frames)))


def q_partition_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Bed(spark, sf_dir).catalog
    return partition_info(c.tables, c.indexes, c.partitions)


def q_size_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Bed(spark, sf_dir).catalog
    return partition_info(c.tables, c.indexes, c.partitions).select(
        "object_id", "rows", size_class(F.col("rows")).alias("TableSize")
    )


def q_tile_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Bed(spark, sf_dir).catalog
    rows = partition_info(c.tables, c.indexes, c.partitions)
    return rows.select(
        "object_id",
        "rows",
        tile_count(F.col("rows"), FEW_ROWS.row_limit).alias("tiles"),
        tile_count(F.col("rows"), FEWER_ROWS.row_limit).alias("tiles_fewer_rows"),
    )


def q_table_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Bed(spark, sf_dir).report()


def q_table_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_by_table(Bed(spark, sf_dir).report())


def q_leading_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = load(spark, sf_dir)
    return leading_key_column(
        build_catalog(spark, frames, specs(frames), schema=SCHEMA, check_keys=True)
    )


def row_case(rule: Callable, params: PlanParams = FEW_ROWS) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rule(Bed(spark, sf_dir).report(), params)


def table_case(rule: Callable, params: PlanParams = FEW_ROWS) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bed = Bed(spark, sf_dir)
        return rule(bed.stored_report(), bed.catalog, bed.tables, params)

    return run


def q_report_with_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    bed = Bed(spark, sf_dir)
    report = bed.stored_report()
    rules = [
        case1_plain(report, FEW_ROWS),
        case3_partitions(report, FEW_ROWS),
        case5_lob_partitions(report, FEW_ROWS),
        case6_lob_plain(report, FEW_ROWS),
    ]
    return apply_rules(report, union_all(rules))


def q_final_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    bed = Bed(spark, sf_dir)
    return analyze(spark, bed.catalog, bed.tables, FEW_ROWS).final


def q_final_report_hidden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As if the report were stored under the name of the largest table."""
    return final_report(Bed(spark, sf_dir).report(), "lineitem")


def q_lob_profile_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as a server with two-byte characters sizes them; Spanish ones with some beyond the basic plane."""
    frames = {t: table(spark, sf_dir, t) for t in ("benchmark", "conversations", "documents")}
    marked = F.when(F.col("lang") == "es", F.concat("text", F.lit("\U0001f600\u20ac\U00010348"))).otherwise(F.col("text"))
    frames["documents"] = frames["documents"].select("doc_id", marked.alias("text"))
    wide = {
        t: TableSpec(key=(KEYS[t],), lengths={"role": 9}, type_names={"text": "ntext" if t == "benchmark" else "nvarchar"})
        for t in frames
    }
    return profile_tables(spark, build_catalog(spark, frames, wide, schema=SCHEMA), by_full_name(frames))


def q_session_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on a database of the session catalog: the given files as tables, one of them partitioned."""
    spark.sql("CREATE DATABASE IF NOT EXISTS tilewright_given")
    spark.catalog.setCurrentDatabase("default")
    for t in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS tilewright_given.{t}")
        if t == "documents":
            place = f"{scratch(spark, t)}/rows"
            table(spark, sf_dir, t).write.partitionBy("lang").option("path", place).saveAsTable(f"tilewright_given.{t}")
        else:
            spark.sql(f"CREATE TABLE tilewright_given.{t} USING parquet LOCATION '{sf_dir}/{t}.parquet'")
    catalog, tables = session_catalog(spark, "tilewright_given", {t: [k] for t, k in KEYS.items()})
    return table_report(catalog, profile_tables(spark, catalog, tables))


def q_session_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Databases of the session catalog, one for each region and market segment, those of the system left out."""
    regions = table(spark, sf_dir, "region").select(F.concat(F.lit("region_"), F.lower("r_name")).alias("name"))
    segments = table(spark, sf_dir, "customer").select(F.concat(F.lit("pg_temp_region_"), F.lower("c_mktsegment")))
    names = regions.union(segments).select(F.replace("name", F.lit(" "), F.lit("_")).alias("name"))
    for r in names.distinct().collect():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{r.name}`")
    return user_schemas(session_databases(spark)).where(F.col("schema_name").contains("region_"))


def q_report_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report replaced by a new one, read back: half of the rows from a table, half from files."""
    report, path = Bed(spark, sf_dir).stored_report(), f"{scratch(spark, 'report')}/current"
    for rows in (report.where("rows > 100"), report):
        write_report(rows, path=path)
        write_report(rows, table="tilewright_report")
    odd = F.col("ID") % 2 == 1
    return read_report(spark, path).where(odd).unionByName(spark.table("tilewright_report").where(~odd))


def q_report_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report stored in parts, to which the rules of two cases and then of two more are written."""
    bed = Bed(spark, sf_dir)
    report, path = bed.stored_report(), f"{scratch(spark, 'report')}/current"
    write_report(report, path=path, parts=4)
    for first, second in ((case1_plain, case3_partitions), (case5_lob_partitions, case6_lob_plain)):
        update_report(spark, path, first(report, FEW_ROWS).unionByName(second(report, FEW_ROWS)))
    return read_report(spark, path)


def q_result_dumped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final report as JSON lines, read back."""
    folder = scratch(spark, "dump")
    return spark.read.schema(REPORT).json(dump_result(q_final_report(spark, sf_dir), folder, "given"))


def q_rules_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules as lines of text, read back with their place."""
    path = f"{scratch(spark, 'rules')}/text"
    write_rules(table_case(load_rules, FEWER_ROWS)(spark, sf_dir), path)
    return read_rules(spark, path)


def q_slices_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written in ten slices; the fourth is read back alone."""
    path = f"{scratch(spark, 'slices')}/lineitem"
    write_slices(sliced(spark, sf_dir, "lineitem", "l_orderkey"), path)
    return read_slice(spark, path, 4).select("l_orderkey", "l_linenumber", "l_quantity", "slice")


def boundaries(name: str, key: str, tiles: int, **limits: int) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return range_boundaries(table(spark, sf_dir, name), key, tiles, **limits)

    return run


def q_range_boundaries_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the keys are null."""
    key = F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")).alias("returned_order")
    return range_boundaries(table(spark, sf_dir, "lineitem").select(key), "returned_order", 9)


def q_user_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One database per customer; some nations hold the server's own."""
    nation = F.col("c_nationkey")
    databases = table(spark, sf_dir, "customer").select(
        F.when(nation == 0, "master")
        .when(nation == 1, "model")
        .when(nation == 2, "msdb")
        .when(nation == 3, "tempdb")
        .otherwise(F.col("c_name"))
        .alias("name"),
        F.when(F.col("c_acctbal") < 0, "OFFLINE").otherwise("ONLINE").alias("state_desc"),
    )
    return user_databases(databases)


def q_user_pg_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One database per order; pending ones are templates, low priority is closed."""
    databases = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("order_"), F.col("o_orderkey")).alias("datname"),
        (F.col("o_orderstatus") == "P").alias("datistemplate"),
        (F.col("o_orderpriority") != "5-LOW").alias("datallowconn"),
    )
    return user_pg_databases(databases)


def q_user_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One schema per document, named after its language or source."""
    doc_id = F.col("doc_id").cast("string")
    schemata = table(spark, sf_dir, "documents").select(
        F.when(F.col("source") == "src0", "pg_catalog")
        .when(F.col("source") == "src1", "information_schema")
        .when(F.col("source") == "src2", F.concat(F.lit("pgXtoast"), doc_id))
        .when(F.col("lang") == "de", F.concat(F.lit("pg_toast_"), doc_id))
        .when(F.col("lang") == "es", F.concat(F.lit("pg_temp_"), doc_id))
        .otherwise(F.concat(F.col("lang"), F.lit("_"), doc_id))
        .alias("schema_name")
    )
    return user_schemas(schemata)


def q_name_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_search(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "RED")


def loaded_orders(orders: DataFrame) -> DataFrame:
    """A faulty copy of ``orders``: rows lost, changed, nulled and added."""
    low, urgent = F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority") == "1-URGENT"
    kept = orders.where(~((F.col("o_orderstatus") == "P") & low)).select(
        "o_orderkey",
        "o_custkey",
        F.when((F.col("o_orderstatus") == "F") & urgent, None).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(urgent, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )
    added = orders.where((F.col("o_orderstatus") == "O") & low).withColumn(
        "o_orderkey", -F.col("o_orderkey") - 1
    )
    return kept.unionByName(added)


def q_compare_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return compare_tables(orders, loaded_orders(orders), ["o_orderkey"])


def q_compare_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a return lost, and first lines loaded twice."""
    lines = table(spark, sf_dir, "lineitem")
    target = lines.where("l_returnflag <> 'R'").unionByName(
        lines.where("l_returnflag = 'N' AND l_linenumber = 1")
    )
    return compare_rows(lines, target)


def q_compare_tables_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by order, which repeats: quantities of returned lines are one more in the copy."""
    lines = table(spark, sf_dir, "lineitem")
    more = F.when(F.col("l_returnflag") == "R", F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return compare_tables(lines, lines.withColumn("l_quantity", more), ["l_orderkey"])


def q_compare_lobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """French documents loaded in capitals, compared by digest."""
    source = table(spark, sf_dir, "documents")
    target = source.withColumn(
        "text", F.when(F.col("lang") == "fr", F.upper("text")).otherwise(F.col("text"))
    )
    return compare_tables(source, target, ["doc_id"], digest=["text"])


def q_compare_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by order, as in a load that got one quantity wrong."""
    lines = table(spark, sf_dir, "lineitem")
    more = F.when(F.col("l_quantity") == 50, 51.0).otherwise(F.col("l_quantity"))
    return compare_buckets(lines, lines.withColumn("l_quantity", more), ["l_orderkey"])


def q_compare_buckets_lobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one source lost and French ones in capitals; texts are compared by digest."""
    source = table(spark, sf_dir, "documents")
    text = F.when(F.col("lang") == "fr", F.upper("text")).otherwise(F.col("text"))
    target = source.withColumn("text", text).where("source IS NULL OR source <> 'src1'")
    return compare_buckets(source, target, ["doc_id"], digest=["text"], buckets=256)


def q_lob_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    small, large = lob_split(table(spark, sf_dir, "documents"), "text")
    sides = [
        df.select("doc_id", F.lit(side).alias("side"), byte_length(F.col("text")).alias("bytes"))
        for df, side in ((small, "small"), (large, "large"))
    ]
    return sides[0].unionByName(sides[1])


def q_sequence_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = load(spark, sf_dir)
    return sequence_positions({t: (frames[t], k) for t, k in KEYS.items()})


def q_column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct counts here; the default is a sketch."""
    frames = load(spark, sf_dir)
    return union_all([column_stats(frames[t], t, exact_distinct=True) for t in TABLES])


def q_column_stats_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of whole numbers and dates, counted in bitmaps."""
    parts = []
    for t, df in load(spark, sf_dir).items():
        df = df.withColumns({c: F.to_date(c) for c, dtype in df.dtypes if dtype.startswith("timestamp")})
        names = [c for c, dtype in df.dtypes if dtype in ("tinyint", "smallint", "int", "bigint", "date")]
        parts.append(distinct_counts(df, names).select(F.lit(t).alias("table_name"), "*"))
    return union_all(parts)


def q_column_stats_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch, its distinct count told by whether it is within 5 % of the exact one."""
    sketch = union_all([column_stats(df, t) for t, df in load(spark, sf_dir).items()])
    exact = q_column_stats(spark, sf_dir).select(
        "table_name", "column_name", F.col("distinct_count").alias("exact")
    )
    off = F.abs(F.col("distinct_count") - F.col("exact"))
    return sketch.join(exact, ["table_name", "column_name"]).withColumn(
        "distinct_count", F.when(off <= 0.05 * F.col("exact"), F.col("exact")).otherwise(-1)
    ).drop("exact")


def sliced(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    df = table(spark, sf_dir, name)
    return assign_slices(df, key, range_boundaries(df, key, 10))


def q_assign_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliced(spark, sf_dir, "orders", "o_orderdate").select("o_orderkey", "o_orderdate", "slice")


def q_slice_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_balance(sliced(spark, sf_dir, "lineitem", "l_orderkey"), "l_orderkey")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lob_columns": q_lob_columns,
    "lob_profile": q_lob_profile,
    "lob_profile_dedup": q_lob_profile_dedup,
    "partition_info": q_partition_info,
    "size_class": q_size_class,
    "tile_count": q_tile_count,
    "table_report": q_table_report,
    "table_rollup": q_table_rollup,
    "leading_key": q_leading_key,
    "case1_rules": row_case(case1_plain),
    "case2_rules": table_case(case2_ranges),
    "case3_rules": row_case(case3_partitions),
    "case4_rules": table_case(case4_lob_ranges),
    "case4_rules_tiled": table_case(case4_lob_ranges, FEWER_ROWS),
    "case5_rules": row_case(case5_lob_partitions),
    "case6_rules": row_case(case6_lob_plain),
    "load_rules": table_case(load_rules),
    "load_rules_fewer_rows": table_case(load_rules, FEWER_ROWS),
    "load_rules_default_limits": table_case(load_rules, PlanParams()),
    "report_with_rules": q_report_with_rules,
    "final_report": q_final_report,
    "final_report_hidden": q_final_report_hidden,
    "range_boundaries": boundaries("lineitem", "l_orderkey", 7),
    "range_boundaries_ties": boundaries("lineitem", "l_quantity", 7),
    "range_boundaries_text": boundaries("customer", "c_name", 10),
    "range_boundaries_time": boundaries("orders", "o_orderdate", 10),
    "range_boundaries_narrowed": boundaries("lineitem", "l_orderkey", 10, cuts=200),
    "range_boundaries_narrowed_time": boundaries("events", "ts", 10, cuts=100),
    "range_boundaries_narrowed_text": boundaries("events", "event_type", 6, cuts=100),
    "range_boundaries_nulls": q_range_boundaries_nulls,
    "assign_slices": q_assign_slices,
    "slice_balance": q_slice_balance,
    "lob_profile_wide": q_lob_profile_wide,
    "session_report": q_session_report,
    "session_schemas": q_session_schemas,
    "report_stored": q_report_stored,
    "report_updated": q_report_updated,
    "result_dumped": q_result_dumped,
    "rules_as_text": q_rules_as_text,
    "slices_written": q_slices_written,
    "user_databases": q_user_databases,
    "user_pg_databases": q_user_pg_databases,
    "user_schemas": q_user_schemas,
    "name_search": q_name_search,
    "compare_tables": q_compare_tables,
    "compare_rows": q_compare_rows,
    "compare_tables_repeated": q_compare_tables_repeated,
    "compare_lobs": q_compare_lobs,
    "compare_buckets": q_compare_buckets,
    "compare_buckets_lobs": q_compare_buckets_lobs,
    "lob_split": q_lob_split,
    "sequence_positions": q_sequence_positions,
    "column_stats": q_column_stats,
    "column_stats_bitmap": q_column_stats_bitmap,
    "column_stats_sketch": q_column_stats_sketch,
}
