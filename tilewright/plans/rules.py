"""Load rules: which tables are loaded whole, by partition or by key range.

Cases 1, 3, 5 and 6 work on report rows (one per LOB column) and are written
back to the report; cases 2 and 4 work on tables and only exist as rules.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tilewright.functions.columns import tile_count
from tilewright.operators.keys import leading_key_column
from tilewright.operators.report import rollup_by_table
from tilewright.operators.tiles import range_boundaries
from tilewright.params import PlanParams
from tilewright.session import CONCURRENT_PLANS, local_frame, union_all
from tilewright.sources.catalog import Catalog

RULES = (
    "case_id int, ID int, SchemaName string, TableName string, rn int, rule_json string"
)

# Labels written to the report's Type column, by case.
CASE_LABELS = {
    1: "[Table has No Partitions -- Number of Rows <= 10,000,000]",
    3: "[Table has Partitions -- Table does not contain lobs or lobs size is <= 1K]",
    5: "[Table has Partitions -- Table contains lobs > 1K]",
    6: "[Table has No Partitions, has LOBs => 1024KB and Number of Rows <= 10,000,000]",
}

# First rule id of a case; the second rule of a pair is offset.
RULE_ID_BASE = {1: 100_000_000, 2: 200_000_000, 3: 300_000_000, 4: 400_000_000, 5: 500_000_000}
SECOND_RULE_OFFSET = 10_000_000


def case1_plain(report: DataFrame, params: PlanParams = PlanParams()) -> DataFrame:
    """Not partitioned, few rows, no or small LOBs: load whole."""
    few = F.col("rows") <= params.row_limit
    rows = _numbered_rows(report, _whole() & few & _small_lobs(params))
    return _row_rules(rows, 1, _selection(_id(RULE_ID_BASE[1]), filters=True))


def case3_partitions(report: DataFrame, params: PlanParams = PlanParams()) -> DataFrame:
    """Partitioned, no or small LOBs: load by partition."""
    rows = _numbered_rows(report, (F.col("PartitionCount") > 0) & _small_lobs(params))
    return _row_rules(rows, 3, _partition_pair(3))


def case5_lob_partitions(report: DataFrame, params: PlanParams = PlanParams()) -> DataFrame:
    """Partitioned, large LOBs: load by partition."""
    rows = _numbered_rows(report, (F.col("PartitionCount") > 0) & _large_lobs(params))
    return _row_rules(rows, 5, _partition_pair(5))


def case6_lob_plain(report: DataFrame, params: PlanParams = PlanParams()) -> DataFrame:
    """Not partitioned, few rows, LOBs at or above the limit: load whole."""
    few = F.col("rows") <= params.row_limit
    large = (F.col("ContainsLOBs") == "Yes") & (F.col("MaxLOBSizeKB") >= params.lob_limit_kb)
    rows = _numbered_rows(report, _whole() & few & large)
    return _row_rules(rows, 6, _selection(_id(params.case6_base), filters=True))


def case2_ranges(
    report: DataFrame,
    catalog: Catalog,
    tables: Mapping[str, DataFrame],
    params: PlanParams = PlanParams(),
) -> DataFrame:
    """Not partitioned, many rows, no or small LOBs: load by key range.

    A table without a primary key takes its number but gets no rule.
    """
    return _table_cases(report, catalog, tables, params, [2])


def case4_lob_ranges(
    report: DataFrame,
    catalog: Catalog,
    tables: Mapping[str, DataFrame],
    params: PlanParams = PlanParams(),
) -> DataFrame:
    """Not partitioned, large LOBs: load whole, and by key range if there are several tiles."""
    return _table_cases(report, catalog, tables, params, [4])


def load_rules(
    report: DataFrame,
    catalog: Catalog,
    tables: Mapping[str, DataFrame],
    params: PlanParams = PlanParams(),
) -> DataFrame:
    """The rules of all six cases. ``report`` is read repeatedly, so pass a stored one."""
    cases = [
        case1_plain(report, params),
        case3_partitions(report, params),
        case5_lob_partitions(report, params),
        case6_lob_plain(report, params),
        _table_cases(report, catalog, tables, params, [2, 4]),  # a table is in one of them at most
    ]
    return union_all(cases).select(*T.StructType.fromDDL(RULES).names)


def apply_rules(report: DataFrame, rules: DataFrame) -> DataFrame:
    """Write rule text and case label back to the report rows; of two cases the later wins."""
    labels = F.create_map(*[F.lit(x) for pair in CASE_LABELS.items() for x in pair])
    last = (
        rules.where(F.col("ID").isNotNull())
        .groupBy("ID")
        .agg(F.max_by(F.struct("case_id", "rule_json"), "case_id").alias("rule"))
        .select("ID", F.element_at(labels, F.col("rule.case_id")).alias("label"), "rule.rule_json")
    )
    matched = F.col("label").isNotNull()
    written = {
        "Type": F.coalesce("label", "Type"),
        "Table_JSON": F.when(matched, F.col("rule_json")).otherwise(F.col("Table_JSON")),
    }
    return report.join(last, "ID", "left").select(
        *[written.get(c, F.col(c)).alias(c) for c in report.columns]
    )


def _whole() -> Column:
    return F.col("PartitionCount") == 0


def _small_lobs(params: PlanParams) -> Column:
    return (F.col("ContainsLOBs") == "No") | (
        (F.col("ContainsLOBs") == "Yes") & (F.col("MaxLOBSizeKB") <= params.lob_limit_kb)
    )


def _large_lobs(params: PlanParams) -> Column:
    return (F.col("ContainsLOBs") == "Yes") & (F.col("MaxLOBSizeKB") > params.lob_limit_kb)


def _numbered_rows(report: DataFrame, case: Column) -> DataFrame:
    order = W.orderBy("SchemaName", "TableName", "ConcatenatedLOBs", "ID")
    return report.where(case).withColumn("rn", F.row_number().over(order))


def _table_cases(
    report: DataFrame, catalog: Catalog, tables: Mapping[str, DataFrame], params: PlanParams, cases: list[int]
) -> DataFrame:
    """The rules of cases 2 and 4, whose tables are chosen and cut into key ranges together."""
    many = F.col("rows") > params.row_limit
    case = F.when(_whole() & many & _small_lobs(params), 2).when(_whole() & _large_lobs(params), 4)
    chosen = (
        rollup_by_table(report)
        .withColumn("case_id", case)
        .where(F.col("case_id").isin(cases))
        .select(
            "case_id",
            "SchemaName",
            "TableName",
            tile_count(F.col("rows"), params.row_limit, params.max_tiles).alias("tiles"),
        )
    )
    number = F.row_number().over(W.partitionBy("case_id").orderBy("SchemaName", "TableName"))
    numbered = leading_key_column(catalog).join(chosen, ["SchemaName", "TableName"]).withColumn("rn", number)
    pair = _joined(_selection(_id(RULE_ID_BASE[2])), _ranges_rule(2))
    whole = _selection(_id(RULE_ID_BASE[4]), filters=True)
    lob_pair = F.when(F.col("tiles") > 1, _joined(whole, _ranges_rule(4)))
    rule = F.when(F.col("case_id") == 2, pair).otherwise(F.coalesce(lob_pair, whole))
    return _with_boundaries(numbered, tables).select(
        "case_id", "SchemaName", "TableName", "rn", rule.alias("rule_json")
    )


def _with_boundaries(chosen: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Add each table's boundaries as JSON text; null without a key or a second tile."""
    rows = chosen.collect()  # at most one row per table of the catalog
    wanted = [r for r in rows if r.first_column is not None and (r.tiles or 0) > 1]

    def boundaries(r) -> DataFrame:
        found = range_boundaries(tables[f"{r.SchemaName}.{r.TableName}"], r.first_column, r.tiles)
        return found.select(
            F.lit(r.SchemaName).alias("SchemaName"), F.lit(r.TableName).alias("TableName"), "*"
        ).where("loc > 1").groupBy("SchemaName", "TableName").agg(_boundary_json(found))

    spark = chosen.sparkSession
    names = ["case_id", "SchemaName", "TableName", "first_column", "tiles", "rn"]
    known = local_frame(
        spark,
        [tuple(r[c] for c in names) for r in rows],
        "case_id int, SchemaName string, TableName string, first_column string, tiles int, rn int",
    )
    if not wanted:
        return known.withColumn("boundaries", F.lit(None).cast("string"))
    with ThreadPoolExecutor(CONCURRENT_PLANS) as pool:
        parts = list(pool.map(boundaries, wanted))
    return known.join(union_all(parts), ["SchemaName", "TableName"], "left")


def _boundary_json(found: DataFrame) -> Column:
    """``[[key of tile 2],[key of tile 3],...]``: numbers bare, anything else as a string."""
    numeric = isinstance(found.schema["min_val"].dataType, T.NumericType)
    value = F.col("min_val") if numeric else F.col("min_val").cast("string")
    tiles = F.array_sort(F.collect_list(F.struct("loc", value.alias("v"))))
    return F.to_json(F.transform(tiles, lambda t: F.array(t["v"]))).alias("boundaries")


def _row_rules(rows: DataFrame, case: int, rule: Column) -> DataFrame:
    return rows.select(
        F.lit(case).alias("case_id"), "ID", "SchemaName", "TableName", "rn", rule.alias("rule_json")
    )


def _id(base: int) -> Column:
    return (F.col("rn") + base).cast("string")


def _head(kind: str, rule_id: Column) -> list[Column]:
    locator = F.struct(
        F.col("SchemaName").alias("schema-name"), F.col("TableName").alias("table-name")
    )
    return [
        F.lit(kind).alias("rule-type"),
        rule_id.alias("rule-id"),
        rule_id.alias("rule-name"),
        locator.alias("object-locator"),
    ]


def _selection(rule_id: Column, filters: bool = False) -> Column:
    parts = [*_head("selection", rule_id), F.lit("include").alias("rule-action")]
    if filters:
        parts.append(F.array().cast("array<string>").alias("filters"))
    return F.to_json(F.struct(*parts))


def _partition_pair(case: int) -> Column:
    base = RULE_ID_BASE[case]
    load = F.struct(F.lit("partitions-auto").alias("type")).alias("parallel-load")
    second = F.struct(*_head("table-settings", _id(base + SECOND_RULE_OFFSET)), load)
    return _joined(_selection(_id(base)), F.to_json(second))


def _ranges_rule(case: int) -> Column:
    """Null unless the table has a key and boundaries."""
    load = F.struct(
        F.lit("ranges").alias("type"),
        F.array("first_column").alias("columns"),
        # Boundaries are JSON already, typed by the key of each table.
        F.parse_json("boundaries").alias("boundaries"),
    ).alias("parallel-load")
    rule_id = _id(RULE_ID_BASE[case] + SECOND_RULE_OFFSET)
    rule = F.to_json(F.struct(*_head("table-settings", rule_id), load))
    return F.when(F.col("first_column").isNotNull() & F.col("boundaries").isNotNull(), rule)


def _joined(first: Column, second: Column) -> Column:
    """A pair of rules; null if either is."""
    return F.concat(first, F.lit(","), second)
