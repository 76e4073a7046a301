import json

from fixtures import make_catalog, make_report, report_row
from pyspark.sql import functions as F

from tilewright.params import PlanParams
from tilewright.plans import (
    apply_rules,
    case1_plain,
    case2_ranges,
    case3_partitions,
    case4_lob_ranges,
    case5_lob_partitions,
    case6_lob_plain,
    load_rules,
)
from tilewright.plans.rules import CASE_LABELS
from tilewright.session import local_frame

LIMITS = PlanParams(row_limit=100, lob_limit_kb=4, max_tiles=10)


def rules_of(df):
    return {(r.case_id, r.TableName): r.rule_json for r in df.collect()}


def parsed(text):
    return json.loads(f"[{text}]")


def catalog(spark, *names, keyed=True, schema="main"):
    tables = [(1001 + i, 1, n, 0) for i, n in enumerate(names)]
    return make_catalog(
        spark,
        schemas=[(1, schema)],
        tables=tables,
        columns=[(t[0], 1, "k", 56, 4) for t in tables],
        indexes=[(t[0], 1 if keyed else 0, int(keyed)) for t in tables],
        index_columns=[(t[0], 1, 1, 1) for t in tables] if keyed else [],
    )


def test_row_cases(spark):
    report = make_report(
        spark,
        report_row(1, "plain", 100),
        report_row(2, "small_lob", 100, lob="x", kb="4"),
        report_row(3, "large_lob", 100, lob="x", kb="4.0000010"),
        report_row(4, "parted", 5, parts=2),
        report_row(5, "parted_lob", 500, parts=2, lob="x", kb="5"),
        report_row(6, "many", 101),
        report_row(7, "unknown", None),
    )
    by_case = {
        case: [r.TableName for r in op(report, LIMITS).orderBy("rn").collect()]
        for case, op in [(1, case1_plain), (3, case3_partitions), (5, case5_lob_partitions), (6, case6_lob_plain)]
    }
    # At exactly the limit a table is in case 1 and in case 6.
    assert by_case == {1: ["plain", "small_lob"], 3: ["parted"], 5: ["parted_lob"], 6: ["large_lob", "small_lob"]}


def test_later_case_wins(spark):
    report = make_report(spark, report_row(1, "edge", 5, lob="x", kb="4"), report_row(2, "many", 500))
    rules = case1_plain(report, LIMITS).unionByName(case6_lob_plain(report, LIMITS))
    rows = {r.TableName: r for r in apply_rules(report, rules).collect()}
    assert rows["edge"].Type == CASE_LABELS[6]
    assert json.loads(rows["edge"].Table_JSON)["rule-id"] == "100000001"
    # Rows that only cases 2 or 4 match keep an empty rule.
    assert (rows["many"].Type, rows["many"].Table_JSON) == (None, "")


def test_case6_base(spark):
    report = make_report(spark, report_row(1, "t", 5, lob="x", kb="9"))
    apart = PlanParams(row_limit=100, lob_limit_kb=4, case6_base=600_000_000)
    assert json.loads(case6_lob_plain(report, apart).first().rule_json)["rule-id"] == "600000001"


def test_rows_and_tables_are_numbered_apart(spark):
    report = make_report(
        spark, report_row(1, "t", 5, lob="a", kb="9"), report_row(2, "t", 5, lob="b", kb="1"), report_row(3, "t", 5, lob="c", kb="8")
    )
    frames = {"main.t": local_frame(spark, [(i,) for i in range(5)], "k int")}
    rows = load_rules(report, catalog(spark, "t"), frames, LIMITS).collect()
    assert sorted((r.case_id, r.ID, r.rn) for r in rows if r.ID) == [(1, 2, 1), (6, 1, 1), (6, 3, 2)]
    assert [(r.case_id, r.rn) for r in rows if r.ID is None] == [(4, 1)]


def test_selection_text(spark):
    report = make_report(spark, report_row(1, 'quo"te', 5, schema="s"))
    text = case1_plain(report, LIMITS).first().rule_json
    assert parsed(text) == [
        {
            "rule-type": "selection",
            "rule-id": "100000001",
            "rule-name": "100000001",
            "object-locator": {"schema-name": "s", "table-name": 'quo"te'},
            "rule-action": "include",
            "filters": [],
        }
    ]


def test_partition_pair(spark):
    report = make_report(spark, report_row(1, "p", 5, parts=3))
    first, second = parsed(case3_partitions(report, LIMITS).first().rule_json)
    assert "filters" not in first and first["rule-id"] == "300000001"
    assert second["rule-id"] == "310000001"
    assert second["parallel-load"] == {"type": "partitions-auto"}


def test_case2(spark):
    report = make_report(spark, report_row(1, "a", 250), report_row(2, "b", 250), report_row(3, "few", 100))
    frames = {f"main.{n}": spark.range(250).select(F.col("id").cast("int").alias("k")) for n in "ab"}
    rules = rules_of(case2_ranges(report, catalog(spark, "a", "b", "few"), frames, LIMITS))
    assert set(rules) == {(2, "a"), (2, "b")}
    first, second = parsed(rules[2, "b"])
    assert (first["rule-id"], second["rule-id"]) == ("200000002", "210000002")
    assert second["parallel-load"] == {"type": "ranges", "columns": ["k"], "boundaries": [[84], [167]]}


def test_case2_without_key(spark):
    report = make_report(spark, report_row(1, "a", 250), report_row(2, "b", 250))
    both = make_catalog(
        spark,
        tables=[(1, 1, "a", 0), (2, 1, "b", 0)],
        columns=[(2, 1, "k", 56, 4)],
        indexes=[(1, 0, 0), (2, 1, 1)],
        index_columns=[(2, 1, 1, 1)],
    )
    frames = {"main.b": spark.range(250).select(F.col("id").alias("k"))}
    rules = rules_of(case2_ranges(report, both, frames, LIMITS))
    assert rules[2, "a"] is None  # takes number 1, but no rule
    assert parsed(rules[2, "b"])[0]["rule-id"] == "200000002"


def test_text_keys_are_quoted(spark):
    report = make_report(spark, report_row(1, "a", 150))
    frames = {"main.a": spark.range(150).select(F.concat(F.lit('k"'), F.lpad(F.col("id").cast("string"), 3, "0")).alias("k"))}
    rule = rules_of(case2_ranges(report, catalog(spark, "a"), frames, LIMITS))[2, "a"]
    assert parsed(rule)[1]["parallel-load"]["boundaries"] == [['k"075']]


def test_date_keys_are_quoted(spark):
    report = make_report(spark, report_row(1, "a", 150))
    frames = {"main.a": spark.range(150).select(F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("k"))}
    rule = rules_of(case2_ranges(report, catalog(spark, "a"), frames, LIMITS))[2, "a"]
    assert parsed(rule)[1]["parallel-load"]["boundaries"] == [["2024-03-16"]]


def test_case4(spark):
    report = make_report(
        spark, report_row(1, "few", 5, lob="x", kb="9"), report_row(2, "many", 250, lob="x", kb="9")
    )
    frames = {f"main.{n}": spark.range(250).select(F.col("id").alias("k")) for n in ("few", "many")}
    c = catalog(spark, "few", "many")
    rules = rules_of(case4_lob_ranges(report, c, frames, LIMITS))
    assert [r["rule-id"] for r in parsed(rules[4, "few"])] == ["400000001"]
    selection, ranges = parsed(rules[4, "many"])
    assert selection["filters"] == [] and ranges["parallel-load"]["boundaries"] == [[84], [167]]
    # Without a key the selection stays and only the ranges go.
    heap = rules_of(case4_lob_ranges(report, catalog(spark, "few", "many", keyed=False), frames, LIMITS))
    assert len(parsed(heap[4, "many"])) == 1
    # A small table with large LOBs is in cases 4 and 6.
    assert rules_of(case6_lob_plain(report, LIMITS)).keys() == {(6, "few")}


def test_no_table_qualifies(spark):
    report = make_report(spark, report_row(1, "few", 5))
    rows = load_rules(report, catalog(spark, "few"), {}, LIMITS).collect()
    assert [(r.case_id, r.ID) for r in rows] == [(1, 1)]
