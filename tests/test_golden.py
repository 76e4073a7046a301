"""Known figures of the test tables at sf0.01."""

import json
from decimal import Decimal

import pytest

from tilewright.operators import final_report, range_boundaries, rollup_by_table, table_report
from tilewright.plans import load_rules, profile_tables
from tilewright.session import materialize
from workload import FEW_ROWS, FEWER_ROWS, Bed, table

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def bed(spark):
    return Bed(spark, SF_DIR)


@pytest.fixture(scope="module")
def report(bed):
    return bed.stored_report()


GOLDEN = {
    ("benchmark", "text"): (40, 0, "0.3847650", 40, "Small"),
    ("conversations", "text"): (536, 0, "1.9169920", 418, "Small"),
    ("customer", ""): (1500, 0, "0", 0, "Small"),
    ("documents", "text"): (1000, 4, "32.2724600", 306, "Small"),
    ("embeddings", ""): (500, 0, "0", 0, "Small"),
    ("events", "props"): (10000, 30, "0.0087890", 10000, "Medium"),
    ("labels", ""): (399, 0, "0", 0, "Small"),
    ("lineitem", ""): (60000, 0, "0", 0, "Large"),
    ("nation", ""): (25, 0, "0", 0, "Small"),
    ("orders", ""): (15000, 0, "0", 0, "Medium"),
    ("pages", "html"): (250, 0, "22.5673820", 5, "Small"),
    ("pages", "url"): (250, 0, "0.0556640", 250, "Small"),
    ("part", ""): (2000, 0, "0", 0, "Small"),
    ("region", ""): (5, 0, "0", 0, "Small"),
    ("supplier", ""): (100, 0, "0", 0, "Small"),
}


def test_report(report):
    got = {
        (r.TableName, r.ConcatenatedLOBs): (
            r.rows, r.PartitionCount, r.MaxLOBSizeKB, r.CountLess1KAndNulls, r.TableSize,
        )
        for r in report.collect()
    }
    assert got == {k: (a, b, Decimal(c), d, e) for k, (a, b, c, d, e) in GOLDEN.items()}


def test_rules_few_rows(bed, report):
    rows = load_rules(report, bed.catalog, bed.tables, FEW_ROWS).collect()
    numbers = {c: [r.TableName for r in sorted(rows, key=lambda r: r.rn) if r.case_id == c] for c in range(1, 7)}
    assert numbers == {
        1: ["benchmark", "conversations", "customer", "embeddings", "labels", "nation", "pages", "part", "region", "supplier"],
        2: ["lineitem", "orders"],
        3: ["events"],
        4: ["pages"],
        5: ["documents"],
        6: ["pages"],
    }
    # Cases 1 and 6 share an id base, so their rule ids collide.
    first = {r.case_id: json.loads(r.rule_json)["rule-id"] for r in rows if r.rn == 1 and r.case_id in (1, 6)}
    assert first == {1: "100000001", 6: "100000001"}


def test_rules_fewer_rows(bed, report):
    rows = load_rules(report, bed.catalog, bed.tables, FEWER_ROWS).collect()
    numbers = {c: [r.TableName for r in sorted(rows, key=lambda r: r.rn) if r.case_id == c] for c in range(1, 7)}
    assert numbers == {
        1: ["benchmark", "nation", "region", "supplier"],
        2: ["conversations", "customer", "embeddings", "labels", "lineitem", "orders", "part"],
        3: ["events"],
        4: ["pages"],
        5: ["documents"],
        6: [],
    }
    by_table = {(r.case_id, r.TableName): r.rule_json for r in rows}
    assert by_table[2, "labels"] is None
    selection, ranges = json.loads("[" + by_table[4, "pages"] + "]")
    assert selection["filters"] == [] and ranges["rule-id"] == "410000001"
    assert ranges["parallel-load"] == {
        "type": "ranges", "columns": ["page_id"], "boundaries": [[84], [167]],
    }


@pytest.mark.parametrize(
    "name, key, tiles, starts",
    [
        ("lineitem", "l_orderkey", 7, [2188, 4320, 6457, 8582, 10715, 12868]),
        ("orders", "o_orderkey", 2, [7500]),
        ("pages", "page_id", 3, [84, 167]),
        ("customer", "c_custkey", 10, [150, 300, 450, 600, 750, 900, 1050, 1200, 1350]),
    ],
)
@pytest.mark.parametrize("limits", [{}, {"cuts": 5}])
def test_boundaries(spark, name, key, tiles, starts, limits):
    found = range_boundaries(table(spark, SF_DIR, name), key, tiles, **limits)
    assert [r.min_val for r in found.where("loc > 1").orderBy("loc").collect()] == starts
