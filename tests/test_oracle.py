"""Every registered query against its SQL, and the registry itself."""

import pytest

import __spark_entry__ as entry_point
import oracle
import oracle_check
import workload

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_matches_sql(spark, con, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    assert oracle_check.differences(con, df, entry_point.oracle_sql()[name]) is None


def test_registry():
    assert set(workload.QUERIES) == set(oracle.ORACLE)
    assert not set(entry_point.oracle_sql()) - set(entry_point.queries())
    assert set(workload.QUERIES) <= set(entry_point.queries())


def test_entry(spark):
    from tilewright.operators.report import REPORT
    from pyspark.sql import types as T

    df = entry_point.entry(spark)
    wanted = T.StructType.fromDDL(REPORT)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in wanted]
    rows = df.collect()
    assert [r.rows for r in rows] == sorted((r.rows for r in rows), reverse=True)
